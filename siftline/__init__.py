"""siftline: posting triage on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function; every scalar is
a ``Column`` expression.  The clock is always the ``as_of`` argument, so that a
job gives the same rows whenever, and however often, it is run.
"""

__version__ = "0.1.0"
