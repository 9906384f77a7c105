"""The same operators, fed by a stream."""
