"""Sorted Arrow batches of a task, cut at the borders of groups."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa


class Groups(NamedTuple):
    """Rows of whole groups, and where each group and the end lie."""

    table: pa.Table
    bounds: np.ndarray

    def column(self, name: str) -> np.ndarray:
        return self.table[name].to_numpy()


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows that begin a group, but for the first."""
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for key in keys:
        values = table[key].to_numpy()
        new |= values[1:] != values[:-1]
    return np.flatnonzero(new) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[Groups]:
    """Rows sorted by ``keys``, in tables that end where a group ends."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        changes = _changes(table, keys)
        held = table
        if len(changes):
            held = table.slice(changes[-1])
            yield Groups(table.slice(0, changes[-1]), np.concatenate([[0], changes]))
    if held is not None and held.num_rows:
        yield Groups(held, np.concatenate([[0], _changes(held, keys), [held.num_rows]]))
