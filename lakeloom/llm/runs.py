"""Key runs of sorted Arrow batches, for blocked comparisons inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Slices that each hold all rows of one key: the first ``keys`` columns.

    Batches come sorted by key; only the run at hand is held. A run of one
    row has nothing to compare and is left out.
    """
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            key = tuple(c[s] for c in cols)
            if key != at:
                if sum(h.num_rows for h in held) > 1:
                    yield pa.Table.from_batches(held)
                held, at = [], key
            held.append(b.slice(s, e - s))
    if sum(h.num_rows for h in held) > 1:
        yield pa.Table.from_batches(held)
