"""Scanning key-sorted Arrow batches group by group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from .common import tidy_after


def key_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[dict[str, np.ndarray]]:
    """Column arrays of sorted batches, cut so that no key spans two of them.

    Only the rows of the key at the end of a batch are carried to the next.
    """
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        new = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
        if not len(new[key]):
            continue
        have = new if rest is None else {n: np.concatenate((rest[n], new[n])) for n in new}
        cut = int(np.searchsorted(have[key], have[key][-1], side="left"))
        if cut:
            yield {n: x[:cut] for n, x in have.items()}
        rest = {n: x[cut:] for n, x in have.items()}
    if rest is not None:
        yield rest


def changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it; true for the first."""
    out = np.zeros(len(columns[0]), dtype=bool)
    if len(out):
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def scan(key: str, schema: pa.Schema, step: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]):
    """A function for ``mapInArrow`` that applies ``step`` to whole key groups."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_runs(batches, key):
            out = step(part)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema)

    return run
