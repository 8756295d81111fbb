"""Arrow helpers for operators that run numpy or Python code on batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text that one call of an operator's function gets at most, unless one text alone has more.
BATCH_BYTES = 8 << 20


_holder: list = [None, None]


def claim(owner: str, release: Callable[[], None]) -> None:
    """Says whose tables a worker keeps from now on. Workers serve many tasks; another operator's tables are let go."""
    if _holder[0] not in (None, owner):
        _holder[1]()
    _holder[:] = [owner, release]


def pieces(batch: pa.RecordBatch, text: int = 1, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of consecutive rows whose texts have at most limit bytes; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def by_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch], text: int = 1) -> Callable:
    """For mapInArrow: function, applied to slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield function(piece)

    return run


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null: empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_strings(column: pa.Array) -> list[str]:
    """Each text; null: empty."""
    return [x or "" for x in column.to_pylist()]
