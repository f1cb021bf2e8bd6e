"""Arrow batches in slices, so that little text at a time becomes Python strings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

#: bytes of text in a slice
SLICE = 1 << 20


def slices(batch, column: str = "text", size: int = SLICE) -> Iterator:
    """Runs of rows of a record batch of about ``size`` bytes in ``column``; a longer text is a run of its own.

    They share the batch's buffers.
    """
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        if total + n > size and i > begin:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def tidy(work: Callable) -> Callable:
    """A map over batches that gives the memory it has freed back to the system when a task ends.

    Python workers live on and serve later stages: what they keep for themselves, the executor lacks.
    """

    @wraps(work)
    def run(batches):
        import ctypes
        import gc

        import pyarrow as pa

        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library has it
            pass

    return run
