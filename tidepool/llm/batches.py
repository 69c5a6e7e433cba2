"""Bytes of many texts at once: slices of an Arrow column as flat arrays, and hashes over them.

Hashes are polynomials modulo 2^64 over prefix sums, so those of any number of substrings cost a few
vector operations for all bytes of a slice, whatever the texts' lengths.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 19
SLICE_ROWS = 1024

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = None


def release_memory() -> None:
    """Give what is free back to the system: Python workers are used again by later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not a C library that can


BATCH_ROWS = 1000
READ_ROWS = 512


def whole_texts(docs: DataFrame) -> DataFrame:
    """``docs``, after making sure that its session reads and sends whole texts in small batches.

    An Arrow batch stands in the memory of both the JVM and the worker, and 10,000 texts, the default,
    have no bound worth the name.  Of a Parquet batch each task keeps the texts in one array, which is
    made twice as large as needed.  A session that sets ``spark.sql.execution.arrow.maxRecordsPerBatch``
    or ``spark.sql.parquet.columnarReaderBatchSize`` itself keeps its own value.
    """
    conf = docs.sparkSession.conf
    for name, usual, rows in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
                              ("spark.sql.parquet.columnarReaderBatchSize", "4096", READ_ROWS)):
        if conf.get(name, usual) == usual:
            conf.set(name, str(rows))
    return docs


CACHES: list[Callable[[], None]] = []   # what empties the encoders that outlive a task
HASHING: list[Callable[[], None]] = []  # and the tables of hashing, which are soon made again


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: bool = False):
    """A function for ``mapInArrow`` that leaves no free memory behind in its worker, and empties the
    caches that outlive a task: those of hashing, and an encoder that another kind of function has
    left there, unless it is to ``keep`` it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            for empty in CACHES:
                empty()
        release_memory()
        try:
            yield from work(batches)
        finally:
            for empty in HASHING:
                empty()
            release_memory()

    return run


def lean_group(work: Callable[[pa.Table], pa.Table]):
    """The same for ``applyInArrow`` on groups."""
    def run(table: pa.Table) -> pa.Table:
        for empty in CACHES:
            empty()
        try:
            return work(table)
        finally:
            release_memory()

    return run


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows; a longer text is a run of its own."""
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(max(end, first + 1), first + max_rows, n)
        yield (first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first])
        first = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of a well-known 64-bit mixer)."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def byte_values() -> np.ndarray:
    """A fixed odd 64-bit value for every byte."""
    global _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
    return _BYTE


_POWERS: dict[int, np.ndarray] = {}
HASHING.append(_POWERS.clear)


def powers(n: int, base: int) -> np.ndarray:
    """The first powers of a base; those for usual slices are computed once in a process."""
    if n <= 2 * SLICE_BYTES:
        if base not in _POWERS:
            _POWERS[base] = _powers(2 * SLICE_BYTES, base)
        return _POWERS[base][:n]
    return _powers(n, base)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=_U)


class SpanHash:
    """Hashes of spans of one byte array: equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        inverse = pow(_BASE, -1, 1 << 64)
        n = len(data)
        terms = byte_values()[data] * powers(n, _BASE)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(terms, dtype=_U, out=self.sums[1:])
        self.back = powers(n + 1, inverse)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width, as good as those of :meth:`spans` in their upper bits
        only: they are not mixed."""
        n = len(self.sums) - width
        out = self.sums[width:] - self.sums[:n]
        out *= self.back[:n]
        return out


class SequenceHash:
    """Hashes of spans of a sequence of 64-bit values: equal values give equal hashes."""

    def __init__(self, values: np.ndarray):
        inverse = pow(_BASE, -1, 1 << 64)
        n = len(values)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(values * powers(n, _BASE), dtype=_U, out=self.sums[1:])
        self.back = powers(n + 1, inverse)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


LONG_WORD = 1 << 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, offsets: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text) of texts that stand end to end."""
    data = _LOWER[data] if fold else data
    solid = ~_BLANK[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True  # a text starts a word even if the one before ends in one
    starts = np.flatnonzero(solid & (begins[:-1] | np.append(True, ~solid[:-1])))
    ends = np.flatnonzero(solid & (begins[1:] | np.append(~solid[1:], True))) + 1
    hashes = SpanHash(data).spans(starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = _long_word(data[starts[i]:ends[i]].tobytes())
    return hashes, np.searchsorted(starts, offsets)


def _long_word(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _long_text(data: np.ndarray, piece: int, fold: bool) -> np.ndarray:
    """Hashes of the words of one text, worked on in pieces that end at a blank."""
    raw, out, at = memoryview(data), [], 0
    while at < len(data):
        end = min(at + piece, len(data))
        if end < len(data):
            part = np.flatnonzero(_BLANK[data[at:end]])
            if len(part):
                end = at + int(part[-1]) + 1
            else:  # a word longer than a piece
                while end < len(data) and not _BLANK[data[end]]:
                    step = np.flatnonzero(_BLANK[data[end:end + piece]])
                    end = end + int(step[0]) if len(step) else min(end + piece, len(data))
                if end - at > LONG_WORD:
                    word = bytes(raw[at:end])
                    out.append(np.array([_long_word(word.lower() if fold else word)], _U))
                    at = end
                    continue
        out.append(_words(data[at:end], np.array([0, end - at]), fold)[0])
        at = end
    return np.concatenate([np.zeros(0, _U), *out])


def word_runs(column: pa.Array, piece: int = SLICE_BYTES, fold: bool = False
              ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words, first word of every row and their end) for runs of rows.

    Words are separated by ASCII white space; with ``fold``, A-Z count as a-z.  A text longer than ``piece`` is a run of its own; beyond
    its bytes it takes eight bytes a word and the room for one piece.
    """
    for first, end, data, offsets in slices(column, piece):
        if end == first + 1 and len(data) > 2 * piece:
            words = _long_text(data, piece, fold)
            yield first, words, np.array([0, len(words)])
        else:
            yield first, *_words(data, offsets, fold)
