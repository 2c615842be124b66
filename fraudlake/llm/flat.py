"""Texts of an Arrow batch as one flat byte array, cut into words with numpy.

Every text operator of this package runs through :func:`map_texts`: Spark deals the rows,
``mapInArrow`` hands each task its batches, and a batch is worked through in slices of a
few MB, so a task's memory is bounded by the slice or by its longest single text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that are worked on at once (a longer single text is taken whole).
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**63, dtype=np.uint64)) * 8 + 5 & (2**64 - 1)
_GRAM = [np.uint64(int(x) * 2 + 1) for x in _rng.integers(1, 2**63, 64, dtype=np.uint64)]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Texts:
    """Texts as ``buf`` (uint8) with ``offs`` (len + 1 offsets, from 0); nulls are empty."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.n = buf, offs, len(offs) - 1

    def lowered(self) -> Texts:
        return Texts(LOWER[self.buf], self.offs)

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value per byte."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def owner(self, at: np.ndarray) -> np.ndarray:
        """Index of the text that holds each byte position."""
        return np.searchsorted(self.offs, at, side="right") - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of marked bytes; a run never crosses texts."""
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offs] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end[:-1] &= ~inside[1:] | edge[1:-1]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text index of the words ``[^\\x20\\x09-\\x0D]+``."""
        starts, ends = self.runs(~SPACE[self.buf])
        return starts, ends, self.owner(starts)


def _grow(n: int) -> None:
    if len(_powers[0]) < n:
        n = max(n, 2 * SLICE_BYTES)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over coded bytes from one prefix sum."""
    _grow(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[buf] * _powers[0][: len(buf)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers[1][starts]
    return mix(h + (ends - starts).astype(np.uint64) * _GRAM[0])


def gram_hash(h: np.ndarray, at: tuple[int, ...]) -> np.ndarray:
    """Hash of the items at the given offsets from each position (ordered)."""
    n = len(h) - at[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, i in enumerate(at):
        out += h[i : i + n] * _GRAM[k + 1]
    return mix(out)


def keyed(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes made distinct per owner."""
    return mix(h ^ mix(owner.astype(np.uint64) + _GRAM[40]))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    """(first, last, Texts) pieces of a string column, each of about SLICE_BYTES."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offs, offs[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, Texts(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
        first = last


def map_texts(
    df: DataFrame, fn: Callable[[list[pa.Array], Texts], dict], schema: T.StructType | str, *, carry: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Apply ``fn(carried columns, texts)`` to slices of the rows; it returns columns by name.

    Only the text and the carried columns are read, so extra columns of any name are harmless.
    """
    cols = [df[c] for c in carry] + [df[text].cast("string").alias("__text")]
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in slices(batch.column(batch.num_columns - 1)):
                own = [batch.column(i).slice(first, last - first) for i in range(batch.num_columns - 1)]
                got = fn(own, texts)
                if got is not None:
                    yield pa.RecordBatch.from_arrays([_array(got[c]) for c in names], names)

    return df.select(*cols).mapInArrow(run, schema)


def _array(x) -> pa.Array:
    return x if isinstance(x, pa.Array) else pa.array(x)


def annotate(df: DataFrame, fn: Callable[[Texts], dict], schema: str, *, text: str = "text") -> DataFrame:
    """All columns of ``df``, untouched, and the columns that ``fn(texts)`` gives for each row.

    The new columns' names must not be among those of ``df``; callers use a ``__`` prefix.
    """
    added = T.StructType.fromDDL(schema)
    names = [f.name for f in added.fields]
    out = T.StructType(df.schema.fields + added.fields)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in slices(batch.column(at)):
                got = fn(texts)
                own = [batch.column(i).slice(first, last - first) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays(own + [_array(got[c]) for c in names], out.names)

    return df.mapInArrow(run, out)
