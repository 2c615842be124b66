"""Importance resampling of documents towards a target, drawn by parallel sorting by regular sampling.

1. Words of all documents and of the target are counted by hash bucket: one array a task, added up.
   A bucket's gain compares the two; the gains (BUCKETS numbers) go to the tasks as an array.
2. A document's weight is the floored mean of its words' gains, its score that weight plus noise
   from a hash of its id (Gumbel), so the highest scores are a draw without replacement.
3. Each task sorts its documents into a run. Regular samples of the runs, taken each ``step`` rows,
   give the splitters of even segments; the sample is bounded by the number of segments and runs.
4. Rows per segment, summed up, give each segment's first rank. Segments that begin within the
   draw are exchanged, merged locally and ranked exactly; no later one can hold a drawn document.

Runs are written with each row's run and place, which break ties of equal ids, so any number of
equal rows splits evenly. Defined results: null text has no words; a null id is hashed as empty and
comes last among ties; repeated rows are ranked one by one; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import id_type, saved

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Regular samples a segment.
SAMPLES = 8
#: Bytes up to which words are hashed all at once.
SHORT = 64

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    """The table of the reflected polynomial 0xEDB88320, by its rule."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc32_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each byte span, a byte of all short spans at a time."""
    length = ends - starts
    out = np.zeros(len(starts), np.uint32)
    for i in np.flatnonzero(length > SHORT):
        out[i] = zlib.crc32(buf[starts[i] : ends[i]])
    short = np.flatnonzero(length <= SHORT)
    short = short[np.argsort(-length[short], kind="stable")]
    at, left = starts[short], length[short]
    crc = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for j in range(int(left[0]) if len(left) else 0):
        k = int(np.searchsorted(-left, -j, side="left"))
        c = crc[:k]
        crc[:k] = _CRC[(c ^ buf[at[:k] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out[short] = ~crc
    return out


def word_buckets(t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of texts lower-cased in A-Z, and its text's index."""
    t = t.lowered()
    starts, ends = t.runs(_WORD[t.buf])
    return (crc32_spans(t.buf, starts, ends) % np.uint32(BUCKETS)).astype(np.int64), t.owner(starts)


def bucket_counts(df: DataFrame) -> np.ndarray:
    """Words by bucket in all texts; each task sends one array at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, texts in flat.slices(b.column(0)):
                total += np.bincount(word_buckets(texts)[0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = df.select(df["text"].cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and in the raw texts."""
    big_t, big_s = int(target.sum()), int(raw.sum())
    ratio = [((t + 1.0) * (big_s + BUCKETS)) / ((s + 1.0) * (big_t + BUCKETS)) for t, s in zip(target.tolist(), raw.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def noise(key: str | None) -> int:
    h = int(hashlib.sha256(f"{SEED}:{key or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight and score of every document."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        bucket, owner = word_buckets(t)
        n = np.bincount(owner, minlength=t.n)
        total = np.zeros(len(bucket) + 1, np.int64)
        np.cumsum(gain[bucket], out=total[1:])
        ends = np.cumsum(n)
        weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
        score = weight + np.array([noise(k) for k in own[1].to_pylist()], np.int64)
        return {"doc_id": own[0], "n_features": n, "weight": weight, "score": score}

    keyed = docs.select(docs["doc_id"], docs["text"], docs["doc_id"].cast("string").alias("key"))
    return flat.map_texts(keyed, run, f"doc_id {id_type(docs)}, n_features long, weight long, score long", carry=("doc_id", "key"))


def _numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """Rows counted from 0 within equal values of ``by``, in the order they stand in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column(by).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
            if last is not None and key[0] == last:
                place[: first[1] if len(first) > 1 else len(key)] += seen
            last, seen = key[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], [*b.schema.names, name])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, {name} long")


def _runs(rows: DataFrame) -> DataFrame:
    """Each task's rows as a sorted run: the rows that may be drawn, best first, then the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, TaskContext.get().partitionId()))], [*b.schema.names, "run"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    marked = rows.mapInArrow(run, f"{fields}, run long").withColumn("drawable", F.col("n_features") >= MIN_WORDS)
    return _numbered(marked.sortWithinPartitions(F.desc("drawable"), F.desc("score"), F.asc_nulls_last("doc_id")), "run", "pos")


def _key(score, doc_id, run, pos) -> tuple:
    return (-score, doc_id is None, doc_id, run, pos)


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document."""
    gain = gains(bucket_counts(target), bucket_counts(docs))
    runs = saved(_runs(scored(docs, gain)), "runs")
    can = runs.where("drawable")
    total = can.count()
    wanted = total * percent // 100
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(1, min(tasks * 100 // max(percent, 1), total))
    step = max(1, total // (segments * SAMPLES))
    sample = can.where(F.col("pos") % step == 0).select("score", "doc_id", "run", "pos").collect()  # segments x SAMPLES x 2, and one a run, at most
    keys = sorted(_key(*r) for r in sample)
    splitters = [keys[len(keys) * i // segments] for i in range(1, segments)] if keys else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("score", "doc_id", "run", "pos", "drawable")]
            seg = [bisect_right(splitters, _key(*r[:4])) if r[4] else -1 for r in zip(*cols)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seg, pa.int32())], [*b.schema.names, "seg"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    dealt = saved(runs.mapInArrow(place, f"{fields}, seg int"), "segments")
    sizes = np.zeros(segments, np.int64)
    for r in dealt.where("seg >= 0").groupBy("seg").count().collect():  # one row a segment
        sizes[r["seg"]] = r["count"]
    first = np.cumsum(sizes) - sizes
    last = int((first < wanted).sum()) - 1  # of the segments that begin within the draw
    inside = F.col("seg").between(0, last)
    merged = dealt.where(inside).repartitionById(max(last + 1, 1), F.col("seg"))
    merged = merged.sortWithinPartitions("seg", F.desc("score"), F.asc_nulls_last("doc_id"), "run", "pos")
    start = F.element_at(F.array(*(F.lit(int(x)) for x in first[: max(last + 1, 1)])), F.col("seg") + 1)
    ranked = _numbered(merged, "seg", "place").withColumn("rank", start + F.col("place") + 1)
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank.cast("long").alias("rank")).unionByName(dealt.where(~inside).select(*out, F.lit(None).cast("long").alias("rank")))
