"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words and word beginnings, hashed into ``BUCKETS``; a text counts each
once. The machine adds, to a bias and a weight per term, the product of the terms' factor
vectors for every pair in the text, so a pair such as insult and group mention can weigh more
than its parts. Counts of terms by label and the fit use a sample of at most ``FIT_ROWS``
labelled rows per class (a parameter), drawn by a hash of the id; rows held out are never in
it. Every hashed term of the sample has a weight and a factor row, whatever its own association
with the label; weight decay keeps down those that say nothing. All texts are scored whole.

Defined results: null and empty texts have no terms and get the bias alone; without labelled
rows of both classes the score is the smoothed share of toxic rows; several labels of one id
count as toxic if any is; null ids are never labelled or held out; repeated texts of the
sample count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import bucket_of, id_type, saved

BUCKETS = 1 << 18
#: Weight of a toxic row in the fit, against 1 of another, before the classes' shares.
TOXIC_WEIGHT = 2.0
FACTORS = 8
FIT_ROWS = 10_000
HEADS = (4, 5)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of the distinct hashed terms of each text, in order of the text."""
    t = t.lowered()
    starts, ends = t.runs(_LETTER[t.buf])
    doc = t.owner(starts)
    h, owner = [flat.hash_spans(t.buf, starts, ends)], [doc]
    for n in HEADS:
        long = np.flatnonzero(ends - starts > n)
        h.append(flat.mix(flat.hash_spans(t.buf, starts[long], starts[long] + n) + np.uint64(n)))
        owner.append(doc[long])
    key = np.concatenate(owner).astype(np.int64) * BUCKETS + (np.concatenate(h) >> np.uint64(46)).astype(np.int64)
    key = np.unique(key)
    return key % BUCKETS, key // BUCKETS


class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of <factors, factors>)."""

    def __init__(self, features: np.ndarray, bias: float):
        self.slot = np.full(BUCKETS, -1, np.int32)
        self.slot[features] = np.arange(len(features), dtype=np.int32)
        rng = np.random.default_rng(4)
        self.bias, self.w = bias, np.zeros(len(features))
        self.v = rng.normal(0, 0.05, (len(features), FACTORS))

    def rows(self, t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
        bucket, doc = terms(t)
        slot = self.slot[bucket]
        return slot[slot >= 0], doc[slot >= 0]

    def margin(self, slot: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        sums = np.stack([np.bincount(doc, self.v[slot, f], n) for f in range(FACTORS)], axis=1)
        squares = np.bincount(doc, (self.v**2).sum(1)[slot], n)
        return self.bias + np.bincount(doc, self.w[slot], n) + 0.5 * ((sums**2).sum(1) - squares), sums

    def fit(self, slot: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 15, batch: int = 64, rate: float = 0.1, decay: float = 1e-4) -> Machine:
        """Mini-batches of weighted logistic loss with per-parameter steps (Adagrad) and weight decay."""
        rng = np.random.default_rng(5)
        cut = np.searchsorted(doc, np.arange(len(y) + 1))
        gb, gw, gv = 1e-6, np.full(self.w.shape, 1e-6), np.full(self.v.shape, 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(order), batch):
                own = order[i : i + batch]
                s = np.concatenate([slot[cut[j] : cut[j + 1]] for j in own])
                d = np.repeat(np.arange(len(own)), cut[own + 1] - cut[own])
                z, sums = self.margin(s, d, len(own))
                g = weight[own] * (_sigmoid(z) - y[own]) / len(own)
                used = np.unique(s)
                at = np.searchsorted(used, s)
                dw = np.bincount(at, g[d], len(used)) + decay * self.w[used]
                pair = g[d, None] * (sums[d] - self.v[s])
                dv = np.stack([np.bincount(at, pair[:, f], len(used)) for f in range(FACTORS)], axis=1) + decay * self.v[used]
                gb += g.sum() ** 2
                gw[used] += dw**2
                gv[used] += dv**2
                self.bias -= rate * g.sum() / gb**0.5
                self.w[used] -= rate * dw / gw[used] ** 0.5
                self.v[used] -= 0.2 * rate * dv / gv[used] ** 0.5
        return self

    def score(self, t: flat.Texts) -> np.ndarray:
        slot, doc = self.rows(t)
        return _sigmoid(self.margin(slot, doc, t.n)[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(text, y) of at most ``fit_rows`` training rows per class; and the classes' whole counts."""
    known = labels.where("doc_id is not null and toxic is not null").where(bucket_of("doc_id", 5) != 0)
    known = saved(known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")), "labelled")
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    drawn = [known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows) for c in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1])  # 2 * fit_rows rows at most
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    return saved(rows.dropDuplicates(["text", "y"]).select("text", "y"), "fit_rows"), counts


def _counts(sample: DataFrame) -> np.ndarray:
    """Texts per bucket of each class, summed on Spark; 2 x BUCKETS values reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * BUCKETS, np.int64)
        for b in batches:
            y = b.column("y").to_numpy()
            for first, last, t in flat.slices(b.column("text")):
                bucket, doc = terms(t)
                total += np.bincount(bucket + BUCKETS * y[first:last][doc], minlength=2 * BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = sample.select("text", "y").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(2 * BUCKETS)
    out[rows["at"].to_numpy(int)] = rows["n"].to_numpy(float)
    return out.reshape(2, BUCKETS)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    sample, whole = labelled_sample(docs, labels, fit_rows)
    drawn = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    prior = (whole.get(1, 0) + 0.5) / (sum(whole.values()) + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not drawn.get(0) or not drawn.get(1):
        return Machine(np.zeros(0, np.int64), bias)
    n0, n1 = _counts(sample)
    machine = Machine(np.flatnonzero(n0 + n1), bias)

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        slot, doc = machine.rows(t)
        cut = np.searchsorted(doc, np.arange(t.n + 1))
        return {"y": own[0], "slots": pa.array([slot[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())}

    rows = flat.map_texts(sample, run, "y int, slots binary", carry=("y",)).toPandas()  # 2 * fit_rows rows at most
    rows = rows.sort_values(["y", "slots"], kind="stable")
    slots = [np.frombuffer(x, np.int32) for x in rows["slots"]]
    y = rows["y"].to_numpy(float)
    doc = np.repeat(np.arange(len(y)), [len(x) for x in slots])
    weight = np.where(y == 1, TOXIC_WEIGHT * whole[1] / drawn[1], whole[0] / drawn[0])
    return machine.fit(np.concatenate(slots), doc, y, weight / weight.mean())


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    machine = train(docs, labels, fit_rows)
    rows = flat.map_texts(docs, lambda own, t: {"doc_id": own[0], "score": machine.score(t)}, f"doc_id {id_type(docs)}, score double")
    held = F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
