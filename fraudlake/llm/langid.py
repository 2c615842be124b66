"""Language identification by multilingual mixture inference.

Each learned language has a character model: probabilities of a byte given the two before it,
within words, from counts over all training texts (hashed into ``BUCKETS``). A text's words are
a mixture: expectation-maximisation estimates its language proportions from the words'
likelihoods. Sets of languages, the best one alone and then the leading two, three and so on
up to all, are compared for every text by their likelihood less ``PENALTY`` times log(words) for each further language;
the prediction is the largest proportion within the set that wins.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text where nothing could be learned; repeated rows learn and are scored each; a text is taken
whole; extra columns are ignored; a null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import bucket_of, id_type

BUCKETS = 1 << 16
STEPS = 12
PENALTY = 2.0
SMOOTH = 0.1

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def grams(t: flat.Texts) -> tuple[np.ndarray, ...]:
    """Per letter byte and word end: context (two bytes), hashed trigram; and each word's first item and text."""
    low = np.where(_LETTER[t.buf], flat.LOWER[t.buf], 32).astype(np.int64)
    starts, ends = t.runs(low != 32)
    length = ends - starts + 1  # a word's bytes and its end
    first = np.cumsum(length) - length
    at = np.arange(int(length.sum())) - np.repeat(first - starts, length)
    inside = np.repeat(starts, length)
    padded = np.concatenate([low, [32, 32]])
    stop = np.repeat(ends, length)
    b0 = np.where(at - 2 >= inside, padded[at - 2], 32)
    b1 = np.where(at - 1 >= inside, padded[at - 1], 32)
    b2 = np.where(at < stop, padded[at], 32)
    context = b0 << 8 | b1
    tri = (context << 8 | b2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return context, (tri >> np.uint64(48)).astype(np.int64), first, t.owner(starts)


def _counts(docs: DataFrame) -> DataFrame:
    """lang, at, n: counts of trigram buckets (at < BUCKETS) and of contexts, summed on Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), object)
            for first, last, t in flat.slices(b.column("text")):
                context, tri, start, doc = grams(t)
                owner = np.repeat(doc, np.diff(np.append(start, len(tri))))
                for lang in set(langs[first:last]):
                    mine = (langs[first:last] == lang)[owner]
                    got = np.bincount(tri[mine], minlength=2 * BUCKETS) + np.bincount(context[mine] + BUCKETS, minlength=2 * BUCKETS)
                    total[lang] = total.get(lang, 0) + got
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "at", "n"])

    rows = docs.where("lang is not null and text is not null").where(F.coalesce(bucket_of("doc_id", 4) != 2, F.lit(True)))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log of trigram counts and log of context counts, [language, bucket], smoothed.

    What reaches the driver is bounded by the number of languages, not by the texts.
    """
    rows = _counts(docs).toPandas()
    langs = sorted(rows["lang"].unique())
    n = np.zeros((len(langs), 2 * BUCKETS))
    n[np.searchsorted(langs, rows["lang"].to_numpy(object)) if langs else [], rows["at"].to_numpy(int)] = rows["n"].to_numpy(float)
    return langs, np.log(n[:, :BUCKETS] + SMOOTH).astype(np.float32), np.log(n[:, BUCKETS:] + SMOOTH * 256).astype(np.float32)


def _climb(lik: np.ndarray, owner: np.ndarray, start: np.ndarray, share: np.ndarray, steps: int) -> np.ndarray:
    """Proportions per text after EM steps from ``share``; a language at 0 stays there."""
    n = np.diff(np.append(start, len(owner)))[:, None]
    for _ in range(steps):
        r = share[owner] * lik
        r /= r.sum(1, keepdims=True)
        share = np.add.reduceat(r, start, axis=0) / n
    return share


def infer(logs: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language index, its proportion) per text that has words; logs: [word, language], owner ascending from 0."""
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    n = np.diff(np.append(start, len(owner)))
    top = logs.max(1, keepdims=True)
    lik = np.maximum(np.exp(logs - top), 1e-30)
    alone = np.add.reduceat(np.log(lik), start, axis=0)
    best, value = alone.argmax(1), alone.max(1)
    share = np.ones(len(start))
    mixed = _climb(lik, owner, start, np.full(alone.shape, 1 / alone.shape[1]), STEPS)
    order = np.argsort(-mixed, axis=1, kind="stable")
    for k in range(2, alone.shape[1] + 1):
        inside = np.zeros(alone.shape, bool)
        np.put_along_axis(inside, order[:, :k], True, axis=1)
        some = np.where(inside, np.maximum(mixed, 1e-6), 0)
        some = _climb(lik, owner, start, some / some.sum(1, keepdims=True), STEPS // 2) if k < alone.shape[1] else mixed
        got = np.add.reduceat(np.log(np.maximum((some[owner] * lik).sum(1), 1e-300)), start) - PENALTY * (k - 1) * np.log(n + 1)
        up = got > value
        value[up] = got[up]
        best[up], share[up] = some[up].argmax(1), some[up].max(1)
    return best, share


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    langs, tri_log, context_log = learn(docs)
    names = pa.array([*langs, "und"], pa.string())

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        pred, score = np.full(t.n, len(langs)), np.zeros(t.n)
        context, tri, first, doc = grams(t)
        has = np.array(own[1].to_pylist(), bool)
        if langs and len(first):
            logs = np.stack([np.add.reduceat(a[tri] - b[context], first) for a, b in zip(tri_log, context_log)], axis=1).astype(np.float64)
            some, owner = np.unique(doc, return_inverse=True)
            pred[some], score[some] = infer(logs, owner)
            pred[~has], score[~has] = len(langs), 0.0
        return {"doc_id": own[0], "lang_pred": names.take(pa.array(pred)), "score": score}

    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has"))
    out = flat.map_texts(rows, run, f"doc_id {id_type(docs)}, lang_pred string, score double", carry=("doc_id", "has"))
    held = F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
