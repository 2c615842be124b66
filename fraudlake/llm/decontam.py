"""Benchmark decontamination by spaced-seed hashing.

A mask names the token positions of a window that are hashed; the others may differ, so a seed
survives substitutions. Three masks of five tokens together hit every 15-token passage with up
to three substituted tokens. Hashes of all test items are joined with those of all training
texts; each hit fixes a diagonal (offset of the text against the item), along which the longest
stretch with at least 80 % equal tokens is measured. A text is contaminated by an item if that
stretch is 13 tokens, or 80 % of a shorter item.

Tokens are runs of letters and digits in lower case, so punctuation never hides a passage.

Defined results: null or empty texts and items match nothing; items below five tokens are
searched by their whole token sequence; repeated items are each reported, a repeated doc_id
once per item; rows without an id are not reported; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import BROADCAST_ROWS, id_type, if_small, saved

#: Token offsets that each mask hashes.
MASKS = ((0, 1, 3, 4, 5), (0, 2, 7, 8, 9), (0, 1, 2, 7, 8))
RUN_TOKENS = 13
#: A stretch may have one unequal token for every four equal ones.
MISS = 4
#: Distinct item seeds up to which tasks hold them to drop other windows before the join.
FILTER_SEEDS = 2_000_000


_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _tokens(t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and text index of the tokens: runs of letters and digits of texts in lower case."""
    starts, ends = t.runs(_LETTER[t.buf])
    return flat.hash_spans(t.buf, starts, ends), t.owner(starts)


def _lower(column: str):
    return F.lower(F.col(column).cast("string"))


def short_masks(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """(first position, offsets from it) of the masks of an item of n tokens, below RUN_TOKENS.

    One substitution for every five tokens is allowed: none below five, where the whole is one
    mask; with one, a mask leaves out each position in turn; with two, the item is cut into four
    blocks, of which two stay whole, and each two blocks are a mask.
    """
    every = range(n)
    if n < MISS + 1:
        masks = [tuple(every)]
    elif n < 2 * (MISS + 1):
        masks = [tuple(i for i in every if i != out) for out in every]
    else:
        blocks = [range(n * k // 4, n * (k + 1) // 4) for k in range(4)]
        masks = [(*blocks[a], *blocks[b]) for a in range(4) for b in range(a + 1, 4)]
    return [(m[0], tuple(i - m[0] for i in m)) for m in masks]


def _hashed(words: np.ndarray, doc: np.ndarray, at: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    h = flat.gram_hash(words, at)
    same = np.flatnonzero(doc[: len(h)] == doc[at[-1] :]) if len(h) else np.zeros(0, np.int64)
    return flat.mix(h[same] + np.uint64(sum((i + 1) << 3 * k for k, i in enumerate(at)))), same


def seeds(words: np.ndarray, doc: np.ndarray, lengths: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of all windows of each mask, and of those of items of the given lengths."""
    for at in dict.fromkeys([*MASKS, *(m for n in lengths for _, m in short_masks(n))]):
        yield _hashed(words, doc, at)


def _first(doc: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(n))


def item_seeds(items: DataFrame) -> DataFrame:
    """h, item_id, pos, n of every window of the items, and of the masks of short items at their places."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        words, doc = _tokens(t)
        count, first = np.bincount(doc, minlength=t.n), _first(doc, t.n)
        got = [*seeds(words, doc)]
        for n in range(1, RUN_TOKENS):
            for begin, mask in short_masks(n):
                h, at = _hashed(words, doc, mask)
                own_place = (count[doc[at]] == n) & (at - first[doc[at]] == begin)
                got.append((h[own_place], at[own_place]))
        h = np.concatenate([x for x, _ in got]) if got else np.zeros(0, np.uint64)
        at = np.concatenate([x for _, x in got]) if got else np.zeros(0, np.int64)
        return {"h": h.view(np.int64), "item_id": own[0].take(pa.array(doc[at])), "pos": (at - first[doc[at]]).astype(np.int64), "n": count[doc[at]]}

    rows = items.where("item_id is not null and text is not null").select("item_id", _lower("text").alias("text"))
    return flat.map_texts(rows, run, f"h long, item_id {id_type(items, 'item_id')}, pos long, n long", carry=("item_id",))


def text_seeds(docs: DataFrame, lengths: tuple[int, ...], wanted) -> DataFrame:
    """h, doc_id, pos of the windows of the texts; ``wanted`` (a Spark broadcast) keeps those of items."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict | None:
        words, doc = _tokens(t)
        first, hs, ats = _first(doc, t.n), [], []
        table = None if wanted is None else _table(wanted.value)
        for h, at in seeds(words, doc, lengths):
            if table is not None:
                bits, sorted_seeds = table
                maybe = np.flatnonzero(bits[h >> np.uint64(42)])
                h, at = h[maybe], at[maybe]
                i = np.minimum(np.searchsorted(sorted_seeds, h), len(sorted_seeds) - 1)
                hit = sorted_seeds[i] == h
                h, at = h[hit], at[hit]
            hs.append(h)
            ats.append(at)
        if not hs:
            return None
        h, at = np.concatenate(hs), np.concatenate(ats)
        return {"h": h.view(np.int64), "doc_id": own[0].take(pa.array(doc[at])), "pos": (at - first[doc[at]]).astype(np.int64)}

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", _lower("text").alias("text"))
    return flat.map_texts(rows, run, f"h long, doc_id {id_type(docs)}, pos long")


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(sorted_seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap over the top 22 bits in front of the sorted seeds; kept per worker."""
    if id(sorted_seeds) not in _tables:
        _tables.clear()
        bits = np.zeros(1 << 22, bool)
        bits[sorted_seeds >> np.uint64(42)] = True
        _tables[id(sorted_seeds)] = bits, sorted_seeds
    return _tables[id(sorted_seeds)]


def longest_run(equal: np.ndarray) -> tuple[int, int]:
    """(length, equal tokens) of the longest stretch with at least MISS equal per unequal token."""
    if not equal.any():
        return 0, 0
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISS))])
    least = np.minimum.accumulate(total)
    # the first place whose total is not above a given one: least falls, so search it backwards
    start = np.searchsorted(-least, -total, side="left")
    length = np.arange(len(total)) - start
    end = int(np.argmax(length))
    return int(length[end]), int(equal[start[end] : end].sum())


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per contaminated (doc_id, item_id): n_item_words, run_words, matched_words, overlap."""
    spark = docs.sparkSession
    found = saved(item_seeds(items), "item_seeds")
    lengths = tuple(r.n for r in found.where(F.col("n") < RUN_TOKENS).select("n").distinct().collect())  # RUN_TOKENS - 1 values at most
    distinct = found.select("h").distinct()
    few = distinct.limit(FILTER_SEEDS + 1).count() <= FILTER_SEEDS
    wanted = None
    if few:
        wanted = spark.sparkContext.broadcast(np.sort(distinct.toPandas()["h"].to_numpy(np.int64).view(np.uint64)))
        if not len(wanted.value):
            wanted = spark.sparkContext.broadcast(np.zeros(1, np.uint64))
    hits = text_seeds(docs, lengths, wanted).join(if_small(found.select("h", "item_id", F.col("pos").alias("at"))), "h")
    pairs = hits.groupBy("doc_id", "item_id").agg(F.collect_set(F.col("pos") - F.col("at")).alias("diagonals"))
    pairs = saved(pairs, "leak_pairs")
    texts = docs.select("doc_id", _lower("text").alias("text"))
    texts = texts.join(if_small(pairs.select("doc_id").distinct()), "doc_id", "left_semi")
    named = items.select("item_id", _lower("text").alias("item"))
    named = named.join(pairs.select("item_id").distinct(), "item_id", "left_semi").dropDuplicates()
    rows = pairs.join(if_small(named, BROADCAST_ROWS // 100), "item_id").join(texts, "doc_id").select("doc_id", "item_id", "diagonals", "item", "text")
    kinds = id_type(docs), id_type(items, "item_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for diagonals, item, text in zip(*(b.column(c).to_pylist() for c in ("diagonals", "item", "text"))):
                one, two = ([*flat.slices(pa.array([x], pa.large_string()))][0][2] for x in (item, text))
                got.append(_align(_tokens(one)[0], _tokens(two)[0], diagonals))
            n, run_words, matched = (np.array(x, np.int64) for x in zip(*got)) if got else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("item_id"), *map(pa.array, (n, run_words, matched))], ["doc_id", "item_id", "n_item_words", "run_words", "matched_words"])

    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item_words long, run_words long, matched_words long"
    best = rows.mapInArrow(run, schema).groupBy("doc_id", "item_id").agg(F.max(F.struct("run_words", "matched_words", "n_item_words")).alias("r"))
    best = best.select("doc_id", "item_id", "r.n_item_words", "r.run_words", "r.matched_words")
    enough = (F.col("run_words") >= RUN_TOKENS) | (5 * F.col("matched_words") >= 4 * F.col("n_item_words"))
    return best.where(enough).withColumn("overlap", F.col("matched_words") / F.col("n_item_words"))


def _align(item: np.ndarray, text: np.ndarray, diagonals: list[int]) -> tuple[int, int, int]:
    best = (0, 0)
    for d in diagonals:
        a, b = max(0, -d), min(len(item), len(text) - d)
        if b > a:
            best = max(best, longest_run(item[a:b] == text[a + d : b + d]))
    return len(item), *best
