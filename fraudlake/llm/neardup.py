"""Near duplicates by an LSH forest over MinHash signatures.

1. Each text becomes a set of distinct word shingles, a 128-bit fingerprint of the set and a
   MinHash signature of ``HASHES`` values. Equal sets are one class, stood for by its smallest id.
2. The signatures are sorted in ``ORDERS`` orders; order t starts at column 4t and goes round.
   In an order, classes that share the first ``MIN_DEPTH`` values form a region. A region of over
   ``REGION_ROWS`` rows is cut again at twice the depth, and so on, so depth adapts to how crowded
   the region is and no task gets an unbounded one; the first class of each cut-off part is also
   paired with the first of the region it came from.
3. Candidates are the neighbours in sorted order, those with the longest common prefix, within
   ``WINDOW`` places, whose signatures agree as they would at the asked similarity less four
   standard deviations.
4. Candidates are confirmed on full sets in rounds: first the two best neighbours of each class,
   then what still leads from one component to another. Within a component nothing is left to
   prove, so a group of copies costs a few sets per member and never all its pairs.
5. A region of more than ``WINDOW`` + 1 classes is crowded: cutting it, or the window, can hide a
   pair. All classes of crowded regions are joined once more on the rarest shingles of their sets,
   as many as a similar set must share one of, which misses no pair; what joins two components is
   confirmed on full sets.

Defined results: a text without words has an empty set and is linked with nothing; a null id
cannot name a component: such a row takes that of its equals, or none, and is kept only then;
repeated rows are each returned; the rows come back with no other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import id_type, if_small, lookup_join, saved

HASHES = 128
ORDERS = 24
MIN_DEPTH = 4
REGION_ROWS = 1024
WINDOW = 32
PICKS = 2
#: Shingles of crowded classes are ordered by the counts of HEAVY ranges of their hashes, where a
#: range holds at least 1 / HEAVY of all; the counts travel in PARTS rows.
HEAVY, PARTS = 1 << 20, 64

_rng = np.random.default_rng(128)
_MULT = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_FP = _rng.integers(1, 2**63, 2, dtype=np.uint64)


def shingles(t: flat.Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of lower-cased texts, and their text's index (ascending).

    A text of fewer words, but at least one, has its whole sequence as one shingle.
    """
    t = t.lowered()
    starts, ends, doc = t.words()
    words = flat.hash_spans(t.buf, starts, ends)
    grams = flat.gram_hash(words, tuple(range(k)))
    whole = np.flatnonzero(doc[: len(grams)] == doc[k - 1 :]) if len(grams) else np.zeros(0, np.int64)
    h, owner = [grams[whole]], [doc[whole]]
    count = np.bincount(doc, minlength=t.n)
    first = np.searchsorted(doc, np.arange(t.n))
    for n in range(1, k):
        few = np.flatnonzero(count == n)
        if len(few):
            short = flat.gram_hash(words, tuple(range(n)))
            h.append(short[first[few]])
            owner.append(few)
    h, owner = np.concatenate(h), np.concatenate(owner)
    order = np.argsort(flat.keyed(h, owner), kind="stable")
    key = flat.keyed(h, owner)[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.sort(order[new])
    h, owner = h[at], owner[at]
    at = np.argsort(owner, kind="stable")
    return h[at], owner[at]


def sketch_texts(t: flat.Texts, k: int) -> dict:
    h, owner = shingles(t, k)
    n = np.bincount(owner, minlength=t.n)
    some = np.flatnonzero(n)
    at = np.concatenate([[0], np.cumsum(n[some])[:-1]]) if len(some) else np.zeros(0, np.int64)
    fps = [np.zeros(t.n, np.int64) for _ in range(2)]
    sig = np.zeros((len(some), HASHES), np.uint16)
    if len(some):
        for out, c in zip(fps, _FP):
            out[some] = np.add.reduceat(flat.mix(h ^ c), at).view(np.int64)
        for j in range(HASHES):
            low = np.minimum.reduceat((h * _MULT[j] + _ADD[j]) >> np.uint64(32), at)
            sig[:, j] = flat.mix(low) & np.uint64(0xFFFF)
    rows = [None] * t.n
    split = np.concatenate([sig >> np.uint16(8), sig & np.uint16(255)], axis=1).astype(np.uint8)
    for i, row in zip(some, split):
        rows[i] = row.tobytes()
    return {"n_shingles": n.astype(np.int64), "fp1": fps[0], "fp2": fps[1], "sig": pa.array(rows, pa.binary())}


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint (fp1, fp2) and signature of every row."""
    schema = f"doc_id {id_type(docs)}, n_shingles long, fp1 long, fp2 long, sig binary"
    return flat.map_texts(docs, lambda own, t: {"doc_id": own[0]} | sketch_texts(t, k), schema)


def _bytes(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, width)


def _signatures(col: pa.Array) -> np.ndarray:
    """The 16-bit values of signatures kept as all high bytes, then all low bytes."""
    both = _bytes(col, 2 * HASHES).astype(np.uint16)
    return both[:, :HASHES] << np.uint16(8) | both[:, HASHES:]


def _low():
    """The low bytes alone, which neighbours are compared by; chance adds 1 in 256 to an agreement."""
    return F.expr(f"substring(sig, {HASHES + 1}, {HASHES})").alias("low")


def _turned(sig: np.ndarray, t: int) -> np.ndarray:
    return np.roll(sig, -MIN_DEPTH * t, axis=1)


def _region(turned: np.ndarray, t: int, depth: int) -> np.ndarray:
    out = np.full(len(turned), t, np.uint64)
    for j in range(depth):
        out = flat.mix(out * flat._GRAM[1] + turned[:, j])
    return out.view(np.int64)


def _place(classes: DataFrame, id_kind: str) -> DataFrame:
    """rep, order, region at the least depth: one row per class and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = _signatures(b.column("sig"))
            for t in range(ORDERS):
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep"), pa.array(np.full(len(sig), t, np.int32)), pa.array(_region(_turned(sig, t), t, MIN_DEPTH))], ["rep", "t", "region"]
                )

    return classes.select("rep", "sig").mapInArrow(run, f"rep {id_kind}, t int, region long")


def _deeper(rows: DataFrame, depth: int, id_kind: str) -> DataFrame:
    """rep, order, signature, region at the given depth, and the region they came from (parent)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig, t = _signatures(b.column("sig")), b.column("t").to_numpy()
            region = np.zeros(len(sig), np.int64)
            for one in np.unique(t):
                region[t == one] = _region(_turned(sig[t == one], int(one)), int(one), depth)
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("t"), b.column("sig"), pa.array(region), b.column("region")], ["rep", "t", "sig", "region", "parent"])

    return rows.select("rep", "t", "sig", "region").mapInArrow(run, f"rep {id_kind}, t int, sig binary, region long, parent long")


def forest(classes: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Rows (rep, t, low, region) of the regions that hold two classes or more, each of a bounded
    size; pairs (a, b) of the first classes of cut-off parts with those of their regions; and the
    classes (rep) of crowded regions."""
    kind = id_type(classes, "rep")
    placed = _place(classes, kind)
    sizes = saved(placed.groupBy("region").agg(F.count("*").alias("n"), F.min("rep").alias("first")).where("n > 1"), "regions")
    rows = saved(placed.join(sizes, "region").groupBy("rep").agg(F.collect_list(F.struct("t", "region", "n", "first")).alias("at")), "places")
    rows = rows.join(classes.select("rep", "sig"), "rep").select("rep", "sig", F.explode("at").alias("p")).select("rep", "sig", "p.*")
    crowded = rows.where(F.col("n") > WINDOW + 1).select("rep").distinct()
    big = sizes.where(F.col("n") > REGION_ROWS)
    if not big.head(1):
        return rows.select("rep", "t", _low(), "region"), None, crowded
    done, pairs, depth = [rows.where(F.col("n") <= REGION_ROWS).select("rep", "t", _low(), "region")], [], MIN_DEPTH
    hot = saved(rows.where(F.col("n") > REGION_ROWS).select("rep", "t", "sig", "region", "first"), "crowded")
    while hot.head(1):
        depth = min(2 * depth, HASHES)
        firsts = saved(hot.groupBy("region").agg(F.min("first").alias("root")).withColumnRenamed("region", "parent"), "firsts")
        cut = saved(_deeper(hot, depth, kind), "deeper")
        if depth == HASHES:  # equal signatures: parts of any make, tied by their first classes
            cut = cut.withColumn("region", F.xxhash64("region", F.pmod(F.xxhash64("rep"), F.lit(1024))))
        sizes = cut.groupBy("region").agg(F.count("*").alias("n"), F.min("rep").alias("first"), F.first("parent").alias("parent"))
        sizes = saved(sizes, "parts")
        pairs.append(lookup_join(sizes, firsts, "parent", "inner", rows=firsts.count()).where("first <> root").select(F.least("first", "root").alias("a"), F.greatest("first", "root").alias("b")))
        sized = lookup_join(cut.drop("parent"), sizes.drop("parent"), "region", "inner", rows=sizes.count())
        more = (F.col("n") > REGION_ROWS) & F.lit(depth < HASHES)
        done.append(sized.where((F.col("n") > 1) & ~more).select("rep", "t", _low(), "region"))
        hot = saved(sized.where(more).select("rep", "t", "sig", "region", "first"), "crowded")
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, pairs).distinct(), crowded


def _neighbours(rows: DataFrame, least: int, every: bool) -> DataFrame:
    """Pairs (x, y, est) of neighbours within WINDOW places whose labels differ.

    ``every``: all of them; otherwise the best neighbour of each row, on either side.
    """
    kind = id_type(rows, "rep")
    key = F.expr(f"concat(substring(low, {MIN_DEPTH} * t + 1), substring(low, 1, {MIN_DEPTH} * t))")
    rows = rows.withColumn("turned", key).select("region", "turned", "rep", "label")
    rows = rows.repartition("region").sortWithinPartitions("region", "turned", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for b in batches:
            if not b.num_rows:
                continue
            now = (b.column("region").to_numpy(), _bytes(b.column("turned"), HASHES), b.column("rep").to_numpy(zero_copy_only=False), b.column("label").to_numpy(zero_copy_only=False))
            seen = 0 if tail is None else len(tail[0])
            region, sig, rep, label = now if tail is None else [np.concatenate(p) for p in zip(tail, now)]
            best, by = np.zeros(len(rep), np.int32), np.zeros(len(rep), np.int32)
            for o in range(1, min(WINDOW, len(rep) - 1) + 1):
                i = np.flatnonzero((region[o:] == region[:-o]) & (label[o:] != label[:-o])) + o
                i = i[i >= seen]
                if not len(i):
                    continue
                est = (sig[i] == sig[i - o]).sum(1)
                i, est = i[est >= least], est[est >= least]
                if every:
                    yield _pairs(rep[i], rep[i - o], est)
                else:
                    for own, step in ((i, o), (i - o, -o)):
                        up = est > best[own]
                        best[own[up]], by[own[up]] = est[up], step
            if not every:
                i = np.flatnonzero(best)
                yield _pairs(rep[i], rep[i - by[i]], best[i])
            tail = tuple(p[-WINDOW:] for p in (region, sig, rep, label))

    def _pairs(x, y, est) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(est.astype(np.int32))], ["x", "y", "est"])

    return rows.mapInArrow(run, f"x {kind}, y {kind}, est int")


def set_rows(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """rep and its sorted shingle hashes, for the ids asked for."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        h, owner = shingles(t, k)
        cut = np.searchsorted(owner, np.arange(t.n + 1))
        return {"rep": own[0], "shingles": pa.array([np.sort(h[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())}

    wanted = docs.select("doc_id", "text").join(if_small(ids.select(F.col("rep").alias("doc_id"))), "doc_id", "left_semi")
    return flat.map_texts(wanted, run, f"rep {id_type(docs)}, shingles binary").dropDuplicates(["rep"])


def _confirm(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) with whether their full sets are similar enough (linked)."""
    up, down = share
    kind = id_type(pairs, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flags = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                flags.append(down * inter >= up * (len(both) - inter))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(flags, pa.bool_())], ["a", "b", "linked"])

    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return if_small(pairs.select("a", "b")).join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges, a power of two, each hash is in."""
    return (h >> np.uint64(65 - ranges.bit_length())).astype(np.int64)


def _range_counts(sets: DataFrame) -> DataFrame:
    """part, counts: how many shingles of the sets fall into each range, as a task has summed them.

    A task has PARTS rows of HEAVY / PARTS counts, whatever number of sets and shingles it reads.
    """
    ranges, size = HEAVY, HEAVY // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ranges, np.int64)
        for b in batches:
            h = np.frombuffer(b"".join(b.column("shingles").to_pylist()), np.uint64)
            total += np.bincount(_range(h, ranges), minlength=ranges)
        own = [i for i in range(ranges // size) if total[i * size : (i + 1) * size].any()]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([total[i * size : (i + 1) * size].tobytes() for i in own], pa.binary())], ["part", "counts"])

    return sets.select("shingles").mapInArrow(run, "part int, counts binary")


def _counts(sets: DataFrame) -> np.ndarray:
    """The counts of all ranges over all sets: HEAVY numbers."""
    size = HEAVY // PARTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            for part, counts in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["part", "counts"])

    out = np.zeros(HEAVY, np.int64)
    for r in _range_counts(sets).repartition("part").mapInArrow(add, "part int, counts binary").collect():
        out[r.part * size : (r.part + 1) * size] = np.frombuffer(r.counts, np.int64)
    return out


def _prefixes(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """h, rep, n, pos, label: the rarest of each set's n shingles, so many that two similar sets share one.

    Sets of a similarity of share or more have at least that part of the larger in common, so their
    first n - ceil(share * n) + 1 shingles meet, in whatever order all sets keep: here that of the
    counts of their hashes' ranges, with those below the bound as equals, and of hashes. ``pos`` is
    the place in that order, ``label`` that of the set.
    """
    up, down = share
    kind = id_type(sets, "rep")
    n = _counts(sets)
    table = sets.sparkSession.sparkContext.broadcast(np.where((n > 1) & (n * HEAVY >= n.sum()), n, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = table.value
        for b in batches:
            hs, at, size, pos, label = [], [], [], [], b.column("label")
            for i, x in enumerate(b.column("shingles").to_pylist()):
                x = np.frombuffer(x, np.uint64)
                first = np.lexsort((x, n[_range(x, len(n))]))[: len(x) + up * len(x) // -down + 1]
                hs.append(x[first])
                at.append(np.full(len(first), i))
                size.append(np.full(len(first), len(x)))
                pos.append(np.arange(len(first)))
            if hs:
                own = pa.array(np.concatenate(at))
                cells = [pa.array(np.concatenate(hs).view(np.int64)), b.column("rep").take(own), pa.array(np.concatenate(size)), pa.array(np.concatenate(pos)), label.take(own)]
                yield pa.RecordBatch.from_arrays(cells, ["h", "rep", "n", "pos", "label"])

    return sets.select("rep", "shingles", "label").mapInArrow(run, f"h long, rep {kind}, n long, pos long, label {kind}")


def _complete(sets: DataFrame, labels: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(rep, label) once more, with every link between two of the given sets.

    First the components that meet at a shingle are tried by one member each, again until that
    links nothing; then all pairs that still lead from one component to another. Pairs whose
    places in the order leave too few shingles to be similar are never made. Sets get their labels
    before they are spread to shingles; a shingle whose sets are of one component stays so and is left out
    from then on, so only what is still open meets new labels.
    """
    up, down = share
    named = lambda df: df.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    rows = saved(_prefixes(named(sets), share), "prefixes")
    fits = (up * F.col("na") <= down * F.col("nb")) & (up * F.col("nb") <= down * F.col("na"))
    # from a shingle that they share on, two sets can have no more in common than what follows it in either
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    fits = fits & ((up + down) * most >= up * (F.col("na") + F.col("nb")))
    pair = (F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
    checked, every = None, False
    while True:
        mixed = rows.groupBy("h").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("h")
        mixed = saved(mixed, "mixed_shingles")
        rows = saved(lookup_join(rows, mixed, "h", "inner", rows=mixed.count()), "mixed")
        first = F.struct("pos", "rep", "n")  # the place that leaves most in common
        sides = rows if every else rows.groupBy("h", "label").agg(F.min(first).alias("m")).select("h", "label", "m.*")
        one = sides.select("h", F.col("rep").alias("ra"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("label").alias("la"))
        two = sides
        if not every:
            two = saved(sides.groupBy("h").agg(F.min(F.struct("label", "rep", "n", "pos")).alias("m")).select("h", "m.*"), "least_members")
        two = two.select("h", F.col("rep").alias("rb"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("label").alias("lb"))
        tried = lookup_join(one, two, "h", "inner", rows=two.count()).where(F.col("la") > F.col("lb")).where(fits).select(*pair).distinct()
        if checked is not None:
            tried = tried.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        now = saved(_confirm(saved(tried, "crowded_pairs"), sets, share), "crowded_checked")
        linked = bool(now.where("linked").head(1))
        if linked:
            labels = saved(components(now.where("linked").select("a", "b").unionByName(labels.select(F.col("label").alias("a"), F.col("rep").alias("b")))), "labels")
        if every:
            return labels
        if linked:
            rows = named(rows.drop("label"))
        checked = now if checked is None else checked.unionByName(now)
        every = not linked


def components(links: DataFrame) -> DataFrame:
    """(rep, label) of every node of the links (a, b): the smallest node it can reach.

    Alternates large-star and small-star steps until the links no longer change; each step is a
    grouped minimum and a join on the node, written to the shared folder.
    """

    def digest(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    def star(both: DataFrame, large: bool) -> DataFrame:
        """both: (u, v) rows; ties each u's (larger, or smaller) neighbours to the least of them and u."""
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        tied = both.join(least, "u").where("v > u" if large else "v <= u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        if not large:
            tied = tied.unionByName(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
        return tied.where("a <> b").select("a", "b").distinct()

    now = saved(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while (mark := digest(now)) != before:
        before = mark
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        wide = star(both, True)
        now = saved(star(wide.select(F.col("b").alias("u"), F.col("a").alias("v")), False), "links")
    return now.select(F.col("b").alias("rep"), F.col("a").alias("label"))


def near_duplicates(docs: DataFrame, k: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Two documents are linked if share[1] * |intersection| >= share[0] * |union| of their sets of
    k-word shingles; component_id is the smallest doc_id reachable over links, itself included.
    """
    rows = saved(sketches(docs, k), "sketches")
    found = rows.where("n_shingles > 0 and doc_id is not null")
    classes = found.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("sig").alias("sig"))
    classes = saved(classes, "classes")
    labels = _labels(docs, classes, k, share)
    comp = F.coalesce("label", "rep")
    named = classes.join(labels, "rep", "left").where((F.col("n") > 1) | F.col("label").isNotNull())
    named = saved(named.select(F.struct("fp1", "fp2").alias("fp"), comp.alias("component_id")), "named_classes")
    rows = rows.withColumn("fp", F.when(F.col("n_shingles") > 0, F.struct("fp1", "fp2"))).select("doc_id", "n_shingles", "fp")
    out = lookup_join(rows, named, "fp", rows=named.count()).withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _labels(docs: DataFrame, classes: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """(rep, label) of the classes in components of two or more."""
    s = share[0] / share[1]
    least = int(HASHES * (s - 4 * (s * (1 - s) / HASHES) ** 0.5))
    places, ties, crowded = forest(classes)
    crowded = saved(crowded, "crowded_classes")
    places = saved(places, "forest")
    pick = lambda df: F.sort_array(F.collect_set(F.struct("est", "y")), False)
    best = _neighbours(places.withColumn("label", F.col("rep")), least, False)
    best = best.groupBy("x").agg(F.slice(pick(best), 1, PICKS).alias("at")).select("x", F.explode("at.y").alias("y"))
    pairs = best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = saved((pairs if ties is None else pairs.unionByName(ties)).distinct(), "pairs")

    # whoever has any candidate has a best one
    ids = saved(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), "candidates")
    sets = saved(set_rows(docs, saved(ids.union(crowded).distinct(), "wanted"), k), "sets")
    checked = saved(_confirm(pairs, sets, share), "checked")
    labels = saved(components(checked.where("linked")), "labels")

    in_play = places.join(ids.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "rep")
    across = _neighbours(in_play, least, True).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    across = across.join(checked, ["a", "b"], "left_anti")
    across = saved(across, "pairs_across")
    last = saved(_confirm(across, sets, share).where("linked"), "links_across")
    if last.head(1):
        ties = labels.select(F.col("label").alias("a"), F.col("rep").alias("b"))
        labels = saved(components(ties.unionByName(last.select("a", "b"))), "labels")
    if not crowded.head(1):
        return labels
    return _complete(sets.join(if_small(crowded), "rep", "left_semi"), labels, share)
