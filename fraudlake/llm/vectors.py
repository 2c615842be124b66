"""Nearest neighbours by largest inner product, over robust-pruned directed graphs.

1. Equal vectors are one class, stood for by its smallest id; of its rows the k + 1 smallest ids are
   kept as members, more can't be among any k nearest.
2. Classes are dealt by hash into shards of about SHARD_ROWS. In each shard a graph is built
   (:func:`build`): points enter in doubling batches; a greedy search from the entry points proposes
   a point's neighbours, pruning keeps those that no kept one is closer to by the factor ALPHA, so
   edges stay diverse, and the reverse edges are added and pruned alike. The graphs are written once.
3. A beam search (:func:`beam`) takes each distinct query vector through each shard. Queries come in
   blocks of bounded size; a task holds one shard and one block.
4. The shards' best are scored in doubles, added up component by component, and merged; classes
   become their members, a query its own rows' results.

Largest inner product becomes least distance with one more component, sqrt(M^2 - |x|^2), where M is
the largest norm; a query has 0 there. Every vector is in a graph, whatever its number of copies.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part; a query meets vectors of its own length only; a row is known by its vec_id, so rows of the
query's vec_id are never its neighbours, and repeated equal rows count once. A null vec_id takes no
part. Ties go to smaller ids. Only vec_id and embedding are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import id_type, saved

K = 20
#: Classes a shard, about; and queries a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
#: Out-edges of a point, beam width of build and search, relaxation of the pruning.
DEGREE = 48
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
#: Entry points of a graph: its first points, and rows searched at once.
ENTRIES = 8
AT_ONCE = 512
#: Pairs of candidates compared at once when edges are pruned.
PAIRS_AT_ONCE = 1 << 21


def _distances(x: np.ndarray, norms: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """|x|^2 - 2 q x for the points ``ids`` of each query row: squared distance less |q|^2."""
    return norms[ids] - 2 * np.matmul(x[ids], q[:, :, None])[:, :, 0]


def beam(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``width`` points nearest to each row of q that a greedy walk finds.

    ``edges``: (points, degree), -1 where there is none. Each step opens the nearest point of the
    beam that isn't open yet, for all rows at once, until all of every beam are open.
    """
    rows, none = len(q), len(x)
    ids = np.full((rows, width), none, np.int64)
    dist = np.full((rows, width), np.inf, x.dtype)
    opened = np.zeros((rows, width), bool)
    first = entries[:width]
    ids[:, : len(first)] = first
    dist[:, : len(first)] = _distances(x, norms, q, np.broadcast_to(first, (rows, len(first))))
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    at = np.arange(rows)
    while len(at):
        todo = ~opened[at] & (ids[at] < none)
        some = todo.any(1)
        at, todo = at[some], todo[some]
        if not len(at):
            break
        pick = todo.argmax(1)
        opened[at, pick] = True
        near = edges[ids[at, pick]]
        new = near >= 0
        near = np.where(new, near, 0)
        d = _distances(x, norms, q[at], near)
        worst = dist[at, -1]
        new &= d < worst[:, None]
        r, c = np.nonzero(new)
        if not len(r):
            continue
        seen = (ids[at[r]] == near[r, c][:, None]).any(1)
        new[r[seen], c[seen]] = False
        d = np.where(new, d, np.inf)
        all_d = np.concatenate([dist[at], d], axis=1)
        order = np.argsort(all_d, axis=1)[:, :width]
        dist[at] = np.take_along_axis(all_d, order, 1)
        ids[at] = np.take_along_axis(np.concatenate([ids[at], np.where(new, near, none)], axis=1), order, 1)
        opened[at] = np.take_along_axis(np.concatenate([opened[at], np.zeros_like(new)], axis=1), order, 1)
    return ids, dist


def prune(x: np.ndarray, points: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Out-edges of each point from its candidates (rows of ``near``, -1 for none, repeats allowed).

    Nearest first; a kept neighbour removes every candidate that is ALPHA times closer to it than
    to the point. What is pruned fills the rest of the edges, nearest first.
    """
    n, c = near.shape
    d = ((x[np.maximum(near, 0)] - x[points][:, None, :]) ** 2).sum(2)
    d[(near < 0) | (near == points[:, None])] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
    same = np.sort(near, axis=1)
    if c > 1 and (same[:, 1:] == same[:, :-1]).any():  # equal ids stand side by side within equal distances at most
        for j in range(1, c):
            d[(near[:, :j] == near[:, j : j + 1]).any(1), j] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
    vecs = x[np.maximum(near, 0)]
    size = (vecs * vecs).sum(2)
    between = size[:, :, None] + size[:, None, :] - 2 * np.matmul(vecs, vecs.transpose(0, 2, 1))
    closer = ALPHA * ALPHA * between <= d[:, None, :]  # [i, j, m]: j removes m
    open_, kept, left = np.isfinite(d), np.zeros((n, c), bool), np.full(n, DEGREE)
    for j in range(c):
        take = open_[:, j] & (left > 0)
        kept[:, j] = take
        left -= take
        open_ &= ~(closer[:, j] & take[:, None])
    rank = np.where(kept, 0, np.where(np.isfinite(d), 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :DEGREE]
    out = np.where(np.isfinite(np.take_along_axis(d, order, 1)), np.take_along_axis(near, order, 1), -1)
    if out.shape[1] < DEGREE:
        out = np.concatenate([out, np.full((n, DEGREE - out.shape[1]), -1, np.int64)], axis=1)
    return out


def _add_reverse(x: np.ndarray, edges: np.ndarray, points: np.ndarray) -> None:
    """Edges back to ``points``; a point with more than DEGREE is pruned, all its edges considered."""
    to = edges[points].ravel()
    frm = np.repeat(points, edges.shape[1])[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    who, first, count = np.unique(to, return_index=True, return_counts=True)
    by = np.argsort(count, kind="stable")  # points with about as many new edges together
    lo = 0
    while lo < len(by):
        wide = int(count[by[min(lo + AT_ONCE, len(by)) - 1]])
        part = by[lo : lo + max(1, min(AT_ONCE, PAIRS_AT_ONCE // (wide + DEGREE) ** 2))]
        wide, own = int(count[part].max()), np.repeat(np.arange(len(part)), count[part])
        place = np.arange(len(own)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        back = np.full((len(part), wide), -1, np.int64)
        back[own, place] = frm[first[part][own] + place]
        edges[who[part]] = prune(x, who[part], np.concatenate([edges[who[part]], back], axis=1))
        lo += len(part)


def build(x: np.ndarray) -> np.ndarray:
    """Edges (len(x), DEGREE), -1 for none, of the graph over the rows of x, taken in their order."""
    n = len(x)
    norms = (x * x).sum(1)
    edges = np.full((n, DEGREE), -1, np.int64)
    done = min(n, 2 * DEGREE)
    start = np.arange(done)
    if done > 1:
        edges[start] = prune(x, start, np.broadcast_to(start, (done, done)).copy())
    while done < n:
        last = min(n, 2 * done)
        for lo in range(done, last, AT_ONCE):
            points = np.arange(lo, min(lo + AT_ONCE, last))
            near, _ = beam(x, norms, edges, np.arange(min(ENTRIES, n)), x[points], BUILD_BEAM)
            edges[points] = prune(x, points, np.where(near < n, near, -1))
            _add_reverse(x, edges, points)
        done = last
    return edges


def _usable(rows: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and its class key of the rows that take part."""
    out = rows.select(rows["vec_id"], rows["embedding"].cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    v = F.transform("v", lambda c: c + F.lit(0.0))  # -0.0 is 0.0
    key = F.concat_ws(":", F.xxhash64("v"), F.xxhash64(F.lit(1), "v"))
    return out.where(F.coalesce(fine, F.lit(False))).select("vec_id", v.alias("v")).withColumn("key", key)


def _floats(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _raised(x: np.ndarray, norm2: float) -> np.ndarray:
    """Single precision, scaled by the largest norm, with the component that makes all norms equal."""
    x = x / math.sqrt(norm2)
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def graphs(classes: DataFrame) -> DataFrame:
    """shard, key, rep, v and edges (places within the shard) of every class; ``top``: largest squared norm."""
    kind = id_type(classes, "rep")

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("mix").to_numpy(), kind="stable")))
        x = _raised(_floats(table.column("v")), table.column("top")[0].as_py())
        edges = build(x)
        at = pa.array(np.arange(len(x)), pa.int32())
        lists = pa.ListArray.from_arrays(np.arange(0, edges.size + 1, DEGREE).astype(np.int32), pa.array(edges.ravel().astype(np.int32)))
        own = ["shard", "key", "rep", "v", "top"]
        return pa.table([*(table.column(c) for c in own), at, lists], [*own, "at", "edges"])

    keyed = classes.withColumn("mix", F.xxhash64(F.lit(7), "key"))
    return keyed.groupBy("shard").applyInArrow(run, f"shard string, key string, rep {kind}, v array<double>, top double, at int, edges array<int>")


def _search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """asked, key, rep, score: of each query vector the best k classes of each shard that the beam finds."""
    kind = id_type(index, "rep")

    def run(graph: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["asked", "key", "rep", "score"]
        if not graph.num_rows or not asked.num_rows:
            empty = [asked.schema.field("asked").type, graph.schema.field("key").type, graph.schema.field("rep").type, pa.float64()]
            return pa.table([pa.array([], t) for t in empty], names)
        graph = graph.take(pa.array(np.argsort(graph.column("at").to_numpy(), kind="stable")))
        exact, q, reps = _floats(graph.column("v")), _floats(asked.column("v")), graph.column("rep").to_numpy()
        n = len(exact)
        x = _raised(exact, graph.column("top")[0].as_py())
        edges = _floats(graph.column("edges")).astype(np.int64)
        norms, entries = (x * x).sum(1), np.arange(min(ENTRIES, n))
        out = []
        for lo in range(0, len(q), AT_ONCE):
            part = q[lo : lo + AT_ONCE]
            size = np.sqrt((part * part).sum(1, keepdims=True))
            ids, _ = beam(x, norms, edges, entries, np.concatenate([part / size, np.zeros_like(size)], axis=1).astype(np.float32), max(BEAM, k))
            score = np.zeros(ids.shape)
            for j in range(part.shape[1]):  # component by component, so that sums don't depend on the machine
                score += part[:, j, None] * np.append(exact[:, j], 0.0)[ids]
            score[ids == n] = -np.inf
            order = np.lexsort((np.append(reps, 0)[ids], -score))[:, :k]
            row = np.repeat(np.arange(lo, lo + len(part)), order.shape[1])
            found, score = np.take_along_axis(ids, order, 1).ravel(), np.take_along_axis(score, order, 1).ravel()
            out.append((row[found < n], found[found < n], score[found < n]))
        row, found, score = (np.concatenate(c) for c in zip(*out))
        picked = graph.select(["key", "rep"]).take(pa.array(found))
        return pa.table([asked.column("asked").take(pa.array(row)), picked.column("key"), picked.column("rep"), pa.array(score)], names)

    return index.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(run, f"asked string, key string, rep {kind}, score double")


def nearest(rows: DataFrame, asked: Column | None = None, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows nearest to each row whose vec_id is divisible by 20.

    ``asked``: the condition on vec_id that makes a row a query, if another.
    """
    asked = (F.col("vec_id") % 20 == 0) if asked is None else asked
    use = saved(_usable(rows), "vectors")
    classes = saved(_classes(use, asked, k), "vector_classes")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    size = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum("asked").alias("q"), F.max(norm2).alias("top"))
    shards, blocks = F.ceil(F.col("n") / SHARD_ROWS).cast("int"), F.greatest(F.ceil(F.col("q") / BLOCK_ROWS), F.lit(1)).cast("int")
    size = size.select("d", shards.alias("shards"), blocks.alias("blocks"), "top")  # one row for each length of vectors
    sized = classes.withColumn("d", F.size("v")).join(F.broadcast(size), "d")
    named = lambda n: F.concat_ws("/", "d", n)
    index = sized.select(named(F.pmod(F.xxhash64("key"), F.col("shards"))).alias("shard"), "key", "rep", "v", "top")
    index = saved(graphs(index), "graphs")

    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("s")
    block = F.pmod(F.xxhash64(F.lit(3), "key"), F.col("blocks")).cast("int")
    queries = sized.where("asked = 1").select(F.col("key").alias("asked"), "v", "d", block.alias("block"), every)
    queries = queries.select("asked", "v", "block", named(F.col("s")).alias("shard"))
    length = F.split_part("shard", F.lit("/"), F.lit(1)).cast("int")
    copies = index.withColumn("d", length).join(F.broadcast(size.select("d", "blocks")), "d")
    copies = copies.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("d", "blocks")
    found = saved(_search(copies, queries, k + 1), "found")

    found = _best(found, ["rep", "key"], k + 1).join(classes.select("key", "members"), "key")
    found = _best(found.select("asked", "score", F.explode("members").alias("vec_id")).distinct(), ["vec_id"], k + 1)
    lists = found.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))  # k + 1 at most
    who = use.where(asked).select(F.col("key").alias("asked"), F.col("vec_id").alias("query_id")).distinct()
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = who.join(lists, "asked").select("query_id", F.posexplode(near).alias("at", "x"))
    return out.select(F.col("query_id").cast("long"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").cast("long").alias("vec_id"), F.col("x.score").alias("score"))


def _classes(use: DataFrame, asked: Column, k: int) -> DataFrame:
    """key, rep (smallest id), v, asked (1: some row is a query), members (the k + 1 smallest ids)."""
    order = Window.partitionBy("key").orderBy("vec_id")
    few = use.select("key", "vec_id").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    members = few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    one = use.groupBy("key").agg(F.min("vec_id").alias("rep"), F.first("v").alias("v"), F.max(asked.cast("int")).alias("asked"))
    return one.join(members, "key")


def _best(found: DataFrame, ties: list[str], k: int) -> DataFrame:
    """The first k rows (n: 1 to k) of each ``asked`` by score, then by the columns ``ties``."""
    order = Window.partitionBy("asked").orderBy(F.desc("score"), *ties)
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
