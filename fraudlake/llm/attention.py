"""Language-model scores by a causal self-attention model trained in numpy.

A word's subword id is its beginning (three bytes, and whether more follow) if that is one of
the ``PIECES`` most frequent in training, else one shared id; the end of a text has its own.
The model gives P(subword id | ids before); a word then has its share of the counts of its id:
(c + 1) / (words + distinct words + 1). Counts come from all training texts. The model's
weights come from all training texts too: their windows are written once, in rows of at most
``SPAN`` blocks, which are dealt to slots by a hash of the row, a slot for each ``SLOT_WINDOWS``
windows of the whole table, and ordered there by that hash. In each of ``ROUNDS`` rounds every slot
trains from common weights on all its windows; the slots' weights are then averaged. A small table is
passed as often in a round as makes ``STEPS`` steps of all its windows. So the weights depend on
the training rows alone, not on how Spark has dealt them to tasks.

Scoring: a text is cut into blocks of ``BLOCK`` tokens. A block's window is the block and the
one before it, so windows overlap by half, each token is scored once, and it sees 16 to 31 ids
before it (fewer at the start). All windows of a slice go through the model in batches.

Counts of frequent words are sent to the tasks: a word with at least 1 / ``FREQUENT`` of all
training tokens, of which there can't be more than ``FREQUENT``. The other words of each text
are written beside its score, so that texts are cut into words once for both, and joined with
their counts on Spark; none of them is in more than that share of the tokens.

Defined results: null and empty texts have one token, their end; without training texts counts
are 0 and the model is uniform over ids; rows without an id are training rows; repeated rows
train and are scored each (equal rows of one id train in one slot).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import bucket_of, id_type, saved

PIECES = 126
END, OTHER, START, PAD = 0, 1, PIECES + 2, PIECES + 3
IDS = PIECES + 2
WIDTH, HIDDEN, BLOCK = 16, 32, 16
ROUNDS, STEPS, BATCH = 3, 300, 128
SLOT_WINDOWS, SPAN = 1 << 16, 512
#: Exponents up to RANGE are taken as they are, larger ones from their maximum; places whose output scores are held at once.
RANGE, ROWS = 40, 512
FREQUENT = 1 << 20
_CELLS = np.arange((PAD + 1) * WIDTH).reshape(PAD + 1, WIDTH)
#: Parts in which the slots' weights are summed before they reach the driver.
PARTS = 16


def words_of(t: flat.Texts, hashed: bool = True) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """Hash (if asked for), beginning and text index of the lower-cased words."""
    t = flat.Texts(np.take(flat.LOWER, t.buf), t.offs)
    starts, ends = t.runs((t.buf != 0x20) & (t.buf - np.uint8(0x09) > 4))  # bytes below 0x09 wrap round
    doc = np.repeat(np.arange(t.n), np.diff(np.searchsorted(starts, t.offs)))
    padded, length = np.append(t.buf, np.zeros(2, np.uint8)), ends - starts
    piece = padded[starts].astype(np.int64) << 16
    piece |= (padded[starts + 1] * (length > 1)).astype(np.int64) << 8
    piece |= padded[starts + 2] * (length > 2)
    piece |= (length > 3).astype(np.int64) << 24
    return flat.hash_spans(t.buf, starts, ends) if hashed else None, piece, doc


def word_counts(rows: DataFrame) -> DataFrame:
    """h, piece, c: the training texts' words and their counts."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        h, piece, _ = words_of(t)
        order = np.argsort(h)
        first = np.flatnonzero(np.append(True, np.diff(h[order]) != 0)) if len(h) else np.zeros(0, np.int64)
        c = np.diff(np.append(first, len(h)))
        return {"h": h[order][first].view(np.int64), "piece": piece[order][first].astype(np.int32), "c": c}

    parts = flat.map_texts(rows, run, "h long, piece int, c long", carry=())
    return parts.groupBy("h", "piece").agg(F.sum("c").alias("c"))


class Model:
    """One block of causal self-attention over subword ids; ``p`` maps names to weights."""

    def __init__(self, unigram: np.ndarray, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(8)
        d = WIDTH
        shapes = {"emb": (PAD + 1, d), "q": (d, d), "k": (d, d), "v": (d, d), "o": (d, d), "near": (2 * BLOCK,), "w1": (d, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, IDS)}
        self.p = weights or {n: (rng.normal(0, s[0] ** -0.5 if len(s) > 1 and n != "emb" else 0.3, s) if n not in ("near", "b1", "w2") else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}
        if weights is None:
            self.p["b2"] = np.log(unigram).astype(np.float32)
        i, j = np.arange(BLOCK)[:, None], np.arange(2 * BLOCK)[None, :]
        self.gap = i + BLOCK - j  # how far a key lies before its query
        self.ahead = self.gap < 0
        self.back = np.maximum(self.gap, 0)
        self.room: dict[str, np.ndarray] = {}

    def _held(self, name: str, *shape: int, kind: type | None = None) -> np.ndarray:
        """An array to write to, the same in every call, so that no batch has to get its memory anew."""
        kind, size = kind or self.p["w2"].dtype, math.prod(shape)
        if name not in self.room or self.room[name].dtype != kind or self.room[name].size < size:
            self.room[name] = np.empty(size, kind)
        return self.room[name][:size].reshape(shape)

    def tables(self) -> dict[str, np.ndarray]:
        """By id: queries, keys, values, what each id as a query gives each as a key, and what an attended id adds.

        Inputs are embeddings alone and places count by their distance only, so all of these are
        functions of ids, and windows look them up. ``pair`` and ``near`` are exponentials, 0 for what
        isn't seen, if these can't vanish for all keys of a query (not ``deep``).
        """
        p = self.p
        q, k, v = p["emb"] @ p["q"] * np.float32(WIDTH**-0.5), p["emb"] @ p["k"], p["emb"] @ p["v"]
        pair = q @ k.T
        pair -= pair[:, :PAD].max(1, keepdims=True)
        near = p["near"] - p["near"].max()
        deep = pair[:, :PAD].min() + near.min() < -RANGE
        near, none = near[self.back], -1e9
        if not deep:
            pair, near, none = np.exp(pair), np.exp(near), 0
        pair[:, PAD] = none
        near[self.ahead] = none
        return {"q": q, "k": k, "v": v, "pair": pair, "near": near, "adds": v @ p["o"], "deep": deep}

    def forward(self, ids: np.ndarray, tables: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
        """ids: [window, 2 * BLOCK] inputs; what the last BLOCK attend to, before it is divided by its
        sum ``whole``, what that gives them, and the hidden layer after them. ``tables``: those of the present weights."""
        p, t = self.p, tables or self.tables()
        ids = ids.astype(np.intp)
        n, now = len(ids), ids[:, BLOCK:]
        at = np.add((now * (PAD + 1))[:, :, None], ids[:, None, :], out=self._held("at", n, BLOCK, 2 * BLOCK, kind=np.intp))
        a = np.take(t["pair"].ravel(), at, out=self._held("a", n, BLOCK, 2 * BLOCK), mode="clip")
        if t["deep"]:
            a += t["near"]
            a -= a.max(2, keepdims=True)
            np.exp(a, out=a)
        else:
            a *= t["near"]
        whole = (a.reshape(-1, 2 * BLOCK) @ np.ones(2 * BLOCK, a.dtype)).reshape(n, BLOCK, 1)
        x = np.take(t["adds"], ids, axis=0, out=self._held("x", n, 2 * BLOCK, WIDTH), mode="clip")
        mixed = np.matmul(a, x, out=self._held("mixed", n, BLOCK, WIDTH))
        mixed /= whole
        h = np.take(p["emb"], now, axis=0)
        h += mixed
        h = h.reshape(-1, WIDTH)
        z = h @ p["w1"]
        z += p["b1"]
        np.tanh(z, out=z)
        return t | {"ids": ids, "at": at, "a": a, "whole": whole, "x": x, "mixed": mixed, "h": h, "z": z}

    def _bias(self) -> np.ndarray | None:
        """Exponentials of the last bias, if these and those of the rest can't leave the range; z lies within 1 of 0."""
        if (np.abs(self.p["w2"]).sum(0) + np.abs(self.p["b2"])).max() > RANGE:
            return None
        return np.exp(self.p["b2"])

    def _scores(self, z: np.ndarray, bias: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """y and factor: the probability of id j is in proportion to exp(y[:, j]) * factor[j]."""
        y = np.matmul(z, self.p["w2"], out=self._held("y", len(z), IDS))
        if bias is not None:
            return y, bias
        y += self.p["b2"]
        y -= y.max(1, keepdims=True)
        return y, np.ones(IDS, y.dtype)

    def log_prob(self, ids: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probabilities of the targets, which follow the last BLOCK inputs."""
        out, bias, tables = np.empty(target.size, self.p["w2"].dtype), self._bias(), self.tables()
        for i in range(0, len(ids), BATCH):
            z, first = self.forward(ids[i : i + BATCH], tables)["z"], i * BLOCK
            for j in range(0, len(z), ROWS):
                y, factor = self._scores(z[j : j + ROWS], bias)
                part = slice(first + j, first + j + len(y))
                to = target.reshape(-1)[part]
                hit = y[np.arange(len(y)), to] + np.log(factor)[to]
                out[part] = hit - np.log(np.exp(y, out=y) @ factor)
        return out.reshape(target.shape)

    def gradients(self, ids: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over targets that aren't PAD."""
        p, f = self.p, self.forward(ids)
        z, kind = f["z"], p["w2"].dtype
        target = target.ravel().astype(np.intp)
        share = (target != PAD) / np.array(max((target != PAD).sum(), 1), kind)
        target = np.minimum(target, IDS - 1)
        g = {"w2": np.zeros((HIDDEN, IDS), kind), "b2": np.zeros(IDS, kind)}
        dz, bias = np.empty_like(z), self._bias()
        for i in range(0, len(z), ROWS):
            part = slice(i, i + ROWS)
            e, factor = self._scores(z[part], bias)
            total = np.exp(e, out=e) @ factor
            to = target[part]
            e.reshape(-1)[np.arange(0, e.size, IDS) + to] -= total / factor[to]
            by = (share[part] / total)[:, None]
            # the loss changes with scores by e * factor * by
            g["w2"] += (z[part] * by).T @ e
            g["b2"] += by[:, 0] @ e
            np.multiply(e @ (p["w2"] * factor).T, by, out=dz[part])
        g["w2"] *= factor
        g["b2"] *= factor
        z *= z
        dz *= np.subtract(1, z, out=z)
        g |= {"w1": f["h"].T @ dz, "b1": np.ones(len(dz), kind) @ dz}
        dh = (dz @ p["w1"].T).reshape(f["mixed"].shape)
        own = _by_id(f["ids"][:, BLOCK:], dh)
        dh /= f["whole"]
        dx = np.matmul(f["a"].transpose(0, 2, 1), dh, out=self._held("dx", *f["x"].shape))
        ds = np.matmul(dh, f["x"].transpose(0, 2, 1), out=self._held("ds", *f["a"].shape))
        ds -= np.einsum("nid,nid->ni", dh, f["mixed"])[:, :, None]
        ds *= f["a"]
        g["near"] = np.bincount(self.back.ravel(), np.where(self.ahead, 0, ds.sum(0)).ravel(), 2 * BLOCK)
        # back from what windows looked up to the tables, and from these to the weights
        pair = np.bincount(f["at"].ravel(), ds.ravel(), (PAD + 1) ** 2).reshape(PAD + 1, PAD + 1).astype(kind)
        adds = _by_id(f["ids"], dx)
        dq, dk, dv = pair @ f["k"] * np.float32(WIDTH**-0.5), pair.T @ f["q"], adds @ p["o"].T
        g |= {"q": p["emb"].T @ dq, "k": p["emb"].T @ dk, "v": p["emb"].T @ dv, "o": f["v"].T @ adds}
        g["emb"] = own + dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T
        return {n: g[n].astype(np.float32) for n in p}

    def train(self, chunks: Iterable[np.ndarray], rate: float, seed: int, passes: int = 1) -> int:
        """Adam over batches of windows ([prev, now, target] ids in a row); how many windows there were.

        A pass takes each window once, in an order shuffled by chunk. ``passes`` above 1 hold all windows.
        """
        rng = np.random.default_rng(seed)
        state = self._joined()
        rows, i = 0, 0
        if passes > 1:
            chunks = list(chunks)
        for turn in range(passes):
            for chunk in chunks:
                rows += len(chunk) if turn == 0 else 0
                order = rng.permutation(len(chunk))
                for at in range(0, len(chunk), BATCH):
                    i += 1
                    self._step(chunk[order[at : at + BATCH]], state, i, rate)
        return rows

    def _joined(self) -> list[np.ndarray]:
        """All weights as one array, of which ``p`` becomes views, and Adam's two means."""
        whole = np.concatenate([x.ravel() for x in self.p.values()])
        cut = np.cumsum([0] + [x.size for x in self.p.values()])
        self.p = {n: whole[a:b].reshape(x.shape) for (n, x), a, b in zip(self.p.items(), cut, cut[1:])}
        return [whole, np.zeros_like(whole), np.zeros_like(whole)]

    def _step(self, rows: np.ndarray, state: list[np.ndarray], i: int, rate: float) -> None:
        whole, m, s = state
        g = np.concatenate([x.ravel() for x in self.gradients(rows[:, : 2 * BLOCK], rows[:, 2 * BLOCK :]).values()])
        m[:] = 0.9 * m + 0.1 * g
        s[:] = 0.99 * s + 0.01 * g * g
        whole -= (rate * (m / (1 - 0.9**i)) / (np.sqrt(s / (1 - 0.99**i)) + 1e-8)).astype(np.float32)


def _by_id(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sums of x [..., WIDTH] over the places of each id."""
    at = np.take(_CELLS, ids.ravel(), axis=0)
    return np.bincount(at.ravel(), x.ravel(), _CELLS.size).reshape(_CELLS.shape).astype(x.dtype)


def blocks(t: flat.Texts, pieces: np.ndarray, ids: np.ndarray, hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Windows [prev, now] and targets per block, the text of each, and (hash, id, text) of the words."""
    h, piece, doc = words_of(t, hashed)
    at = np.minimum(np.searchsorted(pieces, piece), max(len(pieces) - 1, 0))
    word_id = np.where(pieces[at] == piece, ids[at], OTHER) if len(pieces) else np.full(len(piece), OTHER)
    n = np.bincount(doc, minlength=t.n) + 1
    count = -(-n // BLOCK)
    first = np.cumsum(count) - count
    target = np.full(int(count.sum()) * BLOCK, PAD, np.int16)
    begin = np.cumsum(n - 1) - (n - 1)
    target[first[doc] * BLOCK + np.arange(len(doc)) - begin[doc]] = word_id
    target[first * BLOCK + n - 1] = END
    now = np.append(np.int16(START), target[:-1])
    now[first * BLOCK] = START
    now, target = now.reshape(-1, BLOCK), target.reshape(-1, BLOCK)
    prev = np.concatenate([np.full((1, BLOCK), PAD, np.int16), now[:-1]])
    prev[first] = PAD
    return np.concatenate([prev, now], axis=1), target, np.repeat(np.arange(t.n), count), (h, word_id, doc)


def training_rows(texts: DataFrame, pieces: np.ndarray, ids: np.ndarray) -> DataFrame:
    """key, at, n, windows: [prev, now, target] of every block of the texts, at most SPAN blocks in a row."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        window, target, doc, _ = blocks(t, pieces, ids, hashed=False)
        rows = np.concatenate([window, target], axis=1).astype(np.uint8)
        first = np.searchsorted(doc, np.arange(t.n + 1))
        cut = [(i, k, a, min(a + SPAN, first[i + 1])) for i in range(t.n) for k, a in enumerate(range(first[i], first[i + 1], SPAN))]
        key = own[0].to_numpy(zero_copy_only=False)
        return {
            "key": key[[c[0] for c in cut]], "at": np.array([c[1] for c in cut], np.int32), "n": np.array([c[3] - c[2] for c in cut], np.int64),
            "windows": pa.array([rows[a:b].tobytes() for _, _, a, b in cut], pa.binary()),
        }

    return flat.map_texts(texts, run, "key long, at int, n long, windows binary", carry=("key",))


def chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The rows' windows, some thousands at a time; where they are cut depends on the rows alone."""
    held, size = [], 0
    for b in batches:
        for blob in b.column("windows"):
            held.append(np.frombuffer(blob.as_buffer(), np.uint8).reshape(-1, 3 * BLOCK))
            size += len(held[-1])
            if size >= 8192:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def dealt(rows: DataFrame, slots: int) -> DataFrame:
    """The rows' windows in a partition for each slot, ordered there; a function of the rows alone."""
    slot = F.pmod(F.xxhash64("key", "at"), F.lit(slots)).cast("int")
    return rows.repartitionById(slots, slot).sortWithinPartitions(F.xxhash64("at", "key"), "key", "at").select("windows")


def _average(slots_rows: DataFrame, slots: int, passes: int, model: Model, turn: int) -> Model:
    """One round: each slot trains on all its windows from the common weights; their weighted mean."""
    names, shapes = list(model.p), [x.shape for x in model.p.values()]
    start = np.concatenate([x.ravel() for x in model.p.values()])
    size = len(start)

    def load(flat_weights: np.ndarray) -> dict[str, np.ndarray]:
        cut = np.cumsum([0] + [int(np.prod(s)) for s in shapes])
        return {n: flat_weights[a:b].reshape(s).copy() for n, s, a, b in zip(names, shapes, cut, cut[1:])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(None, load(start))
        n = own.train(chunked(batches), 0.01 / (1 + turn), turn, passes)
        if n:
            out = np.concatenate([x.ravel() for x in own.p.values()]).astype(np.float64) * n
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()]), pa.array([n])], ["w", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size), 0
        for b in batches:
            for w, n in zip(b.column("w").to_pylist(), b.column("n").to_pylist()):
                total, rows = total + np.frombuffer(w), rows + n
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([rows])], ["w", "n"])

    parts = slots_rows.mapInArrow(run, "w binary, n long")
    if slots > PARTS:
        parts = parts.repartition(PARTS).mapInArrow(add, "w binary, n long")
    parts = parts.collect()
    if not parts:
        return model
    parts.sort(key=lambda r: (r.n, bytes(r.w)))  # so that the sum doesn't depend on which part came first
    mean = sum(np.frombuffer(r.w) for r in parts) / sum(r.n for r in parts)
    return Model(None, load(mean.astype(np.float32)))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(bucket_of("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", F.col("text").isNull(), "text"))
    training = rows.where(~F.col("held_out"))
    counts = saved(word_counts(training), "word_counts")
    ends = training.count()
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = whole.n + ends, whole.v + (ends > 0)

    by_piece = saved(counts.groupBy("piece").agg(F.sum("c").alias("n"), F.count("*").alias("v")), "pieces")
    top = by_piece.orderBy(F.desc("n"), "piece").limit(PIECES).collect()  # the vocabulary's size
    pieces = np.array(sorted(r.piece for r in top), np.int64)
    where = {r.piece: r for r in top}
    ids = np.arange(len(pieces)) + 2
    words, kinds = np.zeros(IDS), np.zeros(IDS)
    words[END], kinds[END] = ends, ends > 0
    for i, piece in zip(ids, pieces):
        words[i], kinds[i] = where[piece].n, where[piece].v
    words[OTHER], kinds[OTHER] = whole.n - words[2:].sum(), whole.v - kinds[2:].sum()
    within = np.log10(words + kinds + 1)

    model = Model((words + 1) / (words + 1).sum())
    windows = saved(training_rows(training.select("key", "text"), pieces, ids), "lm_windows")
    n_windows = windows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots, passes = max(1, -(-n_windows // SLOT_WINDOWS)), max(1, -(-STEPS * BATCH // max(n_windows, 1)))
    windows = dealt(windows, slots).persist(StorageLevel.DISK_ONLY)  # shuffled and ordered once for all rounds
    for turn in range(ROUNDS):
        model = _average(windows, slots, passes, model, turn)
    windows.unpersist()

    often = counts.where(F.col("c") * FREQUENT >= n_all).select("h", "c").toPandas()  # FREQUENT rows at most
    often = often.sort_values("h", kind="stable")
    often = spark.sparkContext.broadcast((often["h"].to_numpy(np.int64), often["c"].to_numpy(np.int64)))

    def known(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, c = often.value
        if not len(keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(keys, h.view(np.int64)), len(keys) - 1)
        hit = keys[at] == h.view(np.int64)
        return hit, np.where(hit, c[at], 0)

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        window, target, doc, (h, word_id, word_doc) = blocks(t, pieces, ids)
        hit, c = known(h)
        logs = np.log10(c + 1.0)
        total = np.bincount(word_doc, logs - within[word_id], t.n) + np.log10(ends + 1.0) - within[END]
        for i in range(0, len(window), 1024):
            lp = model.log_prob(window[i : i + 1024], np.minimum(target[i : i + 1024], IDS - 1))
            total += np.bincount(doc[i : i + 1024], np.where(target[i : i + 1024] == PAD, 0, lp).sum(1, dtype=np.float64), t.n) / np.log(10)
        return {
            "doc_id": own[0], "held_out": own[1], "key": own[2], "n_tokens": np.bincount(word_doc, minlength=t.n) + 1,
            "seen": np.bincount(word_doc[hit], minlength=t.n) + int(ends > 0), "logs": np.bincount(word_doc, logs, t.n) + np.log10(ends + 1.0), "total": total,
            "rare": pa.ListArray.from_arrays(np.searchsorted(word_doc[~hit], np.arange(t.n + 1)).astype(np.int32), pa.array(h[~hit].view(np.int64))),
        }

    kind = id_type(docs)
    main = flat.map_texts(rows, run, f"doc_id {kind}, held_out boolean, key long, n_tokens long, seen long, logs double, total double, rare array<long>", carry=("doc_id", "held_out", "key"))
    main = saved(main, "lm_rows")
    pairs = main.select("key", F.explode("rare").alias("h"))
    few = counts.where(F.col("c") * FREQUENT < n_all).select("h", "c")
    more = pairs.join(few, "h").groupBy("key").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("l"), F.count("*").alias("k"))
    more = more.join(main.groupBy("key").agg(F.count("*").alias("r")), "key")  # equal rows share a key
    more = more.select("key", (F.col("l") / F.col("r")).alias("l"), (F.col("k") / F.col("r")).cast("long").alias("k"))
    out = main.join(more, "key", "left").withColumn("l", F.coalesce("l", F.lit(0.0)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("l") - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"), (F.col("total") + F.col("l")).alias("score"),
    )
