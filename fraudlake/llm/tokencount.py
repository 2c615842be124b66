"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers run one after the other. The first cuts texts into pre-tokens
(``vocab.scan``: chunk state maps composed by a parallel prefix scan). The second reads a
pre-token byte by byte, and each of its transitions carries the change in the number of tokens
of what was read so far.

A state of the second is all that can still matter: for every place where a further token
could have begun, the vocabulary's trie node reached since, the last token before that place,
and the number of tokens up to it against the number now. A token may end a prefix only if it
and the token before it stay apart when encoded together, which holds for exactly one of the
candidates. Transitions are compiled when a text first needs them and kept per worker; all
distinct pre-tokens of a slice then step through the table together, one byte a step. Beyond
``STATES`` states the table is compiled anew, which bounds memory and changes no count.

Defined results: null and empty texts have 0 bytes and tokens; a special token's text counts as
one token; texts are taken whole; a null id is returned as it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import id_type
from .vocab import Vocabulary, distinct, pretokens, vocabulary

STATES = 200_000
#: Pairs of tokens remembered as staying apart, before they are forgotten and found anew.
PAIRS = 1 << 20
ROOT = 0


class Transducer:
    def __init__(self, vocab: Vocabulary):
        self.rank = dict(zip(vocab.keys.tolist(), vocab.ranks.tolist()))
        self.made, self.size, self.of_byte = vocab.made.tolist(), vocab.size, vocab.of_byte.tolist()
        self.bytes = vocab.bytes
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner = [True]
        for i, data in vocab.bytes.items():
            if i in vocab.special.values():
                continue
            node = ROOT
            for b in data:
                self.inner[node] = True
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token[node] = i
        self.apart: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((ROOT, -1, 0),)
        self.states, self.number = [start], {start: 0}
        self.column = np.full(256, -1, np.int64)
        self.columns = 0
        self.to, self.more = np.full((1024, 32), -1, np.int32), np.zeros((1024, 32), np.int8)

    def merged(self, data: bytes) -> list[int]:
        ids = [self.of_byte[b] for b in data]
        while len(ids) > 1:
            ranks = [self.rank.get(a * self.size + b, -1) for a, b in zip(ids, ids[1:])]
            known = [r for r in ranks if r >= 0]
            if not known:
                break
            i = ranks.index(min(known))
            ids[i : i + 2] = [self.made[ranks[i]]]
        return ids

    def stays_apart(self, a: int, b: int) -> bool:
        key = a * self.size + b
        if key not in self.apart:
            if len(self.apart) >= PAIRS:
                self.apart.clear()
            self.apart[key] = key not in self.rank and self.merged(self.bytes[a] + self.bytes[b]) == [a, b]
        return self.apart[key]

    def compile(self, state: int, byte: int) -> None:
        going, ended = [], None
        for node, last, behind in self.states[state]:
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            t = self.token[nxt]
            if ended is None and t >= 0 and (last < 0 or self.stays_apart(last, t)):
                ended = (t, behind + 1)
            if self.inner[nxt]:
                going.append((nxt, last, behind))
        t, change = ended
        key = tuple((n, last, behind - change) for n, last, behind in going) + ((ROOT, t, 0),)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        if to >= len(self.to):
            self.to = np.concatenate([self.to, np.full_like(self.to, -1)])
            self.more = np.concatenate([self.more, np.zeros_like(self.more)])
        self.to[state, self.column[byte]] = to
        self.more[state, self.column[byte]] = change

    def _columns(self, data: np.ndarray) -> None:
        for b in np.unique(data):
            if self.column[b] < 0:
                self.column[b] = self.columns
                self.columns += 1
        while self.columns > self.to.shape[1]:
            self.to = np.concatenate([self.to, np.full_like(self.to, -1)], axis=1)
            self.more = np.concatenate([self.more, np.zeros_like(self.more)], axis=1)

    def count(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each byte span; all spans take one byte a step."""
        if len(self.states) > STATES:
            self.reset()
        self._columns(buf)
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those at work are a prefix
        starts, length = starts[order], (ends - starts)[order]
        state, total = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if len(length):
            working = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
        for k in range(int(length[0]) if len(length) else 0):
            n = working[k]
            byte = buf[starts[:n] + k]
            now, col = state[:n], self.column[byte]
            nxt = self.to[now, col]
            new = np.flatnonzero(nxt < 0)
            if len(new):
                for pair in np.unique(now[new] << 8 | byte[new]).tolist():
                    self.compile(pair >> 8, pair & 255)
                nxt = self.to[now, col]
            total[:n] += self.more[now, col]
            state[:n] = nxt
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


_compiled: dict[str, Transducer] = {}


def count_texts(t: flat.Texts, path: str) -> np.ndarray:
    vocab = vocabulary(path)
    if path not in _compiled:
        _compiled[path] = Transducer(vocab)
    starts, ends, special = pretokens(t, vocab)
    if not len(starts):
        return np.zeros(t.n, np.int64)
    one, code = distinct(t, starts, ends)
    each = _compiled[path].count(t.buf, starts[one], ends[one])[code]
    each[special >= 0] = 1
    return np.bincount(t.owner(starts), each, t.n).astype(np.int64)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        return {"doc_id": own[0], "n_bytes": np.diff(t.offs), "n_tokens": count_texts(t, path)}

    rows = flat.map_texts(docs, run, f"doc_id {id_type(docs)}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
