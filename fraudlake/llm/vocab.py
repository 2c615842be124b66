"""Public byte-level BPE vocabulary files, and cutting flat texts into their pre-tokens.

The pre-token pattern is a finite-state machine over classes of code points. Its state maps
over chunks of text are composed by a parallel prefix scan, so a batch of texts of any lengths
is cut in a fixed number of numpy steps per chunk length plus the logarithm of the chunks.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

from . import flat

# Fixed values of the pattern: the contractions that are pre-tokens of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
CHUNK = 64

# Symbols: letter, number, other, contraction of one or two letters, white space: last before
# other text (a space, another), or not last. Plus FIRST: first of its text. PAD: no symbol.
L, N, P, A1, A2, SPACE, LAST, MORE = range(8)
FIRST, PAD = 8, 16
# States: between pre-tokens; in letters, numbers, other; after a space; in white space; one or
# two letters of a contraction to come.
END, IN_L, IN_N, IN_P, AFTER, IN_W, ONE, TWO = range(8)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token starts, by [symbol, state]."""
    to, cut = np.zeros((PAD + 1, 8), np.int8), np.zeros((PAD + 1, 8), np.int8)
    for state in range(8):
        for symbol in range(8):
            if state in (ONE, TWO):
                nxt, new = state - 1 if state == TWO else END, 0
            elif symbol in (L, N, P) or symbol in (A1, A2) and state in (IN_P, AFTER):
                nxt = {L: IN_L, N: IN_N}.get(symbol, IN_P)
                new = state not in (nxt, AFTER)
            elif symbol in (A1, A2):
                nxt, new = ONE if symbol == A1 else TWO, 1
            elif symbol == MORE:
                nxt, new = IN_W, state != IN_W
            else:
                nxt, new = AFTER if symbol == SPACE else END, 1
            to[symbol, state], cut[symbol, state] = nxt, new
        to[PAD, state] = state
    to[FIRST : 2 * FIRST], cut[FIRST : 2 * FIRST] = to[:8, [END]], cut[:8, [END]]
    return to, cut


TO, CUT = _machine()


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    table = np.full(0x110000, P, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((L, r"\p{L}"), (N, r"\p{N}"), (MORE, r"\s")):
        table[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return table


def _symbols(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``first`` marks those that begin a text."""
    sym = _classes()[cp]
    white = sym == MORE
    n = len(cp)
    ends = np.append(first[1:], True)
    before_text = white & ~ends & ~np.append(white[1:], False)
    sym[before_text] = np.where(cp[before_text] == 32, SPACE, LAST)
    at = np.flatnonzero(cp == 39)
    if len(at):
        padded, stop = np.append(cp, [0, 0]), np.append(first, [True, True])
        one, two = padded[at + 1], padded[at + 2]
        for c in CONTRACTIONS:
            hit = (one == ord(c[1])) & ~stop[at + 1]
            if len(c) == 3:
                hit &= (two == ord(c[2])) & ~stop[at + 2]
            sym[at[hit]] = A1 if len(c) == 2 else A2
    return sym + FIRST * first.astype(np.uint8) if n else sym


def scan(sym: np.ndarray) -> np.ndarray:
    """Flags of the symbols where a pre-token starts."""
    chunks = -(-len(sym) // CHUNK)
    padded = np.full(chunks * CHUNK, PAD, np.uint8)
    padded[: len(sym)] = sym
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    flat_to, flat_cut = TO.ravel(), CUT.ravel()
    # each chunk as a map of states, all eight entry states at once
    maps = np.tile(np.arange(8, dtype=np.int8), (chunks, 1))
    for col in columns:
        maps = flat_to[(col.astype(np.int16) << 3)[:, None] + maps]
    # inclusive prefix scan: map i becomes the composition of maps 0..i
    step = 1
    while step < chunks:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), axis=1)
        step *= 2
    state = np.zeros(chunks, np.int16)
    state[1:] = maps[:-1, END]
    out = np.empty((CHUNK, chunks), np.int8)
    for k, col in enumerate(columns):
        at = (col.astype(np.int16) << 3) + state
        out[k] = flat_cut[at]
        state = flat_to[at].astype(np.int16)
    return out.T.ravel()[: len(sym)].astype(bool)


class Vocabulary:
    """A byte-level BPE of a tokenizers .json file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
        ids = spec["model"]["vocab"]
        self.bytes = {i: bytes(shown[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: content for content, i in self.special.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([ids["".join(m)] for m in merges], np.int64)
        self.size = max(self.bytes) + 1
        order = np.argsort(left * self.size + right, kind="stable")
        #: Sorted pair keys, with each pair's rank; what each rank makes.
        self.keys, self.ranks, self.made = (left * self.size + right)[order], order, made
        self.of_byte = np.array([ids[c] for c, _ in sorted(shown.items(), key=lambda p: p[1])], np.int64)
        self.lengths = np.array([len(self.bytes.get(i, b"")) for i in range(self.size)], np.int64)
        self.flat_bytes = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(self.size)), np.uint8)
        self.byte_offs = np.concatenate([[0], np.cumsum(self.lengths)])


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pretokens(t: flat.Texts, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and special ids (or -1) of the pre-tokens, in order."""
    if not len(t.buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = t.buf.tobytes()
    begins, special = t.offs[:-1], {}
    if vocab.special and any(s in raw for s in vocab.special):
        for m in re.finditer(b"|".join(map(re.escape, vocab.special)), raw):
            if t.owner(np.array([m.start()]))[0] == t.owner(np.array([m.end() - 1]))[0]:
                special[m.start()] = (m.end(), vocab.special[m[0]])
        begins = np.unique(np.concatenate([begins, [*special], [e for e, _ in special.values()]]).astype(np.int64))
    begins = begins[begins < len(raw)]
    cp = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((t.buf & 0xC0) != 0x80)
    first = np.zeros(len(raw), bool)
    first[begins] = True
    starts = lead[scan(_symbols(cp, first[lead]))]
    ends = np.append(starts[1:], len(raw))
    ids = np.full(len(starts), -1)
    if special:
        whole = np.ones(len(starts), bool)
        for a, (b, i) in special.items():
            x, y = np.searchsorted(starts, [a, b])
            whole[x + 1 : y], ends[x], ids[x] = False, b, i
        starts, ends, ids = starts[whole], ends[whole], ids[whole]
    return starts, ends, ids


def distinct(t: flat.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of one pre-token for each distinct string, and each pre-token's number among them."""
    import pandas as pd

    code, _ = pd.factorize(flat.hash_spans(t.buf, starts, ends))
    one = np.zeros(code.max() + 1 if len(code) else 0, np.int64)
    one[code[::-1]] = np.arange(len(code))[::-1]
    return one, code


def spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans one after another, and the place where each begins."""
    first = np.cumsum(lengths) - lengths
    return buf[np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)], first
