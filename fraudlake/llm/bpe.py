"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. In a round, each word's pair of
lowest rank is found by binary search over the sorted pair keys, and all its places in the word
are merged, leftmost first; words without a known pair drop out. Ids are spread back over the
texts. Decoding gathers the tokens' bytes in one step.

Defined results: null and empty texts have no tokens; a special token's text becomes its one
id, as the library does by default; texts are taken whole, without truncation or padding.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import flat
from .store import id_type
from .vocab import Vocabulary, distinct, pretokens, spans, vocabulary


def merge_words(symbols: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of words given by their byte symbols, and the number of each word's tokens."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_ids, done_words = [], []
    while len(symbols):
        key = symbols[:-1] * vocab.size + symbols[1:]
        at = np.minimum(np.searchsorted(vocab.keys, key), len(vocab.keys) - 1)
        known = (vocab.keys[at] == key) & (word[:-1] == word[1:])
        rank = np.full(len(symbols), len(vocab.ranks))
        rank[:-1][known] = vocab.ranks[at[known]]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(first, len(word)))
        least = np.minimum.reduceat(rank, first)
        more = np.repeat(least < len(vocab.ranks), size)
        done_ids.append(symbols[~more])
        done_words.append(word[~more])
        hit = (rank == np.repeat(least, size)) & more
        # of pairs that overlap (a run of one symbol), every other one from the left
        places = np.flatnonzero(hit)
        if len(places):
            run = np.cumsum(np.append(True, np.diff(places) != 1)) - 1
            start = places[np.append(True, np.diff(run) != 0)]
            hit[places[(places - start[run]) % 2 == 1]] = False
        symbols[hit] = vocab.made[rank[hit]]
        more[1:] &= ~hit[:-1]
        symbols, word = symbols[more], word[more]
    if not done_ids:
        return symbols, np.zeros(len(lengths), np.int64)
    ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
    return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


def encode_texts(t: flat.Texts, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in order, and offsets of each text's ids."""
    starts, ends, special = pretokens(t, vocab)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(t.n + 1, np.int64)
    one, code = distinct(t, starts, ends)
    length = ends[one] - starts[one]
    data, _ = spans(t.buf, starts[one], length)
    ids, count = merge_words(vocab.of_byte[data], length, vocab)
    first = np.cumsum(count) - count
    out, begin = spans(ids, first[code], count[code])
    total = count[code]
    for i in np.flatnonzero(special >= 0)[::-1]:  # few: their strings are rare in texts
        out = np.concatenate([out[: begin[i]], [special[i]], out[begin[i] + total[i] :]])
        total[i] = 1
    offs = np.zeros(t.n + 1, np.int64)
    np.cumsum(np.bincount(t.owner(starts), total, t.n).astype(np.int64), out=offs[1:])
    return out, offs


def decode_ids(ids: np.ndarray, offs: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the tokens one after another, and offsets of each text's bytes."""
    length = vocab.lengths[ids]
    data, _ = spans(vocab.flat_bytes, vocab.byte_offs[ids], length)
    total = np.concatenate([[0], np.cumsum(length)])
    return data, total[offs]


def _sha(data: memoryview, offs: np.ndarray) -> list[str]:
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offs, offs[1:])]


def _text_sha(data: np.ndarray, offs: np.ndarray) -> list[str]:
    raw = data.tobytes()
    parts = [raw[a:b] for a, b in zip(offs, offs[1:])]
    return [hashlib.sha256(p.decode("utf-8", "replace").encode()).hexdigest() for p in parts]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (list of int) and the decoded text of every row."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        vocab = vocabulary(path)
        ids, offs = encode_texts(t, vocab)
        data, cut = decode_ids(ids, offs, vocab)
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]
        lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return {"doc_id": own[0], "ids": lists, "decoded": pa.array(texts, pa.string())}

    return flat.map_texts(docs, run, f"doc_id {id_type(docs)}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the ids (little-endian uint32) and of the decoded text."""

    def run(own: list[pa.Array], t: flat.Texts) -> dict:
        vocab = vocabulary(path)
        ids, offs = encode_texts(t, vocab)
        data, cut = decode_ids(ids, offs, vocab)
        return {
            "doc_id": own[0], "n_tokens": np.diff(offs),
            "ids_sha256": _sha(memoryview(ids.astype("<u4").tobytes()), 4 * offs), "decoded_sha256": _text_sha(data, cut),
        }

    return flat.map_texts(docs, run, f"doc_id {id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
