"""The attention scores read each text, deal the windows and make a model's tables as few times as they need."""
import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from fraudlake.llm import attention, flat

N = attention.IDS


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())  # bytes.lower changes A-Z only


def test_words_and_beginnings_of_every_byte():
    rng = random.Random(5)
    texts = ["", None, " \t", "Ab ABC aBcD", "é ß x", "\x08 \x0e\x1f\x00 \x0d\x0ca"] + ["".join(chr(rng.randrange(256)) for _ in range(rng.randrange(40))) for _ in range(500)] + [None]
    t = next(flat.slices(pa.array(texts)))[2]
    h, piece, doc = attention.words_of(t)
    want = [(w, i) for i, x in enumerate(texts) for w in split(x)]
    code = [w[0] << 16 | (w + b"\0")[1] << 8 | (w + b"\0\0")[2] | (len(w) > 3) << 24 for w, _ in want]
    assert piece.tolist() == code and doc.tolist() == [i for _, i in want]
    assert len(set(zip(h.tolist(), (w for w, _ in want)))) == len(set(h.tolist())) == len({w for w, _ in want})
    none, same, _ = attention.words_of(t, hashed=False)
    assert none is None and same.tolist() == code


def test_tables_of_a_model_are_made_once_for_all_batches(monkeypatch):
    made, tables = [], attention.Model.tables
    monkeypatch.setattr(attention.Model, "tables", lambda self: made.append(1) or tables(self))
    rng = np.random.default_rng(3)
    ids, target = rng.integers(0, N, (5 * attention.BATCH, 2 * attention.BLOCK)), rng.integers(0, N, (5 * attention.BATCH, attention.BLOCK))
    m = attention.Model(np.full(N, 1 / N))
    whole = m.log_prob(ids, target)
    assert len(made) == 1
    parts = [m.log_prob(ids[i : i + attention.BATCH], target[i : i + attention.BATCH]) for i in range(0, len(ids), attention.BATCH)]
    assert np.array_equal(whole, np.concatenate(parts))


def test_texts_are_cut_three_times_and_windows_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(attention, "FREQUENT", 20)  # nearly all words are joined
    monkeypatch.setattr(attention, "STEPS", 3)
    calls = collections.Counter()
    frame = type(spark.range(1))
    map_texts, ordered = flat.map_texts, frame.sortWithinPartitions
    monkeypatch.setattr(flat, "map_texts", lambda *a, **k: calls.update(["texts"]) or map_texts(*a, **k))
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda *a, **k: calls.update(["dealt"]) or ordered(*a, **k))
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("kalo miru Sato nemi grolf".split()) + str(rng.randrange(30)) for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += rows[:9] + [(None, "kalo1 kalo1 odd"), (None, None), (500, None), (501, ""), (501, ""), (7, "another text of one id")]
    out = attention.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert calls == {"texts": 3, "dealt": 1}

    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for (_, t), out_of in zip(rows, held) if not out_of for w in [*split(t), None])
    n, v = sum(c.values()), len(c)
    want = []
    for (i, t), out_of in zip(rows, held):
        w = [*split(t), None]
        want.append((i, out_of, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert collections.Counter(want) == collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
