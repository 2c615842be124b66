"""Importance resampling against a plain sort."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from fraudlake.llm import flat, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, target, percent=10):
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for x in texts:
            for w in words(x):
                counts[zlib.crc32(w.encode()) % 10000] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        w = words(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 10000] for x in w) // len(w) if w else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    can = sorted((-r[3], r[0] is None, r[0] or 0, i) for i, r in enumerate(rows) if r[1] >= 20)
    rank = {k[3]: n for n, k in enumerate(can[: len(can) * percent // 100], 1)}
    return sorted(((*r, rank.get(i)) for i, r in enumerate(rows)), key=str)


def made(n, seed):
    rng = random.Random(seed)
    vocab = ["Alpha", "beta2", "ÉTÉ", "été", "don't", "x-y", "Ω", "long" * 40, "a", "zz9"] + [f"w{i}" for i in range(300)]
    return [(i, None if i % 97 == 0 else " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 5, 19, 20, 60, 200])))) for i in range(n)]


def drawn(spark, docs, target, percent=10, parts=7):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts).selectExpr("*", "1 rank", "'x' run", "2 seg", "3 score")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resample.draw(d, b, percent).collect()), key=str)


def test_crc_of_spans():
    data = [b"", b"a", b"word", b"x" * 64, b"y" * 65, "é".encode() * 500]
    buf = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(x) for x in data])
    got = resample.crc32_spans(buf, ends - [len(x) for x in data], ends)
    assert got.tolist() == [zlib.crc32(x) for x in data]


def test_words_of_odd_texts():
    texts = ["", "A\x00b\x7fC", "É-é 09az:`{", "\x80\xa0ß"]
    bucket, owner = resample.word_buckets(next(flat.slices(pa.array(texts)))[2])
    assert list(zip(owner.tolist(), bucket.tolist())) == [(i, zlib.crc32(w.encode()) % 10000) for i, t in enumerate(texts) for w in words(t)]


def test_draw_equals_plain_sort(spark):
    docs, target = made(900, 3), [t for _, t in made(30, 4)]
    assert drawn(spark, docs, target) == plain(docs, target)
    assert drawn(spark, docs, target, 37) == plain(docs, target, 37)


def test_ties_repeats_and_null_ids(spark):
    same = " ".join(["tie"] * 25)
    docs = [(5, same)] * 400 + [(None, same)] * 30 + [(i, same) for i in range(200)]
    assert drawn(spark, docs, ["tie"]) == plain(docs, ["tie"])


def test_empty_tables(spark):
    assert drawn(spark, [], ["x"]) == []
    docs = made(60, 9)
    assert drawn(spark, docs, []) == plain(docs, [])
    assert drawn(spark, [(1, "few words")], ["few"]) == plain([(1, "few words")], ["few"])
