"""An interaction of terms that are each uncorrelated with the label."""
import random
import zlib

from fraudlake.llm import toxicity


def test_either_word_but_not_both(spark):
    rng = random.Random(22)
    rows, labels = [], []
    for i in range(3000):
        a, b = i % 2 == 0, i // 2 % 2 == 0  # balanced: neither word says anything alone
        w = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(6)] + ["insx"] * a + ["grpy"] * b
        rng.shuffle(w)
        rows.append((i, " ".join(w) + f" r{i}"))
        labels.append((i, 1, int(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == labels[i][2] for i in held) / len(held) > 0.9
