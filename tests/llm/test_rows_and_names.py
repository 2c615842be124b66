"""Stages judge rows, not ids, and leave columns of any name alone; pairs of a crowd stay few."""
import random

import pytest
from pyspark.sql import functions as F

from fraudlake.llm import neardup, pii, quality, secrets, stages, store

PLAIN = " ".join(f"word{i} of text" for i in range(40)) + "."
NAMES = ["__base", "__soft", "__n_words", "__all", "__new", "__kinds", "__host", "row", "r", "h", "label"]


def odd(spark, rows):
    """Documents with columns named like the operators' own, and a map."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    return df.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in NAMES], F.create_map(F.lit("k"), "source").alias("tags"))


@pytest.mark.parametrize("step", ["quality", "redact", "pseudonyms", "near_dedup", "decontaminate"])
def test_columns_named_like_the_operators_own(spark, tmp_path, step):
    rows = [(i, f"{PLAIN} {i} password = hunter{i}xyz, mail ann{i}@mail.example.org", None if i % 2 else "s", 5) for i in range(12)]
    docs = odd(spark, rows)
    spark.createDataFrame([(1, "nothing like these at all, not even a few words of it")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {
        "quality": lambda: quality.keep_good(docs), "redact": lambda: secrets.redact(docs), "pseudonyms": lambda: pii.pseudonymise(docs, "key"),
        "near_dedup": lambda: stages.near_dedup(spark, docs, str(tmp_path)), "decontaminate": lambda: stages.decontaminate(spark, docs, str(tmp_path)),
    }[step]()
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got
    for i, r in got.items():
        assert all(r[c] == f"{c} {i}" for c in NAMES) and r["tags"] == {"k": r["source"]}
    if step in ("redact", "pseudonyms"):
        assert all(f"hunter{i}xyz" not in r["text"] if step == "redact" else f"ann{i}@" not in r["text"] for i, r in got.items())
        assert all(r["n_chars"] == len(r["text"]) for r in got.values()), [(r["n_chars"], len(r["text"])) for r in got.values()]


def test_repeated_rows_and_null_ids_are_one_group(spark, tmp_path):
    other = PLAIN.replace("word3 ", "changed ")
    far = " ".join(f"other{i} thing" for i in range(60))
    rows = [(1, PLAIN), (1, PLAIN), (2, PLAIN), (None, PLAIN), (None, PLAIN), (1, far), (7, other), (None, far), (9, ""), (9, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r["doc_id"], r["text"]) for r in stages.near_dedup(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, PLAIN), (1, far), (9, ""), (9, ""), (None, None)], key=str)


def test_leaks_go_row_by_row(spark, tmp_path):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"so {item} end"), (3, "a clean text"), (3, f"again {item}"), (None, "clean too")]
    got = stages.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(3, "a clean text"), (None, "clean too")], key=str)


def test_salts_are_those_of_the_row(spark):
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(3)], "k long, v string")
    out = store.lookup_join(left, right, "k")
    assert "rand(" not in out._jdf.queryExecution().toString() and out.where("v is null").count() == 0 and out.count() == 1000


def test_a_crowd_of_unlike_texts_makes_few_pairs(spark, monkeypatch):
    """Texts of one template with more changes than the threshold allows: their prefixes meet in the
    template's shingles, but no pair of them is made; the few partners among them are found."""
    monkeypatch.setattr(neardup, "WINDOW", 1)
    tried = []
    confirm = neardup._confirm
    monkeypatch.setattr(neardup, "_confirm", lambda pairs, sets, share: tried.append(pairs.count()) or confirm(pairs, sets, share))
    rng, template = random.Random(4), [f"t{i}" for i in range(150)]
    texts = []
    for i in range(200):
        w = list(template)
        for j in rng.sample(range(150), 9):
            w[j] = f"u{i}x{j}"
        texts.append((3 * i, " ".join(w)))
        if i % 20 == 0:
            two = list(w)
            two[149] = f"v{i}"
            texts.append((3 * i + 1, " ".join(two)))
    out = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, (85, 100)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - i % 3 for i, _ in texts}
    assert sum(tried[2:]) < 400, tried
