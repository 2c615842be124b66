"""Secret scans with Spark expressions only.

Base spans come from three patterns. Further spans come from two character Markov models, one
of random strings and one of ordinary identifiers, learned from all texts: the values that the
patterns find are samples of the first, other long runs with at most one group of digits of the
second. A run is a secret
(kind ``markov``) if its log-likelihood ratio is high enough, it has a letter and a digit and
it overlaps no base span; texts without a digit are not searched for runs. Positions count code points; a span's end is exclusive.

Spark finds the matches of a pattern but not their places, so a text is split at the pattern
too, and the places are running sums of the lengths of pieces and matches.

Defined results: null and empty texts have no spans (the digest of an empty string); texts are
taken whole; repeated rows are each returned; equal runs train once; without samples a model is
uniform over its letters.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import packed, unpacked

# The patterns, the group that is the value, and its least length. The last two
# take whole runs, so their least length can stand in the pattern and short runs cost nothing.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}+", 0, 20),
    "hex": (r"[0-9a-f]{24,}+", 0, 24),
}
#: What makes a pattern's match possible at all; cheap to look for.
HINTS = {"assign": "[:=]", "access": "AKIA", "hex": "[0-9a-f]{24}", "markov": "[0-9]"}
KINDS = [*PATTERNS, "markov"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = r"[A-Za-z0-9+/_=-]{16,}+"
#: Least ratio of a run, in nats per pair of characters, and in all.
MEAN_RATIO, SUM_RATIO = 0.5, 10.0
SMOOTH = 0.5

_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def _spans(text: Column, pattern: str, hint: str, group: int, kind: int) -> Column:
    """All leftmost non-overlapping matches as (s, k, e, v): start, kind, end, value."""
    p = F.lit(pattern)
    cols = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit")]
    if group:
        cols.append(F.regexp_extract_all(text, p, F.lit(group)).alias("v"))
    parts = F.filter(F.arrays_zip(*cols), lambda x: x["hit"].isNotNull())
    empty = F.array().cast(_SPAN)
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["hit"])
        one = F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["v" if group else "hit"].alias("v"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.when(text.rlike(hint), F.aggregate(parts, begin, step, lambda acc: acc["out"])).otherwise(empty)


def _base(text: Column, kind: str) -> Column:
    pattern, group, least = PATTERNS[kind]
    return F.filter(_spans(text, pattern, HINTS[kind], group, KINDS.index(kind)), lambda x: F.length(x["v"]) >= least)


def _runs(text: Column) -> Column:
    return F.filter(_spans(text, RUN, HINTS["markov"], 0, KINDS.index("markov")), lambda x: x["v"].rlike("[A-Za-z]"))


def _apart(runs: Column, base: Column) -> Column:
    return F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["s"] < r["e"]) & (r["s"] < b["e"])))


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__base``, the base spans in order, and ``__runs``, the runs beside them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.sort_array(F.concat(*[_base(text, k) for k in PATTERNS]))
    return docs.withColumn("__base", base).withColumn("__runs", _apart(_runs(text), F.col("__base")))


def learn(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratios of the pairs of LETTERS; at most 2 * len(LETTERS)**2 counts are brought here."""
    spans = with_candidates(docs.select("text"))
    plain = F.filter("__runs", lambda x: ~x["v"].rlike("[0-9][^0-9]+[0-9]"))
    marked = lambda c, y: F.transform(c, lambda x: F.struct(x["v"].alias("v"), F.lit(y).alias("y")))
    tokens = spans.select(F.explode(F.concat(marked("__base", 1), marked(plain, 0))).alias("t")).groupBy("t.v").agg(F.max("t.y").alias("y"))
    pairs = tokens.select("y", F.explode(F.expr("transform(sequence(1, greatest(length(v) - 1, 1)), i -> substring(v, i, 2))")).alias("pair"))
    counts = pairs.where(F.length("pair") == 2).groupBy("y", "pair").count().collect()
    n = np.full((2, len(LETTERS), len(LETTERS)), SMOOTH)
    for r in counts:
        a, b = LETTERS.find(r.pair[0]), LETTERS.find(r.pair[1])
        if a >= 0 and b >= 0:
            n[r.y, a, b] += r["count"]
    p = np.log(n / n.sum(2, keepdims=True))
    return p[1] - p[0]


def _scored(runs: Column, ratios: np.ndarray) -> Column:
    """The runs whose ratio reaches both bounds."""
    table = F.array(*[F.lit(float(round(x, 6))) for x in ratios.ravel()])
    letters, n = F.lit(LETTERS), len(LETTERS)

    def code(v: Column, i: Column) -> Column:
        return F.call_function("locate", F.substring(v, i, F.lit(1)), letters)

    def total(v: Column) -> Column:
        at = F.sequence(F.lit(1), F.length(v) - 1)
        return F.aggregate(at, F.lit(0.0), lambda acc, i: acc + F.element_at(table, (code(v, i) - 1) * n + code(v, i + 1)))

    return F.filter(runs, lambda r: r["v"].rlike("[0-9]") & (total(r["v"]) >= F.greatest(F.lit(SUM_RATIO), MEAN_RATIO * (F.length(r["v"]) - 1))))


def _joined(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["k"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__base`` and ``__all``, the spans in order."""
    rows = with_candidates(docs)
    return rows.withColumn("__all", F.sort_array(F.concat("__base", _scored(F.col("__runs"), learn(docs))))).drop("__runs")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the count of each kind, base_sha256 and spans of every row."""
    rows = find(docs.select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("__all", lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *[number(k) for k in KINDS], F.sha2(_joined(F.col("__base")), 256).alias("base_sha256"), _joined(F.col("__all")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark``; rows and other columns stay, n_chars follows the text."""
    rows = find(packed(docs, "text"))
    text = F.col("text").cast("string")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    done = F.aggregate("__all", begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    hit = F.size("__all") > 0
    rows = rows.select("row", hit.alias("hit"), F.when(hit, done).otherwise(text).alias("redacted"))
    new = {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("hit"), F.length("redacted").cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*unpacked(docs, **new))
