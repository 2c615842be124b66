"""Host-level quality rules.

Each document is measured once. Rule failures are summed per host (``source``), each host's
failure rate of a rule is shrunk towards all hosts by a beta prior fitted to the hosts
(method of moments), and the host's verdict is joined back to its documents: on a host
whose shrunk rate of a rule reaches ``host_rate``, documents that fail that rule go; on other
hosts a lone failure is tolerated. Documents that fail a base rule go on any host.

Defined results: a null or empty text has no words, so it fails the base rule of length; a
null host is a host of its own; repeated rows are measured and counted each; a text is always
taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import id_type, lookup_join, packed, saved, unpacked

#: Method rules and their conditions on the measured counts, in integers.
SOFT_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "shouting": "n_letters >= 20 and 10 * n_upper > 7 * n_letters",
    "word_length": "2 * word_chars < 5 * n_words or word_chars > 15 * n_words",
}
BASE_RULES = {"short": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words"}

#: Shrunk failure rate from which a host is held to a rule.
HOST_RATE = 0.005

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
WINDOW = 5


def _per_text(owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, minlength=n)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the items whose key comes more than once, and of those not the first of their key."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, many = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return many, later


def measure_texts(t: flat.Texts) -> dict[str, np.ndarray]:
    starts, ends, doc = t.words()
    head = (t.buf & 0xC0) != 0x80  # first bytes of code points
    out = {"n_words": _per_text(doc, t.n), "word_chars": t.sums(head & ~flat.SPACE[t.buf]), "n_symbols": t.sums(_SYMBOL[t.buf])}
    upper = (t.buf >= 65) & (t.buf <= 90)
    out["n_upper"], out["n_letters"] = t.sums(upper), t.sums(upper | (t.buf >= 97) & (t.buf <= 122))

    # lines: cut at \n and between texts
    cut = np.flatnonzero(t.buf == 10)
    line_start = np.sort(np.concatenate([t.offs[:-1], cut + 1]), kind="stable")
    line_end = np.sort(np.concatenate([t.offs[1:], cut]), kind="stable")
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_doc = t.owner(line_start)
    _, later = _repeated(flat.keyed(flat.hash_spans(t.buf, line_start, line_end), line_doc))
    out["n_lines"], out["n_dup_lines"] = _per_text(line_doc, t.n), _per_text(line_doc[later], t.n)

    # five-word windows found twice or more in their text
    grams = flat.gram_hash(flat.hash_spans(t.buf, starts, ends), tuple(range(WINDOW)))
    whole = np.flatnonzero(doc[: len(grams)] == doc[WINDOW - 1 :]) if len(grams) else np.zeros(0, int)
    many, _ = _repeated(flat.keyed(grams[whole], doc[whole]))
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, whole[many], 1)
    np.add.at(step, whole[many] + WINDOW, -1)
    out["n_repeat_words"] = _per_text(doc[np.cumsum(step[:-1]) > 0], t.n)
    return out


def host_of(column: str):
    """The key of a document's host; null is a host of its own."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, host and the counts of every row."""
    rows = docs.select("doc_id", host_of("source").alias("host"), "text")
    schema = f"doc_id {id_type(docs)}, host string, " + ", ".join(f"{c} long" for c in _COUNTS)
    return flat.map_texts(rows, lambda own, t: {"doc_id": own[0], "host": own[1]} | {c: x.astype(np.int64) for c, x in measure_texts(t).items()}, schema, carry=("doc_id", "host"))


def host_rates(stats: DataFrame) -> DataFrame:
    """Per host: n, the failures of each soft rule, and their rates shrunk by the beta prior.

    The prior of a rule has the hosts' mean rate m and the strength s = m(1-m)/v - 1, where v is
    the variance between hosts beyond what chance gives; without such variance the hosts share
    one rate. Only one row of prior parameters is brought to the driver.
    """
    fails = [F.sum(F.expr(f"({cond})").cast("long")).alias(f"f_{r}") for r, cond in SOFT_RULES.items()]
    hosts = saved(stats.groupBy("host").agg(F.count("*").alias("n"), *fails), "hosts")
    parts = [F.sum("n").alias("n"), F.count("*").alias("k")]
    parts += [F.sum(f"f_{r}").alias(f"f_{r}") for r in SOFT_RULES]
    parts += [F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n")).alias(f"q_{r}") for r in SOFT_RULES]
    total = hosts.agg(*parts).first()
    for r in SOFT_RULES:
        a, b = beta_prior(total["n"] or 0, total["k"], total[f"f_{r}"] or 0, total[f"q_{r}"] or 0.0)
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(a)) / (F.col("n") + F.lit(a + b)))
    return hosts


#: Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 1000.0)


def beta_prior(n: int, k: int, fails: int, squares: float) -> tuple[float, float]:
    """Alpha and beta from the sums over hosts of n, f and f*f/n."""
    m = (fails + 0.5) / (n + 1)
    between = (squares - fails * fails / n) / n - m * (1 - m) * (k - 1) / n if n else 0.0
    s = m * (1 - m) / between - 1 if between > 0 else STRENGTH[1]
    s = min(max(s, STRENGTH[0]), STRENGTH[1])
    return m * s, (1 - m) * s


def _verdicts(stats: DataFrame, host_rate: float) -> tuple[DataFrame, int]:
    """The rules that each host is held to, and the number of hosts."""
    hosts = host_rates(stats)
    held = F.filter(F.array(*[F.when(F.col(f"rate_{r}") >= host_rate, F.lit(r)) for r in SOFT_RULES]), lambda x: x.isNotNull())
    hosts = saved(hosts.select("host", held.alias("held")), "host_verdicts")
    return hosts, hosts.count()


def _failed(rules: dict[str, str], prefix: str = ""):
    conds = {r: _prefixed(c, prefix) for r, c in rules.items()}
    return F.filter(F.array(*[F.when(F.expr(c), F.lit(r)) for r, c in conds.items()]), lambda x: x.isNotNull())


def _prefixed(cond: str, prefix: str) -> str:
    for c in _COUNTS if prefix else ():
        cond = re.sub(rf"\b{c}\b", prefix + c, cond)
    return cond


def judge(docs: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """One row per document: its counts, base_failed, kept, and the host rules that reject it."""
    stats = saved(measure(docs), "doc_stats")
    hosts, n = _verdicts(stats, host_rate)
    rows = lookup_join(stats, hosts, "host", rows=n)
    against = F.array_intersect(_failed(SOFT_RULES), "held")
    base = F.size(_failed(BASE_RULES)) > 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & (F.size(against) == 0)).alias("kept"), against.alias("host_rules"),
    )


def keep_good(docs: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The rows are measured again as they pass, so neither their texts nor their ids are joined.
    """
    hosts, n = _verdicts(measure(docs), host_rate)
    counts = lambda t: {f"__{c}": x.astype(np.int64) for c, x in measure_texts(t).items()}
    rows = flat.annotate(packed(docs, "text", "source"), counts, ", ".join(f"__{c} long" for c in _COUNTS))
    rows = rows.where(F.size(_failed(BASE_RULES, "__")) == 0).withColumn("__soft", _failed(SOFT_RULES, "__")).withColumn("__host", host_of("source"))
    held = hosts.select(F.col("host").alias("__host"), F.col("held").alias("__held"))
    return lookup_join(rows, held, "__host", rows=n).where(~F.arrays_overlap("__soft", "__held")).select(*unpacked(docs))
