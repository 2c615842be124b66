"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import attention, bpe, conversations, decontam, langid, neardup, pii, quality, resample, secrets, tokencount, toxicity, vectors
from .store import read_table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop("host_rules")


@query
def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), k=3, share=(85, 100))


@query
def op4_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op5_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(read_table(spark, sf_dir, "documents"), bpe.default_path(), limit=512)


@query
def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"), pii.session_key(spark))


@query
def op7_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


@query
def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(read_table(spark, sf_dir, "documents"))


@query
def op9_bpe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), bpe.default_path())


@query
def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read_table(spark, sf_dir, "documents"))


@query
def op11_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(read_table(spark, sf_dir, "conversations"))


@query
def op12_regular_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.draw(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(read_table(spark, sf_dir, "embeddings"))


_WORD = r"[^\x20\x09-\x0D]+"

_rates = ",\n".join(
    f"""  (f_{r} + m_{r} * s_{r}) / (n + s_{r}) AS rate_{r}""" for r in quality.SOFT_RULES
)
_moments = ",\n".join(
    f"""  (sum(f_{r}) + 0.5) / (sum(n) + 1) AS m_{r},
  (sum(f_{r} * f_{r} / n::DOUBLE) - sum(f_{r}) * sum(f_{r}) / sum(n)::DOUBLE) / sum(n) - ((sum(f_{r}) + 0.5) / (sum(n) + 1)) * (1 - (sum(f_{r}) + 0.5) / (sum(n) + 1)) * (count(*) - 1) / sum(n) AS v_{r}"""
    for r in quality.SOFT_RULES
)
_strengths = ",\n".join(
    f"""  least(greatest(CASE WHEN v_{r} > 0 THEN m_{r} * (1 - m_{r}) / v_{r} - 1 ELSE {quality.STRENGTH[1]} END, {quality.STRENGTH[0]}), {quality.STRENGTH[1]}) AS s_{r}, m_{r}"""
    for r in quality.SOFT_RULES
)
SQL["op1_host_quality"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS host,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents),
lines AS (
  SELECT doc_id, sum(c)::BIGINT AS n_lines, sum(c - 1)::BIGINT AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS c
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line)
  GROUP BY doc_id),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))),
repeats AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM grams WHERE c > 1) GROUP BY doc_id),
s AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines,
         len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper, len(regexp_extract_all(t, '[A-Za-z]'))::BIGINT AS n_letters
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
f AS (
  SELECT host, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {c}) AS f_{r}" for r, c in quality.SOFT_RULES.items())}
  FROM s GROUP BY host),
moments AS (SELECT {_moments} FROM f),
prior AS (SELECT {_strengths} FROM moments),
rates AS (SELECT host, {_rates} FROM f CROSS JOIN prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({" OR ".join(f"({c})" for c in quality.BASE_RULES.values())}) AS base_failed,
       NOT ({" OR ".join(f"({c})" for c in quality.BASE_RULES.values())}
            OR {" OR ".join(f"(({c}) AND rate_{r} >= {quality.HOST_RATE})" for r, c in quality.SOFT_RULES.items())}) AS kept
FROM s JOIN rates USING (host)"""


# crc32 by its table: a byte at a time over a list of byte values
_CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""


def _crc32(data: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295)"""


_BYTES = "list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SQL["op12_regular_sampling"] = f"""
WITH tab AS ({_CRC_TABLE}),
texts AS (
  SELECT row_number() OVER () AS row, doc_id, false AS aim, text FROM documents UNION ALL SELECT NULL, NULL, true, text FROM benchmark),
words AS (
  SELECT row, aim, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_PLAIN}')) AS w FROM texts),
buckets AS (SELECT w, {_crc32(_BYTES)} % {resample.BUCKETS} AS bucket FROM (SELECT DISTINCT w FROM words), tab),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE NOT aim) AS s, count(*) FILTER (WHERE aim) AS t FROM words JOIN buckets USING (w) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (big_s + {resample.BUCKETS})) / ((s + 1)::DOUBLE * (big_t + {resample.BUCKETS})))) AS gain FROM counts, sums),
weights AS (
  SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE NOT aim GROUP BY row),
scores AS (
  SELECT row, doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('{resample.SEED}:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE NOT aim),
placed AS (
  SELECT *, row_number() OVER (ORDER BY n_features < {resample.MIN_WORDS}, score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (WHERE n_features >= {resample.MIN_WORDS}) OVER () AS total FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= total * {resample.PERCENT} // 100 THEN place END::BIGINT AS rank FROM placed"""

_ROLE, _TEXT = "coalesce(role, ' ')", "coalesce(text, ' ')"
_TAIL = "right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)"
_KEY = "list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)"


def _ways() -> str:
    """Moves of one row by state: (at, move, price, letters, to, turns added)."""
    out = []
    for s in conversations.STATES:
        for at, added in conversations._INSERTS[s]:
            due = "assistant" if at == conversations.USER else "user"
            to = conversations.ASSISTANT if at == conversations.USER else conversations.USER
            cost, text = conversations.INSERT * len(added), "".join(f"{x}:\n" for x in added)
            out.append((s, due[0], cost, "I" * len(added) + "K", to, text, ""))
            out.append((s, "*", cost + conversations.REROLE, "I" * len(added) + "R", to, text, due))
            if at == conversations.START:
                out.append((s, "s", cost, "I" * len(added) + "K", conversations.SYSTEM, text, ""))
    lit = lambda x: str(x) if isinstance(x, int) else "'" + x + "'"
    return ", ".join("(" + ", ".join(map(lit, row)) + ")" for row in out)


def _endings() -> str:
    rows = [(s, conversations.INSERT * len(e), "I" * len(e), "".join(f"{x}:\n" for x in e)) for s, e in conversations._ENDING.items()]
    return ", ".join(f"({s}, {c}, '{a}', '{t}')" for s, c, a, t in rows)


SQL["op11_survivor_viterbi"] = f"""
WITH RECURSIVE tab AS ({_CRC_TABLE}),
dealt AS (SELECT conv_id, turn, {_ROLE} AS role, {_TEXT} AS text, {_crc32(_KEY)} % 20 AS fault FROM conversations, tab),
hurt AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM dealt, range(CASE fault WHEN 3 THEN 2 ELSE 1 END) WHERE fault <> 0),
named AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c FROM hurt),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, {_TAIL} AS tail FROM named),
rows AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS seen FROM placed),
marked AS (
  SELECT *, tail = '' AS blank, tail <> '' AND seen > 1 AS duplicate, tail <> '' AND seen = 1 AND tail NOT IN ('.', '!', '?') AS truncated,
         left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY c ORDER BY i), 1) AS before FROM rows),
stats AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM marked GROUP BY c),
ways(origin, initial, price, letters, dest, added, new) AS (VALUES {_ways()}),
search AS (
  SELECT c, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS turns FROM stats
  UNION ALL
  SELECT c, i, dest, best.cost, best.audit, best.turns FROM (
    SELECT c, i, dest, min(struct_pack(cost := cost, audit := audit, turns := turns)) AS best FROM (
      SELECT m.c, m.i, w.dest, s.cost + w.price + CASE WHEN m.truncated THEN {conversations.TRUNCATED} ELSE 0 END AS cost, s.audit || w.letters AS audit,
             s.turns || w.added || CASE w.new WHEN '' THEN m.role ELSE w.new END || ':' || m.text || chr(10) AS turns
      FROM search s JOIN marked m ON m.c = s.c AND m.i = s.i + 1 JOIN ways w ON w.origin = s.state AND (w.initial = '*' OR w.initial = m.initial)
      WHERE NOT m.blank AND NOT m.duplicate
      UNION ALL
      SELECT m.c, m.i, s.state, s.cost + {conversations.DELETE}, s.audit || 'D', s.turns FROM search s JOIN marked m ON m.c = s.c AND m.i = s.i + 1)
    GROUP BY c, i, dest)),
endings(origin, price, letters, added) AS (VALUES {_endings()}),
final AS (
  SELECT s.c, min(struct_pack(cost := s.cost + e.price, audit := s.audit || e.letters, turns := s.turns || e.added)) AS best
  FROM search s JOIN stats t ON t.c = s.c AND t.n = s.i JOIN endings e ON e.origin = s.state GROUP BY s.c),
found AS (SELECT t.*, f.best FROM stats t JOIN final f USING (c))
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.turns, length(best.turns) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN found f ON a.conv_id IS NOT DISTINCT FROM f.conv_id"""
