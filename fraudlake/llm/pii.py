"""Format-preserving pseudonyms of personal data.

Numbers and dates that pass their kind's validation are replaced by a keyed permutation of
their own format: a card number by a card number with a right check digit, a date by a date
in the same notation. One key maps equal values to equal values in every document, so they
stay linked, and the key's holder can go back (:func:`restore`).

The permutation is a Feistel network over the integers below n: a value is cut into two
digits of about sqrt(n), and rounds add a keyed hash of the one to the other. It is repeated
until the result is below n and has the form of the value again, which keeps it a bijection on
each form. Spark deals the rows; a task keeps no state but the values of one text.

Kinds: email (the name before the @; letters stay letters, digits digits), iban (mod 97),
card (13 to 19 digits, Luhn), date (1900 to 2099), ssn, ip (four numbers to 255; public
addresses stay public, others keep their first number), phone (8 to 15 digits with a country
code, or ten digits in groups). Country codes and the domains of addresses stay. Numbers that
fail their validation are left alone. Where matches overlap the leftmost counts, then the
longest, then the kind listed first.

Defined results: a null text stays null and an empty one empty, without spans; texts are taken
whole; repeated rows are each returned; other columns stay as they are. Positions count code
points of the given text; a span's end is exclusive.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .flat import Texts, annotate
from .store import packed, unpacked

ROUNDS = 10
#: Session setting that holds the key, and the key of sessions without it (for trials only).
KEY_SETTING, TRIAL_KEY = "spark.fraudlake.pii.key", "trial key"

# The kinds' patterns.
_SEP = "[ .-]"
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?!\w|[.-][0-9])",
    "date": r"(?<![\w/.-])(?:[0-9]{4}([/.-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\2[0-9]{4})(?!\w|[/.-][0-9])",
    "ssn": r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!\w|[.-][0-9])",
    "ip": r"(?<![\w.-])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|[.-][0-9])",
    "phone": rf"(?<![\w+.-])(?:\+[1-9][0-9]{{0,2}}{_SEP}?(?:\([0-9]{{1,4}}\){_SEP}?)?[0-9]{{2,4}}(?:{_SEP}?[0-9]{{2,4}}){{1,4}}"
    rf"|\([0-9]{{3}}\){_SEP}?[0-9]{{3}}{_SEP}[0-9]{{4}}|[0-9]{{3}}([.-])[0-9]{{3}}\1[0-9]{{4}})(?!\w|[.-][0-9])",
}
KINDS = list(PATTERNS)
#: Digits that a text has at least if it holds anything but an address with an @.
LEAST_DIGITS = 4
#: Alphabets that a letter or digit stays within.
ALPHABETS = [
    "0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "abcdefghijklmnopqrstuvwxyz",
    "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])),
    "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xDF)])),
]
_ALPHABET = {c: a for a in ALPHABETS for c in a}
_COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


@dataclass(frozen=True)
class Value:
    """A valid value: number x below n, permuted under ``tweak``; render(y) has form ``form`` or is passed over."""

    x: int
    n: int
    tweak: str
    form: tuple
    render: Callable[[int], str]


def permute(x: int, n: int, key: bytes, tweak: str, back: bool = False) -> int:
    """The keyed permutation of 0 .. n - 1 at x, or its inverse."""
    b = isqrt(n - 1) + 1
    a = -(-n // b)
    sign = -1 if back else 1
    while True:
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            half = left if i % 2 else right
            h = int.from_bytes(hashlib.blake2b(f"{tweak}|{n}|{i}|{half}".encode(), key=key).digest(), "big")
            if i % 2:
                right = (right + sign * h) % b
            else:
                left = (left + sign * h) % a
        x = left * b + right
        if x < n:
            return x


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _fill(shape: str, digits: str) -> str:
    rest = iter(digits)
    return re.sub("[0-9]", lambda _: next(rest), shape)


def _letters(shape: str) -> tuple[int, int, str, Callable[[int], str]]:
    """x, n, classes and render of a string whose letters and digits each vary within their alphabet."""
    x, n = 0, 1
    for c in shape:
        if a := _ALPHABET.get(c):
            x, n = x * len(a) + a.index(c), n * len(a)
    classes = "".join(str(ALPHABETS.index(_ALPHABET[c])) if c in _ALPHABET else c for c in shape)

    def render(y: int) -> str:
        out = []
        for c in reversed(shape):
            if a := _ALPHABET.get(c):
                y, d = divmod(y, len(a))
                c = a[d]
            out.append(c)
        return "".join(reversed(out))

    return x, n, classes, render


def _email(m: str) -> Value | None:
    name, domain = m.split("@")
    x, n, classes, render = _letters(name)
    return Value(x, n, f"email {classes}", (domain,), lambda y: f"{render(y)}@{domain}") if n > 1 else None


def _iban(m: str) -> Value | None:
    plain = m.replace(" ", "")
    country, body = plain[:2], plain[4:]

    def check(body: str) -> str:
        return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"

    if not 15 <= len(plain) <= 34 or check(body) != plain[2:4]:
        return None
    x, n, classes, render = _letters(body)

    def spaced(y: int) -> str:
        rest = iter(country + check(render(y)) + render(y))
        return "".join(c if c == " " else next(rest) for c in m)

    return Value(x, n, f"iban {country}{classes}", (), spaced)


def _card(m: str) -> Value | None:
    digits = re.sub("[ -]", "", m)
    k = len(digits) - 1
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn(digits[:k]) != int(digits[k]):
        return None
    return Value(int(digits[:k]), 10**k, "card", (), lambda y: _fill(m, f"{y:0{k}d}{luhn(f'{y:0{k}d}')}"))


def _date(m: str) -> Value | None:
    sep = re.search("[/.-]", m)[0]
    parts = m.split(sep)
    if len(parts[0]) == 4:
        order = "ymd"
    else:
        order = "dmy" if sep == "." or int(parts[0]) > 12 else "mdy"
    at = dict(zip(order, map(int, parts), strict=True))
    try:
        day = dt.date(at["y"], at["m"], at["d"]).toordinal()
    except ValueError:
        return None
    if not _FIRST_DAY <= day <= _LAST_DAY:
        return None
    widths = tuple(map(len, parts))

    def render(y: int) -> str:
        d = dt.date.fromordinal(_FIRST_DAY + y)
        value = {"y": d.year, "m": d.month, "d": d.day}
        return sep.join(f"{value[c]:0{w}d}" for c, w in zip(order, widths, strict=True))

    return Value(day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, "date", (order, widths), render)


def _ssn(m: str) -> Value | None:
    area, group, serial = m.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    return Value(int(area + group + serial), 10**9, "ssn", (), lambda y: _fill(m, f"{y:09d}"))


def _ip(m: str) -> Value | None:
    parts = m.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    a, b, c, d = map(int, parts)
    low = (b << 16) + (c << 8) + d
    text = lambda y: ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))
    inner = a in (0, 10, 127) or a >= 224 or (a, b) in ((192, 168), (169, 254)) or (a == 172 and 16 <= b < 32)
    if inner:
        return Value(low, 1 << 24, f"ip {a}", ("inner",), lambda y: text((a << 24) + y))
    return Value((a << 24) + low, 1 << 32, "ip", ("public",), text)


def _phone(m: str) -> Value | None:
    cut = re.match(r"\+[0-9]{1,3}", m)
    prefix = cut[0] if cut else ""
    rest = m[len(prefix) :]
    digits = re.sub("[^0-9]", "", rest)
    code = prefix or "+1"
    if not 8 <= len(digits) + len(code) - 1 <= 15 or len(digits) < 6:
        return None
    assigned = code == "+1" and len(digits) == 10 and digits[0] > "1" and digits[3] > "1"
    return Value(int(digits), 10 ** len(digits), f"phone {code}", (assigned,), lambda y: prefix + _fill(rest, f"{y:0{len(digits)}d}"))


_READ = {"email": _email, "iban": _iban, "card": _card, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone}


def pseudonym(kind: str, match: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a match, or the value of a pseudonym; None if the match isn't valid."""
    v = _READ[kind](match)
    if v is None:
        return None
    y = v.x
    while True:
        y = permute(y, v.n, key, v.tweak, back)
        out = v.render(y)
        if _COMPILED[kind].fullmatch(out) and (w := _READ[kind](out)) is not None and (w.tweak, w.form, w.n) == (v.tweak, v.form, v.n):
            return out


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the valid values of a text, in order and not overlapping."""
    found = []
    for k, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text:
            continue
        for m in _COMPILED[kind].finditer(text):
            if _READ[kind](m[0]) is not None:
                found.append((m.start(), -m.end(), k))
    out, at = [], 0
    for start, end, k in sorted(found):
        if start >= at:
            out.append((start, -end, KINDS[k]))
            at = -end
    return out


_ADDED = "__new string, __spans string, __pseudonyms array<string>, __kinds array<string>"


def _work(key: str, back: bool) -> Callable[[Texts], dict]:
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def run(texts: Texts) -> dict:
        digits = texts.sums((texts.buf >= 48) & (texts.buf <= 57))
        ats = texts.sums(texts.buf == 64)
        cols: list[list] = [[], [], [], []]
        for i in range(texts.n):
            text = texts.buf[texts.offs[i] : texts.offs[i + 1]].tobytes().decode()
            got = spans(text) if digits[i] >= LEAST_DIGITS or ats[i] else []
            names = [pseudonym(k, text[s:e], secret, back) for s, e, k in got]
            pieces, at = [], 0
            for (s, e, _), name in zip(got, names, strict=True):
                pieces += [text[at:s], name]
                at = e
            row = "".join([*pieces, text[at:]]), ",".join(f"{k}:{s}:{e}" for s, e, k in got), names, [k for *_, k in got]
            for col, x in zip(cols, row, strict=True):
                col.append(x)
        words = pa.list_(pa.string())
        return dict(zip(("__new", "__spans", "__pseudonyms", "__kinds"), map(pa.array, cols, (pa.string(), pa.string(), words, words)), strict=True))

    return run


def _annotated(docs: DataFrame, key: str, back: bool) -> DataFrame:
    rows = docs.withColumn("text", F.col("text").cast("string"))
    return annotate(rows, _work(key, back), _ADDED)


def _replaced(docs: DataFrame, key: str, back: bool) -> DataFrame:
    rows = _annotated(packed(docs, "text"), key, back)
    change = F.size("__kinds") > 0
    rows = rows.select("row", change.alias("change"), F.when(change, F.col("__new")).otherwise(F.col("text")).alias("replaced"))
    new = {"text": F.col("replaced")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("change"), F.length("replaced").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*unpacked(docs, **new))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the personal data of their texts replaced; n_chars follows the text, other columns stay."""
    return _replaced(docs, key, False)


def restore(docs: DataFrame, key: str) -> DataFrame:
    """The texts that :func:`pseudonymise` was given, from what it returned."""
    return _replaced(docs, key, True)


def report(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, n_<kind> of each kind, spans (kind:start:end in the given text), the pseudonyms in order, and the new text."""
    rows = _annotated(docs.select("doc_id", "text"), key, False)
    count = lambda kind: F.size(F.filter("__kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    text = F.when(F.col("text").isNotNull(), F.col("__new")).alias("text")
    return rows.select("doc_id", *[count(k) for k in KINDS], F.col("__spans").alias("spans"), F.col("__pseudonyms").alias("pseudonyms"), text)


def links(found: DataFrame) -> DataFrame:
    """From :func:`report`: pseudonym, n_docs, first_doc of every value that several documents share."""
    each = found.select("doc_id", F.explode(F.array_distinct("pseudonyms")).alias("pseudonym"))
    return each.groupBy("pseudonym").agg(F.countDistinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


def session_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, TRIAL_KEY)
