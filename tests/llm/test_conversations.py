"""Conversation repair against exhaustive and plain full-string searches."""
import hashlib
import itertools
import random
import zlib

from fraudlake.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain(rows, fault):
    """Dynamic programming over (last initial) with whole audit strings and repaired rows."""
    ways = {"": (0, "", ())}

    def better(to, cost, audit, turns, into):
        if to not in into or (cost, audit) < into[to][:2]:
            into[to] = (cost, audit, turns)

    def inserts(ways):
        for _ in range(3):
            new = dict(ways)
            for s, (c, a, t) in ways.items():
                for role in ("user", "assistant"):
                    if (s, role[0]) in NEXT:
                        better(NEXT[s, role[0]], c + 5, a + "I", (*t, f"{role}:"), new)
            ways = new
        return ways

    for (_, role, text), f in zip(rows, fault):
        into = {}
        for s, (c, a, t) in inserts(ways).items():
            better(s, c + 2, a + "D", t, into)
            if f in ("blank", "duplicate"):
                continue
            more = 5 * (f == "truncated")
            for letter, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                if (s, new[:1]) in NEXT:
                    better(NEXT[s, new[:1]], c + price + more, a + letter, (*t, f"{new}:{text}"), into)
        ways = into
    ways = inserts(ways)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def exhaustive(rows, fault):
    gaps = [()] + [(x,) for x in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    best = None
    for edits in itertools.product("KUAD", repeat=len(rows)):
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, turns, ok = 0, "", [], True
            for (_, role, text), f, e, more in zip(rows, fault, edits, added):
                cost += 5 * len(more)
                audit += "I" * len(more)
                turns += [f"{r}:" for r in more]
                if e == "D":
                    cost, audit = cost + 2, audit + "D"
                    continue
                if f in ("blank", "duplicate"):
                    ok = False
                    break
                new = {"K": role, "U": "user", "A": "assistant"}[e]
                cost += (e != "K") + 5 * (f == "truncated")
                audit += "K" if e == "K" else "R"
                turns.append(f"{new}:{text}")
            if not ok:
                continue
            cost, audit = cost + 5 * len(added[-1]), audit + "I" * len(added[-1])
            turns += [f"{r}:" for r in added[-1]]
            state = ""
            for t in turns:
                state = NEXT.get((state, t[:1]))
                if state is None:
                    break
            if state in ("", "a") and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, tuple(turns))
    return best


def expected(rows):
    out = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        now = damaged([r for r in rows if r[0] == conv])
        fault = faults(now)
        cost, audit, turns = plain(now, fault)
        known = {t for t, _, _ in now if t is not None}
        initials = [r[:1] for _, r, _ in now]
        out[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0,
            *(fault.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest(),
        )
    return out


def results(spark, rows, schema="conv_id long, turn long, role string, text string"):
    got = cv.report(spark.createDataFrame(rows, schema)).collect()
    out = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in got}
    assert len(out) == len(got)
    return out


def made(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "usr", "", None]
    texts = ["One.", "Two!", "Three?", "no end", "", "  ", None, "Long line.\nMore. ", "é…", "a?\t"]
    return [(conv, rng.choice([None, t, t, t, t // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {t}{rng.choice(['.', '', '!'])}") for t in range(n)]


def test_plain_search_is_the_cheapest():
    rng = random.Random(2)
    for conv in range(25):
        now = damaged(made(rng, conv, 2))
        if len(now) <= 2:
            assert plain(now, faults(now)) == exhaustive(now, faults(now))


def test_report_equals_plain_search(spark):
    rng = random.Random(5)
    rows = [r for conv in range(300) for r in made(rng, conv, rng.randint(1, 12))] + made(rng, None, 9)
    rows += rows[40:60]
    rng.shuffle(rows)
    assert results(spark, rows) == expected(rows)


def test_long_conversations_span_tasks(spark):
    rng = random.Random(8)
    rows = [r for conv, n in ((0, 150), (1, 3), (2, 700), (3, 60), (4, 2)) for r in made(rng, conv, n)]
    rows += [(5, t, "tool", f"Tool {t}.") for t in range(200)]  # two ways stay open to the end
    rows += [(6, t, ("user", "assistant")[t % 2], "Same.") for t in range(300)]
    rows += [(7, 3, "user", "Equal row.")] * 500
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("7", "false", "13")):
            spark.conf.set(k, v)
        assert results(spark, rows) == expected(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_survivors_leave_the_tree():
    t = cv.Trellis((cv.START,))
    for i in range(5000):
        t.push(2 if i % 2 == 0 else 4)
        t.resolved[cv.START].clear()
    assert max(len(r) for _, _, r in t.finish().values()) <= 3


def test_repaired_turns_and_other_columns(spark):
    rows = [(1, 1, "system", "Be kind.", "x"), (1, 2, "assistant", "Hello.", "x"), (1, 3, "user", "Why?", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, h string")
    edits, totals, _ = cv.repair(df.select("conv_id", "turn", "role", "text").selectExpr("*", "1L copies"))
    got = [tuple(r) for r in cv.repaired(edits).orderBy("pid", "at", "place").select("role", "text").collect()]
    assert got == [("system", "Be kind."), ("user", "Hello."), ("assistant", "Why?")]
    assert totals.first()["cost"] == 2


def test_empty_table(spark):
    assert results(spark, []) == {}
    rows = [(k, 0, "user", "Hi.") for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    got = results(spark, rows)
    assert len(got) == len(rows) and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
