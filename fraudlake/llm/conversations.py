"""Conversation structure repair by survivor-coalescence Viterbi.

The rows of a conversation, in order, become a structure ``(s?(ua)+)?`` of role initials by the
cheapest edits: Keep 0, Rerole to user or assistant 1, Delete 2 (a must for blank rows and
duplicates), Insert an empty user or assistant turn 5; a truncated row that stays adds 5. Of
equally cheap repairs the one with the ASCII-least string of edit initials counts.

1. Equal rows of a conversation are counted, not repeated, and flagged (:func:`flagged`).
2. The rows are dealt by range of (conversation, turn, role, text), so a long conversation spans
   several tasks. Each task reads its rows in order and keeps, per state of the structure, one
   survivor: cost, place of its edit string among all survivors' strings, and a leaf of a
   backpointer tree (:class:`Trellis`). Nodes count their references; once all survivors share
   an ancestor, the edits up to it are final and leave. A survivor that another one beats by more
   than any future can make up is dropped. So a task holds the unresolved suffix alone. Ties are
   settled by the survivors' places, which order their whole strings, unresolved parts included.
3. A conversation that meets a border of a task (or of a batch) is worked through from every
   state it may be entered in; costs and string places by (entered, left) state compose over its
   few segments (:func:`_compose`), and the choice picks each row's edit.

Defined results: null role or text reads as one space, a null conv_id is a conversation of its
own; rows go by turn (nulls first), then role and text, and equal rows stand side by side. A role
without initial can't be kept. Only the four columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .store import if_small, saved

#: Blank characters.
BLANK = " \t\n\x0b\x0c\r"

#: Costs (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The turns that may be inserted in a state without going in circles, by the state they lead to.
_INSERTS = {
    START: ((START, ()), (USER, ("user",)), (ASSISTANT, ("user", "assistant"))),
    SYSTEM: ((SYSTEM, ()), (USER, ("user",)), (ASSISTANT, ("user", "assistant"))),
    USER: ((USER, ()), (ASSISTANT, ("assistant",))),
    ASSISTANT: ((ASSISTANT, ()), (USER, ("user",))),
}
#: What must be inserted after the last row, by state.
_ENDING = {START: (), SYSTEM: ("user", "assistant"), USER: ("assistant",), ASSISTANT: ()}
#: LOSS[x][y]: the most that ending well from state x costs above ending well from y.
_LOSS = {START: (0, 0, 5, 0), SYSTEM: (10, 0, 5, 10), USER: (7, 5, 0, 5), ASSISTANT: (2, 0, 5, 0)}

#: Edits of one row: (letters, roles of the turns inserted before it, its new role: "" if deleted,
#: None if kept), and the steps (to, cost, edit) by kind of row and state.
EDITS: list[tuple[str, tuple[str, ...], str | None]] = [("D", (), "")]
STEPS: list[dict[int, list[tuple[int, int, int]]]] = []


def _steps(initial: str, truncated: bool) -> dict[int, list[tuple[int, int, int]]]:
    """Inserting before a deletion is never best: inserting after it costs the same and sorts first."""
    out = {s: [(s, DELETE, 0)] for s in STATES}
    for s in STATES:
        for at, added in _INSERTS[s]:
            cost = INSERT * len(added) + TRUNCATED * truncated
            due = "assistant" if at == USER else "user"
            to = ASSISTANT if at == USER else USER
            ways = [(to, cost, None)] if initial == due[0] else [(to, cost + REROLE, due)]
            if initial == "s" and at == START:
                ways.append((SYSTEM, cost, None))
            for left, price, role in ways:
                EDITS.append(("I" * len(added) + ("K" if role is None else "R"), added, role))
                out[s].append((left, price, len(EDITS) - 1))
    return out


for _initial in ("s", "u", "a", ""):
    for _truncated in (False, True):
        STEPS.append(_steps(_initial, _truncated))
#: Edits that follow the last row, by the state it leaves.
ENDINGS = {}
for _s in STATES:
    EDITS.append(("I" * len(_ENDING[_s]), _ENDING[_s], ""))
    ENDINGS[_s] = len(EDITS) - 1


def kind_of(initial: Column, truncated: Column) -> Column:
    """Index into STEPS of a row that may stay."""
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (2 * place + truncated.cast("int")).cast("int")


class _Node:
    __slots__ = ("parent", "edit", "refs", "kids")

    def __init__(self, parent, edit: int):
        self.parent, self.edit, self.refs, self.kids = parent, edit, 1, []
        if parent is not None:
            parent.refs += 1
            parent.kids.append(self)


def _release(node: _Node) -> None:
    node.refs -= 1
    while not node.refs and node.parent is not None:
        up = node.parent
        up.kids.remove(node)
        up.refs -= 1
        node.parent, node = None, up


class Trellis:
    """Survivors of one conversation, or of a segment of it, from each state it may be entered in.

    ``push`` takes the next row that may stay; ``resolved[e]`` holds the final edits so far on the
    way from state e; ``finish`` gives what is left of each survivor.
    """

    def __init__(self, entries: tuple[int, ...]):
        self.entries = entries
        self.roots = {e: _Node(None, -1) for e in entries}
        self.live = {e: {e: (0, 0, self.roots[e])} for e in entries}
        self.resolved: dict[int, deque] = {e: deque() for e in entries}

    def push(self, kind: int) -> None:
        steps, keys, grown = STEPS[kind], set(), {}
        for e, live in self.live.items():
            best: dict[int, tuple] = {}
            for s, (cost, place, node) in live.items():
                for to, price, edit in steps[s]:
                    key = (cost + price, place, EDITS[edit][0])
                    if to not in best or key < best[to][0]:
                        best[to] = (key, node, edit)
            for s in list(best):
                if any(best[x][0][0] + _LOSS[x][s] < best[s][0][0] for x in best if x != s):
                    del best[s]
            grown[e] = best
            keys.update(k[1:] for k, _, _ in best.values())
        places = {k: i for i, k in enumerate(sorted(keys))}
        for e, best in grown.items():
            new = {s: (k[0], places[k[1:]], _Node(node, edit)) for s, (k, node, edit) in best.items()}
            for _, _, node in self.live[e].values():
                _release(node)
            self.live[e] = new
            root = self.roots[e]
            while root.refs == 1 and root.kids:
                (child,) = root.kids
                self.resolved[e].append(child.edit)
                child.parent = None
                root = child
            self.roots[e] = root

    def finish(self) -> dict[tuple[int, int], tuple[int, int, list[int]]]:
        """By (entered, left): cost, place of the whole string among all, unresolved edits."""
        out = {}
        for e, live in self.live.items():
            for s, (cost, place, node) in live.items():
                rest = []
                while node is not self.roots[e]:
                    rest.append(node.edit)
                    node = node.parent
                out[e, s] = (cost, place, rest[::-1])
        return out


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of the rows after the faults that a checksum of
    ``conv_id:turn`` (nulls: one space) deals: dropped, emptied, without end marks, twice, as user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(rows["conv_id"].cast("string"), space), F.lit(":"), F.coalesce(rows["turn"].cast("string"), space))
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce(rows["text"].cast("string"), space), F.coalesce(rows["role"].cast("string"), space)
    cols = rows.select(rows["conv_id"], rows["turn"].cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"))
    at = F.col("fault")
    return cols.where(at != 0).select(
        "conv_id",
        "turn",
        F.when(at == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(at == 1, "").when(at == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(at == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def flagged(rows: DataFrame) -> DataFrame:
    """One row for each distinct (conv_id, turn, role, text) with its copies, n, of which ``gone``
    must be deleted; fault (blank, truncated, or null) of a first copy; kind of what may stay."""
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    one = saved(one.withColumn("h", F.sha2(F.concat("role", F.lit(":"), "text"), 256)), "turns")
    early = one.groupBy("conv_id", "role", "h").agg(F.count("*").alias("times"), F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("first"))
    early = saved(early.where("times > 1").select(F.col("conv_id").alias("c0"), F.col("role").alias("r0"), F.col("h").alias("h0"), "first"), "repeated_turns")
    same = F.col("conv_id").eqNullSafe(F.col("c0")) & (F.col("role") == F.col("r0")) & (F.col("h") == F.col("h0"))
    last = F.right(F.rtrim("text", F.lit(BLANK)), F.lit(1))
    later = F.coalesce(~F.col("turn").eqNullSafe(F.col("first.turn")), F.lit(False)) & F.col("first").isNotNull()
    out = one.join(if_small(early), same, "left").select("conv_id", "turn", "role", "text", "n", last.alias("last"), later.alias("later"))
    blank, cut = F.col("last") == "", ~F.col("last").isin(".", "!", "?")
    stays = ~blank & ~F.col("later")
    return out.select(
        "conv_id", "turn", "role", "text", "n",
        F.when(stays, F.col("n") - 1).otherwise(F.col("n")).alias("gone"),
        blank.alias("blank"),
        (stays & cut).alias("truncated"),
        F.when(stays, kind_of(F.left("role", F.lit(1)), cut)).otherwise(-1).cast("int").alias("kind"),
    )


#: Of a whole conversation: cost and ending; of a segment: costs and places by state entered and left.
_SEGMENT = "struct<cost:long,ending:int,costs:array<int>,places:array<int>,illegal:long,first:string,last:string>"
_TURN = "turn long, role string, text string, n long, gone long"


#: States entered and left, as the arrays of segments and edits list them.
_PAIRS = [(e, s) for e in STATES for s in STATES]


def _legal(two: str) -> bool:
    return two in ("su", "ua", "au")


def _cheapest(ends: dict[int, tuple]) -> int:
    """The state to end in, by cost and place of the edit string."""
    return min(ends, key=lambda s: (ends[s][0] + INSERT * len(_ENDING[s]), ends[s][1]))


class _Run:
    """One conversation within a task: pending rows, their trellis, and the counts at its ends."""

    def __init__(self, conv, entries: tuple[int, ...]):
        self.conv, self.trellis = conv, Trellis(entries)
        self.pending: deque = deque()
        self.open = 0  # pending rows whose edit isn't settled
        self.illegal, self.first, self.last = 0, None, ""

    def add(self, row: tuple, n: int, kind: int, initial: str) -> None:
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not _legal(self.last + initial)
        self.illegal += (n - 1) * (not _legal(initial + initial))
        self.last = initial
        self.pending.append((row, kind))
        if kind >= 0:
            self.trellis.push(kind)

    def settled(self) -> Iterator[tuple[tuple, list[int] | None]]:
        """Rows at the front whose edits are final, from every state entered in."""
        ways = self.trellis.resolved
        while self.pending:
            row, kind = self.pending[0]
            if kind >= 0:
                if not all(ways.values()):
                    return
                yield row, [ways[e].popleft() for e in self.trellis.entries]
            else:
                yield row, None
            self.pending.popleft()


def _edit_rows(flags: DataFrame) -> DataFrame:
    """Rows with their possible edits (``edits``: one, or one by state entered, or by states entered
    and left), and a row for each conversation or segment of one (``seg``)."""
    kind = flags.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(f"pid int, at long, {_TURN}, edits array<int>, seg {_SEGMENT}").fields])
    arrow = to_arrow_schema(schema)
    keys = ["conv_id", "turn", "role", "text"]
    dealt = flags.select(*keys, "n", "gone", "kind", F.left("role", F.lit(1)).alias("initial"))
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at, now = TaskContext.get().partitionId(), 0, None
        out: list[tuple] = []

        def close() -> None:
            ends, ways = now.trellis.finish(), now.trellis.resolved
            whole = len(ways) == 1
            seg = {"illegal": now.illegal, "first": now.first, "last": now.last}
            if whole:
                s = _cheapest({s: ends[START, s] for _, s in ends})
                ends = {(START, s): ends[START, s]}
                seg |= {"cost": ends[START, s][0] + INSERT * len(_ENDING[s]), "ending": s}
            else:
                seg |= {name: [ends[k][j] if k in ends else -1 for k in _PAIRS] for j, name in enumerate(("costs", "places"))}
            by = {k: [*ways[k[0]], *rest] for k, (_, _, rest) in ends.items()}
            i = 0
            for row, kind in now.pending:
                picks = None
                if kind >= 0:
                    picks = [by[START, s][i]] if whole else [by[k][i] if k in by else -1 for k in _PAIRS]
                    i += 1
                out.append((*row, picks, None))
            out.append((now.conv, pid, *[None] * 7, seg))

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            convs = cols[0]
            for i in range(len(convs)):
                if now is None or convs[i] != now.conv:
                    inside = now is not None  # a conversation before it ended here
                    if inside:
                        close()
                    ends_here = convs[-1] != convs[i]
                    now = _Run(convs[i], (START,) if inside and ends_here else STATES)
                n, gone, k, initial = (c[i] for c in cols[4:])
                now.add((convs[i], pid, at, cols[1][i], cols[2][i], cols[3][i], n, gone), n, k, initial)
                at += 1
                out += [(*row, edits, None) for row, edits in now.settled()]
            if out:
                yield _batch(out, arrow)
                out.clear()
        if now is not None:
            close()
            yield _batch(out, arrow)

    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _compose(segments: DataFrame) -> DataFrame:
    """conv_id, pid, entered and left state of each segment; cost, illegal and last state (ending)
    of the whole on the row of its last segment, null on the others.

    A conversation has at most one segment a task and one a batch, so a group is small.
    """
    kind = segments.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("pid int, entered int, left int, cost long, illegal long, ending int").fields])
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["pid"])
        live: dict[int, tuple] = {START: (0, 0)}
        back: list[dict[int, int]] = []
        illegal, before = 0, None
        for r in rows:
            seg = r["seg"]
            illegal += seg["illegal"] + (before is not None and not _legal(before + seg["first"]))
            before = seg["last"]
            best: dict[int, tuple] = {}
            for j, (e, s) in enumerate(_PAIRS):
                if e in live and seg["costs"][j] >= 0:
                    key = (live[e][0] + seg["costs"][j], live[e][1], seg["places"][j])
                    if s not in best or key < best[s][0]:
                        best[s] = (key, e)
            order = {k: i for i, k in enumerate(sorted({k[1:] for k, _ in best.values()}))}
            live = {s: (k[0], order[k[1:]]) for s, (k, _) in best.items()}
            back.append({s: e for s, (_, e) in best.items()})
        end = _cheapest(live)
        out, at = [], end
        for r, step in zip(rows[::-1], back[::-1]):
            out.append((r["conv_id"], r["pid"], step[at], at, *((live[end][0] + INSERT * len(_ENDING[end]), illegal, end) if not out else (None, None, None))))
            at = step[at]
        return pa.Table.from_batches([_batch(out, arrow)])

    return segments.groupBy("conv_id").applyInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repair conversations given as (conv_id, turn, role, text, copies).

    Returns the edits (conv_id, pid, at, turn, role, text, edit, gone) in the order of (pid, at):
    ``edit`` indexes EDITS (null: none of the copies may stay) and ``gone`` further copies are
    deleted; a row of pid 2^31 - 1 without turn holds what is inserted at the end; the
    conversations' (conv_id, cost, illegal), cost without the copies in ``gone``; and the flags.
    """
    flags = saved(flagged(rows), "turn_flags")
    every = saved(_edit_rows(flags), "turn_edits")
    seen = every.where("seg is not null")
    parts = saved(_compose(seen.where("seg.ending is null").select("conv_id", "pid", "seg")), "segments")
    total = ["cost", "illegal", "ending"]
    ends = seen.where("seg.ending is not null").select("conv_id", *(f"seg.{c}" for c in total))
    ends = ends.unionByName(parts.where("ending is not null").select("conv_id", *total))
    turns = every.where("seg is null")
    chosen = parts.select(F.col("conv_id").alias("c0"), F.col("pid").alias("p0"), "entered", "left")
    size, at = F.size("edits"), len(STATES)
    turns = turns.join(if_small(chosen), (F.col("pid") == F.col("p0")) & F.col("conv_id").eqNullSafe(F.col("c0")), "left")
    pick = F.when(size == 1, 0).when(size == at, F.col("entered")).otherwise(at * F.col("entered") + F.col("left"))
    turns = turns.select("conv_id", "pid", "at", "turn", "role", "text", F.get("edits", pick).alias("edit"), "gone")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))]
    last = F.element_at(F.array(*(F.lit(ENDINGS[s]) for s in STATES)), F.col("ending") + 1)
    tail = ends.where(F.col("ending").isin([s for s in STATES if _ENDING[s]]))
    tail = tail.select("conv_id", F.lit(2**31 - 1).alias("pid"), F.lit(0).cast("long").alias("at"), *none, last.alias("edit"), F.lit(0).cast("long").alias("gone"))
    return turns.unionByName(tail), ends.select("conv_id", "cost", "illegal"), flags


def digest(edits: DataFrame) -> DataFrame:
    """conv_id, audit (edit initials) and sha256 of the repaired ``role:text`` lines.

    One hash runs over a conversation's rows in order, so these pass one task, as a stream.
    """
    kind = edits.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, sha, lines = None, [], None, 0
        for b in batches:
            done = []
            for conv, role, text, edit, gone in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "edit", "gone"))):
                if sha is None or conv != now:
                    if sha is not None:
                        done.append((now, "".join(audit), sha.hexdigest()))
                    now, audit, sha, lines = conv, [], hashlib.sha256(), 0
                letters, added, new = EDITS[edit] if edit is not None else ("", (), "")
                audit.append(letters + "D" * gone)
                kept = [f"{x}:" for x in added] + ([f"{role if new is None else new}:{text}"] if new != "" else [])
                for line in kept:
                    sha.update((("\n" if lines else "") + line).encode())
                    lines += 1
            if done:
                yield _batch(done, arrow)
        if sha is not None:
            yield _batch([(now, "".join(audit), sha.hexdigest())], arrow)

    dealt = edits.select("conv_id", "pid", "at", "role", "text", "edit", "gone").repartition("conv_id").sortWithinPartitions("conv_id", "pid", "at")
    return dealt.mapInArrow(run, schema)


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, pid, at, place (their order), role, text."""
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    ways = []
    for _, added, new in EDITS:
        own = [] if new == "" else [turn(F.col("role") if new is None else F.lit(new), F.col("text"))]
        items = [turn(F.lit(x), F.lit("")) for x in added] + own
        ways.append(F.array(*items) if items else F.array().cast("array<struct<role:string,text:string>>"))
    lists = F.element_at(F.array(*ways), F.col("edit") + 1)
    return edits.where("edit is not null").select("conv_id", "pid", "at", F.posexplode(lists).alias("place", "t")).select("conv_id", "pid", "at", "place", "t.*")


def report(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of the table: gaps, faults, cost, audit and digest of the repair of
    its damaged rows. Without rows after the damage: zeros, empty audit, hash of nothing."""
    edits, totals, flags = repair(damage(conversations))
    shape = flags.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("gone"))).alias("duplicate"),
        F.sum(F.col("truncated").cast("long")).alias("truncated"),
        F.sum("gone").alias("gone"),
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    parts = [
        shape.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "gone"))),
        totals,
        digest(edits),
        conversations.select("conv_id").distinct(),
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    zero = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long")
    return every.groupBy("conv_id").agg(
        *(zero(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")),
        (zero("cost") + DELETE * zero("gone")).cast("long").alias("cost"),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
