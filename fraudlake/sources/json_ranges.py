"""One huge JSON object read as rows by many tasks, whatever its values hold.

Spark deals the file out by byte ranges, cut at commas. Where a range starts is unknown at first:
in a text or outside, and how deep. So each range is read from both possible states, which gives
a map from the state it starts in to the one it leaves; the maps, one per range, are composed in
file order and tell every range's true start. Then the ranges are read once more and give their
pairs; what a border cuts is put together from the pieces on either side.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPE = re.compile(r"\\.", re.S)
_BRACKETS = re.compile(r"[{}\[\]]")
_OPEN = "{["


def _quotes(fragment: str) -> list[str]:
    """The stretches of a fragment between its quotes; every other one is text."""
    return (_ESCAPE.sub("  ", fragment) if "\\" in fragment else fragment).split('"')


@dataclass
class _Cursor:
    """Reads fragments in order; ``pairs`` are complete, ``piece`` is the one begun.

    ``inside``: within the object whose pairs are wanted (None: not known yet). ``cut``: the piece
    began before this range, ``head`` is what of it lies in here, once it has ended.
    """
    level: int
    prefix: str | None
    text: bool = False
    depth: int = 0
    inside: bool | None = False
    cut: bool = False
    head: str | None = None
    pairs: list[str] = field(default_factory=list)
    piece: list[str] = field(default_factory=list)
    last: str | None = None  # the last whole text of the level above

    def _end(self) -> None:
        done, self.piece = "".join(self.piece), []
        if self.cut:
            self.head, self.cut = done, False
        elif done.strip():
            self.pairs.append(done)

    def read(self, fragment: str) -> None:
        parts = _quotes(fragment)
        plain = parts[self.text :: 2]
        if self.depth >= self.level and not any(map(_BRACKETS.search, plain)):
            if self.inside is not False:
                self.piece.append(fragment)
        else:
            at, kept = 0, 0
            for i, part in enumerate(parts):
                if (i % 2 == 1) != self.text:  # a text; whole if both quotes are in this fragment
                    self.last = fragment[at : at + len(part)] if 0 < i < len(parts) - 1 else None
                else:
                    for m in _BRACKETS.finditer(part):
                        spot = at + m.start()
                        if m[0] in _OPEN:
                            self.depth += 1
                            if self.depth == self.level:
                                self.inside = m[0] == "{" and (self.prefix is None or self.last == self.prefix)
                                kept = spot + 1
                        else:
                            if self.depth == self.level:
                                if self.inside is not False:
                                    self.piece.append(fragment[kept:spot])
                                    self._end()
                                self.inside = False
                            self.depth -= 1
                at += len(part) + 1
            if self.depth >= self.level and self.inside is not False:
                self.piece.append(fragment[kept:])
        self.text ^= len(parts) % 2 == 0
        if not self.text and self.depth == self.level and self.inside is not False:
            self._end()
        elif self.depth >= self.level and self.inside is not False:
            self.piece.append(",")


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    frags = spark.read.option("lineSep", ",").text(path)
    return frags.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), "value")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, start, fragments) of each range of a task, in order."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    for (name, start), own in itertools.groupby(rows(), key=lambda r: r[:2]):
        yield name, start, (r[2] for r in own)


def _state_maps(frags: DataFrame) -> dict[str, list[tuple]]:
    """By file and in order: (start, [(in a text at the end, change of depth) from outside, from in a text])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, start, own in _ranges(batches):
            state, change = [False, True], [0, 0]
            for fragment in own:
                parts = _quotes(fragment)
                if len(parts) == 1 and not _BRACKETS.search(fragment):
                    continue
                count = [sum((p.count("{") + p.count("[") - p.count("}") - p.count("]")) for p in parts[k::2]) for k in (0, 1)]
                for k in (0, 1):
                    change[k] += count[int(state[k])]
                    state[k] ^= len(parts) % 2 == 0
            cells = [name, start, state[0], change[0], state[1], change[1]]
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], ["file", "start", "t0", "d0", "t1", "d1"])

    out: dict[str, list[tuple]] = {}
    for r in frags.mapInArrow(run, "file string, start long, t0 boolean, d0 long, t1 boolean, d1 long").collect():  # one row a range
        out.setdefault(r["file"], []).append((r["start"], [(r["t0"], r["d0"]), (r["t1"], r["d1"])]))
    return {f: sorted(v) for f, v in out.items()}


def _value(raw: str) -> str | None:
    """A JSON value as text: texts plain, null as None, numbers as written, objects compact."""
    v = json.loads(raw, parse_float=str, parse_int=str)
    if v is None or isinstance(v, str):
        return v
    return json.dumps(json.loads(raw), separators=(",", ":"), ensure_ascii=False)


_PAIR = re.compile(r'\s*("(?:[^"\\]|\\.)*")\s*:\s*(.*\S)\s*', re.S)


def parse_pair(pair: str) -> tuple[str, str | None]:
    m = _PAIR.fullmatch(pair)
    if m is None:
        raise ValueError(f"not a pair of a JSON object: {pair[:200]}")
    return json.loads(m[1]), _value(m[2])


def read_json_ranges(spark: SparkSession, path: str, key_name: str, value_name: str, prefix: str | None = None) -> DataFrame:
    """``(key, value)`` of the pairs of the object in each file, or of the object under ``prefix``.

    Any text may hold commas, quotes and brackets; values that are objects come as compact JSON.
    No task holds more than its range and the longest pair. One row per range comes to the driver.
    """
    if prefix is not None and "," in prefix:
        raise ValueError("a prefix with a comma is read by the whole-file path")
    level = 1 if prefix is None else 2
    frags = _fragments(spark, path)
    starts: dict[tuple[str, int], tuple] = {}
    for name, maps in _state_maps(frags).items():
        text, depth = False, 0
        for start, both in maps:
            starts[name, start] = (text, depth, start != maps[0][0])  # nothing precedes the first range
            text, change = both[int(text)]
            depth += change

    def cursor(at: tuple, inside: bool | None) -> _Cursor:
        text, depth, cut = at
        return _Cursor(level, prefix, text, depth, inside if depth >= level else False, cut=cut)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each range leaves: whether inside (null: as it found it), and whether a pair ended in it."""
        for name, start, own in _ranges(batches):
            c = cursor(starts[name, start], None)
            for fragment in own:
                c.read(fragment)
                c.pairs.clear()
            cells = [pa.array([name]), pa.array([start]), pa.array([c.inside], pa.bool_()), pa.array([not c.cut])]
            yield pa.RecordBatch.from_arrays(cells, ["file", "start", "inside", "ended"])

    known: dict[tuple[str, int], tuple] = {}
    rows = frags.mapInArrow(follow, "file string, start long, inside boolean, ended boolean").collect()  # one row a range
    inside, chain, before = False, 0, None
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        at = (r["file"], r["start"])
        if r["file"] != before:
            inside, chain, before = False, at[1], r["file"]
        known[at] = (inside, chain)
        if r["inside"] is not None:
            inside = r["inside"]
        if r["ended"]:
            chain = at[1]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole pairs (chain null), and the pieces at the borders with the range that their pair began in."""
        def out(name, start, chain, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([x] * n, t) for x, t in ((name, pa.string()), (start, pa.int64()), (chain, pa.int64()))] + [pa.array(texts, pa.string())], names)

        names = ["file", "start", "chain", "text"]
        for name, start, own in _ranges(batches):
            inside, chain = known[name, start]
            c = cursor(starts[name, start], inside)
            for fragment in own:
                c.read(fragment)
                if len(c.pairs) >= 1000:
                    yield out(name, start, None, c.pairs)
                    c.pairs = []
            yield out(name, start, None, c.pairs)
            rest = "".join(c.piece)
            if c.cut:  # no pair ended here: all of it belongs to one that began before
                yield out(name, start, chain, [rest])
            else:
                yield out(name, start, chain, [c.head or ""])
                yield out(name, start, start, [rest])

    read = frags.mapInArrow(pairs, "file string, start long, chain long, text string")
    whole = read.filter("chain is null").select("text")
    border = read.filter("chain is not null").groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
    border = border.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))  # the pieces of one pair

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parse_pair(t) for t in b.column(0).to_pylist() if t.strip()]
            k, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(v, pa.string())], [key_name, value_name])

    return whole.unionByName(border).mapInArrow(parse, f"`{key_name}` string, `{value_name}` string")
