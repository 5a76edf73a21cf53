"""Repair of conversation structure by iterative-deepening A*.

A conversation is a row of turns that should read ``(s?(ua)+)?`` by the first
letters of its roles. The cheapest edits that get there are found by a
depth-first search that tries the edits of each turn in ASCII order (Delete,
Insert, Keep, Rerole) under a cost bound. The bound starts at a lower bound of
the cost and rises to the least cost that went over it. A transposition table
holds, for each (turn, role before), the largest budget that is known to fail;
it stays true when the bound rises, so no state is searched twice with the same
budget. The first path that is accepted is the cheapest and, of these, the
least in ASCII order.

No conversation is gathered in one task for the search. Rows are put in order
of (conversation, turn) by a range partitioning, so that a long conversation
lies in many partitions, and cut into pieces of at most ``PIECE`` rows. A piece
in the middle of a conversation is searched for every pair of a role before and
a role after it; a fold of the pieces joins these paths. Of two paths of equal
cost between the same states neither is a prefix of the other, so the joined
path is the least one too. The edits of a conversation and the SHA-256 of its
repaired text are one value each and are made in order, row by row, from a
sorted partition, with one row and the edits in memory.

Defined results: a null conv_id is a conversation of its own; null roles and
texts are one space; null turns come first and do not count as gaps; rows of
one turn are ordered by role, then by the SHA-256 of the text; repeated rows are
duplicates; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import column

#: Rows of one search.
PIECE = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Role before a place: none yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: What may follow each of them, and the role that an inserted or changed turn gets there.
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
ACCEPTED = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
#: Fault of a row: none, last sign missing, or one that must be deleted.
SOUND, CUT, BLANK, DUPLICATE = range(4)


def lower_bounds(initials: str, faults: list[int]) -> list[dict[int, int]]:
    """Least cost from each place on, for each role before it: three for each
    row that must go, one for each truncated row, one for each illegal
    neighbourhood of the others (an edit costs two and mends two at most).
    What follows the last row is left open, which keeps it a lower bound."""
    n = len(initials)
    out: list[dict[int, int]] = [dict.fromkeys(STATES, 0)] * (n + 1)
    base, after = 0, ""      # cost of the rows behind, initial of the first one that can stay
    for i in range(n - 1, -1, -1):
        if faults[i] >= BLANK:
            base += DELETE
        else:
            base += (after != "" and initials[i] + after not in LEGAL) + TRUNCATED * (faults[i] == CUT)
            after = initials[i]
        out[i] = {s: base + (after != "" and after not in FOLLOWS[s]) for s in STATES}
    return out


class Search:
    """Searches over the rows of one piece; those for the same ends share a table."""

    def __init__(self, initials: str, faults: list[int]):
        self.initials, self.faults = initials, faults
        self.least = lower_bounds(initials, faults)
        self.failed: dict[tuple, dict] = {}

    def moves(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: letter, cost, next row, next state."""
        n = len(self.initials)
        if i < n:
            yield "D", DELETE, i + 1, state
        turn = NEXT[state][0]
        yield "I", INSERT, i, turn
        if i < n and self.faults[i] < BLANK:
            extra = TRUNCATED * (self.faults[i] == CUT)
            kept = FOLLOWS[state].get(self.initials[i])
            if kept is not None:
                yield "K", KEEP + extra, i + 1, kept
            yield "R", REROLE + extra, i + 1, turn

    def best(self, start: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
        """Cost, edits and last state of the cheapest path, the ASCII-least of these."""
        failed = self.failed.setdefault(ends, {})
        bound = self.least[0][start]
        while True:
            found, bound = self._within(start, ends, bound, failed)
            if found is not None:
                return bound, *found

    def _within(self, start, ends, bound, failed):
        """Path of cost ``bound`` at most, or the least cost above it."""
        n, over = len(self.initials), None
        path, stack = [], [(0, start, bound, self.moves(0, start))]
        while stack:
            i, state, left, moves = stack[-1]
            if i == n and state in ends:
                return ("".join(path), state), bound - left
            for letter, cost, j, to in moves:
                rest = left - cost
                need = max(self.least[j][to], failed.get((j, to), -1) + 1)
                if need > rest:
                    over = need - rest if over is None else min(over, need - rest)
                    continue
                path.append(letter)
                stack.append((j, to, rest, self.moves(j, to)))
                break
            else:
                failed[i, state] = max(left, failed.get((i, state), -1))
                stack.pop()
                if path:
                    path.pop()
        return None, bound + over


def cheapest(initials: str, faults: list[int]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    cost, audit, _ = Search(initials, faults).best(START, ACCEPTED)
    return cost, audit


# ---------------------------------------------------------------- damage and faults, as columns

def _written(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows with faults planted by
    crc32 of ``conv_id:turn``."""
    h = F.crc32(F.concat(_written("conv_id"), F.lit(":"), _written("turn"))) % 20
    text = (F.when(F.col("__h") == 1, "").when(F.col("__h") == 2, F.translate(_written("text"), ".!?", ""))
            .otherwise(_written("text")))
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("__h", h).where("__h <> 0")
            .select("conv_id", "turn", F.when(F.col("__h") == 4, "user").otherwise(_written("role")).alias("role"),
                    text.alias("text"), F.when(F.col("__h") == 3, 2).otherwise(1).cast("long").alias("copies")))


SPACES = " \t\n\x0b\x0c\r"


def turns(rows: DataFrame) -> DataFrame:
    """One row for each different (conversation, turn, role, text), without
    the text: digest, copies, fault of the first copy. Any group of equal
    rows is added up before it is sent."""
    bare = F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1)))
    faults = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*".!?"), CUT).otherwise(SOUND)
    each = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), faults.alias("fault"), "copies")
    one = each.groupBy("conv_id", "turn", "role", "digest").agg(F.first("fault").alias("fault"), F.sum("copies").alias("copies"))
    # A text's first turn: nulls first, as a struct's comparison has it.
    first = one.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn")).alias("first"))
    same = (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    late = (F.col("fault") != BLANK) & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return one.join(first, same).select("conv_id", "turn", "role", "digest", "copies",
                                        F.when(late, DUPLICATE).otherwise(F.col("fault")).alias("fault"))


# ---------------------------------------------------------------- pieces and their fold

def piece_paths(initials: str, faults: list[int], whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of the best paths of a piece:
    one for a whole conversation, else one for each pair of states that rows
    can join. Nothing leads back to START or SYSTEM but deletions, and to SYSTEM
    one kept system turn (the last of the cheapest, as D comes before K), so
    these need no search."""
    search, n = Search(initials, faults), len(initials)
    if whole:
        cost, audit, end = search.best(START, ACCEPTED)
        return [(START, end, cost, audit)]
    out = [(s, s, DELETE * n, "D" * n) for s in (START, SYSTEM)]
    system = [(faults[i] == CUT, -i) for i in range(n) if initials[i] == "s" and faults[i] < BLANK]
    if system:
        cut, i = min(system)
        out.append((START, SYSTEM, DELETE * (n - 1) + TRUNCATED * cut, "D" * -i + "K" + "D" * (n - 1 + i)))
    for end in (USER, ASSISTANT):
        out += [(s, end, *search.best(s, (end,))[:2]) for s in STATES]
    return out


PIECE_TAIL = ("piece long, lo {turn}, hi {turn}, turns long, first string, last string, blank long, duplicate long, "
              "truncated long, illegal long, starts array<int>, ends array<int>, costs array<long>, audits array<string>")
_TAIL = [pa.int64(), None, None, pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4, pa.list_(pa.int32()),
         pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]


def _rows(batches: Iterator[pa.RecordBatch], cols: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column(batch, c).to_pylist() for c in cols))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _cut_pieces(ids: pa.DataType, order: pa.DataType):
    """Sorted rows of a partition -> its pieces, with the paths through each."""
    names = ["conv_id", "turn", "role", "digest", *(c.split()[0] for c in PIECE_TAIL.split(", "))]
    types = [ids, order, pa.string(), pa.binary(), *(t or order for t in _TAIL)]

    def piece(key, rows, number, whole):
        initials = [r[1][:1] for r in rows]
        faults = [r[2] for r in rows]
        seen = [r[0] for r in rows if r[0] is not None]
        # An empty role has no initial and follows nothing.
        paths = piece_paths("".join(x or "-" for x in initials), faults, whole)
        return (*key, number, seen[0] if seen else None, seen[-1] if seen else None, len(set(seen)),
                initials[0], initials[-1], *(faults.count(x) for x in (BLANK, DUPLICATE, CUT)),
                sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), *map(list, list(zip(*((s, e, c, a) for s, e, c, a in paths)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, key, number, first = [], [], None, 0, True
        now = object()
        for conv, turn, role, digest, copies, fault in _rows(batches, ["conv_id", "turn", "role", "digest", "copies", "fault"]):
            if conv != now and held:
                # Neither the first nor the last conversation of a partition, so all of it is here.
                out.append(piece(key, held, number, whole=number == 0 and not first))
                held, number, first = [], 0, False
            now = conv
            for k in range(copies):
                if len(held) == PIECE:
                    out.append(piece(key, held, number, whole=False))
                    held, number = [], number + 1
                if not held:
                    key = (conv, turn, role, digest)
                held.append((turn, role, fault if k == 0 or fault == BLANK else DUPLICATE))
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        if held:
            out.append(piece(key, held, number, whole=False))
        if out:
            yield _batch(out, names, types)

    return run


def _text(node: tuple | None, until: tuple | None = None) -> str:
    parts = []
    while node is not until:
        parts.append(node[1])
        node = node[0]
    return "".join(reversed(parts))


def _earlier(a: tuple, b: tuple) -> bool:
    """Whether the edits of ``a`` come before those of ``b``: compared from
    where the two paths part."""
    x, y = a, b
    while x is not y:
        x, y = x[0], y[0]
    return _text(a, x) < _text(b, x)


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Fold:
    """The pieces of a conversation, joined one after another."""

    def __init__(self):
        self.paths: dict[int, tuple[int, tuple | None]] = {START: (0, None)}
        self.counts = [0, 0, 0, 0]
        self.lo = self.hi = self.last = None
        self.turns = 0

    def add(self, lo, hi, turns, first, last, counts, paths) -> None:
        new: dict[int, tuple[int, tuple | None]] = {}
        for start, end, cost, audit in paths:
            if start not in self.paths:
                continue
            total, node = self.paths[start][0] + cost, (self.paths[start][1], audit)
            best = new.get(end)
            if best is None or total < best[0] or total == best[0] and _earlier(node, best[1]):
                new[end] = (total, node)
        self.paths = new
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        self.counts[3] += self.last is not None and self.last + first not in LEGAL
        self.last = last
        if lo is not None:
            self.turns += turns - (lo == self.hi)
            self.lo, self.hi = (lo if self.lo is None else self.lo), hi

    def row(self) -> tuple:
        best = None
        for state in ACCEPTED:
            if state in self.paths:
                got = self.paths[state]
                if best is None or got[0] < best[0] or got[0] == best[0] and _earlier(got[1], best[1]):
                    best = got
        gaps = 0 if self.lo is None else int(self.hi - self.lo + 1 - self.turns)
        return (gaps, *self.counts, best[0], _text(best[1]))


def _join_pieces(ids: pa.DataType):
    names = ["conv_id", *(c.split()[0] for c in FOUND.split(", "))]
    types = [ids, *[pa.int64()] * 6, pa.string()]
    cols = ["conv_id", "lo", "hi", "turns", "first", "last", "blank", "duplicate", "truncated", "illegal",
            "starts", "ends", "costs", "audits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, fold = [], None, None
        for conv, lo, hi, count, first, last, blank, dup, cut, illegal, *paths in _rows(batches, cols):
            if fold is None or conv != now:
                if fold is not None:
                    out.append((now, *fold.row()))
                now, fold = conv, _Fold()
            fold.add(lo, hi, count, first, last, (blank, dup, cut, illegal), zip(*paths))
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        if fold is not None:
            out.append((now, *fold.row()))
        if out:
            yield _batch(out, names, types)

    return run


def edits(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: gaps, blank, duplicate,
    truncated, illegal, cost and audit of its damaged rows."""
    from pyspark.sql.pandas.types import to_arrow_type

    one = turns(damaged(conversations))
    kinds = {f.name: f.dataType for f in one.schema.fields}
    ids, order = to_arrow_type(kinds["conv_id"]), to_arrow_type(kinds["turn"])
    key = f"conv_id {kinds['conv_id'].simpleString()}, turn {kinds['turn'].simpleString()}, role string, digest binary, "
    by = ["conv_id", "turn", "role", "digest"]
    pieces = (one.repartitionByRange(*by).sortWithinPartitions(*by)
              .mapInArrow(_cut_pieces(ids, order), key + PIECE_TAIL.format(turn=kinds["turn"].simpleString())))
    found = (pieces.repartition("conv_id").sortWithinPartitions(*by, "piece")
             .mapInArrow(_join_pieces(ids), f"conv_id {kinds['conv_id'].simpleString()}, {FOUND}")
             .withColumnRenamed("conv_id", "__found"))
    every = conversations.select("conv_id").distinct()
    zeros = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in found.columns[1:-1]]
    return (every.join(found, F.col("conv_id").eqNullSafe(F.col("__found")), "left")
            .select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit")))


# ---------------------------------------------------------------- the repaired rows

HEAD = [c.split()[0] for c in FOUND.split(", ")]


def _in_order(conversations: DataFrame) -> DataFrame:
    """Each conversation's row of edits, then its damaged rows."""
    found, rows = edits(conversations), damaged(conversations)
    both = found.withColumn("kind", F.lit(0)).unionByName(
        rows.select("conv_id", "turn", "role", "text", "copies", F.unhex(F.sha2("text", 256)).alias("digest"),
                    F.lit(1).alias("kind")), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, None, None, None) where a conversation begins, then
    (head, edit, role, text) for each of its repaired turns."""
    head, at, state = None, 0, START

    def inserted():
        nonlocal at, state
        while head is not None and head[-1][at:at + 1] == "I":
            at += 1
            state, role = NEXT[state]
            yield head, "I", role, ""

    for row in _rows(batches, ["conv_id", "kind", "role", "text", "copies", *HEAD]):
        conv, kind, role, text, copies = row[:5]
        if kind == 0:
            yield from inserted()
            head, at, state = (conv, *row[5:]), 0, START
            yield head, None, None, None
            continue
        for _ in range(copies):
            yield from inserted()
            edit = head[-1][at]
            at += 1
            if edit == "K":
                state = FOLLOWS[state][role[:1]]
                yield head, edit, role, text
            elif edit == "R":
                state, new = NEXT[state]
                yield head, edit, new, text
    yield from inserted()


def _digests(ids: pa.DataType):
    names, types = ["conv_id", *HEAD, "repaired_sha256"], [ids, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, sha, empty = [], None, None, True
        for head, edit, role, text in _replay(batches):
            if edit is None:
                if now is not None:
                    out.append((*now, sha.hexdigest()))
                now, sha, empty = head, hashlib.sha256(), True
                if len(out) >= 1000:
                    yield _batch(out, names, types)
                    out = []
                continue
            sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        if now is not None:
            out.append((*now, sha.hexdigest()))
        if out:
            yield _batch(out, names, types)

    return run


def _turn_rows(ids: pa.DataType):
    names, types = ["conv_id", "position", "edit", "role", "text"], [ids, pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for head, edit, role, text in _replay(batches):
            if edit is None:
                place = 0
                continue
            out.append((head[0], place, edit, role, text))
            place, size = place + 1, size + len(text)
            if len(out) >= 1000 or size > 1 << 22:
                yield _batch(out, names, types)
                out, size = [], 0
        if out:
            yield _batch(out, names, types)

    return run


def _id_types(conversations: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = conversations.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0), edit (K, R or I), role, text of every
    repaired conversation; those without a turn left have no rows."""
    name, ids = _id_types(conversations)
    return _in_order(conversations).mapInArrow(
        _turn_rows(ids), f"conv_id {name}, position long, edit string, role string, text string")


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Faults, cost, edits and the SHA-256 of the repaired text of every conversation."""
    name, ids = _id_types(conversations)
    return _in_order(conversations).mapInArrow(_digests(ids), f"conv_id {name}, {FOUND}, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every conversation."""
    return repair_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
