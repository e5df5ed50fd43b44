"""Repair of conversations: a generalised LR parser over the role grammar with weighted edits."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.storage import cut, mapped

# Rows that one step parses at once. Longer conversations are parsed in pieces.
PIECE_ROWS = 4096

# Role initials: an optional system turn, then pairs of user and assistant.
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# One letter an edit, telling the role too: rerole to user or assistant, insert the same.
REROLED = {"u": "p", "a": "q"}
INSERTED = {"u": "v", "a": "w"}
AUDIT = ("pqvw", "RRII")


class Parser:
    """The LR automaton of a grammar, and what edits can do from each of its stack tops.

    Stacks with equal tops go on alike in this grammar: what lies below a top only tells
    whether a system turn came first. So ``tops`` has one stack for each.
    """

    def __init__(self, grammar=GRAMMAR, start: str = "C"):
        self.rules = grammar
        self.kinds = {left for left, _ in grammar}
        self.states: list[frozenset] = []
        self.goto: list[dict[str, int]] = []
        self._add(self._closed({(i, 0) for i, (left, _) in enumerate(grammar) if left == start}))
        self.start = start
        self.tops: dict[int, tuple[int, ...]] = {0: (0,)}
        queue = [(0,)]
        for stack in queue:
            for x in "sua":
                after = self.shift(stack, x)
                if after and after not in queue:
                    self.tops.setdefault(after[-1], after)
                    queue.append(after)
        self.moves = {top: self._moves(stack) for top, stack in self.tops.items()}
        self.ends = {
            top: min((ins for ins, s in self._inserts(stack) if self.accepts(s)), key=len)
            for top, stack in self.tops.items()
        }

    def _closed(self, items: set) -> frozenset:
        queue = list(items)
        for rule, dot in queue:
            rest = self.rules[rule][1][dot:]
            if rest and rest[0] in self.kinds:
                for i, (left, _) in enumerate(self.rules):
                    if left == rest[0] and (i, 0) not in items:
                        items.add((i, 0))
                        queue.append((i, 0))
        return frozenset(items)

    def _add(self, state: frozenset) -> int:
        if state in self.states:
            return self.states.index(state)
        self.states.append(state)
        self.goto.append({})
        at = len(self.states) - 1
        for x in sorted({self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}):
            moved = {(r, d + 1) for r, d in state if self.rules[r][1][d : d + 1] == x}
            self.goto[at][x] = self._add(self._closed(moved))
        return at

    def shift(self, stack: tuple[int, ...], x: str) -> tuple[int, ...] | None:
        """The stack after ``x``, reduced as far as that needs no look at what follows."""
        if x not in self.goto[stack[-1]]:
            return None
        stack += (self.goto[stack[-1]][x],)
        while len(self.states[stack[-1]]) == 1:
            ((rule, dot),) = self.states[stack[-1]]
            left, right = self.rules[rule]
            if dot < len(right):
                break
            stack = stack[: len(stack) - dot]
            stack += (self.goto[stack[-1]][left],)
        return stack

    def accepts(self, stack: tuple[int, ...]) -> bool:
        return any(
            self.rules[rule][0] == self.start and dot == len(self.rules[rule][1])
            for rule, dot in self.states[stack[-1]]
        )

    def _inserts(self, stack: tuple[int, ...]) -> list[tuple[str, tuple[int, ...]]]:
        """Stacks that inserted turns lead to, each with the fewest of them."""
        found = [("", stack)]
        for ins, s in found:
            for x in ROLES:
                after = self.shift(s, x)
                if after and all(after[-1] != f[-1] for _, f in found):
                    found.append((ins + x, after))
        return found

    def _moves(self, stack: tuple[int, ...]) -> list[tuple[str, str, int]]:
        """(inserted turns, turn taken, top after both), the fewest inserts for each pair."""
        best: dict[tuple[str, int], str] = {}
        for ins, s in self._inserts(stack):
            for x in "sua":
                after = self.shift(s, x)
                if after:
                    best.setdefault((x, after[-1]), ins)
        return [(ins, x, top) for (x, top), ins in best.items()]


@functools.cache
def parser() -> Parser:
    return Parser()


@dataclass(slots=True)
class Top:
    """A stack top of the graph: its cheapest way there.

    ``rank`` orders tops by their audits. Every way up to a row has one letter a row that is
    not an insert and ends in one, so no audit is the start of another; their order is known
    from the order of the ways they extend and the letters added.
    """

    cost: int
    rank: int
    last: tuple | None


def advance(live: dict[int, Top], initial: str, must_go: bool, truncated: bool) -> dict[int, Top]:
    """All tops after one row; ways that meet in a top leave the least (cost, audit)."""
    moves = parser().moves
    best: dict[int, tuple] = {}

    def offer(top, cost, rank, audit, plan, last):
        if top not in best or (cost, rank, audit) < best[top][:3]:
            best[top] = (cost, rank, audit, plan, last)

    for top, way in live.items():
        offer(top, way.cost + DELETE, way.rank, "D", "D", way.last)
        if must_go:
            continue
        for ins, x, after in moves[top]:
            cost = way.cost + INSERT * len(ins) + TRUNCATED * truncated
            audit, plan = "I" * len(ins), "".join(INSERTED[i] for i in ins)
            if x == initial:
                offer(after, cost, way.rank, audit + "K", plan + "K", way.last)
            elif x in REROLED:
                offer(after, cost + REROLE, way.rank, audit + "R", plan + REROLED[x], way.last)
    order = {top: i for i, top in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
    return {
        top: Top(cost, order[top], (last, plan)) for top, (cost, _, _, plan, last) in best.items()
    }


def plan_of(way: Top) -> str:
    parts, at = [], way.last
    while at is not None:
        at, part = at
        parts.append(part)
    return "".join(reversed(parts))


def parse(rows: Iterable[tuple[str, bool, bool]], entry: int) -> list[tuple[int, int, str]]:
    """From one top through rows of (initial, must go, truncated): (top, cost, edits)."""
    live = {entry: Top(0, 0, None)}
    for row in rows:
        live = advance(live, *row)
    return [(top, way.cost, plan_of(way)) for top, way in live.items()]


def audit(plan: str) -> str:
    return plan.translate(str.maketrans(*AUDIT))


_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("top", pa.int32()),
        ("cost", pa.int64()), ("plan", pa.string()), ("illegal", pa.int64()),
        ("head", pa.string()), ("tail", pa.string()),
    ]
)
PIECES = (
    "conv_id bigint, piece bigint, entry int, top int, cost bigint, plan string, illegal bigint, "
    "head string, tail string"
)
LEGAL = {"su", "ua", "au"}


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order, in each partition. The first piece there may go on from another
    partition and pieces after a full one go on too, so they are parsed from every top.

    A piece's ids have no gap: where ids jump within a conversation, another piece begins."""
    conv, piece, rows, fresh = None, None, [], False

    def ended():
        illegal = sum(a[0] + b[0] not in LEGAL for a, b in zip(rows, rows[1:]))
        out = [
            (conv, piece, entry, top, cost, plan, illegal, rows[0][0], rows[-1][0])
            for entry in ([0] if fresh else parser().tops)
            for top, cost, plan in parse(rows, entry)
        ]
        return pa.record_batch([list(c) for c in zip(*out)], schema=_PIECES)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "row_id", "initial", "must_go", "truncated"))
        for c, row_id, *row in zip(*columns):
            if rows and (c != conv or len(rows) == most or row_id != piece + len(rows)):
                yield ended()
                fresh, rows = c != conv, []
            if not rows:
                conv, piece = c, row_id
            rows.append(row)
    if rows:
        yield ended()


_CHOSEN = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("top", pa.int32()),
        ("tail", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()),
    ]
)
CHOSEN = "conv_id bigint, piece bigint, entry int, top int, tail string, cost bigint, illegal bigint"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation come in order; of each only its choices are remembered.

    Cost and illegal neighbours of the whole are on the row of its last piece, else 0.
    """
    conv, started = None, False
    live: dict[int, tuple[int, int]] = {}
    steps: list[tuple[int, dict[int, int]]] = []
    illegal, last = 0, ""
    here: list = []

    def joined():
        """Take in the piece in ``here``: the least (cost, audit) for each top."""
        nonlocal live, illegal, last
        best: dict[int, tuple] = {}
        for _, _, entry, top, cost, plan, _, _, _ in here:
            if entry in live:
                way = (live[entry][0] + cost, live[entry][1], audit(plan), entry)
                if top not in best or way < best[top]:
                    best[top] = way
        order = {top: i for i, top in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
        live = {top: (way[0], order[top]) for top, way in best.items()}
        illegal += here[0][6] + (bool(steps) and last + here[0][7] not in LEGAL)
        last = here[0][8]
        steps.append((here[0][1], {top: way[3] for top, way in best.items()}))

    def ended():
        ends = parser().ends
        top = min(live, key=lambda t: (live[t][0] + INSERT * len(ends[t]), live[t][1]))
        tail = "".join(INSERTED[x] for x in ends[top])
        cost, out = live[top][0] + INSERT * len(ends[top]), []
        for piece, entries in reversed(steps):
            out.append((conv, piece, entries[top], top, tail, cost, illegal))
            top, tail, cost = entries[top], "", 0
        for k in range(1, len(out)):
            out[k] = (*out[k][:6], 0)
        for at in range(0, len(out), 4096):
            yield pa.record_batch([list(c) for c in zip(*out[at : at + 4096])], schema=_CHOSEN)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _PIECES.names)):
            if here and row[:2] != here[0][:2]:
                joined()
                here = []
                if row[0] != conv:
                    yield from ended()
                    started = False
            if not started:
                conv, live, steps, illegal, last, started = row[0], {0: (0, 0)}, [], 0, "", True
            here.append(row)
    if here:
        joined()
        yield from ended()


def blank(text: Column) -> Column:
    return ~text.rlike("[^\\x20\\x09-\\x0D]")


def cut_short(text: Column) -> Column:
    """Whether the last character that is not white space ends no sentence."""
    return ~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z")


@dataclass
class Repair:
    """What a repair found and made.

    ``summary``: one row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit. ``turns``: the repaired rows: conv_id, row_id and at (their order), role, text.
    """

    summary: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> Repair:
    """Repair conversations of rows (conv_id, turn, role, text) to ``(s?(ua)+)?`` roles.

    Rows go by turn (nulls first; ties by role and text). A row's first fault counts: blank,
    duplicate (role and text seen earlier in its conversation), truncated (ends no sentence).
    Edits: keep 0, rerole to user or assistant 2, delete 3 (blank and duplicate rows have to
    go), insert an empty turn 2; a truncated row that stays costs 1. Of the cheapest edits
    those of the least audit (initials K, R, D, I) win. ``gaps`` are missing turn numbers,
    ``illegal`` counts neighbours whose role initials are not su, ua or au.

    A generalised LR parser takes row by row; its graph-structured stack keeps the cheapest
    way for each top. Rows are dealt to tasks by ranges of (conv_id, turn, ...), so one
    conversation of a third of all rows lies in many tasks. Each parses pieces of at most
    ``piece_rows`` rows from every top they can start at; pieces are then joined in order by
    their tops, one row of choices a piece.

    Null role or text counts as one space; null conv_id is a conversation of its own. A role
    without first character fits nowhere. Repeated rows are duplicates. Extra columns are not
    read. No rows give no conversations.
    """
    space = F.lit(" ")
    ordered = (
        rows.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", space).alias("role"),
            F.coalesce("text", space).alias("text"),
        )
        .withColumn("head", F.substring("text", 1, 64))
        .repartitionByRange("conv_id", "turn", "role", "head")
        .sortWithinPartitions("conv_id", "turn", "role", "head", "text")
        .drop("head")
        .withColumn("row_id", F.monotonically_increasing_id())
    )
    ordered = cut(ordered)
    # The first of equal rows; its id is a key of its own, however many copies it has.
    firsts = (
        ordered.filter(~blank(F.col("text")))
        .groupBy("conv_id", "role", F.sha2("text", 256).alias("digest"))
        .agg(F.min("row_id").alias("row_id"))
        .select("row_id", F.lit(True).alias("new"))
    )
    judged = (
        ordered.select(
            "row_id",
            "conv_id",
            "turn",
            F.substring("role", 1, 1).alias("initial"),
            blank(F.col("text")).alias("blank"),
            cut_short(F.col("text")).alias("short"),
        )
        .join(firsts, "row_id", "left")
        .withColumn("duplicate", ~F.col("blank") & F.col("new").isNull())
        .withColumn("must_go", F.col("blank") | F.col("duplicate"))
        .withColumn("truncated", ~F.col("must_go") & F.col("short"))
        .select("row_id", "conv_id", "turn", "initial", "blank", "duplicate", "must_go", "truncated")
    )
    judged = cut(judged)
    dealt = judged.repartitionByRange("row_id").sortWithinPartitions("row_id")
    taken = dealt.select("conv_id", "row_id", "initial", "must_go", "truncated")
    pieces = cut(mapped(taken, functools.partial(_pieces, most=piece_rows), PIECES))
    in_order = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "entry")
    chosen = cut(
        mapped(in_order, _choose, CHOSEN)
        .join(pieces.select("piece", "entry", "top", "plan"), ["piece", "entry", "top"])
        .select("conv_id", "piece", "cost", "illegal", F.concat("plan", "tail").alias("plan"))
    )

    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    # Distinct turns first, so that no task holds those of a whole conversation.
    turns = judged.groupBy("conv_id", "turn").agg(count("blank"), count("duplicate"), count("truncated"))
    faults = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        count("blank"), count("duplicate"), count("truncated"),
    )
    edits = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.translate(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "plan"))), lambda x: x["plan"]), ""),
            *AUDIT,
        ).alias("audit"),
    )
    same = F.equal_null(F.col("f.conv_id"), F.col("e.conv_id"))
    summary = faults.alias("f").join(edits.alias("e"), same).select("f.*", "illegal", "cost", "audit")

    steps = chosen.select(
        "piece", F.posexplode(F.regexp_extract_all("plan", F.lit("[vw]*[KDpq](?:[vw]+\\z)?"), F.lit(0))).alias("k", "step")
    )
    # A piece's rows have consecutive ids from its first on.
    steps = steps.select((F.col("piece") + F.col("k")).alias("row_id"), "step")
    letters = F.filter(F.split("step", ""), lambda x: (x != "") & (x != "D"))
    made = F.transform(
        letters,
        lambda x: F.struct(
            F.when(x.isin("p", "v"), ROLES["u"]).when(x.isin("q", "w"), ROLES["a"]).otherwise(F.col("role")).alias("role"),
            F.when(x.isin("v", "w"), "").otherwise(F.col("text")).alias("text"),
        ),
    )
    repaired = (
        ordered.join(steps, "row_id")
        .select("conv_id", "row_id", F.posexplode(made).alias("at", "turn"))
        .select("conv_id", "row_id", "at", "turn.role", "turn.text")
    )
    return Repair(summary, repaired)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state = None, None
    for batch in batches:
        done = []
        for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if state is None or c != conv:
                if state is not None:
                    done.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256(line)
            else:
                state.update(b"\n" + line)
        if done:
            yield pa.record_batch([list(x) for x in zip(*done)], schema=_DIGEST)
    if state is not None:
        yield pa.record_batch([[conv], [state.hexdigest()]], schema=_DIGEST)


def text_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines: (conv_id, sha256).

    A digest takes its lines one by one, so a conversation's go through one task; they are
    sorted on disk and read as a stream, and nothing of them is held.
    """
    order = ["conv_id", "row_id", "at"]
    dealt = turns.repartition("conv_id").sortWithinPartitions(*order)
    return mapped(dealt.select("conv_id", "role", "text"), _digests, "conv_id bigint, sha256 string")
