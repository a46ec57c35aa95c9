"""Repair of conversations at the least cost, by Hirschberg's divide and conquer.

A conversation is valid if its roles spell ``(s?(ua)+)?``.  Read from the left it is in one of four states: at the start, after
the system turn, after a user or after an assistant turn.  Every row takes the state on by an edit; insertions take it on between rows.  In
each state only one of user and assistant can follow, so the state and the edits' initials say all.

The cheapest edits are found without a table of all rows and states.  Over a run of rows goes a vector of four costs and, of equal
use, the order of the four cheapest paths by their initials: paths that end at the same row in different states are never
equal and none begins another, so that order is carried on with the costs.  The forward vector of the left half and the backward vector of
the right half meet in the middle; of the states with the least sum the one whose path comes first is crossed, and both halves are
solved alike between their fixed ends.

A run of ``PIECE`` rows is a task's unit.  Its map from entry to exit states is a 4 x 4 matrix, computed without the other runs;
the matrices of a conversation are chained, which fixes the states between its runs, then each run is solved by itself.  So a conversation of any
length is spread over tasks, except for the digest of its repaired text: a digest over one text has to be streamed
in order, which one task does with one batch in memory.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import pieces_of
from stokesweave.session import Stages

PIECE = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = "sua"  # other roles have initial ``o``: they can only be changed or deleted
ENTERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the one of user and assistant that may come next
MAY_KEEP = {("s", START), *((i, s) for s, t in FOLLOWS.items() for i in "ua" if ENTERS[i] == t)}
RIGHT_PAIRS = {"su", "ua", "au"}
FAULTS = "-bdt"  # none, blank, duplicate, truncated
RANK_BITS = 2
FAR = 1 << 60

#: a row is one letter: initial (s, u, a, other) and fault
KINDS = {(i, f): chr(65 + 4 * a + b) for a, i in enumerate("suao") for b, f in enumerate(FAULTS)}
OF_KIND = {k: v for v, k in KINDS.items()}


# --- least-cost paths ------------------------------------------------------------


@lru_cache(None)
def _steps(kind: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest way over a row from state to state: cost and initials, insertions before the row included."""
    initial, fault = OF_KIND[kind]
    kept = 5 if fault == "t" else 0
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for entry in STATES:
        state = entry
        for inserts in range(3):  # a third insertion would come back to a state that was left
            ways = [(state, 2, "D")]
            if fault not in "bd":
                ways.append((FOLLOWS[state], 1 + kept, "R"))
                if (initial, state) in MAY_KEEP:
                    ways.append((ENTERS[initial], kept, "K"))
            for to, cost, letter in ways:
                way = (5 * inserts + cost, "I" * inserts + letter)
                if way < out.get((entry, to), (FAR, "")):
                    out[entry, to] = way
            state = FOLLOWS[state]
    return out


#: insertions after the last row that lead to a valid end
ENDING = {START: (0, ""), ASSISTANT: (0, ""), USER: (5, "I"), SYSTEM: (10, "II")}


def _advance(costs: list[int], order: list[int], kind: str) -> tuple[list[int], list[int]]:
    """Costs and order of the four paths after one more row.  ``order`` counts from 0 in the order of initials."""
    best: list[tuple] = [(FAR,)] * 4
    for (s, t), (cost, word) in _steps(kind).items():
        if costs[s] < FAR:
            way = (costs[s] + cost, order[s], word)
            if way < best[t]:
                best[t] = way
    ranked = sorted((w[1:], t) for t, w in enumerate(best) if w[0] < FAR)
    place = [3] * 4
    for k, (_, t) in enumerate(ranked):
        place[t] = k
    return [w[0] for w in best], place


def forward(kinds: str, entry: int) -> tuple[list[int], list[int]]:
    """Least cost from ``entry`` to every state over the rows, and the order of those paths by their initials."""
    costs, order = [FAR] * 4, [0] * 4
    costs[entry] = 0
    for kind in kinds:
        costs, order = _advance(costs, order, kind)
    return costs, order


def backward(kinds: str, ends: list[int]) -> list[int]:
    """Least cost from every state over the rows, when ending in state t costs ``ends[t]`` more."""
    for kind in reversed(kinds):
        before = [FAR] * 4
        for (s, t), (cost, _) in _steps(kind).items():
            before[s] = min(before[s], cost + ends[t])
        ends = before
    return ends


def crossing(costs: list[int], order: list[int], rest: list[int]) -> int:
    """Of the states with the least sum, the one whose path comes first."""
    return min(STATES, key=lambda s: (costs[s] + rest[s], order[s]))


def between(kinds: str, entry: int, exit_: int) -> str:
    """Initials of the cheapest edits over the rows between two states; ASCII-least among equals."""
    if not kinds:
        return ""
    if len(kinds) == 1:
        return _steps(kinds)[entry, exit_][1]
    half = len(kinds) // 2
    ends = [FAR] * 4
    ends[exit_] = 0
    middle = crossing(*forward(kinds[:half], entry), backward(kinds[half:], ends))
    return between(kinds[:half], entry, middle) + between(kinds[half:], middle, exit_)


def matrix(kinds: str) -> list[int]:
    """Cost and order from each entry to each exit, in 16 numbers."""
    return [c << RANK_BITS | o if c < FAR else -1 for entry in STATES for c, o in zip(*forward(kinds, entry))]


def chain(matrices: list[list[int]]) -> tuple[int, list[int]]:
    """Least cost of the whole conversation and the state at every border of its runs, first and last included."""

    def way(m: list[int], s: int, t: int) -> tuple[int, int]:
        return (FAR, 0) if m[4 * s + t] < 0 else (m[4 * s + t] >> RANK_BITS, m[4 * s + t] & (1 << RANK_BITS) - 1)

    fore: list[tuple[list[int], list[int], list[int]]] = [([0, FAR, FAR, FAR], [0] * 4, [])]
    for m in matrices:
        costs, order, _ = fore[-1]
        best = [min((costs[s] + way(m, s, t)[0], order[s], way(m, s, t)[1], s) for s in STATES) for t in STATES]
        ranked = sorted(STATES, key=lambda t: (best[t][0] >= FAR, best[t][1:3]))
        place = [ranked.index(t) for t in STATES]
        fore.append(([min(b[0], FAR) for b in best], place, [b[3] for b in best]))
    costs, order, _ = fore[-1]
    # the last border: endings differ in length only where an insertion follows, which costs more
    last = crossing(costs, order, [ENDING[s][0] for s in STATES])
    borders = [last]
    for _, _, came in reversed(fore[1:]):
        borders.append(came[borders[-1]])
    return costs[last] + ENDING[last][0], borders[::-1]


@lru_cache(50_000)
def _short_matrix(kinds: str) -> list[int]:
    return matrix(kinds)


@lru_cache(50_000)
def _short_between(kinds: str, entry: int, exit_: int) -> str:
    return between(kinds, entry, exit_)


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in RIGHT_PAIRS for a, b in itertools.pairwise(initials))


# --- rows ------------------------------------------------------------------------


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` after the damage that the checksum of ``conv:turn`` chooses for a row.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the
    user's.  A null reads as one space in the checksum, the role and the text.
    """
    space = F.lit(" ")
    fault = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)]).cast("binary")) % 20
    flat = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"), fault.alias("fault"))
    out = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return flat.where("fault <> 0").select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), out.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies")
    )


def _digest() -> Column:
    return F.md5(F.col("text").cast("binary"))


def _own_kind() -> Column:
    """Initial and fault of a row by itself, duplicates not yet known."""
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    seen = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    last = F.substring(seen, -1, 1)
    fault = F.when(seen == "", 1).when(last.isin(".", "!", "?"), 0).otherwise(3)
    return (4 * place + fault).alias("kind")


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows of all conversations with their number in order: ``conv, turn, role, digest, kind, copies, at``.

    Order is by turn, nulls first; rows of one turn by role, then by the digest of their text, so that equal rows are neighbours.  A range
    partitioning deals even one long conversation to many tasks.
    """
    flat = rows.select("conv", "turn", "role", _digest().alias("digest"), _own_kind(), "copies")
    distinct = flat.groupBy("conv", "turn", "role", "digest", "kind").agg(F.sum("copies").alias("copies"))
    keys = ["conv", "turn", "role", "digest"]
    return distinct.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())


def _letter(kind: Column) -> Column:
    return F.char(kind + 65)


def runs(stage: DataFrame) -> DataFrame:
    """``conv, at, kinds`` of each run of rows; ``at`` is the number of its first row.

    A row is a duplicate unless it is the first of its conversation with that role and text.  The first ones are found by their number, which is
    joined back, so a text that is said everywhere crowds no task.
    """
    first = stage.where("kind % 4 <> 1").groupBy("conv", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    told = stage.select("conv", "kind", "copies", "at").join(first, "at", "left")
    kind = F.when((F.col("kind") % 4 != 1) & F.col("first").isNull(), F.col("kind") - F.col("kind") % 4 + 2).otherwise(F.col("kind"))
    # copies of a row follow it; all but the first are duplicates, or blank like it
    more = F.when(F.col("kind") % 4 == 1, F.col("kind")).otherwise(F.col("kind") - F.col("kind") % 4 + 2)
    letters = F.concat(_letter(kind), F.repeat(_letter(more), (F.col("copies") - 1).cast("int")))
    # a conversation's run is within one partition of the order
    part = F.shiftright("at", 33)
    run = told.select("conv", part.alias("part"), F.floor((F.col("at") - F.shiftleft(part, 33)) / PIECE).alias("run"), "at", letters.alias("letters"))
    grouped = run.groupBy("conv", "part", "run").agg(
        F.min("at").alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "letters"))), lambda x: x["letters"]), "").alias("kinds"),
    )
    return grouped.select("conv", "at", "kinds")


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 2048):
        kinds = batch.column(2).to_pylist()
        rows = [[OF_KIND[k] for k in s] for s in kinds]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([_short_matrix(k) if len(k) < 64 else matrix(k) for k in kinds], pa.list_(pa.int64())),
                pa.array([illegal_pairs("".join(i for i, _ in r)) for r in rows], pa.int64()),
                pa.array([r[0][0] for r in rows], pa.string()),
                pa.array([r[-1][0] for r in rows], pa.string()),
                *[pa.array([sum(f == g for _, f in r) for r in rows], pa.int64()) for g in "bdt"],
            ],
            names=["conv", "at", "matrix", "illegal", "opens", "closes", "blank", "duplicate", "truncated"],
        )


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 256):
        out: dict[str, list] = {c: [] for c in ("at", "entry", "exit", "last", "cost", "illegal")}
        source: list[int] = []
        for n, of in enumerate(batch.column(1).to_pylist()):
            cost, borders = chain([r["matrix"] for r in of])
            joined = sum(a["closes"] + b["opens"] not in RIGHT_PAIRS for a, b in itertools.pairwise(of))
            for k, r in enumerate(of):
                source.append(n)
                for c, v in zip(out, (r["at"], borders[k], borders[k + 1], k == len(of) - 1, cost, joined)):
                    out[c].append(v)
        types = dict(at=pa.int64(), entry=pa.int32(), exit=pa.int32(), last=pa.bool_(), cost=pa.int64(), illegal=pa.int64())
        arrays = [pa.array(out[c], t) for c, t in types.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *arrays], names=["conv", *types])


def _solve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 2048):
        kinds, entry, exit_, last = (batch.column(k).to_pylist() for k in range(1, 5))
        edits = [
            (_short_between(k, s, t) if len(k) < 64 else between(k, s, t)) + (ENDING[t][1] if end else "") for k, s, t, end in zip(kinds, entry, exit_, last)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(edits, pa.string())], names=["at", "edits"])


class Repaired:
    """The lines of one conversation, digested as its edits and rows arrive in order."""

    def __init__(self) -> None:
        self.digest, self.state, self.audit, self.edits, self.at, self.started = hashlib.sha256(), START, [], "", 0, False

    def _line(self, role: str, text: str) -> None:
        if self.started:
            self.digest.update(b"\n")
        self.started = True
        self.digest.update(f"{role}:{text}".encode())

    def _follow(self, text: str) -> None:
        self.state = FOLLOWS[self.state]
        self._line("user" if self.state == USER else "assistant", text)

    def _inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._follow("")
            self.at += 1

    def run(self, edits: str) -> None:
        self._inserts()
        self.audit.append(edits)
        self.edits, self.at = edits, 0

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = ENTERS[role[0]]
            self._line(role, text)
        elif edit == "R":
            self._follow(text)

    def end(self) -> tuple[str, str]:
        self._inserts()
        return "".join(self.audit), self.digest.hexdigest()


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation; a run's edits come before its rows."""
    names, held, current = ["conv", "audit", "repaired_sha256"], None, None
    for batch in pieces_of(batches, 1024):
        done: list[tuple] = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv", "edits", "role", "text", "copies")))
        for conv, edits, role, text, copies in rows:
            if current is None or conv != held:
                if current is not None:
                    done.append((held, *current.end()))
                held, current = conv, Repaired()
            if edits is not None:
                current.run(edits)
            else:
                for _ in range(copies):
                    current.row(role, text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (batch.schema.field("conv").type, pa.string(), pa.string()))], names=names)
        kind = batch.schema.field("conv").type
    if current is not None:
        last = (held, *current.end())
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(last, (kind, pa.string(), pa.string()))], names=names)


EMPTY_DIGEST = hashlib.sha256().hexdigest()


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` are damaged first, see :func:`damage`.  ``audit`` has the initials of Keep (0), Rerole (1), Delete (2, required for blank and
    duplicate rows) and Insert (5); kept and reroled rows that are truncated cost 5 more.  Of equally cheap repairs the one whose audit comes first
    in ASCII is taken.  Rows without a conversation id form one conversation; null turns come first and take no part in ``gaps``; rows of one
    turn are in order of role and digest of the text.  Conversations that lose every row have zeros, an empty audit and the digest of nothing.
    A role that begins with none of s, u, a cannot be kept.  Turns are whole numbers.  No rows give no rows.  Only the four named columns
    are read, so others cannot clash.
    """
    stages = Stages()
    key = f"conv {rows.schema[conv].dataType.simpleString()}"
    damaged = damage(rows, conv, turn, role, text)
    stage = stages.cut(ordered(damaged))
    told = stages.cut(runs(stage))
    mapped = told.mapInArrow(_run_batches, f"{key}, at long, matrix array<long>, illegal long, opens string, closes string, blank long, duplicate long, truncated long")
    mapped = stages.cut(mapped)
    # one row per run: rows of a conversation by PIECE
    gathered = mapped.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "matrix", "opens", "closes"))).alias("runs"))
    chained = stages.cut(gathered.mapInArrow(_chain_batches, f"{key}, at long, entry int, exit int, last boolean, cost long, illegal long"))
    solved = told.select("at", "kinds").join(chained.select("at", "entry", "exit", "last"), "at").select("at", "kinds", "entry", "exit", "last")
    edits = solved.mapInArrow(_solve_batches, "at long, edits string")

    # edits take the place in order of their run's first row, just before it
    keys = ["conv", "turn", "role", "digest"]
    heads = edits.join(stage.select("at", *keys), "at").select(*keys, F.lit(0).alias("after"), "edits", F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    lines = damaged.select("conv", "turn", "role", _digest().alias("digest"), F.lit(1).alias("after"), F.lit(None).cast("string").alias("edits"), "text", F.col("copies").cast("long").alias("copies"))
    stream = heads.unionByName(lines).repartition("conv").sortWithinPartitions(*keys, "after")
    digests = stream.select("conv", "edits", "role", "text", "copies").mapInArrow(_digest_batches, f"{key}, audit string, repaired_sha256 string")

    # turns of a conversation, each counted once before they meet
    turns = stage.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = {c: "long" for c in counts} | {"audit": "string", "repaired_sha256": "string"}

    def fact(df: DataFrame) -> DataFrame:
        return df.select("conv", *[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in facts])

    sums = mapped.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    # pairs over the border of two runs are known where the runs are chained
    over = chained.where("last").select("conv", "cost", "illegal")
    every = fact(rows.select(F.col(conv).alias("conv")).distinct())
    for part in (gaps, sums, over, digests):
        every = every.unionByName(fact(part))
    total = every.groupBy("conv").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_DIGEST)).alias("repaired_sha256"),
    )
    return total.select(F.col("conv").alias("conv_id"), *facts)
