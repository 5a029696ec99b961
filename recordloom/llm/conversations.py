"""Repair of conversations: the cheapest edits that give turns in the order ``(s?(ua)+)?``.

Every row of a conversation is kept, gets another role, or is deleted, and rows with an empty
text may be inserted. Each choice is an edge of an acyclic graph over (rows left, what was
said last) and has one integer as its weight: the cost in the high digits, and in a fixed
number of low digits the letters of the audit, the first one highest, with zeros at the end.
So the least integer is the least cost and, among equal costs, the audit that is least in
ASCII (one that ends sooner comes first), and an ordinary minimum decides everything.

Equal rows become one row with a count before they are shuffled. The rows are then sorted by
conversation and turn into ranges, so that a long conversation lies in many tasks. A task
solves what lies in it whole. Of a conversation that goes on in another range, or is longer than
a block, each block gives the least cost from each state to each; these are folded from the
last block to the first (numbers only), which tells what each block's ends cost; then blocks
are solved one by one, and their states folded from the first to the last. What a single value needs
whole (the audit, the hash of the repaired text) is put together block by block in a stream.

Defined results: rows stand by turn (nulls first), then role, then the SHA-256 of the text.
Null roles and texts are one space. Rows with zero copies only name their conversation; a
conversation without other rows, a null id among them, has zeros, an empty audit and the hash
of nothing. Roles count by their first letter, s, u or a, as it is written. Turns may be any
numbers; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from recordloom.llm.folders import table

#: What was said last: nothing, then the roles.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The role that may follow a state, beside a system turn at the start.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Costs, and the digits of the audit's letters in the order of ASCII.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS = " DIKR"
D, I, K, R = range(1, 5)  # noqa: E741
DIGIT = 3
LEGAL = {"su", "ua", "au"}
#: What the end of a conversation costs from each state: the turns still to be inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: Rows and bytes of a block.
BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 15
#: A text that so many rows of a conversation share is looked up by a broadcast (at most 1,000 are).
SHARED_ROWS = 10_000

SPACES = " \t\n\x0b\x0c\r"
ROW = "struct<turn:bigint,role:string,text:string,copies:bigint,blank:boolean,again:boolean,cut:boolean>"
COUNTS = "blank long, duplicate long, truncated long, illegal long"
REPORT = f"conv_id long, gaps long, {COUNTS}, cost long, audit string, repaired_sha256 string"
TURNS = "turns array<struct<edit:string,role:string,text:string>>"
EDGES = "first string, last string, first_turn long, last_turn long, turns_seen long, spoken long"
PLACE = "conv_id long, part int, seq long"


@dataclass
class Block:
    """Rows in order, as ``(turn, role, text, copies, blank, again, cut)``."""

    rows: list[tuple] = field(default_factory=list)

    def items(self) -> Iterator[tuple[str, bool, bool, int]]:
        """Per row its initial, whether it must go, whether it is truncated, and its further copies."""
        for _, role, _, copies, blank, again, cut in self.rows:
            if copies:
                yield role[:1], blank or again, cut, copies - 1

    def counts(self) -> tuple[int, int, int, int]:
        """Blank, duplicate and truncated rows, and neighbours whose roles can't follow each other."""
        blank = duplicate = truncated = illegal = 0
        before = None
        for _, role, _, copies, is_blank, again, cut in self.rows:
            if not copies:
                continue
            if is_blank:
                blank += copies
            elif again:
                duplicate += copies
            else:
                duplicate += copies - 1
                truncated += bool(cut)
            illegal += copies - 1 + (before is not None and before + role[:1] not in LEGAL)
            before = role[:1]
        return blank, duplicate, truncated, illegal

    def edges(self) -> tuple:
        """First and last initial, first and last turn, distinct turns, rows."""
        some = [row for row in self.rows if row[3]]
        turns = [row[0] for row in some if row[0] is not None]
        ends = (some[0][1][:1], some[-1][1][:1]) if some else (None, None)
        return (*ends, *((turns[0], turns[-1]) if turns else (None, None)), len(set(turns)), len(some))

    def costs(self) -> list[int]:
        """Least costs from each state to each, rows of four; no letters are asked for."""
        out = {}
        for end in STATES:
            far = 1 << 62
            values = [0 if state == end else far for state in STATES]
            for initial, forced, cut, more in reversed(list(self.items())):
                values = _inserted([v + DELETE * more for v in values], lambda v: v + INSERT)
                values = [min(_edges(state, initial, forced, cut, values, lambda _, cost, v: v + cost)) for state in STATES]
                values = _inserted(values, lambda v: v + INSERT)
            out[end] = values
        return [out[end][state] for state in STATES for end in STATES]


def _edges(state: int, initial: str, forced: bool, cut: bool, values, weight) -> Iterator[int]:
    """The weights of what can be done with a row in a state."""
    yield weight(D, DELETE, values[state])
    if forced:
        return
    extra = TRUNCATED if cut else 0
    said = INITIALS.get(initial)
    if said == NEXT[state] or (said == SYSTEM and state == START):
        yield weight(K, extra, values[said])
    yield weight(R, RENAME + extra, values[NEXT[state]])


def _inserted(values: list[int], insert: Callable[[int], int]) -> list[int]:
    """The values where turns may be inserted first: two at most are ever worth it."""
    start, system, user, assistant = values
    user, assistant = min(user, insert(assistant)), min(assistant, insert(user))
    return [min(start, insert(user)), min(system, insert(user)), user, assistant]


class Solver:
    """The least edits of a block from any state, where leaving it costs ``ends``; None: the conversation's end."""

    def __init__(self, block: Block, ends: list[int] | None):
        self.block, items = block, list(block.items())
        # a row has one letter after at most two insertions; a run of copies, which all go, one letter
        self.low = DIGIT * (3 * sum(1 + (more > 0) for *_, more in items) + 3)
        values = [v << self.low for v in ends] if ends else self._end()
        for initial, forced, cut, more in reversed(items):
            if more:
                values = self._inserted([self._before(D, DELETE * more, v) for v in values])
            values = self._inserted([min(_edges(s, initial, forced, cut, values, self._before)) for s in STATES])
        self.values = values

    def _end(self) -> list[int]:
        far = 1 << (self.low + 62)
        return self._inserted([0, far, far, 0])

    def _before(self, letter: int, cost: int, rest: int) -> int:
        """The weight of an edge and what follows: letters move one place to the right."""
        high = rest >> self.low
        letters = rest - (high << self.low)
        return (high + cost << self.low) + (letter << self.low - DIGIT) + (letters >> DIGIT)

    def _inserted(self, values: list[int]) -> list[int]:
        return _inserted(values, lambda v: self._before(I, INSERT, v))

    def letters(self, state: int) -> list[int]:
        """The digits of the best path, in order."""
        digits, at = [], self.low - DIGIT
        while at >= 0 and (digit := self.values[state] >> at & 7):
            digits.append(digit)
            at -= DIGIT
        return digits

    def path(self, state: int) -> tuple[str, int, int, list[tuple[str, str, str]]]:
        """Audit, cost, the state it leads to, and the edits (letter, role, text) that leave a turn."""
        audit, cost, turns = [], 0, []
        rows = iter([row for row in self.block.rows if row[3]])
        copies = 0
        for digit in self.letters(state):
            letter = LETTERS[digit]
            if digit == I:
                state, role, text = NEXT[state], ROLES[NEXT[state]], ""
                cost += INSERT
            elif copies:  # the letter of the copies
                audit.append(letter * copies)
                cost, copies = cost + DELETE * copies, 0
                continue
            else:
                _, role, text, count, _, _, cut = next(rows)
                copies = count - 1
                if digit == D:
                    audit.append(letter)
                    cost += DELETE
                    continue
                if digit == R:
                    role = ROLES[NEXT[state]]
                    cost += RENAME
                cost += TRUNCATED if cut else 0
                state = INITIALS[role[:1]]
            audit.append(letter)
            turns.append((letter, role, text))
        return "".join(audit), cost, state, turns


def _long(value: int) -> int:
    """As a 64-bit number, which the distance of two turns may exceed."""
    return (value + 2**63) % 2**64 - 2**63


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return 0 if first is None else _long(last - first + 1 - turns)


def _joined(turns: list[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text in turns).encode()


def _edits(turns: list[tuple[str, str, str]]) -> list[dict]:
    return [{"edit": letter, "role": role, "text": text} for letter, role, text in turns]


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    held, room = [], 0
    for row in rows:
        held.append(row)
        room += 200 + size(row)
        if room > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, room = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(df: DataFrame, run: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    """Rows to rows in a stream."""

    def size(row: dict) -> int:
        texts = [r["text"] or "" for name in ("rows", "turns") for r in row.get(name) or ()]
        return sum(map(len, texts)) + len(row.get("audit") or "") + len(row.get("piece") or "")

    schema = _arrow(ddl)

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        yield from _batches(run(rows), schema, size)

    return df.mapInArrow(frame, ddl)


def _sorted_rows(turns: DataFrame) -> DataFrame:
    """Distinct rows with their copies and faults, in ranges of conversations and turns."""
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    here = copies > 0
    space = F.lit(" ")
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(here, F.col("turn").cast("long")).alias("turn"),
        F.when(here, F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(here, F.coalesce(F.col("text").cast("string"), space)).alias("text"),
        F.when(here, copies).otherwise(0).alias("copies"),
    )
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    end = F.rtrim("text", F.lit(SPACES))
    rows = table(
        counted.select(
            "*",
            F.coalesce(end == "", F.lit(False)).alias("blank"),
            F.coalesce((end != "") & ~F.right(end, F.lit(1)).isin(".", "!", "?"), F.lit(False)).alias("cut"),
            F.sha2("text", 256).alias("digest"),
        ),
        "turns",
    )
    said = rows.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "digest")
    again = table(
        said.agg(
            F.count(F.lit(1)).alias("n"), F.count("turn").alias("numbered"), F.min("turn").alias("least")
        ).where("n > 1"),
        "said",
    )
    again = again.select(
        *(F.col(c).alias(f"a_{c}") for c in ("conv_id", "role", "digest")),
        "n",
        F.when(F.col("n") == F.col("numbered"), F.col("least")).alias("first"),
    )
    same = F.expr("conv_id <=> a_conv_id AND role = a_role AND digest = a_digest")
    # a key above the thousandth part of all rows occurs less than 1,000 times
    most = max(SHARED_ROWS, rows.count() // 1000)
    names = ["conv_id", "turn", "role", "text", "copies", "blank", "cut", "digest"]
    later = F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    light = rows.join(again.where(F.col("n") <= most), same, "left").select(*names, later.alias("light"))
    heavy = light.join(F.broadcast(again.where(F.col("n") > most)), same, "left")
    marked = heavy.select(*names, ((F.col("light") | later) & ~F.col("blank")).alias("again"))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest")]
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("conv_id", "turn", "role", "text", "copies", "blank", "again", "cut")


@dataclass(frozen=True)
class Repair:
    """``report``: a row for each conversation; ``turns``: what is left of them, if asked for."""

    report: DataFrame
    turns: DataFrame | None


def repair(turns: DataFrame, with_turns: bool = False, block_rows: int = BLOCK_ROWS) -> Repair:
    """Repair every conversation of ``turns`` (``conv_id, turn, role, text``, and ``copies`` if rows have any).

    ``block_rows``: of a longer conversation, so many rows are solved at once.
    """
    rows = _sorted_rows(turns)
    solved = table(_mapped(rows, _blocks(with_turns, block_rows), SOLVED), "solved")
    done = solved.where("NOT open")
    report, kept = done.select(*_names(REPORT)), done.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("seq"), "turns")
    blocks = solved.where("open")
    placed = _entered(blocks)
    opened = blocks.select("part", "seq", "rows").join(placed, ["part", "seq"])
    pieces = _mapped(opened, _solved_block(with_turns), PIECE)
    pieces = table(pieces, "pieces") if with_turns else pieces
    whole = pieces.drop("turns").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    report = report.unionByName(_mapped(whole, _put_together, REPORT))
    if not with_turns:
        return Repair(report, None)
    kept = kept.unionByName(pieces.select("conv_id", "part", "seq", "turns"))
    one = kept.select("conv_id", "part", "seq", F.posexplode("turns").alias("place", "turn"))
    return Repair(report, one.select("conv_id", "part", "seq", "place", "turn.*"))


def _names(ddl: str) -> list[str]:
    """The columns of a schema without nested ones."""
    return [column.split()[0] for column in ddl.split(", ")]


SOLVED = f"{REPORT}, open boolean, part int, seq long, rows array<{ROW}>, costs array<long>, {EDGES}, {TURNS}"


def _blocks(with_turns: bool, block_rows: int):
    """Solve what lies whole in this range; of the rest, the blocks with their numbers."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        part, seq = TaskContext.get().partitionId(), 0
        current, block, size, cut_before, first = None, None, 0, True, True

        def closed() -> dict:
            audit, cost, _, kept = Solver(block, None).path(START)
            counts = dict(zip(_names(COUNTS), block.counts()))
            _, _, low, high, seen, _ = block.edges()
            sha256 = hashlib.sha256(_joined(kept)).hexdigest()
            out = {"conv_id": current, "open": False, "gaps": _gaps(low, high, seen), **counts}
            return out | {"cost": cost, "audit": audit, "repaired_sha256": sha256, "turns": _edits(kept) if with_turns else None}

        def left_open() -> dict:
            names = ("turn", "role", "text", "copies", "blank", "again", "cut")
            out = {"conv_id": current, "open": True, "part": part, "seq": seq, "costs": block.costs()}
            out |= dict(zip(_names(COUNTS), block.counts())) | dict(zip(_names(EDGES), block.edges()))
            return out | {"rows": [dict(zip(names, row)) for row in block.rows]}

        for row in rows:
            if block is None or row["conv_id"] != current:
                if block is not None:  # the first one may have begun in the range before
                    yield left_open() if cut_before or first else closed()
                    first, seq = False, seq + 1
                current, block, size, cut_before = row["conv_id"], Block(), 0, False
            elif len(block.rows) >= block_rows or size > BLOCK_BYTES:
                yield left_open()
                block, size, cut_before, seq = Block(), 0, True, seq + 1
            block.rows.append(tuple(row[c] for c in ("turn", "role", "text", "copies", "blank", "again", "cut")))
            size += len(row["text"] or "")
        if block is not None:  # the last one may go on in the next range
            yield left_open()

    return run


def _by_conversation(rows: Iterator[dict]) -> Iterator[tuple[dict, bool]]:
    """Rows with whether they begin a conversation."""
    before = object()
    for row in rows:
        yield row, row["conv_id"] != before
        before = row["conv_id"]


def _exits(rows: Iterator[dict]) -> Iterator[dict]:
    """From the last block to the first: what it costs to leave each block in each state."""
    entry = None
    for row, last in _by_conversation(rows):
        ends = None if last else entry
        costs = row["costs"]
        entry = [min(costs[4 * s + t] + (END if last else ends)[t] for t in STATES) for s in STATES]
        yield {"part": row["part"], "seq": row["seq"], "ends": ends}


def _leads_to(rows: Iterator[dict]) -> Iterator[dict]:
    """The state to which the best path of a block leads from each state."""
    for row in rows:
        solver = Solver(_block_of(row), row["ends"])
        yield {k: row[k] for k in ("part", "seq", "ends")} | {"to": [solver.path(s)[2] for s in STATES]}


def _block_of(row: dict) -> Block:
    names = ("turn", "role", "text", "copies", "blank", "again", "cut")
    return Block([tuple(r[c] for c in names) for r in row["rows"]])


ENTERED = f"{PLACE}, state int, ends array<long>, is_last boolean, gaps long, {COUNTS}"


def _states(rows: Iterator[dict]) -> Iterator[dict]:
    """From the first block to the last: the state in which each is entered, and the sums so far."""
    for row, first in _by_conversation(rows):
        if first:
            state, said, low, high, seen, sums = START, None, None, None, 0, [0, 0, 0, 0]
        sums = [a + row[c] for a, c in zip(sums, _names(COUNTS))]
        if row["spoken"]:
            sums[3] += said is not None and said + row["first"] not in LEGAL
            said = row["last"]
        if row["first_turn"] is not None:
            seen += row["turns_seen"] - (row["first_turn"] == high)
            low, high = row["first_turn"] if low is None else low, row["last_turn"]
        out = {c: row[c] for c in ("conv_id", "part", "seq", "ends")} | {"state": state, "is_last": row["ends"] is None}
        yield out | {"gaps": _gaps(low, high, seen)} | dict(zip(_names(COUNTS), sums))
        state = row["to"][state]


def _entered(blocks: DataFrame) -> DataFrame:
    """Where the blocks of each conversation are entered and left; only numbers move."""
    order = ["conv_id", "part", "seq"]
    numbers = blocks.select(*order, "costs").repartition("conv_id")
    downwards = numbers.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    exits = table(_mapped(downwards, _exits, "part int, seq long, ends array<long>"), "exits")
    there = blocks.select("part", "seq", "rows").join(exits, ["part", "seq"])
    to = _mapped(there, _leads_to, "part int, seq long, ends array<long>, to array<int>")
    numbers = blocks.select(*order, *_names(COUNTS), *_names(EDGES))
    upwards = numbers.join(to, ["part", "seq"]).repartition("conv_id").sortWithinPartitions(*order)
    return table(_mapped(upwards, _states, ENTERED), "entered")


PIECE = f"{PLACE}, is_last boolean, gaps long, {COUNTS}, cost long, audit string, piece binary, said boolean, {TURNS}"


def _solved_block(with_turns: bool):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            audit, cost, _, kept = Solver(_block_of(row), row["ends"]).path(row["state"])
            out = {c: row[c] for c in ("conv_id", "part", "seq", "is_last", "gaps", *_names(COUNTS))}
            out |= {"cost": cost, "audit": audit, "piece": _joined(kept), "said": bool(kept)}
            yield out | {"turns": _edits(kept) if with_turns else None}

    return run


def _put_together(rows: Iterator[dict]) -> Iterator[dict]:
    """The blocks of a conversation, in order, to its report."""
    for row, first in _by_conversation(rows):
        if first:
            sha256, audit, cost, said = hashlib.sha256(), [], 0, False
        if row["said"]:
            sha256.update((b"\n" if said else b"") + row["piece"])
            said = True
        audit.append(row["audit"])
        cost += row["cost"]
        if row["is_last"]:
            out = {c: row[c] for c in ("conv_id", "gaps", *_names(COUNTS))}
            yield out | {"cost": cost, "audit": "".join(audit), "repaired_sha256": sha256.hexdigest()}
