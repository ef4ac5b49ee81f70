"""Repair of conversation structure by least edits, as a stream over secondary-sorted turns.

Conversations are dealt over tasks, their turns sorted by turn, and one pass carries the state of a dynamic program across Arrow
batches: for each of the four places in the role pattern ``(s?(ua)+)?`` (nothing yet, after system, after user, after assistant) the
least cost, and the order of the four best edit lists. Only differences of costs decide, so the program is a finite machine
whose moves are computed once and looked up. A back-pointer is one byte for each place, four a turn. Turns and back-pointers of
a conversation beyond ``SPILL`` bytes go to an unnamed file of the task and are read back once, the pointers from the end, the turns
from the start; in memory stays one letter a turn, the list of edits that is returned.

Faults, the first counts: blank (nothing but blanks), duplicate (role and text seen earlier in the conversation), truncated (the last
character that is no blank is none of ``.!?``). Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate
turns), Insert a textless user or assistant turn 5; a truncated turn that stays adds 5. Of the cheapest lists the first in ASCII order
is taken: every best list ends with the letter of the same turn, so at equal cost no list is the head of another and the order of the
lists so far decides.

Duplicates of an earlier turn number are found by a count over (conversation, hash of role and text), those of the same number stand
side by side in the sort, so no task holds a set of all texts of a conversation.

Defined cases: null roles and texts are one blank; turns are sorted by number (null first), role and text; a role's initial is its first
character, as it is, and an empty role has none; a null conversation id is a conversation of its own; gaps ignore null turns; a
conversation whose turns are all marked as gone has zeros, no edits and no text; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import marshal
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import BLANKS

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
ENDS = ".!?"
SPILL = 8 << 20
NEVER = 1 << 40
# From any place the rest of a list from any other place can be followed at this cost at most: two turns inserted and a kept
# system turn deleted instead. A place that lies further behind the best can no longer win or tie.
BEHIND = 2 * INSERT + DELETE
# Places of the role pattern, and the place after one more turn that the pattern asks for.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LETTERS = "DKR"


def kept_place(place: int, initial: int) -> int | None:
    """Where a turn of this initial leads if it is kept, or None."""
    if initial == SYSTEM:
        return SYSTEM if place == START else None
    return initial if initial and NEXT[place] == initial else None


def moves(initial: int, must_go: bool, truncated: bool) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, letters, pointer) of one turn, each with up to two turns inserted before it."""
    found, extra = [], TRUNCATED if truncated else 0
    for start in range(4):
        place = start
        for inserted in range(3):
            options = [("D", place, DELETE)]
            if not must_go:
                options.append(("R", NEXT[place], REROLE + extra))
                to = kept_place(place, initial)
                if to is not None:
                    options.append(("K", to, KEEP + extra))
            for letter, to, cost in options:
                pointer = start | inserted << 2 | LETTERS.index(letter) << 4
                found.append((start, to, cost + inserted * INSERT, "I" * inserted + letter, pointer))
            place = NEXT[place]
    return found


class Machine:
    """The program's moves: (cost differences, order of lists, kind of turn) to the next ones, looked up after the first time."""

    FIRST = ((0, NEVER, NEVER, NEVER), (0, 0, 0, 0))
    # What may follow the last turn: the end, or the turns that the pattern still asks for.
    LAST = ((START, 0, ""), (ASSISTANT, 0, ""), (USER, INSERT, "I"), (SYSTEM, 2 * INSERT, "II"))

    def __init__(self):
        self.table: dict[tuple, tuple] = {}
        self.kinds: dict[tuple, list] = {}

    def step(self, costs: tuple, order: tuple, kind: tuple) -> tuple[tuple, tuple, int, bytes]:
        """(costs, order, what was taken off the costs, pointers)."""
        key = (costs, order, kind)
        hit = self.table.get(key)
        if hit is None:
            hit = self.table[key] = self._step(costs, order, kind)
        return hit

    def _step(self, costs, order, kind):
        options = self.kinds.setdefault(kind, moves(*kind))
        best: list[tuple | None] = [None] * 4
        for start, to, cost, letters, pointer in options:
            if costs[start] < NEVER:
                one = (costs[start] + cost, order[start], letters, pointer)
                if best[to] is None or one < best[to]:
                    best[to] = one
        least = min(b[0] for b in best if b)
        best = [b if b and b[0] - least <= BEHIND else None for b in best]
        ranks = {b[1:3]: i for i, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
        return (
            tuple(b[0] - least if b else NEVER for b in best),
            tuple(ranks[b[1:3]] if b else 0 for b in best),
            least,
            bytes(b[3] if b else 0 for b in best),
        )

    def finish(self, costs: tuple, order: tuple) -> tuple[int, int, str]:
        """(cost, last place before it, letters) of the cheapest end."""
        ends = [(costs[p] + cost, order[p], letters, p) for p, cost, letters in self.LAST if costs[p] < NEVER]
        cost, _, letters, place = min(ends)
        return cost, place, letters


class Spool:
    """Bytes in the order they came; beyond ``SPILL`` in an unnamed file of the task."""

    def __init__(self):
        self.file, self.tail, self.size = None, bytearray(), 0

    def add(self, data: bytes) -> None:
        self.tail += data
        self.size += len(data)
        if len(self.tail) > SPILL:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.tail = bytearray()

    def blocks(self, block: int) -> Iterator[bytes]:
        """From the start."""
        if self.file is not None:
            self.file.seek(0)
            while data := self.file.read(block):
                yield data
        yield bytes(self.tail)

    def reversed_blocks(self, block: int) -> Iterator[bytes]:
        """From the end; each block in its own order."""
        yield bytes(self.tail)
        at = self.size - len(self.tail)
        while at > 0:
            start = max(0, at - block)
            self.file.seek(start)
            yield self.file.read(at - start)
            at = start

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Conversation:
    """The running state of one conversation."""

    def __init__(self, conv_id, machine: Machine):
        self.conv_id, self.machine = conv_id, machine
        self.costs, self.order = Machine.FIRST
        self.cost, self.n = 0, 0
        self.turns, self.pointers = Spool(), Spool()
        self.low = self.high = None
        self.numbers = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        seen = seen or self.before == (turn, role, text)
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.numbers += self.high != turn
            self.high = turn
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in ("su", "ua", "au")
        self.before = (turn, role, text)
        bare = text.rstrip(BLANKS)
        blank = not bare
        duplicate = not blank and seen
        truncated = not blank and not duplicate and bare[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        kind = (INITIAL.get(role[:1], 0), blank or duplicate, truncated)
        self.costs, self.order, less, pointers = self.machine.step(self.costs, self.order, kind)
        self.cost += less
        self.n += 1
        record = marshal.dumps((turn, role, text))
        self.turns.add(len(record).to_bytes(8, "big") + record)
        self.pointers.add(pointers)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.numbers

    def steps(self) -> tuple[bytearray, int, str]:
        """One pointer for each turn in order, the cost, and the letters after the last turn."""
        cost, place, last = self.machine.finish(self.costs, self.order)
        taken = bytearray(self.n)
        at = self.n
        for block in self.pointers.reversed_blocks(4 << 18):
            for i in range(len(block) - 4, -1, -4):
                pointer = block[i + place]
                at -= 1
                taken[at] = pointer
                place = pointer & 3
        return taken, self.cost + cost, last

    def records(self) -> Iterator[tuple]:
        rest = b""
        for block in self.turns.blocks(1 << 20):
            rest += block
            at = 0
            while len(rest) - at >= 8:
                size = int.from_bytes(rest[at : at + 8], "big")
                if len(rest) - at - 8 < size:
                    break
                yield marshal.loads(rest[at + 8 : at + 8 + size])
                at += 8 + size
            rest = rest[at:]

    def edited(self, taken: bytearray, last: str) -> Iterator[tuple[str, int | None, str, str]]:
        """(letter, turn, role, text) of every edit; a deleted turn as it was."""
        place = START
        for pointer, (turn, role, text) in zip(taken, self.records()):
            for _ in range(pointer >> 2 & 3):
                place = NEXT[place]
                yield "I", None, ROLE[place], ""
            letter = LETTERS[pointer >> 4]
            if letter == "R":
                place = NEXT[place]
                role = ROLE[place]
            elif letter == "K":
                place = kept_place(place, INITIAL[role[:1]])
            yield letter, turn, role, text
        for letter in last:
            place = NEXT[place]
            yield letter, None, ROLE[place], ""

    def close(self) -> None:
        self.turns.close()
        self.pointers.close()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Whole conversations of a sorted partition, one at a time; the last state is carried from batch to batch."""
    machine, now = Machine(), None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "turn", "role", "text", "seen", "held")]
        for conv_id, turn, role, text, seen, held in zip(*(c.to_pylist() for c in columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                    now.close()
                now = Conversation(conv_id, machine)
            if held:
                now.add(turn, role, text, bool(seen))
    if now is not None:
        yield now
        now.close()


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv_id bigint, position bigint, turn bigint, role string, text string, edit string"
TYPES = {"bigint": pa.int64(), "string": pa.string()}


def _batches(rows: Iterator[tuple], schema: str, weight) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most 1,000 rows or a few megabytes."""
    names, types = zip(*[part.split() for part in schema.split(", ")])
    out, held = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, TYPES[t]) for c, t in zip(zip(*out), types)], list(names))

    for row in rows:
        out.append(row)
        held += weight(row)
        if len(out) >= 1000 or held > SPILL:
            yield batch()
            out, held = [], 0
    if out:
        yield batch()


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv in _conversations(batches):
            taken, cost, last = conv.steps()
            digest, audit, joint = hashlib.sha256(), bytearray(), b""
            for letter, _, role, text in conv.edited(taken, last):
                audit += letter.encode()
                if letter != "D":
                    digest.update(joint + f"{role}:{text}".encode())
                    joint = b"\n"
            yield conv.conv_id, conv.gaps(), conv.blank, conv.duplicate, conv.truncated, conv.illegal, cost, audit.decode(), digest.hexdigest()

    return _batches(rows(), REPORT, lambda r: len(r[7]))


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv in _conversations(batches):
            taken, _, last = conv.steps()
            stay = (x for x in conv.edited(taken, last) if x[0] != "D")
            for position, (letter, turn, role, text) in enumerate(stay):
                yield conv.conv_id, position, turn, role, text, letter

    return _batches(rows(), TURNS, lambda r: len(r[4]))


def blank(text: Column) -> Column:
    return ~text.rlike("[^\\x20\\x09-\\x0D]")


def _ordered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, held: Column | None) -> DataFrame:
    """conv_id, turn, role, text, held, and seen: the same role and text have an earlier turn number."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.lit(True) if held is None else held).alias("held"),
    )
    number = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    named = rows.withColumn("h", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    groups = named.filter("held").filter(~blank(F.col("text"))).groupBy("conv_id", "h").agg(F.min(number).alias("first"), F.max(number).alias("last"))
    again = groups.filter("first < last").select(F.col("conv_id").alias("c"), F.col("h").alias("again_h"), "first")
    met = named.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("again_h")), "left")
    seen = F.coalesce(F.col("first") < number, F.lit(False))
    rows = met.select("conv_id", "turn", "role", "text", "held", seen.alias("seen"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair_report(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, the least cost, the edits and the hash of the repaired text.

    Turns where ``held`` is false are gone; they only name their conversation.
    """
    return _ordered(turns, conv_col, turn_col, role_col, text_col, held).mapInArrow(_reports, REPORT)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """The turns of the repaired conversations: position from 0, the turn they had (null if inserted), role, text and edit."""
    return _ordered(turns, conv_col, turn_col, role_col, text_col, held).mapInArrow(_turns, TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with known damage by a checksum of id and turn; ``held`` is false for turns that are lost.

    Of 20 cases: 0 loses the turn, 1 its text, 2 its ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = turns.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), case.alias("case"))
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("case") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("held", F.col("case") != 0).withColumn("copy", F.explode(times)).drop("case", "copy")
