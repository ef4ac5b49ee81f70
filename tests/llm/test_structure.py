"""Structure repair against a plain version that writes out every list of edits' cheapest end from the back."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from bazaarflow.llm import structure
from bazaarflow.llm.queries import QUERIES, SQL
from tools.compare import duck, rows_of_duck, rows_of_spark

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def harm(rows):
    out, ids = [], set()
    for c, turn, role, text in rows:
        ids.add(c)
        role, text = " " if role is None else role, " " if text is None else text
        name = lambda x: " " if x is None else str(x)
        case = zlib.crc32(f"{name(c)}:{name(turn)}".encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        row = (c, turn, "user" if case == 4 else role, text)
        out += [row, row] if case == 3 else [row]
    return ids, out


def plain(ids, rows):
    convs = defaultdict(list)
    for c, *row in rows:
        convs[c].append(row)
    return {repair(c, sorted(convs[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c in ids}


def repair(c, turns):
    faults, seen = [], set()
    for _, role, text in turns:
        kept = BLANK.findall(text)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0

    def follows(shape, letter):
        return PATTERN.fullmatch(shape + letter + ("a" if letter == "u" else "ua" if letter == "s" else "")) is not None

    @lru_cache(None)
    def best(i, shape, room):
        """(cost, audit, lines) of the turns from i on; shape stands for all that came before by its end."""
        options = [(0, "", ())] if i == len(turns) and PATTERN.fullmatch(shape) else []
        for letter, role in (("u", "user"), ("a", "assistant")):
            if room and follows(shape, letter):
                cost, audit, lines = best(i, short(shape + letter), room - 1)
                options.append((cost + 5, "I" + audit, (f"{role}:", *lines)))
        if i < len(turns):
            _, own, text = turns[i]
            cost, audit, lines = best(i + 1, shape, 3)
            options.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                late = 5 * (faults[i] == "truncated")
                if own[:1] in ("s", "u", "a") and follows(shape, own[:1]):
                    cost, audit, lines = best(i + 1, short(shape + own[:1]), 3)
                    options.append((cost + late, "K" + audit, (f"{own}:{text}", *lines)))
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if follows(shape, letter):
                        cost, audit, lines = best(i + 1, short(shape + letter), 3)
                        options.append((cost + late + 1, "R" + audit, (f"{role}:{text}", *lines)))
        return min(options, default=(10**9, "", ()))

    def short(shape):
        return "ua" if shape.endswith("a") else shape[-3:] if shape[0] != "s" else shape[:3]

    cost, audit, lines = best(0, "", 3)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def reports(df):
    got = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def rows():
    draw, out = random.Random(11), []
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "u", "sue"]
    texts = ["One.", "Two!", "cut off", "", " \n", None, "Why? ", "…", "a.b"]
    for c in range(300):
        for i in range(draw.randrange(1, 10)):
            turn = None if draw.random() < 0.05 else i + draw.randrange(3)
            out.append((c, turn, draw.choice(roles), draw.choice(texts) if draw.random() < 0.5 else f"Text {draw.random()}."))
    out += [(None, 0, "user", "No id."), (None, 1, "assistant", "None."), (1000, None, None, None)]
    out += [(1001, i, "user" if i % 2 == 0 else "assistant", f"Turn {i % 90} of many.") for i in range(300)]
    return out


def test_registered_query_equals_plain_version_and_sql(spark, root):
    table = [tuple(r) for r in spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_structure_repair"](spark, root)
    assert reports(found) == plain(*harm(table))
    names, values, _ = rows_of_duck(duck(root), SQL["op12_structure_repair"])
    assert (names, values) == rows_of_spark(found)


def test_random_conversations_equal_the_plain_version(spark, rows):
    sys.setrecursionlimit(50_000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert reports(structure.repair_report(structure.damaged(df), held=F.col("held"))) == plain(*harm(rows))
    whole = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert reports(structure.repair_report(df)) == plain({r[0] for r in rows}, whole)


def test_giant_conversations_go_through_files(spark, rows, monkeypatch):
    batches = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    batches.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, inputs, first = {}, [], {}
    for c, t, r, x in batches:
        number = (t is not None, t or 0)
        first.setdefault((c, r, x), number)
        inputs.append((c, t, r, x, first[(c, r, x)] < number, True))
    import pyarrow as pa

    names = ["conv_id", "turn", "role", "text", "seen", "held"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
    cut = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*inputs[i : i + 13]), types)], names) for i in range(0, len(inputs), 13)]
    want = [b.to_pylist() for b in structure._reports(iter(cut))]
    monkeypatch.setattr(structure, "SPILL", 64)
    got = [b.to_pylist() for b in structure._reports(iter(cut))]
    assert sum(got, []) == sum(want, [])


def test_repaired_turns_follow_the_pattern(spark, rows):
    damaged = structure.damaged(spark.createDataFrame(rows, SCHEMA))
    turns = defaultdict(list)
    for r in structure.repaired_turns(damaged, held=F.col("held")).collect():
        turns[r.conv_id].append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in structure.repair_report(damaged, held=F.col("held")).collect()}
    for c, digest in digests.items():
        held = sorted(turns.get(c, []), key=lambda r: r.position)
        assert [r.position for r in held] == list(range(len(held)))
        assert PATTERN.fullmatch("".join(r.role[:1] for r in held))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in held).encode()).hexdigest() == digest


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert structure.repair_report(empty).collect() == [] and structure.repaired_turns(empty).collect() == []
    gone = spark.createDataFrame([(5, 1, "user", "Hi."), (5, 9, "user", "Ho.")], SCHEMA)
    row = structure.repair_report(gone, held=F.lit(False)).collect()
    assert [tuple(r) for r in row] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    clash = spark.createDataFrame([(5, 1, "user", "Hi.")], SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("h", "c", "first", "last", "seen", "held", "again_h", "case", "copy")])
    assert reports(structure.repair_report(clash)) == plain({5}, [(5, 1, "user", "Hi.")])
    assert reports(structure.repair_report(structure.damaged(clash), held=F.col("held"))) == plain(*harm([(5, 1, "user", "Hi.")]))
    long = "word " * 200_000 + "."
    pair = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", long)]
    assert reports(structure.repair_report(spark.createDataFrame(pair, SCHEMA))) == plain({1}, pair)


def test_few_machine_states():
    machine, draw = structure.Machine(), random.Random(5)
    costs, order = structure.Machine.FIRST
    for _ in range(50_000):
        kind = (draw.randrange(4), draw.random() < 0.3, draw.random() < 0.3)
        costs, order, _, _ = machine.step(costs, order, (kind[0], kind[1], kind[2] and not kind[1]))
    assert len(machine.table) < 5000
