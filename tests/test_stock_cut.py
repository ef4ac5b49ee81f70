"""Cut products against a sequential store: negative quantities, high levels, and runs where starts matter for long."""

import random

import pytest

from bazaarflow.operators import stock as St
from bazaarflow.operators.ordered import SkewPolicy

SCHEMA = "product_id bigint, event_id bigint, order_id string, at_us bigint, action string, qty int"


def store(events, seed):
    """(reason, available, stock, reserved) of every event, one after the other."""
    stock, reserved, out = dict(seed), {}, {}
    for p, i, _, _, action, q in sorted(events, key=lambda e: (e[0], e[3], e[1])):
        s, r, reason = stock.get(p, 0), reserved.get(p, 0), None
        free = max(0, s - r)
        if action == "order":
            reason = "OUT_OF_STOCK" if free <= 0 else "INSUFFICIENT_STOCK" if free < q else "APPROVED"
            if reason == "APPROVED":
                r += q
        elif action == "sold":
            s, r = max(0, s - q), max(0, r - q)
        else:
            s = q
        stock[p], reserved[p] = s, r
        out[i] = (reason, free, s, r)
    return out


def events_of(kind, n, draw):
    """One product's events: level far above, at and below what is asked."""
    levels = {"plenty": 10_000_000, "tight": 40, "empty": 3, "negative": 30}[kind]
    out = []
    for i in range(n):
        x = draw.random()
        if kind == "plenty":
            action, q = ("order", draw.randrange(1, 6)) if x < 0.98 else ("sold", draw.randrange(1, 4))
        elif x < 0.55:
            action, q = "order", draw.randrange(1, 9)
        elif x < 0.9:
            action, q = "sold", draw.randrange(1, 6)
        else:
            action, q = "update", draw.randrange(levels)
        if kind == "negative" and draw.random() < 0.3:
            q = -draw.randrange(1, 5)
        out.append((action, q))
    return out, levels


@pytest.mark.parametrize("policy", [SkewPolicy(40, 8), SkewPolicy(200, 3)])
def test_cut_products_equal_a_sequential_store(spark, policy):
    draw, events, seed = random.Random(2), [], {}
    for p, kind in enumerate(["plenty", "tight", "empty", "negative", "negative"]):
        made, level = events_of(kind, 400, draw)
        if p != 4:
            seed[p] = level
        events += [(p, p * 10_000 + i, f"o{i}", i // 3, a, q) for i, (a, q) in enumerate(made)]
    df = spark.createDataFrame(draw.sample(events, len(events)), SCHEMA)
    seeds = spark.createDataFrame(list(seed.items()), "product_id bigint, initial_stock bigint")
    got = {r.event_id: (r.reason, r.available, r.stock_after, r.reserved_after) for r in St.stock_decisions(df, seeds, policy).collect()}
    assert got == store(events, seed)


def test_pieces_equal_runs_from_every_amount():
    """The piece around a start gives the end of every amount in it."""
    draw = random.Random(4)
    for kind in ("tight", "negative", "empty"):
        for _ in range(60):
            made, _ = events_of(kind, draw.randrange(1, 30), draw)
            rows = lambda r: iter([(1, 0, a, q, 0, 25, r) for a, q in made])

            def end(r):
                s = 25
                for a, q in made:
                    s, r = St.after_event(a, q, s, r)
                return r

            for start in range(0, 30, 3):
                ((_, _, low, high, flat, at, value),) = St._trial(rows(start))
                assert at == start and value == end(start) and low <= start <= high
                for r in range(max(low, -10), min(high, 60) + 1):
                    assert end(r) == (value if flat else value + r - start)
