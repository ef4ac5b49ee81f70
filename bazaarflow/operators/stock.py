"""First-come-first-served stock allocation.

Input events: product_id, event_id, order_id, at_us, action, qty with action one of
'order' (check and reserve), 'sold' (confirm a sale), 'update' (set the level).

Each product's events are folded in order: one shuffle, one sort, two numbers of state. The
seed travels with the events as each product's first one, so no join is needed. A product
with too many events is cut into chunks, whose starting states are found first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.numeric import floored_ratio, round_half_up
from ..session import materialize
from .ordered import CHUNK, DEFAULT, SkewPolicy, with_chunks

ORDER = ["at_us", "event_id"]
# Below every level that a sum of quantities can reach.
LOWEST = -(1 << 62)


def quantity() -> Column:
    """The quantity of an event. An update without a level sets 0, an order or sale without one is for 1."""
    unsaid = F.when(F.col("action") == "update", 0).otherwise(1)
    return F.coalesce(F.col("qty"), unsaid).cast("bigint")


def after_event(action: str, qty: int, stock: int, reserved: int) -> tuple[int, int]:
    """Stock and reserved amount after one event."""
    if action == "order":
        free = stock - reserved
        return stock, reserved + qty if free > 0 and free >= qty else reserved
    if action == "sold":
        return max(0, stock - qty), max(0, reserved - qty)
    return qty if action == "update" else stock, reserved


def _seed_reserved(seed: DataFrame) -> list:
    given = F.col("initial_reserved") if "initial_reserved" in seed.columns else F.lit(0)
    return [given.cast("bigint").alias("_reserved0")]


def _with_seed(events: DataFrame, seed: DataFrame) -> DataFrame:
    """Events and, before them as their time is null, one 'seed' row per seeded product."""
    first = seed.select(
        "product_id", F.lit("seed").alias("action"), F.col("initial_stock").cast("bigint").alias("qty"), *_seed_reserved(seed)
    )
    return events.unionByName(first, allowMissingColumns=True)


# ---- products that are cut -------------------------------------------------------------
#
# The level after a run of events is a function of the level before it, max(base, level + add) or a fixed number, whatever
# the run; so chunks are reduced to two numbers in parallel and the levels follow along the chunks of a product.
#
# The reserved amount after a chunk is a step function of the amount before it: between two breakpoints it is the amount plus a shift,
# or a fixed number where a sale empties it. A run of a chunk from one amount gives the whole piece around that amount, as
# every decision tells how far the amount could move without changing it. Chunks run in parallel from supposed amounts; then
# the pieces are followed from the first chunk on, and only chunks entered outside their known pieces run again. Starts
# soon agree, as full stock and empty reserves forget the amount before, and each round settles one chunk at least.


def _stream(rows: DataFrame, schema: str, run: Callable[[Iterator[tuple]], Iterator[tuple]], inputs: list[str]) -> DataFrame:
    """``run`` over the tuples of a sorted partition, as they come."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tuples = (row for b in given for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs]))
        out: list[tuple] = []
        for row in run(tuples):
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return rows.mapInArrow(batches, schema)


def _level_of_chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(product, chunk, base, add, fixed) of each run of (product, chunk, action, qty)."""
    for (product, chunk), events in groupby(rows, key=lambda r: r[:2]):
        base, add, fixed = LOWEST, 0, False
        for _, _, action, qty in events:
            if action in ("update", "seed"):
                base, add, fixed = qty, 0, True
            elif action == "sold":
                base, add = max(0, base - qty) if fixed or base > LOWEST else 0, add - qty
        yield product, chunk, base, add, fixed


def _level_at_starts(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(product, chunk, level at its start, whether it is the first) along the chunks of each product."""
    for product, chunks in groupby(rows, key=lambda r: r[0]):
        level, first = 0, True
        for _, chunk, base, add, fixed in chunks:
            yield product, chunk, level, first
            level, first = base if fixed else max(base, level + add), False


def _trial(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(product, chunk, low, high, flat, start, value): the piece around ``start`` of the chunk's step function.

    Amounts from ``low`` to ``high`` end at ``value``, moved as far from it as the amount lies from ``start`` unless ``flat``.
    """
    for (product, chunk), events in groupby(rows, key=lambda r: r[:2]):
        stock = reserved = start = None
        down, up, flat = LOWEST, -LOWEST, False
        for _, _, action, qty, seeded, level, supposed in events:
            if start is None:
                stock, reserved, start = level, supposed, supposed
            if action == "seed":
                stock, reserved, flat = qty, seeded, True
                continue
            if not flat and action == "order":
                most = stock - max(qty, 1)  # the largest amount at which the order is approved
                if reserved <= most:
                    up = min(up, most - reserved)
                else:
                    down = max(down, most + 1 - reserved)
            elif not flat and action == "sold":
                if reserved > qty:
                    down = max(down, qty - reserved)
                else:
                    up, flat = min(up, qty - reserved), True
            stock, reserved = after_event(action, qty, stock, reserved)
        yield product, chunk, max(LOWEST, start + down), min(-LOWEST, start + up), flat, start, reserved


def _followed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(product, chunk, level, amount, known) along the pieces of each product's chunks, sorted by chunk.

    Behind a chunk that is entered outside its pieces the amounts are supposed ones.
    """
    for product, of_product in groupby(rows, key=lambda r: r[0]):
        amount = 0
        for chunk, pieces in groupby(of_product, key=lambda r: r[1]):
            near, hit, level = None, None, 0
            for _, _, level, low, high, flat, start, value in pieces:
                if near is None or abs(start - amount) < abs(near[0] - amount):
                    near = start, value
                if low <= amount <= high:
                    hit = value if flat else value + amount - start
            yield product, chunk, level, amount, hit is not None
            amount = near[1] if hit is None else hit


def _chunk_starts(heavy: DataFrame) -> DataFrame:
    """Stock and reserved amount at the start of every chunk of the cut products."""
    key = f"product_id {heavy.schema['product_id'].dataType.simpleString()}, {CHUNK} bigint"
    here = F.col("product_id").eqNullSafe(F.col("_p")) & (F.col(CHUNK) == F.col("_c"))
    slim = heavy.select("product_id", CHUNK, *ORDER, "action", "qty", F.coalesce("_reserved0", F.lit(0)).alias("_reserved0"))

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("product_id", CHUNK).sortWithinPartitions("product_id", CHUNK, *ORDER)

    def along(df: DataFrame) -> DataFrame:
        return df.repartition("product_id").sortWithinPartitions("product_id", CHUNK)

    maps = _stream(in_order(slim), f"{key}, base bigint, add bigint, fixed boolean", _level_of_chunks, ["product_id", CHUNK, "action", "qty"])
    levels = _stream(along(maps), f"{key}, level bigint, first boolean", _level_at_starts, ["product_id", CHUNK, "base", "add", "fixed"])
    levels = materialize(levels)
    # The first chunk starts with nothing reserved; a full stock is as good as any other start for the rest.
    wanted = levels.select("product_id", CHUNK, "level", F.when(F.col("first"), 0).otherwise(F.greatest(F.lit(0), F.col("level"))).cast("bigint").alias("amount"))
    pieces = None
    while True:
        asked = wanted.select(F.col("product_id").alias("_p"), F.col(CHUNK).alias("_c"), "level", "amount")
        rows = in_order(slim.join(asked, here).drop("_p", "_c"))
        inputs = ["product_id", CHUNK, "action", "qty", "_reserved0", "level", "amount"]
        found = _stream(rows, f"{key}, low bigint, high bigint, flat boolean, start bigint, value bigint", _trial, inputs)
        at = levels.select(F.col("product_id").alias("_p"), F.col(CHUNK).alias("_c"), "level")
        found = found.join(at, here).drop("_p", "_c")
        pieces = materialize(found if pieces is None else pieces.unionByName(found))
        inputs = ["product_id", CHUNK, "level", "low", "high", "flat", "start", "value"]
        starts = _stream(along(pieces), f"{key}, level bigint, amount bigint, known boolean", _followed, inputs)
        starts = materialize(starts)
        wanted = starts.filter("not known")
        if wanted.isEmpty():
            names = {"product_id": "_p", CHUNK: "_c", "level": "_stock_c", "amount": "_reserved_c"}
            return starts.drop("known").withColumnsRenamed(names)


def stock_decisions(events: DataFrame, seed: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Every event with the state before it, the decision taken and the state after it.

    ``seed``: product_id, initial_stock and, to continue an earlier run, initial_reserved.
    Products without a seed start at zero.
    """
    whole = events.withColumn("qty", quantity())
    rows, cut = with_chunks(_with_seed(whole, seed), ["product_id"], ORDER, policy)
    rows = rows.withColumns({"_stock_c": F.lit(0).cast("bigint"), "_reserved_c": F.lit(0).cast("bigint")})
    if cut:
        starts = _chunk_starts(rows.filter(F.col(CHUNK) >= 0).drop("_stock_c", "_reserved_c"))
        hit = F.col("product_id").eqNullSafe(F.col("_p")) & (F.col(CHUNK) == F.col("_c"))
        rows = rows.drop("_stock_c", "_reserved_c").join(starts, hit, "left").drop("_p", "_c")
    rows = rows.fillna(0, ["_stock_c", "_reserved_c", "_reserved0"])
    placed = rows.repartition("product_id", CHUNK).sortWithinPartitions("product_id", CHUNK, *ORDER)
    names = whole.columns
    states = ["stock_before", "reserved_before", "stock_after", "reserved_after"]
    kept = [T.StructField(f.name, f.dataType) for f in whole.schema.fields]
    schema = T.StructType([*kept, *[T.StructField(s, T.LongType()) for s in states]])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, stock, reserved = None, 0, 0
        for batch in batches:
            trail: tuple[list, ...] = ([], [], [], [])
            columns = ("product_id", CHUNK, "action", "qty", "_reserved0", "_stock_c", "_reserved_c")
            for product, chunk, action, qty, seeded, *start in zip(*[batch.column(c).to_pylist() for c in columns]):
                if (product, chunk) != run:
                    run, (stock, reserved) = (product, chunk), start
                after = (qty, seeded) if action == "seed" else after_event(action, qty, stock, reserved)
                for out, value in zip(trail, (stock, reserved, *after)):
                    out.append(value)
                stock, reserved = after
            arrays = [batch.column(n) for n in names] + [pa.array(out, pa.int64()) for out in trail]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *states])

    return judged(placed.mapInArrow(fold, schema).filter(~F.col("action").eqNullSafe("seed")))


def judged(folded: DataFrame) -> DataFrame:
    """Events with their states, and what that means for an order: available and reason."""
    free = F.greatest(F.lit(0), F.col("stock_before") - F.col("reserved_before"))
    reason = (
        F.when(F.col("action") != "order", F.lit(None))
        .when(free <= 0, "OUT_OF_STOCK")
        .when(free < F.col("qty"), "INSUFFICIENT_STOCK")
        .otherwise("APPROVED")
    )
    return folded.withColumn("available", free).withColumn("reason", reason)


def allocations(decisions: DataFrame) -> DataFrame:
    """Outcome of every order; a rejected order takes nothing."""
    approved = F.col("reason") == "APPROVED"
    return decisions.filter("action = 'order'").select(
        "product_id",
        "event_id",
        "order_id",
        approved.alias("approved"),
        "reason",
        "available",
        F.col("qty").alias("requested"),
        F.when(approved, F.col("available") - F.col("qty")).alias("remaining_after_reserve"),
    )


def stock_updates(decisions: DataFrame, large: int = 10) -> DataFrame:
    """Level updates with the old level; marks changes above ``large``."""
    changed = F.abs(F.col("stock_before") - F.col("stock_after")) > large
    return decisions.filter("action = 'update'").select(
        "product_id",
        "event_id",
        F.col("stock_before").alias("old_stock"),
        F.col("stock_after").alias("new_stock"),
        "reserved_after",
        changed.alias("large_change"),
    )


def confirmed_sales(decisions: DataFrame) -> DataFrame:
    """Confirmed sales with the state after them."""
    return decisions.filter("action = 'sold'").select(
        "product_id", "event_id", "order_id", "qty", F.col("stock_after").alias("new_stock"), "reserved_after"
    )


def final_state(decisions: DataFrame, seed: DataFrame) -> DataFrame:
    """Stock, reserved and available per product at the end; seeded products without events included."""
    last = decisions.groupBy("product_id").agg(
        F.max_by(F.struct("stock_after", "reserved_after"), F.struct(*ORDER)).alias("s")
    )
    start = seed.select("product_id", "initial_stock", *_seed_reserved(seed))
    joined = start.join(last, "product_id", "full").select(
        "product_id",
        F.coalesce("s.stock_after", F.col("initial_stock").cast("bigint"), F.lit(0)).alias("stock"),
        F.coalesce("s.reserved_after", F.col("_reserved0"), F.lit(0)).alias("reserved"),
    )
    return joined.withColumn("available_stock", F.greatest(F.lit(0), F.col("stock") - F.col("reserved")))


def available_stock(products: DataFrame, state: DataFrame) -> DataFrame:
    """Available stock of the asked products; unknown products have none."""
    found = products.join(state.select("product_id", "available_stock"), "product_id", "left")
    return found.withColumn("available_stock", F.coalesce("available_stock", F.lit(0)))


def change_log(decisions: DataFrame) -> DataFrame:
    """Audit rows: stock reserved by approved orders and stock sold."""
    sold = F.col("action") == "sold"
    hit = sold | (F.col("reason") == "APPROVED")
    return decisions.filter(hit).select(
        "product_id",
        "event_id",
        "order_id",
        F.when(sold, "sold").otherwise("reserved").alias("action"),
        F.col("qty").alias("quantity"),
        F.when(sold, F.col("stock_after")).alias("new_stock"),
    )


def stock_numbers() -> list[Column]:
    """Counters of the decisions on orders, as aggregates that add up over parts."""
    order = F.col("action") == "order"
    return [
        F.count_if(order).alias("total_checks"),
        F.count_if(order & (F.col("reason") == "APPROVED")).alias("approved"),
        F.count_if(order & (F.col("reason") == "OUT_OF_STOCK")).alias("rejected_no_stock"),
        F.count_if(order & (F.col("reason") == "INSUFFICIENT_STOCK")).alias("rejected_insufficient"),
    ]


def stock_stats(counters: dict, state: DataFrame, low: int = 5) -> DataFrame:
    """Counters of a run in one row, from those of its decisions and the state after it."""
    products = state.agg(F.count("*").alias("products_tracked"), F.count_if(F.col("available_stock").between(1, low)).alias("low_stock_count"))
    checks = {c: F.lit(counters[c]).cast("bigint") for c in ("total_checks", "approved", "rejected_no_stock", "rejected_insufficient")}
    rate = round_half_up(floored_ratio("approved", "total_checks") * F.lit(100.0), 2)
    return products.withColumns(checks).withColumn("approval_rate", rate)
