"""Event-time order per key on Spark's keyed state and timers.

Rows of a key wait in its state until the watermark has passed them, then go to a fold in order. A micro-batch touches the keys
that have rows in it or whose timer is due, and no others. Rows at or before the watermark of their micro-batch are late: Spark would
drop them without a word, so the time goes on as a plain number, the fold compares it with the watermark and gives
late rows out, marked. Rows without a time are late too.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.dates import micros
from ..sources.events import END_TIME

Columns = dict[str, np.ndarray]

# Stands for a missing number; as a time it lies before every watermark.
MISSING = -(1 << 62)


def watermarked(stream: DataFrame, ts: str, delay_seconds: float, keep: Column) -> DataFrame:
    """Rows that satisfy ``keep`` with their time as ``at_us``; their column ``ts`` is null, but carries the watermark.

    Every row comes twice for a moment: one copy has the time alone and moves the watermark, the other has no time for Spark to
    drop it by. An event of ``END_TIME`` has the first copy only.
    """
    at, keep = F.col(ts), F.coalesce(keep, F.lit(False))
    ended = F.coalesce(at >= F.to_timestamp(F.lit(END_TIME)), F.lit(False))
    none = F.array().cast("array<boolean>")
    clock = F.when(at.isNotNull() & (keep | ended), F.array(F.lit(True))).otherwise(none)
    row = F.when(keep & ~ended, F.array(F.lit(False))).otherwise(none)
    copies = stream.withColumn("at_us", known(micros(ts))).withColumn("_clock", F.explode(F.concat(clock, row)))
    timed = copies.withColumn(ts, F.when(F.col("_clock"), at)).withWatermark(ts, f"{int(delay_seconds * 1000)} milliseconds")
    return timed.filter(F.col(ts).isNull()).drop("_clock")


def known(number: Column) -> Column:
    """A number that is never null."""
    return F.coalesce(number.cast("bigint"), F.lit(MISSING))


def unknown(number: Column) -> Column:
    """Null again where a number was missing."""
    return F.when(number != MISSING, number)


@dataclass(frozen=True)
class Fold:
    """What happens to a key's rows in order.

    ``step(key, carry, rows)`` takes the rows that the watermark has passed, sorted, and returns the new carry and output columns;
    ``carry`` is None at first. ``expires(key)`` is the time in microseconds after which a key gets no more rows, or None.
    """

    step: Callable[[tuple, object, Columns], tuple[object, Columns]]
    expires: Callable[[tuple], int] | None = None


def _columns(frame: pd.DataFrame, names: list[str]) -> Columns:
    return {n: frame[n].to_numpy() for n in names}


def _joined(parts: list[Columns], names: list[str]) -> Columns:
    return parts[0] if len(parts) == 1 else {n: np.concatenate([p[n] for p in parts]) for n in names}


def in_event_order(rows: DataFrame, ts: str, keys: list[str], inputs: list[str], fold: Fold, out: str) -> DataFrame:
    """The fold's output and the late rows (``late`` is true, columns of the output that are no input are null).

    ``rows`` comes from ``watermarked`` with its time column ``ts`` and holds ``keys`` and ``inputs``, among these at_us and event_id, the order. ``out`` gives the
    output columns and their types.
    """
    types = dict(part.strip().split(" ", 1) for part in out.split(", "))

    def frame(key: tuple, columns: Columns, n: int, late: bool) -> pd.DataFrame:
        held = dict(zip(keys, ([k] * n for k in key))) | columns
        return pd.DataFrame({**{c: held.get(c, [None] * n) for c in types}, "late": late})

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark_ms = state.getCurrentWatermarkMs()
        waiting, carry = pickle.loads(state.get[0]) if state.exists else (None, None)
        parts = [waiting] if waiting is not None else []
        if not state.hasTimedOut:
            for given in frames:
                got = _columns(given, inputs)
                late = got["at_us"] <= mark_ms * 1000
                if late.any():
                    yield frame(key, {n: v[late] for n, v in got.items()}, int(late.sum()), True)
                    got = {n: v[~late] for n, v in got.items()}
                if len(got["at_us"]):
                    parts.append(got)
        if parts:
            held = _joined(parts, inputs)
            order = np.lexsort((held["event_id"], held["at_us"]))
            held = {n: v[order] for n, v in held.items()}
            passed = int(np.searchsorted(held["at_us"], mark_ms * 1000, "right"))
            if passed:
                carry, made = fold.step(key, carry, {n: v[:passed] for n, v in held.items()})
                n = len(made["at_us"])
                if n:
                    yield frame(key, made, n, False)
            waiting = {n: v[passed:] for n, v in held.items()} if passed < len(order) else None
        end_ms = None if fold.expires is None else int(fold.expires(key)) // 1000 + 1
        if waiting is None and (carry is None or (end_ms is not None and end_ms <= mark_ms)):
            if state.exists:
                state.remove()
            return
        state.update((pickle.dumps((waiting, carry)),))
        if waiting is not None:
            state.setTimeoutTimestamp(int(waiting["at_us"][0]) // 1000 + 1)
        elif end_ms is not None:
            state.setTimeoutTimestamp(end_ms)

    schema = ", ".join(f"{n} {t}" for n, t in types.items()) + ", late boolean"
    slim = rows.select(ts, *keys, *[c for c in inputs if c not in keys])
    return slim.groupBy(*keys).applyInPandasWithState(run, schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout)


def late_rows(stream: DataFrame, ts: str, delay_seconds: float, columns: list[str], spread: Column, tasks: int = 64) -> DataFrame:
    """Every row with ``late`` and the ``watermark_us`` it met; keeps no state.

    Rows are dealt by ``spread``, a number; the time comes back as at_us and is not among ``columns``.
    """
    types = {f.name: f.dataType.simpleString() for f in stream.select(*columns).schema.fields}

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        for given in frames:
            yield given.drop(columns=["dealt", ts]).assign(late=given["at_us"] <= mark, watermark_us=mark)

    rows = watermarked(stream, ts, delay_seconds, F.lit(True))
    rows = rows.select(ts, *columns, "at_us", F.pmod(known(spread), F.lit(tasks)).alias("dealt"))
    schema = ", ".join(f"`{n}` {t}" for n, t in types.items()) + ", at_us bigint, late boolean, watermark_us bigint"
    found = rows.groupBy("dealt").applyInPandasWithState(run, schema, "none int", "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("at_us", unknown(F.col("at_us")))
