"""Merging sorted inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .ordered import DEFAULT, SkewPolicy, position


def merge_sorted(inputs: list[DataFrame], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Merge inputs of (value, pos) into one order.

    Equal values keep input order, then position. Adds ``source`` and the place in the
    merged order; places come from chunk totals, so no task sees the whole order.
    """
    tagged = [df.select("value", F.lit(i).alias("source"), "pos") for i, df in enumerate(inputs)]
    union = reduce(DataFrame.unionByName, tagged)
    return position(union, [], ["value", "source", "pos"], "merged_pos", policy, cut_all=True)


def sorted_input(df: DataFrame, value: str, tie: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """(value, pos) of one input in its own order."""
    slim = df.select(F.col(value).alias("value"), F.col(tie).alias("_tie"))
    return position(slim, [], ["value", "_tie"], "pos", policy, cut_all=True).select("value", "pos")
