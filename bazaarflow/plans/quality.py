"""Data checks, reported as rows (check, column, passed, bad_rows, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _finding(check: str, column: str, bad: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        (bad == 0).alias("passed"),
        bad.cast("bigint").alias("bad_rows"),
        message.alias("message"),
    )


def _unfold(one_row: DataFrame, findings: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*findings)).alias("f")).select("f.*")


def scan_checks(
    df: DataFrame,
    table: str,
    required: list[str] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
    not_empty: bool = True,
) -> DataFrame:
    """Not-empty, null and range checks of all columns in one scan. Nulls pass a range."""
    required, ranges = required or [], ranges or {}
    aggs = [F.count("*").alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    aggs += [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"range_{c}") for c, (lo, hi) in ranges.items()]
    findings = []
    if not_empty:
        empty = (F.col("rows") == 0).cast("int")
        text = F.when(F.col("rows") == 0, F.lit(f"{table}: empty")).otherwise(
            F.concat(F.lit(f"{table}: "), F.col("rows").cast("string"), F.lit(" rows"))
        )
        findings.append(_finding("not_empty", "*", empty, text))
    for c in required:
        n = F.col(f"null_{c}")
        findings.append(_finding("no_nulls", c, n, F.concat(F.lit(f"{table}.{c}: "), n.cast("string"), F.lit(" nulls"))))
    for c, (lo, hi) in ranges.items():
        n = F.col(f"range_{c}")
        text = F.concat(F.lit(f"{table}.{c}: "), n.cast("string"), F.lit(f" values outside [{lo}, {hi}]"))
        findings.append(_finding("value_range", c, n, text))
    return _unfold(df.agg(*aggs), findings)


def duplicate_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Surplus rows over distinct keys."""
    surplus = df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dupes"))
    names = ",".join(keys)
    text = F.concat(F.lit(f"{table}: "), F.col("dupes").cast("string"), F.lit(f" duplicate keys on {names}"))
    return _unfold(surplus, [_finding("no_duplicates", names, F.col("dupes"), text)])


def quality_report(
    df: DataFrame,
    table: str,
    required: list[str] | None = None,
    keys: list[str] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """The whole suite; every failing column is listed, not only the first."""
    reports = [scan_checks(df, table, required, ranges)]
    if keys:
        reports.append(duplicate_check(df, table, keys))
    return reduce(DataFrame.unionByName, reports)


def all_passed(report: DataFrame) -> bool:
    """True when no check failed; brings one value to the driver."""
    return report.agg(F.coalesce(F.bool_and("passed"), F.lit(True))).first()[0]
