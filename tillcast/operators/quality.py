"""Data quality: column contracts, schema comparison, profiling, referential checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Fail fast, listing every missing column (the forecaster's input check)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in input DataFrame: {missing}")


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or present column: expected type, actual type, status
    (``ok`` / ``missing`` / ``type_mismatch`` / ``unexpected``). Pure metadata."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name, typ in want.items():
        got = actual.get(name)
        status = "missing" if got is None else ("ok" if got == typ else "type_mismatch")
        rows.append((name, typ, got, status))
    rows += [(n, None, t, "unexpected") for n, t in actual.items() if n not in want]
    schema = "column string, expected string, actual string, status string"
    return df.sparkSession.createDataFrame(rows, schema)


def schema_nulls(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``schema_report`` with the null cells of each column (null for a missing column), counted
    in one pass: a column that could not be read as its type shows as nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return schema_report(df, expected).join(counts.select(F.inline(cells)), "column", "left")


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, min and max (as text).

    ``exact``: one grouped count per column (partial aggregation by value, so a
    value holding a third of the rows collapses map-side), then a small global
    aggregate over the groups. Meant for a stored columnar table — each column's
    job reads that column only — instead of multiplying every row by the number of
    columns for multiple distinct counts. ``exact=False``: a single pass with
    HyperLogLog distinct counts."""
    columns = columns or df.columns
    if exact:
        parts = []
        for c in columns:
            g = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(g.agg(
                F.lit(c).alias("column"), F.sum("n").alias("rows"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
                F.count("v").alias("distinct"),
                F.min("v").cast("string").alias("min"), F.max("v").cast("string").alias("max")))
        return reduce(DataFrame.unionByName, parts)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}"), F.approx_count_distinct(c).alias(f"_d{i}"),
                 F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"),
                      F.col(f"_n{i}").alias("nulls"), F.col(f"_d{i}").cast("long").alias("distinct"),
                      F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
             for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*cells)))


def _count(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failed_rows")).select(F.lit(name).alias("check"), "failed_rows")


def quality_report(sales: DataFrame, prices: DataFrame, calendar: DataFrame,
                   extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rule violations as ``(check, failed_rows)`` rows; 0 means clean.

    Referential checks are left-anti joins (rows kept only when the other side
    has no match), the key check a grouped count; each is one aggregate.
    """
    wk = sales.join(calendar.select("date", "wm_yr_wk"), "date", "left")
    checks = {
        "sales_outside_calendar": sales.join(calendar.select("date"), "date", "left_anti"),
        "sales_without_price": wk.join(prices.select("store_id", "item_id", "wm_yr_wk"),
                                       ["store_id", "item_id", "wm_yr_wk"], "left_anti"),
        "duplicate_series_day": sales.groupBy("id", "date").count().filter(F.col("count") > 1),
        "null_sales": sales.filter(F.col("sales").isNull()),
        "negative_sales": sales.filter(F.col("sales") < 0),
        "nonpositive_or_null_price": prices.filter(~(F.coalesce(F.col("sell_price"), F.lit(0.0)) > 0)),
        "duplicate_price_key": prices.groupBy("store_id", "item_id", "wm_yr_wk").count()
        .filter(F.col("count") > 1),
        "duplicate_calendar_day": calendar.groupBy("date").count().filter(F.col("count") > 1),
    }
    checks.update(extra or {})
    return reduce(DataFrame.unionByName, [_count(k, v) for k, v in checks.items()])
