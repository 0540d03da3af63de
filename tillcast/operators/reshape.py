"""Wide ⇄ long reshapes of the daily sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.schemas import DAY_PREFIX, SERIES_KEYS


def day_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(DAY_PREFIX)]


def _consecutive_start(days: list[str]) -> int | None:
    """First day number when the columns are ``d_k, d_k+1, ...`` in order."""
    try:
        nums = [int(c[len(DAY_PREFIX):]) for c in days]
    except ValueError:
        return None
    ok = nums and all(b == a + 1 for a, b in zip(nums, nums[1:]))
    return nums[0] if ok else None


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _str_array(values: list[str]):
    """A literal string array as one SQL expression (one JVM call)."""
    return F.expr("array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")")


def melt_daily(wide: DataFrame, keys: list[str] = SERIES_KEYS) -> DataFrame:
    """Every ``d_<n>`` column becomes a ``(d, sales)`` row; null values are kept.

    One ``posexplode`` over an array of the day columns: a narrow Generate, no
    shuffle, far cheaper than ``unpivot`` on ~1,900 columns. The day code comes
    from the position: by arithmetic when the columns are a consecutive run,
    else through the ordered list of names held once as a literal array. Wide
    expressions are built as one SQL string (one JVM call, not one per column).
    """
    days = day_columns(wide)
    types = dict(wide.dtypes)
    values = "array(" + ", ".join(_q(c) if types[c] == "int" else f"CAST({_q(c)} AS INT)" for c in days) + ")"
    exploded = wide.select(*keys, F.posexplode(F.expr(values)).alias("_pos", "sales"))
    start = _consecutive_start(days)
    if start is not None:
        code = F.concat(F.lit(DAY_PREFIX), (F.col("_pos") + start).cast("string"))
    else:
        code = F.element_at(_str_array(days), F.col("_pos") + 1)
    return exploded.select(*keys, code.alias("d"), "sales")


def pivot_daily(long: DataFrame, day_codes: list[str], keys: list[str] = SERIES_KEYS,
                fill: int | None = 0) -> DataFrame:
    """Long ``(keys, d, sales)`` to one row per series with a column per day code
    (units summed per cell; days without a row become ``fill``).

    Spark's two-phase pivot (aggregate per cell, then one array per series) does
    the spreading. Filling happens in long form — each series explodes its own
    list of day codes and left-joins its sales — because a projection of
    thousands of ``coalesce`` expressions is far slower to compile than to run.
    """
    long = long.filter(F.col("d").isin(day_codes)).select(*keys, "d", "sales")
    if fill is not None:
        grid = long.select(*keys).distinct().select(*keys, F.explode(_str_array(day_codes)).alias("d"))
        long = (grid.join(long, [*keys, "d"], "left")
                .withColumn("sales", F.coalesce(F.col("sales"), F.lit(fill))))
    return long.groupBy(*keys).pivot("d", day_codes).agg(F.sum("sales").cast("int"))
