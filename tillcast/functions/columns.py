"""Column expressions shared by all layers. Everything here is a built-in Spark
expression, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the retail calendar (they must equal the reference's).
#   wday: 1 = Saturday, 2 = Sunday, 3 = Monday, ..., 7 = Friday
#   weekend: wday in (1, 2)
#   benefit ("snap") days: day of month <= 10 in CA, <= 15 in TX, <= 14 in WI
#   yearly events with their type and rule:
#     SuperBowl    Sporting  last Sunday of January to 2001 and in 2003, first Sunday of
#                            February in 2002 and from 2004 to 2021, second one from 2022
#     Thanksgiving National  fourth Thursday of November
#     Christmas    National  25 December
#     LaborDay     National  first Monday of September
#     MemorialDay  National  last Monday of May
#   default price of a series without any known price: 1.99
# ---------------------------------------------------------------------------
WEEKEND_WDAYS = (1, 2)
SNAP_LAST_DAY = {"snap_CA": 10, "snap_TX": 15, "snap_WI": 14}
EVENT_TYPES = {
    "SuperBowl": "Sporting",
    "Thanksgiving": "National",
    "Christmas": "National",
    "LaborDay": "National",
    "MemorialDay": "National",
}
DEFAULT_PRICE = 1.99


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def m5_wday(date: str | Column) -> Column:
    """Retail week day: Saturday = 1 ... Friday = 7 (Spark's dayofweek has Sunday = 1)."""
    return (F.dayofweek(col_(date)) % 7 + 1).cast("int")


def year_week(date: str | Column) -> Column:
    """Two-digit calendar year followed by the ISO week, e.g. 2012-01-01 -> 1252."""
    d = col_(date)
    return ((F.year(d) % 100) * 100 + F.weekofyear(d)).cast("int")


def weekday_name(date: str | Column) -> Column:
    return F.date_format(col_(date), "EEEE")


def event_name(date: str | Column) -> Column:
    """Named event of a day by the rules above; null on ordinary days."""
    d = col_(date)
    dow, dom, mon, year = F.dayofweek(d), F.dayofmonth(d), F.month(d), F.year(d)  # dayofweek: 1 = Sunday
    january = (year <= 2001) | (year == 2003)
    bowl = (F.when(january, (mon == 1) & (dom >= 25))
            .when(year <= 2021, (mon == 2) & (dom <= 7))
            .otherwise((mon == 2) & dom.between(8, 14)))
    return (F.when(bowl & (dow == 1), F.lit("SuperBowl"))
            .when((mon == 11) & (dow == 5) & (dom >= 22) & (dom <= 28), F.lit("Thanksgiving"))
            .when((mon == 12) & (dom == 25), F.lit("Christmas"))
            .when((mon == 9) & (dow == 2) & (dom <= 7), F.lit("LaborDay"))
            .when((mon == 5) & (dow == 2) & (dom >= 25), F.lit("MemorialDay")))


def event_type(name: str | Column) -> Column:
    n = col_(name)
    out = None
    for k, v in EVENT_TYPES.items():
        out = (F.when(n == k, F.lit(v)) if out is None else out.when(n == k, F.lit(v)))
    return out


def is_weekend(wday: str | Column) -> Column:
    return col_(wday).isin(*WEEKEND_WDAYS).cast("int")


def is_holiday(event: str | Column) -> Column:
    """1 when the event name is neither null nor empty."""
    return (F.coalesce(col_(event), F.lit("")) != "").cast("int")


def to_cents(amount: str | Column) -> Column:
    """Money as exact integer cents (round first: a cast alone would truncate)."""
    return F.round(col_(amount) * 100).cast("long")


def from_cents(cents: str | Column) -> Column:
    return col_(cents) / F.lit(100.0)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, 0.0 when the denominator is not positive."""
    n, d = col_(num), col_(den)
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0))


def exact_avg(c: str | Column) -> Column:
    """Mean as sum / count in double: order independent for integer inputs."""
    x = col_(c)
    return F.sum(x).cast("double") / F.count(x)


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it holds at most ``max_rows`` rows.

    The probe reads at most ``max_rows + 1`` rows. Beyond the bound the frame is
    returned unhinted and the join falls back to a shuffle join that AQE may still
    demote to a broadcast from real run-time sizes.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
