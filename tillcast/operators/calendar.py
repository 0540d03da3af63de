"""Calendar dimension (one row per day): date spine, day code, year-week key, week day,
month, year, events from an event table, and benefit-day flags."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import columns as C

FUTURE_DAYS = 30

# Largest event table (days with events) that is broadcast; about 270 years of every day.
MAX_EVENT_DAYS = 100_000

# The event dates that must equal the reference's, by event.
EVENT_DATES = {
    "SuperBowl": ["2011-02-06", "2012-02-05"],
    "Thanksgiving": ["2011-11-24", "2012-11-22"],
    "Christmas": ["2011-12-25", "2012-12-25"],
    "LaborDay": ["2011-09-05", "2012-09-03"],
    "MemorialDay": ["2011-05-30", "2012-05-28"],
}
EVENT_SCHEMA = "date date, slot int, event_name string, event_type string"


def _as_col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, str)):
        return F.to_date(F.lit(str(v)))
    raise TypeError(f"not a date: {v!r}")


def known_events(spark: SparkSession) -> DataFrame:
    """The event table (``EVENT_SCHEMA``) of the known dates above."""
    rows = [(_dt.date.fromisoformat(d), None, name, C.EVENT_TYPES[name])
            for name, dates in EVENT_DATES.items() for d in dates]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def _spine(spark: SparkSession, start, end) -> DataFrame:
    days = F.sequence(_as_col(start), _as_col(end))
    return spark.range(1).select(F.explode(days).alias("date"))


def yearly_events(spark: SparkSession, start, end) -> DataFrame:
    """The event table of all yearly events from ``start`` to ``end``, by their rules; it
    holds the known dates among others."""
    name = C.event_name("date")
    return (_spine(spark, start, end)
            .select("date", F.lit(1).alias("slot"), name.alias("event_name"), C.event_type(name).alias("event_type"))
            .filter("event_name IS NOT NULL"))


def events_by_day(events: DataFrame) -> DataFrame:
    """``events(date, slot, event_name, event_type)`` as one row per day with the two slots
    that a calendar has. A day's events are ordered by slot (null last), then name; the
    first is slot 1, the second slot 2. Further ones are not lost: they join slot 2,
    separated by `` + ``. A repeated event counts once; rows without date or name are
    no events."""
    one = F.struct(F.coalesce(F.col("slot"), F.lit(2**31 - 1)).alias("slot"), F.col("event_name").alias("name"),
                   F.coalesce("event_type", F.lit("")).alias("type"))
    days = (events.filter("date IS NOT NULL AND coalesce(event_name, '') <> ''").groupBy("date")
            .agg(F.array_sort(F.collect_set(one)).alias("e")))
    rest = F.slice("e", 2, F.greatest(F.size("e") - 1, F.lit(0)))

    def later(field: str) -> Column:
        return F.when(F.size("e") > 1, F.array_join(F.transform(rest, lambda x: x[field]), " + "))

    first = F.get("e", F.lit(0))
    return days.select("date", first["name"].alias("event_name_1"), first["type"].alias("event_type_1"),
                       later("name").alias("event_name_2"), later("type").alias("event_type_2"))


def calendar_dim(spark: SparkSession, start, end, events: DataFrame | None = None) -> DataFrame:
    """Calendar from ``start`` to ``end`` inclusive, as a raw file would read:
    days without an event carry null event names.

    ``start``/``end`` are dates or date Columns (e.g. scalar subqueries over the
    fact). Size is the number of days, independent of the data volume. ``events`` is an
    event table, joined by date (broadcast only after its days are counted); by default
    the yearly events of these days, which are no more than the days themselves.
    """
    s = _as_col(start)
    if events is None:
        days = F.broadcast(events_by_day(yearly_events(spark, start, end)))
    else:
        days = C.checked_broadcast(events_by_day(events), MAX_EVENT_DAYS)
    spine = _spine(spark, start, end).join(days, "date", "left")
    return spine.select(
        F.col("date"),
        C.year_week("date").alias("wm_yr_wk"),
        C.weekday_name("date").alias("weekday"),
        C.m5_wday("date").alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        # d_1 is the first day of the calendar
        F.concat(F.lit("d_"), (F.datediff(F.col("date"), s) + 1).cast("string")).alias("d"),
        "event_name_1", "event_type_1", "event_name_2", "event_type_2",
        *[(F.dayofmonth("date") <= n).cast("int").alias(k) for k, n in C.SNAP_LAST_DAY.items()],
    )
