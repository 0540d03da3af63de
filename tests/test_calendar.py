import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.operators import calendar, forecast
from tillcast.operators.calendar import calendar_dim

D = dt.date


def _cal(spark, lo, hi):
    return {r.date: r for r in calendar_dim(spark, lo, hi).collect()}


def test_spine_codes_and_week_keys(spark):
    cal = _cal(spark, D(2011, 1, 29), D(2012, 1, 2))
    assert len(cal) == 339
    first = cal[D(2011, 1, 29)]
    assert (first.d, first.weekday, first.wday, first.month, first.year) == ("d_1", "Saturday", 1, 1, 2011)
    assert cal[D(2011, 1, 30)].wday == 2 and cal[D(2011, 1, 31)].wday == 3 and cal[D(2011, 2, 4)].wday == 7
    assert cal[D(2012, 1, 1)].wm_yr_wk == 1252      # calendar year with ISO week
    assert cal[D(2012, 1, 2)].wm_yr_wk == 1201
    assert cal[D(2011, 1, 30)].d == "d_2"


def test_events_follow_the_holiday_rules(spark):
    cal = _cal(spark, D(2011, 1, 1), D(2012, 12, 31))
    expected = {
        D(2011, 2, 6): ("SuperBowl", "Sporting"), D(2012, 2, 5): ("SuperBowl", "Sporting"),
        D(2011, 11, 24): ("Thanksgiving", "National"), D(2012, 11, 22): ("Thanksgiving", "National"),
        D(2011, 12, 25): ("Christmas", "National"), D(2012, 12, 25): ("Christmas", "National"),
        D(2011, 9, 5): ("LaborDay", "National"), D(2012, 9, 3): ("LaborDay", "National"),
        D(2011, 5, 30): ("MemorialDay", "National"), D(2012, 5, 28): ("MemorialDay", "National"),
    }
    got = {d: (r.event_name_1, r.event_type_1) for d, r in cal.items() if r.event_name_1 is not None}
    assert got == expected
    assert all(r.event_name_2 is None for r in cal.values())


def test_snap_flags(spark):
    cal = _cal(spark, D(2011, 3, 9), D(2011, 3, 16))
    flags = [(r.snap_CA, r.snap_TX, r.snap_WI) for _, r in sorted(cal.items())]
    assert flags == [(1, 1, 1), (1, 1, 1), (0, 1, 1), (0, 1, 1), (0, 1, 1), (0, 1, 1), (0, 1, 0), (0, 0, 0)]


def test_half_even_and_safe_ratio(spark):
    df = spark.createDataFrame([(-0.4, 0.0), (0.5, 2.0), (1.5, 0.0), (2.5, 4.0)], "x double, d double")
    rows = df.select(forecast.finish(F.col("x")).alias("r"), C.safe_ratio("x", "d").alias("q")).collect()
    assert [r.r for r in rows] == [0, 0, 2, 2]
    assert [r.q for r in rows] == [0.0, 0.25, 0.0, 0.625]


def test_known_event_dates_follow_the_rules(spark):
    """The known dates as an event table give the calendar that the rules give."""
    by_rule = _cal(spark, D(2011, 1, 1), D(2012, 12, 31))
    known = calendar_dim(spark, D(2011, 1, 1), D(2012, 12, 31), events=calendar.known_events(spark))
    assert {r.date: r for r in known.collect()} == by_rule


def test_super_bowl_of_each_era(spark):
    days = {r.date for r in calendar.yearly_events(spark, D(1992, 1, 1), D(2023, 12, 31)).collect()
            if r.event_name == "SuperBowl"}
    assert len(days) == 32
    assert {D(1992, 1, 26), D(1993, 1, 31), D(1998, 1, 25), D(2001, 1, 28), D(2002, 2, 3), D(2003, 1, 26), D(2004, 2, 1),
            D(2012, 2, 5), D(2021, 2, 7), D(2022, 2, 13), D(2023, 2, 12)} <= days


def test_several_events_on_a_day_fill_the_slots(spark):
    day, other = D(2016, 5, 8), D(2016, 5, 9)
    rows = [(day, 2, "Mother's day", "Cultural"), (day, 1, "VE day", None), (day, 1, "VE day", None),
            (other, None, "B", "X"), (other, None, "A", "Y"), (other, 7, "C", "Z"), (other, 9, "D", "Z"),
            (None, 1, "lost", "X"), (day, 3, None, "X"), (D(1900, 1, 1), 1, "outside", "X")]
    events = spark.createDataFrame(rows, calendar.EVENT_SCHEMA)
    cal = {r.date: r for r in calendar_dim(spark, day, D(2016, 5, 10), events=events).collect()}
    assert len(cal) == 3
    got = {d: (r.event_name_1, r.event_type_1, r.event_name_2, r.event_type_2) for d, r in cal.items()}
    assert got == {day: ("VE day", "", "Mother's day", "Cultural"), other: ("C", "Z", "D + A + B", "Z + Y + X"),
                   D(2016, 5, 10): (None, None, None, None)}


def test_empty_event_table(spark):
    events = spark.createDataFrame([], calendar.EVENT_SCHEMA)
    cal = calendar_dim(spark, D(2011, 12, 24), D(2011, 12, 26), events=events).collect()
    assert len(cal) == 3 and all(r.event_name_1 is None for r in cal)
