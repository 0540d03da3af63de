import datetime as dt

from pyspark.sql import functions as F

from tillcast.operators import kpi

D0 = dt.date(2011, 1, 29)
COLS = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, " \
       "date date, sales int, revenue_cents long, price_cents long"


def _fact(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_growth_zero_when_previous_week_empty_and_asp_zero_without_units(spark):
    rows = [("a", "I1", "D", "C", "S1", "T", D0 + dt.timedelta(days=20), 0, 0, 100)]
    f = _fact(spark, rows)
    g = kpi.kpi_wow_growth(f).first()
    assert g.growth_rate_wow == 0.0 and g.prev_7_revenue == 0.0
    t = kpi.kpi_totals(f).first()
    assert t.average_selling_price == 0.0 and t.total_units_sold == 0


def test_wow_windows_are_half_open(spark):
    last = D0 + dt.timedelta(days=20)
    rows = [("a", "I1", "D", "C", "S1", "T", last - dt.timedelta(days=k), 1, c, 100)
            for k, c in [(0, 100), (6, 100), (7, 50), (13, 50), (14, 999)]]
    g = kpi.kpi_wow_growth(_fact(spark, rows)).first()
    assert (g.last_7_revenue, g.prev_7_revenue, g.growth_rate_wow) == (2.0, 1.0, 100.0)


def test_top_and_worst_tie_breaks(spark):
    rows = [(f"{i}", i, "D", "C", "S1", "T", D0, 1, c, 1) for i, c in
            [("B", 500), ("A", 500), ("C", 300), ("D", 100), ("E", 100), ("F", 100), ("G", 900)]]
    f = _fact(spark, rows)
    assert [r.item_id for r in kpi.top_products(f, 3).collect()] == ["G", "A", "B"]
    # worst 3 = tail of the (revenue desc, item asc) order, shown in that order
    assert [r.item_id for r in kpi.top_products(f, 3, worst=True).collect()] == ["D", "E", "F"]


def test_summary_text_layout(spark):
    rows = [("a", "I1", "D", "C1", "S1", "T1", D0, 1234, 123456789, 1), ("b", "I2", "D", "C2", "S2", "T2", D0, 5, 10, 2)]
    f = _fact(spark, rows)
    fc = spark.createDataFrame([("a", D0 + dt.timedelta(days=1), 12345, 2.5), ("a", D0 + dt.timedelta(days=2), 2, 2.5)],
                               "id string, date date, sales int, sell_price double")
    s = kpi.kpi_summary(f, fc).first()
    total_rev, total_units, fr, fu = 1234567.99, 1239, (12345 + 2) * 2.5, 12347
    want = (
        "HISTORICAL GENERAL METRICS:\n"
        f"- Total Revenue: ${total_rev:,.2f}\n"
        f"- Total Units Sold: {total_units:,}\n"
        "- Top Category: C1\n"
        "- Top Performing Store: S1 (located in state T1)\n"
        "- Top Performing State: T1\n\n"
        "FUTURE 30-DAY FORECAST METRICS:\n"
        f"- Forecasted Total Revenue: ${fr:,.2f}\n"
        f"- Forecasted Units Sold: {fu:,}\n"
        f"- Average Forecasted Daily Sales: {fu / 2:.1f} units\n"
    )
    assert s.summary == want
    q = kpi.question_context(spark.createDataFrame([("why?",)], "text string"), kpi.kpi_summary(f, fc)).first()
    assert q.prompt.endswith("User Question: why?\nAssistant Response:") and want in q.prompt


def test_share_and_ranking(spark):
    rows = [("a", "I1", "D", "C1", "S1", "T", D0, 1, 300, 1), ("b", "I2", "D", "C2", "S2", "T", D0, 1, 100, 1),
            ("c", "I3", "D", "C2", "S3", "T", D0, 1, 300, 1)]
    f = _fact(spark, rows)
    share = {r.cat_id: r.share_pct for r in kpi.category_share(f).collect()}
    assert share == {"C1": 300 / 700 * 100.0, "C2": 400 / 700 * 100.0}
    ranks = [(r.store_id, r.revenue_rank) for r in kpi.store_ranking(f.withColumn("sell_price", F.lit(1.0))).collect()]
    assert ranks == [("S1", 1), ("S3", 2), ("S2", 3)]
