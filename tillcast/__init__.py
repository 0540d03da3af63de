"""tillcast — retail sales analytics and forecasting as Spark DataFrame jobs.

Layers (all lazy ``DataFrame -> DataFrame`` functions, chained with ``.transform``):

* ``sources``   — CSV / table readers and writers, the adapter from the driver's
  TPC-H-style tables to the retail model, table readiness.
* ``functions`` — column expressions shared by every layer (calendar codes,
  money in cents, safe ratios, half-to-even rounding).
* ``operators`` — calendar, cleaning, melt, fact joins, features, gold marts,
  KPIs, forecasting, data quality.
* ``plans``     — the end-to-end job and the query registry used by the driver.
* ``streaming`` — the same silver → gold marts run incrementally with
  Structured Streaming over a directory of new fact files.
"""

__all__ = ["session"]
