"""Raw M5-style CSV inputs: calendar, weekly sell prices and the wide daily sales.

All three are read with explicit schemas — no inference pass. The wide sales
schema is built from the header line (6 string keys + an int per ``d_<n>``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillcast.schemas import CALENDAR, PRICES, wide_sales_schema

CALENDAR_FILE = "calendar.csv"
PRICES_FILE = "sell_prices.csv"
SALES_FILE = "sales_train_validation.csv"


@dataclass
class RawInputs:
    calendar: DataFrame
    prices: DataFrame
    sales: DataFrame


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("mode", "FAILFAST")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark).schema(CALENDAR).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark).schema(PRICES).csv(path)


def read_sales_wide(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales with a header-derived schema; ``enforceSchema=False`` makes
    Spark check the header of every file against it."""
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"empty sales file: {path}")
    names = [h.strip().strip('"') for h in header.value.split(",")]
    return (_csv(spark).schema(wide_sales_schema(names)).option("enforceSchema", False).csv(path))


def read_raw(spark: SparkSession, raw_dir: str) -> RawInputs:
    """All three inputs; a missing file is reported by name (no data is made up)."""
    missing, out = [], {}
    for key, name, reader in (("calendar", CALENDAR_FILE, read_calendar),
                              ("prices", PRICES_FILE, read_prices),
                              ("sales", SALES_FILE, read_sales_wide)):
        try:
            out[key] = reader(spark, f"{raw_dir.rstrip('/')}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                missing.append(name)
            else:
                raise
    if missing:
        raise FileNotFoundError(f"raw input files missing under {raw_dir}: {missing}")
    return RawInputs(**out)
