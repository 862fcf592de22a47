"""Warehouse bootstrap: calendar and seeded dimensions, written idempotently,
plus the seed-style fact builders (array series -> facts, market grid).

Re-running ``bootstrap`` adds nothing: each dimension is loaded
insert-if-absent on its natural key (source names included, so a re-seed
cannot duplicate a source and fan out later joins), and new rows get keys
after the current maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery.functions.keys import index_label, with_defaults
from orrery.functions.period import quarter_end_key
from orrery.operators.change import pct_change_prev
from orrery.operators.dims import calendar, sequential_keys
from orrery.operators.load import append_rows, observed_rows
from orrery.operators.reshape import arrays_to_long
from orrery.schemas import TABLES, declared
from orrery.sources import seeds

# Column defaults of the dimension tables.
NOW = "current_timestamp()"
DEFAULTS = {
    "dim_country": {"is_g20": False, "is_eu": False, "created_at": NOW},
    "dim_indicator": {"is_active": True},
    "dim_sector": {},
    "dim_source": {"reliability": 5, "last_updated": NOW},
}

DIMENSIONS = {
    # table: (natural key, surrogate key, seed frame)
    "dim_country": ("country_code", "country_key", seeds.countries),
    "dim_indicator": ("indicator_code", "indicator_key", seeds.indicators),
    "dim_sector": ("sector_code", "sector_key", seeds.sectors),
    "dim_source": ("source_name", "source_key", seeds.sources),
}


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    from orrery.session import path_exists
    return spark.read.parquet(path) if path_exists(spark, path) else None  # None: not written yet


def add_dimension_rows(spark: SparkSession, path: str, rows: DataFrame, natural: str, surrogate: str,
                       schema: StructType | None = None, order: Sequence[str] = ()) -> int:
    """Append the rows of ``rows`` whose natural key is new, with keys after the current max,
    in the declared columns and types if a schema is given. New rows are numbered by ``order``, or as they come.

    New rows are numbered in their order within range partitions from the stored maximum on
    (``sequential_keys``), so a dimension of any size continues densely and a key that was
    given never changes. Returns the number of rows added.
    """
    existing = _read_or_none(spark, path)
    ordered = rows.withColumn("__ord", F.monotonically_increasing_id())  # input order
    rest = [c for c in rows.columns if c != natural]
    new = ordered.groupBy(natural).agg(F.min("__ord").alias("__ord"),
                                       *[F.min_by(c, "__ord").alias(c) for c in rest])  # first occurrence wins
    start = 0
    if existing is not None:
        new = new.join(existing.select(natural), natural, "left_anti")
        start = existing.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    new = sequential_keys(new, order or ["__ord"], surrogate, start + 1).withColumn(surrogate, F.col(surrogate).cast("int")).drop("__ord")
    cols = [surrogate] + [c for c in new.columns if c != surrogate]
    obs = Observation("dimension")
    out = (declared(new, schema) if schema else new.select(*cols)).observe(obs, F.count(F.lit(1)).alias("rows"))
    append_rows(out, path)
    return observed_rows(obs)


def bootstrap(spark: SparkSession, warehouse: str, start: str = "2015-01-01", end: str = "2030-12-31",
              fiscal_shift_months: int = 0) -> dict[str, int]:
    """Write the calendar (overwrite) and insert-if-absent the seeded dimensions."""
    declared(calendar(spark, start, end, fiscal_shift_months), TABLES["dim_date"]).coalesce(1).write.mode("overwrite").parquet(
        f"{warehouse}/dim_date")
    added = {}
    for table, (natural, surrogate, seed) in DIMENSIONS.items():
        rows = with_defaults(seed(spark), {c: F.current_timestamp() if v == NOW else v for c, v in DEFAULTS[table].items()})
        added[table] = add_dimension_rows(spark, f"{warehouse}/{table}", rows, natural, surrogate, TABLES[table])
    return added


def facts_from_arrays(series: DataFrame, key: str, measures: dict[str, str], base_year: int,
                      scale_factors: dict[str, float] | None = None, change_for: Sequence[str] = (),
                      change_scale: int = 2) -> DataFrame:
    """Seed-style facts from wide yearly arrays (L-03, P-09, F-10, W-02 seed variant).

    ``series`` has one row per ``key`` and one array column per measure
    (``measures`` maps column -> indicator code). Values are scaled by
    ``scale_factors``; a measure in ``change_for`` gets a change against the
    previous year divided by the signed previous value, and treats 0 as missing.
    Returns ``(key, year, date_key, indicator_code, value, yoy_change)``.
    """
    scale_factors = scale_factors or {}
    long = arrays_to_long(series, [key], list(measures), base_year, "year", drop_falsy=list(change_for))
    parts = []
    for col, code in measures.items():
        v = F.col(col) * F.lit(scale_factors.get(col, 1.0))
        part = long.select(key, "year", v.alias("value"))
        if col in change_for:
            # previous array position, even when it is missing (then the change is NULL)
            part = pct_change_prev(part, [key], ["year"], "value", "yoy_change", change_scale, use_abs=False,
                                   keep_prev=False)
        else:
            part = part.withColumn("yoy_change", F.lit(None).cast("double"))
        parts.append(part.filter(F.col("value").isNotNull()).withColumn("indicator_code", F.lit(code)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("date_key", F.concat(F.col("year").cast("string"), F.lit("1231")).cast("int")) \
              .select(key, "year", "date_key", "indicator_code", "value", "yoy_change")


def market_grid(years: Column, sectors: DataFrame, countries: Column) -> DataFrame:
    """Year x quarter x sector x country scaffold with quarter-end keys and index labels
    (J-07, P-05, P-12). ``years`` and ``countries`` are array columns; the grid size
    is bounded by the dimensions, not by data."""
    g = sectors.select("sector_key").withColumns({
        "year": F.explode(years)}).withColumn("quarter", F.explode(F.sequence(F.lit(1), F.lit(4)))) \
        .withColumn("country_key", F.explode(countries))
    return g.select("year", "quarter", "sector_key", "country_key",
                    quarter_end_key("year", "quarter").alias("date_key"),
                    index_label("country_key", "sector_key").alias("index_name"))


__all__ = ["bootstrap", "add_dimension_rows", "facts_from_arrays", "market_grid"]
