"""Explicit schemas of the raw zone, staging, dimensions and facts (S-02, S-09)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType, TimestampType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_OBSERVATION = _s(
    ("indicator_code", StringType()), ("country_code_2", StringType()), ("period", StringType()),
    ("value", DoubleType()), ("unit", StringType()), ("source", StringType()),
    ("pipeline_run_id", StringType()), ("loaded_at", StringType()),
)

TRANSFORMED_OBSERVATION = _s(
    ("date_key", IntegerType()), ("country_code", StringType()), ("indicator_code", StringType()),
    ("source", StringType()), ("value", DoubleType()), ("yoy_change", DoubleType()),
    ("is_estimated", BooleanType()), ("is_anomaly", BooleanType()), ("pipeline_run_id", StringType()),
    ("load_timestamp", TimestampType()),
)

STAGING = _s(
    ("raw_id", LongType()), ("source", StringType()), ("country_code", StringType()),
    ("indicator_code", StringType()), ("period", StringType()), ("raw_value", StringType()),
    ("unit", StringType()), ("loaded_at", TimestampType()), ("processed", BooleanType()),
    ("error_message", StringType()),
)

DIM_DATE = _s(
    ("date_key", IntegerType()), ("full_date", DateType()), ("year", ShortType()), ("quarter", ShortType()),
    ("month", ShortType()), ("month_name", StringType()), ("week", ShortType()), ("day_of_month", ShortType()),
    ("day_name", StringType()), ("is_weekend", BooleanType()), ("fiscal_year", ShortType()),
    ("fiscal_quarter", ShortType()),
)

DIM_COUNTRY = _s(
    ("country_key", IntegerType()), ("country_code", StringType()), ("country_name", StringType()),
    ("region", StringType()), ("sub_region", StringType()), ("income_group", StringType()),
    ("currency_code", StringType()), ("latitude", DecimalType(9, 6)), ("longitude", DecimalType(9, 6)),
    ("population", LongType()), ("area_sq_km", LongType()), ("is_g20", BooleanType()), ("is_eu", BooleanType()),
    ("created_at", TimestampType()),
)

DIM_INDICATOR = _s(
    ("indicator_key", IntegerType()), ("indicator_code", StringType()), ("indicator_name", StringType()),
    ("category", StringType()), ("sub_category", StringType()), ("unit", StringType()), ("source", StringType()),
    ("frequency", StringType()), ("description", StringType()), ("is_active", BooleanType()),
)

DIM_SECTOR = _s(
    ("sector_key", IntegerType()), ("sector_code", StringType()), ("sector_name", StringType()),
    ("gics_code", StringType()), ("description", StringType()),
)

DIM_SOURCE = _s(
    ("source_key", IntegerType()), ("source_name", StringType()), ("source_url", StringType()),
    ("api_endpoint", StringType()), ("reliability", ShortType()), ("last_updated", TimestampType()),
)

FACT_ECONOMIC_INDICATORS = _s(
    ("indicator_id", LongType()), ("date_key", IntegerType()), ("country_key", IntegerType()),
    ("indicator_key", IntegerType()), ("source_key", IntegerType()), ("value", DecimalType(20, 6)),
    ("yoy_change", DecimalType(10, 4)), ("qoq_change", DecimalType(10, 4)), ("mom_change", DecimalType(10, 4)),
    ("is_estimated", BooleanType()), ("is_revised", BooleanType()), ("load_timestamp", TimestampType()),
    ("pipeline_run_id", StringType()),
)

FACT_TRADE_FLOWS = _s(
    ("trade_id", LongType()), ("date_key", IntegerType()), ("exporter_key", IntegerType()),
    ("importer_key", IntegerType()), ("sector_key", IntegerType()), ("export_value_usd", DecimalType(20, 2)),
    ("import_value_usd", DecimalType(20, 2)), ("trade_balance", DecimalType(20, 2)),
    ("yoy_growth", DecimalType(10, 4)), ("load_timestamp", TimestampType()),
)

FACT_MARKET_DATA = _s(
    ("market_id", LongType()), ("date_key", IntegerType()), ("country_key", IntegerType()),
    ("sector_key", IntegerType()), ("index_name", StringType()), ("open_price", DecimalType(12, 4)),
    ("close_price", DecimalType(12, 4)), ("high_price", DecimalType(12, 4)), ("low_price", DecimalType(12, 4)),
    ("volume", LongType()), ("market_cap_usd", DecimalType(20, 2)), ("pe_ratio", DecimalType(10, 4)),
    ("load_timestamp", TimestampType()),
)

PIPELINE_METRICS = _s(
    ("run_id", StringType()), ("stage", StringType()), ("record_count", LongType()), ("status", StringType()),
    ("recorded_at", TimestampType()),
)

def declared(df, schema: StructType, defaults: dict | None = None):
    """``df`` with exactly the columns of ``schema``, in its order and types; a column that it
    lacks gets its default, or NULL."""
    from pyspark.sql import Column
    from pyspark.sql import functions as F
    defaults = defaults or {}

    def one(f):
        if f.name in df.columns:
            return F.col(f.name)
        value = defaults.get(f.name)
        return value if isinstance(value, Column) else F.lit(value)

    return df.select(*[one(f).cast(f.dataType).alias(f.name) for f in schema.fields])


TABLES = {
    "dim_date": DIM_DATE, "dim_country": DIM_COUNTRY, "dim_indicator": DIM_INDICATOR, "dim_sector": DIM_SECTOR,
    "dim_source": DIM_SOURCE, "fact_economic_indicators": FACT_ECONOMIC_INDICATORS,
    "fact_trade_flows": FACT_TRADE_FLOWS, "fact_market_data": FACT_MARKET_DATA, "stg_raw_indicators": STAGING,
}
