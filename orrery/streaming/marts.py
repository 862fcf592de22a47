"""The five result sets of the dashboard, kept up to date from streams of facts (T-03).

A mart keeps one row of mergeable aggregates per result row (sums and counts, greatest
values, the latest row by date), in a versioned table partitioned by one of its keys. A
micro-batch is aggregated the same way, merged with the partitions it touches and
published as a new version; the other partitions are neither read nor written. Readers
always see a whole version, and old ones are removed. What is not mergeable (a ratio, a
rank, the top-k) is worked out of the state when it is read, so a group that rises or falls
enters or leaves the top-k by itself.

A fact can be taken back: rows whose ``retract`` is true are subtracted from sums and counts, and
a group without rows left goes. Greatest and latest values cannot be taken back, only
overtaken; their marts refuse such rows. A replayed micro-batch is known by its id and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.sources.versions import VersionedTable
from orrery.streaming.sources import stream_path

RETRACT = "retract"
_ROWS = "__rows"


@dataclass(frozen=True)
class Kept:
    """One mergeable column of a state: how rows (with their sign, 1 or -1) make it, and how two states make one."""
    name: str
    first: Callable[[Column], Column]
    merge: Callable[[Column], Column]
    retractable: bool = True


def summed(name: str, column: str, kind: str = "double") -> Kept:
    return Kept(name, lambda sign: F.sum(F.col(column) * sign).cast(kind), lambda c: F.sum(c).cast(kind))


def counted(name: str, column: str) -> Kept:
    return Kept(name, lambda sign: F.sum(F.when(F.col(column).isNotNull(), sign).otherwise(0)).cast("long"), lambda c: F.sum(c).cast("long"))


def greatest(name: str, column: str) -> Kept:
    return Kept(name, lambda sign: F.max(column), lambda c: F.max(c), False)


def latest(name: str, *columns: str) -> Kept:
    """The row that is greatest by the columns in their order."""
    return Kept(name, lambda sign: F.max(F.struct(*columns)), lambda c: F.max(c), False)


@dataclass(frozen=True)
class LiveMart:
    keys: tuple[str, ...]  # of a state row
    partition: str  # SQL expression over the keys with few values
    kept: tuple[Kept, ...]
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows  # facts to rows with the keys

    def state(self, rows: DataFrame) -> DataFrame:
        """State of some rows by themselves."""
        sign = F.when(F.coalesce(F.col(RETRACT), F.lit(False)), -1).otherwise(1) if RETRACT in rows.columns else F.lit(1)
        if RETRACT in rows.columns and not all(k.retractable for k in self.kept):
            sign = F.when(F.col(RETRACT), F.raise_error(F.lit("greatest and latest values cannot be taken back"))).otherwise(1).cast("int")
        return self.prepare(rows).groupBy(*self.keys).agg(*[k.first(sign).alias(k.name) for k in self.kept], F.sum(sign).cast("long").alias(_ROWS))

    def merged(self, a: DataFrame, b: DataFrame | None) -> DataFrame:
        if b is None:
            return a.filter(F.col(_ROWS) != 0)
        out = a.unionByName(b).groupBy(*self.keys).agg(*[k.merge(F.col(k.name)).alias(k.name) for k in self.kept], F.sum(_ROWS).cast("long").alias(_ROWS))
        return out.filter(F.col(_ROWS) != 0)  # below zero: taken back before it came

    def update(self, table: VersionedTable, rows: DataFrame, epoch: int, keep: int = 2) -> bool:
        """Take in a micro-batch; False if it was in already."""
        head = table.head()
        if head and int(head["label"]) >= epoch:
            return False
        new = self.state(rows).persist()  # a row per touched group, used twice
        try:
            touched = [r["p"] for r in new.select(F.expr(self.partition).alias("p")).distinct().collect()]  # few values by contract
            if touched:
                table.publish(self.merged(new, table.read(touched)), F.expr(self.partition), touched, str(epoch))
        finally:
            new.unpersist()
        table.vacuum(keep)
        return True


def keep_marts(spark: SparkSession, source: str, root: str, checkpoint: str, marts: dict[str, LiveMart], available_now: bool = True,
               refresh: str = "30 seconds", files_per_batch: int = 1000):
    """Stream the facts at ``source`` into the state of each mart at ``{root}/{name}``: one read of the facts for all of them."""
    schema = spark.read.parquet(source).schema
    facts = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(stream_path(source))
    tables = {name: VersionedTable(spark, f"{root}/{name}") for name in marts}

    def take_in(batch: DataFrame, epoch_id: int) -> None:
        for name, mart in marts.items():
            mart.update(tables[name], batch, epoch_id)

    w = facts.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=refresh).start()


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    state = VersionedTable(spark, f"{root}/{name}").read()
    if state is None:
        raise ValueError(f"nothing is published at {root}/{name} yet")
    return state


# ---------------------------------------------------------------- the five marts

def _year(key: str = "date_key") -> Column:
    return F.floor(F.col(key) / 10000).cast("int")


def _with_year(rows: DataFrame) -> DataFrame:
    return rows.withColumn("year", _year())


def _with_quarter(rows: DataFrame) -> DataFrame:
    close, opened = F.col("close_price").cast("double"), F.col("open_price").cast("double")
    month = F.floor(F.col("date_key") / 100) % 100
    return rows.withColumns({"year": _year(), "quarter": F.ceil(month / 3).cast("int"),
                             "ratio": F.try_divide(close, F.nullif(opened, F.lit(0.0))) - 1, "pe": F.col("pe_ratio").cast("double")})


KPI = LiveMart(("country_key", "indicator_key"), "CAST(pmod(country_key, 32) AS INT)", (latest("row", "date_key", "value", "yoy_change"),))
TREND = LiveMart(("year", "country_key", "indicator_key", "date_key"), "year", (latest("row", "value", "yoy_change"),), _with_year)
HEATMAP = LiveMart(("sector_key", "year", "quarter"), "year", (
    summed("ratio_sum", "ratio"), counted("ratio_n", "ratio"), summed("pe_sum", "pe"), counted("pe_n", "pe")), _with_quarter)
MAP = LiveMart(("year", "country_key", "indicator_key"), "year", (greatest("value", "value"),), _with_year)
TRADE = LiveMart(("exporter_key", "importer_key", "sector_key", "year"), "year", (
    summed("exports", "export_value_usd", "decimal(38,2)"), summed("imports", "import_value_usd", "decimal(38,4)"),
    summed("growth", "yoy_growth", "decimal(38,4)"), counted("growth_n", "yoy_growth")), _with_year)



def key_counts(*keys: str, buckets: int = 256) -> LiveMart:
    """Rows per key as a state, so that the uniqueness of a stored table (D-07) follows its batches without a scan of the table."""
    return LiveMart(keys, f"CAST(pmod(xxhash64({', '.join(keys)}), {buckets}) AS INT)", ())


def repeated_keys(state: DataFrame) -> DataFrame:
    """Keys held more than once, with their number: ``unique_audit`` out of the state."""
    return state.filter(F.col(_ROWS) > 1).withColumnRenamed(_ROWS, "n")


INDICATOR_MARTS = {"kpi": KPI, "trend": TREND, "map": MAP}


def kpi(state: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame, country: str, codes: Sequence[str]) -> DataFrame:
    """M-01 out of the state."""
    c = dim_country.filter(F.col("country_code") == country).select("country_key")
    i = dim_indicator.filter(F.col("indicator_code").isin(*codes)).select("indicator_key", "indicator_code")
    return state.join(c, "country_key").join(i, "indicator_key").select("indicator_code", "row.value", "row.yoy_change")


def trend(state: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame, year_start: int, countries: Sequence[str], code: str) -> DataFrame:
    """M-02 out of the state."""
    c = dim_country.filter(F.col("country_code").isin(*countries)).select("country_key", "country_code", "country_name")
    i = dim_indicator.filter(F.col("indicator_code") == code).select("indicator_key")
    rows = state.filter((F.col("year") >= year_start) & F.col("row.value").isNotNull())
    return (rows.join(c, "country_key").join(i, "indicator_key")
            .select("country_code", "country_name", "year", F.col("row.value").alias("gdp"), F.col("row.yoy_change").alias("growth"))
            .orderBy("country_code", "year"))


def heatmap(state: DataFrame, dim_sector: DataFrame, year_start: int, scale: int = 6) -> DataFrame:
    """M-03 out of the state."""
    s = dim_sector.select("sector_key", "sector_name")

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.col(total), F.nullif(F.col(n), F.lit(0)))

    return (state.filter(F.col("year") >= year_start).join(s, "sector_key")
            .select("sector_name", "year", "quarter", F.round(mean("ratio_sum", "ratio_n") * 100, scale).alias("return_pct"),
                    F.round(mean("pe_sum", "pe_n"), 4).alias("pe_ratio"))
            .orderBy(F.col("year").desc(), F.col("quarter").desc(), "sector_name"))


def country_map(state: DataFrame, dim_date: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame, as_of: Column, columns: dict[str, str]) -> DataFrame:
    """M-04 out of the state."""
    year = dim_date.filter(F.col("full_date") <= as_of).agg(F.max("year")).scalar()
    i = dim_indicator.filter(F.col("indicator_code").isin(*columns.values())).select("indicator_key", "indicator_code")
    c = dim_country.select("country_key", "country_name", "country_code", "latitude", "longitude", "region")
    j = state.filter(F.col("year") == year).join(c, "country_key").join(i, "indicator_key")
    return j.groupBy("country_name", "country_code", "latitude", "longitude", "region").agg(
        *[F.max(F.when(F.col("indicator_code") == code, F.col("value"))).alias(name) for name, code in columns.items()])


def trade_flows(state: DataFrame, dim_country: DataFrame, dim_sector: DataFrame, year_start: int, k: int = 100) -> DataFrame:
    """M-05 out of the state: the top-k of all groups as they stand."""
    ce = dim_country.select(F.col("country_key").alias("exporter_key"), F.col("country_name").alias("exporter"))
    ci = dim_country.select(F.col("country_key").alias("importer_key"), F.col("country_name").alias("importer"))
    j = (state.filter(F.col("year") >= year_start).join(ce, "exporter_key").join(ci, "importer_key")
         .join(dim_sector.select("sector_key", "sector_name"), "sector_key"))
    # keys that share a name are one flow
    g = j.groupBy("exporter", "importer", "sector_name", "year").agg(
        (F.sum("exports").cast("double") / 1e9).alias("export_bn"), (F.sum("imports").cast("double") / 1e9).alias("import_bn"),
        F.round(F.try_divide(F.sum("growth").cast("double"), F.nullif(F.sum("growth_n"), F.lit(0))), 4).alias("growth_pct"))
    return g.orderBy(F.col("export_bn").desc_nulls_first(), "exporter", "importer", "sector_name", "year").limit(k)
