"""Named queries whose tables keep state between runs or micro-batches: the incremental
pipeline, fact revisions, live marts and change windows over streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators import audit
from orrery.operators.history import as_of
from orrery.plans import registry as reg
from orrery.plans import standins as si
from orrery.plans.bootstrap import add_dimension_rows
from orrery.plans.incremental import Warehouse
from orrery.session import work_dir
from orrery.sources import sinks
from orrery.sources.payload import build_payloads
from orrery.sources.tables import Tables
from orrery.sources.versions import VersionedTable
from orrery.streaming import marts as live
from orrery.streaming.changes import keep_changes
from orrery.streaming.ingest import ingest_checked, read_zone

RUN_TIMES = ("2001-01-01", "2001-02-01", "2001-03-01")


def three_runs(t: Tables) -> dict[str, DataFrame]:
    """The faulty observations of the end-to-end query in three runs: the periods before 1997; those
    from 1996 on, with the totals of 1996 revised; and a late revision of one country's counts of 1995."""
    path = f"{work_dir(t.spark, 'observations')}/raw"
    reg.end_to_end_raw(t).write.parquet(path)
    raw = t.spark.read.parquet(path)
    code, period, value = F.col("indicator_code"), F.col("period"), F.col("value")
    second = raw.filter(period >= "1996").withColumn("value", F.when((code == "ORD.TOTAL") & period.startswith("1996"), value * 1.25).otherwise(value))
    third = raw.filter((F.col("country_code_2") == "N00") & (code == "ORD.COUNT") & period.startswith("1995")).withColumn("value", value * 2)
    return {"run_a": raw.filter(period < "1997"), "run_b": second, "run_c": third}


def loaded_warehouse(spark: SparkSession, sf: str) -> tuple[Warehouse, list]:
    t = Tables(spark, sf)
    dims = {"country": si.dim_country(t), "indicator": si.indicator_keys(), "source": si.source_keys(), "date": si.dim_date(t)}
    w = Warehouse(spark, f"{work_dir(spark, 'incremental')}/warehouse", buckets=16)
    reports = [w.run(raw, run, dims, F.lit(at).cast("timestamp"), si.STANDIN_ISO2)
               for (run, raw), at in zip(three_runs(t).items(), RUN_TIMES)]
    return w, reports


def q_pipeline_incremental(spark, sf):
    """Every observation with its outcome after three runs, each scored at the cost of the series it touched."""
    w, _ = loaded_warehouse(spark, sf)
    return w.observations().select(F.coalesce("country_iso3", "country_code_2").alias("country_code"), "indicator_code", "period", "frequency",
                                   "date_key", "value", "yoy_change", "is_anomaly", "reason")


def q_facts_as_of(spark, sf):
    """The fact as it was after each of the three runs, with its revisions."""
    w, _ = loaded_warehouse(spark, sf)
    out = None
    for n, at in enumerate(RUN_TIMES, 1):
        rows = as_of(w.fact_history(), F.lit(at).cast("timestamp")).select(
            F.lit(n).alias("after_run"), "date_key", "country_key", "indicator_key", "frequency", "value", "yoy_change", "is_revised")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- live marts and changes

def deliveries(df: DataFrame, path: str, parts: int, key: str):
    """Append the rows to ``path`` in ``parts`` shares by the hash of a column, handing over after each."""
    df.write.parquet(f"{path}-all")
    rows = df.sparkSession.read.parquet(f"{path}-all")
    for n in range(parts):
        rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == n).write.mode("append").parquet(path)
        yield n


def _live_state(spark: SparkSession, name: str, mart: live.LiveMart, facts: DataFrame, key: str, parts: int = 3) -> DataFrame:
    base = work_dir(spark, f"live-{name}")
    for _ in deliveries(facts, f"{base}/facts", parts, key):
        live.keep_marts(spark, f"{base}/facts", f"{base}/marts", f"{base}/checkpoint", {name: mart})
    return live.published(spark, f"{base}/marts", name)


def _yearly_facts(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    facts, d = reg._fact_yearly(t)
    return facts.select("date_key", "country_key", "indicator_key", "value", "yoy_change"), d


def q_live_kpi(spark, sf):
    """The KPI mart from three micro-batches of facts."""
    facts, d = _yearly_facts(Tables(spark, sf))
    state = _live_state(spark, "kpi", live.KPI, facts, "date_key")
    return live.kpi(state, d["country"], d["indicator"], reg.KPI_COUNTRY, si.INDICATOR_CODES)


def q_live_trend(spark, sf):
    facts, d = _yearly_facts(Tables(spark, sf))
    state = _live_state(spark, "trend", live.TREND, facts, "country_key")
    return live.trend(state, d["country"], d["indicator"], reg.TREND_YEAR_START, reg.TREND_COUNTRIES, reg.TREND_CODE)


def q_live_country_map(spark, sf):
    facts, d = _yearly_facts(Tables(spark, sf))
    state = _live_state(spark, "map", live.MAP, facts, "indicator_key")
    return live.country_map(state, d["date"], d["country"], d["indicator"], F.lit(reg.MAP_AS_OF).cast("date"), reg.MAP_COLUMNS)


def q_live_heatmap(spark, sf):
    t = Tables(spark, sf)
    sectors = si.dim_sector(t)
    prices = si.market_prices(t, since_year=reg.HEATMAP_YEAR_START, sectors=sectors)
    state = _live_state(spark, "heatmap", live.HEATMAP, prices.select("date_key", "sector_key", "open_price", "close_price", "pe_ratio"), "close_price")
    return live.heatmap(state, sectors, reg.HEATMAP_YEAR_START)


def q_live_trade_flows(spark, sf):
    """The trade mart from four micro-batches; the third brings a fifth of the facts once more, the fourth takes these back."""
    t = Tables(spark, sf)
    sectors = si.dim_sector(t)
    facts = si.trade_fact(t, since_year=reg.TRADE_YEAR_START - 1, sectors=sectors).select(
        "trade_id", "date_key", "exporter_key", "importer_key", "sector_key", "export_value_usd", "import_value_usd", "yoy_growth")
    base = work_dir(spark, "live-trade")
    facts.write.parquet(f"{base}/all")
    facts = spark.read.parquet(f"{base}/all")
    half, twice = F.pmod("trade_id", F.lit(2)) == 0, F.pmod("trade_id", F.lit(5)) == 0
    for part, taken_back in ((half, False), (~half, False), (twice, False), (twice, True)):
        facts.filter(part).withColumn("retract", F.lit(taken_back)).write.mode("append").parquet(f"{base}/facts")
        live.keep_marts(spark, f"{base}/facts", f"{base}/marts", f"{base}/checkpoint", {"trade": live.TRADE})
    return live.trade_flows(live.published(spark, f"{base}/marts", "trade"), si.dim_country(t), sectors, reg.TRADE_YEAR_START, 100)


def q_stream_changes(spark, sf):
    """Changes of the monthly totals after four micro-batches in shuffled order: first deliveries wrong for a
    third of the months, right ones later, and months before others that they score."""
    t = Tables(spark, sf)
    base = work_dir(spark, "stream-changes")
    reg._nation_series(t, "month").select("country_code", reg.change.period_index("year", "sub", 12).alias("idx"), "value").write.parquet(f"{base}/all")
    rows, month = spark.read.parquet(f"{base}/all"), F.col("idx")
    late, wrong = month % 2 == 0, month % 3 == 0
    batches = [rows.filter(~late & ~wrong).withColumn("version", F.lit(1)),
               rows.filter(wrong).withColumn("value", F.col("value") + 1000).withColumn("version", F.lit(1)),
               rows.filter(late | (F.col("country_code") == "N00")).withColumn("version", F.lit(2)),
               rows.filter(wrong).withColumn("version", F.lit(3))]
    for batch in batches:
        batch.write.mode("append").parquet(f"{base}/observations")
        keep_changes(spark, f"{base}/observations", f"{base}/state", f"{base}/checkpoint", ["country_code"], "idx", "value", ["version"],
                     {"mom_change": 1, "yoy_change": 12}, buckets=8)
    state = VersionedTable(spark, f"{base}/state").read()
    return state.select("country_code", F.floor(month / 12).cast("int").alias("year"), (month % 12 + 1).cast("int").alias("month"), "value",
                        "change_prev", "mom_change", "yoy_change")


# ---------------------------------------------------------------- checked loads

def q_staging_reload(spark, sf):
    """Three reloads of a staging table behind a gate: the finished orders, then all with copies, missing and unknown
    customers (refused: the version before stays readable), then all. What each found and what readers see after it."""
    t = Tables(spark, sf)
    path = work_dir(spark, "staging")
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year")).write.parquet(f"{path}/orders")
    orders = spark.read.parquet(f"{path}/orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    faulty = orders.unionByName(orders.filter(key % 10 == 0)).withColumn(
        "o_custkey", F.when(key % 7 == 0, None).when(key % 11 == 0, cust + 1_000_000_000_000).otherwise(cust))
    check = audit.gate(keys=["o_orderkey"], not_null=["o_orderkey", "o_custkey"],
                       foreign=[("customer", "o_custkey", t.customer.select("c_custkey"), "c_custkey")])
    table, out = VersionedTable(spark, f"{path}/table"), []
    for n, rows in enumerate((orders.filter("o_orderstatus = 'F'"), faulty, orders), 1):
        found = {}
        years = [r["year"] for r in rows.select("year").distinct().collect()]
        try:
            table.publish(rows, "year", years, f"load {n}", gate=check)
        except audit.AuditFailure as e:
            found = e.findings
        out.append((n, table.read().count(), *(found.get(c, 0) for c in ("duplicate keys", "null o_custkey", "orphans customer")), not found))
    return spark.createDataFrame(out, "load int, visible_rows long, duplicate_keys long, null_customers long, orphans long, published boolean")


def q_dimension_keys(spark, sf):
    """Surrogate keys of a stored dimension over two loads: the customers with even keys, then all, numbered by name; given keys stay."""
    t = Tables(spark, sf)
    path = f"{work_dir(spark, 'dimension')}/dim_customer"
    rows = t.customer.select("c_name", "c_custkey", "c_nationkey")
    for part in (rows.filter("c_custkey % 2 = 0"), rows):
        add_dimension_rows(spark, path, part, "c_name", "customer_key", order=["c_name"])
    return spark.read.parquet(path).select("customer_key", "c_name", "c_custkey", "c_nationkey")


EVENT_PAGE = 2000


def _event_documents(t: Tables) -> DataFrame:
    """Pages of events as payload documents: no page whose number leaves 3 by 7 lands, those that leave 5 by 11 land
    twice, those that leave 1 by 5 are cut short, and every thirteenth event has a value that is no number."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    page = (F.floor(F.col("event_id") / EVENT_PAGE) + 1).cast("int")
    totals = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"), F.max(page).alias("pages"))
    e = e.withColumn("page", page).join(totals, "event_type")
    value = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).when(F.col("event_type") != "error", F.col("value").cast("string"))
    row = F.struct(F.when(F.col("user_id") % 17 != 0, F.concat(F.lit("U"), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"))).alias("countryiso3code"),
                   F.struct(F.lit("").alias("id")).alias("country"), F.date_format("ts", "yyyy-MM-dd").alias("date"), value.alias("value"), F.lit("x").alias("unit"))
    meta = F.struct(F.first("page").alias("page"), F.first("pages").alias("pages"), F.first("total").alias("total"))
    docs = build_payloads(e, {"event_type": F.col("event_type"), "page": F.col("page")}, F.col("event_type"), row, meta)
    docs = docs.filter("page % 7 <> 3").withColumn("copy", F.explode(F.when(F.col("page") % 11 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return docs.select("indicator_code", "page", F.when(F.col("page") % 5 == 1, F.substring("text", 1, 60)).otherwise(F.col("text")).alias("text"))


def _ingested(spark: SparkSession, sf: str) -> str:
    base = work_dir(spark, "ingest")
    docs = _event_documents(Tables(spark, sf))
    docs.write.parquet(f"{base}/documents")
    docs = spark.read.parquet(f"{base}/documents")
    for n in range(3):
        docs.filter(F.col("page") % 3 == n).select("indicator_code", "text").write.partitionBy("indicator_code").mode("append").text(f"{base}/landing")
        ingest_checked(spark, f"{base}/landing", f"{base}/zone", f"{base}/checkpoint", "r1", "events feed")
    ingest_checked(spark, f"{base}/landing", f"{base}/zone", f"{base}/checkpoint", "r1", "events feed")  # nothing is new
    return f"{base}/zone"


def q_ingest_checked(spark, sf):
    """Rows per indicator in the four tables after three micro-batches of partly faulty payloads."""
    zone = _ingested(spark, sf)
    out = None
    for table in ("raw", "rejected", "quarantine", "pages"):
        rows = read_zone(spark, zone, table)
        reason = F.col("reason") if table == "quarantine" else F.lit("")
        part = rows.groupBy(F.lit(table).alias("sink"), "indicator_code", reason.alias("reason")).agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("batch").alias("batches"))
        out = part if out is None else out.unionByName(part)
    return out


def q_page_audit(spark, sf):
    """Which pages of each indicator landed, twice or never, against what the payloads declare."""
    pages = read_zone(spark, _ingested(spark, sf), "pages")
    found = audit.page_audit(pages)
    return found.select("indicator_code", "pages", "landed", "double", "total", "rows", F.concat_ws(",", "missing_pages").alias("missing_pages"), "rows_short")


def q_unique_incremental(spark, sf):
    """Keys of (order, part) held more than once, from three loads of lines and the counts each of them updates."""
    t = Tables(spark, sf)
    table = VersionedTable(spark, f"{work_dir(spark, 'key-counts')}/counts")
    counts = live.key_counts("l_orderkey", "l_partkey", buckets=16)
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    for n, part in enumerate(("l_linenumber <= 2", "l_linenumber between 3 and 4", "l_linenumber > 4")):
        counts.update(table, lines.filter(part), n)
    return live.repeated_keys(table.read()).select("l_orderkey", "l_partkey", "n")


def q_csv_report(spark, sf):
    """The heatmap written as CSV with a header and read again."""
    path = f"{work_dir(spark, 'report')}/heatmap"
    sinks.write_csv(reg.q_mart_sector_heatmap(spark, sf), path)
    return spark.read.option("header", True).schema("sector_name string, year int, quarter int, return_pct double, pe_ratio double").csv(path)


def q_refused_run(spark, sf):
    """A run without rows between two with rows: refused before any write, recorded with its stage; nothing else changes."""
    t = Tables(spark, sf)
    dims = {"country": si.dim_country(t), "indicator": si.indicator_keys(), "source": si.source_keys()}
    w = Warehouse(spark, f"{work_dir(spark, 'refused')}/warehouse", buckets=4)
    raw = si.raw_observations(t, "year")
    for run, rows in (("run_a", raw), ("run_b", raw.filter("period < '0'")), ("run_c", raw)):
        try:
            w.run(rows, run, dims, F.lit(RUN_TIMES[0]).cast("timestamp"), si.STANDIN_ISO2)
        except ValueError:
            continue
    metrics = spark.read.parquet(f"{w.root}/pipeline_metrics").groupBy("run_id", "stage", "status").agg(F.sum("record_count").alias("record_count"))
    return metrics.withColumn("facts", F.lit(w.fact_history().count()).cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline_incremental": q_pipeline_incremental,
    "facts_as_of": q_facts_as_of,
    "live_kpi": q_live_kpi,
    "live_trend": q_live_trend,
    "live_country_map": q_live_country_map,
    "live_heatmap": q_live_heatmap,
    "live_trade_flows": q_live_trade_flows,
    "stream_changes": q_stream_changes,
    "staging_reload": q_staging_reload,
    "dimension_keys": q_dimension_keys,
    "ingest_checked": q_ingest_checked,
    "page_audit": q_page_audit,
    "unique_incremental": q_unique_incremental,
    "csv_report": q_csv_report,
    "refused_run": q_refused_run,
}
