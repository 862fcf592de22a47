"""Named queries over the warehouse tables: one per operator group of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Batch entries are
lazy; the ones that exercise sinks or streams write under the session's shared
work folder (``spark.checkpoint.dir``) and return a scan of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.country import standard_code
from orrery.functions.keys import index_label
from orrery.functions.numeric import cents, envelope_high, envelope_low, from_cents
from orrery.functions.period import (parse_period, period_end_key, period_month, period_quarter, period_year,
                                     quarter_end_key)
from orrery.operators import audit, change, dims, load, reshape
from orrery.plans import marts, pipeline
from orrery.plans import standins as si
from orrery.session import work_dir
from orrery.sources import raw_zone, sinks
from orrery.sources.payload import build_payloads, flatten_payload
from orrery.sources.tables import Tables

# Parameters of the registered queries (the stand-in's counterparts of the reference defaults).
TRADE_YEAR_START = 1998
HEATMAP_YEAR_START = 1998
TREND_YEAR_START = 1996
KPI_COUNTRY = "N00"
TREND_COUNTRIES = ("N00", "N01", "N02", "N03", "N04")
TREND_CODE = "ORD.TOTAL"
KPI_NAMES = {"order_value": "ORD.TOTAL", "order_count": "ORD.COUNT", "avg_order": "ORD.AVG",
             "urgent_share": "ORD.URGENT", "unreported": "ORD.NONE"}
MAP_COLUMNS = {"order_value": "ORD.TOTAL", "order_count": "ORD.COUNT", "avg_order": "ORD.AVG",
               "urgent_share": "ORD.URGENT"}
ANOMALY_THRESHOLD = 200.0
FISCAL_SHIFT = 3
MAP_AS_OF = "1999-06-30"
PANEL_COUNTRIES = 5  # the grid takes this many countries, the first by key
PANEL_YEARS = (1992, 2001)  # first and last year of the market grid and of the expected yearly facts
AUDIT_CALENDAR_START = "1996-01-01"
TARGET_CUTOFF = "1999-01-01"
EVENT_PAGE = 100


def _t(spark: SparkSession, sf: str) -> Tables:
    return Tables(spark, sf)


def _fact_yearly(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Yearly indicator facts through the whole transform and key resolution."""
    spark = t.spark
    d = {"country": si.dim_country(t), "indicator": si.dim_indicator(spark), "source": si.dim_source(spark),
         "date": si.dim_date(t)}
    tr = pipeline.transform(si.raw_observations(t, "year"), si.STANDIN_ISO2, load_timestamp=F.lit(None)
                            .cast("timestamp"))
    facts, _ = pipeline.to_fact_rows(tr, d["country"], si.indicator_keys(), si.source_keys())
    return facts, d


def _stored_fact(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The yearly indicator facts, written with the declared types by year and read again."""
    facts, d = _fact_yearly(t)
    path = f"{work_dir(t.spark, 'fact')}/fact_economic_indicators"
    pipeline.write_facts(facts, path)
    return t.spark.read.parquet(path), d


# ---------------------------------------------------------------- marts

def q_mart_trade_flows(spark, sf):
    t = _t(spark, sf)
    sectors = si.dim_sector(t)
    trade = si.trade_fact(t, since_year=TRADE_YEAR_START - 1, sectors=sectors)
    return marts.trade_flows(trade, si.dim_date(t), si.dim_country(t), sectors, TRADE_YEAR_START, 100)


def q_mart_trade_flows_stored(spark, sf):
    """The trade mart over the stored monthly fact."""
    t = _t(spark, sf)
    sectors = si.dim_sector(t)
    trade = si.stored_trade_fact(t, f"{work_dir(spark, 'fact')}/fact_trade_flows", TRADE_YEAR_START - 1, sectors)
    return marts.trade_flows(trade, si.dim_date(t), si.dim_country(t), sectors, TRADE_YEAR_START, 100)


def q_mart_kpi_latest(spark, sf):
    t = _t(spark, sf)
    facts, d = _fact_yearly(t)
    return marts.kpi_latest(facts, d["date"], d["country"], d["indicator"], KPI_COUNTRY, si.INDICATOR_CODES)


def q_mart_kpi_record(spark, sf):
    t = _t(spark, sf)
    facts, d = _fact_yearly(t)
    rec = marts.kpi_summary(facts, d["date"], d["country"], d["indicator"], KPI_COUNTRY, KPI_NAMES)
    return reshape.flatten_record(rec.drop("last_updated"))


def q_mart_trend(spark, sf):
    t = _t(spark, sf)
    facts, d = _fact_yearly(t)
    return marts.gdp_trend(facts, d["date"], d["country"], d["indicator"], TREND_YEAR_START, TREND_COUNTRIES,
                           TREND_CODE)


def q_mart_trend_stored(spark, sf):
    """The trend mart over the stored fact: only the partitions of its years are read."""
    t = _t(spark, sf)
    facts, d = _stored_fact(t)
    trend = marts.gdp_trend(facts, d["date"], d["country"], d["indicator"], TREND_YEAR_START, TREND_COUNTRIES, TREND_CODE)
    return trend.withColumns({c: F.col(c).cast("double") for c in ("gdp", "growth")})


def q_mart_trend_sql(spark, sf):
    """How the trend countries fared over the stored fact: SQL text with bound arguments and frames."""
    t = _t(spark, sf)
    facts, d = _stored_fact(t)
    return spark.sql(
        """
        SELECT country_key, COUNT(*) AS years, COUNT_IF(yoy_change > 0) AS rising,
               CAST(MAX_BY(value, date_key) AS DOUBLE) AS last_value
        FROM {fact}
        WHERE year >= :since
          AND indicator_key = (SELECT MIN(indicator_key) FROM {indicator} WHERE indicator_code = :code)
          AND country_key IN (SELECT country_key FROM {country} WHERE array_contains(:countries, country_code))
        GROUP BY country_key
        """,
        args={"code": TREND_CODE, "countries": F.array(*[F.lit(c) for c in TREND_COUNTRIES]), "since": TREND_YEAR_START},
        fact=facts, indicator=d["indicator"], country=d["country"])


def q_mart_sector_heatmap(spark, sf):
    """Heatmap over the market prices alone: one lineitem exchange, on the part key."""
    t = _t(spark, sf)
    sectors = si.dim_sector(t)
    prices = si.market_prices(t, since_year=HEATMAP_YEAR_START, sectors=sectors)
    return marts.sector_heatmap(prices, si.dim_date(t), sectors, HEATMAP_YEAR_START)


def q_market_stored(spark, sf):
    """Rows and prices per year of the stored market fact, in its declared decimals."""
    t = _t(spark, sf)
    m = si.stored_market_fact(t, f"{work_dir(spark, 'fact')}/fact_market_data")
    prices = [F.sum(c).cast("double").alias(c) for c in ("open_price", "close_price", "high_price", "low_price")]
    return m.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), *prices)


def q_mart_sector_heatmap_gaps(spark, sf):
    """The heatmap where closes, quantities, open prices and P/E values are missing or zero."""
    t = _t(spark, sf)
    sectors = si.dim_sector(t)
    prices = si.market_prices(t, since_year=HEATMAP_YEAR_START, gaps=True, sectors=sectors)
    return marts.sector_heatmap(prices, si.dim_date(t), sectors, HEATMAP_YEAR_START)


def q_mart_sector_heatmap_rows(spark, sf):
    """The same mart over the whole market fact, with its country."""
    t = _t(spark, sf)
    sectors = si.dim_sector(t)
    market = si.market_fact(t, since_year=HEATMAP_YEAR_START, sectors=sectors)
    return marts.sector_heatmap(market, si.dim_date(t), sectors, HEATMAP_YEAR_START)


def q_mart_country_map(spark, sf):
    t = _t(spark, sf)
    facts, d = _fact_yearly(t)
    return marts.country_map(facts, d["date"], d["country"], d["indicator"], F.lit(MAP_AS_OF).cast("date"), MAP_COLUMNS)


# ---------------------------------------------------------------- dimensions and keys

def q_calendar_dim(spark, sf):
    """The calendar over a fixed range of years, widened to the whole years of every order and ship date outside it."""
    t = _t(spark, sf)
    first, last = (F.lit(d).cast("date") for d in si.CALENDAR)
    dates = t.orders.select(F.col("o_orderdate").alias("d")).unionAll(t.lineitem.select("l_shipdate"))
    start = F.least(first, dates.agg(F.trunc(F.min("d"), "year")).scalar())
    end = F.greatest(last, dates.agg(F.last_day(F.add_months(F.trunc(F.max("d"), "year"), 11))).scalar())
    return dims.calendar_between(start, end, spark, FISCAL_SHIFT)


def q_surrogate_keys(spark, sf):
    t = _t(spark, sf)
    c = t.customer.select("c_custkey", "c_nationkey")
    return dims.sequential_keys(c, ["c_nationkey", "c_custkey"], "customer_key")


def q_country_standardise(spark, sf):
    t = _t(spark, sf)
    c = t.customer.select("c_custkey", si.raw_country_code("c_nationkey").alias("country_code_2"))
    return c.withColumn("country_iso3", standard_code("country_code_2", si.STANDIN_ISO2)) \
            .filter(F.col("country_iso3").isNotNull())


def _period_formats(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_orderdate")
    y = F.year("o_orderdate").cast("string")
    q = F.quarter("o_orderdate").cast("string")
    m = F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    fmt = F.col("o_orderkey") % 4
    period = (F.when(fmt == 0, y).when(fmt == 1, F.concat(y, F.lit("Q"), q))
              .when(fmt == 2, F.concat(y, F.lit("-Q"), q)).otherwise(F.concat(y, F.lit("-"), m)))
    return o.select("o_orderkey", period.alias("period"))


def q_period_parse(spark, sf):
    t = _t(spark, sf)
    p = parse_period(_period_formats(t), "period", "strict")
    x = F.col("period")
    return p.select(
        "o_orderkey", "period", "year", "quarter", "date_key",
        period_year(x, "extended").alias("year_x"), period_quarter(x, "extended").alias("quarter_x"),
        period_month(x, "extended").alias("month_x"),
        period_end_key(period_year(x, "extended"), period_quarter(x, "extended"), period_month(x, "extended"))
        .alias("date_key_x"))


# ---------------------------------------------------------------- change windows

def q_pct_change_prev(spark, sf):
    t = _t(spark, sf)
    s = pipeline.scored(si.raw_observations(t, "year"), si.STANDIN_ISO2)
    return s.select(F.col("country_iso3").alias("country_code"), "indicator_code", "period", "value",
                    "prev_value", "yoy_change")


def q_anomaly_gate(spark, sf):
    t = _t(spark, sf)
    tr = pipeline.transform(si.raw_observations(t, "month"), si.STANDIN_ISO2, mode="extended",
                            threshold=ANOMALY_THRESHOLD, load_timestamp=F.lit(None).cast("timestamp"))
    return tr.drop("load_timestamp")


def q_transform_chain(spark, sf):
    t = _t(spark, sf)
    tr = pipeline.transform(si.raw_observations(t, "year"), si.STANDIN_ISO2,
                            load_timestamp=F.lit(None).cast("timestamp"))
    return tr.drop("load_timestamp")


def _nation_series(t: Tables, grain: str) -> DataFrame:
    m = si.order_measures(t, grain)
    return m.select(si.country_code("nationkey").alias("country_code"), F.col("year").cast("int").alias("year"),
                    F.col("sub").cast("int").alias("sub"), F.col("total").cast("double").alias("value"))


def q_mom_calendar(spark, sf):
    s = _nation_series(_t(spark, sf), "month").withColumn("idx", change.period_index("year", "sub", 12))
    r = change.calendar_change(s, ["country_code"], "idx", "value", 1, "mom_change")
    return r.select("country_code", "year", F.col("sub").alias("month"), "value", "mom_change")


def q_yoy_calendar(spark, sf):
    s = _nation_series(_t(spark, sf), "month").withColumn("idx", change.period_index("year", "sub", 12))
    r = change.calendar_change(s, ["country_code"], "idx", "value", 12, "yoy_change")
    return r.select("country_code", "year", F.col("sub").alias("month"), "value", "yoy_change")


def q_qoq_calendar(spark, sf):
    s = _nation_series(_t(spark, sf), "quarter").withColumn("idx", change.period_index("year", "sub", 4))
    r = change.calendar_change(s, ["country_code"], "idx", "value", 1, "qoq_change")
    return r.select("country_code", "year", F.col("sub").alias("quarter"), "value", "qoq_change")


def q_trade_balance(spark, sf):
    """Exports minus imports per nation and year: lines are summed per pair of nations and
    year first, and only these sums count once for the exporter and once for the importer."""
    t = _t(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    on = si.order_nation(t)
    j = li.join(on, li.l_orderkey == on.o_orderkey).join(s, F.col("l_suppkey") == s.s_suppkey)
    flows = j.groupBy("s_nationkey", "c_nationkey", F.year("l_shipdate").alias("year")).agg(F.sum(cents("l_extendedprice")).alias("v"))
    zero = F.lit(0).cast("long")
    sides = flows.select("year", F.explode(F.array(
        F.struct(F.col("s_nationkey").alias("nationkey"), F.col("v").alias("exp"), zero.alias("imp")),
        F.struct(F.col("c_nationkey").alias("nationkey"), zero.alias("exp"), F.col("v").alias("imp")))).alias("s"))
    g = sides.groupBy(F.col("s.nationkey").alias("nationkey"), "year").agg(
        from_cents(F.sum("s.exp")).alias("export_value"), from_cents(F.sum("s.imp")).alias("import_value"))
    g = g.withColumn("trade_balance", F.col("export_value") - F.col("import_value")) \
         .withColumn("__v", F.col("export_value").cast("double"))
    g = change.calendar_change(g, ["nationkey"], "year", "__v", 1, "yoy_growth")
    return g.select(si.country_code("nationkey").alias("country_code"), F.col("year").cast("int").alias("year"),
                    F.col("export_value").cast("double").alias("export_value"),
                    F.col("import_value").cast("double").alias("import_value"),
                    F.col("trade_balance").cast("double").alias("trade_balance"), "yoy_growth")


def q_revision_flag(spark, sf):
    t = _t(spark, sf)
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    r = change.revision_flag(e, ["user_id", "event_type"], ["ts", "event_id"], "value", "is_revised",
                             bucket=F.to_date("ts"))
    return r.select("event_id", "user_id", "event_type", "value", "is_revised")


# ---------------------------------------------------------------- load

def _monthly_obs_pair(t: Tables, subset) -> tuple[DataFrame, DataFrame]:
    """Monthly observations of a subset of orders and of all orders, from one aggregate."""
    part, whole = si.order_measures_versions(t, "month", subset, materialize=True)
    return _month_keys(si.raw_observations(t, "month", measures=part)), \
        _month_keys(si.raw_observations(t, "month", measures=whole))


def _month_keys(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "country_code": standard_code("country_code_2", si.STANDIN_ISO2),
        "date_key": period_end_key(period_year("period", "extended"), period_quarter("period", "extended"),
                                   period_month("period", "extended"))}).filter(F.col("country_code").isNotNull())


def q_insert_if_absent(spark, sf):
    """Target = facts from finished orders before the cutoff; batch = two runs of all
    orders (in-batch duplicates). First writer wins on (date, country, indicator)."""
    t = _t(spark, sf)
    d = {"country": si.dim_country(t)}
    early = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit(TARGET_CUTOFF).cast("timestamp_ntz"))

    def facts(obs):
        f, _ = load.resolve_keys(obs, [
            load.DimRef(d["country"], "country_code", "country_code", "country_key"),
            load.DimRef(si.indicator_keys(), "indicator_code", "indicator_code", "indicator_key"),
            load.DimRef(si.source_keys(), "source", "source_name", "source_key")])
        return f.select("date_key", "country_key", "indicator_key", "source_key", "value")

    target_obs, batch_obs = _monthly_obs_pair(t, early)
    target = facts(target_obs)
    # the batch arrives twice (two runs delivering the same rows): in-batch duplicates
    batch = facts(batch_obs).withColumn("run", F.explode(F.array(F.lit(1), F.lit(2)))).drop("run")
    return load.merged_table(batch, target, ["date_key", "country_key", "indicator_key"])


def q_latest_version(spark, sf):
    t = _t(spark, sf)
    e = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    return load.latest_version(e, ["user_id", "event_type"], ["ts", "event_id"])


# ---------------------------------------------------------------- reshape

def q_array_series_unnest(spark, sf):
    """Yearly order totals per nation -> dense arrays -> long rows with the seed-style
    change (signed previous value, 2 digits; a zero total counts as missing)."""
    t = _t(spark, sf)
    m = si.order_measures(t, "year")
    long_in = m.select(si.country_code("nationkey").alias("country_code"), F.col("year").cast("int").alias("year"),
                       F.col("total").cast("double").alias("order_value"),
                       F.col("n").cast("double").alias("order_count"))
    wide = reshape.series_to_arrays(long_in, ["country_code"], "year", ["order_value", "order_count"])
    long_out = reshape.arrays_to_long(wide, ["country_code"], ["order_value", "order_count"], "base_year",
                                      drop_falsy=["order_value"])
    r = change.pct_change_prev(long_out, ["country_code"], ["year"], "order_value", "change", 2, use_abs=False,
                               keep_prev=False)
    return r.select("country_code", "year", "order_value", "order_count", "change")


def q_dense_panel(spark, sf):
    """Quarter x sector x first countries grid with quarter-end keys and index labels
    (the market seed grid); every axis is bounded by a dimension."""
    t = _t(spark, sf)
    first = si.dim_country(t).select("country_key").orderBy("country_key").limit(PANEL_COUNTRIES)
    countries = first.agg(F.sort_array(F.collect_list("country_key")).alias("k")).select("k").scalar()
    grid = audit.expected_grid(si.dim_sector(t).select("sector_key"), {
        "year": F.sequence(*[F.lit(y) for y in PANEL_YEARS]), "quarter": F.sequence(F.lit(1), F.lit(4)), "country_key": countries})
    return grid.select(
        F.col("year").cast("int").alias("year"), F.col("quarter").cast("int").alias("quarter"), "sector_key",
        "country_key", quarter_end_key("year", "quarter").alias("date_key"),
        index_label("country_key", "sector_key").alias("index_name"))


def q_completeness_gap(spark, sf):
    t = _t(spark, sf)
    facts, d = _fact_yearly(t)
    present = facts.join(d["country"].select("country_key", "country_code"), "country_key") \
                   .join(d["indicator"].select("indicator_key", "indicator_code"), "indicator_key") \
                   .select("country_code", "indicator_code", F.floor(F.col("date_key") / 10000).cast("int")
                           .alias("year"))
    grid = audit.expected_grid(d["country"].select("country_code"), {
        "indicator_code": F.array(*[F.lit(c) for c in si.INDICATOR_CODES]),
        "year": F.sequence(*[F.lit(y) for y in PANEL_YEARS])})
    return audit.completeness_gap(grid, present, ["country_code", "indicator_code", "year"])


def q_ohlc_envelope(spark, sf):
    t = _t(spark, sf)
    m = si.market_fact(t)
    return m.select("date_key", "country_key", "sector_key",
                    index_label("country_key", "sector_key").alias("index_name"),
                    "open_price", "close_price",
                    envelope_high("open_price", "close_price").alias("high_price"),
                    envelope_low("open_price", "close_price").alias("low_price"))


# ---------------------------------------------------------------- audits

def q_fk_audit(spark, sf):
    t = _t(spark, sf)
    m = si.market_fact(t)
    cal = dims.calendar(spark, AUDIT_CALENDAR_START, si.CALENDAR[1])
    return audit.fk_audit(m, [
        ("date_key", "date_key", cal, "date_key"),
        ("country_key", "country_key", si.dim_country(t), "country_key"),
        ("sector_key", "sector_key", si.dim_sector(t), "sector_key"),
    ])


def q_unique_audit(spark, sf):
    t = _t(spark, sf)
    return audit.unique_audit(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


def q_null_audit(spark, sf):
    t = _t(spark, sf)
    s = pipeline.scored(si.raw_observations(t, "year"), si.STANDIN_ISO2)
    return audit.null_audit(s, ["value", "year", "quarter", "date_key", "prev_value", "yoy_change", "is_anomaly"])


def _staging(t: Tables) -> DataFrame:
    """Raw observations of three grains as staging text: the urgent share arrives
    with a percent sign, the other measures as plain numbers."""
    raw = si.raw_observations(t, "mixed", measures=si.order_measures_grains(t))
    text = F.when(F.col("indicator_code") == "ORD.URGENT", F.concat(F.col("value").cast("string"), F.lit("%"))) \
            .otherwise(F.col("value").cast("string"))
    return raw.select("indicator_code", F.col("country_code_2").alias("country_code"), "period",
                      text.alias("raw_value"), "unit", "source")


def q_quarantine_split(spark, sf):
    t = _t(spark, sf)
    st = parse_period(_staging(t), "period", "strict")
    tagged = audit.quarantine_tagged(st, "raw_value", "double",
                                     [(F.col("date_key").isNotNull(), "unparsable period")])
    return tagged.select("indicator_code", "country_code", "period", "value", "processed", "error_message")


def q_union_sources(spark, sf):
    """Observations from two feeds (orders by customer nation, shipments by supplier
    nation) as one record set."""
    t = _t(spark, sf)
    orders = si.raw_observations(t, "year").select("indicator_code", "country_code_2", "period", "value", "source")
    li = t.lineitem.select("l_suppkey", "l_extendedprice", "l_shipdate")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    ship = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(
        F.col("s_nationkey").alias("nationkey"), F.year("l_shipdate").alias("year")).agg(
        from_cents(F.sum(cents("l_extendedprice"))).alias("total"))
    ship = ship.select(F.lit("SHP.TOTAL").alias("indicator_code"),
                       si.raw_country_code("nationkey").alias("country_code_2"),
                       F.col("year").cast("string").alias("period"),
                       F.col("total").cast("double").alias("value"), F.lit("shipments feed").alias("source"))
    return orders.unionByName(ship)


# ---------------------------------------------------------------- sources and sinks

def _event_payloads(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    code3 = F.when(F.col("user_id") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit("U"), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"), F.lit("X")))
    row = F.struct(
        code3.alias("countryiso3code"),
        F.struct(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("id")).alias("country"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "purchase", F.lit("USD")).alias("unit"),
    )
    return build_payloads(e, {"event_type": F.col("event_type"), "page": F.floor(F.col("event_id") / EVENT_PAGE)},
                          F.col("event_type"), row)


def q_payload_flatten(spark, sf):
    t = _t(spark, sf)
    flat = flatten_payload(_event_payloads(t), "text", "indicator_code", source="events feed", run_id="standin",
                           loaded_at=F.lit("1970-01-01T00:00:00"))
    return flat.select("indicator_code", "country_code_2", "period", "value", "unit", "source")


def q_props_json(spark, sf):
    t = _t(spark, sf)
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


def q_json_export_rows(spark, sf):
    return sinks.json_rows(q_mart_kpi_latest(spark, sf))


def q_run_metrics(spark, sf):
    t = _t(spark, sf)
    base = work_dir(spark, "metrics")
    raw = si.raw_observations(t, "year")
    n_raw = sinks.counted_write(raw, f"{base}/raw")
    tr = pipeline.transform(spark.read.parquet(f"{base}/raw"), si.STANDIN_ISO2)
    n_tr = sinks.counted_write(tr, f"{base}/processed")
    sinks.append_metrics(spark, f"{base}/pipeline_metrics", "standin", "ingest", n_raw, "SUCCESS")
    sinks.append_metrics(spark, f"{base}/pipeline_metrics", "standin", "transform", n_tr, "SUCCESS")
    return spark.read.parquet(f"{base}/pipeline_metrics").select("stage", "record_count", "status")


def q_run_partition_roundtrip(spark, sf):
    """Two runs into one raw zone; read all runs (partition discovery) and one run
    (partition filter); report rows and the order count (an exact integer sum) per run and per read."""
    t = _t(spark, sf)
    root = f"{work_dir(spark, 'raw-zone')}/raw"
    raw_all = si.raw_observations(t, "year", run_id="run_b")
    raw_early = si.raw_observations(t, "year", run_id="run_a").filter(F.col("period") < "1999")
    raw_zone.write_run(raw_early, root, "run_a")
    raw_zone.write_run(raw_all, root, "run_b")
    raw_zone.write_run(raw_all, root, "run_b")  # a rerun replaces only its own partition
    orders = F.sum(F.when(F.col("indicator_code") == "ORD.COUNT", F.col("value"))).cast("long").alias("orders")
    every = raw_zone.read_raw(spark, root).groupBy("run").agg(F.count(F.lit(1)).alias("rows"), orders) \
        .withColumn("read", F.lit("all_runs"))
    one = raw_zone.read_run(spark, root, "run_a", None).groupBy("run").agg(F.count(F.lit(1)).alias("rows"), orders) \
        .withColumn("read", F.lit("one_run"))
    return every.unionByName(one).select("read", "run", "rows", "orders")


# ---------------------------------------------------------------- streaming

def q_stream_incremental_load(spark, sf):
    from orrery.streaming.ingest import incremental_load
    t = _t(spark, sf)
    base = work_dir(spark, "stream-load")
    early = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit(TARGET_CUTOFF).cast("timestamp_ntz"))
    cols = ["indicator_code", "country_code", "period", "date_key", "value"]
    run_a, run_b = _monthly_obs_pair(t, early)
    year = F.floor(F.col("date_key") / 10000).cast("int").alias("year")
    raw_zone.write_run(run_a.select(*cols, year), f"{base}/raw", "run_a")
    raw_zone.write_run(run_b.select(*cols, year), f"{base}/raw", "run_b")
    incremental_load(spark, f"{base}/raw", f"{base}/fact", f"{base}/checkpoint",
                     keys=["country_code", "indicator_code", "date_key"], partition_by=["year"])
    return spark.read.parquet(f"{base}/fact").select(*cols)


def q_stream_live_kpi(spark, sf):
    from orrery.streaming.live import live_kpis, live_latest
    base = work_dir(spark, "stream-kpi")
    live_latest(spark, f"{sf.rstrip('/')}/events.parquet", f"{base}/kpi", f"{base}/checkpoint")
    return live_kpis(spark, f"{base}/kpi").select("event_type", "latest_value", "latest_event_id", "change", "events")


def q_stream_dedupe(spark, sf):
    """Three runs deliver the events: the later days first, then the earlier ones (late first
    deliveries) with copies of some of the first, then copies of half of all."""
    from orrery.streaming.dedupe import dedupe_events
    t = _t(spark, sf)
    base = work_dir(spark, "stream-dedupe")
    late = F.dayofmonth("ts") % 2 == 0
    for part in (late, ~late | (F.col("event_id") % 5 == 0), F.col("event_id") % 2 == 0):
        t.events.filter(part).write.mode("append").parquet(f"{base}/landing")
        dedupe_events(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type", "value")


# ---------------------------------------------------------------- the whole run

def end_to_end_raw(t: Tables) -> DataFrame:
    """Yearly, quarterly and monthly observations with faults by rule: months do not parse in
    strict mode, average orders of 1996 have no value, two nations have unknown codes, and
    yearly counts come once more under an indicator that no dimension has."""
    raw = si.raw_observations(t, "mixed", measures=si.order_measures_grains(t))
    gap = (F.col("indicator_code") == "ORD.AVG") & F.col("period").startswith("1996")
    raw = raw.withColumn("value", F.when(~gap, F.col("value")))
    extra = raw.filter((F.col("indicator_code") == "ORD.COUNT") & (F.length("period") == 4))
    return raw.unionByName(extra.withColumn("indicator_code", F.lit("ORD.EXTRA")))


def q_pipeline_end_to_end(spark, sf):
    """Two runs of the whole pipeline, the first with the early periods only; what became of
    the observations of each: loaded, already there, or quarantined with a reason."""
    t = _t(spark, sf)
    base = work_dir(spark, "end-to-end")
    d = {"country": si.dim_country(t), "indicator": si.dim_indicator(spark), "source": si.dim_source(spark), "date": si.dim_date(t)}
    raw = end_to_end_raw(t)
    rows = []
    for run, part in (("run_a", raw.filter(F.col("period") < "1998")), ("run_b", raw)):
        report = pipeline.run_pipeline(spark, part, f"{base}/warehouse", run, d, si.STANDIN_ISO2)
        out = {"raw": report.raw_rows, "loaded": report.loaded_rows, **report.quarantined}
        orphans = sum(n for r, n in report.quarantined.items() if r.startswith("unknown key"))
        out["already there"] = report.transformed_rows - report.loaded_rows - orphans
        rows += [(run, k, n) for k, n in out.items()]
    counts = spark.createDataFrame(rows, "run string, outcome string, rows long")
    facts = spark.read.parquet(f"{base}/warehouse/fact_economic_indicators")
    stored = facts.groupBy(F.col("pipeline_run_id"), F.col("frequency")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.unionByName(stored.select(F.lit("stored").alias("run"), F.concat(F.lit("frequency "), "frequency").alias("outcome"), "rows"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_trade_flows": q_mart_trade_flows,
    "mart_trade_flows_stored": q_mart_trade_flows_stored,
    "mart_kpi_latest": q_mart_kpi_latest,
    "mart_kpi_record": q_mart_kpi_record,
    "mart_trend": q_mart_trend,
    "mart_trend_stored": q_mart_trend_stored,
    "mart_trend_sql": q_mart_trend_sql,
    "mart_sector_heatmap": q_mart_sector_heatmap,
    "market_stored": q_market_stored,
    "mart_sector_heatmap_gaps": q_mart_sector_heatmap_gaps,
    "mart_sector_heatmap_rows": q_mart_sector_heatmap_rows,
    "mart_country_map": q_mart_country_map,
    "calendar_dim": q_calendar_dim,
    "surrogate_keys": q_surrogate_keys,
    "country_standardise": q_country_standardise,
    "period_parse": q_period_parse,
    "pct_change_prev": q_pct_change_prev,
    "anomaly_gate": q_anomaly_gate,
    "transform_chain": q_transform_chain,
    "mom_calendar": q_mom_calendar,
    "yoy_calendar": q_yoy_calendar,
    "qoq_calendar": q_qoq_calendar,
    "trade_balance": q_trade_balance,
    "revision_flag": q_revision_flag,
    "insert_if_absent": q_insert_if_absent,
    "latest_version": q_latest_version,
    "array_series_unnest": q_array_series_unnest,
    "dense_panel": q_dense_panel,
    "completeness_gap": q_completeness_gap,
    "ohlc_envelope": q_ohlc_envelope,
    "fk_audit": q_fk_audit,
    "unique_audit": q_unique_audit,
    "null_audit": q_null_audit,
    "quarantine_split": q_quarantine_split,
    "union_sources": q_union_sources,
    "payload_flatten": q_payload_flatten,
    "props_json": q_props_json,
    "json_export_rows": q_json_export_rows,
    "run_metrics": q_run_metrics,
    "run_partition_roundtrip": q_run_partition_roundtrip,
    "stream_incremental_load": q_stream_incremental_load,
    "stream_live_kpi": q_stream_live_kpi,
    "stream_dedupe": q_stream_dedupe,
    "pipeline_end_to_end": q_pipeline_end_to_end,
}
