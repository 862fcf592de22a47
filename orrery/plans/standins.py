"""Stand-in star schema built from the warehouse input tables.

The indicator warehouse's roles are played by the order/lineitem tables:

* country     <- nation (+ region); code ``N{key:02d}``; raw feeds report odd
                 nations under a two-letter code ``M{A+key}`` (see ``STANDIN_ISO2``)
* indicator   <- four measures of orders per customer nation and period
* trade fact  <- lineitem: exporter = supplier nation, importer = customer nation,
                 sector = part type, one row per month and flow
* market fact <- lineitem: open = part retail price, close = unit price, P/E = part size
* calendar    <- every day of a fixed range of years

Everything here is lazy and derived from the scanned tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.keys import hash_key, index_label
from orrery.functions.numeric import cents, envelope_high, envelope_low, from_cents, safe_ratio
from orrery.functions.period import date_key, month_end_key
from orrery.operators.change import calendar_change, period_index
from orrery.operators.dims import calendar, sequential_keys
from orrery.operators.load import append_rows
from orrery.operators.reshape import unpivot
from orrery.schemas import FACT_MARKET_DATA, FACT_TRADE_FLOWS, declared
from orrery.sources.tables import Tables

# Fixed values of the stand-in (rules, not data).
INDICATORS = (
    # code, key, name, unit, frequency
    ("ORD.TOTAL", 1, "Order value", "USD", "Annual"),
    ("ORD.COUNT", 2, "Order count", "orders", "Annual"),
    ("ORD.AVG", 3, "Average order value", "USD", "Annual"),
    ("ORD.URGENT", 4, "Urgent order share", "%", "Annual"),
)
INDICATOR_CODES = tuple(i[0] for i in INDICATORS)
SOURCE_NAME = "orders feed"
URGENT_PRIORITY = "1-URGENT"
CALENDAR = ("1990-01-01", "2004-12-31")
# Odd nation keys below 21 report a two-letter code; 21 and 23 have no mapping.
STANDIN_ISO2 = {f"M{chr(65 + k)}": f"N{k:02d}" for k in range(1, 21, 2)}


def country_code(nationkey: str | Column) -> Column:
    k = F.col(nationkey) if isinstance(nationkey, str) else nationkey
    return F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0"))


def raw_country_code(nationkey: str | Column) -> Column:
    """Code as a raw feed reports it: alpha-3 for even keys, two letters for odd keys."""
    k = F.col(nationkey) if isinstance(nationkey, str) else nationkey
    return F.when(k % 2 == 0, country_code(k)).otherwise(F.concat(F.lit("M"), F.char(k + 65)))


# ---------------------------------------------------------------- dimensions

def dim_country(t: Tables) -> DataFrame:
    """nation + region."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("country_key"),
        country_code("n_nationkey").alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )


def dim_indicator(spark: SparkSession) -> DataFrame:
    """Literal rows, so broadcast by construction (a frame made from a Python list
    has no size statistics and would otherwise be planned as a shuffle join)."""
    return F.broadcast(spark.createDataFrame(
        [(k, c, n, u, f) for c, k, n, u, f in INDICATORS],
        "indicator_key int, indicator_code string, indicator_name string, unit string, frequency string"))


def indicator_keys() -> dict[str, int]:
    return {c: k for c, k, *_ in INDICATORS}


def source_keys() -> dict[str, int]:
    return {SOURCE_NAME: 1}


def dim_source(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(1, SOURCE_NAME, 8)],
                                             "source_key int, source_name string, reliability int"))


def dim_sector(t: Tables) -> DataFrame:
    """Distinct part types with dense keys in name order."""
    types = t.part.select(F.col("p_type").alias("sector_code")).distinct()
    keyed = sequential_keys(types, ["sector_code"], "sector_key")
    return keyed.select(F.col("sector_key").cast("int").alias("sector_key"), "sector_code",
                        F.initcap("sector_code").alias("sector_name"))


def dim_date(t: Tables, fiscal_shift_months: int = 0) -> DataFrame:
    """Calendar over the fixed range ``CALENDAR``: bounded by it, whatever dates the facts hold
    (facts outside it are the business of the foreign-key audit)."""
    return calendar(t.spark, *CALENDAR, fiscal_shift_months)


# ---------------------------------------------------------------- raw observations

def order_measures(t: Tables, grain: str = "year") -> DataFrame:
    """Per (customer nation, period): exact order value sum, count, urgent count.

    ``grain`` is ``year``, ``quarter`` or ``month``. The join to customer is a
    shuffle join at scale (customer grows with the data); partial aggregation
    combines rows map-side before the group-by shuffle.
    """
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    d = F.col("o_orderdate")
    sub = {"year": F.lit(None).cast("int"), "quarter": F.quarter(d), "month": F.month(d)}[grain]
    return j.groupBy(F.col("c_nationkey").alias("nationkey"), F.year(d).alias("year"), sub.alias("sub")).agg(
        from_cents(F.sum(cents("o_totalprice"))).alias("total"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderpriority") == URGENT_PRIORITY).alias("urgent"),
    )


def order_measures_grains(t: Tables, grains: tuple[str, ...] = ("year", "quarter", "month")) -> DataFrame:
    """``order_measures`` for several grains in one pass: a GROUPING SETS aggregate
    (one scan, one join, one shuffle of partially aggregated rows) with a ``grain``
    column. Sums and counts are exact, so each grain equals its own aggregate."""
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    d = F.col("o_orderdate")
    j = j.select(F.col("c_nationkey").alias("nationkey"), F.year(d).alias("year"), F.quarter(d).alias("q"),
                 F.month(d).alias("m"), cents("o_totalprice").alias("price"),
                 (F.col("o_orderpriority") == URGENT_PRIORITY).alias("is_urgent"))
    sets = {"year": ["nationkey", "year"], "quarter": ["nationkey", "year", "q"], "month": ["nationkey", "year", "m"]}
    g = j.groupingSets([sets[x] for x in grains], "nationkey", "year", "q", "m").agg(
        from_cents(F.sum("price")).alias("total"), F.count(F.lit(1)).alias("n"),
        F.count_if("is_urgent").alias("urgent"))
    grain = (F.when(F.col("m").isNotNull(), F.lit("month")).when(F.col("q").isNotNull(), F.lit("quarter"))
             .otherwise(F.lit("year")))
    sub = F.coalesce(F.col("m"), F.col("q"))
    return g.select(grain.alias("grain"), "nationkey", "year", sub.alias("sub"), "total", "n", "urgent")


def order_measures_versions(t: Tables, grain: str, subset: Column,
                            materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """``order_measures`` over all orders and over the ``subset`` of orders, from
    one conditional aggregate (one scan, one join, one shuffle). Returns
    ``(subset_measures, all_measures)``; groups with no subset order are absent
    from the first, as they would be from a separate aggregate.

    With ``materialize`` the aggregate (one row per nation and period, small) is
    written once with ``checkpoint()`` to the shared folder, so every consumer
    of the two versions reads it instead of recomputing the scan and join."""
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey).withColumns({
        "__in": subset, "__urgent": F.col("o_orderpriority") == URGENT_PRIORITY, "__price": cents("o_totalprice")})
    d = F.col("o_orderdate")
    sub = {"year": F.lit(None).cast("int"), "quarter": F.quarter(d), "month": F.month(d)}[grain]
    g = j.groupBy(F.col("c_nationkey").alias("nationkey"), F.year(d).alias("year"), sub.alias("sub")).agg(
        from_cents(F.sum("__price")).alias("total"), F.count(F.lit(1)).alias("n"),
        F.count_if("__urgent").alias("urgent"),
        from_cents(F.sum(F.when(F.col("__in"), F.col("__price")))).alias("s_total"), F.count_if("__in").alias("s_n"),
        F.count_if(F.col("__in") & F.col("__urgent")).alias("s_urgent"))
    if materialize:
        from orrery.session import shared_dir
        shared_dir(t.spark)
        g = g.checkpoint()
    part = g.filter(F.col("s_n") > 0).select("nationkey", "year", "sub", F.col("s_total").alias("total"),
                                               F.col("s_n").alias("n"), F.col("s_urgent").alias("urgent"))
    return part, g.select("nationkey", "year", "sub", "total", "n", "urgent")


def period_text(grain: str) -> Column:
    y = F.col("year").cast("string")
    if grain == "year":
        return y
    if grain == "quarter":
        return F.concat(y, F.lit("Q"), F.col("sub").cast("string"))
    return F.concat(y, F.lit("-"), F.lpad(F.col("sub").cast("string"), 2, "0"))


def measure_values(m: DataFrame) -> DataFrame:
    """Measures as doubles: exact decimal sum cast once, ratios from one division."""
    extra = ["grain"] if "grain" in m.columns else []
    return m.select(
        *extra, "nationkey", "year", "sub",
        F.col("total").cast("double").alias("v_total"),
        F.col("n").cast("double").alias("v_count"),
        (F.col("total").cast("double") / F.col("n")).alias("v_avg"),
        (F.col("urgent") * 100.0 / F.col("n")).alias("v_urgent"),
    )


def raw_observations(t: Tables, grain: str = "year", run_id: str = "standin",
                     loaded_at: str = "1970-01-01T00:00:00", measures: DataFrame | None = None) -> DataFrame:
    """Raw observation rows in the raw-zone schema (S-02), long form per indicator.

    ``grain`` may be one grain or ``"mixed"`` with ``measures`` from
    ``order_measures_grains`` (the period text then follows each row's grain)."""
    m = measures if measures is not None else order_measures(t, grain)
    if grain == "mixed":
        period = (F.when(F.col("grain") == "year", period_text("year"))
                  .when(F.col("grain") == "quarter", period_text("quarter")).otherwise(period_text("month")))
    else:
        period = period_text(grain)
    wide = measure_values(m).withColumns({"period": period, "country_code_2": raw_country_code("nationkey")})
    long = unpivot(wide, ["country_code_2", "period"], {
        "v_total": "ORD.TOTAL", "v_count": "ORD.COUNT", "v_avg": "ORD.AVG", "v_urgent": "ORD.URGENT"})
    unit = F.when(F.col("indicator_code") == "ORD.COUNT", "orders").when(
        F.col("indicator_code") == "ORD.URGENT", "%").otherwise("USD")
    return long.select(
        "indicator_code", "country_code_2", "period", "value", unit.alias("unit"),
        F.lit(SOURCE_NAME).alias("source"), F.lit(run_id).alias("pipeline_run_id"),
        F.lit(loaded_at).alias("loaded_at"))


# ---------------------------------------------------------------- facts

def order_nation(t: Tables) -> DataFrame:
    """``(o_orderkey, c_nationkey)``: orders joined to customer first, so lineitem is
    joined (and shuffled) once on ``orderkey`` instead of once more on ``custkey``."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")


def trade_fact(t: Tables, since_year: int | None = None, lineitem: DataFrame | None = None, sectors: DataFrame | None = None) -> DataFrame:
    """Monthly trade flows: (month-end date_key, exporter, importer, sector) with
    exact export/import sums, balance and YoY growth against the same month a
    year earlier (D-03, D-04).

    ``since_year`` prunes the lineitem scan (pushed to Parquet); YoY needs the
    year before the first reported year, so callers pass ``year_start - 1``.
    ``lineitem`` may be a bucketed copy (``sources/layout.py``): bucketed on
    ``l_orderkey`` it joins the orders side without shuffling lineitem.
    """
    li = (lineitem if lineitem is not None else t.lineitem).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate")
    if since_year is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(f"{since_year}-01-01").cast("timestamp_ntz"))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    p = part_sectors(t, sectors).select("p_partkey", "sector_key")
    on = order_nation(t)
    j = (li.join(on, li.l_orderkey == on.o_orderkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(p, F.col("l_partkey") == p.p_partkey))
    month_end = month_end_key(F.year("l_shipdate"), F.month("l_shipdate"))
    ext = cents("l_extendedprice")
    net = ext * (F.lit(100) - cents("l_discount"))  # exact, in units of 1e-4
    g = j.groupBy(
        month_end.alias("date_key"),
        F.col("s_nationkey").alias("exporter_key"),
        F.col("c_nationkey").alias("importer_key"),
        F.col("sector_key"),
    ).agg(from_cents(F.sum(ext)).alias("export_value_usd"), from_cents(F.sum(net), 4).alias("import_value_usd"))
    g = g.withColumns({
        "trade_balance": F.col("export_value_usd") - F.col("import_value_usd"),
        "__m": period_index(F.floor(F.col("date_key") / 10000), F.floor(F.col("date_key") / 100) % 100, 12),
        "__v": F.col("export_value_usd").cast("double")})
    g = calendar_change(g, ["exporter_key", "importer_key", "sector_key"], "__m", "__v", 12, "yoy_growth", 4)
    return g.select(
        hash_key("date_key", "exporter_key", "importer_key", "sector_key").alias("trade_id"),
        "date_key", "exporter_key", "importer_key", "sector_key",
        "export_value_usd", "import_value_usd", "trade_balance",
        F.col("yoy_growth").cast("decimal(18,4)").alias("yoy_growth"),
    )


def stored_trade_fact(t: Tables, path: str, since_year: int | None = None, sectors: DataFrame | None = None) -> DataFrame:
    """The monthly trade fact, written in its declared form by year and read again: marts
    then read the partitions of their years and shuffle no lineitem."""
    rows = declared(trade_fact(t, since_year, sectors=sectors), FACT_TRADE_FLOWS, {"load_timestamp": F.current_timestamp()})
    append_rows(rows.withColumn("year", F.floor(F.col("date_key") / 10000).cast("int")), path, ["year"], ["date_key", "exporter_key"])
    return t.spark.read.parquet(path)


def stored_market_fact(t: Tables, path: str, since_year: int | None = None) -> DataFrame:
    """The market fact with its price envelope, written in its declared form by year and read again."""
    m = market_fact(t, since_year).withColumns({
        "market_id": hash_key("date_key", "country_key", "sector_key", "open_price", "close_price"),
        "index_name": index_label("country_key", "sector_key"),
        "high_price": envelope_high("open_price", "close_price"), "low_price": envelope_low("open_price", "close_price")})
    rows = declared(m, FACT_MARKET_DATA, {"load_timestamp": F.current_timestamp()})
    append_rows(rows.withColumn("year", F.floor(F.col("date_key") / 10000).cast("int")), path, ["year"], ["date_key", "country_key"])
    return t.spark.read.parquet(path)


def _since(li: DataFrame, since_year: int | None) -> DataFrame:
    if since_year is None:
        return li
    return li.filter(F.col("l_shipdate") >= F.lit(f"{since_year}-01-01").cast("timestamp_ntz"))


def part_sectors(t: Tables, sectors: DataFrame | None = None) -> DataFrame:
    """Parts with the key of their sector, joined before the far larger lineitem. ``sectors``: the
    dimension, where a query has it already (its keys are given by a job of their own)."""
    sectors = dim_sector(t) if sectors is None else sectors
    return t.part.join(sectors, F.col("p_type") == sectors.sector_code)


def market_prices(t: Tables, since_year: int | None = None, gaps: bool = False, sectors: DataFrame | None = None) -> DataFrame:
    """One market observation per lineitem without its country: open = part retail price,
    close = unit price, P/E = part size. Lineitem is shuffled once, on its part key.

    ``gaps`` makes missing and zero values by rule, as a feed has them: no close where the
    line's part key is divisible by 7, a zero quantity (so no close either) by 11, a zero
    open price by 5, no P/E by 3.
    """
    li = _since(t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"), since_year)
    p = part_sectors(t, sectors).select("p_partkey", "sector_key", "p_retailprice", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    k, price, size = F.col("l_partkey"), F.col("p_retailprice"), F.col("p_size").cast("double")
    quantity, value = F.col("l_quantity"), F.col("l_extendedprice")
    if gaps:
        value = F.when(k % 7 != 0, value)
        quantity = F.when(k % 11 != 0, quantity).otherwise(F.lit(0.0))
        price = F.when(k % 5 != 0, price).otherwise(F.lit(0.0))
        size = F.when(k % 3 != 0, size)
    return j.select(date_key("l_shipdate").alias("date_key"), "l_suppkey", "sector_key", price.alias("open_price"),
                    safe_ratio(value, quantity).alias("close_price"), size.alias("pe_ratio"))


def market_fact(t: Tables, since_year: int | None = None, sectors: DataFrame | None = None) -> DataFrame:
    """``market_prices`` with the supplier's nation as country."""
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("country_key"))
    m = market_prices(t, since_year, sectors=sectors)
    return m.join(s, m.l_suppkey == s.s_suppkey).select(
        "date_key", "country_key", "sector_key", "open_price", "close_price", "pe_ratio")
