"""DuckDB SQL of the queries that keep state: each from the base tables, all at once."""

from __future__ import annotations

from orrery.plans.oracle import ORACLE_SQL as ORACLE
from orrery.plans.oracle import CC, DC, DI, DS, FREQ, GATED, OM, P_KEY, P_QUARTER, P_YEAR, R, RAWOBS, SCORED, STD, with_
from orrery.plans import registry_state as reg


def _observations() -> list[str]:
    grains = [x for g in ("year", "quarter", "month") for x in (OM(f"om_{g}", g), RAWOBS(f"raw_{g}", g, f"om_{g}"))]
    every = " UNION ALL ".join(f"SELECT * FROM raw_{g}" for g in ("year", "quarter", "month"))
    return [*grains, f"""allraw AS (SELECT * REPLACE (CASE WHEN indicator_code = 'ORD.AVG' AND period LIKE '1996%' THEN NULL ELSE value END AS value)
  FROM ({every} UNION ALL SELECT * REPLACE ('ORD.EXTRA' AS indicator_code) FROM raw_year WHERE indicator_code = 'ORD.COUNT'))""",
            """deliveries AS (
  SELECT 1 AS run, * FROM allraw WHERE period < '1997' UNION ALL
  SELECT 2, * REPLACE (CASE WHEN indicator_code = 'ORD.TOTAL' AND period LIKE '1996%' THEN value * 1.25 ELSE value END AS value)
  FROM allraw WHERE period >= '1996' UNION ALL
  SELECT 3, * REPLACE (value * 2 AS value) FROM allraw WHERE country_code_2 = 'N00' AND indicator_code = 'ORD.COUNT' AND period LIKE '1995%')"""]


def _outcomes(name: str, runs: int) -> str:
    """Outcome of every observation by its latest delivery of the first ``runs`` runs."""
    return f"""{name}_d AS (SELECT * FROM deliveries WHERE run <= {runs}
  QUALIFY row_number() OVER (PARTITION BY country_code_2, indicator_code, period ORDER BY run DESC) = 1),
{name}_p AS (SELECT *, {STD('country_code_2')} AS iso3, {P_YEAR('period')} AS year, {P_QUARTER('period')} AS quarter FROM {name}_d),
{name}_o AS (SELECT *, {P_KEY('year', 'quarter')} AS date_key, {FREQ('quarter')} AS frequency, CASE WHEN value IS NULL THEN 'value is null'
  WHEN iso3 IS NULL THEN 'unknown country' WHEN year IS NULL THEN 'unparsable period' END AS early FROM {name}_p),
{name}_l AS (SELECT *, LAG(value) OVER (PARTITION BY iso3, indicator_code, early ORDER BY year NULLS FIRST, quarter NULLS FIRST) AS before FROM {name}_o),
{name}_c AS (SELECT *, {R('(value - before) / NULLIF(abs(before), 0) * 100', 4)} AS change FROM {name}_l),
{name} AS (SELECT COALESCE(iso3, country_code_2) AS country_code, indicator_code, period, frequency, date_key, value, CASE WHEN early IS NULL THEN change END AS yoy_change,
  CASE WHEN early IS NULL THEN abs(change) > 200 END AS is_anomaly, source, COALESCE(early, CASE WHEN change IS NULL THEN 'change not scored'
  WHEN abs(change) > 200 THEN 'anomalous change' END) AS reason FROM {name}_c)"""


def _pipeline_incremental() -> str:
    return with_(*_observations(), _outcomes("final", 3)) + "SELECT * EXCLUDE (source) FROM final"


def _facts_as_of() -> str:
    ctes = [*_observations(), DC, DI, DS]
    for n in (1, 2, 3):
        ctes += [_outcomes(f"out{n}", n), f"""f{n} AS (SELECT date_key, country_key, indicator_key, frequency, value, yoy_change FROM out{n}
  JOIN dc USING (country_code) JOIN di USING (indicator_code) JOIN ds ON source = source_name WHERE reason IS NULL)"""]
    key = "date_key, country_key, indicator_key, frequency"
    # a version that stands keeps its flag; a new one is revised if its value is not that of the version before
    ctes += ["v1 AS (SELECT *, false AS is_revised FROM f1)", f"""v2 AS (SELECT {key}, n.value, n.yoy_change, CASE WHEN o.value IS NULL THEN false
  WHEN n.value = o.value AND n.yoy_change IS NOT DISTINCT FROM o.yoy_change THEN o.is_revised ELSE n.value <> o.value END AS is_revised
  FROM f2 n LEFT JOIN v1 o USING ({key}))""", f"""v3 AS (SELECT {key}, n.value, n.yoy_change,
  CASE WHEN o.value IS NULL THEN COALESCE(n.value <> a.value, false)
  WHEN n.value = o.value AND n.yoy_change IS NOT DISTINCT FROM o.yoy_change THEN o.is_revised ELSE n.value <> o.value END AS is_revised
  FROM f3 n LEFT JOIN v2 o USING ({key}) LEFT JOIN v1 a USING ({key}))"""]
    cols = f"{key}, value, yoy_change, is_revised"
    return with_(*ctes) + " UNION ALL ".join(f"SELECT {n} AS after_run, {cols} FROM v{n}" for n in (1, 2, 3))


def _stream_changes() -> str:
    def change(then: str, to: str) -> str:
        return R(f"(m.value - {then}) / NULLIF(abs({then}), 0) * 100", 4) + f" AS {to}"
    return with_(OM("om", "month"), f"s AS (SELECT {CC('nationkey')} AS country_code, year, sub AS month, year * 12 + sub - 1 AS idx, "
                 "CAST(total AS DOUBLE) AS value FROM om)",
                 "m AS (SELECT *, LAG(value) OVER (PARTITION BY country_code ORDER BY idx) AS before FROM s)") + f"""
SELECT m.country_code, m.year, m.month, m.value, {change('m.before', 'change_prev')}, {change('b.value', 'mom_change')}, {change('y.value', 'yoy_change')}
FROM m LEFT JOIN s b ON b.country_code = m.country_code AND b.idx = m.idx - 1 LEFT JOIN s y ON y.country_code = m.country_code AND y.idx = m.idx - 12"""


STAGING_RELOAD = """WITH faulty AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_custkey END AS c
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)),
n AS (SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS finished, (SELECT count(*) FROM orders) AS every,
  (SELECT count(*) FROM (SELECT o_orderkey FROM faulty GROUP BY 1 HAVING count(*) > 1)) AS dup, (SELECT count(*) FROM faulty WHERE c IS NULL) AS nulls,
  (SELECT count(*) FROM faulty WHERE c IS NULL OR c NOT IN (SELECT c_custkey FROM customer)) AS orphans)
SELECT 1 AS load, finished AS visible_rows, 0::BIGINT AS duplicate_keys, 0::BIGINT AS null_customers, 0::BIGINT AS orphans, true AS published FROM n
UNION ALL SELECT 2, finished, dup, nulls, orphans, false FROM n UNION ALL SELECT 3, every, 0, 0, 0, true FROM n"""

DIMENSION_KEYS = """SELECT row_number() OVER (ORDER BY c_custkey % 2, c_name)::INTEGER AS customer_key, c_name, c_custkey, c_nationkey FROM customer"""

_PAGES = f"""e AS (SELECT *, CAST(event_id // {reg.EVENT_PAGE} + 1 AS INTEGER) AS page FROM events),
types AS (SELECT event_type, count(*) AS total, max(page) AS pages FROM e GROUP BY 1),
landed AS (SELECT event_type, page, count(*) AS rows FROM e WHERE page % 7 <> 3 GROUP BY ALL),
docs AS (SELECT *, page % 5 = 1 AS cut FROM landed UNION ALL SELECT *, page % 5 = 1 FROM landed WHERE page % 11 = 5),
good AS (SELECT e.*, docs.page % 3 AS batch FROM docs JOIN e USING (event_type, page) WHERE NOT cut)"""

INGEST_CHECKED = f"""WITH {_PAGES}, every AS (
  SELECT CASE WHEN user_id % 17 = 0 THEN 'rejected' ELSE 'raw' END AS sink, event_type, '' AS reason, batch FROM good
  WHERE event_id % 13 <> 0 AND event_type <> 'error' AND value IS NOT NULL
  UNION ALL SELECT 'quarantine', event_type, 'value', batch FROM good WHERE event_id % 13 = 0
  UNION ALL SELECT 'quarantine', event_type, 'document', page % 3 FROM docs WHERE cut
  UNION ALL SELECT 'pages', event_type, '', page % 3 FROM docs WHERE NOT cut)
SELECT sink, event_type AS indicator_code, reason, count(*) AS rows, count(DISTINCT batch) AS batches FROM every GROUP BY ALL"""

PAGE_AUDIT = f"""WITH {_PAGES}, there AS (SELECT event_type, page, rows, count(*) AS n FROM docs WHERE NOT cut GROUP BY ALL),
got AS (SELECT event_type, count(*) AS landed, sum(n - 1)::BIGINT AS double, sum(rows)::BIGINT AS rows FROM there GROUP BY 1),
gone AS (SELECT event_type, string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) AS missing_pages
  FROM (SELECT event_type, unnest(generate_series(1, pages)) AS page FROM types) ANTI JOIN there USING (event_type, page) GROUP BY 1)
SELECT event_type AS indicator_code, types.pages, landed, double, total, rows, COALESCE(missing_pages, '') AS missing_pages, total - rows AS rows_short
FROM types JOIN got USING (event_type) LEFT JOIN gone USING (event_type)"""

UNIQUE_INCREMENTAL = "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def _refused_run() -> str:
    """The second run with rows finds them all in: nothing changes, and what counts is the facts of the first."""
    return with_(OM("om", "year"), RAWOBS("raw", "year", "om"), SCORED("sc", "raw"), GATED("tr", "sc"), "n AS (SELECT count(*) AS n FROM tr)") + """
SELECT 'run_a' AS run_id, 'load' AS stage, 'SUCCESS' AS status, n AS record_count, n AS facts FROM n
UNION ALL SELECT 'run_b', 'ingest', 'FAILED', 0, n FROM n UNION ALL SELECT 'run_c', 'load', 'SUCCESS', 0, n FROM n"""


ORACLE_SQL: dict[str, str] = {
    "staging_reload": STAGING_RELOAD,
    "dimension_keys": DIMENSION_KEYS,
    "ingest_checked": INGEST_CHECKED,
    "page_audit": PAGE_AUDIT,
    "unique_incremental": UNIQUE_INCREMENTAL,
    "csv_report": ORACLE["mart_sector_heatmap"],
    "refused_run": _refused_run(),
    # the live marts are the batch marts
    **{f"live_{name}": ORACLE[f"mart_{mart}"] for name, mart in (
        ("kpi", "kpi_latest"), ("trend", "trend"), ("country_map", "country_map"), ("heatmap", "sector_heatmap"), ("trade_flows", "trade_flows"))},
    "stream_changes": _stream_changes(),
    "pipeline_incremental": _pipeline_incremental(),
    "facts_as_of": _facts_as_of(),
}
