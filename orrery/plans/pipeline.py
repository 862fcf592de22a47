"""The batch pipeline: raw observations -> transformed observations -> fact rows.

``transform`` is one lazy DataFrame chain. All runs repeat the same observations, so the
latest-run reduce is an aggregate that combines in each task before it shuffles; the
change window then shuffles the reduced rows only.

Every raw row ends in one place: loaded (or already there), superseded by a later
delivery, or in the quarantine table with its reason.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orrery.functions.country import with_standard_code
from orrery.functions.keys import hash_key
from orrery.functions.period import frequency, parse_period
from orrery.operators.change import calendar_change, flag_anomalies, pct_change_prev, period_index
from orrery.operators.load import DimRef, append_rows, latest_version, load_if_absent, observed_rows, resolve_keys
from orrery.schemas import FACT_ECONOMIC_INDICATORS
from orrery.sources import raw_zone

SERIES_KEYS = ("country_iso3", "indicator_code")
#: An annual and a fourth-quarter value share their date, so the frequency is part of the key.
NATURAL_KEY = ("date_key", "country_key", "indicator_key", "frequency")

REASONS = ("value is null", "unknown country", "unparsable period", "change not scored", "anomalous change", "unknown key", "key is null")


def latest_runs(raw: DataFrame) -> DataFrame:
    """One row per observation: the latest delivery, ties broken by all other columns."""
    version = [c for c in ("loaded_at", "run", "pipeline_run_id") if c in raw.columns]
    keys = ["country_iso3", "indicator_code", "period"]
    rest = [c for c in raw.columns if c not in keys and c not in version]
    return latest_version(raw, keys, [*version, *rest])


def parsed(raw: DataFrame, mapping=None, mode: str = "strict", latest_run_only: bool = True) -> DataFrame:
    """Standard codes, latest delivery and period columns; nothing is dropped but superseded deliveries."""
    df = with_standard_code(raw, "country_code_2", "country_iso3", mapping)
    if latest_run_only:
        # rows without a standard code are told apart by the raw code
        df = latest_runs(df.withColumn("country_iso3", F.coalesce("country_iso3", F.concat(F.lit("?"), F.coalesce("country_code_2", F.lit(""))))))
        df = df.withColumn("country_iso3", F.when(~F.col("country_iso3").startswith("?"), F.col("country_iso3")))
    df = parse_period(df, "period", mode)
    return df.withColumn("frequency", frequency(F.col("quarter"), F.col("month") if mode == "extended" else None))


def with_change(df: DataFrame, mode: str = "strict", threshold: float = 200.0, scale: int = 4) -> DataFrame:
    order = ["year", "quarter", "month"] if mode == "extended" else ["year", "quarter"]
    df = pct_change_prev(df, list(SERIES_KEYS), order, "value", "yoy_change", scale)
    return flag_anomalies(df, "yoy_change", threshold)


def scored(raw: DataFrame, mapping=None, mode: str = "strict", threshold: float = 200.0, scale: int = 4,
           latest_run_only: bool = True, unparsable_take_part: bool = False) -> DataFrame:
    """Standardise, parse, reduce to the latest run per observation, and score changes.

    Rows without a standard code go. Rows whose period does not parse go before the change
    window, so that none becomes the previous value of the first good period;
    ``unparsable_take_part`` keeps them in it (they sort first), for parity with feeds
    scored that way. Keeps every column needed by the gate (``is_anomaly`` NULL for unscored rows).
    """
    df = parsed(raw, mapping, mode, latest_run_only).filter(F.col("country_iso3").isNotNull())
    if not unparsable_take_part:
        df = df.filter(F.col("date_key").isNotNull())
    return with_change(df, mode, threshold, scale)


def with_outcome(df: DataFrame, mode: str = "strict", threshold: float = 200.0, scale: int = 4, keep_unscored: bool = False) -> DataFrame:
    """Parsed observations with their change, flag and the ``reason`` that keeps them out (NULL: they go on)."""
    early = (F.when(F.col("value").isNull(), REASONS[0]).when(F.col("country_iso3").isNull(), REASONS[1])
             .when(F.col("date_key").isNull(), REASONS[2]))
    # rows that are out already form series of their own: none is another's previous value
    df = df.withColumn("__out", early)
    order = ["year", "quarter", "month"] if mode == "extended" else ["year", "quarter"]
    df = pct_change_prev(df, [*SERIES_KEYS, "__out"], order, "value", "yoy_change", scale)
    df = flag_anomalies(df, "yoy_change", threshold)
    late = F.when(F.col("is_anomaly"), REASONS[4])
    if not keep_unscored:
        late = F.when(F.col("is_anomaly").isNull(), REASONS[3]).otherwise(late)
    return df.withColumn("reason", F.coalesce("__out", late)).drop("__out")


def judged(raw: DataFrame, mapping=None, mode: str = "strict", threshold: float = 200.0, scale: int = 4,
           keep_unscored: bool = False, latest_run_only: bool = True,
           load_timestamp: F.Column | None = None) -> DataFrame:
    """The transformed schema for every observation, with the ``reason`` that keeps it out (NULL: it goes on)."""
    df = with_outcome(parsed(raw, mapping, mode, latest_run_only), mode, threshold, scale, keep_unscored)
    return df.select(
        "date_key", F.coalesce("country_iso3", "country_code_2").alias("country_code"), "indicator_code", "source", "value", "yoy_change",
        F.lit(False).alias("is_estimated"), "is_anomaly", "pipeline_run_id",
        (load_timestamp if load_timestamp is not None else F.current_timestamp()).alias("load_timestamp"),
        "period", "frequency", "reason")


def transform(raw: DataFrame, mapping=None, mode: str = "strict", threshold: float = 200.0, scale: int = 4,
              keep_unscored: bool = False, latest_run_only: bool = True,
              load_timestamp: F.Column | None = None) -> DataFrame:
    """L-05: standardise -> parse -> change -> anomaly -> gate, in the transformed schema, with the frequency."""
    rows = judged(raw, mapping, mode, threshold, scale, keep_unscored, latest_run_only, load_timestamp)
    return rows.filter(F.col("reason").isNull()).drop("reason", "period")


def to_fact_rows(transformed: DataFrame, dim_country: DataFrame, dim_indicator: DataFrame | dict,
                 dim_source: DataFrame | dict, dim_date: DataFrame | None = None, extra: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Resolve natural codes to surrogate keys (J-04). Returns ``(fact_rows, orphans)``; fact rows
    keep the columns ``extra`` too.

    Small code lists may be passed as ``{code: key}`` dicts (map lookup, no join)."""
    dims = [
        DimRef(dim_country, "country_code", "country_code", "country_key"),
        DimRef(dim_indicator, "indicator_code", "indicator_code", "indicator_key"),
        DimRef(dim_source, "source", "source_name", "source_key"),
    ]
    if dim_date is not None:
        dims.append(DimRef(dim_date.select(F.col("date_key").alias("__dk"), F.col("date_key").alias("__dk_ok")),
                           "date_key", "__dk", "__dk_ok"))
    matched, orphans = resolve_keys(transformed, dims)
    facts = matched.select(
        hash_key(*NATURAL_KEY).alias("indicator_id"),
        "date_key", "country_key", "indicator_key", "source_key", "value", "yoy_change",
        "is_estimated", "pipeline_run_id", "load_timestamp", "frequency", *extra,
    )
    return facts, orphans


def declared_facts(facts: DataFrame) -> DataFrame:
    """Fact rows with the declared columns and types, then ``frequency`` and ``year``.

    ``qoq_change`` and ``mom_change`` compare with the quarter and the month before, on
    quarterly and monthly series; ``is_revised`` is false on a first load.
    """
    month = F.floor(F.col("date_key") / 100) % 100
    year = F.floor(F.col("date_key") / 10000).cast("int")
    series = ["country_key", "indicator_key", "frequency"]
    df = facts.withColumns({"year": year, "__m": period_index(year, month.cast("int"), 12)})
    df = calendar_change(df, series, "__m", "value", 3, "qoq_change")
    df = calendar_change(df, series, "__m", "value", 1, "mom_change")
    quarterly, monthly = F.col("frequency") == "Q", F.col("frequency") == "M"
    df = df.withColumns({"qoq_change": F.when(quarterly, F.col("qoq_change")), "mom_change": F.when(monthly, F.col("mom_change")),
                         "is_revised": F.lit(False)})
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_ECONOMIC_INDICATORS.fields], "frequency", "year")


def write_facts(facts: DataFrame, path: str) -> None:
    """First load of the stored fact: declared types, partitioned by year."""
    append_rows(declared_facts(facts), path, ["year"], ["date_key", "country_key"])


@dataclass
class RunReport:
    run_id: str
    raw_rows: int
    transformed_rows: int
    loaded_rows: int
    status: str
    quarantined: dict[str, int] = field(default_factory=dict)


def _quarantine(frames: list[DataFrame], path: str, run_id: str) -> dict[str, int]:
    """Append the rows under ``run=<run_id>`` and return how many have each reason."""
    columns = ["date_key", "country_code", "indicator_code", "source", "value", "period", "frequency", "pipeline_run_id", "reason"]
    rows = reduce(DataFrame.unionByName, [f.select(*columns) for f in frames])
    raw_zone.write_run(rows, path, run_id)
    counts = raw_zone.read_run(rows.sparkSession, path, run_id).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return {r.reason: r.n for r in counts.collect()}  # at most one row per reason


def run_pipeline(spark: SparkSession, raw: DataFrame, warehouse: str, run_id: str, dims: dict[str, DataFrame],
                 mapping=None, mode: str = "strict", keep_unscored: bool = False) -> RunReport:
    """Ingest -> transform -> load, with counts observed on the writes (no re-scan).

    ``raw`` is a frame of raw observations (for instance ``flatten_payload`` over
    landed files). Writes ``{warehouse}/raw``, ``{warehouse}/processed`` and
    ``{warehouse}/quarantine`` by run, and appends new facts to
    ``{warehouse}/fact_economic_indicators``, partitioned by year. A run that fails,
    or that gets no rows (L-06), is recorded in ``{warehouse}/pipeline_metrics`` as
    FAILED with its stage, and the error is raised.
    """
    from orrery.sources.sinks import append_metrics

    metrics, stage = f"{warehouse}/pipeline_metrics", "ingest"
    try:
        if raw.isEmpty():  # before any write
            raise ValueError("the ingest returned no rows")
        raw_obs = Observation("raw")
        raw_zone.write_run(raw.observe(raw_obs, F.count(F.lit(1)).alias("rows")), f"{warehouse}/raw", run_id)

        stage = "transform"
        tr_obs = Observation("transformed")
        judged_rows = judged(raw_zone.read_all_runs(spark, f"{warehouse}/raw"), mapping, mode, keep_unscored=keep_unscored)
        good = F.count_if(F.col("reason").isNull()).alias("rows")
        raw_zone.write_run(judged_rows.observe(tr_obs, good), f"{warehouse}/processed", run_id)

        stage = "load"
        processed = raw_zone.read_run(spark, f"{warehouse}/processed", run_id).drop("run")
        going_on = processed.filter(F.col("reason").isNull()).drop("reason", "period")
        facts, orphans = to_fact_rows(going_on, dims["country"], dims["indicator"], dims["source"], dims.get("date"))
        out = [processed.filter(F.col("reason").isNotNull()),
               orphans.withColumns({"period": F.lit(None).cast("string"), "reason": F.concat(F.lit("unknown key: "), F.col("missing"))})]
        quarantined = _quarantine(out, f"{warehouse}/quarantine", run_id)
        loaded = load_if_absent(declared_facts(facts), f"{warehouse}/fact_economic_indicators", list(NATURAL_KEY), ["year"],
                                sort_within=["date_key", "country_key"])
    except Exception:
        append_metrics(spark, metrics, run_id, stage, 0, "FAILED")
        raise
    report = RunReport(run_id, observed_rows(raw_obs), observed_rows(tr_obs), loaded, "SUCCESS", quarantined)
    append_metrics(spark, metrics, run_id, "load", report.loaded_rows, report.status)
    return report
