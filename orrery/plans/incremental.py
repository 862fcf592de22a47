"""The pipeline at the cost of what a run brings (L-05, S-05, D-09).

``run_pipeline`` scores the whole history again with every run. Here the state is kept: the
latest delivery of every observation with its outcome, dealt over buckets of series
(country and indicator). A run

1. is written to the raw zone and read back, alone;
2. reads the buckets of the series it touches; of these only the touched series (a semi join)
   take its deliveries in and are scored again, as a late or revised observation also
   changes its neighbour's change; the other series of the bucket are carried along;
3. publishes these buckets as a new version (``sources/versions.py``);
4. takes the outcomes that changed, whether delivered or re-scored, on to the fact history, whose
   touched years get a new version, and to the run's own quarantine.

Series are bounded by their periods, and a bucket by the number of buckets, which sizes
the unit of rewriting; buckets are many more than the cores of a cluster at scale. Running a run
again finds nothing changed and loads nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orrery.operators.history import revise
from orrery.operators.load import observed_rows
from orrery.plans.pipeline import NATURAL_KEY, REASONS, parsed, to_fact_rows, with_outcome
from orrery.schemas import RAW_OBSERVATION
from orrery.sources import raw_zone
from orrery.sources.sinks import append_metrics
from orrery.sources.versions import VersionedTable

RAW = [*(f.name for f in RAW_OBSERVATION.fields), raw_zone.RUN_COL]
OUTCOME = ["country_iso3", "year", "quarter", "date_key", "frequency", "yoy_change", "is_anomaly", "reason"]
#: What a delivery or a re-score can change; the run that last changed it is ``scored_by``.
JUDGED = ["value", "yoy_change", "reason", "source"]
FACT_ATTRIBUTES = ["source_key", "value", "yoy_change", "pipeline_run_id"]


@dataclass
class IncrementalReport:
    run_id: str
    raw_rows: int
    read_rows: int  # of the state
    written_rows: int  # of the state
    rescored: int  # outcomes that changed
    buckets: int
    quarantined: dict[str, int] = field(default_factory=dict)


def series() -> Column:
    """A series by name: a country without a standard code by its raw code."""
    country = F.coalesce("country_iso3", F.concat(F.lit("?"), F.coalesce("country_code_2", F.lit(""))))
    return F.concat_ws("|", country, F.coalesce("indicator_code", F.lit("")))


class Warehouse:
    """Folders of the incremental pipeline: ``raw``, ``observations``, ``facts``, ``quarantine``, ``pipeline_metrics``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.state = VersionedTable(spark, f"{self.root}/observations")
        self.facts = VersionedTable(spark, f"{self.root}/facts")

    def observations(self) -> DataFrame | None:
        """Every observation with its latest delivery and outcome."""
        return self.state.read()

    def fact_history(self) -> DataFrame | None:
        return self.facts.read()

    def run(self, raw: DataFrame, run_id: str, dims: dict, at: Column | None = None, mapping=None, mode: str = "strict",
            keep_unscored: bool = False) -> IncrementalReport:
        """Take in one run. ``at`` is its load time (now). A run that fails or is empty (L-06) is recorded and raised."""
        stage, metrics = "ingest", f"{self.root}/pipeline_metrics"
        try:
            if raw.isEmpty():
                raise ValueError("the ingest returned no rows")
            seen = Observation("raw")
            raw_zone.write_run(raw.observe(seen, F.count(F.lit(1)).alias("rows")), f"{self.root}/raw", run_id)
            stage = "transform"
            report = self._transform(run_id, mapping, mode, keep_unscored)
            report.raw_rows = observed_rows(seen)
            stage = "load"
            changed = self.state.read(self._touched).filter(F.col("scored_by") == run_id)
            report.quarantined = self._load(changed, run_id, dims, at if at is not None else F.current_timestamp())
        except Exception:
            append_metrics(self.spark, metrics, run_id, stage, 0, "FAILED")
            raise
        append_metrics(self.spark, metrics, run_id, "load", report.rescored - sum(report.quarantined.values()), "SUCCESS")
        return report

    def _transform(self, run_id: str, mapping, mode: str, keep_unscored: bool) -> IncrementalReport:
        arrived = raw_zone.read_run(self.spark, f"{self.root}/raw", run_id).select(RAW)
        named = parsed(arrived, mapping, mode).withColumns({"series": series()}).withColumn("bucket", self._bucket())
        # at most one row a bucket comes to the driver
        self._touched = [r["bucket"] for r in named.select("bucket").distinct().collect()]
        wrote, rescored = Observation("wrote"), Observation("rescored")
        before = self.state.read(self._touched)
        fresh, carried = arrived, None
        if before is not None:
            touched = named.select("series").distinct()
            carried = before.join(touched, "series", "left_anti")
            known = before.join(touched, "series", "left_semi")
            fresh = arrived.unionByName(known.select(RAW))
        scored = with_outcome(parsed(fresh, mapping, mode), mode, keep_unscored=keep_unscored)
        # what is out by itself has no change: its period may have no place in the series
        own = F.coalesce(F.col("reason").isin(*REASONS[:3]), F.lit(False))
        scored = scored.withColumns({c: F.when(~own, F.col(c)) for c in ("yoy_change", "is_anomaly")})
        scored = scored.select(*RAW, *OUTCOME).withColumns({"series": series()}).withColumn("bucket", self._bucket())
        mine = F.lit(run_id)
        if before is None:
            scored = scored.withColumn("scored_by", mine)
        else:
            key = ["series", "period"]
            old = known.select(*[F.col(k).alias(f"__{k}") for k in key], F.struct(*JUDGED, "scored_by").alias("__old"))
            same = F.col("__old").isNotNull()
            for c in JUDGED:
                same = same & F.col(c).eqNullSafe(F.col(f"__old.{c}"))
            match = F.lit(True)
            for k in key:
                match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
            scored = scored.join(old, match, "left").withColumn("scored_by", F.when(same, F.col("__old.scored_by")).otherwise(mine))
            scored = scored.drop("__old", *[f"__{k}" for k in key])
        rows = scored if carried is None else scored.unionByName(carried.select(scored.columns))
        rows = rows.observe(wrote, F.count(F.lit(1)).alias("rows")).observe(rescored, F.count_if(F.col("scored_by") == mine).alias("rows"))
        self.state.publish(rows, "bucket", self._touched, run_id, ("series", "year"))
        return IncrementalReport(run_id, 0, 0 if before is None else before.count(), observed_rows(wrote), observed_rows(rescored), len(self._touched))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("series"), F.lit(self.buckets)).cast("int")

    def _load(self, changed: DataFrame, run_id: str, dims: dict, at: Column) -> dict[str, int]:
        """Changed outcomes to the fact history and the quarantine; returns the run's quarantine counts."""
        rows = changed.withColumn("country_code", F.coalesce("country_iso3", "country_code_2")).withColumns(
            {"is_estimated": F.lit(False), "load_timestamp": at})
        parsable = rows.filter(F.col("date_key").isNotNull())
        resolved, orphans = to_fact_rows(parsable, dims["country"], dims["indicator"], dims["source"], dims.get("date"), extra=("reason",))
        columns = ["date_key", "country_code", "indicator_code", "source", "value", "period", "frequency", "pipeline_run_id", "reason"]
        missing = orphans.filter(F.col("reason").isNull()).withColumn("reason", F.concat(F.lit("unknown key: "), F.col("missing")))
        out = rows.filter(F.col("reason").isNotNull()).select(columns).unionByName(missing.select(columns))
        raw_zone.write_run(out, f"{self.root}/quarantine", run_id)
        counts = {r["reason"]: r["n"] for r in raw_zone.read_run(self.spark, f"{self.root}/quarantine", run_id)
                  .groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row per reason

        batch = resolved.withColumns({"year": F.floor(F.col("date_key") / 10000).cast("int"), "out": F.col("reason").isNotNull()})
        years = [r["year"] for r in batch.select("year").distinct().collect()]
        if years:
            history = revise(self.facts.read(years), batch, [*NATURAL_KEY, "year"], FACT_ATTRIBUTES, at, retracted="out")
            self.facts.publish(history, "year", years, run_id, ("date_key", "country_key"))
        return counts

    def vacuum(self, keep: int = 2) -> int:
        return len(self.state.vacuum(keep)) + len(self.facts.vacuum(keep))
