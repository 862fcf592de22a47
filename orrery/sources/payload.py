"""Landed API payloads -> raw observation rows (S-01).

A landed payload is one JSON document ``[meta, rows]`` where ``rows`` is an
array of objects with ``countryiso3code``, ``country.id``, ``date``, ``value``
and optionally ``unit``. Documents are parsed in two steps with ``from_json``
(outer array of raw JSON strings, then the typed row array), exploded, and
rows with a NULL value are dropped. Absent or empty row arrays give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.country import payload_code

ROW_SCHEMA = ("struct<countryiso3code:string, country:struct<id:string, value:string>, "
              "date:string, value:string, unit:string>")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``(path, text)``; files are read in parallel."""
    return (spark.read.option("wholetext", True).text(path)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def flatten_payload(docs: DataFrame, text: str = "text", indicator: str | Column = "indicator_code",
                    source: str = "World Bank", run_id: str = "", loaded_at: Column | None = None) -> DataFrame:
    """Payload documents -> raw observations in the raw-zone schema.

    ``indicator`` names a column of ``docs`` (or is a Column) giving the
    indicator each document was fetched for. ``unit`` defaults to ``''`` only
    when the field is absent from the row object. Numbers may come as text. What
    gives no row for a fault of its own is in ``payload_quarantine``.
    """
    ind = F.col(indicator) if isinstance(indicator, str) else indicator
    outer = docs.select(ind.alias("indicator_code"), F.from_json(F.col(text), "array<string>").alias("doc"))
    rows = outer.select("indicator_code", F.from_json(F.get(F.col("doc"), 1), "array<string>").alias("rows"))
    raw = rows.select("indicator_code", F.explode("rows").alias("row_text"))
    r = raw.select("indicator_code", F.from_json("row_text", ROW_SCHEMA).alias("r"),
                   F.array_contains(F.json_object_keys("row_text"), "unit").alias("has_unit"))
    # an absent ``unit`` key becomes ''; a present JSON null stays NULL
    unit = F.when(F.col("has_unit"), F.col("r.unit")).otherwise(F.lit(""))
    value = F.col("r.value").try_cast("double")
    return r.filter(value.isNotNull()).select(
        "indicator_code",
        payload_code(F.col("r.countryiso3code"), F.col("r.country.id")).alias("country_code_2"),
        F.col("r.date").alias("period"),
        value.alias("value"),
        unit.alias("unit"),
        F.lit(source).alias("source"),
        F.lit(run_id).alias("pipeline_run_id"),
        (loaded_at if loaded_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("loaded_at"),
    )


def payload_quarantine(docs: DataFrame, text: str = "text", indicator: str | Column = "indicator_code") -> DataFrame:
    """(indicator_code, reason, text) of documents that are no ``[meta, rows]`` and of rows
    that are no object or whose value is no number. A JSON null value is no fault."""
    ind = F.col(indicator) if isinstance(indicator, str) else indicator
    outer = docs.select(ind.alias("indicator_code"), F.col(text).alias("text"), F.from_json(F.col(text), "array<string>").alias("doc"))
    rows = F.get(F.col("doc"), 1)
    listed = F.from_json(rows, "array<string>")
    # a document without rows, or with a JSON null for them, is an empty page and no fault
    bad_doc = F.col("doc").isNull() | (F.size("doc") == 0) | (rows.isNotNull() & (F.trim(rows) != "null") & listed.isNull())
    documents = outer.filter(F.coalesce(bad_doc, F.lit(True))).select("indicator_code", F.lit("document").alias("reason"), "text")
    each = outer.filter(~F.coalesce(bad_doc, F.lit(True))).select("indicator_code", F.explode(listed).alias("text"))
    fields = F.from_json("text", ROW_SCHEMA)
    no_object = F.json_object_keys("text").isNull()
    no_number = fields["value"].isNotNull() & fields["value"].try_cast("double").isNull()
    reason = F.when(no_object, F.lit("row")).when(no_number, F.lit("value"))
    return documents.unionByName(each.select("indicator_code", reason.alias("reason"), "text").filter(F.col("reason").isNotNull()))


def payload_pages(docs: DataFrame, text: str = "text", indicator: str | Column = "indicator_code") -> DataFrame:
    """(indicator_code, page, pages, total, rows) of every document that parses: what its ``meta`` declares and how many rows it brings."""
    ind = F.col(indicator) if isinstance(indicator, str) else indicator
    doc = F.from_json(F.col(text), "array<string>")
    outer = docs.select(ind.alias("indicator_code"), doc.alias("doc")).filter(F.size("doc") > 0)
    meta = F.from_json(F.get("doc", F.lit(0)), "struct<page:int, pages:int, total:bigint>")
    rows = F.coalesce(F.size(F.from_json(F.get("doc", F.lit(1)), "array<string>")), F.lit(0))
    return outer.select("indicator_code", meta.alias("m"), F.greatest(rows, F.lit(0)).cast("long").alias("rows")).select(
        "indicator_code", "m.page", "m.pages", "m.total", "rows")


def build_payloads(rows: DataFrame, doc_key: dict[str, Column], indicator: Column, row_struct: Column,
                   page_meta: Column | None = None) -> DataFrame:
    """Group observation rows into ``[meta, rows]`` documents, one per ``doc_key``
    value (used to land test payloads). The key must bound a document, like an
    API page: e.g. ``id div page_size`` caps it at ``page_size`` rows."""
    meta = page_meta if page_meta is not None else F.struct(F.count(F.lit(1)).alias("total"))
    docs = rows.groupBy(*[c.alias(n) for n, c in doc_key.items()]).agg(
        F.first(indicator).alias("indicator_code"),
        F.to_json(meta).alias("__meta"),
        F.to_json(F.collect_list(row_struct)).alias("__rows"),
    )
    return docs.select(*doc_key, "indicator_code",
                       F.concat(F.lit("["), F.col("__meta"), F.lit(","), F.col("__rows"), F.lit("]")).alias("text"))
