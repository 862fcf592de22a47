"""Reshapes: wide array series <-> long rows, unpivot, and the one-row KPI record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def series_to_arrays(df: DataFrame, keys: Sequence[str], year: str, values: Sequence[str]) -> DataFrame:
    """Long ``(keys, year, value...)`` -> one row per key with ``base_year`` and a
    dense array per measure (missing years -> NULL). Each array holds one entry
    per year of the key's span, so its size is bounded by the calendar, not the data."""
    entries = {v: F.map_from_entries(F.collect_list(F.struct(F.col(year), F.col(v)))).alias(f"__m_{v}")
               for v in values}
    g = df.groupBy(*keys).agg(F.min(year).alias("base_year"), F.max(year).alias("__last"), *entries.values())
    years = F.sequence(F.col("base_year"), F.col("__last"))

    def lookup(v: str):
        return lambda y: F.element_at(F.col(f"__m_{v}"), y)

    cols = [F.transform(years, lookup(v)).alias(v) for v in values]
    return g.select(*keys, "base_year", *cols)


def arrays_to_long(df: DataFrame, keys: Sequence[str], arrays: Sequence[str], base_year: str | int | Column,
                   year_out: str = "year", drop_falsy: Sequence[str] = ()) -> DataFrame:
    """Wide arrays -> one row per (key, position) with ``year = base + position`` (L-03).

    ``arrays_zip`` keeps the measures aligned by position. Measures in
    ``drop_falsy`` treat 0 as missing (F-10): the row keeps NULL for that measure.
    """
    base = F.lit(base_year) if isinstance(base_year, int) else (F.col(base_year) if isinstance(base_year, str)
                                                                else base_year)
    z = df.select(*keys, base.alias("__base"), F.posexplode(F.arrays_zip(*[F.col(a) for a in arrays])))
    out = z.select(*keys, (F.col("__base") + F.col("pos")).cast("int").alias(year_out),
                   *[F.col(f"col.{a}").alias(a) for a in arrays])
    for a in drop_falsy:
        out = out.withColumn(a, F.when(F.col(a) != 0, F.col(a)))
    return out


def unpivot(df: DataFrame, ids: Sequence[str], measures: dict[str, str], name: str = "indicator_code",
            value: str = "value", value_type: str = "double") -> DataFrame:
    """Wide measures -> long ``(ids, name, value)``; ``measures`` maps column -> label."""
    pairs = ", ".join(f"'{label}', CAST(`{col}` AS {value_type})" for col, label in measures.items())
    return df.selectExpr(*[f"`{i}`" for i in ids], f"stack({len(measures)}, {pairs}) AS ({name}, {value})")


def kpi_record(latest: DataFrame, code_col: str, named_codes: dict[str, str],
               fields: dict[str, str]) -> DataFrame:
    """Latest rows ``(code, field...)`` -> one row, one struct per named code (A-07).

    ``named_codes`` maps output name -> code; ``fields`` maps struct field -> input
    column (``{'value': 'value', 'change': 'yoy_change'}``). A code with no row
    gives a struct of NULL fields. The pivot values are given explicitly, so the
    pivot is one hash aggregate with no extra job to find them.
    """
    codes = list(named_codes.values())
    s = F.struct(*[F.col(src).alias(f) for f, src in fields.items()])
    piv = latest.groupBy().pivot(code_col, codes).agg(F.first(s, ignorenulls=True))
    types = {f.name: f.dataType for f in latest.schema.fields}
    absent = F.struct(*[F.lit(None).cast(types[src]).alias(f) for f, src in fields.items()])
    return piv.select(*[F.coalesce(F.col(f"`{code}`"), absent).alias(name) for name, code in named_codes.items()])


def flatten_record(df: DataFrame) -> DataFrame:
    """Struct columns -> ``{column}_{field}`` columns (for row-wise comparison and CSV)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
