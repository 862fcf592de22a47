"""Callers' columns that have the names of the operators' own."""

import public_tokenizers
from pyspark.sql import functions as F

from orrery.llm.line_dedup import LineDuplicates
from orrery.llm.near_dup import drop_near_duplicates
from orrery.llm.packing import pack_best_fit
from orrery.llm.quality import bands, judged, measured
from orrery.llm.kneser_ney import train
from orrery.llm.repeats import RepeatedStrings

NAMES = ["lines", "_d1", "_d2", "_may", "_t1", "_t2", "_spans", "_cut", "_lang", "_mid", "_half", "_room", "_deal", "_group", "_key", "_words", "_k1", "_k2", "_first",
         "LINES", "kept", "base_failed", "n_removed", "text2"]


def docs(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(i, f"{line}\nown words of number {i} in a line\nok", "en") for i in range(4)] + [(9, None, None), (10, "", "en")]
    names = [n for n in NAMES if n != "LINES"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id")).alias(n) for n in names])


def same_others(got, before, but=()):
    cols = ["doc_id", *[c for c in before.columns if c not in ("doc_id", "text", *but)]]
    assert [c for c in before.columns] == got.columns[:len(before.columns)]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, before.select(cols).filter(F.col("doc_id").isin([r[0] for r in got.select("doc_id").collect()])).collect()))


def test_line_dedup(spark):
    d = docs(spark)
    got = LineDuplicates(d).apply(d)
    same_others(got, d)
    assert sum("one two" in (r["text"] or "") for r in got.collect()) == 1
    assert sum((r["text"] or "").endswith("\nok") for r in got.collect()) == 1  # a line of one word, too
    got = LineDuplicates(d).apply(d, "lines", "n_removed")
    same_others(got, d, ("lines", "n_removed"))


def test_near_dedup_repeats_quality_packing(spark):
    d = docs(spark)
    same_others(drop_near_duplicates(d), d)
    same_others(RepeatedStrings(d).apply(d), d, ("kept", "n_removed"))
    scored = measured(d, train(d))
    got = judged(scored, bands(scored))
    same_others(got, d, ("kept", "base_failed"))
    assert got.filter("kept").count() == 0
    pieces = d.withColumn("length", F.lit(7)).withColumn("offset", F.lit("x"))
    got = pack_best_fit(pieces)
    same_others(got, d)
    assert sorted(r["offset"] for r in got.collect()) == [0, 7, 14, 21, 28, 35]
