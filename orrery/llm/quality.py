"""Quality rules: simple counts, and perplexity bands of a Kneser-Ney model.

The base rule rejects texts of fewer than 50 words, and those where over half of the
words lie in 3-word windows that the text repeats. For the others the bits per byte
under a modified Kneser-Ney model of all texts (kneser_ney.py) must lie within the band
of their language: median +- ``width`` robust standard deviations (1.4826 times the
median absolute deviation, ``least_spread`` bits at least). Too high is text unlike the
language, too low is text of little content.

Bands come from exact medians over all documents that the base rule keeps, from bits
rounded to 1/1024. A null language is one of its own. A null or empty text has no words
and is rejected by the base rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kneser_ney import SLICE, KneserNey, ngrams_of, symbols
from .tables import aside, written
from .textbytes import SPACE, flat, hashes, lines, mix, release, slices, windows, words

STEPS = 1024
MEASURES = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,bits:double>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items equal an earlier one of their text, and which occur twice or more in it."""
    key = mix(key + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return later, any_


def text_measures(raw: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(off) - 1
    w, ln = words(raw, off), lines(raw, off)
    by = lambda text, flag: np.bincount(text[flag], minlength=n).astype(np.int64)
    starts = np.flatnonzero(~SPACE[raw] & ((raw & 0xC0) != 0x80))
    symbols = np.flatnonzero(_SYMBOL[raw])
    has_word = np.searchsorted(w.start, ln.end) > np.searchsorted(w.start, ln.start)
    later, _ = _repeats(hashes(raw, ln.start, ln.end)[has_word], ln.text[has_word])
    text = w.text
    h, item = windows(hashes(raw, w.start, w.end), w.first, 3)
    _, twice = _repeats(h, text[item])
    covered = np.zeros(len(w.start) + 2, bool)
    for k in range(3):
        covered[item[twice] + k] = True
    return {"n_words": np.diff(w.first), "word_chars": np.diff(np.searchsorted(starts, off)),
            "n_symbols": np.diff(np.searchsorted(symbols, off)), "n_dup_lines": by(ln.text[has_word], later),
            "n_repeat_words": by(text, covered[:len(text)])}


def measured(docs: DataFrame, model: KneserNey, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct of the base counts and the bits per byte (null for an empty text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(MEASURES)
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for texts in slices(batch, SLICE):
                raw, off = flat(texts)
                out = text_measures(raw, off)
                units, at = symbols(raw, off)
                total = np.concatenate([[0.0], np.cumsum(-shared.value.log2_probability(ngrams_of(units, at)))])[at]
                size = np.diff(off)
                bits = np.diff(total) / np.maximum(size, 1)
                parts.append(pa.StructArray.from_arrays([*(pa.array(v, pa.int64()) for v in out.values()), pa.array(bits, mask=size == 0)],
                                                        [*out, "bits"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(f, pa.int64()) for f in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("bits", pa.float64())]))
            del batch, parts
        release()

    return docs.withColumn(into, udf(F.col(f"`{text}`").cast("string")))


def base_failed(q: str = "quality"):
    n_words = F.col(f"{q}.n_words")
    return (n_words < 50) | (100 * F.col(f"{q}.n_repeat_words") > 50 * n_words)


def bands(scored: DataFrame, lang: str = "lang", q: str = "quality", width: float = 6.0, least_spread: float = 0.03) -> DataFrame:
    """One row per language: lowest and highest bits per byte that are kept."""
    step = F.round(F.col(f"{q}.bits") * STEPS).cast("long")
    counts = scored.select(lang, q).filter(~base_failed(q)).groupBy(F.col(lang).alias("_lang"), step.alias("step")).agg(F.count("*").alias("n"))
    middle = counts.groupBy("_lang").agg(F.expr("percentile(step, 0.5, n)").alias("mid"))
    apart = counts.alias("c").join(middle.alias("m"), F.col("c._lang").eqNullSafe(F.col("m._lang"))).select("c._lang", "mid", "n", F.abs(F.col("step") - F.col("mid")).alias("gap"))
    half = F.greatest(1.4826 * F.expr("percentile(gap, 0.5, n)") / STEPS, F.lit(least_spread)) * width
    return written(apart.groupBy("_lang").agg((F.first("mid") / STEPS).alias("_mid"), half.alias("_half")), "bands")


def judged(scored: DataFrame, limits: DataFrame, lang: str = "lang", q: str = "quality") -> DataFrame:
    """``scored`` with ``base_failed`` and ``kept`` (replaced if there)."""
    scored, back = aside(scored, (lang, q), ("base_failed", "kept"))
    out = scored.join(limits, F.col(lang).eqNullSafe(F.col("_lang")), "left")
    inside = F.abs(F.col(f"{q}.bits") - F.col("_mid")) <= F.col("_half")
    return back(out.withColumn("base_failed", base_failed(q)).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))))

