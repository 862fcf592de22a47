"""Secret scans: fixed patterns, and a character network over every other candidate.

Spans are (kind, start, end) in code points, end exclusive. The kinds ``assign``,
``access`` and ``hex`` come from patterns and always stay. A candidate is any other run of 6
or more token characters that has a digit, a mark inside or a change from small to capital letters,
that has 20 characters, or that follows ``:`` or ``=``: all that is not a plain word.
Marks at the ends of a run are no part of it. What a pattern's span leaves of a
run is a candidate by itself. A convolutional network (char_cnn.py) reads every candidate with its
context and adds it as kind ``net`` where its calibrated probability reaches the threshold: the
highest that keeps ``recall`` of held-out secrets, or the lowest that passes no more than
``noise`` of the held-out others, if that is higher.

The network learns from findings whose labels do not come from the patterns alone: planted secrets
and look-alikes of many shapes (findings.py) in contexts of the corpus, the patterns' own findings, and
unlabelled candidates of the corpus. The latter are mostly no secrets, but may hold some that the patterns miss: a
first network, which has learned from the labelled findings alone, tells which of them to leave out of
the training of the second. Training (scanner_training.py), calibration and threshold take all distinct
candidates of the table; scanning covers every text whole.

A null or empty text has no spans. Equal rows get equal spans. A table without any candidate adds none and learns nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .char_cnn import CharCNN, codes, window
from .scanner_training import train_on
from .textbytes import release, slices

# The patterns of the base kinds, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "net")

LEAST, LONG = 6, 20
_T = r"[A-Za-z0-9+/_.=@$!#%^&*~-]"
#: Whole runs but for plain words that follow no ``:`` or ``=``.
RUN = re.compile(rf"""(?<!{_T})(?:(?!(?:[A-Z]?[a-z]{{0,18}}|[A-Z]{{1,19}})[.!]?(?!{_T}))"""
                 r"""|(?<=:)|(?<=[:=]["'])|(?<=[:=]\x20)|(?<=[:=]\x20["'])|(?<=[:=]\x20\x20)|(?<=[:=]\x20\x20["']))""" + _T + "{6,}")
MARKS = "+/_.=@$!#%^&*~-"
NOT_PLAIN = re.compile(r"[0-9]|[a-z][A-Z]|[A-Za-z][^A-Za-z]+[A-Za-z]")
GIVEN = re.compile(r"[:=]\x20{0,2}[\"']?\Z")
SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_FINDING = pa.list_(pa.struct([("window", pa.string()), ("secret", pa.bool_())]))

def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern kinds, by start and then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if "=" in text or ":" in text else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A run without the marks at its ends; up to two ``=`` after letters or digits stay."""
    own = text[start:end]
    body = own.rstrip(MARKS)
    pad = len(own) - len(body)
    more = min(2, len(own[len(body):]) - len(own[len(body):].lstrip("=")))
    left = len(body) - len(body.lstrip(MARKS))
    return start + left, end - pad + more


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) of every candidate outside the base spans."""
    out, k = [], 0
    for m in RUN.finditer(text):
        start, end = m.span()
        while k < len(base) and base[k][1] <= start:
            k += 1
        at, parts, j = start, [], k
        while j < len(base) and base[j][0] < end:
            parts.append((at, base[j][0]))
            at, j = max(at, base[j][1]), j + 1
        for s, e in (*parts, (at, end)):
            s, e = _trimmed(text, s, e) if e - s >= LEAST else (s, s)
            if e - s >= LEAST and (e - s >= LONG or NOT_PLAIN.search(text, s, e) or GIVEN.search(text, max(0, s - 5), s)):
                out.append((s, e))
    return out


def findings(text: Column) -> Column:
    """Windows of the base findings and of the other candidates of each text."""

    @F.arrow_udf("array<struct<window:string,secret:boolean>>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], _FINDING)]
            for texts in slices(batch):
                rows: list[list] = []
                for t in texts.to_pylist():
                    base = base_spans(t) if t else []
                    rows.append([{"window": window(t, s, e), "secret": False} for s, e in (candidates(t, base) if t else ())]
                                + [{"window": window(t, value_start(t, s, e, k), e), "secret": True} for s, e, k in base])
                parts.append(pa.array(rows, _FINDING))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text)


def value_start(text: str, start: int, end: int, kind: str) -> int:
    """Where the value of a base span begins: that of ``assign`` without its name."""
    return ASSIGN.match(text, start, end).start(2) if kind == "assign" else start


def train_scanner(docs: DataFrame, text: str = "text", recall: float = 0.98, noise: float = 0.002) -> CharCNN | None:
    """Network trained on all distinct findings of the patterns, all other candidates, and planted findings."""
    found = docs.select(F.explode(findings(F.col(f"`{text}`").cast("string"))).alias("f")).select("f.*").distinct()
    return train_on(found, recall, noise)


def spans_of_all(texts: list[str | None], model: CharCNN | None) -> list[list[tuple[int, int, str]]]:
    """Spans of each text by start and then kind; the candidates of all texts are scored together."""
    found = [base_spans(t) if t else [] for t in texts]
    if model is None:
        return found
    more = [(i, s, e) for i, t in enumerate(texts) if t for s, e in candidates(t, found[i])]
    p = model.probability(codes([window(texts[i], s, e) for i, s, e in more]))
    for k in np.flatnonzero(p >= model.threshold):
        i, s, e = more[k]
        found[i].append((s, e, "net"))
    return [sorted(x, key=lambda y: (y[0], KINDS.index(y[2]))) for x in found]


def spans_of(text: str, model: CharCNN | None) -> list[tuple[int, int, str]]:
    return spans_of_all([text], model)[0]


def secret_spans(text: Column, model: CharCNN | None) -> Column:
    """Column of the spans of each text, by start and then kind."""

    @F.arrow_udf(SPAN)
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], _SPAN)]
            for texts in slices(batch):
                rows = [[{"kind": k, "start": s, "end": e} for s, e, k in x] for x in spans_of_all(texts.to_pylist(), model)]
                parts.append(pa.array(rows, _SPAN))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text.cast("string"))


def redacted(text: Column, model: CharCNN | None, mark: str = "[SECRET]") -> Column:
    """Text with every span (overlapping or touching ones together) replaced by ``mark``."""

    @F.arrow_udf("string")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.string())]
            for texts in slices(batch):
                rows = texts.to_pylist()
                for i, spans in enumerate(spans_of_all(rows, model)):
                    if spans:
                        out, at = [], 0
                        for s, e, _ in spans:
                            if s > at or not out:
                                out += [rows[i][at:s], mark]
                            at = max(at, e)
                        rows[i] = "".join(out) + rows[i][at:]
                parts.append(pa.array(rows, pa.string()))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text.cast("string"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def scan_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", recall: float = 0.98, noise: float = 0.002) -> DataFrame:
    """``docs`` with an array of spans in column ``into`` (replaced if there); all rows and other columns stay."""
    model = train_scanner(docs, text, recall, noise)
    return docs.withColumn(into, secret_spans(F.col(f"`{text}`"), model))
