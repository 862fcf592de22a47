from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from orrery.llm import kneser_ney
from orrery.llm import quality as rules
from orrery.llm.secrets import spans_of, train_scanner
from orrery.llm.tables import written

from .test_line_dedup import brute as plain_lines
from .test_near_dup import bag, brute_classes
from .test_packing import check_places
from .test_quality import brute as plain_measures

SF = "/root/testdata/sf0.01"
STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def kept(spark):
    """The result of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), name)
    return out


def test_stages(kept):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "secrets", "packing"]
    for name in list(STAGES)[:-1]:
        assert kept[name].dtypes == kept["documents"].dtypes
        assert all(r.n_chars == len(r.text) for r in kept[name].collect())


def test_quality_stage(kept, spark):
    docs = kept["documents"]
    scored = rules.measured(docs, kneser_ney.train(docs))
    bits = {r.doc_id: (r.lang, r.quality.bits) for r in scored.collect()}
    passed = {}
    for r in docs.collect():
        n, _, _, _, repeated = plain_measures(r.text)
        if n >= 50 and 100 * repeated <= 50 * n:
            passed[r.doc_id] = bits[r.doc_id]
    by = defaultdict(list)
    for lang, b in passed.values():
        by[lang].append(np.floor(b * 1024 + 0.5))
    want = set()
    for d, (lang, b) in passed.items():
        mid = np.median(by[lang])
        half = 6 * max(1.4826 * np.median(np.abs(np.array(by[lang]) - mid)) / 1024, 0.03)
        if abs(b - mid / 1024) <= half:
            want.add(d)
    assert {r.doc_id for r in kept["quality"].collect()} == want


def test_line_stage(kept):
    want, _ = plain_lines([(r.doc_id, r.text) for r in kept["quality"].collect()])
    assert {r.doc_id: r.text for r in kept["line_dedup"].collect()} == {d: t for (d, _), t in want.items()}


def test_near_duplicate_stage(kept):
    texts = {r.doc_id: r.text for r in kept["line_dedup"].collect()}
    classes = brute_classes(texts)
    want = {d for d, c in classes.items() if c == d or not bag(texts[d])}
    assert {r.doc_id: r.text for r in kept["near_dedup"].collect()} == {d: texts[d] for d in want}


def test_secret_stage(kept):
    docs = kept["near_dedup"]
    model, want = train_scanner(docs), {}
    for r in docs.collect():
        cover = [False] * len(r.text)
        for s, e, _ in spans_of(r.text, model):
            cover[s:e] = [True] * (e - s)
        out, i = [], 0
        ends = {}
        for s, e, _ in spans_of(r.text, model):
            ends[s] = max(e, ends.get(s, 0))
        while i < len(r.text):
            if cover[i]:
                out.append("[SECRET]")
                while i < len(r.text) and cover[i]:
                    i += 1
            else:
                out.append(r.text[i])
                i += 1
        want[r.doc_id] = "".join(out)
    got = {r.doc_id: r.text for r in kept["secrets"].collect()}
    assert got == want and any("[SECRET]" in t for t in got.values())


def test_packing_stage(kept):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = kept["packing"].collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.doc_id] += r.length
    want = {r.doc_id: len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept["secrets"].collect()}
    assert sizes == want
    assert check_places(rows) <= 1.02 * sum(want.values()) / 4096 + 1


def test_registered(spark):
    assert entry.queries()["pipeline"] is pipeline.run
    rows = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert rows and check_places(rows)


def test_odd_tables(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 30_000, "en", "s", 1), (2, "word " * 30_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.count() <= 20
            if name != "packing":
                assert out.dtypes == docs.dtypes
