import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm.interpolation import BUCKETS, DeletedInterpolation, expectation_maximisation
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def pairs(ts):
    return list(zip(["<s>", *ts[:-1]], ts))


def counts(texts):
    words, both = Counter(), Counter()
    for t in texts:
        words.update(tokens(t))
        both.update(pairs(tokens(t)))
    words["<s>"] = len(texts)
    return words, both


def test_query_against_plain_counts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d in docs}
    words, both = counts([t for d, t in docs.items() if fold[d] != 2])
    n, v = sum(c for w, c in words.items() if w != "<s>"), len(words) - 1
    model_rows = {r.doc_id: r for r in QUERIES["op7_lm_score"](spark, SF).collect()}
    assert len(model_rows) == len(docs)
    fold_of = F.crc32(F.col("doc_id").cast("string")) % 7
    role = F.when(fold_of == 2, 2).when(fold_of == 3, 1).otherwise(0)
    weights = DeletedInterpolation(spark.read.parquet(f"{SF}/documents.parquet"), role).weights
    # weights: the same expectation-maximisation on events counted plainly
    rest, rest_both = counts([t for d, t in docs.items() if fold[d] not in (2, 3)])
    rn, rv = sum(c for w, c in rest.items() if w != "<s>"), len(rest) - 1
    events = Counter()
    for d, t in docs.items():
        if fold[d] == 3:
            for u, w in pairs(tokens(t)):
                events[rest[u].bit_length(), (rest_both[u, w] / rest[u]) if rest[u] else 0.0, rest[w] / rn] += 1
    b, p2, p1 = (np.array(x) for x in zip(*events))
    plain = expectation_maximisation(b, np.stack([p2, p1, np.full(len(b), 1 / (rv + 1))], axis=1), np.array(list(events.values())))
    assert np.abs(weights - plain).max() < 0.02
    gain = 0
    for d, t in docs.items():
        r, ts = model_rows[d], tokens(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[d] == 2, len(ts), sum(words[w] > 0 for w in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ts), rel=1e-12)
        want = 0
        for u, w in pairs(ts):
            l2, l1, l0 = weights[words[u].bit_length()]
            want += math.log10(l2 * (both[u, w] / words[u] if words[u] else 0) + l1 * words[w] / n + l0 / (v + 1))
        assert r.score == pytest.approx(want, rel=1e-9)
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0  # held-out documents are likelier than under the base


def test_probabilities_sum_to_one_at_most(spark):
    rows = [(i, f"a b c d{i % 3}") for i in range(30)]
    model = DeletedInterpolation(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(0) + F.col("doc_id") % 2)
    assert model.weights.shape == (BUCKETS, 3) and np.allclose(model.weights.sum(axis=1), 1) and (model.weights[:, 2] > 0).all()
    assert (model.tokens, model.types) == (150, 7)


def test_odd_tables(spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = [(None, None, 0), (1, "", 0), (1, "", 0), (2, " \n", 1), (3, long, 2), (3, long, 2), (4, "A a b", 0), (5, "x" * 500_000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk int")
    out = DeletedInterpolation(df, F.col("chunk")).documents.collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 200_001), (3, 200_001), (4, 3), (5, 2)]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)
    assert DeletedInterpolation(df.limit(0), F.col("chunk")).documents.count() == 0
