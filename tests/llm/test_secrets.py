import hashlib
import re

import numpy as np
import pytest

from orrery.llm import scanner_training
from orrery.llm.char_cnn import CharCNN, codes, train, window
from orrery.llm.queries import QUERIES
from orrery.llm.secrets import base_spans, candidates, redacted, scan_secrets, spans_of_all, train_scanner

SF = "/root/testdata/sf0.01"


def brute(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


@pytest.mark.parametrize("text", [
    "", "token=abc token=abcdef", "secret=token=abcdef", "token=token:abcdef", "Api_Key: 'abcdef' é PASSWD=\"x.y-z=/+_\"",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "f" * 24 + " " + "0" * 23 + "A" + "abc" * 9, "ſecret=abcdef toKen=abcdef", "é" * 50 + "deadbeef" * 4])
def test_base_spans(text):
    assert [f"{k}:{s}:{e}" for s, e, k in base_spans(text)] == brute(text)


def test_gradients():
    rng = np.random.default_rng(1)
    model = CharCNN.new(rng)
    x = codes([window("some text token=abcdef0123456789 and more", 10, 32), window("x" * 100, 30, 90)])
    y, w = np.array([1.0, 0.0]), np.ones(2)
    grads = model.gradients(x, y, w)

    def loss():
        z = model.logits(x)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    for value, grad in zip((model.embed, model.conv, model.conv_bias, model.dense), grads):
        i = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        old, eps = value[i], 1e-6
        value[i] = old + eps
        up = loss()
        value[i] = old - eps
        down = loss()
        value[i] = old
        assert (up - down) / (2 * eps) == pytest.approx(grad[i], rel=1e-3)


def test_held_out_accuracy():
    rng = np.random.default_rng(3)
    chars = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))

    def some(n):
        out, labels = [], []
        for i in range(n):
            secret = bool(i % 2)
            body = "".join(rng.choice(chars, 32)) if secret else "-".join("".join(rng.choice(chars[:26], 5)) for _ in range(4)) + "-2024"
            text = ("key is " if rng.random() < 0.5 else "see page ") + body + " ok"
            at = text.index(body)
            out.append(window(text, at, at + len(body)))
            labels.append(secret)
        return out, np.array(labels)

    model = train(*some(600))
    test, labels = some(400)
    found = model.probability(codes(test)) >= model.threshold
    assert found[labels].mean() >= 0.9 and found[~labels].mean() <= 0.02


def test_candidates():
    text = 'plain words, Capital. WORD. "a": hidden = \'secretive\' x12345 camelCase well-known 2024-01-02!! http://a.b/c_d abcdefghijklmnopqrstuvw ##### zz=='
    found = [text[s:e] for s, e in candidates(text, [])]
    assert found == ["hidden", "secretive", "x12345", "camelCase", "well-known", "2024-01-02", "//a.b/c_d".lstrip("/"), "abcdefghijklmnopqrstuvw"]
    rest = "0123456789abcdef01234567XYZ" + "q9W" * 8
    assert [rest[s:e] for s, e in candidates(rest, base_spans(rest))] == ["XYZ" + "q9W" * 8]


#: Shapes that neither the patterns nor the planted findings of the training have.
SHAPES = {
    "ghp": lambda some: f"see ghp_{some(36)} there",
    "pwd": lambda some: f"the pwd: {some(10)} ok",
    "three parts": lambda some: f"use glpat-{some(20)} now",
    "marked": lambda some: f"passphrase='{some(7)}!{some(4)}'",
    "padded": lambda some: f"and {some(43)}= so",
    "rest of a run": lambda some: f"0123456789abcdef01234567Z{some(24)}",
}


@pytest.fixture(scope="module")
def scanner(spark):
    return train_scanner(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("shape", SHAPES)
def test_recall_by_held_out_shape(scanner, shape):
    rng = np.random.default_rng(6)
    chars = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    texts = [f"Is and retitioning the of. {SHAPES[shape](lambda n: ''.join(rng.choice(chars, n)))} Ndble by for 12.5.2020." for _ in range(200)]
    found = [any(k == "net" and 27 <= s and e <= len(t) - 22 for s, e, k in x) for t, x in zip(texts, spans_of_all(texts, scanner))]
    assert np.mean(found) >= 0.9


def test_precision_on_usual_text(scanner):
    rng = np.random.default_rng(8)
    n = lambda k: "".join(rng.choice(list("0123456789"), k))
    texts = [f"On {n(4)}-0{n(1)[0]}-1{n(1)} call 555-{n(4)} or mail some.{n(2)}@mail{n(1)}.example.com, see https://www.example.org/some/page-{n(3)}.html, "
             f"version {n(1)}.{n(2)}.{n(1)}, order {n(12)}, getUserName{n(1)}, max_line_length, password: required" for _ in range(200)]
    wrong = sum(k == "net" for x in spans_of_all(texts, scanner) for _, _, k in x)
    assert wrong <= 0.02 * sum(len(candidates(t, [])) for t in texts)


def test_secrets_of_unknown_shape_among_the_corpus(spark):
    """Secrets that the patterns miss stand unlabelled in the training table and are found all the same."""
    rng = np.random.default_rng(9)
    chars = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    some = lambda k: "".join(rng.choice(chars, k))
    rows = [(i, f"Word and 12.{i} words, " + (f"ghp_{some(36)}" if i % 7 == 0 else f"pwd: {some(10)}" if i % 7 == 1 else f"token = {some(20)}" if i % 7 == 2 else f"item-{i}"))
            for i in range(700)]
    got = {r.doc_id: [x.kind for x in r.secrets] for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = lambda m: np.mean(["net" in got[i] for i in got if i % 7 == m])
    assert hit(0) >= 0.9 and hit(1) >= 0.9
    assert np.mean(["net" in got[i] for i in got if i % 7 > 2]) <= 0.01


def test_training_takes_every_finding(spark, monkeypatch):
    """All distinct findings are learned from, in groups, and the network does not depend on how the rows are dealt."""
    rows = [(i, f"a w{i}x and token=abcdef{i}") for i in range(2500)]
    tables, write = {}, scanner_training.written
    monkeypatch.setattr(scanner_training, "GROUP", 1000)
    monkeypatch.setattr(scanner_training, "written", lambda df, name: tables.setdefault(name, []).append(out := write(df, name)) or out)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [docs.repartition(n).select("text") for n in (1, 5)]
    found = [scanner_training.train_on(f.selectExpr("lpad(text, 80, ' ') AS window", "text LIKE '%7' AS secret"), 0.98, 0.002, 1) for f in found]
    for groups in tables["groups"]:
        held = groups.collect()
        assert len(held) > 1 and sum(len(r.secret) for r in held) == 2500 + 4096 * len(held) and sum(sum(r.corpus) for r in held) == 2250
    assert (found[0].conv == found[1].conv).all() and found[0].threshold == found[1].threshold


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_secrets"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("net")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))


def test_odd_tables(spark):
    long = "word " * 200_000 + "token=abcdef0123456789abcdef"
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, long, None), (2, long, None)], "doc_id long, text string, secrets string")
    rows = scan_secrets(df).collect()
    assert sorted(len(r.secrets) for r in rows) == [0, 0, 1, 1]
    assert scan_secrets(df.limit(0)).count() == 0
    assert train_scanner(df.limit(0)) is None
    cut = [r.t for r in df.select(redacted(df.text, None).alias("t")).collect()]
    assert cut == [None, "", "word " * 200_000 + "[SECRET]", "word " * 200_000 + "[SECRET]"]
