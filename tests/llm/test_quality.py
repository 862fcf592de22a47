import re
from collections import Counter

import numpy as np
import pytest

from orrery.llm.kneser_ney import BITS, FOLD, ORDER, KneserNey, ngrams
from orrery.llm.kneser_ney import symbols, train
from orrery.llm.quality import bands, judged, measured, text_measures
from orrery.llm.queries import QUERIES
from orrery.llm.textbytes import hashes, lines, words

SF = "/root/testdata/sf0.01"
ODD = ["", " ", "\n", "a\n", "\n\na\n\na", "a b c a b c", "x x x x", "é\xa0b ñ", "a\r\na\r\n", "\x0b\x0c", "日本 語\n日本 語", "w" * 1000 + " " + "w" * 1000]


def flatten(texts):
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def brute(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    return len(ws), sum(map(len, ws)), sum(map(text.count, "#*$%&|<>")), dup, len(covered)


def test_words_and_lines():
    raw, off = flatten(ODD)
    w, ln = words(raw, off), lines(raw, off)
    for i, t in enumerate(ODD):
        b = raw.tobytes()
        assert [b[w.start[k]:w.end[k]].decode() for k in range(w.first[i], w.first[i + 1])] == re.findall(r"[^\x20\x09-\x0D]+", t)
        assert [b[ln.start[k]:ln.end[k]].decode() for k in range(ln.first[i], ln.first[i + 1])] == t.split("\n")


def test_hashes_tell_ranges_apart():
    raw, off = flatten(["a" * n for n in range(100)] + ["a" * n for n in range(100)])
    h = hashes(raw, off[:-1], off[1:])
    assert (h[:100] == h[100:]).all() and len(set(h.tolist())) == 100


def test_measures_against_brute_force(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    got = text_measures(*flatten(texts))
    assert list(zip(*(v.tolist() for v in got.values()))) == [brute(t) for t in texts]


def test_model_against_a_plain_kneser_ney():
    raw, off = flatten(["the cat sat on the mat", "a cat", "the dog sat on a log the end" * 3])
    grams, n = np.unique(ngrams(raw, off), return_counts=True)
    model = KneserNey.of_counts(grams, n)
    top = {int(k): int(c) for k, c in zip(grams, n)}
    levels = {ORDER: top}
    for o in range(ORDER - 1, 0, -1):
        levels[o] = Counter(k & ((1 << BITS * o) - 1) for k in levels[o + 1])

    def discount(o, c):
        s = [max(sum(v == k for v in levels[o].values()), 1) for k in (1, 2, 3, 4)]
        k = min(c, 3)
        return min(max(k - (k + 1) * s[0] / (s[0] + 2 * s[1]) * s[k] / s[k - 1], 0.1), 0.9 * k)

    def p(o, key):
        if not o:
            return 2.0 ** -BITS
        own = [(k, c) for k, c in levels[o].items() if k >> BITS == key >> BITS]
        lower = p(o - 1, key & ((1 << BITS * (o - 1)) - 1))
        total = sum(c for _, c in own)
        if not total:
            return lower
        c = levels[o].get(key, 0)
        return (c - (discount(o, c) if c else 0)) / total + sum(discount(o, c) for _, c in own) / total * lower

    other = ngrams(*flatten(["the cog sat zzz!", "9"]))
    for key, got in zip(np.concatenate([grams, other]).tolist(), model.log2_probability(np.concatenate([grams, other])).tolist()):
        assert got == pytest.approx(np.log2(p(ORDER, key)))
    whole = model.log2_probability(((int(grams[0]) >> BITS) << BITS) + np.arange(1 << BITS, dtype=np.int32))
    assert (2 ** whole).sum() == pytest.approx(1)
    assert FOLD.max() < 1 << BITS


def test_every_character_is_a_symbol_of_its_own():
    texts = [*ODD, "é è E D ß 0 1 \n\t", "", "a😀b\U0010ffff", "\uffff\ue000"]
    units, at = symbols(*flatten(texts))
    for i, t in enumerate(texts):
        assert units[at[i]:at[i + 1]].astype("<u2").tobytes().decode("utf-16-le") == t
    every = [chr(c) for c in range(1, 0x2FFF)]
    assert len(set(ngrams(*flatten(every)).tolist())) == len(every)


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    rows = QUERIES["op4_quality"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = brute(docs[r.doc_id].text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    passed = [r for r in rows if not r.base_failed]
    assert all(r.kept for r in passed if r.doc_id in good)
    assert sum(not r.kept for r in passed) > 0


def test_odd_tables(spark):
    prose = "some plain words of a text that goes on for a while and says nothing at all to anyone who reads it now "
    rows = [(i, "en", prose + " ".join(f"w{i}x{k}" for k in range(60)), "x") for i in range(30)] * 2
    rows += [(None, None, None, None), (None, None, "", None), (7, None, "".join(f"%{k}|#" for k in range(60)), None), (8, "en", "long " * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, kept string")
    scored = measured(df, train(df)).cache()
    out = judged(scored, bands(scored)).collect()
    assert len(out) == len(rows) and all(r.kept == (not r.base_failed) for r in out if r.lang is None or r.doc_id != 8)
    empty = df.limit(0)
    scored = measured(empty, train(empty))
    assert judged(scored, bands(scored)).count() == 0
