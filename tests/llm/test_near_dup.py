import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orrery.llm.components import connected
from orrery.llm.near_dup import NearDuplicates, drop_near_duplicates, parities
from orrery.llm.probminhash import band_hashes, shingles, signatures, similarities, similarity
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def flatten(texts):
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def bag(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(ws[i:i + 5]) for i in range(max(len(ws) - 4, 1))) if ws else Counter()


def brute_classes(texts, threshold=0.8):
    """class_id of every document, by comparing all texts that share a shingle."""
    bags = {d: bag(t) for d, t in texts.items()}
    node = {}
    for d in sorted(texts):
        ws = tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[d] or "")))
        node.setdefault(ws or (d,), []).append(d)
    first = [v[0] for v in node.values()]
    by = defaultdict(list)
    for d in first:
        for s in bags[d]:
            by[s].append(d)
    links = set()
    for d in first:
        common = Counter(e for s in bags[d] for e in by[s] if e > d)
        for e, n in common.items():
            weighted = max(*bags[d].values(), *bags[e].values()) > 1
            jaccard = n / (len(bags[d]) + len(bags[e]) - n)
            if jaccard >= threshold or weighted and jaccard > 0.2 and similarity(bags[d], bags[e])[1] >= threshold:
                links.add((d, e))
    parent = {d: d for d in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {d: find(v[0]) for v in node.values() for d in v}


def test_shingles():
    texts = ["", "A b", "a B", "a b c d e", "a b c d e f a b c d e", "x"]
    owner, ids, weight, keys = shingles(*flatten(texts))
    per = [dict(zip(ids[owner == i].tolist(), weight[owner == i].tolist())) for i in range(len(texts))]
    assert [sorted(p.values()) for p in per] == [sorted(bag(t).values()) for t in texts]
    assert per[1] == per[2] and (keys[:, 1] == keys[:, 2]).all() and (keys[:, 3] != keys[:, 4]).all()


def test_components_agree_with_the_probability_jaccard_similarity():
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 1 << 43, 60).astype(np.uint64)
    x, y = {int(i): int(rng.integers(1, 6)) for i in ids[:45]}, {int(i): int(rng.integers(1, 6)) for i in ids[10:]}
    side = lambda s: (np.zeros(len(s), np.int64), np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)]))
    sigs = [signatures(1, *side(s), 6000)[0] for s in (x, y)]
    jaccard, jp = similarity(x, y)
    assert (sigs[0] == sigs[1]).mean() == pytest.approx(jp, abs=0.03)
    assert similarities(1, side(x), side(y))[0].tolist() == pytest.approx([jaccard, jp])
    assert (band_hashes(np.stack(sigs), 100) != 0).all()


def test_connected(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(500, 500)]
    edges += [(int(a), int(b)) for a, b in rng.integers(200, 300, (60, 2))]
    got = dict(tuple(r) for r in connected(spark.createDataFrame(edges, "u long, v long")).collect())
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in QUERIES["op5_near_dup"](spark, SF).collect()}
    assert got == brute_classes(texts)
    assert len(set(got.values())) < len(texts)


def test_hot_groups_and_chains(spark):
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(10**9)}"
    base = [word() for _ in range(120)]
    texts, at = {}, 0
    for k in range(60):  # near copies of one text, some of them further apart than the threshold
        ws = list(base)
        for i in rng.choice(120, k % 8, replace=False):
            ws[i] = word()
        texts[at] = " ".join(ws)
        at += 1
    for _ in range(60):
        texts[at] = " ".join(base)
        at += 1
    ws = [word() for _ in range(200)]
    for _ in range(25):  # a chain: neighbours are alike, its ends are not
        ws = ws[6:] + [word() for _ in range(6)]
        texts[at] = " ".join(ws)
        at += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in NearDuplicates(df).documents().collect()}
    assert got == brute_classes(texts)


def test_repeated_passages(spark):
    rng = np.random.default_rng(9)
    word = lambda: f"w{rng.integers(10**9)}"
    texts = {}
    for k in range(12):  # copies in which a passage comes five times, or the beginning four times
        ws = [word() for _ in range(200)]
        at = int(rng.integers(0, 160))
        texts[3 * k] = " ".join(ws)
        texts[3 * k + 1] = " ".join(ws[:at] + ws[at:at + 40] * 5 + ws[at + 40:])
        texts[3 * k + 2] = " ".join(ws[:30] * 4 + ws[30:])
    similar = similarity(bag(texts[0]), bag(texts[1]))
    assert similar[0] > 0.95 and similar[1] < 0.7
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in NearDuplicates(df).documents().collect()}
    assert got == brute_classes(texts) == {d: d - d % 3 for d in texts}


def test_parities_bound_the_shingles_of_one_text_alone():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 1 << 44, n).astype(np.uint64)) for n in (0, 3, 40, 300, 5000)]
    sets += [np.union1d(sets[3][20:], sets[2]), sets[4][:-7]]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    odd = parities(len(sets), owner, np.concatenate(sets))
    apart = np.array([[np.bitwise_count(x ^ y).sum() for x in odd] for y in odd])
    alone = np.array([[len(np.setxor1d(x, y)) for x in sets] for y in sets])
    assert (apart <= alone).all() and apart[4, 6] == 7 and apart[3, 5] > 55


def test_large_groups_a_little_too_far_apart_are_not_verified_pair_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(12)
    word = lambda: f"w{rng.integers(10**9)}"
    base, texts = [word() for _ in range(400)], {}
    for k in range(80):  # two of these differ in up to twelve words: a similarity of 0.74 and more
        ws = list(base)
        for i in rng.choice(79, 6, replace=False):
            ws[5 * i + 2] = word()
        texts[k] = " ".join(ws)
    verified, plain = [], NearDuplicates._exactly
    monkeypatch.setattr(NearDuplicates, "_exactly", lambda self, pairs: verified.append(pairs.count()) or plain(self, pairs))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in NearDuplicates(df).documents().collect()}
    assert got == brute_classes(texts) and len(set(got.values())) > 40
    assert sum(verified) < 400


def test_odd_tables(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "", "k"), (2, None, "k"), (2, None, "k"), (3, " \n", "k"), (4, "one two", "k"), (5, "One  two", None), (6, "one three", None),
            (None, "lone text", None), (8, long, None), (8, long, None), (9, long + " end", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in NearDuplicates(df).documents().collect())
    assert got == [(0, 0), (1, 1), (2, 2), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (8, 8), (8, 8), (9, 8)]
    kept = drop_near_duplicates(df).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 2, 3, 4, 6, 8] and kept[0].asDict().keys() == {"doc_id", "text", "node"}
    assert drop_near_duplicates(df.limit(0)).count() == 0


def test_steps_leave_no_shuffle_files(spark):
    from glob import glob
    from time import sleep

    from orrery.llm.tables import _CLEANUP, written

    def ids():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f.split("/")[-1] for d in local for f in glob(f"{d}/*/shuffle_*.data")}

    before, setting = ids(), spark.conf.get(_CLEANUP)
    written(spark.range(100_000).selectExpr("id % 1000 AS k", "id").groupBy("k").sum("id"), "sums")
    for _ in range(50):
        if ids() <= before:
            break
        sleep(0.1)
    assert ids() <= before and spark.conf.get(_CLEANUP) == setting


def test_texts_that_lose_no_document_do_not_move(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(40))) for i in range(20)] + [(30, text), (31, text), (32, text.upper()), (30, text), (None, text)]
    rows += [(40, None), (41, ""), (41, " "), (41, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = drop_near_duplicates(df).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, rows[:20] + [(30, text)] + rows[25:]))
