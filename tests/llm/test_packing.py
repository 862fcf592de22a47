import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orrery.llm.packing import _encoder, best_fit, pack_best_fit, pack_documents
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_against_a_linear_search(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    sequence, offset, room = best_fit(lengths, 50)
    free = []
    for n, s, o in zip(lengths, sequence, offset):
        fits = [f for f in free if f >= n]
        assert (free[s] == min(fits)) if fits else s == len(free)
        if s == len(free):
            free.append(50)
        assert o == 50 - free[s]
        free[s] -= n
    assert free == room.tolist()


def test_ids_of_words_are_the_ids_of_the_text():
    whole = Tokenizer.from_file(PATH)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ["It's the O'Neill's... don't|stop, (ok) a.b,c", "Éá é. İstanbul İ. ΣΑΣ ΣΑΣ. K. ǅ! ª. Ⅷ. x́!", "<|endoftext|> a<|startoftext|>. b",
             "1,234.5% 10kg ß. ﬁ. 漢字。漢字. हिन्दी. हि, 👍🏽! a‍b. ﻿x.", "".join(f"a{c}b." for c in spaces), "", "  x  ", "A.B. THE!! the%%% WORD###,"]
    rng = np.random.default_rng(0)
    alphabet = list("aZé.,!' \n|#1́İßΣ​ͅ") + spaces
    texts += ["".join(rng.choice(alphabet, 40)) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(_encoder(PATH).text_ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def check_places(rows, capacity=4096):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query_against_the_tokenizer(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_packing"](spark, SF).collect()
    whole, want = Tokenizer.from_file(PATH), []
    for d, t in texts.items():
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want += [(d, k, k * 4096, len(x), zlib.crc32(x.tobytes())) for k in range(-(-len(ids) // 4096)) for x in [ids[k * 4096:(k + 1) * 4096]]]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert check_places(rows) <= -(-sum(w[3] for w in want) // 4096) * 1.02 + 1


@pytest.mark.parametrize("group_rows", [100, 10_000])
def test_groups_and_hot_lengths(spark, group_rows):
    df = spark.range(900).selectExpr("if(id < 300, 7, id) key", "if(id < 300, 2000, 1 + id * 7 % 1500) length", "'x' sequence_id", "id keep")
    rows = pack_best_fit(df, 4096, group_rows).collect()
    assert sorted(r.keep for r in rows) == list(range(900))
    least = -(-sum(r.length for r in rows) // 4096)
    assert check_places(rows) <= (1.02 * least + 1 if group_rows > 900 else 1.1 * least)


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "word " * 20_000)], "doc_id long, text string")
    rows = pack_documents(df, PATH).collect()
    assert sorted(r.length for r in rows)[:3] == [1, 1, 1] and sum(r.length for r in rows) == 20_004
    assert check_places(rows) == 5
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_words_take_the_short_way(monkeypatch):
    """Words of ASCII or of Latin letters go to the model's merges at once, with the ids of the whole tokenizer."""
    from orrery.llm.packing import _Words
    words = _Words(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(4)
    marks, letters = [chr(i) for i in range(33, 127)], [chr(i) for i in range(0xC0, 0x250)]
    some = ["don't", "DON'T", "'S", "it's.", "</w>", "Straße", "Œuvre", "naïve", "x2", "£"]
    some += ["".join(rng.choice(marks, rng.integers(1, 9))) for _ in range(2000)] + ["".join(rng.choice(letters + ["a", "B"], rng.integers(1, 6))) for _ in range(2000)]
    odd = ["<|endoftext|>", "a<|EndOfText|>b", "İz", "é", "ΣΑΣ", "日本"]
    want = {w: words.encode(w) for w in some + odd}
    asked = []
    monkeypatch.setattr(words, "encode", lambda text: asked.append(text) or want[text])
    assert {w: words[w] for w in some + odd} == want
    assert not {"don't", "Straße", "naïve", "x2"} & set(asked) and {"<|endoftext|>", "a<|EndOfText|>b", "İz"} <= set(asked)
