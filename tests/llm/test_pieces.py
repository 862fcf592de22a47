from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from orrery.llm import pieces
from orrery.llm.pieces import Pieces, decode, encode_sampled, sampled
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return Pieces(PATH, 0.5)


def flatten(texts):
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def encoded(model, texts, keys=None):
    ids, place = sampled(model, *flatten(texts), np.arange(len(texts), dtype=np.int64) if keys is None else keys)
    return [ids[a:b].tolist() for a, b in zip(place[:-1], place[1:])]


def all_paths(model, sp, text):
    """Every segmentation and its probability."""
    ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if model.weight[i] > 0}
    text = "▁" + text.replace(" ", "▁")

    def go(at):
        if at == len(text):
            return [((), 1.0)]
        return [((ids[p], *rest), model.weight[ids[p]] * w) for n in range(1, 17) if at + n <= len(text) and (p := text[at:at + n]) in ids for rest, w in go(at + n)]

    paths = dict(go(0))
    total = sum(paths.values())
    return {k: v / total for k, v in paths.items()}


@pytest.mark.parametrize("text", ["tea", "  a the", "été"])
@pytest.mark.parametrize("long", [64, 0])
def test_draws_follow_the_path_probabilities(model, monkeypatch, text, long):
    monkeypatch.setattr(pieces, "LONG", long)
    want = all_paths(model, sentencepiece.SentencePieceProcessor(model_file=PATH), text)
    n = 40_000
    got = Counter(map(tuple, encoded(model, [text] * n)))
    assert set(got) <= set(want)
    for path, p in want.items():
        assert got[path] / n == pytest.approx(p, abs=4 * (p * (1 - p) / n) ** 0.5 + 1e-4)


def test_reproducible_and_varied(model):
    texts = ["some words to cut in pieces", "others", "some words to cut in pieces"]
    one = encoded(model, texts, np.array([5, 6, 7]))
    assert encoded(model, texts[::-1], np.array([7, 6, 5])) == one[::-1]
    assert one[0] != one[2]


ODD = ["", " ", "   ", "a", "▁", "a▁ ▁b", "tab\there\nline\r\n", "日本語 テキスト", "👍🏽 ok", " lead and trail ", "\x00\x7f", "x" * 5000, "日" * 3000, " " * 300, "ab " * 5000, "­​"]


def test_odd_texts_round_trip(spark, model):
    texts = [*ODD, None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, ids string")
    out = df.withColumn("p", encode_sampled(F.col("text"), F.col("doc_id"), PATH)).withColumn("back", decode(F.col("p.ids"), PATH)).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    by = {}
    for r in out:
        ids = np.frombuffer(bytes(r.p.ids), "<u4").tolist()
        assert r.back == (r.text or "") and len(ids) == r.p.n_pieces and by.setdefault(r.doc_id, ids) == ids
        if r.text and "▁" not in r.text:
            assert sp.decode(ids) == r.text
    empty = df.limit(0)
    assert empty.withColumn("p", encode_sampled(F.col("text"), F.col("doc_id"), PATH)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op8_pieces"](spark, SF).collect()
    assert len(rows) == docs.count() and all(r.lossless for r in rows)
    again = {r.doc_id: (r.n_pieces, r.ids_crc32) for r in QUERIES["op8_pieces"](spark, SF).collect()}
    assert again == {r.doc_id: (r.n_pieces, r.ids_crc32) for r in rows}
