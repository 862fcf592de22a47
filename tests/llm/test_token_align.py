import hashlib
from collections import Counter

import public_tokenizers
import pytest

from orrery.llm.queries import QUERIES
from orrery.llm.token_align import TokenAlignment, align

SF = "/root/testdata/sf0.01"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """Whole texts, decoded token by token with the libraries, aligned byte by byte."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders
    a, b, level = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), decoders.ByteLevel()
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in visible}
    byte.update({chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in visible)})
    found = []
    for i, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a.id_to_token(t)) for t in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(t) else p.replace("▁", " ").encode() for t, p in ((t, b.id_to_piece(t)) for t in ids_b)]
        whole = (" " + (text or "")).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole or not text:
            found.append((i, [], [], [], []))
            continue
        ends_a, ends_b, at = [], [], 0
        for t in bytes_a:
            ends_a.append(at := at + len(t))
        at = 0
        for t in bytes_b:
            ends_b.append(at := at + len(t))
        groups, links, ga, gb, x, y = [], [], [], [], 0, 0
        for e in range(1, len(whole) + 1):
            in_a, in_b = x < len(ends_a) and ends_a[x] == e, y < len(ends_b) and ends_b[y] == e
            if in_a:
                ga.append(ids_a[x])
            if in_b:
                gb.append(ids_b[y])
            if in_a and in_b:
                links.append((ids_a[x], ids_b[y]))
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
            x, y = x + in_a, y + in_b
        found.append((i, ids_a, ids_b, groups, links))
    counts = Counter(p for *_, links in found for p in links)
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted(((i, len(x), len(y), len(g), len(k), sum(counts[p] == top[p[1]] for p in k), sum(counts[p] for p in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, x, y, g, k in found), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_whole_texts(spark):
    df = QUERIES["op13_token_align"](spark, SF)
    assert df.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(df) == plain(rows)


ODD = [None, "", " ", "  ", "a", " lead", "trail ", "two  spaces", "tab\tand\nlines \n\n x", "don't 's 're I'll 'tis", "café naïve über ́x é × ÷",
       "▁ piece mark", "a ▁b", "<s> </s> <unk> <0x41> <|endoftext|> x<|endoftext|>y", "日本語 の 文", "\U0001f600 \U0001f469‍\U0001f4bb ok", " nbsp 　wide  sep",
       "1234567 12 3.14 -5", "\x00 nul \x1f \x7f del", "same same same", "aaaaaaaa" * 300, "! ? !? ... --- a-b_c d", "­ soft ­y", "x" * 5000 + " end"]


@pytest.mark.parametrize("chunk_bytes", [1, 200, 1 << 20])
def test_odd_texts_repeated_rows_and_clashing_names(spark, chunk_bytes):
    rows = [(n, t) for n, t in enumerate(ODD)] + [(19, ODD[19]), (None, "same thing"), (19, "same")]
    df = spark.createDataFrame([(i, t, 1, "p", 2) for i, t in rows], "doc_id long, text string, chunk int, pairs string, n_a int")
    assert result(TokenAlignment(df.repartition(3), A, B, chunk_bytes=chunk_bytes).documents()) == plain(rows)


def test_random_texts(spark):
    import random
    rng = random.Random(4)
    parts = [" ", " ", " ", "  ", "\n", "\t", "'", "s", "the", "Zug", "é", "ß", "9", "12", ".", ",", "-", "▁", "日", "<", ">", " ", "x́", "ing", "Ł"]
    rows = [(i, "".join(rng.choice(parts[:17] if i % 5 else parts) for _ in range(rng.randrange(1, 60)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(TokenAlignment(df, A, B, chunk_bytes=9000).documents()) == plain(rows)


def test_pairs_and_empty_table(spark):
    df = spark.createDataFrame([(1, "the cat the dog"), (2, "the")], "doc_id long, text string")
    found = TokenAlignment(df, A, B)
    assert sorted(r["count"] for r in found.pairs().collect()) == [1, 1, 3]
    empty = TokenAlignment(df.limit(0), A, B)
    assert empty.documents().columns == COLUMNS and empty.documents().count() == 0 and empty.pairs().count() == 0
    assert result(TokenAlignment(df.select("doc_id").selectExpr("doc_id", "cast(null as string) as text"), A, B).documents()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_align():
    assert align([1, 2, 3], [2, 5, 6], [7, 8, 9], [1, 2, 6]) == [([1], [7, 8]), ([2, 3], [9])]
    assert align([], [], [], []) == []
