"""Piece codec, word token counts and packing against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd import ODD, documents, local, table
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from prodseq.llm.merging import PairTable, merge
from prodseq.llm.packing import byte_encoder, combinations, fit, make_plan, pack, token_ids
from prodseq.llm.pieces import PieceCodec, encode_and_decode
from prodseq.llm.token_counts import WordMerger, count_tokens

PIECES, WORDS, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"))


def strange_texts():
    random.seed(4)
    parts = list("aabcde  ▁\n\t'sSΣσß½²①٣ँé日本語😀\x00\x1c\x85\xa0ǅ_<|>") + ["<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<0x0A>", "'ll", "'S", " the", "ing", "  ", "İ"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(800)]
    codes = [*range(1, 0x3100, 7), *range(0xFE00, 0x10000, 7)]
    return [*texts, *(f"a{chr(c)}b {chr(c)}1" for c in codes), "a" * 3000, " " * 70, "abcab" * 900, "日" * 500, "", " ", "▁", "\n"]


def one_by_one(symbols, table):
    symbols = list(symbols)
    while len(symbols) > 1:
        ranks, products = table.look_up(np.array(symbols[:-1]), np.array(symbols[1:]))
        at = int(ranks.argmin())
        if products[at] < 0:
            break
        symbols[at : at + 2] = [int(products[at])]
    return symbols


def test_merge_equals_merging_one_pair_at_a_time():
    random.seed(1)
    for _ in range(40):
        # products may follow pairs of any rank, so that occurrences depend on each other
        pairs = {(random.randrange(6), random.randrange(6)) for _ in range(8)}
        rows = [(a, b, r, 4 + r) for r, (a, b) in enumerate(pairs)]
        left, right, rank, product = np.array(rows).T
        table = PairTable.build(left, right, rank, product, 16)
        words = [[random.randrange(4) for _ in range(random.randint(0, 12))] for _ in range(30)]
        flat, lengths = merge(np.array([s for w in words for s in w], np.int32), np.array([len(w) for w in words]), table)
        ends = np.cumsum(lengths)
        assert [flat[e - n : e].tolist() for e, n in zip(ends, lengths)] == [one_by_one(w, table) for w in words]


def test_pieces_equal_library():
    codec, library = PieceCodec(PIECES), SentencePieceProcessor(model_file=PIECES)
    texts = strange_texts()
    expected = library.encode(texts)
    found = [np.frombuffer(b"".join(w[0] for w in words), "<i4").tolist() for words in codec.encode(texts)]
    assert found == expected
    with_end = [[*x, codec.end] for x in expected]
    decoded = codec.decode(np.concatenate([np.array(x) for x in with_end]), np.array([len(x) for x in with_end]))
    assert [d.decode() for d in decoded] == library.decode(with_end)


def test_piece_rows(spark):
    library = SentencePieceProcessor(model_file=PIECES)
    rows = encode_and_decode(documents(spark), PIECES, keep_ids=True).collect()
    assert len(rows) == len(ODD)
    for row, (doc_id, text, _) in zip(rows, ODD, strict=True):
        ids = [*library.encode(text or ""), 2]
        assert (row.doc_id, row.n_tokens, row.ids) == (doc_id, len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded == library.decode(ids) and row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()


def test_word_counts_equal_library(spark):
    library = Tokenizer.from_file(WORDS)
    texts = strange_texts()
    assert WordMerger(WORDS).counts(texts) == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    rows = count_tokens(documents(spark), WORDS, limit=10).collect()
    for row, (doc_id, text, _) in zip(rows, ODD, strict=True):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(row) == (doc_id, len((text or "").encode()), n, n > 10)


def test_byte_ids_equal_library():
    library, (encoder, _) = Tokenizer.from_file(BYTES), byte_encoder(BYTES)
    for text in strange_texts():
        assert encoder.encode(text, allowed_special="all") == library.encode(text, add_special_tokens=False).ids


def test_fit_meets_an_exact_histogram():
    histogram = np.zeros(64, np.int64)
    histogram[[20, 44, 10, 30, 24]] = [50, 50, 40, 40, 40]
    combos = combinations(histogram, 64)
    assert (combos.sum(axis=1) == 64).all()
    used = np.bincount(combos.ravel(), weights=np.repeat(fit(combos, histogram), 3), minlength=64)
    assert np.allclose(used[1:], histogram[1:], atol=1)
    plan = make_plan(histogram, 64)
    assert plan.total == -(-int((histogram * np.arange(64)).sum()) // 64)


@pytest.mark.parametrize("held", [[0, 1, 2, 30, 31, 32, 33, 62, 63], list(range(64)), [0, 5], [21, 22]])
def test_all_shallow_combinations_are_tried(held):
    histogram = np.zeros(64, np.int64)
    histogram[held] = 3
    some = [x for x in held if x]
    want = {tuple(sorted((0, a, 64 - a))) for a in some if 64 - a in some} | {tuple(sorted((a, b, 64 - a - b))) for a in some for b in some if 64 - a - b in some}
    found = combinations(histogram, 64)
    assert {tuple(r) for r in found.tolist()} == want and len(found) == len(want)


def test_most_rests_are_placed_by_the_fit():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    histogram = np.bincount([(len(token_ids(t or "", BYTES)) + 1) % 2048 for t in texts], minlength=2048)
    assert make_plan(histogram, 2048).used[1:].sum() > 0.6 * histogram[1:].sum()


def test_long_runs_of_one_character_equal_library():
    library = Tokenizer.from_file(BYTES)
    for text in (" " * 2_000_000, "\t" * 2_000_000, "\n" * 2_000_000, "x" + " " * 150_000 + "y<|endoftext|>", "a" * 300_000, "!" * 300_000):
        assert token_ids(text, BYTES) == library.encode(text, add_special_tokens=False).ids


def test_blanks_are_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "plain"), (3, "\n" * 1_000_000)], "doc_id long, text string")
    pieces = local(pack(docs, BYTES))
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {1: 1_000_001, 2: 2, 3: 500_001}
    assert pieces["sequence_id"].nunique() == -(-1_500_004 // 2048)


@pytest.mark.parametrize("source", ["odd", "table", "hot"])
def test_packing_is_whole_and_gapless(spark, source):
    docs = {
        "odd": lambda: documents(spark),
        "table": lambda: table(spark, "documents"),
        "hot": lambda: spark.range(500).selectExpr("id AS doc_id", "IF(id % 3 = 0, concat('x ', id), 'same words in each of them') AS text"),
    }[source]()
    window = 2048 if source == "table" else 64
    library = Tokenizer.from_file(BYTES)
    pieces = local(pack(docs, BYTES, window=window))
    whole = {}
    for row in docs.select("doc_id", "text").collect():
        whole.setdefault(-1 if row.doc_id is None else row.doc_id, []).append([*library.encode(row.text or "", add_special_tokens=False).ids, 1])
    total = sum(len(x) for group in whole.values() for x in group)
    assert pieces["length"].sum() == total
    for doc_id, group in whole.items():
        mine = pieces[pieces["doc_id"].isna()] if doc_id == -1 else pieces[pieces["doc_id"] == doc_id]
        expected = sorted((s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for ids in group if len(group) == 1 for s, n in zip(mine["start"], mine["length"]))
        if len(group) == 1:
            assert sorted(zip(mine["start"], mine["length"], mine["ids_crc32"])) == expected
            ordered = mine.sort_values("start")
            assert (ordered["start"] + ordered["length"]).tolist()[:-1] == ordered["start"].tolist()[1:]
        assert sorted(set(mine["doc_tokens"])) == sorted({len(ids) for ids in group})
    short = 0
    for _, sequence in pieces.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        ends = (sequence["offset"] + sequence["length"]).tolist()
        assert sequence["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= window
        short += ends[-1] < window
    assert short <= 1 and pieces["sequence_id"].nunique() == -(-total // window)


def test_empty_tables(spark):
    empty = documents(spark).limit(0)
    for frame in (encode_and_decode(empty, PIECES), count_tokens(empty, WORDS), pack(empty, BYTES)):
        assert frame.count() == 0
