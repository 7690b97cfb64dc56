"""Codecs, files and tokenizers: against the libraries, and exact round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surgecast.llm import piece_codec, queries, sharedfiles, token_files, warc, word_tokens

ODD = [
    "", " ", "  ", "a", " a  b ", "\n", "a\n\nb", "▁", "a▁▁b", "tab\tand\x00nul", "é 𝄞 ☃ ​", "<s> </s> <0x0A> <unk>", "x" * 5000, " " * 3000,
    "word " * 2000, "Ünïcödé ñandú straße", "ab\n cd \n", "\r\nwin\r\n", "日本語のテキスト", "1234567890 3.14159", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = queries.tokenizer_path(queries.PIECES)
    return piece_codec.codec(path), sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.mark.parametrize("text", ODD)
def test_pieces_of_odd_texts(pieces, text):
    own, lib = pieces
    ids = lib.encode(text)
    assert own.encode(text).tolist() == ids
    assert own.decode(np.array(ids, np.int64)) == lib.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n▁thein.,é'(²1_S")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_of_any_text(text):
    import sentencepiece

    path = queries.tokenizer_path(queries.PIECES)
    own, lib = piece_codec.codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    ids = lib.encode(text)
    assert own.encode(text).tolist() == ids
    assert own.decode(np.array(ids, np.int64)) == lib.decode(ids)


def test_piece_tables_with_clashing_columns(spark):
    path = queries.tokenizer_path(queries.PIECES)
    rows = [(1, None, "old"), (2, "", "old"), (3, "the cat", "old"), (3, "the cat", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = piece_codec.detokenize(piece_codec.tokenize(df, path), path)
    got = sorted((r.doc_id, r.ids, r.decoded) for r in out.collect())
    assert got[0] == (1, [2], "") and got[1] == (2, [2], "")
    assert got[2] == got[3] and got[3][2] == "the cat" and got[3][1][-1] == 2
    assert piece_codec.tokenize(df.limit(0), path).count() == 0 and piece_codec.detokenize(out.limit(0), path).count() == 0
    both = piece_codec.tokenize(df.withColumnRenamed("ids", "decoded"), path, decoded="decoded")
    assert sorted((r.doc_id, r.ids, r.decoded) for r in both.collect()) == got
    assert piece_codec.detokenize(out.withColumnRenamed("decoded", "other"), path).columns == ["doc_id", "text", "ids", "other", "decoded"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    x = np.array(ids, np.uint64)
    code, packed, escapes = token_files.pack(x)
    assert len(code) == packed + 2 * escapes and escapes == sum(i >> 60 > 0 for i in ids)
    assert token_files.unpack(code, packed, len(x)).tolist() == ids


def test_simple8b_packs_small_ids_densely():
    assert token_files.pack(np.ones(600, np.uint64))[1] == 10
    assert token_files.pack(np.full(40, 2**15 - 1, np.uint64))[1] == 10


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_BPE)
    tool = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = [*ODD, None, "It's <|endoftext|> THE end", *[" ".join(rng.choice(["the", "Thé", "ab c", "x9", "don't"]) for _ in range(rng.randrange(400))) for _ in range(40)]]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(6, "twice"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = token_files.write_tokens(df, path, sharedfiles.new_folder(spark, "test-tokens"), 2, file_ids=3000)
    got = {}
    for r in token_files.read_tokens(files).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tool.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(got[doc_id])
        assert own.pop(0) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        got[doc_id] = own
        start += len(ids)
    assert not any(got.values()) and files.count() > 3
    none = token_files.write_tokens(df.limit(0), path, sharedfiles.new_folder(spark, "test-tokens"), 2)
    assert token_files.read_tokens(none).count() == 0


def test_archives(spark):
    big, other = "<p>é</p>" * 200, "y" * 1000
    rows = [(1, "http://a\r\nX: y", big, 0), (2, None, big, 0), (9, "u", big, 0), (3, "u", other, 0), (4, "u", "small", 0), (5, "u", "small", 0), (6, "u", None, 0), (7, "u", "", 0), (8, "u", "z" * 600_000, 0), (9, "u", big, 0), (None, "u", other, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").drop("digest")
    index = warc.write_archives(df, sharedfiles.new_folder(spark, "test-warc"), file_bytes=300)
    got = sorted(((r.record_id, r.record_type, r.payload_bytes, r.refers_to) for r in warc.read_archives(index).collect()), key=str)
    u = lambda i: f"urn:page:{i}"
    n = len(big.encode())
    expected = [(u(1), "revisit", n, u(9)), (u(2), "revisit", n, u(9)), (u(9), "response", n, None), (u(9), "response", n, None), (u(3), "response", 1000, None), (u("null"), "revisit", 1000, u(3))]
    expected += [(u(i), "response", k, None) for i, k in ((4, 5), (5, 5), (6, 0), (7, 0), (8, 600_000))]
    assert got == sorted(expected, key=str)
    for r in index.collect():
        fields, body = warc.read_record(r.path, r.frame_at, r.frame_size, r.at)
        assert fields["WARC-Record-ID"] == f"<{r.record_id}>"
    assert warc.read_archives(warc.write_archives(df.limit(0), sharedfiles.new_folder(spark, "test-warc"))).count() == 0


def test_word_tokenizer_parts():
    """Parts in the table give the library's ids of the whole text."""
    tool = word_tokens.WordTokenizer(queries.tokenizer_path(queries.WORD_BPE))
    odd = ["<|startoftext|>", "<|EndOfText|>", "0", "10 20", "a0b 00", "İstanbul ΣΑΣ", "é ́x", "we're I'LL 'd", "''s \"'t", "\t\r\x0b", "٠١ ０²", "日本語", "😀🏽0", "a\x00b", "é0É", "Œuvre ß", "x" * 90 + "É", "A" * 300 + " 0", "", " ", "\n"]
    rng = np.random.default_rng(3)
    for _ in range(400):
        text = "".join(rng.choice(odd, rng.integers(0, 9)).tolist())
        assert tool(text).tolist() == tool.tool.encode(text, add_special_tokens=False).ids


def test_word_tokenizer_batches(monkeypatch):
    """Small segments, windows and tables, which start anew all the time, change nothing."""
    for name, value in (("SEGMENT", 50), ("UNITS", 20), ("ENTRIES", 200), ("SLOTS", 1024), ("STORED", 300)):
        monkeypatch.setattr(word_tokens, name, value)
    tool = word_tokens.WordTokenizer(queries.tokenizer_path(queries.WORD_BPE))
    rng = np.random.default_rng(4)
    odd = ["<|endoftext|>", "<|START", "10 20", "İstanbul ", "we're ", "é ́x", "\t", "a\x00b ", "a\x00", "x" * 30, "X" * 24 + " ", "y" * 25, "", " ", "\n", "The, ", "cat;dog ", "Ünï ", "ÀÖØÞß×÷àÿ", "É,", "é\u0301", "\u0301 ", "Ā", "ÅÅ5ç "]
    import pyarrow as pa

    for _ in range(60):
        texts = ["".join(rng.choice(odd, rng.integers(0, 12)).tolist()) for _ in range(rng.integers(0, 9))] + [None, ""]
        ids, at = tool.batch(pa.array(texts, pa.string()))
        for t, a, z in zip(texts, at[:-1], at[1:]):
            assert ids[a:z].tolist() == tool.tool.encode(t or "", add_special_tokens=False).ids
        assert at[-1] == len(ids) and at[0] == 0
