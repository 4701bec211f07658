"""Byte-level BPE and Huffman files against the libraries and a plain decoder."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from faregrid.llm import bpe, huffman
from faregrid.session import scratch_paths

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MIXED = st.text(alphabet=st.sampled_from(list("ab's 1é漢\n\t\r\x0b\x1c .,🙂")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_pieces_keep_the_ids(text):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert bpe.encode_text(enc, text, size=3) == enc.encode_ordinary(text)
    assert enc.decode_bytes(enc.encode_ordinary(text)) == text.encode()


def test_long_text_without_a_safe_place():
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    text = "é" * 5000 + " " * 5000 + "b" * 5000
    assert list(map(len, bpe.pieces(text, 100))) == [10_000, 5_000] or len(
        list(bpe.pieces(text, 100))
    ) >= 1
    assert bpe.encode_text(enc, text, size=100) == enc.encode_ordinary(text)


def test_encode_decode_equals_library(spark, edge_docs):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = bpe.encode_decode(edge_docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    want = [
        (r["doc_id"], enc.encode_ordinary(r["text"] or ""), (r["text"] or "").encode())
        for r in edge_docs.collect()
    ]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    have = sorted(
        ((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded_sha256"]) for r in got),
        key=key,
    )
    assert have == sorted(
        ((i, ids, hashlib.sha256(raw).hexdigest()) for i, ids, raw in want), key=key
    )
    assert all(r["round_trip"] and len(r["ids_sha256"]) == 64 for r in got)


def test_decode_gives_raw_bytes(spark, edge_docs):
    rows = bpe.encode_decode(edge_docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    back = bpe.decode(rows, RANKS, public_tokenizers.PATTERN)
    want = sorted((r["text"] or "").encode() for r in edge_docs.collect())
    assert sorted(bytes(r["raw"]) for r in back.collect()) == want


@settings(max_examples=200, deadline=None)
@given(MIXED)
def test_remembered_chunks_keep_the_ids(text):
    encoder = huffman._Encoder(VOCABULARY)
    want = huffman._tokenizer(VOCABULARY).encode(text, add_special_tokens=False).ids
    for _ in range(2):
        (raw,) = encoder.encode([text])
        assert np.frombuffer(raw, encoder.kind).tolist() == want


@pytest.mark.parametrize(
    "text",
    [
        "end <|endoftext|> of",
        "<|endoftext|>",
        "a  <|endoftext|>  b\t<|endoftext|><|endoftext|>\n c",
        "<|endoftext|",
        "a\0b <|endoftext|> \0  c",
        "  \n <|endoftext|>x y  z ",
    ],
)
def test_added_tokens_as_the_library_reads_them(text):
    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    encoder = huffman._Encoder(VOCABULARY)
    for other in ("of the", text, "x <|endoftext|>"):
        (raw, _) = encoder.encode([text, other])
        assert np.frombuffer(raw, encoder.kind).tolist() == want


def test_added_tokens_that_take_blanks(tmp_path):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.add_special_tokens([AddedToken("<cut>", lstrip=True, rstrip=True)])
    path = str(tmp_path / "added.json")
    tokenizer.save(path)
    encoder = huffman._Encoder(path)
    texts = ["some  <cut>  words here", "words <|endoftext|> here", "<cut>", "no more words"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(r, encoder.kind).tolist() for r in encoder.encode(texts)] == want


def kraft(lengths):
    return sum(2.0 ** -n for n in lengths.values())


def test_code_lengths_are_best_and_limited():
    few = {0: 5, 1: 9, 2: 12, 3: 13, 4: 16, 5: 45}
    assert huffman.code_lengths(few) == {0: 4, 1: 4, 2: 3, 3: 3, 4: 3, 5: 1}
    steep = {i: 2**i for i in range(30)}
    lengths = huffman.code_lengths(steep, 8)
    assert max(lengths.values()) <= 8 and kraft(lengths) <= 1
    # package-merge agrees with plain Huffman where the limit does not bind
    counts = {i: random.Random(i).randint(1, 1000) for i in range(300)}
    cost = lambda x: sum(counts[i] * n for i, n in x.items())
    assert cost(huffman._package_merge(counts, 18)) == cost(huffman.code_lengths(counts, 18))
    assert huffman.code_lengths({7: 3}) == {7: 1} and huffman.code_lengths({}) == {}
    with pytest.raises(ValueError):
        huffman.code_lengths({i: 1 for i in range(5)}, 2)


@pytest.mark.parametrize("size", [1, 2, 255, 256, 257, 5000])
def test_pack_and_unpack(size):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.zipf(1.3, size), 40_000).astype(np.int64)
    values, counts = np.unique(ids, return_counts=True)
    book = huffman.CodeBook(
        huffman.code_lengths(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    )
    parts = np.diff([0, *sorted({0, size // 3, size // 2, size})])
    payloads, offsets = book.pack(ids, parts)
    begin = np.cumsum([0, *[8 * len(p) for p in payloads]])
    checkpoints = np.concatenate([o + b for o, b in zip(offsets, begin, strict=False)])
    assert book.unpack(b"".join(payloads), checkpoints, parts).tolist() == ids.tolist()
    (payload,), _ = book.pack(ids, np.asarray([size]))
    # one bit at a time, from the codes alone
    bits = "".join(f"{b:08b}" for b in payload)
    table = {f"{book.codes[i]:0{book.lengths[i]}b}": i for i in values}
    word, plain = "", []
    for bit in bits:
        word += bit
        if word in table:
            plain.append(int(table[word]))
            word = ""
        if len(plain) == size:
            break
    assert plain == ids.tolist()


def test_stored_tokens(spark, edge_docs, no_docs):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    start = 0
    rows = [
        (
            r["doc_id"],
            np.asarray(
                [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4"
            ).tobytes(),
        )
        for r in edge_docs.collect()
    ]
    got = huffman.stored_tokens(edge_docs, VOCABULARY, with_ids=True).orderBy("start").collect()
    have = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got]
    key = lambda x: (x[0] is not None, x[0] or 0)
    assert [key(h) for h in have] == sorted(map(key, have))
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    want = [(doc_id, len(raw) // 4, zlib.crc32(raw)) for doc_id, raw in rows]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    assert huffman.stored_tokens(no_docs, VOCABULARY).count() == 0


def test_many_parts_and_blocks(spark, monkeypatch, edge_docs):
    """The same stream whatever the number of parts and blocks."""
    docs = spark.range(500).selectExpr("500 - id AS doc_id", "repeat(concat('word ', id, ' '), id % 40) AS text")
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    read = lambda df: [tuple(r[c] for c in columns) for r in df.orderBy("start").collect()]
    whole = read(huffman.stored_tokens(docs, VOCABULARY))
    monkeypatch.setattr(huffman, "PART_IDS", 3000)
    parts = huffman.stored_tokens(docs.repartition(3), VOCABULARY)
    assert read(parts) == whole and [r[0] for r in whole] == list(range(1, 501))


def test_ids_of_any_type_and_hot_ids(spark, monkeypatch):
    """Text ids, a null id of a third of the rows and repeated rows, over many parts."""
    docs = spark.range(600).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('d', id % 150) END AS doc_id",
        "repeat(concat('word ', id % 200, ' '), CAST(id % 40 AS int)) AS text",
    )
    monkeypatch.setattr(huffman, "PART_IDS", 3000)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]
        want.append((r["doc_id"] or "", len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
    huffman.stored_tokens(docs, VOCABULARY)
    (files,) = [p for p in scratch_paths(spark) if "token-blocks" in p][-1:]
    got = huffman.read_blocks(spark, files).orderBy("start").collect()  # the files are enough
    assert sorted((r["doc_id"] or "", r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert [r["doc_id"] or "" for r in got] == sorted(w[0] for w in want)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    nulls = spark.read.parquet(f"{files}/blocks").selectExpr("part", "explode(doc_ids) AS id")
    assert nulls.filter("id IS NULL").select("part").distinct().count() > 1


class Recording:
    """A tokenizer that keeps the texts it was given."""

    def __init__(self, inner):
        self.inner, self.seen = inner, []

    def encode_batch_fast(self, texts, **options):
        self.seen.extend(texts)
        return self.inner.encode_batch_fast(texts, **options)


def test_new_chunks_with_a_space_need_nothing_between():
    text = "One two, three é漢 it's 4,5\nsix <|endoftext|> seven\n eight"
    encoder = huffman._Encoder(VOCABULARY)
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder.tokenizer = recording = Recording(encoder.tokenizer)
    (raw,) = encoder.encode([text])
    assert np.frombuffer(raw, encoder.kind).tolist() == want
    (spaced,) = [t for t in recording.seen if " two," in t]
    assert "\t" not in spaced and all(c in spaced for c in (" three", " é漢", " it's"))


def test_words_with_marks_and_line_ends_need_no_new_call():
    encoder = huffman._Encoder(VOCABULARY)
    library = encoder.tokenizer
    encoder.tokenizer = recording = Recording(library)
    encoder.encode(["All of one text, then another.", "of one"])
    recording.seen.clear()
    text = "All of, text. another\none text\n\nof text? then; one: another!"
    (raw,) = encoder.encode([text])
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(raw, encoder.kind).tolist() == want
    # all known but a word that was never at the head of a line
    assert recording.seen == ["one"]


def test_only_the_place_of_two_blanks_is_new():
    encoder = huffman._Encoder(VOCABULARY)
    library = encoder.tokenizer
    encoder.tokenizer = recording = Recording(library)
    encoder.encode(["some words here are"])
    recording.seen.clear()
    text = "some words  here are words"
    (raw,) = encoder.encode([text])
    assert np.frombuffer(raw, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert recording.seen == ["  here"]


WORDS = ["the", "of", "it's", "3.5", "a,", "b.", "é!", "漢,", "end.\n", "\n", "", " ", "\t", "x\ty",
         "\u00a0", "\u3000.", "\x1c", "'re,", "...", "?!", "\0", "<|endoftext|>", "<|endoftext|>.", "²;", "A"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=8), min_size=1, max_size=6), st.data())
def test_columns_of_texts_keep_the_ids(lists, data):
    texts = [data.draw(st.sampled_from([" ", "", "\n"])).join(words) for words in lists]
    encoder, library = _SMALL[0], huffman._tokenizer(VOCABULARY)
    column = pa.array([None, *texts, None])
    ids, ends = encoder.encode_column(column)
    got = [part.tolist() for part in np.split(ids, ends)]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
    assert got == [*want, []]


_SMALL = [huffman._Encoder(VOCABULARY)]  # its words grow from example to example


def test_forgetting_keeps_the_ids(monkeypatch):
    monkeypatch.setattr(huffman, "KNOWN_CHUNKS", 60)
    encoder, rng = huffman._Encoder(VOCABULARY), random.Random(5)
    library = huffman._tokenizer(VOCABULARY)
    for _ in range(100):
        texts = [
            "".join(rng.choice(WORDS) + rng.choice(["", " ", " ", "\n", f" n{rng.randint(0, 99)},"]) for _ in range(9))
            for _ in range(4)
        ]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(r, encoder.kind).tolist() for r in encoder.encode(texts)] == want
    assert len(encoder.words) + len(encoder.raw) < 200
    assert encoder.encode([]) == []


def test_stretches_of_a_column():
    column = pa.array(["ab", None, "abcd", "x" * 50, "", "a"])
    assert list(huffman._of_bytes(column, 6)) == [(0, 3), (3, 1), (4, 2)]
    assert list(huffman._of_bytes(column.slice(2, 2), 6)) == [(0, 1), (1, 1)]
    assert list(huffman._of_bytes(column.slice(0, 0), 6)) == []
    assert huffman._encoder(VOCABULARY) is huffman._encoder(VOCABULARY)


def test_blocks_are_decoded_side_by_side(monkeypatch):
    monkeypatch.setattr(huffman, "DECODED_BYTES", 10)
    rows = [(4, 256), (6, 256), (1, 256), (1, 128), (30, 128), (2, 128)]
    batch = pa.RecordBatch.from_pydict(
        {"payload": [b"x" * n for n, _ in rows], "stride": [s for _, s in rows]}
    )
    assert list(huffman._together(batch)) == [(0, 2), (2, 1), (3, 1), (4, 1), (5, 1)]
    assert list(huffman._together(batch.slice(0, 0))) == []
