"""Encoding, token files and packing."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tastemap.llm import lines, packing, seekable, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]),
                         st.sampled_from("abcÀéßΣσς'’!.,-<|>0 \n\t\x1c\x85 ́ſK"))))
def test_words_encode_as_whole_texts(text):
    encoder = tokens.encoder(PATH)
    expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.words
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == expected


def test_special_tokens_and_a_full_memo(tokenizer, monkeypatch):
    texts = ["a<|endoftext|>B", "<|ENDOFTEXT|> it's IT'LL don't 's", "x" * 3000 + " é" * 40, ""]
    monkeypatch.setattr(tokens, "MEMO_WORDS", 2)
    encoder = tokens.Encoder(PATH)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = tokens.Encoder(path)
    assert not encoder.words
    text = "two  words\n and a tail "
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text.encode(), None])[0], "<u4").tolist() == expected


def expected_digests(rows, tokenizer, end):
    start, found = 0, []
    for doc_id, text in rows:
        ids = ids_of(tokenizer, text, end)
        found.append((doc_id, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_token_files_round_trip(spark, documents, tokenizer):
    files = seekable.write_tokens(documents, PATH, end_id=2)
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = [tuple(r)[:4] for r in seekable.read_tokens(files).orderBy("start").collect()]
    assert got == expected_digests(rows, tokenizer, 2)


def test_token_files_of_awkward_rows(awkward, tokenizer):
    files = seekable.write_tokens(awkward, PATH, end_id=2)
    got = seekable.read_tokens(files).orderBy("start").collect()
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    expected = sorted((r.doc_id is not None, r.doc_id or 0, len(ids_of(tokenizer, r.text, 2)),
                       crc32(ids_of(tokenizer, r.text, 2).tobytes()))
                      for r in awkward.select("doc_id", "text").collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32)
                  for r in got) == expected


def test_no_documents_give_no_files(no_rows):
    files = seekable.write_tokens(no_rows, PATH, end_id=2)
    assert files.count() == 0 and seekable.read_tokens(files).count() == 0


def test_readers_seek_and_check(spark, documents, tokenizer, monkeypatch):
    some = documents.where("doc_id < 20").coalesce(1)
    path = seekable.write_tokens(some, PATH, end_id=2).first().path
    with seekable.TokenFile(path) as file:
        place = file.documents.column("doc_id").to_pylist().index(7)
        read = []
        unpack = file.frame
        monkeypatch.setattr(file, "frame", lambda n: read.append(n) or unpack(n))
        text = some.where("doc_id = 7").first().text
        assert file.ids(place).tolist() == ids_of(tokenizer, text, 2).tolist()
        assert read == [place]
        n_frames = len(file.sizes)
    # Any reader of the compression format gets all ids in order.
    with open(path, "rb") as raw:
        data = raw.read()
    stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
    assert len(stream.read()) == sum(2 * len(ids_of(tokenizer, r.text, 2)) for r in some.collect())
    assert n_frames == some.count()
    with open(path, "r+b") as raw:
        raw.seek(int(12))
        byte = raw.read(1)
        raw.seek(12)
        raw.write(bytes([byte[0] ^ 1]))
    with seekable.TokenFile(path) as file, pytest.raises((ValueError, zstandard.ZstdError)):
        for number in range(n_frames):
            file.frame(number)


def test_a_long_document_takes_several_frames(spark, tokenizer, monkeypatch):
    # Frames are cut on the executors, which read the module's own constant.
    docs = spark.createDataFrame([(1, "a " * 10)], "doc_id long, text string")
    batch = next(iter(docs.selectExpr("doc_id", "0L AS row", "text").toArrow().to_batches()))
    monkeypatch.setattr(seekable, "FRAME_IDS", 4)
    ids = ids_of(tokenizer, "a " * 10, 2).tobytes()
    frames = seekable._frames(batch, [ids], zstandard.ZstdCompressor(), "<u4")
    assert frames.column("n_ids").to_pylist() == [4, 4, 3]
    assert frames.column("part").to_pylist() == [0, 1, 2]


def check_packing(rows, size):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in by_sequence.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place <= size
    return len(by_sequence)


def test_packing_documents(documents, tokenizer):
    pieces = packing.cut_documents(documents, PATH, 1, 512)
    packed = packing.pack_pieces(pieces, 512).collect()
    expected = {}
    for row in documents.collect():
        ids = ids_of(tokenizer, row.text, 1)
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at:at + 512]
            expected[row.doc_id, piece] = (at, len(part), crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == expected
    least = -(-sum(r.length for r in packed) // 512)
    assert least <= check_packing(packed, 512) <= 1.02 * least + 1


def test_packing_awkward_rows(awkward, no_rows):
    pieces = packing.cut_documents(awkward, PATH, 1, 64)
    packed = packing.pack_pieces(pieces, 64).collect()
    check_packing(packed, 64)
    assert len(packed) == pieces.count()
    assert packing.pack_pieces(packing.cut_documents(no_rows, PATH, 1, 64), 64).count() == 0


def test_packed_ids_are_the_documents(spark, tokenizer):
    docs = spark.createDataFrame([(i, f"text number {i} " * i) for i in range(1, 9)],
                                 "doc_id long, text string")
    pieces = packing.cut_documents(docs, PATH, 1, 16, with_ids=True)
    packed = packing.pack_pieces(pieces, 16)
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    for row in packed.collect():
        part = ids[row.sequence_id][row.offset:row.offset + row.length]
        assert crc32(part.tobytes()) == row.ids_crc32


def test_lengths_out_of_range_are_refused(spark):
    with pytest.raises(ValueError, match="length 9"):
        packing.pack_pieces(spark.createDataFrame([(9,)], "length long"), 8)


def test_other_columns_stay(spark):
    rows = spark.createDataFrame([(3, "x"), (5, "y"), (8, None)], "length long, name string")
    packed = packing.pack_pieces(rows, 8)
    assert packed.columns == ["length", "name", "sequence_id", "offset"]
    assert check_packing(packed.collect(), 8) == 2


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_piece(seed):
    random.seed(seed)
    size = random.choice([10, 100, 512])
    counts = np.zeros(size + 1, np.int64)
    for _ in range(random.choice([0, 5, 3000])):
        counts[random.randint(1, size)] += 1
    kinds = packing.plan_sequences(counts)
    placed = np.zeros(size + 1, np.int64)
    for lengths, n in kinds:
        assert sum(lengths) <= size
        for length in lengths:
            placed[length] += n
    assert (placed == counts).all()
    slots = packing.plan_slots(kinds)
    assert len(slots[0]) == sum(len(lengths) for lengths, _ in kinds)


def test_nnls_is_non_negative_least_squares():
    generator = np.random.default_rng(3)
    matrix = generator.random((12, 8))
    truth = np.maximum(generator.normal(size=8), 0)
    x = packing.nnls(matrix, matrix @ truth)
    assert np.allclose(x, truth, atol=1e-5) and (x >= 0).all()
    # At the solution no coefficient may grow, and those above zero are stationary.
    target = generator.normal(size=12)
    x = packing.nnls(matrix, target)
    slope = matrix.T @ (target - matrix @ x)
    assert (slope < 1e-5).all() and np.allclose(slope[x > 1e-9], 0, atol=1e-5)


def test_letters_with_marks_are_kept_once():
    encoder = tokens.Encoder(PATH)
    encoder.encode(["Word word, (word) WORD! word".encode()])
    held = [v for v in vars(encoder).values() if isinstance(v, dict) and v is not encoder.letters]
    keys = [k if isinstance(k, bytes) else k.encode() for d in held for k in d]
    assert keys.count(b"word") == 1


def test_workers_drop_the_words_when_they_turn_to_other_work():
    tokens.encoder(PATH).encode([b"words kept from task to task"])
    assert tokens.encoder(PATH).memo
    batch = pa.record_batch([pa.array([1]), pa.array([b"a line"])], ["doc_id", "text"])
    assert sum(b.num_rows for b in lines._lines(iter([batch]))) == 2
    assert not tokens.encoder(PATH).memo
