"""Token files and piece coding against the libraries, text by text."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybook.llm import pieces, queries, token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(st.sampled_from(" \n\t\r \x1c▁ab.,'sTé1😀<|>") | st.characters(), max_size=40)


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_packing_round_trip(values):
    values = np.array(values, dtype=np.uint32)
    control, data = token_files.pack(values)
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values.tolist()


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_token_parts_equal_whole_texts(text):
    text = text.encode("utf-8", "ignore").decode()
    own = token_files.text_encoder(BPE)
    expected = np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert own.encode([text]) == [expected]


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_pieces_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    own = pieces.encoder(PIECES)
    ids = own.vocabulary.library.encode(text)
    ((joined, decoded),) = own.encode([text])
    assert joined == ",".join(map(str, ids))
    assert decoded == own.vocabulary.library.decode(ids) == own.vocabulary.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_agendas_side_by_side_equal_single_ones(texts):
    own = pieces.encoder(PIECES).vocabulary
    parts = [p for t in texts for p in pieces.parts_of(t.encode("utf-8", "ignore").decode())] + ["▁", "▁the", "a" * 64, "a" * 65, "▁internationalization"]
    assert own.encode_parts(parts) == [own.encode_part(p) for p in parts]


def test_generations_are_turned(monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY_PARTS", 5)
    monkeypatch.setattr(token_files, "MEMORY_PARTS", 5)
    one, two = pieces.Encoder(PIECES), token_files.TextEncoder(BPE)
    for text in ["some words of a text that repeat", "words of another text that repeat", "some words of a text that repeat"] * 3:
        assert one.encode([text])[0][0] == ",".join(map(str, one.vocabulary.library.encode(text)))
        assert np.frombuffer(two.encode([text])[0], "<u4").tolist() == two.library.encode(text).ids
        assert len(one.recent) <= 12 and len(two.recent) <= 12


#: Marks after letters, blanks of all kinds before spaces, and added tokens, whole and torn.
CUTS = [
    "one, two. three! it's. don't! l'été, où? é.é É;à ÷. ×.x word's'. a.'s a'.s a'll. 1.5 a1. x2,3",
    "x\u0301. ª. ǆ, ɏ. ɐ. 中文. 中 文 Ⅷ. ñ-ñ ß$$$ word### a...b a_b (c) \"d\" e~f",
    "a<|endoftext|>. b <|endoftext|>c|endoftext|> <|endoftext| > text|>x ĠĠ Ċa.Ġ <|endoftext|>\n<|endoftext|>",
    "a\xa0 b\x85 c\u1680 d\u2003 e\u2028 f\u205f g\u3000 h\x1c i\u180e j\u200b k\ufeff l à é\nà\n",
    "a  b   c\n\nd \ne\n f\t g\t\nh\r\ni  ", " ", "\n", ".", "a", "é", "", " .", "\n\n", ". .", " a", "a ", "😀 😀. a😀.",
]


@pytest.mark.parametrize("bounds", [{}, {"NEW_PARTS": 1}, {"NEW_PARTS": 3, "SLICE_BYTES": 5}, {"MEMORY_LENGTH": 0}, {"MEMORY_PARTS": 2}])
def test_parts_cut_at_marks_and_encoded_together(monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(token_files, name, value)
    own = token_files.TextEncoder(BPE)
    expected = [np.array(own.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in CUTS]
    for _ in range(2):
        assert own.encode(CUTS) == expected
    fresh = token_files.TextEncoder(BPE)
    assert [fresh.encode([t])[0] for t in CUTS] == expected
    assert own.encode([]) == []


class CountingLibrary:
    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.library.encode_batch_fast(texts, **options)


def test_new_parts_reach_the_library_together_and_once():
    own = token_files.TextEncoder(BPE)
    own.library = CountingLibrary(own.library)
    words = [f"{a}{b}{c}" for a in ("shon", "erth", "ouat") for b in ("ing", "ea", "ble") for c in ("né", "ly", "tion")]
    text = " " + " ".join(words)
    expected = own.library.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == expected
    assert own.library.texts == [text]
    # With a mark behind it a known word is not new.
    marked = " " + ", ".join(words) + "."
    expected = own.library.library.encode(marked, add_special_tokens=False).ids
    assert np.frombuffer(own.encode([marked])[0], "<u4").tolist() == expected
    assert sorted(own.library.texts[1:]) == [",", "."]


@pytest.mark.parametrize("alphabet", ["ab", "ab\u0120", "ab\u010a", "ab\u0120\u010a."])
def test_vocabularies_that_leave_bytes_out(tmp_path, alphabet):
    from tokenizers import models, pre_tokenizers

    library = Tokenizer(models.BPE({letter: i for i, letter in enumerate(alphabet)}, []))
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    path = str(tmp_path / "tokenizer.json")
    library.save(path)
    texts = ["a b\nab. ba, zz \nz", " a", "z", " z z a"]
    expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_files.TextEncoder(path).encode(texts) == expected


def test_id_counts_over_batches():
    import pyarrow as pa

    rows = [[1, 2, 2], [], [70_000, 2], [0]]
    narrow = [token_files._narrow(np.array(r, "<u4").tobytes()) for r in rows]
    batches = [pa.RecordBatch.from_pydict({"ids": pa.array(part, pa.binary())}) for part in (narrow[:2], [], narrow[2:])]
    (made,) = token_files._id_counts(iter(batches))
    assert made.to_pydict() == {"id": [0, 1, 2, 70_000], "n": [1, 1, 3, 1]}


def expected_tokens(texts):
    library, start, out = Tokenizer.from_file(BPE), 0, []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, small_texts):
    rows = queries.op1_token_files(spark, "/root/testdata/sf0.001").select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, rows.collect())) == expected_tokens(sorted(small_texts.items()))


def test_token_files_of_awkward_rows(spark, awkward, nothing):
    path = token_files.new_shard_folder(spark)
    token_files.write_shards(awkward.select("doc_id", "text"), BPE, 2, path)
    texts = sorted(((r.doc_id, r.text) for r in awkward.collect()), key=lambda t: t[0])
    rows = token_files.read_shards(spark, path, digests=True).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, rows.collect())) == expected_tokens(texts)
    ids = {r.doc_id: r.ids for r in token_files.read_shards(spark, path).collect()}
    assert ids[11][-1] == 2 and ids[1] == [2]
    path = token_files.new_shard_folder(spark)
    token_files.write_shards(nothing.select("doc_id", "text"), BPE, 2, path)
    assert token_files.read_shards(spark, path).count() == 0


def expected_pieces(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = []
    for doc_id, text in texts:
        ids = library.encode(text or "")
        joined = ",".join(map(str, ids))
        out.append((doc_id, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out)


def test_piece_query(spark, small_texts):
    assert sorted(map(tuple, queries.op5_piece_codec(spark, "/root/testdata/sf0.001").collect())) == expected_pieces(small_texts.items())


def test_pieces_of_awkward_rows(awkward, nothing):
    rows = pieces.encode_texts(awkward.select("doc_id", "text"), PIECES, digests=True)
    assert sorted(map(tuple, rows.collect())) == expected_pieces((r.doc_id, r.text) for r in awkward.collect())
    kept = pieces.encode_texts(awkward, PIECES)
    assert kept.columns[-2:] == ["piece_ids", "decoded"] and "component" in kept.columns
    assert {r.doc_id: r.decoded for r in kept.collect()}[4] == "Hello   world\n\nagain "
    assert pieces.encode_texts(nothing, PIECES).count() == 0


def test_unsuitable_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_files.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))


def test_workers_get_small_batches(spark):
    import pyarrow as pa

    from tallybook.session import BATCH_ROWS, small_batches

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for rows, expected in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("10", 10)):
            spark.conf.set(key, rows)
            assert int(small_batches(spark).conf.get(key)) == expected
            sizes = spark.range(0, 3000, 1, 1).mapInArrow(
                lambda batches: (pa.RecordBatch.from_pydict({"id": [len(b)]}) for b in batches), "id bigint"
            )
            assert {r.id for r in sizes.collect()} == {expected}
    finally:
        spark.conf.set(key, before)
