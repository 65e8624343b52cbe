"""BPE transducer and streaming decoder against a public tokenizer library."""

import hashlib
import random

import pytest
import tiktoken

from bazaarlens.llm.bpe import (Decoder, Encoder, default_vocabulary, digests, read_ranks,
                                round_trip, windows)
from bazaarlens.llm.registry import QUERIES
from tests.conftest import SF_SMALL

PATH, PATTERN = default_vocabulary()
TOKENS = read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(TOKENS)})


@pytest.fixture(scope="module")
def encoder():
    return Encoder(TOKENS, PATTERN)


def test_random_pieces(library, encoder):
    rnd = random.Random(3)
    for k in range(4000):
        piece = b"".join(rnd.choice(TOKENS) for _ in range(rnd.randint(1, 5))) if k % 2 else \
            bytes(rnd.choice(b"abcdeinorst ") for _ in range(rnd.randint(1, 25)))
        assert list(encoder.pieces.transducer.encode_piece(piece)) == \
            library._encode_single_piece(piece)


def test_awkward_texts(library, encoder):
    for text in ["", " ", "\n\n  \t x", "I'm we're 'tis", "<|endoftext|>", "a" * 3000, "é" * 500,
                 "日本語テキスト 🙂🙂", "x  y \x1c z", "123 456,789", "a  b   c    "]:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_windows_change_nothing(library, encoder):
    text = "Some words, 12 numbers\n\n and  blanks " * 50
    for size in (1, 7, 64):
        assert "".join(windows(text, size)) == text
        got = [i for w in windows(text, size) for i in encoder.encode(w).tolist()]
        assert got == library.encode_ordinary(text)


def test_windows_cut_by_the_pattern_s_white_space(library, encoder):
    rnd = random.Random(11)
    signs = "ab1.!  \n\x1c\x1d\x1e\x1f\x85\u00a0\u2028\u200b\x00"
    for _ in range(300):
        text = "".join(rnd.choice(signs) for _ in range(60))
        for size in (1, 3, 10):
            parts = list(windows(text, size))
            assert "".join(parts) == text
            assert [m for w in parts for m in encoder.find(w)] == encoder.find(text)
    assert list(windows("..\x1c.. b", 2)) == ["..\x1c..", " b"]
    assert list(windows("", 3)) == [""]


def test_settled_tokens_are_emitted_early(library, encoder, monkeypatch):
    """A long piece leaves the transducer in runs; what is remembered stays
    below a settling step and a few times the longest token."""
    import bazaarlens.llm.bpe as B
    machine, rnd = encoder.pieces.transducer, random.Random(12)
    longest, held = max(map(len, TOKENS)), []
    plain = B.Transducer._settled
    monkeypatch.setattr(B.Transducer, "_settled", lambda self, state, closing: (
        held.append(len(closing)), plain(self, state, closing))[1])
    for settle in (1, 7, 64):
        monkeypatch.setattr(B, "SETTLE", settle)
        for piece in (bytes(rnd.choice(b"abcdeinorst") for _ in range(3000)), b"a" * 3000,
                      "é日🙂".encode() * 200, b"".join(rnd.choice(TOKENS) for _ in range(400))):
            runs = list(machine.emit(piece))
            assert [i for r in runs for i in r] == library._encode_single_piece(piece)
            assert len(runs) == -(-len(piece) // settle)
        assert max(held) <= settle + 3 * longest
    monkeypatch.setattr(B, "MAX_STATES", 20)   # emptied within a piece
    piece = bytes(rnd.choice(b"abcdeinorst") for _ in range(3000))
    assert [i for r in B.Transducer(TOKENS).emit(piece) for i in r] == library._encode_single_piece(piece)


def test_small_state_table_changes_nothing(library, encoder, monkeypatch):
    import bazaarlens.llm.bpe as B
    monkeypatch.setattr(B, "MAX_STATES", 20)
    monkeypatch.setattr(B, "MAX_PIECES", 5)
    text = "the quick brown fox jumps over the lazy dog " * 5
    assert Encoder(TOKENS, PATTERN).encode(text).tolist() == library.encode_ordinary(text)


def test_decoder_hands_on_whole_characters(encoder):
    text = "naïve 日本 🙂 \x80 end"
    ids = encoder.encode(text).tolist()
    parts = list(Decoder(TOKENS).stream([[i] for i in ids]))
    assert b"".join(parts) == text.encode()
    for p in parts:
        p.decode()
    broken = [encoder.pieces.transducer.encode_piece(bytes([0xF0, 0x9F])) +
              encoder.pieces.transducer.encode_piece(b"ab")]
    assert b"".join(Decoder(TOKENS).stream(broken)) == b"\xf0\x9fab"


def _expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_edge_rows(spark, library):
    rows = [(1, "hello"), (None, None), (2, ""), (2, ""), (3, "word " * 60000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(str, digests(round_trip(spark, df)).collect()))
    assert got == sorted(
        f"Row(doc_id={i}, n_tokens={n}, ids_sha256='{a}', decoded_sha256='{b}')"
        for i, (n, a, b) in ((i, _expected(library, t)) for i, t in rows))
    assert digests(round_trip(spark, df.limit(0))).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _expected(library, docs[r.doc_id])
