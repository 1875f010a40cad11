"""Tokens against the tiktoken library, and round trips."""

import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import bpe as B
from riskloom.llm.common import portions

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)
CODEC = B.Codec(RANKS, P.PATTERN)
OWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "  ", "a  b", "a \n b", "\n\n x", "it's we'll 'S 12 345", "x\x1cy \x1d z", "a  b　c", "naïve ñandú 漢字 🎉", "<|endoftext|>", " " * 3000 + "a", "ab" * 5000, "a" * 20000, "  a\t\tb  "]


@pytest.mark.parametrize("text", ODD)
def test_like_the_library(text):
    assert CODEC.encode(text) == OWN.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tae's1"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=60))
def test_any_text(text):
    assert CODEC.encode(text) == OWN.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()
    for size in (1, 5):
        assert "".join(B.slices(text, size)) == text
        assert [i for s in B.slices(text, size) for i in CODEC.encode(s)] == OWN.encode_ordinary(text)


def test_many_at_once():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abcdefe tin") for _ in range(rng.randrange(1, 90))) for _ in range(3000)] + ["ñandú漢字🎉".encode(), b"aaaaaaaaaaaaaaaaaaaaaaaa", bytes(range(256))]
    assert CODEC.encode_pieces(pieces) == [CODEC.encode_piece(p) for p in pieces]
    odd = {bytes([b]): b for b in range(256)} | {b"xab": 256, b"xa": 257, b"ab": 258, b"cab": 259, b"abab": 260}
    own, lib = B.Codec(odd, ".+"), tiktoken.Encoding("odd", pat_str=".+", mergeable_ranks=odd, special_tokens={})
    for _ in range(400):
        text = "".join(rng.choice("xabc") for _ in range(rng.randrange(1, 40)))
        assert own.encode_pieces([text.encode()]) == [own.encode_piece(text.encode())] == [lib.encode_ordinary(text)], text


def test_queue_order():
    rng = random.Random(1)
    queue, held = B.RankQueue(50_000), []
    for _ in range(3000):
        if held and rng.random() < 0.4:
            assert queue.pop() == held.pop(held.index(min(held)))
        else:
            entry = (rng.randrange(50_000) // rng.choice([1, 500]), rng.randrange(10_000))
            queue.add(*entry)
            held.append(entry)
    assert [queue.pop() for _ in range(len(held) + 1)] == [*sorted(held), None]


def test_rows(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(ODD)] + [(1, " ", "x", 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = B.tokenize(df, PATH, P.PATTERN, ["doc_id"])
    got = out.collect()
    assert len(got) == len(rows)
    want = {(k, hashlib.sha256(" ".join(map(str, OWN.encode_ordinary(t or ""))).encode()).hexdigest(), len(OWN.encode_ordinary(t or ""))) for k, t, *_ in rows}
    assert {(r["doc_id"], r["ids_sha256"], r["n_tokens"]) for r in got} == want
    back = B.detokenize(out, PATH, ["doc_id", "decoded_sha256"]).collect()
    assert {(r["doc_id"], bytes(r["body"])) for r in back} == {(k, (t or "").encode()) for k, t, *_ in rows}
    assert all(hashlib.sha256(r["body"]).hexdigest() == r["decoded_sha256"] for r in back)
    assert B.tokenize(df.limit(0), PATH, P.PATTERN, ["doc_id"]).count() == 0


def test_portions_hold_every_row_once():
    sizes = [3, 3, 3, 3, 25, 0, 10, 1, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array([b"x" * n for n in sizes], pa.binary())], names=["doc_id", "_body"])
    parts = [p.column(0).to_pylist() for p in portions(iter([batch.slice(0, 0), batch, batch.slice(2, 3)]), 10)]
    assert parts == [[0, 1, 2], [3], [4], [5, 6], [7, 8], [2, 3], [4]]
