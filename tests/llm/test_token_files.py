"""Files against the library on whole texts, and blocks against their ids."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN = Tokenizer.from_file(PATH)
OWN.encode_special_tokens = True


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=300))
def test_blocks(ids):
    ids = np.array(ids, np.uint32)
    assert (T.unpack_block(T.pack_block(ids), 0) == ids).all()


def test_segments_and_index():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.2, 30_000).clip(0, 2**32 - 1).astype(np.uint32)
    blob = T.pack_segment(3, 1, 77, np.array([5, 9]), np.array([10_000, 20_000]), ids)
    data = blob + b"\n" + T.pack_segment(3, 2, 9, np.zeros(0), np.zeros(0), ids[:0]) + b"\n"
    one, none = T.segments(data)
    assert (one.ids() == ids).all() and (one.part, one.number, one.before, list(one.keys)) == (3, 1, 77, [5, 9]) and none.n_ids == 0
    for first, count in [(0, 1), (4095, 2), (4096, 4096), (29_999, 1), (100, 25_000), (5, 0)]:
        assert (one.ids(first, count) == ids[first : first + count]).all()
    with pytest.raises(ValueError):
        list(T.segments(data[:200] + bytes([data[200] ^ 1]) + data[201:]))


def want(rows):
    start, out = 0, []
    for i, t in rows:
        ids = [*OWN.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


ODD = ["", None, "It's a TEST, naïve é x", "a\x1cb \x1d c", "a b　c d", "<|endoftext|> <|startoftext|>", "İstanbul ΣΑΣ ﬁ", "漢字 🎉🎉 12345", "x" * 3000, " lead  and\ttrail \n", "́ start", "word " * 9000]


def test_rows(spark):
    rows = [(k * 3, t) for k, t in enumerate(ODD * 4)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows[::-1]], "doc_id long, text string, part int").repartition(4)
    assert sorted(map(tuple, T.token_files(df, PATH, 1).collect()), key=repr) == want(rows)


def test_equal_and_null_ids(spark):
    rows = [(None, "null id"), (1, "a"), (1, "a"), (1, "b"), (2, None)]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    assert sorted(map(tuple, T.token_files(df, PATH, 1).collect()), key=repr) == want(rows)


def test_empty(spark):
    assert T.token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, 1).count() == 0


def test_query_like_the_file_alone(spark, tmp_path):
    """The registered query against the library with nothing set."""
    from riskloom.llm.queries import op9_token_files

    plain, text = Tokenizer.from_file(PATH), ODD + ["a<|endoftext|>b", "x <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "é<|endoftext|>́ c", "<|endoftext|>\u00a0<|startoftext|>\u3000."]
    spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start, out = 0, []
    for i, t in enumerate(text):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert plain.encode("a<|endoftext|>b", add_special_tokens=False).ids[1] == 49407
    assert sorted(map(tuple, op9_token_files(spark, str(tmp_path)).collect())) == out
