"""Pieces against the library, places against the rules, bins against exhaustive search."""

import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import packing as P
from riskloom.llm import words as W

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=9), st.integers(0, 60))
def test_fullest(items, room):
    got = P._fullest(Counter(items), room)
    best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= room)
    assert sum(x * k for x, k in got) == best and all(Counter(items)[x] >= k > 0 for x, k in got)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 1000), max_size=30))
def test_plan(counts):
    left = Counter(counts)
    bins = P.plan_bins(counts, 50)
    for used, number in bins:
        assert sum(x * k for x, k in used) <= 50 and number > 0
        left.subtract({x: k * number for x, k in used})
    assert not any(left.values())


def test_plan_is_tight():
    rng = np.random.default_rng(3)
    counts = Counter(np.minimum(4096, rng.lognormal(6, 1.2, 50_000).astype(int) + 1).tolist())
    total = sum(x * n for x, n in counts.items())
    bins = P.plan_bins(counts)
    assert sum(n for _, n in bins) <= -(-total // 4096) + 1 and len(bins) < 3 * len(counts)


ODD = ["", None, "It's a TEST, naïve é x", "a\x1cb \x1d c", "a b　c", "a<|endoftext|> <|startoftext|>", "İstanbul ΣΑΣ ﬁ H̱ ǅ Ⱥ, ªº! 'tis don't... x's y'", "漢字 🎉🎉 12345", "x" * 3000, " lead  and\ttrail \n", "́ start", "word " * 9000, "end"]


def ids_of(text):
    return [*OWN.encode(text or "", add_special_tokens=False).ids, 1]


def test_rows(spark, tmp_path):
    from riskloom.llm.queries import op12_best_fit_packing

    rows = [*enumerate(ODD * 3), (None, "null id"), (1, "again"), (1, "again")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, part int, length int").repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_best_fit_packing(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = out.collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(ids_of(t), "<u4")
        for k in range(0, len(ids), 4096):
            want[i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == -(-sum(r["length"] for r in got) // 4096)


def test_ids_and_sequences(spark):
    df = spark.createDataFrame([("a", "one two"), ("b", "three"), ("c", "one two"), ("d", None)], "doc_id string, text string")
    packed = P.pack(df, PATH, 1, size=4).persist()
    assert {(r["doc_id"], r["piece"]): list(r["ids"]) for r in packed.collect()} == {(k, 0): ids_of(t) for k, t in [("a", "one two"), ("b", "three"), ("c", "one two"), ("d", None)]}
    made = {r["sequence_id"]: list(r["ids"]) for r in P.sequences(packed).collect()}
    for r in packed.collect():
        assert made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == list(r["ids"])
    assert sorted(map(len, made.values())) == [2, 3, 4] or sorted(map(len, made.values())) == [1, 4, 4]
    assert P.pack(df.limit(0), PATH, 1).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x260), st.sampled_from("aZé'st.,|<>́̇ ΣİßŒ")), max_size=12), max_size=20))
def test_words(texts):
    encoder = W.WordEncoder(OWN.to_str())
    want = [OWN.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])] == want


def test_long_text_and_generations(monkeypatch):
    monkeypatch.setattr(W, "REMEMBER", 20)
    monkeypatch.setattr(W, "PIECE", 100)
    rng = np.random.default_rng(4)
    text = " ".join("".join(rng.choice(list("abé,'"), 5)) for _ in range(2000)) + "x" * 500
    encoder = W.WordEncoder(OWN.to_str())
    for _ in range(2):
        assert np.frombuffer(encoder.encode_long(text.encode()), "<u4").tolist() == OWN.encode(text, add_special_tokens=False).ids
