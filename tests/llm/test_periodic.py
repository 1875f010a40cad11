"""Runs against a search over all periods."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import periodic as P


def brute(words):
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and (i, j - i + q) not in found:  # a smaller period comes first
                found[i, j - i + q] = q
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def alike(texts):
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = np.array([w for t in texts for w in t], np.int64)
    got = P.find_runs(words, at)
    want = [(s + a, n, q) for t, a in zip(texts, at, strict=False) for s, n, q in brute(t)]
    assert sorted(map(tuple, got.tolist())) == sorted(want)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=120), min_size=1, max_size=4))
def test_two_words(texts):
    alike(texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9)), max_size=5), min_size=1, max_size=3), st.integers(0, 5))
def test_powers(parts, extra):
    texts = []
    for blocks in parts:
        text = []
        for root, times in blocks:
            text += root * times + root[: extra % (len(root) + 1)]
        texts.append(text)
    alike(texts)


def test_nested_powers():
    rng = np.random.default_rng(5)
    for _ in range(60):
        root = rng.integers(0, 3, int(rng.integers(1, 6))).tolist()
        for _ in range(3):
            root = (root * int(rng.integers(1, 6)))[: int(rng.integers(1, 300))] + rng.integers(0, 3, int(rng.integers(0, 3))).tolist()
        alike([root * 5, root[::-1] * 4, root])


def expected(key, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        key,
        len(runs),
        *(top or (None,) * 3),
        top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def texts():
    rng = np.random.default_rng(2)
    vocabulary = ["der", "die", "été", "the", "x", "漢字", "a b", "q\x1cr"]
    out = ["", None, " \t\r\n\x0b\x0c ", "a a a a a a", "a a a a a", "ab ab\tab\nab ab  ab ab", "w " * 5000, "one"]
    for k in range(60):
        root = " ".join(rng.choice(vocabulary, int(rng.integers(1, 30))))
        out.append(" ".join([root] * int(rng.integers(1, 8))) + " " + " ".join(rng.choice(vocabulary, 20)))
    return out


def test_query(spark, tmp_path):
    from riskloom.llm.queries import op13_periodic_runs

    rows = [*enumerate(texts()), (None, "a b " * 9), (3, "a a a a a a"), (3, "a a a a a a"), (-7, "left right " * 40)]
    spark.createDataFrame([(k, t, "n", 1) for k, t in rows], "doc_id long, text string, runs string, top int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(*r) for r in rows), key=repr)


def test_operator_and_empty(spark):
    df = spark.createDataFrame([("k", "a b a b a b a b c")], "doc_id string, text string")
    (r,) = P.periodic_runs(df).collect()
    assert (r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"])) == ("k", 9, [(0, 8, 2)], b"a b c")
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_long_text(spark):
    text = "start " + "a b c d e f g " * 100_000 + "end"
    (r,) = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(x) for x in r["runs"]] == [(1, 700_000, 7)] and bytes(r["collapsed"]) == b"start a b c d e f g end"
