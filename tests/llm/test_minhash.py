"""Classes against all pairs, and signatures against exact similarity."""

import itertools

import numpy as np
import pytest

from riskloom.llm import minhash as M


def words_of(text):
    return (text or "").encode().translate(M.WORD_BYTES).split()


def sets_of(text):
    w = words_of(text)
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: sets_of(t) for i, t in rows}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in parent}


def corpus():
    rng = np.random.default_rng(3)
    vocabulary = ["w" + str(k) for k in range(400)]
    text = lambda n: list(rng.choice(vocabulary, n))
    rows, i = [], 0
    for _ in range(25):
        base = text(int(rng.integers(8, 300)))
        for _ in range(int(rng.integers(1, 6))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 1 + len(copy) // 60))):
                copy[int(rng.integers(len(copy)))] = "edit"
            rows.append((i, " ".join(copy)))
            i += 1
    for extra in (None, "", "...", "one", "One!", "one two", "a b c d", "A b, c d.", "é è", "line of words " * 4000):
        rows.append((i, extra))
        i += 1
    return rows


def crowd():
    """Copies of one text with edits of their own, and chains that link only through each other."""
    rng = np.random.default_rng(9)
    base = ["b" + str(k) for k in range(120)]
    rows = []
    for k in range(120):
        copy, own = list(base), int(rng.integers(1, 7))
        for at in rng.choice(24, own, replace=False) * 5:
            copy[at] = f"e{int(rng.integers(3))}" if k % 3 else f"x{k}"
        rows.append((k, " ".join(copy)))
    rows += [(200 + k, " ".join(base[: 120 - 8 * k])) for k in range(12)]
    return rows


@pytest.mark.parametrize("few", [24, 1])
@pytest.mark.parametrize("make", ["corpus", "crowd"])
def test_classes(spark, monkeypatch, make, few):
    monkeypatch.setattr(M, "FEW", few)
    rows = globals()[make]()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, u int")
    got = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_repeated_and_null_ids(spark):
    text, other = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (3, other), (4, other), (5, None)], "doc_id long, text string")
    got = sorted((tuple(r)[:3] for r in M.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, None, 3), (3, None, 3), (3, None, 3), (3, 3, 2), (4, 3, 2), (5, 5, 1)], key=repr)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicates(df).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    k = 2000
    for scale in (1.0, 6.0):
        a = {int(e): float(w) for e, w in zip(rng.integers(0, 1 << 60, 60), scale * rng.random(60) + 0.05, strict=True)}
        b = {e: w * rng.choice([0.5, 1, 1, 2]) for e, w in a.items()}
        want = sum(min(a[e], b[e]) for e in a) / sum(max(a[e], b[e]) for e in a)
        doc = np.repeat([0, 1], 60)
        sig = M.signatures(doc, np.array([*a, *b], np.uint64), np.array([*a.values(), *b.values()]), 2, k)
        assert abs((sig[0] == sig[1]).mean() - want) < 0.05


def test_links_are_named_for_what_they_are(spark):
    df = spark.createDataFrame([(k, "one text that all share " * 9 + f"end {k}") for k in range(9)], "doc_id long, text string")
    assert M.near_duplicates(df).columns == ["doc_id", "class_id", "class_size", "links_checked"]
