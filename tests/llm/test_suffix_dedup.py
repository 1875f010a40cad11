"""Repeats against a brute-force scan of every window."""

import hashlib

import numpy as np
import pytest

from riskloom.llm import suffix_dedup as S


def brute(rows, length=100):
    """rows: (id, text or None), in corpus order."""
    seen, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for n, (_, b) in enumerate(texts):
        for a in range(len(b) - length + 1):
            seen.setdefault(b[a : a + length], (n, a))
    for n, (i, b) in enumerate(texts):
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] < (n, a):
                gone[a : a + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string")
    out = S.remove_repeats(df, keep=False, **more)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus():
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(300)] + ["été", "ñandú"]
    text = lambda n: " ".join(rng.choice(words, n))
    passage, edge = text(40), text(11)
    rows = [(k, text(int(rng.integers(0, 120)))) for k in range(60)]
    for k in range(60, 100):
        rows.append((k, text(int(rng.integers(0, 30))) + passage[: int(rng.integers(90, len(passage)))] + text(9)))
    rows += [(100 + k, rows[k * 3][1]) for k in range(15)]  # copies
    for k in range(15):  # near copies
        old = list(rows[k * 4][1])
        if old:
            old[int(rng.integers(len(old)))] = "#"
        rows.append((120 + k, "".join(old)))
    rows += [(140, None), (141, ""), (142, "a" * 99), (143, "a" * 100), (144, "a" * 350), (145, "ab" * 400), (146, edge + "ab" * 300), (147, "abc" * 5000 + passage), (148, "line of text that repeats. " * 60)]
    return rows


@pytest.mark.parametrize("sizes", [S.Sizes(), S.Sizes(hot=1, crowd=1, block=700), S.Sizes(hot=2, crowd=2, stretch=1500)])
def test_like_brute_force(spark, sizes):
    rows = corpus()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        assert got(spark, rows, sizes=sizes) == sorted(brute(rows), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_periods_near_the_width(spark):
    """Lines whose repeats are as far apart as a window's grams reach, or one byte less or more."""
    rng = np.random.default_rng(8)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    rows = [(0, word(300))]
    for size in (52, 53, 54):
        for times in (3, 4, 5, 6):
            for _ in range(5):
                rows.append((len(rows), word(int(rng.integers(0, 80))) + (word(size - 1) + "\n") * times + word(int(rng.integers(0, 80)))))
    rows += [(len(rows) + k, rows[k * 7 + 1][1]) for k in range(5)]
    assert got(spark, rows) == sorted(brute(rows), key=repr)


def test_repeated_and_null_ids(spark):
    rows = corpus()
    body, other = rows[3][1] * 3, rows[4][1] * 2
    df = [(None, body), (5, other), (5, body), (5, body), (9, body)]
    in_order = sorted(df, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got(spark, df) == sorted(brute(in_order), key=repr)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_kept_bytes(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in S.remove_repeats(df).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
