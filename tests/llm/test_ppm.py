"""Scores against a dictionary model that counts and escapes byte by byte."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import ppm as P


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(rows):
    train = [(i, (t or "").encode().translate(LOWER)) for i, t in rows if not (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)]
    follow = defaultdict(Counter)
    words = Counter()
    for _, b in train:
        s = bytes([P.START] * P.ORDER) + b + bytes([P.END])
        for k in range(P.ORDER, len(s)):
            for n in range(P.ORDER + 1):
                follow[s[k - n : k]][s[k]] += 1
        words.update(b.split())
        words[b""] += 1
    total, distinct = sum(words.values()), len(words)

    def symbol(context, x):
        out, gone = 0.0, set()
        for n in range(P.ORDER, -1, -1):
            seen = follow.get(context[P.ORDER - n :])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in gone}
            size = sum(left.values()) + len(left)
            if x in left:
                return out + math.log10(left[x] / size)
            if left:
                out += math.log10(len(left) / size)
            gone |= set(seen)
        return out - math.log10(256 - len(gone))

    result = []
    for i, t in rows:
        b = (t or "").encode().translate(LOWER)
        s = bytes([P.START] * P.ORDER) + b + bytes([P.END])
        tokens = [*b.split(), b""]
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in tokens)
        score = sum(symbol(s[k - P.ORDER : k], s[k]) for k in range(P.ORDER, len(s)))
        result.append((i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(tokens), sum(words[w] > 0 for w in tokens), total, base, score))
    return result


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_BYTES", block)
    rng = np.random.default_rng(1)
    words = ["der", "die", "Das", "été", "the", "x y", "ab\tcd", "q\n"]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(0, 40))))) for k in range(40)]
    rows += [(40, None), (41, ""), (42, "Never SEEN 漢字 🎉 \x00 É"), (None, "null id"), (7, rows[7][1]), (7, rows[7][1]), (8, "other text of an old id"), (43, "zzz" * 2000)]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, block int, word string")
    got = P.score(df)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got, want = sorted(map(tuple, got.collect()), key=repr), sorted(brute(rows), key=repr)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_no_training_rows_and_empty(spark):
    i = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    df = spark.createDataFrame([(i, "ab")], "doc_id long, text string")
    (r,) = P.score(df).collect()
    assert r["score"] == pytest.approx(-3 * math.log10(256)) and (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert P.score(df.limit(0)).count() == 0
