"""Hits against a scan of every window in every document."""

import hashlib
import re

import numpy as np

from riskloom.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)) if w else []:
            wins.setdefault(tuple(w[k : k + 13]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, met = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k : k + n]))
                if found:
                    met |= found
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, gid int")
    b = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, words string")
    return sorted((tuple(r) for r in decontaminate(d, b).collect()), key=repr)


def test_like_brute_force(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["a", "the", "of", "Été", "niño", "x1", *("w" + str(k) for k in range(40))]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(int(rng.integers(13, 40)))) for k in range(20)] + [(20, "the of"), (21, "x1"), (22, "w1, w2 W3 w4"), (23, None), (24, "..."), (25, ""), (None, text(14)), (3, text(15)), (26, "w7 w8 " * 20)]
    docs = []
    for k in range(60):
        body = text(int(rng.integers(0, 200)))
        for _ in range(int(rng.integers(0, 3))):
            item = items[int(rng.integers(20))][1].split(" ")
            a = int(rng.integers(0, 5))
            body += " " + ", ".join(item[a : a + int(rng.integers(8, 30))]).upper() + ". " + text(int(rng.integers(0, 50)))
        docs.append((k, body))
    docs += [(60, None), (61, ""), (62, items[0][1]), (62, items[0][1]), (62, items[1][1]), (None, items[2][1]), (63, items[4][1] + " " + items[4][1]), (64, "w7 w8 " * 3000), (65, " ".join(items[5][1].split()[:12]))]
    assert got(spark, docs, items) == brute(docs, items)


def test_only_long_items_and_empty_tables(spark):
    item = " ".join(f"q{k}" for k in range(30))
    docs = [(1, "x " * 10 + item[5:] + " y" * 500), (2, "nothing here")]
    assert got(spark, docs, [(1, item)]) == brute(docs, [(1, item)])
    assert got(spark, [], [(1, item)]) == []
    assert got(spark, docs, []) == brute(docs, [])
