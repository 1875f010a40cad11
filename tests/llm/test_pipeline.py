"""The pipeline against brute-force versions of its stages."""

import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from test_decontaminate import brute as contaminated
from test_minhash import brute as classes

import corpus_pipeline
from riskloom.llm.bpe import read_ranks

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int"


def repeats(rows, length=100):
    seen, out = {}, []
    bodies = [(t or "").encode() for _, t in rows]
    for n, b in enumerate(bodies):
        for a in range(len(b) - length + 1):
            seen.setdefault(b[a : a + length], (n, a))
    for n, ((i, t), b) in enumerate(zip(rows, bodies, strict=True)):
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] < (n, a):
                gone[a : a + length] = True
        out.append((i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")))
    return out


def expected(docs, items):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    docs = sorted(((d[0], d[1]) for d in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    docs = [r for r in docs if r[1] and any(c.isalpha() for c in r[1])]
    group = classes([(n, t) for n, (_, t) in enumerate(docs)])
    docs = [r for n, r in enumerate(docs) if group[n] == n]
    docs = repeats(docs)
    bad = {n for n, *_, flag in contaminated([(n, t) for n, (_, t) in enumerate(docs)], items) if flag}
    out = []
    for n, (i, t) in enumerate(docs):
        if n not in bad:
            ids = own.encode_ordinary(t)
            out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def tables(spark, path, docs, items):
    spark.createDataFrame([(i, t, lang, "s", None, 1) for i, t, lang in docs], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_like_brute_force(spark, tmp_path):
    rng = np.random.default_rng(8)
    words = ["mot", "été", "house", "straße", "niño", *("w" + str(k) for k in range(200))]
    text = lambda n: " ".join(rng.choice(words, n))
    items = [(k, text(30)) for k in range(4)] + [(9, None)]
    passage = text(40)
    docs = [(k, text(int(rng.integers(5, 150))), ["en", "fr", None][k % 3]) for k in range(40)]
    docs += [(40 + k, docs[k][1] + (" end" if k % 2 else ""), "en") for k in range(8)]
    docs += [(50 + k, text(60) + " " + passage + " " + text(60), "fr") for k in range(5)]
    docs += [(60, items[0][1] + " " + text(10), "en"), (61, text(400) + items[1][1], "en"), (62, None, "en"), (63, "", None), (64, "123 ---", "en"), (65, "x " * 5000, "en"), (None, text(40), "en"), (3, docs[3][1], "en"), (3, text(50), "en")]
    tables(spark, tmp_path, docs, items)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()), key=repr) == expected(docs, items)


def test_empty(spark, tmp_path):
    tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns(spark, tmp_path):
    docs = [(k, f"some words of text number {k} and more", "en") for k in range(6)]
    tables(spark, tmp_path, docs, [(1, "other words")])
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeats", "benchmark", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
