"""Held-out accuracy, learning by gradients that differences confirm, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import language_id as L
from riskloom.llm.common import held_out
from riskloom.llm.queries import op10_language_id


def test_gradients():
    rng = np.random.default_rng(1)
    net = L._start(["a", "b"], 4, rng)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    words, labels = [b"abc", b"zq", b"m"], np.array([0, 1, 1])

    def loss():
        *_, inner, _, _, _, p = L._positions(net, words, False)
        return -(np.log(p[:, np.arange(3), labels]) * inner).sum()

    x, xr, mask, inner, both, tf, tb, p = L._positions(net, words, True)
    grad = p.copy()
    grad[:, np.arange(3), labels] -= 1
    grad *= inner[:, :, None]
    grads = {k: np.zeros_like(v) for k, v in net.weights.items()}
    back, half = grad @ net.weights["o"].T, both.shape[2] // 2
    L._gru_back(x, mask, net.weights, "f", tf, back[:, :, :half], grads)
    L._gru_back(xr, mask, net.weights, "b", tb, L._reverse(back[:, :, half:], mask), grads)
    for name, at in [("uf", (1, 2)), ("ub", (3, 9)), ("xf", (97, 5)), ("xb", (113, 1)), ("bf", (10,)), ("bb", (0,))]:
        w, was = net.weights[name], net.weights[name][at]
        w[at] = was + 1e-3
        up = loss()
        w[at] = was - 1e-3
        slope = (up - loss()) / 2e-3
        w[at] = was
        assert abs(slope - grads[name][at]) < 2e-3 * max(1, abs(slope)), name


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op10_language_id(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 1), (1, "the cat and the dog", "en", 1), (2, None, "en", 2), (None, "le chat et le chien", "fr", 3), (4, "123 --- 456", "fr", 4), (5, "", None, 5), (6, "x" * 100_000, None, 6), (7, "le chien", "fr", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, body int")
    net = L.fit(df, ~held_out("doc_id", 4), steps=5)
    assert net.langs == ["en", "fr"]
    got = L.identify(df, net, ["doc_id"]).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {2, 4, 5}
    assert L.fit(df.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in L.identify(df, None, ["doc_id"]).collect()} == {"und"}
    assert L.identify(df.limit(0), net, ["doc_id"]).count() == 0


def _learned(monkeypatch, df, **options):
    """What fit hands to training: its languages, and (language, piece) with counts."""
    seen = {}

    def train(langs, words, labels, counts):
        seen.update(langs=langs, pieces={(langs[k], w): n for k, w, n in zip(labels, words, counts, strict=True)})

    monkeypatch.setattr(L, "train", train)
    L.fit(df, F.lit(True), **options)
    return seen


def test_every_language_is_learned(spark, monkeypatch):
    rich = [(k, " ".join(f"w{k}x{j}" for j in range(200)), "rich") for k in range(200)]
    rare = [(1000 + k, f"wort{k} und", f"l{k:02}") for k in range(80)]
    same = [(7, "one text of one id", "same")] * 3000
    blank = [(5000, " \n\t", "blank"), (5001, "no label", None)]
    df = spark.createDataFrame(rich + rare + same + blank, "doc_id long, text string, lang string")
    seen = _learned(monkeypatch, df)
    assert seen["langs"] == sorted({*(r[2] for r in rich + rare + same)})
    for _, text, lang in rare + same[:1]:
        assert {w for at, w in seen["pieces"] if at == lang} == {w.encode() for w in text.split()}
    assert seen["pieces"]["same", b"text"] == 3000
    assert 250 < sum(at == "rich" for at, _ in seen["pieces"]) < 500


def test_long_words_are_cut_before_the_draw(spark, monkeypatch):
    body = "".join(chr(0x4E00 + k % 3000) for k in range(200_000))
    df = spark.createDataFrame([(1, body, "zh"), (2, "é" * 40 + " é", "fr")], "doc_id long, text string, lang string")
    seen = _learned(monkeypatch, df, max_pieces=400, least_pieces=100)
    pieces = [w for at, w in seen["pieces"] if at == "zh"]
    assert 100 < len(pieces) < 300 and all(len(w) <= L.PIECE for w in pieces)
    assert {w: n for (at, w), n in seen["pieces"].items() if at == "fr"} == {("é" * 15).encode(): 2, ("é" * 10).encode(): 1, "é".encode(): 1}


def test_many_languages_in_parts(spark):
    rng = np.random.default_rng(2)
    net = L._start([f"l{k:03}" for k in range(700)], 4, rng)
    df = spark.createDataFrame([(k, f"some words {k}") for k in range(2500)], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in L.identify(df, net, ["doc_id"]).collect()} == set(range(2500))


def test_stage_without_labels_keeps_texts(spark):
    from corpus_pipeline import language

    rows = [(1, "a text", None, "s", 6), (2, "12 --", None, "s", 5), (3, None, None, "s", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r) for r in language(spark, df, "").collect()] == rows[:1]
