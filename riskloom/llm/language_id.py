"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads a word (a stretch without white space, with a blank at either end) byte
by byte in both directions and gives every byte a probability for each language; states
start anew at each word, so a word counts once per task however often it occurs. A
document's probabilities are the mean over all bytes of all its words.

Training is numpy, by backpropagation through time, on the driver, over a bounded sample of
every language: ``docs_per_lang`` of its labelled documents (expected number, picked by a
hash of id and text, at least one), whose words are cut into pieces of ``PIECE`` bytes; of
the distinct pieces of each language an equal share of ``max_pieces``, though no less than
``least_pieces``, comes to the driver, again picked by hash. Held-out rows never train.

Defined cases: null text, or no letter: ``und`` with score 0; null languages and ids train
and predict like others (a null language never trains); without any labelled row all are
``und``; a language whose labelled texts are all blank is not learned; words over ``PIECE``
bytes are read in pieces; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from riskloom.llm.common import portions, small_batches, text_bytes, tidy
from riskloom.session import materialise

PIECE = 30
REMEMBER = 250_000  # words whose result a task keeps
WIDE = 64  # with more languages than this, fewer words and rows are held at a time
SLOTS = 1 << 30
BLANK = 32


@dataclass
class Network:
    """Weights of both directions and of the output, and the languages in order."""

    langs: list[str]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _start(langs: list[str], hidden: int, rng: np.random.Generator) -> Network:
    w = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, 0.1, (256, 3 * hidden)).astype(np.float32)
        w[f"u{d}"] = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        w[f"b{d}"] = np.zeros(3 * hidden, np.float32)
    w["o"] = (rng.normal(0, 1, (2 * hidden, len(langs))) / np.sqrt(2 * hidden)).astype(np.float32)
    w["c"] = np.zeros(len(langs), np.float32)
    return Network(langs, w)


def _gru(x: np.ndarray, mask: np.ndarray, w: dict, d: str, keep: bool = True):
    """States after each byte, in reading order. x: (time, batch) bytes; padding holds the state."""
    u, b, hidden = w[f"u{d}"], w[f"b{d}"], w[f"u{d}"].shape[0]
    h, states, trace = np.zeros((x.shape[1], hidden), np.float32), [], []
    for t in range(len(x)):
        a = w[f"x{d}"][x[t]] + b
        g = h @ u
        zr = _sigmoid(a[:, : 2 * hidden] + g[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        n = np.tanh(a[:, 2 * hidden :] + r * g[:, 2 * hidden :])
        m = mask[t][:, None]
        if keep:
            trace.append((h, z, r, n, g[:, 2 * hidden :]))
        h = np.where(m, n + z * (h - n), h)
        states.append(h)
    return np.stack(states), trace


def _gru_back(x, mask, w, d, trace, grad_states, grads) -> None:
    """Adds the gradients of one direction, last byte first."""
    u, hidden = w[f"u{d}"], w[f"u{d}"].shape[0]
    dh = np.zeros_like(grad_states[0])
    for t in reversed(range(len(x))):
        h, z, r, n, gn = trace[t]
        m = mask[t][:, None]
        dh = dh + grad_states[t]
        dn = np.where(m, dh * (1 - z) * (1 - n * n), 0)
        dz = np.where(m, dh * (h - n) * z * (1 - z), 0)
        dr = dn * gn * r * (1 - r)
        da = np.concatenate([dz, dr, dn], 1)
        dg = np.concatenate([dz, dr, dn * r], 1)
        np.add.at(grads[f"x{d}"], x[t], da)
        grads[f"b{d}"] += da.sum(0)
        grads[f"u{d}"] += h.T @ dg
        dh = np.where(m, dh * z, dh) + dg @ u.T


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, batch) bytes, what is no padding, and what is no blank around a word."""
    size = np.array([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    x = np.full((int(size.max()) + 2, len(words)), BLANK, np.uint8)
    col = np.repeat(np.arange(len(words)), size)
    row = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size) + 1
    x[row, col] = data
    t = np.arange(len(x))[:, None]
    return x, t < size + 2, (t > 0) & (t <= size)


def _reverse(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Every column back to front, its padding still behind."""
    size = mask.sum(0)
    t = np.arange(len(x))[:, None]
    return np.take_along_axis(x, np.where(t < size, size - 1 - t, t).reshape((len(x), -1) + (1,) * (x.ndim - 2)), 0)


def _positions(net: Network, words: list[bytes], keep: bool):
    x, mask, inner = _padded(words)
    xr = _reverse(x, mask)
    hf, tf = _gru(x, mask, net.weights, "f", keep)
    hr, tb = _gru(xr, mask, net.weights, "b", keep)
    both = np.concatenate([hf, _reverse(hr, mask)], 2)
    return x, xr, mask, inner, both, tf, tb, _softmax(both @ net.weights["o"] + net.weights["c"])


def train(langs: list[str], words: list[bytes], labels: np.ndarray, counts: np.ndarray, hidden: int = 24, steps: int = 500, batch: int = 384, seed: int = 11) -> Network:
    """Adam over batches of words, drawn by the root of their counts, languages evenly."""
    rng = np.random.default_rng(seed)
    net = _start(langs, hidden, rng)
    share = np.sqrt(counts)
    share = share / np.bincount(labels, share, len(langs))[labels]
    share /= share.sum()
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        pick = rng.choice(len(words), min(batch, len(words)), p=share)
        x, xr, mask, inner, both, tf, tb, p = _positions(net, [words[i] for i in pick], True)
        grad = p.copy()
        grad[:, np.arange(len(pick)), labels[pick]] -= 1
        grad *= (inner / inner.sum())[:, :, None]
        grad = grad.astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in net.weights.items()}
        grads["o"] = np.tensordot(both, grad, ((0, 1), (0, 1)))
        grads["c"] = grad.sum((0, 1))
        back, half = grad @ net.weights["o"].T, both.shape[2] // 2
        _gru_back(x, mask, net.weights, "f", tf, back[:, :, :half], grads)
        _gru_back(xr, mask, net.weights, "b", tb, _reverse(back[:, :, half:], mask), grads)
        rate = 0.01 * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def word_sums(net: Network, words: list[bytes]) -> np.ndarray:
    """For each word: probabilities summed over its bytes, and its number of bytes."""
    pieces = [(i, w[k : k + PIECE]) for i, w in enumerate(words) for k in range(0, len(w), PIECE)]
    pieces.sort(key=lambda p: len(p[1]))
    out = np.zeros((len(words), len(net.langs) + 1))
    some = max(1, 4096 * WIDE // max(WIDE, len(net.langs)))
    for k in range(0, len(pieces), some):
        part = pieces[k : k + some]
        *_, inner, _, _, _, p = _positions(net, [w for _, w in part], False)
        owner = np.array([i for i, _ in part])
        np.add.at(out[:, :-1], owner, (p * inner[:, :, None]).sum(0))
        np.add.at(out[:, -1], owner, inner.sum(0))
    return out


def _up_to(hashed: str, n: int, groups: list[Row]) -> Column:
    """Whether ``hashed`` is among about ``n`` of its language's ``count``; its ``least`` always is."""
    limits = [F.when(F.col("lang") == r["lang"], F.lit(max(r["least"] + 1, -(-SLOTS * n // r["count"])))) for r in groups]
    while len(limits) > 1:  # a shallow tree
        limits = [F.coalesce(*limits[k : k + 16]) for k in range(0, len(limits), 16)]
    return F.col(hashed) < limits[0]


def fit(docs: DataFrame, train_rows: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_lang: int = 400, max_pieces: int = 30_000, least_pieces: int = 250, **options) -> Network | None:
    """The network for the rows of ``docs`` that ``train_rows`` picks; None without any."""
    slot = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SLOTS))
    sizes = [F.count(F.lit(1)).alias("count"), F.min("h").alias("least")]
    rows = docs.where(train_rows).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), slot(F.col(id_col).cast("string"), F.col(text_col)).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"[^\x09-\x0D ]"))
    found = rows.groupBy("lang").agg(*sizes).collect()
    if not found:
        return None
    words = rows.where(_up_to("h", docs_per_lang, found)).select("lang", F.explode(F.split("text", r"[\x09-\x0D ]+").cast("array<binary>")).alias("word")).where(F.length("word") > 0)
    cuts = F.transform(F.sequence(F.lit(1), F.length("word"), F.lit(PIECE)), lambda k: F.substring(F.col("word"), k, F.lit(PIECE)))
    pieces = words.select("lang", F.explode(cuts).alias("piece")).groupBy("lang", "piece").count()
    pieces = materialise(pieces.withColumn("h", slot("lang", "piece")), "pieces")
    share = max(least_pieces, max_pieces // len(found))
    sample = pieces.where(_up_to("h", share, pieces.groupBy("lang").agg(*sizes).collect())).orderBy("h", "lang", "piece").collect()
    langs = sorted(r["lang"] for r in found)
    place = {lang: k for k, lang in enumerate(langs)}
    labels, counts = np.array([place[r["lang"]] for r in sample]), np.array([r["count"] for r in sample], float)
    return train(langs, [bytes(r["piece"]) for r in sample], labels, counts, **options)


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


class _Sums:
    """``word_sums`` of words in two generations: a full young one becomes the old one, from
    which what is met again comes back."""

    def __init__(self, net: Network, most: int) -> None:
        self.net, self.most, self.width = net, most, len(net.langs) + 1
        self.old: tuple[dict, np.ndarray] = {}, np.zeros((0, self.width))
        self.place: dict[bytes, int] = {}
        self.table = np.empty((1024, self.width))

    def learn(self, words: set[bytes]) -> None:
        """Puts every word into the young generation."""
        if len(self.place) > self.most:
            self.old = self.place, self.table
            self.place, self.table = {}, np.empty((1024, self.width))
        before, rows = self.old
        fresh = words.difference(self.place)
        again = [w for w in fresh if w in before]
        new = list(fresh.difference(again))
        at = len(self.place)
        end = at + len(fresh)
        if end > len(self.table):
            table = np.empty((max(end, 2 * len(self.table)), self.width))
            table[:at] = self.table[:at]
            self.table = table
        self.table[at : at + len(again)] = rows[[before[w] for w in again]]
        if new:
            self.table[at + len(again) : end] = word_sums(self.net, new)
        self.place.update(zip([*again, *new], range(at, end), strict=True))


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = max(WIDE, len(net.langs) if net else 0)
        sums = _Sums(net, REMEMBER * WIDE // wide) if net else None
        for batch in portions(batches):
            bodies, lettered = batch.column("body").to_pylist(), batch.column("lettered").to_pylist()
            counts = [Counter(b.split()) if ok and net else Counter() for b, ok in zip(bodies, lettered, strict=True)]
            if sums:
                sums.learn(set().union(*counts))
                seen, table = sums.place, sums.table
            langs, scores = [], []
            for c in counts:
                if not c:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                at = np.fromiter(map(seen.__getitem__, c), np.int64, len(c))
                total = np.fromiter(c.values(), np.float64, len(c)) @ table[at]
                best = int(total[:-1].argmax())
                langs.append(net.langs[best])
                scores.append(min(1.0, float(total[best] / total[-1])))
            rest = [batch.column(k) for k in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-2], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, net: Network | None, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of every document with lang_pred and score."""
    small_batches(docs.sparkSession)
    kept = docs.select(*columns).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    rows = docs.select(*columns, has_letter(text_col).alias("lettered"), text_bytes(text_col).alias("body"))
    return rows.mapInArrow(tidy(_predict(net)), f"{schema}, lang_pred string, score double")
