"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the set of its five-word shingles (words: lower case, letters and digits; a
text of fewer words is one shingle), or with ``weighting="count"`` the multiset. A
signature is found by throwing darts: every element owns a region, its weight by a rank
range, cut into cells of area one; a hash of (element, weight band, rank cell) says how many
darts lie in the cell (Poisson), and a hash of each dart gives its rank, its weight and one
of ``k`` coordinates. Darts above the element's weight miss; the earliest rank in each
coordinate is kept. Only about k log k darts are thrown, whatever the number of elements:
the rank range is (k log k + 2k) over the total weight, doubled where a coordinate is empty.

Two sets agree in a coordinate with the probability of their (weighted) Jaccard similarity.
Bands of coordinates are joined, and every pair is verified by exact Jaccard similarity:

1. Documents with equal words collapse to one; only that goes on.
2. In each band bucket all members are compared with one leader, the member that shares the
   most buckets, and verified links are closed to classes.
3. Buckets that then still hold several classes are split. If a is not similar enough to the
   leader, every b that is similar enough to a shares with it elements in which both
   differ from the leader (without one, J(a, b) <= J(a, leader)); ``_needed`` says how
   many. So members meet again in one bucket per leader and differing element, of which
   each enters only its rarest, as many as a pair with that many in common cannot miss.
   Buckets get new leaders; what is then still in another class than the largest of its
   bucket is compared with those of all other classes there that its place in the order
   of elements does not rule out (see ``_left``). Leaders of at most ``FEW`` members
   have all members of different classes compared.

So links inside a class are not all listed, but none that could join two classes is lost,
and the work grows with the members of a bucket, not with its pairs. No bucket is collected:
all steps are aggregations and joins that Spark can split.

Defined cases: null or wordless texts are alone in their class; repeated rows and ids are
copies; the class is the smallest id (of the first row in order of id, text); other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import keyed, text_bytes, tidy
from riskloom.session import materialise

BANDS, ROWS = 24, 5
FEW = 24
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Chances that a cell of area one holds at most 0, 1, 2 ... darts, scaled to 32 bits.
_POISSON = (np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, i + 1, dtype=float))) for i in range(12)]) * 2**32).astype(np.uint64)
#: Separators become blanks, A-Z lower case.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(words: list[bytes], cache: dict, n: int = 5) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order, repeats included."""
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    if not n:
        return h
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * _M1 + h[k : len(h) - n + 1 + k]
    return _mix(out + np.uint64(n))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(documents, k) ids of the earliest darts. Every document must have an element."""
    best = np.full((n_docs, k), np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(doc, weight, n_docs)
    reach = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300)
    open_docs = np.ones(n_docs, bool)
    while open_docs.any():
        pick = open_docs[doc]
        _throw(doc[pick], element[pick], weight[pick], reach, best, k)
        open_docs = (best == np.iinfo(np.uint64).max).any(1) & (total > 0)
        best[open_docs] = np.iinfo(np.uint64).max
        reach = np.where(open_docs, reach * 2, reach)
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _throw(doc, element, weight, reach, best, k: int) -> None:
    """Darts of all elements, the earliest of each coordinate into ``best``: rank in the
    upper half (whole ranks above 18 bits of fraction), the dart's id in the lower."""
    band, low = 0, 0.0
    flat_best = best.reshape(-1)
    while len(doc):
        wide = max(1.0, low)  # bands of weight: 0-1, 1-2, 2-4, 4-8 ...
        cells = np.ceil(reach[doc] * wide).astype(np.int64)
        for lo, hi in _parts(cells, 1 << 20):
            size = cells[lo:hi]
            owner = np.repeat(np.arange(lo, hi), size)
            cell = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            seed = _mix(element[owner] + np.uint64((band + 1) * int(_M1) & (1 << 64) - 1) + cell.astype(np.uint64) * _M3)
            darts = np.searchsorted(_POISSON, seed >> np.uint64(32), "right")
            owner, cell, seed = np.repeat(owner, darts), np.repeat(cell, darts), np.repeat(seed, darts)
            order = np.arange(len(owner)) - np.repeat(np.cumsum(darts) - darts, darts)
            seed = _mix(seed + (order.astype(np.uint64) + np.uint64(1)) * _M1)
            more = _mix(seed + _M2)
            rank = (cell + (seed >> np.uint64(40)) / 2.0**24) / wide
            height = low + wide * ((more >> np.uint64(40)) / 2.0**24)
            hit = (height < weight[owner]) & (rank <= reach[doc[owner]])
            spot = doc[owner[hit]] * k + (((seed[hit] & np.uint64(0xFFFFFF)) * np.uint64(k)) >> np.uint64(24)).astype(np.int64)
            value = ((rank[hit] * 2**14).astype(np.uint64) << np.uint64(32)) | (more[hit] & np.uint64(0xFFFFFFFF))
            np.minimum.at(flat_best, spot, value)
        low, band = low + wide, band + 1
        left = weight > low
        doc, element, weight = doc[left], element[left], weight[left]


def _parts(size: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    total, i = np.concatenate([[0], np.cumsum(size)]), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        yield i, j
        i = j


def _sketch(bands: int, rows: int, n: int, weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                if len(cache) > 500_000:
                    cache.clear()
                keys, elements, weights = [], [], []
                for body in batch.column(1).to_pylist():
                    words = body.translate(WORD_BYTES).split()
                    found, count = np.unique(shingles(words, cache, n), return_counts=True)
                    keys.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                    elements.append(found)
                    weights.append(count.astype(float) if weighting == "count" else np.ones(len(found)))
                size = np.array([len(e) for e in elements])
                full = np.flatnonzero(size)
                joined = [[] for _ in range(len(size))]
                if len(full):
                    doc = np.repeat(np.arange(len(full)), size[full])
                    sig = signatures(doc, np.concatenate(elements), np.concatenate(weights), len(full), bands * rows).astype(np.uint64).reshape(len(full), bands, rows)
                    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _M2, sig.shape[:2])
                    for r in range(rows):
                        key = _mix(key * _M1 + sig[:, :, r])
                    for k, i in enumerate(full):
                        joined[i] = key[k].view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(joined, pa.list_(pa.int64()))], names=["u", "words", "bands"])

    return run


def _sets(n: int, weighting: str):
    """Sorted shingle hashes, and their counts, of each document as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in batches:
            out: list[list[bytes]] = [[], []]
            for body in batch.column(1).to_pylist():
                if len(cache) > 500_000:
                    cache.clear()
                found, count = np.unique(shingles(body.translate(WORD_BYTES).split(), cache, n), return_counts=True)
                out[0].append(found.tobytes())
                out[1].append(count.astype(np.uint32).tobytes() if weighting == "count" else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["u", "items", "counts"])

    return run


def jaccard(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> float:
    """Of sorted distinct elements with counts; no counts: of sets."""
    at = np.searchsorted(b, a)
    same = (at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a)
    if not len(na):
        common = int(same.sum())
        return common / (len(a) + len(b) - common)
    common = int(np.minimum(na[same], nb[at[same]]).sum())
    return common / (int(na.sum()) + int(nb.sum()) - common)


def _verify(at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("items", "counts", "items2", "counts2")]
            ok = [
                jaccard(np.frombuffer(a, np.uint64), np.frombuffer(na, np.uint32), np.frombuffer(b, np.uint64), np.frombuffer(nb, np.uint32)) >= at_least
                for a, na, b, nb in zip(*cols, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return run


def _needed(differ: int, size: int, leader: int, open_: bool, t: float) -> int:
    """Least number of elements in which a set of ``size`` elements, ``differ`` of them
    unlike its leader's, and any set of another class with a similarity of ``t`` both
    differ from the leader. At least one of the two is open, not similar to the leader.

    Sets A, B are similar when the elements in only one of them are at most
    c (|A| + |B|), c = (1 - t) / (1 + t). These are the elements in which just one differs
    from the leader L, so both differ in at least (dA + dB - c (|A| + |B|)) / 2. With
    dB > c (|B| + |L|), B being open, that is more than (dA - c |A| + c |L|) / 2. An open
    A may also meet a B that is not: dB is at least what both differ in, and |B| at most
    |A| / t, which leaves dA - c |A| (1 + 1 / t).
    """
    c = (1 - t) / (1 + t)
    need = (differ - c * size + c * leader) / 2
    if open_:
        need = min(need, differ - c * size * (1 + 1 / t))
    return max(1, int(np.ceil(need - 1e-6)))


def _differ(at_least: float):
    """Elements in which two sets, or their counts, differ, how many of them another class
    must share, their number and the size of the set; of counted elements one must be
    shared, and the sizes are 0: they tell nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, need, size = [], [], []
            for a, na, b, nb, open_ in zip(*(batch.column(c).to_pylist() for c in ("items", "counts", "items2", "counts2", "open")), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if na:
                    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                    same = both[np.frombuffer(na, np.uint32)[i] == np.frombuffer(nb, np.uint32)[j]]
                    out.append(np.setdiff1d(np.union1d(x, y), same, assume_unique=True).view(np.int64))
                    need.append(1)
                    size.append((0, 0))
                else:
                    out.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                    need.append(_needed(len(out[-1]), len(x), len(y), open_, at_least))
                    size.append((len(out[-1]), len(x)))
            numbers = [pa.array(x, pa.int64()) for x in (need, [d for d, _ in size], [n for _, n in size])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("u", "v", "degree", "label", "open")), *numbers, pa.array(out, pa.list_(pa.int64()))],
                names=["u", "v", "degree", "label", "open", "need", "differ", "size", "elements"],
            )

    return run


def closed(links: DataFrame) -> DataFrame:
    """(u, label): the smallest vertex that each vertex of ``links`` (u, v) reaches.

    Every round, each vertex takes the smallest label around it, and then its label's
    label, so that the rounds grow with the logarithm of a class's width."""
    both = materialise(links.select("u", "v").union(links.select("v", "u")).distinct(), "links")
    labels = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("u").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next").select("u", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved"))
        step = materialise(step, "labels")
        labels = step.select("u", "label")
        if step.where("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, at_least: float = 0.8, weighting: str = "set", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id_col``, class_id (smallest id of the class), class_size and links_checked of every document.
    The last are the links of the document's text that were verified to close its class, not
    all it has: in a large class most texts were only compared with a leader."""
    table, plain = keyed(docs, id_col, text_col)
    texts = table.select(F.col("_u").alias("u"), text_bytes(text_col).alias("body"))
    sketch = materialise(texts.mapInArrow(tidy(_sketch(bands, rows, words, weighting)), "u long, words binary, bands array<long>"), "sketch")
    heads = sketch.where("words is not null").groupBy("words").agg(F.min("u").alias("u"), F.first("bands").alias("bands"))
    heads = materialise(heads, "heads")
    member = heads.select("u", F.explode("bands").alias("band"))
    full = member.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # A list of at most `bands` buckets each, so that a member knows its degree without a join.
    own = member.join(full, "band").groupBy("u").agg(F.sum("n").alias("degree"), F.collect_list("band").alias("shared"))
    own = materialise(own, "shared")
    member = own.select("u", "degree", F.explode("shared").alias("band"))
    sets = texts.join(own.select("u").hint("merge"), "u", "left_semi").mapInArrow(tidy(_sets(words, weighting)), "u long, items binary, counts binary")
    sets = materialise(sets, "sets")
    tried = materialise(_led(member, "band").select("u", "v", "degree").distinct(), "pairs")
    links = materialise(_verified(tried, sets, at_least), "verified")
    labels = closed(links)
    few, parts = _parted(tried, labels, sets, at_least)
    tried = tried.select("u", "v")
    led = _led(parts, "bucket")
    for step in (lambda: few.union(_across(led, labels)), lambda: _left(parts, labels, at_least)):
        asked = step().select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        known = tried.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        asked = materialise(asked.join(known, ["u", "v"], "left_anti"), "pairs")
        more = materialise(_verified(asked, sets, at_least), "verified")
        tried = tried.union(asked)
        if not more.isEmpty():
            links = materialise(links.union(more), "verified")
            labels = closed(links)
    ends = links.select("u").union(links.select(F.col("v").alias("u"))).groupBy("u").agg(F.count("*").alias("links_checked"))
    known = heads.select("words", "u").join(labels, "u", "left").join(ends, "u", "left").select("words", F.coalesce("label", "u").alias("label"), F.coalesce("links_checked", F.lit(0)).alias("links_checked"))
    placed = sketch.select("u", "words").join(known, "words", "left").select(F.col("u").alias("_u"), F.coalesce("label", "u").alias("_first"), F.coalesce("links_checked", F.lit(0)).cast("long").alias("links_checked"))
    sizes = placed.groupBy("_first").agg(F.count("*").alias("class_size"))
    found = placed.join(sizes, "_first")
    if plain:
        kind = docs.schema[id_col].dataType
        return found.select(F.col("_u").cast(kind).alias(id_col), F.col("_first").cast(kind).alias("class_id"), "class_size", "links_checked")
    ids = table.select("_u", id_col)
    out = ids.join(found, "_u")
    return out.join(ids.select(F.col("_u").alias("_first"), F.col(id_col).alias("class_id")), "_first").select(id_col, "class_id", "class_size", "links_checked")


def _led(members: DataFrame, key: str) -> DataFrame:
    """Members of each bucket with its leader, v, the one of the highest degree; the leader
    itself is left out."""
    ranked = members.groupBy(key).agg(F.max(F.struct("degree", (-F.col("u")).alias("minus"))).alias("top"))
    return members.join(ranked.select(key, (-F.col("top.minus")).alias("v")), key).where("u <> v")


def _labelled(state: DataFrame, labels: DataFrame) -> DataFrame:
    """``state`` with the class of the member and whether the leader is in another."""
    named = state.join(labels, "u", "left").withColumn("label", F.coalesce("label", "u"))
    named = named.join(labels.select(F.col("u").alias("v"), F.col("label").alias("led")), "v", "left")
    return named.withColumn("open", F.col("label") != F.coalesce("led", "v")).drop("led")


def _across(state: DataFrame, labels: DataFrame) -> DataFrame:
    return _labelled(state.select("u", "v").distinct(), labels).where("open").select("u", "v")


def _parted(state: DataFrame, labels: DataFrame, sets: DataFrame, at_least: float) -> tuple[DataFrame, DataFrame]:
    """Of leaders v whose members u are in several classes: all pairs of different classes
    where the members are few, else the members by differing element (bucket, u)."""
    named = _labelled(state, labels)  # with the members' degrees
    mixed = named.groupBy("v").agg(F.max("open").alias("mixed"), F.count("*").alias("n")).where("mixed")
    rest = materialise(named.join(mixed.select("v", "n"), "v"), "mixed")
    small = rest.where(F.col("n") <= FEW).select("v", "u", "label")
    other = small.select("v", F.col("u").alias("w"), F.col("label").alias("other"))
    few = small.join(other, "v").where("u < w AND label <> other").select("u", F.col("w").alias("v"))
    large = rest.where(F.col("n") > FEW).select("u", "v", "degree", "label", "open")
    parts = _with_sets(large, sets).mapInArrow(tidy(_differ(at_least)), "u long, v long, degree long, label long, open boolean, need long, differ long, size long, elements array<long>")
    parts = parts.select("v", "u", "degree", "label", "open", "need", "differ", "size", F.explode("elements").alias("element"))
    parts = materialise(parts.select(F.xxhash64("v", "element").alias("bucket"), "v", "u", "degree", "label", "open", "need", "differ", "size"), "parts")
    alive = parts.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("open").alias("open"), F.count("*").alias("n")).where("a <> b AND open")
    # A member's own elements make up a window, so it is no longer than its text.
    own = Window.partitionBy("v", "u")
    rarest = parts.drop("open").join(alive.select("bucket", "n"), "bucket")
    rarest = rarest.withColumn("rank", F.row_number().over(own.orderBy("n", "bucket"))).withColumn("all", F.count("*").over(own))
    behind = (F.col("all") - F.col("rank")).alias("behind")
    return few, materialise(rarest.where("rank <= `all` - need + 1").select("bucket", "u", "degree", "differ", "size", behind).distinct(), "members")


def _left(parts: DataFrame, labels: DataFrame, at_least: float) -> DataFrame:
    """Pairs of different classes that are still in one bucket, one of them outside its
    largest class, and that can be similar.

    Sets that differ from the leader in dA and dB elements, k of them shared, differ from
    each other in dA + dB - 2 k; similar ones in at most c (|A| + |B|). All members have
    their elements in one order, so in the first bucket that two share, k is at most one
    more than what the shorter rest ``behind`` it holds."""
    c = (1 - at_least) / (1 + at_least)
    named = parts.join(labels, "u", "left").select("bucket", "u", "differ", "size", "behind", F.coalesce("label", "u").alias("label"))
    sizes = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
    mixed = materialise(named.join(largest.select("bucket", F.col("top.label").alias("major")), "bucket"), "left")
    minor = mixed.where("label <> major").select("bucket", *(F.col(x).alias(y) for x, y in (("u", "v"), ("label", "other"), ("differ", "differ2"), ("size", "size2"), ("behind", "behind2"))))
    possible = 2 * (1 + F.least("behind", "behind2")) >= F.col("differ") + F.col("differ2") - c * (F.col("size") + F.col("size2")) - 1e-6
    return minor.join(mixed, "bucket").where(possible & (F.col("label") != F.col("other"))).select("u", "v")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    other = sets.select(F.col("u").alias("v"), F.col("items").alias("items2"), F.col("counts").alias("counts2"))
    return pairs.join(sets, "u").join(other, "v")


def _verified(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    both = _with_sets(pairs, sets).select("u", "v", "items", "counts", "items2", "counts2")
    return both.mapInArrow(tidy(_verify(at_least)), "u long, v long")
