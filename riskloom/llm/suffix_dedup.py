"""Removal of byte strings that repeat in the corpus, by prefix-free parsing.

A string of ``length`` bytes that also starts earlier (smaller document, or earlier in
the same one) is a repeat, and every byte under a repeat goes. The corpus is never
sorted whole:

1. *Parse.* A rolling hash over ``GRAM`` bytes triggers phrases: each window of
   ``length`` bytes belongs to the smallest hash inside it, and neighbouring windows with
   the same trigger make a phrase. Phrases overlap by ``length - 1`` bytes, so every
   window lies whole in its phrase, and equal windows lie in phrases with equal triggers.
2. *Dictionary.* Phrases are shuffled by trigger as two hashes and a position. Of equal
   phrases only the earliest can hold first occurrences: later ones are repeats from end
   to end and never compared again. A phrase whose trigger nothing else shares is clean.
3. *Suffix arrays.* What is left, phrases that share a trigger but differ, is a small
   dictionary. Its texts are shuffled by trigger, and each bucket sorts the suffixes that
   begin a window by their first ``length`` bytes, eight at a time, going on only with ties.
4. *Corpus order.* Suffixes that tie to the end are equal windows; positions in the parse
   order them, and all but the earliest are repeats.

Triggers with over ``crowd`` differing phrases, or over ``hot`` in one batch, say the edges
of a passage in a third of all documents, do not meet in one bucket: their phrases are
sorted where they are, batch by batch, each class of equal windows sends one row, a 128-bit
hash of the window and its earliest position, and classes meet by that hash. So no task
grows with a group of copies, and nothing is broadcast or collected.

Defined cases: null text is empty; texts under ``length`` bytes keep all; equal ids are
ordered by text, and of equal rows all but one are repeats of it; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import buckets, flat, keyed, text_bytes, tidy, tidy_group, with_id
from riskloom.session import materialise

GRAM = 48
LEVEL = 3  # of compression, for what is shuffled packed
LONGEST = 256  # windows in a phrase; longer runs come from periodic text


class Sizes(NamedTuple):
    """Sizes of the work in one task; results don't depend on them."""

    hot: int = 32  # differing phrases of one trigger that a batch sends
    crowd: int = 4096  # differing phrases of one trigger that meet in one task
    stretch: int = 1 << 20  # bytes hashed at a time
    block: int = 1 << 20  # bytes of a batch's dictionary sorted at a time


_RNG = np.random.default_rng(20240229)
_TABLES = _RNG.integers(0, 1 << 63, (3, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F)
_PHRASE = [("g", "<u8"), ("fp", "<u8"), ("u", "<i8"), ("a", "<i8"), ("nw", "<i4"), ("own", "<u1")]  # own: 1 periodic, 2 or 3 of a hot trigger
_PLACE = [("u", "<i8"), ("a", "<i8"), ("nw", "<i4")]
_CLASS = [("hi", "<u8"), ("lo", "<u8"), ("u", "<i8"), ("a", "<i8")]


def _pack(columns: list[np.ndarray], fields: list) -> bytes:
    body = b"".join(np.ascontiguousarray(c, t).tobytes() for c, (_, t) in zip(columns, fields, strict=True))
    return zstandard.compress(body, LEVEL)


def _unpack(blobs, fields: list) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in fields)
    parts = []
    for blob in blobs:
        body, at = zstandard.decompress(blob), 0
        n, part = len(body) // width, []
        for _, t in fields:
            part.append(np.frombuffer(body, t, n, at))
            at += n * np.dtype(t).itemsize
        parts.append(part)
    return [np.concatenate([p[k] for p in parts]) for k in range(len(fields))]


def rolling(data: np.ndarray, length: int, which: int) -> np.ndarray:
    """A 64-bit hash of every ``length`` bytes, from hashes of powers of two."""
    out, done, size = None, 0, 1
    h, n = _TABLES[which][data], len(data) - length + 1
    while True:
        if length & size:
            piece = h[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(pow(_FACTORS[which], size, 1 << 64)) + piece
            done += size
        if size * 2 > length:
            break
        h = h[:-size] * np.uint64(pow(_FACTORS[which], size, 1 << 64)) + h[size:]
        size *= 2
    out ^= out >> np.uint64(31)
    out *= np.uint64(_FACTORS[(which + 1) % 3])
    out ^= out >> np.uint64(29)
    return out


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def phrases(data: np.ndarray, ends: np.ndarray, length: int):
    """Phrases of a stretch of text: trigger hash, first window, number of windows and
    whether the trigger comes twice in it. ``ends``: for each byte, where its document
    ends. Windows that would leave their document are not looked at."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none.astype(bool)
    valid = ends[:n] - np.arange(n) >= length
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none.astype(np.uint64), none, none, none.astype(bool)
    width = length - GRAM + 1
    h = rolling(data, GRAM, 0)
    low = _slide(h, width, np.minimum)
    v = low[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (v[1:] != v[:-1])
    first = np.flatnonzero(new)
    inside = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    first = np.flatnonzero(inside % LONGEST == 0)
    count = np.diff(np.append(first, len(starts)))
    # a gram is a trigger if it is the minimum of some window; two equal neighbours up to width apart share a run: a periodic phrase
    edge = np.zeros(width - 1, np.uint64)
    high = _slide(np.concatenate([edge, np.where(valid, low, 0).astype(np.uint64), edge]), width, np.maximum)
    trigger = np.flatnonzero(h == high[: len(h)])
    twice = np.flatnonzero((h[trigger[1:]] == h[trigger[:-1]]) & (np.diff(trigger) <= width))
    own = np.zeros(len(first), bool)
    if len(twice):
        a = starts[first]
        left, right = trigger[twice] - width, trigger[twice + 1] + 1
        lo, hi = np.searchsorted(a + count, left, "right"), np.searchsorted(a, right, "left")
        size = np.maximum(hi - lo, 0)
        run = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own[run[v[first][run] == np.repeat(h[trigger[twice]], size)]] = True
    return v[first], starts[first], count, own


def _stretches(at: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(first document, last document + 1, first byte, last byte + 1) of about ``limit`` bytes; a
    longer document comes in several stretches."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        if at[j] - at[i] <= limit:
            yield i, j, int(at[i]), int(at[j])
        else:
            for lo in range(int(at[i]), int(at[j]), limit):
                yield i, j, lo, min(lo + limit, int(at[j]))
        i = j


def _parse(length: int, n_buckets: int, sizes: Sizes):
    """Phrases of a batch of documents, packed by bucket of the trigger. Kind 0 is for
    the dictionary, 1 is settled: own = 0 a repeat, 3 to be compared in its batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(1))
            ids, found = np.asarray(batch.column(0)), []
            for i, j, lo, hi in _stretches(at, sizes.stretch):
                stop = min(hi + length - 1, int(at[j]))  # windows that start here may end in the next stretch
                piece = data[lo:stop]
                ends = np.repeat(np.minimum(at[i + 1 : j + 1], stop), np.diff(np.clip(at[i : j + 1], lo, stop))) - lo
                g, a, nw, own = phrases(piece, ends, length)
                view = memoryview(np.ascontiguousarray(piece))
                fp = np.fromiter((xxhash.xxh3_64_intdigest(view[x : x + y]) for x, y in zip(a.tolist(), (nw + length - 1).tolist(), strict=True)), np.uint64, len(a))
                doc = np.searchsorted(at[i : j + 1], a + lo, "right") - 1 + i
                found.append((g, fp, ids[doc], a + lo - at[doc], nw, own))
            if not found:
                continue
            cols = [np.concatenate([f[k] for f in found]) for k in range(6)]
            if not len(cols[0]):
                continue
            cols, settled = _settle(cols, sizes.hot)
            bucket = (cols[0] % np.uint64(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cols, bucket = [c[order] for c in cols], bucket[order]
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            keys = [int(bucket[x]) for x in cut[:-1]]
            blobs = [_pack([c[x:y] for c in cols], _PHRASE) for x, y in zip(cut[:-1], cut[1:], strict=True)]
            kinds = [0] * len(keys)
            if len(settled[0]):
                keys.append(int(settled[0][0] % np.uint64(n_buckets)))
                blobs.append(_pack(settled, _PHRASE))
                kinds.append(1)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "kind", "blob"])

    return run


def _settle(cols: list[np.ndarray], limit: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Phrases to send and phrases settled here, for triggers that are frequent in the batch."""
    g = cols[0]
    _, back, count = np.unique(g, return_inverse=True, return_counts=True)
    hot = count[back] > limit
    if not hot.any():
        return cols, [c[:0] for c in cols]
    rest, cols = [c[~hot] for c in cols], [c[hot] for c in cols]
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    g, fp, u, a, nw, own = (c[order] for c in cols)
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (fp[1:] != fp[:-1])
    repeat = [x[~first] for x in (g, fp, u, a, nw)]
    kept = [x[first] for x in (g, fp, u, a, nw, own)]
    begin = np.flatnonzero(np.diff(kept[0], prepend=~kept[0][:1]) != 0)
    size = np.diff(np.append(begin, len(kept[0])))
    place = np.arange(len(kept[0])) - np.repeat(begin, size)
    many = np.repeat(size, size) > limit
    send = ~many | (place < limit)
    settled = [np.concatenate([x, y[many]]) for x, y in zip(repeat, kept[:5], strict=True)]
    settled.append(np.concatenate([np.zeros(len(repeat[0]), np.uint8), np.full(int(many.sum()), 3, np.uint8)]))
    kept[5] = kept[5] | np.where(many, 2, 0).astype(np.uint8)
    return [np.concatenate([x, y[send]]) for x, y in zip(rest, kept, strict=True)], settled


def _settled_rows(g, u, a, nw, look) -> pa.Table:
    return pa.table({"b": pa.array(((g >> np.uint64(33)) ^ (g & np.uint64(0x7FFFFFFF))).astype(np.int32), pa.int32()), "u": pa.array(u, pa.int64()), "a": pa.array(a, pa.int64()), "nw": pa.array(nw, pa.int32()), "look": pa.array(look, pa.int8())})


def _resolve(table: pa.Table, crowd: int) -> pa.Table:
    """Repeats among the phrases of a bucket (look = 0), phrases to be compared with
    themselves only (1), phrases that share a trigger but differ (2), and those of a
    trigger that too many share (3)."""
    kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
    out = []
    ready = [b for b, k in zip(blobs, kinds, strict=True) if k]
    if ready:
        g, _, u, a, nw, own = _unpack(ready, _PHRASE)
        out.append(_settled_rows(g, u, a, nw, own))
    asked = [b for b, k in zip(blobs, kinds, strict=True) if not k]
    if asked:
        cols = _unpack(asked, _PHRASE)
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        g, fp, u, a, nw, own = (c[order] for c in cols)
        same_g = g[1:] == g[:-1]
        first = np.ones(len(g), bool)
        first[1:] = ~(same_g & (fp[1:] == fp[:-1]))
        begin = np.ones(len(g), bool)
        begin[1:] = ~same_g
        group = np.cumsum(begin) - 1
        texts = np.bincount(group, weights=first)
        hot = (texts > crowd) | (np.bincount(group, weights=own >= 2) > 0)
        look = np.where(texts > 1, np.where(hot, 3, 2), 0)[group]
        look = np.where(look > 0, look, own & 1) * first
        pick = ~first | (look > 0)
        out.append(_settled_rows(g[pick], u[pick], a[pick], nw[pick], look[pick]))
    return pa.concat_tables(out)


def suffix_order(data: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``data`` at ``places`` that tie with another over ``length`` bytes:
    their numbers in ``places`` in suffix order, ties in the order given, and whether each
    is the first of its tie."""
    body = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(body) - 7,), ">u8", body, strides=(1,))
    alive, group = np.arange(len(places)), np.zeros(len(places), np.int64)
    head = np.zeros(0, bool)
    for depth in [*range(0, length - 8, 8), length - 8]:
        word = words[places[alive] + depth].astype(np.uint64)
        order = np.lexsort((word, group)) if depth else np.argsort(word, kind="stable")
        alive, word, group = alive[order], word[order], group[order]
        head = np.ones(len(alive) + 1, bool)
        head[1:-1] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        tied = ~(head[1:] & head[:-1])
        alive, head = alive[tied], head[:-1][tied]
        group = np.cumsum(head)
    return alive, head


def _without(body: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, stretches removed, and bytes kept when first[i]:last[i] go."""
    if not len(first):
        return 0, 0, body.tobytes()
    step = np.zeros(len(body) + 1, np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, last, -1)
    gone = np.cumsum(step[:-1]) > 0
    return int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), body[~gone].tobytes()


_LOOKED = {"kind": pa.int32(), "bucket": pa.int32(), "_u": pa.int64(), "body": pa.binary(), "blob": pa.binary(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}


def _compare(length: int, n_buckets: int, keep: bool, sizes: Sizes):
    """Second look at documents, with their settled phrases. Phrases that differ are sent
    to the bucket of their trigger (kind 3); those of hot triggers are sorted here and
    their classes sent (kind 2); documents that wait for answers go on as they are (kind
    1), the others are cut (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column("body"))
            ids = np.asarray(batch.column("_u"))
            lists = batch.column("runs")
            counts = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, np.int64)
            counts = np.where(np.asarray(lists.is_valid()), counts, 0)
            flat_runs = lists.flatten()
            doc = np.repeat(np.arange(len(ids)), counts)
            a = np.asarray(flat_runs.field("a")).astype(np.int64)
            nw = np.asarray(flat_runs.field("nw")).astype(np.int64)
            look = np.asarray(flat_runs.field("look"))
            spans, asks = [(doc[look == 0], a[look == 0], nw[look == 0])], None
            for kind in (1, 3):
                pick = look == kind
                more, asks = _dictionary(data, at, ids, doc[pick], a[pick], nw[pick], length, sizes.block)
                spans.append(more)
            sent = look == 2
            spans = [np.concatenate(x) for x in zip(*spans, strict=True)]
            order = np.argsort(spans[0], kind="stable")
            spans = [x[order] for x in spans]
            cut = np.searchsorted(spans[0], np.arange(len(ids) + 1))
            waits = np.zeros(len(ids), bool)
            waits[asks[0]] = True
            waits[doc[sent]] = True
            out: dict[str, list] = {name: [] for name in _LOOKED}
            for k in range(len(ids)):
                body = data[at[k] : at[k + 1]]
                first, last = spans[1][cut[k] : cut[k + 1]], spans[1][cut[k] : cut[k + 1]] + spans[2][cut[k] : cut[k + 1]] + length - 1
                if waits[k]:
                    row = (1, None, int(ids[k]), zstandard.compress(body.tobytes(), LEVEL), np.concatenate([first, last]).astype("<i8").tobytes(), None, None, None, None)
                else:
                    n_removed, n_spans, kept = _without(body, first, last)
                    row = (0, None, int(ids[k]), kept if keep else None, None, len(body), n_removed, n_spans, hashlib.sha256(kept).hexdigest())
                for x, v in zip(out.values(), row, strict=True):
                    x.append(v)
            hi, lo = asks[1], asks[2]
            bucket = (hi % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            columns = [hi[order], lo[order], ids[asks[0]][order], asks[3][order]]
            edge = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            for x, y in zip(edge[:-1], edge[1:], strict=True):
                row = (2, int(bucket[x]), None, None, _pack([c[x:y] for c in columns], _CLASS), None, None, None, None)
                for z, v in zip(out.values(), row, strict=True):
                    z.append(v)
            bucket = np.asarray(flat_runs.field("b"))[sent] % n_buckets
            order = np.argsort(bucket, kind="stable")
            bucket, doc, a, nw = bucket[order], doc[sent][order], a[sent][order], nw[sent][order]
            edge = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            for x, y in zip(edge[:-1], edge[1:], strict=True):
                text = zstandard.compress(_gather(data, at[doc[x:y]] + a[x:y], nw[x:y] + length - 1).tobytes(), LEVEL)
                row = (3, int(bucket[x]), None, text, _pack([ids[doc[x:y]], a[x:y], nw[x:y]], _PLACE), None, None, None, None)
                for z, v in zip(out.values(), row, strict=True):
                    z.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[name], t) for name, t in _LOOKED.items()], names=list(_LOOKED))

    return run


def _gather(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``data[first[i]:first[i] + size[i]]``, one after the other."""
    shift = np.repeat(first - (np.cumsum(size) - size), size)
    return data[shift + np.arange(len(shift))]


def _windows(nw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of phrases begin in their joined texts, and in their phrases."""
    inside = np.arange(nw.sum()) - np.repeat(np.cumsum(nw) - nw, nw)
    size = nw + length - 1
    return np.repeat(np.cumsum(size) - size, nw) + inside, inside


def _dictionary(data, at, ids, doc, a, nw, length: int, block: int):
    """Suffix arrays over phrases (document, first window, windows). Returns windows that
    repeat an earlier one of the same block, as (document, start, 1), and one row per
    class: (document, hash, hash, start) of its earliest window."""
    order = np.lexsort((a, ids[doc]))
    doc, a, nw = doc[order], a[order], nw[order]
    if len(doc):  # a phrase may be told twice
        fresh = np.append(True, (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]))
        doc, a, nw = doc[fresh], a[fresh], nw[fresh]
    repeats, asks, size = [], [], nw + length - 1
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(doc):
        j = max(i + 1, int(np.searchsorted(total, total[i] + block, "right")) - 1)
        base, span = at[doc[i:j]] + a[i:j], size[i:j]
        text = _gather(data, base, span)
        place, inside = _windows(nw[i:j], length)
        alive, head = suffix_order(text, place, length)
        of, start = np.repeat(doc[i:j], nw[i:j]), np.repeat(a[i:j], nw[i:j]) + inside
        lead = np.ones(len(place), bool)
        lead[alive[~head]] = False
        repeats.append((of[~lead], start[~lead]))
        hi, lo = (rolling(text, length, w)[place[lead]] for w in (1, 2))
        asks.append((of[lead], hi, lo, start[lead]))
        i = j
    none = np.zeros(0, np.int64)
    repeats = [np.concatenate([r[k] for r in repeats]) if repeats else none for k in range(2)]
    kinds = (np.int64, np.uint64, np.uint64, np.int64)
    asks = [np.concatenate([x[k] for x in asks]) if asks else none.astype(t) for k, t in enumerate(kinds)]
    return (repeats[0], repeats[1], np.ones(len(repeats[0]), np.int64)), asks


def _spans(u: np.ndarray, a: np.ndarray) -> pa.Table:
    """Windows as runs of neighbours."""
    order = np.lexsort((a, u))
    u, a = u[order], a[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (np.diff(a) != 1)
    first = np.flatnonzero(new)
    return pa.table({"u": pa.array(u[first], pa.int64()), "a": pa.array(a[first], pa.int64()), "nw": pa.array(np.diff(np.append(first, len(u))), pa.int64())})


def _answer(length: int):
    def run(table: pa.Table) -> pa.Table:
        """Windows of a bucket that are not the earliest of their class."""
        kinds = table.column("kind").to_pylist()
        blobs = table.column("blob").to_pylist()
        found = []
        hashed = [b for b, k in zip(blobs, kinds, strict=True) if k == 2]
        if hashed:
            found.append(_later(hashed))
        texts = [zstandard.decompress(b) for b, k in zip(table.column("body").to_pylist(), kinds, strict=True) if k == 3]
        if texts:
            u, a, nw = _unpack([b for b, k in zip(blobs, kinds, strict=True) if k == 3], _PLACE)
            nw = nw.astype(np.int64)
            text, size = np.frombuffer(b"".join(texts), np.uint8), nw + length - 1
            order = np.lexsort((a, u))
            text = _gather(text, (np.cumsum(size) - size)[order], size[order])
            u, a, nw = u[order], a[order], nw[order]
            place, inside = _windows(nw, length)
            alive, head = suffix_order(text, place, length)
            later = alive[~head]
            found.append(_spans(np.repeat(u, nw)[later], (np.repeat(a, nw) + inside)[later]))
        return pa.concat_tables(found)

    return run


def _later(blobs: list[bytes]) -> pa.Table:
    hi, lo, u, a = _unpack(blobs, _CLASS)
    order = np.lexsort((a, u, lo, hi))
    hi, lo, u, a = (x[order] for x in (hi, lo, u, a))
    later = np.zeros(len(hi), bool)
    later[1:] = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
    return _spans(u[later], a[later])


def _cut(length: int, keep: bool):
    """Texts that waited, without the bytes under their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [zstandard.decompress(b) for b in batch.column("body").to_pylist()]  # packed by ``_compare``
            lists = batch.column("late")
            sizes = np.where(np.asarray(lists.is_valid()), np.diff(np.asarray(lists.offsets)), 0) if len(lists) else np.zeros(0, np.int64)
            late, cut = lists.flatten(), np.concatenate([[0], np.cumsum(sizes)])
            late_a, late_nw = np.asarray(late.field("a")), np.asarray(late.field("nw"))
            out: list[list] = [[], [], [], [], []]
            for k, blob in enumerate(batch.column("blob").to_pylist()):
                known, body, own = np.frombuffer(blob, "<i8").reshape(2, -1), np.frombuffer(bodies[k], np.uint8), slice(cut[k], cut[k + 1])
                first = np.concatenate([known[0], late_a[own]])
                last = np.concatenate([known[1], late_a[own] + late_nw[own] + length - 1])
                n_removed, n_spans, kept = _without(body, first, last)
                for x, v in zip(out, (kept if keep else None, len(body), n_removed, n_spans, hashlib.sha256(kept).hexdigest()), strict=True):
                    x.append(v)
            columns = ["body", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("_u"), *(pa.array(x, _LOOKED[c]) for x, c in zip(out, columns, strict=True))], names=["_u", *columns])

    return run


def whole_text(kept: str) -> Column:
    """Text of remaining bytes; what is left of a character that was cut in two goes too."""
    decode = lambda bodies: bodies.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))
    return F.pandas_udf(decode, "string", F.PandasUDFType.SCALAR)(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, keep: bool = True, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256, and with
    ``keep`` the remaining bytes as ``kept``."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    rows, plain = keyed(docs, id_col, text_col)
    texts = rows.select("_u", text_bytes(text_col).alias("body"))
    n = buckets(texts, F.length("body"))
    parsed = texts.where(F.length("body") >= length).mapInArrow(tidy(_parse(length, n, sizes)), "bucket int, kind int, blob binary")
    settled = parsed.groupBy("bucket").applyInArrow(tidy_group(lambda t: _resolve(t, sizes.crowd)), "b int, u long, a long, nw int, look byte")
    runs = settled.groupBy(F.col("u").alias("_u")).agg(F.collect_list(F.struct("b", "a", "nw", "look")).alias("runs"))
    schema = "kind int, bucket int, _u long, body binary, blob binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    looked = materialise(texts.join(runs, "_u", "left").mapInArrow(tidy(_compare(length, n, keep, sizes)), schema), "phrases")
    late = looked.where("kind >= 2").select("bucket", "kind", "body", "blob").groupBy("bucket").applyInArrow(tidy_group(_answer(length)), "u long, a long, nw long")
    late = late.groupBy(F.col("u").alias("_u")).agg(F.collect_list(F.struct("a", "nw")).alias("late"))
    out = ["_u", "body", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    done = looked.where("kind = 0").select(*out)
    waited = looked.where("kind = 1").select("_u", "body", "blob").join(late, "_u", "left")
    found = done.unionByName(waited.mapInArrow(tidy(_cut(length, keep)), "_u long, body binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    found = found.withColumnRenamed("body", "kept") if keep else found.drop("body")
    return with_id(found, rows, plain, id_col)
