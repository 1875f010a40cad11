"""Runs of periodic words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(6, 4 q)`` that no neighbouring word extends. Runs of period q are looked for at the
dyadic scale t <= q < 2 t. Each window of t words has a hash; place i belongs to the set of
that scale if the smallest hash of the windows from i to i + t is that of the first or of the
last of them. Whether a place belongs depends on its 2 t words alone, so equal contexts are
chosen alike, and every t places in a row hold one unless all their windows are highly
periodic (period of at most t / 4). Such windows lie in runs found at lower scales; they are
left out of the set, and their small periods come from there. Within a run of period q a
place is chosen among the first t, and the next place with an equal context is exactly q
away: the pair proposes the period. Proposals are compared word by word and extended, so
hashes choose places and propose, and equality of words decides.

Documents are independent: rows are read where they are scanned, with no shuffle, by
portions of bytes; a longer text is a portion of its own.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text;
repeated rows give repeated results; a null id is kept and its text never planted; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import portions, small_batches, text_bytes, tidy

SHORTEST, EXPONENT = 6, 4
_NONE = np.uint64(2**64 - 1)
#: Odd multipliers of a 64-bit finaliser.
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _synchronising(ident: np.ndarray, t: int, periodic: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places of the set at scale ``t``; ``last`` is where each place's document ends."""
    order = np.where(periodic, _NONE, ident)
    low, wide = order, 1
    while wide < t:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    low = np.minimum(low[:-1], low[1:])  # over t + 1 windows
    size = len(low)
    chosen = ((low == order[:size]) | (low == order[t:])) & (low != _NONE)
    chosen &= np.arange(2 * t, size + 2 * t) <= last[:size]
    return np.flatnonzero(chosen)


def _extended(words: np.ndarray, at: np.ndarray, places: np.ndarray, periods: np.ndarray) -> list[np.ndarray]:
    """Maximal stretches (start, length, period) around the proposals, of 4 periods or more."""
    doc = np.searchsorted(at, places, "right") - 1
    order = np.lexsort((places, periods, doc))
    doc, periods, places = doc[order], periods[order], places[order]
    cut = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(periods, prepend=-1))
    out = []
    for a, b in zip(cut, [*cut[1:], len(doc)], strict=True):
        q, s, e = int(periods[a]), int(at[doc[a]]), int(at[doc[a] + 1])
        edge = np.flatnonzero(np.diff(words[s : e - q] == words[s + q : e], prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        mine = np.unique(np.searchsorted(starts, places[a:b] - s, "right") - 1)
        length = ends[mine] - starts[mine] + q
        long = length >= EXPONENT * q
        out.append(np.stack([starts[mine][long] + s, length[long], np.full(int(long.sum()), q)], 1))
    return out


def find_runs(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of documents laid end to end, by start and
    period. ``words`` are numbers that tell words apart, ``at`` where each document begins
    (one more entry than documents)."""
    size = np.diff(at)
    last = np.repeat(at[1:], size)
    found = np.zeros((0, 3), np.int64)
    ident, t = _mix((words.astype(np.uint64) + np.uint64(1)) * _A), 1
    while len(size) and EXPONENT * t <= size.max():
        twice = _mix(ident[:-t] * _A + ident[t:])
        mark = np.zeros(len(ident) + 1, np.int32)
        small = found[(4 * found[:, 2] <= t) & (found[:, 1] >= t)]
        np.add.at(mark, small[:, 0], 1)
        np.add.at(mark, small[:, 0] + small[:, 1] - t + 1, -1)
        places = _synchronising(ident, t, np.cumsum(mark[:-1]) > 0, last)
        context = twice[places]
        order = np.argsort(context, kind="stable")
        equal = context[order[1:]] == context[order[:-1]]
        here, there = places[order[:-1]][equal], places[order[1:]][equal]
        apart = there - here
        fits = (apart >= t) & (apart < 2 * t) & (there < last[here])
        if fits.any():
            found = np.concatenate([found, *_extended(words, at, here[fits], apart[fits])])
        ident, t = twice, 2 * t
    found = found[found[:, 1] >= SHORTEST]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def strongest(runs: np.ndarray) -> int | None:
    """The row with the greatest exact length / period; ties: smallest start, then period."""
    if not len(runs):
        return None
    ratio = runs[:, 1] / runs[:, 2]
    near = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9))
    return int(min(near, key=lambda k: (-Fraction(int(runs[k, 1]), int(runs[k, 2])), runs[k, 0], runs[k, 2])))


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """Which original word each of ``n`` words becomes, None where the text is left as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    source = np.arange(n)
    source[a:] = a + (source[a:] - a) % p
    return source


def _run(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            known: dict[bytes, int] = {}
            texts, coded = [], []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = body.split()
                codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
                source = planted(key, len(words)) if plant else None
                if source is not None:
                    words, codes = [words[k] for k in source.tolist()], codes[source]
                texts.append(words)
                coded.append(codes)
            at = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
            runs = find_runs(np.concatenate(coded), at)
            mark = np.zeros(at[-1] + 1, np.int64)
            np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
            np.add.at(mark, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(mark[:-1]) == 0
            cut = np.searchsorted(runs[:, 0], at)
            lists, tops, bodies = [], [], []
            for k, words in enumerate(texts):
                own = runs[cut[k] : cut[k + 1]] - [at[k], 0, 0]
                rows = [{"start": s, "length": n, "period": q} for s, n, q in own.tolist()]
                lists.append(rows)
                top = strongest(own)
                tops.append(None if top is None else rows[top])
                if rows:
                    words = [words[i] for i in np.flatnonzero(kept[at[k] : at[k + 1]]).tolist()]
                bodies.append(b" ".join(words))
            one = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
            made = [pa.array(np.diff(at)), pa.array(lists, pa.list_(one)), pa.array(tops, one), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[batch.schema.names[0], "n_words", "runs", "top", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Per row: ``id_col``, n_words, ``runs`` by start and period, ``top`` (the run with the
    greatest exponent, null without runs) and ``collapsed``, the bytes of the words left when
    each run keeps its first period, joined by one space. With ``plant`` a tenth of the texts,
    told by a hash of the id, is first made periodic from some word on, to be found again."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    one = "struct<start:bigint,length:bigint,period:bigint>"
    rows = docs.select(id_col, text_bytes(text_col).alias("_body"))
    return rows.mapInArrow(tidy(_run(plant)), f"`{id_col}` {kind}, n_words bigint, runs array<{one}>, top {one}, collapsed binary")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What ``periodic_runs`` gave, with digests in place of lists and texts."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    runs = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    milli = F.expr("1000 * top.length div top.period")
    return found.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        milli.alias("exponent_milli"),
        F.sha2(runs, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
