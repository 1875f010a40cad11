"""Packing documents into sequences of a fixed size by minimum bin slack.

A document is the ids of its text and an end id; one longer than the size is cut into pieces
of the size, of which the last may be shorter. Pieces of one length are alike, so bins are
planned over the number of pieces of each length, a table of at most ``size`` rows however
large the corpus, which is all that reaches the driver. A bin starts with the greatest length
left (its slack can only be filled by others); a subset-sum dynamic program over the lengths
left, longest first and with their numbers, holds the sums within reach as bits of one
integer and stops at the first that leaves no slack, or takes the greatest sum. The combination
is removed as often as the numbers allow, so a plan has a few bins per length.

Pieces are dealt to the plan by their rank among the pieces of their length. A task counts
its own pieces of a length as it makes them, and a running sum over tasks adds those of the
tasks before it: a length that a third of all pieces have is spread over all tasks.

Defined cases: null text is empty and has the end id alone; repeated rows, equal and null ids
each get their own pieces; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import portions, small_batches, text_bytes, tidy
from riskloom.llm.words import WordEncoder
from riskloom.session import materialise

SIZE = 4096


def _fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of the combination with the greatest sum within ``room``."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, take = left - take, 2 * take
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return sorted(used.items(), reverse=True)


def plan_bins(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as ([(length, times in the bin), longest first], number of such bins) for
    ``counts``, the number of pieces of each length from 1 to ``size``."""
    left, bins = dict(counts), []
    while left:
        longest = max(left)
        rest = {x: n - (x == longest) for x, n in left.items() if x != longest or n > 1}
        used = dict(_fullest(rest, size - longest))
        used[longest] = used.get(longest, 0) + 1
        number = min(left[x] // k for x, k in used.items())
        bins.append((sorted(used.items(), reverse=True), number))
        for x, k in used.items():
            left[x] -= k * number
            if not left[x]:
                del left[x]
    return bins


def _places(bins: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Per bin kind and length: length, first rank, times in a bin, first sequence, offset."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for used, number in bins:
        offset = 0
        for length, times in used:
            rows.append((length, ranks.get(length, 0), times, sequence, offset))
            ranks[length] = ranks.get(length, 0) + times * number
            offset += length * times
        sequence += number
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _cut(json_text: str, end_id: int, size: int, spelled: bool, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder(json_text, spelled), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(size + 1, np.int64)
        for batch in portions(batches):
            bodies = batch.column(1).to_pylist()
            coded = [b + end for b in ([encoder.encode_long(bodies[0])] if len(bodies) == 1 else encoder.encode(bodies))]
            pieces = [(k, a // (4 * size), b[a : a + 4 * size]) for k, b in enumerate(coded) for a in range(0, len(b), 4 * size)]
            owner, number, raw = zip(*pieces, strict=True)
            length = np.array([len(b) // 4 for b in raw], np.int64)
            order = np.argsort(length, kind="stable")
            first = np.flatnonzero(np.diff(length[order], prepend=0))
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(first, np.diff(first, append=len(length)))
            nth += seen[length]
            seen += np.bincount(length, minlength=size + 1)
            made = {
                "piece": pa.array(number, pa.int32()),
                "start": pa.array([n * size for n in number], pa.int64()),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(b) for b in raw], pa.int64()),
                "part": pa.array(np.full(len(length), part, np.int64)),
                "nth": pa.array(nth),
            }
            if keep:
                made["ids"] = pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in raw], pa.list_(pa.int64()))
            keys = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *made.values()], names=[batch.schema.names[0], *made])

    return run


def _deal(places: np.ndarray, most: int):
    """Sequence and offset of pieces by (length, rank)."""
    keys = places[:, 0] * (most + 1) + places[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            row = places[np.searchsorted(keys, length * (most + 1) + rank, "right") - 1]
            within = rank - row[:, 1]
            sequence, offset = row[:, 3] + within // row[:, 2], row[:, 4] + within % row[:, 2] * length
            kept = [n for n in batch.schema.names if n != "rank"]
            columns = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", spelled: bool = False, ids: bool = True) -> DataFrame:
    """Per piece: ``id_col``, piece, start (ids of its document before it), length, ids_crc32,
    sequence_id, offset (place in the sequence) and with ``ids`` the ids themselves."""
    with open(tokenizer_path, encoding="utf-8") as f:
        json_text = f.read()
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    told = ", ids array<bigint>" if ids else ""
    rows = docs.select(id_col, text_bytes(text_col).alias("_body"))
    pieces = materialise(rows.mapInArrow(tidy(_cut(json_text, end_id, size, spelled, ids)), f"{schema}, part bigint, nth bigint{told}"), "pieces")
    numbers = materialise(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in numbers.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = numbers.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "part"])
    columns = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    places = _places(plan_bins(counts, size))
    dealt = ranked.select(*columns, (F.col("before") + F.col("nth")).alias("rank"))
    return dealt.mapInArrow(_deal(places, max(counts.values(), default=0)), f"{schema}{told}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence of ``pack``: sequence_id, ids. A sequence has at most as many
    pieces as it has places."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))
