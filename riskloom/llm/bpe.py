"""Byte-level BPE encoding and decoding by a rank queue over a hierarchical bitmap.

Pre-tokens are linked lists of parts. For every merge rank there is a bucket of list
positions whose pair has that rank, and a bitmap of ranks that have a bucket, with two
levels of summary words above; find-first-set down the levels gives the next rank in a few
steps. The leftmost position of the bucket is merged, entries that a merge made stale are
skipped, and the new pairs enter their buckets. The cost is n log n for any length, so a
pre-token of a megabyte is no special case. All short pre-tokens of a batch share one queue:
a step takes the next rank's bucket and merges the leftmost position of every pre-token in
it, as arrays.

Ranks are those of a ``.tiktoken`` file; each match of the pattern is encoded on its own,
without special tokens. Pre-tokens are looked up before they are encoded: a task remembers the
results of about ``REMEMBER`` distinct ones and as many met before them. Documents
are cut only where no match of the pattern can reach across: before a blank that follows a
character that is no white space.

Defined cases: null text is empty, has no tokens and decodes to nothing; repeated rows give
repeated results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import portions, small_batches, text_bytes, tidy

PORTION = 8 << 20  # bytes of text cut into stretches at a time
REMEMBER = 400_000
SHORT = 64
#: White space of Unicode, for \s; fixed values.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file (a parameter of the job, on the driver)."""
    with open(path, "rb") as f:
        return _parsed(f.read())


def _parsed(text: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in text.splitlines() if line.strip())}


class RankQueue:
    """Positions by rank, smallest rank first, leftmost position first."""

    def __init__(self, ranks: int) -> None:
        self.levels = []
        while True:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * ranks)
            if ranks <= 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def add(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        for level in self.levels:
            word = level[rank >> 6]
            level[rank >> 6] = word | 1 << (rank & 63)
            if word:
                break
            rank >>= 6

    def pop(self) -> tuple[int, int] | None:
        """The next (rank, position), or None."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return None
            at = at << 6 | (word & -word).bit_length() - 1  # find first set
        bucket = self.buckets[at]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[at]
            bit = at
            for level in self.levels:
                level[bit >> 6] &= ~(1 << (bit & 63))
                if level[bit >> 6]:
                    break
                bit >>= 6
        return at, position


    def fill(self, rank: int, positions: list[int]) -> None:
        """Adds positions to a bucket, in no order."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
        else:
            self.buckets[rank] = positions
            for level in self.levels:
                word = level[rank >> 6]
                level[rank >> 6] = word | 1 << (rank & 63)
                if word:
                    break
                rank >>= 6

    def take(self) -> tuple[int, list[int]] | None:
        """The smallest rank with its whole bucket, or None."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return None
            at = at << 6 | (word & -word).bit_length() - 1
        bit = at
        for level in self.levels:
            level[bit >> 6] &= ~(1 << (bit & 63))
            if level[bit >> 6]:
                break
            bit >>= 6
        return at, self.buckets.pop(at)


class Codec:
    """Encoding and decoding with one set of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.queue = RankQueue(self.size)
        self.pairs: tuple | None = None
        self.bytes = _Spelling(self.tokens, self.size)
        self.decimal = _Spelling({r: b" %d" % r for r in self.tokens}, self.size)
        self.split = regex.compile(pattern.replace(r"[^\s", rf"[^{_SPACE}").replace(r"\s", rf"[{_SPACE}]").replace(r"\S", rf"[^{_SPACE}]"))

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, ranks, queue = len(piece), self.ranks, self.queue
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # rank of the part that starts here with the next one
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                queue.add(rank, i)
        while (found := queue.pop()) is not None:
            rank, i = found
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            end = after[i] = after[j]
            pair[j] = -1
            if end < n:
                before[end] = i
            for a in (before[i], i):
                if a < 0:
                    continue
                b = after[a]
                new = ranks.get(piece[a : after[b]]) if b < n else None
                if new is None:
                    pair[a] = -1
                elif new != pair[a]:
                    pair[a] = new
                    queue.add(new, a)
                # an equal rank is queued already, unless it was just taken
                elif a == i:
                    queue.add(new, a)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of token ids, -1 for none."""
        if self.pairs is None:
            made = {}
            for token, rank in self.ranks.items():
                for k in range(1, len(token)):
                    a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                    if a is not None and b is not None:
                        made[a * self.size + b] = rank
            keys = np.array(sorted(made), np.int64)
            self.pairs = keys, np.array([made[k] for k in keys.tolist()], np.int64)
            self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
            self.doubles = self._pair_ranks(np.repeat(self.single, 256), np.tile(self.single, 256))
        keys, ranks = self.pairs
        want = left * self.size + right
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[at] == want, ranks[at], -1)

    @staticmethod
    def _fill(queue: RankQueue, places: np.ndarray, ranks: np.ndarray) -> None:
        """Adds places by rank, a bucket at a time."""
        if len(ranks) < 8:
            for rank, place in zip(ranks.tolist(), places.tolist(), strict=True):
                queue.fill(rank, [place])
            return
        order = ranks.argsort()
        places, ranks = places[order].tolist(), ranks[order]
        a = 0
        for b in [*((ranks[1:] != ranks[:-1]).nonzero()[0] + 1).tolist(), len(places)]:
            queue.fill(int(ranks[a]), places[a:b])
            a = b

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """``encode_piece`` of each."""
        return [np.frombuffer(b, "<u4").tolist() for b in self.packed(pieces)]

    def packed(self, pieces: list[bytes]) -> list[bytes]:
        """``encode_piece`` of each, over one queue, as little-endian unsigned 32-bit numbers."""
        out: list = [None] * len(pieces)
        short = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) > SHORT:
                out[k] = np.array(self.encode_piece(piece), "<u4").tobytes()
            else:
                short.append(k)
        if not short:
            return out
        size = np.array([len(pieces[k]) for k in short])
        data = np.frombuffer(b"".join(pieces[k] for k in short), np.uint8)
        n, owner, end = len(data), np.repeat(np.arange(len(short)), size), np.cumsum(size)
        self._pair_ranks(np.zeros(0, np.int64), np.zeros(0, np.int64))
        ids = self.single[data]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[end - 1] = -1
        before[end - size] = -1
        pair = np.full(n, -1, np.int64)
        has = np.flatnonzero(after >= 0)
        pair[has] = self.doubles[data[has].astype(np.int64) * 256 + data[has + 1]]
        queue = RankQueue(self.size)
        first = has[pair[has] >= 0]
        self._fill(queue, first, pair[first])
        while (found := queue.take()) is not None:
            rank, places = found
            at = np.array(places)
            at.sort()
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            lead = np.ones(len(at), bool)
            np.not_equal(at[1:], at[:-1], out=lead[1:])  # a place may be queued twice
            if not lead.all():
                at, lead = at[lead], lead[lead]
            np.not_equal(owner[at[1:]], owner[at[:-1]], out=lead[1:])
            if not lead.all():
                queue.fill(rank, at[~lead].tolist())
                at = at[lead]
            gone = after[at]
            ids[at], pair[gone], ids[gone] = rank, -1, -1
            after[at] = after[gone]
            inner = after[at] >= 0
            before[after[at[inner]]] = at[inner]
            pair[at] = -1
            back = before[at]
            new = np.concatenate([at[inner], back[back >= 0]])
            ranks = self._pair_ranks(ids[new], ids[after[new]])
            pair[new] = ranks
            self._fill(queue, new[ranks >= 0], ranks[ranks >= 0])
        alive = ids >= 0
        raw, a = ids[alive].astype("<u4").tobytes(), 0
        for k, b in zip(short, (4 * np.cumsum(np.bincount(owner[alive], minlength=len(short)))).tolist(), strict=True):
            out[k] = raw[a:b]
            a = b
        return out

    def encode(self, text: str) -> list[int]:
        return [r for m in self.split.findall(text) for r in self.encode_piece(m.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Spelling:
    """Byte strings of ids, laid end to end."""

    def __init__(self, words: dict[int, bytes], size: int) -> None:
        self.length = np.zeros(size, np.int64)
        self.length[list(words)] = [len(w) for w in words.values()]
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(words[k] for k in sorted(words)), np.uint8)

    def spell(self, ids: np.ndarray, cut: np.ndarray) -> list[bytes]:
        """The strings of ``ids[cut[k]:cut[k + 1]]`` for every k, each joined."""
        out, at = [], np.concatenate([[0], np.cumsum(self.length[ids])])
        for a in range(0, len(ids), 1 << 17):
            part = ids[a : a + (1 << 17)]
            end = at[a : a + len(part) + 1] - at[a]
            out.append(self.data[np.repeat(self.start[part] - end[:-1], self.length[part]) + np.arange(end[-1])].tobytes())
        body, at = b"".join(out), at[cut].tolist()
        return [body[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class _Memory:
    """Packed ids of pre-tokens in two generations: a full young one becomes the old one, from
    which what is met again comes back. Lives as long as its task."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as pre-tokens, and where each begins."""
        if len(self.ids) > REMEMBER:
            self.old, self.ids = self.ids, {}
        ids, old, fresh = self.ids, self.old, []
        for m in set().union(*texts).difference(ids):
            if m in old:
                ids[m] = old[m]
            else:
                fresh.append(m)
        ids.update(zip(fresh, self.codec.packed([m.encode() for m in fresh]), strict=True))
        raw = [b"".join(map(ids.__getitem__, text)) for text in texts]
        cut = np.concatenate([[0], np.cumsum([len(b) // 4 for b in raw])]).astype(np.int64)
        return np.frombuffer(b"".join(raw), "<u4").astype(np.int64), cut


_CUT = re.compile(r"(?<=\S)(?= )")  # no match of the pattern reaches across


def slices(text: str, size: int) -> list[str]:
    """``text`` cut after ``size`` characters or more, before a blank that follows no white space."""
    out, a = [], 0
    while a < len(text):
        found = _CUT.search(text, a + size) if len(text) > a + size else None
        b = found.start() if found else len(text)
        out.append(text[a:b])
        a = b
    return out


@functools.lru_cache(maxsize=1)
def _codec(text: bytes, pattern: str) -> Codec:
    """Kept by a Python worker from task to task; its size is that of the rank file."""
    return Codec(_parsed(text), pattern)


def _run(rank_text: bytes, pattern: str, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_text, pattern)
        memory, split = _Memory(codec), codec.split.findall
        for batch in portions(batches, PORTION):
            texts = [body.decode() for body in batch.column(batch.num_columns - 1).to_pylist()]
            n = len(texts)
            numbers, own, body, told = [0] * n, [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts], [[] for _ in texts]
            for part in [texts] if n > 1 else [[s] for s in slices(texts[0], PORTION)]:
                found, cut = memory.look_up([split(text) for text in part])
                for k, (a, b, ids_text, bytes_text) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), codec.decimal.spell(found, cut), codec.bytes.spell(found, cut), strict=True)):
                    own[k].update(ids_text[1:] if not numbers[k] else ids_text)  # each id has a blank before it
                    body[k].update(bytes_text)
                    numbers[k] += b - a
                    if ids:
                        told[k] += found[a:b].tolist()
            out = [numbers, [h.hexdigest() for h in own], [h.hexdigest() for h in body], told]
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            made = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = [*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                made.append(pa.array(out[3], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return run


def tokenize(docs: DataFrame, ranks_path: str, pattern: str, columns: list[str], text_col: str = "text", ids: bool = True) -> DataFrame:
    """``columns`` of every document with n_tokens, ids_sha256 (of the decimal ids), the hash
    of what the ids decode to, and with ``ids`` the ids."""
    with open(ranks_path, "rb") as f:
        rank_text = f.read()
    small_batches(docs.sparkSession)
    rows = docs.select(*columns, text_bytes(text_col).alias("_body"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return rows.mapInArrow(tidy(_run(rank_text, pattern, ids)), f"{schema}, {made}")


def detokenize(rows: DataFrame, ranks_path: str, columns: list[str], ids_col: str = "ids") -> DataFrame:
    """``columns`` of every row with ``body``, the bytes of its ids; null ids give null."""
    tokens = {r: t for t, r in read_ranks(ranks_path).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [None if x is None else b"".join(map(tokens.__getitem__, x)) for x in batch.column(batch.num_columns - 1).to_pylist()]
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bodies, pa.binary())], names=[*batch.schema.names[:-1], "body"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)
    return rows.select(*columns, ids_col).mapInArrow(run, f"{schema}, body binary")
