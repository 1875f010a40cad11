"""Repairs against a shortest-path search over whole conversations, and pieces of any size."""

import hashlib
import heapq
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import repair as R


def cheapest(codes, entry=R.START, goal=R.ACCEPT):
    """Dijkstra over (cost, edits), the ASCII-least first."""
    heap, done = [(0, "", 0, entry)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        end = i == len(codes)
        if end and (state in (0, 3) if goal == R.ACCEPT else state == goal):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        code = "" if end else codes[i]
        given = 3 if state == 2 else 2
        if not end or goal == R.ACCEPT:
            heapq.heappush(heap, (cost + 5, audit + "I", i, given))
        if end:
            continue
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
        if code == "x":
            continue
        more = 5 * code.isupper()
        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, given))
        after = {"s": 1, "u": 2, "a": 3, "o": None}[code.lower()]
        if after and {1: state == 0, 2: state != 2, 3: state == 2}[after]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, after))
    return None


@settings(max_examples=500, deadline=None)
@given(st.text("suaoxSUAO", max_size=14), st.integers(0, 3), st.integers(0, 4))
def test_search(codes, entry, goal):
    assert R.search(codes, entry, goal) == cheapest(codes, entry, goal)


def test_search_long():
    rng = random.Random(1)
    for _ in range(10):
        codes = "".join(rng.choice("uuuaaaxUAos") for _ in range(R.PIECE_ROWS))
        assert R.search(codes) == cheapest(codes)


def damaged(rows):
    """(conv, turn, role, text) after damage."""
    out = []
    for conv, turn, role, text in rows:
        told = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in told[3] if c not in ".!?") if kind == 2 else told[3]
        out += [(conv, turn, "user" if kind == 4 else told[2], text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows, original):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            bare = text.rstrip(R.BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in R.LEGAL for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = cheapest(codes)
        made, state, i = [], 0, 0
        for e in audit:
            if e == "K":
                state = {"s": 1, "u": 2, "a": 3}[own[i][2][0]]
                made.append(f"{own[i][2]}:{own[i][3]}")
            elif e in "RI":
                state = 3 if state == 2 else 2
                made.append(f"{R.ROLES[state]}:{own[i][3] if e == 'R' else ''}")
            i += e != "I"
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", " \t", "", None, "Why? ", "été. ", "same.", "ends\x0b.\n", "漢字", "a\nb."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "", "uncle", "Assistant"]
    rows = []
    for c in [*range(n), None]:
        turn, start = -2, len(rows)
        for k in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 0, 3])
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
            text = rng.choice(texts) if rng.random() < 0.5 else f"{c} {k}{rng.choice(['.', '!', ''])}"
            rows.append((c, None if rng.random() < 0.05 else turn, role, text))
        if rng.random() < 0.2:
            rows.append(rows[start])  # a repeated row
    return rows


@pytest.mark.parametrize(("piece", "longest"), [(256, 8), (5, 40)])
def test_query(spark, tmp_path, monkeypatch, piece, longest):
    from riskloom.llm.queries import op11_conversation_repair

    monkeypatch.setattr(R, "PIECE_ROWS", piece)
    rows = conversations(piece, 60, longest)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, copies_ int, key string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = op11_conversation_repair(spark, str(tmp_path))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(damaged(rows), rows)


def test_texts_and_other_ids(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "tool", "Yo."), ("a", 2, "user", "Bye!"), ("b", None, None, None), ("c", 7, "system", "Be nice.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: r for r in R.repair(df, texts=True).collect()}
    assert [tuple(x) for x in got["a"]["repaired"]] == [("user", "Hi."), ("assistant", "Bye!")] and got["a"]["audit"] == "KDR"
    assert (got["b"]["blank"], got["b"]["audit"], got["b"]["repaired"], got["b"]["repaired_sha256"]) == (1, "D", [], hashlib.sha256().hexdigest())
    assert (got["c"]["cost"], got["c"]["audit"], got["c"]["gaps"]) == (2, "D", 0)
    assert R.repair(df.limit(0)).count() == 0


def test_one_conversation_of_many_rows(spark, monkeypatch):
    """Over all tasks, with long texts and thousands of equal rows."""
    rows = [(7, k, ("user", "assistant")[k % 2 if k % 11 else 0], f"{k}." if k % 5 else "x" * 2000 + "!") for k in range(1500)] + [(7, 3, "user", "again.")] * 2000 + [(8, 0, "user", "y" * 9_000_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    want = brute(rows, rows)
    for most in (64, 256):
        monkeypatch.setattr(R, "PIECE_ROWS", most)
        assert sorted(map(tuple, R.repair(df).collect()), key=repr) == want
