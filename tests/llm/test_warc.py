"""Round trips, and salvage of damaged archives."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc as W


def expected(rows):
    out = []
    last = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            last[b] = max(last.get(b, p), p)
    for p, u, h in rows:
        b = (h or "").encode()
        ref = last.get(b) if p != last.get(b) else None
        out.append((None if p is None else str(p), u, len(b), hashlib.sha1(b).hexdigest(), "response" if ref is None else "revisit", None if ref is None else str(ref)))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    big = "<p>é" * 300
    rows = [(k, f"http://x.com/{k}", "<html>" + "x" * (k * 50)) for k in range(60)]
    rows += [(60 + k, "http://y.com/", big) for k in range(9)] + [(70, None, None), (71, "http://a/\r\nInjected: 1", ""), (72, "u%0A", "WARC/1.1\r\n\r\n" * 200), (73, "g", "\x1f\x8b\x08" * 400), (5, "http://x.com/5", rows[5][2]), (74, "long", "z" * 3_000_000), (None, "no id", big), (64, "again", big)]
    df = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    W.write_archives(df, f"{tmp_path}/w", file_records=7)
    got = W.read_archives(spark, f"{tmp_path}/w")
    assert got.where("kind = 'gap'").count() == 0
    found = sorted(((None if r["page"] == "null" else r["page"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), key=repr)
    want = [(p, u if u is None else u.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"), *rest) for p, u, *rest in expected(rows)]
    assert found == sorted(want, key=repr)
    for name in (tmp_path / "w").glob("part-*"):  # any gzip reader takes the files
        assert gzip.open(name).read().startswith(b"WARC/1.1\r\n")
    sums = got.where("payload is not null").select("payload_digest", F.sha1("payload").alias("again"))
    assert sums.where("payload_digest <> again").count() == 0


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    W.write_archives(df, f"{tmp_path}/w")
    assert W.read_archives(spark, f"{tmp_path}/w").count() == 0


def records(n):
    made = []
    for k in range(n):
        body = (f"page {k} " * (k + 3)).encode()
        made.append(W.record(str(k), f"u{k}", body, len(body), hashlib.sha1(body).hexdigest(), None))
    return made


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    made = [W._member(r) if packed else r for r in records(12)]
    offsets = [sum(map(len, made[:k])) for k in range(13)]
    whole = b"".join(made)
    assert [(k, a, got["page"]) for k, a, _, got in W.salvage(whole)] == [("record", offsets[k], str(k)) for k in range(12)]
    rng = random.Random(3)
    for _ in range(60):
        hurt, data = rng.randrange(12), bytearray(whole)
        kind = rng.choice(["flip", "cut", "fill"])
        at = rng.randrange(offsets[hurt], offsets[hurt + 1])
        if kind == "flip":
            data[at] ^= 1 << rng.randrange(8)
        elif kind == "cut":
            del data[at : min(at + rng.randrange(1, 30), offsets[hurt + 1])]
        else:
            data[at:at] = b"\x00garbage" * rng.randrange(1, 40)
        out = list(W.salvage(bytes(data)))
        pages = {got["page"] for k, _, _, got in out if k == "record"}
        assert {str(k) for k in range(12)} - pages <= {str(hurt)}
        spans = [(a, b) for _, a, b, _ in out]
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_reasons():
    a, b = records(2)
    for data, reason in [(b"junk" + a, "no version line"), (a[:-3], "no end of record"), (a.replace(b"page 0", b"page 9", 1), "digest"), (a.replace(b"Content-Length: ", b"Content-Length: x", 1), "length"), (a[:40], "colon")]:
        gaps = [g for k, _, _, g in W.salvage(data + b) if k == "gap"]
        assert len(gaps) == 1 and reason in gaps[0], reason


def pages_of(data):
    return [got["page"] for k, _, _, got in W.salvage(data) if k == "record"], [g for k, _, _, g in W.salvage(data) if k == "gap"]


def test_several_records_in_a_member():
    made = records(5)
    assert pages_of(W._member(b"".join(made))) == (["0", "1", "2", "3", "4"], [])
    made[2] = made[2].replace(b"page 2", b"page 7", 1)
    behind = W._member(records(6)[5])
    pages, gaps = pages_of(W._member(b"".join(made)) + behind)
    assert pages == ["0", "1", "3", "4", "5"] and len(gaps) == 1 and "digest" in gaps[0]
    assert pages_of(b"".join(made))[0] == ["0", "1", "3", "4"]


def test_torn_member():
    body = random.Random(1).randbytes(40_000).hex().encode()
    made = records(4) + [W.record("4", None, body, len(body), hashlib.sha1(body).hexdigest(), None)]
    whole, behind = W._member(b"".join(made)), W._member(records(6)[5])
    pages, gaps = pages_of(whole[:-3000])
    assert pages == ["0", "1", "2", "3"] and gaps == ["gzip member without an end"]
    pages, gaps = pages_of(whole[:-3000] + behind)
    assert pages == ["0", "1", "2", "3", "5"] and len(gaps) == 1
    flipped = bytearray(whole)
    flipped[-6] ^= 1  # the checksum alone
    pages, gaps = pages_of(bytes(flipped) + behind)
    assert pages == ["0", "1", "2", "3", "4", "5"] and len(gaps) == 1 and "check" in gaps[0]


def test_long_pages_in_files_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "LONG", 1000)
    monkeypatch.setattr(W, "FILE_BYTES", 5000)
    rows = [(k, "u", random.Random(k).randbytes(1000).hex() if k % 4 == 0 else "s" * k) for k in range(40)]
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w", file_records=10)
    got = {(r["page"], r["payload_bytes"]) for r in W.read_archives(spark, f"{tmp_path}/w").collect()}
    assert got == {(str(k), len(h)) for k, _, h in rows}
    assert len(list((tmp_path / "w").glob("part-*"))) >= 8 and max(f.stat().st_size for f in (tmp_path / "w").glob("part-*")) < 8000
