"""WARC archives: round trip, revisits, and salvage of damaged files."""

import gzip
import hashlib
import io
import os
import random

import pytest

from unfurl.llm import warc
from unfurl.llm.common import table


def brute(rows):
    rows = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, b in rows:
        same = [q for q, c in rows if c == b and q is not None]
        revisit = len(b) >= 1000 and same and p != max(same)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def test_whole_table(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url", "html")
    more = pages.unionByName(pages.where("page_id % 3 = 0").selectExpr("page_id + 100000 AS page_id", "url", "html"))
    got = sorted((tuple(r) for r in warc.warc_report(more).collect()), key=str)
    assert got == brute([tuple(r) for r in more.collect()])
    assert any(r[3] == "revisit" for r in got)


def test_odd_rows(spark):
    long = "é" * 600
    rows = [(1, None, long), (2, "http://a/b c\r\nX: y", long), (2, "u", long), (None, "n", long), (3, "u", ""), (4, "u", None), (5, "u", "x" * 999), (6, "u", "x" * 999), (None, "z", "y" * 2000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    got = sorted((tuple(r) for r in warc.warc_report(pages).collect()), key=str)
    assert got == brute(rows)
    assert warc.warc_report(pages.limit(0)).count() == 0


def members(n, zipped=True):
    rng, out = random.Random(n), []
    for i in range(n):
        body = bytes(rng.randrange(256) for _ in range(rng.choice([0, 10, 3000]))) + b"WARC/1.1\r\n\x1f\x8b\x08" * (i % 3)
        rec = warc.record(i, f"http://x/{i}", body, hashlib.sha1(body).hexdigest(), len(body), None, "response")
        out.append(gzip.compress(rec, mtime=0) if zipped else rec)
    return out


def salvage(data):
    return list(warc.Salvage(io.BytesIO(data), len(data)).read())


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_recovers_all_other_records(zipped):
    rng = random.Random(7)
    parts = members(30, zipped)
    whole = salvage(b"".join(parts))
    assert [x[0] for x in whole] == ["record"] * 30
    for _ in range(60):
        i = rng.randrange(30)
        bad = bytearray(parts[i])
        how = rng.choice(["flip", "cut", "junk", "zero"])
        if how == "flip":
            bad[rng.randrange(12, len(bad) - 8)] ^= 1 << rng.randrange(8)
        elif how == "cut":
            bad = bad[:rng.randrange(1, len(bad) - 5)]
        elif how == "zero":
            bad[:12] = bytes(12)
        else:
            bad = bytearray(b"\x1f\x8b\x08 no member WARC/1.0\r\n no record") + bad
        data = b"".join(parts[:i]) + bytes(bad) + b"".join(parts[i + 1:])
        got = salvage(data)
        ids = {warc._id(x[3]["warc-record-id"]) for x in got if x[0] == "record"}
        assert set(range(30)) - {i} <= ids, (how, i)
        assert ids <= set(range(30)) or (how == "flip" and not zipped)  # nothing guards a plain header
        spans = [(x[1], x[2]) for x in got]  # records and gaps tile the file
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        if how != "flip":
            assert any(x[0] == "gap" for x in got)


def test_very_long_urls(spark):
    rows = [(1, "http://x/" + "a" * 70_000, "one"), (2, "http://x/" + " " * 30_000, "two"), (3, "u" * 600_000, "z" * 5000), (4, "u", "z" * 5000), (5, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((tuple(r) for r in warc.warc_report(pages).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_of_very_long_headers(zipped):
    parts = []
    for i, n in enumerate([5, 70_000, warc.READ_BYTES - 300, warc.READ_BYTES, 3 * warc.READ_BYTES, 5]):
        rec = warc.record(i, "u" * n, b"body", hashlib.sha1(b"body").hexdigest(), 4, None, "response")
        parts.append(gzip.compress(rec, mtime=0) if zipped else rec)
    got = salvage(b"".join(parts))
    assert [(x[0], warc._id(x[3]["warc-record-id"])) for x in got] == [("record", i) for i in range(6)]
    for n in range(warc.READ_BYTES - 320, warc.READ_BYTES - 280):  # the end of the headers across the end of a read
        rec = warc.record(9, "u" * n, b"", hashlib.sha1(b"").hexdigest(), 0, None, "response")
        assert [x[0] for x in salvage(rec + parts[0] if not zipped else gzip.compress(rec, 1) + parts[0])] == ["record"] * 2


def test_headers_that_do_not_end_cost_only_themselves():
    parts = members(3, False)
    data = parts[0] + b"WARC/1.1\r\nA: " + b"x" * (2 * warc.READ_BYTES) + b"\r\n" + parts[1] + parts[2] + b"WARC/1.1\r\nB: y"
    got = salvage(data)
    assert [x[0] for x in got] == ["record", "gap", "record", "record", "gap"]
    assert [x[3] for x in got if x[0] == "gap"] == ["malformed header", "headers do not end"]


def test_a_gap_is_an_error_where_archives_must_be_whole(spark, tmp_dir):
    parts = members(4)
    path = os.path.join(tmp_dir, "a.warc.gz")
    with open(path, "wb") as f:
        f.write(parts[0] + parts[1][:-9] + parts[2])
    with pytest.raises(Exception, match="has a gap from byte"):
        warc.read_warc(spark.createDataFrame([(path,)], "path string"), whole=True).collect()


def test_damaged_archive_through_spark(spark, tmp_dir):
    parts = members(20)
    path = os.path.join(tmp_dir, "a.warc.gz")
    with open(path, "wb") as f:
        f.write(b"".join(parts[:5]) + parts[5][:-9] + b"".join(parts[6:]) + b"tail")
    got = warc.read_warc(spark.createDataFrame([(path,)], "path string")).collect()
    assert sorted(r.page_id for r in got if r.gap_reason is None) == [i for i in range(20) if i != 5]
    assert len([r for r in got if r.gap_reason]) == 2 and all(r.payload_ok for r in got if r.gap_reason is None)
