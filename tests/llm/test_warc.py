import hashlib
import io
import uuid
import zlib

import pytest

from visitmart.llm import warc as m

BIG = "x" * 200


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows],
                                 "page_id long, url string, html string, arc string, offset int")


ROWS = [(5, "http://a/ b?q=é", BIG), (3, "http://c/", BIG), (9, None, BIG), (9, None, BIG), (1, "http://d/", None),
        (2, "http://d/\n2", ""), (4, "u", "x" * 99), (6, "u", "x" * 99), (7, "v", "é" * 50 + "\r\n\r\nzz"),
        (8, "v", "é" * 50 + "\r\n\r\nzz"), (None, "n", BIG), (10, "w", "long " * 200000)]


def brute(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, (True, 0)), (p is None, p or 0))
    out, seen = [], set()
    for p, _, h in rows:
        b = (h or "").encode()
        lead = first.get(b)
        if lead is None or (lead == (p is None, p or 0) and b not in seen):
            seen.add(b)
            out.append((p, len(b), hashlib.sha256(b).hexdigest(), "response", None))
        else:
            out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit", lead[1]))
    return sorted(out, key=str)


def test_round_trip(spark):
    assert sorted(map(tuple, m.warc_round_trip(pages(spark, ROWS)).collect()), key=str) == brute(ROWS)


def test_empty(spark):
    assert m.warc_round_trip(pages(spark, [])).collect() == []


def test_payloads_and_headers_survive(spark, tmp_dir):
    arcs = m.write_arcs(pages(spark, ROWS).repartition(1), f"{tmp_dir}/arc", file_bytes=400)
    assert arcs.count() > 2                      # several files, so both versions
    got = m.read_warcs(m.convert(arcs, f"{tmp_dir}/warc")).collect()
    want = {p: h or "" for p, _, h in ROWS}
    for r in got:
        assert uuid.UUID(r.record_id[10:-1]) and r.date == "2020-01-01T00:00:00Z"
        if r.record_type == "response":
            assert r.html == want[r.page_id]
        else:
            assert r.refers_to_id in {x.record_id for x in got if x.record_type == "response"}
    assert {r.target for r in got if r.page_id == 5} == {"http://a/%20b?q=%C3%A9"}


@pytest.mark.parametrize("version", [1, 2])
def test_declared_length_rules(tmp_dir, version):
    """A payload that looks like a header line does not start a record."""
    block = m.http_block(b"http://x/ 0.0.0.0 20200101000000 text/html 5\nabc", 1)
    path = m.write_file(tmp_dir, ".arc.gz", [
        m.member(m.arc_header("n.arc", version, "20200101000000")),
        m.member(m.arc_record(version, "http://y/", "19991231235959", block, 9, "n.arc"))])
    (_, fields, got), = m.read_arc(path)
    assert got == block and fields["Archive-date"] == "19991231235959" and fields["URL"] == "http://y/"


def test_broken_archives_are_errors(tmp_dir):
    path = m.write_file(tmp_dir, ".arc.gz", [m.member(m.arc_header("n", 1, "20200101000000")),
                                             m.member(b"http://y/ 0 20200101000000 text/html 50\nshort\n")])
    with pytest.raises(ValueError):
        list(m.read_arc(path))


def test_members_across_reads():
    data = [bytes([i]) * (i * 1000 + 1) for i in range(5)]
    raw = b"".join(map(m.member, data))
    got = list(m.members(io.BytesIO(raw), chunk=7))
    assert [x for _, x in got] == data and zlib.decompress(raw[got[1][0]:got[2][0]], 31) == data[1]
