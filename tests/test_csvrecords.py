"""Records with line breaks inside quotes, cut at every byte."""

import os
import random
from dataclasses import replace

import pytest

from conftest import d, rows
from visitmart.sources import csvrecords
from visitmart.sources.csvload import LoadSpec, decoded, load_csv, read_fields, with_options

SPEC = LoadSpec(fields=("a", "b", "ed"), target=("a", "b", "day"), dates={"day": ("ed", "%m/%d/%Y")}, multiline=True)
FILES = {
    "one.csv": 'x,"two\r\nlines, ""q""",1/2/2024\r\n"","\r\n\r\n",1/3/2024\r\n5" pipe,no "quotes" here,1/4/2024\r\n\r\n'
               '"a\nb\nc\nd\ne","""",1/5/2024\r\nplain,row,1/6/2024\r\n',
    "two.csv": 'caf\xe9 “x”,"\n",2/2/2024\nlast,"no\nend",2/3/2024',
    "three.csv": 'p,"""\n""",3/1/2024\n"q"tail,r,3/2/2024\n,"\n\n\n\n\n",3/3/2024\n"open at the\nend of the file',
}


def _write(folder):
    os.makedirs(folder)
    for name, text in FILES.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(text.encode("cp1252"))


def _whole(text: bytes) -> list[bytes]:
    """Records by one walk over the characters of a whole file."""
    out, cur, quoted, fresh, i = [], b"", False, True, 0
    while i < len(text):
        c = text[i:i + 1]
        if quoted and c == b'"' and text[i + 1:i + 2] == b'"':
            cur, i = cur + b'""', i + 2
            continue
        if quoted:
            quoted = c != b'"'
        elif c == b'"' and fresh:
            quoted = True
        if c == b"\n" and not quoted:
            out.append(cur)
            cur, fresh = b"", True
        else:
            cur += c
            fresh = c == b"," and not quoted
        i += 1
    out = [r[:-1] if r.endswith(b"\r") else r for r in out + [cur]]
    return sorted(r for r in out if r)


@pytest.mark.parametrize("size", [1, 3, 40, 100_000])
def test_records_cut_at_every_byte_equal_the_whole_file(spark, tmp_dir, size):
    _write(f"{tmp_dir}/in")
    want = sorted(r for t in FILES.values() for r in _whole(t.encode("cp1252")))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        n = csvrecords._lines(spark, f"{tmp_dir}/in").rdd.getNumPartitions()
        got = sorted(bytes(r.record) for r in csvrecords.records(spark, f"{tmp_dir}/in").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want
    assert size > 1 or n == sum(len(t.encode("cp1252")) for t in FILES.values())


def test_fields_equal_the_reader_of_whole_files(spark, tmp_dir):
    _write(f"{tmp_dir}/in")
    whole = decoded(with_options(spark.read, SPEC).csv(f"{tmp_dir}/in"), SPEC)
    got = rows(read_fields(spark, f"{tmp_dir}/in", SPEC), "a", "b", "ed")
    # The reader of whole files turns CR LF inside quotes into LF; here the bytes stay, as in the loader.
    assert [tuple(v and v.replace("\r\n", "\n") for v in r) for r in got] == rows(whole, "a", "b", "ed")


def test_load_with_line_breaks(spark, tmp_dir):
    _write(f"{tmp_dir}/in")
    out = rows(load_csv(spark, f"{tmp_dir}/in", replace(SPEC)).rows)
    assert ("x", 'two\r\nlines, "q"', d(2024, 1, 2)) in out
    assert ("caf\xe9 “x”", "\n", d(2024, 2, 2)) in out


def test_lines_end_as_a_walk_over_characters_says():
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice('",a') for _ in range(rnd.randrange(9))).encode()
        for inside in (False, True):
            quoted, fresh, i = inside, True, 0
            while i < len(text):
                c = text[i:i + 1]
                if quoted and text[i:i + 2] == b'""':
                    i += 2
                    continue
                if quoted:
                    quoted = c != b'"'
                elif c == b'"' and fresh:
                    quoted = True
                fresh = c == b"," and not quoted
                i += 1
            assert csvrecords.inside_after(text, inside) == quoted, (text, inside)


def test_no_files_of_content(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    open(f"{tmp_dir}/in/empty.csv", "w").close()
    assert csvrecords.records(spark, f"{tmp_dir}/in").count() == 0
