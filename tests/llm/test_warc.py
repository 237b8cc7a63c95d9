"""WARC round trips against a plain sequential reader, with records and magic inside payloads."""

import base64
import glob
import hashlib
import random

import pytest

from orderlens import stages
from orderlens.llm import queries, warc

FOLDER = "/root/testdata/sf0.01"
LAST = 2**63 - 1


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def plain(pages, least=0):
    """pages: (id, html) as read-back rows."""
    first = {}
    for i, html in pages:
        raw = (html or "").encode()
        first[raw] = min(first.get(raw, LAST), LAST if i is None else i)
    out = []
    for i, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= least and first[raw] < (LAST if i is None else i)
        out.append((i, len(raw), digest(raw), "revisit" if again else "response", first[raw] if again else None))
    return sorted(out, key=str)


def sequential(path):
    """The records of an archive, read one after another."""
    for file in sorted(glob.glob(f"{path}/part-*")):
        raw, at = open(file, "rb").read(), 0
        while at < len(raw):
            head, _, _ = raw[at:].partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(x.split(b": ", 1) for x in lines[1:])
            size = int(fields[b"Content-Length"])
            begin = at + len(head) + 4
            assert raw[begin + size:begin + size + 4] == b"\r\n\r\n"
            yield fields, raw[begin:begin + size]
            at = begin + size + 4


def rows_of(df):
    return sorted(((r.id, r.payload_bytes, r.actual or r.digest, r.kind, r.refers_to) for r in df.collect()), key=str)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op13_warc(spark, FOLDER).collect()), key=str) == plain(pages)


def odd_pages():
    rng = random.Random(13)
    record = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Type: x\r\n"
              "Content-Length: {}\r\n\r\n{}\r\n\r\n")
    fakes = ["WARC/1.1\r\n", "WARC/1.1", "\r\n\r\nWARC/1.1\r\n", record.format(3, "abc"), record.format(3, "abc") * 3,
             record.format(10**6, "too long"), record.format(0, ""), record.format(5, "short"),
             "WARC/1.1\r\nContent-Length: 7\r\nno colon\r\n\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "\r\n\r\n", "\n\n"]
    pages = [(k, "".join(rng.choice(["<p>words</p>", "\r\n", *fakes]) for _ in range(rng.randrange(9)))) for k in range(60)]
    pages += [(200, None), (201, ""), (202, ""), (203, "é😀\x00" * 30), (204, "long " * 2000), (205, "WARC/1.1\r\n" * 300),
              (None, "no id"), (None, "no id"), (206, "no id"), (None, None), (207, "same"), (207, "same"), (3000, "same"),
              (-5, "negative"), (208, "negative"), (209, record.format(10**6, "x") + "y" * 1500)]
    return pages


@pytest.mark.parametrize("split", ["1200", "128m"])
def test_magic_in_payloads(spark, split):
    pages = odd_pages()
    df = spark.createDataFrame([(i, f" http://x/{i} ", h, 0, "clash") for i, h in pages],
                               "page_id long, url string, html string, size int, _digest string").repartition(3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = stages.new_path(spark, "archive")
        warc.write(df, path, per_file=25)
        found = warc.read(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = sorted(((r.id, r.payload_bytes, r.actual or r.digest, r.kind, r.refers_to) for r in found), key=str)
    assert got == plain(pages)
    assert all(r.url == f"http://x/{r.id}" or r.id is None for r in found)
    assert all(r.actual == r.digest for r in found if r.kind == "response")
    told = [(f[b"WARC-Record-ID"], f[b"WARC-Type"].decode(), len(b)) for f, b in sequential(path)]
    assert len(told) == len(pages)
    payloads = sorted(b.split(b"\r\n\r\n", 1)[1] for f, b in sequential(path) if f[b"WARC-Type"] == b"response")
    assert len({*payloads}) == len({h or "" for _, h in pages})


def test_least_bytes_urls_and_empty(spark):
    pages = [(1, "abc"), (2, "abc"), (3, "abcdefgh"), (4, "abcdefgh"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, None if i == 1 else "http://x/a b\r\nInjected: 1", h) for i, h in pages],
                               "page_id long, url string, html string")
    found = warc.round_trip(df, least_bytes=4)
    assert rows_of(found) == plain(pages, 4)
    assert {r.id: r.url for r in found.collect()}[1] is None
    assert {r.id: r.url for r in found.collect()}[2] == "http://x/a b%0D%0AInjected: 1"
    assert warc.round_trip(df.limit(0)).count() == 0


def test_damaged_archive(spark, tmp_path):
    """What follows a damaged record is not reached; a file that begins otherwise gives nothing."""
    df = spark.createDataFrame([(k, None, f"page {k}") for k in range(6)], "page_id long, url string, html string").coalesce(1)
    path = f"{tmp_path}/a"
    warc.write(df.orderBy("page_id"), path)
    (file,) = glob.glob(f"{path}/part-*")
    raw = open(file, "rb").read()
    for n, changed in enumerate((raw.replace(b"page 3", b"page 3 and more"), b"junk" + raw)):
        at = tmp_path / f"b{n}"
        at.mkdir()
        (at / "x.warc").write_bytes(changed)
        assert sorted(r.id for r in warc.read(spark, str(at)).collect()) == ([0, 1, 2, 3] if n == 0 else [])
