"""Content-defined chunks against a byte-by-byte version, and what is removed."""

import hashlib
import random

from orderlens.llm import chunks, queries

FOLDER = "/root/testdata/sf0.01"


def plain_ends(text):
    """One byte after another, with the rolling hash kept in a variable."""
    ends, last, h = [], 0, 0
    wanted = []
    for i, b in enumerate(text):
        h = (2 * h + int(chunks.GEAR[b])) & 0xFFFF
        if i >= 15 and h >> (16 - chunks.MASK_BITS) == 0 and (i + 1 == len(text) or text[i + 1] & 0xC0 != 0x80):
            wanted.append(i + 1)
    for c in [*wanted, len(text)]:
        while c - last > chunks.MOST:
            last += chunks.MOST
            while text[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if c - last >= chunks.LEAST or (c == len(text) and c > last):
            ends.append(c)
            last = c
    return ends


def plain(docs, min_run=72):
    first, out = {}, {}
    parts = {}
    for doc in sorted(docs):
        raw = (docs[doc] or "").encode()
        ends = plain_ends(raw)
        parts[doc] = (raw, list(zip([0, *ends], ends)))
        for a, b in parts[doc][1]:
            first.setdefault(raw[a:b], doc)
    for doc, (raw, own) in parts.items():
        spans = []
        for a, b in own:
            if first[raw[a:b]] != doc:
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        spans = [s for s in spans if s[1] - s[0] >= min_run]
        kept = bytearray(raw)
        for a, b in reversed(spans):
            del kept[a:b]
        out[doc] = (len(raw), len(own), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.op4_chunk_dedup(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_chunks, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == plain(docs)


def test_passages_resist_insertions(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    own = lambda n: " ".join(word() for _ in range(n))
    passages = [own(55) for _ in range(20)]
    docs = [(i, f"{own(rng.randrange(90))} {passages[i % 20]} {own(rng.randrange(90))}") for i in range(100)]
    clean = [(1000 + i, own(150)) for i in range(50)]
    got = {r._id: sum(s.stop - s.start for s in r.spans)
           for r in chunks.dedup_chunks(spark.createDataFrame(docs + clean, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i, _ in docs[:20] + clean)
    assert sum(got[i] > 0 for i, _ in docs[20:]) >= 76
    assert sum(got[i] for i, _ in docs[20:]) > 0.55 * sum(len(passages[i % 20]) for i, _ in docs[20:])


def test_odd_rows(spark):
    text = "".join(chr(0x4e00 + i % 3000) for i in range(500))
    rows = [(1, None), (2, ""), (3, text), (4, text), (4, "other text of the same id"), (None, text), (5, "a" * 100000),
            (6, "b" + "a" * 100000), (3, text)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, kept string, pos int")
    got = sorted(((r._row.doc_id, len(r.kept), r._row.kept) for r in chunks.dedup_chunks(df).collect()), key=str)
    kept = {(d, n) for d, n, _ in got}
    assert len(got) == 9 and {(1, 0), (2, 0), (3, 500), (4, 0), (4, 25), (None, 0), (5, 100000)} <= kept
    assert all(c == "clash" for *_, c in got)
    assert chunks.dedup_chunks(df.limit(0)).count() == 0
