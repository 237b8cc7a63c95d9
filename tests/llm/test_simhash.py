"""Edited fingerprints and the radius search against plain versions."""

import hashlib
import math
import random
from collections import Counter

import pytest
import xxhash

from orderlens.llm import queries, simhash

FOLDER = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    terms = [b" ".join(words[i:i + 2]) for i in range(max(1, len(words) - 1))] if words else []
    votes = [0] * 128
    for t in terms:
        raw = xxhash.xxh3_128_digest(t)
        weight = min(8, 1 + len(t) // 4)
        for side in (0, 1):
            h = int.from_bytes(raw[8 * side:8 * side + 8], "little")
            for b in range(64):
                votes[64 * side + b] += weight if h >> b & 1 else -weight
    return sum(1 << b for b, v in enumerate(votes) if v > 0)


def plain_likeness(a, b):
    d = (a ^ b).bit_count()
    return 1.0 if not d else max(0.0, math.cos(math.pi * d / 128))


def expected(rows):
    """rows: (id, text) in descending order."""
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        f, e, n = (plain_fingerprint(x) for x in (text, edited, after))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{f:032x}", f"{e:032x}",
                    round(plain_likeness(f, e), 9), round(plain_likeness(f, n), 9)))
    return out


def as_rows(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
             round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = queries.op5_simhash_edits(spark, FOLDER).collect()
    want = expected(sorted(docs, reverse=True))
    assert sorted(as_rows(spark.createDataFrame(got))) == sorted(want)
    prints = {w[0]: int(w[3], 16) for w in want}
    for r in got:
        near = sum((prints[r.doc_id] ^ f).bit_count() <= 3 for f in prints.values())
        assert r.n_near == (near if r.doc_id % 20 == 0 else None)
    edits, others = [r.near_edited for r in got if r.n_chars > 300], [r.near_next for r in got if r.n_chars > 300]
    assert sum(edits) / len(edits) > 0.6 and sum(others) / len(others) < 0.2


@pytest.mark.parametrize("partitions", ["1", "4", "9"])
def test_odd_rows(spark, partitions, tmp_path):
    rows = [(5, None), (9, ""), (2, "one"), (40, "two words"), (7, "long word " * 50000), (100, "é😀" * 40),
            (60, "same text of some words"), (61, "same text of some words"), (-3, "negative id here")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lo string, hi int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for part in (rows, rows[:1], []):
            df.filter(df.doc_id.isin([r[0] for r in part])).write.parquet(str(tmp_path / f"{len(part)}/documents.parquet"))
            got = as_rows(queries.op5_simhash_edits(spark, str(tmp_path / str(len(part)))))
            assert sorted(got) == sorted(expected(sorted(part, reverse=True)) if part else [])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "d e f"), (3, "x y"), (3, "x y"), (3, "z")], "doc_id long, text string")
    got = simhash.fingerprints_with_neighbours(df).collect()
    assert Counter(r._id for r in got) == {None: 2, 3: 3}


@pytest.mark.parametrize("radius", [0, 3, 5])
def test_radius_search(spark, radius):
    rng = random.Random(2)
    prints = [rng.getrandbits(128) for _ in range(30)]
    for f in list(prints):
        for k in (1, 2, 3, 4, 5, 8, 9):
            prints.append(f ^ sum(1 << b for b in rng.sample(range(128), k)))
    prints += prints[:5]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(f >> 64), signed(f & 2**64 - 1)) for f in prints], "hi long, lo long")
    got = {((r.hi % 2**64) << 64) | (r.lo % 2**64): r.n_near for r in simhash.within(df, df, radius).collect()}
    assert got == {f: sum((f ^ g).bit_count() <= radius for g in prints) for f in prints}
