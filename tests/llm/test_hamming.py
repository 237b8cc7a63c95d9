"""SimHash near-dedup against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderlens.llm import graph, hamming, queries

FOLDER = "/root/testdata/sf0.01"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    ids = [i for i, _ in rows]
    fps = np.array([f for _, f in rows], np.uint64)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    for a, b in zip(*np.nonzero(near)):
        x, y = sorted((root(ids[a]), root(ids[b])))
        parent[y] = x
    return {i: root(i) for i in ids}


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: fingerprint(r.text) for r in docs}
    got = queries.op7_simhash_near(spark, FOLDER).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{v:016x}" for k, v in want.items()}
    assert {r.doc_id: r.component_id for r in got} == brute(sorted(want.items()))


@pytest.mark.parametrize("tile", [4096, 3])
def test_links_of_chains_and_stars(spark, tile):
    """Chains of near fingerprints, all at the radius or one beyond, in tiny and large tiles."""
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(9):
            fps.add(f)
            for b in rng.sample(range(64), rng.choice((3, 3, 4))):
                f ^= 1 << b
    fps |= {0, 1, 3, 2**64 - 1}
    rows = [(i, f) for i, f in enumerate(sorted(fps, key=lambda f: f * 7919 % 2**61))]
    classes = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for i, f in rows], "fp long, _id long")
    found = {r.node: r.root for r in graph.components(hamming.links(classes, 3, tile)).collect()}
    assert {i: found.get(i, i) for i, _ in rows} == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, None), (4, ""), (9, " \n"), (2, text), (7, text.upper()), (7, text), (None, "alone in here now"),
            (3, "two words"), (8, "long " * 60000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fp string, component int")
    got = sorted(((r._id, r.component) for r in hamming.near_groups(df).collect()), key=str)
    assert got == sorted([(5, 4), (4, 4), (9, 4), (2, 2), (7, 2), (7, 2), (None, None), (3, 3), (8, 8)], key=str)
    assert hamming.near_groups(df.limit(0)).count() == 0
