"""Suffix-array dedup against a set of all 50-byte strings, and the suffix order against sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import queries, suffix

FOLDER = "/root/testdata/sf0.01"


def plain(docs, length=50):
    """docs: (id, bytes); rows of one id are one document."""
    least, out = {}, []
    for doc, raw in sorted(docs, key=lambda d: d[0]):
        for i in range(len(raw) - length + 1):
            least.setdefault(raw[i:i + length], doc)
    for doc, raw in docs:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if least[raw[i:i + length]] < doc:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_query(spark):
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op6_suffix_dedup(spark, FOLDER).collect())) == plain(docs)


def test_pieces():
    """Each window of each text is in one piece, short and long texts together."""
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 49, 50, 51, 299, 300, 349, 350, 2000)]
    seen = [(i, at + k) for who, offset, part in suffix.pieces(texts, 50, 300)
            for i, at, own in zip(who, offset, part) for k in range(len(own) - 49)]
    assert sorted(seen) == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 49)]


@pytest.mark.parametrize("chunk, hot", [(8_000_000, 4096), (2_000, 4096), (1, 0), (9_000, 3)])
def test_odd_rows(spark, chunk, hot):
    """One document a chunk up to all of them; no anchor hot up to all of them."""
    rng = random.Random(6)
    own = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    shared, texts = own(400), []
    for _ in range(40):
        a, b = sorted(rng.sample(range(400), 2))
        texts.append(own(rng.randrange(60)) + shared[a:b] + own(rng.randrange(60)) + shared[b:a + 60])
    rows = list(enumerate(texts)) + [(50, None), (51, ""), (52, "a" * 49), (53, "a" * 50), (54, "a" * 51),
                                     (55, "a" * 3000), (56, "ab" * 2000), (57, shared), (58, shared), (58, shared),
                                     (58, own(90) + shared), (None, shared + "!"), (59, "\x00" * 80), (60, "\x00" * 70)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, spans string, start int")
    found = suffix.dedup_suffixes(df, chunk_bytes=chunk, hot_contexts=hot).withColumn("n_removed", suffix.n_removed()).collect()
    got = sorted((2**63 - 1 if r._id is None else r._id, r.n_bytes, r.n_removed, len(r.spans),
                  hashlib.sha256(r.kept).hexdigest()) for r in found)
    assert got == plain([(2**63 - 1 if d is None else d, (t or "").encode()) for d, t in rows])
    assert suffix.dedup_suffixes(df.limit(0)).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_two_stage_order(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(1, letters + 1, 3000).astype(np.uint8)
    text[rng.integers(0, 3000, 40)] = 0
    text[-1] = 0
    wanted = (text != 0) & (rng.random(3000) < .7)
    raw = text.tobytes() + bytes(20)
    order = suffix.two_stage_order(text, wanted, 16)
    assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
    # Suffixes end with their string: the 0 that ends it and all after it count as equal.
    keys = [raw[i:i + 16].split(b"\x00")[0] for i in order.tolist()]
    assert keys == sorted(keys)
    shared = suffix.common_prefixes(np.frombuffer(raw, np.uint8), order, 16)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]:][:16], raw[order[k]:][:16]
        assert shared[k] == next((i for i in range(16) if a[i] != b[i]), 16)


@pytest.mark.parametrize("hot", [False, True])
def test_doubled_row_with_separate_passages(hot):
    """A row that comes twice in a task: each span that a smaller id has is told whole, twice or once."""
    import pyarrow as pa
    rng = random.Random(9)
    own = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    one, two = own(120), own(120)
    raw = {1: one + own(80) + two, 2: own(70) + one + own(90) + two + own(60)}
    told = np.unique(np.concatenate([suffix.anchors([t], 50)[3] for t in raw.values()]))
    answers = pa.table([pa.array([1]), pa.array([suffix._gaps(told)]), pa.array([suffix._pack(np.full(len(told), hot))])],
                       schema=suffix.TOLD)

    def known(rows):
        batch = pa.record_batch([pa.array(rows, pa.int64()), pa.array([10 * d for d in rows], pa.int64()),
                                 pa.array([raw[d].decode() for d in rows])], ["_id", "_key", "_text"])
        spans = []
        chunk = pa.Table.from_batches(suffix._chunks(8_000_000)(iter([batch])))
        for r in suffix._send_contexts(50, 1)(chunk, answers).to_pylist():
            if r["known"]:
                columns = [suffix._unpack(r[c], k).tolist() for c, k in (("ids", "<i8"), ("starts", "<i8"), ("sizes", "<u4"))]
                spans += zip(*columns)
        return spans

    once = known([1, 2])
    assert len(once) == 2 and all(d == 2 and n >= 50 for d, _, n in once)
    assert set(known([1, 2, 2])) == set(known([2, 1])) == set(once)


def test_anchors_are_dealt_evenly_over_the_buckets():
    """Anchors are the smallest hashes of their windows; no bucket may get most of them, and none is lost."""
    text = np.random.default_rng(3).integers(97, 123, 200_000).astype(np.uint8).tobytes()
    packed = next(suffix._chunks(1 << 20)(iter([pa.record_batch(
        [pa.array([1]), pa.array([1]), pa.array([text.decode()])], ["_id", "_key", "_text"])])))
    chunk = pa.record_batch([pa.array([7]), packed.column("sizes"), packed.column("texts")], ["chunk", "sizes", "texts"])
    rows = pa.Table.from_batches(suffix._send_anchors(50, 40)(iter([chunk]))).to_pylist()
    dealt = {r["bucket"]: suffix._sums(r["hashes"]) for r in rows}
    assert len(dealt) == len(rows) == 40 and max(map(len, dealt.values())) < 1.5 * min(map(len, dealt.values()))
    every = np.unique(np.concatenate([h for _, _, part in suffix.pieces([text], 50) for h in [suffix.anchors(part, 50)[3]]]))
    assert np.array_equal(np.sort(np.concatenate(list(dealt.values()))), every)
