"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text; where its upper bits are zero a chunk
ends, so the same passage is cut alike wherever it stands and whatever was
inserted before it. Chunks are compared by digest. A chunk that a document with a
smaller id has too is a repeat, and runs of repeats of at least ``min_run`` bytes
are removed; shorter runs are chance and stay.

Digests are grouped with a partial aggregate, so a chunk that every document has
is one row a task, and the repeats are found by an anti join on (digest, id), which
spreads such a chunk over all tasks.

Defined cases: null or empty text has no chunks; rows with the same id are one
document, so they never make each other repeats; rows without an id come after all
others; chunks end at character boundaries, so what is kept is valid text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import bits
from orderlens.llm import text as T

# The gear table: one pseudo-random 16-bit number a byte value.
GEAR = np.random.default_rng(0x6EA2).integers(0, 1 << 16, 256, dtype=np.uint16)
WINDOW = 16
LEAST, MOST, MASK_BITS = 12, 192, 4
SCHEMA = "_id long, _key int, pos int, d1 long, d2 long"


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash after each byte: h = 2 h + gear[byte], so it sees the last 16 bytes.

    The sum over 16 bytes is built by doubling: sums over 1, 2, 4 and 8 bytes, shifted and added.
    """
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    return h


def ends_of(texts: list[bytes]) -> list[list[int]]:
    """The chunk ends of each text: ``LEAST`` bytes apart (but the last), at most about ``MOST``."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts_char = np.append((data[1:] & 0xC0) != 0x80, True) if len(data) else np.empty(0, bool)
    wanted = np.flatnonzero(((gear_hash(data) >> np.uint16(16 - MASK_BITS)) == 0) & starts_char) + 1
    found, at = [], 0
    places = np.searchsorted(wanted, np.cumsum([0, *map(len, texts)]), "right").tolist()
    for k, text in enumerate(texts):
        n, last, ends = len(text), 0, []
        own = wanted[places[k]:places[k + 1]] - at
        # Before the 16th byte the hash still sees the text before.
        for c in [*own[own >= WINDOW].tolist(), n]:
            while c - last > MOST:
                last += MOST
                while text[last] & 0xC0 == 0x80:
                    last -= 1
                ends.append(last)
            if c - last >= LEAST or (c == n and c > last):
                ends.append(c)
                last = c
        found.append(ends)
        at += n
    return found


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        every = batch.column("_text").to_pylist()
        for part in bits.slices(every):
            texts, begin = [t.encode("utf-8", "surrogatepass") for t in every[part]], part.start
            ends = ends_of(texts)
            sizes = np.array([len(e) for e in ends])
            raw = b"".join([digest(t[a:b]) for t, e in zip(texts, ends) for a, b in zip([0, *e], e)])
            values = np.frombuffer(raw, "<i8").reshape(-1, 2)
            owner = np.repeat(np.arange(len(texts)), sizes) + begin
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            take = pa.array(owner)
            yield pa.record_batch([batch.column("_id").take(take), batch.column("_key").take(take),
                                   pa.array(place.astype(np.int32)), pa.array(np.ascontiguousarray(values[:, 0])),
                                   pa.array(np.ascontiguousarray(values[:, 1]))],
                                  ["_id", "_key", "pos", "d1", "d2"])


def runs(lost: np.ndarray, ends: list[int], min_run: int) -> list[tuple[int, int]]:
    """Byte spans of consecutive chunk places, those of at least ``min_run`` bytes."""
    if not len(lost):
        return []
    breaks = np.flatnonzero(np.diff(lost) != 1) + 1
    spans = []
    for part in np.split(lost, breaks):
        a, b = (ends[part[0] - 1] if part[0] else 0), ends[part[-1]]
        if b - a >= min_run:
            spans.append((a, b))
    return spans


def dedup_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = 72) -> DataFrame:
    """``_id``, ``_row`` (the input row), ``n_bytes``, ``n_chunks``, ``spans`` removed and ``kept``, the text left."""
    spark = docs.sparkSession
    table = T.documents(docs, id_col, text_col).withColumn("_key", F.hash("_text"))
    path = stages.new_path(spark, "chunks")
    table.select("_id", "_key", "_text").mapInArrow(_digests, SCHEMA).write.parquet(path)
    chunks = spark.read.schema(SCHEMA).parquet(path)
    shared = stages.stage(chunks.groupBy("d1", "d2").agg(F.min("_id").alias("first"), F.max("_id").alias("last"))
                          .filter("first < last").select("d1", "d2", "first"), "shared_chunks")
    lost = stages.stage(
        chunks.join(shared, ["d1", "d2"]).filter(F.col("_id") > F.col("first"))
        .groupBy("_id", "_key").agg(F.sort_array(F.collect_set("pos")).alias("lost")), "lost_chunks")
    stages.remove(spark, path)

    @F.pandas_udf("n_bytes long, n_chunks long, spans array<struct<start:long,stop:long>>, kept string")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        rows, texts = [], list(texts)
        for part in bits.slices(texts):
            raw = [t.encode("utf-8", "surrogatepass") for t in texts[part]]
            for text, ends, gone in zip(raw, ends_of(raw), places[part]):
                spans = runs(np.asarray(gone if gone is not None else (), np.int64), ends, min_run)
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(ends), [{"start": a, "stop": b} for a, b in spans],
                             kept.decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["n_bytes", "n_chunks", "spans", "kept"])

    return (table.join(lost, ["_id", "_key"], "left").withColumn("_cut", cut("_text", "lost"))
            .select("_id", "_row", "_cut.n_bytes", "_cut.n_chunks", "_cut.spans", "_cut.kept"))


def n_removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
