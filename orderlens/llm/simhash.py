"""Document fingerprints by SimHash, and the search for all fingerprints within a Hamming radius.

A term is a shingle of two words; its weight grows with its length, since long
terms are the rare ones. The 128-bit hashes of all terms, repeats included, vote
with their weights on the bits. The likeness of two fingerprints is the cosine
that their share of differing bits stands for.

``within`` finds every fingerprint within a radius of the queried ones: the bits
are cut into three blocks more than the radius has bits (six at least), of which at
least three agree; for each choice of three blocks, permuted to the front as a key, a
table is joined with the queries, and candidates are compared exactly. A wider radius
is as exact, but has more tables with shorter keys: 20 tables for three bits, 165 for
eight.

Defined cases: null or empty text has no terms and the fingerprint zero; equal
texts have equal fingerprints; documents with the same id are ordered by a hash
of their text; a single document is its own next one; rows without an id come as
if their id were larger than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import bits
from orderlens.llm import text as T

TERM_WORDS, HEAVIEST = 2, 8
BITS = 128
# Blocks that agree and make up a key, and the radius unless another is chosen.
FRONT, RADIUS = 3, 3


def fingerprint(texts: list[str]) -> np.ndarray:
    """128-bit fingerprints of a batch of texts, as rows of two unsigned 64-bit numbers (low, high)."""
    found, digest = np.zeros((len(texts), 2), np.uint64), xxhash.xxh3_128_digest
    for part in bits.slices(texts):
        found[part] = _vote([bits.shingles(t, TERM_WORDS) for t in texts[part]], digest)
    return found


def _vote(terms: list[list[bytes]], digest) -> np.ndarray:
    sizes = np.array([len(t) for t in terms], np.int64)
    flat = [s for own in terms for s in own]
    values = np.frombuffer(b"".join(map(digest, flat)), "<u8").reshape(-1, 2)
    weights = np.minimum(HEAVIEST, 1 + np.fromiter(map(len, flat), np.int64, len(flat)) // 4)
    owner = np.repeat(np.arange(len(terms)), sizes)
    total = np.bincount(owner, weights, len(terms)).astype(np.int64)[:, None]
    return np.column_stack([bits.pack_bits(
        bits.bit_counts(np.ascontiguousarray(values[:, side]), sizes, weights, HEAVIEST) * 2 > total)
        for side in (0, 1)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine by the share of differing bits, at least 0."""
    differing = np.bitwise_count(a ^ b).sum(axis=1)
    return np.where(differing == 0, 1.0, np.maximum(0.0, np.cos(np.pi * differing / BITS)))


ROWS = pa.schema([("target", pa.int32()), ("guest", pa.bool_()), ("_id", pa.int64()), ("_key", pa.int64()),
                  ("packed", pa.binary())])
RESULT = ("_id long, n_chars long, edited_sha256 string, lo long, hi long, edited_lo long, edited_hi long, "
          "near_edited double, near_next double")


def _with_guests(bounds: np.ndarray, guests: dict[int, list[int]]):
    """Each document for its range of ids, and the first of each range also for the one before it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column(0).to_numpy()
            own = np.searchsorted(bounds, ids, "left").tolist()
            rows = []
            for i, (doc, key, text) in enumerate(zip(ids.tolist(), batch.column(1).to_pylist(), batch.column(2))):
                packed = compress(text.as_py().encode("utf-8", "surrogatepass"))
                rows.append((own[i], False, doc, key, packed))
                rows.extend((g, True, doc, key, packed) for g in guests.get(doc, ()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), ROWS.types)] if rows else
                                  [pa.array([], t) for t in ROWS.types], schema=ROWS)

    return deal


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in descending order, its guest last: each with the text that follows it."""
    expand = zstandard.ZstdDecompressor().decompress
    held: list[tuple[int, str]] = []
    prints = np.empty((0, 2), np.uint64)

    def rows(docs: list, marks: np.ndarray) -> pa.RecordBatch:
        edited = []
        for (_, text), (_, after) in zip(docs, docs[1:]):
            cut = len(text) // 3
            edited.append(text[:len(text) - cut] + after[:cut])
        new, own, following = fingerprint(edited), marks[:-1], marks[1:]
        signed = lambda column: pa.array(np.ascontiguousarray(column).view(np.int64))
        return pa.record_batch([
            pa.array([d for d, _ in docs[:-1]], pa.int64()), pa.array([len(t) for _, t in docs[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            signed(own[:, 0]), signed(own[:, 1]), signed(new[:, 0]), signed(new[:, 1]),
            pa.array(likeness(own, new)), pa.array(likeness(own, following))],
            ["_id", "n_chars", "edited_sha256", "lo", "hi", "edited_lo", "edited_hi", "near_edited", "near_next"])

    closed = False
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            docs = []
            for guest, doc, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(4)):
                if not closed:
                    docs.append((doc, expand(packed.as_py()).decode("utf-8", "surrogatepass")))
                closed = closed or guest
            marks = fingerprint([t for _, t in docs])
            held, prints = [*held, *docs], np.concatenate((prints, marks))
            if len(held) > 1:
                yield rows(held, prints)
                held, prints = held[-1:], prints[-1:]
    if held and not closed:
        raise ValueError("a range of ids came without the document that follows it")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited text, and how like they and the next document's are.

    The next document is the one with the next smaller id, after the last the first; the edited text
    has its last third replaced by as many characters from the next document's beginning. Documents
    are dealt out by ranges of ids, once; the first document of a range is also sent to the range that
    precedes it in this order, so no range waits for another. Texts travel compressed.
    """
    spark = docs.sparkSession
    table = T.documents(docs, id_col, text_col)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = table.select("_id")
    # One bound and one largest id a range: as many numbers as there are partitions.
    cuts = ids.agg(F.percentile_approx("_id", [k / n for k in range(1, n)], F.lit(100 * n))).first()[0] if n > 1 else None
    bounds = np.unique(np.array(cuts or [], np.int64))
    first = np.array([r[0] for r in ids.mapInArrow(_largest(bounds), "range int, _id long")
                      .groupBy("range").agg(F.max("_id").alias("_id")).select("_id").orderBy("_id").collect()], np.int64)
    ranges = np.searchsorted(bounds, first, "left").tolist()
    guests: dict[int, list[int]] = {}
    for k, doc in enumerate(first.tolist()):
        guests.setdefault(doc, []).append(ranges[(k + 1) % len(ranges)])
    dealt = table.select("_id", F.xxhash64("_text").alias("_key"), "_text").mapInArrow(
        _with_guests(bounds, guests), "target int, guest boolean, _id long, _key long, packed binary")
    return (dealt.repartitionById(max(n, len(bounds) + 1), "target")
            .sortWithinPartitions("target", "guest", F.desc("_id"), "_key")
            .mapInArrow(_compare, RESULT))


def _largest(bounds: np.ndarray):
    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for r in np.unique(places := np.searchsorted(bounds, ids, "left")).tolist():
                top = int(ids[places == r].max())
                found[r] = max(found.get(r, top), top)
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                              ["range", "_id"])
    return largest


def hex_of(hi: str = "hi", lo: str = "lo") -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def blocks(radius: int) -> list[tuple[str, int, int]]:
    """(half, shift, width) of the blocks for a radius, nearly equal in each half, wide ones first."""
    n = max(2 * FRONT, radius + FRONT)
    found = []
    for half, count in (("hi", n - n // 2), ("lo", n // 2)):
        shift = 0
        for k in range(count):
            width = 64 // count + (k < 64 % count)
            found.append((half, shift, width))
            shift += width
    return found


def _tables(prints: DataFrame, radius: int) -> DataFrame:
    """A row for each table: its number and the three blocks at the front of its permutation, as one key."""
    cut = blocks(radius)
    block = [F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << w) - 1)) for h, s, w in cut]
    wide = max(w for *_, w in cut)
    # Three widest blocks may pass 64 bits by one: a bit less in the key adds candidates and loses none.
    second, third = wide, min(2 * wide, 64 - min(w for *_, w in cut))
    keys = [F.struct(F.lit(k).cast("int").alias("table"), block[a].bitwiseOR(F.shiftleft(block[b], second))
                     .bitwiseOR(F.shiftleft(block[c], third)).alias("key"))
            for k, (a, b, c) in enumerate(combinations(range(len(cut)), FRONT))]
    return prints.withColumn("_t", F.explode(F.array(*keys))).select("*", "_t.table", "_t.key").drop("_t")


def within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each queried fingerprint (``hi``, ``lo``): ``n_near``, the rows of ``prints`` within ``radius`` bits, 0 to 125.

    Equal fingerprints are counted first, so copies cost one row.
    """
    if not 0 <= radius <= BITS - FRONT:
        raise ValueError(f"the bits cannot be cut into blocks for radius {radius}")
    classes = _tables(prints.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")), radius)
    asked = _tables(queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")).distinct()
                    .select("q_hi", "q_lo", F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")), radius).drop("hi", "lo")
    differing = (F.bit_count(F.col("hi").bitwiseXOR(F.col("q_hi")))
                 + F.bit_count(F.col("lo").bitwiseXOR(F.col("q_lo"))))
    # Queries grow with the corpus, so they are never broadcast: one plan at every size.
    return (asked.hint("merge").join(classes, ["table", "key"]).filter(differing <= radius)
            .groupBy("q_hi", "q_lo", "hi", "lo").agg(F.max("n").alias("n"))
            .groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg(F.sum("n").alias("n_near")))


def fingerprints_with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                                 every: int = 20) -> DataFrame:
    """``edited_fingerprints`` plus ``n_near`` for ids divisible by ``every``: documents within the radius, itself too."""
    rows = stages.stage(edited_fingerprints(docs, id_col, text_col), "fingerprints")
    asked = (F.col("_id") % every == 0) & (F.col("_id") != T.LAST_ID)
    near = within(rows.select("hi", "lo"), rows.filter(asked).select("hi", "lo"))
    found = rows.filter(asked).join(near, ["hi", "lo"]).select("n_near", *rows.columns)
    return (rows.filter(~asked).withColumn("n_near", F.lit(None).cast("long")).unionByName(found)
            .withColumn("_id", F.nullif("_id", F.lit(T.LAST_ID))))
