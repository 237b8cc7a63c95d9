"""SimHash near-dedup by tiled exact comparison.

Different fingerprints are put into tiles by the population counts of their four
16-bit blocks. Two fingerprints within the radius have counts that differ by at
most the radius in all, so a tile meets only the tiles of such counts; every
pair of tiles that meet is compared completely with NumPy exclusive-or and bit
counts. A pair of tiles gives a spanning forest of its links, not all pairs, and
the forests are joined into components.

Defined cases: no words (null, empty or white space): fingerprint zero, linked
like any other; each row is a document of its own, also when it repeats an id;
rows without an id come after all others, and a component of such rows only has
a null id; classes that rows of one repeated id share may be joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import bits, graph
from orderlens.llm import text as T

BLOCKS, BLOCK_BITS = 4, 16
# A comparison holds so many pairs of fingerprints at once.
PAIRS_AT_ONCE = 1 << 19


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(``_id``, ``_key``, ``fp``) for a table with ``_id`` and ``_text``: majority vote of the shingles' XXH64 bits.

    ``_key`` is a hash of the text, to find the row again.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1).to_pylist(), np.empty(batch.num_rows, np.uint64)
            for part in bits.slices(texts):
                values, sizes = bits.hashes(texts[part], words, lambda s: xxhash.xxh64_intdigest(s, seed))
                found[part] = bits.pack_bits(bits.bit_counts(values, sizes) * 2 > sizes[:, None])
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found.view(np.int64))],
                                  ["_id", "_key", "fp"])

    return docs.select("_id", "_text", F.xxhash64("_text").alias("_key")).mapInArrow(
        vote, "_id long, _key long, fp long")


def block_counts(fp: Column) -> list[Column]:
    mask = (1 << BLOCK_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(mask)) for i in range(BLOCKS)]


def cell_of(counts: list[Column]) -> Column:
    cell = F.lit(0)
    for c in counts:
        cell = cell * (BLOCK_BITS + 1) + c
    return cell.cast("int")


def tiles(classes: DataFrame, tile: int) -> DataFrame:
    """(``cell``, ``counts``, ``part``, ``fps``, ``ids``): fingerprints of equal block counts, about ``tile`` each."""
    counted = classes.withColumn("counts", F.array(*block_counts(F.col("fp"))))
    counted = counted.withColumn("cell", cell_of([F.col("counts")[i] for i in range(BLOCKS)]))
    # At most 17^4 cells exist, so their sizes can be broadcast for any number of documents.
    parts = counted.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).alias("parts"))
    return (counted.join(F.broadcast(parts), "cell")
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
            .groupBy("cell", "part").agg(
                F.first("counts").alias("counts"),
                F.sort_array(F.collect_list(F.struct("fp", "_id"))).alias("m"))
            .select("cell", "part", "counts", F.col("m.fp").alias("fps"), F.col("m._id").alias("ids")))


def forest(i: np.ndarray, j: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links reduced to one per node: each node of a component with the smallest node of it."""
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(nodes))
    return linked, label[linked]


def compare(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links between ``a`` and ``b`` (None: within ``a``); nodes of ``b`` follow those of ``a``."""
    other, shift = (a, 0) if b is None else (b, len(a))
    nodes, found = len(a) + (0 if b is None else len(b)), []
    step = max(1, PAIRS_AT_ONCE // max(1, len(other)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at:at + step, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            found.append(forest(i, j + shift, nodes))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), nodes)


def links(classes: DataFrame, radius: int = 3, tile: int = 4096) -> DataFrame:
    """(``u``, ``v``): ids of classes (``fp``, ``_id``) whose fingerprints differ in at most ``radius`` bits.

    The links given connect exactly what all links connect.
    """
    own = stages.stage(tiles(classes, tile), "tiles")
    shifts = [d for d in product(range(-radius, radius + 1), repeat=BLOCKS)
              if sum(map(abs, d)) <= radius and d >= (0,) * BLOCKS]
    moved = [F.struct(*[(F.col("counts")[i] + d[i]).alias(f"c{i}") for i in range(BLOCKS)]) for d in shifts]
    inside = F.array(*[F.col(f"to.c{i}").between(0, BLOCK_BITS) for i in range(BLOCKS)])
    meets = (own.select("cell", F.col("part").alias("left_part"), F.col("fps").alias("left_fps"),
                        F.col("ids").alias("left_ids"), F.explode(F.array(*moved)).alias("to"))
             .filter(F.forall(inside, lambda x: x))
             .select(F.col("cell").alias("left_cell"), "left_part", "left_fps", "left_ids",
                     cell_of([F.col(f"to.c{i}") for i in range(BLOCKS)]).alias("cell")))
    same = F.col("left_cell") == F.col("cell")
    pairs = (meets.join(own, "cell")
             .filter(~same | (F.col("part") >= F.col("left_part")))
             .select((same & (F.col("part") == F.col("left_part"))).alias("self"),
                     "left_fps", "left_ids", "fps", "ids"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for k in range(batch.num_rows):
                fp_a, id_a, fp_b, id_b = (batch.column(c)[k].values.to_numpy() for c in range(1, 5))
                alone = batch.column(0)[k].as_py()
                # Unsigned: NumPy counts the bits of a signed number's absolute value.
                i, j = compare(fp_a.view(np.uint64), None if alone else fp_b.view(np.uint64), radius)
                if len(i):
                    ids = id_a if alone else np.concatenate((id_a, id_b))
                    us.append(ids[i])
                    vs.append(ids[j])
            if us:
                yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return pairs.mapInArrow(match, "u long, v long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3,
    tile: int = 4096, seed: int = 42,
) -> DataFrame:
    """One row per document: ``_id``, ``_key``, ``fp`` (as a signed long), ``component``: the smallest id reachable."""
    marked = stages.stage(fingerprints(T.documents(docs, id_col, text_col), words, seed), "fingerprints")
    classes = stages.stage(marked.groupBy("fp").agg(F.min("_id").alias("_id")), "classes")
    found = graph.components(links(classes, radius, tile))
    named = classes.join(found, F.col("_id") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "_id").alias("component"))
    none = F.lit(T.LAST_ID)
    return marked.join(named, "fp").select(
        F.nullif("_id", none).alias("_id"), "_key", "fp", F.nullif("component", none).alias("component"))
