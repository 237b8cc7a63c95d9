"""Packing token ids into fixed windows by bounded-space best fit.

Every partition keeps at most ``open_windows`` windows. A document is tokenized,
gets the separator id, and is cut into whole windows; what remains goes to the
open window that it fills best. When none has room and no further window may be
opened, the fullest is topped up with the beginning of the remainder and
emitted, so emitted windows have no padding. The windows still open at the end
of each partition are merged in groups, level by level; the very last remainder
of a group is cut at powers of two, which need no padding.

The ids are those of the vocabulary file read by the ``tokenizers`` library
with ``add_special_tokens=False``; they are computed by ``tiktoken`` from the
rank file of the same vocabulary, which gives the same ids several times faster.

Defined cases: a null or empty text is the separator alone; a null id stays
null; rows with the same id are packed as separate documents.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import stages

# Fixed value: sequence ids hold level, partition or group, and a counter.
LEVEL_BIT, OWNER_BIT = 60, 32
PIECE = ("_id long, start long, length long, ids binary, doc_tokens long, "
         "sequence_id long, offset long, open boolean, owner long")
TYPES = pa.schema([("_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                   ("offset", pa.int64()), ("open", pa.bool_()), ("owner", pa.int64())])
NAMES = TYPES.names


@cache
def encoding(ranks: str, special: tuple[tuple[str, int], ...]):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens=dict(special))


class Window:
    """One open sequence: the pieces placed in it so far."""

    def __init__(self, size: int):
        self.free, self.pieces = size, []

    def put(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.free -= len(piece[2])


class Packer:
    """Places (id, start, ids, doc_tokens) pieces; full windows become rows at once."""

    def __init__(self, size: int, windows: int, level: int, owner: int):
        self.size, self.windows = size, windows
        self.base = (level << LEVEL_BIT) | (owner << OWNER_BIT)
        self.owner, self.made, self.rows = owner, 0, []
        self.open: list[Window] = []

    def emit(self, pieces: list[tuple], still_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), total, self.base | self.made,
                              offset, still_open, self.owner))
            offset += len(ids)
        self.made += 1

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> None:
        size = self.size
        while len(ids) >= size:
            self.emit([(doc, start, ids[:size], total)])
            start, ids = start + size, ids[size:]
        if not len(ids):
            return
        fitting = [w for w in self.open if w.free >= len(ids)]
        if fitting:
            best = min(fitting, key=lambda w: w.free)
        elif len(self.open) < self.windows:
            best = Window(size)
            self.open.append(best)
        else:
            best = min(self.open, key=lambda w: w.free)
            cut = best.free
            best.put((doc, start, ids[:cut], total))
            self.close(best)
            best = Window(size)
            self.open.append(best)
            start, ids = start + cut, ids[cut:]
        best.put((doc, start, ids, total))
        if not best.free:
            self.close(best)

    def close(self, window: Window) -> None:
        self.open.remove(window)
        self.emit(window.pieces)

    def finish(self, last: bool) -> None:
        """The rest: windows left open, or, in the last merge, cut at powers of two."""
        for window in self.open:
            if not last:
                self.emit(window.pieces, still_open=True)
                continue
            pieces, left = list(window.pieces), self.size - window.free
            while left:
                room = 1 << (left.bit_length() - 1)
                left -= room
                taken = []
                while room:
                    doc, start, ids, total = pieces.pop(0)
                    if len(ids) > room:
                        pieces.insert(0, (doc, start + room, ids[room:], total))
                        ids = ids[:room]
                    taken.append((doc, start, ids, total))
                    room -= len(ids)
                self.emit(taken)
        self.open = []

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
    open_windows: int = 16, separator: int = 0, ranks: str = "byte_bpe_50k.tiktoken",
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),), group: int = 64,
    levels: int = 3,
) -> DataFrame:
    """One row per piece: ``_id``, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    ``group`` partitions, then groups, are merged at each of ``levels`` levels.
    """

    def by_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks, special).encode_to_numpy
        packer = Packer(size, open_windows, 0, TaskContext.get().partitionId())
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "", allowed_special="all", disallowed_special=())
                ids = np.append(ids, separator).astype("<u4")
                packer.add(doc, 0, ids, len(ids))
                if len(packer.rows) >= 1000:
                    yield as_batch(packer.take())
        packer.finish(last=False)
        yield as_batch(packer.take())

    def merged(level: int):
        def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            packer = Packer(size, 1, level, key[0])
            rows = rows.sort_values(["sequence_id", "offset"]).rename(columns={"_id": "doc"})
            for r in rows.itertuples():
                packer.add(None if pd.isna(r.doc) else int(r.doc), int(r.start),
                           np.frombuffer(r.ids, "<u4"), int(r.doc_tokens))
            packer.finish(last=level == levels)
            return pd.DataFrame(packer.take(), columns=NAMES).astype({"_id": "Int64"})
        return merge

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    pieces = stages.stage(texts.mapInArrow(by_partition, PIECE), "pieces")
    done, left = [pieces.filter("NOT open")], pieces.filter("open")
    for level in range(1, levels + 1):
        owner = F.floor(F.col("owner") / group).cast("long").alias("merge_group")
        step = stages.stage(left.groupBy(owner).applyInPandas(merged(level), PIECE), "merged")
        done.append(step.filter("NOT open"))
        left = step.filter("open")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.drop("open", "owner")


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in NAMES]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, TYPES.types)], schema=TYPES)
