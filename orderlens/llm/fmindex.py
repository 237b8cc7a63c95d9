"""Benchmark decontamination with one FM-index per training shard.

The words of a shard's documents become symbols. A word that no benchmark item
has can't be inside a match, so it is a separator, and runs between separators
that are shorter than the shortest phrase are left out; what remains is indexed:
suffix array, Burrows-Wheeler transform, a wavelet matrix for ranks, and suffix
positions sampled at every 32nd place and at the start of each run. All phrases
are searched backwards at once, their occurrences are located by walking to a
sampled position, and the hit words are merged into removal spans.

Defined cases: null or empty text has no words; an item without words has no
phrase; an item of fewer words than the window is one phrase; an item without an
id has the id ''. Repeated rows are judged alike, each on its own.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import text as T

# Word bytes are digits, letters and all bytes from 0x80 on; A-Z is lower-cased.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
SAMPLE = 32
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def same_windows(text: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """A number for the ``m`` symbols from each start on: equal for equal windows, 0 to their count."""
    ids, width = np.zeros(len(starts), np.int64), int(text.max(initial=0)) + 1
    for k in range(m):
        ids = np.unique(ids * width + text[starts + k], return_inverse=True)[1]
    return ids


class Phrases:
    """The windows of benchmark items over a vocabulary of their words; symbol 0 is every other word.

    The items' symbols stand in one array, and a window is its place there, so that a word
    of the benchmark costs a few numbers. ``groups``: for each length the place of every
    different window, the items that have it, and where each window's items begin.
    """

    # Windows laid out as rows of symbols at a time.
    AT_ONCE = 1 << 16

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.names: list[str] = []
        self.symbols: dict[bytes, int] = {}
        placed, ends = array("i"), array("q")
        for name, text in items:
            self.names.append(name)
            placed.extend(self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text))
            ends.append(len(placed))
        self.text = np.array(placed, np.int32)
        sizes = np.diff(np.array(ends, np.int64), prepend=0)
        begins, lengths = np.cumsum(sizes) - sizes, np.minimum(sizes, window)
        found = [int(m) for m in np.unique(lengths) if m]
        self.shortest = min(found, default=0)
        self.groups = [(m, *self._distinct(begins, np.where(lengths == m, sizes - m + 1, 0), m)) for m in found]

    def _distinct(self, begins: np.ndarray, counts: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of ``counts`` windows of ``m`` words from each item's begin on the different ones, and who has them."""
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        ids = same_windows(self.text, starts, m)
        first = np.unique(ids, return_index=True)[1]
        which, owners = np.divmod(np.unique(ids * len(counts) + owner), len(counts))
        return starts[first], owners, np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(first)))))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of one length as rows of symbols, all owners of that length, and the rows' places among them."""
        for m, starts, owners, bounds in self.groups:
            for at in range(0, len(starts), self.AT_ONCE):
                part = starts[at:at + self.AT_ONCE]
                yield self.text[part[:, None] + np.arange(m)].astype(np.int64), owners, bounds[at:at + len(part) + 1]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling. Separators (0) count as different symbols in order of place."""
    zeros = np.flatnonzero(text == 0)
    rank = text + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    step = 1
    while True:
        follow = np.zeros(len(text), np.int64)
        follow[:-step] = rank[step:] + 1
        key = rank * (int(follow.max()) + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.empty(len(text), np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = new
        if rank[order[-1]] == len(text) - 1:
            return order
        step *= 2


class FMIndex:
    """Index of a symbol array that begins and ends with the separator 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        bwt = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        starts = np.zeros(len(text), bool)
        starts[1:] = text[:-1] == 0
        sampled = starts | (np.arange(len(text)) % SAMPLE == 0) | (text == 0)
        self.sampled = sampled[order]
        self.place = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]
        self.levels, row = [], bwt
        for bit in reversed(range(max(1, int(symbols).bit_length()))):
            ones = (row >> bit) & 1
            counts = np.concatenate(([0], np.cumsum(ones)))
            self.levels.append((bit, counts, len(row) - int(counts[-1])))
            row = np.concatenate((row[ones == 0], row[ones == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is in the transform before row ``at``."""
        low = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            set_bits = (symbol >> bit) & 1 == 1
            at = np.where(set_bits, zeros + ones[at], at - ones[at])
            low = np.where(set_bits, zeros + ones[low], low - ones[low])
        return at - low

    def symbol_at(self, row: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(row)
        for bit, ones, zeros in self.levels:
            one = ones[row + 1] - ones[row]
            symbol |= one << bit
            row = np.where(one == 1, zeros + ones[row], row - ones[row])
        return symbol

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of phrases of one length: those that occur, and their rows (low, high)."""
        which = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.before[last], self.before[last + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            symbol = phrases[which, k]
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
            left = high > low
            which, low, high = which[left], low[left], high[left]
        left = high > low
        return which[left], low[left], high[left]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking backwards to sampled ones."""
        found = np.empty(len(rows), np.int64)
        which, steps = np.arange(len(rows)), 0
        while len(which):
            here = self.sampled[rows]
            found[which[here]] = self.positions[self.place[rows[here]]] + steps
            which, rows = which[~here], rows[~here]
            symbol = self.symbol_at(rows)
            rows = self.before[symbol] + self.rank(symbol, rows)
            steps += 1
        return found


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> dict[int, tuple[list, list]]:
    """Merged spans of hit words and the items found, for the documents (symbol arrays) that have any."""
    if not docs or not phrases.groups:
        return {}
    sizes = np.array([len(d) + 1 for d in docs])
    text = np.zeros(sizes.sum() + 1, np.int64)
    begins = np.cumsum(sizes) - sizes + 1
    for begin, d in zip(begins, docs):
        text[begin:begin + len(d)] = d
    # Runs of vocabulary words that can hold a phrase, one separator between them.
    edges = np.flatnonzero(np.diff(text != 0))
    run_start, run_stop = edges[::2] + 1, edges[1::2] + 1
    long_enough = run_stop - run_start >= phrases.shortest
    run_start, run_stop = run_start[long_enough], run_stop[long_enough]
    if not len(run_start):
        return {}
    lengths = run_stop - run_start
    index_start = np.cumsum(lengths + 1) - lengths
    indexed = np.zeros(lengths.sum() + len(lengths) + 1, np.int64)
    place = np.repeat(index_start, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    source = np.zeros(len(indexed), np.int64)
    source[place] = place + np.repeat(run_start - index_start, lengths)
    indexed[place] = text[source[place]]
    index = FMIndex(indexed, len(phrases.symbols))

    cover, pairs = np.zeros(len(indexed) + 1, np.int64), []
    for group, owners, bounds in phrases.blocks():
        which, low, high = index.search(group)
        if not len(which):
            continue
        counts = high - low
        rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        at = index.locate(rows)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + group.shape[1], -1)
        doc = np.searchsorted(begins, source[at], "right") - 1
        seen = np.unique(np.stack((doc, np.repeat(which, counts))), axis=1)
        for d, w in seen.T.tolist():
            pairs.extend((d, o) for o in owners[bounds[w]:bounds[w + 1]].tolist())
    hit = (np.cumsum(cover)[:-1] > 0) & (indexed != 0)
    span_edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    result: dict[int, tuple[list, list]] = {}
    for a, b in zip(span_edges[::2].tolist(), span_edges[1::2].tolist()):
        d = int(np.searchsorted(begins, source[a], "right") - 1)
        spans = result.setdefault(d, ([], []))[0]
        start, stop = int(source[a] - begins[d]), int(source[b - 1] - begins[d]) + 1
        spans.append({"start": start, "stop": stop})
    for d, o in sorted(set(pairs)):
        result[d][1].append(phrases.names[o])
    return result


def _merge(spans: list[dict]) -> list[dict]:
    """Spans in order, joined where they touch."""
    done: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if done and s["start"] <= done[-1]["stop"]:
            done[-1]["stop"] = max(done[-1]["stop"], s["stop"])
        else:
            done.append(dict(s))
    return done


def cut(text: str, spans: list[dict]) -> str:
    """``text`` without the words of ``spans``, each from its first word's first byte to its last word's last."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    kept, at = [], 0
    for s in spans:
        kept.append(raw[at:places[s["start"]][0]])
        at = places[s["stop"] - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def _scan(phrases, shard_words: int, remove: bool):
    """Adds what one block of phrases finds; a partition is searched in shards of about ``shard_words`` words.

    ``remove``: the words of all spans found so far are cut from ``_text``.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = phrases.value
        get = known.symbols.get
        held, docs, words = [], [], 0

        def flush() -> list[pa.RecordBatch]:
            found, done, out = search_shard(docs, known), 0, []
            for batch in held:
                hits = [found.get(k, ((), ())) for k in range(done, done + batch.num_rows)]
                own = docs[done:done + batch.num_rows]
                done += batch.num_rows
                spans = [_merge([*old, *h[0]]) if h[0] else old
                         for old, h in zip(batch.column("spans").to_pylist(), hits)]
                items = [sorted({*old, *h[1]}) for old, h in zip(batch.column("items").to_pylist(), hits)]
                columns = {name: batch.column(name) for name in batch.schema.names}
                if remove and any(spans):
                    columns["_text"] = pa.array([cut(t, s) if s else t for t, s in zip(
                        batch.column("_text").to_pylist(), spans)], pa.string())
                columns |= {"n_words": pa.array([len(d) for d in own], pa.int64()),
                            "spans": pa.array(spans, SPANS), "items": pa.array(items, pa.list_(pa.string()))}
                out.append(pa.record_batch(list(columns.values()), list(columns)))
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [np.array([get(w, 0) for w in words_of(t.as_py())], np.int32)
                       for t in part.column("_text")]
                held.append(part)
                docs.extend(own)
                words += sum(map(len, own))
                if words >= shard_words:
                    yield from flush()
                    held, docs, words = [], [], 0
        yield from flush()

    return scan


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_bytes``, so that what is broadcast is bounded."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    place = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [items.filter(place == b) for b in range(blocks)]


def _search(table: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, window: int,
            shard_words: int, block_bytes: int, remove: bool = False) -> DataFrame:
    """``table`` (with ``_text``) plus ``n_words``, ``spans`` and ``items``; the blocks search one after another.

    With ``remove`` the last block cuts the words hit from ``_text``.
    """
    spark = table.sparkSession
    found = table.withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start:int,stop:int>>"),
        "items": F.array().cast("array<string>")})
    blocks = item_blocks(benchmark, item_col, item_text, block_bytes)
    for k, block in enumerate(blocks, start=1):
        items = ((r["item"], r["text"]) for r in block.toLocalIterator())
        known = spark.sparkContext.broadcast(Phrases(items, window))
        found = found.mapInArrow(_scan(known, shard_words, remove and k == len(blocks)), found.schema)
    return found


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = 10,
    shard_words: int = 1_000_000, block_bytes: int = 16_000_000,
) -> DataFrame:
    """One row per document: ``_id``, ``n_words``, ``spans`` of hit words (start, stop), ``items`` (sorted ids).

    The benchmark is sent to the executors in blocks of about ``block_bytes``.
    """
    table = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return _search(table, benchmark, item_col, item_text, window, shard_words, block_bytes).drop("_text")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = 10,
    shard_words: int = 1_000_000, block_bytes: int = 16_000_000,
) -> DataFrame:
    """The documents in internal form (``_id``, ``_row``) with ``kept``, the text without the words hit."""
    found = _search(T.documents(docs, id_col, text_col), benchmark, item_col, item_text, window,
                    shard_words, block_bytes, remove=True)
    return found.withColumnRenamed("_text", "kept")


def n_hit() -> Column:
    """Number of hit words of a row of ``find_leaks``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
