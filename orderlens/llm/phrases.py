"""Collocations: phrases of two to five words whose parts meet more often than chance.

A text is cut into pieces and words. Only the longest windows are counted: each word with
its four followers in lead columns, padded with nulls behind the end of a piece. A
``ROLLUP`` over the columns then sums the windows' counts over successively shorter
prefixes, which gives the count of every phrase of one to five words and, for the language
alone, of all words; no n-gram of another order is ever formed.

A window need not be longer than the phrases that can reach the least count: it also ends
where a word, two or three adjacent words are too rare. Which ones are is told by tables
of counters that phrases of a length share by hash; a counter holds at least the count of
each of its phrases, so one below the least count proves them rare, and no frequent phrase
loses an occurrence. The counters grow with the corpus up to 2^27 a length and are sent
out as one bit each (16 MB at most); in a corpus too large for them they prove
nothing and the windows stay long, with the same result.

Defined cases: a null language is ``und``; null and empty texts, and texts without
words, have no phrase; a language without frequent phrases has no row; rows count as
documents of their own, repeated or not, with an id or without; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens import stages

# What ends a piece, and the longest phrase.
BREAKS, ORDER = b".,;:!?\n\x0b\x0c\r", 5
_TABLE = bytes(0x0A if c in BREAKS else 0x20 if c == 0x09 else c for c in range(256))
# Bytes of text cut at once, words in a block: a block has fewer than 2^21 different words.
PART, BLOCK, CODE_BITS = 1 << 20, 1 << 20, 21
# Bits of the largest counter table, text bytes per counter, counters that travel together.
MOST_BITS, BYTES_PER_COUNTER, CHUNK = 27, 32, 1 << 15
# Text bytes per bucket of windows.
BYTES_PER_BUCKET = 1 << 25
# Lengths of the phrases that are looked for rare ones, in passes over the texts.
PASSES = ([1, 2], [3])
WORDS = [f"w{k}" for k in range(1, ORDER + 1)]


class Codes(dict):
    """The number of each word of a language, dealt at its first sight; 0 is a break and -1 no word."""

    def __init__(self, words: list[bytes], owner: list[int], lang: int):
        super().__init__({b"": -1, b"\n": 0})
        self.words, self.owner, self.lang = words, owner, lang

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self.owner.append(self.lang)
        self[word] = len(self.words) - 1
        return self[word]


class Block:
    """Words of a task's documents as numbers: ``codes``, a break behind each document.

    ``own``: so many of them start a window here, the others follow to complete windows.
    """

    def __init__(self):
        self.words, self.owner, self.langs = [b"\n"], [0], []
        self.tables: dict[str, Codes] = {}
        self.held: list[np.ndarray] = []
        self.size = 0
        self.codes, self.own = np.empty(0, np.int32), 0

    def table(self, lang: str) -> Codes:
        if lang not in self.tables:
            self.langs.append(lang)
            self.tables[lang] = Codes(self.words, self.owner, len(self.langs) - 1)
        return self.tables[lang]

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.size += len(codes)

    def close(self, last: bool) -> Block:
        """Settle this block; the next one begins with the words that are not its own."""
        self.codes = np.concatenate(self.held)
        self.own = len(self.codes) if last else len(self.codes) - (ORDER - 1)
        following = Block()
        tail = [following.table(self.langs[self.owner[c]])[self.words[c]] if c else 0 for c in self.codes[self.own:]]
        following.add(np.array(tail, np.int32))
        return following

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word and its language."""
        seeds = [xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) for name in self.langs] or [0]
        found = (xxhash.xxh64_intdigest(w, seeds[k]) for w, k in zip(self.words, self.owner))
        return np.fromiter(found, np.uint64, len(self.words))


def parts(raw: bytes) -> Iterator[bytes]:
    """A text in parts that end between words."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PART)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, raw = lang.as_py(), text.as_py().encode("utf-8", "surrogatepass").lower().translate(_TABLE)
            for part in parts(raw):
                cut = part.replace(b"\n", b" \n ").split(b" ")
                codes = np.fromiter(map(block.table(lang).__getitem__, cut), np.int32, len(cut))
                block.add(codes[codes >= 0])
                if block.size >= BLOCK:
                    following = block.close(last=False)
                    yield block
                    block = following
            block.add(np.zeros(1, np.int32))
    if block.size:
        block.close(last=True)
        yield block


class Marks:
    """Which phrases of one to ``len(tables)`` words may be frequent, in a block of words.

    ``tables`` has a bitmap of the hot counters for each length that is known so far.
    """

    def __init__(self, block: Block, tables: list[bytes], size_bits: int):
        self.codes = np.append(block.codes, np.zeros(ORDER, np.int32))
        self.hashes, self.shift = block.hashes(), np.uint64(64 - size_bits)
        self.tables = [np.frombuffer(t, np.uint8) for t in tables]
        self.hot = [self.codes > 0]
        for m in range(1, len(tables) + 1):
            self.hot.append(self.lookup(m))

    def starts(self, m: int) -> np.ndarray:
        """Where phrases of ``m`` words begin that are inside a piece, with all shorter phrases hot as far as known."""
        shorter = self.hot[min(m, len(self.hot)) - 1]
        known = min(m, len(self.hot)) - 1 or 1
        own = np.ones(len(self.codes) - ORDER, bool)
        for k in range(m - known + 1):
            own &= shorter[k:k + len(own)]
        return np.flatnonzero(own)

    def counter(self, at: np.ndarray, m: int) -> np.ndarray:
        """The counter that each phrase of ``m`` words shares with others."""
        mixed = np.full(len(at), m, np.uint64)
        for k in range(m):
            mixed = (mixed ^ self.hashes[self.codes[at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        return ((mixed * np.uint64(0x165667B19E3779F9)) >> self.shift).astype(np.int64)

    def lookup(self, m: int) -> np.ndarray:
        at = self.starts(m)
        counter = self.counter(at, m)
        found = np.zeros(len(self.codes), bool)
        found[at] = (self.tables[m - 1][counter >> 3] >> (counter & 7).astype(np.uint8)) & 1
        return found


def hot_tables(texts: DataFrame, known: list[bytes], orders: list[int], least: int, size_bits: int) -> list[bytes]:
    """Bitmaps of the counters that reach ``least`` for phrases of each of ``orders`` words; ``known``: those of shorter ones.

    A task adds its counts in place and sends the chunks that it has touched; a chunk's sums stream through one task.
    At most 2^27 bits for each order reach the driver.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(known)
    kind = np.dtype(next(t for t in (np.uint8, np.uint16, np.uint32) if least <= np.iinfo(t).max))
    chunks = max(1, (1 << size_bits) // CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros(max(CHUNK, 1 << size_bits), kind) for m in orders}
        for block in blocks(batches):
            marks = Marks(block, shared.value, size_bits)
            for m in orders:
                at = marks.starts(m)
                kinds, n = np.unique(marks.counter(at[at < block.own], m), return_counts=True)
                # More than enough need not be told apart from enough.
                sums[m][kinds] = np.minimum(sums[m][kinds].astype(np.int64) + n, least)
        pack = zstandard.ZstdCompressor(level=1).compress
        for m in orders:
            for k in range(chunks):
                own = sums[m][k * CHUNK:(k + 1) * CHUNK]
                if own.any():
                    yield pa.record_batch([pa.array([m * chunks + k]), pa.array([pack(own.tobytes())], pa.binary())],
                                          ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(unpack(packed.as_py()), kind).astype(np.int64)
                sums[k] = np.minimum(sums[k] + own, least) if k in sums else own
        for k, own in sums.items():
            yield pa.record_batch([pa.array([k]), pa.array([np.packbits(own >= least, bitorder="little").tobytes()],
                                                           pa.binary())], ["chunk", "bits"])

    rows = (texts.mapInArrow(count, "chunk long, counts binary").repartition("chunk")
            .mapInArrow(add, "chunk long, bits binary").collect())
    shared.destroy()
    found, width = {m: bytearray(chunks * CHUNK // 8) for m in orders}, CHUNK // 8
    for row in rows:
        m, k = divmod(row["chunk"], chunks)
        found[m][k * width:(k + 1) * width] = row["bits"]
    return [bytes(found[m]) for m in orders]


def _pack(words: list[bytes], columns: list[np.ndarray], lang: np.ndarray, n: np.ndarray) -> bytes:
    """Windows as one value: their words once, joined by spaces, then numbers of words (0: none), languages and counts."""
    used, places = np.unique(np.concatenate(columns), return_inverse=True)
    text = b" ".join(words[c] if c else b"" for c in used.tolist())
    # The words stand from place 1 on, also when no window is padded.
    places = places + 1 if used[0] else places
    parts = [np.array([len(text), len(n), int(used[0] == 0)], "<u4").tobytes(), text, places.astype("<u4").tobytes(),
             lang.astype("<u4").tobytes(), n.astype("<i8").tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(packed: bytes) -> Iterator[tuple[int, bytes, int]]:
    """(language, words joined by spaces, count) of each window."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    text, m, padded = np.frombuffer(raw, "<u4", 3).tolist()
    words = raw[12:12 + text].split(b" ")
    words = words if padded else [b"", *words]
    places = np.frombuffer(raw, "<u4", ORDER * m, 12 + text).reshape(ORDER, m)
    sizes = (places > 0).sum(axis=0).tolist()
    lang = np.frombuffer(raw, "<u4", m, 12 + text + 4 * ORDER * m).tolist()
    n = np.frombuffer(raw, "<i8", m, 12 + text + 4 * (ORDER + 1) * m).tolist()
    for own, size, k, c in zip(places.T.tolist(), sizes, lang, n):
        yield k, b" ".join([words[i] for i in own[:size]]), c


def windows(texts: DataFrame, tables: list[bytes], size_bits: int, buckets: int) -> DataFrame:
    """(``lang``, ``w1`` to ``w5``, ``n``): how often the texts hold each longest window, padded with nulls.

    Words that cannot be frequent are counted together, in a window of nulls. A block sends its windows
    packed, one value for each bucket of a hash; a bucket's windows are added up as they stream by.
    """
    shared = texts.sparkSession.sparkContext.broadcast(tables)

    def lead(block: Block, marks: Marks) -> Iterator[np.ndarray]:
        """The words, and lead columns of those after them; 0 from where a window ends."""
        start = np.flatnonzero(marks.codes[:block.own] > 0)
        yield marks.codes[start]
        inside, most = np.ones(len(start), bool), len(marks.hot) - 1
        for k in range(1, ORDER + 1):
            m = min(k, most)
            inside &= marks.hot[m][start + k - m]
            yield np.where(inside, marks.codes[start + k - 1], 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            if not block.langs:
                continue
            marks = Marks(block, shared.value, size_bits)
            every, *columns = lead(block, marks)
            # Rare words are one window of each language, which has number 0 throughout.
            owner = np.array(block.owner, np.int32)
            rare = np.flatnonzero(columns[0] == 0)
            total = np.bincount(owner[every[rare]], minlength=len(block.langs))
            columns = [np.delete(c, rare).astype(np.uint64) for c in columns]
            high, low = columns[0], columns[3]
            for c in columns[1:3]:
                high = high << np.uint64(CODE_BITS) | c
            low = low << np.uint64(CODE_BITS) | columns[4]
            order = np.lexsort((low, high))
            new = np.flatnonzero(np.concatenate((
                [True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)))[:len(order)])
            n = np.concatenate((total, np.diff(np.append(new, len(order)))))
            kinds = [np.concatenate((np.zeros(len(total), np.int32), c[order[new]].astype(np.int32))) for c in columns]
            lang = np.concatenate((np.arange(len(total)), owner[kinds[0][len(total):]]))
            mixed = np.zeros(len(n), np.uint64)
            for c in kinds:
                mixed = (mixed ^ np.where(c > 0, marks.hashes[c], np.uint64(0))) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
            bucket = (mixed % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = [(int(bucket[own[0]]), block.langs, _pack(block.words, [c[own] for c in kinds], lang[own], n[own]))
                    for own in np.split(order, cuts) if len(own)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.list_(pa.string()), pa.binary()))],
                                  ["bucket", "langs", "packed"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, {}

        def told() -> Iterator[pa.RecordBatch]:
            rows = [(lang, *p.decode("utf-8", "replace").split(" ")) if p else (lang,) for lang, p in sums]
            n = list(sums.values())
            for at in range(0, len(rows), 1 << 14):
                part = [r + (None,) * (ORDER + 1 - len(r)) for r in rows[at:at + (1 << 14)]]
                yield pa.record_batch([*(pa.array(c, pa.string()) for c in zip(*part)),
                                       pa.array(n[at:at + (1 << 14)], pa.int64())], ["lang", *WORDS, "n"])

        for batch in batches:
            for bucket, langs, packed in zip(*(batch.column(c) for c in range(3))):
                if bucket.as_py() != now:
                    yield from told()
                    now, sums = bucket.as_py(), {}
                names = langs.as_py()
                for k, phrase, c in _unpack(packed.as_py()):
                    sums[names[k], phrase] = sums.get((names[k], phrase), 0) + c
        yield from told()

    return (texts.mapInArrow(count, "bucket long, langs array<string>, packed binary")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(add, f"lang string, {', '.join(f'{w} string' for w in WORDS)}, n long"))


def counts(docs: DataFrame, least: int = 100, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(``lang``, ``words``, ``size``, ``phrase``, ``f``): phrases of up to five words that occur ``least`` times.

    The phrase of size 0 has the number of all words of the language.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size_bits = min(MOST_BITS, max(15, (size // BYTES_PER_COUNTER).bit_length()))
    tables: list[bytes] = []
    for orders in PASSES:
        tables += hot_tables(texts, tables, orders, least, size_bits)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = windows(texts, tables, size_bits, max(partitions, size // BYTES_PER_BUCKET))
    # A prefix that ends in padding is a shorter phrase once more.
    kept = sum((F.col(w).isNotNull().cast("int") for w in WORDS), F.lit(0))
    return (found.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
            .withColumn("size", kept).filter(F.bit_count("g") + F.col("size") == ORDER)
            .filter((F.col("size") == 0) | (F.col("f") >= least))
            .select("lang", F.array_compact(F.array(*WORDS)).alias("words"), "size", F.concat_ws(" ", *WORDS).alias("phrase"), "f"))


def scored(found: DataFrame) -> DataFrame:
    """Candidates with their lowest cut: ``lang``, ``phrase``, ``words``, ``size``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    total = found.filter("size = 0").select("lang", F.col("f").alias("n"))
    shorter = found.filter(f"size BETWEEN 1 AND {ORDER - 1}").select("lang", "phrase", "f")
    side = lambda name, count: shorter.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cut = F.array_join
    cuts = (found.filter("size >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "words", "size", F.col("f").alias("a"), "k",
                    cut(F.slice("words", 1, F.col("k")), " ").alias("left"),
                    cut(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
            .join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(total, "lang"))
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in "alnr"}
    score = F.expr(f"(1000 * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']})")
    lowest = (cuts.groupBy("lang", "phrase", "words", "size", "a", "n")
              .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")))
    return lowest.select("lang", "phrase", "words", "size", "a", "low.l", "low.r", "n", "low.score")


def independent(candidates: DataFrame, found: DataFrame, share: int = 100) -> DataFrame:
    """Without the candidates that a longer phrase with at least ``share`` percent of their occurrences holds."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda s: F.array_join(F.slice("words", s, m), " "))))
    longer = (found.filter("size >= 3").select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    held = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    return candidates.join(longer, ["lang", "phrase"], "left").filter(~held).drop("longer")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, share: int = 100,
                 top: int = 2000) -> DataFrame:
    """The ``top`` candidates of each language by score, occurrences and phrase, with ``rank`` from 1."""
    found = stages.stage(counts(docs, least, lang_col, text_col), "phrases")
    kept = independent(scored(found), found, share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A share of a language leaves its first rows only, so that no task gets a whole language.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = (kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top))
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
