"""Suffix-array dedup: bytes under 50-byte strings that a document with a smaller id also has.

One suffix array of everything cannot be sorted in one place, so suffixes are dealt
out by content. In every 50-byte window the 16-gram of the smallest hash is its
anchor; equal windows have equal anchors, so all copies of a window meet in the
bucket of its anchor. Windows of one anchor travel together as a context: the bytes
from its first window's start to its last window's end.

1. Whole copies go first: of equal texts only the smallest id stays. The rest is packed into chunks.
   Anchors that only one document has cannot carry a repeat. Each chunk sends its different anchors
   to buckets; a bucket tells each chunk which of them another chunk has too.
2. Each chunk sends the contexts of anchors that are told or that several of its own documents have.
   Of equal contexts in a chunk only those of the smallest id travel, their bytes once: the others
   are repeats of it. At the edges of a passage that very many documents share all contexts differ,
   though the anchor is one. Anchors with many different contexts are hot: their windows travel one
   by one, to the bucket of the window's own hash, so that only equal windows meet in one place,
   one for each chunk.
3. Each bucket sorts the windows of its contexts in two stages: suffixes smaller than
   their successors directly, the others induced by bucket scans. Adjacent common
   prefixes of 50 bytes make groups, and windows whose group has a smaller id are
   removed from their document.

Nothing is sampled or capped. Buckets and chunks grow in number with the corpus. Texts travel compressed.

Defined cases: null or empty text, and texts below the length, lose nothing; rows
with the same id are one document; rows without an id come after all others; what is
kept may end inside a character, so it is bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import text as T

GRAM = 16
# Bytes handled at once, and the low bits of a key that hold a place among them.
PIECE, PLACE_BITS = 1 << 17, 24
# Text per chunk, per bucket of anchors and of contexts.
CHUNK_BYTES, ANCHOR_BYTES, CONTEXT_BYTES = 6_000_000, 16_000_000, 6_000_000
# A bucket is sorted in so many parts one after the other; a task holds some 50 bytes for each byte of a part.
PARTS = 16
# Contexts that a task of step 2 holds at once.
CONTEXTS_AT_ONCE = 60_000
# An anchor with more different contexts than this is hot: its windows are dealt out one by one.
HOT_CONTEXTS = 4_096


def rolling_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, the first byte the highest; shorter by 7."""
    v = data.astype(np.uint64)
    for s in (1, 2, 4):
        v = (v[:-s] << np.uint64(8 * s)) | v[s:]
    return v


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each place on; shorter by 15."""
    v = rolling_words(data)
    h = v[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += v[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(30))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text number, first window start, last window start, anchor hash)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    h = gram_hashes(data)
    keys = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    place = (sliding_min(keys, length - GRAM + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    start = np.flatnonzero(owner[:len(data) - length + 1] == owner[length - 1:])
    if not len(start):
        return anchors([], length)
    place = place[start]
    edge = np.flatnonzero((np.diff(place) != 0) | (np.diff(start) != 1))
    first, last = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(start) - 1]))
    who = owner[start[first]]
    return who, start[first] - begin[who], start[last] - begin[who], h[place[first]]


def pieces(texts: list[bytes], length: int, piece: int = PIECE) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, long ones in parts that share length - 1 bytes, so that each window is in one part."""
    who, offset, part, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), piece):
            own = text[at:at + piece + length - 1]
            if size + len(own) > 2 * piece and part:
                yield who, offset, part
                who, offset, part, size = [], [], [], 0
            who.append(i)
            offset.append(at)
            part.append(own)
            size += len(own)
    if part:
        yield who, offset, part


# --- chunks -----------------------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


CHUNK = pa.schema([(c, pa.binary()) for c in ("ids", "keys", "sizes", "texts")])


def _chunks(chunk_bytes: int):
    """(_id, _key, _text) packed into chunks of at most ``chunk_bytes``; a longer text is a chunk of its own."""

    def packed(ids: list, keys: list, texts: list) -> pa.RecordBatch:
        row = (_pack(np.array(ids, "<i8")), _pack(np.array(keys, "<i8")),
               _pack(np.array([len(t) for t in texts], "<i8")),
               zstandard.ZstdCompressor(level=3).compress(b"".join(texts)))
        return pa.record_batch([pa.array([c], pa.binary()) for c in row], schema=CHUNK)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, texts, size = [], [], [], 0
        for batch in batches:
            for i, k, t in zip(*(batch.column(c) for c in range(3))):
                text = t.as_py().encode("utf-8", "surrogatepass")
                if texts and size + len(text) > chunk_bytes:
                    yield packed(ids, keys, texts)
                    ids, keys, texts, size = [], [], [], 0
                ids.append(i.as_py())
                keys.append(k.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield packed(ids, keys, texts)

    return chunks


def _texts(sizes: bytes, texts: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(texts)
    ends = np.cumsum(_unpack(sizes, "<i8")).tolist()
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]


# --- step 1: which anchors are shared ---------------------------------------------------------

SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
TOLD = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])


def _gaps(sorted_hashes: np.ndarray) -> bytes:
    return _pack(np.diff(sorted_hashes, prepend=np.uint64(0)))


def _sums(gaps: bytes) -> np.ndarray:
    return np.cumsum(_unpack(gaps, "<u8"), dtype=np.uint64)


def _send_anchors(length: int, buckets: int):
    """The different anchors of each chunk, and how many different contexts each has there, at most 65,535."""

    def route(chunk: int, hashes: np.ndarray, sides: np.ndarray) -> pa.RecordBatch:
        # Anchors are the smallest hashes about them, so their high bits are mostly 0: the low ones deal them out evenly.
        bucket = (hashes & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)
        order = np.lexsort((sides, hashes, bucket))
        hashes, sides = hashes[order], sides[order]
        new = np.concatenate(([True], (np.diff(hashes) != 0) | (np.diff(sides) != 0)))
        hashes = hashes[new]
        at = np.flatnonzero(np.concatenate(([True], np.diff(hashes) != 0)))
        counts = np.minimum(np.diff(np.append(at, len(hashes))), 65_535).astype("<u2")
        hashes = hashes[at]
        bucket = bucket[order][new][at]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        rows = [(int(bucket[a]), chunk, _gaps(hashes[a:b]), _pack(counts[a:b]))
                for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(bucket)])))]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), SENT.types)], schema=SENT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, sizes, texts in zip(*(batch.column(c) for c in range(3))):
                held = []
                for _, _, part in pieces(_texts(sizes.as_py(), texts.as_py()), length):
                    owner, first, last, h = anchors(part, length)
                    if not len(h):
                        continue
                    words = rolling_words(np.frombuffer(b"".join(part), np.uint8))
                    own = np.array([len(t) for t in part])
                    begin = (np.cumsum(own) - own)[owner]
                    sides = words[begin + first] * np.uint64(0x9E3779B97F4A7C15)
                    held.append((h, sides ^ words[begin + last + length - 8] + (last - first).astype(np.uint64)))
                if held:
                    yield route(chunk.as_py(), *map(np.concatenate, zip(*held)))

    return send


def _shared(hot_contexts: int):
    """To each chunk, those of its anchors that another chunk has too, and which of them are hot."""

    def shared(group: pa.Table) -> pa.Table:
        chunks = group.column("chunk").to_numpy()
        hashes = [_sums(h) for h in group.column("hashes").to_pylist()]
        counts = np.concatenate([_unpack(c, "<u2") for c in group.column("counts").to_pylist()]).astype(np.int64)
        place = np.repeat(np.arange(len(chunks), dtype=np.int32), [len(h) for h in hashes])
        h = np.concatenate(hashes)
        del hashes
        order = np.argsort(h, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
        size = np.diff(np.append(edge, len(h)))
        hot = np.empty(len(h), bool)
        hot[order] = np.repeat(np.add.reduceat(counts[order], edge) > hot_contexts, size)
        told = np.empty(len(h), bool)
        told[order] = np.repeat(size > 1, size)
        told |= hot
        rows = []
        for k in np.unique(place[told]).tolist():
            a, b = np.searchsorted(place, [k, k + 1])
            own = told[a:b]
            rows.append((int(chunks[k]), _gaps(h[a:b][own]), _pack(hot[a:b][own])))
        columns = list(zip(*rows)) or [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, TOLD.types)], schema=TOLD)

    return shared


# --- step 2: contexts -------------------------------------------------------------------------

CONTEXT = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), *[(c, pa.binary()) for c in (
    "ids", "keys", "starts", "sizes", "parts", "bytes")]])


def _send_contexts(length: int, buckets: int):
    """Compressed columns of many contexts: those for one bucket in a row; known ones are spans to remove.

    Texts go by ascending id. A context that a smaller id of the chunk has is known to be a repeat.
    One that comes again in the same text has size 0 behind the first and no bytes. What was seen is
    forgotten from time to time, which sends more and changes no result.
    """
    digest = xxhash.xxh3_128_digest

    def row(bucket: int, slots: list) -> tuple:
        docs, keys, raw, starts, parts = zip(*slots)
        times = [len(s) for s in starts]
        sizes = np.zeros(sum(times), "<u4")
        sizes[np.cumsum(times) - times] = [len(r) for r in raw]
        return (bucket, False, *[_pack(np.repeat(np.array(c, "<i8"), times)) for c in (docs, keys)],
                _pack(np.array([a for s in starts for a in s], "<i8")), _pack(sizes),
                _pack(np.array(parts, "u1")), zstandard.ZstdCompressor(level=3).compress(b"".join(raw)))

    def known_row(bucket: int, spans: list) -> tuple:
        docs, keys, start, stop = (np.array(c, "<i8") for c in zip(*spans))
        return (bucket, True, _pack(docs), _pack(keys), _pack(start), _pack((stop - start).astype("<u4")),
                *[_pack(np.empty(0, "u1"))] * 2)

    def send(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return CONTEXT.empty_table()
        ids, keys = (_unpack(chunk.column(c)[0].as_py(), "<i8") for c in ("ids", "keys"))
        texts = _texts(*(chunk.column(c)[0].as_py() for c in ("sizes", "texts")))
        order = np.lexsort((keys, ids))
        order = order[np.concatenate(([True], (np.diff(ids[order]) != 0) | (np.diff(keys[order]) != 0)))]
        ids, keys, texts = ids[order], keys[order], [texts[i] for i in order.tolist()]
        told = np.concatenate([np.empty(0, np.uint64), *map(_sums, answers.column("hashes").to_pylist())])
        hot = np.concatenate([np.empty(0, bool), *(_unpack(c, "?") for c in answers.column("hot").to_pylist())])
        hot = set(told[hot].tolist())

        found = [(np.array(who)[owner], np.array(offset)[owner] + first, last - first + length, h)
                 for who, offset, part in pieces(texts, length) for owner, first, last, h in [anchors(part, length)]]
        who, start, size, h = map(np.concatenate, zip(*found)) if found else anchors([], length)
        del found
        order = np.lexsort((who, h))
        edge = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0))) if len(h) else np.empty(0, np.int64)
        times = np.diff(np.append(edge, len(h)))
        own = ids[who[order]]
        several = np.empty(len(h), bool)
        several[order] = np.repeat(own[edge] != own[edge + times - 1], times) if len(h) else False
        del order, own
        several |= np.isin(h, told)

        least: dict[bytes, list] = {}
        routed: dict[int, list] = {}
        known: list = []

        def remember(doc: int, key: int, a: int, b: int) -> None:
            if known and known[-1][:2] == [doc, key] and known[-1][2] <= a <= known[-1][3]:
                known[-1][3] = max(known[-1][3], b)
            else:
                known.append([doc, key, a, b])

        def meet(doc: int, key: int, a: int, raw: bytes, value: int) -> None:
            mark = digest(raw)
            seen = least.get(mark)
            if seen is None or seen[0] == doc and seen[1] != key:
                least[mark] = slot = (doc, key, raw, [a], value // buckets % PARTS)
                routed.setdefault(value % buckets, []).append(slot)
            elif seen[0] == doc:
                seen[3].append(a)
            else:
                remember(doc, key, a, a + len(raw))

        rows: list[tuple] = []

        def flush() -> None:
            rows.extend(row(bucket, slots) for bucket, slots in routed.items())
            if known:
                rows.append(known_row(known[0][0] % buckets, known))
            for held in (routed, least, whole, known):
                held.clear()

        whole: dict[bytes, int] = {}
        for j in np.flatnonzero(several).tolist():
            i, a, n, anchor = int(who[j]), int(start[j]), int(size[j]), int(h[j])
            doc, key, raw = int(ids[i]), int(keys[i]), texts[i][a:a + n]
            if anchor not in hot:
                meet(doc, key, a, raw, anchor)
            elif whole.setdefault(digest(raw), doc) < doc:
                remember(doc, key, a, a + n)
            else:
                for k in range(n - length + 1):
                    window = raw[k:k + length]
                    meet(doc, key, a + k, window, xxhash.xxh3_64_intdigest(window))
            if len(least) + len(whole) + len(known) >= CONTEXTS_AT_ONCE:
                flush()
        flush()
        columns = list(zip(*rows)) or [[]] * len(CONTEXT)
        return pa.table([pa.array(c, t) for c, t in zip(columns, CONTEXT.types)], schema=CONTEXT)

    return send


# --- step 3: the suffixes of a bucket ---------------------------------------------------------

def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` suffixes of ``text`` in order of their first ``depth`` bytes.

    ``text`` holds strings that each end with a 0, the smallest byte. A suffix is small if it is
    smaller than its successor. Small suffixes are sorted directly; a large one comes right after
    its successor was placed, in the bucket of its own first byte, ahead of the small ones there.
    Besides the wanted suffixes those are ordered that a chain of large ones ends at.
    """
    n = len(text)
    place = np.arange(n, dtype=np.int32)
    rises = np.append(text[1:] > text[:-1], True)
    following = np.where(np.append(text[1:] != text[:-1], True), place, np.int32(n - 1))
    following = np.minimum.accumulate(following[::-1])[::-1]
    small = rises[following] | (text == 0)
    ends = np.where(small, place, np.int32(n - 1))
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    chain = np.flatnonzero(wanted & ~small)
    marks = np.zeros(n + 1, np.int32)
    marks[chain + 1] = 1
    marks -= np.bincount(ends[chain] + 1, minlength=n + 1).astype(np.int32)
    used = wanted | (np.cumsum(marks[:-1], dtype=np.int32) > 0)
    del place, following, ends, marks, rises

    direct = _sort_direct(_padded_words(text, depth), np.flatnonzero(used & small), depth)
    by_byte = np.searchsorted(text[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        found = pending[byte]
        rows = np.concatenate(found) if found else np.empty(0, np.int64)
        placed = [rows]
        while len(rows):
            rows = rows - 1
            rows = rows[(rows >= 0) & (text[rows] == byte) & used[rows]]
            placed.append(rows)
        placed.append(direct[by_byte[byte]:by_byte[byte + 1]])
        rows = np.concatenate(placed)
        order.append(rows)
        before = rows[rows > 0] - 1
        before = before[(text[before] > byte) & used[before]]
        head = text[before]
        kinds = np.argsort(head, kind="stable")
        cuts = np.flatnonzero(np.diff(head[kinds])) + 1
        for part in np.split(before[kinds], cuts) if len(before) else ():
            pending[int(text[part[0]])].append(part)
        pending[byte] = []
    order = np.concatenate(order)
    return order[wanted[order]]


def _padded_words(text: np.ndarray, depth: int) -> np.ndarray:
    return rolling_words(np.concatenate((text, np.zeros(depth + 16, np.uint8))))


def _sort_direct(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` bytes there, eight to a key."""
    return at[np.lexsort([words[at + k] for k in reversed(range(0, depth, 8))])]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it, up to ``depth``; the first has 0."""
    words = _padded_words(text, depth)
    found, at = np.zeros(len(order), np.uint8), np.arange(1, len(order))
    for k in range(0, depth, 8):
        differing = words[order[at - 1] + k] ^ words[order[at] + k]
        same = differing == 0
        rest = differing[~same]
        equal = sum(((rest >> np.uint64(8 * j)) == 0 for j in range(1, 8)), np.zeros(len(rest), np.int64))
        found[at[~same]] = np.minimum(depth, k + equal)
        at = at[same]
    found[at] = depth
    return found


def _repeats(length: int):
    """Spans to remove from the documents whose contexts met in a bucket."""

    def spans(ids: np.ndarray, keys: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Table:
        return pa.table([pa.array(c) for c in (ids, keys, start, stop)], ["_id", "_key", "start", "stop"])

    def repeats(group: pa.Table) -> pa.Table:
        told = {True: [], False: []}
        for known, *packed in zip(*(group.column(c).to_pylist() for c in CONTEXT.names[1:])):
            told[known].append(tuple(map(_unpack, packed, ("<i8", "<i8", "<i8", "<u4", "u1", "u1"))))
        found = [spans(i, k, a, a + n) for i, k, a, n, *_ in told[True]]
        if told[False]:
            # A context comes first with its size and bytes, then with size 0 for other places in its text.
            ids, keys, starts, sizes, parts, data = map(np.concatenate, zip(*told.pop(False)))
            head = sizes > 0
            place, sizes = parts[np.cumsum(head) - 1], sizes[head]
            for part in np.unique(parts):
                own, mine = parts == part, place == part
                found.append(sorted_part(ids[mine], keys[mine], starts[mine], head[mine], sizes[own], data[np.repeat(own, sizes)]))
        return pa.concat_tables(found)

    def sorted_part(all_ids: np.ndarray, all_keys: np.ndarray, all_starts: np.ndarray, head: np.ndarray,
                    sizes: np.ndarray, data: np.ndarray) -> pa.Table:
        ids, slot = all_ids[head], np.cumsum(head) - 1
        sizes = sizes.astype(np.int32) + np.int32(1)
        begin = np.cumsum(sizes, dtype=np.int32) - sizes
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        text, inside = np.zeros(sizes.sum(), np.uint8), np.ones(sizes.sum(), bool)
        inside[begin + sizes - 1] = False
        text[inside] = data + np.uint8(1)
        del data, inside
        last = np.repeat(begin + sizes - 1 - np.int32(length), sizes)
        wanted = np.arange(len(text), dtype=np.int32) <= last
        del last
        order = two_stage_order(text, wanted, length)
        heads = np.flatnonzero(common_prefixes(text, order, length) < length)
        who = ids[owner[order]]
        least = np.repeat(np.minimum.reduceat(who, heads), np.diff(np.append(heads, len(order))))
        repeated = np.zeros(len(text) + 1, bool)
        repeated[order] = least < who
        edges = np.flatnonzero(np.diff(np.concatenate(([False], repeated)).astype(np.int8)))
        a, b = edges[::2], edges[1::2]
        mine = owner[a]
        a, b = a - begin[mine], b - begin[mine] + length - 1
        # Spans of a context, once for each place where it starts.
        times = np.bincount(mine, minlength=len(ids))
        each = times[slot]
        at = np.repeat((np.cumsum(times) - times)[slot] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        place = np.repeat(np.arange(len(slot)), each)
        return spans(all_ids[place], all_keys[place], all_starts[place] + a[at], all_starts[place] + b[at])

    return repeats


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("_text")]
        yield pa.record_batch([batch.column("_id"), batch.column("_key"), pa.array(packed, pa.binary())],
                              ["_id", "_key", "packed"])


def repeated_spans(table: DataFrame, length: int = 50, chunk_bytes: int = CHUNK_BYTES,
                   hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(``_id``, ``_key``, ``spans``): sorted spans (start, stop), not yet joined, of documents with repeats.

    ``table`` has ``_id``, ``_text`` and ``_key``, a 64-bit hash of the text.
    """
    spark = table.sparkSession
    size = table.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    least_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor_buckets = max(least_buckets, int(size // ANCHOR_BYTES) + 1)
    context_buckets = max(least_buckets, int(size // CONTEXT_BYTES) + 1)
    first, second = T.wide_hash(F.col("_text"))
    prints = table.select("_id", first.alias("h1"), second.alias("h2"), F.octet_length("_text").alias("n"))
    least = prints.groupBy("h1", "h2").agg(F.min("_id").alias("least"))
    copies = stages.stage(prints.filter(F.col("n") >= length).join(least, ["h1", "h2"]).filter("_id > least")
                          .select("_id", F.col("h1").alias("_key"), "n").distinct(), "copies")

    rest = (table.filter(F.octet_length("_text") >= length)
            .join(copies.select("_id", "_key"), ["_id", "_key"], "left_anti").select("_id", "_key", "_text"))
    chunks = stages.stage(rest.mapInArrow(_chunks(chunk_bytes), "ids binary, keys binary, sizes binary, texts binary")
                          .withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    told = (chunks.select("chunk", "sizes", "texts").mapInArrow(
        _send_anchors(length, anchor_buckets), "bucket int, chunk long, hashes binary, counts binary")
        .groupBy("bucket").applyInArrow(_shared(hot_contexts), "chunk long, hashes binary, hot binary"))
    spans = (chunks.groupBy("chunk").cogroup(told.groupBy("chunk"))
             .applyInArrow(_send_contexts(length, context_buckets),
                           "bucket int, known boolean, ids binary, keys binary, starts binary, sizes binary, "
                           "parts binary, bytes binary")
             .groupBy("bucket").applyInArrow(_repeats(length), "_id long, _key long, start long, stop long"))
    whole = copies.select("_id", "_key", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("stop"))
    return (spans.unionByName(whole).groupBy("_id", "_key")
            .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")))


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   chunk_bytes: int = CHUNK_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``_id`` (null: none), ``n_bytes``, ``spans`` removed (start, stop; apart from each other) and ``kept``, the bytes left."""
    table = T.documents(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("_key"))
    spans = stages.stage(repeated_spans(table, length, chunk_bytes, hot_contexts), "repeats")
    packed = table.mapInArrow(_pack_texts, "_id long, _key long, packed binary")

    @F.pandas_udf("n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    def cut(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        expand, rows = zstandard.ZstdDecompressor().decompress, []
        for raw, start, stop in zip(texts, starts, stops):
            text, merged = expand(raw), []
            if start is not None:
                # Sorted by start: a span begins anew where it lies beyond all before it.
                reach = np.maximum.accumulate(stop)
                new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
                merged = list(zip(start[new].tolist(), reach[np.append(new[1:], len(stop)) - 1].tolist()))
            edges = [0, *(x for s in merged for x in s), len(text)]
            rows.append((len(text), [{"start": a, "stop": b} for a, b in merged],
                         b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))))
        return pd.DataFrame(rows, columns=["n_bytes", "spans", "kept"])

    return (packed.join(spans, ["_id", "_key"], "left").withColumn("_cut", cut("packed", F.col("spans")["start"], F.col("spans")["stop"]))
            .select(F.nullif("_id", F.lit(T.LAST_ID)).alias("_id"), "_cut.n_bytes", "_cut.spans", "_cut.kept"))


def n_removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
