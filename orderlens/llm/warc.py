"""WARC archives: pages written as records, and records read back by boundary chains.

Writing. A page is a ``response`` record, or a ``revisit`` of the page of the smallest id
with the same payload. Records are strings; Spark's text writer puts the record end
(two line ends) behind each, so the files are plain WARC 1.1 in any file system that
Spark reaches, and payloads are not shuffled unless many pages are copies.

Reading. Spark's text reader cuts the files at the magic ``WARC/1.1`` line, also where a
payload holds it, so a piece is only a candidate. A task knows the places of its pieces
from the start of its split on; a candidate's header tells where its successor must
begin. The sums of earlier splits turn these into places in the file. Links inside a
split are followed in the task to the first place outside it; pointer jumping from the
start of every file then finds the splits' true first records, doubling the reach in each
round, and the chain inside each split keeps what can be reached. A magic inside a
payload is never reached. Payloads that were cut by one are put together again.

Defined cases: null html is an empty payload; a null url has no header line and is read
back as null; line ends in a url are percent-coded and white space round it goes; rows
without an id come after all others; rows that repeat id and payload are all the
response, or all revisits; payloads of fewer than ``least_bytes`` are all responses.
Other columns are not looked at. A file that does not begin with a record gives none; what
follows a damaged record in its file is not reached.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import text as T

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
MAGIC_BYTES = MAGIC.encode()
RECORD_END = "\r\n\r\n"
END_BYTES = RECORD_END.encode()
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
URN = "urn:page:"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "kind string, id long, refers_to long, url string, payload_bytes long, digest string, actual string"
FIELDS = [f.split()[0] for f in RECORD.split(", ")]
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]


# --- writing ----------------------------------------------------------------------------------

def base32(hex_digest: Column) -> Column:
    """The 40 hex digits of a SHA-1 as 32 base-32 digits: five of one are four of the other."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), digits, BASE32)


def revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """(``_id``, ``_digest``, ``_first``) of the pages whose payload a page of smaller id has."""
    marks = rows.filter(F.octet_length("_html") >= least_bytes).select("_id", "_digest")
    firsts = (marks.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
              .filter("_first < _last").select("_digest", "_first"))
    return marks.join(firsts, "_digest").filter("_id > _first").select("_id", "_digest", "_first").distinct()


def records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int, date: str) -> DataFrame:
    """One column ``record``: the pages as WARC records without the record end."""
    rows = pages.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(T.LAST_ID)).alias("_id"), F.col(url_col).cast("string").alias("_url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    rows = rows.withColumn("_digest", F.sha1("_html"))
    known = stages.stage(revisits(rows, least_bytes), "revisits")
    rows = rows.join(known, ["_id", "_digest"], "left")

    def urn(c: str) -> Column:
        return F.concat(F.lit(f"<{URN}"), F.when(F.col(c) < T.LAST_ID, F.col(c).cast("string")).otherwise(""), F.lit(">\r\n"))

    again = F.col("_first").isNotNull()
    url = F.replace(F.replace(F.trim("_url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.concat(F.lit(HTTP), F.octet_length("_html").cast("string"), F.lit(RECORD_END),
                     F.when(again, "").otherwise(F.col("_html")))
    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn("_id"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), base32(F.col("_digest")), F.lit("\r\n"),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn("_first"), F.lit(f"WARC-Profile: {REVISIT}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "))
    return (rows.withColumn("_block", block).select(F.concat(
        head, F.octet_length("_block").cast("string"), F.lit(RECORD_END), F.col("_block")).alias("record")))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", per_file: int = 1_000_000) -> None:
    """The archives of ``pages`` below ``path``, at most ``per_file`` records in a file."""
    (records(pages, id_col, url_col, html_col, least_bytes, date).write
     .option("lineSep", RECORD_END).option("maxRecordsPerFile", per_file).text(path))


# --- reading ----------------------------------------------------------------------------------

def header(piece: bytes) -> tuple[int, int, dict[bytes, bytes]] | None:
    """Length of the header, of the block, and the fields of a piece that begins behind a magic."""
    end = piece.find(END_BYTES)
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    size = fields.get(b"content-length", b"")
    if not (size.isdigit() and len(size) < 16 and b"warc-type" in fields):
        return None
    return end + len(END_BYTES), int(size), fields


def page_of(urn: bytes | None) -> int | None:
    name = (urn or b"").strip(b"<>")
    digits = name[len(URN):] if name.startswith(URN.encode()) else b""
    return int(digits) if digits.lstrip(b"-").isdigit() and len(digits) < 20 else None


def described(fields: dict[bytes, bytes], block: bytes | None) -> tuple:
    """The values of ``FIELDS``; without a block its size and digest are open."""
    said = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
    kind, url = fields[b"warc-type"].decode("utf-8", "replace"), fields.get(b"warc-target-uri")
    size = actual = None
    if block is not None:
        end = block.find(END_BYTES)
        http, payload = (block[:end], block[end + len(END_BYTES):]) if end >= 0 else (b"", block)
        if kind == "revisit":
            told = [v.strip() for n, _, v in (x.partition(b":") for x in http.split(b"\r\n"))
                    if n.strip().lower() == b"content-length"]
            size = int(told[0]) if told and told[0].isdigit() else None
        else:
            size, actual = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (kind, page_of(fields.get(b"warc-record-id")), page_of(fields.get(b"warc-refers-to")),
            None if url is None else url.decode("utf-8", "replace"), size, said or None, actual)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``split``, ``value``): what the magic separates, in file order within a split.

    ``file`` is a 64-bit hash of the path.
    """
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.col("value").cast("binary").alias("value")))


def placed(batch: pa.RecordBatch, state: dict) -> Iterator[tuple[int, int, int, bytes]]:
    """(file, split, place from the start of the split's first piece, piece) for the rows of a task."""
    for file, split, value in zip(*(batch.column(c) for c in range(3))):
        key, piece = (file.as_py(), split.as_py()), value.as_py()
        if state.get("key") != key:
            state["key"], state["at"] = key, 0
        yield *key, state["at"], piece
        state["at"] += len(piece) + len(MAGIC_BYTES)


PIECE = (f"file long, split long, at long, size long, next long, exit long, head long, whole boolean, {RECORD}")
PIECE_NAMES = [f.split()[0] for f in PIECE.split(", ")]
PIECE_TYPES = [*[pa.int64()] * 7, pa.bool_(), *TYPES]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece with what its header tells, and where the links inside its split lead."""
    state: dict = {}
    rows: list[list] = []

    def flush() -> Iterator[pa.RecordBatch]:
        exits = {}
        for row in reversed(rows):
            if row[4] is not None:
                # A link leads forward, so its target is settled already.
                row[5] = exits[row[2]] = exits.get(row[4], row[4])
        for k in range(0, len(rows), 1 << 14):
            columns = zip(*rows[k:k + (1 << 14)])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, PIECE_TYPES)], PIECE_NAMES)
        rows.clear()

    for batch in batches:
        for file, split, at, piece in placed(batch, state):
            if rows and rows[-1][:2] != [file, split]:
                yield from flush()
            found = header(piece)
            if not found:
                rows.append([file, split, at, len(piece), None, None, None, None, *[None] * len(FIELDS)])
                continue
            head, size, fields = found
            whole = len(piece) == head + size + len(END_BYTES) and piece.endswith(END_BYTES)
            after = at + head + size + len(END_BYTES) + len(MAGIC_BYTES)
            rows.append([file, split, at, len(piece), after, None, head, whole,
                         *described(fields, piece[head:head + size] if whole else None)])
    yield from flush()


def bases(placed_pieces: DataFrame) -> DataFrame:
    """(``file``, ``split``, ``base``): place in the file of each split's first piece."""
    sizes = placed_pieces.groupBy("file", "split").agg(
        F.sum(F.col("size") + len(MAGIC_BYTES)).alias("total"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def entries(candidates: DataFrame) -> DataFrame:
    """(``file``, ``place``) of the true records that a link from another split, or the file's start, leads to.

    ``candidates`` has ``file``, ``place`` and ``exit``, where the links inside its split lead. In each round
    what is reached marks its jump's target, and every jump is followed by that of its target.
    """
    start = len(MAGIC_BYTES)
    targets = candidates.select("file", F.col("exit").alias("place")).distinct()
    first = candidates.filter(F.col("place") == start)
    others = candidates.filter(F.col("place") != start).join(targets, ["file", "place"], "left_semi")
    nodes = stages.stage(first.unionByName(others).select(
        "file", "place", F.col("exit").alias("jump"), (F.col("place") == start).alias("reached")), "links")
    while True:
        target = nodes.select("file", F.col("place").alias("jump"), F.col("jump").alias("then"))
        hit = nodes.filter("reached").select("file", F.col("jump").alias("place")).distinct().withColumn("hit", F.lit(True))
        nodes = stages.stage(
            nodes.join(target, ["file", "jump"], "left").join(hit, ["file", "place"], "left")
            .select("file", "place", F.col("then").alias("jump"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached")),
            "links")
        if nodes.filter("jump IS NOT NULL").isEmpty():
            return nodes.filter("reached").select("file", "place")


def _chain(group: pa.Table) -> pa.Table:
    """The records of a split that can be reached from its first true one."""
    following = dict(zip(group["at"].to_pylist(), group["next"].to_pylist()))
    at, found = min(group["entry"].to_pylist()), []
    while at in following:
        found.append(at)
        at = following[at]
    n = len(found)
    return pa.table([pa.array(group["file"].to_pylist()[:1] * n, pa.int64()),
                     pa.array(group["split"].to_pylist()[:1] * n, pa.int64()), pa.array(found, pa.int64())],
                    ["file", "split", "at"])


def _assembled(group: pa.Table) -> pa.Table:
    """A record whose payload holds the magic, from its pieces."""
    group = group.sort_by("place")
    # A magic may also end behind the block, with the record's own line end.
    raw = MAGIC_BYTES.join(group["value"].to_pylist()) + MAGIC_BYTES
    head, size, fields = header(raw)
    row = described(fields, raw[head:head + size])
    return pa.table([pa.array([v], t) for v, t in zip(row, TYPES)], FIELDS)


def _gathered(spark: SparkSession, path: str, open_records: DataFrame) -> DataFrame:
    """The fields of records that are cut by a magic in their payload (``file``, ``place``, ``stop``)."""

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            rows = [(f, s, at, len(v), v) for f, s, at, v in placed(batch, state)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 4, pa.binary()])],
                                      ["file", "split", "at", "size", "value"])

    # Splits may be laid out anew in this pass, so its pieces are placed by its own sums.
    files = open_records.select("file").distinct()
    copy = stages.stage(pieces(spark, path).mapInArrow(raw, "file long, split long, at long, size long, value binary")
                        .join(files, "file", "left_semi"), "pieces")
    where = copy.select("file", "split", "at").join(bases(copy), ["file", "split"]).select(
        "file", "split", "at", (F.col("base") + F.col("at")).alias("place"))
    before = W.partitionBy("file").orderBy("place")
    owned = (where.join(open_records, ["file", "place"], "left")
             .withColumn("owner", F.last(F.when(F.col("stop").isNotNull(), F.struct(F.col("place").alias("begin"), "stop")),
                                         ignorenulls=True).over(before))
             .filter("place < owner.stop")
             .select("file", "split", "at", "place", F.col("owner.begin").alias("begin")))
    return (copy.select("file", "split", "at", "value").join(owned, ["file", "split", "at"])
            .groupBy("file", "begin").applyInArrow(_assembled, RECORD))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives below ``path``: the columns of ``RECORD``.

    ``actual`` is the digest of the payload as it was read, for responses; ``digest`` what the header says.
    """
    found = stages.stage(pieces(spark, path).mapInArrow(_candidates, PIECE), "candidates")
    base = stages.stage(bases(found), "splits")
    links = found.filter("next IS NOT NULL").select("file", "split", "at", "next", "exit").join(base, ["file", "split"])
    links = links.select("file", "split", "at", "next", (F.col("base") + F.col("at")).alias("place"),
                         (F.col("base") + F.col("exit")).alias("exit"))
    # Only a file whose first piece is empty begins with a record.
    begins = found.filter("split = 0 AND at = 0 AND size = 0").select("file")
    true = entries(links.select("file", "place", "exit").join(begins, "file", "left_semi"))
    entry = (links.join(true, ["file", "place"]).groupBy("file", "split").agg(F.min("at").alias("entry")))
    chain = stages.stage(links.select("file", "split", "at", "next").join(entry, ["file", "split"])
                         .groupBy("file", "split").applyInArrow(_chain, "file long, split long, at long"), "chain")
    kept = found.join(chain, ["file", "split", "at"])
    cut = stages.stage(
        kept.filter("NOT whole").join(base, ["file", "split"])
        .select("file", (F.col("base") + F.col("at")).alias("place"),
                (F.col("base") + F.col("next") - len(RECORD_END) - len(MAGIC)).alias("stop")), "cut")
    whole = kept.filter("whole").select(FIELDS)
    return whole if cut.isEmpty() else whole.unionByName(_gathered(spark, path, cut))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = 0) -> DataFrame:
    """The records of ``pages``, written to a stage of archives and read back."""
    spark = pages.sparkSession
    path = stages.new_path(spark, "warc")
    write(pages, path, id_col, url_col, html_col, least_bytes)
    return read(spark, path)
