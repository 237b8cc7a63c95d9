"""The registered queries of the corpus operators and, where it can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    chat, chunks, extract, fmindex, hamming, lines, packing, phrases, quality, simhash, suffix, warc, whiten)

CONTROL = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def public_id() -> F.Column:
    return F.col("_row")["doc_id"].alias("doc_id")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back from the output."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.render(chat.canonical(chat.records(rows.unionByName(extra))))
    turns = chat.read_back(F.col("formatted"))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return (chats.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(told, 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(table(spark, folder, "documents")).select(
        public_id(), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored; the label, where there is one, stands beside it."""
    docs = table(spark, folder, "documents")
    models = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, models).select("doc_id", "_score.p_quality", "_score.p_toxic", "_score.keep")


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = chunks.dedup_chunks(table(spark, folder, "documents"))
    return found.select(public_id(), "n_bytes", "n_chunks", chunks.n_removed().alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and their edits; neighbours are searched for ids divisible by 20."""
    found = simhash.fingerprints_with_neighbours(table(spark, folder, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_chars", "edited_sha256",
                        simhash.hex_of().alias("fingerprint"),
                        simhash.hex_of("edited_hi", "edited_lo").alias("edited_fingerprint"),
                        "near_edited", "near_next", "n_near")


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.dedup_suffixes(table(spark, folder, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_bytes", suffix.n_removed().alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash_near(spark: SparkSession, folder: str) -> DataFrame:
    found = hamming.near_groups(table(spark, folder, "documents"))
    return found.select(F.col("_id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = fmindex.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return (found.withColumn("n_hit", fmindex.n_hit()).select(
        F.col("_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated")))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        F.col("_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def op10_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(table(spark, folder, "embeddings")).select(
        F.col("_id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "whitened", "explained", "identity_error")


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes",
                        F.coalesce("actual", "digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                        F.col("refers_to"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_simhash_edits": op5_simhash_edits,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_simhash_near": op7_simhash_near,
    "op8_decontaminate": op8_decontaminate,
    "op9_packing": op9_packing,
    "op10_html_extract": op10_html_extract,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
}

# Text escapes of the template, for the length of the formatted text.
ESCAPED = "{0}"
for _plain, _coded in chat.ESCAPES:
    ESCAPED = f"replace({ESCAPED}, '{_plain}', '{_coded}')"

ORACLE = {
    "op1_chat_format": f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
s AS (SELECT *, {ESCAPED.format("role")} || {ESCAPED.format("text")} AS esc,
  CASE WHEN role = 'assistant' THEN text ELSE '' END AS lt FROM r),
g AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
  string_agg(lt, '' ORDER BY turn, role, text) AS loss,
  CAST(sum(length(esc) + {len(chat.TURN + chat.BODY + chat.END)}) AS BIGINT) AS formatted_chars FROM s GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars FROM g""",
    "op2_line_dedup": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(f.owner <> k.doc_id, false) AS lost FROM k LEFT JOIN f ON k.key = f.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op6_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, array_slice(b, i, i + 49) AS s FROM (SELECT *, unnest(range(1, n - 48)) AS i FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
h AS (SELECT w.doc_id, w.i FROM w JOIN f ON w.s = f.s WHERE f.m < w.doc_id),
k AS (SELECT *, CASE WHEN i - lag(i) OVER o > 50 THEN 1 ELSE 0 END AS new FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM k),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 49 AS z FROM g GROUP BY doc_id, run),
p AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_spans, CAST(sum(z - a + 1) AS BIGINT) AS n_removed,
  list(a ORDER BY a) AS starts, list(z ORDER BY a) AS stops FROM r GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN starts IS NULL THEN b ELSE list_reduce(list_transform(range(1, len(starts) + 2),
    lambda j: CASE WHEN j > 1 AND stops[j - 1] = n OR coalesce(starts[j], n + 1) = coalesce(stops[j - 1], 0) + 1 THEN ''::BLOB
      ELSE array_slice(b, coalesce(stops[j - 1], 0) + 1, coalesce(starts[j], n + 1) - 1) END), lambda x, y: x || y) END) AS kept_sha256
FROM d LEFT JOIN p ON d.doc_id = p.doc_id""",
    "op8_decontaminate": r"""
WITH lo AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lo),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
p AS (SELECT item_id, least(10, len(ws)) AS m, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM b
  WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM p),
s AS (SELECT doc_id, m, ws, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM w) WHERE len(ws) >= m),
h AS (SELECT s.doc_id, s.i, s.m, w.item_id FROM (SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM s) s
  JOIN w ON s.m = w.m AND s.phrase = w.phrase),
hw AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(hi.n, 0) AS n_items,
  sha256(coalesce(hi.items, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id""",
    "op11_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
k AS (SELECT lang, ws, unnest(range(1, least(len(ws), 5) + 1)) AS k FROM p),
s AS (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM s)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
v AS (SELECT u.lang, u.phrase, u.f AS a, a.f AS l, b.f AS r, n.n, cut,
    1000::HUGEINT * u.f * n.n // (a.f::HUGEINT * b.f) AS score
  FROM u JOIN f a ON a.lang = u.lang AND a.phrase = array_to_string(u.ws[1:cut], ' ')
  JOIN f b ON b.lang = u.lang AND b.phrase = array_to_string(u.ws[cut + 1:], ' ') JOIN n ON n.lang = u.lang),
w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
x AS (SELECT lang, f, ws, k, unnest(range(2, k)) AS m FROM c),
y AS (SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS i FROM x),
z AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS f FROM y GROUP BY 1, 2),
q AS (SELECT w.* FROM w LEFT JOIN z ON w.lang = z.lang AND w.phrase = z.phrase WHERE z.f IS NULL OR 100 * z.f < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score FROM q QUALIFY rank <= 2000""",
    "op13_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
g AS (SELECT p.*, first, list_transform(range(0, 8), lambda i: CAST('0x' || substr(p.h, 5 * i + 1, 5) AS BIGINT)) AS v
  FROM p JOIN f ON p.h = f.h)
SELECT page_id, octet_length(b) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM g""",
}
