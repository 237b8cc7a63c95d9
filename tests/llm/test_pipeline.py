"""Every stage of the pipeline against a plain version, on what its predecessor kept."""

import hashlib
import os
import re
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
import test_fmindex  # noqa: E402
import test_hamming  # noqa: E402
import test_packing  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from orderlens import stages  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def results(spark):
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        docs = found[name] = stages.stage(step(spark, docs, FOLDER), name)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def strip_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(docs):
    owner = {}
    for doc in sorted(docs):
        for line in docs[doc].split("\n"):
            owner.setdefault(strip_key(line), doc)
    return {doc: "\n".join(x for x in text.split("\n") if len(strip_key(x)) < 10 or owner[strip_key(x)] == doc)
            for doc, text in docs.items()}


def test_quality_keeps_good_documents(spark, results):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r.doc_id for r in results["quality"].select("doc_id").collect()}
    rows = labels.collect()
    good = [r.doc_id for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id for r in rows if r.quality == 0 or r.toxic == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d not in kept for d in bad) >= 0.9 * len(bad)


def test_lines(results):
    assert texts(results["line_dedup"]) == plain_lines(texts(results["quality"]))


def test_near_duplicates(results):
    before = texts(results["line_dedup"])
    roots = test_hamming.brute(sorted((k, test_hamming.fingerprint(v)) for k, v in before.items()))
    assert texts(results["near_dedup"]) == {k: v for k, v in before.items() if roots[k] == k}


def test_decontamination(spark, results):
    before, after = texts(results["near_dedup"]), texts(results["decontaminate"])
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 10]) for _, t in items for w in [test_fmindex.words(t)]
               for i in range(max(1, len(w) - 9))}
    assert before.keys() == after.keys()
    for doc, text in before.items():
        own, hit = test_fmindex.words(text), set()
        for i in range(len(own)):
            if tuple(own[i:i + 10]) in windows:
                hit.update(range(i, i + 10))
        assert test_fmindex.words(after[doc]) == [w for i, w in enumerate(own) if i not in hit]
        if not hit:
            assert after[doc] == text
    rows = results["decontaminate"].filter(F.char_length("text") != F.col("n_chars"))
    assert rows.count() == 0


def test_sequences(results):
    import public_tokenizers
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(results["packing"].collect(), texts(results["decontaminate"]), tokenizer)


def test_columns_and_odd_tables(spark):
    """Nulls everywhere, repeated rows, clashing names, and no rows."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, _id string, kept string, "
              "`a.b` int")
    rows = [(None, None, None, None, None, "x", "y", 1), (1, "", None, None, None, "x", "y", 1),
            (2, "the same line here\nand more", "en", "s", 5, "x", "y", 1)] + [
            (3, "the same line here\nother", "en", "s", 5, "x", "y", 1)] * 2
    df = spark.createDataFrame(rows, schema)
    for table in (df, df.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            table = stages.stage(step(spark, table, FOLDER), name)
            if name != "packing":
                assert table.columns == df.columns
        assert table.filter("length < 1").count() == 0


def test_line_operator(spark):
    from orderlens.llm import lines
    docs = {i: "\n".join(f"line number {(i * j) % 17}  " if j % 3 else f" LINE Number {j}\t" for j in range(i % 9))
            for i in range(80)}
    docs |= {90: "short\nshort\n\n", 91: "short", 92: "Line Number 3\n" * 4000, 93: "é" * 10, 94: "É" * 10}
    df = spark.createDataFrame([(k, v, 1) for k, v in docs.items()], "doc_id long, text string, lost int")
    want = plain_lines(docs)
    for batches, fanout in ((1, 2), (7, 2), (4, 3)):
        got = lines.dedup_lines(df, batches=batches, fanout=fanout).collect()
        assert {r._id: r.kept for r in got} == want
        assert all(r.n_lines - r.n_dropped == (want[r._id].count("\n") + 1 if r.n_lines > r.n_dropped else 0)
                   for r in got)


def test_chat_layouts_and_escapes(spark):
    import json

    from orderlens.llm import chat
    odd = "&amp; <|turn|> [INST] </s> &lt; \\ é😀 <|end|>"
    records = [
        {"messages": [{"role": "system", "content": odd}, {"role": "user", "content": ""}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": odd}], "id": 4},
        {"instruction": "do", "input": "", "output": odd}, {"instruction": "do", "input": "x", "output": "y"},
        {"prompt": odd, "completion": "c"}, {"prompt": None, "response": "r"}, {"question": "q", "answer": "a"},
        {"unknown": 1}, [1], {"messages": []}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(99, None)],
                               "id int, record string")
    made = chat.render(chat.canonical(df)).withColumn("back", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    rows = {r.id: r for r in made.collect()}
    assert all([tuple(t) for t in r.back] == [tuple(t) for t in r.chat.turns] for r in rows.values())
    assert [tuple(t) for t in rows[1].back] == [("user", "a"), ("assistant", odd)] and rows[1].loss == odd
    assert [tuple(t) for t in rows[3].back] == [("user", "do\n\nx"), ("assistant", "y")]
    assert [tuple(t) for t in rows[2].back] == [("user", "do"), ("assistant", odd)]
    assert rows[7].chat.layout is None and rows[8].back == [] and rows[99].back == [] and rows[9].back == []
    assert rows[4].chat.fingerprint != rows[5].chat.fingerprint
    assert "[INST]" not in rows[0].formatted and "</s>" not in rows[0].formatted
    assert hashlib.sha256(rows[5].loss.encode()).hexdigest() == hashlib.sha256(b"r").hexdigest()
