"""Packing against the tokenizers library and the rules of a sequence."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer):
    """Each id lies in one piece with the right ids; sequences have no gaps and no padding."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for doc, pieces in docs.items():
        ids = [*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            part = np.array(ids[at:at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0


def test_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    check(queries.op9_packing(spark, FOLDER).collect(), texts, tokenizer)


def test_odd_rows(spark, tokenizer):
    texts = {1: None, 2: "", 3: "a<|endoftext|>b", 4: "long " * 5000, 5: "x" * 70000, 6: "é\x00\n"}
    df = spark.createDataFrame([(k, v, "clash", 7) for k, v in texts.items()],
                               "doc_id long, text string, ids string, offset int").repartition(3)
    rows = packing.pack(df, open_windows=2).select(
        F.col("_id").alias("doc_id"), "*", F.crc32("ids").alias("ids_crc32")).collect()
    check(rows, texts, tokenizer)


def test_null_id_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "c"), (3, "c")], "doc_id long, text string")
    rows = packing.pack(df).collect()
    assert sum(r._id is None for r in rows) >= 1
    assert sum(r.length for r in rows if r._id == 3) == 4
    assert packing.pack(df.limit(0)).count() == 0
