"""Collocations against counting every phrase by itself, in Python integers."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from orderlens.llm import phrases, queries

FOLDER = "/root/testdata/sf0.01"


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(docs, least, top=2000, share=100):
    """docs: (lang, text). Rows of the result, all numbers exact."""
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, *words[i:j]) for i in range(len(words)) for j in range(i + 1, min(len(words), i + 5) + 1))
    often = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    longest = Counter()
    for (lang, *words), c in often.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    longest[lang, *words[i:j]] = max(longest[lang, *words[i:j]], c)
    rows = []
    for (lang, *words), a in often.items():
        if 100 * longest[lang, *words] >= share * a and longest[lang, *words]:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows.append((lang, " ".join(words), a, f[lang, *words[:k]], f[lang, *words[k:]], n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_query(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = rows_of(queries.op11_collocations(spark, FOLDER))
    assert got == plain(docs, 100) and got


@pytest.mark.parametrize("least,top,share", [(2, 2000, 100), (3, 5, 100), (4, 2000, 50), (1, 2000, 100)])
def test_odd_texts(spark, least, top, share):
    rng = random.Random(least)
    words = ["a", "A", "b", "É", "é", "x y", "\x00", "<tag>", "'", "word", "\U0001f600"]
    docs = [(rng.choice(["en", "fr", None, "", "und"]), "".join(
        rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ",", "\x0b", "\r\n"])
        for _ in range(rng.randrange(40)))) for _ in range(60)]
    docs += [("en", None), (None, None), ("en", ""), ("en", " \t .,; "), ("de", "one word"), ("long", "a b c a b " * 400)]
    docs += [("es", "same row twice here now")] * 4 + [("tie", "p q. r s. t u")] * 5
    df = spark.createDataFrame([(None, *d, "w", 1, 2) for d in docs],
                               "doc_id long, lang string, text string, w1 string, f int, n int")
    got = rows_of(phrases.collocations(df, least=least, top=top, share=share))
    assert got == plain(docs, least, top, share)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(df).collect() == []


@pytest.mark.parametrize("block,part", [(7, 5), (50, 11), (1 << 20, 1 << 20)])
def test_blocks_lose_no_window(monkeypatch, block, part):
    """Windows of blocks that end inside a document, and of texts that are cut in parts."""
    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "PART", part)
    rng = random.Random(block)
    docs = [(rng.choice(["en", "fr"]), " ".join(rng.choice(["a", "b", "cc", "d.", "longer word"]) for _ in range(rng.randrange(60))))
            for _ in range(30)] + [("en", "x" * 100), ("en", "")]
    batch = pa.record_batch([pa.array(c) for c in zip(*docs)], ["lang", "text"])
    got, want, made = Counter(), Counter(), 0
    for b in phrases.blocks([batch]):
        made += 1
        codes = [*b.codes.tolist(), 0, 0, 0, 0]
        for i in range(b.own):
            window = codes[i:i + 5]
            window = window[:window.index(0)] if 0 in window else window
            if window:
                got[b.langs[b.owner[window[0]]], *(b.words[c].decode() for c in window)] += 1
    for lang, text in docs:
        for words in pieces(text):
            want.update((lang, *words[i:i + 5]) for i in range(len(words)))
    assert got == want and (made > 5) == (block < 100)


def test_products_beyond_64_bits(spark):
    """Scores from counts whose products need more than 64 bits, against Python."""
    a, l, r, n = 3_000_000_017, 5_000_000_021, 4_000_000_007, 900_000_000_011
    found = spark.createDataFrame(
        [("en", [], 0, "", n), ("en", ["x"], 1, "x", l), ("en", ["y"], 1, "y", r), ("en", ["x", "y"], 2, "x y", a)],
        "lang string, words array<string>, size int, phrase string, f long")
    assert [x.score for x in phrases.scored(found).collect()] == [1000 * a * n // (l * r)]


def test_rare_pairs_end_windows(spark):
    """Windows are longer than one word only where a pair can be frequent."""
    docs = spark.createDataFrame([("en", "north wind")] * 20 + [("en", f"once{i} upon{i} a{i} time{i}") for i in range(300)],
                                 "lang string, text string")
    tables = phrases.hot_tables(docs, [], [1, 2], 10, 15)
    tables += phrases.hot_tables(docs, tables, [3], 10, 15)
    made = phrases.windows(docs, tables, 15, 3).filter("w2 IS NOT NULL").select("w1", "w2").distinct().collect()
    assert ("north", "wind") in [tuple(r) for r in made] and len(made) < 5
    assert phrases.windows(docs, tables, 15, 3).agg({"n": "sum"}).first()[0] == 40 + 1200
