"""Decontamination against a word-by-word search, and the index against counting."""

import random
import re

import numpy as np
import pytest

from orderlens.llm import fmindex


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    out = {}
    for key, text in docs:
        own, hit, names = words(text), set(), set()
        for name, item in items:
            w = words(item)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                part = w[i:i + window]
                for at in range(len(own) - len(part) + 1):
                    if own[at:at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        names.add(name)
        out[key] = (len(own), len(hit), sorted(names))
    return out


@pytest.mark.parametrize("block_bytes", [16_000_000, 60])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(3)
    voc = ["aa", "Bb", "cç", "d1", "É", "ff"]
    items = [(str(i), " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 12, 15, 15, 30])]
    items[1] = ("1", "zz")
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(rng.choice(items)[1] if rng.random() < .5 else
                         " ".join(rng.choice([*voc, "x", "y"]) for _ in range(rng.randrange(15))))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "!!! --"), (103, items[7][1].upper() * 3), (104, " ".join([items[5][1]] * 500))]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, spans string, n_words int")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = brute(docs, items)
    found = fmindex.find_leaks(df, bench, shard_words=300, block_bytes=block_bytes)
    got = {r._id: (r.n_words, r.n_hit, list(r["items"]))
           for r in found.withColumn("n_hit", fmindex.n_hit()).collect()}
    assert got == want
    kept = {r._id: r for r in fmindex.decontaminate(df, bench, block_bytes=block_bytes).collect()}
    for key, text in docs:
        assert len(words(kept[key].kept)) == want[key][0] - want[key][1]
        if not want[key][1]:
            assert kept[key].kept == (text or "")
        assert kept[key]._row.spans == "clash"


def test_empty_tables_and_nulls(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (1, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "a b"), (2, None)], "item_id long, text string")
    got = sorted(((r._id, r.n_words, r["items"]) for r in fmindex.find_leaks(df, bench).collect()), key=str)
    assert got == [(1, 0, []), (1, 0, []), (None, 2, [""])]
    assert fmindex.find_leaks(df.limit(0), bench).count() == 0
    assert {r.n_words for r in fmindex.find_leaks(df, bench.limit(0)).collect()} == {0, 2}


@pytest.mark.parametrize("at_once", [3, 1 << 16])
def test_phrases_by_places(monkeypatch, at_once):
    """Windows and owners as a dictionary of tuples has them; laid out a few or many at a time."""
    monkeypatch.setattr(fmindex.Phrases, "AT_ONCE", at_once)
    rng = random.Random(8)
    items = [(f"i{k}", " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 4, 5, 9])))) for k in range(60)]
    items += [("twice", "a b a b a b a b a b"), ("none", None), ("i0", "c c c c")]
    want = {}
    for k, (_, text) in enumerate(items):
        own = (text or "").split()
        for i in range(max(1, len(own) - 3) if own else 0):
            want.setdefault(tuple(own[i:i + 4]), set()).add(k)
    phrases = fmindex.Phrases(iter(items), 4)
    spelled, got, rows = {v: k.decode() for k, v in phrases.symbols.items()}, {}, 0
    for group, owners, bounds in phrases.blocks():
        rows += len(group)
        for row, a, b in zip(group.tolist(), bounds[:-1], bounds[1:]):
            got[tuple(spelled[s] for s in row)] = set(owners[a:b].tolist())
    assert got == want and rows == len(want) and phrases.shortest == 1
    assert fmindex.Phrases([], 4).groups == fmindex.Phrases([("x", None)], 4).groups == []


def test_index_ranks_and_places():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 5, 700)
    text[0] = text[-1] = 0
    index = fmindex.FMIndex(text, 4)
    phrases = np.array([[a, b, c] for a in range(1, 5) for b in range(1, 5) for c in range(1, 5)])
    which, low, high = index.search(phrases)
    got = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    want = {k: [i for i in range(698) if (text[i:i + 3] == p).all()] for k, p in enumerate(phrases)}
    assert got == {k: v for k, v in want.items() if v}
