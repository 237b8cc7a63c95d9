"""Co-training: chosen features against a plain count, held-out rows, rare classes, odd rows, accuracy."""

import zlib
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, label int"


def documents(spark, n, words=("good", "fine", "bad", "awful")):
    """Documents whose last word tells their quality, and the labels of all."""
    rows = [(i, f"some words {i} of a text and {words[i % 4]}", "en", "web" if i % 4 < 2 else "spam", 0) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 < 2), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_chosen_codes(monkeypatch):
    """The features of a fit are those of largest chi-square, counted in plain Python; blocks don't matter."""
    rng = np.random.default_rng(5)
    rows, y = [], rng.random(200) < .4
    for i in range(200):
        rows.append(np.array([100 * k for k in range(40) if rng.random() < (.7 if y[i] and k < 6 else .3)], np.int32))
    which = np.array([i for i in range(200) if i % 5])
    seen, hits = Counter(), Counter()
    for i in which:
        seen.update(rows[i].tolist())
        hits.update(rows[i].tolist() * int(y[i]))
    n, positive, score = len(which), int(y[which].sum()), {}
    for c in seen:
        expected = seen[c] * positive / n
        score[c] = (hits[c] - expected) ** 2 / max(1e-9, expected * (1 - positive / n) * (1 - seen[c] / n))
    best = sorted((c for c in seen if seen[c] >= 4 and score[c] > 4), key=lambda c: (-score[c], c))
    weights = []
    for size in (7, 1 << 18):
        monkeypatch.setattr(quality.Rows, "AT_ONCE", size)
        for k in (3, 4096):
            model = quality.fit_linear(quality.Indexed.index(quality.Rows.of(rows)), which, y[which].astype(float), k)
            assert model.codes.tolist() == sorted(best[:k]) and len(best) > 3
            weights.append(model.weights.tolist())
        plain = quality.Rows.of(rows).logits(model)
        assert np.allclose(plain, quality.Indexed.index(quality.Rows.of(rows)).logits(model))
    assert np.allclose(weights[0], weights[2]) and np.allclose(weights[1], weights[3])


def test_held_out():
    y = np.array([1, 0, 0, 0, 0, 0, 0, 0, 1, np.nan, 0])
    held = quality.held_out(y, list(range(11)), 4)
    assert held[y == 1].sum() == 1 and held[y == 0].sum() == 2 and not held[9]
    assert not quality.held_out(np.array([1.0]), [7], 4).any()


def test_query_accuracy(spark):
    """Held out by the test itself: documents whose labels the fit does not see."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    hidden = {r.doc_id: r for r in labels.collect() if zlib.crc32(b"%d" % r.doc_id) % 3 == 0}
    models = quality.fit(docs, labels.filter(~labels.doc_id.isin([*hidden])))
    told = {r.doc_id: r._score for r in quality.score(docs, models).filter(docs.doc_id.isin([*hidden])).collect()}
    right = [(told[i].p_quality >= .5) == (r.quality == 1) for i, r in hidden.items()]
    calm = [(told[i].p_toxic >= .5) == (r.toxic == 1) for i, r in hidden.items()]
    assert sum(right) >= .95 * len(right) and sum(calm) >= .9 * len(calm)
    rows = queries.op3_quality(spark, FOLDER)
    assert rows.count() == docs.count() and rows.filter("p_quality IS NULL OR p_toxic IS NULL").count() == 0


def test_rare_class(spark):
    """Two toxic labels are on both sides of the split; one is fitted on; none never rejects."""
    docs, labels = documents(spark, 80)
    for count in (0, 1, 2, 5):
        marked = labels.withColumn("toxic", (labels.doc_id % 16 == 3).cast("int") * (labels.doc_id < 16 * count).cast("int"))
        models = quality.fit(docs, marked)
        assert (models["toxic"] is None) == (count == 0)
        assert models["quality"] is not None
    assert all(r._score.p_toxic == 0 for r in quality.score(docs, quality.fit(docs, labels)).collect())


def test_odd_rows(spark):
    docs, labels = documents(spark, 60)
    odd = spark.createDataFrame([(None, None, None, None, None), (1000, "", "en", "web", 1), (3, "a text with good", "en", "web", 1),
                                 (1001, "good " * 50_000, "en", "web", 1), (1002, None, "fr", None, 1)], SCHEMA)
    more = spark.createDataFrame([(None, 1, 1), (5, None, 0), (6, 1, None), (7, 0, 0), (7, 1, 0), (5000, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    every = docs.unionByName(odd)
    models = quality.fit(every, labels.unionByName(more))
    found = quality.score(every, models, name="clash")
    assert found.count() == 65 and found.columns == [*docs.columns, "clash"]
    assert all(0 <= r.clash.p_quality <= 1 and r.clash.keep is not None for r in found.collect())
    for d, m in ((every.limit(0), labels), (every, labels.limit(0)), (every.limit(0), labels.limit(0))):
        models = quality.fit(d, m)
        assert models == {"quality": None, "toxic": None}
        assert all(r._score.keep for r in quality.score(d, models).collect())


@pytest.mark.parametrize("labelled,test", [((1.0, 0.0, 1.0, 0.0), (False, False, True, True)),
                                           ((1.0, 0.0, 0.0, 0.0), (False, False, False, True))])
def test_co_train_plain(labelled, test):
    """The page view is confident of unlabelled rows and teaches the text view a word it never saw labelled."""
    base = list(labelled) * 8 + [float("nan")] * 40
    page = [np.array([1 if y == 1 or (np.isnan(y) and i % 2) else 2], np.int32) for i, y in enumerate(base)]
    text = [np.array([10 if y == 1 else 11] if not np.isnan(y) else [12 if i % 2 else 13], np.int32) for i, y in enumerate(base)]
    held = np.array(list(test) * 8 + [False] * 40)
    model = quality.co_train(quality.Indexed.index(quality.Rows.of(text)), quality.Indexed.index(quality.Rows.of(page)), np.array(base), held,
                             confident=.6, share=.9)
    assert {12, 13} & {*model.text.codes.tolist()}
    p = model.probability(quality.Rows.of(text), quality.Rows.of(page))
    assert all((p[i] >= .5) == (y == 1) for i, y in enumerate(base) if not np.isnan(y))
