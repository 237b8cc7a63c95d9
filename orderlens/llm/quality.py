"""Quality and toxicity by co-training of two views.

The text view sees the words of a document: presence of words and word
beginnings, and how repetitive and decorated the words are. The page view sees
where the document comes from and how it is laid out: language, source, sizes,
lines, shares of letter kinds. For each target both views are fitted on labelled
rows; over several rounds each view then labels the unlabelled rows it is most
confident of for the other one. At the end the two views are calibrated and
combined on labelled rows held out from all fitting.

Only the fit is bounded: at most ``fit_rows`` labelled and ``pool_rows``
unlabelled rows, chosen by a hash of the id. Every document is scored whole.

Defined cases: null or empty text has no words and is scored by its page view;
null language or source is a value of its own; a label row with a null label or
id is ignored; several label rows of a document count as its worst. Rows are held out
class by class, so a class of two rows is on both sides; a class of one row is fitted
on, and the calibration then uses the fitted rows. Without labelled rows of both
classes a target is never met (quality 1, toxicity 0). The result's column must have a
name that the input hasn't.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.fmindex import words_of

# The page and text features.
PREFIXES = (4, 6)
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
DIGITS = bytes(range(48, 58))
DECORATION = re.compile(rb"[!-/:-@\[-`{-~]{2,}")
SCORES = "p_quality double, p_toxic double, keep boolean"


def _code(*parts) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode())


def _least(name: str, value: float, steps: float) -> list[int]:
    """One code for each step that ``value`` reaches, so that rare high values share what lower ones learn."""
    return [_code(name, k) for k in range(1, int(value * steps) + 1)]


def _share(name: str, part: float, whole: float, steps: int = 12) -> list[int]:
    return _least(name, part / whole, steps) if whole else []


def _codes(found: set[int]) -> np.ndarray:
    return np.fromiter(found, np.uint32, len(found)).view(np.int32)


def text_view(raw: bytes, words: list[bytes]) -> np.ndarray:
    """Feature codes of the words: 32-bit, so a rare word hardly ever meets another's weight."""
    kinds = set(words)
    crc = zlib.crc32
    codes = {crc(w) for w in kinds}
    for n in PREFIXES:
        salt = crc(b"prefix%d" % n)
        codes.update({crc(p, salt) for p in {w[:n] for w in kinds if len(w) >= n}})
    n = len(words)
    codes.update(_share("repeat", sum(map(eq, words, words[1:])), n, 16))
    codes.update(_share("decorated", len(DECORATION.findall(raw)), n, 16))
    codes.update(_least("kinds", len(kinds) / max(1.0, n ** 0.8), 6))
    return _codes(codes)


def page_view(raw: bytes, words: list[bytes], lang: str | None, source: str | None) -> np.ndarray:
    """Feature codes of origin and layout."""
    size, lines = len(raw), raw.count(b"\n") + 1
    upper = size - len(raw.translate(None, UPPER))
    letters = size - len(raw.translate(None, LETTERS))
    digits = size - len(raw.translate(None, DIGITS))
    spaces = raw.count(b" ") + lines - 1
    log = lambda x: math.log2(x + 1)
    return _codes({
        _code("lang", lang), _code("source", source), *_least("size", log(size), 1),
        *_least("lines", log(lines), 1), *_least("line", log(size / lines), 1),
        *_share("upper", upper, letters, 25), *_share("digits", digits, size, 25),
        *_share("other", max(0, size - letters - digits - spaces), size, 40),
        *_least("word", size / len(words) if words else 0, 1)})


def views(text: str | None, lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(text)
    return text_view(raw, words), page_view(raw, words, lang, source)


class Rows:
    """Sparse binary rows: feature codes of many documents, one after another."""

    # Codes looked at together: what is held besides the rows is bounded by it.
    AT_ONCE = 1 << 18

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes, self.sizes = codes, sizes

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate(rows) if rows else np.empty(0, np.int32), np.array([len(r) for r in rows], np.int64))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, code) of all codes, a block of rows at a time."""
        ends = np.cumsum(self.sizes)
        first, n = 0, len(self.sizes)
        while first < n:
            begin = int(ends[first] - self.sizes[first])
            last = max(first + 1, int(np.searchsorted(ends, begin + self.AT_ONCE, "right")))
            yield np.repeat(np.arange(first, last), self.sizes[first:last]), self.codes[begin:int(ends[last - 1])]
            first = last

    def weights_of(self, model: Linear, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(model.codes, codes), len(model.codes) - 1)
        return np.where(model.codes[at] == codes, model.weights[at], 0.0)

    def logits(self, model: Linear) -> np.ndarray:
        out = np.full(len(self.sizes), model.bias)
        if len(model.codes):
            for row, codes in self.blocks():
                out += np.bincount(row, self.weights_of(model, codes), len(out))
        return out


class Indexed(Rows):
    """Rows whose codes are places in ``names``, the sorted codes that at least a few of them have."""

    def __init__(self, places: np.ndarray, sizes: np.ndarray, names: np.ndarray):
        super().__init__(places, sizes)
        self.names = names

    @classmethod
    def frequent(cls, column: pa.ChunkedArray, least: int = 4) -> Indexed:
        """The rows of an Arrow list column without the codes of fewer than ``least`` rows."""
        lists = column.combine_chunks()
        rows = Rows(lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64))
        names, counts = np.unique(rows.codes, return_counts=True)
        names = names[counts >= least]
        places, sizes = [np.empty(0, np.int32)], np.zeros(len(rows.sizes), np.int64)
        for row, codes in rows.blocks() if len(names) else ():
            at = np.minimum(np.searchsorted(names, codes), len(names) - 1).astype(np.int32)
            stays = names[at] == codes
            places.append(at[stays])
            sizes += np.bincount(row[stays], minlength=len(sizes))
        return cls(np.concatenate(places), sizes, names)

    @classmethod
    def index(cls, rows: Rows) -> Indexed:
        names, places = np.unique(rows.codes, return_inverse=True)
        return cls(places.astype(np.int32), rows.sizes, names)

    def weights_of(self, model: Linear, codes: np.ndarray) -> np.ndarray:
        every = np.zeros(len(self.names))
        every[np.searchsorted(self.names, model.codes)] = model.weights
        return every[codes]


@dataclass
class Linear:
    codes: np.ndarray
    weights: np.ndarray
    bias: float


def fit_linear(rows: Indexed, which: np.ndarray, y: np.ndarray, features: int, steps: int = 150,
               penalty: float = 2e-4) -> Linear:
    """Logistic regression on the features that differ most between the classes (chi-square)."""
    index = np.full(len(rows.sizes), -1)
    index[which] = np.arange(len(which))
    n, positive = len(which), max(1e-9, y.sum())
    seen, hits = np.zeros(len(rows.names), np.int64), np.zeros(len(rows.names))
    for row, places in rows.blocks():
        own = index[row]
        places, own = places[own >= 0], own[own >= 0]
        seen += np.bincount(places, minlength=len(seen))
        hits += np.bincount(places, y[own], len(hits))
    expected = seen * positive / n
    spread = np.maximum(1e-9, expected * (1 - positive / n) * (1 - seen / n))
    score = np.where(seen >= 4, (hits - expected) ** 2 / spread, 0)
    best = np.sort(np.argsort(-score, kind="stable")[:features])
    best = best[score[best] > 4]
    place = np.full(len(rows.names), -1, np.int32)
    place[best] = np.arange(len(best))
    chosen = [(np.empty(0, np.int64), np.empty(0, np.int32))]
    for row, places in rows.blocks():
        own, at = index[row], place[places]
        inside = (own >= 0) & (at >= 0)
        chosen.append((own[inside], at[inside]))
    owner, column = (np.concatenate(c) for c in zip(*chosen))
    del chosen
    share = positive / n
    w, bias = np.zeros(len(best)), math.log(share / (1 - share))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(owner, w[column], n), -30, 30)))
        miss = (p - y) / n
        g, gb = np.bincount(column, miss[owner], len(w)) + penalty * w, miss.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 / (1 + t / steps)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9 ** t)) / (math.sqrt(vb / (1 - 0.99 ** t)) + 1e-8)
    return Linear(rows.names[best], w, float(bias))


def fit_dense(x: np.ndarray, y: np.ndarray, steps: int = 60, penalty: float = 1e-2) -> np.ndarray:
    """Weights and bias of a logistic regression of few columns, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + penalty * w)
    return w


@dataclass
class Model:
    """Both views of one target and how their logits are combined; ``held_out``: rows and accuracy."""

    text: Linear
    page: Linear
    combine: np.ndarray
    held_out: tuple[int, float]

    def probability(self, text: Rows, page: Rows) -> np.ndarray:
        x = np.column_stack((np.clip(text.logits(self.text), -30, 30), np.clip(page.logits(self.page), -30, 30)))
        return 1 / (1 + np.exp(-np.clip(x @ self.combine[:-1] + self.combine[-1], -30, 30)))


def held_out(y: np.ndarray, ids: list[int], every: int) -> np.ndarray:
    """Of the labelled rows of each class the second of every ``every``, by a hash of the id."""
    held = np.zeros(len(y), bool)
    order = np.array(sorted(range(len(ids)), key=lambda k: (zlib.crc32(b"%d" % ids[k]), k)), np.int64)
    for label in (0.0, 1.0):
        own = order[y[order] == label]
        held[own[1::every]] = True
    return held


def co_train(text: Indexed, page: Indexed, y: np.ndarray, held: np.ndarray, rounds: int = 2, features: int = 4096,
             confident: float = 0.97, share: float = 0.1) -> Model | None:
    """``y``: 1, 0, or nan for unlabelled rows; ``held``: labelled rows kept for calibration.

    In each round a view hands its most confident unlabelled rows to the other one: of each
    class at most ``share`` of the unlabelled rows times the share of the class.
    """
    known = np.flatnonzero(~np.isnan(y) & ~held)
    test = np.flatnonzero(~np.isnan(y) & held)
    if len({*y[known]}) < 2:
        return None
    if len({*y[test]}) < 2:
        # A class of one row is fitted on, and nothing else is left to calibrate with.
        test = known
    pool = np.flatnonzero(np.isnan(y))
    given = {"text": {}, "page": {}}
    sides = {"text": text, "page": page}

    def fit(side: str) -> Linear:
        rows = np.concatenate((known, np.array(sorted(given[side]), np.int64)))
        target = np.concatenate((y[known], [given[side][k] for k in sorted(given[side])]))
        return fit_linear(sides[side], rows, target, features)

    models = {side: fit(side) for side in sides}
    prior = y[known].mean()
    for _ in range(rounds):
        for side, other in (("text", "page"), ("page", "text")):
            left = np.array([k for k in pool if k not in given[other]], np.int64)
            scale = fit_dense(sides[side].logits(models[side])[test][:, None], y[test])
            p = 1 / (1 + np.exp(-np.clip(scale[0] * sides[side].logits(models[side])[left] + scale[1], -30, 30)))
            for label, sure, part in ((1.0, p, prior), (0.0, 1 - p, 1 - prior)):
                best = np.argsort(-sure, kind="stable")[:int(share * part * len(pool))]
                given[other] |= {int(left[k]): label for k in best if sure[k] >= confident}
        models = {side: fit(side) for side in sides}
    x = np.column_stack([np.clip(sides[s].logits(models[s])[test], -30, 30) for s in ("text", "page")])
    model = Model(models["text"], models["page"], fit_dense(x, y[test]), (0, 0.0))
    found = model.probability(text, page)[test] >= 0.5
    model.held_out = (len(test), float((found == (y[test] == 1)).mean()))
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", fit_rows: int = 10_000, pool_rows: int = 5_000,
        held_share: int = 4, rounds: int = 2) -> dict[str, Model | None]:
    """The two models, from at most ``fit_rows`` labelled and ``pool_rows`` unlabelled documents.

    The executors turn the chosen documents into feature codes; of each class every
    ``held_share``-th labelled row is held out. The driver gets those bounded rows only,
    and trains one target after the other on places in one list of codes.
    """
    order = F.xxhash64("_id", F.lit("fit"))
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id"))
             .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    ids = docs.select(F.col(id_col).cast("long").alias("_id")).filter("_id IS NOT NULL")
    chosen = marks.orderBy(order, "_id").limit(fit_rows)
    pool = (ids.join(marks.select("_id"), "_id", "left_anti").orderBy(order, "_id").limit(pool_rows)
            .select("_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic")))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                       F.col(lang_col).cast("string").alias("_lang"), F.col(source_col).cast("string").alias("_source"))

    @F.pandas_udf("text array<int>, page array<int>")
    def codes(text: pd.Series, lang: pd.Series, source: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([views(*r) for r in zip(text, lang, source)], columns=["text", "page"])

    # At most fit_rows + pool_rows rows of three numbers are broadcast.
    found = (rows.join(F.broadcast(chosen.unionByName(pool)), "_id")
             .select("_id", "quality", "toxic", codes("_text", "_lang", "_source").alias("v"))
             .select("_id", "quality", "toxic", "v.text", "v.page").toArrow().sort_by("_id"))
    ids = found["_id"].to_pylist()
    targets = {name: found[name].to_pandas().to_numpy(np.float64) for name in ("quality", "toxic")}
    text, page = found["text"], found["page"]
    del found
    text, page = Indexed.frequent(text), Indexed.frequent(page)
    pa.default_memory_pool().release_unused()
    return {name: co_train(text, page, y, held_out(y, ids, held_share), rounds) for name, y in targets.items()}


def score(docs: DataFrame, models: dict[str, Model | None], text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", name: str = "_score", threshold: float = 0.5) -> DataFrame:
    """``docs`` plus the struct ``name``: ``p_quality``, ``p_toxic`` and ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf(SCORES)
    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for text, lang, source in batches:
            p = {k: np.full(len(text), float(k == "quality")) for k in known}
            # The features of a few hundred documents at a time.
            for at in range(0, len(text), 256):
                part = slice(at, at + 256)
                found = [views(*r) for r in zip(text[part], lang[part], source[part])]
                sides = Rows.of([v[0] for v in found]), Rows.of([v[1] for v in found])
                for k, m in known.items():
                    if m:
                        p[k][part] = m.probability(*sides)
            yield pd.DataFrame({"p_quality": p["quality"], "p_toxic": p["toxic"],
                                "keep": (p["quality"] >= threshold) & (p["toxic"] < threshold)})

    return docs.withColumn(name, judge(F.col(text_col), F.col(lang_col).cast("string"),
                                       F.col(source_col).cast("string")))
