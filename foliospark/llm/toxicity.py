"""Toxicity: maximum-scoring segments over token log-odds with Dirichlet priors.

Learning.  From at most ``Params.sample`` labelled documents (those with the smallest hash of
their id) words are counted by label.  Features are whole words and their prefixes of 4 to
8 characters.  A feature's weight is the log-odds ratio of its rates in toxic and other
documents under a symmetric Dirichlet prior, ``prior`` for each word of the vocabulary (a prefix
has what its words have together); it is kept if the ratio lies ``z_min`` standard
deviations from 0 and, for a prefix, ``prefix_min`` from 0 at least.  Words seen often enough
that begin with a kept prefix, but whose own ratio is no higher than 1, are kept with weight 0:
a word's own record counts before its prefix's.

Scoring.  A token weighs what its word's longest feature weighs, less ``cost``, so that the
expected weight is negative; repeats of a word nearby weigh less, those further than ``window``
tokens back don't count, so a passage weighs the same wherever it stands.  One linear scan (Ruzzo and Tompa's) finds all maximal-scoring
segments.  A segment of score S in n tokens has the expected count E = K n exp(-lambda S)
(Karlin and Altschul): lambda solves sum p(s) exp(lambda s) = 1 over the token weights of
documents that aren't toxic, K is the rate of positive segments in them.  Segments with E below
``e_max`` are significant passages; the sum of their -ln E and their number go through a
logistic curve, fitted on labelled documents that the weights haven't seen.

Defined cases: null and empty texts have no tokens and get the score of a document without
passages; documents labelled more than once count as toxic if any label says so, null labels
and ids don't count; without any usable label every score is 0; repeated rows are scored alike;
extra columns are ignored.  An empty table gives an empty result.

What is collected and broadcast is bounded by the sample: a feature is in ``min_support`` of its
documents at least.  Texts never enter a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, fresh, revive, share, small_batches, tidied, tidy


@dataclass(frozen=True)
class Params:
    """``z_min``, ``prefix_min`` and ``prior`` were chosen by learning from folds 1 and 2, calibrating on 3 and counting errors on 4; fold 0 had no part in it."""

    sample: int = 40_000
    prior: float = 0.5
    z_min: float = 3.5
    prefix_min: float = 2.0
    min_support: int = 5
    cost: float = 0.1
    e_max: float = 0.05
    folds: int = 5
    #: Of the folds that are learned from (all but 0), those that give weights; the others calibrate.
    learn: tuple[int, ...] = (1, 2, 3)
    window: int = 100


PREFIXES = range(4, 9)
REPORT = "score double, n_tokens long, passages array<struct<start:int,end:int,score:double,e_value:double>>"
_LETTER = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile("[a-z\u0080-\U0010ffff]+")


def lower(text: str) -> str:
    """Lower case with one character for each, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def tokens(text: str | None) -> list[bytes]:
    return lower(text).encode("utf-8", "surrogatepass").translate(_LETTER).split() if text else []


def segments(weights: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence in which tokens weigh -cost, but for those listed.

    weights: (position, weight) in order; only positive runs can begin or end a segment, so what
    lies between two listed positions counts as one step.  Gives (first, last, score).
    """
    stack: list[list] = []  # first, last, total before, total upto
    total, at = 0.0, -1
    for i, w in weights:
        total -= cost * (i - at - 1)
        at = i
        if w <= 0:
            total += w
            continue
        new = [i, i, total, total + w]
        total += w
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= new[2]:
                # A later segment can't reach past this one's start: remembered by the link.
                k = stack[k][4]
            if k < 0 or stack[k][3] >= new[3]:
                stack.append([*new, k])
                break
            new = [stack[k][0], new[1], stack[k][2], new[3]]
            del stack[k:]
    return [(a, b, upto - before) for a, b, before, upto, _ in stack]


class Model:
    """Weights of features, and the constants of calibration."""

    def __init__(self, weights: dict[str, float], cost: float, e_max: float, window: int = Params.window):
        self.weights, self.cost, self.e_max, self.window = weights, cost, e_max, window
        self.lam, self.k = 1.0, 1e-3
        self.curve = (-50.0, 0.0, 0.0)
        self.cache: dict[bytes, float | None] = {}

    def weight(self, word: bytes) -> float | None:
        """Of the word's longest feature; None without any."""
        w = word.decode("utf-8", "replace")
        out = self.weights.get(w + "$")
        for n in reversed(PREFIXES):
            if out is not None or len(w) < n:
                continue
            out = self.weights.get(w[:n])
        if len(self.cache) > 500_000:
            self.cache.clear()
        self.cache[word] = out
        return out

    def listed(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Positions whose word has a weight; a word's k-th occurrence within ``window`` tokens weighs a k-th, as one word over and over tells little more than once."""
        cache, out, seen, window = self.cache, [], {}, self.window
        for i, w in enumerate(words):
            x = cache[w] if w in cache else self.weight(w)
            if x and x > 0:
                near = seen.setdefault(w, deque())
                while near and near[0] <= i - window:
                    near.popleft()
                near.append(i)
                x /= len(near)
            if x:
                out.append((i, x - self.cost))
        return out

    def e_value(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(700.0, self.lam * score))

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float, float]]:
        found = [(a, b, s, self.e_value(s, len(words))) for a, b, s in segments(self.listed(words), self.cost)]
        return [x for x in found if x[3] <= self.e_max]

    @staticmethod
    def evidence(passages: list) -> tuple[float, float]:
        return math.log1p(sum(-math.log(max(e, 1e-300)) for *_, e in passages)), math.log1p(len(passages))

    def score(self, passages: list) -> float:
        x = self.evidence(passages)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.curve[0] + self.curve[1] * x[0] + self.curve[2] * x[1]))))


def log_odds(n1: Column, n0: Column, k: Column, all1: int, all0: int, words: int, prior: float) -> tuple[Column, Column]:
    """Log-odds ratio of a feature of ``k`` words, and its z, under a Dirichlet prior over ``words`` words."""
    a, b = n1 + prior * k, n0 + prior * k
    whole1, whole0 = all1 + prior * words, all0 + prior * words
    delta = F.log(a / (whole1 - a)) - F.log(b / (whole0 - b))
    return delta, delta / F.sqrt(1 / a + 1 / b)


def solve_lambda(weights: Counter, cost: float) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1, at most 2.  One imagined token of each sign keeps it finite."""
    n = sum(weights.values()) + 2
    p = [(s, c / n) for s, c in weights.items()] + [(-cost, 1 / n), (5.0, 1 / n)]
    total = lambda x: sum(q * math.exp(x * s) for s, q in p)
    lo, hi = 1e-3, 2.0
    if total(hi) <= 1:
        return hi
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if total(mid) <= 1 else (lo, mid)
    return lo


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small ridge; features aren't penalised below 1e-2."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3)
        step = np.linalg.solve(h, a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic.  Rows whose crc32(doc_id) mod folds is 0 aren't learned from."""
    fold = crc_mod("doc_id", params.folds)
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", "toxic").where(fold != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    # At most ``sample`` rows of two numbers: bounded, so broadcast.
    sample = small_batches(docs).select("doc_id", "text").join(F.broadcast(known), "doc_id")
    learn, check = sample.where(fold.isin(*params.learn)), sample.where(~fold.isin(*params.learn))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter(), Counter()
        flush = lambda: pd.DataFrame([(w.decode("utf-8", "replace"), seen[1][w], seen[0][w]) for w in {*seen[0], *seen[1]}], columns=["word", "n1", "n0"])
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                seen[1 if toxic == 1 else 0].update(set(tokens(text)))
            if len(seen[0]) + len(seen[1]) > 300_000:
                yield flush()
                seen = Counter(), Counter()
        yield flush()

    words = learn.select("text", "toxic").mapInPandas(tidied(count), "word string, n1 long, n0 long").groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    words = words.where("word <> ''").cache()
    try:
        whole = words.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count("*").alias("v")).first()
        all1, all0 = whole["n1"] or 0, whole["n0"] or 0
        if not all1 or not all0 or whole["v"] < 2:
            return Model({}, params.cost, params.e_max, params.window)
        prefix = F.explode(F.filter(F.transform(F.array(*[F.lit(n) for n in PREFIXES]), lambda n: F.when(F.length("word") >= n, F.substring(F.col("word"), F.lit(1), n))), lambda p: p.isNotNull()))
        under = words.select(prefix.alias("f"), "n1", "n0").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count("*").alias("k"))
        features = words.select(F.concat("word", F.lit("$")).alias("f"), "n1", "n0", F.lit(1).cast("long").alias("k")).unionByName(under.where(F.col("k") < whole["v"]))
        delta, z = log_odds(F.col("n1"), F.col("n0"), F.col("k"), all1, all0, whole["v"], params.prior)
        scored = features.where(f"n1 + n0 >= {params.min_support}").select("f", delta.alias("w"), z.alias("z"))
        strong = F.col("f").endswith("$") | (F.abs("w") >= params.prefix_min)
        weights = {r.f: r.w for r in scored.where((F.abs("z") >= params.z_min) & strong).orderBy("f").collect()}
        # Words under a kept prefix whose own record says nothing.
        prefixes = [f for f in weights if not f.endswith("$")]
        if prefixes:
            under = docs.sparkSession.createDataFrame([(p,) for p in prefixes], "p string")
            own = scored.where("f like '%$'").withColumn("p", F.explode(F.transform(F.array(*[F.lit(n) for n in PREFIXES]), lambda n: F.substring(F.col("f"), F.lit(1), n))))
            own = own.where("w <= 1").join(F.broadcast(under), "p", "left_semi").select("f").distinct()
            weights = {r.f: 0.0 for r in own.collect()} | weights
    finally:
        words.unpersist()
    model = Model(weights, params.cost, params.e_max, params.window)

    shared = share(docs.sparkSession, model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Token weights of other documents (rounded) and each document's segments."""
        m, seen, n, positive = revive(Model, shared.value), Counter(), 0, 0
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                if toxic == 1:
                    continue
                words = tokens(text)
                found = m.listed(words)
                n += len(words)
                seen.update(round(w, 1) for _, w in found)
                positive += len(segments(found, m.cost))
        yield pd.DataFrame([(float(w), c, 0, 0) for w, c in seen.items()] + [(0.0, 0, n, positive)], columns=["w", "c", "n", "positive"])

    rows = check.select("text", "toxic").mapInPandas(tidied(measure), "w double, c long, n long, positive long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.sum("positive").alias("positive")).collect()
    n, positive = sum(r["n"] for r in rows), sum(r["positive"] for r in rows)
    spread = Counter({r["w"]: r["c"] for r in rows if r["c"]})
    spread[-params.cost] += n - sum(spread.values())
    model.lam, model.k = solve_lambda(spread, params.cost), (positive + 1) / (n + 1000)
    shared = share(docs.sparkSession, model)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = revive(Model, shared.value)
        for b in batches:
            yield pd.DataFrame([(*m.evidence(m.passages(tokens(text))), int(toxic == 1)) for text, toxic in zip(b["text"], b["toxic"], strict=True)], columns=["a", "b", "y"])

    # Evidence, rounded, with counts: at most ``sample`` rows come to the driver.
    rows = check.select("text", "toxic").mapInPandas(tidied(evidence), "a double, b double, y long").groupBy(F.round("a", 2).alias("a"), F.round("b", 2).alias("b"), "y").count().collect()
    if {r["y"] for r in rows} == {0, 1}:
        x = np.array([(r["a"], r["b"]) for r in rows for _ in range(r["count"])])
        model.curve = fit_curve(x, np.array([r["y"] for r in rows for _ in range(r["count"])], float))
    else:
        model.curve = (-4.0, 2.0, 0.0)
    return model


def annotate(docs: DataFrame, model: Model, text_col: str = "text"):
    """The column of a struct (see REPORT): the score and every significant passage, as character offsets."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = revive(Model, shared.value)
        for batch in batches:
            rows = []
            for text in batch:
                words = tokens(text)
                found = m.passages(words)
                at = [x.span() for x in _WORD.finditer(lower(text))] if found else []
                rows.append((m.score(found), len(words), [(at[a][0], at[b][1], s, e) for a, b, s, e in found]))
            yield pd.DataFrame(rows, columns=["score", "n_tokens", "passages"])
        m.cache.clear()
        tidy()

    return F.pandas_udf(run, REPORT)(F.col(text_col))


def score(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """A row a document: doc_id, held_out, score, predicted, n_tokens, n_passages."""
    model = train(docs, labels, params)
    out = docs.select("doc_id", (crc_mod("doc_id", params.folds) == 0).alias("held_out"), annotate(docs, model).alias("t"))
    return out.select("doc_id", "held_out", F.col("t.score").alias("score"), (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.col("t.n_tokens").alias("n_tokens"), F.size("t.passages").cast("long").alias("n_passages"))


def drop_toxic(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` without the documents that are predicted toxic, in its own columns."""
    model = train(docs, labels, params)
    (clash,) = fresh(docs.columns, "toxicity")
    return docs.withColumn(clash, annotate(docs, model)).where(F.col(clash)["score"] < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
