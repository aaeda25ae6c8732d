"""Toxicity by non-negative positive-unlabelled learning.

The positives are documents confirmed as toxic; everything else in the training
part, labelled or not, is unlabelled text.  A linear classifier over the words
and word stems of a text minimises the class-prior-corrected risk
    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])
in numpy on a sample of at most MOST_POSITIVES and MOST_UNLABELLED documents
(the ones with the least hash of their id); where the bracket falls below zero,
the step goes the other way.  The class prior is the share of toxic documents among all
labelled training rows.  Every whole text is scored with the fitted words' weights.

Edge cases: null, empty or wordless texts get the score of the intercept;
without confirmed positives every score is 0; documents with a null id are
no training rows; repeated rows get equal scores; a document with several labels is a positive
if any of them says so; of several texts with one id the least is learned from; of words that tell the samples apart equally well, the first by
name are chosen; very long texts count like others, by their distinct words; ids may be of any type; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_as_text, id_remainder, id_restored, materialize

MOST_POSITIVES = 3000
MOST_UNLABELLED = 9000
#: Inflected and compound words share their first letters.
STEMS = (4, 5)
#: Words and stems of the model at most, chosen by how far their document frequencies in both samples are apart.
MOST_WORDS = 1024
LEAST_Z = 5.0
STEPS = 400
RATE = 0.3
DECAY = 1e-4
HELD_OUT = (3, 1)
CUT = 0.7

WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    divisor, remainder = HELD_OUT
    return F.coalesce(id_remainder(doc_id, divisor) == remainder, F.lit(False))


def features(text: str | None) -> set[str]:
    """The distinct words of a text, the longer ones' stems of each length in STEMS (marked by a hyphen), and the stems of several distinct words (by two)."""
    found = set(WORD.findall((text or "").lower()))
    stems = Counter(w[:n] + "-" for n in STEMS for w in found if len(w) > n)
    found.update(stems)
    found.update(s + "-" for s, n in stems.items() if n > 1)
    return found


def matched_intercept(z: np.ndarray, positive: np.ndarray, prior: float) -> float:
    """What to add to the scores z so that their mean probability over the unlabelled documents is the prior."""
    low, high = -40.0, 40.0
    for _ in range(60):
        middle = (low + high) / 2
        if (1 / (1 + np.exp(-np.clip(z[~positive] + middle, -30, 30)))).mean() > prior:
            high = middle
        else:
            low = middle
    return low


def risk_gradient(z: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Derivative of the non-negative risk (sigmoid loss, bounded for every score) by the scores z."""
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    bracket = p[~positive].sum() / n_u - prior * p[positive].sum() / n_p
    slope = p * (1 - p)
    minus = np.where(positive, -prior * slope / n_p, slope / n_u)
    plus = np.where(positive, -prior * slope / n_p, 0.0)
    return plus + minus if bracket >= 0 else -minus


def fit(index: np.ndarray, row: np.ndarray, positive: np.ndarray, n_words: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept; index and row name the words present in each document. Steps are scaled per weight by their gathered squares."""
    w, b = np.zeros(n_words), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    first_w, first_b, second_w, second_b = np.zeros(n_words), 0.0, np.zeros(n_words), 0.0
    n = len(positive)
    for t in range(1, STEPS + 1):
        z = np.bincount(row, w[index], n) + b
        g = risk_gradient(z, positive, prior)
        gw, gb = np.bincount(index, g[row], n_words) + DECAY * w, g.sum()
        first_w, first_b = 0.9 * first_w + 0.1 * gw, 0.9 * first_b + 0.1 * gb
        second_w, second_b = 0.99 * second_w + 0.01 * gw * gw, 0.99 * second_b + 0.01 * gb * gb
        scale = RATE / (1 + t / 100)
        w -= scale * (first_w / (1 - 0.9**t)) / (np.sqrt(second_w / (1 - 0.99**t)) + 1e-6)
        b -= scale * (first_b / (1 - 0.9**t)) / (np.sqrt(second_b / (1 - 0.99**t)) + 1e-6)
    z = np.bincount(row, w[index], n) + b
    return w, float(b + matched_intercept(z, positive, prior))


def least_by_hash(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct ids, those with the least hash: a top-k, so each task keeps that many rows."""
    return ids.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """(weights of words, intercept) from training rows: docs (doc_id, text) and labels (doc_id, toxic)."""
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = marks.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"]
    confirmed = marks.filter("toxic = 1").select("doc_id")
    chosen = least_by_hash(confirmed.join(docs.select("doc_id"), "doc_id", "left_semi"), MOST_POSITIVES).withColumn("positive", F.lit(True))
    others = least_by_hash(docs.select("doc_id").join(chosen, "doc_id", "left_anti"), MOST_UNLABELLED).withColumn("positive", F.lit(False))
    sample = materialize(chosen.unionByName(others), "toxic-sample")  # at most MOST_POSITIVES + MOST_UNLABELLED rows, so it may be broadcast
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not prior or not n_p or not n_u:
        return {}, -50.0
    rows = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("positive").alias("positive"), F.min("text").alias("text"))
    rows = materialize(rows, "toxic-texts")
    discard(sample)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, u = Counter(), Counter()
        for batch in batches:
            for positive, text in zip(batch["positive"], batch["text"], strict=True):
                (p if positive else u).update(features(text))
        found = list(p.keys() | u.keys())
        yield pd.DataFrame({"word": found, "p": [p[w] for w in found], "u": [u[w] for w in found]}, columns=["word", "p", "u"]).astype({"word": object})

    df = rows.mapInPandas(count, "word string, p long, u long").groupBy("word").agg((F.sum("p") / n_p).alias("p"), (F.sum("u") / n_u).alias("u"))
    pooled = (F.col("p") * n_p + F.col("u") * n_u) / (n_p + n_u)
    z = (F.col("p") - F.col("u")) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + F.lit(1e-12))
    top = df.withColumn("z", F.abs(z)).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(MOST_WORDS).select("word").collect()
    vocabulary = {r["word"]: i for i, r in enumerate(top)}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].values, "positive": batch["positive"].values, "at": [sorted(vocabulary[w] for w in features(t) & vocabulary.keys()) for t in batch["text"]]})

    found = id_as_text(rows).mapInPandas(present, "doc_id string, positive boolean, at array<int>").orderBy("doc_id").collect()  # MOST_POSITIVES + MOST_UNLABELLED rows of MOST_WORDS entries at most
    discard(rows)
    row = np.repeat(np.arange(len(found)), [len(r["at"]) for r in found])
    index = np.concatenate([np.array(r["at"], np.int64) for r in found])
    w, b = fit(index, row, np.array([r["positive"] for r in found], bool), max(1, len(vocabulary)), float(prior))
    return {word: float(w[i]) for word, i in vocabulary.items()}, b


def score(docs: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = weights.keys()
        for batch in batches:
            z = np.array([intercept + sum(weights[w] for w in features(t) & known) for t in batch["text"]], dtype=float)
            yield pd.DataFrame({"doc_id": batch["doc_id"].values, "score": 1 / (1 + np.exp(-np.clip(z, -700, 700)))})

    return id_restored(id_as_text(docs.select("doc_id", "text")).mapInPandas(run, "doc_id string, score double"), docs)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): trained on the rows that are not held out, for all rows."""
    part = ~held_out(F.col("doc_id"))
    weights, intercept = train(docs.select("doc_id", "text").filter(part), labels.select("doc_id", "toxic").filter(part))
    out = score(docs, weights, intercept)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
