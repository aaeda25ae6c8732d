"""Language identification by hierarchical discrimination.

A text is a unit vector of hashed byte trigrams of its letters.  Linear support vector
machines first choose a language family (one against the rest); within it, one
machine for each pair of languages votes.  They are fitted in numpy on a sample of at
most MOST_SAMPLE training texts, the same number for each language (those with the
least hash of their id) and one at least, which is kept as sparse vectors; features are taken from whole texts, and every
whole text is predicted.  A block of texts is one matrix, whose size is fixed, and a long text adds to its row slice by slice.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and so is
everything if no row has a language; a family with one language needs no vote; rows with a null id are not
learned from; of several rows with one id, the one with the least language and text is learned from; of languages with equally many votes, the one
with the greatest least margin wins, then the first; very long texts are read in slices, so they need no more memory than short ones; repeated rows get
equal results; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXT_ROWS, discard, id_as_text, id_remainder, id_restored, materialize

SIZE = 1 << 14
MOST_SAMPLE = 6000
EPOCHS = 12
BATCH = 32
DECAY = 1e-4
HELD_OUT = (4, 2)
UNKNOWN = "und"
#: Texts of a block, and bytes of a text that are counted at a time.
BLOCK = 64
SLICE = 1 << 16

# Families of ISO 639-1 codes. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es pt it ro ca gl oc rm",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indic": "hi bn mr ne gu pa ur sa si",
    "iranian": "fa ps ku tg",
    "turkic": "tr az kk ky uz tk tt ug",
    "uralic": "fi et hu",
    "semitic": "ar he am mt",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv su mg",
}

#: Letters keep their lower case, bytes of other letters stay, all else separates words.
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    divisor, remainder = HELD_OUT
    return F.coalesce(id_remainder(doc_id, divisor) == remainder, F.lit(False))


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vectors(texts: list) -> np.ndarray:
    """A row for each text: the unit vector of the square roots of its hashed byte-trigram counts (of nothing: 0)."""
    out = np.zeros((len(texts), SIZE), np.float32)
    for i, text in enumerate(texts):
        data = b" " + (text or "").encode("utf-8", "surrogatepass").translate(LETTERS) + b" "
        for low in range(0, len(data) - 2, SLICE):
            x = np.frombuffer(data, np.uint8, min(SLICE + 2, len(data) - low), low).astype(np.uint32)
            code = (x[:-2] << 16 | x[1:-1] << 8 | x[2:])[x[1:-1] != 32]
            out[i] += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - SIZE.bit_length() + 1), minlength=SIZE)
    np.sqrt(out, out=out)
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    out /= np.where(norm > 0, norm, 1)[:, None]
    return out


class Sample:
    """Sparse rows: the entries of row i are those from starts[i] to starts[i + 1]."""

    def __init__(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray):
        self.index, self.value, self.starts = index, value, starts

    def rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of each entry, counted from 0, its feature, its value) of some rows."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        row = np.repeat(np.arange(len(chosen)), sizes)
        at = np.arange(len(row)) + np.repeat(self.starts[chosen] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        return row, self.index[at], self.value[at]


def fit(x: Sample, members: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """Weights (the last is the intercept) of a linear support vector machine: averaged subgradient steps on the hinge loss. y: the signs of the members' rows."""
    rng = np.random.default_rng(seed)
    w, b, t = np.zeros(SIZE), 0.0, 0
    mean, mean_b, n = np.zeros_like(w), 0.0, 0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for low in range(0, len(y), BATCH):
            rows = order[low : low + BATCH]
            t += 1
            rate = 1 / (DECAY * (t + 1000))
            row, index, value = x.rows(members[rows])
            short = y[rows] * (np.bincount(row, w[index] * value, len(rows)) + b) < 1
            step = short * y[rows] * weight[rows] / len(rows)
            w *= 1 - rate * DECAY
            w += rate * np.bincount(index, step[row] * value, SIZE)
            b += 0.01 * rate * float(step.sum())
            if epoch >= EPOCHS // 2:
                mean, mean_b, n = mean + w, mean_b + b, n + 1
    return np.r_[mean / max(1, n), mean_b / max(1, n)].astype(np.float32)


class Hierarchy:
    """Columns of weights: one per family (if there are several), then one per pair of languages of a family."""

    def __init__(self, x: Sample, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        groups: dict[str, list[str]] = {}
        for lang in self.langs:
            groups.setdefault(family_of(lang), []).append(lang)
        self.families = sorted(groups.items())
        family = np.array([family_of(lang) for lang in langs.tolist()])
        columns, everyone = [], np.arange(len(langs))
        if len(self.families) > 1:
            names = [f for f, _ in self.families]
            for f in names if len(names) > 2 else names[:1]:
                columns.append(fit(x, everyone, np.where(family == f, 1, -1), len(columns)))
        self.n_top = len(columns)
        self.pairs = []
        for i, (_, members) in enumerate(self.families):
            for a, b in combinations(members, 2):
                rows = np.flatnonzero((langs == a) | (langs == b))
                self.pairs.append((i, a, b))
                columns.append(fit(x, rows, np.where(langs[rows] == a, 1, -1), len(columns)))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((SIZE + 1, 0), np.float32)

    def predict(self, texts: list) -> list[tuple[str, float]]:
        """(language, score) of each text; one product for all texts of a block."""
        out = []
        for low in range(0, len(texts), BLOCK):
            part = texts[low : low + BLOCK]
            if not self.langs:
                out += [(UNKNOWN, 0.0)] * len(part)
                continue
            z = vectors(part) @ self.weights[:-1] + self.weights[-1]
            out += [self.decide(row) if has_letter(t) else (UNKNOWN, 0.0) for t, row in zip(part, z, strict=True)]
        return out

    def decide(self, z: np.ndarray) -> tuple[str, float]:
        """The language whose family is the most certain, and within it that of the most votes."""
        certain = lambda m: float(1 / (1 + np.exp(-2 * np.clip(m, -30, 30))))
        if self.n_top == 0:
            at, score = 0, 1.0
        elif self.n_top == 1:
            at, score = (0 if z[0] > 0 else 1), certain(abs(z[0]))
        else:
            at = int(np.argmax(z[: self.n_top]))
            score = certain(z[at])
        members = self.families[at][1]
        if len(members) == 1:
            return members[0], score
        votes = dict.fromkeys(members, 0)
        margin = dict.fromkeys(members, np.inf)
        for (i, a, b), m in zip(self.pairs, z[self.n_top :], strict=True):
            if i == at:
                votes[a if m > 0 else b] += 1
                margin[a], margin[b] = min(margin[a], m), min(margin[b], -m)
        best = max(members, key=lambda lang: (votes[lang], margin[lang]))
        return best, score * certain(margin[best])


def train(docs: DataFrame) -> Hierarchy:
    """The machines for training rows (doc_id, text, lang)."""
    named = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    nothing = Sample(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64))
    if not counts:
        return Hierarchy(nothing, np.zeros(0, dtype=object))
    each = max(1, MOST_SAMPLE // len(counts))
    # ids whose hash lies in a share of the range that holds about twice as many as needed, then the least of them
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, float(min(1.0, 2 * each / n + 50 / n)))])
    near = named.select("doc_id", "lang").filter(spread < share[F.col("lang")] * (1 << 20))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = near.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= each).select("doc_id").distinct()
    chosen = materialize(chosen, "lang-sample")  # at most MOST_SAMPLE ids (one a language at least), so it may be broadcast
    rows = named.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("r.lang", "r.text")

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), BLOCK):
                part = batch.iloc[low : low + BLOCK]
                found = vectors(part["text"].tolist())
                at = [np.flatnonzero(v) for v in found]
                yield pd.DataFrame({"lang": part["lang"].values, "at": [i.astype(np.uint16).tobytes() for i in at], "value": [v[i].astype(np.float16).tobytes() for v, i in zip(found, at, strict=True)]})

    sample = rows.mapInPandas(sparse, "lang string, at binary, value binary").orderBy("lang", "at", "value").collect()  # a few kilobytes a text
    discard(chosen)
    if not sample:
        return Hierarchy(nothing, np.zeros(0, dtype=object))
    starts = np.cumsum([0, *(len(r["at"]) // 2 for r in sample)])
    index = np.frombuffer(b"".join(r["at"] for r in sample), np.uint16).astype(np.int64)
    value = np.frombuffer(b"".join(r["value"] for r in sample), np.float16).astype(np.float64)
    return Hierarchy(Sample(index, value, starts), np.array([r["lang"] for r in sample], dtype=object))


def predict(docs: DataFrame, model: Hierarchy) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machines = shared.value
        for batch in batches:
            found = machines.predict(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].values, "lang_pred": [x for x, _ in found], "score": [float(s) for _, s in found]})

    return id_restored(id_as_text(docs.select("doc_id", "text")).mapInPandas(run, "doc_id string, lang_pred string, score double"), docs)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): trained on the rows that are not held out, for all rows."""
    model = train(docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id"))))
    found = materialize(predict(docs, model), "lang-found", arrow_rows=TEXT_ROWS)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
