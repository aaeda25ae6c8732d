"""LM scoring with a hashed maximum-entropy model and a class-factored softmax.

p(word | history) = p(class | history) * p(word | class).  The classes are the end,
the HEAD most frequent words, one each, and the other words by a hash of their
ending.  p(class | history) is a softmax over hashed features of the history:
the previous word and the pair of the two previous ones (n-gram features), the word
two back (a skip feature) and a bias.  p(word | class, history) is a softmax too:
exp(weight) times the smoothed share of the word in its class (all unseen words
share half a count), with one weight for every pair of a history and a frequent word
that training has seen.  The history is the previous word, or where that is above
a share of 1 / COMMON, the two previous ones.  Histories are hashed to one or two slots a
training token and class, so this table grows with the input.  The probabilities sum to one
over the words seen and one unseen word in each class.

The weights of classes have a fixed size.  Their training covers every training document
once: in each round the tasks start from the common weights, make gradient steps over
sparse numpy batches of their share, and the weights are averaged by tokens in a tree of
bounded fan-in.  The weights of words lie in buckets by history, each of about
BUCKET tokens, which one task trains by gradient steps on the counts of all
training documents and applies to the tokens that ask for them; a task combines tokens of one
pair and document before that.  No table of them is broadcast or sent to the driver.

Word counts are over all training tokens.  Frequent words, the MOST_HOT most frequent ones and all above
a share of 1 / HOT_PART of the tokens (so at most HOT_PART), are looked up in a broadcast dictionary,
all others by a join on the word, whose keys are rare by that bound.

Edge cases: null and empty texts have the end as their only token; documents
with a null id count as training rows; without any training row every count is
0 and the model is uniform; repeated rows get equal scores (up to rounding); an empty table gives no rows;
texts are taken whole at any length; words of equal count are in the order of their bytes; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_remainder, id_restored, materialize

HEAD = 7
TAIL = 24
CLASSES = 1 + HEAD + TAIL
FEATURES = 1 << 13
HOT_PART = 1 << 21
#: Words with features of their own, where a share of 1 / HOT_PART does not give more.
MOST_HOT = 1 << 17
#: Histories of a word above a share of 1 / COMMON reach one word further back.
COMMON = 1 << 10
#: Tokens of a bucket of weights, and of a task's block of documents.
BUCKET = 1 << 21
BLOCK = 1 << 20
#: Bits of a word's place in a key, of a class, and most bits of a history's slot, the class included.
PLACE_BITS = 22
CLASS_BITS = 5
MOST_SLOT_BITS = 42
#: Variance of the prior of a word's weight, and gradient steps.
VARIANCE = 4.0
STEPS = 6
#: Sums are handed on in units of 1 / UNIT.
UNIT = 1024
ROUNDS = 3
BATCH = 8192
RATE = 0.15
FAN_IN = 16
#: Rows of one feature in a batch up to which they are added rank by rank.
LONG_RUN = 8
END = b""
HELD_OUT = (5, 1)
#: Distinct words that a task counts before it passes them on.
FLUSH = 300_000


def words_of(text: str | None) -> list[bytes]:
    r"""Lower-cased (A-Z) words: runs of bytes other than \x20 and \x09-\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(doc_id: Column) -> Column:
    divisor, remainder = HELD_OUT
    return F.coalesce(id_remainder(doc_id, divisor) == remainder, F.lit(False))


def tail_class(word: bytes) -> int:
    return 1 + HEAD + crc32(word[-2:]) % TAIL


class Places(dict):
    """word -> its place among the frequent words, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Tokens(NamedTuple):
    """The tokens of some texts: place of each among the frequent words, tokens of each text, classes, hashes of the words one and two back, positions of the rare words, these words."""

    place: np.ndarray
    counts: list[int]
    kinds: np.ndarray
    one: np.ndarray
    two: np.ndarray
    others: np.ndarray
    rare: list[bytes]

    @property
    def firsts(self) -> np.ndarray:
        return np.cumsum([0, *self.counts[:-1]])


class Model:
    """Classes of words and hashed features of histories. frequent: the frequent words' counts; heads: the most frequent words, each its own class."""

    def __init__(self, heads: list[bytes], frequent: dict[bytes, int]):
        words = list(frequent)
        own = {END: 0} | {w: i + 1 for i, w in enumerate(heads)}
        self.place = Places(zip(words, range(len(words)), strict=True))
        # the last entry stands for all other words
        self.hashes = np.array([*map(crc32, words), 0], np.uint64)
        self.kinds = np.array([*(own[w] if w in own else tail_class(w) for w in words), 0], np.int64)
        self.logs = np.log10(np.array([*frequent.values(), 0], float) + 0.5)

    def read(self, texts: list) -> Tokens:
        flat: list[bytes] = []
        counts = []
        for t in texts:
            words = words_of(t)
            flat += words
            flat.append(END)
            counts.append(len(words) + 1)
        n = len(flat)
        place = np.fromiter(map(self.place.__getitem__, flat), np.int64, n)
        h, kinds = self.hashes[place], self.kinds[place]
        others = np.flatnonzero(place < 0)
        rare = [flat[i] for i in others.tolist()]
        h[others] = np.fromiter(map(crc32, rare), np.uint64, len(rare))
        kinds[others] = np.fromiter(map(tail_class, rare), np.int64, len(rare))
        firsts = np.cumsum([0, *counts[:-1]])
        one, two = np.empty(n, np.uint64), np.empty(n, np.uint64)
        one[1:], two[2:] = h[: n - 1], h[: max(0, n - 2)]
        one[firsts] = two[firsts] = BEFORE
        two[np.minimum(firsts + 1, n - 1)[np.array(counts) > 1]] = BEFORE
        return Tokens(place, counts, kinds, one, two, others, rare)

    def rows(self, texts: list) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(place of every token, tokens of each text, class of every token, features of every token as rows of the weights, positions of the rare words, these words); the bias is row 0."""
        t = self.read(texts)
        return t.place, t.counts, t.kinds, features(t), t.others, t.rare


#: Stands for the words before the first.
BEFORE = np.uint64(0xA5A5A5A5A5)


def mixed(x: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
    y = (x + (np.uint64(kind) << np.uint64(41) if isinstance(kind, int) else kind.astype(np.uint64) << np.uint64(41))) * np.uint64(0x9E3779B97F4A7C15)
    y ^= y >> np.uint64(29)
    y *= np.uint64(0xBF58476D1CE4E5B9)
    return y


def slot(x: np.ndarray, kind: int) -> np.ndarray:
    return 1 + (mixed(x, kind) % np.uint64(FEATURES - 1)).astype(np.int64)


def pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return one * np.uint64(0x100000001B3) + two


def features(t: Tokens) -> np.ndarray:
    return np.stack([slot(t.one, 1), slot(t.two, 2), slot(pair(t.one, t.two), 3)])


def logits(weights: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, their exponentials, the sums of these) of a batch."""
    z = weights.take(index[0], axis=0)
    for f in index[1:]:
        z += weights.take(f, axis=0)
    z += weights[0]
    e = np.exp(z)
    ones = np.ones(z.shape[1], z.dtype)
    total = e @ ones
    if not np.isfinite(total).all():
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        total = e @ ones
    return z, e, total


def summed(g: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct features, sums of their rows of g). Most features of a batch are rare, so rows are added rank by rank, and long runs by a product."""
    order = np.argsort(feature.astype(np.uint16), kind="stable")
    ranked, rows = feature[order], g.take(order, axis=0)
    firsts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    n = np.diff(np.r_[firsts, len(ranked)])
    out = rows.take(firsts, axis=0)
    short = np.flatnonzero((n > 1) & (n <= LONG_RUN))
    for rank in range(1, LONG_RUN):
        short = short[n[short] > rank]
        if not len(short):
            break
        out[short] += rows.take(firsts[short] + rank, axis=0)
    for i in np.flatnonzero(n > LONG_RUN).tolist():
        out[i] = np.ones(n[i], g.dtype) @ rows[firsts[i] : firsts[i] + n[i]]
    return ranked[firsts], out


def step(weights: np.ndarray, squares: np.ndarray, at, total: np.ndarray) -> None:
    """A gradient step for some rows of the weights, each entry by its own gathered squares."""
    s = total * total
    s += squares[at]
    squares[at] = s
    s += 1.0
    np.sqrt(s, out=s)
    np.divide(total, s, out=s)
    s *= -RATE
    s += weights[at]
    weights[at] = s


def train_share(model: Model, weights: np.ndarray, squares: np.ndarray, texts: Iterator[list]) -> int:
    """Gradient steps with per-weight step sizes over batches of tokens; changes weights and squares. Gives the number of tokens."""
    seen = 0
    for part in texts:
        _, _, target, index, _, _ = model.rows(part)
        for low in range(0, len(target), BATCH):
            ix, t = index[:, low : low + BATCH], target[low : low + BATCH]
            _, g, total = logits(weights, ix)
            g *= (1 / total)[:, None]
            g[np.arange(len(t)), t] -= 1
            for f in ix:
                step(weights, squares, *summed(g, f))
            step(weights, squares, slice(0, 1), (np.ones(len(t), g.dtype) @ g)[None, :])
            seen += len(t)
    return seen


def text_parts(batch: pd.DataFrame, size: int = 64) -> Iterator[list]:
    texts = batch["text"].tolist()
    for low in range(0, len(texts), size):
        yield texts[low : low + size]


def train_round(spark, docs: DataFrame, vocabulary, weights: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: every task trains on its share from the common weights; averages by tokens. vocabulary: a broadcast of the heads and the frequent words."""
    shared = spark.sparkContext.broadcast((weights, squares))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, common = shared.value
        model, w, s, seen = Model(*vocabulary.value), start.copy(), common.copy(), 0
        for batch in batches:
            seen += train_share(model, w, s, text_parts(batch))
        if seen:
            yield pd.DataFrame({"tokens": [seen], "w": [((w - start) * seen).astype(np.float32).tobytes()], "s": [((s - common) * seen).astype(np.float32).tobytes()]})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, w, s = 0, 0.0, 0.0
        for batch in batches:
            for row in batch.itertuples(index=False):
                tokens += row.tokens
                w = w + np.frombuffer(row.w, np.float32)
                s = s + np.frombuffer(row.s, np.float32)
        if tokens:
            yield pd.DataFrame({"tokens": [tokens], "w": [w.astype(np.float32).tobytes()], "s": [s.astype(np.float32).tobytes()]})

    kind = "tokens long, w binary, s binary"
    written = parts = materialize(docs.select("text").mapInPandas(run, kind), "lm-round")
    n = parts.count()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInPandas(fold, kind)
    tokens, dw, ds = 0, np.zeros(weights.size, np.float64), np.zeros(weights.size, np.float64)
    for row in parts.toLocalIterator():  # FAN_IN rows of the weights' fixed size at most
        tokens += row["tokens"]
        dw += np.frombuffer(row["w"], np.float32)
        ds += np.frombuffer(row["s"], np.float32)
    shared.unpersist()
    discard(written)
    if tokens:
        weights = weights + (dw / tokens).reshape(weights.shape).astype(np.float32)
        squares = squares + (ds / tokens).reshape(weights.shape).astype(np.float32)
    return weights, squares


def count_words(docs: DataFrame) -> DataFrame:
    """(word, tail, n): counts of all tokens, the end included; combined in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for low in range(0, len(batch), 256):
                for t in batch.column("text").slice(low, 256).to_pylist():
                    found.update(words_of(t))
                if len(found) > FLUSH:
                    yield flush()
                    found.clear()
            found[END] += len(batch)
        if found:
            yield flush()

    counts = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ending = F.crc32(F.substring("word", -2, 2)) % F.lit(TAIL)
    return counts.select("word", (F.lit(1 + HEAD) + ending).cast("int").alias("tail"), "n")


def least_frequent(counts: DataFrame, n: int) -> float:
    """The least count of a frequent word."""
    scale = 8  # steps of the counts' logarithm, so the driver gets some 500 rows at most
    steps = counts.groupBy(F.floor(F.log2("n") * scale).alias("at")).agg(F.count("*").alias("v"), F.min("n").alias("least"))
    cut, words = n / HOT_PART, 0
    for row in sorted(steps.collect(), key=lambda r: -r["at"]):
        words += row["v"]
        if words > MOST_HOT:
            break
        cut = min(cut, float(row["least"]))
    return cut


class Trained:
    """What scoring needs: the training documents, the counts' table, the least count of a frequent word, the frequent words' counts, the class totals and the weights."""

    def __init__(self, docs: DataFrame, counts: DataFrame, cut: float, hot: dict, heads: list[bytes], n: int, v: int, totals: np.ndarray, weights: np.ndarray):
        self.docs, self.counts, self.cut, self.hot, self.heads, self.n, self.v, self.totals, self.weights = docs, counts, cut, hot, heads, n, v, totals, weights


def train(docs: DataFrame) -> Trained:
    """The model of a table of training documents (text)."""
    spark = docs.sparkSession
    counts = materialize(count_words(docs), "lm-counts")
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(row["n"]), int(row["v"])
    cut = least_frequent(counts, n)
    found = counts.filter(F.col("n") >= F.lit(cut)).select("word", "n").collect()  # at most HOT_PART words
    hot = {w: c for c, w in sorted(((int(r["n"]), bytes(r["word"])) for r in found), key=lambda x: (-x[0], x[1]))}
    heads = [w for _, w in sorted((-c, w) for w, c in hot.items() if w != END)[:HEAD]]
    classes = counts.withColumn("class", F.col("tail"))
    totals = np.zeros((CLASSES, 2))
    for r in classes.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # one row per class
        totals[r["class"]] += (r["n"], r["v"])
    for i, w in enumerate([END, *heads]):
        if w in hot:
            totals[tail_class(w)] -= (hot[w], 1)
            totals[i] += (hot[w], 1)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    squares = np.zeros((FEATURES, CLASSES), np.float32)
    weights[0] = np.log(totals[:, 0] + 0.5) - np.log(totals[:, 0].sum() + 0.5 * CLASSES)
    vocabulary = spark.sparkContext.broadcast((heads, hot))
    share = F.pmod(F.xxhash64("text"), F.lit(ROUNDS))
    for r in range(ROUNDS):
        weights, squares = train_round(spark, docs.filter(F.coalesce(share, F.lit(0)) == r), vocabulary, weights, squares)
    return Trained(docs, counts, cut, hot, heads, n, v, totals, weights)


class Buckets:
    """Where the weights of words lie: keys are a history's slot, then the word's place + 1 (0: a rare word); a bucket is a range of slots."""

    def __init__(self, n: int, tokens: int):
        self.bits = min(MOST_SLOT_BITS, max(1, n).bit_length() + CLASS_BITS)
        self.number = max(1, -(-tokens // BUCKET))

    def keys(self, t: Tokens, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the tokens whose class has several words, their keys). common: frequent words whose histories reach further back."""
        at = np.flatnonzero(t.kinds > HEAD)
        before = np.r_[-1, t.place[:-1]]
        before[t.firsts] = -1
        history = np.where(common[before[at]], pair(t.one[at], t.two[at]), t.one[at])
        # histories of one class may share a slot, those of two may not: a slot's shares must be of one class
        slots = mixed(history, t.kinds[at]) >> np.uint64(64 - self.bits + CLASS_BITS) << np.uint64(CLASS_BITS) | t.kinds[at].astype(np.uint64)
        return at, slots << np.uint64(PLACE_BITS) | (t.place[at] + 1).astype(np.uint64)

    def bounds(self) -> np.ndarray:
        """First key of each bucket but the first."""
        return np.array([(i << self.bits) // self.number << PLACE_BITS for i in range(1, self.number)], np.uint64)


def planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(data: memoryview, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size).reshape(size, n).T).view(kind).reshape(n)


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of one length as bytes, high bytes apart from low ones."""
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(b"".join(map(planes, columns)), asbytes=True)


def unsqueezed(data: bytes, *kinds: type) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = memoryview(pa.Codec("zstd").decompress(data[8:], n * sum(np.dtype(k).itemsize for k in kinds), asbytes=True))
    out, at = [], 0
    for k in kinds:
        out.append(from_planes(raw[at:], n, k))
        at += n * np.dtype(k).itemsize
    return out


def packed_block(keys: np.ndarray, docs: np.ndarray, buckets: Buckets) -> Iterator[tuple[int, bytes]]:
    """(bucket, its tokens as bytes): keys by their differences, documents, times, for tokens combined by key and document."""
    order = np.argsort(keys)
    k, d = keys[order], docs[order]
    # documents of one key in order: where a key repeats, sort the key's number and the document as one
    again = np.r_[False, k[1:] == k[:-1]][: len(k)]
    several = np.flatnonzero(again | np.r_[again[1:], False][: len(k)])
    runs = np.cumsum(~again[several]).astype(np.uint64) << np.uint64(32) | d[several]
    runs.sort()
    d[several] = runs.astype(np.uint32)
    firsts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])][: len(k)])
    times = np.diff(np.r_[firsts, len(k)]).astype(np.uint32)
    k, d = k[firsts], d[firsts]
    cuts = [0, *np.searchsorted(k, buckets.bounds()).tolist(), len(k)]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if high > low:
            slots = k[low:high] >> np.uint64(PLACE_BITS)
            places = (k[low:high] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.uint32)
            yield i, squeezed(np.diff(slots, prepend=np.uint64(0)), places, d[low:high], times[low:high])


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, documents, times)."""
    slots, places, docs, times = unsqueezed(data, np.uint64, np.uint32, np.uint32, np.uint32)
    return np.cumsum(slots, dtype=np.uint64) << np.uint64(PLACE_BITS) | places, docs, times


def added(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their times."""
    k, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(k, kind="stable")  # runs in order are merged
    k, n = k[order], n[order]
    firsts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][: len(k)])
    return k[firsts], np.add.reduceat(n, firsts) if len(firsts) else n


class WordWeights:
    """The trained weights of a bucket. shares: share of each frequent word in its class, by place."""

    def __init__(self, keys: np.ndarray, times: np.ndarray, shares: np.ndarray):
        slots = keys >> np.uint64(PLACE_BITS)
        place = (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) - 1
        firsts = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]][: len(slots)])
        sizes = np.diff(np.r_[firsts, len(slots)])
        self.keys, self.slots = keys, slots[firsts]
        self.theta, self.log_z = np.zeros(len(keys)), np.zeros(len(firsts))
        if not len(keys):
            return
        own = place >= 0  # rare words have no weight: it stays 0
        share = np.where(own, shares[place], 0.0).astype(np.float32)
        seen = np.where(own, times, 0).astype(np.float32)
        of_slot = np.repeat(np.add.reduceat(times.astype(np.float32), firsts), sizes)
        theta = np.zeros(len(keys), np.float32)
        theta[own] = np.minimum(VARIANCE * seen[own], np.log(seen[own] / (of_slot[own] * share[own])))
        base = of_slot * share
        for _ in range(STEPS):
            expected = base * np.exp(theta)
            expected /= np.repeat(self.normalizers(share, theta, firsts), sizes)
            theta += np.clip((seen - expected - theta / np.float32(VARIANCE)) / (expected + np.float32(1 / VARIANCE)), -1, 1)
        self.theta, self.log_z = theta.astype(float), np.log(self.normalizers(share.astype(float), theta.astype(float), firsts))

    @staticmethod
    def normalizers(share: np.ndarray, theta: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return 1 + np.add.reduceat(share * np.expm1(theta), firsts)

    def gains(self, keys: np.ndarray) -> np.ndarray:
        """What each token adds to the logarithm of its probability; a history that training has not seen adds nothing."""
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        slots = keys >> np.uint64(PLACE_BITS)
        of = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        return np.where(self.keys[at] == keys, self.theta[at], 0.0) - np.where(self.slots[of] == slots, self.log_z[of], 0.0)


#: Rows between the stages of scoring: documents (blob is null), tokens of a bucket, sums of a block.
BETWEEN = "bucket long, block long, at int, doc_id string, n_tokens long, n_hot long, words double, context double, rare binary, blob binary"
BETWEEN_SCHEMA = pa.schema([
    ("bucket", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.string()), ("n_tokens", pa.int64()), ("n_hot", pa.int64()),
    ("words", pa.float64()), ("context", pa.float64()), ("rare", pa.binary()), ("blob", pa.binary()),
])


def blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """Rows of (bucket, block, blob)."""
    own = dict(zip(("bucket", "block", "blob"), zip(*rows, strict=True), strict=True)) if rows else {"bucket": [], "block": [], "blob": []}
    return pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(rows), f.type) for f in BETWEEN_SCHEMA], schema=BETWEEN_SCHEMA)


#: Flags of a document beside its place in the block: its tokens train the weights; its score is asked for.
TRAINS, ASKED = 1, 2


def applied(parts: list[bytes], blocks: list[int], shares: np.ndarray) -> list[tuple[int, bytes]]:
    """(block, sums of its documents) of a bucket: trains the weights on the training tokens and adds them up over the tokens asked for."""
    keys, times, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for data in parts:
        k, d, n = unpacked(data)
        use = (d & TRAINS) > 0
        keys.append(k[use])
        times.append(n[use].astype(np.int64))
        held += int(use.sum())
        if held > BUCKET:
            k, n = added(keys, times)
            keys, times, held = [k], [n], 0
    weights = WordWeights(*added(keys, times), shares)
    out = []
    for data, block in zip(parts, blocks, strict=True):
        k, d, n = unpacked(data)
        use = (d & ASKED) > 0
        k, docs, n = k[use], d[use] >> 2, n[use]
        at, gains = np.zeros(0, np.uint32), weights.gains(k) * n
        if len(docs) and int(docs.max()) > 4 * len(docs):  # few of many documents
            at, docs = np.unique(docs, return_inverse=True)
        sums = np.rint(np.bincount(docs, gains) * UNIT).astype(np.int64)
        own = np.flatnonzero(sums)
        if len(own):
            out.append((block, squeezed(at[own] if len(at) else own.astype(np.uint32), sums[own])))
    return out


def score(docs: DataFrame, model: Trained) -> DataFrame:
    """(doc_id, row, n_tokens, n_known, base_score, score) of whole texts; row is unique.

    The documents must come from files or a written table, so that a task repeated after a lost executor reads the same rows in the same order.
    """
    asked = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.lit(ASKED).alias("flags"))
    trains = model.docs.select(F.lit(None).cast("string").alias("doc_id"), "text", F.lit(TRAINS).alias("flags"))
    return id_restored(score_flagged(asked.unionByName(trains), model), docs)


def score_flagged(keyed: DataFrame, model: Trained) -> DataFrame:
    """Scores of a table (doc_id string, text, flags) whose rows that train are those of the model."""
    spark = keyed.sparkSession
    # a word seen c times has the share (c + 0.5) / room[class]; a class without words gives all to an unseen one
    room = np.log10(model.totals[:, 0] + 0.5 * (model.totals[:, 1] + 1))
    buckets = Buckets(model.n, model.n)
    shared = spark.sparkContext.broadcast((model.heads, model.hot, model.weights, room, model.n))
    frequent = Model(model.heads, model.hot)
    shares = spark.sparkContext.broadcast(10 ** (frequent.logs - room[frequent.kinds]))  # HOT_PART numbers at most
    unseen = float(np.log10(0.5))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, hot, weights, room, n = shared.value
        m, scale = Model(heads, hot), np.log10(np.e)
        common = np.array([*(c * COMMON >= n for c in hot.values()), False])
        task = TaskContext.get().partitionId()
        block, held, rows, keys, docs = task << 31, 0, 0, [], []

        def flush() -> pa.RecordBatch:
            return blobs([(i, block, data) for i, data in packed_block(np.concatenate(keys), np.concatenate(docs), buckets)])

        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                t = m.read(part.column("text").to_pylist())
                flags = part.column("flags").to_numpy()
                own, k = buckets.keys(t, common)
                of = np.repeat(np.arange(len(part)), t.counts)
                keys.append(k)
                docs.append(((rows + of[own]) << 2 | flags[of[own]]).astype(np.uint32))
                held += len(own)
                if (flags & ASKED).any():
                    index = features(t)
                    context = np.empty(len(t.place))
                    for at in range(0, len(t.place), BATCH):
                        kind = t.kinds[at : at + BATCH]
                        z, _, total = logits(weights, index[:, at : at + BATCH])
                        context[at : at + BATCH] = (z[np.arange(len(kind)), kind] - np.log(total)) * scale - room[kind]
                    cuts = [*np.searchsorted(t.others, t.firsts).tolist(), len(t.rare)]
                    # log10(0.5) for the rare words so far
                    columns = {
                        "bucket": pa.array([-1 - (task + block) % buckets.number] * len(part), pa.int64()), "block": pa.array([block] * len(part), pa.int64()), "at": pa.array(range(rows, rows + len(part)), pa.int32()),
                        "doc_id": part.column("doc_id"), "n_tokens": pa.array(t.counts, pa.int64()), "n_hot": pa.array(np.add.reduceat((t.place >= 0).astype(np.int64), t.firsts)),
                        "words": pa.array(np.add.reduceat(m.logs[t.place], t.firsts)), "context": pa.array(np.add.reduceat(context, t.firsts)),
                        "rare": pa.array([b" ".join(t.rare[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()), "blob": pa.nulls(len(part), pa.binary()),
                    }
                    yield pa.RecordBatch.from_arrays([columns[f.name] for f in BETWEEN_SCHEMA], schema=BETWEEN_SCHEMA).filter(pa.array((flags & ASKED) > 0))
                rows += len(part)
                if held >= BLOCK:
                    yield flush()
                    block, held, rows, keys, docs = block + 1, 0, 0, [], []
        if keys:
            yield flush()

    def weigh(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() < 0:
            return rows  # documents, on their way to their block
        sums = applied(rows.column("blob").to_pylist(), rows.column("block").to_pylist(), shares.value)
        return pa.Table.from_batches([blobs([(0, block, data) for block, data in sums])])

    def gather(rows: pa.Table) -> pa.Table:
        is_doc = rows.column("blob").is_null()
        found = rows.filter(is_doc)
        at = found.column("at").to_numpy()
        total = np.zeros(int(at.max(initial=-1)) + 1, np.int64)
        for data in rows.column("blob").drop_null().to_pylist():
            i, n = unsqueezed(data, np.uint32, np.int64)
            total[i] += n
        context = found.column("context").to_numpy() + total[at] / (UNIT * np.log(10))
        found = found.drop_columns(["bucket", "blob"])
        return found.set_column(found.schema.get_field_index("context"), "context", pa.array(context))

    emitted = keyed.mapInArrow(tokens, BETWEEN)
    weighed = emitted.repartition(2 * buckets.number, "bucket").groupBy("bucket").applyInArrow(weigh, BETWEEN)
    scored = weighed.groupBy("block").applyInArrow(gather, "block long, at int, doc_id string, n_tokens long, n_hot long, words double, context double, rare binary")
    scored = materialize(scored.withColumn("row", F.struct("block", "at")), "lm-scored").drop("block", "at")
    words = F.explode(F.split(F.col("rare").cast("string"), " ")).alias("word")
    rare_rows = scored.filter(F.length("rare") > 0).select("row", words).withColumn("word", F.col("word").cast("binary"))
    seen = model.counts.filter(F.col("n") < F.lit(model.cut)).select(F.col("word").alias("w"), (F.log10(F.col("n") + 0.5) - F.lit(unseen)).alias("gain"))
    sums = rare_rows.join(seen, F.col("word") == F.col("w")).groupBy("row").agg(F.count("*").alias("n_rare"), F.sum("gain").alias("rare_gain"))
    out = scored.drop("rare").join(sums.withColumnRenamed("row", "k"), F.col("row") == F.col("k"), "left")
    words = F.col("words") + F.coalesce(F.col("rare_gain"), F.lit(0.0))
    known = F.col("n_hot") + F.coalesce(F.col("n_rare"), F.lit(0))
    base = words - F.col("n_tokens") * F.lit(float(np.log10(model.n + 0.5 * (model.v + 1))))
    return out.select("doc_id", "row", "n_tokens", known.alias("n_known"), base.alias("base_score"), (words + F.col("context")).alias("score"))


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): the model of the rows that are not held out, over all rows."""
    docs = docs.select("doc_id", "text")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    flags = F.lit(ASKED) + F.when(held_out(F.col("doc_id")), 0).otherwise(TRAINS)
    out = id_restored(score_flagged(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", flags.cast("int").alias("flags")), model), docs)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
