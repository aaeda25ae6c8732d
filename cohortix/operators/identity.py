"""Consistency of an identity's members, and the split of those that do not hold together."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.scores import blended_similarity, colour_similarity, consistency
from ..plans.store import materialize
from .clusters import linkage, linkage_of_rows
from .similarity import BLOCK, CHUNK, MOST_PARTS, STRIP, unit_rows

#: Bins that values are counted in, values around p10 that are returned, and what a bin is widened by against rounding.
BINS, MOST_VALUES, SLACK = 4096, 200_000, 1e-12
#: Where the variance of products is less than this share of their mean square, it is not taken from sums.
FLAT = 1e-6
#: Vectors in a block where pairs are only counted; a block of fewer than FEW is not worth that, as ranks are then often tied with a limit.
WIDE, FEW = 2 * BLOCK, 24


@dataclass(frozen=True)
class Limits:
    """The defaults of the consistency rules."""

    colour_weight: float = 0.25
    least_consistency: float = 0.74
    least_colour: float = 0.35
    split_size: int = 8
    split_mean: float = 0.78
    split_colour: float = 0.52
    split_p10: float = 0.62
    split_std: float = 0.07
    split_large_min: float = 0.58
    split_distance: float = 0.14
    album_consistency: float = 0.70
    album_large_consistency: float = 0.78
    album_colour: float = 0.50


def member_pairs(members: DataFrame, limits: Limits) -> DataFrame:
    """(label, left_id, right_id, reid, combined) of all pairs of a label; members (id, label, embedding[, colour array])."""
    coloured = "colour" in members.columns
    rows = members.select("id", "label", V.unit(V.as_double(F.col("embedding"))).alias("v"), (F.col("colour").cast("array<double>") if coloured else F.lit(None).cast("array<double>")).alias("c"))
    a = rows.select("label", F.col("id").alias("left_id"), F.col("v").alias("_v1"), F.col("c").alias("_c1"))
    b = rows.select("label", F.col("id").alias("right_id"), F.col("v").alias("_v2"), F.col("c").alias("_c2"))
    both = a.join(b, "label").filter("left_id < right_id")
    reid = V.cosine(F.col("_v1"), F.col("_v2"))
    shade = F.when(F.col("_c1").isNotNull() & F.col("_c2").isNotNull(), V.dot(F.col("_c1"), F.col("_c2")))
    combined = blended_similarity(F.col("reid"), colour_similarity(shade), limits.colour_weight)
    return both.withColumn("reid", reid).select("label", "left_id", "right_id", "reid", combined.alias("combined"))


def unit_or_none(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(rows at unit length filled up with zeros, their lengths): a missing vector is NaN, as is one with a missing element."""
    values = vectors.to_numpy()
    lengths = np.array([-1 if x is None else len(x) for x in values])
    v = np.zeros((len(lengths), max(0, lengths.max(initial=0))))
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        if n < 0:
            v[rows] = np.nan
        elif n > 0:
            x = np.concatenate(list(values[rows])).astype(float).reshape(len(rows), n)
            size = np.sqrt((x * x).sum(axis=1, keepdims=True))
            v[rows, :n] = x / np.where(size < V.TINY, 1.0, size)
    return v, lengths


def products(v: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, odd: float | None) -> np.ndarray:
    """Products of the rows a with the rows b; ``odd`` where their lengths differ, as a missing product counts."""
    out = v[a] @ v[b].T
    return out if odd is None else np.where(lengths[a][:, None] == lengths[b], out, odd)


def pair_strips(frame: pd.DataFrame, limits: Limits, coloured: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(reid, combined) of the pairs of a label's rows in a pair of blocks, as ``member_pairs`` has them, a strip at a time."""
    w = limits.colour_weight
    ids, own = frame["id"].to_numpy(), frame["_own"].to_numpy()
    v, lengths = unit_or_none(frame["embedding"])
    mixed = len(np.unique(lengths)) > 1
    missing = mixed or bool(np.isnan(v).any())
    if coloured:
        c, tones = colours(frame["colour"])
    low, high = frame["_low"].iloc[0], frame["_high"].iloc[0]
    first, last, alone = np.flatnonzero(own == low), np.flatnonzero(own == high), low == high
    same = alone and len(set(ids)) < len(ids)
    for at in range(0, len(first), STRIP):
        a, b = first[at : at + STRIP], last[at:] if alone else last
        keep = np.triu(np.ones((len(a), len(b)), bool), 1) & (ids[a][:, None] != ids[b] if same else True) if alone else None
        flat = (lambda x, keep=keep: x[keep]) if alone else np.ravel
        reid = flat(products(v, lengths, a, b, np.nan if mixed else None))
        if missing:  # least() and greatest() pass over what is missing
            reid[np.isnan(reid)] = 1.0
        np.clip(reid, -1, 1, out=reid)
        if coloured:
            raw = flat(products(c, tones, a, b, -np.inf))
            raw = np.where(np.isnan(raw), 1.0, np.clip((raw - 0.45) / 0.45, 0, 1))
            known = flat((tones[a][:, None] == tones[b]) & (tones[a] >= 0)[:, None])
            shade = np.where(known, raw, 0.5)
        else:
            shade = 0.5
        if len(reid):
            yield reid, np.clip((1.0 - w) * reid + w * shade, -1, 1)


def plain_blocks(frame: pd.DataFrame, limits: Limits, coloured: bool) -> tuple[np.ndarray, np.ndarray, bool] | None:
    """(first, last, alone): unit vectors of a pair of blocks whose blends are linear in their products; None for other pairs, which ``pair_strips`` has."""
    if coloured or not 0 <= limits.colour_weight <= 1:
        return None
    low, high = frame["_low"].iloc[0], frame["_high"].iloc[0]
    if low == high and frame["id"].duplicated().any():
        return None
    v, lengths = unit_or_none(frame["embedding"])
    if len(np.unique(lengths)) > 1 or lengths[0] < 1 or not np.isfinite(v).all():
        return None
    own = frame["_own"].to_numpy()
    return v[own == low], v[own == high], low == high


def rough_strips(first: np.ndarray, last: np.ndarray, alone: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, products in single precision) of the pairs of two blocks, each pair once; what is no pair is infinite."""
    a, b = first.astype(np.float32), last.astype(np.float32).T
    for at in range(0, len(a), STRIP):
        start = at if alone else 0
        rough = a[at : at + STRIP] @ b[:, start:]
        if alone:
            square = rough[:, : len(rough)]
            square[np.tril_indices(len(square))] = np.inf
        yield at, start, rough


def margin(v: np.ndarray) -> float:
    """More than the error of a product of unit vectors in single precision."""
    return (v.shape[1] + 4) * 2.0**-23


def plain_sums(first: np.ndarray, last: np.ndarray, alone: bool, limits: Limits) -> dict | None:
    """Count, means and squared deviations of a pair of blocks' pairs in closed form; None where the deviation is too small for sums."""
    w, n = limits.colour_weight, len(first) * (len(first) - 1) // 2 if alone else len(first) * len(last)
    if not n:
        return None
    if alone:
        size = (first * first).sum(axis=1)
        total = (float(np.square(first.sum(axis=0)).sum()) - float(size.sum())) / 2
        squares = (float(np.square(first.T @ first).sum()) - float((size * size).sum())) / 2
    else:
        total = float(first.sum(axis=0) @ last.sum(axis=0))
        squares = float(((first.T @ first) * (last.T @ last)).sum())
    apart = squares - total * total / n
    if apart < FLAT * squares or squares <= 0:
        return None
    return {"n": n, "reid_sum": total, "mean": (1.0 - w) * total / n + 0.5 * w, "square": (1.0 - w) ** 2 * apart, "own_sum": 0.5 * n, "p10": None}


def plain_part(first: np.ndarray, last: np.ndarray, alone: bool, limits: Limits) -> dict | None:
    """What ``pair_parts`` has of a pair of blocks: sums in closed form, the least product from double precision, counts in bins from single precision; None where ``plain_sums`` has none."""
    if not (sums := plain_sums(first, last, alone, limits)):
        return None
    w, n = limits.colour_weight, sums["n"]
    least, near, bins, scale = np.inf, 2 * margin(first), np.zeros(BINS + 1, np.int64), BINS / 2
    for at, start, rough in rough_strips(first, last, alone):
        if rough.min(initial=np.inf) <= least + near:
            exact = first[at : at + STRIP] @ last[start:].T
            least = min(least, float(exact[np.isfinite(rough)].min(initial=np.inf)))
        rough *= np.float32((1.0 - w) * scale)
        rough += np.float32((0.5 * w + 1.0) * scale)
        if alone:
            rough[:, : len(rough)][np.tril_indices(len(rough))] = BINS  # counted apart
        bins += np.bincount(np.clip(rough, 0, BINS if alone else BINS - 1, out=rough).astype(np.intp).ravel(), minlength=BINS + 1)
    reid_min, shift = max(-1.0, min(1.0, least)), 0.5 * w
    # a product that rounding takes beyond the last bin counts in it
    bins[BINS - 1] += n - bins[:BINS].sum()
    return sums | {"reid_min": reid_min, "combined_min": (1.0 - w) * reid_min + shift, "bins": bins[:BINS], "slack": near}


def plain_doubts(first: np.ndarray, last: np.ndarray, alone: bool, limits: Limits) -> dict | None:
    """As ``plain_part``, with what ``should_split`` compares alone: the number of values below ``split_p10`` as the only bin, and least values where they are below ``split_large_min``.

    Single precision tells which values are worked out in double precision. Where the blocks show that the label is
    large, a value below ``split_large_min`` decides it, so the rest of their pairs is not counted.
    """
    members = len(first) + (0 if alone else len(last))
    if limits.colour_weight >= 1 or members < FEW or not (sums := plain_sums(first, last, alone, limits)):
        return None
    w, near, below, least, large = limits.colour_weight, 2 * margin(first), 0, np.inf, members >= max(24, limits.split_size)
    edge, floor = ((x - 0.5 * w) / (1.0 - w) for x in (limits.split_p10, limits.split_large_min))
    sure, maybe, floor = np.float32(edge - near), np.float32(edge + near), np.float32(floor + near)

    def exact(i: np.ndarray, j: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(0, len(i), CHUNK):
            yield (1.0 - w) * np.clip(np.einsum("ij,ij->i", first[i[k : k + CHUNK]], last[j[k : k + CHUNK]]), -1, 1) + w * 0.5

    for at, start, rough in rough_strips(first, last, alone):
        if rough.min(initial=np.inf) <= floor:
            i, j = np.nonzero(rough <= floor)
            for x in exact(at + i, start + j):
                least = min(least, float(x.min()))
                if large and least < limits.split_large_min:
                    break
            if large and least < limits.split_large_min:
                break
        known = np.count_nonzero(rough < sure)
        below += known
        if np.count_nonzero(rough <= maybe) > known:
            i, j = np.nonzero((rough >= sure) & (rough <= maybe))
            below += sum(int((x < limits.split_p10).sum()) for x in exact(at + i, start + j))
    least = least if least < limits.split_large_min else np.inf
    return sums | {"reid_min": np.inf, "combined_min": least, "bins": [below], "slack": 0.0}


def plain_values(first: np.ndarray, last: np.ndarray, alone: bool, limits: Limits, low: float, high: float) -> tuple[int, np.ndarray]:
    """(number of values below low, those from low to high): single precision tells which values are worked out in double precision."""
    w, before, found = limits.colour_weight, 0, [np.empty(0)]
    least, most = ((x - 0.5 * w) / (1.0 - w) for x in (low, high))
    least, most = np.float32(least - 2 * margin(first)), np.float32(most + 2 * margin(first))
    for at, start, rough in rough_strips(first, last, alone):
        before += int((rough < least).sum())
        i, j = np.nonzero((rough >= least) & (rough <= most))
        for k in range(0, len(i), CHUNK):
            reid = np.clip(np.einsum("ij,ij->i", first[at + i[k : k + CHUNK]], last[start + j[k : k + CHUNK]]), -1, 1)
            x = (1.0 - w) * reid + w * 0.5
            before += int((x < low).sum())
            found.append(x[(x >= low) & (x <= high)])
    return before, np.concatenate(found)


def colours(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints filled up with zeros, their lengths, -1 for a missing one)."""
    lengths = np.array([-1 if x is None else len(x) for x in column])
    c = np.zeros((len(lengths), max(0, lengths.max(initial=0))))
    for r in np.flatnonzero(lengths > 0):
        c[r, : lengths[r]] = column.iloc[r]
    return c, lengths


def in_blocks(members: DataFrame, block: int) -> tuple[DataFrame, bool]:
    """Members by pairs of blocks (``_big``, ``_low``, ``_high``), and whether a label has several blocks.

    A label with more than a block of members is dealt by a hash of the id and named by ``_big``; the others meet in
    buckets that hold about a block, each label whole in one of them.
    """
    coloured = "colour" in members.columns
    shade = F.col("colour").cast("array<double>") if coloured else F.lit(None).cast("array<double>")
    vector = F.col("embedding") if members.schema["embedding"].dataType.simpleString() == "array<float>" else F.col("embedding").cast("array<double>")
    rows = members.filter("id IS NOT NULL AND label IS NOT NULL").select("id", "label", vector.alias("embedding"), F.when(~F.exists(shade, F.isnull), shade).alias("colour"))
    # written, so that few labels are broadcast and the vectors are not dealt by label first
    sizes = materialize(rows.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"), F.count("*").alias("_n")), "sizes")
    total, most, units = sizes.agg(F.sum("_n"), F.max("_blocks"), F.sum(F.when(F.col("_blocks") > 1, F.col("_blocks") * (F.col("_blocks") + 1) / 2))).first()
    buckets = -(-(total or 0) // block) or 1
    big = F.col("_blocks") > 1
    rows = rows.join(sizes.select("label", "_blocks"), "label").withColumn("_own", F.when(big, F.pmod(F.xxhash64("id"), F.col("_blocks"))).otherwise(F.pmod(F.xxhash64("label"), F.lit(buckets))).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.when(big, F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(F.array("_own"))))
    rows = rows.select("id", "label", "embedding", "colour", "_own", F.when(big, F.col("label")).alias("_big"), F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"))
    return rows.repartition(min(MOST_PARTS, int(units or 0) + buckets), "_big", "_low", "_high"), (most or 0) > 1


def in_bins(combined: np.ndarray) -> np.ndarray:
    return binned(combined, -1.0, 1.0)


def pair_parts(blocks: DataFrame, limits: Limits, coloured: bool, plain_way: Callable = plain_part, counts: Callable = in_bins, whole_too: bool = False) -> DataFrame:
    """Per label and pair of blocks: count, means, least values, squared deviations and p10 of its pairs, or, where a label has several blocks, how many values fall into each of BINS bins (or what ``counts`` has) instead of p10; so too, with ``whole_too``, where ``plain_way`` has a label of one block."""
    w = limits.colour_weight
    kind = blocks.schema["label"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> dict | None:
        whole = bool(frame["_big"].isna().all())
        if (whole_too or not whole) and (plain := plain_blocks(frame, limits, coloured)) and (part := plain_way(*plain, limits)):
            return {"label": frame["label"].iloc[0], **part}
        n, reid_sum, mean, square, own_sum = 0, 0.0, 0.0, 0.0, 0.0
        reid_min = combined_min = np.inf
        values, bins = [], counts(np.empty(0))
        for reid, combined in pair_strips(frame, limits, coloured):
            k, m = len(reid), combined.mean()
            apart = combined - m
            square += float(apart @ apart) + (m - mean) ** 2 * n * k / (n + k)
            mean, n = mean + (m - mean) * k / (n + k), n + k
            reid_sum, reid_min, combined_min = reid_sum + float(reid.sum()), min(reid_min, float(reid.min())), min(combined_min, float(combined.min()))
            own_sum += 0.5 * k if w <= 0 or not coloured else float(np.clip((combined - (1.0 - w) * reid) / w, 0, 1).sum())
            if whole:
                values.append(combined)
            else:
                bins = bins + counts(combined)
        if not n:
            return None
        p10 = float(np.percentile(np.concatenate(values), 10)) if whole else None
        return {"label": frame["label"].iloc[0], "n": n, "reid_sum": reid_sum, "reid_min": reid_min, "mean": mean, "square": square, "combined_min": combined_min, "own_sum": own_sum, "p10": p10, "bins": None if whole else bins, "slack": SLACK}

    names = ["label", "n", "reid_sum", "reid_min", "mean", "square", "combined_min", "own_sum", "p10", "bins", "slack"]

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        found = [one(part) for _, part in frame.groupby("label", sort=False) if len(part) > 1]
        return pd.DataFrame([x for x in found if x], columns=names)

    return blocks.groupBy("_big", "_low", "_high").applyInPandas(meet, f"label {kind}, n long, reid_sum double, reid_min double, mean double, square double, combined_min double, own_sum double, p10 double, bins array<long>, slack double")


def binned(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """Counts of the values in BINS equal bins from low to high; values beyond count in the outer ones."""
    return np.bincount(np.clip((x - low) * (BINS / (high - low)), 0, BINS - 1).astype(np.intp), minlength=BINS)


def located(counts: DataFrame, ranks: DataFrame) -> DataFrame:
    """(label, a, b, inside): the least keys up to which more than ``rank`` and ``rank + 1`` values are counted, and the number of values from a to b; counts (label, key, n), ranks (label, rank)."""
    order = Window.partitionBy("label").orderBy("key")
    upto = counts.groupBy("label", "key").agg(F.sum("n").alias("n")).withColumn("_upto", F.sum("n").over(order)).join(ranks.select("label", "rank"), "label")
    found = upto.groupBy("label").agg(F.min(F.when(F.col("_upto") > F.col("rank"), F.col("key"))).alias("a"), F.min(F.when(F.col("_upto") > F.col("rank") + 1, F.col("key"))).alias("b"), F.max("key").alias("_last"))
    found = found.select("label", F.coalesce("a", "_last").alias("a"), F.coalesce("b", "_last").alias("b"))
    return upto.join(found, "label").filter("key BETWEEN a AND b").groupBy("label", "a", "b").agg(F.sum("n").alias("inside"))


def exact_p10(blocks: DataFrame, parts: DataFrame, limits: Limits, coloured: bool) -> DataFrame:
    """(label, p10) of labels with several blocks: the bins' counts may be rough by ``slack``, by which what is searched is widened; the values around the rank are narrowed down to a bin, then bins of that bin, until they are few enough to be returned; pairs are multiplied again in each round."""
    kind = blocks.schema["label"].dataType.simpleString()
    position = (F.sum("n") - 1) * 0.1
    found = parts.filter("bins IS NOT NULL")
    ranks = found.groupBy("label").agg(F.floor(position).alias("rank"), (position - F.floor(position)).alias("share"), F.max("slack").alias("slack"))
    bins = located(found.select("label", F.posexplode("bins").alias("key", "n")).filter("n > 0"), ranks)
    width = F.lit(2.0 / BINS)
    spans = bins.join(ranks, "label").select("label", (F.col("a") * width - 1.0 - F.col("slack")).alias("low"), ((F.col("b") + 1) * width - 1.0 + F.col("slack")).alias("high"), "inside", "rank", "share")
    big, out = blocks.filter("_big IS NOT NULL"), None
    while True:
        spans = materialize(spans, "spans")
        few = (F.col("inside") <= MOST_VALUES) | (F.col("high") - F.col("low") <= 4 * SLACK)

        def look(frame: pd.DataFrame) -> pd.DataFrame:
            low, high, fine = frame["low"].iloc[0], frame["high"].iloc[0], frame["few"].iloc[0]
            if fine and limits.colour_weight < 1 and (plain := plain_blocks(frame, limits, coloured)):
                before, x = plain_values(*plain, limits, low, high)
                keys, n = np.unique(x, return_counts=True)
                return pd.DataFrame({"label": frame["label"].iloc[0], "few": True, "key": np.append(-9.0, keys), "n": np.append(before, n)})
            before, values, bins = 0, [], np.zeros(BINS, np.int64)
            for _, x in pair_strips(frame, limits, coloured):
                before += int((x < low).sum())
                x = x[(x >= low) & (x <= high)]
                if fine:
                    values.append(np.unique(x, return_counts=True))
                else:
                    bins += binned(x, low, high)
            keys, n = (np.concatenate(x) for x in zip(*values, strict=True)) if values else (np.flatnonzero(bins), bins[bins > 0])
            return pd.DataFrame({"label": frame["label"].iloc[0], "few": fine, "key": np.append(-9.0, keys), "n": np.append(before, n)})

        seen = big.join(F.broadcast(spans.select("label", "low", "high", few.alias("few"))), "label").groupBy("_big", "_low", "_high").applyInPandas(look, f"label {kind}, few boolean, key double, n long")
        seen = materialize(seen, "values")
        found = located(seen.filter("few").select("label", "key", "n"), spans).join(spans.select("label", "share"), "label").select("label", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("p10"))
        out = found if out is None else out.unionByName(found)
        rest = spans.filter(~few)
        if rest.isEmpty():
            return out
        width = (F.col("high") - F.col("low")) / BINS
        finer = located(seen.filter("NOT few").select("label", "key", "n"), spans).join(rest.drop("inside"), "label")
        spans = finer.select("label", (F.col("low") + F.greatest("a", F.lit(0.0)) * width - SLACK).alias("low"), (F.col("low") + (F.col("b") + 1) * width + SLACK).alias("high"), "inside", "rank", "share")
        big = big.join(F.broadcast(rest.select("label")), "label", "left_semi")


def pooled(parts: DataFrame, *more: Column) -> DataFrame:
    """The statistics of ``pair_stats`` from those of the pairs of blocks, and more aggregates of them; ``combined_p10`` is missing where a label has several blocks."""
    mean = F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy("label")) / F.sum("n").over(Window.partitionBy("label"))
    apart = parts.withColumn("_mean", mean).withColumn("_square", F.col("square") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    return apart.groupBy("label").agg(
        (F.sum("reid_sum") / F.sum("n")).alias("reid_mean"), F.min("reid_min").alias("reid_min"), F.first("_mean").alias("combined_mean"), F.min("combined_min").alias("combined_min"),
        F.max("p10").alias("combined_p10"), F.sqrt(F.sum("_square") / F.sum("n")).alias("combined_std"), (F.sum("own_sum") / F.sum("n")).alias("color_mean"), *more,
    )


def pair_stats(members: DataFrame, limits: Limits, block: int = BLOCK) -> DataFrame:
    """(label, reid_mean, reid_min, combined_mean, combined_min, combined_p10, combined_std, color_mean) over the pairs of each label, exact, by products of blocks; no pair leaves its task, but for the values around p10."""
    coloured = "colour" in members.columns
    blocks, several = in_blocks(members, block)
    parts = materialize(pair_parts(blocks, limits, coloured), "pairs")
    out = pooled(parts)
    if not several:
        return out
    return out.join(exact_p10(blocks, parts, limits, coloured), "label", "left").withColumn("combined_p10", F.coalesce("combined_p10", "p10")).drop("p10")


def stats(members: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Statistics per label: size, mean and least similarities, p10 (linear interpolation), deviation, colour mean, score and reasons; a single member is consistent."""
    found = pair_stats(members, limits)
    sizes = members.groupBy("label").agg(F.count("*").alias("size"))
    ones = ["reid_mean", "reid_min", "combined_mean", "combined_min", "combined_p10", "color_mean"]
    out = sizes.join(found, "label", "left").select("label", "size", *[F.coalesce(c, F.lit(1.0)).alias(c) for c in ones], F.coalesce("combined_std", F.lit(0.0)).alias("combined_std"))
    out = out.withColumn("identity_consistency_score", F.when(F.col("size") > 1, consistency(F.col("combined_mean"), 0.68, 0.22)).otherwise(1.0))
    many = F.col("size") > 1
    reasons = [
        F.when(many & (F.col("combined_mean") < limits.least_consistency), "weak_identity_consistency"),
        F.when(many & (F.col("color_mean") < limits.least_colour), "outfit_color_diversity"),
        F.when((F.col("combined_min") < limits.split_large_min) & (F.col("size") >= 3), "low_min_pair_similarity"),
    ]
    return out.withColumn("reasons", F.array_compact(F.array(*reasons)))


def should_split(limits: Limits = Limits(), low: Column | None = None):
    """The condition over the columns of ``stats``; ``low`` says whether p10 is below its limit."""
    low = F.col("combined_p10") < limits.split_p10 if low is None else low
    loose = low & (F.col("combined_std") > limits.split_std)
    large = (F.col("size") >= 24) & (F.col("combined_min") < limits.split_large_min)
    return (F.col("size") >= limits.split_size) & ((F.col("combined_mean") < limits.split_mean) | (F.col("color_mean") < limits.split_colour) | loose | large)


def split_flags(members: DataFrame, limits: Limits = Limits(), block: int = WIDE) -> DataFrame:
    """(label, should_split) as ``stats`` and ``should_split`` have it, exact, from counts: p10 is below its limit if enough values are, so it is worked out only where the limit lies between the two values that it is interpolated from."""
    coloured = "colour" in members.columns

    def below(combined: np.ndarray) -> np.ndarray:
        return np.array([(combined < limits.split_p10).sum()])

    parts = pair_parts(in_blocks(members, block)[0], limits, coloured, plain_doubts, below, whole_too=True)
    found = pooled(parts, F.sum("n").alias("_pairs"), F.sum(F.element_at("bins", 1)).alias("_below"))
    out = members.groupBy("label").agg(F.count("*").alias("size")).join(found, "label", "left")
    rank = F.floor((F.col("_pairs") - 1) * 0.1)
    low = F.when(F.col("_pairs").isNull(), F.lit(1.0) < limits.split_p10).when(F.col("combined_p10").isNotNull(), F.col("combined_p10") < limits.split_p10).when(F.col("_below") <= rank, False).when(F.col("_below") >= rank + 2, True)
    ones = {c: F.coalesce(c, F.lit(1.0)) for c in ("combined_mean", "combined_min", "color_mean")} | {"combined_std": F.coalesce("combined_std", F.lit(0.0))}
    out = materialize(out.withColumns(ones).select("label", should_split(limits, low).alias("should_split")), "flags")
    open_ = out.filter("should_split IS NULL").select("label")
    if open_.isEmpty():
        return out
    exact = stats(members.join(F.broadcast(open_), "label", "left_semi"), limits).select("label", should_split(limits).alias("should_split"))
    return out.filter("should_split IS NOT NULL").unionByName(exact)


def split(members: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(id, label): members whose label should be split are clustered again on the combined distance; the part with the least member keeps the label, others are named by their least member."""
    doubtful = stats(members, limits).filter(should_split(limits)).select("label")
    kept = members.join(doubtful, "label", "left_anti").select("id", "label")
    rows = members.join(doubtful, "label").select("id", "label", F.col("embedding").cast("array<double>").alias("embedding"), (F.col("colour").cast("array<double>") if "colour" in members.columns else F.lit(None).cast("array<double>")).alias("colour"))
    kind = members.schema["id"].dataType.simpleString()

    def parts(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        v = unit_rows(frame["embedding"])
        have = frame["colour"].notna().to_numpy()
        if have.any():
            shade = np.full((len(v), len(v)), 0.5)
            c = np.asarray(frame.loc[have, "colour"].tolist(), float)
            shade[np.ix_(have, have)] = np.clip((c @ c.T - 0.45) / 0.45, 0, 1)
            similar = np.clip((1 - limits.colour_weight) * np.clip(v @ v.T, -1, 1) + limits.colour_weight * shade, -1, 1)
            label = linkage(np.clip(1 - similar, 0, 2), limits.split_distance)
        else:  # without colours the blend is linear in the product, so the matrix is not needed
            label = linkage_of_rows(v, limits.split_distance, slope=1 - limits.colour_weight, offset=0.5 * limits.colour_weight)
        ids = frame["id"].to_numpy()
        return pd.DataFrame({"id": ids, "label": np.where(label == label[0], frame["label"].to_numpy(), ids[label])})

    return kept.unionByName(rows.groupBy("label").applyInPandas(parts, f"id {kind}, label {kind}"))
