"""Pairwise similarity of vectors, mean vectors and their consistency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..plans.store import materialize

#: Vectors in a block of the blocked self-join, rows of a block that are multiplied at once, pairs that are multiplied one by one at once.
BLOCK, STRIP, CHUNK = 4096, 256, 1 << 16
#: Partitions that pairs of blocks are dealt to at most.
MOST_PARTS = 4096


def pairs(vectors: DataFrame, group: str, least: float | None = None) -> DataFrame:
    """(group, left_id, right_id, sim) of the pairs left_id < right_id of each group, as one declarative join on the group.

    vectors (id, embedding, group). For pairs of a whole table see ``blocked_pairs``.
    """
    rows = vectors.select("id", V.unit(V.as_double(F.col("embedding"))).alias("v"), group)
    a = rows.select(group, F.col("id").alias("left_id"), F.col("v").alias("_a"))
    b = rows.select(group, F.col("id").alias("right_id"), F.col("v").alias("_b"))
    out = a.join(b, group).filter("left_id < right_id").select(group, "left_id", "right_id", V.cosine(F.col("_a"), F.col("_b")).alias("sim"))
    return out.filter(F.col("sim") >= least) if least is not None else out


def unit_rows(embeddings: pd.Series) -> np.ndarray:
    """The vectors as a matrix of doubles at unit length; those shorter than TINY stay as they are."""
    v = np.asarray(embeddings.tolist(), np.float64)
    norms = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norms < V.TINY, 1.0, norms)


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows with their block ``_own``, by a hash of the id, once for each pair of blocks ``_low`` <= ``_high`` that holds it."""
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumn("_low", F.least("_own", "_other")).withColumn("_high", F.greatest("_own", "_other")).drop("_other")
    return rows.repartition(min(MOST_PARTS, blocks * (blocks + 1) // 2), "_low", "_high")


def near_rows(frame: pd.DataFrame, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sim): rows of a pair of blocks with a similarity of at least ``least``, each pair once, a strip at a time.

    Products in single precision choose what is computed in double precision; the margin is above their error.
    """
    v, own = unit_rows(frame["embedding"]), frame["_own"].to_numpy()
    first, last = np.flatnonzero(own == frame["_low"].iloc[0]), np.flatnonzero(own == frame["_high"].iloc[0])
    alone = frame["_low"].iloc[0] == frame["_high"].iloc[0]
    rough = v.astype(np.float32)
    others, margin = rough[last].T, (v.shape[1] + 4) * 2.0**-23
    for at in range(0, max(1, len(first)), STRIP):
        i, j = np.nonzero(rough[first[at : at + STRIP]] @ others[:, at if alone else 0 :] >= least - margin)
        i, j = i + at, j + (at if alone else 0)
        if alone:
            i, j = i[i < j], j[i < j]
        i, j = first[i], last[j]
        sim = np.concatenate([np.empty(0), *[np.clip(np.einsum("ij,ij->i", v[i[k : k + CHUNK]], v[j[k : k + CHUNK]]), -1, 1) for k in range(0, len(i), CHUNK)]])
        keep = sim >= least
        yield i[keep], j[keep], sim[keep]


def blocked_pairs(vectors: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(left_id, right_id, sim) of all pairs with a similarity of at least ``least``: exact, by products of blocks.

    Vectors are dealt to blocks by a hash of the id, every pair of blocks meets in one task, and only pairs above the
    threshold leave it. A vector is sent to as many tasks as there are blocks.
    """
    blocks = max(1, -(-vectors.count() // block))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        ids, found = frame["id"].to_numpy(), list(near_rows(frame, least))
        i, j, sim = (np.concatenate(x) for x in zip(*found, strict=True))
        a, b = ids[i], ids[j]
        a, b = np.where(a < b, a, b), np.where(a < b, b, a)
        return pd.DataFrame({"left_id": a, "right_id": b, "sim": sim})[a != b]

    kind = vectors.schema["id"].dataType.simpleString()
    rows = dealt(vectors.select("id", F.col("embedding").cast("array<float>").alias("embedding")), blocks)
    return rows.groupBy("_low", "_high").applyInPandas(meet, f"left_id {kind}, right_id {kind}, sim double")


def connected(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each row is connected with, by these links and those that ``root`` stands for."""
    i, j = np.append(i, np.arange(len(root))), np.append(j, root)
    while True:
        low, new = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def blocked_links(vectors: DataFrame, least: float, most: int, block: int = BLOCK) -> DataFrame:
    """(left_id, right_id, whole): links that connect what pairs with a similarity of at least ``least`` connect.

    A pair of blocks returns all its pairs, or, where these are more than its share of ``most``, one link from each row
    to the least row that the block pair connects it with, with ``whole`` false.
    """
    blocks = max(1, -(-vectors.count() // block))
    share = most // (blocks * (blocks + 1) // 2)

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["id"].to_numpy()
        root, found, n = np.arange(len(frame)), [], 0
        for i, j, _ in near_rows(frame, least):
            if n <= share < n + len(i):
                for a, b in found:
                    root = connected(root, a, b)
                found = []
            n += len(i)
            if n > share:
                root = connected(root, i, j)
            else:
                found.append((i, j))
        if n > share:
            found = [(root[root < np.arange(len(root))], np.flatnonzero(root < np.arange(len(root))))]
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"left_id": ids[i], "right_id": ids[j], "whole": np.full(len(i), n <= share)})

    kind = vectors.schema["id"].dataType.simpleString()
    rows = dealt(vectors.select("id", "embedding"), blocks)
    return rows.groupBy("_low", "_high").applyInPandas(meet, f"left_id {kind}, right_id {kind}, whole boolean")


def mean_vectors(crops: DataFrame, key: str = "track_id") -> DataFrame:
    """(key, embedding, crops_used): mean of the valid unit vectors, at unit length again; keys whose mean vanishes or that have no valid vector are absent."""
    good = crops.filter(V.is_valid(V.as_double(F.col("embedding")))).select(key, V.unit(V.as_double(F.col("embedding"))).alias("v"))
    counts = good.groupBy(key).agg(F.count("*").alias("crops_used"))
    parts = good.select(key, F.posexplode("v").alias("i", "x")).groupBy(key, "i").agg(F.avg("x").alias("x"))
    means = parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("mean"))
    return means.join(counts, key).filter(V.norm(F.col("mean")) > V.TINY).select(key, V.unit(F.col("mean")).alias("embedding"), "crops_used")


def mean_pair_similarity(vectors: DataFrame, key: str) -> DataFrame:
    """(key, n, mean_sim) in closed form: (|sum of unit vectors|^2 - n) / (n (n - 1)), linear in the number of vectors; null for one vector."""
    rows = vectors.select(key, V.unit(V.as_double(F.col("embedding"))).alias("v"))
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    sums = rows.select(key, F.posexplode("v").alias("i", "x")).groupBy(key, "i").agg(F.sum("x").alias("s")).groupBy(key).agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    return counts.join(sums, key, "left").select(key, "n", F.when(F.col("n") > 1, (F.col("q") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).alias("mean_sim"))


def embedding_consistency(vectors: DataFrame, key: str) -> DataFrame:
    """(key, n, consistency): scaled mean pair similarity; 1 for a single vector."""
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("mean_sim") - 0.55) / 0.40))
    return mean_pair_similarity(vectors, key).select(key, "n", F.coalesce(scaled, F.lit(1.0)).alias("consistency"))


def checked(vectors: DataFrame, dimension: int) -> DataFrame:
    """Adds ``valid`` and ``unit_embedding`` (null if invalid)."""
    v = V.as_double(F.col("embedding"))
    ok = V.is_valid(v, dimension)
    return vectors.withColumn("valid", ok).withColumn("unit_embedding", F.when(ok, V.unit(v)))


def similarity_csv(similar: DataFrame, ids: list) -> DataFrame:
    """The similarity matrix of a short list of ids as rows of text with six decimals."""
    text = F.format_string("%.6f", F.col("sim"))
    both = similar.select("left_id", "right_id", text.alias("t")).unionByName(similar.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), text.alias("t")))
    own = similar.sparkSession.createDataFrame([(i,) for i in ids], ["left_id"]).select("left_id", F.col("left_id").alias("right_id"), F.lit("1.000000").alias("t"))
    return both.unionByName(own).groupBy("left_id").pivot("right_id", ids).agg(F.first("t"))


def dense_rows(active: DataFrame, order: str) -> DataFrame:
    """Adds ``row``: 0, 1, 2... in an order, from row numbers within ranges and the sizes of the ranges before, so no task sorts all rows.

    The ranges are written first: sampled again, their bounds could differ.
    """
    spread = active.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    inner = materialize(spread.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1), "ranges")
    sizes = inner.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).select("_part", "_before")
    return inner.join(F.broadcast(before), "_part").withColumn("row", (F.col("_before") + F.col("_n")).cast("long")).drop("_part", "_n", "_before")


# The part of a crop that shows the body (left, right, top, bottom) and the bands of it, as shares; bins of hue, saturation and value.
BODY = (0.18, 0.82, 0.08, 0.96)
BANDS = ((0.12, 0.42), (0.42, 0.78), (0.78, 1.0))
BINS = (16, 4, 8)


def colour_histogram(pixels) -> np.ndarray:
    """Fingerprint of decoded HSV pixels (rows, columns, 3; hue below 180): per band of the body a hue-saturation and a value histogram, each of sum 1, at unit length together."""
    image = np.asarray(pixels)
    height, width = image.shape[:2]
    left, top = int(width * BODY[0]), int(height * BODY[2])
    body = image[top : max(top + 1, int(height * BODY[3])), left : max(left + 1, int(width * BODY[1]))]
    body, parts = body if body.size else image, []
    for start, end in BANDS:
        first = int(len(body) * start)
        band = body[first : max(first + 1, int(len(body) * end))].reshape(-1, 3)
        hs = np.histogram2d(band[:, 0], band[:, 1], bins=BINS[:2], range=((0, 180), (0, 256)))[0].ravel()
        vv = np.histogram(band[:, 2], bins=BINS[2], range=(0, 256))[0]
        parts += [x / max(1.0, x.sum()) for x in (hs, vv)]
    out = np.concatenate(parts)
    length = np.linalg.norm(out)
    return out / length if length > V.TINY else out


def track_fingerprints(crops: DataFrame) -> DataFrame:
    """(track_id, embedding, crops_used): the mean fingerprint of a track's decoded crops at unit length, none for tracks without; crops (track_id, height, width, hsv binary)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [colour_histogram(np.frombuffer(b, np.uint8).reshape(h, w, 3)).tolist() for h, w, b in zip(batch["height"], batch["width"], batch["hsv"], strict=True)]
            yield pd.DataFrame({"track_id": batch["track_id"].values, "embedding": found})

    kind = crops.schema["track_id"].dataType.simpleString()
    known = crops.filter("hsv IS NOT NULL AND height > 0 AND width > 0").select("track_id", "height", "width", "hsv")
    return mean_vectors(known.mapInPandas(run, f"track_id {kind}, embedding array<double>"))


def blur(gray: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian of a gray image, with mirrored borders."""
    g = np.pad(np.asarray(gray, float), 1, mode="reflect") if min(np.shape(gray)) > 1 else np.pad(np.asarray(gray, float), 1, mode="edge")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var()) if np.size(gray) else 0.0


def colour(a: Column, b: Column) -> Column:
    return V.dot(a, b)
