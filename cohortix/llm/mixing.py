"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents by a keyed hash, and the blocks are
permuted by it.  A source whose target is q times its size contributes floor(q) whole
passes over its blocks and, without replacement, the first blocks of a further
pass up to the target; the boundary block is cut at a document.  The exact
numbers of block draws per source form the root of a binary tree over the output
shards: each node splits its quota vector between its children by a multivariate
hypergeometric draw seeded by the node, so a shard recomputes its own path from
the root, and the left siblings on it give the start of the shard's disjoint
interval of each source's permuted blocks.  No node needs another's result.  Sources are
dealt to groups: the tree splits the groups' sums, and each group's vector follows with the sizes that this gives it, which is the same draw
in two steps, so that no row holds all sources.  What a document contributes is what the shards draw of its block.

Edge cases: null text has size 0; the null source is a source of its own, last
in order; documents of size 0 take 0 words; an empty table gives an empty
result; repeated rows are separate documents; of documents with the same hash the one with the lesser id and size goes first; very long texts
are documents like others, so a source's words may differ from its target by half of the one that crosses it; other columns, whatever their names, are
ignored (and kept by ``mix_documents``).  Ids and texts spread rows over hash values: only copies of a row, id and text, share a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = "mix-2"
#: Hex digits of the block number: 16 ** 3 blocks a source.
BLOCK_DIGITS = 3
#: Block draws of an output shard, on average.
SHARD_DRAWS = 64
#: Sources of a group in the tree, on average.
GROUP = 1000
#: Tables of sources or blocks up to so many rows (some ten megabytes) are broadcast; longer ones are joined by shuffle.
MOST_BROADCAST = 100_000
#: Words of a task that writes documents of the mixture.
TASK_WORDS = 8 << 20


def word_count(text: Column) -> Column:
    r"""Number of runs of characters other than \x20 and \x09-\x0D; null: 0. Plain replacements leave single blanks to count; only texts with runs of blanks need a regular expression."""
    flat = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(blank), F.lit(" "))
    single = F.trim(F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " {2,}", " ")).otherwise(flat))
    return F.when(F.octet_length(single) == 0, F.lit(0)).otherwise(F.octet_length(single) - F.octet_length(F.replace(single, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, *keep: str) -> DataFrame:
    """(source, source_size) -> the same with ``target``: weighted shares of all sizes, none above most times its size.

    The water level in closed form: sources in order of most * size / weight are full as long as the level of the rest
    stands above them.  The table has one row per source.
    """
    named = F.struct(F.col("source").isNull(), F.col("source"))
    order = Window.orderBy(named.asc())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(pattern, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("full", F.lit(most) * F.col("source_size").cast("double")).withColumn("ratio", F.col("full") / F.col("weight"))
    rising = Window.orderBy("ratio", named)
    below, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(below), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn("is_full", F.col("ratio") <= F.col("level"))
    # the level that holds for the sources that are not full: that of the first of them
    open_level = F.min(F.when(~F.col("is_full"), F.struct("ratio", "level"))).over(everything)["level"]
    return ranked.withColumn("target", F.when(F.col("is_full"), F.col("full")).otherwise(F.col("weight") * open_level)).select("source", "source_size", "target", *keep)


def join_small(rows: DataFrame, table: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Joins a table of n rows by null-safe keys; it is broadcast only up to MOST_BROADCAST rows, and sort-merged beyond."""
    names = {k: f"_{k}" for k in keys}
    side = table.withColumnsRenamed(names)
    side = F.broadcast(side) if n <= MOST_BROADCAST else side.hint("merge")
    on = [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()]
    return rows.join(side, on, "left").drop(*names.values())


def split_quota(quota: np.ndarray, shard: int, n_shards: int, seed: int, groups: np.ndarray | None = None, group: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(start, quota) of a shard's interval in every source's draws, by its path through the tree.

    groups: the sums of all groups of sources, of which quota is group ``group``; without them quota is all there is.
    """
    groups = np.array([quota.sum()]) if groups is None else groups
    low, high, start = 0, n_shards, np.zeros_like(quota)
    while high - low > 1:
        middle = (low + high) // 2
        take = int(groups.sum()) * (middle - low) // (high - low)
        left_groups = draw(np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, low, high]))), groups, take)
        left = draw(np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, low, high, group + 1]))), quota, int(left_groups[group]))
        if shard < middle:
            quota, groups, high = left, left_groups, middle
        else:
            start, quota, groups, low = start + left, quota - left, groups - left_groups, middle
    return start, quota


def draw(rng: np.random.Generator, quota: np.ndarray, take: int) -> np.ndarray:
    """A multivariate hypergeometric draw, one margin after the other."""
    left, rest = np.zeros_like(quota), int(quota.sum())
    for i, q in enumerate(quota.tolist()):
        rest -= q
        left[i] = hypergeometric(rng, q, rest, take)
        take -= int(left[i])
    return left


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """An exact hypergeometric draw of any size.

    numpy's generator ends at 1e9. Beyond it every member is taken with the probability draws / all, which gives a random subset, and
    then what is missing or too much, about the root of the number, is drawn from the others or from the subset in the same way.
    """
    least, most = max(0, draws - bad), min(good, draws)
    if least == most:
        return least
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    if 2 * draws > good + bad:
        return good - hypergeometric(rng, good, bad, good + bad - draws)
    if draws <= 16:
        got = 0
        for i in range(draws):
            got += int(rng.integers(good + bad - i)) < good - got
        return got
    share = draws / (good + bad)
    x, y = int(rng.binomial(good, share)), int(rng.binomial(bad, share))
    short = draws - x - y
    return x + hypergeometric(rng, good - x, bad - y, short) if short >= 0 else x - hypergeometric(rng, x, y, -short)


def order_of() -> Column:
    """The keyed hash of a row's id and text that permutes the documents of a source."""
    return F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text"), F.lit("")))))


def sized(docs: DataFrame, *keep: Column) -> DataFrame:
    """(doc_id, source, size, order, block, *keep)."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order_of().alias("order"), *keep).withColumn("block", F.substring("order", 1, BLOCK_DIGITS))


def book_of(rows: DataFrame, weights: tuple[float, ...], most: int) -> tuple[DataFrame, int]:
    """(source, block, source_size, target, before, remainder, passes, at_edge, draws) of every block, and their number; draws has (copy, shard) for each time that a shard draws the block."""
    blocks = materialize(rows.groupBy("source", "block").agg(F.sum("size").alias("block_size")), "mix-blocks")
    per_source = blocks.groupBy("source").agg(F.sum("block_size").alias("source_size"), F.count("*").alias("n_blocks"))
    n_sources = per_source.count()
    goal = targets(per_source, weights, most, "n_blocks")
    goal = goal.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = materialize(goal.withColumn("remainder", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size"))), "mix-sources")
    placed = join_small(permuted(blocks), goal, n_sources, ["source"])
    # blocks that the last pass opens: all that begin before the target, so the boundary block too
    last = F.col("before") < F.col("remainder")
    placed = placed.withColumn("times", F.col("passes") + last.cast("long")).withColumn("at_edge", last & (F.col("before") + F.col("block_size") > F.col("remainder")))
    placed = materialize(placed, "mix-placed")
    shards = shard_draws(placed.groupBy("source").agg(F.sum("times").alias("quota")), n_sources)
    copies = placed.select("source", "block", F.explode(F.expr("filter(sequence(0L, times), x -> x < times)")).alias("copy"), "n_blocks", "position")
    copies = copies.withColumn("draw", F.col("copy") * F.col("n_blocks") + F.col("position"))
    shards = shards.select(F.col("source").alias("_s"), F.col("draw").alias("_d"), "shard").hint("merge")
    found = copies.join(shards, copies["source"].eqNullSafe(shards["_s"]) & (copies["draw"] == shards["_d"]))
    drawn = found.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("draws"))
    drawn = drawn.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "draws").hint("merge")
    book = placed.join(drawn, placed["source"].eqNullSafe(drawn["_s"]) & (placed["block"] == drawn["_b"]), "left")
    none = F.array().cast("array<struct<copy:bigint,shard:int>>")
    book = materialize(book.select("source", "block", "source_size", "target", "before", "remainder", "passes", "at_edge", F.coalesce("draws", none).alias("draws")), "mix-book")
    discard(blocks, goal, placed)
    return book, book.count()


def taken(rows: DataFrame, book: DataFrame, n: int) -> DataFrame:
    """Adds source_size, target and draws, the shards' draws that take the row: all of its block's, but of the last one at the edge only those of documents that lie below the target by half or more."""
    joined = join_small(rows, book, n, ["source", "block"])
    inner = Window.partitionBy("source", "block").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = joined.filter("at_edge").withColumn("within", F.sum("size").over(inner) - F.col("size"))
    below = F.col("before") + F.col("within") + F.col("size") / 2 <= F.col("remainder")
    edge = edge.withColumn("draws", F.when(~below, F.filter("draws", lambda d: d["copy"] < F.col("passes"))).otherwise(F.col("draws"))).drop("within")
    both = joined.filter("NOT at_edge").unionByName(edge)
    return both.withColumn("draws", F.when(F.col("size") > 0, F.col("draws")).otherwise(F.slice("draws", 1, 0))).drop("before", "remainder", "passes", "at_edge")


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, shards): how often the mix takes each document, and into which output shards."""
    rows = materialize(sized(docs), "mix-sized")
    book, n = book_of(rows, weights, most)
    out = taken(rows, book, n).withColumn("copies", F.size("draws").cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), F.col("draws.shard").alias("shards"))


def permuted(blocks: DataFrame) -> DataFrame:
    """Adds ``before`` (words of the source's earlier blocks) and ``position``, in the order of the keyed hash; a source has 16 ** BLOCK_DIGITS blocks at most."""
    order = Window.partitionBy("source").orderBy("block")
    return blocks.withColumn("before", F.sum("block_size").over(order) - F.col("block_size")).withColumn("position", F.row_number().over(order) - 1)


def shard_draws(quotas: DataFrame, n_sources: int) -> DataFrame:
    """(source, draw, shard): the leaves of the splitting tree, one draw per row.

    A row of a shard holds the vector of one group of sources; the sums of all groups are in the closure.
    """
    n_groups = max(1, -(-n_sources // GROUP))
    grouped = quotas.withColumn("group", F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(n_groups)).cast("int"))
    entry = F.struct(F.col("source").isNull().alias("n"), F.col("source").alias("source"), "quota")
    vectors = materialize(grouped.groupBy("group").agg(F.array_sort(F.collect_list(entry)).alias("vector"), F.sum("quota").alias("sum")), "mix-vectors")
    sums = [(r["group"], r["sum"]) for r in vectors.select("group", "sum").orderBy("group").collect()]  # one row per group of sources
    groups, totals = [g for g, _ in sums], np.array([n for _, n in sums], np.int64)
    n_shards = max(1, -(-int(totals.sum()) // SHARD_DRAWS))
    leaves = vectors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    kind = "source string, start long, quota long, shard int"

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, vector, shard in zip(batch["group"], batch["vector"], batch["shard"], strict=True):
                start, quota = split_quota(np.array([x["quota"] for x in vector], np.int64), int(shard), n_shards, len(SEED), totals, groups.index(group))
                yield pd.DataFrame({"source": [x["source"] for x in vector], "start": start, "quota": quota, "shard": np.full(len(vector), shard, np.int32)})

    intervals = leaves.repartition("shard").mapInPandas(walk, kind).filter("quota > 0")
    return intervals.select("source", F.explode(F.expr("sequence(start, start + quota - 1)")).alias("draw"), "shard")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixture itself: (doc_id, copy, shard, position) with one row per document drawn, shuffled within its shard."""
    rows = plan(docs, weights, most).select("doc_id", F.posexplode("shards").alias("copy", "shard"))
    return rows.select("doc_id", "copy", "shard", F.xxhash64("doc_id", "copy", "shard").alias("position"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mixture, with the columns of the input; a document taken n times gives n rows, in a random order within each task of a shard.

    Texts are shuffled once, to the shards, as long as the table of blocks may be broadcast.
    """
    light = materialize(sized(docs).drop("doc_id", "order"), "mix-sized")
    book, n = book_of(light, weights, most)
    words = book.select("source", "target").distinct().agg(F.sum("target").alias("w"), F.count("*").alias("n")).first()
    n_shards = book.select(F.explode("draws.shard").alias("s")).agg(F.coalesce(F.max("s"), F.lit(0)).alias("s")).first()["s"] + 1
    parts = max(1, round((words["w"] or 0) / n_shards / TASK_WORDS))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = taken(sized(docs, row), book, n).select("row", "order", F.posexplode("draws.shard").alias("copy", "shard"))
    rows = rows.withColumn("position", F.xxhash64("order", "copy", "shard"))
    discard(light)
    return rows.repartition("shard", F.pmod("position", F.lit(parts))).sortWithinPartitions("shard", "position").select("row.*")
