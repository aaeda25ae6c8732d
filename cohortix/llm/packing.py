"""Best-fit packing by a grouping genetic algorithm on distributed islands.

Texts are tokenized where they are read; a task gathers its pieces into blocks of
bounded size, one row each, so nothing is shuffled by a key and no document can
be hot.  Each block is evolved on ISLANDS islands (rows of their own, different
seeds).  A genome is a grouping of the block's pieces into bins.  Crossover
injects whole well-filled bins of one parent into the other, drops the bins that
hold duplicates, and best-fits the displaced pieces.  Mutations break up the worst bin with some others that are not full and give
each bin the subset of their pieces that fills it best; they are kept unless the bins get worse.  After each epoch every
island's elite migrates to the next island of its ring.  Bins that stay badly
filled are broken up and their pieces packed again together with those of
other blocks.

Edge cases: null text counts as empty, an empty text is one piece of length 1
(the end id); texts over the capacity, however long, are cut into full pieces after a shorter
first one; pieces of equal length go in the order of reading; repeated rows are packed as separate documents, even with one id; an
empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXT_ROWS, id_as_text, id_restored, materialize

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k"
#: Pieces below the capacity that a block holds at most.
BLOCK = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 3
#: Mutations of the best grouping in a generation (of the child: a quarter), and the bins that each one breaks up beside the worst.
MUTATIONS = 30
POOL = 10
#: Rows (a block on an island) of a task.
TASK_ROWS = 4
MOST_TASKS = 100_000
#: Bins with more free tokens than this are broken up after the first round.
SLACK = 8

CARRIED = "doc_id string, piece int, start long, length int, ids_crc32 long"
BLOCKS = "block long, doc_id array<string>, piece array<int>, start array<long>, length array<int>, ids_crc32 array<long>"


def encoder(name: str = TOKENIZER):
    """text -> ids of the public byte-level BPE file, as the tokenizers library gives them (the rank file holds the same vocabulary and is about four times as fast)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids: full ones after a first that may be shorter."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return [first] * bool(first) + [capacity] * (n // capacity)


def best_fit(lengths: np.ndarray, items: list[int], bins: list[list[int]], fill: list[int], capacity: int) -> None:
    """Puts the items, in their order, each into the fullest bin that has room for it, or a new one. Changes bins and fill."""
    room = sorted((capacity - f, b) for b, f in enumerate(fill) if f < capacity)
    for i in items:
        n = int(lengths[i])
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(i)
            fill[b] += n
            free -= n
        else:
            b, free = len(bins), capacity - n
            bins.append([i])
            fill.append(n)
        if free:
            insort(room, (free, b))


def decode(genome: np.ndarray, lengths: np.ndarray) -> tuple[list[list[int]], list[int]]:
    order = np.argsort(genome, kind="stable")
    edges = np.flatnonzero(np.diff(genome[order])) + 1
    groups = np.split(order, edges) if len(order) else []
    return [g.tolist() for g in groups], [int(lengths[g].sum()) for g in groups]


def encode(bins: list[list[int]], n: int) -> np.ndarray:
    genome = np.empty(n, np.int32)
    for b, group in enumerate(bins):
        genome[group] = b
    return genome


def fitness(fill: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the unevenness that favours full ones."""
    return -len(fill), float(np.square(np.asarray(fill, float) / capacity).sum())


def crossover(a: tuple, b: tuple, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> tuple:
    """Injects a share of b's best-filled bins into a; a's bins that hold a duplicate go, and their other pieces are best-fitted."""
    full = [i for i, f in enumerate(b[1]) if capacity - f <= capacity // 64]
    if not full:
        return a
    chosen = rng.permutation(full)[: max(1, len(full) // 2)]
    taken = np.zeros(len(lengths), bool)
    bins: list[list[int]] = []
    for i in chosen:
        taken[b[0][i]] = True
        bins.append(list(b[0][i]))
    fill, displaced = [b[1][i] for i in chosen], []
    for group, f in zip(a[0], a[1], strict=True):
        hit = taken[group]
        if not hit.any():
            bins.append(list(group))
            fill.append(f)
        else:
            displaced += [i for i, h in zip(group, hit, strict=True) if not h]
    displaced.sort(key=lambda i: (-lengths[i], i))
    best_fit(lengths, displaced, bins, fill, capacity)
    return bins, fill


def fullest(lengths: list[int], items: list[int], capacity: int) -> list[int]:
    """The first of the items and the subset of the others that fills the capacity best: sums that can be reached are the bits of a number."""
    room = capacity - lengths[items[0]]
    mask, full = (1 << (room + 1)) - 1, 1 << room
    sums, reach = [1], 1
    for i in items[1:]:
        if reach & full:
            break
        reach |= (reach << lengths[i]) & mask
        sums.append(reach)
    left, out = reach.bit_length() - 1, [items[0]]
    for k in range(len(sums) - 1, 0, -1):
        if not sums[k - 1] >> left & 1:  # only with the k-th item
            out.append(items[k])
            left -= lengths[items[k]]
    return out


def mutate(a: tuple, lengths: list[int], capacity: int, rng: np.random.Generator, times: int) -> tuple:
    """Breaks up the worst bin and some that are not full, and gives each new bin what fills it best; a change is kept unless it makes bins more or more even."""
    bins, fill = list(a[0]), list(a[1])
    floor = -(-sum(fill) // capacity)
    for step in range(times):
        if len(bins) <= floor:
            break
        worst = fill.index(min(fill))
        if step % 8 == 0:
            others = [i for i, f in enumerate(fill) if f < capacity]
        picks = rng.random(POOL + 2).tolist()
        gone = {worst, *(others[int(x * len(others))] for x in picks[2:]), *(int(x * len(bins)) for x in picks[:2])}
        gone = [g for g in gone if g < len(bins)]
        left, new, filled = sorted((i for g in gone for i in bins[g]), key=lambda i: (-lengths[i], i)), [], []
        while left:
            new.append(fullest(lengths, left, capacity))
            filled.append(sum(lengths[i] for i in new[-1]))
            used = set(new[-1])
            left = [i for i in left if i not in used]
        if len(new) > len(gone) or (len(new) == len(gone) and sum(f * f for f in filled) < sum(fill[g] ** 2 for g in gone)):
            continue
        for g, group, f in zip(gone, new, filled, strict=False):
            bins[g], fill[g] = group, f
        for g in sorted(gone[len(new) :], reverse=True):
            del bins[g], fill[g]
            others = [i for i, f in enumerate(fill) if f < capacity]
    return bins, fill


def evolve(lengths: np.ndarray, migrants: list[np.ndarray], seed: int, capacity: int, generations: int) -> np.ndarray:
    """The best grouping an island finds from its own starts and the elites it is given; full pieces keep bins of their own."""
    loose = np.flatnonzero(lengths < capacity)
    if len(loose) < len(lengths):
        inner = evolve(lengths[loose], [np.unique(np.asarray(m)[loose], return_inverse=True)[1] for m in migrants], seed, capacity, generations) if len(loose) else loose
        genome = np.empty(len(lengths), np.int32)
        genome[loose] = inner
        full = np.flatnonzero(lengths >= capacity)
        genome[full] = (int(inner.max()) + 1 if len(loose) else 0) + np.arange(len(full))
        return genome
    n = len(lengths)
    rng = np.random.default_rng(abs(seed))
    population = [decode(np.asarray(m), lengths) for m in migrants]
    while len(population) < POPULATION:
        noise = 0 if seed % ISLANDS == 0 and len(population) == len(migrants) else 0.05
        keys = lengths * (1 + noise * rng.standard_normal(n))
        bins, fill = [], []
        best_fit(lengths, sorted(range(n), key=lambda i: (-keys[i], i)), bins, fill, capacity)
        population.append((bins, fill))
    score = lambda g: fitness(g[1], capacity)
    floor, sizes = -(-int(lengths.sum()) // capacity), lengths.tolist()
    population.sort(key=score, reverse=True)
    for _ in range(generations):
        if len(population[0][1]) <= floor:
            break
        other = population[int(rng.integers(1, len(population)))]
        child = mutate(crossover(population[0], other, lengths, capacity, rng), sizes, capacity, rng, MUTATIONS // 4)
        population[0] = mutate(population[0], sizes, capacity, rng, MUTATIONS)
        if score(child) > score(population[-1]):
            population[-1] = child
            population.sort(key=score, reverse=True)
    return encode(population[0][0], n)


#: A block is named by its partition and its number there, and a sequence by its block and its bin there: 24, 24 and 15 bits.
BLOCK_BITS = 24
BIN_BITS = 15


def block_id(partition: int, number: int) -> int:
    if number >> BLOCK_BITS or partition >> 24:
        raise ValueError("too many blocks for a long; use smaller partitions of the input")
    return partition << BLOCK_BITS | number


def sequence_ids(block: int, genome: np.ndarray) -> np.ndarray:
    """Ids of a block's bins; those of different blocks differ (blocks of the second round are negative)."""
    return np.int64(block) * (1 << BIN_BITS) + genome


def tokenize_blocks(capacity: int, end_id: int, tokenizer: str, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_text = encoder(tokenizer)
        from pyspark import TaskContext

        part, done, small, rows = TaskContext.get().partitionId(), 0, 0, []

        def flush() -> pd.DataFrame:
            columns = [list(c) for c in zip(*rows, strict=True)]
            return pd.DataFrame({"block": [block_id(part, done)], **{k: [v] for k, v in zip(("doc_id", "piece", "start", "length", "ids_crc32"), columns, strict=True)}})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array(encode_text(text or "") + [end_id], "<u4")
                start = 0
                for piece, length in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                    start += length
                    small += length < capacity
                    if small >= block or len(rows) >= min(8 * block, 1 << BIN_BITS):
                        yield flush()
                        done, small, rows = done + 1, 0, []
        if rows:
            yield flush()

    return run


def islands_evolve(blocks: DataFrame, capacity: int, islands: int, epochs: int, generations: int) -> DataFrame:
    """(block, lengths) -> (block, genome): epochs of evolution on all islands, a ring migration after each, and the best genome of each block."""

    def epoch(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for block, island, lengths, own, guest in zip(batch["block"], batch["island"], batch["lengths"], batch["genome"], batch["guest"], strict=True):
                    given = [np.asarray(g, np.int32) for g in (own, guest) if g is not None]
                    seed = (int(block) * 1000 + number * 100) * ISLANDS + int(island)
                    out.append(evolve(np.asarray(lengths, np.int64), given, seed, capacity, generations))
                yield pd.DataFrame({"block": batch["block"], "island": batch["island"], "lengths": batch["lengths"], "genome": out})

        return run

    state = blocks.select("block", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    tasks = min(MOST_TASKS, max(1, -(-blocks.count() * islands // TASK_ROWS)))  # rows are small but take long, so their bytes must not decide
    state = state.withColumn("genome", F.lit(None).cast("array<int>")).withColumn("guest", F.lit(None).cast("array<int>")).repartition(tasks, "block", "island")
    ring = Window.partitionBy("block").orderBy("island")
    for number in range(epochs):
        state = state.mapInPandas(epoch(number), "block long, island int, lengths array<int>, genome array<int>")
        if number + 1 < epochs:
            around = F.coalesce(F.lag("genome").over(ring), F.last("genome").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            state = state.withColumn("guest", around).repartition(tasks, "block", "island")
    bins = F.array_max("genome") + 1
    ranked = state.withColumn("bins", bins)
    return ranked.groupBy("block").agg(F.min_by("genome", F.struct("bins", "island")).alias("genome"))


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece's place in sequences of at most capacity tokens."""
    kind = id_as_text(docs.select("doc_id", "text")).mapInPandas(tokenize_blocks(capacity, end_id, tokenizer, block), BLOCKS)
    blocks = materialize(kind, "pack-blocks", arrow_rows=TEXT_ROWS)
    first = place(blocks, capacity)
    first = materialize(first, "pack-first")
    room = F.lit(capacity) - F.col("filled")
    kept = first.filter(room <= SLACK)
    loose = first.filter(room > SLACK).drop("filled", "sequence_id", "offset")
    # the badly filled bins' pieces of all blocks, in new blocks of the same expected size
    n = max(1, -(-loose.count() // block))
    again = loose.withColumn("block", -1 - F.pmod(F.xxhash64("doc_id", "piece", "block", "at"), F.lit(n)))
    fields = [f.split()[0] for f in CARRIED.split(", ")]
    gathered = again.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rows"))
    gathered = gathered.select("block", *[F.col(f"rows.{c}").alias(c) for c in fields])
    second = place(materialize(gathered, "pack-again"), capacity)
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset")]
    return id_restored(kept.select(*columns).unionByName(second.select(*columns)), docs)


def place(blocks: DataFrame, capacity: int) -> DataFrame:
    """Rows of pieces with their sequence, offset, and the fill of the sequence, for blocks of pieces."""
    best = islands_evolve(blocks.select("block", F.col("length").alias("lengths")), capacity, ISLANDS, EPOCHS, GENERATIONS)
    fields = [f.split()[0] for f in CARRIED.split(", ")]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                genome, length = np.asarray(row.genome, np.int64), np.asarray(row.length, np.int64)
                order = np.lexsort((np.arange(len(genome)), genome))
                ends = np.cumsum(length[order])
                firsts = np.r_[0, np.flatnonzero(np.diff(genome[order])) + 1]
                base = np.repeat((ends - length[order])[firsts], np.diff(np.r_[firsts, len(order)]))
                out = pd.DataFrame({c: np.asarray(getattr(row, c))[order] for c in fields})
                out["at"] = order
                out["block"] = row.block
                out["sequence_id"] = sequence_ids(row.block, genome[order])
                out["offset"] = ends - length[order] - base
                out["filled"] = np.bincount(genome, length).astype(np.int64)[genome[order]]
                yield out

    joined = blocks.join(best, "block")
    return joined.mapInPandas(spread, f"{CARRIED}, at int, block long, sequence_id long, offset int, filled int")
