"""Jaccard self-join of documents on their word n-grams by chosen paths.

A document is the set of its N-word shingles.  Documents with equal sets are
one class from the start (they link to each other with similarity 1).  Every
class has COORDINATES minimum-hash values; a run of the join starts from a node
that holds all classes, and a node chooses 1 / THRESHOLD coordinates on average
and sends each class to one child per chosen coordinate, named by the class's
token there.  Nodes of one class die; nodes of up to LIMIT classes are compared
by brute force on sketches; larger ones link their classes to a leader where the
sketches agree.  If few classes are then outside a node's largest component, they are
compared with all of the node; otherwise the node chooses again.  RUNS
runs are repeated: a pair at the threshold is together in one of a run's nodes at
depth FIRST_DEPTH with a probability of 0.72 or more.  Larger nodes below choose twice as many coordinates, which keeps it
above 0.66 at the last depth, so RUNS miss it with less than 3e-5, and the nodes that
are still large at the last depth are compared in blocks, without a cap.

The brute force of a node emits a spanning star of its candidate pairs, not the
pairs.  Connected components of candidates are then verified on the exact
shingle sets: all pairs of a component, in blocks of bounded bytes, so a pair that no node held
is found too if its documents hang together in any way.  What comes out per
document is its class (the component of verified links) and its number of links.
Where only classes are asked for (``one_of_each``), a component's blocks are first compared within themselves and with
one leader, and only what is still apart is compared with the rest.

Edge cases: a text of 1 to N-1 words has one shingle, all its words; a null,
empty or blank text has none, no link, and a class of its own; a document's
copies (equal sets) are links; repeated rows count as copies; rows without an id have classes and links like others, and a class of
nothing else has a null name; of tied names the least id is taken; very long texts are compared whole, and blocks hold fewer of
them; an empty table gives no rows; other columns, whatever their names, are ignored (and kept by ``one_of_each``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, discard, id_as_text, id_restored, materialize, may_contain
from .graph import components

N = 5
THRESHOLD = 0.8
COORDINATES = 128
RUNS = 10
FIRST_DEPTH = 2
LIMIT = 512
DEPTH = 4
#: Sketches that agree in less than this are no candidates: more than five deviations (0.035) below the threshold.
CANDIDATE = 0.6
#: Classes of a component, and shingles of these, that are verified against as many others in one task (a single class may have more shingles).
BLOCK = 1024
BLOCK_SHINGLES = 500_000
#: Components of more classes than this are dealt to several blocks, so that several tasks share them.
PART = 256
PARTS = 8
#: Rows of a matrix of links that are worked on at once.
ROWS = 256
SEED = 20

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word windows of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    count = len(words) - size + 1
    h = np.full(count, size, np.uint64)
    for i in range(size):
        h = h * MIX + each[i : i + count]
        h ^= h >> np.uint64(31)
    return np.unique(mixed(h))


def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minimum_hashes(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least 32-bit value of each coordinate's hash over a set."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(s), 512):
        part = ((s[low : low + 512, None] * a[None, :] + b[None, :]) >> np.uint64(32)).min(axis=0).astype(np.uint32)
        np.minimum(least, part, out=least)
    return least


def sketch_bytes(least: np.ndarray) -> bytes:
    """A sketch's low bytes, then its second bytes and so on, so that its low bytes are the first COORDINATES of it."""
    return least.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def sketch_values(sketches: pd.Series) -> np.ndarray:
    """Matrix of the 32-bit values of a column of sketches."""
    parts = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, 4, COORDINATES)
    return np.ascontiguousarray(parts.transpose(0, 2, 1)).view("<u4")[:, :, 0]


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def named_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rep): rep names a row by its id and text, also where the id is null or repeated."""
    return docs.select("doc_id", "text", row_name())


def row_name() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).alias("rep")


def profile(docs: DataFrame) -> DataFrame:
    """(doc_id, rep, key, size, sketch) of named rows: key names the shingle set (null if empty), size counts it, sketch holds its minimum hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = multipliers(COORDINATES)
        for batch in batches:
            for low in range(0, len(batch), 1000):
                part = batch.iloc[low : low + 1000]
                keys, sizes, sketches = [], [], []
                for t in part["text"]:
                    s = shingles(t)
                    keys.append(set_key(s) if len(s) else None)
                    sizes.append(len(s))
                    sketches.append(sketch_bytes(minimum_hashes(s, a, b)) if len(s) else None)
                yield pd.DataFrame({"doc_id": part["doc_id"].values, "rep": part["rep"].values, "key": keys, "size": sizes, "sketch": sketches})

    return id_restored(id_as_text(docs).mapInPandas(run, "doc_id string, rep long, key binary, size long, sketch binary"), docs)


def chosen(node: int, threshold: float, step: int = 0) -> np.ndarray:
    """The coordinates that a node splits on: 1 / threshold on average, one at least."""
    rng = np.random.default_rng([SEED, step, node & 0xFFFFFFFF, node >> 32 & 0xFFFFFFFF])
    count = int(1 / threshold) + int(rng.random() < 1 / threshold - int(1 / threshold))
    return rng.choice(COORDINATES, count, replace=False)


def child_names(parent: np.ndarray, coordinate: int, values: np.ndarray) -> np.ndarray:
    """The children that classes with these values at a coordinate go to, from their parents."""
    return mixed(mixed(values.astype(np.uint64) + np.uint64(coordinate << 33)) + parent * MIX)


def first_nodes(threshold: float, runs: int):
    """Maps (key, sketch) to (node, key) at depth FIRST_DEPTH of each run: the nodes above hold too much in any case, so they are not counted.

    Up to that depth a node's choice depends on the coordinates of its path alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths = [(r, ()) for r in range(runs)]
        for step in range(FIRST_DEPTH):
            paths = [(r, (*path, int(c))) for r, path in paths for c in chosen(hash((r, path)) & 0x7FFFFFFF, threshold, step + 1)]
        for batch in batches:
            if not len(batch):
                continue
            sketch = sketch_values(batch["sketch"])
            out = []
            for r, path in paths:
                name = np.full(len(batch), r + 1, np.uint64)
                for c in path:
                    name = child_names(name, c, sketch[:, c])
                out.append(name.view(np.int64))
            yield pd.DataFrame({"node": np.concatenate(out), "key": np.tile(batch["key"].to_numpy(), len(paths))})

    return run


def children(threshold: float):
    """Maps (node, key, sketch) to (node, key) of the node's children, by twice as many coordinates as the first levels choose."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sketch = sketch_values(batch["sketch"])
            keys = batch["key"].to_numpy()
            for parent, rows in batch.groupby("node").indices.items():
                for c in chosen(int(parent), threshold / 2):
                    name = child_names(np.array([parent], np.int64).view(np.uint64), int(c), sketch[rows, c])
                    yield pd.DataFrame({"node": name.view(np.int64), "key": keys[rows]})

    return run


def whole_groups(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by column -> frames that hold whole groups."""
    kept: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[column].to_numpy()
        cut = int(np.flatnonzero(values != values[-1])[-1]) + 1 if (values != values[-1]).any() else 0
        if kept and values[0] != kept[-1][column].iloc[-1]:
            yield pd.concat(kept, ignore_index=True)
            kept = []
        if cut:
            yield pd.concat([*kept, batch.iloc[:cut]], ignore_index=True)
            kept = [batch.iloc[cut:]]
        else:
            kept.append(batch)
    if kept:
        yield pd.concat(kept, ignore_index=True)


def least_labels(link: np.ndarray) -> np.ndarray:
    """Component labels (least member) of each of a stack of symmetric adjacency matrices with a true diagonal."""
    g, n, _ = link.shape
    label = np.broadcast_to(np.arange(n, dtype=np.int32), (g, n))
    while True:
        new = np.where(link, label[:, None, :], n).min(axis=2).astype(np.int32)
        new = np.take_along_axis(new, new, axis=1)
        if (new == label).all():
            return new
        label = new


def compare_nodes(candidate: float):
    """Maps sorted rows (node, key, small) to star edges (a, b) of the candidate pairs within each node."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "node"):
            node, keys = frame["node"].to_numpy(), frame["key"].to_numpy()
            small = np.frombuffer(b"".join(frame["small"]), np.uint8).reshape(-1, COORDINATES)
            firsts = np.r_[0, np.flatnonzero(np.diff(node)) + 1]
            counts = np.diff(np.r_[firsts, len(node)])
            for n in np.unique(counts):
                if n < 2:
                    continue
                at = firsts[counts == n]
                step = max(1, (1 << 25) // int(n * n * COORDINATES))
                for low in range(0, len(at), step):
                    rows = at[low : low + step, None] + np.arange(n)[None, :]
                    x = small[rows]
                    link = np.empty((len(rows), n, n), bool)
                    for i in range(0, n, 64):
                        same = np.add.reduce(x[:, i : i + 64, None, :] == x[:, None, :, :], axis=3, dtype=np.uint8)  # COORDINATES fit a byte
                        link[:, i : i + 64] = same >= candidate * COORDINATES
                    label = least_labels(link)
                    moved = label != np.arange(n)[None, :]
                    if moved.any():
                        yield pd.DataFrame({"a": keys[rows[moved]], "b": keys[np.take_along_axis(rows, label, axis=1)[moved]]})

    return run


def candidate_edges(classes: DataFrame, threshold: float = THRESHOLD, runs: int = RUNS) -> DataFrame:
    """Star edges (a, b) over class keys that connect every candidate pair."""
    sketches = classes.select("key", "sketch")
    smalls = classes.select(F.col("key").alias("k"), "small")
    nodes = materialize(sketches.mapInPandas(first_nodes(threshold, runs), "node long, key binary"), "nodes")
    edges, old = None, []
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        sizes = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("node", "m")
        sized = nodes.join(sizes, F.col("node") == F.col("m")).select("node", "key", "n")
        sized = materialize(sized.join(smalls, F.col("key") == F.col("k")).drop("k"), "sized")
        discard(nodes)
        leaf = sized.filter(F.col("n") <= LIMIT).select("node", "key", "small").repartition("node").sortWithinPartitions("node", "key")
        found = leaf.mapInPandas(compare_nodes(CANDIDATE), "a binary, b binary")
        large = sized.filter(F.col("n") > LIMIT)
        some = not large.isEmpty()
        if some:
            found = found.unionByName(led(large))
        edges = materialize(found if edges is None else edges.unionByName(found), "candidates")
        discard(*old)
        if not some:
            discard(sized)
            return edges
        roots = materialize(components(edges), "roots")
        discard(edges)
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a != b")
        large = large.join(roots.withColumnRenamed("node", "k"), F.col("key") == F.col("k"), "left").withColumn("root", F.coalesce("root", "key"))
        large = materialize(apart(large.select("node", "key", "small", "n", "root")), "large")
        discard(sized)
        edges = materialize(edges.unionByName(strays_against_all(large.filter(F.col("strays") <= LIMIT // 2))), "candidates")
        discard(roots)
        old = [edges, large]
        large = large.filter(F.col("strays") > LIMIT // 2)
        if large.isEmpty():
            return edges
        if depth < DEPTH:
            rows = large.select("node", F.col("key").alias("k")).join(sketches, F.col("k") == F.col("key")).select("node", "key", "sketch")
            nodes = materialize(rows.mapInPandas(children(threshold), "node long, key binary"), "nodes")
    out = materialize(edges.unionByName(in_blocks(large)), "candidates")
    discard(*old)
    return out


def apart(large: DataFrame) -> DataFrame:
    """Rows of the nodes that hold more than one component, with ``stray`` (not of the node's largest component) and the number of ``strays``."""
    sizes = large.groupBy("node", "root").agg(F.count("*").alias("size"))
    bulk = sizes.groupBy("node").agg(F.max_by("root", F.struct("size", "root")).alias("bulk"), (F.sum("size") - F.max("size")).alias("strays")).filter("strays > 0").withColumnRenamed("node", "m")
    return large.join(bulk, F.col("node") == F.col("m")).select("node", "key", "small", "n", "strays", (F.col("root") != F.col("bulk")).alias("stray"))


def strays_against_all(large: DataFrame) -> DataFrame:
    """Star edges of nodes with few strays: all other pairs of the node are in one component, so each block of the rest is compared with all strays."""
    half = LIMIT // 2
    blocks = F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("strays")) / half)).cast("int")
    dealt = large.withColumn("blocks", blocks)
    own = F.array(F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.when(F.col("stray"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)))
    dealt = dealt.select(F.xxhash64("node", "block").alias("node"), "key", "small").repartition("node").sortWithinPartitions("node", "key")
    return dealt.mapInPandas(compare_nodes(CANDIDATE), "a binary, b binary")


def led(large: DataFrame) -> DataFrame:
    """Edges to a node's leader (its least key, so that the nodes of a group mostly agree on it) where the sketches agree; one row per class of the node."""
    leader = large.groupBy("node").agg(F.min(F.struct("key", "small")).alias("leader")).select(F.col("node").alias("m"), F.col("leader.key").alias("b"), F.col("leader.small").alias("other"))

    def agree(rows: pd.Series, others: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, COORDINATES) for s in (rows, others))
        return pd.Series((x == y).sum(axis=1) >= CANDIDATE * COORDINATES)

    joined = large.join(leader, F.col("node") == F.col("m"))
    return joined.filter(F.pandas_udf(agree, "boolean")("small", "other")).filter(F.col("key") != F.col("b")).select(F.col("key").alias("a"), "b")


def in_blocks(large: DataFrame) -> DataFrame:
    """Star edges of nodes that stayed large: every pair of blocks of their classes is compared, whatever their number."""
    half = LIMIT // 2
    count = F.greatest(F.lit(1), F.ceil(F.col("n") / half)).cast("int")
    dealt = large.withColumn("count", count).withColumn("own", F.pmod(F.xxhash64("key"), F.col("count")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    pairs = pairs.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")))
    return pairs.select("node", "key", "small").repartition("node").sortWithinPartitions("node", "key").mapInPandas(compare_nodes(CANDIDATE), "a binary, b binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections, by products of incidence matrices over slices of the tokens."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]], np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(tokens)) > 1
    place = np.cumsum(shared) - 1
    live = shared[column]
    owner, column = owner[live], place[column[live]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)
    total, step = int(shared.sum()), max(256, (1 << 22) // n)
    for low in range(0, total, step):
        i, j = np.searchsorted(column, (low, low + step))
        matrix = np.zeros((n, min(step, total - low)), np.float32)
        matrix[owner[i:j], column[i:j] - low] = 1
        out += matrix @ matrix.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Matrix of the links between different sets, worked out some rows at a time."""
    common = intersections(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    out = np.empty(common.shape, bool)
    for low in range(0, len(sets), ROWS):
        c = common[low : low + ROWS].astype(np.float64)
        out[low : low + ROWS] = c >= threshold * (sizes[low : low + ROWS, None] + sizes[None, :] - c) - 1e-9
    np.fill_diagonal(out, False)
    return out


VERIFIED = "key binary, links long, linked long, root binary, in_parts boolean"


def verify(threshold: float):
    """Maps sorted rows (task, own, low, high, count, key, copies, text) to VERIFIED: counts over the pairs of the task's two blocks (over all of its pairs if low = high), and the least key of each one's connected part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, "task"):
            for _, rows in frame.groupby("task", sort=False):
                sets, index = [], []
                seen = set()
                for i, (key, text) in enumerate(zip(rows["key"], rows["text"], strict=True)):
                    s = shingles(text)
                    if key not in seen and set_key(s) == key:
                        seen.add(key)
                        sets.append(s)
                        index.append(i)
                if len(sets) < 2:
                    continue
                rows = rows.iloc[index].drop(columns="text")
                link = linked(sets, threshold)
                own, low, high = (rows[c].to_numpy() for c in ("own", "low", "high"))
                if low[0] != high[0]:  # pairs within a block belong to that block's own task
                    link &= own[:, None] != own[None, :]
                links, copies = link.sum(axis=1), link @ rows["copies"].to_numpy()
                np.fill_diagonal(link, True)
                keys = rows["key"].to_numpy()
                yield pd.DataFrame({"key": keys, "links": links, "linked": copies, "root": keys[least_labels(link[None])[0]], "in_parts": rows["count"].to_numpy() > 1})

    return run


def class_table(profiles: DataFrame) -> DataFrame:
    """(key, first, copies, size, sketch, small): one row per shingle set; first has the least id and the name of its row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "rep"))
    classes = profiles.filter("key IS NOT NULL").groupBy("key").agg(first.alias("first"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    return materialize(classes.withColumn("small", F.substring("sketch", 1, COORDINATES)), "classes")


def members_with_texts(docs: DataFrame, classes: DataFrame, threshold: float, runs: int) -> DataFrame:
    """(root, key, copies, count, own, text): the classes that have candidates, each dealt to one of its component's ``count`` blocks, with a text."""
    edges = candidate_edges(classes, threshold, runs)
    grouped = components(edges)
    members = grouped.join(classes.select("key", "first.rep", "copies", "size"), F.col("node") == F.col("key")).select("root", "key", "rep", "copies", "size")
    members = materialize(members, "members")
    discard(edges)
    n = F.count("*")
    count = F.greatest(F.ceil(n / BLOCK), F.least(F.lit(PARTS), F.ceil(n / PART)), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    sizes = members.groupBy("root").agg(count.cast("int").alias("count")).withColumnRenamed("root", "r")
    dealt = members.join(sizes, F.col("root") == F.col("r")).withColumn("own", F.pmod(F.xxhash64("key"), F.col("count")).cast("int"))
    texts = docs.filter(may_contain(members.select("rep"), F.col("rep"))).select("rep", "text").dropDuplicates(["rep"])
    out = materialize(dealt.join(texts, "rep").select("root", "key", "copies", "count", "own", "text"), "members-texts")
    discard(members)
    return out


def verified(tasks: DataFrame, threshold: float) -> DataFrame:
    rows = tasks.select("task", "own", "low", "high", "count", "key", "copies", "text").repartition("task").sortWithinPartitions("task", "key")
    return materialize(rows.mapInPandas(verify(threshold), VERIFIED), "verified", arrow_rows=TEXT_ROWS)


def block_pairs(members: DataFrame) -> DataFrame:
    """A task for each pair of blocks of a component."""
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    return dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).withColumn("task", F.xxhash64("root", "low", "high"))


def whole_block(task: Column) -> list[Column]:
    return [F.lit(0).alias("low"), F.lit(0).alias("high"), task.alias("task")]


def connected(members: DataFrame, threshold: float) -> DataFrame:
    """(node, root): the connected parts of verified links, without their counts.

    Each block is compared within itself and with the component's leader, which settles most. What is then not in the component's
    largest part is compared with all blocks, or all blocks with each other if it is more than half a block.
    """
    leaders = members.groupBy("root").agg(F.min("key").alias("leader")).withColumnRenamed("root", "r")
    led = members.join(leaders, F.col("root") == F.col("r")).withColumn("at", F.explode(F.when(F.col("key") == F.col("leader"), F.sequence(F.lit(0), F.col("count") - 1)).otherwise(F.array("own"))))
    first = verified(led.select("*", *whole_block(F.xxhash64("root", "at"))), threshold)
    settled = first.filter("NOT in_parts").select(F.col("key").alias("node"), "root")
    edges = first.filter("in_parts").select(F.col("key").alias("a"), F.col("root").alias("b"))
    parts = components(edges).select(F.col("node").alias("k"), F.col("root").alias("part"))
    rows = members.filter("count > 1").join(parts, F.col("key") == F.col("k"), "left").withColumn("part", F.coalesce("part", "key")).drop("k")
    sizes = rows.groupBy("root", "part").agg(F.count("*").alias("n"))
    bulk = sizes.groupBy(F.col("root").alias("r")).agg(F.max_by("part", F.struct("n", "part")).alias("bulk"), (F.sum("n") - F.max("n")).alias("strays")).filter("strays > 0")
    rest = materialize(rows.join(bulk, F.col("root") == F.col("r")).drop("r"), "rest")
    if rest.isEmpty():
        return settled.unionByName(components(edges))
    few = rest.filter(F.col("strays") <= BLOCK // 2)
    few = few.withColumn("at", F.explode(F.when(F.col("part") != F.col("bulk"), F.sequence(F.lit(0), F.col("count") - 1)).otherwise(F.array("own"))))
    again = verified(few.select("*", *whole_block(F.xxhash64("root", "at"))), threshold).unionByName(verified(block_pairs(rest.filter(F.col("strays") > BLOCK // 2)), threshold))
    return settled.unionByName(components(edges.unionByName(again.select(F.col("key").alias("a"), F.col("root").alias("b")))))


def join(docs: DataFrame, threshold: float = THRESHOLD, runs: int = RUNS) -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links): the class of each document and how many others it links to.

    class_id: the least doc_id of the connected component (null if none of it has an id); n_links counts documents with a similarity of threshold or
    more, copies included; n_text_links counts different shingle sets.
    """
    docs = named_rows(docs)
    profiles = materialize(profile(docs), "profiles", arrow_rows=TEXT_ROWS)
    classes = class_table(profiles)
    members = members_with_texts(docs, classes, threshold, runs)
    found = verified(block_pairs(members), threshold)
    discard(members)
    counts = found.groupBy("key").agg(F.sum("links").alias("links"), F.sum("linked").alias("linked"))
    # the star of a component that one task has seen whole is final
    settled = found.filter("NOT in_parts").select(F.col("key").alias("node"), "root")
    merged = components(found.filter("in_parts").select(F.col("key").alias("a"), F.col("root").alias("b")))
    roots = with_roots(classes, settled.unionByName(merged))
    names = materialize(roots.groupBy("root").agg(F.min("first.doc_id").alias("class_id")).withColumnRenamed("root", "r"), "names")
    named = roots.join(names, F.col("root") == F.col("r")).join(counts.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    named = named.select(F.col("key").alias("k"), "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_text_links"))
    # written tables on both sides of a join let a class with very many texts or copies be split among tasks
    named = materialize(named, "named")
    discard(roots, names, found)
    out = profiles.select("doc_id", "key").join(named, F.col("key") == F.col("k"), "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"))


def with_roots(classes: DataFrame, final: DataFrame) -> DataFrame:
    """(key, first, copies, root): the least key of every class's connected component, its own without a link."""
    roots = classes.select("key", "first", "copies").join(final, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key")).drop("node")
    return materialize(roots, "roots")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, that of the least id (of the least hash among equal ids and texts), with the columns of the input; texts without a shingle all stay.

    Only rows that may go are shuffled: the others are told by a filter of fixed size, which has no false negatives.
    """
    name = "_cx_rep"
    while name in docs.columns:
        name += "_"
    rows = named_rows(docs)
    profiles = materialize(profile(rows), "profiles", arrow_rows=TEXT_ROWS)
    classes = class_table(profiles)
    members = members_with_texts(rows, classes, threshold, RUNS)
    roots = with_roots(classes, connected(members, threshold))
    kept = roots.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.rep").alias("kept"))
    counts = profiles.filter("key IS NOT NULL").groupBy("rep").agg(F.count("*").alias("n"))
    doubtful = counts.join(kept, F.col("rep") == F.col("kept"), "left").filter("kept IS NULL OR n > 1")
    doubtful = materialize(doubtful.select(F.col("rep").alias("_r"), F.col("kept").isNotNull().alias("_keep")), "doubtful")
    discard(members, roots, classes)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.withColumn(name, row_name())
    maybe = may_contain(doubtful.select("_r"), F.col(name))
    asked = named.filter(maybe).select(F.struct(*columns).alias("row"), F.col(name).alias("rep"), F.xxhash64(*columns).alias("order"))
    asked = asked.join(doubtful, F.col("rep") == F.col("_r"), "left").filter("_keep IS NULL OR _keep")
    repeated = asked.filter("_keep").groupBy("rep").agg(F.min_by("row", "order").alias("row"))
    return named.filter(~maybe).select(*columns).unionByName(asked.filter("_keep IS NULL").select("row.*")).unionByName(repeated.select("row.*"))
