"""SimHash near-duplicates by vantage-point trees.

1. Every text gets a 64-bit SimHash of its word shingles; fingerprints and ids go to a stage table, texts are not shuffled.
2. Equal fingerprints become one row with their smallest doc_id, so a group of exact copies of any size is one point.
3. A vantage-point tree is fitted on a bounded sample of points (``SAMPLE``). Inner branch: distance to the vantage point at most its radius. Its depth
   follows the number of points, so that a leaf, or shard, keeps about ``LEAF`` of them at every input size.
4. Every point goes to its own shard. By the triangle inequality a link of at most ``radius`` bits can only cross a boundary from an inner point at
   distance over ``mu - radius`` to an outer one; only such points are sent to the outer branch as well, so each possible pair meets in some shard.
5. A shard grows its own tree in memory down to small blocks, compares these exactly and returns a spanning forest of its links, never all pairs.
6. Links of all shards are joined to components by alternating large-star and small-star steps; stage tables cut the lineage.

Defined results: null and empty texts have the fingerprint 0. Null ids form no component of their own id: they get the component of their fingerprint, null
if no row of it has an id. Repeated rows come back as often as they came. Further columns pass through; made columns replace equally named ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import store_stage
from .common import free_name

#: Points on which the tree is fitted, and points that a shard holds on average.
SAMPLE = 65_536
LEAF = 2_048
#: Points that are compared with each other directly.
BLOCK = 256


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``width`` lower-cased words; fewer words make one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(line[a:b], 42) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())]), ">u8").astype(np.uint64)


def majority(hashes: np.ndarray) -> bytes:
    """The bits, by column of ``hashes``, that are set in over half the rows."""
    ones = np.zeros(64 * hashes.shape[1], np.int64)
    for at in range(0, len(hashes), 255):
        rows = np.unpackbits(hashes[at:at + 255].astype(">u8").view(np.uint8), axis=1)
        ones += np.add.reduce(rows, axis=0, dtype=np.uint8)  # 255 rows at most: a byte holds their sum
    return np.packbits(2 * ones > len(hashes)).tobytes()


def majority_bits(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    return int.from_bytes(majority(hashes.reshape(-1, 1)), "big") if len(hashes) else 0


def fingerprint(text: str | None, width: int) -> int:
    return majority_bits(shingle_hashes(text, width))


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def with_fingerprint(docs: DataFrame, width: int, name: str) -> DataFrame:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(fingerprint(t, width)) for t in texts], dtype="int64")

    return docs.withColumn(name, prints("text"))


class Tree:
    """Vantage points and radii as arrays; node ``k`` has the branches ``2k + 1`` (inner) and ``2k + 2`` (outer)."""

    def __init__(self, points: np.ndarray, depth: int, bits: int = 64):
        self.depth = depth
        self.vantage = np.zeros(2**depth - 1, np.uint64)
        self.mu = np.full(2**depth - 1, bits // 2 - 1, np.int64)
        random = np.random.default_rng(7)
        parts = {0: points}
        for node in range(2**depth - 1):
            own = parts.pop(node, points[:0])
            self.vantage[node] = own[random.integers(len(own))] if len(own) else random.integers(2**bits - 1, dtype=np.uint64)
            far = np.bitwise_count(own ^ self.vantage[node]).astype(np.int64)
            if len(own):
                self.mu[node] = min(bits - 1, max(0, int(np.median(far))))
            parts[2 * node + 1], parts[2 * node + 2] = own[far <= self.mu[node]], own[far > self.mu[node]]

    def route(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(indexes into points, shards): every point's own shard and those behind a boundary that it can link across."""
        index, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            far = np.bitwise_count(points[index] ^ self.vantage[node]).astype(np.int64)
            inner = far <= self.mu[node]
            both = inner & (far > self.mu[node] - radius)
            index, node = np.concatenate((index, index[both])), np.concatenate((2 * node + np.where(inner, 1, 2), 2 * node[both] + 2))
        return index, node


def alike_parts(points: np.ndarray, pieces: int, bits: int) -> list[np.ndarray]:
    """Indexes of points that agree in one of ``pieces`` pieces of their bits, a list entry for each value with two points or more."""
    width, found = -(-bits // pieces), []
    points = points.astype(np.uint64)
    for k in range(pieces):
        value = points >> np.uint64(k * width) & np.uint64(2**width - 1)
        order = np.argsort(value, kind="stable")
        ends = np.nonzero(np.diff(value[order]))[0] + 1
        found += [part for part in np.split(order, ends) if len(part) > 1]
    return found


def block_pairs(points: np.ndarray, radius: int, label: np.ndarray, bits: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of different labels at most ``radius`` bits apart, by an in-memory tree with the same boundary rule.

    Labels may be joined on the way: what has the label of most of a block is not compared with that block, so a group that is one already costs little.
    In points of few bits the tree prunes little; two of them that differ in ``radius`` bits agree in one of ``radius + 1`` pieces, so only those that agree in a
    piece are compared. A pair may then come more than once.
    """
    random = np.random.default_rng(11)
    points = points if bits > 32 else points.astype(np.uint32)
    stack = [np.arange(len(points))] if bits > 32 else alike_parts(points, radius + 1, bits)
    while stack:
        index = stack.pop()
        own = points[index]
        # A split that hardly shrinks its part does not pay: such parts are compared by rows.
        if len(index) > BLOCK:
            far = np.bitwise_count(own ^ own[random.integers(len(own))]).astype(np.int64)
            mu = int(np.median(far))
            inner, outer = index[far <= mu], index[far > mu - radius]
            if max(len(inner), len(outer)) < 0.8 * len(index):
                stack += [inner, outer]
                continue
        for at in range(0, len(own), BLOCK):
            rest = np.arange(at, len(own))
            mine = label[index[at:at + BLOCK]]
            kinds, many = np.unique(mine, return_counts=True)
            most = mine == kinds[many.argmax()]
            for rows, columns in ((rest[:BLOCK][most], rest[label[index[at:]] != kinds[many.argmax()]]), (rest[:BLOCK][~most], rest)):
                near = np.flatnonzero(np.bitwise_count(own[rows, None] ^ own[None, columns]) <= radius)
                if not len(near):
                    continue
                a, b = np.divmod(near, len(columns))
                a, b = rows[a], columns[b]
                keep = (a < b) & (label[index[a]] != label[index[b]])
                if keep.any():
                    yield index[a[keep]], index[b[keep]]


def spanning(points: np.ndarray, radius: int, wide: np.ndarray | None = None, most: int = 0, bits: int = 64) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links within one shard and a label per tree; with ``wide`` prints a link must also be at most ``most`` bits of these long."""
    label, forest = np.arange(len(points)), []
    members: dict[int, list[int]] = {}  # of the labels that have more than one
    for left, right in block_pairs(points, radius, label, bits):
        if wide is not None:
            near = np.bitwise_count(wide[left] ^ wide[right]).sum(axis=1) <= most
            left, right = left[near], right[near]
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
        for part in np.split(np.arange(len(left)), np.nonzero(np.diff(left))[0] + 1) if len(left) else []:
            a, others = left[part[0]], right[part]
            groups, first = np.unique(label[others], return_index=True)
            new = groups != label[a]
            if new.any():
                forest += [(int(a), int(b)) for b in others[first[new]]]
                # The largest of the trees keeps its label: a point changes it a few times only, however many links come.
                trees = sorted(((members.pop(int(g), [int(g)]), int(g)) for g in (label[a], *groups[new])), key=lambda tree: len(tree[0]))
                joined, kept = trees.pop()
                for points_of_tree, _ in trees:
                    label[points_of_tree] = kept
                    joined += points_of_tree
                members[kept] = joined
    return forest, label


def tree_links(points: DataFrame, column: str, radius: int) -> DataFrame:
    """(a, b) fingerprints whose links connect what is connected by links of at most ``radius`` bits."""
    spark = points.sparkSession
    count = points.count()
    depth = max(0, int(np.ceil(np.log2(max(1, count) / LEAF))))
    share = min(1.0, 1.2 * SAMPLE / max(1, count))
    drawn = points.select(column).sample(False, share, 3).limit(SAMPLE).toPandas()[column].to_numpy(np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(Tree(np.sort(drawn), depth))

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            prints = part[column].to_numpy(np.int64)
            index, shard = tree.value.route(prints.view(np.uint64), radius)
            yield pd.DataFrame({"shard": shard, "print": prints[index]})

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        prints = np.unique(part["print"].to_numpy(np.int64))
        pairs = np.array(spanning(prints.view(np.uint64), radius)[0], np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": prints[pairs[:, 0]], "b": prints[pairs[:, 1]]})

    routed = points.select(column).mapInPandas(route, "shard long, print long")
    return routed.groupBy("shard").applyInPandas(solve, "a long, b long").where(F.col("a") != F.col("b"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node reachable.

    ``links`` has columns a and b. Large-star hangs a node's larger neighbours under its smallest, small-star its smaller ones; both keep components whole
    and end in stars. Each round's links are stored, so that a lost executor repeats one round at most.
    """
    state = store_stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        ).distinct()
        state = store_stage(small, "links")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(now)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def cluster(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, print, component_id) per row of ``docs``; print is the fingerprint as a signed long."""
    prints = store_stage(with_fingerprint(docs.select("doc_id", "text"), width, "print").select("doc_id", "print"), "prints")
    points = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    points = store_stage(points, "points")
    roots = components(tree_links(points, "print", radius))
    rooted = points.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = store_stage(rooted, "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store_stage(rooted.join(lowest, "root").select("print", "component_id"), "named")
    return prints.join(named, "print", "left").select("doc_id", "print", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return cluster(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The hashes of a text's shingles, sorted, each once."""
    return np.unique(shingle_hashes(text, width))


def wide_print(hashes: np.ndarray, words: int) -> bytes:
    """A SimHash of ``64 * words`` bits: each 64 bits from the hashes mixed anew."""
    mixed = (hashes[:, None] + np.arange(words, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return majority(mixed ^ (mixed >> np.uint64(27)))


def parts_of(prints: np.ndarray) -> np.ndarray:
    """32-bit parts of wide prints, one column each, as unsigned 64-bit numbers."""
    return np.ascontiguousarray(prints.astype(">u8")).view(">u4").reshape(len(prints), -1).astype(np.uint64)


def numbers(cells: pd.Series, words: int) -> np.ndarray:
    """Wide prints of points, which are a wide print and a digest of the shingle set."""
    return np.frombuffer(b"".join(c[:8 * words] for c in cells), ">u8").reshape(-1, words).astype(np.uint64)


def shard_candidates(
    parts: np.ndarray, radius: int, wide: np.ndarray, tight: int, most: int, label: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, loose) pairs of a shard: a spanning forest of those at most ``tight`` bits long, and all loose ones up to ``most`` bits that it leaves apart.

    With labels there is no forest: all pairs up to ``most`` bits between different labels.
    """
    made = []
    if label is None:
        forest, label = spanning(parts, radius, wide, tight, 32)
        a, b = np.array(forest, np.int64).reshape(-1, 2).T
        made.append((a, b, np.zeros(len(a), bool)))
    for left, right in block_pairs(parts, radius, label, 32):
        near = np.bitwise_count(wide[left] ^ wide[right]).sum(axis=1) <= most
        if near.any():
            made.append((left[near], right[near], np.ones(int(near.sum()), bool)))
    return tuple(np.concatenate([m[k] for m in made]) if made else np.zeros(0, bool if k == 2 else np.int64) for k in range(3))


def wide_candidates(points: DataFrame, words: int, tight: int, most: int, radius: int, leaf: int) -> DataFrame:
    """(a, b, loose) points whose wide prints are at most ``most`` bits apart, found in the vantage-point trees of their 32-bit parts.

    See ``shard_candidates`` for what a shard returns. Where ``points`` have a column label, pairs within a label are left out.
    """
    spark = points.sparkSession
    labelled = "label" in points.columns
    count = points.count()
    depth = max(0, int(np.ceil(np.log2(max(1, count) / leaf))))
    drawn = points.select("print").sample(False, min(1.0, 1.2 * SAMPLE / max(1, count)), 3).limit(SAMPLE).toPandas()["print"]
    sample = parts_of(numbers(drawn.sort_values(), words)) if len(drawn) else np.zeros((0, 2 * words), np.uint64)
    trees = spark.sparkContext.broadcast([Tree(np.unique(sample[:, k]), depth, 32) for k in range(2 * words)])

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints, labels = batch["print"].to_numpy(), batch["label"].to_numpy()
            columns = parts_of(numbers(batch["print"], words))
            for k, tree in enumerate(trees.value):
                index, shard = tree.route(columns[:, k], radius)
                yield pd.DataFrame({"part": k, "shard": shard, "print": prints[index], "label": labels[index]})

    def solve(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        own = shard.drop_duplicates("print").sort_values("print")
        cells = own["print"].to_numpy()
        wide = numbers(own["print"], words)
        label = pd.factorize(own["label"])[0] if labelled else None
        left, right, loose = shard_candidates(parts_of(wide)[:, key[0]], radius, wide, tight, most, label)
        return pd.DataFrame({"a": cells[left], "b": cells[right], "loose": loose})

    label = F.col("label") if labelled else F.lit(None).cast("binary")
    routed = points.select("print", label.alias("label")).mapInPandas(route, "part int, shard long, print binary, label binary")
    found = routed.groupBy("part", "shard").applyInPandas(solve, "a binary, b binary, loose boolean")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("loose").alias("loose"))


def checked(pairs: DataFrame, points: DataFrame, keyed: DataFrame, width: int, similarity: float) -> DataFrame:
    """``pairs`` of points with ``holds``: whether the Jaccard similarity of their shingle sets is ``similarity`` or more.

    ``points`` have (print, first: _doc and _row), ``keyed`` has (_doc, _row, text).
    """

    @F.pandas_udf("array<long>")
    def set_of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).view(np.int64) for t in texts], dtype=object)

    asked = pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct()
    named = asked.join(points, "print").select("print", F.col("first._doc").alias("_doc"), F.col("first._row").alias("_row"))
    texts = keyed.join(named, ["_doc", "_row"]).dropDuplicates(["print"])
    sets = store_stage(texts.select("print", set_of("text").alias("set")), "sets")
    both = pairs.join(sets.select(F.col("print").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("print").alias("b"), F.col("set").alias("set_b")), "b"
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - common
    return store_stage(both.select("a", "b", "loose", (common + 1e-9 >= similarity * either).alias("holds")), "checked")


def near_links(
    points: DataFrame, keyed: DataFrame, width: int, similarity: float, words: int, radius: int, leaf: int
) -> DataFrame:
    """(a, b) points whose true links connect what is connected by candidates of at least ``similarity``."""
    chance = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    bits = 64 * words
    tight, most = (int(np.ceil(bits * chance + k * (bits * chance * (1 - chance)) ** 0.5)) for k in (0, 4))
    first = checked(store_stage(wide_candidates(points, words, tight, most, radius, leaf), "candidates"), points, keyed, width, similarity)
    true = first.where("holds").select("a", "b")
    # A link of a forest that is not true may have hidden others: the trees it stands in are searched again for all pairs that true links leave apart.
    forest = first.where(~F.col("loose"))
    if forest.where(~F.col("holds")).isEmpty():
        return true
    trees = store_stage(components(forest.select("a", "b")), "trees")
    members = trees.select(F.col("node").alias("print"), "root").union(trees.select("root", "root")).distinct()
    broken = forest.where(~F.col("holds")).select(F.col("a").alias("print")).join(members, "print").select("root").distinct()
    again = members.join(broken, "root").select("print")
    labels = components(true).withColumnsRenamed({"node": "print", "root": "label"})
    again = store_stage(again.join(labels, "print", "left").select("print", F.coalesce("label", "print").alias("label")), "again")
    tested = first.select("a", "b")
    more = wide_candidates(again, words, tight, most, radius, leaf).join(tested, ["a", "b"], "left_anti")
    return true.union(checked(store_stage(more, "candidates"), points, keyed, width, similarity).where("holds").select("a", "b"))


def drop_near(docs: DataFrame, width: int = 5, similarity: float = 0.8, words: int = 9, radius: int = 3, leaf: int = 65_536) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id (null last) of those connected by texts of at least ``similarity``.

    Texts link if the exact Jaccard similarity J of their shingle sets is ``similarity`` or more; wide SimHashes of the sets only find the candidates. A bit
    differs with chance acos(2J / (1 + J)) / pi at most. Such distances are out of reach for one tree of 64-bit points, where triangle bounds no longer
    prune, so candidates come from trees over the 32-bit parts: two texts meet if any part differs in at most ``radius`` bits, and are compared exactly if
    the whole prints differ in no more bits than expected at ``similarity`` plus four standard deviations. With 18 parts that finds 0.996 of pairs at
    J = 0.8 and more above in expectation; no pair below ``similarity`` is linked.

    Null and empty texts have the empty set and are one group. Null ids come last; repeated rows count once. Further columns pass through.
    """
    doc, row = free_name(docs, "_doc"), free_name(docs, "_row")
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), row: F.xxhash64("text")})

    @F.pandas_udf("binary")
    def points_of(texts: pd.Series) -> pd.Series:
        sets = [shingle_set(t, width) for t in texts]
        return pd.Series([wide_print(s, words) + xxhash.xxh3_128_digest(s.tobytes()) for s in sets], dtype=object)

    own = keyed.select(F.col(doc).alias("_doc"), F.col(row).alias("_row"), "text")
    prints = store_stage(own.select("_doc", "_row", points_of("text").alias("print")), "wide")
    points = store_stage(prints.groupBy("print").agg(F.min(F.struct("_doc", "_row")).alias("first")), "points")
    roots = components(near_links(points, own, width, similarity, words, radius, leaf))
    rooted = points.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    keepers = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._doc").alias(doc), F.col("first._row").alias(row))
    # Repeated rows agree in id and text: one of them stays.
    return keyed.join(keepers, [doc, row]).dropDuplicates([doc, row]).select(*[F.col(f"`{c}`") for c in docs.columns])
