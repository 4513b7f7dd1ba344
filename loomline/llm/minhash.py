"""MinHash near-duplicates: banding, signature verification, exact confirmation, components.

1. Every text becomes the set of its word shingles; equal sets are one point, whatever the number of their documents. A point's signature holds the minima
   of ``bands * rows`` universal hash functions over the set.
2. Points that agree in all rows of a band share a bucket. Buckets of one point are dropped.
3. In each bucket every point is paired with one centre, drawn anew for each band. Such pairs are verified by their signatures, then confirmed on the full
   sets, and joined to components, which the points carry as labels from here on.
4. Buckets that still hold several labels are cut into chunks of bounded size, by label. For each two chunks that are not of one label a task compares the
   signatures of all points, and names those that have a possible partner of another label. Only their sets are fetched; the task then confirms pairs on full
   sets and returns a spanning forest of the true links. No list of pairs leaves a task.
5. Links of both kinds are joined by alternating large-star and small-star steps.

Every link found is exact. A pair with similarity 0.8 shares no band with a chance of 3e-6 at 32 bands of 5 rows, and fails the verification, ``DOUBT``
standard deviations below the threshold, with a chance of 3e-6; both fall off fast above it.

Defined results: null and empty texts have no shingles and are linked with nothing. Null ids give no component its name; rows without an id in a component
without ids have a null component and are kept. Rows with equal ids are rows of their own. Further columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import store_stage
from .simhash_tree import components, shingle_set

#: Points of a chunk, shingles that weigh as much as one point more, and standard deviations of doubt that a signature leaves.
CHUNK = 512
WEIGHT = 1_024
DOUBT = 4.5
#: Weight of the blocks that a task takes up together, points of a block whose pairs are listed, and pairs compared at a time.
TOGETHER = 2_048
FEW = 48
COMPARED = 20_000


def universal(functions: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of the hash functions ``(a x + b) mod 2**64 >> 32`` of 32-bit keys."""
    random = np.random.default_rng(20)
    return random.integers(0, 2**63, functions, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, functions, np.uint64)


def signature(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> bytes:
    """The minimum of each function over a set of 64-bit hashes, as little-endian 32-bit numbers."""
    factor, summand = functions
    low = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    keys = hashes >> np.uint64(32)
    for at in range(0, len(keys), 256):
        block = keys[at:at + 256, None] * factor
        block += summand
        np.minimum(low, block.min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def alike(left: np.ndarray, right: np.ndarray, similarity: float) -> bool:
    """Whether two sets of sorted hashes have a Jaccard similarity of ``similarity`` or more (in hundredths, exactly)."""
    small, large = sorted((len(left), len(right)))
    share = round(100 * similarity)
    if 100 * small < share * large:
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= share * (len(left) + len(right) - common)


def least_agreement(similarity: float, functions: int) -> int:
    """Equal minima that a pair must have to be confirmed on its sets."""
    return int(functions * (similarity - DOUBT * (similarity * (1 - similarity) / functions) ** 0.5))


def shared(left: np.ndarray, right: np.ndarray, rows: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of equal minima, whether an earlier band agrees) for every point of one side with every point of the other."""
    same = np.zeros((len(left), len(right)), np.uint8 if left.shape[1] < 256 else np.int32)
    earlier = np.zeros(same.shape, bool)
    for first in range(0, left.shape[1], rows):
        own = np.zeros(same.shape, np.uint8)
        for k in range(first, first + rows):
            own += left[:, k, None] == right[None, :, k]
        same += own
        if first < band * rows:
            earlier |= own == rows
    return same, earlier


def matrix(cells: pd.Series, functions: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<u4").reshape(-1, functions)


def listed(places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs within small blocks that begin at ``places``."""
    made = [(np.empty(0, np.int64),) * 2]
    for size in np.unique(sizes[sizes > 1]):
        first, second = np.triu_indices(size, 1)
        starts = places[sizes == size][:, None]
        made.append(((starts + first).ravel(), (starts + second).ravel()))
    return tuple(np.concatenate([m[k] for m in made]) for k in range(2))


def possible(part: pd.DataFrame, rows: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the blocks of ``part`` (sorted by block), one point of each side, of different labels, that pass the signature and meet in no earlier
    band; most alike first.
    """
    functions = len(part["signature"].iloc[0]) // 4
    signatures, label = matrix(part["signature"], functions), pd.factorize(part["label"])[0]
    left, right, band = part["left"].to_numpy(), part["right"].to_numpy(), part["band"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], np.diff(part["block"].to_numpy()) != 0)))
    sizes = np.diff(np.append(starts, len(part)))
    made = []
    first, second = listed(starts[sizes <= FEW], sizes[sizes <= FEW])
    sided = (label[first] != label[second]) & (left[first] & right[second] | left[second] & right[first])
    first, second = first[sided], second[sided]
    for at in range(0, len(first), COMPARED):
        a, b = first[at:at + COMPARED], second[at:at + COMPARED]
        equal = signatures[a] == signatures[b]
        same = equal.sum(axis=1)
        met = equal.reshape(len(a), -1, rows).all(axis=2).argmax(axis=1)
        good = (same >= least) & (met == band[a])
        made.append((a[good], b[good], same[good].astype(np.int64)))
    for start, size in zip(starts[sizes > FEW], sizes[sizes > FEW]):
        own = np.arange(start, start + size)
        ours, theirs = own[left[own]], own[right[own]]
        same, earlier = shared(signatures[ours], signatures[theirs], rows, int(band[start]))
        a, b = np.nonzero((same >= least) & ~earlier & (label[ours][:, None] != label[theirs][None]))
        made.append((ours[a], theirs[b], same[a, b].astype(np.int64)))
    if not made:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, same = (np.concatenate([m[k] for m in made]) for k in range(3))
    order = np.argsort(-same, kind="stable")
    return a[order], b[order]


def forest(part: pd.DataFrame, pairs: tuple[np.ndarray, np.ndarray], similarity: float) -> list[tuple[bytes, bytes]]:
    """Links among the pairs that hold on full sets, without those between points joined already."""
    prints, sets = part["print"].to_numpy(), [np.frombuffer(s, np.uint64) for s in part["set"]]
    label = pd.factorize(part["label"])[0].copy()
    found = []
    for a, b in zip(pairs[0].tolist(), pairs[1].tolist()):
        if label[a] != label[b] and alike(sets[a], sets[b], similarity):
            found.append((prints[a], prints[b]))
            label[label == label[b]] = label[a]
    return found


class Points:
    """Stored points of a corpus: (print, signature, n, doc, row), and the sets of those that share a bucket."""

    def __init__(self, docs: DataFrame, width: int, bands: int, rows: int):
        self.width, self.bands, self.rows = width, bands, rows
        functions = universal(bands * rows)

        @F.pandas_udf("print binary, signature binary, n_shingles long")
        def look(texts: pd.Series) -> pd.DataFrame:
            sets = [shingle_set(t, width) for t in texts]
            return pd.DataFrame({
                "print": pd.Series([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], dtype=object),
                "signature": pd.Series([signature(s, functions) if len(s) else None for s in sets], dtype=object),
                "n_shingles": pd.Series([len(s) for s in sets], dtype="int64"),
            })

        keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("row"), "text")
        self.keyed = keyed
        self.looked = store_stage(keyed.withColumn("own", look("text")).select("doc", "row", "own.*"), "minima")
        with_words = self.looked.where(F.col("print").isNotNull())
        # Any row of a print gives its signature and its text; the smallest is taken, so that reruns agree.
        self.points = store_stage(with_words.groupBy("print").agg(
            F.min("doc").alias("first"), F.min(F.struct(F.coalesce("doc", F.lit(-(2**63))).alias("doc"), "row", "signature", "n_shingles")).alias("own")
        ).select("print", "first", "own.*"), "points")

    def buckets(self) -> DataFrame:
        """(band, key, print, n_shingles) of buckets of two points or more."""
        size = 4 * self.rows
        band = F.explode(F.sequence(F.lit(0), F.lit(self.bands - 1))).alias("band")
        own = self.points.select("print", "n_shingles", "signature", band).select(
            "band", F.xxhash64("band", F.substring("signature", F.col("band") * size + 1, F.lit(size))).alias("key"), "print", "n_shingles"
        )
        full = own.groupBy("band", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("print", "band").alias("draw"), F.col("print").alias("centre"))).alias("drawn")
        ).where(F.col("n") > 1).select("band", "key", "drawn.centre")
        return store_stage(own.join(full, ["band", "key"]), "buckets")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(print, set) of the points wanted, computed from the texts of their rows."""
        width = self.width

        @F.pandas_udf("binary")
        def set_of(texts: pd.Series) -> pd.Series:
            return pd.Series([shingle_set(t, width).tobytes() for t in texts], dtype=object)

        rows = self.points.join(wanted, "print", "left_semi").select("doc", "row", "print")
        texts = self.keyed.withColumn("doc", F.coalesce("doc", F.lit(-(2**63)))).join(rows, ["doc", "row"]).dropDuplicates(["print"])
        return store_stage(texts.select("print", set_of("text").alias("set")), "sets")


def centre_links(points: Points, members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) links between points and the centres of their buckets."""
    least = least_agreement(similarity, points.bands * points.rows)

    @F.pandas_udf("int")
    def agreement(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([int((np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")).sum()) for a, b in zip(left, right)], dtype="int32")

    @F.pandas_udf("boolean")
    def holds(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), similarity) for a, b in zip(left, right)], dtype=bool)

    apart = members.where(F.col("print") != F.col("centre"))
    pairs = apart.select(F.least("print", "centre").alias("a"), F.greatest("print", "centre").alias("b")).distinct()

    def beside(frame: DataFrame, other: DataFrame, column: str) -> DataFrame:
        return frame.join(other.select(F.col("print").alias("a"), F.col(column).alias("left")), "a").join(
            other.select(F.col("print").alias("b"), F.col(column).alias("right")), "b"
        )

    verified = store_stage(beside(pairs, points.points, "signature").where(agreement("left", "right") >= least).select("a", "b"), "verified")
    return store_stage(beside(verified, sets, "set").where(holds("left", "right")).select("a", "b"), "links")


def chunk_links(points: Points, members: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) links that connect what is linked within buckets of several labels."""
    rows, least = points.rows, least_agreement(similarity, points.bands * points.rows)
    bucket = ["band", "key"]
    labelled = members.drop("centre").join(labels, "print", "left").withColumn("label", F.coalesce("label", "print"))
    weighed = labelled.groupBy(*bucket, "label").agg(F.sum(1 + F.col("n_shingles") / WEIGHT).alias("weight"))
    # A label that fills chunks alone has chunks of its own; the others share chunks, dealt by their hash.
    weighed = store_stage(weighed.withColumn("alone", F.col("weight") > CHUNK), "weights")
    rest = weighed.groupBy(*bucket).agg(
        F.count(F.lit(1)).alias("labels"), F.coalesce(F.sum(F.when(~F.col("alone"), F.col("weight"))), F.lit(0.0)).alias("rest")
    ).where(F.col("labels") > 1).select(*bucket, F.greatest(F.lit(1), F.ceil(F.col("rest") / CHUNK)).alias("rest"))
    dealt = weighed.join(rest, bucket).select(*bucket, "label", "alone", F.ceil(F.col("weight") / CHUNK).alias("own"), "rest")
    part = F.when(F.col("alone"), F.pmod(F.xxhash64("print"), F.col("own"))).otherwise(F.pmod(F.xxhash64("label"), F.col("rest")))
    pure = F.when(F.col("alone"), F.col("label"))
    chunk = F.struct(pure.alias("pure"), part.alias("part")).alias("chunk")
    placed = store_stage(labelled.join(dealt, [*bucket, "label"]).select(*bucket, "print", "label", "n_shingles", chunk), "placed")

    chunks = placed.select(*bucket, "chunk").distinct()
    crossed = chunks.withColumnRenamed("chunk", "a").join(chunks.withColumnRenamed("chunk", "b"), bucket).where(
        ((F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & F.col("a.pure").isNull())) & ~F.coalesce(F.col("a.pure") == F.col("b.pure"), F.lit(False))
    )
    crossed = crossed.withColumn("block", F.xxhash64("band", "key", "a", "b"))
    sides = crossed.select(*bucket, "block", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk"), "a", "b").select(
        *bucket, "block", "chunk", (F.col("chunk") == F.col("a")).alias("left"), (F.col("chunk") == F.col("b")).alias("right")
    )
    blocks = placed.join(sides, [*bucket, "chunk"]).select("band", "block", "print", "label", "left", "right", "n_shingles")
    blocks = store_stage(blocks, "blocks")
    # Blocks are taken up together, as many as weigh about the same whatever their size: most have two or three points.
    weight = blocks.agg(F.coalesce(F.sum(1 + F.col("n_shingles") / WEIGHT), F.lit(0.0))).first()[0]
    groups = max(1, int(weight / TOGETHER))
    signed = blocks.drop("n_shingles").join(points.points.select("print", "signature"), "print")
    kept = "band int, block long, print binary, label binary, left boolean, right boolean, signature binary"

    def name(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop(columns="group").sort_values(["block", "print"], ignore_index=True)
        return part.iloc[np.unique(np.concatenate(possible(part, rows, least)))][["band", "block", "print", "label", "left", "right", "signature"]]

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["block", "print"], ignore_index=True)
        return pd.DataFrame(forest(part, possible(part, rows, least), similarity), columns=["a", "b"])

    def grouped(frame: DataFrame):
        return frame.withColumn("group", F.pmod(F.col("block"), F.lit(groups))).groupBy("group")

    named = store_stage(grouped(signed).applyInPandas(name, kept), "named")
    return store_stage(grouped(named.join(sets, "print")).applyInPandas(solve, "a binary, b binary"), "links")


def cluster(docs: DataFrame, width: int = 4, similarity: float = 0.8, bands: int = 32, rows: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    points = Points(docs, width, bands, rows)
    members = points.buckets()
    sets = points.sets(members.select("print").distinct())
    first = components(centre_links(points, members, sets, similarity)).select(F.col("node").alias("print"), F.col("root").alias("label"))
    first = store_stage(first, "labels")
    more = chunk_links(points, members, first, sets, similarity)
    roots = components(first.select(F.col("print").alias("a"), F.col("label").alias("b")).union(more))

    rooted = points.points.select("print", "first").join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = store_stage(rooted.select("print", "first", F.coalesce("root", "print").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = store_stage(rooted.join(lowest, "root").select("print", "component"), "classes")
    out = points.looked.join(named, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc")).otherwise(F.col("component"))
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept"))


def digest(docs: DataFrame) -> DataFrame:
    return cluster(docs)
