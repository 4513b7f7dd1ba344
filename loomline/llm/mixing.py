"""Mixing sources to target weights.

1. Words of each source are packed into fixed-length blocks: documents are laid end to end in a fixed order, block ``b`` holds words
   ``[b * block, (b + 1) * block)``. The order is (bucket, id, text hash) within a source, buckets being hash buckets of a fixed mean size, so places
   come from bucket sums and a short window per bucket, however large a source is.
2. Targets share the total by weight; a source stops at ``most`` times its size and the excess is shared out again by weight.
3. A source's slots are as many whole passes over its blocks as fit its target, and a part of one more pass. The last slot is cut short, so that the
   words taken equal the rounded target.
4. Slots are dealt to output shards: source counts of a shard are a multinomial draw, conditional on the totals. The draw splits a range of shards in two
   again and again, seeded by the range, so any task can draw any shard alone and reruns agree.
5. A slot's index is mapped through its source's pseudorandom permutation of that pass (a keyed Feistel network, walked until it lands inside), and slots
   meet blocks by an equi join on (source, block).

Defined results: null texts have size 0 and are never taken; null sources are one source, ordered last. Repeated rows are laid out one by one. An empty
table, or one without words, takes nothing. Further columns pass through; made columns replace equally named ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import store_stage
from .common import running_start, unclash

WEIGHTS = (5.0, 2.0, 1.0)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Mean slots of an output shard.
SHARD_SLOTS = 1024


@dataclass(frozen=True)
class Share:
    """One source of the mix: its size, target and slots."""

    source: str | None
    size: int
    target: float
    blocks: int
    slots: int
    cut: int  # words of the last slot; a whole block's where nothing is cut


def shares(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Targets by weight, stopped at ``most`` times the size, the excess shared again until none is above."""
    targets, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        total = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / total > most * sizes[k]]
        if not over:
            for k in open_:
                targets[k] = left * weights[k] / total
            break
        for k in over:
            targets[k] = most * float(sizes[k])
            open_.remove(k)
        left = float(sum(sizes)) - sum(targets)
    return targets


def scramble(right: np.ndarray, key: int, k: int, mask: np.uint64) -> np.ndarray:
    mixed = (right + np.uint64((key * 4 + k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(29)) & mask


def permuted(index: np.ndarray, count: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of ``range(count)`` at ``index``, or its inverse.

    Four Feistel rounds on the next even number of bits, repeated while the result is outside.
    """
    half = max(1, ((max(1, count - 1)).bit_length() + 1) // 2)
    mask = np.uint64(2**half - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in range(4):
            if back:
                left, right = right ^ scramble(left, key, 3 - k, mask), left
            else:
                left, right = right, left ^ scramble(right, key, k, mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(count)]
    return out.astype(np.int64)


def key_of(seed: int, source: int, epoch: int) -> int:
    return (seed * 1_000_003 + source) * 101 + epoch


def plan(spark, sizes: list[tuple[str | None, int]], block: int, weights, most: float, seed: int) -> list[Share]:
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be", "surrogatepass")))
    targets = shares([s for _, s in ordered], [weights[k % len(weights)] for k in range(len(ordered))], most)
    planned = []
    for k, ((source, size), target) in enumerate(zip(ordered, targets)):
        blocks, last = -(-size // block), size - (-(-size // block) - 1) * block
        words = min(int(round(target)), int(most * size))
        passes, rest = divmod(words, size) if size else (0, 0)
        slots, cut = passes * blocks, block
        if rest:
            # The short block stands somewhere in the part pass: slots before it give whole blocks.
            place = int(permuted(np.array([blocks - 1]), blocks, key_of(seed, k, passes), back=True)[0])
            given = lambda n: n * block - (block - last if place < n else 0)
            need = -(-rest // block)
            need += given(need) < rest
            before = given(need - 1)
            slots, cut = slots + need, rest - before
        planned.append(Share(source, size, target, blocks, slots, cut))
    return planned


def split_counts(counts: np.ndarray, part: int, whole: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of each source's slots fall into ``part`` of ``whole`` places: a multinomial draw conditional on the totals."""
    places, total = part, int(counts.sum())
    out = np.zeros_like(counts)
    random = np.random.default_rng(seed)
    rest = total
    wanted = min(total, round(total * places / whole))
    for k, n in enumerate(counts):
        rest -= int(n)
        if wanted <= 0:
            break
        if max(int(n), rest) < 10**9:
            out[k] = random.hypergeometric(int(n), rest, wanted)
        else:  # beyond the sampler's range the split is near its mean anyway
            mean = int(round(wanted * int(n) / (int(n) + rest)))
            out[k] = min(int(n), wanted, max(mean, wanted - rest))
        wanted -= int(out[k])
    return out


def shard_counts(totals: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, number of slots) of each source in one shard."""
    first, counts, low, high = np.zeros_like(totals), totals.copy(), 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        left = split_counts(counts, middle - low, high - low, (seed, low, high))
        if shard < middle:
            counts, high = left, middle
        else:
            first, counts, low = first + left, counts - left, middle
    return first, counts


def slots(spark, planned: list[Share], block: int, seed: int) -> DataFrame:
    """(_source, _block, _epoch, _shard, _cut): one row per slot; ``_cut`` words of the block are used."""
    totals = np.array([s.slots for s in planned], np.int64)
    shards = max(1, int(totals.sum()) // SHARD_SLOTS)

    def draw(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for shard in part["id"]:
                first, counts = shard_counts(totals, int(shard), shards, seed)
                made = []
                for k, (start, n) in enumerate(zip(first.tolist(), counts.tolist())):
                    index = np.arange(start, start + n)
                    epochs = index // max(1, planned[k].blocks)
                    for epoch in np.unique(epochs):
                        own = index[epochs == epoch]
                        blocks = permuted(own - epoch * planned[k].blocks, planned[k].blocks, key_of(seed, k, int(epoch)))
                        cut = np.where(own == planned[k].slots - 1, planned[k].cut, block)
                        made.append(pd.DataFrame({"_source": k, "_block": blocks, "_epoch": epoch, "_shard": shard, "_cut": cut}))
                if made:
                    yield pd.concat(made)

    return spark.range(shards).mapInPandas(draw, "_source int, _block long, _epoch int, _shard long, _cut long")


def mix(docs: DataFrame, block: int = 64, weights=WEIGHTS, most: float = 3.0, seed: int = 17) -> tuple[DataFrame, DataFrame, list[Share]]:
    """(laid-out documents, taken spans, plan).

    Laid-out documents have all columns of ``docs`` but the text, ``_source`` (number in the plan), ``_start`` and ``_size``; source and start name a
    row that has words. Spans are (_source, _start, _epoch, _shard, _block, _from, _to): words ``[_from, _to)`` of the row, taken by a slot.
    """
    spark = docs.sparkSession
    names = unclash(docs, ("_doc", "_row", "_size", "_source", "_start"))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")
    # Ties of the id are ordered by a hash of all plain columns; rows that agree in these are alike.
    plain = [f.name for f in names.schema.fields if isinstance(f.dataType, T.AtomicType)]
    sized = store_stage(names.select(*[F.col(f"`{c}`") for c in names.columns if c != "text"], F.col("doc_id").alias("_doc"),
                                     F.xxhash64(*plain).alias("_row"), words.alias("_size")), "sized")
    sizes = [(r["source"], int(r["n"])) for r in sized.groupBy("source").agg(F.sum("_size").alias("n")).collect()]
    planned = plan(spark, sizes, block, weights, most, seed)
    numbers = spark.createDataFrame(
        [(s.source, k) for k, s in enumerate(planned)], "_name string, _source int"
    )
    known = sized.join(numbers, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    laid = store_stage(running_start(known, "_source", "_size", ("_doc", "_row")), "laid")
    spans = laid.where(F.col("_size") > 0).select(
        "_source", "_start", "_size",
        F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_start") + F.col("_size") - 1) / block))).alias("_block"),
    ).withColumns({
        "_low": F.greatest(F.lit(0), F.col("_start") - F.col("_block") * block),
        "_high": F.least(F.lit(block), F.col("_start") + F.col("_size") - F.col("_block") * block),
    })
    # Stored, so that the planner knows their size: they grow with the input.
    drawn = store_stage(slots(spark, planned, block, seed), "slots")
    taken = spans.join(drawn, ["_source", "_block"]).withColumn(
        "_high", F.least("_high", "_cut")
    ).where(F.col("_high") > F.col("_low")).select(
        "_source", "_start", "_epoch", "_shard", "_block",
        (F.col("_block") * block + F.col("_low") - F.col("_start")).alias("_from"), (F.col("_block") * block + F.col("_high") - F.col("_start")).alias("_to"),
    )
    return laid, taken, planned


def mixed_texts(docs: DataFrame, block: int = 512, weights=WEIGHTS, most: float = 3.0, seed: int = 17) -> DataFrame:
    """The mix as rows like ``docs``: one per document, pass and unbroken stretch of words taken in it, ``text`` cut to the stretch, ``n_chars`` its length.

    Further columns come along under any name.
    """
    given = docs.columns
    # Inside, no column of the caller can have the name of a made one.
    inner = [c.lower() if c.lower() in ("doc_id", "text", "source", "n_chars") else f"own_{k}" for k, c in enumerate(given)]
    return _mixed_rows(docs.toDF(*inner), block, weights, most, seed).toDF(*given)


def _mixed_rows(docs: DataFrame, block: int, weights, most: float, seed: int) -> DataFrame:
    laid, taken, _ = mix(docs, block, weights, most, seed)
    stretches = taken.groupBy("_source", "_start", "_epoch").agg(F.sort_array(F.collect_list(F.struct("_from", "_to"))).alias("_spans"))

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        made = []
        for text, own in zip(texts, spans):
            joined: list[list[int]] = []
            for span in own:
                if joined and joined[-1][1] == span["_from"]:
                    joined[-1][1] = span["_to"]
                else:
                    joined.append([span["_from"], span["_to"]])
            places = [m.span() for m in WORD.finditer(text)]
            whole = [0, len(places)]
            made.append([text if s == whole else text[places[s[0]][0]:places[s[1] - 1][1]] for s in joined])
        return pd.Series(made, dtype=object)

    plain = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    texts = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(*plain).alias("_row"), F.col("text").alias("_text")).where(
        F.col("_text").isNotNull()
    ).dropDuplicates(["_doc", "_row"])
    rows = laid.join(stretches, ["_source", "_start"]).where(F.col("_size") > 0)
    rows = rows.join(texts, rows["_doc"].eqNullSafe(texts["_doc"]) & (rows["_row"] == texts["_row"])).withColumn("_cut", F.explode(cut("_text", "_spans")))
    made = {"text": F.col("_cut"), "n_chars": F.length("_cut").cast("long")}
    return rows.select(*[made.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def digest(docs: DataFrame, block: int = 64) -> DataFrame:
    """Words taken per document."""
    laid, taken, planned = mix(docs.select("doc_id", "text", "source"), block)
    totals = taken.groupBy("_source", "_start").agg(F.sum(F.col("_to") - F.col("_from")).alias("taken"))
    # Rows without words share the start of their successor; they take nothing.
    joined = laid.join(totals, ["_source", "_start"], "left").withColumn("taken", F.when(F.col("_size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)))
    about = docs.sparkSession.createDataFrame([(k, s.size, float(s.target)) for k, s in enumerate(planned)], "_source int, source_size long, target double")
    return joined.join(about, "_source").select("doc_id", F.col("_size").alias("size"), "source_size", "target", F.col("taken").cast("long").alias("taken"))
