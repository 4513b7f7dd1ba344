"""Filter interaction audit: what each of several filters removes in every order of applying them.

1. A task computes the failed text filters of a row as bits and a 128-bit digest of its text. Equal texts fail equally, so rows are counted per (digest,
   part, doc_id) first and per (digest, part, labels) next, both with map-side combine: a group of copies of any size becomes a few rows before it meets
   its smallest id.
2. What is left of the table is a weight per (part, failure mask, ...), at most ``2 ** filters`` rows a part.
3. Masks as a matrix of 0 (fails) and infinity (passes) and the inverse permutations as a matrix of positions give, by a min-plus product, the removal step
   of every mask in every order. Weights are scattered onto (order, removal step); a mask that fails a filter at a later position than its removal step is
   redundant there.

Defined results: a null text is empty and equals other empty texts. A null doc_id is neither smaller nor larger than another, so such rows never fail the
filter on copies and nothing is a copy of them. Rows that repeat with one doc_id are counted each, and none is a copy of the other. Label rows that repeat
are one, 1 winning; a doc without a label is neither good nor toxic. Null and empty ``lang`` are one part. Further columns are ignored. An empty
table gives no part and so no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
CAPITALS = bytes(range(65, 91))
SIGNS = b"#$%&*|"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: str | None) -> int:
    """Bits of the filters A to D that a text fails."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    few = len(words) < 100
    repeated = 100 * len(set(words)) < 80 * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 10 * len(text)
    signs = len(raw) > len(raw.translate(None, SIGNS))
    return few + 2 * repeated + 4 * loud + 8 * signs


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows and labelled rows of each failure mask; bit k of a mask stands for filter k."""

    def look(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part["text"].where(part["text"].notna(), "")
            yield pd.DataFrame({
                "doc_id": part["doc_id"], "part": part["part"], "mask": texts.map(text_failures).astype("int32"),
                "digest": texts.map(lambda t: xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass"))),
            })

    # Ids travel as text: a null among whole numbers would make doubles of them in pandas.
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    looked = rows.mapInPandas(look, "doc_id string, part string, mask int, digest binary")
    held = looked.withColumn("doc_id", F.col("doc_id").cast("long")).groupBy("digest", "part", "doc_id", "mask").agg(F.count(F.lit(1)).alias("n"))

    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = held.join(marks.where(F.col("doc_id").isNotNull()), "doc_id", "left").withColumns({k: F.coalesce(k, F.lit(0)) for k in ("good", "toxic")})
    groups = marked.groupBy("digest", "part", "good", "toxic", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))).alias("with_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    lowest = groups.groupBy("digest").agg(F.min("first.doc_id").alias("lowest"))
    both = groups.join(lowest, "digest")
    originals = F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    copies = F.coalesce(F.col("with_id") - originals, F.lit(0))
    split = both.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - copies).alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), copies.alias("n")),
    )).alias("own"))
    n = F.col("own.n")
    return split.groupBy("part", F.col("own.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    )


def removal_ranks(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, ranks): the position of each filter in each order, and the removal step of each mask in each order (``filters + 1``: never)."""
    orders = np.array(list(permutations(range(filters))))
    positions = np.argsort(orders, axis=1) + 1
    fails = np.arange(2**filters)[:, None] >> np.arange(filters) & 1
    cost = np.where(fails == 1, 0, filters + 1)
    ranks = np.minimum((cost[:, None, :] + positions[None]).min(axis=2), filters + 1)
    return positions, ranks


def interactions(part: str, masks: np.ndarray, weights: np.ndarray, names: str) -> pd.DataFrame:
    """All orders and steps of one part; ``weights`` has the columns rows, good rows, toxic rows."""
    filters = len(names)
    positions, ranks = removal_ranks(filters)
    orders, steps = len(positions), np.arange(1, filters + 1)
    at = ranks[masks]  # (mask, order)
    lost = np.zeros((orders, filters + 2, 3), np.int64)
    np.add.at(lost, (np.arange(orders)[None], at), weights[:, None, :])
    order = np.argsort(positions, axis=1)  # the filter at each step
    fails = (masks[:, None] >> np.arange(filters) & 1).astype(np.int64)
    redundant = np.stack([(weights[:, :1] * fails[:, order[:, s - 1]] * (at < s)).sum(axis=0) for s in steps], axis=1)
    alone = np.array([weights[masks == 1 << k, 0].sum() for k in range(filters)], np.int64)
    removed = lost[:, 1:filters + 1, 0]
    shapley = np.zeros(filters, np.int64)
    np.add.at(shapley, order, removed)
    flat = {
        "kept": weights[:, 0].sum() - removed.cumsum(axis=1), "removed": removed, "redundant": redundant, "unique_fails": alone[order],
        "good_lost": lost[:, 1:filters + 1, 1], "toxic_lost": lost[:, 1:filters + 1, 2], "shapley": shapley[order],
    }
    spelled = ["".join(names[k] for k in row) for row in order]
    return pd.DataFrame({
        "part": part, "filter_order": np.repeat(spelled, filters), "step": np.tile(steps, orders).astype("int32"),
        **{k: v.reshape(-1).astype("int64") for k, v in flat.items()},
    })


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return interactions(key[0], rows["mask"].to_numpy(np.int64), rows[["n", "good", "toxic"]].to_numpy(np.int64), FILTERS)

    schema = "part string, filter_order string, step int, " + ", ".join(f"{k} long" for k in COUNTS)
    return failures(docs, labels).groupBy("part").applyInPandas(solve, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(docs, labels)


SQL = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), first_ids as (
  select text, min(doc_id) as lowest from d group by text
), marks as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), fails as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    list_filter(list_value(
      case when len(words) < 100 then 'A' end,
      case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' end,
      case when 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text) then 'C' end,
      case when regexp_matches(d.text, '[#$%&*|]') then 'D' end,
      case when d.doc_id > lowest then 'E' end), lambda f: f is not null) as failed
  from d join first_ids using (text) left join marks using (doc_id)
), weights as (
  select part, failed, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from fails group by part, failed
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as f
), orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letters a join letters b on b.f <> a.f join letters c on c.f not in (a.f, b.f) join letters d on d.f not in (a.f, b.f, c.f)
  join letters e on e.f not in (a.f, b.f, c.f, d.f)
), removal as (
  select filter_order, part, failed, n, good, toxic, coalesce(list_min(list_transform(failed, lambda f: instr(filter_order, f))), 6) as gone_at
  from weights, orders
), steps as (
  select filter_order, step, substr(filter_order, step, 1) as f from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), counted as (
  select part, filter_order, step, s.f,
    sum(n) filter (where gone_at > step) as kept, sum(n) filter (where gone_at = step) as removed,
    sum(n) filter (where list_contains(failed, s.f) and gone_at < step) as redundant,
    sum(n) filter (where failed = [s.f]) as unique_fails,
    sum(good) filter (where gone_at = step) as good_lost, sum(toxic) filter (where gone_at = step) as toxic_lost
  from steps s join removal using (filter_order) group by part, filter_order, step, s.f
)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
  coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from counted
"""
