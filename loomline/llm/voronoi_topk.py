"""Exact top-k inner products by a Voronoi join.

1. Vectors become integers. Pivots are drawn from a bounded sample; every row belongs to the cell of its nearest pivot (Euclidean).
2. Summaries: a query's k-th best score is at least its k-th best score among the sample's rows of other ids; a query group keeps the smallest such bound, its largest norm
   and its largest product with each pivot.
3. A row x of cell j can only matter to group i if ``max q.p_j + max|q| * |x - p_j|`` (and ``max|q| * |x|``) reaches the group's bound; other groups never
   see it. Groups hold a bounded number of queries: crowded cells are split.
4. What is sent to a group is dealt over chunks of bounded size; each chunk is solved by a matrix product and returns the k best per query, and the
   chunks' winners are ranked once more.

Defined results: rows whose vector is null or has a null, non-finite or unrepresentable component take no part. Shorter vectors count as filled up with zeros.
Rows with the query's vec_id are the query itself; rows with a null id are candidates of no one. Query rows with one id are one query (the smallest vector
counts), repeated candidate rows are ranked one by one. Scores beyond 64 bits are cut to the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..sources.tables import store_stage

SAMPLE = 2_048
#: Queries of a group and rows of a chunk, at most about so many.
GROUP = 512
CHUNK = 16_384
EXACT = 2.0**53


def matrix(cells: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(cells), dims))
    for k, cell in enumerate(cells):
        own = np.frombuffer(cell, np.float64)
        out[k, :len(own)] = own
    return out


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, cell): floor(scale * x) of each component as bytes of whole doubles."""

    def convert(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            ids, cells = [], []
            for vec_id, vector in zip(part["vec_id"], part["embedding"]):
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(scale * np.asarray(vector, np.float64))
                if np.isfinite(whole).all():
                    ids.append(vec_id)
                    cells.append(whole.tobytes())
            yield pd.DataFrame({"vec_id": pd.Series(ids, dtype="int64"), "cell": pd.Series(cells, dtype=object)})

    told = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull()))
    return told.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInPandas(
        convert, "vec_id long, cell binary"
    )


@dataclass
class Pivots:
    """Sampled rows; the first ``cells`` of them are pivots of the data, the first ``groups`` pivots of the queries."""

    rows: np.ndarray
    ids: np.ndarray
    cells: int
    groups: int

    def nearest(self, x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        p = self.rows[:count]
        square = np.maximum(0.0, (x * x).sum(1)[:, None] - 2.0 * x @ p.T + (p * p).sum(1)[None, :])
        cell = square.argmin(1)
        # Rounding may only make the distance larger than it is.
        return cell, np.sqrt(square[np.arange(len(x)), cell]) * (1 + 1e-9) + 1e-3


def solve(q: pd.DataFrame, x: pd.DataFrame, dims: int, k: int) -> pd.DataFrame:
    """The k best rows of ``x`` for each query, ties to the smaller id."""
    empty = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="int64")})
    if not len(q) or not len(x):
        return empty
    x = x.sort_values("vec_id")
    ids, a, b = x["vec_id"].to_numpy(), matrix(q["cell"], dims), matrix(x["cell"], dims)
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, dims)
    if largest < EXACT:
        scores = (a @ b.T).astype(np.int64)
    else:
        whole = np.vectorize(int, otypes=[object])
        scores = np.clip(whole(a).dot(whole(b).T) if dims else np.zeros((len(a), len(b)), object), -(2**63), 2**63 - 1).astype(np.int64)
    made = []
    for row, query in enumerate(q["query_id"]):
        own = scores[row]
        open_ = np.nonzero(ids != query)[0]
        if len(open_) > k:
            least = np.partition(own[open_], len(open_) - k)[len(open_) - k]
            open_ = open_[own[open_] >= least]
        best = open_[np.lexsort((ids[open_], -own[open_].astype(object) if own.min(initial=0) == -(2**63) else -own[open_]))][:k]
        made.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": own[best]}))
    return pd.concat([empty, *made]) if made else empty


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows where ``is_query`` holds, against all rows."""
    spark = vectors.sparkSession
    rows = store_stage(integers(vectors, scale), "vectors")
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("cell").alias("cell"))
    count, longest = rows.agg(F.count(F.lit(1)), F.max(F.length("cell"))).first()
    asked, dims = queries.count(), (longest or 0) // 8
    drawn = rows.sample(False, min(1.0, 1.2 * SAMPLE / max(1, count)), 9).limit(SAMPLE).toPandas()
    drawn = drawn.iloc[np.random.default_rng(9).permutation(len(drawn))]
    sample = matrix(drawn["cell"], dims)
    pivots = spark.sparkContext.broadcast(
        Pivots(sample, drawn["vec_id"].to_numpy(np.int64), min(len(sample), max(1, int(count**0.5) // 4), 256), min(len(sample), max(1, -(-asked // GROUP)), 256))
    )

    def summarise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pivots.value
        for part in parts:
            q = matrix(part["cell"], dims)
            group, _ = p.nearest(q, p.groups)
            norm = np.sqrt((q * q).sum(1))
            scores = q @ p.rows.T
            # Any number of the sample's rows may have the query's id.
            others = np.where(part["query_id"].to_numpy()[:, None] == p.ids[None, :], -np.inf, scores)
            bound = np.partition(others, -k, axis=1)[:, -k] if len(p.rows) >= k else np.full(len(q), -np.inf)
            for i in np.unique(group):
                own = group == i
                yield pd.DataFrame({
                    "i": i, "n": own.sum(), "least": bound[own].min(), "norm": norm[own].max(), "j": np.arange(p.cells), "most": scores[own][:, :p.cells].max(0),
                })

    # At most 256 x 256 rows.
    told = queries.mapInPandas(summarise, "i int, n long, least double, norm double, j int, most double").groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("norm").alias("norm"), F.max("most").alias("most")
    ).toPandas()
    if not len(told):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    p = pivots.value
    by_group = told.drop_duplicates("i").set_index("i").reindex(range(p.groups))
    most = np.full((p.groups, p.cells), -np.inf)
    most[told["i"], told["j"]] = told["most"]
    blocks = np.maximum(0, -(-by_group["n"].fillna(0).to_numpy().astype(np.int64) // GROUP))
    chunks = max(1, -(-count // CHUNK))
    bounds = spark.sparkContext.broadcast((most, by_group["norm"].fillna(0).to_numpy(), by_group["least"].fillna(np.inf).to_numpy(), blocks))

    def send_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, (most, norms, least, blocks) = pivots.value, bounds.value
        for part in parts:
            x = matrix(part["cell"], dims)
            cell, far = p.nearest(x, p.cells)
            size = np.sqrt((x * x).sum(1)) * (1 + 1e-9)
            chunk = pd.util.hash_array(part["vec_id"].to_numpy()) % np.uint64(chunks)
            for i in np.nonzero(blocks)[0]:
                reach = np.minimum(most[i, cell] + norms[i] * far, norms[i] * size)
                own = reach * (1 + np.sign(reach) * 1e-9) + 1e-3 >= least[i]
                for block in range(blocks[i]):
                    yield pd.DataFrame({"i": i, "block": block, "chunk": chunk[own].astype(np.int64), "vec_id": part["vec_id"][own], "cell": part["cell"][own]})

    def send_queries(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, blocks = pivots.value, bounds.value[3]
        for part in parts:
            group, _ = p.nearest(matrix(part["cell"], dims), p.groups)
            block = (pd.util.hash_array(part["query_id"].to_numpy()) % blocks[group].astype(np.uint64)).astype(np.int64)
            for chunk in range(chunks):
                yield pd.DataFrame({"i": group, "block": block, "chunk": chunk, "query_id": part["query_id"], "cell": part["cell"]})

    key = ["i", "block", "chunk"]
    sent_q = queries.mapInPandas(send_queries, "i int, block int, chunk long, query_id long, cell binary")
    sent_x = rows.mapInPandas(send_rows, "i int, block int, chunk long, vec_id long, cell binary")
    found = sent_q.groupBy(*key).cogroup(sent_x.groupBy(*key)).applyInPandas(
        lambda q, x: solve(q, x, dims, k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % 100 == 0)


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
