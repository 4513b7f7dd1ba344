"""Line dedup: lines that many documents hold stay in one of them.

Normalised lines are exploded and hashed, the distinct documents of each hash are counted, lines over the threshold are dropped and what stays is put
together again by position. Only 128-bit line hashes and document ids are shuffled for the counts; the text itself is shuffled once, to meet the
dropped hashes of its document, and a document's lines never leave its row.

Defined results: a null or empty text is one empty line and stays as it is (null stays null). Rows with the same doc_id are one document for the
counts; null ids together are one document, smaller than all others. Of a frequent line, every row of the largest doc_id keeps all its copies.
Further columns pass through; columns named like the made ones are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import store_stage
from .common import BLANKS, NO_ID, free_name, unclash

#: Tasks over which the documents of one line are spread.
SALTS = 16


def line_key(line: str) -> str:
    """Blanks stripped at both ends, A-Z lower-cased; other letters as they are."""
    line = line.strip(BLANKS)
    return line.lower() if line.isascii() else line.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def key_hash(line: str, min_chars: int) -> bytes | None:
    if len(line) < min_chars:
        return None
    key = line_key(line)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")) if len(key) >= min_chars else None


def frequent_lines(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(all keys per document, frequent keys with the document that keeps them)."""

    def keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            ids, found = [], []
            for doc, text in zip(part["_doc"], part["_text"]):
                own = {key_hash(line, min_chars) for line in text.split("\n")}
                own.discard(None)
                ids.extend([doc] * len(own))
                found.extend(own)
            yield pd.DataFrame({"_doc": pd.Series(ids, dtype="int64"), "_key": pd.Series(found, dtype=object)})

    held = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"), F.coalesce("text", F.lit("")).alias("_text")
    ).mapInPandas(keys, "_doc long, _key binary")
    held = store_stage(held, "keys")
    counted = held.groupBy("_key").agg(F.countDistinct("_doc").alias("_docs"), F.max("_doc").alias("_keeper"))
    return held, counted.where(F.col("_docs") >= min_docs).select("_key", "_keeper")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and ``n_lines`` (before) and ``n_dropped`` added."""
    docs = unclash(docs, ("n_lines", "n_dropped"))
    held, frequent = frequent_lines(docs, min_chars, min_docs)
    # A line that very many documents hold meets its keeper in several tasks.
    salted = frequent.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    drops = (
        held.withColumn("_salt", F.pmod(F.xxhash64("_doc"), F.lit(SALTS)).cast("int")).join(salted, ["_key", "_salt"])
        .where(F.col("_doc") != F.col("_keeper")).groupBy("_doc").agg(F.collect_set("_key").alias("_drop"))
    )
    owner, drop = free_name(docs, "_owner"), free_name(docs, "_drop")
    joined = docs.withColumn(owner, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).join(
        drops.select(F.col("_doc").alias(owner), F.col("_drop").alias(drop)), owner, "left"
    ).select(*[F.col(f"`{c}`") for c in docs.columns], drop)

    def cut(text: str | None, dropped) -> tuple[str | None, int, int]:
        lines = (text or "").split("\n")
        if dropped is None or not len(dropped):
            return text, len(lines), 0
        gone = {bytes(k) for k in dropped}
        kept = [line for line in lines if key_hash(line, min_chars) not in gone]
        return "\n".join(kept), len(lines), len(lines) - len(kept)

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut_lines(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(t, d) for t, d in zip(texts, dropped)], columns=["text", "n_lines", "n_dropped"])

    done = free_name(docs, "_cut")
    return joined.withColumn(done, cut_lines("text", drop)).select(
        *[F.col(f"`{done}`.text").alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col(f"`{done}`.n_lines").alias("n_lines"), F.col(f"`{done}`.n_dropped").alias("n_dropped"),
    )


def digest(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The query's columns: line counts and the hash of the kept text."""
    return dedup_lines(docs, min_chars, min_docs).select(
        F.col("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast(T.BinaryType()), 256).alias("kept_sha256")
    )


SQL = """
with lines as (
  select row_id, doc_id, pos, line, lower_key as key from (
    select row_id, doc_id, pos, line,
      translate(trim(line, E' \\t\\n\\x0B\\x0C\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_key
    from (
      select row_id, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos
      from (select row_number() over () as row_id, doc_id, string_split(coalesce(text, ''), E'\\n') as parts from documents)
    )
  )
), frequent as (
  select key, max(doc_id) as keeper from lines where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
  select l.*, f.key is not null and l.doc_id <> f.keeper as gone from lines l left join frequent f on l.key = f.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, E'\\n' order by pos) filter (where not gone), '')) as kept_sha256
from marked group by row_id, doc_id
"""
