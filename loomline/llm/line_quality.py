"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per document: counts that the base rules use, computed inside its row. Per host (``source``): lines are normalised and hashed, the distinct documents of
each line are counted, and lines in more documents than the host's limit are removed from the text. A document that the base rules pass is still rejected
when the removal depletes it. Hashes of lines are shuffled for the counts, and a host of any size is spread over its lines; a text is shuffled once,
to meet the keys of its removed lines.

Defined results: a null or empty text has no words and fails the base rules; it stays as it is. Lines without a word are never removed, the others leave
with their line break, and base counts are those of the text as it came. Null sources are one host. Rows with the same doc_id are one document for
the line counts (null ids together are one); every row gets its own verdict. Further columns pass through; columns named like the made ones are
replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, NO_ID, free_name, unclash

SYMBOLS = "#*$%&|<>"
MADE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def words_of(text: Column) -> Column:
    """Words as an array; text without words gives an empty one."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: inside a lambda, a column expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more.

    Windows are hashed; where all differ, nothing more is done. Otherwise (hash, place) pairs are sorted, so that equal windows are neighbours, and the
    places they cover are counted once.
    """
    count = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), count - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(pairs: Column) -> Column:
        marked = F.filter(
            pairs, lambda p, k: F.coalesce(F.get(pairs, k - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(pairs, k + 1)["h"] == p["h"], F.lit(False))
        )
        return F.size(F.array_distinct(F.flatten(F.transform(marked, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2)))))

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(pairs, covered))

    return F.when(count < 4, F.lit(0)).otherwise(bound(windows, counted))


def normal_line(line: Column) -> Column:
    """Lower case, no blanks at the ends."""
    return F.lower(F.btrim(line, F.lit(BLANKS)))


def line_key(line: Column, host: Column) -> Column:
    return F.xxhash64(normal_line(line), host)


def base_counts(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    symbols_left = F.translate(text, SYMBOLS, "")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(symbols_left)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeat_words(words).cast("long"),
    }


def judge(
    docs: DataFrame, host: str = "source", min_docs: int = 20, host_share: float = 0.0,
    min_words: int = 50, max_repeat_percent: int = 50, min_left_percent: int = 50,
) -> DataFrame:
    """``docs`` without the removed lines of ``text``, with base counts, ``base_failed``, ``n_removed_words`` and ``kept``.

    A line in more than ``min_docs`` documents of a host is removed, however large the host is; with ``host_share`` it must also be in more than that share of
    the host's documents. A document is depleted when fewer than ``min_words`` words or under ``min_left_percent`` of its words are left.
    """
    docs = unclash(docs, MADE)
    names = {n: free_name(docs, f"_{n}") for n in ("words", "lines", "row", "host", "doc", "gone", "left")}
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(names["doc"]),
        F.xxhash64("doc_id", "text", host).alias(names["row"]),
        F.xxhash64(host).alias(names["host"]),
    )

    has_word = f"[^{''.join(f'\\x{ord(c):02X}' for c in BLANKS)}]"
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(has_word))
    word_list = words_of(text)
    # Both arrays are named first: each expression above is then computed once per row.
    staged = marked.withColumns({names["words"]: word_list, names["lines"]: lines})
    counted = staged.withColumns(base_counts(text, F.col(names["words"]), F.col(names["lines"]))).drop(names["words"], names["lines"])

    held = marked.select(
        F.col(names["doc"]).alias("_doc"), F.col(names["row"]).alias("_row"), F.col(names["host"]).alias("_host"),
        F.explode(lines).alias("_line"),
    ).select("_doc", "_row", line_key(F.col("_line"), F.col("_host")).alias("_key"), "_host")
    common = held.groupBy("_host", "_key").agg(F.countDistinct("_doc").alias("_docs")).where(F.col("_docs") > min_docs)
    if host_share:
        sizes = marked.groupBy(F.col(names["host"]).alias("_host")).agg(F.countDistinct(names["doc"]).alias("_host_docs"))
        common = common.join(sizes, "_host").where(F.col("_docs") > F.col("_host_docs") * host_share)
    common = common.select("_key")
    removed = held.join(common, "_key").groupBy("_doc", "_row").agg(F.collect_set("_key").alias("_gone"))

    out = counted.join(
        removed.withColumnsRenamed({"_doc": names["doc"], "_row": names["row"], "_gone": names["gone"]}), [names["doc"], names["row"]], "left"
    )
    gone = F.col(names["gone"])
    stays = F.filter(F.split("text", "\n"), lambda x: ~x.rlike(has_word) | ~F.array_contains(gone, line_key(x, F.col(names["host"]))))
    cleaned = F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    out = out.withColumn(names["left"], cleaned)
    out = out.withColumn("n_removed_words", F.when(gone.isNull(), F.lit(0)).otherwise(F.col("n_words") - F.size(words_of(F.col(names["left"])))).cast("long"))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return out.select(
        *[F.col(names["left"]).alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns], *MADE[:5], failed.alias("base_failed"),
        (~failed & (left >= min_words) & (100 * left >= min_left_percent * F.col("n_words"))).alias("kept"), "n_removed_words",
    )


def digest(docs: DataFrame) -> DataFrame:
    judged = judge(docs.select("doc_id", "text", "source"))
    return judged.select("doc_id", *MADE)


SQL = """
with docs as (
  select row_number() over () as row_id, doc_id, coalesce(text, '') as text, source,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
    string_split(coalesce(text, ''), E'\\n') as parts
  from documents
), lines as (
  select row_id, doc_id, source, line, lower(trim(line, E' \\t\\n\\x0B\\x0C\\r')) as key,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as n
  from (select row_id, doc_id, source, unnest(parts) as line from docs)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), common as (
  select source, key from lines group by source, key having count(distinct doc_id) > 20
), removed as (
  select l.row_id, sum(n) as n from lines l join common c on l.key = c.key and l.source is not distinct from c.source group by l.row_id
), dups as (
  select row_id, count(*) - count(distinct line) as n from lines group by row_id
), tokens as (
  select row_id, unnest(words) as w, generate_subscripts(words, 1) as i from docs
), windows as (
  select row_id, i, w, lead(w, 1) over (partition by row_id order by i) as w2, lead(w, 2) over (partition by row_id order by i) as w3 from tokens
), twice as (
  select row_id, i from (select row_id, i, count(*) over (partition by row_id, w, w2, w3) as n from windows where w3 is not null) where n > 1
), covered as (
  select row_id, count(distinct i + d) as n from twice, (values (0), (1), (2)) as t(d) group by row_id
), base as (
  select d.doc_id, len(d.words) as n_words, length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(u.n, 0) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
    coalesce(r.n, 0) as n_removed_words
  from docs d left join dups u on d.row_id = u.row_id left join covered c on d.row_id = c.row_id left join removed r on d.row_id = r.row_id
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and n_words - n_removed_words >= 50 and 100 * (n_words - n_removed_words) >= 50 * n_words as kept,
  cast(n_removed_words as bigint) as n_removed_words
from judged
"""
