"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of a text (shares of upper case, symbols, digits, separators, repeated words and so on) are Column expressions over the whole text.
2. A small forest is fitted on a bounded sample of labelled rows. Every path from a root to a node below it is a conjunction of conditions on statistics:
   a rule.
3. A lasso logistic regression over the rules' outcomes keeps a few of them with weights.
4. The kept rules and weights are compiled into one Column expression, which scores every row inside the JVM.

The sample holds at most ``max_rows`` labelled rows, chosen by a hash of the id. Every text is scored whole.

Defined results: null and empty texts have the statistics of an empty text and get a score like any other. Labels are taken per doc_id, the largest if there
are several; null labels and ids are not learned from. If all labels agree, or there are none, every score is the share of good labels (0.5 if none). Further
columns pass through; the made columns replace equally named ones.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import store_stage
from .common import BLANKS, free_name, id_remainder, squash, unclash

#: Statistics by name; a text's words are split once, lengths are of whole texts.
STATISTICS = (
    "log_chars", "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "mark_share", "bar_share", "punctuation_share",
    "next_repeat_share", "distinct_share", "line_words", "distinct_line_share",
)


@dataclass(frozen=True)
class Rule:
    """Conditions ``(statistic, above, threshold)``; the rule holds where all do."""

    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self, value) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.conditions:
            out = out & ((value(name) > threshold) if above else (value(name) <= threshold))
        return out


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float


def statistics(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of the statistics of ``text``."""
    words, lines = free_name(docs, "_words"), free_name(docs, "_lines")
    text = F.coalesce("text", F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))

    def without(pattern_free: Column) -> Column:
        return (F.length(text) - F.length(pattern_free)) / chars

    w, n = F.col(words), F.greatest(F.size(words), F.lit(1))
    upper = without(F.regexp_replace(text, "\\p{Lu}+", ""))
    repeats = F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))
    in_words = F.length(F.translate(text, BLANKS, ""))
    values = {
        "log_chars": F.log1p(F.length(text)),
        "log_words": F.log1p(F.size(words)),
        "word_length": in_words / n,
        "upper_share": upper,
        "digit_share": without(F.translate(text, "0123456789", "")),
        "symbol_share": without(F.translate(text, "#*$%&<>@^~_=+\\", "")),
        "mark_share": without(F.translate(text, "!?", "")),
        "bar_share": without(F.translate(text, "|{}[]/", "")),
        "punctuation_share": without(F.translate(text, ".,;:", "")),
        "next_repeat_share": repeats / n,
        # By logarithms, since the plain share falls with the length of any text.
        "distinct_share": F.log1p(F.size(F.array_distinct(w))) / F.log1p(n),
        "line_words": F.size(words) / F.greatest(F.size(lines), F.lit(1)),
        "distinct_line_share": F.size(F.array_distinct(F.col(lines))) / F.greatest(F.size(lines), F.lit(1)),
    }
    split = docs.withColumns({
        words: F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != ""),
        lines: F.filter(F.split(text, "\n"), lambda x: F.length(x) > 0),
    })
    return split.withColumn(name, F.struct(*[values[s].cast("double").alias(s) for s in STATISTICS])).drop(words, lines)


BRANCH = re.compile(r"^( +)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(forest: str, names: tuple[str, ...]) -> list[Rule]:
    """All paths from the roots to the nodes below, as rules, from a forest's printed form (one line per branch, indented by depth)."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, str, bool, float]] = []
    for line in forest.splitlines():
        found = BRANCH.match(line)
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(found[2])], found[3] == ">", float(found[4]))]
        tight: dict[tuple[str, bool], float] = {}
        for _, name, above, threshold in path:  # conditions on the same side of a statistic become one
            old = tight.get((name, above), threshold)
            tight[name, above] = max(old, threshold) if above else min(old, threshold)
        rules[Rule(tuple(sorted((name, above, t) for (name, above), t in tight.items())))] = None
    return list(rules)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = 12_000, trees: int = 12, depth: int = 3, penalty: float = 0.002) -> Ensemble:
    spark = docs.sparkSession
    marks = labels.where(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("double").alias("_label"))
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    measured = statistics(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), "_stats")  # at most max_rows ids
    sample = store_stage(measured.select("_label", "_stats.*"), "sample").coalesce(4)
    share, kinds = sample.agg(F.avg("_label"), F.countDistinct("_label")).first()
    if kinds != 2:
        return Ensemble((), 30.0 if share == 1 else -30.0 if share == 0 else 0.0)

    x = store_stage(sample.select("_label", array_to_vector(F.array(*STATISTICS)).alias("features")), "features").coalesce(4)
    forest = RandomForestClassifier(
        labelCol="_label", numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="0.5", subsamplingRate=0.7, minInstancesPerNode=5, seed=5
    ).fit(x)
    rules = tree_rules(forest.toDebugString, STATISTICS)
    if not rules:
        return Ensemble((), math.log(share / (1 - share)))
    hits = sample.select("_label", array_to_vector(F.array(*[r.holds(F.col).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(labelCol="_label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100, tol=1e-5)
    found = lasso.fit(store_stage(hits, "hits").coalesce(4))
    kept = tuple((rule, float(weight)) for rule, weight in zip(rules, found.coefficients.toArray()) if weight)
    return Ensemble(kept, float(found.intercept))


def score(model: Ensemble, stats: str) -> Column:
    """The ensemble as one expression over the statistics."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total = total + F.when(rule.holds(lambda name: F.col(f"`{stats}`.{name}")), F.lit(weight)).otherwise(F.lit(0.0))
    return squash(total)


def classify(docs: DataFrame, model: Ensemble, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    docs = unclash(docs, ("score", "predicted"))
    stats = free_name(docs, "_stats")
    return statistics(docs, stats).withColumn("score", score(model, stats)).select(
        *[F.col(f"`{c}`") for c in docs.columns], "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, id_remainder(4) != 2)
    return classify(docs.select("doc_id", "text", (id_remainder(4) == 2).alias("held_out")), model).select("doc_id", "held_out", "score", "predicted")
