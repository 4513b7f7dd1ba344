"""Toxicity by class-conditional Kneser-Ney bigram models.

Both classes share one vocabulary and their back-off counts: a class is the outermost history of an expression, so Kneser-Ney's continuation count of a
word or pair is the number of classes that know it. A class model discounts its own counts and gives the rest to these shared ones, so expressions that
are rare fall back to the same numbers and say little for a class. An expression counts once per document: a text that repeats itself is one witness.
A text's evidence is its log-likelihood ratio per word, over the whole text and over its most toxic window, the latter once more by what at least ``FIRM``
documents hold; a logistic curve over all three, fitted on labelled rows that the counts have not seen, gives the score.

Fitted on a bounded sample: at most ``max_docs`` labelled documents of each class (chosen by a hash of the id, every fifth for the curve), and
the ``MAX_WORDS`` most frequent words; all bigrams of these words in the sample are kept. Every text is scored whole.

Defined results: null and empty texts get the score of no evidence. Labels are taken per doc_id, the largest if there are several; null labels and ids are not
learned from. Without examples of both classes every score is the share of toxic labels (0 if there are none). Repeated rows come back as often as they
came; further columns pass through, and the made columns replace equally named ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..sources.tables import store_stage
from .common import id_remainder, to_pandas, unclash

MAX_WORDS = 2**18
#: Words of a window; documents of an expression and of a history from which they count as firm.
WINDOW = 1
FIRM = 3
#: ASCII punctuation ends words; digits stay.
WORDS = bytes(b if b >= 128 or re.match(r"\w", chr(b)) else 32 for b in range(256)).lower()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(WORDS).split()


def word_hash(word: bytes) -> int:
    """Words are known by 63 bits of their hash, which a sorted array holds in 8 bytes a word."""
    return xxhash.xxh3_64_intdigest(word) >> 1


def word_numbers(words: list[bytes], known: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted hashes, from 1 on; 0 where it is unknown."""
    if not len(known):
        return np.zeros(len(words), np.int64)
    hashes = np.fromiter(map(word_hash, words), np.int64, len(words))
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


@dataclass
class Model:
    """Counts by word number (0: unknown); class 0 is ordinary, class 1 toxic."""

    known: np.ndarray  # sorted hashes of the words
    pair_keys: np.ndarray  # sorted; first word * size + second
    pair_ratio: np.ndarray  # log-likelihood ratio of pairs
    pair_firm: np.ndarray  # whether it is firm
    word_ratio: np.ndarray  # of words after a history without the pair
    history: np.ndarray  # log ratio of the back-off weights of a history
    firm: np.ndarray  # whether a word, and a history, are firm
    weights: np.ndarray  # of the curve
    prior: float

    def ratios(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio of every word after its predecessor, and what of it is firm."""
        ids = word_numbers(words, self.known)
        before = np.concatenate(([0], ids[:-1]))
        single, given = self.word_ratio[ids] + self.history[before], self.word_ratio[ids] * self.firm[0, ids] + self.history[before] * self.firm[1, before]
        if not len(self.pair_keys):
            return single, given
        keys = before * len(self.word_ratio) + ids
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = self.pair_keys[at] == keys
        pair = self.pair_ratio[at]
        return np.where(known, pair, single), np.where(known & self.pair_firm[at], pair, given)

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Mean ratio of the text and of its most toxic window, the latter also by firm ratios."""
        words = words_of(text)
        if not words:
            return 0.0, 0.0, 0.0
        ratios, firm = self.ratios(words)
        wide = min(WINDOW, len(ratios))

        def peak(own: np.ndarray) -> float:
            sums = np.concatenate(([0.0], np.cumsum(own)))
            return float((sums[wide:] - sums[:-wide]).max() / wide)

        return float(ratios.mean()), peak(ratios), peak(firm)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(np.column_stack((np.ones(len(evidence)), evidence)) @ self.weights, -30, 30)))


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Logistic regression by Newton steps, classes weighted to the prior, with a small ridge."""
    x = np.column_stack((np.ones(len(evidence)), evidence))
    share = np.where(toxic == 1, prior / max(1, toxic.sum()), (1 - prior) / max(1, (1 - toxic).sum())) * len(toxic)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - toxic)) + 0.01 * w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(x.shape[1]), gradient)
        w -= np.clip(step, -5, 5)
    return w


def singles(words: pd.DataFrame, size: int, discount: float = 0.75) -> np.ndarray:
    """P(w | c) of both classes. A word's class is its outermost history, so the shared count of a word is the number of classes that know it:
    P(w | c) = (n_c(w) - D + D K_c S(w)) / N_c with S(w) the shared counts' share.
    """
    n = np.zeros((2, size))
    n[:, words["w"]] = words[["n0", "n1"]].to_numpy(float).T
    classes = (n > 0).sum(axis=0)
    total, kinds = np.maximum(1.0, n.sum(axis=1)), np.maximum(1, (n > 0).sum(axis=1))
    shared = np.maximum(classes, 0.5) / max(1, classes.sum())
    return (np.maximum(n - discount, 0) + discount * kinds[:, None] * shared) / total[:, None]


@dataclass
class Histories:
    """Counts of what follows each word, by class: ``seen`` in all, ``types`` of it; ``span`` is the number of types in both."""

    seen: np.ndarray
    types: np.ndarray
    span: np.ndarray

    @staticmethod
    def of(after: pd.DataFrame, size: int) -> Histories:
        seen, types, span = np.zeros((2, size)), np.zeros((2, size)), np.ones(size)
        seen[:, after["v"]], types[:, after["v"]], span[after["v"]] = after[["n0", "n1"]].to_numpy(float).T, after[["t0", "t1"]].to_numpy(float).T, after["t"]
        return Histories(seen, types, span)

    @property
    def firm(self) -> np.ndarray:
        return (self.seen >= FIRM).all(axis=0)

    def backoff(self, discount: float = 0.75) -> np.ndarray:
        """Weight of the shared counts after each history; a class that never saw it has nothing else."""
        return np.where(self.seen > 0, discount * self.types / np.maximum(1.0, self.seen), 1.0)

    def pair_ratios(self, pairs: pd.DataFrame, single: np.ndarray, discount: float = 0.75) -> np.ndarray:
        """Log-likelihood ratios of pairs:
        P(w | v, c) = (n_c(vw) - D) / n_c(v) + B_c(v) Q(w | v, c), where Q discounts the shared counts of pairs once more and gives the rest to P(w | c).
        """
        size = len(self.span)
        key, both = pairs["key"].to_numpy(np.int64), pairs[["n0", "n1"]].to_numpy(float).T
        first, second = key // size, key % size
        pooled = ((both > 0).sum(axis=0) - 0.5 + 0.5 * self.span[first] * single[:, second]) / np.maximum(1.0, self.types[:, first].sum(axis=0))
        given = np.maximum(both - discount, 0) / np.maximum(1.0, self.seen[:, first]) + self.backoff(discount)[:, first] * pooled
        return np.log(given[1] / given[0])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int = 12_000) -> Model:
    spark = docs.sparkSession
    marks = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    marks = store_stage(marks, "marks")
    sizes = {r["_toxic"]: r["count"] for r in marks.groupBy("_toxic").count().collect()}
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    flat = np.array([np.log((prior + 1e-9) / (1 - prior + 1e-9)), 0.0, 0.0, 0.0])
    empty = Model(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros(1), np.zeros(1), np.zeros((2, 1), bool), flat, prior)
    if min(sizes.get(0, 0), sizes.get(1, 0)) < 5:
        return empty
    order = Window.partitionBy("_toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    # A limit per class first: only max_docs ids of each meet in one task.
    first = [marks.where(F.col("_toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs) for c in sizes]
    drawn = reduce(DataFrame.unionByName, first).withColumn("_rank", F.row_number().over(order))
    # At most 2 * max_docs ids.
    sample = store_stage(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").withColumn("_probe", F.col("_rank") % 5 == 0), "sample")
    learned = sample.where(~F.col("_probe")).select("text", "_toxic")

    def count_words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            n: Counter = Counter()
            for text in part["text"]:
                n.update(set(words_of(text)))
            yield pd.DataFrame({"word": pd.Series([word_hash(w) for w in n], dtype="int64"), "n": pd.Series(list(n.values()), dtype="int64")})

    vocabulary = learned.mapInPandas(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    vocabulary = vocabulary.orderBy(F.desc("n"), "word").limit(MAX_WORDS - 1).select("word").toArrow().column("word").to_numpy()
    numbers = np.sort(vocabulary)
    size = len(numbers) + 1
    shared = spark.sparkContext.broadcast(numbers)

    def count_pairs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 500):
                rows = part.iloc[at:at + 500]
                for c, texts in rows["text"].groupby((rows["_toxic"] > 0).astype(int)):
                    keys = []
                    for text in texts:
                        ids = np.concatenate(([0], word_numbers(words_of(text), shared.value)))
                        keys.append(np.unique(ids[:-1] * size + ids[1:]))
                    key, n = np.unique(np.concatenate(keys), return_counts=True)
                    yield pd.DataFrame({"key": key, "n0": n * (c == 0), "n1": n * (c == 1)})

    def count_docs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            n = np.zeros((2, size), np.int64)
            for text, toxic in zip(part["text"], part["_toxic"]):
                n[int(toxic > 0), np.unique(word_numbers(words_of(text), shared.value))] += 1
            w = np.nonzero(n.any(axis=0))[0]
            yield pd.DataFrame({"w": w, "n0": n[0, w], "n1": n[1, w]})

    pairs = learned.mapInPandas(count_pairs, "key long, n0 long, n1 long").groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    pairs = store_stage(pairs, "pairs")
    v, w = F.floor(F.col("key") / size).cast("long").alias("v"), (F.col("key") % size).alias("w")
    sums = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1")]
    types = [F.sum((F.col(f"n{c}") > 0).cast("long")).alias(f"t{c}") for c in (0, 1)]
    words = to_pandas(learned.mapInPandas(count_docs, "w int, n0 long, n1 long").groupBy("w").agg(*sums))
    after = to_pandas(pairs.groupBy(v).agg(*sums, *types, F.count(F.lit(1)).alias("t")))
    single, histories = singles(words, size), Histories.of(after, size)
    counted = spark.sparkContext.broadcast((single, histories))

    def price(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single, histories = counted.value
        for part in parts:
            firm = (part["n0"] + part["n1"] >= FIRM).to_numpy() & histories.firm[part["key"].to_numpy() // size]
            yield pd.DataFrame({"key": part["key"], "ratio": histories.pair_ratios(part, single).astype(np.float32), "firm": firm})

    # All pairs of the bounded sample, as 13 bytes each.
    kept = pairs.where((F.col("key") >= size) & (w > 0)).mapInPandas(price, "key long, ratio float, firm boolean").toArrow()
    keys, ratios, firm = (kept.column(c).to_numpy() for c in ("key", "ratio", "firm"))
    order = np.argsort(keys)
    word_ratio, (back0, back1) = np.log(single[1] / single[0]), histories.backoff()
    word_ratio[0] = 0.0
    often = np.zeros(size, bool)
    often[words["w"]] = words["n0"] + words["n1"] >= FIRM
    model = Model(
        numbers, keys[order], ratios[order], firm[order], word_ratio, np.log(back1 / back0), np.stack((often, histories.firm)), empty.weights, prior
    )
    probe = to_pandas(with_evidence(sample.where("_probe"), model).select("_toxic", "_evidence.mean", "_evidence.peak", "_evidence.firm"))
    if probe["_toxic"].nunique() == 2:
        model.weights = fit_curve(probe[["mean", "peak", "firm"]].to_numpy(float), (probe["_toxic"].to_numpy() > 0).astype(float), prior)
    return model


def with_evidence(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("mean double, peak double, firm double, score double")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = np.array([shared.value.evidence(t) for t in part], float).reshape(-1, 3)
            yield pd.DataFrame({"mean": found[:, 0], "peak": found[:, 1], "firm": found[:, 2], "score": shared.value.score(found)})

    return docs.withColumn("_evidence", measure("text"))


def classify(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    docs = unclash(docs, ("score", "predicted", "_evidence"))
    score = F.col("_evidence.score")
    return with_evidence(docs, model).select(
        *[F.col(f"`{c}`") for c in docs.columns], score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted")
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, id_remainder(3) != 1)
    return classify(docs.select("doc_id", "text", (id_remainder(3) == 1).alias("held_out")), model).select("doc_id", "held_out", "score", "predicted")
