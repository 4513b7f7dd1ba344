"""Language identification by cross-parsing entropy.

A suffix automaton of a language's sample text accepts exactly its substrings. A text is parsed by each automaton into longest matches, phrase after phrase;
few phrases mean that the text is cheap to describe by that language: phrases * log2(sample size) / length estimates the cross entropy, and the
cheapest language wins. Texts are parsed whole, as UTF-8 bytes of their lower-cased letters (so any script works), in segments of ``SEGMENT`` bytes;
a phrase ends where its segment ends. Segments of many texts step through an automaton together, as arrays.

The automata are fitted on a bounded sample: of each language at most ``max_docs`` documents, chosen by a hash of the id, and at most ``sample_bytes`` bytes,
taken in equal shares from places that a hash of the id draws over the whole text. Stretches that the sample has already are left out, and what they
leave free goes to further text of the same documents. Every document is scored.

Defined results: ``und`` and score 0 for null texts, texts without a letter, or when nothing could be learned. Ties go to the smaller language by code point.
Repeated rows come back as often as they came; further columns pass through, and the made columns replace equally named ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import free_name, id_remainder, unclash

SEGMENT = 512
#: Segments that step together.
WIDTH = 8192
#: Bytes of the shortest stretch that counts as repeated, of the shortest one that is kept between two such, and shares drawn for each that is needed.
REPEAT = 24
STUB = 8
DRAWN = 4
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def letters(text: str | None) -> bytes:
    """Lower-cased letters, everything else between ASCII ones as one blank; empty if there is no letter at all."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split())


class Automaton:
    """Suffix automaton as a table: ``table[state + symbol]`` is the next state, its complement where a new phrase begins. States are row offsets."""

    def __init__(self, sample: bytes):
        step: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in sample:
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        # Symbol 0 stands for bytes that the sample lacks (and for the document ends inside it): a phrase of its own, after which comes the last state,
        # where any byte begins a phrase.
        used = sorted(set(sample) - {0})
        self.bits = float(np.log2(max(2, len(sample))))
        self.symbol = np.zeros(256, np.int32)
        self.symbol[used] = np.arange(1, len(used) + 1)
        wide = len(used) + 1
        afresh = np.full(wide, len(step) * wide, np.int32)
        for c, to in step[0].items():
            if c:
                afresh[self.symbol[c]] = to * wide
        table = np.tile(~afresh, (len(step) + 1, 1))
        table[0] = afresh
        for state, ways in enumerate(step):
            for c, to in ways.items():
                if c:
                    table[state, self.symbol[c]] = to * wide
        self.table = table.reshape(-1)

    def breaks(self, columns: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrase ends inside each segment; ``columns[t, k]`` is byte t of segment k, ``active[t]`` how many segments are that long."""
        state, count = np.zeros(columns.shape[1], np.int32), np.zeros(columns.shape[1], np.int32)
        for t, n in enumerate(active.tolist()):
            to = self.table[state[:n] + self.symbol[columns[t, :n]]]
            sign = to >> 31
            state[:n] = to ^ sign
            count[:n] -= sign
        return count


def parse(texts: list[bytes], automata: list[Automaton]) -> np.ndarray:
    """Phrases of each text by each automaton."""
    phrases = np.zeros((len(texts), len(automata)), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(texts) else sizes
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first[owner] + nth * SEGMENT
    size = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
    joined = np.frombuffer(b"".join(texts) + bytes(SEGMENT), np.uint8)
    for at in range(0, len(owner), WIDTH):
        part = np.arange(at, min(at + WIDTH, len(owner)))
        part = part[np.argsort(-size[part], kind="stable")]
        columns = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(joined, SEGMENT)[start[part]].T)
        active = np.searchsorted(-size[part], -np.arange(SEGMENT), side="left")
        active = active[active > 0]
        for k, automaton in enumerate(automata):
            np.add.at(phrases[:, k], owner[part], automaton.breaks(columns, active) + 1)
    return phrases


def fresh(part: bytes, seen: set[bytes]) -> list[bytes]:
    """The stretches of a text that are not in ``seen``, which learns them."""
    old, at = [], 0
    for k in range(len(part) - REPEAT + 1):
        gram = part[k:k + REPEAT]
        if gram in seen:
            if old and k <= old[-1][1]:
                old[-1][1] = k + REPEAT
            else:
                old.append([k, k + REPEAT])
        seen.add(gram)
    kept = []
    for start, stop in (*old, [len(part), len(part)]):
        if start - at >= STUB or not old:
            kept.append(part[at:start])
        at = stop
    return kept


def joined_sample(parts: list[bytes], share: int, sample_bytes: int) -> bytes:
    """A language's sample: ``share`` new bytes of each part, then more of them while there is room."""
    seen: set[bytes] = set()
    first, spare = [], []
    for part in parts:
        room = share
        for stretch in fresh(part, seen):
            first.append(stretch[:room])
            spare.append(stretch[room:])
            room -= len(first[-1])
    return b"\0".join(s for s in (*first, *spare) if s)[:sample_bytes]


def fit(docs: DataFrame, learn: Column, max_docs: int = 400, sample_bytes: int = 49_152) -> dict[str, Automaton]:
    """Automata by language, from a bounded sample of the rows where ``learn`` holds."""
    ranked = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", "doc_id").withColumn(
        "_rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    ).where(F.col("_rank") <= max_docs).withColumn("_draw", F.pmod(F.xxhash64(F.lit("place"), "doc_id", F.xxhash64("text")), F.lit(2**62)))

    def shorten(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for lang, text, rank, draw in zip(part["lang"], part["text"], part["_rank"], part["_draw"]):
                own = letters(text)
                spare = max(0, len(own) - sample_bytes)
                at = draw % (spare + 1)
                rows.append((lang, int(rank), int(draw), own[at:at + sample_bytes]))
            yield pd.DataFrame(rows, columns=["lang", "_rank", "_draw", "_part"])

    drawn: dict[str, tuple[int, list[bytes]]] = {}
    shortened = ranked.mapInPandas(shorten, "lang string, _rank int, _draw long, _part binary").where(F.length("_part") > 0)
    # Equal shares: the first pass learns how many documents a language has, the second sends only their share.
    many = Window.partitionBy("lang")
    share = F.greatest(F.lit(64), F.ceil(sample_bytes / F.count(F.lit(1)).over(many))).cast("int")
    wide = F.least(DRAWN * F.col("_share"), F.length("_part"))
    # A second place is drawn within the first: together they lie anywhere in the text.
    at = F.pmod(F.xxhash64("_draw"), F.length("_part") - wide + 1).cast("int") + 1
    parts = shortened.withColumn("_share", share).select("lang", "_rank", "_share", F.substring("_part", at, wide).alias("_part"))
    for row in parts.orderBy("lang", "_rank").collect():
        drawn.setdefault(row["lang"], (row["_share"], []))[1].append(bytes(row["_part"]))
    return {lang: Automaton(joined_sample(parts, share, sample_bytes)) for lang, (share, parts) in drawn.items()}


def identify(docs: DataFrame, automata: dict[str, Automaton]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the runner-up's share of the cost of both."""
    docs = unclash(docs, ("lang_pred", "score"))
    names = sorted(automata, key=lambda s: s.encode("utf-32-be", "surrogatepass"))
    shared = docs.sparkSession.sparkContext.broadcast([automata[n] for n in names])  # bounded by the sample

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits = np.array([a.bits for a in shared.value])
        for part in texts:
            own = [letters(t) for t in part]
            label, score = np.full(len(own), "und", object), np.zeros(len(own))
            told = np.array([bool(t) for t in own], bool)
            if names and told.any():
                cost = parse([t for t in own if t], shared.value) * bits
                best = cost.argmin(axis=1)
                label[told] = np.array(names, object)[best]
                if len(names) > 1:
                    two = np.partition(cost, 1, axis=1)[:, :2]
                    score[told] = two[:, 1] / two.sum(axis=1)
                else:
                    score[told] = 1.0
            yield pd.DataFrame({"lang_pred": label, "score": score})

    made = free_name(docs, "_made")
    return docs.withColumn(made, predict("text")).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(f"`{made}`.lang_pred").alias("lang_pred"), F.col(f"`{made}`.score").alias("score")
    )


def digest(docs: DataFrame) -> DataFrame:
    held_out = id_remainder(5) == 0
    automata = fit(docs, ~held_out)
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), automata).select("doc_id", "held_out", "lang_pred", "score")
