"""Alignment of two tokenizers over a corpus, by inverted bitmaps of token pairs.

1. A task encodes its texts with both tokenizers, cuts them where both have a token end, and finds the links: pairs of tokens whose byte ranges overlap.
   Between two neighbouring ends of either tokenizer lies exactly one link.
2. Documents are numbered within blocks of a bounded number of links. Per pair and block a compressed bitmap names the documents that hold the pair: plane k
   has those whose number of links has bit k set. A plane is a list of 16-bit numbers or, where that is shorter, 65,536 bits.
3. Per pair the planes of a block are OR-merged and popcounted for its documents, and popcounted plane by plane for its links; sums over blocks are
   combined on the map side.
4. Scores go back through the postings: (pair, block) meets the pair's score, a block's scores meet its bitmaps, and each bitmap adds the score to its
   documents. Bitmaps are shuffled once, by block; the rows that meet a very common pair hold two numbers.

Defined results: null and empty texts, and texts that one of the tokenizers does not spell byte by byte, have no tokens. Rows with equal or null ids are
documents of their own, and equal texts count each. Further columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import store_stage
from .packing import byte_letters

#: Documents of a block are numbered with 16 bits; a block ends early at this many (document, pair) entries.
BLOCK_DOCS = 65_536
BLOCK_ENTRIES = 4_000_000
#: Characters of text that are encoded together.
SLICE = 250_000
#: Numbers of a plane from which on plain bits are shorter.
LISTED = 4_096
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STAGE = (
    "block long, low int, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pair long, bits binary"
)
DOC_COLUMNS = ("block", "low", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")


class ByteTokenizer:
    """A byte-level BPE file. Where its ids follow its merges, the same BPE runs on ranks, which is several times as fast."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = {chr(c): b for b, c in byte_letters().items()}
        spelled = {id_: bytes(letters[c] for c in piece) for piece, id_ in model["vocab"].items() if all(c in letters for c in piece)}
        self.bytes_of = [spelled.get(k, b"") for k in range(max(self.whole.get_vocab_size(), max(spelled) + 1))]
        self.ranked = self.by_rank(model, spelled)

    def by_rank(self, model: dict, spelled: dict[int, bytes]):
        """The encoding by ranks, or None where ids are not in the order of the merges or a probe differs."""
        import tiktoken

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"].get("".join(m)) for m in merges]
        ranks = {b: k for k, b in spelled.items() if k < 256 + len(merges)}
        if ids != list(range(256, 256 + len(merges))) or len(ranks) != 256 + len(merges):
            return None
        found = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        probes = [" It's 12 o'clock,  we'LL  go\n\n\tnow!!", " été Straße ñandú 日本語 مرحبا हिन्दी ½²", " <|endoftext|> x\u0085y z", "  \r\n ", " " + "ab" * 300]
        return found if all(found.encode_ordinary(p) == self.exact(p) for p in probes) else None

    def exact(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        # Very long runs of blanks are beyond the pattern engine of the short way.
        if self.ranked is None or len(text) > 10_000 and LONG_BLANKS.search(text):
            return self.exact(text)
        return self.ranked.encode_ordinary(text)


LONG_BLANKS = re.compile(r"\s{2000}")


class PieceTokenizer:
    """A sentencepiece file; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [self.spelling(k) for k in range(self.model.get_piece_size())]

    def spelling(self, k: int) -> bytes:
        if self.model.is_byte(k):
            return bytes([int(self.model.id_to_piece(k)[3:5], 16)])
        if self.model.is_control(k) or self.model.is_unknown(k):
            return b""
        return self.model.id_to_piece(k).replace("▁", " ").encode()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers with their tables of byte lengths and of decimal ids for the text of groups."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        self.b_ids = len(self.b.bytes_of)
        # Text of id and separator: id 2k within a group, 2k + 1 at the end of a group's side.
        self.spelled = [s for k in range(len(self.a.bytes_of)) for s in (f"{k},", f"{k}|")] + [s for k in range(self.b_ids) for s in (f"{k},", f"{k};")]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text by both tokenizers; None where the text has no tokens."""
        found = []
        for text, b in zip(texts, self.b.encode_all(texts)):
            raw = b" " + text.encode("utf-8", "surrogatepass")
            a = self.a.encode(" " + text) if text else []
            same = text and b"".join(map(self.b.bytes_of.__getitem__, b)) == raw
            # Byte-level BPE by ranks gives back what it was given; the lengths tell whether its pattern left something out.
            if same and self.a.ranked is None:
                same = b"".join(map(self.a.bytes_of.__getitem__, a)) == raw
            found.append((np.array(a, np.int64), np.array(b, np.int64)) if same and self.a_sizes[a].sum() == len(raw) else None)
        return found

    def links(self, texts: list[str], keep_groups: bool) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """(row per text, [text, pair] of distinct links, their numbers). A row has n_a, n_b, n_groups, n_links, sha256 and text of the groups."""
        found = self.tokens(texts)
        rows: list[tuple] = [(0, 0, 0, 0, "", "" if keep_groups else None)] * len(texts)
        own = [k for k, f in enumerate(found) if f]
        if not own:
            return rows, np.empty((2, 0), np.int64), np.empty(0, np.int64)
        a_ids, b_ids = (np.concatenate([found[k][side] for k in own]) for side in (0, 1))
        n_a, n_b = (np.array([len(found[k][side]) for k in own], np.int64) for side in (0, 1))
        # Both sides spell the same bytes, so ends over all texts of the slice are comparable.
        a_ends, b_ends = self.a_sizes[a_ids].cumsum(), self.b_sizes[b_ids].cumsum()
        text_ends = a_ends[n_a.cumsum() - 1]
        merged = np.concatenate((a_ends, b_ends))
        merged.sort(kind="stable")  # two runs in order
        again = merged[1:] == merged[:-1]
        ends, common = merged[np.append(~again, True)], merged[1:][again]
        linked_a, linked_b = a_ids[np.searchsorted(a_ends, ends)], b_ids[np.searchsorted(b_ends, ends)]
        of_text = np.searchsorted(text_ends, ends)
        n_links = np.bincount(of_text, minlength=len(own))
        n_groups = np.bincount(np.searchsorted(text_ends, common), minlength=len(own))

        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        names = np.concatenate((2 * a_ids + (common[a_group] == a_ends), 2 * (len(self.a.bytes_of) + b_ids) + (common[b_group] == b_ends)))
        order = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
        words = list(map(self.spelled.__getitem__, names[order].tolist()))
        at = 0
        for k, na, nb, groups, links in zip(own, n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist()):
            text = "".join(words[at:at + na + nb])[:-1]
            at += na + nb
            rows[k] = (na, nb, groups, links, hashlib.sha256(text.encode()).hexdigest(), text if keep_groups else None)

        pairs = len(self.a.bytes_of) * self.b_ids
        every = of_text * pairs + linked_a * self.b_ids + linked_b
        every.sort()
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        keys, times = every[first], np.diff(np.append(first, len(every)))
        return rows, np.stack((np.array(own, np.int64)[keys // pairs], keys % pairs)), times


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per process."""
    return Aligner(a_path, b_path)


def plane_bytes(lows: np.ndarray) -> bytes:
    """Sorted 16-bit numbers as a plane: their count less one, then the numbers or 65,536 bits."""
    head = (len(lows) - 1).to_bytes(2, "little")
    if len(lows) <= LISTED:
        return head + lows.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, bool)
    bits[lows] = True
    return head + np.packbits(bits, bitorder="little").tobytes()


def to_planes(lows: np.ndarray, times: np.ndarray) -> bytes:
    """Planes of a pair's documents in a block, lowest bit first: each its bit number and ``plane_bytes``."""
    made, bit = [], 0
    while (times >> bit).any():
        own = lows[times >> bit & 1 == 1]
        if len(own):
            made.append(bytes([bit]) + plane_bytes(own))
        bit += 1
    return b"".join(made)


def planes(bits: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(bit, numbers of the documents) of each plane."""
    at = 0
    while at < len(bits):
        bit, count = bits[at], int.from_bytes(bits[at + 1:at + 3], "little") + 1
        at += 3
        if count <= LISTED:
            yield bit, np.frombuffer(bits, "<u2", count, at)
            at += 2 * count
        else:
            yield bit, np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8, BLOCK_DOCS // 8, at), bitorder="little"))[0]
            at += BLOCK_DOCS // 8


def popcounts(bits: bytes) -> tuple[int, int]:
    """(documents, links): of the planes OR-merged, and of each plane by its weight."""
    own = list(planes(bits))
    links = sum(len(lows) << bit for bit, lows in own)
    if len(own) == 1:
        return len(own[0][1]), links
    if sum(len(lows) for _, lows in own) <= LISTED:
        return len(np.unique(np.concatenate([lows for _, lows in own]))), links
    merged = np.zeros(BLOCK_DOCS, bool)
    for _, lows in own:
        merged[lows] = True
    return int(merged.sum()), links


class Postings:
    """Entries of the block at hand."""

    def __init__(self):
        self.entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, pairs: np.ndarray, lows: np.ndarray, times: np.ndarray) -> None:
        self.entries.append((pairs, lows.astype(np.uint16), times.astype(np.int32)))
        self.count += len(pairs)

    def rows(self, block: int) -> Iterator[pd.DataFrame]:
        if not self.count:
            return
        pairs, lows, times = (np.concatenate([e[k] for e in self.entries]) for k in range(3))
        self.__init__()
        order = np.argsort(pairs << 16 | lows)
        pairs, lows, times = pairs[order], lows[order], times[order]
        starts = np.concatenate(([0], np.nonzero(np.diff(pairs))[0] + 1))
        single = np.logical_and.reduceat(times == 1, starts)
        ends = np.append(starts[1:], len(pairs))
        raw = lows.astype("<u2").tobytes()
        # Most pairs are met once per document: one plane of few numbers, cut out of the bytes at hand.
        cut = [
            b"\0" + (e - s - 1).to_bytes(2, "little") + raw[2 * s:2 * e] if one and e - s <= LISTED else to_planes(lows[s:e], times[s:e])
            for s, e, one in zip(starts.tolist(), ends.tolist(), single.tolist())
        ]
        found = pairs[starts]
        for at in range(0, len(cut), 50_000):
            yield pd.DataFrame({"block": block, "pair": found[at:at + 50_000], "bits": cut[at:at + 50_000]})


def align(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """The stored alignment: rows of documents (``DOC_COLUMNS``) and rows of postings (block, pair, bits); pair is ``a * (ids of B) + b``."""

    columns = [c.split()[0] for c in STAGE.split(", ")]

    def shaped(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({c: frame[c].astype(object) if c in frame else pd.Series([None] * len(frame), dtype=object) for c in columns})

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, block, low, held = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, 0, Postings()
        for part in parts:
            ids, texts = part["doc_id"].tolist(), part["text"].tolist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < SLICE and low + end - at < BLOCK_DOCS:
                    size += len(texts[end] or "")
                    end += 1
                rows, (of, pairs), times = own.links([t or "" for t in texts[at:end]], keep_groups)
                frame = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"])
                yield shaped(frame.assign(block=block, low=np.arange(low, low + len(rows)), doc_id=ids[at:end]))
                held.add(pairs, low + of, times)
                low, at = low + len(rows), end
                if held.count >= BLOCK_ENTRIES or low >= BLOCK_DOCS:
                    yield from map(shaped, held.rows(block))
                    block, low = block + 1, 0
        yield from map(shaped, held.rows(block))

    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text"))
    return store_stage(chosen.mapInPandas(encode, STAGE), "alignment")


def postings(aligned: DataFrame) -> DataFrame:
    return aligned.where(F.col("pair").isNotNull()).select("block", "pair", "bits")


def pair_counts(aligned: DataFrame, b_ids: int) -> DataFrame:
    """(pair, a_id, b_id, n_docs, n_links, best): documents and links of each pair; best where no pair of its B id has more links."""

    @F.pandas_udf("n_docs long, n_links long")
    def counts(bits: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([popcounts(b) for b in bits], columns=["n_docs", "n_links"])

    counted = postings(aligned).select("pair", counts("bits").alias("n")).groupBy("pair").agg(
        F.sum("n.n_docs").alias("n_docs"), F.sum("n.n_links").alias("n_links")
    )
    named = store_stage(counted.withColumns({"a_id": F.floor(F.col("pair") / b_ids).cast("int"), "b_id": (F.col("pair") % b_ids).cast("int")}), "pairs")
    top = named.groupBy("b_id").agg(F.max("n_links").alias("top"))
    return named.join(top, "b_id").select("pair", "a_id", "b_id", "n_docs", "n_links", (F.col("n_links") == F.col("top")).alias("best"))


def score(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of documents with ``n_best`` and ``count_sum``, summed over their links by way of the postings."""

    def back(bitmaps: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
        bitmaps, scores = bitmaps.sort_values("pair"), scores.sort_values("key")
        n_best, count_sum = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
        for bits, count, best in zip(bitmaps["bits"], scores["n_links"].tolist(), scores["best"].tolist()):
            for bit, lows in planes(bits):
                count_sum[lows] += count << bit
                if best:
                    n_best[lows] += 1 << bit
        lows = np.nonzero(count_sum)[0]
        return pd.DataFrame({"block": bitmaps["block"].iloc[0], "low": lows, "n_best": n_best[lows], "count_sum": count_sum[lows]})

    bitmaps = postings(aligned)
    scores = bitmaps.select(F.col("block").alias("of"), F.col("pair").alias("key")).join(
        pairs.select(F.col("pair").alias("key"), "n_links", "best"), "key"
    )
    sums = bitmaps.groupBy("block").cogroup(scores.groupBy("of")).applyInPandas(back, "block long, low int, n_best long, count_sum long")
    rows = aligned.where(F.col("pair").isNull()).select(*DOC_COLUMNS)
    none = {k: F.coalesce(k, F.lit(0)) for k in ("n_best", "count_sum")}
    return rows.join(sums, ["block", "low"], "left").withColumns(none).withColumn("doc_id", F.col("doc_id").cast("long"))


def digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    import sentencepiece

    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = align(docs, a_path, b_path)
    b_ids = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    scored = score(aligned, pair_counts(aligned, b_ids))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
