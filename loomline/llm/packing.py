"""Best-two-fit packing of token pieces into sequences of a fixed length.

1. Texts are tokenized word by word with a bounded cache (the tokenizer never joins words across blanks), documents longer than a sequence are cut.
2. Only the histogram of piece lengths, at most one row per possible length, goes to the driver. Bins are filled greedily, longest piece first; then a
   bin's smallest piece is replaced by two unpacked ones that fit the expanded gap more tightly. A filled bin is a pattern of lengths, used as often as the
   counts allow at once, so the work depends on the number of lengths and not on the number of pieces.
3. Every piece gets its rank among the pieces of its length from bucket sums, and finds its sequence and offset in the list of patterns.

Defined results: a null text is empty; every document ends with the id 0, so an empty one is one piece of length 1. Repeated rows and null ids are packed as
any other. Further columns are not carried along, pieces name their document by doc_id. An empty table gives no piece.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import store_stage
from .common import running_start

CACHE_WORDS = 300_000
PIECE = "doc_id {id}, _row long, piece int, start long, length long, ids_crc32 long"


#: Marks that the tokenizer keeps together behind letters.
MARKS = ".,;:!?#*$%&"


def byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(other)}


class WordTokenizer(dict):
    """Ids of words as little-endian unsigned 32-bit bytes. Two generations of words are kept, so that frequent ones stay."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.older: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        # The short way is taken only with a tokenizer for which it agrees on a probe.
        self.short = True
        probe = ["été", "Straße...", "ñandú,", "ÉCOLE!!", "words###", "ﬁn", "日本語", "ǅ", "İx", "I'm", "a1"]
        self.short = all((self.plain(w) or self.whole(w)) == self.whole(w) for w in probe)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            text = word.decode()
            ids = (self.plain(text) if self.short else None) or self.whole(text)
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, word: str) -> bytes | None:
        """Ids of letters with marks behind them, without the tokenizer's normalizing steps; None if these could matter."""
        stem = word.rstrip(MARKS)
        if not stem.isalpha() or "Σ" in stem or not unicodedata.is_normalized("NFC", stem):
            return None
        low = stem.lower()
        if not low.isalpha():
            return None
        return self.piece(low) + (self.piece(word[len(stem):]) if len(stem) < len(word) else b"")

    def piece(self, low: str) -> bytes:
        ids = self.stems.get(low)
        if ids is None:
            found = self.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(self.letters))
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            if len(self.stems) >= CACHE_WORDS:
                self.stems = {}
            self.stems[low] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per process, so that the tasks of a worker share its words."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str, length: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece; with ``keep_ids`` also the ids, as bytes."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = word_tokenizer(tokenizer).encode
        for part in parts:
            rows = []
            for doc, row, text in zip(part["doc_id"], part["_row"], part["text"]):
                ids = encode(text or "") + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    own = ids[at:at + 4 * length]
                    rows.append((doc, row, k, at // 4, len(own) // 4, zlib.crc32(own), *([own] if keep_ids else [])))
            made = pd.DataFrame(rows, columns=["doc_id", "_row", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])
            yield made.astype({"doc_id": part["doc_id"].dtype})

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", F.xxhash64("text").alias("_row"), "text")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):  # a null among ids must not turn them into doubles
        chosen = chosen.withColumn("doc_id", F.col("doc_id").cast("string"))
        schema = PIECE.format(id="string") + ", ids binary" * keep_ids
        return chosen.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast(kind))
    return chosen.mapInPandas(cut, PIECE.format(id=kind) + ", ids binary" * keep_ids)


def best_pair(lengths: list[int], free: dict[int, int], most: int, least: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum in ``(least, most]``."""
    low, high, best, found = 0, bisect_right(lengths, most) - 1, least, None
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > most or (low == high and free[a] < 2):
            high -= 1
            continue
        if a + b > best:
            best, found = a + b, (a, b)
            if best == most:
                break
        low += 1
    return found


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins) that pack ``counts`` pieces of each length."""
    free = {k: v for k, v in counts.items() if v > 0}
    lengths, made = sorted(free), []
    while lengths:
        used: dict[int, int] = {}
        gap, at = capacity, len(lengths) - 1
        while at >= 0 and gap:
            at = min(at, bisect_right(lengths, gap) - 1)
            if at < 0:
                break
            one = lengths[at]
            used[one] = min(free[one], gap // one)
            gap -= one * used[one]
            at -= 1
        times = min(free[k] // n for k, n in used.items())
        if gap and sum(used.values()) > 1:
            small = min(used)
            left = {k: free[k] - used.get(k, 0) for k in lengths}
            open_ = [k for k in lengths if left[k] > 0 and k <= gap + small]
            pair = best_pair(open_, left, gap + small, small)
            if pair:
                used[small] -= 1
                for k in pair:
                    used[k] = used.get(k, 0) + 1
                used = {k: n for k, n in used.items() if n}
                times = min(free[k] // n for k, n in used.items())
        made.append(([k for k, n in sorted(used.items(), reverse=True) for _ in range(n)], times))
        for k, n in used.items():
            free[k] -= n * times
            if not free[k]:
                del free[k]
                lengths.remove(k)
    return made


def places(made: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks, their sequences and offsets; rank ``first + i`` goes to sequence ``+ i``."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in made:
        offset = 0
        for k in lengths:
            rows.setdefault(k, []).append((taken.get(k, 0), sequence, offset))
            taken[k] = taken.get(k, 0) + times
            offset += k
        sequence += times
    return {k: tuple(np.array(v, np.int64).T) for k, v in rows.items()}


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with ``sequence_id`` and ``offset``; with ``keep_ids`` also ``ids`` (bytes, see ``assemble``)."""
    cut = store_stage(pieces(docs, tokenizer, length, keep_ids), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = docs.sparkSession.sparkContext.broadcast(places(patterns(counts, length)))  # bounded by the number of lengths

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(lengths), 2), np.int64)
        wanted, ranked = lengths.to_numpy(), ranks.to_numpy()
        for k in np.unique(wanted):
            own = wanted == k
            first, sequence, offset = found.value[int(k)]
            at = np.searchsorted(first, ranked[own], side="right") - 1
            out[own, 0], out[own, 1] = sequence[at] + ranked[own] - first[at], offset[at]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    ranked = running_start(cut.withColumns({"_one": F.lit(1), "_doc": F.col("doc_id")}), "length", "_one", ("_doc", "piece", "_row"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    return ranked.withColumn("_place", place("length", "_start")).select(*kept, "_place.sequence_id", "_place.offset")


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences of ``pack(..., keep_ids=True)`` as arrays of ids; a group is at most one sequence."""

    @F.pandas_udf("array<long>")
    def numbers(joined: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in joined])

    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return rows.select("sequence_id", numbers(F.col("_parts.ids")).alias("ids"))


def digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
