"""MinHash links, token alignment and the filter audit against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loomline.llm import filter_audit, minhash, token_align

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None) for i, t, lang in rows], SCHEMA)


def plain_words(text):
    return (text or "").encode().split()


# -- MinHash -------------------------------------------------------------------


def shingles(text):
    words = plain_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def linked(rows):
    sets = [shingles(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, *_) in enumerate(rows):
        low[find(k)].append(i)
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [x for x in low[find(k)] if x is not None]
        component = (min(ids) if ids else None) if sets[k] else i
        out.append((i, len(sets[k]), component, i == component))
    return sorted(out, key=str)


def near_rows(seed: int, templates: int, copies: int):
    """Copies of templates with some words replaced, so that similarities lie on both sides of the threshold."""
    draw = random.Random(seed)
    rows = []
    for t in range(templates):
        words = [f"t{t}w{draw.randrange(400)}" for _ in range(draw.choice((9, 40, 150)))]
        for _ in range(copies):
            own = list(words)
            for _ in range(draw.randrange(max(2, len(own) // 14))):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(own), "en"))
    return rows


def test_minhash_links(spark):
    rows = near_rows(1, 12, 20)
    long = " ".join(f"w{k % 9000}" for k in range(20_000))
    rows += [(2000, long, "en"), (2001, long.upper() + " end", "en"), (2002, None, "en"), (2003, "", None), (2004, " \n\t", "fr"), (2005, "One two", "en")]
    rows += [(2006, "one\ttwo ", "en"), (2006, "one two", "en"), (2007, "other", "en"), (None, "one two", "en"), (None, "alone here", "en"), (None, None, None)]
    docs = documents(spark, rows)
    got = [tuple(r) for r in minhash.digest(docs.repartition(3)).collect()]
    expected = linked(rows)
    keep = {(r[0], r[1]): r for r in expected if r[0] is not None}
    assert sorted((r for r in got if r[0] is not None), key=str) == [r for r in expected if r[0] is not None], keep
    # Rows without an id: named by their component where it has an id, kept where it has none.
    assert Counter(r[1:] for r in got if r[0] is None) == Counter([(1, 2005, False), (1, None, True), (0, None, True)])
    assert minhash.digest(docs.limit(0)).count() == 0
    clash = docs.where("doc_id > 1999").withColumns({"Print": F.lit(1), "kept": F.lit("x"), "row": F.lit(2), "signature": F.lit(3)})
    assert minhash.digest(clash).count() == 9


def test_minhash_chunks_lose_no_link(spark, monkeypatch):
    # Chunks of four points: buckets are cut, and every link between chunks counts.
    monkeypatch.setattr(minhash, "CHUNK", 4)
    rows = near_rows(2, 2, 60)
    got = sorted((tuple(r) for r in minhash.digest(documents(spark, rows)).collect()), key=str)
    assert got == linked(rows)


def test_signatures_estimate_the_similarity():
    functions = minhash.universal(160)
    draw = np.random.default_rng(3)
    words = draw.integers(0, 2**63, 1000, np.uint64)
    a, b = np.unique(words[:900]), np.unique(words[100:])
    same = (np.frombuffer(minhash.signature(a, functions), "<u4") == np.frombuffer(minhash.signature(b, functions), "<u4")).mean()
    assert abs(same - 0.8) < 0.12
    assert minhash.alike(a, b, 0.8) and not minhash.alike(a, b[1:], 0.8)  # 800 of 1000, and 799 or less
    assert minhash.least_agreement(0.8, 160) == 105


# -- token alignment -------------------------------------------------------------


def aligned_plainly(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    from loomline.llm.packing import byte_letters

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {chr(c): b for b, c in byte_letters().items()}
    per, total, held = [], Counter(), defaultdict(set)
    for n, (doc, text, _) in enumerate(rows):
        a = whole.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        spelled_a = [bytes(letters[c] for c in whole.id_to_token(i)) for i in a]
        spelled_b = [bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, piece.id_to_piece(i)) for i in b)]
        if not text or b"".join(spelled_a) != f" {text}".encode() or b"".join(spelled_b) != f" {text}".encode():
            per.append((doc, None))
            continue
        owner_a = [k for k, s in enumerate(spelled_a) for _ in s]
        owner_b = [k for k, s in enumerate(spelled_b) for _ in s]
        pairs = sorted(set(zip(owner_a, owner_b)))
        links = [(a[i], b[j]) for i, j in pairs]
        groups, group = [], ([], [])
        for at in range(len(owner_a)):
            end_a, end_b = (at + 1 == len(o) or o[at + 1] != o[at] for o in (owner_a, owner_b))
            if end_a:
                group[0].append(str(a[owner_a[at]]))
            if end_b:
                group[1].append(str(b[owner_b[at]]))
            if end_a and end_b:
                groups.append(",".join(group[0]) + "|" + ",".join(group[1]))
                group = ([], [])
        total.update(links)
        for p in links:
            held[p].add(n)
        per.append((doc, (len(a), len(b), len(groups), links, ";".join(groups))))
    top: dict[int, int] = defaultdict(int)
    for (_, b), n in total.items():
        top[b] = max(top[b], n)
    out = []
    for doc, own in per:
        if own is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            na, nb, ng, links, text = own
            best = sum(total[p] == top[p[1]] for p in links)
            out.append((doc, na, nb, ng, len(links), best, sum(total[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, total, {p: len(d) for p, d in held.items()}


def token_rows():
    rows = [(k, t, "en") for k, t in enumerate([
        "The cat sat on the mat.", "the the the the the the", "  two  spaces\tand\na line  ", "naïve café — 日本語 مرحبا 🤦🏼‍♂️", "a▁b", "<|endoftext|> <s> </s> <0x41>",
        "x\x00y", "'s't're 12345 !!!???", "\r\n\r\n", " ", "Aa" * 300, "ﬁ ½ ² ﷺ", "tab\there", "é é", "​﻿ zero",
    ])]
    rows += [(40, None, "en"), (41, "", "en"), (42, "the cat", None), (42, "the cat", None), (None, "the mat", "en"), (None, None, None)]
    draw = random.Random(5)
    rows += [(50 + k, " ".join(draw.choice(("the", "of", "naïve", "Zzyzx", "1,5", "wörld", "under_score", "…")) for _ in range(draw.randrange(400))), "en") for k in range(20)]
    return [*rows, (99, "long words and more " * 12_000 + " " * 3_000 + "end", "en")]


def test_token_alignment(spark, monkeypatch):
    rows = token_rows()
    expected, total, held = aligned_plainly(rows)
    docs = documents(spark, rows)
    got = [tuple(r) for r in token_align.digest(docs.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    # Blocks of few entries and few documents: counts add up over blocks.
    monkeypatch.setattr(token_align, "SLICE", 300)
    monkeypatch.setattr(token_align, "BLOCK_ENTRIES", 100)
    stage = token_align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), keep_groups=True)
    assert stage.where("bits is not null").select("block").distinct().count() > 5
    pairs = token_align.pair_counts(stage, 32_000)
    assert {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"]) for r in pairs.collect()} == {p: (held[p], n) for p, n in total.items()}
    scored = token_align.score(stage, pairs).collect()
    assert sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in scored), key=str) == sorted(expected, key=str)
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in scored if r["groups"])
    assert token_align.digest(docs.limit(0)).count() == 0
    clash = docs.where("doc_id < 3").withColumns({"block": F.lit("x"), "Pair": F.lit(1), "low": F.lit(None).cast("int"), "n_a": F.lit(2)})
    assert token_align.digest(clash).count() == 3


@pytest.mark.parametrize("size", [1, 5, 4096, 4097, 65_536])
def test_planes_round_trip(size):
    draw = np.random.default_rng(size)
    lows = np.sort(draw.choice(65_536, size, replace=False)).astype(np.uint16)
    times = draw.integers(1, 70_000, size)
    bits = token_align.to_planes(lows, times)
    back = np.zeros(65_536, np.int64)
    for bit, own in token_align.planes(bits):
        back[own] += 1 << bit
    assert (back[lows] == times).all() and back.sum() == times.sum()
    assert token_align.popcounts(bits) == (size, times.sum())


def test_the_short_encoding_agrees_with_the_whole_one():
    own = token_align.ByteTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.ranked is not None
    draw = random.Random(8)
    for _ in range(300):
        text = "".join(chr(draw.choice((draw.randrange(32, 127), draw.randrange(0x250), draw.randrange(0x3000), draw.randrange(0x10000, 0x1FFFF)))) for _ in range(40))
        assert own.encode(text) == own.exact(text)


# -- filter audit -------------------------------------------------------------------


def audited_plainly(rows, marks):
    def fails(i, text):
        text = text or ""
        words = plain_words(text)
        capitals = sum("A" <= c <= "Z" for c in text)
        copy = i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows)
        return (("A" if len(words) < 100 else "") + ("B" if 100 * len(set(words)) < 80 * len(words) else "") + ("C" if 100 * capitals > 10 * len(text) else "")
                + ("D" if set(text) & set("#$%&*|") else "") + ("E" if copy else ""))

    parts = defaultdict(list)
    for i, text, lang in rows:
        own = marks.get(i, (0, 0)) if i is not None else (0, 0)
        parts[lang or ""].append((fails(i, text), *own))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(docs)
            earlier: list = []
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[0] for d in earlier), sum(d[0] == f for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                earlier += gone
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark):
    draw = random.Random(4)
    rows = []
    for k in range(120):
        words = [draw.choice(("aa", "Bb", "CC")) + str(draw.randrange(draw.choice((5, 500)))) for _ in range(draw.choice((3, 99, 100, 140)))]
        rows.append((k, " ".join(words) + draw.choice(("", "", " #", " |")), draw.choice(("en", "fr", None, ""))))
    rows += [(200 + k, rows[k % 9][1], draw.choice(("en", "fr"))) for k in range(40)]
    rows += [(5, rows[5][1], "de"), (5, rows[5][1], "de"), (None, rows[5][1], "en"), (None, None, "en"), (300, None, "en"), (301, "", "en"), (302, "É" * 10 + "AB", "fr")]
    rows += [(303, "w " * 200_000, "en")]
    marks = {i: (draw.randrange(2), draw.randrange(2)) for i in range(0, 310, 2)}
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in marks.items()] + [(2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    got = filter_audit.digest(docs.repartition(5), labels)
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in got.collect()}
    assert found == audited_plainly(rows, marks)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert filter_audit.digest(docs.limit(0), labels).count() == 0
    clash = docs.withColumns({"part": F.lit("x"), "Mask": F.lit(1), "good": F.lit(1), "n": F.lit(2)})
    assert filter_audit.digest(clash, labels.limit(0)).count() == 600 * 4
