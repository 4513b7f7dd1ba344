"""Packing, mixing, top-k and the pipeline against brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from loomline.llm import mixing, packing, voronoi_topk
from loomline.sources.tables import store_stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TOKENS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], SCHEMA)


def mixed_rows():
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 900, rng.integers(1, 400))), f"s{k % 5}" if k % 3 else "s0") for k in range(150)]
    return rows + [(200, None, "s1"), (201, "", None), (202, "only null source \n words", None), (None, "no id", "s2"), (7, rows[7][1], rows[7][2]),
                   (203, " ".join(["long"] * 9000), "s3")]


def test_word_tokenizer_agrees_with_the_whole_way():
    plain = Tokenizer.from_file(TOKENS)
    texts = ["I'm don't'll ＡＢ １２３ 3.14 ΣΑΣ  ΑΣ", "á ́b  x<|endoftext|>y <|startoftext|>", "\x1c a\x1cb \x85 c d　e", "x​z İI ǅ", "  ", "",
             "Straße... ñandú, ÉCOLE!! words### ﬁn 日本語 a1 x²", "a\x0bb\x0cc\x00d", "ab</w> </w>"]
    own = packing.WordTokenizer(TOKENS)
    assert [own.encode(t) for t in texts] == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_packing(spark):
    rows = mixed_rows()
    docs = documents(spark, rows)
    plain = Tokenizer.from_file(TOKENS)
    packed = packing.pack(docs.withColumn("ids", F.lit(1)), TOKENS, 256, keep_ids=True)
    got = [r.asDict() for r in packed.collect()]
    expected = Counter()
    for i, t, _ in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            own = ids[at:at + 256]
            expected[i, k, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    bins = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    total = sum(r["length"] for r in got)
    assert max(bins.values()) <= 256 and len(bins) <= 1.01 * total / 256 + 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.assemble(packed).collect()}
    assert {k: len(v) for k, v in whole.items()} == bins and sum(v.count(0) for v in whole.values()) == len(rows)
    assert packing.pack(docs.limit(0), TOKENS).count() == 0


def test_best_two_fit_swaps_the_smallest_piece():
    # 6 + 3 leaves 1; the 3 gives way to 2 + 2, which fits exactly.
    made = packing.patterns({6: 1, 3: 1, 2: 2}, 10)
    assert made[0] == ([6, 2, 2], 1) and made[1] == ([3], 1)
    counts = {700: 1_000_000, 341: 3_000_000, 1: 5}
    made = packing.patterns(counts, 2048)
    used = Counter()
    for lengths, times in made:
        assert sum(lengths) <= 2048
        for k in lengths:
            used[k] += times
    assert used == counts and len(made) < 20


def test_shares_stop_and_share_again():
    assert mixing.shares([100, 100, 100], [5, 2, 1], 3) == pytest.approx([187.5, 75, 37.5])
    assert mixing.shares([10, 500, 0], [5, 2, 1], 3) == pytest.approx([30, 480, 0])
    assert mixing.shares([], [], 3) == []


def test_permutations_and_shards():
    for n in (1, 2, 5, 100, 1000):
        there = mixing.permuted(np.arange(n), n, 77)
        assert sorted(there) == list(range(n)) and (mixing.permuted(there, n, 77, back=True) == np.arange(n)).all()
    totals = np.array([1000, 3, 0, 412])
    drawn = [mixing.shard_counts(totals, k, 13, 5) for k in range(13)]
    assert (sum(c for _, c in drawn) == totals).all()
    assert all((drawn[k][0] + drawn[k][1] == drawn[k + 1][0]).all() for k in range(12))


def test_mix(spark):
    rows = mixed_rows()
    docs = documents(spark, rows)
    got = [r.asDict() for r in mixing.digest(docs, block=16).collect()]
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(str(r.asDict()) for r in mixing.digest(docs, block=16).collect())
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s), key=str) + [None]
    targets = dict(zip(order, mixing.shares([size[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)))
    by_id = {(i, (t or "")): s for i, t, s in rows}
    taken, ids = Counter(), {i: s for (i, _), s in by_id.items()}
    for r in got:
        s = ids[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(targets[s]) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in order)
    texts = mixing.mixed_texts(docs.withColumn("_block", F.lit(1)), block=16)
    words = Counter()
    for r in texts.collect():
        words[r["source"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == taken and texts.columns == [*docs.columns, "_block"]
    assert mixing.digest(docs.limit(0)).count() == 0 and mixing.mixed_texts(docs.where("doc_id = 200")).count() == 0


def test_mixed_texts_keep_columns_of_any_name(spark):
    docs = documents(spark, mixed_rows())
    plain = Counter(tuple(r) for r in mixing.mixed_texts(docs, block=16).collect())
    clash = docs.withColumns({c: F.lit("own") for c in ("_source", "_start", "_size", "_bucket", "_text", "_spans", "_base", "_DOC", "_row", "own_1")})
    got = mixing.mixed_texts(clash, block=16)
    assert got.columns == clash.columns
    assert Counter(tuple(r)[:len(docs.columns)] for r in got.collect()) == plain and got.where("_source = 'own' and _spans = 'own'").count() == sum(plain.values())


def test_the_mix_is_not_broadcast(spark):
    docs = documents(spark, mixed_rows())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in mixing.digest(docs, block=16)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute_top(vectors, k=10):
    whole = {}
    rows = []
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        rows.append((i, [int(np.floor(1024 * float(np.float64(x)))) for x in v]))
    for i, v in rows:
        if i % 100 == 0:
            whole[i] = min(whole.get(i, v), v, key=lambda u: np.array(u, float).tobytes())
    out = []
    for q, v in whole.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(voronoi_topk, "GROUP", 2)
    monkeypatch.setattr(voronoi_topk, "CHUNK", 200)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6))
    rows = [(k, [float(x) for x in centres[k % 12] + 0.1 * rng.normal(size=6)]) for k in range(900)]
    rows += [(1000 + k, rows[5][1]) for k in range(60)] + [(1100, rows[100][1]), (1200, rows[5][1])]
    rows += [(2000, None), (2001, [1.0, None]), (2100, [float("nan")] * 6), (2200, [1.0, 2.0]), (2300, []), (None, [1.0] * 6), (3, rows[3][1]), (100, rows[100][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1))
    got = sorted(tuple(r) for r in voronoi_topk.digest(vectors).collect())
    assert got == brute_top(rows)
    assert voronoi_topk.digest(vectors.limit(0)).count() == 0
    few = [(0, [2.0**40, 1.0]), (1, [2.0**40, -3.0]), (2, [0.5, 0.25])]
    assert sorted(tuple(r) for r in voronoi_topk.digest(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect()) == brute_top(few)


def test_top_k_of_a_hot_query_id(spark):
    """A third of all rows have the only query's id: their products with it bound nothing."""
    rng = np.random.default_rng(4)
    rows = [(100, [4.0, 4.0, 4.0]) for _ in range(300)] + [(101 + k % 90, [float(x) for x in rng.normal(size=3)]) for k in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in voronoi_topk.digest(vectors).collect()) == brute_top(rows)


def test_pipeline(spark, tmp_path):
    rng = np.random.default_rng(8)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 2000, n))
    shared = "a passage that very many of the documents have in common with others"
    rows, labels = [], []
    for k in range(120):
        text = f"{words(80)}\n{words(60)}"
        toxic = k % 6 == 0
        if toxic:
            text += " nasty vile nasty"
        rows.append((k, text + (f"\n{shared}" if k % 2 else ""), f"s{k % 4}"))
        labels.append((k, 1, int(toxic)))
    rows += [(500, rows[1][1], "s1"), (501, None, "s2"), (502, "", None), (1, rows[1][1], "s1")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = store_stage(stage(spark, docs, str(tmp_path)), name)
        after[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {i for i, *_ in rows if i % 6 or i >= 500}
    assert {r["doc_id"] for r in after["toxicity"].collect()} == clean
    holding = [r["doc_id"] for r in after["line_dedup"].collect() if r["text"] and shared in r["text"]]
    assert set(holding) == {max(i for i, t, _ in rows if t and shared in t and i in clean)}
    # The copies of document 1 differ by the shared line that one of them keeps; empty texts are copies of each other.
    left = [r["doc_id"] for r in after["simhash_near_dedup"].collect()]
    assert len(left) == len(set(left)) and clean - set(left) <= {500, 502}
    packed = after["best_two_fit"].collect()
    assert sum(r["length"] for r in packed) > 0 and corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)
