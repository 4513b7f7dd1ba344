"""Text operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomline.llm import context_mixing, cross_parse, line_quality, lines, rule_ensemble, simhash_tree, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "this line is long enough to be counted as a key, number "


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows], SCHEMA)


def messy(spark):
    shared = LONG + "shared"
    rows = [(k, f"{shared}\n{LONG}{k}\nshort\nshort", "en", f"s{k % 3}") for k in range(8)]
    rows += [(8, None, "en", None), (9, "", None, "s1"), (10, " \n\t\n", "fr", "s1"), (None, f"  {shared.upper()}\r\nlast", "en", "s0")]
    rows += [(11, f"{shared}\nfirst", "en", "s0"), (11, f"{shared}\nfirst", "en", "s0"), (11, "other text", "en", "s0")]
    rows += [(12, " ".join(f"w{n % 700}" for n in range(30_000)), "en", "s0")]
    return documents(spark, rows), rows


def test_line_dedup(spark):
    docs, rows = messy(spark)
    strip = " \t\n\x0b\x0c\r"
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(strip))
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[low(line)].add(lines.NO_ID if i is None else i)
    expected = []
    for i, t, *_ in rows:
        own = lines.NO_ID if i is None else i
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(low(x)) < 40 or len(held[low(x)]) < 5 or max(held[low(x)]) == own]
        expected.append((str(i), len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [(str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in lines.digest(docs).collect()]
    assert sorted(got) == sorted(expected)
    assert lines.digest(docs.limit(0)).count() == 0
    clash = docs.withColumn("N_lines", F.lit("x")).withColumn("_drop", F.lit(1)).withColumn("_cut", F.lit(2))
    out = lines.dedup_lines(clash)
    assert out.columns == [*docs.columns, "_drop", "_cut", "n_lines", "n_dropped"] and out.count() == len(rows)


def test_line_dedup_cuts_texts_under_any_spelling(spark):
    docs, rows = messy(spark)
    plain = {(str(r["doc_id"]), r["n_dropped"], r["text"]) for r in lines.dedup_lines(docs).collect()}
    out = lines.dedup_lines(docs.withColumnRenamed("text", "Text"))
    assert out.columns[1] == "Text" and {(str(r["doc_id"]), r["n_dropped"], r["Text"]) for r in out.collect()} == plain
    assert any(n for _, n, _ in plain)


def test_batches_for_workers_are_bounded_by_bytes(spark):
    from loomline.llm import common

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, str(2**31 - 1))
        common.importable(spark)
        assert spark.conf.get(setting).rstrip("b") == str(common.BATCH_BYTES)
        spark.conf.set(setting, "1000000")  # what the session sets itself stays
        common.importable(spark)
        assert spark.conf.get(setting).rstrip("b") == "1000000"
    finally:
        spark.conf.set(setting, before)


def test_line_quality(spark):
    docs, rows = messy(spark)
    # Three hosts; a limit of two documents makes the shared line common in each.
    got = line_quality.judge(docs, min_docs=1, host_share=0.0, min_words=3).collect()
    held = defaultdict(set)
    for i, t, _, s in rows:
        for line in (t or "").split("\n"):
            if line.split():
                held[s, line.strip().lower()].add(i)
    expected = []
    for i, t, _, s in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for d in range(3)}
        own = [x for x in (t or "").split("\n") if x.split()]
        gone = sum(len(x.split()) for x in own if len(held[s, x.strip().lower()]) > 1)
        failed = len(words) < 3 or 100 * len(covered) > 50 * len(words)
        kept = not failed and len(words) - gone >= 3 and 2 * (len(words) - gone) >= len(words)
        expected.append((str(i), len(words), sum(map(len, words)), sum((t or "").count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(covered), failed, kept, gone))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in got) == sorted(expected)
    assert line_quality.judge(docs.limit(0)).count() == 0
    assert line_quality.judge(docs.withColumn("kept", F.lit(1)).withColumn("_words", F.lit(1))).count() == len(rows)


def fingerprint(text, width):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def grouped(prints, near):
    parent = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if near(prints[a], prints[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return [find(parent, k) for k in range(len(prints))]


def test_simhash_query(spark):
    docs, rows = messy(spark)
    prints = [fingerprint(t, 3) for _, t, *_ in rows]
    roots = grouped(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for (i, *_), root in zip(rows, roots):
        if i is not None:
            first[root] = min(i, first.get(root, i))
    expected = sorted((str(i), f"{p:016x}", str(first.get(r))) for (i, *_), p, r in zip(rows, prints, roots))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash_tree.digest(docs).collect()) == expected
    assert simhash_tree.digest(docs.limit(0)).count() == 0


def test_vantage_tree_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash_tree, "LEAF", 64)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flips = [base[:60] ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(8)]
    points = np.unique(np.concatenate([base, *flips]))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "print long")
    found = {r["node"]: r["root"] for r in simhash_tree.components(simhash_tree.tree_links(frame, "print", 2)).collect()}
    own = points.view(np.int64).tolist()
    roots = grouped(points.tolist(), lambda a, b: (a ^ b).bit_count() <= 2)
    assert len({(find_root, found.get(p, p)) for p, find_root in zip(own, roots)}) == len(set(roots)) == len({found.get(p, p) for p in own})


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201)]
    got = {r["node"]: r["root"] for r in simhash_tree.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[k] == 100 for k in range(101, 140)) and got[201] == 200


def test_near_copies(spark):
    rng = np.random.default_rng(3)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    rows, groups = [], []
    for g in range(30):
        words = text(300)
        for c in range(4):
            changed = list(words)
            for at in rng.choice(300, c, replace=False):
                changed[at] = f"x{g}{c}"
            rows.append((len(rows), " ".join(changed), "en", "s"))
            groups.append(g)
    rows += [(200 + k, " ".join(text(200)), "en", "s") for k in range(60)] + [(300, None, "en", "s"), (301, "", "en", "s"), (5, rows[5][1], "en", "s")]
    kept = simhash_tree.drop_near(documents(spark, rows).withColumn("_doc", F.lit(1)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4 * g for g in range(30)] + [200 + k for k in range(60)] + [300]
    assert "_doc" in kept.columns and simhash_tree.drop_near(documents(spark, rows[:0])).count() == 0


def test_cross_parsing_counts_phrases(spark):
    sample = b"abcabxabcd\0zzz"
    automaton = cross_parse.Automaton(sample)

    def brute(text):
        n = 0
        for at in range(0, len(text), cross_parse.SEGMENT):
            part, i = text[at:at + cross_parse.SEGMENT], 0
            while i < len(part):
                j = i + 1
                while j < len(part) and any(part[i:j + 1] in p for p in sample.split(b"\0")):
                    j += 1
                i, n = j, n + 1
        return n

    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abcdxzq"), size=n).astype(np.uint8)) for n in (1, 2, 5, 511, 512, 513, 2000)]
    assert cross_parse.parse(texts, [automaton])[:, 0].tolist() == [brute(t) for t in texts]


def test_languages(spark):
    rng = np.random.default_rng(2)
    parts = {"aa": ["ka", "to", "mi", "re"], "bb": ["stru", "ßen", "ich", "öl"], "日": ["今日", "明日", "大学", "生"]}
    write = lambda lang, n: " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(n))
    rows = [(k, write(lang, 5 + k % 40), lang, None) for k in range(120) for lang in [list(parts)[k % 3]]]
    rows += [(500, None, "aa", None), (501, "", "aa", None), (502, "123 !!", "bb", None), (503, write("bb", 20_000), None, None), (None, write("aa", 9), None, None)]
    got = cross_parse.digest(documents(spark, rows)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang, _ in rows[:120])
    assert {by_id[k]["lang_pred"] for k in (500, 501, 502)} == {"und"} and by_id[503]["lang_pred"] == "bb" and by_id[None]["lang_pred"] == "aa"
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert {r["lang_pred"] for r in cross_parse.identify(documents(spark, rows[:5]), {}).collect()} == {"und"}
    assert cross_parse.digest(documents(spark, rows[:0])).count() == 0


def labelled(spark, label):
    rng = np.random.default_rng(4)
    bad = ["nasty", "awful", "vile"]
    rows, labels = [], []
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 300, 60)]
        mark = k % 4 == 0
        if label == "toxic" and mark:
            words[10], words[30] = rng.choice(bad, 2)
        if label == "quality" and not mark:
            words = ["".join(rng.choice(list("abcde"), 4)) + "###" for _ in range(30)] if k % 2 else ["SAME"] * 40
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, int(mark), int(mark)))
    rows += [(900, None, None, None), (901, "", None, None), (None, "plain words", None, None), (0, rows[0][1], "en", "s")]
    labels += [(None, 1, 1), (3, None, None), (0, 0, 0), (7777, 1, 1)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


@pytest.mark.parametrize("label, run, modulus", [("toxic", toxicity.digest, 3), ("quality", rule_ensemble.digest, 4)])
def test_classifiers(spark, label, run, modulus):
    docs, labels, rows = labelled(spark, label)
    got = run(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert len(held) > 50 and right >= 0.95 * len(held)
    assert len([r for r in got if r["doc_id"] == 0]) == 2
    assert run(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in run(docs.where("doc_id < 3"), labels.limit(0)).collect()} == {0}


def test_rules_from_a_printed_forest():
    forest = "  Tree 0 (weight 1.0):\n    If (feature 0 <= 1.5)\n     If (feature 0 <= 0.5)\n      Predict: 0.0\n     Else (feature 0 > 0.5)\n      Predict: 1.0\n    Else (feature 0 > 1.5)\n     Predict: 0.0\n"
    rules = rule_ensemble.tree_rules(forest, ("x",))
    assert [r.conditions for r in rules] == [
        (("x", False, 1.5),), (("x", False, 0.5),), (("x", False, 1.5), ("x", True, 0.5)), (("x", True, 1.5),)
    ]


def test_context_mixing(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "HEAD", 20)
    rng = np.random.default_rng(6)
    stems = ["ka", "to", "mire", "stu", "ven", "lo"]
    rows = [(k, " ".join("".join(rng.choice(stems, rng.integers(1, 4))) for _ in range(80)), "en", "s") for k in range(120)]
    rows += [(200, None, None, None), (201, "", None, None), (None, "ka TO new-word", None, None), (5, rows[5][1], "en", "s"), (202, "x" * 5000 + " ka", None, None)]
    got = context_mixing.digest(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    counts = Counter()
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    for i, t, *_ in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    base = {str(i): (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t))) for i, t, *_ in rows}
    for r in got:
        n, known, score = base[str(r["doc_id"])]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and r["base_score"] == pytest.approx(score)
        assert r["score"] <= 0
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 10 and r["doc_id"] < 120]
    assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -3.5
    assert context_mixing.digest(documents(spark, rows[:0])).count() == 0
    unknown = context_mixing.score(documents(spark, rows[:3]), F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in unknown)


def test_passages_end_where_a_word_hash_says_so():
    rng = np.random.default_rng(3)
    for text in ("", "one", " ".join(f"w{n}" for n in rng.integers(0, 90, 400))):
        tokens = [*context_mixing.words_of(text), context_mixing.END]
        found = list(context_mixing.passages(tokens))
        stops = [k + 1 for k, w in enumerate(tokens) if w == context_mixing.END or zlib.crc32(w) % context_mixing.PASSAGE == 0]
        assert [(a, b) for a, b, _ in found] == list(zip([0, *stops], stops))
        assert len({k for _, _, k in found}) == len({tuple(tokens[a:b]) for a, b, _ in found})
        assert all(k.startswith(context_mixing.END) and len(k) > 1 for _, _, k in found)


def test_word_probabilities_sum_to_one_at_most():
    length, nodes, bits = context_mixing.code_tree(np.bincount(np.frombuffer(b"hello world and some more", np.uint8), minlength=256).astype(float))
    assert abs(sum(0.5 ** n for n in length) - 1) < 1e-12
    assert len({(tuple(nodes[b, :n]), tuple(bits[b, :n])) for b, n in enumerate(length)}) == 256


def near_pair(rng, name, size, shared):
    """Two texts of ``2 * size - shared`` five-word shingles in all, ``shared`` of them in both."""
    common = [f"{name}w{n}" for n in rng.permutation(10 * size)[:shared + 4]]
    ends = [[f"{name}{side}{n}" for n in range(size - shared)] for side in "ab"]
    return [" ".join(common + end) for end in ends]


def test_near_copies_have_the_similarity(spark):
    """Pairs at 0.7 to 0.79 stay, pairs at 0.8 to 0.84 lose one; shingles that repeat count once."""
    rng, rows, lost = np.random.default_rng(5), [], set()
    for k in range(240):
        size = int(rng.integers(120, 300))
        shared = next(i for i in range(size) if i / (2 * size - i) >= (0.7, 0.74, 0.78, 0.8, 0.82, 0.84)[k % 6])
        rows += [(2 * k + j, t, "en", "s") for j, t in enumerate(near_pair(rng, f"p{k}", size, shared))]
        if shared / (2 * size - shared) >= 0.8:
            lost.add(2 * k + 1)
    line = " ".join(f"again{n}" for n in range(8))
    rows += [(1000 + k, f"{line}\n" * 200 + " ".join(f"own{k}x{n}" for n in range(60)), "en", "s") for k in range(4)]
    kept = {r["doc_id"] for r in simhash_tree.drop_near(documents(spark, rows)).collect()}
    gone = {i for i, *_ in rows} - kept
    assert gone <= lost and len(gone) >= 0.97 * len(lost)


def test_a_shard_joins_trees_without_going_over_all_points(monkeypatch):
    """Links of many small groups and one long chain give the components of brute force; a join touches the points of the smaller trees only."""
    rng = np.random.default_rng(12)
    points = [int(rng.integers(2**32))]
    for _ in range(300):
        points.append(points[-1] ^ (1 << int(rng.integers(32))))
    for _ in range(200):
        first = int(rng.integers(2**32))
        points += [first, first ^ 5, first ^ 0x80000001]
    points = np.unique(np.array(points, np.uint64))

    def all_points(*_):
        raise AssertionError("a join reads the labels of all points")

    monkeypatch.setattr(simhash_tree.np, "isin", all_points)
    forest, label = simhash_tree.spanning(points, 3, bits=32)
    near = np.bitwise_count(points[:, None] ^ points[None]) <= 3
    for k in range(len(points)):  # neighbours have one label
        assert (label[near[k]] == label[k]).all()
    assert len(forest) == len(points) - len(set(label.tolist())) and all(near[a, b] for a, b in forest)


def test_wide_prints_take_the_majority_of_each_bit():
    rng = np.random.default_rng(13)
    for n in (0, 1, 2, 254, 255, 256, 1_100):
        hashes = np.concatenate((np.full(n // 2, 2**64 - 1, np.uint64), rng.integers(0, 2**63, n - n // 2).astype(np.uint64)))
        bits = [sum(int(h) >> k & 1 for h in hashes) * 2 > n for k in range(64)]
        assert simhash_tree.majority_bits(hashes) == sum(1 << k for k, b in enumerate(bits) if b)
        mixed = [(int(h) + 1) * 0x9E3779B97F4A7C15 % 2**64 for h in hashes]
        mixed = [(h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64 for h in mixed]
        second = sum(1 << k for k in range(64) if sum((h ^ h >> 27) >> k & 1 for h in mixed) * 2 > n)
        assert simhash_tree.wide_print(hashes, 3)[8:16] == second.to_bytes(8, "big")


def test_untrue_links_hide_no_true_ones(spark):
    """Chains of texts in which some neighbours are below the similarity, against brute force; the trees have more than one shard."""
    rng, rows = np.random.default_rng(6), []
    for k in range(12):
        words = [f"c{k}w{n}" for n in range(204)]
        for j in range(8):
            rows.append((8 * k + j, " ".join(words), "en", "s"))
            many = int(rng.integers(8, 34))
            words = words[many:] + [f"c{k}n{j}x{n}" for n in range(many)]
    sets = [set(zip(*(t.split()[d:] for d in range(5)))) for _, t, *_ in rows]
    roots = grouped(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    kept = {r["doc_id"] for r in simhash_tree.drop_near(documents(spark, rows), leaf=32).collect()}
    assert kept == set(roots)


def test_rare_toxic_expressions_speak(spark, monkeypatch):
    """Words and pairs in fewer than three documents are smoothed, not dropped, and no number of ordinary pairs crowds a toxic one out."""
    monkeypatch.setattr(toxicity, "MAX_PAIRS", 40, raising=False)
    rng = np.random.default_rng(8)
    plain = [f"w{n}" for n in range(30)]
    rows, labels = [], []
    for k in range(120):
        words = list(rng.choice(plain, 40))
        if k % 2:
            words += ["red", "a", "blue", "b"] if k % 12 != 1 else ["red", "blue", "a", "b"]
        else:
            words += ["blue", "red", "a", "b"]
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, k % 2))
    rows += [(500 + k, f"w1 w2 seldom{k // 2} w3", "en", "s") for k in range(20)]
    labels += [(500 + k, 1) for k in range(20)]
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    ratios = dict(zip(("w1", "red", "blue"), model.ratios([b"w1", b"red", b"blue"])[0]))
    assert ratios["blue"] > 1.0 and abs(model.word_ratio[toxicity.word_numbers([b"blue"], model.known)[0]]) < 0.5
    met = [w for w in (b"seldom%d" % k for k in range(10)) if toxicity.word_numbers([w], model.known)[0]]
    assert met and all(model.ratios([b"w2", w])[0][1] > 0.3 for w in met)


def test_slot_counts_stay_whole(spark):
    """Single occurrences count in slots that were met 2^24 times, and the model has its six contexts."""
    words = spark.createDataFrame([(b"ab", 2**24), (b"ac", 1), (b"ad", 1)], "word binary, n long").coalesce(1)
    model = context_mixing.train(words)
    assert len(model.counts) == 6 and (model.counts.real + model.counts.imag).max() >= 2**24 + 2


def test_context_mixing_learns_online(spark):
    """A block is predicted before its words are counted: the first one meets no context, later ones do; the slots hold all words in the end."""
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]

    def trained(words):
        return context_mixing.train(spark.createDataFrame([(w.encode(), 1) for w in words], "word binary, n long").coalesce(1))

    first = trained([a + "q" for a in letters[:12]])
    assert first.mixer.map[:, 0].sum() > 0 and first.mixer.map[:, 1:].sum() == 0 and (first.mixer.weights[1:, :-1] == 0.3).all()
    more = trained([a + b for a in letters for b in letters[:6]])
    assert more.mixer.map[:, 1:].sum() > 0 and (more.mixer.weights[1:, :-1] != 0.3).any()
    met = more.counts.real + more.counts.imag
    assert len(set(met.sum(axis=1))) == 1 and met.max() == 26 * 6
    # Equal beginnings share their decisions, and a word costs what it costs alone.
    some = [b"abcd", b"abce", b"abcd", context_mixing.END]
    d = more.coder.decisions(some)
    assert len(d.word) == 16 and len(set(d.same)) == d.same.max() + 1 == 8
    assert more.log10(some) == pytest.approx([more.log10([w])[0] for w in some])


def test_words_are_learned_where_they_stand(spark):
    """Every occurrence trains the model after the words before it: pairs, and triples, in their order cost less than the same words in another."""
    rng, rows = np.random.default_rng(9), []
    after = {f"ka{a}": f"to{b}" for a, b in zip("abcdefghijkl", rng.permutation(list("abcdefghijkl")))}
    third = {(x, y): f"mi{c}" for (x, y), c in zip(after.items(), rng.permutation(list("abcdefghijkl")))}

    def text(first, order):
        return " ".join(w for x in first for w in ((x, after[x], third[x, after[x]]), (after[x], third[x, after[x]], x))[order])

    starts = lambda: rng.choice(list(after), 60)
    rows = [(k, text(starts(), 0), "en", "s") for k in range(150)]
    same = [starts() for _ in range(6)]
    rows += [(1000 + 2 * k + order, text(first, order), "en", "s") for k, first in enumerate(same) for order in (0, 1)]
    got = {r["doc_id"]: r for r in context_mixing.score(documents(spark, rows), F.col("doc_id") >= 1000).collect()}
    for k in range(len(same)):
        a, b = got[1000 + 2 * k], got[1001 + 2 * k]
        assert a["base_score"] == pytest.approx(b["base_score"]) and a["score"] > b["score"] + 20
    # A text costs the same wherever it stands, and its words count once for each time they occur.
    docs = documents(spark, rows[:40])
    model = context_mixing.train(context_mixing.vocabulary(docs).where(~context_mixing.is_passage()), docs)
    some = [[*context_mixing.words_of(t), context_mixing.END] for _, t, *_ in rows[:3]]
    alone = np.concatenate([model.text_costs(t) for t in some])
    assert model.text_costs(sum(some, [])) == pytest.approx(alone)
    bits = sum(len(context_mixing.Coder.decisions(model.coder, [w]).bit) for _, t, *_ in rows[:40] for w in (*context_mixing.words_of(t), context_mixing.END))
    assert {int(m.real.sum() + m.imag.sum()) for m in (*model.counts, *model.beyond)} == {bits}


def test_lines_above_the_limit_leave_the_text(spark):
    docs, rows = messy(spark)
    held = defaultdict(set)
    for i, t, _, s in rows:
        for line in (t or "").split("\n"):
            if line.split():
                held[s, line.strip().lower()].add(i)
    expected = []
    for i, t, _, s in rows:
        left = None if t is None else "\n".join(x for x in t.split("\n") if not x.split() or len(held[s, x.strip().lower()]) <= 1)
        expected.append((str(i), str(left)))
    got = line_quality.judge(docs, min_docs=1, host_share=0.0, min_words=3)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got.collect()) == sorted(expected)
    assert got.columns[:5] == docs.columns and any(a != str(t) for (_, a), (_, t, *_) in zip(expected, rows))


def test_the_limit_of_a_line_does_not_follow_its_host(spark):
    common = "This line stands in twenty five documents of whichever host"
    rows = [(k, f"{common}\n" + " ".join(f"w{k}x{n}" for n in range(80)), "en", "hot" if k < 25 else "small") for k in range(50)]
    rows += [(100 + k, f"line of document {k}", "en", "hot") for k in range(4000)]
    got = line_quality.judge(documents(spark, rows)).where("doc_id < 50").select("text", "n_removed_words").collect()
    assert {r["n_removed_words"] for r in got} == {len(common.split())} and not any(common in r["text"] for r in got)
    loose = line_quality.judge(documents(spark, rows), host_share=0.01).where("n_removed_words > 0")
    assert {r["source"] for r in loose.collect()} == {"small"}


def test_languages_behind_a_shared_opening(spark):
    """Texts of all languages open with the same long notice, which tells nothing."""
    rng = np.random.default_rng(12)
    notice = " ".join(f"{w}" for w in ["all rights reserved no part of this page may be copied in any form without leave of its owners"] * 3)
    own = {lang: ["".join(rng.choice(list(abc), 6)) for _ in range(400)] for lang, abc in (("aa", "abcdefghij"), ("bb", "klmnopqrst"), ("cc", "fghijklmno"))}
    rows = []
    for k in range(900):
        lang = sorted(own)[k % 3]
        rows.append((k, f"{notice} " + " ".join(rng.choice(own[lang], 120)), lang, "s"))
    automata = cross_parse.fit(documents(spark, rows), F.lit(True), sample_bytes=20_000)
    assert set(automata) == set(own)
    probes = [(k, " ".join(rng.choice(own[lang], 40)), lang, "s") for k, lang in enumerate(sorted(own) * 20)]
    got = cross_parse.identify(documents(spark, probes), automata).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)
    sample = cross_parse.joined_sample([f"{notice} {k} ".encode() + b" ".join(w.encode() for w in own["aa"][k:k + 9]) for k in range(50)], 500, 20_000)
    assert sample.count(b"reserved") <= 3


def test_share_lies_anywhere_in_the_text(spark):
    """A word that stands behind the first bytes of every text is learned."""
    rows = [(k, "begin " * 200 + f"{chr(97 + k % 26)}late word{chr(97 + k // 26)} " * 200, "en", "s") for k in range(200)]
    automaton = cross_parse.fit(documents(spark, rows), F.lit(True), sample_bytes=10_000)["en"]
    text = b"late wordc"
    assert cross_parse.parse([text], [automaton])[0, 0] <= 2
