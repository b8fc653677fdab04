"""The training-data operators against brute force, on small tables with nulls, repeats, long texts and odd columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.llm import bpe, common, exact_dedup, hd_language, jaccard_join, kneser_ney, license_scan, mixing, quality_rules, token_counts, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("n", "size", "score", "kept", "labels", "token", "g", "block")]])


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def prose(rng, n, stem="", most=400):
    return " ".join(stem + rng.choice("abcdefgh") + str(rng.randint(0, most)) for _ in range(n))


def rows():
    rng = random.Random(5)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One  two"), (5, "one two"), (6, "All rights reserved. CC-BY, cc by; GNU General Public License"), (7, "Ä" * 3000), (8, prose(rng, 6000)), (8, "repeated id"), (9, "same same"), (9, "same same"), (None, "without id"), (None, "without id")]
    base = prose(rng, 120)
    for i in range(10, 40):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        out.append((i, " ".join(w)))
    passage = prose(rng, 60)
    out += [(i, prose(rng, 50) + " " + passage + " " + prose(rng, 30) + "\n") for i in range(40, 90)]
    out += [(i, base) for i in range(90, 110)]
    out += [(i, prose(rng, rng.randint(1, 90), most=30) + "\nline\nline\n") for i in range(110, 150)]
    return [(i, t, ("aa", "bb", None)[k % 3], (f"s{k % 4}", None)[k % 5 == 4], "x", "x", "x", "x", "x", "x", "x", "x") for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return common.keep(spark.createDataFrame(rows(), SCHEMA).repartition(3), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def once(found):
    """Rows by id, of ids that occur once."""
    seen = Counter(r["doc_id"] for r in found)
    return {r["doc_id"]: r for r in found if r["doc_id"] is not None and seen[r["doc_id"]] == 1}


def texts():
    seen = Counter(r[0] for r in rows())
    return {r[0]: r[1] for r in rows() if r[0] is not None and seen[r[0]] == 1}


# -- exact duplicates


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_duplicates(docs, empty):
    got = exact_dedup.exact_duplicates(docs).collect()
    groups = defaultdict(list)
    for r in rows():
        groups[normal(r[1])].append(r[0])
    want = Counter()
    for g in groups.values():
        if len(g) > 1:
            first = min((x for x in g if x is not None), default=None)
            for k, i in enumerate(sorted(g, key=lambda x: (x is None, x or 0))):
                want[i, first, len(g), k == 0] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert Counter(normal(r["text"]) for r in left.collect()) == Counter(groups.keys())
    assert exact_dedup.deduplicate(empty).count() == 0


def test_deduplicate_takes_null_and_repeated_ids_row_by_row(spark):
    table = [(1, "x"), (5, "x"), (5, "y"), (None, "x"), (None, "z"), (None, "z"), (6, "w"), (6, "w"), (7, "v"), (8, "v"), (9, None)]
    left = exact_dedup.deduplicate(spark.createDataFrame(table, "doc_id long, text string"))
    assert Counter(map(tuple, left.collect())) == Counter([(1, "x"), (5, "y"), (None, "z"), (6, "w"), (7, "v"), (9, None)])


def test_attach_salts_hot_keys(spark):
    many = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    table = many.groupBy("k").agg(F.count(F.lit(1)).alias("w")).withColumn("v", F.col("k") * 2)
    got = common.attach(many, table, ["k"], "w", ["id"], small=0)
    assert got.count() == 3000 and got.filter("v <> 2 * k").count() == 0


# -- mixing


def source_targets(size):
    """Target of each source, from the words it has."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    fixed, total = {}, sum(size.values())
    while True:
        free = [s for s in names if s not in fixed]
        share = {s: (total - sum(fixed.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3 * size[s] for s in free if share[s] > 3 * size[s]}
        if not over:
            return fixed | share
        fixed |= over


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows())
    size = Counter()
    for r in rows():
        size[r[3]] += len(WORD.findall(r[1] or ""))
    names, target = list(size), source_targets(size)
    taken = Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(60, 0.05 * size[s]) or size[s] < 200 or max(len(WORD.findall(r[1] or "")) for r in rows() if r[3] == s) > size[s] / 3
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(mixing.mix(docs.repartition(5)).collect()) == key(got)
    assert mixing.take(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0


def brute_tilt(size, target, cap=3):
    """Root of the words taken in the tilt, by bisection."""
    u = [1 + math.log1p(x * len(size) / sum(size)) for x in size]
    low, high = -60.0, math.log(cap)
    for _ in range(200):
        t = (low + high) / 2
        if sum(x * min(cap, math.exp(t * v)) for x, v in zip(size, u)) < target:
            low = t
        else:
            high = t
    return high


def test_newton_meets_token_constraints(spark):
    rng = random.Random(2)
    shares = {"a": 2.5, "b": 0.3, "c": 1.0, "d": 3.0, "e": 1e-6, "f": 2.999, "g": 1.2}
    size = {k: [0, 0, *(int(rng.lognormvariate(4, 1.5)) + 1 for _ in range(300)), 10**6] for k in shares}
    size["g"] = [7] * 50
    sizes = spark.createDataFrame([("s" + k, k, x) for k, v in size.items() for x in v], "_key string, source string, size long")
    sources = spark.createDataFrame([("s" + k, len(v), sum(v), shares[k] * sum(v)) for k, v in size.items()], "_key string, n long, source_size long, target double")
    for r in mixing.balance(sizes, sources).collect():
        k = r["_key"][1:]
        assert r["error"] < 1e-9
        # Every tilt above log(3) / least exposure takes all that the cap allows.
        assert k == "d" or r["tilt"] == pytest.approx(brute_tilt(size[k], shares[k] * sum(size[k])), abs=1e-6), k
        taken = sum(x * min(3, math.exp(r["tilt"] * (1 + math.log1p(x * len(size[k]) / sum(size[k]))))) for x in size[k])
        assert taken == pytest.approx(shares[k] * sum(size[k]), rel=1e-8)


def test_rates_tilt_by_size(spark):
    rng = random.Random(8)
    table = [(i, " ".join(["w"] * int(rng.lognormvariate(3.5, 0.8))), "abc"[i % 3]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(table, "doc_id long, text string, source string")).collect()
    for s in "abc":
        part = sorted((r for r in got if r["source"] == s and r["size"]), key=lambda r: r["size"])
        rates = [r["rate"] for r in part]
        assert rates[0] != rates[-1] and rates == sorted(rates, reverse=part[0]["target"] < part[0]["source_size"])
        assert sum(r["taken"] for r in part) == pytest.approx(part[0]["target"], rel=0.01)
        assert all(abs(r["copies"] - r["rate"]) < 1 for r in part)


# -- quality


def brute_statistics(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_quality_statistics(spark, docs, empty):
    more = ["a a a", "a a a a", "a b c a b c", "x y z\n x y z \nx y z\n\n", "# | <>&", "p q p q p q p q", "\x1c \xa0 b"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    got = once(quality_rules.statistics(docs.select("doc_id", "text").unionByName(extra)).collect())
    for i, t in {**texts(), **{1000 + i: t for i, t in enumerate(more)}}.items():
        r = got[i]
        assert brute_statistics(t) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]), t
    assert quality_rules.statistics(empty).count() == 0


def test_quality_rules_learn_a_threshold(spark, empty):
    rng = random.Random(3)
    table, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        table.append((i, " ".join(w + ("###" if bad else "") for w in prose(rng, 80, most=10**6).split())))
        labels.append((i, int(not bad)))
    stats = common.keep(quality_rules.statistics(spark.createDataFrame(table, "doc_id long, text string")), "stats")
    rules = quality_rules.learn(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert rules and quality_rules.learn(stats, spark.createDataFrame([], "doc_id long, quality int")) == []
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(stats, rules).collect()}
    assert all(got[i] == bool(y) for i, y in labels)
    assert quality_rules.apply_rules(quality_rules.statistics(empty), rules).count() == 0


# -- near duplicates


def shingles(t):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block", [500, 4])
def test_near_duplicates(docs, empty, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    got = jaccard_join.near_duplicates(docs).collect()
    assert len(got) == len(rows())
    s = {i: shingles(t) for i, t in texts().items()}
    up = {i: i for i in s}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in s:
        for b in s:
            if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    for i, r in once(got).items():
        assert (r["n_shingles"], r["component_id"]) == (len(s[i]), top(i)), i
    assert jaccard_join.near_duplicates(empty).count() == 0
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and 10 in {r["doc_id"] for r in kept.collect()} and not {11, 39, 109} & {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("grouped", [False, True])
def test_links_of_sets_whose_unshared_tokens_come_first(spark, grouped):
    rng, table, shared = random.Random(8), [], []
    token = lambda t: next(jaccard_join.shingle_sets([t]))
    # n shingles each, u of them unshared: J is 0.75 to 0.9, and under 0.75 for the last two.
    for k, (n, u) in enumerate([(14, 2), (21, 3), (28, 4), (40, 5), (70, 10), (100, 8), (95, 5), (13, 2), (60, 10)]):
        common_words = prose(rng, n - u + 4, most=10**6)
        pair = [common_words + " " + prose(rng, u, most=10**6) for _ in range(2)]
        table += [(10 * k, pair[0]), (10 * k + 1, pair[1])]
        # A group around each of the two: its members share all but the last word.
        table += [(10 * k + 2 + j, pair[j % 2].rsplit(" ", 1)[0] + f" last{j}") for j in range(6)] if grouped else []
        shared.append(set(token(pair[0]).tolist()) & set(token(pair[1]).tolist()))
    late = jaccard_join.np.array(sorted(set().union(*shared)), dtype=jaccard_join.np.uint64)
    frame = common.keep(spark.createDataFrame(table, "doc_id long, text string"), "first")
    prints = jaccard_join.fingerprints(frame, "doc_id", "text", 5, 75, late)
    if not grouped:
        prints = prints.withColumn("bands", F.array().cast("array<long>"))
    _, found = jaccard_join.links(frame, common.keep(prints, "prints"), "doc_id", "text")
    s = {i: shingles(t) for i, t in table}
    want = {(a, b) for a in s for b in s if a < b and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])}
    if not grouped:
        assert {(min(r), max(r)) for r in map(tuple, found.collect())} == want and len(want) == 7
    got = {r["_id"]: r["component"] for r in jaccard_join.components(found).collect()}
    assert got == {r["_id"]: r["component"] for r in jaccard_join.components(spark.createDataFrame(sorted(want), "a long, b long")).collect()}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400, x) for x in range(401, 460)] + [(x, x + 1) for x in range(500, 540)]
    links = [(a, b) for a, b in links if a != b]
    up = {x: x for e in links for x in e}
    for _ in up:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    got = {r["_id"]: r["component"] for r in jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == up


# -- token counts


def test_rollup_is_idempotent_and_reverses(spark, tmp_path):
    schema = "op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, old_tokens long"
    store = token_counts.Rollup(spark, str(tmp_path / "r"))
    first = spark.createDataFrame([("insert", "a", None, "t1", 5, None, None, None, None), ("insert", None, "x", "t1", None, None, None, None, None), ("insert", "a", None, "t1", 7, None, None, None, None)], schema)
    total = lambda: sorted((str(r[0]), str(r[1]), r[2], r[3], r[4]) for r in store.totals().collect())
    assert store.apply("1", first) and not store.apply("1", first)
    assert total() == [("None", "x", "t1", 1, 0), ("a", "None", "t1", 2, 12)]
    second = spark.createDataFrame([("revise", "b", None, "t2", 9, "a", None, "t1", 7), ("delete", None, "x", "t1", None, None, None, None, None)], schema)
    store.deltas_left = token_counts.deltas(second)
    store.deltas_left.write.parquet(str(tmp_path / "r" / "deltas" / "broken"))  # written, but never committed
    assert total()[0][0] == "None"
    assert store.apply("2", second) and store.compact("c") and not store.compact("c")
    assert total() == [("a", "None", "t1", 1, 5), ("b", "None", "t2", 1, 9)]
    with pytest.raises(Exception, match="unknown op"):
        store.apply("3", second.withColumn("op", F.lit("upsert")))
    assert store.apply("4", first.limit(0)) and len(total()) == 2


# -- language model


def test_kneser_ney(docs, empty, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BLOCK_WORDS", 3000)
    monkeypatch.setattr(kneser_ney, "SHARD_WORDS", 3000)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    scored, totals = kneser_ney.train_and_score(docs, common.fold("doc_id", 7) != 2)
    got = scored.collect()
    assert len(got) == len(rows())
    token = lambda t: WORD.findall(lower(t)) + ["</s>"]
    c, pairs = Counter(), Counter()
    for r in rows():
        if r[0] is None or not held(r[0]):
            c.update(token(r[1]))
            pairs.update(zip(["<s>", *token(r[1])], token(r[1])))
    n, v, types = sum(c.values()), len(c), Counter(w for _, w in pairs)
    counts = lambda x: [sum(k == j for k in x) for j in (1, 2, 3, 4)]
    d, dt, b = kneser_ney.discounts(counts(pairs.values())), kneser_ney.discounts(counts(types.values())), len(pairs)
    rest = sum(dt[min(k, 3)] for k in types.values()) / b
    of_h, left = Counter(), defaultdict(float)
    for (h, _), k in pairs.items():
        of_h[h] += k
        left[h] += d[min(k, 3)]

    def p(h, w):
        low = max(types[w] - dt[min(types[w], 3)], 0) / b + rest / (v + 1)
        return low if not of_h[h] else max(pairs[h, w] - d[min(pairs[h, w], 3)], 0) / of_h[h] + left[h] / of_h[h] * low

    assert totals.tokens == n
    assert sum(p("one", w) for w in [*c, "unseen"]) == pytest.approx(1)
    for i, r in once(got).items():
        t = token(texts()[i])
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(c[w] > 0 for w in t))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r["score"] == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip(["<s>", *t], t)), rel=1e-4, abs=1e-4)
    assert kneser_ney.train_and_score(empty, F.lit(True))[0].count() == 0
    none = kneser_ney.train_and_score(docs, F.lit(False))[0].agg(F.max("n_known"), F.count(F.lit(1))).first()
    assert tuple(none) == (0, len(rows()))


# -- licenses


def test_license_scan(docs, empty):
    got = once(license_scan.scan_licenses(docs).collect())
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, t in texts().items():
        w, starts, labels = word.findall(lower(t)), [], set()
        for phrase, label in license_scan.BASE.items():
            q = phrase.split()
            for k in range(len(w)):
                if w[k : k + len(q)] == q:
                    starts.append(k)
                    labels.add(label)
        r = got[i]
        assert (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))) == (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
    assert license_scan.scan_licenses(empty).count() == 0


@pytest.mark.parametrize(
    ("text", "has", "lacks"),
    [
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2.0", "apache"),
        ("GNU General Public License, version 3 or any later version", "gpl-3.0-or-later", "gpl-3.0"),
        ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0", "creative-commons"),
        ("SPDX-License-Identifier: MIT", "spdx-mit", "x"),
        ("a licence to commit", "", "mit"),
    ],
)
def test_license_rules(text, has, lacks):
    found = license_scan.scan(text)["labels"].split(",")
    assert has in found and lacks not in found


def samples(tree):
    """Texts that a parsed pattern takes: every alternative, optional parts absent and once."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "BRANCH":
            parts = [x for t in arg[1] for x in samples(t)]
        elif op == "SUBPATTERN":
            parts = samples(arg[3])
        elif op == "MAX_REPEAT":
            parts = ([""] if arg[0] == 0 else []) + samples(arg[2])
        elif op == "IN":
            parts = [chr(a) for o, a in arg if str(o) == "LITERAL"] or ["7"]
        else:
            parts = [{"LITERAL": lambda: chr(arg), "ANY": lambda: "x", "ASSERT_NOT": lambda: ""}[op]()]
        out = [a + b for a in out for b in parts]
    return out


def test_every_alternative_of_a_license_rule_passes_its_keyword_and_matches():
    by_label = defaultdict(list)
    for _, label, keyword, pattern in license_scan.rules():
        by_label[label].append((keyword, pattern))
    for _, label, _, pattern in license_scan.rules():
        for text in {" ".join(x.split()) for x in samples(re._parser.parse(pattern.pattern))}:
            assert any(k in text and p.search(f"so {text} it") for k, p in by_label[label]), (label, text)


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("For academic use only.", "academic-use"),
        ("for academic purposes only", "academic-use"),
        ("for research and educational use only", "academic-use"),
        ("It may not be used for training.", "no-ai"),
        ("may not be used to train models", "no-ai"),
        ("not be used for the training of models", "no-ai"),
    ],
)
def test_license_rules_with_rare_words(text, label):
    assert label in license_scan.scan(text)["labels"].split(",")


def test_license_spans_of_a_long_text():
    t = "under the MIT license and all rights reserved, see the GNU General Public License version 2. " * 4000
    got = license_scan.scan(t)
    one = license_scan.scan(t[: len(t) // 4000])
    assert got["n_base"] == 4000 * one["n_base"] and len(got["spans"]) == 4000 * len(one["spans"])
    assert got["labels"] == one["labels"] and got["last_word"] - got["first_word"] > 3999 * one["n_words"]
    for k in range(2000):
        kept = []
        rng = random.Random(k)
        cover, spans = license_scan.Cover(range(12)), [sorted(rng.choices(range(12), k=2)) for _ in range(8)]
        for s, e in spans:
            assert cover.holds(s, e) == any(a <= s and e <= b for a, b in kept)
            cover.add(s, e)
            kept.append((s, e))


# -- tokenizer


def test_bpe_equals_the_library(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    got = once(bpe.encode(docs).collect())
    for i, x in texts().items():
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert (got[i]["n_tokens"], list(got[i]["ids"]), got[i]["decoded"]) == (len(ids), ids, t.decode(ids, skip_special_tokens=False))
    assert bpe.encode(empty, digest=True).count() == 0
    e, rng = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY)), random.Random(2)
    pool = ["a", "B", "é", "é", "Σ", "ΑΣ ", "ß", "'s", "'LL", "1", "²", "<|endoftext|>", "\x1c", "\x85", "　", "🙂", "İ", "ﬁ", "中", "\n", " ", "don't", "<|", "x" * 70, "_", "\x00"]
    for _ in range(400):
        s = "".join(rng.choices(pool, k=rng.randint(0, 25)))
        i, decoded = e.encode_block([s])[0]
        ids = t.encode(s, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(i) // 4}I", i)) == ids and decoded == t.decode(ids, skip_special_tokens=False), s
    digest = once(bpe.encode(docs, digest=True).collect())[4]
    assert digest["decoded_sha256"] == hashlib.sha256(got[4]["decoded"].encode()).hexdigest()


# -- languages and toxicity


def test_languages(spark, docs, empty):
    rng = random.Random(9)
    parts = {"xx": ["lor", "emi", "psu"], "yy": ["wzk", "qux", "vyt"]}
    table = [(i, " ".join("".join(rng.choices(parts[k], k=3)) for _ in range(30)), k) for i in range(120) for k in [("xx", "yy")[i % 2]]]
    frame = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = hd_language.learn(hd_language.sample(frame, common.fold("doc_id", 5) != 0, "doc_id", "lang"), "text", "lang")
    got = {r["doc_id"]: r for r in hd_language.predict(frame, model).collect()}
    assert all(got[i]["lang_pred"] == k and 0 <= got[i]["score"] <= 1 for i, _, k in table)
    odd = once(hd_language.predict(docs, model).collect())
    assert {odd[i]["lang_pred"] for i in (0, 1, 2)} == {"und"} and odd[7]["lang_pred"] in parts
    assert hd_language.predict(empty, model).count() == 0
    nothing = hd_language.learn(empty, "text", "lang")
    assert {r["lang_pred"] for r in hd_language.predict(docs, nothing).collect()} == {"und"}


def test_grammar_reads_clauses():
    lexicon = toxicity.Lexicon(frozenset({"grob"}), frozenset({"oaf"}))
    read = lambda t: {k: int(n) for k, n in zip(toxicity.READINGS, toxicity.readings(lexicon.classes(t))) if n}
    assert read("what an oaf. Fine") == {"plain": 1}
    assert read("you are a grobian") == {"targeted": 1}
    assert read("not an oaf") == {"negated": 1}
    assert read("she said: oaf") == {"plain": 1} and read("she said oaf") == {"reported": 1}
    assert read("I will kill you") == {"targeted threat": 1} and read("you I will kill") == {"targeted threat": 1}
    assert read("I will kill time") == {"threat": 1} and read("I will not kill you") == {"negated": 1}
    assert read("I will hurt you") == read("ich werde dich schlagen") == {"threat": 1}
    assert read("you will break it") == read("the storm hit you") == read("a piece of cake") == read("get up, sit down") == {}
    assert read("what a piece of garbage") == {"plain": 1} and read("you pile of trash") == {"targeted": 1}
    assert read("not a piece of garbage") == {"negated": 1} and read("shut up") == {"plain": 1} and read("shut up you") == {"targeted": 1}
    assert read("what an oaf you are") == {"targeted": 1} and read("what an oaf. You know") == {"plain": 1}
    assert read("oaf " * 50) == {"plain": 50}
    assert read("a quiet text") == {} and read("") == {}


def brute_readings(clause):
    """The readings of a clause by rules over places."""
    out = Counter()
    negated_until, said = 0, False
    for p, x in enumerate(clause):
        object_after = "Y" in clause[p + 1 : p + 1 + toxicity.OBJECT_REACH]
        phrase = x == "D" and (clause[:p].endswith("P") or clause[:p].endswith("PF")) or x == "X" and clause[:p].endswith("E")
        harm = x in "Hh" and "M" in clause[:p] and (object_after or "Y" in clause[clause.index("M") : p])
        if x == "N":
            negated_until = toxicity.REACH
        elif x == "R":
            said, negated_until = True, 0
        elif x in "IT" or phrase or harm:
            if negated_until:
                out["negated"] += 1
            elif said:
                out["reported"] += 1
            elif harm:
                out["threat"] += 1
            elif x == "T":
                out["targeted threat" if object_after or "Y" in clause[:p] else "threat"] += 1
            else:
                out["targeted" if object_after or "Y" in clause[:p] else "plain"] += 1
            negated_until = 0
        elif x not in "PF":
            negated_until = max(negated_until - 1, 0)
    return dict(out)


def test_composed_machine_equals_rules():
    def same(clause):
        got = {k: int(n) for k, n in zip(toxicity.READINGS, toxicity.readings(clause)) if n}
        assert got == brute_readings(clause), clause

    symbols = toxicity.WORDS.replace("|", "")
    for n in range(5):
        for clause in itertools.product(symbols, repeat=n):
            same("".join(clause))
    rng = random.Random(6)
    for _ in range(20_000):
        same("".join(rng.choices(symbols, k=rng.randint(5, 14))))


def test_toxicity_fit_does_not_depend_on_the_sample():
    rng = np.random.default_rng(3)
    y = (rng.random(40_000) < 0.2).astype(float)
    counts = rng.poisson(np.where(y == 1, 1.2, 0.2)[:, None] * np.ones(6))
    bias, weights = toxicity._fit(counts, y, [1.0, 1.0])
    chosen = (y == 1) | (rng.random(len(y)) < 0.25)
    bias2, weights2 = toxicity._fit(counts[chosen], y[chosen], [0.25, 1.0])
    assert bias2 == pytest.approx(bias, abs=0.15) and np.abs(weights2 - weights).max() < 0.15


def test_toxicity_learns_stems(spark, docs, empty):
    rng = random.Random(4)
    table, labels = [], []
    for i in range(1500):
        toxic = i % 10 == 0
        w = prose(rng, 40, most=3).replace("0", "o").replace("1", "ee").replace("2", "u").replace("3", "y").split()
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = "zorg" + rng.choice(["ed", "ing", "", "st"])
        table.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    frame, marks = spark.createDataFrame(table, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(frame, marks, common.fold("doc_id", 5) != 0)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(frame, model).collect()}
    assert sum(got[i] == y for i, y in labels) >= 1495
    assert {r["doc_id"] for r in toxicity.reject(frame, marks).collect()} == {i for i, p in got.items() if not p}
    plain = once(toxicity.score(docs, model).collect())
    assert all(0 <= r["score"] <= 1 for r in plain.values()) and plain[0]["score"] == plain[1]["score"]
    assert toxicity.score(empty, toxicity.learn(empty, marks.limit(0), F.lit(True))).count() == 0
