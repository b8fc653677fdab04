"""The corpus pipeline, stage by stage, against brute force on a small table with nulls, repeats and a very long text."""

from __future__ import annotations

import hashlib
import random
import struct
from collections import Counter

import corpus_pipeline
import pytest
from gridspark.llm import bpe, common
from test_llm import WORD, normal, prose, shingles, source_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, score string"
TOXIC = range(300, 400)


def table():
    rng = random.Random(21)
    base = prose(rng, 150)
    out = [(0, None), (1, ""), (2, " \n"), (3, "three short words"), (4, "three  short\nwords"), (5, prose(rng, 8000)), (7, "a row that repeats"), (7, "a row that repeats"), (None, "a row without id")]
    for i in range(10, 30):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        out.append((i, " ".join(w)))
    out += [(i, base.replace(" ", "\n" if i % 2 else "  ")) for i in range(30, 45)]
    out += [(i, prose(rng, rng.randint(20, 120))) for i in range(50, 300)]
    for i in TOXIC:
        w = prose(rng, 60).split()
        for _ in range(4):
            w[rng.randrange(60)] = "zorg" + rng.choice(["ed", "ing", "", "st"])
        out.append((i, " ".join(w)))
    return [(i, t, ("aa", None)[k % 2], (f"s{k % 4}", None)[k % 7 == 6], len(t or ""), k, "x") for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(table(), DOCS).repartition(3).write.parquet(f"{sf}/documents.parquet")
    labels = [(i, 1, int(i in TOXIC)) for i in range(50, 400)] + [(None, 1, 1), (60, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def key(rs):
    return sorted(map(str, map(tuple, rs)))


def near(rs):
    """Rows that stay when one of each group of similar texts does."""
    s = {r[0]: shingles(r[1]) for r in rs if r[0] is not None}
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
    return [r for r in rs if r[0] is None or top(r[0]) == r[0]]


def test_stages_and_run(spark, folder, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    seen, names = [], [name for name, _ in corpus_pipeline.STAGES]

    def watched(stage):
        return lambda spark, docs, sf: (seen.append(docs), stage(spark, docs, sf))[1]

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, watched(stage)) for name, stage in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, folder).collect()
    assert all(d.columns == seen[0].columns for d in seen)
    held = dict(zip(names, [[tuple(r) for r in d.collect()] for d in seen[1:]] + [[tuple(r) for r in last]]))
    clean = [r for r in table() if r[0] not in TOXIC]
    assert key(held["toxicity"]) == key(clean)
    first = {}
    for r in clean:
        t = normal(r[1])
        if t not in first or r[0] is not None and r[0] < first[t][0]:
            first[t] = r
    # Of a row that repeats either may stay.
    short = lambda rs: sorted((str(r[0]), r[1] or "") for r in rs)
    assert short(held["exact dedup"]) == short(first.values())
    assert key(held["jaccard join"]) == key(near(held["exact dedup"]))
    assert not {r[0] for r in held["jaccard join"]} & set(range(11, 45))

    words = lambda r: len(WORD.findall(r[1] or ""))
    size, taken = Counter(), Counter()
    for r in held["jaccard join"]:
        size[r[3]] += words(r)
    copies = Counter(held["mixing"])
    assert set(copies) <= set(held["jaccard join"]) and max(copies.values()) <= 3
    for r, n in copies.items():
        taken[r[3]] += n * words(r)
    for s, target in source_targets(size).items():
        longest = max(words(r) for r in held["jaccard join"] if r[3] == s)
        assert abs(taken[s] - target) <= max(0.05 * size[s], longest / 2 + 60), s

    t = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    wanted = []
    for r in held["mixing"]:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        wanted.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert key(held["bpe"]) == key(wanted)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
