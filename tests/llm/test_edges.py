"""Odd column names, very long words and texts, late writers, rows without an id: cases that the other tests do not reach."""

from __future__ import annotations

import random
import time

import corpus_pipeline
import public_tokenizers
import pytest
from gridspark.llm import bpe, common, exact_dedup, jaccard_join, mixing, quality_rules, token_counts, toxicity
from gridspark.llm.workload import QUERIES, SQL
from pyspark.sql import functions as F
from test_llm import prose

ODD = ["_sha", "_text", "_copies", "_of", "_stays", "_taken_id", "_copy", "_id", "_TEXT_", "_n", "_counts", "copies", "kept"]


def odd_docs(spark):
    rng = random.Random(31)
    rows = [(i, prose(rng, 60)) for i in range(40)]
    rows += [(None, rows[3][1]), (None, "null id, own text"), (None, "null id, own text"), (5, rows[7][1]), (5, "same id, other text"), (90, rows[8][1]), (91, None), (92, "")]
    docs = spark.createDataFrame([(i, t, "aa", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in ODD if c != "_TEXT_"})


def odd_values(rows):
    return all(r[c] == c + (str(r["doc_id"]) if r["doc_id"] is not None else "-") for r in rows for c in ODD if c != "_TEXT_")


def test_stages_give_columns_of_any_name_back(spark, tmp_path):
    docs = odd_docs(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.keep(stage(spark, docs, str(tmp_path)), "odd")
        rows = docs.collect()
        assert docs.columns == odd_docs(spark).columns and rows and odd_values(rows)
    stayed = exact_dedup.deduplicate(odd_docs(spark)).collect()
    texts = [" ".join((r["text"] or "").split()) for r in stayed]
    assert len(texts) == len(set(texts)) == 43
    own = {r["doc_id"]: r["text"] for r in odd_docs(spark).filter("doc_id in (7, 8)").collect()}
    of_five = {r["text"] for r in stayed if r["doc_id"] == 5}
    assert {"same id, other text", own[7]} < of_five and len(of_five) == 3  # the row of id 7 is the later copy
    assert [r["text"] for r in stayed if r["doc_id"] is None] == ["null id, own text"]
    assert {r["doc_id"] for r in stayed if r["text"] in own.values()} == {5, 8}
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs(spark), str(tmp_path)).count() == 48
    assert jaccard_join.one_of_each(odd_docs(spark)).columns == odd_docs(spark).columns
    assert mixing.take(odd_docs(spark).limit(0)).count() == 0


def test_toxic_rows_go_row_by_row(spark):
    rng = random.Random(32)
    clean = [(i, prose(rng, 40), 0) for i in range(1, 200)]
    toxic = [(i, " ".join(w if k % 9 else "zorg" + rng.choice(["ed", "ing"]) for k, w in enumerate(prose(rng, 50).split())), 1) for i in range(200, 300)]
    rows = clean + toxic
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    extra = [(None, toxic[0][1], 1), (None, clean[0][1], 0), (200, clean[1][1], 0), (1, toxic[1][1], 1)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, y int")
    left = toxicity.reject(docs, labels).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left))) == sorted(map(str, ((i, t) for i, t, y in rows + extra if not y)))
    named = toxicity.reject(docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))
    assert named.filter("y = 1").count() == 0 and named.count() == len(left)


def test_windows_of_long_texts_keep_their_hash(spark):
    n = 300_000
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i.cast("string"))))
    docs = spark.range(0, 2, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, words).otherwise(F.concat(words, F.lit(" w1 w2 w3"))).alias("text"))
    got = {r["doc_id"]: r for r in quality_rules.statistics(docs).collect()}
    assert (got[0]["n_words"], got[0]["n_repeat_words"]) == (n, 0)
    assert (got[1]["n_words"], got[1]["n_repeat_words"]) == (n + 3, 6)
    several = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(2000)), lambda i: F.concat(F.lit("w"), i.cast("string"))).alias("w"))
    windows = common.keep(several, "words").select(F.explode(quality_rules._windows(F.col("w"))).alias("x")).select("x.*")
    word = lambda k: F.concat(F.lit("w"), (F.col("p") + k).cast("string"))
    assert windows.count() == 1999 and windows.filter(F.col("h") != F.xxhash64(word(0), word(1), word(2))).count() == 0


def test_a_late_writer_of_a_compacted_batch_adds_nothing(spark, tmp_path):
    schema = "op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, old_tokens long"
    rows = lambda n: spark.createDataFrame([("insert", "a", "x", "t", n, None, None, None, None)], schema)
    store = token_counts.Rollup(spark, str(tmp_path / "r"))
    assert store.apply("a", rows(10)) and store.apply("b", rows(10)) and store.compact("c")
    for _ in range(6):  # file names are random: some sort first
        store._commit("a", token_counts.deltas(rows(10)), [])
        assert [r["tokens"] for r in store.totals().collect()] == [20]
    assert store.apply("d", rows(1)) and store.compact("e")
    store._commit("b", token_counts.deltas(rows(10)), [])
    assert [r["tokens"] for r in store.totals().collect()] == [21]


def test_one_word_of_a_million_letters():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(bpe.VOCABULARY)
    library, own = Tokenizer.from_file(path), bpe.Encoder(path)
    rng = random.Random(33)
    for word in ("".join(rng.choice("etaoinshrdlu") for _ in range(3000)), "a" * 700, "ab" * 400, "é" * 300, "x" * 257):
        (ids, _), = own.encode_block([word + " y"])
        assert ids == b"".join(i.to_bytes(4, "little") for i in library.encode(word + " y", add_special_tokens=False).ids)
    start = time.perf_counter()
    own.encode_block(["".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))])
    assert time.perf_counter() - start < 60


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op11_periodic_runs", "op12_byte_bpe", "op13_conversation_repair")])
def test_every_query_returns_its_rows(spark, name):
    from compare import compare, duck

    if name in SQL:
        assert compare(QUERIES[name](spark, SF), duck(SF), SQL[name]) is None
        return
    got = QUERIES[name](spark, SF)
    docs = common.read(spark, SF, "documents")
    assert "doc_id" in got.columns and got.count() == docs.count()
    if "held_out" in got.columns:
        parts = 7 if name.startswith("op5") else 5
        assert got.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == (2 if parts == 7 else 0))).count() == 0


def test_frequent_words_are_scored_alike_where_they_are_read_and_in_shards(spark, monkeypatch):
    from gridspark.llm import kneser_ney

    docs = odd_docs(spark).unionByName(odd_docs(spark).withColumn("text", F.repeat(F.concat("text", F.lit(" the the end ")), 30)))
    monkeypatch.setattr(kneser_ney, "BLOCK_WORDS", 2000)
    monkeypatch.setattr(kneser_ney, "SHARD_WORDS", 3000)
    found = []
    for frequent in (1 << 16, 20, 0.5):
        monkeypatch.setattr(kneser_ney, "FREQUENT", frequent)
        rows, totals = kneser_ney.train_and_score(docs, common.fold("doc_id", 7) != 2)
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in rows.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == docs.count()


def test_languages_by_bundling_in_plain_python(spark, monkeypatch):
    """Prototypes and cosines from lists of numbers, gram by gram."""
    import math

    import numpy as np
    from gridspark.llm import hd_language

    monkeypatch.setattr(hd_language, "DIMENSIONS", 64)
    letters = {}

    def letter(c):
        if c not in letters:
            bits = np.random.Generator(np.random.Philox(key=[hd_language.SEED, ord(c)])).integers(0, 2, 64, dtype=np.int8)
            letters[c] = [2 * int(b) - 1 for b in bits]
        return letters[c]

    def moved(v, k):
        return v[-k:] + v[:-k]

    def document(text):
        kept = []
        for c in text.lower():
            if c.isalpha():
                kept.append(c)
            elif kept and kept[-1] != " ":
                kept.append(" ")
        if not any(c.isalpha() for c in kept):
            return None
        line = [" ", *kept, " "]
        sums = [0] * 64
        for a, b, c in zip(line, line[1:], line[2:]):
            for i, (x, y, z) in enumerate(zip(moved(letter(a), 2), moved(letter(b), 1), letter(c))):
                sums[i] += x * y * z
        return sums

    def unit(v):
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v]

    learned = [("Der Hund läuft.", "de"), ("die Katze schläft", "de"), ("the dog is running", "en"), ("Cats sleep all day", "en"), ("!!", "en"), ("le chien court", None)]
    asked = ["ein Hund", "a dog and a cat", "ÄÖÜ", "x", "  tail. ", "42 !", "", None]
    rows = spark.createDataFrame(learned, "text string, lang string")
    model = hd_language.learn(rows, "text", "lang", dimensions=64)
    protos = {}
    for text, lang in learned:
        v = document(text)
        if lang and v:
            protos[lang] = [x + y for x, y in zip(protos.get(lang, [0] * 64), unit(v))]
    assert model[0] == sorted(protos)
    for row, lang in zip(model[1], model[0]):
        assert row.tolist() == pytest.approx(unit(protos[lang]))
    got = {r["doc_id"]: r for r in hd_language.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(asked):
        v = document(text) if text else None
        if v is None:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        cosines = {lang: sum(x * y for x, y in zip(unit(p), unit(v))) for lang, p in protos.items()}
        best = max(cosines.values())
        assert cosines[got[i]["lang_pred"]] == pytest.approx(best) == got[i]["cosine"]
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp((c - best) / hd_language.TEMPERATURE) for c in cosines.values()))
