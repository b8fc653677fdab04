"""What a Python worker gets and keeps: batches bounded in bytes, a bounded word cache, rows as Arrow has them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.llm import bpe, common, jaccard_join, toxicity

MODEL = {"stems": frozenset({"idi"}), "words": frozenset(), "bias": toxicity.BIAS, "weights": np.array(list(toxicity.READINGS.values()))}
OPERATORS = {
    "toxicity": lambda docs: toxicity.counts(docs, MODEL, "doc_id", "text"),
    "sets": lambda docs: jaccard_join.sets(docs, "doc_id", "text"),
    "fingerprints": lambda docs: jaccard_join.fingerprints(docs, "doc_id", "text", 5, 75, np.empty(0, np.uint64)),
    "bpe": lambda docs: bpe.encode(docs, digest=True),
}


@pytest.fixture
def batch_setting(spark):
    before = spark.conf.get(common._BATCH)
    yield
    spark.conf.set(common._BATCH, before)


@pytest.mark.parametrize("name", OPERATORS)
def test_batches_are_bounded_and_every_row_passes(spark, monkeypatch, tmp_path, batch_setting, name):
    spark.conf.set(common._BATCH, str(64 << 20))
    docs = spark.range(3000).coalesce(1).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 1000)).alias("text"))
    kind, log = type(docs), str(tmp_path / "sizes")
    plain = kind.mapInArrow

    def logged(self, run, schema, *more):
        def seen(batches):
            def noted():
                for b in batches:
                    with open(log, "a") as f:
                        f.write(f"{b.num_rows} {b.nbytes}\n")
                    yield b

            yield from run(noted())

        return plain(self, seen, schema, *more)

    monkeypatch.setattr(kind, "mapInArrow", logged)
    assert OPERATORS[name](docs).count() == 3000
    sizes = [tuple(map(int, line.split())) for line in open(log)]
    assert sum(n for n, _ in sizes) == 3000
    assert max(size for _, size in sizes) <= common.BATCH_BYTES + 10_000


def test_a_lower_bound_stays(spark, batch_setting):
    spark.conf.set(common._BATCH, "1m")
    common.in_arrow(spark.range(1), lambda batches: batches, "id long")
    assert spark.conf.get(common._BATCH) in ("1m", f"{1 << 20}b")


def test_encoding_passes_ids_as_they_are_without_pandas(spark):
    n = 2 * bpe.BLOCK_DOCS + 1
    rows = [(2**60 + 1 + i if i % 5 else None, None if i % 7 == 0 else f"Some words, {i}") for i in range(n)]
    out = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    found = out.collect()
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    assert all(r.n_tokens == len(r.ids) and (r.n_tokens == 0) == (t is None) for r, (_, t) in zip(found, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_the_word_cache_is_bounded_and_forgets_without_harm(monkeypatch):
    assert bpe.CACHE_WORDS <= 100_000
    one = bpe.Encoder(bpe.public_tokenizers.path(bpe.VOCABULARY))
    texts = [f"word{chr(97 + i % 26)} x{chr(97 + i // 26)}y and the rest" for i in range(200)]
    whole = one.encode_block(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    again = [x for t in texts for x in one.encode_block([t])]
    assert again == whole and len(one.ids) < 50
