"""What toxicity workers hold: texts in small parts, one lexicon, rows as Arrow has them."""

from __future__ import annotations

import numpy as np

from gridspark.llm import toxicity

MODEL = {"stems": frozenset({"idi"}), "words": frozenset(), "bias": toxicity.BIAS, "weights": np.array(list(toxicity.READINGS.values()))}


def test_ids_beside_null_ids_stay_exact_and_rows_pass_in_parts(spark):
    n = 2 * toxicity.TEXTS + 1
    rows = [(2**60 + 1 + i if i % 5 else None, "you are an idiot" if i % 2 else None) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    scored = toxicity.score(docs, MODEL)
    found = scored.collect()
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    assert [r.n_plain + r.n_targeted for r in found] == [i % 2 for i in range(n)]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_a_worker_keeps_one_bounded_lexicon():
    first = toxicity._lexicon(frozenset({"abc"}), frozenset())
    first.classes(" ".join("w" + chr(97 + i % 26) * (1 + i // 26 % 26) + chr(97 + i // 676) for i in range(1000)))
    assert 0 < len(first) <= toxicity.CACHE_WORDS <= 100_000
    toxicity._lexicon(frozenset({"abd"}), frozenset())
    assert toxicity._lexicon.cache_info().currsize == 1
