"""Language identification by hyperdimensional profiles.

Every letter has a random vector of -1 and 1, drawn from its code point. A three-letter gram binds (multiplies) the
vectors of its letters, permuted by their place; a document bundles (adds) its grams; a language's prototype bundles
the documents it was learned from. The language with the largest cosine to a document is predicted.

Rows: null or letterless texts are ``und`` with score 0. Rows without language are not learned from. Without any
prototype every text is ``und``. Ties go to the language that comes first by code point. Very long texts are taken whole. Repeated rows
and ids, and null ids, are judged row by row. An empty table gives an empty result. Columns other than id, text and language are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, read

DIMENSIONS = 1024
SEED = 20240229
#: Documents learned from per language, at most about so many, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 3000
#: Temperature that turns cosines into a score.
TEMPERATURE = 0.05
_GRAMS, _LETTERS, _SLICE = 40_000, 20_000, 2048


@lru_cache(maxsize=1)
def _alphabetic() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter grams of a text (three code points packed in one number) and their counts.

    Runs of anything but letters count as one space; a text without letters has no gram.
    """
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _alphabetic()[cp]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    held = letter.copy()
    held[1:] |= letter[:-1]
    seq = np.where(letter, cp, 32)[held].astype(np.int64)
    seq = np.concatenate([[32], seq, [32]])
    return np.unique((seq[:-2] << 42) | (seq[1:-1] << 21) | seq[2:], return_counts=True)


class Memory:
    """Vectors of letters and grams, made when met; both tables are emptied when they are full."""

    def __init__(self, dimensions: int, seed: int):
        self.d, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self._empty()

    def _empty(self) -> None:
        self.at: dict[int, int] = {}
        self.table = np.empty((_GRAMS, self.d), dtype=np.int8)

    def letter(self, c: int) -> np.ndarray:
        v = self.letters.get(c)
        if v is None:
            if len(self.letters) >= _LETTERS:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=[self.seed, c])).integers(0, 2, self.d, dtype=np.int8)
            v = self.letters[c] = (2 * bits - 1).astype(np.int8)
        return v

    def rows(self, codes: list[int]) -> np.ndarray:
        if len(self.at) + len(codes) > _GRAMS:
            self._empty()
        out = []
        for g in codes:
            i = self.at.get(g)
            if i is None:
                i = self.at[g] = len(self.at)
                a, b, c = g >> 42, (g >> 21) & 0x1FFFFF, g & 0x1FFFFF
                self.table[i] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            out.append(i)
        return self.table[out]

    def document(self, text: str) -> np.ndarray | None:
        codes, counts = grams(text)
        if not len(codes):
            return None
        v = np.zeros(self.d, dtype=np.float64)
        for s in range(0, len(codes), _SLICE):
            v += counts[s : s + _SLICE].astype(np.float32) @ self.rows(codes[s : s + _SLICE].tolist()).astype(np.float32)
        return v


@lru_cache(maxsize=1)
def _memory(d: int, seed: int) -> Memory:
    return Memory(d, seed)


def learn(rows: DataFrame, text_col: str, lang_col: str, dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their prototypes of length 1. Tasks bundle what they read; one sum per language and
    dimension joins the bundles."""

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, sums = _memory(dimensions, seed), {}
        for b in batches:
            for text, lang in zip(b["_text"], b["_lang"]):
                v = m.document(text)
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [x.tolist() for x in sums.values()]})

    known = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = known.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang")).mapInPandas(bundle, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
    table = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v")).orderBy("lang").collect()  # languages times dimensions
    langs = [r["lang"] for r in table]
    protos = np.array([[x["x"] for x in r["v"]] for r in table]) if table else np.zeros((0, dimensions))
    return langs, protos / np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``id_col, lang_pred, score, cosine``."""
    langs, protos = model
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = _memory(protos.shape[1], seed)
        for b in batches:
            out = []
            for text in b["_text"]:
                v = m.document(text) if text and langs else None
                if v is None:
                    out.append(("und", 0.0, None))
                    continue
                cosine = protos @ v / np.linalg.norm(v)
                best = int(np.argmax(cosine))
                out.append((langs[best], float(1 / np.exp((cosine - cosine[best]) / TEMPERATURE).sum()), float(cosine[best])))
            yield pd.DataFrame({id_col: b["_id"].array, "lang_pred": [x[0] for x in out], "score": [x[1] for x in out], "cosine": pd.Series([x[2] for x in out], dtype="float64")})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInPandas(run, f"`{id_col}` {kind}, lang_pred string, score double, cosine double")


def sample(docs: DataFrame, training: Column, id_col: str, lang_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Training rows, of each language about ``per_language`` at most."""
    rows = docs.filter(training & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row per language
    if not counts:
        return rows
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_language / n))]), F.col(lang_col))
    return rows.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share * 1_000_000)


def op9_hd_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    model = learn(sample(docs, fold("doc_id", 5) != 0, "doc_id", "lang"), "text", "lang")
    out = predict(docs, model)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "cosine")
