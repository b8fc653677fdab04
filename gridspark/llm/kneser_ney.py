"""Language model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Texts travel as blocks: a task hashes the words of some thousand documents with numpy and deals sorted arrays to shards,
so a shuffled row stands for thousands of words. Pairs (history, word) are dealt by a grid of history and word, so that
a frequent word is spread over a whole row or column of shards; equal pairs of a block are summed first.

Training: shards count their pairs; word shards sum what all pair shards know of a word (count, histories before it,
followers by count); discounts come from counts of counts over the whole corpus; each pair shard asks the word shards
for the words it has and stores, per pair, sorted hashes and what the pair adds to the back-off score. Words that make up a
share of the corpus (a bounded list) are scored where the text is read; of the others a text sends each once. Scoring: a text's
score is the sum of log10 back-off weight and continuation probability of all its words (word shards) plus those
additions for the pairs that the model has (pair shards). Shards are memory-mapped from a file by the worker that uses
them. Nothing passes through the driver but the counts of counts and that list.

Rows: a null text is empty; every text has one end token. Words are held as 64-bit hashes, pairs within a shard as 40
bits, so of a million unseen pairs about one per million entries of a shard is taken for a seen one. Without training
texts every word has probability 1. Repeated ids and null ids are scored as rows of their own. Very long texts are taken whole, in memory
proportional to their words. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, fold, keep, read
from .hashing import blocks, mix, word_hashes

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Words of a block and of a shard, about; and pair shards for one word shard.
BLOCK_WORDS, SHARD_WORDS, PER_WORD_SHARD = 400_000, 1_000_000, 8
BLOCK_DOCS = 60_000
CHARS_PER_WORD = 6
#: Words that make up one in so many tokens, or histories, are known to every scoring task (at most twice as many words as this).
FREQUENT = 1 << 16
#: Gains are stored in steps of 1 / GAIN.
GAIN = 1 << 20
_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_SIDE = np.uint64(0x9FB21C651E98DF25)
_BLOB = "b1 binary, b2 binary, b3 binary, b4 binary"


class Grid:
    """Which shard a pair, and which word shard a word belongs to."""

    def __init__(self, chars: int):
        shards = max(4, chars // (CHARS_PER_WORD * SHARD_WORDS))
        self.rows = self.columns = int(np.ceil(np.sqrt(shards)))
        self.words = max(4, self.rows * self.columns // PER_WORD_SHARD)

    def pair(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        return ((mix(h) % np.uint64(self.rows)) * np.uint64(self.columns) + mix(w ^ _SIDE) % np.uint64(self.columns)).astype(np.int64)

    def word(self, w: np.ndarray) -> np.ndarray:
        return (mix(w + _SIDE) % np.uint64(self.words)).astype(np.int64)


def _pairs(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Histories, words and text numbers of all tokens, ends included."""
    hs, ws, ds = [], [], []
    for s, e in blocks(texts):
        words, at = word_hashes(texts[s:e])
        n = np.diff(at)
        ends = np.cumsum(n + 1) - 1
        w = np.full(len(words) + len(n), END, np.uint64)
        h = np.full(len(w), START, np.uint64)
        inner = np.ones(len(w), bool)
        inner[ends] = False
        w[inner] = words
        first = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
        later = np.ones(len(w), bool)
        later[first] = False
        h[later] = words
        hs.append(h)
        ws.append(w)
        ds.append(np.repeat(np.arange(s, e, dtype=np.int64), n + 1))
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in ((hs, np.uint64), (ws, np.uint64), (ds, np.int64)))


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and where their runs start."""
    at = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.empty(0, np.int64)
    return sorted_values[at], at


def _planes(x: np.ndarray) -> bytes:
    """An array's bytes, first bytes of all numbers first so that small numbers compress, packed."""
    return _PACK.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()) if len(x) else b""


def _unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    b = _UNPACK.decompress(b) if b else b
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _sorted_bytes(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as planes of their differences."""
    return _planes(np.diff(x, prepend=np.zeros(1, x.dtype)))


def _sorted_array(b: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(b, np.uint64), dtype=np.uint64)


def _mapped(x: np.ndarray) -> np.ndarray:
    """The array, mapped from a file that has no name and goes with the mapping."""
    if not len(x):
        return x
    with tempfile.TemporaryFile() as f:
        x.tofile(f)
        f.flush()
        return np.memmap(f, dtype=x.dtype, mode="r", shape=x.shape)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids with other columns, texts) of blocks of documents; the text is the last column."""
    rows, texts, held = [], [], 0
    for b in (whole.slice(s, 500) for whole in batches for s in range(0, whole.num_rows, 500)):
        cols = [c.to_pylist() for c in b.columns]
        for i, t in enumerate(cols[-1]):
            rows.append(tuple(c[i] for c in cols[:-1]))
            texts.append(t)
            held += len(t or "") // CHARS_PER_WORD + 1
            if held >= BLOCK_WORDS or len(texts) >= BLOCK_DOCS:
                yield rows, texts
                rows, texts, held = [], [], 0
    if texts:
        yield rows, texts


def _by_shard(shard: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shard and the entries of ``order`` in it; ``shard`` is in the order of ``order``."""
    by = np.argsort(shard, kind="stable")
    names, at = _runs(shard[by])
    for s, a, b in zip(names.tolist(), at.tolist(), [*at[1:].tolist(), len(by)]):
        yield s, order[by[a:b]]


def _count_pairs(docs: DataFrame, text_col: str, grid: Grid) -> DataFrame:
    """shard, sorted distinct histories and words, and per pair the place of its history and word and its count."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _taken(batches):
            h, w, _ = _pairs(texts)
            order = np.lexsort((w, h))
            h, w = h[order], w[order]
            at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
            n = np.diff(np.append(at, len(h))).astype(np.uint32)
            h, w = h[at], w[at]
            out = []
            for s, x in _by_shard(grid.pair(h, w), np.arange(len(h))):
                dh, runs = _runs(h[x])
                out.append((s, _sorted_bytes(dh), _planes(np.diff(np.append(runs, len(x))).astype(np.uint32)), w[x].tobytes(), _planes(n[x])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] + [pa.binary()] * 4)], names=["shard", "b1", "b2", "b3", "b4"])

    def merge(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.repeat(_sorted_array(a), _unplanes(b, np.uint32)) for a, b in zip(g["b1"], g["b2"])])
        w = np.concatenate([np.frombuffer(b, np.uint64) for b in g["b3"]])
        n = np.concatenate([_unplanes(b, np.uint32) for b in g["b4"]]).astype(np.int64)
        order = np.lexsort((w, h))
        h, w, n = h[order], w[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
        n = np.add.reduceat(n, at)
        h, w = h[at], w[at]
        dh, runs = _runs(h)
        dw = np.unique(w)
        place = np.searchsorted(dw, w).astype(np.uint32)
        counts = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        row = (int(key[0]), _sorted_bytes(dh), _planes(np.diff(np.append(runs, len(h))).astype(np.uint32)), _sorted_bytes(dw), _planes(place), _planes(n.astype(np.uint32)), *counts)
        return pd.DataFrame([row], columns=["shard", "hs", "runs", "ws", "place", "n", "n1", "n2", "n3", "n4"])

    dealt = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(deal, f"shard long, {_BLOB}")
    return dealt.groupBy("shard").applyInPandas(merge, "shard long, hs binary, runs binary, ws binary, place binary, n binary, n1 long, n2 long, n3 long, n4 long")


def _shard_arrays(r) -> tuple:
    hs, runs, ws = _sorted_array(r["hs"]), _unplanes(r["runs"], np.uint32).astype(np.int64), _sorted_array(r["ws"])
    return hs, runs, ws, _unplanes(r["place"], np.uint32).astype(np.int64), _unplanes(r["n"], np.uint32).astype(np.int64)


def _words(shards: DataFrame, grid: Grid) -> DataFrame:
    """One row per word shard: sorted words; count, distinct histories, followers seen once, twice and more often, and
    how often it is a history."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                hs, runs, ws, place, n = _shard_arrays(r)
                starts = np.cumsum(runs) - runs
                types = [np.add.reduceat(x.astype(np.int64), starts) for x in (n == 1, n == 2, n >= 3, n)]
                of_h = np.stack([np.zeros(len(hs), np.int64)] * 2 + types)
                of_w = np.zeros((6, len(ws)), np.int64)
                of_w[0], of_w[1] = np.bincount(place, weights=n, minlength=len(ws)), np.bincount(place, minlength=len(ws))
                out = []
                for words, stats in ((hs, of_h), (ws, of_w)):
                    for s, x in _by_shard(grid.word(words), np.arange(len(words))):
                        out.append((s, _sorted_bytes(words[x]), _planes(np.ascontiguousarray(stats[:, x]).ravel())))
                yield pd.DataFrame(out, columns=["wshard", "words", "stats"])

    def merge(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        words = [_sorted_array(b) for b in g["words"]]
        every = np.unique(np.concatenate(words))
        stats = np.zeros((6, len(every)), np.int64)
        for w, b in zip(words, g["stats"]):
            stats[:, np.searchsorted(every, w)] += _unplanes(b, np.int64).reshape(6, -1)
        types = stats[1]
        row = (int(key[0]), _sorted_bytes(every), _planes(stats.ravel()), int(stats[0].sum()), int((stats[0] > 0).sum()), int(types.sum()), *[int((types == k).sum()) for k in (1, 2, 3, 4)], int((types >= 3).sum()))
        return pd.DataFrame([row], columns=["wshard", "words", "stats", "tokens", "vocabulary", "types", "t1", "t2", "t3", "t4", "t3up"])

    dealt = shards.select("hs", "runs", "ws", "place", "n").mapInPandas(deal, "wshard long, words binary, stats binary")
    return dealt.groupBy("wshard").applyInPandas(merge, "wshard long, words binary, stats binary, tokens long, vocabulary long, types long, t1 long, t2 long, t3 long, t4 long, t3up long")


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from how many things occur 1, 2, 3 and 4 times; fixed ones if that is undefined."""
    n1, n2, n3, n4 = n
    plain = np.array([0.0, 0.5, 1.0, 1.5])
    if not (n1 and n2 and n3):
        return plain
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return d if (d[1:] > 0).all() and (d[1:] < [1, 2, 3]).all() else plain


class Totals:
    """What is known of the whole training corpus: counts of counts and the discounts they give."""

    def __init__(self, pairs: list[int], tokens: int, vocabulary: int, types: int, t: list[int], t3up: int):
        self.tokens, self.vocabulary, self.types = tokens, vocabulary, types
        self.d, self.dt = discounts(pairs), discounts(t)
        self.rest = float(self.dt[1] * t[0] + self.dt[2] * t[1] + self.dt[3] * t3up) / types if types else 1.0
        self.unseen = self.rest / (vocabulary + 1)

    def continuation(self, types: np.ndarray) -> np.ndarray:
        return np.maximum(types - self.dt[np.minimum(types, 3)], 0) / max(self.types, 1) + self.unseen

    def backoff(self, stats: np.ndarray) -> np.ndarray:
        """Weight that a history leaves to continuation; 1 for words that were never a history."""
        n = stats[5]
        return np.where(n > 0, (self.d[1] * stats[2] + self.d[2] * stats[3] + self.d[3] * stats[4]) / np.maximum(n, 1), 1.0)


    def values(self, words: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What one occurrence of each word adds: to the score without pairs, to the base score, to the known words.

        Every word is a word and, but for ends (which are never a history), a history once; starts are histories only.
        """
        real = words != START
        floor = float(np.log10(self.tokens + self.vocabulary + 1))
        score = np.log10(self.backoff(stats)) + np.where(real, np.log10(self.continuation(stats[1])), 0)
        return score, np.where(real, np.log10(stats[0] + 1.0) - floor, 0), (stats[0] > 0).astype(float)


def _frequent(words: DataFrame, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted words that occur, or are a history, in one of FREQUENT places, and their statistics."""
    least = max(1, int(tokens / FREQUENT))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for w, x in zip(b["words"], b["stats"]):
                w, x = _sorted_array(w), _unplanes(x, np.int64).reshape(6, -1)
                often = (x[0] >= least) | (x[5] >= least)
                yield pd.DataFrame({"words": [w[often].tobytes()], "stats": [np.ascontiguousarray(x[:, often].T).tobytes()]})

    found = words.select("words", "stats").mapInPandas(pick, "words binary, stats binary").collect()  # at most 2 * FREQUENT words
    w = np.concatenate([np.frombuffer(r["words"], np.uint64) for r in found]) if found else np.empty(0, np.uint64)
    x = np.concatenate([np.frombuffer(r["stats"], np.int64).reshape(-1, 6) for r in found]) if found else np.empty((0, 6), np.int64)
    order = np.argsort(w)
    return w[order], np.ascontiguousarray(x[order].T)


def train(docs: DataFrame, text_col: str, grid: Grid) -> tuple[DataFrame, DataFrame, Totals]:
    """Pair shards (shard, keys, gains), word shards (wshard, words, stats) and the totals."""
    shards = keep(_count_pairs(docs, text_col, grid), "pairs")
    words = keep(_words(shards, grid), "words")
    p = shards.agg(*[F.sum(f"n{k}") for k in (1, 2, 3, 4)]).first()
    t = words.agg(*[F.sum(c) for c in ("tokens", "vocabulary", "types", "t1", "t2", "t3", "t4", "t3up")]).first()
    t = [x or 0 for x in t]
    totals = Totals([x or 0 for x in p], t[0], t[1], t[2], t[3:7], t[7])
    words = words.select("wshard", "words", "stats")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                out = []
                for side, x in (("h", r["hs"]), ("w", r["ws"])):
                    x = _sorted_array(x)
                    out += [(s, int(r["shard"]), side, _sorted_bytes(x[i])) for s, i in _by_shard(grid.word(x), np.arange(len(x)))]
                yield pd.DataFrame(out, columns=["wshard", "shard", "side", "words"])

    def answer(key: tuple, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["shard", "side", "wshard", "x"])
        every = _sorted_array(known["words"].iloc[0])
        stats = _unplanes(known["stats"].iloc[0], np.int64).reshape(6, -1)
        of_w = totals.continuation(stats[1]).astype(np.float32)
        of_h = np.stack([stats[5].astype(np.float32), totals.backoff(stats).astype(np.float32)])
        out = []
        for shard, side, x in zip(asked["shard"], asked["side"], asked["words"]):
            i = np.searchsorted(every, _sorted_array(x))
            out.append((shard, side, int(key[0]), _planes(of_w[i]) if side == "w" else _planes(np.ascontiguousarray(of_h[:, i]).ravel())))
        return pd.DataFrame(out, columns=["shard", "side", "wshard", "x"])

    asked = shards.select("shard", "hs", "ws").mapInPandas(ask, "wshard long, shard long, side string, words binary")
    answers = keep(asked.groupBy("wshard").cogroup(words.groupBy("wshard")).applyInPandas(answer, "shard long, side string, wshard long, x binary"), "answers")

    def finish(key: tuple, own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        hs, runs, ws, place, n = _shard_arrays(own.iloc[0])
        of_h, of_w = np.zeros((2, len(hs))), np.zeros(len(ws))
        hw, ww = grid.word(hs), grid.word(ws)
        for side, s, x in zip(got["side"], got["wshard"], got["x"]):
            if side == "w":
                of_w[ww == s] = _unplanes(x, np.float32)
            else:
                of_h[:, hw == s] = _unplanes(x, np.float32).reshape(2, -1)
        at = np.repeat(np.arange(len(hs)), runs)
        low = of_h[1][at] * of_w[place]
        p = (n - totals.d[np.minimum(n, 3)]) / of_h[0][at] + low
        keys = _pair_keys(hs[at], ws[place])
        order = np.argsort(keys, kind="stable")
        keys, gains = keys[order], np.clip(np.rint((np.log10(p) - np.log10(low))[order] * GAIN), 0, 2**32 - 1).astype(np.uint32)
        return pd.DataFrame([(int(key[0]), _sorted_bytes(keys), _planes(gains))], columns=["shard", "keys", "gains"])

    model = keep(shards.drop("n1", "n2", "n3", "n4").groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(finish, "shard long, keys binary, gains binary"), "model")
    discard(shards)
    discard(answers)
    return model, words, totals


def _pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h) * np.uint64(3) + w) >> np.uint64(24)


def score(docs: DataFrame, model: DataFrame, words: DataFrame, totals: Totals, grid: Grid, id_col: str, text_col: str) -> DataFrame:
    """``id_col, n_tokens, n_known, base_score, score``, one row per document."""
    kind = docs.schema[id_col].dataType.simpleString()
    often, stats_of_often = _frequent(words, totals.tokens)
    worth = np.stack(totals.values(often, stats_of_often))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for k, (rows, texts) in enumerate(_taken(batches)):
            block = TaskContext.get().partitionId() * 2**31 + k
            h, w, d = _pairs(texts)
            d = d.astype(np.uint16)
            keys = _pair_keys(h, w)
            order = np.argsort(keys)
            out = [("pair", s, block, _sorted_bytes(keys[x]), _planes(d[x]), None, None, None) for s, x in _by_shard(grid.pair(h[order], w[order]), order)]
            # Frequent words are summed here, so that no shard gets all texts of one. The others go out once per text, with their number.
            every = np.concatenate([w, np.full(len(texts), START, np.uint64)])
            at = np.concatenate([d, np.arange(len(texts)).astype(np.uint16)])
            place = np.minimum(np.searchsorted(often, every), max(len(often) - 1, 0))
            known = often[place] == every if len(often) else np.zeros(len(every), bool)
            here = np.concatenate([np.bincount(at[known], weights=v[place[known]], minlength=len(texts)) for v in worth])
            every, at = every[~known], at[~known]
            order = np.lexsort((at, every))
            every, at = every[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], (every[1:] != every[:-1]) | (at[1:] != at[:-1])])) if len(every) else np.empty(0, np.int64)
            times = np.diff(np.append(first, len(every))).astype(np.uint32)
            every, at = every[first], at[first]
            for s, x in _by_shard(grid.word(every), np.arange(len(every))):
                dw, runs = _runs(every[x])
                out.append(("word", s, block, _sorted_bytes(dw), _planes(np.diff(np.append(runs, len(x))).astype(np.uint32)), _planes(at[x]), _planes(times[x]), None))
            out.append(("text", block, block, _planes(here), None, None, _planes(np.bincount(d, minlength=len(texts)).astype(np.int64)), [r[0] for r in rows]))
            types = [pa.string(), pa.int64(), pa.int64()] + [pa.binary()] * 4 + [pa.list_(ids)]
            for s in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[s : s + 64]), types)], names=names)

    names = ["kind", "shard", "block", "b1", "b2", "b3", "b4", "ids"]
    from pyspark.sql.pandas.types import to_arrow_type

    ids = to_arrow_type(docs.schema[id_col].dataType)
    columns = ["block", "x", "b4", "ids"]

    def look_up(key: tuple, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        what, out = key[0], []
        if not len(asked):
            return pd.DataFrame(columns=columns)
        if what == "text":
            return pd.DataFrame({"block": asked["block"], "x": asked["b1"], "b4": asked["b4"], "ids": asked["ids"]})
        if what == "pair":
            keys = _mapped(_sorted_array(known["b1"].iloc[0])) if len(known) else np.empty(0, np.uint64)
            gains = _mapped(_unplanes(known["b2"].iloc[0], np.uint32)) if len(known) else np.empty(0, np.uint32)
            for block, b1, b2 in zip(asked["block"], asked["b1"], asked["b2"]):
                k, d = _sorted_array(b1), _unplanes(b2, np.uint16)
                if len(keys):
                    i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                    hit = keys[i] == k
                    gain = np.bincount(d[hit], weights=gains[i[hit]] / GAIN, minlength=int(d.max()) + 1)
                    out.append((block, _planes(np.concatenate([gain, np.zeros(2 * len(gain))])), None, None))
            return pd.DataFrame(out, columns=columns)
        every = _mapped(_sorted_array(known["b1"].iloc[0])) if len(known) else np.empty(0, np.uint64)
        stats = _mapped(_unplanes(known["b2"].iloc[0], np.int64)).reshape(6, -1) if len(known) else np.zeros((6, 0), np.int64)
        for block, b1, b2, b3, b4 in zip(asked["block"], asked["b1"], asked["b2"], asked["b3"], asked["b4"]):
            w, runs, d, times = _sorted_array(b1), _unplanes(b2, np.uint32).astype(np.int64), _unplanes(b3, np.uint16), _unplanes(b4, np.uint32)
            s = np.zeros((6, len(w)), np.int64)
            if len(every):
                i = np.minimum(np.searchsorted(every, w), len(every) - 1)
                hit = every[i] == w
                s[:, hit] = stats[:, i[hit]]
            n = int(d.max()) + 1
            sums = [np.bincount(d, weights=np.repeat(v, runs) * times, minlength=n) for v in totals.values(w, s)]
            out.append((block, _planes(np.concatenate(sums)), None, None))
        return pd.DataFrame(out, columns=columns)

    def total(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        head = g[g["b4"].notna()].iloc[0]
        tokens = _unplanes(head["b4"], np.int64)
        sums = np.zeros((3, len(tokens)))
        for x in g["x"]:
            if x:
                part = _unplanes(x, np.float64).reshape(3, -1)
                sums[:, : part.shape[1]] += part
        return pd.DataFrame({id_col: pd.Series(list(head["ids"]), dtype="Int64" if kind in ("bigint", "int") else object), "n_tokens": tokens, "n_known": np.rint(sums[2]).astype(np.int64), "base_score": sums[1], "score": sums[0]})

    dealt = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(deal, f"kind string, shard long, block long, {_BLOB}, ids array<{kind}>")
    known = model.select(F.lit("pair").alias("kind"), "shard", F.col("keys").alias("b1"), F.col("gains").alias("b2")).unionByName(words.select(F.lit("word").alias("kind"), F.col("wshard").alias("shard"), F.col("words").alias("b1"), F.col("stats").alias("b2")))
    parts = dealt.groupBy("kind", "shard").cogroup(known.groupBy("kind", "shard")).applyInPandas(look_up, f"block long, x binary, b4 binary, ids array<{kind}>")
    return parts.groupBy("block").applyInPandas(total, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double")


def train_and_score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Totals]:
    """Scores of all rows under the model of those for which ``training`` holds."""
    grid = Grid(docs.agg(F.sum(F.length(F.col(text_col).cast("string")))).first()[0] or 0)
    model, words, totals = train(docs.filter(training), text_col, grid)
    return score(docs, model, words, totals, grid, id_col, text_col), totals


def op5_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    scored, totals = train_and_score(read(spark, sf, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
