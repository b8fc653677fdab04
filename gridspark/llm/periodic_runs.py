"""Periodic runs of words inside a text, found by seeds on diagonals that are extended once.

A run is a stretch of consecutive words with smallest period q, at least ``max(6, 4 * q)`` words long, that cannot be
made longer on either side. Along the diagonal of lag q its words agree ``length - q`` times, at least 5 times for
q = 1 and 3 * q times above. Periods are taken in classes [low, high] with one seed length k each: the agreement that
every run of the class guarantees, and at least ``2 * high - 1``. A window of that length inside a run has the run's own
period as its smallest, so the next occurrence of the same window is exactly one period on: it is enough to pair each
occurrence with the next one in the same text, never all of them with each other. Pairs whose lag lies in the class are
seeds; a table of how far each lag is covered lets every stretch be extended once.

Windows are compared by names, not by hashes: equal names mean equal words. Only the first sieve (windows of five words
that occur again in the same text) uses a hash, which can let too much through but nothing fall out.

Rows: a null or empty text, or one of white space, has no words and no runs. A null id stays null. Repeated rows and
repeated ids are looked at row by row. Very long texts are taken whole: memory is in proportion to the longest text, and
shorter ones share blocks. Runs of equal length tie by start, then by period. An empty table gives an empty result.
Columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, read

#: Bytes of text that are looked at together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
LEAST_WORDS, LEAST_PERIODS = 6, 4
_RUN = "struct<start: bigint, length: bigint, period: bigint>"


def classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(lowest period, highest period, seed length), until no run of a text of ``longest`` words is left out."""
    low, k = 1, LEAST_WORDS - 1
    while LEAST_PERIODS * low <= longest:
        high = (k + 1) // 2
        yield low, high, k
        low = high + 1
        k = (LEAST_PERIODS - 1) * low


def _dense(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each distinct key, counted from 0, and how many there are."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), bool)
    new[:1] = False
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new)
    return names, int(names[order[-1]]) + 1 if len(keys) else 0


def _sieve(x: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """True where the window of ``k`` symbols occurs again in the same text (by hash, so a little too often at most)."""
    h = np.zeros(len(x) - k + 1, np.uint64)
    for j in range(k):
        h = (h ^ x[j : len(x) - k + 1 + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    found = np.zeros(len(h), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def find_runs(x: np.ndarray, doc: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs. ``x`` holds the word numbers of several texts with a number of its own
    after each text, ``doc`` the text of each place, ``longest`` the words of the longest text."""
    first = LEAST_WORDS - 1
    if len(x) <= first:
        return []
    again = _sieve(x, doc, first)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
    start, size = edge[::2], edge[1::2] - edge[::2] + first - 1  # stretches that consist of windows which occur again
    runs: list[tuple[int, int, int]] = []
    place = name = left = None
    width = 0
    for low, high, k in classes(longest):
        long = size >= k
        if not long.any():
            break
        if place is None or long.sum() < len(size):
            start, size = start[long], size[long]
            ends = np.cumsum(size)
            place = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
            left = np.repeat(ends, size) - np.arange(ends[-1])  # symbols up to the end of the stretch
            name, count = _dense(x[place])
            width = 1
        while 2 * width <= k:  # names of windows twice as long
            b = np.minimum(np.arange(len(name)) + width, len(name) - 1)
            name, count = _dense(name * count + name[b])
            width *= 2
        at = np.flatnonzero(left >= k)
        key = name[at] * count + name[at + k - width]
        order = np.argsort(key, kind="stable")
        a, b = at[order[:-1]], at[order[1:]]
        a, lag = place[a], place[b] - place[a]
        pair = (key[order[:-1]] == key[order[1:]]) & (lag >= low) & (lag <= high)
        if pair.any():
            _extend(x, a[pair], lag[pair], k, runs)
    return runs


def _extend(x: np.ndarray, seed: np.ndarray, lag: np.ndarray, k: int, runs: list) -> None:
    """Extend seeds along their diagonals; places that a lag has covered are not looked at again."""
    order = np.lexsort((seed, lag))
    seed, lag = seed[order], lag[order]
    # Neighbouring seeds of one lag are one stretch: its first seed, and how far the last one reaches.
    new = np.ones(len(seed), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (seed[1:] != seed[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(seed)) - 1
    covered: dict[int, int] = {}
    for i, last, q in zip(seed[heads].tolist(), seed[tails].tolist(), lag[heads].tolist()):
        if i < covered.get(q, 0):
            continue
        end = last + k
        while end + q < len(x) and x[end] == x[end + q]:
            end += 1
        while i and x[i - 1] == x[i - 1 + q]:
            i -= 1
        covered[q] = end
        if end + q - i >= max(LEAST_WORDS, LEAST_PERIODS * q):
            runs.append((i, end + q - i, q))


def runs_of(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text; runs by start, then period."""
    held, size = [], 0
    for t in texts:
        held.append(t or b"")
        size += len(held[-1])
        if size >= BLOCK_BYTES:
            yield from _block(held)
            held, size = [], 0
    yield from _block(held)


def _block(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(n.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(n)), n + 1)
    ends = np.cumsum(n + 1) - 1
    x = np.empty(len(doc), np.int64)
    inside = np.ones(len(doc), bool)
    inside[ends] = False
    x[inside] = codes
    x[ends] = len(flat) + np.arange(len(n))
    found: dict[int, list] = {}
    for s, length, q in find_runs(x, doc, int(n.max()) if len(n) else 0):
        d = int(doc[s])
        found.setdefault(d, []).append((s - int(ends[d] - n[d]), length, q))
    for d, w in enumerate(words):
        yield w, sorted(found.get(d, ()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what a run repeats after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        step[s + q] += 1
        step[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_runs, start, length, period, exponent_milli`` of the longest run, with
    ``runs`` (array of start, length, period) and ``collapsed`` (text), or with their SHA-256 where ``digest`` is set.

    Nothing is shuffled: a text's runs lie in its own row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tail = "runs_sha256 string, collapsed_sha256 string" if digest else f"runs array<{_RUN}>, collapsed string"
    schema = f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, {tail}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, number, texts, lists = [], [], [], []
            for words, runs in runs_of(b.column(1).cast(pa.binary()).to_pylist()):
                number.append(len(runs))
                best.append(min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None))
                text = b" ".join(collapse(words, runs))
                if digest:
                    lists.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest())
                    texts.append(hashlib.sha256(text).hexdigest())
                else:
                    lists.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    texts.append(text.decode("utf-8"))
            long = lambda values: pa.array(values, pa.int64())
            start, length, period = (long([r[i] for r in best]) for i in range(3))
            milli = long([None if r[0] is None else 1000 * r[1] // r[2] for r in best])
            rest = [pa.array(lists, pa.string() if digest else pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), long(number), start, length, period, milli, *rest], names=[id_col, "n_runs", "start", "length", "period", "exponent_milli", *(("runs_sha256", "collapsed_sha256") if digest else ("runs", "collapsed"))])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col`` where about one text in ten repeats itself from some word on, by a rule on its id.

    With h = crc32 of the id as text and g = h / 10, texts with h % 10 = 0 repeat from word a = g % n on with period
    1 + (n - a) / (3 + g % 8). Texts without words, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col).cast("string"), WHITE), lambda w: w != "")

    def tail(w: Column, g: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
        period = F.slice(w, a + 1, p)
        again = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.concat_ws(" ", F.concat(F.slice(w, F.lit(1), a), again))

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col), h.alias("_h"))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    planted = F.when(F.size("_w") > 0, tail(F.col("_w"), F.floor(F.col("_h") / 10)))
    return rows.select(id_col, F.coalesce(planted, text_col).alias(text_col))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs(with_planted_runs(read(spark, sf, "documents")), digest=True)
