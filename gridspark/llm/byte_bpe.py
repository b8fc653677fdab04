"""Byte-level BPE with a public rank file; a block's new words are merged together, rank by rank.

The distinct words that a worker meets for the first time form a small corpus. An inverted index leads from each rank to
the places of the adjacent pairs that merge into it; ranks are replayed from the lowest to the highest, every place of a
rank is merged (from left to right inside a word), and only the two neighbours of a merged place get new entries. Each
merge is done once, so a word's cost grows with its length, not with its square.

Encoding one word by itself takes its lowest pair, wherever that is. Replay gives the same as long as no merge makes a
pair of a lower rank than its own. A word in which one does is encoded again by itself, with a heap of its pairs. A word
that is an entry of the rank file is that one token. Words met before come from a bounded cache.

Rows: a null or empty text has no tokens and decodes to nothing. Special tokens in a text are plain text. Very long texts
and words are taken whole, in memory proportional to their length. Repeated rows and ids, and null ids, are encoded row by row. An
empty table gives an empty result. Columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words in use kept by a worker (as many again are kept from before), and characters of text whose new words are merged together.
CACHE_WORDS = 250_000
BLOCK_CHARS = 1 << 22
_SHIFT = 20


class ByteEncoder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.bytes = {r: t for t, r in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        # Every way in which two entries make a third: left << _SHIFT | right -> rank of both together.
        self.pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << _SHIFT | b] = rank
        self.keys = np.array(sorted(self.pairs), np.int64) if self.pairs else np.array([-2], np.int64)
        self.made = np.array([self.pairs.get(k, -1) for k in self.keys.tolist()], np.int64)
        self.pattern = regex.compile(pattern)
        #: Words in use, and those in use before the cache was last full.
        self.cache: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _index(self, symbols: np.ndarray) -> tuple[dict[int, list[int]], list[int]]:
        """Places of each rank, ascending, and the rank of the pair at each place (-1: none)."""
        keys = symbols[:-1] << _SHIFT | symbols[1:]
        keys[(symbols[:-1] < 0) | (symbols[1:] < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = np.where(self.keys[at] == keys, self.made[at], -1)
        places = np.flatnonzero(found >= 0)
        ranks = found[places]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        index = {int(ranks[s]): places[s:e].tolist() for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]) if e > s}
        return index, [*found.tolist(), -1]

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word (not empty)."""
        pairs = self.pairs.get
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        starts = (np.cumsum(lengths) - lengths).tolist()
        table = np.array([*self.single, -1], np.int64)
        flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        flat[np.cumsum(lengths) - 1] = 256  # the end of a word
        index, rank_at = self._index(table[flat])
        symbols = table[flat].tolist()
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = list(index)
        heapq.heapify(queue)
        alone: set[int] = set()
        while queue:
            rank = heapq.heappop(queue)
            for i in sorted(index.pop(rank)):
                if rank_at[i] != rank:  # a neighbour was merged meanwhile
                    continue
                j = after[i]
                k = after[j]
                symbols[i], symbols[j] = rank, -2
                rank_at[i] = rank_at[j] = -1
                after[i] = k
                before[k] = i
                h = before[i]
                if h >= 0 and symbols[h] >= 0:
                    rank_at[h] = r = pairs(symbols[h] << _SHIFT | rank, -1)
                    if r >= 0:
                        if r < rank:
                            alone.add(bisect_right(starts, i) - 1)
                        if r in index:
                            index[r].append(h)
                        else:
                            index[r] = [h]
                            heapq.heappush(queue, r)
                if symbols[k] >= 0:
                    rank_at[i] = r = pairs(rank << _SHIFT | symbols[k], -1)
                    if r >= 0:
                        if r < rank:
                            alone.add(bisect_right(starts, i) - 1)
                        if r in index:
                            index[r].append(i)
                        else:
                            index[r] = [i]
                            heapq.heappush(queue, r)
        starts.append(size)
        return [self.by_itself(w) if n in alone else [s for s in symbols[starts[n] : starts[n + 1]] if s >= 0] for n, w in enumerate(words)]

    def by_itself(self, word: bytes) -> list[int]:
        """Always the leftmost of the pairs of lowest rank in this word."""
        pairs, symbols = self.pairs.get, [self.single[b] for b in word]
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i in range(size - 1) if (r := pairs(symbols[i] << _SHIFT | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= size or pairs(symbols[i] << _SHIFT | symbols[j]) != rank:
                continue
            k = after[j]
            symbols[i], symbols[j], after[i] = rank, -1, k
            if k < size:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < size and (r := pairs(symbols[left] << _SHIFT | symbols[right])) is not None:
                    heapq.heappush(heap, (r, left))
        return [s for s in symbols if s >= 0]

    def learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8") for w in new]
        whole = [self.ranks.get(w) for w in raw]
        rest = iter(self.replay([w for w, r in zip(raw, whole) if r is None]))
        for word, rank in zip(new, whole):
            ids = next(rest) if rank is None else [rank]
            self.cache[word] = (len(ids), " ".join(map(str, ids)), b"".join(map(self.bytes.__getitem__, ids)))

    def encode_block(self, texts: list[str | None]) -> list[tuple[int, str, bytes]]:
        """(number of ids, ids as decimal text joined by spaces, decoded bytes) of each text."""
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        words = [self.pattern.findall(t or "") for t in texts]
        new = set().union(*words).difference(self.cache) if words else set()
        known = new.intersection(self.older)
        self.cache.update(zip(known, map(self.older.__getitem__, known)))
        if len(new) > len(known):
            self.learn(sorted(new - known))
        out = []
        for ws in words:
            got = list(map(self.cache.__getitem__, ws))
            out.append((sum(g[0] for g in got), " ".join([g[1] for g in got]), b"".join([g[2] for g in got])))
        return out


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None, digest: bool = False) -> DataFrame:
    """``id_col, n_tokens`` with ``ids`` (array) and ``decoded`` (bytes), or with their SHA-256 where ``digest`` is set:
    of the decimal ids joined by one space, and of the decoded bytes. ``path`` is a rank file, ``pattern`` what cuts a text into words."""
    path = path or public_tokenizers.path(VOCABULARY)
    pattern = pattern or public_tokenizers.PATTERN
    kind = docs.schema[id_col].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<long>, decoded binary"
    names = [id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for b in batches:
            texts = b.column(1).to_pylist()
            for start, end in _blocks(texts):
                got = e.encode_block(texts[start:end])
                if digest:
                    rest = [pa.array([hashlib.sha256(i.encode()).hexdigest() for _, i, _ in got], pa.string()), pa.array([hashlib.sha256(d).hexdigest() for _, _, d in got], pa.string())]
                else:
                    rest = [pa.array([[int(x) for x in i.split()] for _, i, _ in got], pa.list_(pa.int64())), pa.array([d for _, _, d in got], pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), pa.array([n for n, _, _ in got], pa.int64()), *rest], names=names)

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, {tail}")


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_CHARS characters; a longer text is a range of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= BLOCK_CHARS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode(read(spark, sf, "documents"), digest=True)
