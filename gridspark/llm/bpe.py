"""BPE encoding and decoding with a public vocabulary file; merges are found by a segment tree over adjacent pair ranks.

Leaf i of a word's tree holds the rank of the pair that starts at symbol i; the root is the leftmost lowest-rank merge,
and a merge changes three leaves, each in logarithmic time. The trees of all new words of a block of documents stand in
one array, so a step merges once in each of them. Words met before come from a bounded cache.

Rows: a null or empty text has no tokens. Special tokens that stand in a text are recognised, as the vocabulary says.
Bytes that are no letters of any word (white space) are dropped by this vocabulary; decoding joins the tokens by spaces.
Very long texts and words are taken whole. Repeated rows, repeated and null ids are encoded row by row; an empty table gives an empty
result; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import in_arrow, read

VOCABULARY = "word_bpe_49k.json"
#: Words kept by a worker, and documents taken at a time.
CACHE_WORDS = 60_000
BLOCK_DOCS = 128
#: Words of more bytes are merged one by one.
LONG_WORD = 256
_NONE = np.int64(2**62)
# White space as the vocabulary's patterns mean it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        self.width = np.int64(max(self.tokens) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] for a, _ in pairs], dtype=np.int64) * self.width + np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pairs: dict[int, int] | None = None  # for long words only
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, str] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; _NONE where the vocabulary has no such merge or a symbol is missing (-1)."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.rank[at], _NONE)

    def _merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge each row (-1 after its end) until no pair is left; removed symbols become -1."""
        m, size = symbols.shape
        sym = np.concatenate([symbols, np.full((m, 1), -1, np.int64)], axis=1)
        place = np.arange(size, dtype=np.int64)
        after = np.tile(np.arange(1, size + 1, dtype=np.int64), (m, 1))
        before = np.tile(np.arange(-1, size, dtype=np.int64), (m, 1))
        tree = np.full((m, 2 * size), _NONE, np.int64)
        leaf = self._ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(m, size)
        tree[:, size:] = np.where(leaf < _NONE, leaf * size + place, _NONE)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            root = tree[rows, 1]
            i = root % size
            j = after[rows, i]
            k = after[rows, j]
            new = self.made[root // size]
            sym[rows, i], sym[rows, j] = new, -1
            after[rows, i] = k
            before[rows, k] = i
            h = before[rows, i]
            right = self._ranks(new, sym[rows, k])
            left = self._ranks(np.where(h >= 0, sym[rows, np.maximum(h, 0)], -1), new)
            for at, rank in ((j, np.full(len(rows), _NONE)), (i, right), (np.where(h >= 0, h, j), np.where(h >= 0, left, _NONE))):
                node = at + size
                tree[rows, node] = np.where(rank < _NONE, rank * size + at, _NONE)
                node = node >> 1
                while node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, 1] < _NONE]
        return sym[:, :-1]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same tree for one long word, in plain numbers: a step of the array form costs as much for one word as for thousands."""
        n = len(symbols)
        size = 1 << max(1, (n - 1).bit_length())
        width = int(self.width)
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), self.rank.tolist()))
        none, pair, made = int(_NONE), self.pairs.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        leaf = [pair(a * width + b, -1) for a, b in zip(symbols, symbols[1:])]
        tree = [none] * size + [r * size + i if r >= 0 else none for i, r in enumerate(leaf)] + [none] * (size - len(leaf))
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        while tree[1] < none:
            rank, i = divmod(tree[1], size)
            j = after[i]
            k = after[j]
            symbols[i], symbols[j] = int(made[rank]), -1
            after[i] = k
            if k < n:
                before[k] = i
            h = before[i]
            right = pair(symbols[i] * width + symbols[k], -1) if k < n else -1
            left = pair(symbols[h] * width + symbols[i], -1) if h >= 0 else -1
            for at, r in ((j, -1), (i, right), (h, left)):
                if at < 0:
                    continue
                node = size + at
                tree[node] = r * size + at if r >= 0 else none
                node >>= 1
                while node:
                    a, b = tree[2 * node], tree[2 * node + 1]
                    least = a if a < b else b
                    if tree[node] == least:
                        break
                    tree[node] = least
                    node >>= 1
        return [s for s in symbols if s >= 0]

    def learn(self, words: list[str]) -> None:
        """Encode words that the cache lacks. Words of about the same length share an array."""
        raw = [w.encode("utf-8", "replace") for w in words]
        lengths = np.array([len(r) for r in raw])
        for x in np.flatnonzero(lengths > LONG_WORD).tolist():
            ids = self._merge_long([*self.inner[list(raw[x][:-1])].tolist(), int(self.final[raw[x][-1]])])
            self.ids[words[x]], self.text[words[x]] = np.array(ids, "<u4").tobytes(), " ".join([self.tokens[i] for i in ids])
        lengths[lengths > LONG_WORD] = 0
        for bits in np.unique(np.ceil(np.log2(np.maximum(lengths, 2))).astype(int)):
            size = 1 << int(bits)
            mine = np.flatnonzero((lengths <= size) & ((lengths > size // 2) | (size == 2)) & (lengths > 0))
            step = max(1, (1 << 20) // size)
            for s in range(0, len(mine), step):
                part = mine[s : s + step]
                n = lengths[part]
                flat = np.frombuffer(b"".join(raw[x] for x in part), dtype=np.uint8)
                row, col = np.repeat(np.arange(len(part)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
                sym = np.full((len(part), size), -1, np.int64)
                sym[row, col] = np.where(col == np.repeat(n - 1, n), self.final[flat], self.inner[flat])
                sym = self._merge(sym)
                held = sym >= 0
                ids, ends = sym[held].astype("<u4"), np.cumsum(held.sum(axis=1))
                data, texts = ids.tobytes(), [self.tokens[x] for x in ids.tolist()]
                start = 0
                for x, e in zip(part.tolist(), ends.tolist()):
                    self.ids[words[x]], self.text[words[x]] = data[4 * start : 4 * e], " ".join(texts[start:e])
                    start = e

    def pieces(self, text: str) -> list[str]:
        """Words of a text after NFC and lower case; special tokens stay as they are."""
        parts = self.split.split(text) if self.split and "<|" in text else [text]
        out = []
        for p in parts:
            if p in self.special:
                out.append(p + "\0")  # no word has this character at its end, see below
            elif p:
                # Lower case letter by letter, so without the rule for a sigma at the end of a word.
                out += _PIECES.findall(unicodedata.normalize("NFC", p).replace("Σ", "σ").lower())
        return out

    def encode_block(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        if len(self.ids) > CACHE_WORDS:
            self.ids, self.text = {}, {}
        for s, i in self.special.items():
            self.ids[s + "\0"], self.text[s + "\0"] = np.array([i], "<u4").tobytes(), s
        words = [self.pieces(t or "") for t in texts]
        new = set().union(*words).difference(self.ids) if words else set()
        self.learn(sorted(new))
        return [(b"".join(map(self.ids.__getitem__, w)), " ".join(map(self.text.__getitem__, w))) for w in words]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, digest: bool = False) -> DataFrame:
    """``id_col, n_tokens`` with ``ids`` (array) and ``decoded`` (text), or with their SHA-256 where ``digest`` is set."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[id_col].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<long>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            for s in range(0, b.num_rows, BLOCK_DOCS):
                part = b.slice(s, BLOCK_DOCS)
                got = e.encode_block(part.column(1).to_pylist())
                out = {id_col: part.column(0), "n_tokens": pa.array([len(i) // 4 for i, _ in got], pa.int64())}
                if digest:
                    out["ids_sha256"] = pa.array([hashlib.sha256(i).hexdigest() for i, _ in got], pa.string())
                    out["decoded_sha256"] = pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for _, t in got], pa.string())
                else:
                    out["ids"] = pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i, _ in got], pa.list_(pa.int64()))
                    out["decoded"] = pa.array([t for _, t in got], pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    rows = docs.selectExpr(f"`{id_col}` as _id", f"cast(`{text_col}` as string) as _text")
    return in_arrow(rows, run, f"`{id_col}` {kind}, n_tokens long, {tail}")


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode(read(spark, sf, "documents"), digest=True)
