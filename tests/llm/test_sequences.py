"""Periodic runs, byte-level BPE and conversation repair against brute force, and their queries on a given table."""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import random
import re
import zlib
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers
from gridspark.llm import byte_bpe, common, conversations, periodic_runs

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()
CLASHING = ["_id", "_text", "_h", "_w", "_c", "_code", "_turn", "_pos", "n_runs", "n_tokens", "audit", "_rule"]


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# Periodic runs -----------------------------------------------------------------------------------------------------


def runs_by_definition(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if len(part) >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, len(part), q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def run_row(words):
    runs = runs_by_definition(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = None if not runs else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, SHA("".join("%d,%d,%d\n" % r for r in runs)), SHA(" ".join(x for i, x in enumerate(words) if i not in dropped)))


RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def periodic_words(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        k = rng.choice([1, 2, 3, 50])
        if rng.random() < 0.5:
            out += [str(rng.randrange(k)) for _ in range(rng.randint(0, 30))]
        else:
            out += ([str(rng.randrange(k)) for _ in range(rng.randint(1, 25))] * 200)[: rng.randint(0, 150)]
    return out


def test_runs_of_many_texts_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK_BYTES", 1500)
    rng = random.Random(2)
    texts = [" ".join(periodic_words(rng)).encode() for _ in range(800)]
    found = list(periodic_runs.runs_of([*texts, None, b"", b" \t\n"]))
    assert len(found) == 803 and found[-3:] == [([], [])] * 3
    assert sum(len(r) for _, r in found) > 1000
    for t, (words, runs) in zip(texts, found):
        assert words == t.split() and runs == runs_by_definition(words)


def test_seed_lengths_reach_every_run():
    for low, high, k in periodic_runs.classes(10_000):
        for q in range(low, high + 1):
            assert 2 * q - 1 <= k <= max(6, 4 * q) - q
    assert [c[0] for c in periodic_runs.classes(10_000)][1:] == [c[1] + 1 for c in periodic_runs.classes(10_000)][:-1]


def test_runs_of_rows(spark):
    rng = random.Random(3)
    rows = [(i, " \t".join(periodic_words(rng)) + "\n") for i in range(300)]
    rows += [(None, None), (None, "a " * 40), (1, "x " * 9), (1, "x " * 9), (400, ""), (401, " \n"), (402, "ab " * 200_000), (403, "Ä b " * 12), (404, "A a " * 6)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(docs), digest=True)
    assert got.columns == ["doc_id", *RUN_COLUMNS]
    found = Counter((r["doc_id"], *[r[c] for c in RUN_COLUMNS]) for r in got.collect())
    short = [(i, t) for i, t in rows if i != 402]
    for (i, t), n in Counter(short).items():
        assert found[(i, *run_row(planted(i, WORD.findall(t or ""))))] == n, i
    long = next(r for r in found if r[0] == 402)
    n = 200_000
    assert long[1:6] == (1, 0, n, 1, 1000 * n) and long[7] == SHA("ab")
    full = periodic_runs.periodic_runs(docs.filter("doc_id = 404"))
    row = full.first()
    assert [tuple(r) for r in row["runs"]] == [(0, 12, 2)] and row["collapsed"] == "A a"
    assert periodic_runs.periodic_runs(docs.filter("false"), digest=True).collect() == []


def test_op11_query(spark):
    from gridspark.llm.workload import QUERIES

    docs = {r["doc_id"]: r["text"] for r in common.read(spark, SF, "documents").collect()}
    got = QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert len(got) == len(docs) and any(r["n_runs"] for r in got)
    for r in got:
        assert tuple(r[c] for c in RUN_COLUMNS) == run_row(planted(r["doc_id"], WORD.findall(docs[r["doc_id"]] or ""))), r["doc_id"]


# Byte-level BPE ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(4)
    out = [None, "", " ", "\n\n  x", "don't  DON'T", "<|endoftext|>", "a" * 5000, "ab" * 3000, " " * 3000, "é‍👩‍👩‍👧", "\x1c\x85᠎　x", "".join(rng.choice("abcdefgh") for _ in range(20_000))]
    for _ in range(400):
        kinds = rng.choice([[(97, 123), (32, 33)], [(32, 127)], [(0xA0, 0x250), (32, 48)], [(0x4E00, 0x4F00), (0x600, 0x700), (0x1F600, 0x1F640)]])
        out.append("".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randint(0, 150))))
    return out


def test_byte_bpe_equals_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "null id"), (0, "again"), (0, "again")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    got = Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), bytes(r["decoded"])) for r in byte_bpe.encode(docs).collect())
    for (i, t), n in Counter(rows).items():
        ids = library.encode_ordinary(t or "")
        assert got[(i, len(ids), tuple(ids), (t or "").encode())] == n, i
    assert byte_bpe.encode(docs.filter("false")).collect() == []


def test_every_letter_is_cut_as_the_library_cuts(library):
    e = byte_bpe.ByteEncoder(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3500 or c % 53 == 0)]
    texts = [f"a{chr(c)}a 1{chr(c)}1 {chr(c)}{chr(c)}!" for c in points]
    for t, (_, ids, decoded) in zip(texts, e.encode_block(texts)):
        assert ids == " ".join(map(str, library.encode_ordinary(t))) and decoded == t.encode(), hex(ord(t[1]))


def test_rank_files_whose_merges_go_back(tmp_path):
    """Ranks in no order: merges that make a pair of lower rank than their own must be taken as the library takes them."""
    went_back = 0
    for seed in range(60):
        rng = random.Random(seed)
        longer = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(25)})
        rng.shuffle(longer)
        ranks = {t: i for i, t in enumerate([bytes([b]) for b in range(256)] + longer)}
        path = tmp_path / f"{seed}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
        own = byte_bpe.ByteEncoder(str(path), public_tokenizers.PATTERN)
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        single = own.by_itself
        own.by_itself = lambda w: (calls.append(w), single(w))[1]  # noqa: B023
        calls = []
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(60)]
        for w, (_, ids, _) in zip(words, own.encode_block(words)):
            assert ids == " ".join(map(str, library.encode_ordinary(w))), (seed, w)
        went_back += len(calls)
    assert went_back


def test_one_very_long_word():
    e = byte_bpe.ByteEncoder(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(5)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(300_000)).encode()
    assert e.replay([word])[0] == e.by_itself(word)


def test_op12_query(spark, library):
    from gridspark.llm.workload import QUERIES

    docs = {r["doc_id"]: r["text"] or "" for r in common.read(spark, SF, "documents").collect()}
    got = QUERIES["op12_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), SHA(" ".join(map(str, ids))), SHA(text))


# Conversations -----------------------------------------------------------------------------------------------------

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def cheapest(rows):
    """(cost, audit, lines) by a search over (cost, letters): rows are (initial, role, text, must go, cut off)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in seen:  # the first to come is the cheapest and least
            continue
        seen.add((i, state))
        need = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", i, need[0], (*lines, need + ":")))
        if i < len(rows):
            initial, role, text, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if not gone:
                if initial == need[0] or initial == "s" and state == "":
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, initial, (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, need[0], (*lines, f"{need}:{text}")))


def repaired(rows):
    """Result of one conversation from (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], SHA(r[2])))
    faults, seen, coded = Counter(), set(), []
    for _, role, text in rows:
        text_only = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not text_only else "duplicate" if (role, text) in seen else "truncated" if text_only[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        coded.append((role[:1], role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
    cost, audit, lines = cheapest(coded)
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, SHA("\n".join(lines)))


def damage(conv, rows):
    out = []
    for turn, role, text in rows:
        spelt = ":".join(" " if x is None else str(x) for x in (conv, turn))
        rule, text = zlib.crc32(spelt.encode()) % 20, " " if text is None else text
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out += [(turn, "user" if rule == 4 else role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
    return out


def conversation(rng, n):
    texts = ["Yes.", "No", " ", "", None, "Why?\n", "so ", "go! ", "a" * 50, *[f"t{i}." for i in range(40)]]
    roles = rng.choice([["user", "assistant"], ["system", "user", "assistant", "user", "assistant", "assistant"], ["system", "user", "assistant", "tool", "", None, "usher"]])
    return [(rng.choice([None, i, i, i, i, i // 2]), rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[i % 2], rng.choice(texts)) for i in range(n)]


def test_auction_finds_the_least_cheapest_edits():
    rng = random.Random(6)
    for _ in range(400):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 1, 2, 5, 6, 9, 10, 8, 11]) for _ in range(rng.randint(0, 150)))
        rows = [("suat"[c % 4], "", "", bool(c & 4), bool(c & 8)) for c in codes]
        assert conversations.repair(codes) == cheapest(rows)[:2]


def test_prices_are_feasible_and_exact():
    rng = random.Random(7)
    for _ in range(60):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 9, 10]) for _ in range(20))
        end = (0, 6, 3, 0)
        prices = conversations.solve(codes, end)
        arcs = conversations._lattice(codes)
        assert all(prices[i] <= cost + prices[to] for i, own in enumerate(arcs) for _, cost, to in own)
        exact = [None] * len(arcs) + list(end)
        for layer in range(len(codes) - 1, -1, -1):
            best = [min(cost + exact[to] for _, cost, to in arcs[4 * layer + q] if to >= 4 * layer + 4) for q in range(4)]
            for _ in range(3):
                best = [min([best[q], *[cost + best[to - 4 * layer] for _, cost, to in arcs[4 * layer + q] if to < 4 * layer + 4]]) for q in range(4)]
            exact[4 * layer : 4 * layer + 4] = best
        assert prices[:4] == exact[:4]


@pytest.mark.parametrize("large", [(10_000, 10**9, 4096), (12, 10**9, 5), (0, 0, 1), (0, 0, 64)], ids=["small", "mixed", "blocks of one", "blocks"])
def test_conversations(spark, large):
    rng = random.Random(8)
    convs = {i: conversation(rng, rng.choice([0, 1, 2, 3, 5, 9, 30])) for i in range(60)} | {100: conversation(rng, 300), None: conversation(rng, 7), 101: [(1, "user", "same.")] * 40, 102: [(None, "user", "x" * 70_000 + ".")] * 3}
    rows = [(c, *r) for c, rs in convs.items() for r in rs]
    rng.shuffle(rows)
    df = with_clashes(spark.createDataFrame(rows, CONV).repartition(5))
    got = conversations.repair_conversations(df, large_rows=large[0], large_chars=large[1], block_rows=large[2])
    found = {r["conv_id"]: tuple(r[c] for c in (*COUNTS, "audit", "repaired_sha256")) for r in got.collect()}
    assert found == {c: repaired(rs) for c, rs in convs.items() if rs}


def test_no_conversations(spark):
    assert conversations.repair_conversations(spark.createDataFrame([], CONV)).collect() == []


def test_op13_query(spark, tmp_path):
    from gridspark.llm.workload import QUERIES

    def check(sf):
        convs = {}
        for r in common.read(spark, sf, "conversations").collect():
            convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
        got = QUERIES["op13_conversation_repair"](spark, sf).collect()
        assert len(got) == len(convs)
        for r in got:
            assert tuple(r[c] for c in (*COUNTS, "audit", "repaired_sha256")) == repaired(damage(r["conv_id"], convs[r["conv_id"]])), r["conv_id"]

    check(SF)
    rng = random.Random(9)
    rows = [(c, *r) for c in [*range(80), None] for r in conversation(rng, rng.choice([1, 2, 6]))]
    spark.createDataFrame(rows, CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    check(str(tmp_path))
