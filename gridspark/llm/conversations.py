"""Repair of conversation structure: the cheapest edits that give the roles ``(s?(ua)+)?``, by an auction for shortest paths.

A conversation is a lattice of integer costs: a node is a number of rows read and the state of the role pattern, an arc is
Keep (0), Rerole (3), Delete (4) or Insert (3); rows that are cut off cost 3 more unless deleted, blank rows and repeats must
go. Every node has a price that never exceeds what an arc costs plus the price at its end. The auction holds one path: if
some arc at its last node is tight the path grows by it, else that node's price rises to its cheapest arc and the path
gives the node up. When the path arrives, the price of its origin is its distance, and every arc of every cheapest path
is tight; of these the trace takes the least letter each time (D < I < K < R).

Prices only rise, by integers, so the work of an auction grows with length times distance. Lattices are therefore taken in
stretches of STRETCH rows from the end, each with the exact distances at its end as the prices there.

Conversations up to LARGE_ROWS rows and LARGE_CHARS characters are read as a sorted stream, one at a time. Larger ones, which may
hold a third of the table, are cut into blocks of rows: a block's table of costs from each state to each other is found by itself, the
tables are chained from the last block to the first in a stream that holds four numbers, each block is then traced from every state
it may be entered in, and a stream from the first block to the last picks the trace. Both ways give the same rows. What the result
itself has of any length, the audit of a conversation, is held by the task that returns it; repaired texts only pass a running hash.

Rows: a null conversation id is a conversation of its own. A null turn comes first; a null role or text is one space, also where a role,
a turn or an id is spelt out. Rows of the same turn are ordered by role, then by the SHA-256 of the text. A role is judged by its
first character; an empty one cannot be kept. Very long texts make a conversation a large one. Repeated rows are repeats, as the rule
says. An empty table gives an empty result. Only the four columns named are read, so the names of others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach, keep, read

#: A conversation above one of these is cut into blocks of BLOCK_ROWS.
LARGE_ROWS, LARGE_CHARS = 10_000, 16_000_000
BLOCK_ROWS = 4096
STRETCH = 32
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
# States: nothing yet, after s, after u, after a. A row's code is its role (s, u, a, other) + 4 if it must go + 8 if it is cut off.
_STATES = 4
_NEXT = (2, 2, 3, 2)
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_ROLE_OF = {1: "system", 2: "user", 3: "assistant"}
# What is still to be inserted after the last row.
_TO_END = (0, 2, 1, 0)
_END = tuple(n * INSERT for n in _TO_END)
# More than the distances of two states can differ by: what leaving through another state costs in a block's table.
_FAR = 64
_LEGAL = {(0, 1), (1, 2), (2, 1)}


@lru_cache(maxsize=None)
def _arcs(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, target: state, or state + 4 in the next layer), letters in ASCII order."""
    role, must_go, extra = code % 4, code & 4, CUT_OFF if code & 8 else 0
    arcs = [("D", DELETE, _STATES + state), ("I", INSERT, _NEXT[state])]
    if not must_go:
        if (state, role) in _KEPT:
            arcs.append(("K", KEEP + extra, _STATES + _KEPT[state, role]))
        arcs.append(("R", REROLE + extra, _STATES + _NEXT[state]))
    return tuple(arcs)


def _lattice(codes: bytes) -> list[list[tuple[str, int, int]]]:
    """The arcs of every node that has any; node = 4 * rows read + state."""
    return [[(letter, cost, _STATES * i + target) for letter, cost, target in _arcs(c, q)] for i, c in enumerate(codes) for q in range(_STATES)]


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> None:
    """Raise ``prices`` until a path of tight arcs leads from ``origin`` to a node without arcs; its price is then its distance."""
    path = [origin]
    while path[-1] < len(arcs):
        node = path[-1]
        least, to = min((cost + prices[target], target) for _, cost, target in arcs[node])
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def solve(codes: bytes, end: tuple[int, ...], origins: range | tuple[int, ...] = range(_STATES)) -> list[int]:
    """Prices of a lattice whose last layer has the prices ``end``; those of the origins (in the first layer) are exact."""
    prices = [min(end)] * (_STATES * len(codes)) + list(end)
    arcs = _lattice(codes)
    for origin in origins:
        auction(arcs, prices, origin)
    return prices


def trace(codes: bytes, prices: list[int], state: int) -> tuple[str, int]:
    """The least of the cheapest edits from ``state`` on, and the state they end in."""
    arcs = _lattice(codes)
    tight = [[(letter, to) for letter, cost, to in own if cost + prices[to] == prices[node]] for node, own in enumerate(arcs)]
    arrives = [False] * len(arcs) + [True] * _STATES
    for i in range(len(codes) - 1, -1, -1):
        for _ in range(3):  # inserts stay in the layer, three times at most
            for node in range(_STATES * i, _STATES * i + _STATES):
                arrives[node] = arrives[node] or any(arrives[to] for _, to in tight[node])
    letters, node = [], state
    while node < len(arcs):
        letter, node = next((letter, to) for letter, to in tight[node] if arrives[to])
        letters.append(letter)
    return "".join(letters), node - len(arcs)


def _stretches(codes: bytes, end: tuple[int, ...], origins=range(_STATES)) -> list[tuple[bytes, list[int]]]:
    """Stretches from the first to the last with their prices, solved from the end."""
    out = []
    starts = range(0, len(codes), STRETCH)
    for s in reversed(starts):
        part = codes[s : s + STRETCH]
        prices = solve(part, end, range(_STATES) if s else origins)
        out.append((part, prices))
        end = tuple(prices[:_STATES])
    return out[::-1]


def _trace_all(stretches: list[tuple[bytes, list[int]]], state: int) -> tuple[str, int]:
    letters = []
    for part, prices in stretches:
        piece, state = trace(part, prices, state)
        letters.append(piece)
    return "".join(letters), state


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return _repair_short(codes) if len(codes) <= STRETCH else _repair(codes)


def _repair(codes: bytes) -> tuple[int, str]:
    if not codes:
        return 0, ""
    stretches = _stretches(codes, _END, (0,))
    letters, state = _trace_all(stretches, 0)
    return stretches[0][1][0], letters + "I" * _TO_END[state]


_repair_short = lru_cache(maxsize=1 << 16)(_repair)


def table_of(codes: bytes) -> list[int]:
    """Costs from each state before the rows to each state after them, row by row; _FAR stands for ways round that never pay."""
    columns = []
    for q in range(_STATES):
        end = tuple(0 if x == q else _FAR for x in range(_STATES))
        stretches = _stretches(codes, end)
        columns.append(stretches[0][1][:_STATES])
    return [columns[q][s] for s in range(_STATES) for q in range(_STATES)]


def lines(audit: str, codes: bytes, state: int = 0) -> Iterator[tuple[int, str, str | None]]:
    """(row, letter, new role) for each edit; an insert names the row it stands before."""
    i = 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield i, letter, _ROLE_OF[state]
            continue
        if letter == "R":
            state = _NEXT[state]
            yield i, letter, _ROLE_OF[state]
        else:
            if letter == "K":
                state = _KEPT[state, codes[i] % 4]
            yield i, letter, None
        i += 1


def illegal_pairs(codes: bytes) -> int:
    roles = [c % 4 for c in codes]
    return sum((a, b) not in _LEGAL for a, b in zip(roles, roles[1:]))


# Rows -----------------------------------------------------------------------------------------------------------------


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """_c (id as text, never null), _id, _turn, _role, _text, _sha, _code without repeats."""
    conv, text = F.col(conv_col), F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    out = rows.select(
        F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("")).alias("_c"),
        conv.alias("_id"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("_role"),
        text.alias("_text"),
    )
    first = F.substring("_role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    blank = ~F.col("_text").rlike(r"[^\x20\x09-\x0D]")
    cut_off = ~blank & ~F.col("_text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return out.select("*", F.sha2("_text", 256).alias("_sha"), (role + 4 * blank.cast("int") + 8 * cut_off.cast("int")).alias("_code"))


_ORDER = ("_turn", "_role", "_sha")
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Pieces of batches that belong to one _c, and whether the piece begins one."""
    last = None
    for b in batches:
        if not len(b):
            continue
        c = b["_c"].to_numpy()
        cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)]
        for s, e in zip(cuts, cuts[1:]):
            yield b.iloc[s:e], c[s] != last
            last = c[s]


def _small(rows: DataFrame) -> DataFrame:
    """Conversations one at a time, from a sorted stream."""

    def one(parts: list[pd.DataFrame]) -> dict:
        p = pd.concat(parts) if len(parts) > 1 else parts[0]
        seen, codes, turns = set(), bytearray(), set()
        blank = duplicate = cut_off = 0
        for turn, role, text, code in zip(p["_turn"], p["_role"], p["_text"], p["_code"]):
            if turn is not None:
                turns.add(int(turn))
            if code & 4:
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
                code = code % 4 + 4
            else:
                seen.add((role, text))
                cut_off += code >> 3
            codes.append(code)
        codes = bytes(codes)
        cost, audit = repair(codes)
        roles, texts = p["_role"].tolist(), p["_text"].tolist()
        out = []
        for i, letter, role in lines(audit, codes):
            if letter != "D":
                out.append((role or roles[i]) + ":" + ("" if letter == "I" else texts[i]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        return {"_c": p["_c"].iat[0], "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": cut_off, "illegal": illegal_pairs(codes), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode("utf-8")).hexdigest()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, done = [], []
        for piece, begins in _groups(batches):
            if begins and held:
                done.append(one(held))
                held = []
                if len(done) >= 1000:
                    yield pd.DataFrame(done)
                    done = []
            held.append(piece)
        if held:
            done.append(one(held))
        if done:
            yield pd.DataFrame(done)

    stream = rows.select("_c", "_turn", "_role", "_text", "_sha", "_code").repartition("_c").sortWithinPartitions("_c", *_ORDER)
    return stream.select("_c", F.col("_turn").cast("string").alias("_turn"), "_role", "_text", "_code").mapInPandas(run, f"_c string, {_RESULT}")


def _stream(rows: DataFrame, order: list, step: Callable, schema: str) -> DataFrame:
    """Rows of a _c in order through one task, which holds a batch and what ``step`` carries: step(batch, carried or None) -> (rows out, carried)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = None
        for piece, begins in _groups(batches):
            out, carried = step(piece, None if begins else carried)
            if len(out):
                yield out

    return rows.repartition("_c").sortWithinPartitions("_c", *order).mapInPandas(run, schema)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of large conversations with their place: sorted by ranges over many tasks, places counted on from task to task."""
    total = rows.count()
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // 1_000_000))
    tied = rows.withColumn("_any", F.monotonically_increasing_id())  # equal rows may lie in different ranges
    kept = tied.repartitionByRange(parts, "_c", *_ORDER, "_any").sortWithinPartitions("_c", *_ORDER, "_any").drop("_any")
    # Task and place in the task are written down with the row: they do not change when it is read again.
    kept = keep(kept.withColumn("_at", F.monotonically_increasing_id()), "conversation_rows").withColumn("_task", F.shiftright("_at", 33))
    own = kept.groupBy("_c", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_c").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    out = attach(kept, own.drop("_first"), ["_c", "_task"], "_n", ["_at"])
    return out.withColumn("_pos", F.col("_at") + F.col("_offset")).drop("_at", "_offset", "_task")


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["_codes"] = [bytes(x.tolist()) for x in b["_list"]]
        b["_table"] = [table_of(c) for c in b["_codes"]]
        b["_illegal"] = [illegal_pairs(c) for c in b["_codes"]]
        yield b.drop(columns="_list")


def _distances(batch: pd.DataFrame, end: tuple[int, ...] | None) -> tuple[pd.DataFrame, tuple[int, ...]]:
    """Blocks from the last to the first: the distances at the end of each."""
    ends, costs, last = [], [], []
    for table in batch["_table"]:
        last.append(end is None)
        end = end or _END
        ends.append(list(end))
        end = tuple(min(table[_STATES * s + q] + end[q] for q in range(_STATES)) for s in range(_STATES))
        costs.append(end[0])
    return batch.drop(columns="_table").assign(_end=ends, _cost=costs, _last=last), end


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        pieces, ends = [], []
        for codes, end in zip(b["_codes"], b["_end"]):
            stretches = _stretches(codes, tuple(int(x) for x in end))
            found = [_trace_all(stretches, state) for state in range(_STATES)]
            pieces.append([p for p, _ in found])
            ends.append([e for _, e in found])
        yield b.drop(columns="_end").assign(_pieces=pieces, _ends=ends)


def _chosen(batch: pd.DataFrame, carried: tuple[int, int] | None) -> tuple[pd.DataFrame, tuple[int, int]]:
    """Blocks from the first to the last: the state each is entered in, and thereby its edits."""
    state, before = carried or (0, -1)
    states, audits, illegal = [], [], []
    for codes, pieces, ends, last, own in zip(batch["_codes"], batch["_pieces"], batch["_ends"], batch["_last"], batch["_illegal"]):
        states.append(state)
        audit, state = pieces[state], int(ends[state])
        audits.append(audit + "I" * _TO_END[state] if last else audit)
        illegal.append(own + (before >= 0 and (before, codes[0] % 4) not in _LEGAL))
        before = codes[-1] % 4
    return batch.drop(columns=["_pieces", "_ends"]).assign(_state=states, _audit=audits, _illegal=illegal), (state, before)


def _edits(block_rows: int):
    """One row per row of the conversation: roles inserted before it, its letter, its new role. An end row closes a conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for c, block, codes, audit, state, last in zip(b["_c"], b["_block"], b["_codes"], b["_audit"], b["_state"], b["_last"]):
                lead = []
                for i, letter, role in lines(audit, codes, state):
                    if letter == "I":
                        lead.append(role)
                    else:
                        out.append((c, block * block_rows + i, lead, letter, role))
                        lead = []
                if lead or last:
                    out.append((c, block * block_rows + len(codes) - (not last), lead, "E" if last else "I", None))
            yield pd.DataFrame(out, columns=["_c", "_pos", "_lead", "_letter", "_new"])

    return run


def _hashed(batch: pd.DataFrame, carried) -> tuple[pd.DataFrame, tuple]:
    """The hash of repaired lines as they pass; given out where the end row passes."""
    digest, later = carried or (hashlib.sha256(), False)
    out = []

    def line(text: str) -> None:
        nonlocal later
        digest.update((("\n" if later else "") + text).encode("utf-8"))
        later = True

    for c, lead, letter, new, role, text in zip(batch["_c"], batch["_lead"], batch["_letter"], batch["_new"], batch["_role"], batch["_text"]):
        for r in lead:
            line(r + ":")
        if letter in "KR":
            line(f"{new or role}:{text}")
        if letter == "E":
            out.append((c, digest.hexdigest()))
    return pd.DataFrame(out, columns=["_c", "repaired_sha256"]), (digest, later)


def _large(rows: DataFrame, block_rows: int) -> DataFrame:
    """Conversations of any size, in blocks."""
    placed = _placed(rows)
    narrow = placed.select("_c", "_pos", "_turn", "_role", "_sha", "_code")
    first = narrow.filter("_code & 4 = 0").groupBy("_c", "_role", "_sha").agg(F.min("_pos").alias("_least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = attach(narrow, keep(first, "conversation_repeats"), ["_c", "_role", "_sha"], "_n", ["_pos"], "left")
    repeat = F.coalesce((F.col("_pos") > F.col("_least")) & (F.col("_code").bitwiseAND(4) == 0), F.lit(False))
    marked = keep(marked.select("_c", "_pos", "_turn", repeat.alias("_again"), F.when(repeat, F.col("_code") % 4 + 4).otherwise(F.col("_code")).alias("_code")), "conversation_codes")
    number = lambda cond: F.sum(cond.cast("long"))
    code = F.col("_code")
    by_turn = marked.groupBy("_c", "_turn").agg(number((code >= 4) & (code < 8) & ~F.col("_again")).alias("b"), number(F.col("_again")).alias("d"), number(code >= 8).alias("t"))
    counts = by_turn.groupBy("_c").agg(
        F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count("_turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(name) for c, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_code"))), lambda x: x["_code"])
    blocks = marked.groupBy("_c", F.floor(F.col("_pos") / block_rows).alias("_block")).agg(listed.alias("_list"))
    blocks = blocks.mapInPandas(_measured, "_c string, _block long, _codes binary, _table array<int>, _illegal long")
    blocks = _stream(blocks, [F.desc("_block")], _distances, "_c string, _block long, _codes binary, _illegal long, _end array<int>, _cost long, _last boolean")
    kept = "_c string, _block long, _codes binary, _illegal long, _cost long, _last boolean"
    blocks = blocks.repartition("_c", "_block").mapInPandas(_traced, f"{kept}, _pieces array<string>, _ends array<int>")
    blocks = keep(_stream(blocks, ["_block"], _chosen, f"{kept}, _state int, _audit string"), "conversation_edits")
    audit = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("_block", "_audit"))), lambda x: x["_audit"]))
    whole = blocks.groupBy("_c").agg(F.sum("_illegal").alias("illegal"), F.min_by("_cost", "_block").alias("cost"), audit.alias("audit"))
    done = blocks.mapInPandas(_edits(block_rows), "_c string, _pos long, _lead array<string>, _letter string, _new string")
    done = done.join(placed.select("_c", "_pos", "_role", "_text"), ["_c", "_pos"], "left")
    hashes = _stream(done, ["_pos", F.col("_letter") != "I"], _hashed, "_c string, repaired_sha256 string")
    return counts.join(whole, "_c").join(hashes, "_c")


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    large_rows: int = LARGE_ROWS,
    large_chars: int = LARGE_CHARS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per conversation: ``conv_col``, gaps between turns, rows that are blank, repeats or cut off, illegal neighbours,
    and the cheapest repair: cost, audit (one letter per edit) and the SHA-256 of the repaired ``role:text`` lines."""
    ready = _prepared(rows, conv_col, turn_col, role_col, text_col)
    sizes = ready.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("_text")).alias("_chars"))
    big = keep(sizes.filter((F.col("_n") > large_rows) | (F.col("_chars") > large_chars)).select("_c", "_n", F.lit(True).alias("_big")), "large_conversations")
    names = [c.split()[0] for c in _RESULT.split(", ")]
    if big.isEmpty():
        found = _small(ready)
    else:
        parted = attach(ready, big, ["_c"], "_n", ["_sha"], "left")
        found = _small(parted.filter("_big is null")).unionByName(_large(parted.filter("_big").drop("_big"), block_rows).select("_c", *names))
    kind = rows.schema[conv_col].dataType
    return found.select(F.when(F.col("_c") != "", F.substring("_c", 2, 2**31 - 1)).cast(kind).alias(conv_col), *names)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults put in by a rule on conversation and turn; nulls in roles, texts and the rule are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rule = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("_rule") == 1, "").when(F.col("_rule") == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(F.col("_rule") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = rows.select("conv_id", "turn", "role", "text", rule.alias("_rule")).filter("_rule != 0")
    out = out.select("conv_id", "turn", F.when(F.col("_rule") == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
    return out.drop("_copy")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "conversations")
    found = repair_conversations(damaged(rows)).withColumnRenamed("conv_id", "_of")
    ids = rows.select("conv_id").distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
