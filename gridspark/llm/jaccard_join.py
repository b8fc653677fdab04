"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles. Classes of equal sets are represented by their smallest id. Representatives that
agree in a min-hash band are compared with the smallest of them: those that prove similar form a group around it.
Large groups are cut into chunks. The matrix has an entry where a token of the prefixes of a group's members meets the
group; a prefix is the part of a set, rarest tokens first, that two similar sets must share a token of. Pairs of groups
that meet in a token within bounds of size and position are looked up: a member's overlap with the other group's token
union bounds its overlap with every member, so only groups that reach the bound are opened and compared member by
member. All links come from exact set sizes; min-hashes only decide who is compared first, and a sample of the
documents only decides on the order of tokens. Components join links by alternating large-star and small-star steps.

Rows: null and empty texts have the empty set and are linked with nothing; a text with fewer words than a shingle has
the whole as its one shingle. Rows that repeat an id are linked with each other. Rows with null id stay alone, with a
null component. Sets are held as 64-bit hashes. Very long texts are taken whole: a set is one row. An empty table gives an empty result.
Columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import attach, in_arrow, keep, only_ids, read
from .hashing import blocks, mix, word_hashes

WORDS = 5
#: Similarity in hundredths.
SIMILARITY = 75
BANDS, BAND_ROWS = 4, 2
#: Members of a chunk of a group (on average), and postings of a token compared within one task.
CHUNK, BLOCK = 64, 500
#: Share of documents whose tokens are counted to order tokens by frequency, and how many frequent tokens are told apart.
ORDER_SAMPLE, ORDER_MIN, ORDER_TOKENS = 16, 3, 200_000
_SALTS = mix(np.arange(1000, 1000 + BANDS * BAND_ROWS, dtype=np.uint64))


def shingle_sets(texts: list, words: int = WORDS) -> Iterator[np.ndarray]:
    """The set of shingle hashes of each text, sorted."""
    for s, e in blocks(texts):
        h, at = word_hashes(texts[s:e])
        rolled = np.zeros(max(len(h) - words + 1, 0), np.uint64)
        for k in range(words):
            rolled = mix(rolled + h[k : k + len(rolled)] + np.uint64(k + 1))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for x in h[a:b]:
                    short = mix(short + x)
                yield mix(short + np.uint64(0xABCD))
            else:
                yield np.empty(0, np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _batches(b: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    for s in range(0, b.num_rows, size):
        yield b.slice(s, size)


def sets(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """_id, n, set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _batches(b):
                got = list(shingle_sets(part.column(1).to_pylist(), words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in got], pa.int64()), _lists(got)], names=["_id", "n", "set"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return in_arrow(rows, run, f"_id {kind}, n long, set array<long>")


def frequent(docs: DataFrame, id_col: str, text_col: str, words: int) -> np.ndarray:
    """Frequent tokens, most frequent last. They only order tokens: any list gives the same links."""
    some = sets(docs.filter(F.pmod(F.xxhash64(id_col), F.lit(ORDER_SAMPLE)) == 0), id_col, text_col, words)
    top = some.select(F.explode("set").alias("token")).groupBy("token").count().filter(F.col("count") >= ORDER_MIN)
    rows = top.orderBy(F.desc("count"), "token").limit(ORDER_TOKENS).collect()  # at most ORDER_TOKENS numbers
    return np.array([r["token"] for r in reversed(rows)], dtype=np.int64).view(np.uint64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: int, hot: np.ndarray) -> DataFrame:
    """_id, n, k1 and k2 (hashes of the whole set), bands, prefix (tokens by their place in the order)."""
    kind = docs.schema[id_col].dataType.simpleString()
    by_hash = np.argsort(hot, kind="stable")
    hot_sorted, hot_place = hot[by_hash], by_hash.astype(np.uint64) + np.uint64(2**62)

    def one(s: np.ndarray) -> tuple:
        n = len(s)
        if not n:
            return 0, 0, 0, s, s
        m = mix(s + np.uint64(77))
        k1, k2 = int(np.add.reduce(m) >> np.uint64(1)), int(np.add.reduce(mix(m)) >> np.uint64(1))
        low = np.array([np.min(mix(s ^ x)) for x in _SALTS], np.uint64).reshape(BANDS, BAND_ROWS)
        bands = np.arange(BANDS, dtype=np.uint64)
        for k in range(BAND_ROWS):
            bands = mix(bands + low[:, k])
        order = s >> np.uint64(2)
        if len(hot_sorted):
            at = np.minimum(np.searchsorted(hot_sorted, s), len(hot_sorted) - 1)
            order = np.where(hot_sorted[at] == s, hot_place[at], order)
        size = n - (similarity * n + 99) // 100 + 1
        return n, k1, k2, bands, np.sort(order)[:size]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _batches(b):
                got = [one(s) for s in shingle_sets(part.column(1).to_pylist(), words)]
                n, k1, k2, bands, prefix = zip(*got)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x, pa.int64()) for x in (n, k1, k2)], _lists(list(bands)), _lists(list(prefix))], names=["_id", "n", "k1", "k2", "bands", "prefix"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return in_arrow(rows, run, f"_id {kind}, n long, k1 long, k2 long, bands array<long>, prefix array<long>")


def _similar(a: Column, b: Column, similarity: int) -> Column:
    """Whether two sets, given as arrays of distinct tokens, reach the similarity."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= similarity * (F.size(a) + F.size(b) - both)


def _compared(pairs: DataFrame, some: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) of ids whose sets are similar."""
    left = pairs.join(some.select(F.col("_id").alias("a"), F.col("set").alias("_a")), "a")
    # A centre may be compared with very many.
    weights = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n"))
    both = attach(left, some.select(F.col("_id").alias("b"), F.col("set").alias("_b")).join(weights, "b"), ["b"], "_n", ["a"], small=0)
    return both.filter(_similar(F.col("_a"), F.col("_b"), similarity)).select("a", "b").distinct()


def _meetings(members: DataFrame, similarity: int) -> DataFrame:
    """Pairs of groups (g1 < g2) of different centres that meet in a token within the bounds of size and position.

    ``members``: g, centre, n, prefix, several (whether the group has more members). A token of more groups than BLOCK
    is compared block by block, so no task holds all of its groups.
    """
    entries = members.select("g", "centre", F.col("n").cast("int").alias("n"), "several", F.posexplode("prefix").alias("pos", "token"))
    entries = entries.select("token", "g", "centre", F.col("n").alias("least"), F.col("n").alias("most"), (F.col("n") - F.col("pos") - 1).alias("rest"), "several")
    merged = entries.filter("several").groupBy("token", "g", "centre").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.max("rest").alias("rest"))
    entries = entries.filter("not several").drop("several").unionByName(merged)
    token = Window.partitionBy("token")
    shared = entries.withColumn("_n", F.count(F.lit(1)).over(token)).withColumn("_low", F.min("centre").over(token)).withColumn("_high", F.max("centre").over(token))
    shared = shared.filter("_n > 1 and _low < _high").drop("_low", "_high").withColumn("blocks", F.ceil(F.col("_n") / BLOCK).cast("int"))
    shared = shared.withColumn("own", F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int")).drop("_n")
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    shared = keep(shared.select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "g", "centre", "least", "most", "rest"), "matrix")
    one, two = (shared.select("token", "x", "y", *[F.col(c).alias(c + k) for c in ("own", "g", "centre", "least", "most", "rest")]) for k in "12")
    bound = (F.col("g1") < F.col("g2")) & (F.col("centre1") != F.col("centre2")) & ((F.col("own1") != F.col("own2")) | (F.col("x") == F.col("y")))
    bound = bound & (100 * F.col("most1") >= similarity * F.col("least2")) & (100 * F.col("most2") >= similarity * F.col("least1"))
    # The bound of position holds for the first token that two sets share; the later ones are counted all the same.
    early = (100 + similarity) * (1 + F.least("rest1", "rest2")) >= similarity * (F.col("least1") + F.col("least2"))
    met = one.join(two, ["token", "x", "y"]).filter(bound).withColumn("early", early).groupBy("g1", "centre1", "g2", "centre2")
    met = met.agg(F.max("early").alias("early"), F.count(F.lit(1)).alias("common"), F.min("least1").alias("least1"), F.min("least2").alias("least2"), F.max("most1").alias("most1"), F.max("most2").alias("most2")).filter("early")
    # Common tokens lie in both prefixes or after the one that ends first, so their number has a bound.
    after = lambda n: F.ceil(similarity * n / 100) - 1
    most = F.col("common") + F.greatest(after(F.col("most1")), after(F.col("most2")))
    return met.filter((100 + similarity) * most >= similarity * (F.col("least1") + F.col("least2"))).select("g1", "centre1", "g2", "centre2")


def _opened(pairs: DataFrame, groups: DataFrame, similarity: int) -> DataFrame:
    """The pairs of groups with a link: a member of one whose overlap with the other's union reaches the bound, and
    that is similar to one of the other's members. ``groups``: g, sets, tokens (null where there is one set)."""
    left = pairs.join(groups.select(F.col("g").alias("g1"), F.col("sets").alias("s1")), "g1")
    both = left.join(groups.select(F.col("g").alias("g2"), F.col("sets").alias("s2"), F.col("tokens").alias("t2")), "g2")
    both = both.withColumn("t2", F.when(F.size("s2") == 1, F.get("s2", F.lit(0))).otherwise(F.col("t2")))
    reaches = lambda m: 100 * F.size(F.array_intersect(m, F.col("t2"))) >= similarity * F.size(m)
    found = F.exists("s1", lambda m: reaches(m) & F.exists("s2", lambda k: _similar(m, k, similarity)))
    return both.filter(found).select(F.col("centre1").alias("a"), F.col("centre2").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """_id, component (the smallest id that links a < b reach) of every id in ``links``."""
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: neighbours above a node go to the smallest of its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("_n")), "low")
        large = attach(both, low, ["u"], "_n", ["v"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = keep(large, "large")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = keep(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n")), "low")
        small = attach(large, low, ["u"], "_n", ["v"])
        small = small.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = keep(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.select(F.col("u").alias("_id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("_id"), F.col("v").alias("component")).distinct())


def links(docs: DataFrame, prints: DataFrame, id_col: str, text_col: str, words: int = WORDS, similarity: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (k1, k2, rep, size), and links (a, b) between representatives: enough of them to join all
    that are linked, since members of a group are linked with its centre."""
    full = prints.filter("n > 0 and _id is not null")
    classes = keep(full.groupBy("k1", "k2").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    copies = keep(attach(full.select("_id", "k1", "k2"), classes.filter("size > 1"), ["k1", "k2"], "size", ["_id"]).filter("_id <> rep").select("_id").distinct(), "copies")
    reps = only_ids(full, copies, "_id", False)
    # Groups: the smallest id of a band's bucket is compared with the others.
    banded = keep(reps.select("_id", F.explode("bands").alias("band")), "banded")
    buckets = keep(banded.groupBy("band").agg(F.min("_id").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "buckets")
    stars = keep(attach(banded, buckets, ["band"], "_n", ["_id"]).filter("_id <> b").select(F.col("_id").alias("a"), "b").distinct(), "stars")
    ids = stars.select(F.explode(F.array("a", "b")).alias(id_col)).distinct()
    near = keep(_compared(stars, keep(sets(only_ids(docs, ids, id_col, True), id_col, text_col, words), "sets"), similarity), "near")
    centres = keep(near.groupBy(F.col("a").alias("_id")).agg(F.min("b").alias("centre")), "centres")
    sizes = keep(centres.groupBy("centre").agg((F.count(F.lit(1)) + 1).alias("_n")), "sizes").withColumn("chunks", F.ceil(F.col("_n") / CHUNK).cast("int"))
    # A member belongs to its centre's group; a centre that belongs to no other group belongs to its own.
    placed = centres.unionByName(sizes.join(centres, sizes["centre"] == centres["_id"], "left_anti").select(F.col("centre").alias("_id"), "centre"))
    placed = keep(attach(placed, sizes, ["centre"], "_n", ["_id"]).select("_id", "centre", F.xxhash64("centre", F.pmod(F.xxhash64("_id"), "chunks")).alias("g")), "placed")
    marked = placed.withColumn("several", F.lit(True))
    if marked.count() <= 200_000:
        marked = F.broadcast(marked)
    members = reps.join(marked, "_id", "left").select("_id", F.coalesce("g", F.xxhash64("_id", F.lit("alone"))).alias("g"), F.coalesce("centre", "_id").alias("centre"), "n", "prefix", F.coalesce("several", F.lit(False)).alias("several"))
    pairs = keep(_meetings(members, similarity), "pairs")
    used = keep(pairs.select(F.explode(F.array("g1", "g2")).alias("g")).distinct(), "used")
    inside = keep(members.select("_id", "g").join(used, "g", "left_semi"), "inside")
    some = sets(only_ids(docs, inside.select(F.col("_id").alias(id_col)).distinct(), id_col, True), id_col, text_col, words)
    groups = inside.join(some, "_id").groupBy("g").agg(F.collect_list("set").alias("sets"))
    groups = keep(groups.withColumn("tokens", F.when(F.size("sets") > 1, F.array_distinct(F.flatten("sets")))), "groups")
    return classes, near.unionByName(keep(_opened(pairs, groups, similarity), "opened"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """``id_col, n_shingles, component_id``, one row per document."""
    hot = frequent(docs, id_col, text_col, words)
    prints = keep(fingerprints(docs, id_col, text_col, words, similarity, hot), "prints")
    classes, found = links(docs, prints, id_col, text_col, words, similarity)
    classes = classes.join(components(found).withColumnRenamed("_id", "rep"), "rep", "left")
    classes = keep(classes.select("k1", "k2", F.coalesce("component", "rep").alias("component"), "size"), "components")
    linked = attach(prints.filter("n > 0 and _id is not null").select("_id", "n", "k1", "k2"), classes, ["k1", "k2"], "size", ["_id"])
    alone = prints.filter("n = 0 or _id is null").select("_id", "n", F.col("_id").alias("component"))
    out = linked.select("_id", "n", "component").unionByName(alone)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component only."""
    found = keep(near_duplicates(docs, id_col, text_col), "found")
    return only_ids(docs, found.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), id_col, False).select(*docs.columns)


def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read(spark, sf, "documents"))
