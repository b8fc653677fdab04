"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text.

Texts are compared after every run of white space became one space; a null text counts as empty. Each level splits
only the groups of two or more rows that the level before it left. Ties: of equal texts the row with the smallest id
stays (null ids come last), of rows with the same id one of them. Very long texts are hashed as they are. An empty table gives an
empty result. Other columns are not read, and :func:`deduplicate` gives them back whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, attach, fresh, keep, only_ids, read

PREFIX = 128


def normalised(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), WHITE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """One narrow row per document: _row, _id, _len, _head and, where asked for, _sha. Kept as a table, so that _row is fixed."""
    t = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_t"))
    cols = [F.monotonically_increasing_id().alias("_row"), "_id", F.length("_t").alias("_len"), F.xxhash64(F.substring("_t", 1, PREFIX)).alias("_head")]
    return keep(t.select(*cols, *([F.sha2("_t", 256).alias("_sha")] if full else [])), "digests")


def _split(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys occur at least twice."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return attach(rows, groups, keys, "_n", ["_row"])


def _decide(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of groups of two or more equal texts, with keep_id, group_size and kept."""
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"), first.alias("_first")).filter("group_size > 1").withColumn("_n", F.col("group_size"))
    return attach(rows, groups, keys, "_n", ["_row"]).select("_row", "_id", "_sha", F.col("_first.id").alias("keep_id"), "group_size", (F.col("_first.row") == F.col("_row")).alias("kept"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: bool = False) -> DataFrame:
    """``id_col, keep_id, group_size, kept`` (and _sha with ``hashes``) for the rows of groups of equal texts only. Whole texts are hashed for the rows
    that share length and prefix with another row; the rest is never read beyond that."""
    d = digests(docs, id_col, text_col, full=False)
    left = keep(_split(_split(d, ["_len"]), ["_len", "_head"]).select("_id").distinct(), "survivors")
    some = only_ids(docs, left.select(F.col("_id").alias(id_col)), id_col, True).unionByName(docs.filter(F.col(id_col).isNull()))
    d = digests(some, id_col, text_col)
    found = _decide(d, ["_len", "_head", "_sha"]).drop("_row").withColumnRenamed("_id", id_col)
    return found if hashes else found.drop("_sha")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, the one with the smallest id; all columns stay. Ids may be null or repeat."""
    found = keep(exact_duplicates(docs, id_col, text_col, hashes=True), "duplicates")
    gone = keep(found.filter("not kept").select(id_col).distinct(), "gone")
    ids, none = gone.filter(F.col(id_col).isNotNull()), F.col(id_col).isNull()
    # An id that one row has stands for that row. Null ids and ids that repeat do not: there id and text decide.
    again = keep(only_ids(docs.select(id_col), ids, id_col, True).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(id_col), "again")
    out = only_ids(docs, only_ids(ids, again, id_col, False), id_col, False)
    if again.isEmpty() and gone.filter(none).isEmpty():
        return out.select(*docs.columns)
    several = lambda rows: only_ids(rows, again, id_col, True).unionByName(rows.filter(none))
    sha, of, text, stays = fresh(docs, "_sha", "_of", "_text", "_stays")
    by = several(found).groupBy(F.col(id_col).alias(of), F.col("_sha").alias(text)).agg(F.max("kept").alias(stays), F.count(F.lit(1)).alias("_n")).filter(~F.col(stays) | (F.col("_n") > 1)).drop("_n")
    marked = several(out).withColumn(sha, F.sha2(normalised(text_col), 256))
    marked = marked.join(keep(by, "decided"), F.col(id_col).eqNullSafe(F.col(of)) & (F.col(sha) == F.col(text)), "left")
    # Rows that repeat id and text: one of them stays, if any does.
    twice = marked.filter(stays).dropDuplicates([id_col, sha])
    rest = only_ids(out.filter(~none), again, id_col, False)
    return rest.select(*docs.columns).unionByName(marked.filter(F.col(stays).isNull()).unionByName(twice).select(*docs.columns))


def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document. The hash is a result column here, so each text is read whole, once, for all three levels."""
    d = digests(read(spark, sf, "documents"))
    groups = keep(_decide(_split(_split(d, ["_len"]), ["_len", "_head"]), ["_len", "_head", "_sha"]).drop("_id", "_sha"), "groups")
    out = d.join(groups, "_row", "left")
    alone = F.col("group_size").isNull()
    return out.select(
        F.col("_id").alias("doc_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
