"""Token counts as delta-maintained rollups.

Totals of documents and tokens by source, language and tokenizer version change only by signed deltas: an insert adds
its counts, a delete takes them away, a revision takes the old image away and adds the new one. A batch is reduced to
one delta per group (map-side combined, so a hot source costs one row per task) and committed under its batch id: the
deltas are written first, the commit row last. A batch id that is committed is not applied again; one that broke off
before its commit row is not seen and may be applied anew. Compaction replaces committed deltas by their sum.

A change has: op ('insert', 'delete', 'revise'), source, lang, tokenizer, tokens, and for a revision old_source,
old_lang, old_tokenizer, old_tokens. Null sources and languages are groups of their own; null tokens count as 0; other
ops are refused; empty batches commit no delta. Groups whose documents have all gone do not appear. Repeated changes count as often as
they are in a batch; very long texts are counted whole; other columns of a batch are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, keep, read, shared_folder

GROUP = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """One signed row per group that a batch of changes touches."""
    bad = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null"))))
    sign = F.when(F.col("op").isin("insert", "revise"), F.lit(1)).when(F.col("op") == "delete", F.lit(-1)).otherwise(bad.cast("int"))
    image = lambda p, s: F.struct(*[F.col(p + g).cast("string").alias(g) for g in GROUP], s.cast("long").alias("documents"), (s * F.coalesce(F.col(p + "tokens"), F.lit(0))).cast("long").alias("tokens"))
    both = F.when(F.col("op") == "revise", F.array(image("", sign), image("old_", F.lit(-1)))).otherwise(F.array(image("", sign)))
    summed = changes.select(F.explode(both).alias("d")).select("d.*").groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return summed.filter("documents <> 0 or tokens <> 0")


class Rollup:
    """Committed deltas under a folder that Spark can write; safe to repeat any call that failed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema("batch string, file string, replaces array<string>").parquet(f"{self.path}/commits")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], "batch string, file string, replaces array<string>")

    def committed(self, batch: str) -> bool:
        return not self._commits().filter(F.col("batch") == batch).isEmpty()

    def _live(self) -> list[str]:
        """Delta folders that count: one for each batch that no compaction holds.

        Two writers may commit the same batch, the second one even after a compaction that holds the first one's file:
        a batch is in a compaction if any of its files is.
        """
        rows = self._commits().collect()
        gone = {x for r in rows for x in r["replaces"] or []}
        held = {r["batch"] for r in rows if r["file"] in gone}
        first = {}
        for r in sorted(rows, key=lambda r: r["file"]):
            first.setdefault(r["batch"], r["file"])
        return sorted(f for b, f in first.items() if b not in held)

    def _commit(self, batch: str, rows: DataFrame, replaces: list[str]) -> None:
        file = f"{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/deltas/{file}")
        self.spark.createDataFrame([(batch, file, replaces)], "batch string, file string, replaces array<string>").coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it is committed already."""
        if self.committed(batch):
            return False
        self._commit(batch, deltas(changes), [])
        return True

    def compact(self, batch: str) -> bool:
        """Replace all live deltas by one; ``batch`` names the compaction."""
        live = self._live()
        if self.committed(batch) or len(live) < 2:
            return False
        self._commit(batch, self.totals(), live)
        return True

    def totals(self) -> DataFrame:
        live = [f"{self.path}/deltas/{f}" for f in self._live()]
        rows = self.spark.read.schema(SCHEMA).parquet(*live) if live else self.spark.createDataFrame([], SCHEMA)
        out = rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return out.filter("documents <> 0 or tokens <> 0")


PIECE = r"[A-Za-z]+|[0-9]|[^\x20\x09-\x0DA-Za-z0-9]"


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The life of the whole table: every document arrives counted as words, every document is also counted in pieces,
    the pieces are revised by a new version that counts an end mark too, and documents of under 50 words go and come
    back. One batch is sent twice, and the deltas are compacted between. The totals are those of all documents."""
    docs = read(spark, sf, "documents")
    count = lambda p: F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)).cast("long")
    counted = keep(docs.select("source", "lang", count(WORD).alias("w"), count(PIECE).alias("p")), "counted")
    none = {f"old_{g}": F.lit(None).cast("string") for g in GROUP} | {"old_tokens": F.lit(None).cast("long")}
    as_change = lambda rows, op, tok, n, old=none: rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(tok).alias("tokenizer"), n.alias("tokens"), *[c.alias(k) for k, c in old.items()])
    store = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    words, pieces = as_change(counted, "insert", "words-1", F.col("w")), as_change(counted, "insert", "pieces-1", F.col("p"))
    store.apply("words", words)
    store.apply("pieces", pieces)
    store.apply("words", words)
    old = {"old_source": F.col("source"), "old_lang": F.col("lang"), "old_tokenizer": F.lit("pieces-1"), "old_tokens": F.col("p")}
    store.apply("revised", as_change(counted, "revise", "pieces-2", F.col("p") + 1, old))
    store.compact("compaction-1")
    short = counted.filter("w < 50")
    store.apply("short words", as_change(short, "delete", "words-1", F.col("w")))
    store.apply("short pieces", as_change(short, "delete", "pieces-2", F.col("p") + 1))
    store.apply("short words again", as_change(short, "insert", "words-1", F.col("w")))
    store.apply("short pieces again", as_change(short, "insert", "pieces-2", F.col("p") + 1))
    return store.totals()


SQL = r"""
WITH c AS (
  SELECT source, lang,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]|[^\x20\x09-\x0DA-Za-z0-9]')) AS p
  FROM documents)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS documents, CAST(sum(w) AS BIGINT) AS tokens FROM c GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-2', count(*), CAST(sum(p + 1) AS BIGINT) FROM c GROUP BY source, lang
"""
