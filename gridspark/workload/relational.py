"""Query parameters, catalog, profiling, scalar rules, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import scalars as sc
from gridspark.operators import profile as pr
from gridspark.operators import query as qy
from gridspark.operators.paging import PageIndex, page_after
from gridspark.sources import catalog as ct
from gridspark.sources.io import export, flatten_records, read_delimited
from gridspark.sources.staging import new_path
from gridspark.workload.base import check, frame, table

# --- query parameters -------------------------------------------------------------------------


def portal(spark, sf):
    """The catalog with orders standing in for a published table."""
    catalog = ct.Catalog(spark)
    catalog.register("statistics", lambda: table(spark, sf, "orders"))
    return catalog


@check("named_table_read", "SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice, 6) AS o_totalprice, o_orderdate, o_orderpriority FROM {orders}")
def _(spark, sf):
    return portal(spark, sf).get("network_statistics", limit=None)


@check("projection", "SELECT o_orderkey, ROUND(o_totalprice * 1.2, 4) AS gross FROM {orders}", digits=4)
def _(spark, sf):
    return portal(spark, sf).get("statistics", limit=None, select="o_orderkey, o_totalprice * 1.2D AS gross")


@check("projection_list", "SELECT o_orderkey, o_orderstatus FROM {orders}")
def _(spark, sf):
    return qy.query(table(spark, sf, "orders"), columns=["o_orderkey", "o_orderstatus"])


WHERE = "o_orderstatus IN ('O', 'F') AND o_totalprice >= 1000 AND NOT (o_orderpriority LIKE '1%' OR o_orderpriority = '5-LOW') AND o_custkey != 7"


@check("predicate", f"SELECT o_orderkey FROM {{orders}} WHERE {WHERE}")
def _(spark, sf):
    return qy.query(table(spark, sf, "orders"), where=WHERE, select="o_orderkey")


@check("date_functions", "SELECT o_orderkey FROM {orders} WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 3) OR o_orderdate::DATE = DATE '1998-01-05'")
def _(spark, sf):
    where = "year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 3) OR date(o_orderdate) = DATE'1998-01-05'"
    return qy.query(table(spark, sf, "orders"), where=where, select="o_orderkey")


@check("predicate_merge", "SELECT o_orderkey FROM {orders} WHERE (o_orderstatus = 'O') AND (o_custkey < 50 OR o_totalprice > 200000)")
def _(spark, sf):
    where = qy.merge_where(F.col("o_orderstatus") == "O", "o_custkey < 50 OR o_totalprice > 200000", "( )")
    return qy.query(table(spark, sf, "orders"), where=where, select="o_orderkey")


@check("sort_top_k", "SELECT o_orderkey, ROUND(o_totalprice, 4) AS o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 100", digits=4)
def _(spark, sf):
    return qy.query(table(spark, sf, "orders"), select="o_orderkey, o_totalprice", order_by="-o_totalprice", limit=100, tiebreak=["o_orderkey"])


@check("page_offset", "SELECT o_orderkey FROM {orders} ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 120")
def _(spark, sf):
    return qy.query(table(spark, sf, "orders"), select="o_orderkey", order_by="o_orderdate", limit=50, offset=120, tiebreak=["o_orderkey"])


@check("page_offset_only", "SELECT l_orderkey, l_linenumber FROM {lineitem} ORDER BY l_shipdate DESC, l_orderkey, l_linenumber OFFSET (SELECT COUNT(*) // 2 FROM {lineitem})")
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    return qy.query(rows, columns=["l_orderkey", "l_linenumber"], order_by="-l_shipdate", offset=rows.count() // 2, tiebreak=["l_orderkey", "l_linenumber"])


@check("page_deep", "SELECT l_orderkey, l_linenumber FROM {lineitem} ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 1000 OFFSET (SELECT COUNT(*) * 3 // 4 FROM {lineitem})")
def _(spark, sf):
    index = PageIndex(table(spark, sf, "lineitem"), "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return index.page(index.total * 3 // 4, 1000).select("l_orderkey", "l_linenumber")


@check("page_after", "SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderstatus > 'F' OR (o_orderstatus = 'F' AND o_orderkey > 700) ORDER BY o_orderstatus, o_orderkey LIMIT 300")
def _(spark, sf):
    return page_after(table(spark, sf, "orders"), "o_orderstatus", ("F", 700), 300, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@check("delimited_round_trip", "SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice, 4) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, 'a;\"' || o_orderpriority || '\"' AS note FROM {orders} WHERE o_orderstatus <> 'F'", digits=4)
def _(spark, sf):
    path = new_path(spark, "orders_text")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), F.concat(F.lit('a;"'), "o_orderpriority", F.lit('"')).alias("note"))
    export(rows, path, "csv", where="o_orderstatus <> 'F'")
    return read_delimited(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date, note string")


@check("bounded_fetch", "SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderpriority = '2-HIGH' ORDER BY o_orderdate DESC, o_orderkey LIMIT 200")
def _(spark, sf):
    return qy.fetch_all(table(spark, sf, "orders"), "o_orderpriority = '2-HIGH'", 200, "-o_orderdate", ["o_orderkey"]).select("o_orderkey", "o_custkey")


@check("page_with_total", "SELECT o_orderkey, (SELECT COUNT(*) FROM {orders} WHERE o_orderstatus = 'P') AS total_count FROM {orders} WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20")
def _(spark, sf):
    match = qy.matching(table(spark, sf, "orders"), "o_orderstatus = 'P'")
    return qy.with_total(qy.page(match.select("o_orderkey"), "o_orderkey", 20), match)


@check(
    "group_by",
    "SELECT o_orderpriority, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total, ROUND(AVG(o_totalprice), 2) AS mean FROM {orders} GROUP BY 1 ORDER BY total DESC LIMIT 3",
    digits=2,
)
def _(spark, sf):
    select = "count(*) AS orders, sum(o_totalprice) AS total, avg(o_totalprice) AS mean"
    return qy.query(table(spark, sf, "orders"), select=select, group_by="o_orderpriority", order_by="-total", limit=3)


@check("refine", "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def _(spark, sf):
    return qy.query(table(spark, sf, "orders"), select="o_orderkey", refine={"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


@check("exclude", "SELECT o_orderkey FROM (SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS s FROM {orders}) x WHERE s IS DISTINCT FROM 'F'")
def _(spark, sf):
    rows = frame(spark, sf, "SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS s FROM {orders}")
    return qy.query(rows, select="o_orderkey", exclude={"s": "F"})


@check(
    "facet_counts",
    """SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, COUNT(*) AS count FROM {orders} GROUP BY 2
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, COUNT(*) FROM {orders} GROUP BY 2""",
)
def _(spark, sf):
    return qy.facet_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


# --- profiling --------------------------------------------------------------------------------


@check(
    "group_statistics",
    """SELECT l_returnflag, COUNT(l_extendedprice) AS count, ROUND(AVG(l_extendedprice), 2) AS mean, ROUND(SUM(l_extendedprice), 2) AS sum,
       ROUND(MIN(l_extendedprice), 2) AS min, ROUND(MAX(l_extendedprice), 2) AS max FROM {lineitem} GROUP BY 1""",
    digits=2,
)
def _(spark, sf):
    return pr.group_statistics(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")


@check("transformer_statistics", "SELECT l_suppkey, COUNT(*) AS count, ROUND(AVG(l_quantity), 4) AS mean, ROUND(MAX(l_quantity), 4) AS max FROM {lineitem} GROUP BY 1", digits=4)
def _(spark, sf):
    return pr.group_statistics(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity", ("count", "mean", "max"), digits=None)


@check("multi_key_group", "SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count, ROUND(AVG(o_totalprice), 2) AS mean FROM {orders} GROUP BY 1, 2", digits=2)
def _(spark, sf):
    return pr.group_statistics(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice", ("count", "mean"))


@check(
    "pivot_mean",
    """SELECT o_orderpriority, """
    + ", ".join(f"ROUND(COALESCE(AVG(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END), 0), 2) AS \"{s}\"" for s in ("F", "O", "P", "X"))
    + " FROM {orders} GROUP BY 1",
    digits=2,
)
def _(spark, sf):
    return pr.pivot(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice", ["F", "O", "P", "X"])


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@check(
    "pivot_by_time",
    "SELECT date_trunc('hour', ts) AS hour, " + ", ".join(f"ROUND(SUM(CASE WHEN event_type = '{s}' THEN value END), 4) AS \"{s}\"" for s in EVENT_TYPES) + " FROM {events} GROUP BY 1",
    digits=4,
)
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    return pr.pivot(rows, "hour", "event_type", "value", list(EVENT_TYPES), how="sum", fill=None)


@check("value_counts", "SELECT p_brand, COUNT(*) AS count FROM {part} GROUP BY 1 ORDER BY count DESC, p_brand LIMIT 10")
def _(spark, sf):
    return pr.value_counts(table(spark, sf, "part"), "p_brand", 10)


HOLES = "SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS props FROM {events}"


@check(
    "missing_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing, ROUND(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS percent FROM ({HOLES}) x" for c in ("event_id", "value", "props")
    ),
)
def _(spark, sf):
    return pr.missing_profile(frame(spark, sf, HOLES))


@check(
    "numeric_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 2) AS mean, ROUND(STDDEV_SAMP({c}), 2) AS std, ROUND(MIN({c})::DOUBLE, 2) AS min, ROUND(MAX({c})::DOUBLE, 2) AS max,
        ROUND(quantile_cont({c}::DOUBLE, 0.25), 2) AS q25, ROUND(quantile_cont({c}::DOUBLE, 0.5), 2) AS q50, ROUND(quantile_cont({c}::DOUBLE, 0.75), 2) AS q75 FROM {{lineitem}}"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    ),
    digits=2,
)
def _(spark, sf):
    return pr.numeric_summary(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])


@check(
    "categorical_profile",
    """WITH c AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, COUNT(*) AS count FROM {orders} GROUP BY 2
         UNION ALL SELECT 'o_orderpriority', o_orderpriority, COUNT(*) FROM {orders} GROUP BY 2
         UNION ALL SELECT 'day', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), COUNT(*) FROM {orders} GROUP BY 2),
       d AS (SELECT "column", COUNT(*) AS distinct_values FROM c GROUP BY 1)
       SELECT d."column", distinct_values, value, count FROM d LEFT JOIN c ON c."column" = d."column" AND distinct_values <= 10""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate").cast("string"))
    return pr.categorical_profile(rows, ["o_orderstatus", "o_orderpriority", "day"])


@check("distinct_ids", "SELECT DISTINCT l_suppkey FROM {lineitem} WHERE l_suppkey IS NOT NULL")
def _(spark, sf):
    return pr.distinct_values(table(spark, sf, "lineitem"), "l_suppkey")


_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@check(
    "correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND(CORR({a}, {b}), 6) AS correlation FROM {{lineitem}}" for a in _NUM for b in _NUM),
)
def _(spark, sf):
    return pr.correlation_matrix(table(spark, sf, "lineitem"), _NUM)


# --- scalar rules -----------------------------------------------------------------------------

AREA_TEXT = """SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN ' epn ' WHEN 1 THEN 'SPN' WHEN 2 THEN 'lpn' WHEN 3 THEN 'Other' ELSE NULL END AS area FROM {customer}"""


@check(
    "licence_area_expand",
    f"""SELECT c_custkey, CASE upper(trim(area)) WHEN 'EPN' THEN 'Eastern Power Networks (EPN)' WHEN 'SPN' THEN 'South Eastern Power Networks (SPN)'
        WHEN 'LPN' THEN 'London Power Networks (LPN)' ELSE area END AS full_area FROM ({AREA_TEXT}) x""",
)
def _(spark, sf):
    return frame(spark, sf, AREA_TEXT).select("c_custkey", sc.expand_licence_area("area").alias("full_area"))


AREA_FIELDS = """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CASE c_nationkey % 4 WHEN 0 THEN 'South Eastern Power Networks' WHEN 1 THEN 'Eastern Power Networks'
   WHEN 2 THEN 'London' ELSE 'elsewhere' END END AS licencearea, CASE WHEN c_custkey % 2 = 0 THEN 'spn' ELSE '' END AS licence_area FROM {customer}"""


@check(
    "licence_area_detect",
    f"""WITH t AS (SELECT c_custkey, upper(COALESCE(NULLIF(licencearea, ''), NULLIF(licence_area, ''))) AS a FROM ({AREA_FIELDS}) x)
        SELECT c_custkey, CASE WHEN contains(a, 'SPN') OR contains(a, 'SOUTH EASTERN') THEN 'SPN' WHEN contains(a, 'EPN') OR contains(a, 'EASTERN') THEN 'EPN'
               WHEN contains(a, 'LPN') OR contains(a, 'LONDON') THEN 'LPN' END AS area FROM t""",
)
def _(spark, sf):
    rows = frame(spark, sf, AREA_FIELDS)
    return rows.select("c_custkey", sc.detect_licence_area(rows).alias("area"))


VOLTS = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS STRING) || 'kV' WHEN 1 THEN ' ' || CAST(p_size AS STRING) || ' KV ' WHEN 2 THEN CAST(p_size AS STRING) ELSE p_brand END AS v FROM {part}"


@check(
    "parse_voltage",
    f"""WITH t AS (SELECT p_partkey, TRY_CAST(trim(replace(lower(v), 'kv', '')) AS DOUBLE) AS kv FROM ({VOLTS}) x)
        SELECT p_partkey, kv, CASE WHEN kv >= 22 THEN 'grid' WHEN kv IS NOT NULL THEN 'primary' END AS transformer_type FROM t""",
)
def _(spark, sf):
    kv = sc.parse_voltage("v")
    return frame(spark, sf, VOLTS).select("p_partkey", kv.alias("kv"), sc.transformer_type(kv).alias("transformer_type"))


DATES = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T05:30:00Z'
   ELSE 'unknown' END AS d FROM {orders}"""


@check("date_normalise", f"SELECT o_orderkey, TRY_CAST(substr(d, 1, 10) AS DATE) AS day FROM ({DATES}) x")
def _(spark, sf):
    return frame(spark, sf, DATES).select("o_orderkey", sc.normalise_date("d").alias("day"))


ODD = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE) WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS v FROM {events}"""


@check("sanitise_non_finite", f"SELECT event_id, CASE WHEN isfinite(v) THEN ROUND(v, 6) END AS v, CASE WHEN isfinite(v) THEN ROUND(v, 6) END AS inner_v FROM ({ODD}) x")
def _(spark, sf):
    nested = frame(spark, sf, ODD).withColumn("n", F.struct(F.array("v").alias("a")))
    return sc.sanitise(nested).select("event_id", "v", F.col("n.a")[0].alias("inner_v"))


@check("clean_column_names", "SELECT o_orderkey AS order_key, o_custkey AS cust_key_id FROM {orders}")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Cust-Key.Id"))
    return sc.clean_names(rows)


TEXTS = """SELECT CAST(event_id AS STRING) AS id, CAST(ts AS STRING) AS event_time, CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(event_id * 3 AS STRING) END AS mostly,
   CASE WHEN event_id % 3 = 0 THEN '-' ELSE CAST(event_id AS STRING) END AS partly FROM {events}"""


@check(
    "infer_types",
    f"""SELECT CAST(id AS DOUBLE) AS id, TRY_CAST(event_time AS TIMESTAMP) AS event_time, TRY_CAST(mostly AS DOUBLE) AS mostly, partly FROM ({TEXTS}) x""".replace("AS STRING", "AS VARCHAR"),
)
def _(spark, sf):
    return sc.infer_types(frame(spark, sf, TEXTS))


@check(
    "any_text_match",
    """SELECT doc_id FROM {documents} WHERE contains(lower(text), 'license') OR contains(lower(source), 'license') OR contains(lower(lang), 'license')""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.where(sc.any_text_contains(docs, " License ")).select("doc_id")


@check("current_to_power", "SELECT event_id, ROUND(value * 11 * sqrt(3.0) * 0.97 / 1000, 6) AS mw FROM {events}")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", sc.amps_to_mw("value").alias("mw"))


@check("load_column", "SELECT event_id, ROUND(value * 11 * sqrt(3.0) * 0.97 / 1000, 6) AS load_mw FROM {events}")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.lit(None).cast("double").alias("total_mw"), F.col("value").cast("string").alias("Current_Amps_A"))
    return rows.select("event_id", sc.load_column(rows).alias("load_mw"))


# --- records and catalog ----------------------------------------------------------------------


@check(
    "json_records",
    """SELECT CASE WHEN event_id % 3 = 2 THEN 'unknown' ELSE CAST(event_id AS VARCHAR) END AS id, event_type, ROUND(value, 6) AS value FROM {events}""",
)
def _(spark, sf):
    rows = table(spark, sf, "events")
    third = F.col("event_id") % 3
    raw = rows.select(
        F.when(third == 0, F.col("event_id")).alias("id"),
        F.when(third == 1, F.col("event_id").cast("string")).alias("recordid"),
        F.when(third != 2, F.struct("event_type", "value")).alias("fields"),
        F.when(third == 2, F.col("event_type")).alias("event_type"),
        F.when(third == 2, F.col("value")).alias("value"),
    )
    return flatten_records(raw)


# Schema snapshots made from the rows: one dataset per customer segment and nation parity.
SNAPSHOT = """SELECT c_mktsegment AS dataset_id, collect_set('f' || CAST((c_custkey * {k}) % {m} AS STRING)) AS fields FROM {{customer}} GROUP BY 1"""


@check(
    "schema_drift",
    """WITH a AS (SELECT c_mktsegment AS dataset_id, list(DISTINCT 'f' || CAST(c_custkey % 7 AS VARCHAR)) AS f FROM {customer} GROUP BY 1),
       b AS (SELECT c_mktsegment AS dataset_id, list(DISTINCT 'f' || CAST((c_custkey * 2) % 9 AS VARCHAR)) AS f FROM {customer} WHERE c_mktsegment <> 'BUILDING' GROUP BY 1)
       SELECT a.dataset_id, array_to_string(list_sort(list_filter(b.f, lambda x: NOT list_contains(a.f, x))), ',') AS added,
              array_to_string(list_sort(list_filter(a.f, lambda x: NOT list_contains(b.f, x))), ',') AS removed,
              len(list_filter(a.f, lambda x: NOT list_contains(b.f, x))) > 0 AS breaking
       FROM a JOIN b ON a.dataset_id = b.dataset_id""",
)
def _(spark, sf):
    stored = frame(spark, sf, SNAPSHOT.format(k=1, m=7))
    live = frame(spark, sf, SNAPSHOT.format(k=2, m=9)).where("dataset_id <> 'BUILDING'")
    drift = ct.schema_drift(stored, live)
    return drift.withColumns({c: F.concat_ws(",", c) for c in ("added", "removed")})


META = """SELECT c_custkey AS row, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE ' ds' || CAST(c_custkey % 400 AS STRING) || ' ' END AS datasetid, c_name AS title FROM {customer}"""


@check(
    "unmanaged_ids",
    f"""WITH m AS (SELECT trim(datasetid) AS dataset_id, title, row FROM ({META.replace("AS STRING", "AS VARCHAR")}) x WHERE trim(datasetid) <> '')
        SELECT dataset_id, arg_min(title, row) AS title FROM m WHERE dataset_id NOT IN (SELECT 'ds' || CAST(s_suppkey AS VARCHAR) FROM {{supplier}}) GROUP BY 1""",
)
def _(spark, sf):
    published = ct.published_ids(frame(spark, sf, META), title="title")
    known = frame(spark, sf, "SELECT 'ds' || CAST(s_suppkey AS STRING) AS dataset_id FROM {supplier}")
    return ct.unmanaged_ids(published, known)


@check(
    "merged_ids",
    "SELECT DISTINCT c_mktsegment AS dataset_id FROM {customer} UNION SELECT DISTINCT o_orderpriority FROM {orders}",
)
def _(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("dataset_id"))
    right = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("dataset_id"))
    return ct.merged_ids(left, right)
