"""Query parameters as DataFrame operations: project, filter, refine, group, sort, page, facets.

Text conditions and expressions go to Spark's own SQL parser.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.cells import INDEX_COLUMNS
from gridspark.functions.geo import within_distance, within_polygon
from gridspark.operators.paging import page


def query(
    df: DataFrame,
    select: str | Sequence[str] | None = None,
    columns: str | Sequence[str] | None = None,
    where: str | Column | None = None,
    order_by: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    group_by: str | None = None,
    refine: Mapping[str, object] | None = None,
    exclude: Mapping[str, object] | None = None,
    polygon: Sequence[tuple[float, float]] | str | None = None,
    distance: tuple[float, float, float] | str | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Apply the parameters in the order filter, group or project, sort, page."""
    if columns is not None and select is not None:
        raise ValueError("'select' and 'columns' say the same: give one of them")
    out = matching(df, where, refine, exclude, polygon, distance)
    chosen = _expressions(select if columns is None else columns)
    if group_by:
        out = grouped(out, group_by, chosen)
        out = page(out, order_by, limit, offset, tiebreak)
    elif order_by and chosen:
        # Sort keys may be left out of the projection.
        out = project(page(out, order_by, limit, offset, tiebreak), chosen)
    else:
        out = page(project(out, chosen), order_by, limit, offset, tiebreak)
    # Columns of a spatial index serve the filter; they are in the result only if asked for.
    return out if chosen or not set(INDEX_COLUMNS) <= set(out.columns) else out.drop(*INDEX_COLUMNS)


def matching(df: DataFrame, where=None, refine=None, exclude=None, polygon=None, distance=None) -> DataFrame:
    """Rows that meet every given condition."""
    cond = merge_where(where)
    for name, value in (refine or {}).items():
        cond = both(cond, F.col(name) == F.lit(value))
    for name, value in (exclude or {}).items():
        # Rows without a value are kept: they do not have the excluded one.
        cond = both(cond, ~F.col(name).eqNullSafe(F.lit(value)))
    if polygon:
        cond = both(cond, within_polygon(df, polygon))
    if distance:
        cond = both(cond, within_distance(df, distance))
    return df if cond is None else df.where(cond)


def both(a: Column | None, b: Column | None) -> Column | None:
    if a is None or b is None:
        return b if a is None else a
    return a & b


def merge_where(*conditions: str | Column | None) -> Column | None:
    """AND of all conditions, each taken as a whole; blank ones and ``()`` mean no filter."""
    out = None
    for c in conditions:
        if isinstance(c, str):
            c = None if c.strip() in ("", "()", "( )") else F.expr(c)
        out = both(out, c)
    return out


def _expressions(select: str | Sequence[str] | None) -> str | None:
    if select is None or not len(select):
        return None
    return select if isinstance(select, str) else ", ".join(select)


def _sql(df: DataFrame, text: str) -> DataFrame:
    return df.sparkSession.sql(text, source_=df)


def _plain(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def project(df: DataFrame, select: str | Sequence[str] | None) -> DataFrame:
    """Columns or expressions, as text or a list."""
    text = _expressions(select)
    return df if text is None else _sql(df, f"SELECT {_plain(text)} FROM {{source_}}")


def grouped(df: DataFrame, group_by: str, select: str | Sequence[str] | None) -> DataFrame:
    """Aggregates per group; group columns that ``select`` leaves out come first."""
    text = _expressions(select) or group_by
    source = f"FROM {{source_}} GROUP BY {_plain(group_by)}"
    out = _sql(df, f"SELECT {_plain(text)} {source}")
    missing = [g.strip() for g in group_by.split(",") if "(" not in group_by and g.strip().strip("`") not in out.columns]
    return _sql(df, f"SELECT {', '.join(missing)}, {_plain(text)} {source}") if missing else out


def fetch_all(df: DataFrame, where: str | Column | None = None, max_records: int | None = None, order_by: str | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """All matching rows; with ``max_records`` the first of them in the order given."""
    return page(matching(df, where), order_by, max_records, tiebreak=tiebreak)


def with_total(df: DataFrame, page_of: DataFrame) -> DataFrame:
    """Add to a page the row count of the whole match it was taken from."""
    return df.withColumn("total_count", page_of.agg(F.count("*")).scalar())


def facet_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(facet, value, count)`` for all facet columns in one pass; nulls are not listed."""
    cells = [F.struct(F.lit(c).alias("facet"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*cells)).alias("_f"))
        .select("_f.*")
        .where(F.col("value").isNotNull())
        .groupBy("facet", "value")
        .agg(F.count("*").alias("count"))
    )
