"""Quality rules: an ordered list of threshold conjunctions, learned by sequential covering from labelled statistics.

Statistics of every text are computed with built-in functions and kept as a narrow table. The labelled rows among
them are binned at quantiles; each growing or pruning step is one grouped count over (statistic, bin), so what reaches
the driver is bounded by statistics times bins. A rule is grown on two thirds of the rows (FOIL's gain), its last
conditions are dropped while that does not hurt its precision on the rest, and it is taken only if it is precise
enough there. The list becomes one ordered CASE expression.

Rows: a null text has no words. Labels of a document that repeat count once, the worse one. Without labels no rule is
learned. Ties are broken by statistic and bin, so reruns agree. Very long texts are taken whole, in memory proportional to
their words. Repeated rows are rows of their own. An empty table gives an empty result. Columns other than id and text are not read,
so their names cannot clash. A list has at most MAX_RULES rules of MAX_CONDITIONS conditions: it is to be read by people.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, WORD, keep, read

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50
#: Labelled rows used for learning, at most about so many, chosen by a hash of the id.
SAMPLE_ROWS = 200_000
BINS = 24
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVER = 5
SHARES = ("symbol_share", "dup_line_share", "repeat_share", "word_length", "n_words")


def _windows(w: Column) -> Column:
    """Hash and position of the windows of three words of the array ``w``, sorted, so that equal ones are neighbours.

    The hash keeps its 64 bits whatever the length of the text.
    """
    n = F.size(w)
    one = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))
    return F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), one)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    t = t.withColumn("_w", F.filter(F.split("_t", WHITE), lambda x: x != ""))
    t = t.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)))
    chars = F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))
    t = t.select(
        F.col("_id").alias(id_col),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        chars.cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        _windows(F.col("_w")).alias("_r"),
    )
    # Neighbours in the sorted windows that agree; their positions, sorted, cover three words each.
    at = lambda i: F.get("_r", i)
    last = F.size("_r") - 1
    same = F.filter(F.sequence(F.lit(0), last), lambda i: ((i > 0) & (at(i)["h"] == at(i - 1)["h"])) | ((i < last) & (at(i)["h"] == at(i + 1)["h"])))
    t = t.withColumn("_s", F.when(F.col("_r").isNotNull(), F.sort_array(F.transform(same, lambda i: at(i)["p"].cast("long")))))
    covered = F.aggregate(
        "_s",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("at")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3).cast("long"), x - a["at"])).alias("n"), x.alias("at")),
    )["n"]
    return t.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_r", "_s")


def shares() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
        "n_words": F.col("n_words").cast("double"),
    }


def _holds(rule: list, cols: dict[str, Column]) -> Column:
    """rule: (name, above, bound) triples."""
    out = F.lit(True)
    for name, above, bound in rule:
        out = out & ((cols[name] > F.lit(bound)) if above else (cols[name] <= F.lit(bound)))
    return out


def _any(rules: list, cols: dict[str, Column]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | _holds(r, cols)
    return out


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[list[tuple[str, bool, float]]]:
    """The decision list: rules for rows of label 0, in the order in which they are tried."""
    worst = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("_y"))
    known = worst.count()
    if not known:
        return []
    worst = worst.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < min(1.0, sample_rows / known) * 1_000_000)
    rows = stats.join(worst, id_col).select(F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(3)).alias("_part"), (F.col("_y") == 0).cast("int").alias("_bad"), *[c.alias(n) for n, c in shares().items()])
    rows = keep(rows, "labelled")
    cuts: dict[str, list[float]] = {}
    quantiles = [F.percentile_approx(n, [i / BINS for i in range(BINS + 1)], 10_000).alias(n) for n in SHARES]
    for r in rows.groupBy("_bad").agg(*quantiles).collect():  # two rows
        for n in SHARES:
            cuts[n] = sorted({*cuts.get(n, []), *(r[n] or [])})
    if not cuts:
        return []
    above = lambda n: F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts[n]]), lambda x: F.col(n) > x))
    bins = [above(n).alias(n) for n in SHARES]
    rows = keep(rows.groupBy("_part", "_bad", *bins).agg(F.count(F.lit(1)).alias("_m")), "binned")
    # Above cut k of a statistic means bin > k.
    bounded = {n: F.col(n) for n in SHARES}

    def counts(left: DataFrame) -> dict:
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in SHARES])).alias("c")
        got = left.select("_bad", "_m", cells).groupBy("c.f", "c.b").agg(F.sum(F.col("_m") * F.col("_bad")).alias("p"), F.sum(F.col("_m") * (1 - F.col("_bad"))).alias("n"))
        return {(r["f"], r["b"]): (r["p"], r["n"]) for r in got.collect()}  # statistics times bins at most

    def totals(left: DataFrame) -> tuple[int, int]:
        r = left.agg(F.sum(F.col("_m") * F.col("_bad")), F.sum(F.col("_m") * (1 - F.col("_bad")))).first()
        return r[0] or 0, r[1] or 0

    rules: list[list[tuple[str, bool, int]]] = []
    while len(rules) < MAX_RULES:
        left = rows.filter(~_any(rules, bounded)) if rules else rows
        grow, prune = left.filter("_part > 0"), left.filter("_part = 0")
        rule: list[tuple[str, bool, int]] = []
        p0, n0 = totals(grow)
        while p0 and n0 and len(rule) < MAX_CONDITIONS:
            c = counts(grow.filter(_holds(rule, bounded)))
            best = (0.0, None, 0, 0)
            for name in SHARES:
                for k in range(len(cuts[name])):
                    for above in (True, False):
                        inside = [v for (f, b), v in c.items() if f == name and (b > k) == above]
                        p, n = sum(v[0] for v in inside), sum(v[1] for v in inside)
                        if p >= MIN_COVER and (gain := p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))) > best[0] + 1e-9:
                            best = (gain, (name, above, k), p, n)
            if best[1] is None:
                break
            rule.append(best[1])
            p0, n0 = best[2], best[3]
        if not rule:
            break
        scored = []
        for k in range(1, len(rule) + 1):
            p, n = totals(prune.filter(_holds(rule[:k], bounded)))
            scored.append(((p + 1) / (p + n + 2) if p + n else 0.0, -k, p, n))
        value, k, p, n = max(scored)
        if p + n == 0 or p / (p + n) < MIN_PRECISION or value < MIN_PRECISION - 0.15:
            break
        rules.append(rule[:-k])
    return [[(n, above, float(cuts[n][k])) for n, above, k in r] for r in rules]


def verdict(rules: list[list[tuple[str, bool, float]]]) -> Column:
    """Number (from 1) of the first rule that rejects a row of ``statistics``; null if none does."""
    cols, out = shares(), None
    for i, r in enumerate(rules, 1):
        out = F.when(_holds(r, cols), F.lit(i)) if out is None else out.when(_holds(r, cols), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def apply_rules(stats: DataFrame, rules: list) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    stats = keep(statistics(read(spark, sf, "documents")), "statistics")
    rules = learn(stats, read(spark, sf, "labels"))
    return apply_rules(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
