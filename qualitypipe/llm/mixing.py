"""Mixing sources to target weights by Poisson replication.

A source with weight w should make up w / (sum of weights) of the result, so each of its rows is wanted
(w / sum) * rows * epochs / (rows of the source) times on average. How often a row is taken is drawn from the Poisson
distribution with that mean, by inverting it at a number between 0 and 1 that a hash of the seed and the whole row
gives; a large mean is the sum of several draws with means of 50 at most. Rows are exploded by their counts and put in the order of
another hash: a global shuffle, the same on every run.

Defined results: null sources are a source of their own (``None`` in the weights). A source without a weight
has weight 1; weight 0 takes no row. Ids play no part, so rows without an id or with the same one draw for themselves. n rows that are
equal in every column are drawn n times, all copies numbered in one sequence. An empty table gives an empty result;
empty and long texts are only carried. Columns named like the added ones (``copy_no``, ``shuffle_key``) stay, and
the added ones get underscores behind their names; all other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitypipe.llm.shared import written

MEAN_PER_DRAW = 50.0
#: With as many sources or fewer, their rates are sent to all tasks (about 1.4 kB each); with more, rows are joined by shuffle.
FEW_SOURCES = 2_000
#: Likewise for the digests (32 bytes) of rows that repeat.
FEW_REPEATED = 200_000


def chance(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 bits from the md5 of the parts."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 13), 16, 10)
    return bits.cast("double") / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str | None, float] | None, epochs: float, source: str = "source") -> DataFrame:
    """One row per source: its name, mean, number of draws, and the cumulative probabilities of one draw."""
    counts = written(docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_n")), "source-counts")
    weight = F.lit(1.0)
    for name, value in (weights or {}).items():
        if value < 0:
            raise ValueError("weights must not be negative")
        weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("_weight", weight)
    rows, total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0.0))).first()
    if not total:
        return counts.select("_source", F.lit(0.0).alias("_mean"), F.lit(1).alias("_draws"), F.array(F.lit(1.0)).alias("_below"))
    mean = F.col("_weight") * F.lit(rows * epochs / total) / F.col("_n")
    draws = F.greatest(F.lit(1), F.ceil(mean / MEAN_PER_DRAW)).cast("int")
    one = counts.select("_source", mean.alias("_mean"), draws.alias("_draws")).withColumn("_each", F.col("_mean") / F.col("_draws"))
    last = F.ceil(F.col("_each") + 12 * F.sqrt("_each") + 20).cast("int")
    below = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-F.col("_each")).alias("p"), F.array(F.exp(-F.col("_each"))).alias("below")),
        lambda a, k: F.struct(
            (a["p"] * F.col("_each") / k).alias("p"),
            F.concat(a["below"], F.array(F.element_at(a["below"], -1) + a["p"] * F.col("_each") / k)).alias("below"),
        ),
        lambda a: a["below"],
    )
    return one.select("_source", "_mean", "_draws", below.alias("_below"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    epochs: float = 1.0,
    seed: int = 1,
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as drawn, with ``copy_no`` (from 1) and ``shuffle_key``, in the order of the latter."""
    by_source = written(rates(docs, weights, epochs, source), "source-rates")
    few = by_source.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES
    by_source = F.broadcast(by_source) if few else by_source
    # numbers instead of names, so that no column can be taken for one of those joined
    columns = [f"_{i}" for i in range(len(docs.columns))]
    source_column = columns[docs.columns.index(source)]
    rows = _counted_once(docs.toDF(*columns), columns)
    draws = F.sequence(F.lit(1), (F.col("_draws") * F.col("_n")).cast("int"))
    chances = F.transform(draws, lambda j: chance(str(seed), "draw", F.col("_row"), j.cast("string")))
    drawn = F.aggregate("_chances", F.lit(0), lambda a, u: a + F.size(F.filter("_below", lambda p: p <= u)))
    joined = rows.join(by_source, F.col(source_column).eqNullSafe(F.col("_source")), "left")
    counted = joined.withColumn("_chances", chances).select(*columns, "_row", drawn.alias("_times")).filter("_times > 0")
    copies = counted.select(*columns, "_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), F.col("_row"), F.col("_copy").cast("string")))
    ordered = copies.select(*columns, "_copy", order.alias("_order")).orderBy("_order", "_copy")
    return ordered.toDF(*docs.columns, *added_columns(docs.columns))


def added_columns(columns: list[str]) -> list[str]:
    """``copy_no`` and ``shuffle_key``, with underscores behind them as long as the rows have a column of that name."""
    taken, names = {c.lower() for c in columns}, []
    for name in ("copy_no", "shuffle_key"):
        while name in taken:
            name += "_"
        names.append(name)
    return names


def _row_digest(columns: list[str]) -> Column:
    """md5 of all columns of a row; a null is not an empty text."""
    each = [F.md5(F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))) for c in columns]
    return F.md5(F.concat(*each))


def _counted_once(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Each row with ``_row``, its digest, and ``_n``: rows that are equal in every column are one row, counted.

    Only digests are shuffled to find them; where rows repeat, only these are grouped, with partial counts.
    """
    keyed = rows.withColumn("_row", _row_digest(columns))
    repeated = written(keyed.groupBy("_row").count().filter("count > 1").select("_row"), "repeated-rows")
    number = repeated.limit(FEW_REPEATED + 1).count()
    if not number:
        return keyed.withColumn("_n", F.lit(1))
    repeated = F.broadcast(repeated) if number <= FEW_REPEATED else repeated
    once = keyed.join(repeated, "_row", "left_anti").select(*columns, "_row", F.lit(1).cast("long").alias("_n"))
    grouped = keyed.join(repeated, "_row", "left_semi").groupBy("_row")
    many = grouped.agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("_n"))
    return once.unionByName(many)


def oracle_sql(columns: str, seed: int = 1) -> str:
    """DuckDB's SQL for ``mix`` with equal weights and one epoch, for means up to 50 and rows that don't repeat."""
    digest = " || ".join(f"md5(coalesce('s' || {c}::VARCHAR, 'n'))" for c in columns.split(", "))
    return f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM counts)::DOUBLE / (SELECT count(*) FROM counts) / n AS mean FROM counts),
chances AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM (
    SELECT source, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p FROM rates, range(0, 200) AS r(k)) AS terms),
draws AS (
  SELECT *, ('0x' || substr(md5('{seed}|draw|' || digest || '|1'), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM (SELECT *, md5({digest}) AS digest FROM documents) AS d),
counted AS (
  SELECT {columns}, digest, (SELECT count(*) FROM chances AS c WHERE c.source IS NOT DISTINCT FROM draws.source AND c.below <= draws.u AND c.k <
    ceil(0.0 + (SELECT mean FROM rates AS r WHERE r.source IS NOT DISTINCT FROM draws.source)) + 60) AS times FROM draws)
SELECT {columns}, copy_no::INTEGER AS copy_no,
  md5('{seed}|order|' || digest || '|' || copy_no::VARCHAR) AS shuffle_key
FROM (SELECT {columns}, digest, unnest(range(1, times + 1)) AS copy_no FROM counted) AS copies
"""
