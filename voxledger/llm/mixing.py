"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Each source has a total (its target of words) and a schedule: its share of that total per unit of
training time goes in a straight line from ``f`` times the mean to ``2 - f`` times. The integral of the
schedule is the source's demand, ``target * (f t + (1 - f) t^2)`` words up to time ``t``. A document that
begins ``c`` words into its source gets the position where the demand is ``c``: the inverse of the
integral. Documents of all sources, sorted by position, are the curriculum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxledger.llm.common import checkpoint, column

# Weights of the sources by code point, repeating; the first share of each schedule.
WEIGHTS = (5, 2, 1)
FIRST_SHARES = (1.5, 1.0, 0.5)
SHARE = 1.5  # words of the mix, by all words
MOST = 2  # times that a document may be taken
BUCKET_ROWS = 4_096  # documents of a source that are summed in one window

SIZE = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """``id``, ``source``, ``size`` and ``ordinal``: an order within the source by a digest of id and text,
    so rows without ids, or with one repeated id, are spread as well."""
    key = F.concat(F.coalesce(column(id_col).cast("string"), F.lit("")), F.lit(" "), F.md5(F.coalesce(column(text), F.lit("")).cast("binary")))
    return docs.select(
        column(id_col).alias("id"),
        column(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(column(text), F.lit(SIZE)), F.lit(0)).cast("long").alias("size"),
        F.md5(key.cast("binary")).alias("ordinal"),
    )


def source_targets(
    sizes: DataFrame,
    weights: tuple = WEIGHTS,
    first_shares: tuple = FIRST_SHARES,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """One row per source: ``source_size``, ``n_docs``, ``target``, ``first_share``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words. Sorted
    by the level at which each is full (``most`` times its size by its weight), the first one that is
    not full when all before it are gives the level of the rest. The windows run over sources, not
    over documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), ((F.col("rank") - 1) % len(values) + 1).cast("int"))
    ranked = (
        per_source.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", pick(weights))
        .withColumn("first_share", pick(first_shares))
        .withColumn("most", F.lit(float(most)) * F.col("source_size"))
    )
    fill = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    levels = ranked.select(
        "*",
        (
            (F.lit(float(share)) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
        F.row_number().over(fill).alias("turn"),
    )
    rest = F.min(F.when(F.col("most") / F.col("weight") > F.col("level"), F.struct("turn", "level"))).over(all_rows)["level"]
    return levels.select(
        "source",
        "source_size",
        "n_docs",
        "first_share",
        F.least(F.col("most"), F.coalesce(F.col("weight") * rest, F.col("most"))).alias("target"),
    )


def position(words: Column, target: Column, first: Column) -> Column:
    """The training time in [0, 1] at which the demand of a source is ``words``."""
    y = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(F.lit(0.0))
    root = F.sqrt(first * first + F.lit(4.0) * (F.lit(1.0) - first) * y)
    # First shares are positive, so the divisor is too.
    return F.lit(2.0) * y / (first + root)


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    first_shares: tuple = FIRST_SHARES,
    share: float = SHARE,
    most: int = MOST,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per input row: ``id``, ``source``, ``size``, ``source_size``, ``target`` and ``passes``.

    ``passes`` lists what the mix takes of the document: one struct (``epoch``, ``taken``,
    ``position``) per time its source's demand reaches it, at most ``most``. A source is gone through
    in the order of a digest of id and text, again and again until its target is met; the last document is
    taken in part, so a source's words are its target, rounded down. Rows that repeat id and text share
    an order; which of them comes first does not show in the result. Null texts have size 0, a null
    source is a source, an empty table gives an empty result. Texts are counted whole; other columns,
    clashing ones too, are not read.

    A running sum within a source is cut into buckets of about ``bucket_rows`` documents: each sums its
    own, and a table of bucket totals carries the sums over, so a large source is many tasks.
    """
    sizes = checkpoint(sized(docs, id_col, text, source))
    targets = checkpoint(source_targets(sizes, weights, first_shares, share, most))
    of = targets.withColumnRenamed("source", "of")
    # The first 32 bits of the digest, as a fraction of the source's buckets.
    fraction = F.conv(F.substring("ordinal", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    buckets = F.ceil(F.col("n_docs") / F.lit(bucket_rows))
    placed = sizes.join(of, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "ordinal", "source_size", "target", "first_share",
        F.floor(fraction * buckets).alias("bucket"),
    )
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("source").alias("of"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("carried")
    )
    within = Window.partitionBy("source", "bucket").orderBy("ordinal", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = running.join(carried, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("of_bucket")))
    start = F.col("before") + F.col("carried")
    words = F.floor(F.col("target"))
    passes = []
    for epoch in range(most):
        begin = start + F.lit(epoch) * F.col("source_size")
        passes.append(
            F.struct(
                F.lit(epoch).alias("epoch"),
                F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), words - begin)).alias("taken"),
                position(begin.cast("double"), F.col("target"), F.col("first_share")).alias("position"),
            )
        )
    return joined.select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        F.filter(F.array(*passes), lambda p: p["taken"] > 0).alias("passes"),
    )


def mix_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the position at which it is first taken.

    Range-sorted by this position; documents that are never taken (null) come last.
    """
    mixed = mix_sources(docs).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["taken"]).alias("taken"),
        F.array_min(F.transform("passes", lambda p: p["position"])).alias("first_position"),
    )
    by = (F.col("first_position").asc_nulls_last(), F.col("doc_id").asc_nulls_last())
    return mixed.repartitionByRange(*by).sortWithinPartitions(*by)


def curriculum(docs: DataFrame, **how) -> DataFrame:
    """The mix as a table sorted by position: ``id``, ``source``, ``epoch``, ``taken``, ``position``."""
    rows = mix_sources(docs, **how).select("id", "source", F.explode("passes").alias("p")).select("id", "source", "p.*")
    return rows.repartitionByRange(column("position"), column("id")).sortWithinPartitions("position", "id", "epoch")


# The same rows in SQL. Sources are ranked, filled up in the order of their levels, and documents are
# summed in the order of the digest of their ids.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))) AS ordinal
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight,
         [1.5, 1.0, 0.5][(rank - 1) % 3 + 1]::DOUBLE AS first_share, 2.0::DOUBLE * source_size AS most
  FROM per_source),
levels AS (
  SELECT *, row_number() OVER fill AS turn,
    (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM ranked WINDOW fill AS (ORDER BY most / weight, rank)),
rest AS (SELECT min_by(level, turn) FILTER (WHERE most / weight > level) AS level FROM levels),
targets AS (
  SELECT l.source, l.source_size, l.first_share, least(l.most, coalesce(l.weight * r.level, l.most)) AS target
  FROM levels l, rest r),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.first_share,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ordinal, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - start)) AS one,
            greatest(0, least(size, floor(target)::BIGINT - start - source_size)) AS two FROM placed),
timed AS (
  SELECT *, CASE WHEN target > 0 THEN least((CASE WHEN one > 0 THEN start ELSE start + source_size END)::DOUBLE / target, 1.0) ELSE 0.0 END AS y
  FROM taken)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
       CASE WHEN one + two > 0 THEN 2.0::DOUBLE * y / (first_share + sqrt(first_share * first_share + 4.0::DOUBLE * (1.0 - first_share) * y)) END AS first_position
FROM timed
"""

