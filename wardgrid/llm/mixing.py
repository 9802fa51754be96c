"""Mixing sources to target weights by hash-random order and prefix sums.

Every document gets a random key (md5 of its id), so a source sorted by key is a random order
that every run repeats. Each source has a budget of words. Whole passes (epochs) over the source
come first; the rest of the budget takes the documents in key order, and the document at the cut
gives just the words still missing, so a source's taken words equal its budget rounded down.

Keys are range-partitioned by their first digits: block sums of words are added up first, then
each block of a source runs on from its offset (`running_total`). A source with a third of all
rows is so spread over as many tasks as it has blocks.

Edge cases: null or blank texts have size 0 and are taken 0 times; a null source is a source of
its own, weighed last; a null doc_id has the key of the empty id; repeated rows are separate
documents (next to one another in key order); an empty table gives an empty result; other columns
are ignored. The sources themselves (one row each) are weighed in one task: they are metadata.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.llm.shared import broadcast_if_small, running_total, same, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROWS_PER_BLOCK = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target): weighted shares, none above `most` times its source's size.

    Sources are filled in the order of (capacity / weight). Those before the first source whose
    capacity exceeds its weighted share of what is left are full; the others divide the rest.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("_fill", "_rank")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = (
        sized.groupBy("source")
        .agg(F.sum("size").cast("long").alias("source_size"))
        .withColumn("_rank", F.row_number().over(by_source) - 1)
        .withColumn("_weight", weight)
        .withColumn("_most", F.col("source_size") * F.lit(most))
        .withColumn("_fill", F.col("_most") / F.col("_weight"))
    )
    filled = ranked.select(
        "*",
        (
            (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_most").over(earlier), F.lit(0)))
            / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0)))
        ).alias("_level"),
    )
    fits = F.when(F.col("_level") <= F.col("_fill"), F.struct("_fill", "_rank", "_level"))
    level = F.min(fits).over(everything)["_level"]
    return filled.withColumn("_level", level).select(
        "source",
        "source_size",
        F.least(F.col("_most").cast("double"), F.coalesce(F.col("_weight") * F.col("_level"), F.lit(float("inf")))).alias("target"),
    )


def mix_sizes(
    spark: SparkSession,
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """sized: doc_id, source, size (words). Adds source_size, target and taken."""
    rows = sized.count()
    digits = min(6, max(1, math.ceil(math.log(max(2, rows / ROWS_PER_BLOCK), 16))))
    keyed = sized.withColumn("mix_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn(
        "_range", F.conv(F.substring("mix_key", 1, digits), 16, 10).cast("int")
    )
    ordered = running_total(keyed, "size", ["source"], "_range", [F.col("mix_key"), F.col("doc_id"), F.col("size")], "_before")
    targets = broadcast_if_small(source_targets(sized, weights, share, most).withColumnRenamed("source", "_source"))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return ordered.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mix(spark: SparkSession, docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document (`mix_sizes`)."""
    sized = stored(spark, docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return mix_sizes(spark, sized, **parameters)


def mix_documents(spark: SparkSession, docs: DataFrame, **parameters) -> DataFrame:
    """The mixed corpus itself, in the columns of docs: a document taken twice comes as two rows.

    A source's budget ends inside one document; that copy keeps its first words, joined by one
    space, and its n_chars. Rows that share doc_id, source and size share one decision (their
    words count together and a cut is divided evenly among them). Documents without words add
    nothing to a mix and are left out.
    """
    key = ["doc_id", "source", "size"]
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("_words"))
    grouped = sizes.groupBy("doc_id", "source", "_words").agg(F.count("*").alias("_rows"))
    merged = stored(
        spark,
        grouped.select("doc_id", "source", (F.col("_words") * F.col("_rows")).alias("size"), "_words", "_rows"),
        "mix-sizes",
    )
    taken = (
        mix_sizes(spark, merged.select(*key), **parameters)
        .join(merged.withColumnsRenamed({k: f"_{k}" for k in key}), F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
        .filter("taken > 0")
        .select(
            F.col("doc_id").alias("_doc_id"),
            F.col("source").alias("_source"),
            F.col("_words").alias("_size"),
            F.floor(F.col("taken") / F.col("_rows")).alias("_taken"),
        )
        .dropDuplicates(["_doc_id", "_source", "_size"])
    )
    chosen = docs.withColumn("_words", word_count(F.col("text"))).join(
        taken,
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")),
    )
    copies = chosen.filter("_taken > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_words")).cast("int")))
    )
    keep = F.least(F.col("_words"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_words")).cast("int")
    gap = r"[\x20\x09-\x0D]+"
    first_words = F.array_join(F.slice(F.split(F.regexp_replace("text", "^" + gap, ""), gap), 1, keep), " ")
    whole = keep == F.col("_words")
    out = copies.withColumn("_text", F.when(whole, F.col("text")).otherwise(first_words))
    replaced = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        kept = F.when(whole, F.col("n_chars")).otherwise(F.char_length("_text"))
        replaced["n_chars"] = kept.cast(docs.schema["n_chars"].dataType)
    return out.select(*[replaced.get(c, F.col(c)).alias(c) for c in docs.columns])


#: Checks op10 in DuckDB.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS mix_key
  FROM documents
), sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rnk
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][rnk % 3 + 1] AS weight, source_size * 2 AS most, source_size * 2 / CAST([3, 1, 2][rnk % 3 + 1] AS DOUBLE) AS fill
  FROM sources
), levels AS (
  SELECT *, (CAST(SUM(source_size) OVER () AS DOUBLE) * 1.5
             - CAST(COALESCE(SUM(most) OVER (ORDER BY fill, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(SUM(weight) OVER () - COALESCE(SUM(weight) OVER (ORDER BY fill, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS lev
  FROM weighed
), chosen AS (
  SELECT lev FROM levels WHERE lev <= fill ORDER BY fill, rnk LIMIT 1
), targets AS (
  SELECT source, source_size, LEAST(CAST(most AS DOUBLE), weight * lev) AS target
  FROM weighed, chosen
), ordered AS (
  SELECT sized.*, targets.source_size, targets.target, CAST(FLOOR(targets.target) AS BIGINT) AS budget,
         CAST(SUM(size) OVER (PARTITION BY sized.source ORDER BY mix_key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM ordered
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + GREATEST(0, LEAST(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM passes
"""
