"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stage, text_of, unused

WORD = r"[^\x20\x09-\x0D]+"
#: Documents in one ordered range of a source, about.
RANGE_ROWS = 4_096


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Target per source from (source, source_size): shares of the total by weight.

    Sources by code point, NULL last, take ``weights`` in turn. A target stops at ``most``
    times its source's size and the excess goes to the others by weight, until none is
    above: with sources ordered by size over weight, the first k stop at their bound, for
    the smallest k that leaves the next one below its own.
    """
    rank = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    turn = (F.row_number().over(rank) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("total") - F.col("bounded")) / F.col("free")
    return (
        sizes.withColumn("weight", weight)
        .withColumn("bound", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn("bounded", F.coalesce(F.sum("bound").over(earlier), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("free", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        # the level falls below a source's ratio at the first one that does not stop
        .withColumn("level", F.first(F.when(F.col("ratio") > level, level), ignorenulls=True).over(every))
        .withColumn("target", F.least("bound", F.coalesce(F.col("level") * F.col("weight"), F.col("bound"))))
        .select("source", "source_size", "target")
    )


def sizes_of(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """doc_id, source, size, and the hash-random key of each document."""
    size = F.regexp_count(text_of(), F.lit(WORD)) if size is None else size
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        size.cast("long").alias("size"),
        F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Words taken from each document so that each source meets its target.

    Every source is ordered by a hash of doc_id: an order that reruns repeat. Ordered
    ranges of the hash hold about ``RANGE_ROWS`` documents, however large the source; sums
    per range give each range its offset. A source's budget is its target, rounded down:
    whole epochs of it are taken, then documents in order, the last of them in part.

    Columns: doc_id, size, source_size, target, taken (words, repeats counted), source.
    NULL texts have size 0; a NULL source is a source; repeated rows are documents of their
    own, ties in the order are broken by size; an empty table gives no rows.
    """
    rows = stage(sizes_of(docs))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = source_targets(sums.select("source", "source_size"), weights, most)
    plan = plan.join(sums.select(F.col("source").alias("s"), "n_docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = stage(plan.withColumn("n_ranges", F.ceil(F.col("n_docs") / RANGE_ROWS)).drop("n_docs"))
    # 24 bits of the key, in equal ranges
    place = F.conv(F.substring("key", 1, 6), 16, 10).cast("long")
    rows = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("range", F.floor(place * F.col("n_ranges") / F.lit(1 << 24)))
    in_range = rows.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_range.select(
        F.col("source").alias("s"), F.col("range").alias("r"),
        F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("before_range"),
    )
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    order = Window.partitionBy("source", "range").orderBy("key", "size", "doc_id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("before_range") - F.col("before")
    return (
        rows.withColumn("before", before).withColumn("epochs", epochs)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least("size", rest)))
        .select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "source")
    )


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix' || doc_id) AS key
  FROM {documents}
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 3e0 * source_size AS bound, 3e0 * source_size / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(3e0 * source_size) OVER w, 0) AS bounded,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free
  FROM sums
  WINDOW w AS (ORDER BY 3e0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((total - bounded) / free, ratio) AS l FROM ordered WHERE ratio > (total - bounded) / free
), targets AS (
  SELECT source, source_size, least(bound, coalesce(l * weight, bound)) AS target FROM ordered, level
), placed AS (
  SELECT doc_id, size, source_size, target, floor(target) AS budget, source,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN targets USING (source)
)
SELECT doc_id, size, source_size, target, source,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE floor(budget / source_size) * size
            + greatest(0, least(size, budget - floor(budget / source_size) * source_size - before)) END AS BIGINT) AS taken
FROM placed
"""


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """The mix itself: each document once per whole repeat, and the partly taken one cut.

    Columns and their order are those of ``docs``. A cut text keeps its first words, up to
    the last one taken. Documents without words are taken once, so that a mix that takes a
    source whole keeps all of it.
    """
    d, s, n, taken, copies, size, nth, whole, part, i, row = unused(
        docs, "d", "s", "n", "taken", "copies", "size", "nth", "whole", "part", "i", "row"
    )
    every = mix_sources(docs, weights, most)
    sums = every.groupBy(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("size").alias(n))
    sums = sums.agg(F.sum("taken").alias(taken), F.count("*").alias(copies))
    c = F.col
    same = c("doc_id").cast("long").eqNullSafe(c(d)) & c("source").cast("string").eqNullSafe(c(s)) & (c(size) == c(n))
    joined = docs.withColumn(size, F.regexp_count(text_of(), F.lit(WORD)).cast("long")).join(sums, same)
    # rows of one id, source and size share what they take, in the order of a hash of the whole row
    joined = joined.withColumn(row, F.xxhash64(text_of(), F.to_json(F.struct(*[c(f"`{x}`") for x in docs.columns]))))
    joined = joined.withColumn(nth, F.row_number().over(Window.partitionBy(d, s, n).orderBy(row)))
    share = F.floor(c(taken) / c(copies)) + (c(nth) <= c(taken) % c(copies)).cast("long")
    wholes = F.when(c(size) == 0, F.lit(1)).otherwise((share / c(size)).cast("int"))
    rest = F.when(c(size) == 0, F.lit(0)).otherwise(share % c(size))
    times = wholes + F.when(rest > 0, F.lit(1)).otherwise(F.lit(0))
    joined = joined.withColumn(whole, wholes).withColumn(part, rest)
    repeated = joined.where(times > 0).withColumn(i, F.explode(F.sequence(F.lit(1), times)))
    # words with the spaces after them; spaces before the first word are a piece of their own
    pieces = F.split("text", r"(?<=[ \t-\r])(?=[^ \t-\r])", -1)
    head = F.array_join(F.slice(pieces, F.lit(1), (c(part) + F.col("text").rlike(r"^[ \t-\r]").cast("int")).cast("int")), "")
    cut = (c(i) > c(whole)) & (c(part) > 0)
    return repeated.withColumn("text", F.when(cut, head).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])
