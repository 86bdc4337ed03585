"""Exact quantiles and mid-ranks without ordering a whole column in one task.

Values are placed in buckets between cut points. The cut points come from an approximate
quantile sketch and only decide how evenly the work is spread; results are exact, because
positions are counted from the exact bucket sizes. Copies of one value always share a
bucket and are summed before they are shuffled, so a hot value is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.schema import require_columns

MIN_BUCKETS = 64
MAX_BUCKETS = 10_000
BROADCAST_ROWS = 100_000
SKETCH_GROUPS = 512
SKETCH_POINTS = 128
#: Rows that one bucket may hold before it is cut again, parts it is cut into, and rounds of that.
BUCKET_ROWS = 2_000_000
BUCKET_PARTS = 64
REFINEMENTS = 4


def default_buckets(df: DataFrame) -> int:
    """Four buckets per shuffle partition, within fixed limits."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BUCKETS, min(MAX_BUCKETS, 4 * partitions))


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The table as a broadcast of known size if it has at most ``limit`` rows.

    A larger table is returned as it is, for a shuffled join. Knowing the size before the
    join is planned spares the other side a shuffle that a late decision would waste.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def clean(column: Column) -> Column:
    """Double value with NaN as NULL and -0.0 as 0.0, so that equal values compare equal."""
    value = column.cast("double") + F.lit(0.0)
    return F.when(~F.isnan(value), value)


def _doubles(values: Iterable[float]) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


def cut_points(df: DataFrame, columns: list[str], buckets: int) -> tuple[list[list[float]], int]:
    """Increasing cut points per column, from approximate quantiles, and the rows of the table; one job for all columns.

    The sketches of the input partitions are merged in SKETCH_GROUPS groups and their
    quantiles pooled, so neither the driver nor one task meets a sketch per partition.
    """
    local = _doubles((i + 0.5) / SKETCH_POINTS for i in range(SKETCH_POINTS))
    grid = _doubles(i / buckets for i in range(1, buckets))
    sketches = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.percentile_approx(c, local, 4 * SKETCH_POINTS).alias(c) for c in columns]
    )
    pooled = sketches.select("_rows", F.posexplode(F.arrays_zip(*columns)).alias("_at", "_p")).select(
        F.when(F.col("_at") == 0, F.col("_rows")).alias("_rows"), "_p.*"
    )
    cuts = pooled.agg(
        F.sum("_rows").alias("_rows"), *[F.percentile_approx(c, grid, 2 * MAX_BUCKETS).alias(c) for c in columns]
    ).first()
    return [sorted(set(cuts[c] or [])) or [0.0] for c in columns], cuts["_rows"] or 0


def _refined(cells: DataFrame, rows: int, cuts: int, bucket_rows: int) -> DataFrame:
    """Cells with buckets of more than ``bucket_rows`` rows cut again, until none is left or copies of one value fill it.

    A sketch may put a bucket's ends off by a share of all rows, so on large tables a
    bucket can outgrow a task. Sizes are counted, and only oversized buckets are sketched
    again, inside themselves; a table whose buckets cannot be oversized is not read again.
    """
    keys = ["measure", "bucket"]
    cells = cells.withColumn("bucket", F.col("bucket").cast("long"))
    grid = _doubles(i / BUCKET_PARTS for i in range(1, BUCKET_PARTS))
    local = _doubles((i + 0.5) / BUCKET_PARTS for i in range(BUCKET_PARTS))
    share = 1.0 / (cuts + 1) + 2.0 / (4 * SKETCH_POINTS)
    for _ in range(REFINEMENTS):
        if rows * share <= bucket_rows:
            return cells
        sizes = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high"))
        large = small_side(sizes.where((F.col("_n") > bucket_rows) & (F.col("_low") < F.col("_high"))).select(keys))
        if large.isEmpty():
            return cells
        sketches = cells.join(large, keys, "left_semi").groupBy(*keys, (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
            F.percentile_approx("value", local, 4 * SKETCH_POINTS).alias("_sketch")
        )
        pooled = sketches.select(*keys, F.explode("_sketch").alias("_x")).groupBy(*keys)
        again = small_side(pooled.agg(F.array_distinct(F.percentile_approx("_x", grid, 2 * MAX_BUCKETS)).alias("_cuts")))
        part = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("value"))), F.lit(0))
        part = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(part)
        cells = cells.join(again, keys, "left").withColumn("bucket", F.col("bucket") * BUCKET_PARTS + part).drop("_cuts")
        share *= 2.0 / BUCKET_PARTS
    return cells


def bucketed(
    df: DataFrame, values: Sequence[str], by: Sequence[str] = (), buckets: int | None = None, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Long form (by..., measure, value, bucket) of the non-NULL values; NULL keys dropped.

    Buckets grow with the values and hold about ``bucket_rows`` rows at most, or one value.
    """
    require_columns(df, *values, *by)
    inputs = [f"_v{i}" for i in range(len(values))]
    outputs = [f"_b{i}" for i in range(len(values))]
    narrow = df.select(*by, *[clean(F.col(v)).alias(n) for v, n in zip(values, inputs)])
    for key in by:
        narrow = narrow.where(F.col(key).isNotNull())
    cuts, rows = cut_points(narrow, inputs, buckets or default_buckets(df))
    inf = float("inf")
    placed = Bucketizer(
        inputCols=inputs,
        outputCols=outputs,
        splitsArray=[[-inf, *c, inf] for c in cuts],
        handleInvalid="keep",
    ).transform(narrow)
    cells = F.stack(
        F.lit(len(values)),
        *[x for v, i, o in zip(values, inputs, outputs)
          for x in (F.lit(v), F.col(i), F.col(o).cast("int"))],
    ).alias("measure", "value", "bucket")
    return _refined(placed.select(*by, cells).where(F.col("value").isNotNull()), rows, min(map(len, cuts)), bucket_rows)


def bucket_positions(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per bucket the first position (from 0) and the position after the last; n is the total.

    The windows run over bucket totals: at most one row per bucket and group.
    """
    group = Window.partitionBy(*by, "measure")
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = cells.groupBy(*by, "measure", "bucket").agg(F.count(F.lit(1)).alias("_size"))
    return sizes.select(
        *by,
        "measure",
        "bucket",
        (F.sum("_size").over(running) - F.col("_size")).alias("start"),
        F.sum("_size").over(running).alias("stop"),
        F.sum("_size").over(group).alias("n"),
    )


def exact_quantiles(
    df: DataFrame,
    values: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles: (by..., measure, n, quantiles).

    Only the rows of the buckets that hold a wanted position are shuffled, that is about
    2 * len(probs) of all the buckets. Measures without a value give no row.
    """
    keys = [*by, "measure"]
    cells = bucketed(df, values, by, buckets)

    def low(p: float) -> Column:
        return F.floor(F.lit(float(p)) * (F.col("n") - 1))

    def high(p: float) -> Column:
        return F.ceil(F.lit(float(p)) * (F.col("n") - 1))

    wanted = F.lit(False)
    for p in probs:
        for position in (low(p), high(p)):
            wanted = wanted | ((position >= F.col("start")) & (position < F.col("stop")))
    positions = bucket_positions(cells, by).where(wanted).drop("stop")
    needed = small_side(positions)
    copies = F.count(F.lit(1)).alias("_copies")
    if needed is positions:
        # A shuffled join: copies are summed in each task first, so that a value with very
        # many of them meets its bucket as one row.
        counted = cells.groupBy(*keys, "bucket", "value").agg(copies).join(needed, [*keys, "bucket"])
    else:
        counted = cells.join(needed, [*keys, "bucket"]).groupBy(*keys, "bucket", "start", "n", "value").agg(copies)
    running = (
        Window.partitionBy(*keys, "bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("_stop", F.col("start") + F.sum("_copies").over(running)).withColumn(
        "_start", F.col("_stop") - F.col("_copies")
    )

    def at(position: Column) -> Column:
        inside = (position >= F.col("_start")) & (position < F.col("_stop"))
        return F.max(F.when(inside, F.col("value")))

    picked = ranked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[c for i, p in enumerate(probs)
          for c in (at(low(p)).alias(f"_l{i}"), at(high(p)).alias(f"_h{i}"))],
    )
    quantiles = [
        F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}"))
        * (F.lit(float(p)) * (F.col("n") - 1) - low(p))
        for i, p in enumerate(probs)
    ]
    return picked.select(*keys, "n", F.array(*quantiles).alias("quantiles"))


def value_ranks(
    df: DataFrame, value: str | Sequence[str], by: Sequence[str] = (), buckets: int | None = None, bucket_rows: int = BUCKET_ROWS,
    within: Sequence[str] = (),
) -> DataFrame:
    """Mid-rank of each distinct value among all rows: (by..., measure, value, copies, ties, rank, n).

    With ``by``, one row per value and key; ``ties`` counts the value over all keys. With
    ``within``, a part of ``by``, the ranks are among the rows of each of its keys, and of
    several values each is ranked by itself: one scan and one order serve them all.
    """
    values = [value] if isinstance(value, str) else list(value)
    cells = bucketed(df, values, by, buckets, bucket_rows)
    group = [*within, "measure"]
    starts = bucket_positions(cells.select(*group, "bucket"), within).select(*group, "bucket", "start", "n")
    counted = cells.groupBy("measure", "bucket", "value", *by).agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy(*group, "bucket").orderBy("value").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    same = Window.partitionBy(*group, "bucket", "value")
    return (
        counted.withColumn("ties", F.sum("copies").over(same))
        .withColumn("_upto", F.sum("copies").over(upto))
        .join(small_side(starts), [*group, "bucket"])
        .select(
            *by,
            "measure",
            "value",
            "copies",
            "ties",
            (F.col("start") + F.col("_upto") - (F.col("ties") - 1) / F.lit(2e0)).alias("rank"),
            "n",
        )
    )


def average_rank(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """(value, copies, rank) of each distinct non-NULL value."""
    return value_ranks(df, value, buckets=buckets).select("value", "copies", "rank")


def rank_sums(
    df: DataFrame, value: str | Sequence[str], key: str, buckets: int | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """Per key: rows, rank sum, share of the tie term sum(t^3 - t), and the total n.

    With ``within`` or several values: per such key and ``measure`` too.
    """
    ties = F.col("ties").cast("double")
    return (
        value_ranks(df, value, [*within, key], buckets, within=within)
        .groupBy(*within, "measure", key)
        .agg(
            F.sum("copies").alias("rows"),
            F.sum(F.col("copies") * F.col("rank")).alias("rank_sum"),
            F.sum(F.col("copies") * (ties * ties - 1)).alias("tie_term"),
            F.max("n").alias("n"),
        )
    )
