"""Written tables: results, versioned snapshots, staging, fingerprints and differences."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of both tables that a difference counts at once; larger tables are compared in several blocks.
DIFF_ROWS = 32_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_result(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Persist a result table as Parquet."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


MANIFESTS = "_manifests"


def _file_prints(df: DataFrame) -> DataFrame:
    """(file, n_rows, content_hash) of each file of a table, whatever the order of its rows."""
    cells = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    marked = df.select(F.col("_metadata.file_name").alias("file"), cells.alias("cells"))
    return marked.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cells").cast("string").alias("content_hash")
    )


def snapshot_table(df: DataFrame, root: str, version: str) -> str:
    """Write an immutable version of a table and its manifest; an existing version is an error.

    The manifest lists every file of the version with its rows and a fingerprint of its
    content, taken from the files as they were written.
    """
    path = f"{root}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    _file_prints(df.sparkSession.read.parquet(path)).write.mode("errorifexists").parquet(f"{root}/{MANIFESTS}/{version}")
    return path


def check_snapshot(spark: SparkSession, root: str, version: str) -> DataFrame:
    """(file, status) of each file of a version: ok, changed, missing or added since it was written."""
    listed = spark.read.parquet(f"{root}/{MANIFESTS}/{version}").select(
        "file", F.col("n_rows").alias("_rows"), F.col("content_hash").alias("_hash")
    )
    found = _file_prints(spark.read.option("basePath", root).parquet(f"{root}/version={version}").drop("version"))
    same = (F.col("n_rows") == F.col("_rows")) & F.col("content_hash").eqNullSafe(F.col("_hash"))
    # A file without rows is in the manifest of neither side.
    status = F.when(F.col("n_rows").isNull(), "missing").when(F.col("_rows").isNull(), "added").when(same, "ok").otherwise("changed")
    return listed.join(found, "file", "full").select("file", status.alias("status"))


def read_snapshot(spark: SparkSession, root: str, version: str | None = None, check: bool = False) -> DataFrame:
    """One version (only its folder is scanned), or all of them with a ``version`` column.

    With ``check`` a version is first compared with its manifest; ValueError if a file differs.
    """
    if version is None:
        if check:
            raise ValueError("Only a named version can be checked")
        return spark.read.parquet(root)
    if check:
        wrong = check_snapshot(spark, root, version).where("status <> 'ok'").limit(10).collect()
        if wrong:
            raise ValueError(f"Version {version} differs from its manifest: {[tuple(r) for r in wrong]}")
    return spark.read.option("basePath", root).parquet(f"{root}/version={version}").drop("version")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where the setting is absent, staged tables go below the warehouse, which a session
    shares with its executors as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"


def stage(df: DataFrame, folder: str | None = None, options: dict | None = None) -> DataFrame:
    """Cut the lineage of a table that several jobs will read.

    The table is written to a new folder below ``folder`` (by default the session's
    shared folder) and read back, so later passes scan only the columns they need and
    survive lost executors. Shuffle files of the job are dropped once it has been
    written. Staged folders belong to whoever owns the shared folder; nothing is deleted
    here. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/riskframe/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table_fingerprint(
    df: DataFrame, cols: list[str] | None = None, algorithm: str = "xxhash64"
) -> DataFrame:
    """Per column: row count, non-NULL count and a content hash that ignores row order.

    The hash is the exact decimal sum of the cell hashes, so equal multisets of cells
    agree whatever the partitioning. ``md5`` sums the first 15 hex digits of the text
    form, which other engines can recompute.
    """
    columns = cols or df.columns
    if algorithm == "xxhash64":
        def cell(c):
            return F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c)))
    elif algorithm == "md5":
        def cell(c):
            return F.conv(F.substring(F.md5(F.col(c).cast("string").cast("binary")), 1, 15), 16, 10)
    else:
        raise ValueError(f"Unknown fingerprint algorithm: {algorithm}")
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        aggregates += [
            F.count(F.col(c)).alias(f"n_{i}"),
            F.sum(cell(c).cast("decimal(20,0)")).alias(f"h_{i}"),
        ]
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            F.col(f"n_{i}").alias("n_values"),
            F.coalesce(F.col(f"h_{i}").cast("string"), F.lit("0")).alias("content_hash"),
        )
        for i, c in enumerate(columns)
    ]))
    return df.agg(*aggregates).select(rows.alias("r")).select("r.*")


def table_diff(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows that only one of two tables holds, with ``change`` and the number of copies.

    Multiset semantics: each row counts +1 in the new table and -1 in the old, equal rows
    are summed before the shuffle, and a non-zero sum is a difference. Copies are counted
    rather than repeated, so one row with many copies stays one row. Both tables are staged
    once; their rows are counted in blocks by hash, of DIFF_ROWS rows on average, so that the
    memory of a task does not grow with the tables.
    With ``keys``, rows whose key occurs on both sides of the difference are marked
    ``changed_from`` / ``changed_to``.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("Tables differ in their columns")
    columns = old.columns
    signed = stage(old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1))))
    blocks = 1 + signed.count() // DIFF_ROWS
    block = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(blocks))
    delta = reduce(DataFrame.unionByName, [
        (signed if blocks == 1 else signed.where(block == b)).groupBy(*columns)
        .agg(F.sum("_sign").alias("_delta"))
        .where(F.col("_delta") != 0)
        .withColumn("change", F.when(F.col("_delta") > 0, "added").otherwise("removed"))
        .withColumn("copies", F.abs("_delta"))
        .drop("_delta")
        for b in range(blocks)
    ])
    if not keys:
        return delta
    delta = stage(delta)
    both = (
        delta.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(F.count_distinct("change").alias("_sides"))
        .where(F.col("_sides") == 2)
    )
    match = [delta[k].eqNullSafe(both[f"_{k}"]) for k in keys]
    kind = (
        F.when(F.col("_sides").isNull(), F.col("change"))
        .when(F.col("change") == "added", "changed_to")
        .otherwise("changed_from")
    )
    return delta.join(both, match, "left").withColumn("change", kind).select(*columns, "change", "copies")
