"""What a table or a plan looks like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Leaves of a plan that read no files.
NO_FILES = ("LocalTableScanExec", "RangeExec", "OneRowRelationExec", "EmptyRelationExec")


def describe_table(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of each column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def table_shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per (non-empty) partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n_rows"))


def file_stats(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Number of files, bytes and mean size in MB. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        (F.avg("length") / (1024 * 1024)).alias("avg_file_mb"),
    )


def scan_estimate(df: DataFrame) -> int:
    """Bytes the scans of a query would read, after partition pruning.

    File sizes from the plan, scaled by the width of the columns read. Rows made in
    the program count as nothing; any other leaf whose size is not known is an error.
    """
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    total = 0
    for scan in scans:
        kind = scan.getClass().getSimpleName()
        if kind in NO_FILES:
            continue
        if kind != "FileSourceScanExec":
            raise ValueError(f"the size of a {kind} is not known")
        stored = scan.relation().dataSchema().defaultSize()
        needed = scan.requiredSchema().defaultSize() if scan.requiredSchema().size() else 0
        total += int(scan.selectedPartitions().totalFileSize()) * needed // max(stored, 1)
    return total


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two results has (with their side); none if equal.

    Duplicates count: a row twice on one side and once on the other differs.
    """
    columns = left.columns
    counts = (
        left.select(*columns, F.lit(1).alias("_side"))
        .unionByName(right.select(*columns, F.lit(-1).alias("_side")))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("_surplus"))
        .filter("_surplus <> 0")
    )
    side = F.when(F.col("_surplus") > 0, "left").otherwise("right").alias("only_in")
    return counts.select(*columns, side, F.abs("_surplus").alias("n_rows"))


def _fingerprints(df: DataFrame, buckets: int) -> DataFrame:
    """Rows of each bucket, and two sums of their hashes that do not depend on their order."""
    rows = df.select(F.xxhash64(*df.columns).alias("_h"), F.xxhash64(F.lit("second"), *df.columns).alias("_g"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("_h", "_g")]
    return rows.groupBy(F.pmod("_h", F.lit(buckets)).alias("_bucket")).agg(F.count("*").alias("_n"), *sums)


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = 4096) -> list[int]:
    """Hash buckets whose rows differ between two results (at most all ``buckets``)."""
    sides = [_fingerprints(df, buckets) for df in (left, right)]
    joined = sides[0].alias("l").join(sides[1].alias("r"), "_bucket", "full")
    equal = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("_n", "_h", "_g")]
    return sorted(r["_bucket"] for r in joined.filter(~(equal[0] & equal[1] & equal[2])).select("_bucket").collect())


def parity_in_buckets(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """The rows of ``parity``, for large results that are nearly equal.

    A first pass shuffles one row per task and bucket: the number of rows and the sums of two
    64-bit hashes. Only rows of buckets that differ are then compared as they are; equal results
    are not shuffled at all. Both sides need the same types (hashes of an ``int`` and a
    ``bigint`` differ); maps have no hash.
    """
    right = right.select(*left.columns)
    if left.dtypes != right.dtypes:
        raise ValueError(f"the types differ: {sorted(set(left.dtypes) ^ set(right.dtypes))}")
    differing = differing_buckets(left, right, buckets)
    bucket = F.pmod(F.xxhash64(*left.columns), F.lit(buckets))
    inside = bucket.isin(differing) if differing else F.lit(False)
    return parity(left.filter(inside), right.filter(inside))


def scanned_partitions(df: DataFrame) -> tuple[int, int]:
    """Partition folders and files that the scans of a query open, after pruning."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    opened = [s.selectedPartitions() for s in scans if s.getClass().getSimpleName() == "FileSourceScanExec"]
    return sum(p.partitionCount() for p in opened), sum(p.totalNumberOfFiles() for p in opened)
