"""Shared building blocks: durable intermediate tables, size checks and distributed ranking."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to this count may be sent to every executor or held by the driver.
SMALL_ROWS = 100_000

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="quern-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    The written table cuts the lineage, survives the loss of executors, is evaluated only
    once however often it is used, and tells Catalyst its true size, so that the automatic
    broadcast threshold works on measured bytes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends inside are deleted at once, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def fits(df: DataFrame, limit: int = SMALL_ROWS) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads no more than ``limit + 1`` of them."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; otherwise leave the join to Catalyst."""
    return F.broadcast(df) if fits(df, limit) else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table out by ``key`` when it sits in fewer splits than there are cores.

    For work that is heavy per row, such as regular expressions over long texts, where moving a split
    costs far less than leaving cores idle. A table with enough splits, which any large one has, is
    returned as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def with_row_number(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_no", start: int = 0
) -> DataFrame:
    """Number all rows by ``order`` without passing them through one task.

    Rows are range-partitioned and sorted, stored with their place inside the partition, and
    shifted by the row counts of the partitions before. Only those counts, one per partition, come
    to the driver. ``order`` should end in a unique column, so that a frequent value in the leading
    column is spread over several ranges.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    )
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["p"]: r["count"] for r in placed.groupBy(part.alias("p")).count().collect()}
    offsets = [start]
    for p in range(max(counts, default=0)):
        offsets.append(offsets[-1] + counts.get(p, 0))
    # A constant array: the plan keeps the measured size of the stored table.
    shift = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    number = F.element_at(shift, (part + 1).cast("int")) + inside
    return placed.withColumn(name, number).drop("_place")


def with_group_row_number(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str = "row_no"
) -> DataFrame:
    """Zero-based place of each row inside its group, also when one group holds most rows.

    A window per group would sort a hot group in one task; here all rows are ranked together and
    the first rank of the group is subtracted. The first ranks are stored, so that Catalyst broadcasts
    them by their measured size, or joins them with skew handling.
    """
    ranked = with_row_number(df, [*[F.col(c) for c in group], *order], "_rank")
    firsts = materialize(ranked.groupBy(*group).agg(F.min("_rank").alias("_first")), "firsts")
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in group]
    return (
        ranked.alias("r")
        .join(firsts.alias("f"), reduce(lambda a, b: a & b, keys))
        .select("r.*", (F.col("_rank") - F.col("f._first")).alias(name))
        .drop("_rank")
    )
