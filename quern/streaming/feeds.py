"""Arrival-driven jobs on file sources. Each run takes what has landed and stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.predict import SIZES, feedback_update
from quern.sinks.tables import upsert_table


def feedback_stream(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    base: DataFrame,
    schema: T.StructType | str,
    refit: Callable[[DataFrame], object] | None = None,
    classes: Sequence[str] = tuple(SIZES),
) -> tuple[DataFrame, object | None]:
    """Take new user records into the training table and refit on all of it.

    A batch writes the folder of its own number, so running it again after a failure replaces its
    rows instead of adding them twice. Returns the training table and the last model.
    """
    models: list[object] = []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")
        if refit is not None:
            models.append(refit(training()))

    def training() -> DataFrame:
        try:
            users = spark.read.schema(schema).parquet(f"{store}/batch=*")
        except AnalysisException as error:
            # Nothing has landed yet; any other fault is passed on.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            users = spark.createDataFrame([], schema)
        return feedback_update(base, users, classes=classes)

    query = (
        spark.readStream.schema(schema)
        .option("header", True)
        .csv(landing)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    return training(), models[-1] if models else None


def landing_stream(
    spark: SparkSession,
    landing: str,
    db: str,
    table: str,
    checkpoint: str,
    schema: T.StructType | str,
    keys: Sequence[str],
    clean: Callable[[DataFrame], DataFrame],
    version: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Clean landed files and upsert them by key.

    The row with the greatest ``version`` wins for each key, inside a batch and against the stored row, in
    whatever order the files come; a null version is older than any other. The upsert replaces rows of equal
    key, so a batch that is run again leaves the same table.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = clean(batch)
        if version is not None:
            others = [c for c in rows.columns if c not in keys]
            newest = F.max(F.struct(version, *[c for c in others if c != version])).alias("_r")
            stored = f"`{db}`.`{table}`"
            if spark.catalog.tableExists(stored):
                # Only stored rows of the batch's keys are compared with it.
                same = reduce(lambda a, b: a & b, [F.col(f"s.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys])
                old = spark.table(stored).alias("s").join(rows.select(*keys).distinct().alias("b"), same, "left_semi")
                rows = rows.unionByName(old.select(*rows.columns))
            rows = rows.groupBy(*keys).agg(newest).select(*keys, *[f"_r.{c}" for c in others])
        else:
            rows = rows.dropDuplicates()
        upsert_table(rows, db, table, keys)

    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(landing)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )
    query.awaitTermination()
    return spark.table(f"`{db}`.`{table}`")
