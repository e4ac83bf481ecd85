"""Layers stored for what is done with them: buckets for joins, ranges of ids for changes in place."""

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from geolayers.model import LayerError
from geolayers.operators.columns import FID
from geolayers.operators.dml import delete, update
from geolayers.session import broadcast_if_small, row_bytes, shared_path, staged

# Ids that one range of a stored layer holds.
RANGE_IDS = 1 << 20
RANGE = re.compile(r"fid_range_(\d+)")


# --- buckets ------------------------------------------------------------------


def store_bucketed(
    df: DataFrame, keys: list[str] | None = None, buckets: int | None = None, table: str | None = None, most_uneven: float = 5.0
) -> DataFrame:
    """Store a layer in buckets of its id (or ``keys``) as an external table, and read it back.

    Two layers of equally many buckets are joined and grouped by their keys without a shuffle, as often as they are
    read. Without a shuffle Spark cannot split a hot key either: rows whose largest bucket has over ``most_uneven`` times the
    mean are stored without buckets, and their joins shuffle as usual. Files lie in the session's shared folder; ``table`` names the table.
    """
    spark = df.sparkSession
    keys = keys or [FID]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    table = table or f"layer_{uuid.uuid4().hex}"
    path = shared_path(spark, "bucketed")
    if sizes["all"] and sizes["most"] * buckets > most_uneven * sizes["all"] and sizes["all"] > buckets:
        df.write.option("path", path).saveAsTable(table)
    else:
        # Dealt by the buckets' own hash, so each task writes one file.
        dealt = df.repartition(buckets, *keys)
        dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)


# --- ranges of ids ------------------------------------------------------------


def write_ranges(df: DataFrame, path: str, ids: int = RANGE_IDS) -> None:
    """Store a layer by ranges of its id, so that changes rewrite only the ranges they touch.

    The folders' names hold the size of a range (``fid_range_SIZE=NUMBER``). Rows without an id cannot be stored.
    """
    _ranged(df, ids).repartitionByRange(f"fid_range_{ids}", FID).sortWithinPartitions(FID).write.partitionBy(f"fid_range_{ids}").parquet(path)


def _ranged(df: DataFrame, ids: int) -> DataFrame:
    fid = F.col(FID)
    known = F.when(fid.isNull(), F.raise_error(F.lit("a row without a fid cannot be stored by ranges")).cast("bigint")).otherwise(fid)
    return df.withColumn(f"fid_range_{ids}", F.floor(known / F.lit(ids)).cast("bigint") if ids & (ids - 1) else F.shiftright(known, ids.bit_length() - 1))


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, str, int]:
    df = spark.read.parquet(path)
    column = next((c for c in df.columns if RANGE.fullmatch(c)), None)
    if column is None:
        raise LayerError(f"{path} is not stored by ranges of ids")
    return df, column, int(RANGE.fullmatch(column)[1])


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """A layer of ``write_ranges`` with its own columns."""
    df, column, _ = _opened(spark, path)
    return df.drop(column)


def _touched(base: DataFrame, changes: DataFrame, column: str, ids: int) -> tuple[DataFrame, DataFrame]:
    """The numbers of the ranges that hold ids of ``changes``, and the rows of these ranges; other folders stay unread."""
    numbers = staged(_ranged(changes.select(FID), ids).select(column).distinct(), "ranges")
    size = numbers.agg(F.count("*"), F.coalesce(F.sum(row_bytes(numbers)), F.lit(0))).first()
    return numbers, base.join(broadcast_if_small(numbers, *size), column, "left_semi")


def _replace(spark: SparkSession, path: str, changed: DataFrame, numbers: DataFrame, column: str, ids: int) -> None:
    """Put the new rows of the touched ranges in the place of the old ones.

    The new rows are whole in the shared folder before the first old file goes. Each range's folder is replaced by
    itself: a reader in between may see some ranges old and some new.
    """
    changed = staged(_ranged(changed, ids), "changed")
    dealt = changed.repartitionByRange(column, FID).sortWithinPartitions(FID)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    # A range that has lost all its rows is not among the written ones: its folder goes.
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in numbers.join(changed.select(column).distinct(), column, "left_anti").toLocalIterator():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={row[column]}"), True)


def update_stored(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """``update`` of a layer of ``write_ranges`` in its place; a refused change leaves it as it was."""
    base, column, ids = _opened(spark, path)
    changes = staged(changes, "changes")
    numbers, near = _touched(base, changes, column, ids)
    _replace(spark, path, update(near.drop(column), changes), numbers, column, ids)


def delete_stored(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """``delete`` from a layer of ``write_ranges`` in its place."""
    base, column, ids = _opened(spark, path)
    keys = staged(keys.select(FID).filter(F.col(FID).isNotNull()), "keys")
    numbers, near = _touched(base, keys, column, ids)
    _replace(spark, path, delete(near.drop(column), keys), numbers, column, ids)


def insert_stored(spark: SparkSession, path: str, added: DataFrame) -> None:
    """Append rows with their ids (of ``insert``) to a layer of ``write_ranges``; no file is rewritten."""
    base, column, ids = _opened(spark, path)
    wanted = [c for c in base.columns if c != column]
    if sorted(added.columns) != sorted(wanted):
        raise LayerError(f"the rows must have the columns {wanted}")
    rows = _ranged(added.select(*wanted), ids).repartitionByRange(column, FID).sortWithinPartitions(FID)
    rows.write.mode("append").partitionBy(column).parquet(path)
