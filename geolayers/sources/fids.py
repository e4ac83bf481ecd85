"""Dense feature ids in row order, without a global sort or a single-task pass."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from geolayers.session import row_bytes, staged

FID = "fid"
# monotonically_increasing_id() holds the partition above 33 bits of row number.
ROW_BITS = 33
IN_PARTITION = (1 << ROW_BITS) - 1
# Measured bytes of an offsets' table (one row per file or split) that every task may hold.
OFFSET_BYTES = 64 << 20


def running_offsets(counts: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """``counts`` with ``_offset``: ``start`` and the ``_rows`` of all blocks before, in ``order``; stored.

    A prefix sum in two steps: blocks are range-partitioned and summed by partition, then
    each partition adds up its own. Only the partitions' sums are seen in one place.
    """
    counts = staged(counts, "counts")
    spread = staged(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "blocks")
    sums = spread.groupBy("_part").agg(F.sum("_rows").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(within), F.lit(0)).alias("_before")
    # As many rows as partitions.
    joined = spread.select("*", before).join(F.broadcast(base), "_part")
    offset = (F.lit(start) + F.col("_base") + F.col("_before")).cast("bigint").alias("_offset")
    return staged(joined.select(*counts.columns, offset), "offsets")


def layer_offsets(counts: DataFrame, order: list[str], start: int) -> tuple[DataFrame, dict]:
    """``running_offsets`` of several layers in a fixed number of jobs, and the bytes of each layer's offsets.

    ``_layer`` tells the layers apart; each counts from ``start``.
    """
    offsets = running_offsets(counts, ["_layer", *order], start)
    # As many rows as layers.
    first = offsets.groupBy("_layer").agg(F.min("_offset").alias("_least"), F.sum(row_bytes(offsets)).alias("bytes"))
    own = F.col("_offset") - F.col("_least") + start
    moved = offsets.join(F.broadcast(first.drop("bytes")), "_layer").withColumn("_offset", own).drop("_least")
    return moved, {r["_layer"]: r["bytes"] for r in first.collect()}


def _with_offsets(
    rows: DataFrame, block: list[str], offsets: DataFrame, place: Column, name: str = FID, size: int | None = None
) -> DataFrame:
    """id = offset of the row's block + place inside the block.

    ``offsets`` has one row per file or input split. It is broadcast if it measures ``OFFSET_BYTES``
    at most (some 300,000 files), so the rows stay where they were read; beyond it both sides meet by
    a shuffle on the block, whose large blocks adaptive execution splits. A row of no block, or beyond
    its block's rows, is an error.
    """
    names = [c for c in rows.columns if c not in {*block, "_row"}]
    offsets = offsets.select(*block, "_offset", "_first", "_rows")
    size = offsets.agg(F.sum(row_bytes(offsets))).first()[0] or 0 if size is None else size
    joined = rows.join(F.broadcast(offsets) if size <= OFFSET_BYTES else offsets.hint("merge"), block, "left")
    known = F.col("_offset").isNotNull() & (place >= 0) & (place < F.col("_rows"))
    fid = F.when(known, F.col("_offset") + place).otherwise(
        F.raise_error(F.lit("the source changed while its rows were numbered")).cast("bigint")
    )
    return joined.select(fid.cast("bigint").alias(name), *[F.col(f"`{c}`") for c in names])


def parquet_marked(df: DataFrame) -> DataFrame:
    """Rows of a Parquet scan with their file and their place in it."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def parquet_counts(marked: DataFrame) -> DataFrame:
    """(_file, _rows, _first) of the files of marked rows; no other column is read."""
    return marked.groupBy("_file").agg(F.count("*").alias("_rows"), F.lit(0).cast("bigint").alias("_first"))


def marked_fids(
    marked: DataFrame, start: int = 0, offsets: DataFrame | None = None, name: str = FID, size: int | None = None
) -> DataFrame:
    """Ids of rows of ``parquet_marked``, from one or several scans."""
    if offsets is None:
        offsets = running_offsets(parquet_counts(marked), ["_file"], start)
    return _with_offsets(marked, ["_file"], offsets, F.col("_row"), name, size)


def file_fids(df: DataFrame, start: int = 0, offsets: DataFrame | None = None, name: str = FID) -> DataFrame:
    """Ids of a Parquet scan from each row's place in its file.

    The place is stored nowhere and does not depend on how a file was split, so
    a lost task computes the same ids again.  Files count in path order. ``offsets``
    (of ``running_offsets``) may be known from the footers.
    """
    return marked_fids(parquet_marked(df), start, offsets, name)


def lookup_fids(df: DataFrame, fids: list[int], start: int = 0) -> DataFrame:
    """The rows of a Parquet scan with these ids of ``file_fids``; only their files are read.

    The offsets' table gives file and place of each id, so no more than ``fids`` has comes
    to the driver; a filter on the paths then leaves out all other files, and a small join
    picks the rows.
    """
    offsets = running_offsets(parquet_counts(parquet_marked(df)), ["_file"], start)
    wanted = F.array(*[F.lit(f).cast("bigint") for f in sorted(set(fids))]) if fids else F.array().cast("array<bigint>")
    own = F.filter(wanted, lambda f: (f >= F.col("_offset")) & (f < F.col("_offset") + F.col("_rows")))
    places = offsets.select("_file", "_offset", F.explode(own).alias(FID)).collect()
    table = df.sparkSession.createDataFrame(
        [(p["_file"], p[FID] - p["_offset"], p[FID]) for p in places], f"_file string, _row bigint, {FID} bigint"
    )
    files, rows = ({p["_file"] for p in places}, {p[FID] - p["_offset"] for p in places})
    near = df.filter(F.col("_metadata.file_path").isin(list(files)) & F.col("_metadata.row_index").isin(list(rows)))
    # As many rows as ids were asked for.
    found = parquet_marked(near).join(F.broadcast(table), ["_file", "_row"])
    return found.select(FID, *[F.col(f"`{c}`") for c in df.columns])


def assign_fid(df: DataFrame, start: int = 0, order_by: list[str] | None = None) -> DataFrame:
    """Number any DataFrame start, start+1, ... in partition order.

    The rows are written to the shared folder first: contents and order of a
    recomputed partition may differ, ids of a written one cannot.  With
    ``order_by`` the rows are range-partitioned and ids follow that order.
    """
    if order_by:
        df = df.orderBy(*order_by)
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    fixed = staged(marked, "fids").withColumn("_block", F.shiftright("_row", ROW_BITS))
    counts = fixed.groupBy("_block").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    offsets = running_offsets(counts, ["_block"], start)
    return _with_offsets(fixed, ["_block"], offsets, F.col("_row") - F.col("_first"))


def csv_marked(df: DataFrame) -> DataFrame:
    """Rows of a CSV scan with their file, the start of their split and their number in the task."""
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION))
    at = F.col("_metadata.file_block_start").alias("_at")
    return df.select("*", F.col("_metadata.file_path").alias("_file"), at, number.alias("_row"))


def csv_offsets(layers: list[DataFrame], start: int = 1) -> tuple[DataFrame, dict]:
    """``layer_offsets`` of the splits of several layers, each a frame of marked rows; ``_layer`` is the place in the list."""
    parts = [df.select(F.lit(k).alias("_layer"), "_file", "_at", "_row") for k, df in enumerate(layers)]
    splits = reduce(DataFrame.union, parts).groupBy("_layer", "_file", "_at")
    counts = splits.agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    return layer_offsets(counts, ["_file", "_at"], start)


def csv_fids(marked: DataFrame, offsets: DataFrame | None = None, name: str = FID, size: int | None = None) -> DataFrame:
    """Ids of a CSV layer in file order, from 1; ``marked`` are rows of ``csv_marked``, from one or several scans.

    CSV rows carry no row number, only the path and start of their split, and the
    running number of their task, which is contiguous inside a split. One pass over
    the scan (``csv_offsets``) counts the rows of each split; the rows themselves are
    numbered where they are read, and nothing is stored.
    """
    offsets = csv_offsets([marked])[0] if offsets is None else offsets
    return _with_offsets(marked, ["_file", "_at"], offsets, F.col("_row") - F.col("_first"), name, size)
