"""Places of rows in a global order, by a distributed radix sort from the last digit on.

Rows lie in blocks, and each knows its place within its block. A pass takes one digit
of the composite key: each task puts the rows of a block back in their places, counts
the digit's values and gives each row its number among the block's rows of that value, in
order of place (a stable counting sort). The counts' prefix sums over (value, block) are the
places where each block's rows of a value begin, so each row's new place in the whole is that
plus its number. After the most significant digit the places are the final ranks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from geolayers.session import staged

BITS = 11
# A block's rows meet in one task, and no block holds more.
BLOCK_BITS = 20


def digits(rows: DataFrame, keys: list[str]) -> list[tuple[str, int, int]]:
    """(key, least value, shift) of each digit that the keys have, the least significant first.

    Shift -1 stands for the digit that tells nulls from values. Only digits within the
    keys' ranges are counted, so what all rows have in common costs no pass.
    """
    ends = [f(k) for k in keys for f in (F.min, F.max)]
    nulls = [F.count("*") - F.count(k) for k in keys]
    found = rows.agg(*ends, *nulls).first()
    out = []
    for i, key in reversed(list(enumerate(keys))):
        least, most, missing = found[2 * i], found[2 * i + 1], found[2 * len(keys) + i]
        if least is not None:
            out += [(key, least, shift) for shift in range(0, (most - least).bit_length(), BITS)]
            if missing:
                out.append((key, least, -1))
    return out


def digit_values(column: pa.ChunkedArray, least: int, shift: int) -> np.ndarray:
    """One digit of each value's distance from the least one; nulls count as the least."""
    if shift < 0:
        return column.is_valid().to_numpy().astype(np.uint16)
    values = column.fill_null(least).to_numpy().astype(np.int64)
    # Distances are unsigned: the difference of any two 64-bit numbers fits.
    distance = values.view(np.uint64) - np.int64(least).view(np.uint64)
    return ((distance >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def counting_sort(values: np.ndarray) -> np.ndarray:
    """Each row's number among the rows of the same value, in order."""
    counts = np.bincount(values, minlength=1 << BITS)
    starts = np.cumsum(counts) - counts
    order = np.argsort(values, kind="stable")  # 16-bit numbers: counted, not compared
    number = np.empty(len(values), np.int64)
    number[order] = np.arange(len(values)) - starts[values[order]]
    return number


def _pass(rows: DataFrame, key: str, least: int, shift: int) -> DataFrame:
    """Rows with the place in the whole order after this digit."""
    names = rows.columns

    def place(table: pa.Table) -> pa.Table:
        at = table["_at"].to_numpy()
        back = np.empty(len(at), np.int64)
        back[at] = np.arange(len(at))
        table = table.take(pa.array(back))
        values = digit_values(table[key], least, shift)
        table = table.set_column(names.index("_at"), "_at", pa.array(counting_sort(values), pa.int64()))
        return table.append_column("_digit", pa.array(values.astype(np.int32)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _digit int"
    placed = staged(rows.groupBy("_block").applyInArrow(place, schema), "radix")
    counts = placed.groupBy("_digit", "_block").agg(F.count("*").alias("n"))
    # One row for each value of a digit: 2 ** BITS at most, whatever the number of rows.
    totals = counts.groupBy("_digit").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lower"))
    blocks = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n").over(blocks), F.lit(0)).alias("within")
    offsets = counts.select("_digit", "_block", within).join(F.broadcast(totals), "_digit")
    offsets = offsets.select("_digit", "_block", (F.col("lower") + F.col("within")).alias("_offset"))
    return placed.join(offsets, ["_block", "_digit"]).withColumn("place", F.col("_offset") + F.col("_at"))


def radix_placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their ``place`` from 0 in ascending order of the 64-bit columns ``keys``.

    Nulls come first. Equal keys keep the order in which the rows are stored. ``rows`` must read stored data, as
    it is read again for the keys' ranges. The key given first weighs most. Each pass stores its
    rows in the shared folder, so a lost executor costs one pass at most.
    """
    spark = rows.sparkSession
    names = rows.columns
    n = rows.count()
    passes = digits(rows, keys) or [(keys[0], 0, -1)]
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n >> BLOCK_BITS))
    size = max(1, -(-n // wide))
    row = F.monotonically_increasing_id()
    state = rows.withColumn("_row", row).select(
        *names,
        F.shiftright("_row", BLOCK_BITS).alias("_block"),
        F.col("_row").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("_at"),
    )
    for key, least, shift in passes:
        done = _pass(state, key, least, shift)
        state = done.select(*names, F.expr(f"place div {size}").alias("_block"), (F.col("place") % size).alias("_at"))
    return done.select(*names, "place")
