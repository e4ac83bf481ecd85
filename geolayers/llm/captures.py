"""A capture index: sorted runs of captures merged into one global order.

Writers of archives leave runs, each sorted by URL key, time, id and place. The merge deals
the captures to tasks by ranges of that whole key, so a page that was captured more often than all
others spreads over several tasks; each task takes its part of every run in the run's order and
merges them with a tree of losers.
"""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from geolayers.session import staged

KEY = ["urlkey", "stamp", "id", "file", "offset"]
RUN = "run string, seq int, urlkey string, stamp bigint, id bigint, file string, offset bigint, length bigint, type string"
# Captures that one merging task holds, on average.
RANGE_ROWS = 1 << 17
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_key(url: Column) -> Column:
    """The host's labels from the last to the first, then ``)`` and the rest without fragment.

    Without ``://`` there is no host; a null URL is an empty one.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    whole = F.regexp_extract(F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url), "^[^#]*", 0)
    host = F.when(at > 0, F.regexp_extract(whole, "^[^/?]*", 0)).otherwise(F.lit(""))
    labels = F.array_join(F.reverse(F.split(F.translate(host, UPPER, LOWER), r"\.")), ",")
    return F.concat(labels, F.lit(")"), F.substring(whole, F.length(host) + 1, F.length(whole)))


def order_key(urlkey: str, stamp: int, number: int | None, file: str, offset: int) -> tuple:
    """What captures are compared by; a null id stands before all others."""
    return urlkey, stamp, number is not None, number or 0, file, offset


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of the match below it.

    Taking the winner replays only the matches on the way from its leaf to the
    top. Equal keys come out in the order of the runs.
    """

    def __init__(self, runs: list[Iterable]):
        self.runs = [iter(run) for run in runs]
        self.heads = [self._next(run) for run in range(len(runs))]
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf)

    def _next(self, run: int) -> tuple:
        for key in self.runs[run]:
            return False, key, run
        return True, run  # a run at its end loses against all others

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the other side has not played yet: wait here
                self.losers[node] = winner
                return
            if self.heads[other] < self.heads[winner]:
                winner, self.losers[node] = other, winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(run, key) of all runs in ascending order."""
        while self.runs and not self.heads[winner := self.losers[0]][0]:
            yield winner, self.heads[winner][1]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def merged_order(runs: list[str], keys: list[tuple]) -> list[int]:
    """Row numbers in the order of their keys; the rows of a run stand together and ascend."""
    cuts = [k for k in range(len(runs)) if k == 0 or runs[k] != runs[k - 1]] + [len(runs)]
    at = cuts[:-1]
    out = []
    for run, _ in LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:])]):
        out.append(at[run])
        at[run] += 1
    return out


def merge_runs(runs: DataFrame) -> DataFrame:
    """The captures of sorted runs in one order, stored: ``part`` and ``at`` number them.

    ``runs`` has the columns of ``RUN``; ``seq`` counts the captures of a run in their order. Columns besides:
    ``capture`` is a capture's number in the history of its URL, from 1. An empty table gives no rows.
    Captures of one range (``RANGE_ROWS`` on average) meet in a task, and no URL is a group of its own there.
    """
    spark = runs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(n, *KEY).sortWithinPartitions("run", "seq")

    def merge(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = list(map(order_key, *(rows[c].to_pylist() for c in KEY)))
        rows = rows.take(pa.array(merged_order(rows["run"].to_pylist(), keys), pa.int64())).drop_columns(["run", "seq"])
        number, last, count = [], None, 0
        for urlkey in rows["urlkey"].to_pylist():
            count = count + 1 if urlkey == last else 1
            last = urlkey
            number.append(count)
        part = pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())
        rows = rows.append_column("part", part).append_column("at", pa.array(range(len(rows)), pa.int64()))
        yield from rows.append_column("capture", pa.array(number, pa.int64())).to_batches(max_chunksize=10_000)

    kind = RUN.partition("seq int, ")[2] + ", part int, at bigint, capture bigint"
    index = staged(dealt.mapInArrow(merge, kind), "captures")
    # A history that goes on from an earlier range counts on from there.
    pieces = index.groupBy("urlkey", "part").agg(F.max("capture").alias("n"))
    earlier = Window.partitionBy("urlkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = pieces.select("urlkey", "part", F.sum("n").over(earlier).alias("begun")).filter("begun > 0")
    whole = index.join(begun, ["urlkey", "part"], "left")
    return whole.withColumn("capture", F.col("capture") + F.coalesce("begun", F.lit(0))).drop("begun")
