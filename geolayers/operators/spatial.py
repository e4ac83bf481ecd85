"""Bounding-box filters, the exact box test and the bounding-box join."""

import heapq
import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from geolayers.functions.boxes import BOX_TYPE, bbox_meets, bbox_within, make_box
from geolayers.functions.wkb import box_wkb, envelope, geometry_kind, geometry_meets_box, point_wkb, strip_ewkb
from geolayers.model import LayerError, box_name, geometry_metadata
from geolayers.session import FIXED_WIDTH, broadcast_limit, has_fixed_width, row_bytes, staged

# Finest cell of the join grid, in the units of the coordinates.
FINEST_CELL = 1e-6
# Cell sizes go up in steps of 2 ** LEVEL_STEP.
LEVEL_STEP = 2
# Bytes of a box and a cell key in a broadcast row.
BOX_BYTES = 128
# Largest share of the smaller side that one task holds as a hash table.
HASH_BYTES = 64 << 20
# A long thin box may cover 2 ** LONG_BITS more cells along its long side.
LONG_BITS = 2
# Cells are counted up to 2 ** SPAN_BITS on each side of zero; what lies beyond is in the last one.
SPAN_BITS = 50
# Rectangles that cover the smaller side, and the grid from which they are made.
COVER_PARTS = 16
COVER_BITS = 6
# The cover is worth a job of its own if the larger side has so many rows, and that many times those of the smaller one.
COVER_ROWS = 1_000_000
COVER_TIMES = 4
# Computed boxes are stored if the sides have so many rows together.
STORED_ROWS = 10_000


def encode_points(df: DataFrame, x, y, name: str = "geom", srid: int | None = None) -> DataFrame:
    """Add a point geometry column and its box from two coordinate columns."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return df.select(
        "*",
        point_wkb(x, y).alias(name, metadata=geometry_metadata(srid, "Point")),
        make_box(x, y, x, y).alias(box_name(name)),
    )


def encode_boxes(df: DataFrame, xmin, ymin, xmax, ymax, name: str = "geom", srid: int | None = None) -> DataFrame:
    """Add a rectangle geometry column and its box from four side columns."""
    sides = [F.col(c) if isinstance(c, str) else c for c in (xmin, ymin, xmax, ymax)]
    box = make_box(*sides)
    return df.select(
        "*",
        box_wkb(box).alias(name, metadata=geometry_metadata(srid, "Polygon")),
        box.alias(box_name(name)),
    )


def geometry_column(df: DataFrame, name: str, srid: int | None = None, kind: str = "Geometry") -> DataFrame:
    """Declare a binary column of WKB or EWKB as a geometry and add its box."""
    plain = df.withColumn(name, strip_ewkb(F.col(f"`{name}`"))).withMetadata(name, geometry_metadata(srid, kind))
    return plain.withColumn(box_name(name), envelope(F.col(f"`{name}`")))


def common_kind(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The one kind of a layer's geometries, else ``Geometry``."""
    kind = geometry_kind(F.col(f"`{geom}`"))
    found = df.agg(F.min(kind).alias("low"), F.max(kind).alias("high"))
    return found.select(F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("Geometry").alias("kind"))


def covering(df: DataFrame, geom: str) -> Column:
    """The stored box of a geometry column; computed if the layer has none."""
    if box_name(geom) in df.columns:
        return F.col(f"`{box_name(geom)}`")
    return envelope(F.col(f"`{geom}`"))


def bbox_filter(df: DataFrame, box, geom: str = "geom") -> DataFrame:
    """Features whose box meets the four numbers of ``box``; NULL never does."""
    return df.filter(bbox_meets(covering(df, geom), box))


def intersects_box(df: DataFrame, box, geom: str = "geom") -> DataFrame:
    """Features that share a point with ``box``, exactly.

    The stored box decides most rows: outside means no, inside means yes, and a
    point or a geometry without an extent needs no more.  Only the bytes of the
    rest reach the Arrow function.
    """
    wkb, bounds = F.col(f"`{geom}`"), covering(df, geom)
    settled = bbox_within(bounds, box) | geometry_kind(wkb).startswith("Point")
    open_wkb = F.when(~settled, wkb)
    near = df.filter(bbox_meets(bounds, box))
    return near.filter(F.coalesce(geometry_meets_box(open_wkb, box), F.lit(True)))


# --- bounding-box join ----------------------------------------------------------
#
# Each box belongs to the grid level whose cells are about its own size, so it
# touches few cells whatever its extent.  Boxes of one level meet in their own
# cells.  Across levels the smaller box is also entered under the coarser cells
# that contain it, for those levels only that occur on the other side.  Cells
# are integers and a coarser cell is a shifted finer one, so no rounding can
# separate two boxes that meet.


def _bits(n: Column) -> Column:
    """Smallest b with n <= 2 ** b."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def _shift(n: Column, level: Column) -> Column:
    return F.call_function("shiftright", n, level)


def _finest(side: Column, cell: float) -> Column:
    """The number of the finest cell; sides beyond the last cells, and infinite ones, are in those.

    That keeps the order of sides, so boxes that meet still share a cell.
    """
    last = F.lit(float(1 << SPAN_BITS))
    return F.floor(F.least(F.greatest(side / F.lit(cell), -last), last)).cast("bigint")


def _is_stored(df: DataFrame, box: str) -> bool:
    """Whether the files of ``df`` hold a column of the box's name. Only the speed of the join depends on it."""
    files = df.inputFiles()
    if not files or not files[0].endswith(".parquet"):
        return False
    try:
        return box in df.sparkSession.read.parquet(files[0]).columns
    except AnalysisException:  # a path that cannot be read by its URI
        return False


def _boxed(df: DataFrame, geom: str, side: str, drop: set[str]) -> DataFrame:
    """Add the box (``_l`` / ``_r``); without what the join drops.

    A box that has to be computed from the geometry is stored with its row, since
    a join reads its sides several times.
    """
    computed = box_name(geom) not in df.columns
    df = df.withColumn(f"_{side}", covering(df, geom)).filter(F.col(f"_{side}").isNotNull()).drop(*drop)
    return staged(df, "boxes") if computed else df


def _is_stored(df: DataFrame, box: str) -> bool:
    """Whether the files of ``df`` hold a column of the box's name. Only the speed of the join depends on it."""
    files = df.inputFiles()
    if not files or not files[0].endswith(".parquet"):
        return False
    try:
        return box in df.sparkSession.read.parquet(files[0]).columns
    except AnalysisException:  # a path that cannot be read by its URI
        return False


def _dealt(boxed: DataFrame, df: DataFrame, geom: str) -> DataFrame:
    """A side whose boxes lie in files, its own or new ones.

    Each comparison of a pushed-down filter would compute an expression's box anew. The rows of new files are dealt
    evenly, so a layer of one file is joined on all cores.
    """
    if box_name(geom) not in df.columns or _is_stored(df, box_name(geom)):
        return boxed
    return staged(boxed.repartition(2 * boxed.sparkSession.sparkContext.defaultParallelism), "boxes")


def _placed(df: DataFrame, cell: float, side: str) -> DataFrame:
    """Add the level of the box."""
    box = F.col(f"_{side}")
    wide = _finest(box["xmax"], cell) - _finest(box["xmin"], cell)
    high = _finest(box["ymax"], cell) - _finest(box["ymin"], cell)
    exact = F.greatest(_bits(F.greatest(wide, high)) - LONG_BITS, _bits(F.least(wide, high)), F.lit(0))
    return df.withColumn(f"_{side}level", (F.ceil(exact / LEVEL_STEP) * LEVEL_STEP).cast("int"))


def _lanes(side: str, level: int, others: list[int]) -> list[int]:
    """Entries of a box of ``level``, each level * 2 + lane.

    Lane 0 joins left boxes in their own cells with equal or smaller right
    boxes, lane 1 joins smaller left boxes with right boxes in their own cells.
    """
    coarser = [m for m in others if m > level]
    if side == "l":
        return [level * 2] * (level >= others[0]) + [m * 2 + 1 for m in coarser]
    return [level * 2] * (level in others) + [m * 2 for m in coarser] + [level * 2 + 1] * (level > others[0])


def _level_of(entry: Column) -> Column:
    return F.shiftright(entry, 1)


def _entered(df: DataFrame, side: str, own: list[int], others: list[int], cell: float) -> DataFrame:
    """One row per cell under which a box can meet one of the other side."""
    box, level = F.col(f"_{side}"), F.col(f"_{side}level")
    lanes = F.array().cast("array<int>")
    for m in own:
        lanes = F.when(level == m, F.lit(_lanes(side, m, others)).cast("array<int>")).otherwise(lanes)
    df = df.withColumn("_entry", F.explode(lanes))
    for axis in ("x", "y"):
        ends = [_shift(_finest(box[f"{axis}{end}"], cell), _level_of(F.col("_entry"))) for end in ("min", "max")]
        df = df.withColumn(f"_c{axis}", F.explode(F.sequence(*ends)))
    return df.drop(f"_{side}level")


CELL_KEY = ["_entry", "_cx", "_cy"]


class _Side:
    """What a side's stored boxes say of it: rows, extent and own cells per level."""

    def __init__(self, rows):
        self.cells = {r["level"]: r["cells"] for r in rows}
        self.rows = sum(r["rows"] for r in rows)
        folds = zip((min, min, max, max), BOX_TYPE.fields)
        self.extent = [fold(r[f.name] for r in rows) for fold, f in folds] if rows else None


def _measured(boxed: dict[str, DataFrame], cell: float) -> dict[str, _Side]:
    """Both sides in one job; a stored box is all that is read."""
    folds = list(zip((F.min, F.min, F.max, F.max), BOX_TYPE.fields))
    parts = []
    for side, df in boxed.items():
        box, level = F.col(f"_{side}"), F.col(f"_{side}level")
        cells = F.lit(1).cast("bigint")
        for axis in ("x", "y"):
            first, last = (_shift(_finest(box[f"{axis}{end}"], cell), level) for end in ("min", "max"))
            cells = cells * (last - first + 1)
        parts.append(_placed(df, cell, side).select(F.lit(side).alias("side"), level.alias("level"), cells.alias("cells"), box.alias("box")))
    grouped = parts[0].unionByName(parts[1]).groupBy("side", "level")
    sums = F.count("*").alias("rows"), F.sum("cells").alias("cells")
    found = grouped.agg(*sums, *[fold(f"box.{f.name}").alias(f.name) for fold, f in folds]).collect()
    return {s: _Side([r for r in found if r["side"] == s]) for s in boxed}


def _within(inner: list[float], outer: list[float]) -> bool:
    return outer[0] <= inner[0] and outer[1] <= inner[1] and inner[2] <= outer[2] and inner[3] <= outer[3]


def _common(a: list[float], b: list[float]) -> list[float]:
    return [max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3])]


def _cell_size(boxed: dict[str, DataFrame], cell: float, common: list[float]) -> float:
    """The finest cell, made larger where the coordinates would lie beyond the last one.

    Then nearly all boxes decide it, so stray ones do not coarsen the grid.
    """
    if max(map(abs, common)) <= cell * (1 << SPAN_BITS):
        return cell
    centres = []
    for side, df in boxed.items():
        box = F.col(f"_{side}")
        middle = [F.abs(box[f"{axis}min"] / 2 + box[f"{axis}max"] / 2) for axis in "xy"]
        centres.append(df.select(F.greatest(*middle).alias("far")).filter(F.col("far") < float("inf")))
    far = centres[0].unionByName(centres[1]).agg(F.percentile_approx("far", 0.999, 10000)).first()[0]
    return max(cell, (far or 0.0) / (1 << (SPAN_BITS - 1)))


def _area(box: list[float]) -> float:
    return (box[2] - box[0]) * (box[3] - box[1])


def _hull(boxes: list[list[float]]) -> list[float]:
    return [fold(b[k] for b in boxes) for k, fold in enumerate((min, min, max, max))]


def quadtree_cover(cells: dict[tuple[int, int], list[float]], bits: int, parts: int) -> list[list[float]]:
    """At most ``parts`` boxes that cover the hulls of all cells of a grid of 2 ** bits a side.

    From the root on, the node whose children leave out most area takes their place.
    """
    levels = [{place: list(box) for place, box in cells.items()}]
    for _ in range(bits):
        above: dict[tuple[int, int], list] = {}
        for (x, y), box in levels[-1].items():
            above.setdefault((x >> 1, y >> 1), []).append(box)
        levels.append({place: _hull(boxes) for place, boxes in above.items()})

    def children(level, place):
        return [(x, y) for x in (2 * place[0], 2 * place[0] + 1) for y in (2 * place[1], 2 * place[1] + 1) if (x, y) in levels[level - 1]]

    def entry(level, place):
        gain = 0.0
        if level:
            gain = _area(levels[level][place]) - sum(_area(levels[level - 1][c]) for c in children(level, place))
        return -gain, level, place

    nodes = [entry(bits, place) for place in levels[bits]]
    done = []
    heapq.heapify(nodes)
    while nodes:
        gain, level, place = heapq.heappop(nodes)
        below = children(level, place) if level else []
        # One child is the same hull: go down; several must leave something out and find room.
        if len(below) == 1 or (below and gain < 0 and len(nodes) + len(done) + len(below) <= parts):
            for child in below:
                heapq.heappush(nodes, entry(level - 1, child))
        else:
            done.append(levels[level][place])
    return done


def _cover(df: DataFrame, side: str, common: list[float]) -> list[list[float]]:
    """A few boxes that cover all boxes of a side; its boxes are counted into a grid of fixed size first."""
    box = F.col(f"_{side}")
    last = (1 << COVER_BITS) - 1
    places = []
    for axis, low, high in (("x", common[0], common[2]), ("y", common[1], common[3])):
        share = ((box[f"{axis}min"] / 2 + box[f"{axis}max"] / 2) - F.lit(low)) / F.lit((high - low) or 1.0)
        places.append(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * last).cast("int").alias(axis))
    folds = zip((F.min, F.min, F.max, F.max), BOX_TYPE.fields)
    found = df.select(box.alias("box"), *places).groupBy("x", "y").agg(*[fold(f"box.{f.name}").alias(f.name) for fold, f in folds])
    hulls = {(r["x"], r["y"]): _common([r[f.name] for f in BOX_TYPE.fields], common) for r in found.collect()}
    return quadtree_cover(hulls, COVER_BITS, COVER_PARTS)


def _narrowed(boxed: dict[str, DataFrame], sides: dict[str, _Side], cover_rows: int) -> tuple[dict[str, DataFrame], bool]:
    """Each side without boxes that lie beyond all of the other's, and whether anything may have gone.

    First the other side's extent, then, for a side that is much the larger one, a cover of the other. Both are
    comparisons with literals, by which a stored layer skips files and row groups.
    """
    out, fewer = dict(boxed), False
    for side, other in (("l", "r"), ("r", "l")):
        if not _within(sides[side].extent, sides[other].extent):
            out[side], fewer = out[side].filter(bbox_meets(F.col(f"_{side}"), sides[other].extent)), True
    small = min("lr", key=lambda s: sides[s].rows)
    large = "r" if small == "l" else "l"
    common = _common(sides["l"].extent, sides["r"].extent)
    worth = sides[large].rows >= max(cover_rows, COVER_TIMES * sides[small].rows)
    if worth and all(map(math.isfinite, common)) and common[0] <= common[2] and common[1] <= common[3]:
        cover = _cover(out[small], small, common)
        if not cover:
            return {s: df.limit(0) for s, df in out.items()}, True
        if sum(map(_area, cover)) <= 0.7 * _area(common):
            meets = [bbox_meets(F.col(f"_{large}"), box) for box in cover]
            while len(meets) > 1:  # balanced, so the filter is no deep chain
                meets = [a | b for a, b in zip(meets[::2], meets[1::2])] + meets[len(meets) & ~1 :]
            out[large], fewer = out[large].filter(meets[0]), True
    return out, fewer


def _entries_at_most(side: str, own: dict[int, int], others: list[int]) -> int:
    """Bound on the rows of ``_entered``: a coarser level never has more cells."""
    return sum(cells * len(_lanes(side, level, others)) for level, cells in own.items())


def _small_side(placed: dict[str, DataFrame], entries: dict[str, int]) -> tuple[str, int]:
    """-> (side with fewer entries, bound on its bytes).

    The width of the rows is measured only where the number of entries alone
    does not rule a broadcast out, and only if some column has no fixed width.
    """
    side = min("lr", key=entries.get)
    df = placed[side]
    limit = broadcast_limit(df.sparkSession)
    widest = FIXED_WIDTH * (len(df.columns) + 8)
    if entries[side] * FIXED_WIDTH <= limit and not all(has_fixed_width(f.dataType) for f in df.schema):
        widest += df.agg(F.max(row_bytes(df)).alias("bytes")).first()["bytes"] or 0
    return side, entries[side] * (widest + BOX_BYTES)


def _hot_cells(entered: dict[str, DataFrame], entries: dict[str, int], partitions: int) -> list[tuple[str, int, int]]:
    """(side, cell key, parts) of cells with more rows than two mean partitions.

    Frequent-items sketches, one per side and slice of the keys, find them in
    one job that merges on many tasks.  The result only steers how cells are
    split: the join sees every row.  There can be no more hot cells on a side
    than half the shuffle partitions, so the list is small.
    """
    slices, tracked = min(64, partitions), max(1024, partitions // 4)
    keyed = [df.select(F.lit(s).alias("side"), F.xxhash64(*CELL_KEY).alias("key")) for s, df in entered.items()]
    sketch = (
        keyed[0]
        .unionByName(keyed[1])
        .groupBy("side", F.pmod("key", F.lit(slices)))
        .agg(F.expr(f"approx_top_k(key, {tracked}, {tracked})").alias("top"))
    )
    mean = F.when(F.col("side") == "l", max(1, entries["l"] // partitions)).otherwise(max(1, entries["r"] // partitions))
    items = sketch.select("side", F.explode("top").alias("top")).select(
        "side", F.col("top.item").alias("key"), F.ceil(F.col("top.count") / mean).alias("parts")
    )
    return [tuple(r) for r in items.filter("parts > 2").collect()]


def _splits(spark, hot: list[tuple[str, int, int]], partitions: int) -> tuple[DataFrame, dict[str, float]]:
    """Cell key -> parts of each side, and each side's largest part in mean partitions.

    Where both sides are hot, the grid of their parts stays near the number of
    shuffle partitions, so their parts are larger than a mean one.
    """
    parts: dict[int, dict[str, int]] = {}
    for side, key, count in hot:
        parts.setdefault(key, {"l": 1, "r": 1})[side] = count
    rows, largest = [], {"l": 2.0, "r": 2.0}  # a cell that is not hot has two mean partitions at most
    for key, both in parts.items():
        product = both["l"] * both["r"]
        scale = min(1.0, math.sqrt(partitions / product)) if min(both.values()) > 1 else 1.0
        split = {s: max(1, math.ceil(both[s] * scale)) for s in "lr"}
        rows.append((key, split["l"], split["r"]))
        largest = {s: max(largest[s], both[s] / split[s]) for s in "lr"}
    return F.broadcast(spark.createDataFrame(rows, "_key bigint, _lparts int, _rparts int")), largest


def _salted(entered: DataFrame, splits: DataFrame, side: str, unique: list[str]) -> DataFrame:
    """Split the rows of hot cells; the other side's splits see a copy of each."""
    other = "r" if side == "l" else "l"
    parts = {s: F.coalesce(F.col(f"_{s}parts"), F.lit(1)) for s in "lr"}
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in unique]), parts[side]).cast("int")
    copies = F.explode(F.sequence(F.lit(0), parts[other] - 1))
    df = entered.withColumn("_key", F.xxhash64(*CELL_KEY)).join(splits, "_key", "left")
    return df.withColumn(f"_{side}salt", own).withColumn(f"_{other}salt", copies).drop("_key", "_lparts", "_rparts")


def bbox_join(
    left: DataFrame,
    right: DataFrame,
    left_geom: str = "geom",
    right_geom: str = "geom",
    cell: float = FINEST_CELL,
    cover_rows: int = COVER_ROWS,
) -> DataFrame:
    """All pairs of features whose boxes meet, each once.

    Boxes may be of any size, infinite ones included. A side with ``cover_rows`` rows or more that is much the larger one
    is first filtered by a few boxes that cover the other, so a stored layer skips what lies between them.

    Column names of the sides must differ (a shared geometry column and its box
    are kept from neither side).  Pass ids and boxes only and join wide columns
    back by id, since a row travels once per cell.
    """
    drop = {left_geom, box_name(left_geom)} & {right_geom, box_name(right_geom)}
    clash = (set(left.columns) & set(right.columns)) - drop
    if clash:
        raise LayerError(f"both sides of the join have columns {sorted(clash)}")
    keep = {s: [c for c in df.columns if c not in drop] for s, df in (("l", left), ("r", right))}
    boxed = {"l": _boxed(left, left_geom, "l", drop), "r": _boxed(right, right_geom, "r", drop)}
    fields = [df.schema[c] for s, df in (("l", left), ("r", right)) for c in keep[s]]
    nothing = left.sparkSession.createDataFrame([], T.StructType(fields))
    sides = _measured(boxed, cell)
    if not sides["l"].rows or not sides["r"].rows:
        return nothing
    if sides["l"].rows + sides["r"].rows >= STORED_ROWS:
        boxed = {"l": _dealt(boxed["l"], left, left_geom), "r": _dealt(boxed["r"], right, right_geom)}
    coarser = _cell_size(boxed, cell, _common(sides["l"].extent, sides["r"].extent))
    # Boxes far from all of the other side meet nothing; only what is left counts.
    boxed, fewer = _narrowed(boxed, sides, cover_rows)
    if fewer or coarser != cell:
        cell, sides = coarser, _measured(boxed, coarser)
    if not sides["l"].rows or not sides["r"].rows:
        return nothing
    placed = {s: _placed(df, cell, s) for s, df in boxed.items()}
    own = {s: side.cells for s, side in sides.items()}
    others = {"l": sorted(own["r"]), "r": sorted(own["l"])}
    entries = {s: _entries_at_most(s, own[s], others[s]) for s in "lr"}
    entered = {s: _entered(df, s, sorted(own[s]), others[s], cell) for s, df in placed.items()}
    keys = CELL_KEY
    spark = left.sparkSession
    small, size = _small_side(placed, entries)
    if size <= broadcast_limit(spark):
        entered[small] = F.broadcast(entered[small])
    else:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = _hot_cells(entered, entries, partitions)
        largest = {"l": 2.0, "r": 2.0}
        if hot:
            splits, largest = _splits(spark, hot, partitions)
            for s in "lr":
                unique = ["fid"] if "fid" in keep[s] else [*keep[s], f"_{s}"]
                entered[s] = _salted(entered[s], splits, s, unique)
            keys = CELL_KEY + ["_lsalt", "_rsalt"]
        # A task's hash table: a mean share beside the largest part of a cell.
        if size * (1 + largest[small]) <= partitions * HASH_BYTES:
            entered[small] = entered[small].hint("shuffle_hash")
    joined = entered["l"].join(entered["r"], keys)
    lowest = {axis: F.greatest(F.col("_l")[f"{axis}min"], F.col("_r")[f"{axis}min"]) for axis in "xy"}
    corner = [F.col(f"_c{axis}") == _shift(_finest(lowest[axis], cell), _level_of(F.col("_entry"))) for axis in "xy"]
    meets = bbox_meets(F.col("_l"), F.col("_r"))
    return joined.filter(corner[0] & corner[1] & meets).select(*keep["l"], *keep["r"])
