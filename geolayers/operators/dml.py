"""Insert, update and delete by feature id.

Each returns the changed layer as a new DataFrame that the caller writes to a
new path.  Writing over the path that is being read destroys the input.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from geolayers.functions.values import coerce_write
from geolayers.functions.wkb import envelope, strip_ewkb
from geolayers.model import LayerError, STORED_AS, box_name, declared_name, is_geometry
from geolayers.session import broadcast_if_small, row_bytes
from geolayers.sources.fids import FID, assign_fid


def _need_fid(*frames: DataFrame) -> None:
    for df in frames:
        if FID not in df.columns:
            raise LayerError("changing a layer needs its fid column")


def _hinted(df: DataFrame) -> DataFrame:
    """Broadcast a change set only if its measured size allows it.

    Otherwise both sides are shuffled by fid, which is unique and cannot skew.
    """
    size = df.agg(F.count("*").alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return broadcast_if_small(df, size["rows"], size["bytes"] or 0)


def _stored(value: Column, field: T.StructField) -> Column:
    """A new value as the layer stores it, in the type of the layer's column.

    Times are rounded to seconds, NULL list elements dropped, the SRID word of
    EWKB removed.
    """
    if is_geometry(field):
        return strip_ewkb(value)
    value = value.cast(field.dataType)
    if isinstance(field.dataType, T.VariantType) or declared_name(field.dataType) not in STORED_AS:
        return value
    return coerce_write(value, field.dataType, field.name).cast(field.dataType)


def _with_boxes(base: DataFrame, new: DataFrame) -> DataFrame:
    """Rows with new geometries get new boxes, unless they bring them along."""
    for field in base.schema:
        box = box_name(field.name)
        if is_geometry(field) and box in base.columns and field.name in new.columns and box not in new.columns:
            new = new.withColumn(box, envelope(F.col(f"`{field.name}`")))
    return new


def insert(base: DataFrame, new: DataFrame, order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """-> (layer with the new rows, the new rows with their ids).

    New geometries get their boxes.  Rows without a fid get ids after the largest one, in partition order or in
    the order of ``order_by``; a given fid is kept and must be free.  Columns
    that the layer lacks are ignored, columns that the rows lack are NULL.
    """
    _need_fid(base)
    new = _with_boxes(base, new)
    extra = [c for c in new.columns if c not in base.columns]
    missing = [c for c in base.columns if c not in new.columns and c != FID]
    last = base.agg(F.max(FID).alias("last")).first()["last"]
    last = -1 if last is None else last
    if FID in new.columns:
        given = new.filter(F.col(FID).isNotNull())
        taken = _hinted(given.select(FID))
        clash = base.select(FID).join(taken, FID, "left_semi")
        twice = given.groupBy(FID).count().filter("count > 1").select(FID)
        found = clash.unionByName(twice).first()
        if found is not None:
            raise LayerError(f"fid {found[FID]} exists already")
        highest = given.agg(F.max(FID).alias("last")).first()["last"]
        last = max(last, highest) if highest is not None else last
        numbered = assign_fid(new.filter(F.col(FID).isNull()).drop(FID), last + 1, order_by)
        numbered = given.unionByName(numbered)
    else:
        numbered = assign_fid(new, last + 1, order_by)
    types = {f.name: f.dataType for f in base.schema}
    numbered = numbered.drop(*extra).withColumns({c: F.lit(None).cast(types[c]) for c in missing})
    fields = {f.name: f for f in base.schema}
    stored = numbered.select(
        [_stored(F.col(f"`{c}`"), fields[c]).alias(c, metadata=fields[c].metadata) for c in base.columns]
    )
    return base.unionByName(stored), stored


def update(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Overwrite the columns of ``changes`` in the features with its fids.

    A NULL in ``changes`` becomes NULL in the layer; a changed geometry gets its
    new box.  An unknown or repeated fid is an error, checked against the fid
    column alone before the join.  ``changes`` is read three times, so store an
    expensive one first.
    """
    _need_fid(base, changes)
    unknown = [c for c in changes.columns if c not in base.columns]
    if unknown:
        raise LayerError(f"layer has no columns {unknown}")
    changes = _with_boxes(base, changes)
    changed = [c for c in changes.columns if c != FID]
    size = changes.agg(
        F.count("*").alias("rows"), F.countDistinct(FID).alias("fids"), F.sum(row_bytes(changes)).alias("bytes")
    ).first()
    if size["rows"] != size["fids"]:
        raise LayerError("a fid occurs twice (or is NULL) in the changes")

    def hinted(df):
        return broadcast_if_small(df, size["rows"], size["bytes"] or 0)

    if base.select(FID).join(hinted(changes.select(FID)), FID, "left_semi").count() != size["rows"]:
        raise LayerError("the changes contain a fid that the layer lacks")
    marked = changes.select(
        FID, *[F.col(f"`{c}`").alias(f"_new_{c}") for c in changed], F.lit(True).alias("_changed")
    )
    joined = base.join(hinted(marked), FID, "left")
    out = []
    for field in base.schema:
        old = F.col(f"`{field.name}`")
        if field.name in changed:
            new = _stored(F.col(f"`_new_{field.name}`"), field)
            old = F.when(F.col("_changed"), new).otherwise(old)
        out.append(old.alias(field.name, metadata=field.metadata))
    return joined.select(out)


def update_where(base: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns in the features that satisfy ``condition``; no shuffle."""
    _need_fid(base)
    if any(name.lower() == FID for name in values):
        raise LayerError("a fid cannot be changed")
    unknown = [c for c in values if c not in base.columns]
    if unknown:
        raise LayerError(f"layer has no columns {unknown}")
    values = dict(values)
    for field in base.schema:
        if is_geometry(field) and field.name in values and box_name(field.name) in base.columns:
            values.setdefault(box_name(field.name), envelope(values[field.name]))
    out = []
    for field in base.schema:
        old = F.col(f"`{field.name}`")
        if field.name in values:
            old = F.when(condition, _stored(values[field.name], field)).otherwise(old)
        out.append(old.alias(field.name, metadata=field.metadata))
    return base.select(out)


def delete(base: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop the features with the fids of ``keys``; unknown fids are no error."""
    _need_fid(base, keys)
    return base.join(_hinted(keys.select(FID).distinct()), FID, "left_anti").select(base.columns)


def delete_where(base: DataFrame, condition: Column) -> DataFrame:
    """Drop the features that satisfy ``condition``; unknown (NULL) keeps them."""
    _need_fid(base)
    return base.filter(~F.coalesce(condition, F.lit(False)))


def returning(base: DataFrame, keys: DataFrame) -> DataFrame:
    """The features with the fids of ``keys``, as a change reports them."""
    _need_fid(base, keys)
    return base.join(_hinted(keys.select(FID).distinct()), FID, "left_semi").select(base.columns)



# Operations of a change log.
PUT, DROP = ("insert", "update"), "delete"


def apply_log(base: DataFrame, log: DataFrame, op: str = "op", sequence: str = "seq") -> DataFrame:
    """The layer after a log of mixed inserts, updates and deletes, in one pass over both.

    A row of the log has an operation (``insert``, ``update`` or ``delete``), a number in the
    ``sequence``, a fid and new values of all other columns of the log. For each fid the last operation decides. An
    update of a fid that the layer lacks, and that the log has not inserted, has no effect; an insert replaces a feature that is there. A
    feature that the log has inserted or deleted before its last update starts anew: columns that the log
    lacks are NULL, else they stay as they were. Inserts without a fid get ids after the largest one of layer and log, in the
    order of the sequence. A sequence number that occurs twice for a fid, an unknown operation, and an update or delete without a fid are errors.

    Each fid's last row is found by partial aggregates, so a feature with most of the changes is no hot group;
    one outer join with the layer follows. The log is read several times: store an expensive one first.
    """
    _need_fid(base, log)
    own = [c for c in log.columns if c not in (FID, op, sequence)]
    unknown = [c for c in own if c not in base.columns]
    if unknown:
        raise LayerError(f"layer has no columns {unknown}")
    wrong = ~F.coalesce(F.col(op).isin(*PUT, DROP), F.lit(False)) | (F.col(FID).isNull() & (F.col(op) != PUT[0])) | F.col(sequence).isNull()
    faulty = log.filter(wrong).select(op, FID).first()
    if faulty is not None:
        raise LayerError(f"the log holds an operation that cannot be done: {faulty[0]} of fid {faulty[1]}")
    given = log.filter(F.col(FID).isNotNull())
    twice = given.groupBy(FID, sequence).count().filter("count > 1").first()
    if twice is not None:
        raise LayerError(f"sequence number {twice[1]} occurs twice for fid {twice[0]}")
    new = log.filter(F.col(FID).isNull())
    if new.first() is not None:
        last = base.select(FID).unionByName(given.select(FID)).agg(F.max(FID)).first()[0]
        numbered = assign_fid(new.drop(FID), 0 if last is None else last + 1, [sequence])
        given = given.unionByName(numbered.select(given.columns))
    given = _with_boxes(base, given)
    own = [c for c in given.columns if c not in (FID, op, sequence)]
    values = F.struct(F.col(op).alias("_op"), *[F.col(f"`{c}`") for c in own])
    anew = F.max(F.when(F.col(op) != PUT[1], F.col(sequence))).isNotNull()
    inserted = F.max_by(F.col(op), F.when(F.col(op) != PUT[1], F.col(sequence)))
    last = given.groupBy(FID).agg(F.max_by(values, F.col(sequence)).alias("_last"), anew.alias("_anew"), inserted.alias("_base"))
    size = last.agg(F.count("*").alias("rows"), F.sum(row_bytes(last)).alias("bytes")).first()
    joined = base.withColumn("_known", F.lit(True)).join(broadcast_if_small(last, size["rows"], size["bytes"] or 0), FID, "full_outer")
    code = F.col("_last._op")
    # An update needs a feature: one of the layer that the log has not deleted, or one that it has inserted.
    there = F.when(F.col("_anew"), F.col("_base") == PUT[0]).otherwise(F.col("_known"))
    kept = code.isNull() | (code == PUT[0]) | ((code == PUT[1]) & F.coalesce(there, F.lit(False)))
    out = []
    for field in base.schema:
        old = F.col(f"`{field.name}`")
        if field.name in own:
            old = F.when(code.isNotNull(), _stored(F.col(f"_last.`{field.name}`"), field)).otherwise(old)
        elif field.name != FID:
            old = F.when(code.isNotNull() & F.col("_anew"), F.lit(None)).otherwise(old)
        out.append(old.alias(field.name, metadata=field.metadata))
    return joined.filter(kept).select(out)
