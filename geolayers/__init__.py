"""Vector layers (points, lines, polygons with attributes) as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The Arrow functions of this package travel to the executors inside the plan,
# so a cluster needs no copy of the package on its worker nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from geolayers.functions.boxes import bbox_meets, make_box
from geolayers.functions.names import launder, launder_name
from geolayers.functions.text import transcode
from geolayers.functions.values import coerce_read, coerce_write
from geolayers.functions.wkb import (
    box_wkb,
    envelope,
    geometry_kind,
    line_wkb,
    point_wkb,
    strip_ewkb,
    to_wkt,
)
from geolayers.model import Field, LayerError
from geolayers.operators.columns import as_layer
from geolayers.operators.dml import (
    delete,
    delete_where,
    insert,
    returning,
    update,
    update_where,
)
from geolayers.operators.spatial import (
    bbox_filter,
    bbox_join,
    common_kind,
    encode_boxes,
    encode_points,
    geometry_column,
    intersects_box,
)
from geolayers.sources.catalog import import_layers, layer_catalog, list_layers
from geolayers.sources.fids import assign_fid
from geolayers.sources.layers import layer_count, read_layer, write_layer
from geolayers.sources.shapefile import ingest_shapefiles, read_shapefile

__all__ = [
    "Field",
    "LayerError",
    "as_layer",
    "assign_fid",
    "bbox_filter",
    "bbox_join",
    "bbox_meets",
    "box_wkb",
    "coerce_read",
    "coerce_write",
    "common_kind",
    "delete",
    "delete_where",
    "encode_boxes",
    "encode_points",
    "envelope",
    "geometry_column",
    "geometry_kind",
    "import_layers",
    "ingest_shapefiles",
    "insert",
    "intersects_box",
    "launder",
    "launder_name",
    "layer_catalog",
    "layer_count",
    "line_wkb",
    "list_layers",
    "make_box",
    "point_wkb",
    "read_layer",
    "read_shapefile",
    "returning",
    "strip_ewkb",
    "to_wkt",
    "transcode",
    "update",
    "update_where",
    "write_layer",
]
