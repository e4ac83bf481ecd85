"""What goes to Python workers at once, and what they keep."""

import ctypes
import sys
from collections.abc import Callable
from types import ModuleType

import pyarrow as pa
from pyspark.sql import SparkSession

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Texts are long: let the session send at most ``ROWS`` of them in one Arrow batch.

    Spark's own bound on a batch's bytes stays in force for the longest ones.
    """
    rows = int(spark.conf.get(KEY))
    if rows <= 0 or rows > ROWS:
        spark.conf.set(KEY, str(ROWS))


def kept_by_worker(kind: str, key, make: Callable):
    """The object of this kind that the Python worker made for ``key``, one per kind.

    The package's functions are sent by value, so their modules' globals end with
    the task; a module of the worker's own outlives it.
    """
    held = sys.modules.setdefault("_geolayers_worker", ModuleType("_geolayers_worker")).__dict__
    if held.get(kind, (None,))[0] != key:
        held.pop(kind, None)
        held[kind] = key, make()
    return held[kind][1]


def one_thread() -> None:
    """Matrix products of this worker run on its task's own core.

    Spark gives a worker as many BLAS threads as its executor has cores. For small products the others spin
    and take the cores of other tasks. Where the library is another than numpy's own, nothing changes.
    """
    with open("/proc/self/maps") as maps:
        paths = {line.split()[-1] for line in maps if "openblas" in line}
    for path in paths:
        library = ctypes.CDLL(path)
        for name in ("openblas_set_num_threads", "openblas_set_num_threads64_"):
            put = getattr(library, name, None) or getattr(library, f"scipy_{name}", None)
            if put:
                put(ctypes.c_int(1))


def give_back() -> None:
    """Hand freed memory back to the system, where the C library can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
