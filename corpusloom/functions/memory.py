"""Memory of the Python workers, and files of finished work."""

from __future__ import annotations


import gc
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from corpusloom.settings import ensure_checkpoint_dir

RELEASE_S = 1.5             # until Py4J has told the JVM what Python has let go


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """A checkpoint of the table that ``make`` plans; its shuffle files go at once.

    Spark deletes the files of a shuffle when the driver's JVM finds that nothing
    refers to it any more, which without this may be long after.  ``make`` is a
    function, so that no variable of the caller holds the plan.
    """
    frame = make()
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    frame = frame.checkpoint()
    for _ in range(2):      # what the first round frees may have held more
        gc.collect()
        time.sleep(RELEASE_S)
        spark.sparkContext._jvm.System.gc()
    return frame


def memory_returner():
    """A function that returns freed memory to the system.

    Spark keeps Python workers between tasks, and what numpy and Arrow have freed
    would stay theirs.  Returned as a nested function so that it travels to the
    executors by value.
    """

    def give_back():
        import ctypes

        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return give_back
