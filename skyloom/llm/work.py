"""Helpers shared by the operators: intermediate tables, free column names, hashes of a row's id."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import skyloom

from skyloom.session import new_work_path

# What str.split() and bytes.split() call white space in the contracts: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once for each application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(skyloom.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="skyloom-"), "skyloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("skyloom", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def map_arrow(df: DataFrame, f: Callable, schema) -> DataFrame:
    """``mapInArrow`` with a function of this library."""
    ship(df.sparkSession)
    return df.mapInArrow(f, schema)


_holder: tuple[str, Callable[[], None]] | None = None


def hold(name: str, release: Callable[[], None]) -> None:
    """Makes ``name`` the one operator that keeps looked-up words in this Python worker.

    Workers live on between tasks; what another operator has kept is released, so the memory of stages that follow
    one another does not add up.
    """
    global _holder
    if _holder is not None and _holder[0] != name:
        _holder[1]()
        give_back()
    _holder = (name, release)


def give_back() -> None:
    """Returns freed memory of this process to the system; the C library keeps what numpy has freed otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # a C library without it


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    The rows are computed once, survive lost executors, and have a size in bytes that Spark knows before it
    plans a join, so its own threshold decides on broadcasts.
    """
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it (case is ignored)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor)).cast("int")


def crc_mod_value(doc_id: int, divisor: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % divisor


def texts_of(column: pa.Array) -> list[str]:
    """An Arrow string column as Python texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]
