"""Intermediate tables in the shared folder, and small helpers the operators have in common."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_dir

#: A run of the six ASCII white-space characters, and a run of anything else, as Java and DuckDB regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Spark's file server hands the archive out from the driver; nobody else opens this folder.
    archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}_llm.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder all executors share, and read back: lineage ends here and nothing is computed twice."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


_paths: dict[int, str] = {}


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing will read any more; what was made of them is stored itself by then."""
    for table_ in tables:
        if path := _paths.pop(id(table_), None):
            delete_path(table_.sparkSession, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal ``keys``, for input sorted by them; only one run is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        values = list(zip(*columns))
        start = 0
        for i, value in enumerate(values):
            if value != current:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, current, start = [], value, i
        if len(values) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
