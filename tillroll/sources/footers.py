"""What the files of a stored Parquet table really hold, column by column.

A merged read shows one schema for the whole table: columns that a file lacks are read as null, and their order is
that of some file. The footers tell which partitions differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.sources.sinks import file_system


def open_file(path: str) -> pa.NativeFile:
    """A file on any file system that Arrow knows, seen from a task."""
    if path.startswith("file:"):
        return pa.OSFile(path.removeprefix("file:").replace("///", "/", 1))
    files, place = FileSystem.from_uri(path)
    return files.open_input_file(place)


def stored_layouts(spark: SparkSession, folder: str, opened: Callable[[str], pa.NativeFile] = open_file) -> DataFrame:
    """One row per partition and layout: ``partition`` (its folder), ``columns`` (name and type in stored
    order), ``files`` and the name of one of them.

    Spark lists the files without reading them; tasks read the footers alone. ``opened`` opens a file
    in a task, for file systems that Arrow does not know.
    """

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, columns = pa.string(), pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
        for batch in batches:
            found = []
            for path in batch["path"].to_pylist():
                with opened(path) as file:
                    found.append([{"name": field.name, "type": str(field.type)} for field in pq.read_schema(file)])
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(found, columns)], schema=pa.schema([("path", names), ("columns", columns)]))

    files, place = file_system(spark, folder)
    base = files.makeQualified(place).toString()
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    read = listed.select("path").mapInArrow(footers, "path string, columns array<struct<name: string, type: string>>")
    inside = F.substring(F.col("path"), len(base) + 2, 1 << 20)
    rows = read.select(F.regexp_replace(inside, "/?[^/]*$", "").alias("partition"), "columns", F.regexp_extract(inside, "[^/]*$", 0).alias("file"))
    return rows.groupBy("partition", "columns").agg(F.count("*").alias("files"), F.min("file").alias("file"))


def deviating_layouts(layouts: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The rows of ``stored_layouts`` that differ from the columns expected in the files, and how:
    ``missing``, ``extra`` and ``retyped`` name columns, ``misplaced`` tells that the rest is in another order.

    The type of a column is the one most files have (the last by name among equally many).
    """
    wanted = F.array(*map(F.lit, expected)).cast("array<string>")
    names = F.transform("columns", lambda column: column["name"])
    cells = layouts.select("*", F.explode_outer("columns").alias("_cell")).select("*", "_cell.*").drop("_cell")
    holders = cells.withColumn("_holders", F.sum("files").over(Window.partitionBy("name", "type")))
    usual = F.max_by("type", F.struct("_holders", "type")).over(Window.partitionBy("name"))
    retyped = F.sort_array(F.collect_set(F.when(F.col("type") != F.col("_usual"), F.col("name"))))
    judged = holders.withColumn("_usual", usual).groupBy(*layouts.columns).agg(F.array_join(retyped, ",").alias("retyped"))
    return judged.select(
        "partition",
        "files",
        "file",
        F.array_join(F.array_except(wanted, names), ",").alias("missing"),
        F.array_join(F.array_except(names, wanted), ",").alias("extra"),
        (F.array_intersect(names, wanted) != F.array_intersect(wanted, names)).alias("misplaced"),
        "retyped",
    ).where((F.concat("missing", "extra", "retyped") != "") | F.col("misplaced"))
