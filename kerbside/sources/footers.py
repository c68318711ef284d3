"""Monthly files as a table: what one listing finds, and what the files' footers say.

The listing is a Spark read that opens no file. Footers are one more job: executors
read the last bytes of each file, so loading does not wait on the driver for one
file after the other, however many there are.
"""

from __future__ import annotations

import hashlib
import json
import re
import string
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.trips import month_index, parse_month
from kerbside.session import store_scheme
from kerbside.settings import END_MONTH, SERVICES, START_MONTH, Lake

# Stores whose files executors open themselves; in others Spark's own reader probes the footers.
_ARROW_STORES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
_PROBES_AT_ONCE = 16
_TAIL_BYTES = 64 * 1024

FILE_SCHEMA = "service_type string, year int, month int, path string, length bigint, modified timestamp"
FOOTER_SCHEMA = f"{FILE_SCHEMA}, variant string, footer_digest string, rows bigint"


def layout_parts(layout: str) -> tuple[str, str, list[str]]:
    """(glob, pattern, fields) of a month layout without its root: which files to list, and how to read their names.

    ``pattern`` is a Java expression; group i is ``fields[i - 1]``. A file may also
    lie in a folder of that name.
    """
    glob, pattern, fields = "", "", []
    for literal, field, spec, _ in string.Formatter().parse(layout.removeprefix("{root}")):
        glob += literal
        pattern += re.escape(literal)
        if field in fields:
            pattern += f"\\{fields.index(field) + 1}"
        elif field:
            width = (spec or "").strip("0d")
            pattern += r"([^/]+?)" if field == "service" else rf"(\d{{{width}}})" if width else r"(\d+)"
            fields.append(field)
        glob += "*" if field else ""
    return glob, f"{pattern}(?:/[^/]+)?$", fields


def listed_files(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> DataFrame:
    """The landed files of the months from start to end: service_type, year, month, path, length, modified."""
    glob, pattern, fields = layout_parts(lake.month_layout)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        found = reader.load(lake.raw.rstrip("/") + glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILE_SCHEMA)
        raise

    def part(field: str):
        return F.regexp_extract("path", pattern, fields.index(field) + 1)

    files = found.select(
        part("service").alias("service_type"),
        part("year").try_cast("int").alias("year"),
        part("month").try_cast("int").alias("month"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )
    first, last = (year * 12 + month - 1 for year, month in map(parse_month, (start, end)))
    return files.filter(F.col("service_type").isin(list(services)) & month_index("year", "month").between(first, last))


def with_footers(files: DataFrame) -> DataFrame:
    """``files`` with ``variant``, the same for files of the same columns and types, ``footer_digest`` and ``rows``.

    Column order and upper or lower case make no variant. A file that is no parquet raises.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_footer(path) for path in batch.column("path").to_pylist()]
            columns = [pa.array(values) for values in zip(*found, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "variant", "footer_digest", "rows"])

    return files.mapInArrow(read, FOOTER_SCHEMA)


def read_footer(path: str) -> tuple[str, str, int]:
    """(variant, digest of the footer's bytes, number of rows) of a parquet file."""
    store, name = _store_of(path)
    with store.open_input_file(name) as file:
        size = file.size()
        tail = file.read_at(min(size, _TAIL_BYTES), max(0, size - _TAIL_BYTES))
        length = int.from_bytes(tail[-8:-4], "little")
        if tail[-4:] != b"PAR1" or length + 12 > size:
            raise ValueError(f"not a parquet file: {path}")
        if length + 8 > len(tail):
            tail = file.read_at(length + 8, size - length - 8)
    footer = tail[-8 - length : -8]
    found = pq.read_metadata(pa.BufferReader(b"PAR1" + footer + tail[-8:]))
    columns = sorted(
        (c.path.lower(), c.physical_type, str(c.logical_type), c.length or 0)
        for c in (found.schema.column(i) for i in range(found.num_columns))
    )
    variant = hashlib.sha256(json.dumps(columns).encode()).hexdigest()
    return variant, hashlib.sha256(footer).hexdigest(), found.num_rows


def _store_of(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = path.rpartition(":") if path.startswith("file:") else path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{_ARROW_STORES[scheme]}:{rest}")


def _with_spark_schemas(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``with_footers`` for stores that only Spark reads: the driver asks for one schema per file, many at a time."""

    def probe(row) -> tuple:
        schema = spark.read.parquet(row.path).schema
        columns = sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields)
        return (*row, hashlib.sha256(json.dumps(columns).encode()).hexdigest(), None, None)

    with ThreadPoolExecutor(_PROBES_AT_ONCE) as pool:
        return spark.createDataFrame(list(pool.map(probe, files.collect())), FOOTER_SCHEMA)


def landed_files(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> DataFrame:
    """The landed files with their footers; digest and rows are null where only Spark reads the store."""
    files = listed_files(spark, lake, services, start, end)
    return with_footers(files) if store_scheme(spark, lake.raw) in _ARROW_STORES else _with_spark_schemas(spark, files)
