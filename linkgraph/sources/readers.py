"""Readers (S1-S7): files of any format, typed-by-prefix folders, tables."""

from __future__ import annotations

import csv
import zlib
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linkgraph.operators.relational import union_all_by_name
from linkgraph.session import cut_lineage

# --- fixed values: pipe-separated input -------------------------------------
PIPE_CSV_OPTIONS = {"header": "true", "sep": "|"}
# The same for files of this package's own writer: quotes are doubled, line breaks and outer spaces are part of a value.
EXPORT_CSV_OPTIONS = {**PIPE_CSV_OPTIONS, "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\\N",
                      "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Marker between a kind and the rest of a file name (``<dir>/<Kind>Doc...``).
KIND_MARKER = "Doc"
# ---------------------------------------------------------------------------


def to_ddl(dtype: str | Sequence[Sequence[str]]) -> str:
    """Schema as DDL: accepts a DDL string or ``[[column, type], ...]`` pairs."""
    if isinstance(dtype, str):
        return dtype
    return ", ".join(f"`{c}` {t}" for c, t in dtype)


def create_schema(dtype: str | Sequence[Sequence[str]], nullable: bool = False) -> T.StructType:
    """``[[column, type], ...]`` (or DDL) -> ``StructType``; fields non-nullable by default.

    File readers mark every field nullable again on load, so the flag only
    matters for DataFrames built from rows.
    """
    parsed = T.DataType.fromDDL(to_ddl(dtype))
    return T.StructType([T.StructField(f.name, f.dataType, nullable) for f in parsed.fields])


def read_file(spark: SparkSession, path: str | Sequence[str], dtype: Any = None, fmt: str = "csv",
              options: Mapping[str, Any] | None = None) -> DataFrame:
    """Load path(s) in any format with pass-through options and an optional schema.

    An explicit schema skips inference (no extra pass over the input).
    """
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in (options or {}).items()})
    if dtype is not None:
        reader = reader.schema(to_ddl(dtype))
    return reader.load(path if isinstance(path, str) else list(path))


def _inflate(content: bytes) -> bytes:
    """The head of a gzip file's text; raises if the file is cut off or broken anywhere."""
    head, rest = b"", content
    while rest:
        member = zlib.decompressobj(wbits=31)
        while rest and not member.eof:
            out = member.decompress(rest, 1 << 20)
            head = head if len(head) > 1 << 16 else head + out
            rest = member.unconsumed_tail or member.unused_data
            if not out and not member.eof and not member.unconsumed_tail:
                raise EOFError("cut off")
        if not member.eof:
            raise EOFError("cut off")
    return head


def _fits(found: pa.DataType, wanted: pa.DataType) -> bool:
    """Whether Spark reads a Parquet column of type ``found`` as ``wanted`` without loss."""
    kinds = [(pa.types.is_string, pa.types.is_large_string, pa.types.is_dictionary), (pa.types.is_timestamp,), (pa.types.is_nested,)]
    if any(any(k(found) for k in same) and any(k(wanted) for k in same) for same in kinds):
        return True
    for one in (pa.types.is_integer, pa.types.is_floating):
        if one(found) and one(wanted):
            return found.bit_width <= wanted.bit_width
    return found.equals(wanted)


def _fault(name: str, content: bytes, fmt: str, wanted: pa.Schema | None, header: str | None) -> str | None:
    """Why a file cannot be used as a whole; None if it can."""
    try:
        if fmt == "parquet":
            file = pq.ParquetFile(pa.BufferReader(content))
            for field in wanted or ():
                at = file.schema_arrow.get_field_index(field.name)
                if at < 0:
                    return f"schema: no column {field.name}"
                if not _fits(file.schema_arrow.field(at).type, field.type):
                    return f"schema: {field.name} is {file.schema_arrow.field(at).type}"
            for group in range(file.num_row_groups):  # every page is decoded once
                file.read_row_group(group)
            return None
        head = _inflate(content) if name.endswith(".gz") else content[:1 << 16]
        if fmt == "csv" and header is not None and wanted is not None:
            line = head.decode("utf-8", "replace").splitlines()[:1]
            names = next(csv.reader(line, delimiter=header), [])
            missing = [f.name for f in wanted if f.name not in names]
            if missing:
                return f"schema: no column {missing[0]}"
    except Exception as e:  # whatever a reader raises is a reason to reject the file, not to stop the job
        return f"unreadable: {type(e).__name__}"
    return None


def read_whole_files(spark: SparkSession, path: str | Sequence[str], dtype: Any = None, fmt: str = "parquet",
                     options: Mapping[str, Any] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the rows of all files that are whole, and ``(file, reason)`` of all others.

    Where one input of many is broken, the others go on and nothing of the broken
    one is used: a cut-off or corrupt file (Parquet of any codec; gzip for CSV, JSON and
    text) and one without the wanted columns (Parquet types, CSV header line) is
    rejected as a whole, not from the broken place on.  Bad records inside a readable
    file are ``parse_with_rejects``'s business.

    Every file is checked by one task, which holds its bytes: for inputs of files up to
    about a tenth of an executor's memory (2 GB at most, beyond which the read fails).
    The verdicts are stored; rejected files are taken out by an anti-join on the file
    path, so neither the listing nor the verdicts pass through the driver.
    """
    opts = {k: str(v) for k, v in (options or {}).items()}
    places = path if isinstance(path, str) else list(path)
    schema = T.StructType.fromDDL(to_ddl(dtype)) if dtype is not None else None
    wanted = to_arrow_schema(schema) if schema is not None else None
    header = opts.get("sep", ",") if opts.get("header", "false").lower() == "true" else None

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                reason = _fault(name.as_py(), content.as_py(), fmt, wanted, header)
                if reason:
                    bad.append((name.as_py(), reason))
            yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in bad], pa.string()) for i in (0, 1)], names=["file", "reason"])

    listing = spark.read.format("binaryFile").options(**{k: v for k, v in opts.items() if k in ("pathGlobFilter", "recursiveFileLookup")})
    files = listing.load(places).select(F.col("_metadata.file_path").alias("file"), "content")
    rejects = cut_lineage(files.mapInArrow(check, "file string, reason string"), "file-rejects")
    reader = spark.read.format(fmt).options(**opts).option("ignoreCorruptFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(places)
    whole = (rows.withColumn("__file__", F.col("_metadata.file_path"))
             .join(rejects.select(F.col("file").alias("__file__")), on="__file__", how="left_anti"))
    return whole.select(*rows.columns), rejects


def read_kinds(spark: SparkSession, directory: str, kinds: Sequence[str], fmt: str = "parquet",
               options: Mapping[str, Any] | None = None, marker: str = KIND_MARKER) -> dict[str, DataFrame]:
    """One table per kind over a folder whose files (or folders) are typed by name prefix (``<Kind>Doc...``).

    Every kind is read by its own path pattern, so kinds may have columns of one name with other types.
    """
    opts = {k: str(v) for k, v in (options or {}).items()}
    return {k: spark.read.format(fmt).options(**opts).load(f"{directory.rstrip('/')}/{k}{marker}*") for k in kinds}


def read_by_prefix(spark: SparkSession, directory: str, kinds: Sequence[str], fmt: str = "parquet",
                   options: Mapping[str, Any] | None = None, marker: str = KIND_MARKER) -> DataFrame:
    """The tables of ``read_kinds`` as one, with column ``kind``.

    Columns are matched by name; one whose types differ between kinds becomes text
    (numbers are widened).
    """
    tables = read_kinds(spark, directory, kinds, fmt, options, marker)
    tagged = [df.withColumn("kind", F.lit(k)) for k, df in tables.items()]
    return union_all_by_name(tagged)


def read_table(spark: SparkSession, name: str | None = None,
               jdbc_options: Mapping[str, Any] | None = None) -> DataFrame:
    """A catalog table, or a JDBC table when ``jdbc_options`` are given."""
    if jdbc_options:
        return spark.read.format("jdbc").options(**{k: str(v) for k, v in jdbc_options.items()}).load()
    if not name:
        raise ValueError("read_table: give a table name or jdbc_options")
    return spark.read.table(name)
