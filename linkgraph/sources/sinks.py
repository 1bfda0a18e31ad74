"""Writers (K1-K6): files, header files, edge/node exports, import manifest.

Exports follow a graph database bulk importer's layout: data parts without a
header, the header in a separate file, pipe-separated.  Every write is a
distributed Spark write into the given base folder (shared storage on a
cluster); nothing passes through the driver except header text and counts (and,
on file systems that cannot join files, a single file's bytes, in a small buffer).

A whole export is complete or absent: it is written to a staging folder beside its
place, moved there when every write has succeeded, and its manifest comes last.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException, UnsupportedOperationException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkgraph.operators.columns import auto_stringify
from linkgraph.operators.graph import edge_header_names, label_profile, nodes_for_label
from linkgraph.session import cut_lineage

# --- fixed values: export layout --------------------------------------------
EXPORT_SEP = "|"
# Standard CSV quoting; a value holding the separator, a quote or a line break is
# quoted and quotes are doubled.  Outer spaces stay, NULL is told from empty text.
CSV_WRITE_OPTIONS = {"sep": EXPORT_SEP, "quote": '"', "escape": '"', "header": "false", "lineSep": "\n",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N"}
CSV_READ_OPTIONS = {**{k: v for k, v in CSV_WRITE_OPTIONS.items() if k not in ("header", "lineSep")}, "multiLine": "true"}
# What keeps values as they are; separator and header line are the caller's.
CSV_VALUE_OPTIONS = {k: v for k, v in CSV_WRITE_OPTIONS.items() if k not in ("sep", "header")}
HEADER_SUFFIX = "_header"
EDGES_SUFFIX = "_edges"
MANIFEST = "import_manifest"
# ---------------------------------------------------------------------------


def _target(base_dir: str, path: str) -> str:
    return f"{base_dir.rstrip('/')}/{path.lstrip('/')}"


def header_frame(df: DataFrame, sep: str = EXPORT_SEP) -> DataFrame:
    """The header line of ``df`` (column names joined by ``sep``) as a one-row table."""
    return df.sparkSession.range(1).select(F.lit(sep.join(df.columns)).alias("value"))


def save_header(df: DataFrame, path: str, sep: str = EXPORT_SEP) -> str:
    """Write the header line to one UTF-8 file ``path`` without a line break, on any file system Spark knows."""
    _write_bytes(df.sparkSession, path, sep.join(df.columns).encode())
    return path


def _path(spark: SparkSession, path: str):
    """(file system, path) of a path on any file system Spark knows (needs a session with a JVM, not Spark Connect)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a file or folder in its place; what is there goes."""
    fs, p = _path(spark, target)
    fs.mkdirs(p.getParent())
    fs.delete(p, True)
    if not fs.rename(_path(spark, source)[1], p):
        raise OSError(f"cannot move {source} to {target}")


#: Records of one part; a reader takes a part with line breaks in its values as one split.
PART_RECORDS = 1_000_000


def _write_counted(df: DataFrame, path: str) -> int:
    """Write CSV parts of bounded length; the number of records written, counted by the write itself."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**CSV_WRITE_OPTIONS)
       .option("maxRecordsPerFile", PART_RECORDS).mode("overwrite").csv(path))
    return seen.get["rows"]


def join_parts(spark: SparkSession, folder: str, target: str, head: bytes = b"") -> int:
    """One file ``target`` from ``head`` and the part files of ``folder`` in part order; the number of parts.

    The file system joins them by itself where it can (no byte is read); otherwise
    they are copied one after the other through a small buffer.
    """
    fs, source = _path(spark, folder)
    parts = sorted(str(f.getPath().toString()) for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    paths = [_path(spark, p)[1] for p in parts]
    merged = f"{folder}/_joined"
    if head:
        _write_bytes(spark, merged, head)
    elif paths:
        fs.rename(paths.pop(0), _path(spark, merged)[1])
    else:
        _write_bytes(spark, merged, b"")
    filled = [p for p in paths if fs.getFileStatus(p).getLen()]
    if filled:
        sources = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(filled))
        for i, p in enumerate(filled):
            sources[i] = p
        try:
            fs.concat(_path(spark, merged)[1], sources)
        except (UnsupportedOperationException, IllegalArgumentException, Py4JJavaError):  # cannot join files, or not these
            whole = f"{folder}/_copied"
            out = fs.create(_path(spark, whole)[1], True)
            try:
                for p in [_path(spark, merged)[1], *filled]:
                    part = fs.open(p)
                    try:
                        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, spark._jsc.hadoopConfiguration(), False)
                    finally:
                        part.close()
            finally:
                out.close()
            merged = whole
    _move(spark, merged, target)
    return len(parts)


def _csv_name(name: str, sep: str) -> str:
    quoted = any(c in name for c in (sep, '"', "\n", "\r"))
    return '"' + name.replace('"', '""') + '"' if quoted else name


def _save_joined(df: DataFrame, target: str, fmt: str, mode: str, opts: dict[str, str]) -> None:
    """Write parts in parallel beside ``target``, then join them into its one file."""
    spark = df.sparkSession
    fs, place = _path(spark, target)
    if mode != "overwrite" and fs.exists(place):
        if mode == "ignore":
            return
        if mode != "append":
            raise FileExistsError(target)
    stage = f"{target}_stage-{uuid.uuid4().hex[:12]}"
    packed = opts.get("compression", "none") == "gzip"
    head = b""
    if fmt == "csv" and opts.get("header", "false").lower() == "true":
        head = (opts.get("sep", ",").join(_csv_name(c, opts.get("sep", ",")) for c in df.columns) + "\n").encode()
        head = gzip.compress(head, mtime=0) if packed else head  # members of a gzip file may follow each other
        opts = {**opts, "header": "false"}
    try:
        df.write.format(fmt).options(**opts).save(stage)
        name = f"part-00000-{uuid.uuid4()}.{ {'text': 'txt'}.get(fmt, fmt)}{'.gz' if packed else ''}"
        join_parts(spark, stage, f"{stage}/_whole/{name}", head)
        if mode == "append" and fs.exists(place):
            _move(spark, f"{stage}/_whole/{name}", f"{target}/{name}")
        else:
            _move(spark, f"{stage}/_whole", target)
    finally:
        fs.delete(_path(spark, stage)[1], True)


def save_file(df: DataFrame, base_dir: str, path: str, fmt: str = "csv", mode: str = "overwrite",
              single_file: bool = False, repartition: int | None = None, save_header_file: bool = False,
              header_sep: str = EXPORT_SEP, options: Mapping[str, Any] | None = None) -> str:
    """Write ``df`` to ``base_dir/path``.

    Array columns named ``*_att`` / ``*_set`` are rendered as text first.  File
    count: ``single_file`` -> one file, else ``repartition`` -> n files, else as
    planned (AQE-coalesced shuffle output).  For text formats a header file
    ``<path>_header`` can be written beside the data.

    A single text file (CSV, JSON lines or text, plain or gzip) is written as parts by
    all tasks, which are then joined in order; other formats have one writer.  CSV
    values are written so that they read back as they were (``CSV_VALUE_OPTIONS``,
    with ``multiLine`` on the read), unless ``options`` say otherwise.
    """
    out = auto_stringify(df)
    target = _target(base_dir, path)
    opts = {k: str(v) for k, v in (options or {}).items()}
    if fmt == "csv":
        opts = {**CSV_VALUE_OPTIONS, **opts}
    joins = fmt in ("csv", "json", "text") and opts.get("compression", "none") in ("none", "gzip")
    if single_file and joins:
        _save_joined(out, target, fmt, mode, opts)
        if save_header_file:
            save_header(out, f"{target}{HEADER_SUFFIX}", opts.get("sep", header_sep))
        return target
    if single_file:
        out = out.coalesce(1)
    elif repartition:
        out = out.repartition(int(repartition))
    out.write.format(fmt).options(**opts).mode(mode).save(target)
    if save_header_file and fmt not in ("parquet", "orc"):
        save_header(out, f"{target}{HEADER_SUFFIX}", opts.get("sep", header_sep))
    return target


def write_edges(edges: DataFrame, base_dir: str, name: str, partitions: int | None = None) -> dict[str, Any]:
    """Edge export: ``<name>_edges/`` parts (no header) + ``<name>_header`` file."""
    out = edge_header_names(auto_stringify(edges))
    if partitions:
        out = out.repartition(int(partitions))
    data = _target(base_dir, f"{name}{EDGES_SUFFIX}")
    rows = _write_counted(out, data)
    header = save_header(out, _target(base_dir, f"{name}{HEADER_SUFFIX}"))
    return {"kind": "relationship", "name": name, "data": data, "header": header, "row_count": rows}


def write_nodes(nodes: DataFrame, base_dir: str, labels: Sequence[str] | None = None,
                partitions: int | None = None, label_col: str = "Label",
                id_col: str = "NodeID") -> list[dict[str, Any]]:
    """Per-label node export: ``nodes/<Label>/`` parts + ``nodes/<Label>_header``.

    The nodes are stored once in the checkpoint folder; one profiling pass over
    the wanted labels (default: all) decides the columns of each label's file
    (all-NULL columns dropped); then one write per label reads the stored table.
    Nodes without a label belong to no file.
    """
    nodes = cut_lineage(nodes, "export-nodes")
    profile = label_profile(nodes, label_col, labels)
    written = []
    for label in (labels if labels is not None else sorted(profile)):
        table = nodes_for_label(nodes, label, label_col, id_col, keep_cols=profile.get(label, []))
        if partitions:
            table = table.repartition(int(partitions))
        data = _target(base_dir, f"nodes/{label}")
        rows = _write_counted(table, data)
        header = save_header(table, _target(base_dir, f"nodes/{label}{HEADER_SUFFIX}"))
        written.append({"kind": "node", "name": label, "data": data, "header": header, "row_count": rows})
    return written


def read_export(spark: SparkSession, entry: Mapping[str, Any]) -> DataFrame:
    """Read an exported part folder back, naming columns from its header file
    (all values as text, as the importer sees them)."""
    header = spark.read.text(entry["header"], wholetext=True).first()["value"]
    schema = ", ".join(f"`{c}` STRING" for c in header.split(EXPORT_SEP))
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(entry["data"])


@contextmanager
def staged_export(spark: SparkSession, base_dir: str) -> Iterator[str]:
    """A folder to write an export into.  What it holds at the end moves to ``base_dir``; after a failure it goes.

    The old manifest goes before the first move, so an importer that asks for the
    manifest never takes a half-written export, also if the driver is lost.
    """
    base = base_dir.rstrip("/")
    stage = f"{base}/_staging-{uuid.uuid4().hex[:12]}"
    fs, folder = _path(spark, stage)
    fs.mkdirs(folder)
    try:
        yield stage
        fs.delete(_path(spark, f"{base}/{MANIFEST}")[1], True)
        for f in sorted(str(x.getPath().getName()) for x in fs.listStatus(folder)):
            _move(spark, f"{stage}/{f}", f"{base}/{f}")
    finally:
        fs.delete(folder, True)


def write_manifest(spark: SparkSession, entries: Sequence[Mapping[str, Any]], base_dir: str) -> str:
    """Write the manifest of a finished export as one CSV file with a header line, put in place by a rename."""
    table = import_manifest(spark, entries, base_dir).coalesce(1)
    return save_file(table, base_dir, MANIFEST, single_file=True, options={"sep": EXPORT_SEP, "header": "true"})


def import_manifest(spark: SparkSession, entries: Sequence[Mapping[str, Any]], base_dir: str) -> DataFrame:
    """Manifest table: (kind, name, header_path, part_glob, row_count) per export.

    Paths are relative to ``base_dir``; row counts are those of the writes (records,
    which may hold line breaks), so nothing is read again.
    """
    root = base_dir.rstrip("/") + "/"
    rows = [(e["kind"], e["name"], e["header"].removeprefix(root), e["data"].removeprefix(root) + "/part-*", e["row_count"])
            for e in entries]
    return spark.createDataFrame(rows, "kind STRING, name STRING, header_path STRING, part_glob STRING, row_count BIGINT")
