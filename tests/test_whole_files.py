"""A broken input is left out whole, the others go on."""

import gzip
import json
import os

import pytest

from linkgraph.sources import readers as S
from tests.conftest import rows


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def parquet_bytes(spark, tmp_path, df):
    folder = tmp_path / f"p{len(os.listdir(tmp_path))}"
    df.coalesce(1).write.parquet(f"file://{folder}")
    return next(f for f in folder.iterdir() if f.name.startswith("part-")).read_bytes()


def test_parquet(spark, tmp_path):
    good = parquet_bytes(spark, tmp_path, spark.range(20_000).selectExpr("id", "CAST(id AS STRING) AS v"))
    other = parquet_bytes(spark, tmp_path, spark.range(5).selectExpr("CAST(id AS STRING) AS id", "'x' AS v"))
    less = parquet_bytes(spark, tmp_path, spark.range(5))
    small = parquet_bytes(spark, tmp_path, spark.createDataFrame([(7, "seven")], "id int, v string"))
    d = tmp_path / "in"
    put(d / "a b.parquet", good)
    put(d / "cut.parquet", good[:len(good) // 2])
    put(d / "page.parquet", good[:200] + bytes(600) + good[800:])  # the footer is whole, a page is not
    put(d / "text.parquet", b"not a table")
    put(d / "empty.parquet", b"")
    put(d / "types.parquet", other)
    put(d / "columns.parquet", less)
    put(d / "small.parquet", small)
    got, bad = S.read_whole_files(spark, f"file://{d}", "id BIGINT, v STRING")
    assert got.columns == ["id", "v"] and got.count() == 20_001 and got.where("v = 'seven'").first().id == 7
    told = {r.file.rsplit("/", 1)[-1]: r.reason for r in bad.collect()}
    assert set(told) == {"cut.parquet", "page.parquet", "text.parquet", "types.parquet", "columns.parquet"}
    assert told["types.parquet"] == "schema: id is string" and told["columns.parquet"] == "schema: no column v"
    assert all(told[f].startswith("unreadable: ") for f in ("cut.parquet", "page.parquet", "text.parquet"))


@pytest.mark.parametrize("fmt", ["csv", "json", "text"])
def test_gzip(spark, tmp_path, fmt):
    line = {"csv": lambda i: f"{i},n{i}", "json": lambda i: json.dumps({"id": i, "v": f"n{i}"}), "text": lambda i: f"n{i}"}[fmt]
    head = "id,v\n" if fmt == "csv" else ""

    def packed(ids):
        return gzip.compress((head + "\n".join(map(line, ids)) + "\n").encode())

    put(tmp_path / "good.gz", packed(range(30_000)))
    put(tmp_path / "two.gz", packed(range(30_000, 30_010)) + (gzip.compress((line(9) + "\n").encode())))
    put(tmp_path / "cut.gz", packed(range(50_000))[:-20_000])
    put(tmp_path / "tail.gz", packed(range(50))[:-4])
    put(tmp_path / "broken.gz", packed(range(50_000))[:9000] + b"\x00" * 500 + packed(range(50_000))[9500:])
    put(tmp_path / "plain", (head + line(77) + "\n").encode())
    bad = {"cut.gz", "tail.gz", "broken.gz"}
    if fmt == "csv":
        put(tmp_path / "names.gz", gzip.compress(b"id,w\n1,x\n"))
        bad.add("names.gz")
    got, rejects = S.read_whole_files(spark, f"file://{tmp_path}", None if fmt == "text" else "id BIGINT, v STRING", fmt,
                                      {"header": "true"} if fmt == "csv" else None)
    assert got.count() == 30_012
    assert {r.file.rsplit("/", 1)[-1] for r in rejects.collect()} == bad


def test_all_whole_and_none(spark, tmp_path):
    spark.range(10).write.parquet(f"file://{tmp_path}/x")
    got, rejects = S.read_whole_files(spark, f"file://{tmp_path}/x")
    assert rows(got) == sorted([(i,) for i in range(10)], key=str) and rejects.count() == 0
    put(tmp_path / "y" / "z.parquet", b"PAR1")
    got, rejects = S.read_whole_files(spark, f"file://{tmp_path}/y", "id BIGINT")
    assert got.count() == 0 and rejects.count() == 1
