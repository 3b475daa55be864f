"""Landing files and landed rows made from the given tables."""

from __future__ import annotations

import glob
import gzip
import hashlib

from pyspark.sql import functions as F

from celluloid.adapters import films, queries
from celluloid.adapters.shapes import ARRIVAL, dealt
from celluloid.session import own_scratch


def one_file(df, path):
    df.coalesce(1).write.parquet(str(path))


def test_dealt_rows_keep_their_order_in_many_tasks(spark, tmp_path):
    keys = [(k * 37) % 1000 for k in range(1000)] + [None, 5, 5]
    one_file(spark.createDataFrame([(k,) for k in keys], "k long"), tmp_path / "t")
    rows = dealt(spark.read.parquet(str(tmp_path / "t")))
    assert [r["k"] for r in rows.collect()] == keys
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_a_dump_lands_in_many_files(spark, tmp_path):
    own_scratch(spark)
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    one_file(spark.createDataFrame([(k, f"n{k}", "b", "t", k % 50, 1.0) for k in range(600)], columns), tmp_path / "part.parquet")
    one_file(spark.createDataFrame([(k, f"s{k}", k % 25) for k in range(100)], "s_suppkey long, s_name string, s_nationkey int"), tmp_path / "supplier.parquet")
    one_file(spark.createDataFrame([(k, f"n{k}", k % 5) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int"), tmp_path / "nation.parquet")
    for lines in (films.dump_lines(spark, str(tmp_path)), films.odd_dump_lines(spark, str(tmp_path))):
        files = sorted(glob.glob(f"{films.land_lines(lines, 'dump')}/part-*.gz"))
        told = [sum(b"Q1" in line or b"Q4" in line for line in gzip.open(f)) for f in files]
        assert sum(told) == 600 and max(told) < 300


def test_a_file_for_each_key_with_its_lines_in_order(spark, tmp_path):
    own_scratch(spark)
    rows = [(k, f"s{k}", k % 25) for k in range(200)] + [(7, "again", 1), (None, "none", 2)]
    one_file(spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int"), tmp_path / "supplier.parquet")
    got = {r["s_suppkey"]: r for r in queries.artifact_manifest(spark, str(tmp_path)).collect()}
    assert len(got) == 201
    for key, text in ((7, "7|s7|7\n7|again|1\n"), (8, "8|s8|8\n"), (None, "none|2\n")):
        assert got[key]["sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[key]["byte_len"] == len(text)


def test_landed_rows_are_numbered_by_arrival_and_keep_what_is_asked_for(spark, tmp_path):
    own_scratch(spark)
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate string, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    rows = [((k * 7) % 50, k, k % 9, k % 4, float(k), "1997-01-01", 1.0, 0.0, 0.0, "N", "O") for k in range(200)]
    one_file(spark.createDataFrame(rows, columns), tmp_path / "lineitem.parquet")
    got = films.landed(spark, str(tmp_path), "credits_raw")
    assert set(films.LANDED) == {c for c in got.columns if c in ARRIVAL}
    wanted = [f"tt{r[1]:010d}" for r in sorted(rows, key=lambda r: (r[0], r[3], r[4]))]
    assert [r["imdb_id"] for r in got.orderBy("_arrival").collect()] == wanted
