"""CSV trees whose files have headers of their own, and timed writes."""

from strataforge.sources import io

KEYS = {"area": r"/area-(\d+)/"}


def put(root, name, text, mark=""):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((mark + text).encode())


def test_cells_follow_each_files_header(spark, tmp_path):
    put(tmp_path, "area-1/a.csv", "id, name ,age\n1,Ann,30\n2,,31\n", "﻿")
    put(tmp_path, "area-1/b.csv", 'age,id\n40,3\n')
    put(tmp_path, "area-2/c.csv", 'note,"name",id,extra,id\n"x, y","Bo, Jr",4,z,99\n')
    put(tmp_path, "area-2/empty.csv", "")
    put(tmp_path, "area-2/only.csv", "id,name\n")
    put(tmp_path, "other/d.csv", "id\n5\n")
    got = sorted(tuple(r) for r in io.read_csv_tree(spark, f"{tmp_path}/*/*.csv", ["id", "name", "age"], KEYS).collect())
    assert got == [("1", "Ann", "30", "1"), ("2", None, "31", "1"), ("3", None, "40", "1"), ("4", "Bo, Jr", None, "2"), ("5", None, None, None)]


def test_files_of_many_blocks_keep_their_header(spark, tmp_path):
    put(tmp_path, "area-7/big.csv", "b,a\n" + "".join(f"{k},{-k}\n" for k in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = io.read_csv_tree(spark, f"{tmp_path}/*/*.csv", ["a", "b"], KEYS)
        assert rows.count() == 30_000 and rows.where("cast(a AS int) + cast(b AS int) <> 0 OR area <> '7'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_timed_write(spark, tmp_path):
    run = io.timed_write(spark.range(1000).selectExpr("id", "id % 3 AS g"), str(tmp_path / "t"), ["g"]).first()
    assert (run.rows, run.g_seen) == (1000, 3) and run.elapsed > 0 and abs(run.rate * run.elapsed - 1000) < 1e-6
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
