"""Readers, writers, catalog and JDBC options."""

import glob
import uuid

import pytest
from pyspark.sql.classic.dataframe import DataFrame as Classic

from carepulse.session import shared_dir
from carepulse.sources import files, jdbc, tables
from helpers import plan_of, rows


@pytest.fixture
def db():
    return f"db_{uuid.uuid4().hex[:8]}"


def parts(path):
    return glob.glob(f"{path}/*.parquet")


@pytest.mark.parametrize("n_rows,asked,written", [(1000, 5, 5), (3, 5, 1), (10, 1, 1)])
def test_number_of_part_files(spark, tmp_path, n_rows, asked, written):
    path = str(tmp_path / "out")
    files.write_parquet_files(spark.range(n_rows), path, asked)
    assert len(parts(path)) == written and spark.read.parquet(path).count() == n_rows


def test_part_files_are_runs_of_the_input(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_parquet_files(spark.range(0, 103, 1, 7), path, 4)
    runs = sorted([r["id"] for r in spark.read.parquet(f).collect()] for f in parts(path))
    assert runs == [list(range(a, min(a + 26, 103))) for a in range(0, 103, 26)]
    files.write_parquet_files(spark.read.parquet(path).where("id < 10"), path, 2)
    assert spark.read.parquet(path).count() == 10


def test_scan_reads_matching_names_only(spark, tmp_path):
    files.write_parquet_files(spark.range(4), str(tmp_path / "d"), 1)
    (tmp_path / "d" / "readme.txt").write_text("not a table")
    assert files.scan_parquet(spark, str(tmp_path / "d"), "id long").count() == 4


def test_replace_reads_itself_and_keeps_comment(spark, db, tmp_path):
    root = str(tmp_path)
    first = tables.replace_table(spark.range(5).selectExpr("id", "id % 2 AS k"), db, "t", root, "it's \\ here", ["k"])
    assert first.columns == ["id", "k"] and tables.get_comment(spark, db, "t") == "it's \\ here"
    again = tables.replace_table(first.where("id > 2"), db, "t", root)
    assert rows(again, "id") == [(3,), (4,)]
    assert rows(tables.scan_table(spark, db, "t"), "id") == [(3,), (4,)]
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["t"]


def test_a_failed_replace_leaves_the_old_table(spark, db, tmp_path):
    tables.replace_table(spark.range(3), db, "t", str(tmp_path))
    with pytest.raises(Exception):
        tables.replace_table(spark.range(3).selectExpr("id", "raise_error('stop') AS x"), db, "t", str(tmp_path))
    assert tables.scan_table(spark, db, "t").count() == 3


def test_schema_change_can_be_refused(spark, db, tmp_path):
    tables.replace_table(spark.range(3), db, "t", str(tmp_path))
    with pytest.raises(ValueError):
        tables.replace_table(spark.range(3).selectExpr("id AS other"), db, "t", str(tmp_path), allow_schema_change=False)
    assert tables.replace_table(spark.range(3).selectExpr("id AS other"), db, "t", str(tmp_path)).columns == ["other"]


def test_bucketed_tables_join_without_a_shuffle(spark, db, tmp_path):
    saved = [
        tables.replace_table(spark.range(1000).selectExpr("id", f"id AS v{i}"), db, f"t{i}", str(tmp_path), bucket_by=(4, ["id"]))
        for i in range(2)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = saved[0].join(saved[1], "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_names_and_audits(spark, db, tmp_path):
    assert tables.raw_name("x") == tables.raw_name("raw_x") == "raw_x"
    assert tables.missing_tables(spark, db, ["a"]) == ["a"]
    spark.range(1).createOrReplaceTempView("b")
    tables.replace_table(spark.range(3), db, "raw_a", str(tmp_path))
    assert tables.missing_tables(spark, db, ["raw_a", "b"]) == ["b"]
    assert rows(tables.row_counts({"a": tables.scan_table(spark, db, "a", raw=True), "e": spark.range(0)})) == [("a", 3), ("e", 0)]


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class FakeSession:
    def __init__(self, master, conf=None, folder=None):
        self.conf, self.sparkContext = conf or {}, FakeContext(master, folder)


def test_shared_folder_comes_from_the_session():
    named = FakeSession("yarn", {"spark.checkpoint.dir": "s3://b/ckpt"})
    one, two = shared_dir(named, "x"), shared_dir(named, "x")
    assert one.startswith("s3://b/ckpt/x-") and one != two
    assert shared_dir(FakeSession("yarn", folder="hdfs:///c"), "x").startswith("hdfs:///c/x-")
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("yarn"), "x")


def test_parameters_are_not_spliced(spark):
    spark.range(3).createOrReplaceTempView("numbers_v")
    got = tables.run_sql(spark, "SELECT :text AS x, count(*) AS n FROM IDENTIFIER(:t) WHERE id >= :lo", {"t": "numbers_v", "lo": 1, "text": "'; DROP"})
    assert rows(got) == [("'; DROP", 2)]


def test_jdbc_options():
    split = jdbc.Partitioning("id", "0", "1000", 8)
    options = jdbc.jdbc_options("jdbc:x", "sales.t", split, extra={"user": "u"})
    assert options["dbtable"] == "sales.t" and options["numPartitions"] == "8" and options["user"] == "u"
    assert options["pushDownPredicate"] == "true" and "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "t")


def test_part_files_are_written_without_sort_or_shuffle_of_rows(spark, tmp_path):
    """Runs over many partitions, some empty and one large, of odd column types; the writer holds no rows."""
    df = spark.range(0, 4000, 1, 9).where("id < 100 OR id >= 1500").selectExpr("id", "array(id) AS many", "IF(id % 7 = 0, NULL, concat('n', id)) AS name")
    for asked in (1, 3, 50):
        path = str(tmp_path / f"out{asked}")
        files.write_parquet_files(df, path, asked)
        size = -(-2600 // asked)
        runs = [[tuple(r) for r in spark.read.parquet(f).collect()] for f in parts(path)]
        assert sorted(map(len, runs), reverse=True) == [min(size, 2600 - a) for a in range(0, 2600, size)]
        assert [r for run in sorted(runs) for r in run] == [tuple(r) for r in df.collect()]
    empty = str(tmp_path / "empty")
    files.write_parquet_files(df.where("id < 0"), empty, 3)
    assert len(parts(empty)) == 1 and spark.read.parquet(empty).count() == 0
    plans = written_plans(lambda: files.write_parquet_files(df, str(tmp_path / "last"), 3))
    assert plans and "Exchange" not in plans[-1] and "Sort" not in plans[-1]


def written_plans(action):
    """Plans of the Parquet writes that happen in ``action``, in order."""
    plans, before = [], Classic.write
    Classic.write = property(lambda df: plans.append(plan_of(df)) or before.fget(df))
    try:
        action()
    finally:
        Classic.write = before
    return plans
