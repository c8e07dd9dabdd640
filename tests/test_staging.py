import subprocess
import sys

import pytest

from adtrail import session
from adtrail.sinks import jdbc
from adtrail.staging import Staging, release_session, session_scope

ROOT = __file__.rsplit("/", 2)[0]


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    """A session without a shared folder on this master."""

    def __init__(self, master):
        self.conf = _Conf()
        self.sparkContext = type("C", (), {"master": master, "getCheckpointDir": staticmethod(lambda: None)})()


def test_no_shared_folder_is_an_error_off_local_masters():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(_Session(master))
    assert session.shared_dir(_Session("local[2]"), "x") == session.shared_dir(_Session("local"), "x")


def test_queries_run_on_an_unconfigured_local_session(tmp_path):
    code = """
import sys; sys.path.insert(0, %r)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
s.conf.unset("spark.checkpoint.dir") if s.conf.get("spark.checkpoint.dir", None) and s.conf.isModifiable("spark.checkpoint.dir") else None
import __spark_entry__ as E
print("rows", E.queries()["cycle_ip"](s, "/root/testdata/sf0.001").count())
""" % ROOT
    conf = tmp_path / "conf"
    conf.mkdir()
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         env={**__import__("os").environ, "SPARK_CONF_DIR": str(conf)})
    assert "rows" in out.stdout, out.stderr[-2000:]


def test_scopes_release_only_their_own(spark):
    a, b = Staging(spark), Staging(spark)
    x, y = a.table(spark.range(3), "x"), b.table(spark.range(4), "y")
    assert a.release() == 1 and y.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(x.inputFiles()[0]).count()
    assert b.release() == 1


def test_session_scopes_are_released_together(spark):
    release_session()
    session_scope(spark).table(spark.range(2), "q")
    assert release_session() == 1 and release_session() == 0


def test_export_writes_incoming_before_the_target_changes(spark):
    log = []
    rows = spark.createDataFrame([(1, "a")], "id int, name string")
    write = lambda df, table: log.append(("write", table, df.count()))
    done = jdbc.export_tables(spark, lambda t: rows, ["ads", "hosts"], write, lambda sql: log.append(("run", sql)))
    assert done == ["ads", "hosts"]
    assert log == [("write", "ads__staging", 1), ("run", "REPLACE INTO ads (id, name) SELECT id, name FROM ads__staging"),
                   ("write", "hosts__staging", 1), ("run", "REPLACE INTO hosts (id, name) SELECT id, name FROM hosts__staging")]

    def fail(df, table):
        raise OSError("connection lost")

    with pytest.raises(OSError):
        jdbc.export_replace(rows, "ads", fail, lambda sql: log.append("changed"))
    assert "changed" not in log


def test_a_table_can_go_before_its_scope(spark):
    from adtrail.staging import Staging

    with Staging(spark) as scope:
        scope.table(spark.range(3), "one")
        first = scope.paths[-1]
        kept = scope.table(spark.range(5), "two")
        scope.drop(first)
        assert first not in scope.paths and kept.count() == 5 and scope.release() == 1
