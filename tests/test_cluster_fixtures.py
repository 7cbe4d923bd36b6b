"""Fixtures on a cluster: only the checkpoint folder is shared between driver and executors."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import shard_fixtures as FX
from shardscan.session import is_local


def session(master, checkpoint=None, fixtures=None):
    conf = {"spark.master": master, "spark.checkpoint.dir": checkpoint, "spark.shardscan.fixtureDir": fixtures}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key) or default),
                           sparkContext=SimpleNamespace(applicationId="app-of-this-test", getCheckpointDir=lambda: checkpoint))


def test_local_cluster_is_a_cluster():
    assert [is_local(session(m)) for m in ("local", "local[*]", "local[4,2]")] == [True] * 3
    assert [is_local(session(m)) for m in ("local-cluster[3,2,3000]", "spark://h:7077", "yarn", "")] == [False] * 4


def test_files_lie_below_the_shared_folder():
    root = FX.fixture_root
    assert root(session("local-cluster[3,2,3000]", "file:/shared/app%201")) == "/shared/app 1/shardscan-fixtures"
    assert root(session("yarn", "/shared/x")) == "/shared/x/shardscan-fixtures"
    assert root(session("yarn", "hdfs://n/x", "/mnt/f")) == "/mnt/f"
    with pytest.raises(RuntimeError, match="fixtureDir"):
        root(session("yarn", "hdfs://n/x"))


@pytest.mark.parametrize("query, table, columns", [
    ("q25_flat_backend", "customer", "id c_custkey, 'n' c_name, 1 c_nationkey, 1.5D c_acctbal, 's' c_mktsegment"),
    ("q30_flat_backend_orders", "orders", "id o_orderkey, id o_custkey, 'F' o_orderstatus, 1.5D o_totalprice, "
                                          "timestamp'2020-01-01' o_orderdate, '1' o_orderpriority")])
def test_folders_of_one_name_keep_their_own_rows(spark, tmp_path, query, table, columns):
    for parent, n in (("a", 5), ("b", 9)):
        folder = f"{tmp_path}/{parent}/same_name"
        made = spark.range(n).selectExpr(*columns.split(", "))
        made.write.parquet(f"{folder}/{table}.parquet")
        assert sorted(getattr(entry, query)(spark, folder).collect()) == sorted(made.collect())


def test_derby_archives_hold_every_value(spark, tmp_path, monkeypatch):
    """NULL, empty and odd texts, a server and a shard without rows, a row in two shards, a wide key and instants."""
    monkeypatch.setattr(FX, "fixture_root", lambda _: str(tmp_path))
    df = spark.sql(
        "SELECT * FROM VALUES (1L, '', 1.5D, 9223372036854775818BD, timestamp'2020-03-08 02:30:00.123456', true), "
        "(2L, null, null, null, null, null), (2L, 'a \"b\", ''c''\\n\\\\ é ', -1e-300D, 3BD, timestamp'1969-12-31 23:59:59', false), "
        "(null, 'x', 0.1D, 4BD, timestamp'2020-11-01 01:30:00', true) AS t(id, s, d, wide, ts, b)"
    ).withColumn("wide", F.col("wide").cast("decimal(20,0)"))
    shards = [FX.ShardSpec(0, "APP", "T_0", F.lit(True)), FX.ShardSpec(0, "EU_1", "T_1", F.col("id") == 2),
              FX.ShardSpec(0, "APP", "T_2", F.lit(False)), FX.ShardSpec(1, "APP", "T_0", F.lit(False))]
    urls = FX._load_archives(spark, "odd", df, shards, 3, df.columns, 64, "id")

    def read(server, table):
        return spark.read.jdbc(urls[server], table, properties={"driver": FX.DERBY_DRIVER})
    assert read(0, "APP.T_0").dtypes == df.dtypes
    for server, table, wanted in ((0, "APP.T_0", df), (0, "EU_1.T_1", df.where("id = 2")), (0, "APP.T_2", df.limit(0)),
                                  (1, "APP.T_0", df.limit(0)), (2, "SYSIBM.SYSDUMMY1", None)):
        got = read(server, table)
        assert got.count() == (1 if wanted is None else wanted.count())
        if wanted is not None:
            assert got.exceptAll(wanted).count() == 0


def test_derby_archive_that_fails_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FX, "fixture_root", lambda _: str(tmp_path))
    df = spark.sql("SELECT 1L AS id, 'longer than the column' AS s")
    with pytest.raises(Exception, match="did not build"):
        FX._load_archives(spark, "long", df, [FX.ShardSpec(0, "APP", "T", F.lit(True))], 1, df.columns, 5, None)


CLUSTER_RUN = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__ as entry
folder, shared = sys.argv[1:]
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.executor.memory", "700m").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", f"{shared}/wh").getOrCreate())
orders = spark.range(40).selectExpr(
    "id o_orderkey", "id % 3 o_custkey", "'F' o_orderstatus", "id / 4D o_totalprice",
    "timestamp'2020-01-01' + make_interval(0, 0, 0, int(id)) o_orderdate", "'1' o_orderpriority")
orders.write.parquet(f"{folder}/orders.parquet")
spark.range(70).selectExpr("id event_id", "'a' event_type").write.parquet(f"{folder}/events.parquet")
for query, wanted in (("q01_scan_bag", orders), ("q31_hot_key_salted", orders),
                      ("q27_many_shards", spark.read.parquet(f"{folder}/events.parquet"))):
    got = getattr(entry, query)(spark, folder)
    assert got.exceptAll(wanted).count() == 0 and got.count() == wanted.count(), query
counts = entry.q32_split_rows_in_db(spark, folder).groupBy().sum("n_rows").first()[0]
assert counts == 40, counts
spark.stop()
"""


def test_derby_queries_on_a_cluster(tmp_path):
    """Executors are processes of their own: they see only what lies in the shared folder."""
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"}
    env["PYTHONPATH"] = os.path.dirname(os.path.abspath(FX.__file__))
    done = subprocess.run([sys.executable, "-c", CLUSTER_RUN, str(tmp_path / "data"), str(tmp_path / "shared")],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
