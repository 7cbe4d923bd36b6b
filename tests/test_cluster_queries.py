"""Queries of FINDINGS_r03 on executors that are processes of their own, held against their SQL."""

import importlib.util
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

QUERIES = {
    "F3": "q03_table_regex",
    "F4": "q04_schema_regex",
    "F5": "q05_declared_projection",
    "F6": "q06_partition_num",
    "F7": "q07_empty_shard",
    "F8": "q08_null_key_dropped",
    "F9": "q09_null_key_kept",
    "F10": "q10_explicit_bounds",
    "F11": "q11_equality_condition",
    "F12": "q12_query_source",
    "F13": "q13_shard_stats",
    "F14": "q20_scan_report",
    "F15": "q21_provenance",
    "F16": "q22_filter_over_view",
    "F17": "q23_group_over_view",
    "F22": "q30_flat_backend_orders",
}

CLUSTER_RUN = """
import json, sys
import duckdb
from pyspark.sql import SparkSession
import __spark_entry__ as entry
from oracle import compare
folder, shared, *names = sys.argv[1:]
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.executor.memory", "700m").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}")
         .config("spark.sql.warehouse.dir", f"{shared}/wh").getOrCreate())
spark.range(5000).selectExpr(
    "id + id div 7 o_orderkey", "id % 31 o_custkey", "substr('FOP', cast(id % 3 as int) + 1, 1) o_orderstatus",
    "id * 80.25D o_totalprice", "timestamp'2020-01-01' + make_interval(0, 0, 0, int(id)) o_orderdate",
    "'1' o_orderpriority").write.parquet(f"{folder}/orders.parquet")
spark.range(70).selectExpr("id s_suppkey", "concat('s', id) s_name", "id % 5 s_nationkey").write.parquet(
    f"{folder}/supplier.parquet")
con = duckdb.connect()
for t in ("orders", "supplier"):
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
found = {}
for name in names:
    try:
        found[name] = compare(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name])
    except Exception as e:
        found[name] = False, str(e)[:500]
with open(f"{folder}/found.json", "w") as f:
    json.dump(found, f)
spark.stop()
"""


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    at = tmp_path_factory.mktemp("cluster")
    home = at / "home"  # executors write their logs to Spark's home
    (home / "work").mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    (at / ".tmp").mkdir()  # TMPDIR below: temp folders of the driver, unseen by the executors
    tests = os.path.dirname(os.path.abspath(__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"}
    env |= {"PYTHONPATH": f"{os.path.dirname(tests)}:{tests}", "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13",
            "TMPDIR": "/proc/self/cwd/.tmp", "TZ": "UTC"}
    done = subprocess.run([sys.executable, "-c", CLUSTER_RUN, str(at / "data"), str(at / "shared"), *QUERIES.values()],
                          cwd=at, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return json.loads((at / "data" / "found.json").read_text())


@pytest.mark.parametrize("finding", QUERIES)
def test_query_on_a_cluster(found, finding):
    ok, message = found[QUERIES[finding]]
    assert ok, message
    assert not message.startswith("0 rows")
