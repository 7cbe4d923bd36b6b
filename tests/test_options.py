import pytest

from shardscan.options import INT_MIN, ScanOptions, redact, split_urls

BASE = {"url": "jdbc:derby:memory:a", "table-name": "T.*", "schema-name": "APP",
        "scan.partition.column": "id"}


def opts(**kw):
    m = dict(BASE)
    m.update({k.replace("_", "."): v for k, v in kw.items()})
    return m


def test_minimal_batch_and_partitions():
    o = ScanOptions.from_map(BASE, **{"scan.batch.size": "100"})
    assert o.batch_size == 100 and o.partition_num is None
    o = ScanOptions.from_map(BASE, partition_num=4)
    assert o.partition_num == 4


@pytest.mark.parametrize("extra", [
    {},                                                      # neither
    {"scan.batch.size": 1, "scan.partition.num": 1},         # both
    {"scan.batch.size": 0},
    {"scan.batch.size": -3},
    {"scan.partition.num": 0},
    {"scan.partition.num": -1},
    {"scan.batch.size": "x"},
    {"scan.batch.size": 1, "scan.fetch-size": -5},
    {"scan.batch.size": 1, "scan.lower-bound": 5},
    {"scan.batch.size": 1, "scan.lower-bound": 5, "scan.upper-bound": 4},
    {"scan.batch.size": 1, "scan.null-key": "maybe"},
    {"scan.batch.size": 1, "no.such.option": 1},
    {"scan.batch.size": 1, "scan.max-splits": 0},
    {"scan.batch.size": 1, "scan.conditions": "=x"},
])
def test_invalid(extra):
    m = dict(BASE)
    m.update(extra)
    with pytest.raises(ValueError):
        ScanOptions.from_map(m)


def test_missing_required():
    for k in ("url", "table-name", "schema-name", "scan.partition.column"):
        m = dict(BASE, **{"scan.batch.size": 1})
        del m[k]
        with pytest.raises(ValueError):
            ScanOptions.from_map(m)


def test_fetch_size_sentinel_and_props():
    o = ScanOptions.from_map(BASE, **{"scan.batch.size": 1, "scan.fetch-size": INT_MIN,
                                      "username": "u", "password": "s3cret"})
    p = o.jdbc_properties("drv")
    assert p == {"driver": "drv", "user": "u", "password": "s3cret", "fetchsize": str(INT_MIN)}
    assert "s3cret" not in repr(o) and "s3cret" not in str(o)


def test_url_list_forms():
    assert split_urls("a;b; ;c") == ("a", "b", "c")
    assert split_urls(["jdbc:derby:memory:x;create=true"]) == ("jdbc:derby:memory:x;create=true",)
    with pytest.raises(ValueError):
        split_urls(" ; ")


def test_redact():
    assert "pw" not in redact("jdbc:mysql://h/db?user=u&password=pw")
    assert "pw" not in redact("jdbc:derby:memory:x;user=u;password=pw")
    assert "pw" not in redact("postgresql://u:pw@host/db")
    assert redact("jdbc:derby:memory:x") == "jdbc:derby:memory:x"


def test_salt_options():
    o = ScanOptions.from_map(BASE, **{"scan.batch.size": 1, "scan.salt.column": "s", "scan.salt.buckets": 3})
    assert o.buckets == [0, 1, 2]
    assert ScanOptions.from_map(BASE, **{"scan.batch.size": 1}).buckets == [None]
    for bad in ({"scan.salt.column": "s"}, {"scan.salt.buckets": 2}, {"scan.salt.column": "s", "scan.salt.buckets": 0}):
        with pytest.raises(ValueError):
            ScanOptions.from_map(BASE, **{"scan.batch.size": 1, **bad})


def test_max_parallel_reads_option():
    assert ScanOptions.from_map(BASE, **{"scan.batch.size": 1, "scan.max-parallel-reads": 8}).max_parallel_reads == 8
    with pytest.raises(ValueError):
        ScanOptions.from_map(BASE, **{"scan.batch.size": 1, "scan.max-parallel-reads": 0})
