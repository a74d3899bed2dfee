from types import SimpleNamespace

import pytest

from feedlens.session import (Measured, lookup_join, materialize, measured, scratch_path,
                              shared_dir)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_an_error():
    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master,
                                                                     applicationId="test"))

    assert shared_dir(session("local[2]")) == shared_dir(session("local"))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError, match="shared folder"):
            shared_dir(session(master))


def test_sizes(spark):
    rows = spark.createDataFrame([("abc", [1, 2], 5), (None, None, None)],
                                 "s STRING, a ARRAY<BIGINT>, n INT")
    size = measured(rows)
    assert size.bytes == (11 + 40 + 8) + (8 + 8 + 8)
    stored = materialize(rows, "sizes")
    assert stored.bytes == size.bytes and stored.table.count() == 2
    assert measured(stored) is stored
    assert stored.fits(83) and not stored.fits(82)
    assert measured(rows.limit(0)).bytes == 0


def test_lookup_is_broadcast_by_its_measured_size(spark):
    rows = spark.range(10)
    table = spark.range(5)
    for size, hinted in ((10, True), (100, False)):
        joined = lookup_join(rows, Measured(table, size), ["id"], limit=50)
        plan = joined._jdf.queryExecution().analyzed().toString()
        assert ("broadcast" in plan) == hinted
        assert joined.count() == 5
