"""A writer that dies at any step leaves readers a whole version."""

import pytest
from pyspark.sql import functions as F

from cadastra.plans import versions
from cadastra.plans.versions import RunLedger, VersionedWarehouse
from cadastra.plans.warehouse import Warehouse
from cadastra.shared import scratch_path
from tests.conftest import rows


def numbers(warehouse):
    return sorted(r["n"] for r in warehouse.read("t").collect())


@pytest.fixture
def warehouse(spark):
    made = VersionedWarehouse(spark, scratch_path(spark, "versions"))
    made.publish("t", spark.range(3).toDF("n"))
    return made


def failing(df):
    return df.withColumn("n", F.expr("IF(n = 4, raise_error('killed'), n)").cast("bigint"))


def test_a_write_that_fails_leaves_the_version_before(spark, warehouse):
    with pytest.raises(Exception, match="killed"):
        warehouse.publish("t", failing(spark.range(6).toDF("n")))
    assert numbers(warehouse) == [0, 1, 2]
    assert warehouse.publish("t", spark.range(5).toDF("n")) == 5
    assert numbers(warehouse) == [0, 1, 2, 3, 4] and len(warehouse.versions("t")) == 2


def test_a_writer_killed_before_or_after_the_marker(spark, warehouse, monkeypatch):
    commit = VersionedWarehouse._commit

    def before(self, name, version):
        raise KeyboardInterrupt

    def after(self, name, version):
        commit(self, name, version)
        raise KeyboardInterrupt

    for dies, expected in ((before, [0, 1, 2]), (after, [7])):
        monkeypatch.setattr(VersionedWarehouse, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            warehouse.publish("t", spark.range(7, 8).toDF("n"))
        assert numbers(warehouse) == expected


def test_collecting_may_stop_at_any_step(spark, warehouse, monkeypatch):
    for n in (4, 5, 6):
        warehouse.publish("t", spark.range(n).toDF("n"))
    for allowed in range(6):
        left = [allowed]

        def remove(session, path, left=left, real=versions.remove_path):
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            real(session, path)

        with monkeypatch.context() as patched:
            patched.setattr(versions, "remove_path", remove)
            try:
                warehouse.collect("t", keep=2)
            except KeyboardInterrupt:
                pass
        assert numbers(warehouse) == list(range(6))
        for version in warehouse.versions("t"):
            assert spark.read.parquet(f"{warehouse._table('t')}/data/{version}").count() > 0
    assert len(warehouse.versions("t")) == 2 and warehouse.collect("t") == 0


def test_a_table_may_be_rewritten_from_itself(warehouse):
    assert warehouse.replace("t", warehouse.read("t").filter("n > 0")) == 2
    assert numbers(warehouse) == [1, 2]


def test_no_version_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        VersionedWarehouse(spark, scratch_path(spark, "none")).read("t")


def test_a_failed_publish_keeps_the_plain_table(spark):
    plain = Warehouse(spark, scratch_path(spark, "plain"))
    plain.publish("t", spark.range(3).toDF("n"))
    with pytest.raises(Exception, match="killed"):
        plain.publish("t", failing(spark.range(6).toDF("n")))
    assert numbers(plain) == [0, 1, 2]


def test_a_run_is_recorded_once(spark, monkeypatch):
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    assert ledger.history().count() == 0
    audit = spark.createDataFrame([("a", 3, 5, 0.5)], "table_name string, kept_rows bigint, raw_rows bigint, seconds double")
    with monkeypatch.context() as patched:
        patched.setattr(versions, "_mark", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            ledger.record("one", audit)
    assert ledger.history().count() == 0
    assert [ledger.record(run, audit) for run in ("one", "two", "one")] == [True, True, False]
    assert rows(ledger.history().select("run_id", "rejected_rows")) == [("one", 2), ("two", 2)]
    with pytest.raises(ValueError):
        ledger.record("a/b", audit)
