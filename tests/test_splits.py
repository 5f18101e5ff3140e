"""Work follows the rows: splits that hold none, rows of a task."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from foehn.sources.splits import input_splits, spread, split_rows


@pytest.fixture
def conf(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_row_group_over_many_byte_ranges_is_spread(spark, conf, tmp_path):
    """One row group in as many byte ranges as there are cores: one holds all rows."""
    pq.write_table(pa.table({"id": list(range(20_000))}), tmp_path / "one.parquet")
    conf("spark.sql.files.maxPartitionBytes", "8k")
    conf("spark.sql.files.openCostInBytes", "1k")
    one = spark.read.parquet(str(tmp_path / "one.parquet"))
    assert input_splits(one) >= 4 and split_rows(one) == [20_000]
    out = spread(one, cores=4, min_bytes=1024)
    assert out.rdd.getNumPartitions() == 4
    assert sorted(r["id"] for r in out.collect()) == list(range(20_000))
    # rows of a task bound the partitions from below, whatever the cores
    assert spread(one, cores=1, max_rows=3000).rdd.getNumPartitions() == 7
    many = spark.range(0, 1000, numPartitions=4)
    assert spread(many, cores=4, max_rows=250) is many
    assert spread(many, cores=4, max_rows=200).rdd.getNumPartitions() == 5
    empty = spark.range(0, 0, numPartitions=1)
    assert spread(empty, cores=4).count() == 0
