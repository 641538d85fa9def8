from kiln.operators import partition_profile, partition_rows, preview, schema_table
from kiln.session import ensure_checkpoint_dir
from kiln.sources import limit_rows
from tests.conftest import rows


def test_schema_table(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id INT, name STRING, v DOUBLE")
    assert rows(schema_table(df)) == [("id", "int", True), ("name", "string", True), ("v", "double", True)]


def test_partition_profile_and_rows(spark):
    df = spark.range(100).repartition(4)
    prof = rows(partition_profile(df))
    assert len(prof) == 4 and sum(n for _, n in prof) == 100
    p1 = partition_rows(df, 1)
    assert p1.count() == dict(prof)[1] and set(r.pid for r in p1.collect()) == {1}


def test_preview_and_limit_rows(spark):
    df = spark.range(50)
    assert preview(df, 7).count() == 7
    assert [r.id for r in limit_rows(df.repartition(3), 3, order_by="id").collect()] == [0, 1, 2]


def test_checkpoint_dir_is_kept_when_set(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current and ensure_checkpoint_dir(spark) == current
