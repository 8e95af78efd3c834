"""Tables in the catalog: a replacement takes its place whole, or not at all."""

import uuid

import pytest
from pyspark.sql import functions as F

from velorisk.sources.tables import TableStore


@pytest.fixture
def layer(spark, tmp_path):
    name = f"layer_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def tables_in(spark, layer):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {layer}").collect())


def test_replace_in_the_catalog(spark, layer):
    store = TableStore(spark)
    assert not store.exists(layer, "t") and store.missing(layer, ["t"]) == ["t"]
    assert store.replace(layer, "t", spark.range(3)) == 3
    assert store.replace(layer, "t", store.read(layer, "t").where("id > 0").withColumn("more", F.lit(1)), ["more"]) == 2
    assert sorted(r.id for r in store.read(layer, "t").collect()) == [1, 2]
    assert tables_in(spark, layer) == ["t"]


def test_a_write_that_dies_leaves_the_old_table(spark, layer):
    store = TableStore(spark)
    store.replace(layer, "t", spark.range(3))
    dying = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.replace(layer, "t", dying)
    assert store.read(layer, "t").count() == 3
    assert store.replace(layer, "t", spark.range(5)) == 5 and tables_in(spark, layer) == ["t"]


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_swap_that_is_cut_short_is_finished(spark, layer, monkeypatch, at):
    """The job dies before the first rename, before the second, and before the old table is dropped."""
    TableStore(spark).replace(layer, "t", spark.range(3))
    real, calls = spark.sql, []

    def dying(statement, *args, **kwargs):
        if statement.startswith("ALTER") or "__old" in statement and statement.startswith("DROP"):
            calls.append(statement)
            if len(calls) > at:
                raise KeyboardInterrupt
        return real(statement, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(spark, "sql", dying)
        with pytest.raises(KeyboardInterrupt):
            TableStore(spark).replace(layer, "t", spark.range(7))
    after = TableStore(spark)
    # The new table is whole in all cases; before the first rename the old one still has the name.
    assert after.exists(layer, "t") and after.read(layer, "t").count() == (3 if at == 0 else 7)
    assert after.replace(layer, "t", spark.range(9)) == 9
    assert after.read(layer, "t").count() == 9 and tables_in(spark, layer) == ["t"]
