import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.schemas import TableSpec
from pressroom.sources.tables import Warehouse, filters_to_column, keep_last_per_key, merge_counts

ITEMS = TableSpec(
    "items",
    T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("value", T.IntegerType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField("day", T.IntegerType()),
        ]
    ),
    "items",
    key="id",
    partitions=["day"],
)
FLAGS = TableSpec(
    "flags",
    T.StructType([T.StructField("id", T.StringType()), T.StructField("on", T.BooleanType())]),
    "flags",
    key="id",
)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path), {"items": ITEMS, "flags": FLAGS})


def rows(warehouse, name="items"):
    return sorted((tuple(r) for r in warehouse.read_table(name).collect()), key=repr)


def items(spark, *values):
    return spark.createDataFrame(list(values), "id string, value int, tags array<string>, day int")


def test_missing_table_is_empty_and_typed(warehouse):
    empty = warehouse.read_table("items", columns=["id", "tags"])
    assert empty.schema == T.StructType([ITEMS.schema["id"], ITEMS.schema["tags"]])
    assert empty.count() == 0


def test_create_then_merge(spark, warehouse):
    first = warehouse.write_table("items", items(spark, ("a", 1, None, 1), ("b", 1, ["x"], 1), ("c", 1, [], 2)))
    assert first == {"rows_inserted": 3, "rows_updated": 0}
    second = items(spark, ("b", 2, ["y"], 3), ("c", 2, None, 2), ("d", 2, None, 1))
    assert warehouse.write_table("items", second) == {"rows_inserted": 1, "rows_updated": 2}
    expected = [("a", 1, [], 1), ("b", 2, ["y"], 3), ("c", 2, [], 2), ("d", 2, [], 1)]
    assert rows(warehouse) == expected
    assert warehouse.write_table("items", second) == {"rows_inserted": 0, "rows_updated": 3}
    assert rows(warehouse) == expected


def test_partition_left_empty_by_a_move(spark, warehouse):
    warehouse.write_table("items", items(spark, ("a", 1, None, 1), ("b", 1, None, 2)))
    warehouse.write_table("items", items(spark, ("a", 2, None, 2)))
    assert rows(warehouse) == [("a", 2, [], 2), ("b", 1, [], 2)]


def test_untouched_partition_keeps_its_files(spark, warehouse):
    warehouse.write_table("items", items(spark, ("a", 1, None, 1), ("b", 1, None, 2)))

    def files():
        return {r[0] for r in warehouse.read_table("items").where("day = 1").select(F.input_file_name()).collect()}

    before = files()
    warehouse.write_table("items", items(spark, ("c", 1, None, 2)))
    assert files() == before


def test_empty_write_changes_nothing(spark, warehouse):
    warehouse.write_table("items", items(spark, ("a", 1, None, 1)))
    assert warehouse.write_table("items", items(spark).limit(0)) == {"rows_inserted": 0, "rows_updated": 0}
    assert rows(warehouse) == [("a", 1, [], 1)]


def test_last_row_of_a_key_wins_and_null_keys_stay(spark, warehouse):
    df = items(spark, ("a", 1, None, 1), ("a", 3, None, 1), ("a", 2, None, 1), (None, 7, None, 1), (None, 7, None, 1))
    warehouse.write_table("items", df, order_by=["value"])
    assert rows(warehouse) == [("a", 3, [], 1), (None, 7, [], 1), (None, 7, [], 1)]
    assert keep_last_per_key(df, "id", ["value"]).count() == 3


def test_interrupted_write_is_completed(spark, warehouse, monkeypatch):
    warehouse.write_table("items", items(spark, ("a", 1, None, 1), ("b", 1, None, 2)))

    def crash(self, spec, stage):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_apply", crash)
        with pytest.raises(RuntimeError):
            warehouse.write_table("items", items(spark, ("a", 2, None, 3)))
    assert rows(warehouse) == [("a", 1, [], 1), ("b", 1, [], 2)]
    warehouse.write_table("items", items(spark, ("c", 1, None, 2)))
    assert rows(warehouse) == [("a", 2, [], 3), ("b", 1, [], 2), ("c", 1, [], 2)]


def test_bucketed_table_hides_its_bucket(spark, warehouse):
    flags = spark.createDataFrame([(str(i), False) for i in range(50)], "id string, on boolean")
    warehouse.write_table("flags", flags, unique=True)
    update = flags.where("cast(id as int) < 10").withColumn("on", F.lit(True))
    assert warehouse.write_table("flags", update, unique=True) == {"rows_inserted": 0, "rows_updated": 10}
    table = warehouse.read_table("flags")
    assert table.columns == ["id", "on"]
    assert {r["id"] for r in table.where("on").collect()} == {str(i) for i in range(10)}


def test_disjoint_upserts_commute(spark, tmp_path):
    parts = [("a", 1, None, 1), ("b", 1, None, 2)], [("c", 2, None, 1), ("d", 2, None, 3)]
    results = []
    for order in (parts, parts[::-1]):
        w = Warehouse(spark, str(tmp_path / str(len(results))), {"items": ITEMS})
        for part in order:
            w.write_table("items", items(spark, *part))
        results.append(rows(w))
    assert results[0] == results[1]


def test_merge_counts(spark):
    target = spark.createDataFrame([(1,), (2,)], "k int")
    source = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    assert tuple(merge_counts(target, source, "k").first()) == (2, 1)


def test_filters(spark, warehouse):
    warehouse.write_table("items", items(spark, ("a", 1, None, 1), ("b", 2, None, 2), ("c", 2, None, 3)))
    got = warehouse.read_table("items", filters=[("value", "=", 2), ("day", "in", [1, 2])], columns=["id"])
    assert [r["id"] for r in got.collect()] == ["b"]
    with pytest.raises(ValueError):
        filters_to_column([("a", ">", 1)])


def test_rows_of_ids_read_their_partitions_only(spark, warehouse):
    warehouse.write_table("items", items(spark, *[(str(i), i, None, i % 5) for i in range(20)]))
    ids = spark.createDataFrame([("1",), ("6",), ("none",)], "id string")
    got = warehouse.read_rows_of("items", ids)
    assert {r["id"] for r in got.collect()} == {"1", "6"}
    assert {f.split("/")[-2] for f in got.inputFiles()} >= {"day=1"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)
    assert warehouse.read_rows_of("items", ids.where("id = 'none'")).count() == 0
    assert warehouse.read_rows_of("flags", ids).count() == 0
