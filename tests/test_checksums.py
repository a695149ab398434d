import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cityobs.operators.checksums import differing_ranges, parity_by_ranges, range_sums
from cityobs.operators.parity import parity


@pytest.fixture
def table(spark):
    df = spark.range(3000).selectExpr("cast(id % 700 as int) k", "concat('n', id % 11) n", "cast(id % 97 as double) v")
    return df.withColumn("v", F.when(F.col("v") == 5, None).otherwise(F.col("v")))


def test_order_and_layout_do_not_matter(table):
    other = table.orderBy(F.desc("v"), "n").repartition(7)
    assert differing_ranges(table, other.select("v", "k", "n"), ["k"], 1, 4) == []
    assert rows(range_sums(table, ["k"], 1, bits=4)) == rows(range_sums(other, ["k"], 1, bits=4))
    assert parity_by_ranges(table, other, ["k"]).count() == 0


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_differences_equal_the_plain_comparison(spark, table, levels):
    changed = table.withColumn("v", F.when(F.col("k").isin(3, 450), F.col("v") + 1).otherwise(F.col("v")))
    changed = changed.where("k <> 77").union(spark.createDataFrame([(9000, "new", 1.0), (None, None, None)], table.schema))
    changed = changed.union(table.where("k = 500"))  # rows that are repeated
    wanted = parity(table, changed, ["k"])
    got = parity_by_ranges(table, changed, ["k"], bits=4, levels=levels)
    assert rows(got) == rows(wanted) and got.count() > 10


def test_only_differing_ranges_are_kept(table):
    changed = table.withColumn("v", F.when(F.col("k") == 3, -1.0).otherwise(F.col("v")))
    for level in (1, 2, 3):
        assert len(differing_ranges(table, changed, ["k"], level, 4)) == 1


def test_a_level_shuffles_one_row_for_each_range(table):
    text = plan(range_sums(table, ["k"], 1, bits=4))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_bit_xor" in text and "Python" not in text


def test_tolerance_repeated_rows_zeros_and_nan(spark):
    a = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, float("nan")), (3, 1.0), (4, None)], "k int, v double")
    b = spark.createDataFrame([(1, -0.0), (1, 0.0), (2, float("nan")), (3, 1.001), (4, None)], "k int, v double")
    assert parity_by_ranges(a, b, ["k"], {"v": 0.01}, bits=2).count() == 0
    assert [r["k"] for r in parity_by_ranges(a, b, ["k"], bits=2).collect()] == [3]
    once = a.where("k <> 1").union(spark.createDataFrame([(1, 0.0)], "k int, v double"))
    assert [r["k"] for r in parity_by_ranges(a, once, ["k"], bits=2).collect()] == [1]


def test_other_columns_and_empty_tables(spark, table):
    with pytest.raises(ValueError, match="one side only"):
        parity_by_ranges(table, table.drop("v"), ["k"])
    assert parity_by_ranges(table.limit(0), table.limit(0), ["k"]).count() == 0
    assert parity_by_ranges(table.limit(0), table, ["k"], bits=4).count() == 3000
