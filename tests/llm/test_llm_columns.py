"""Tables whose columns are named like the operators' own, in work and in results."""

import pytest
from pyspark.sql import functions as F

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import decontaminate, lines, pii
from cityobs.llm.columns import passed

NAMES = """n_lines N_Removed n_words n_hit items spans row parts drops digest pos row_id row_key row_h row_digest sorted window word
start __id __h __key __drops __kept __spans id h key n_lines_input""".split()
TEXT_ONLY = ["doc_id", "text", "source"]


def benchmark(spark):
    return spark.createDataFrame([(1, "amber birch cedar"), (2, "one"), (None, None)], "item_id long, text string")


OPERATORS = {
    "lines": (lambda df: lines.remove_boilerplate(df, min_sites=2), ["n_lines", "n_removed"]),
    "hits": (lambda df: decontaminate.contamination(df, benchmark(df.sparkSession)), ["n_words", "n_hit", "items"]),
    "hits by shuffle": (
        lambda df: decontaminate.contamination(df, benchmark(df.sparkSession), broadcast_windows=0),
        ["n_words", "n_hit", "items"],
    ),
    "pii": (pii.find, ["spans"]),
}


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_pass_and_change_nothing(spark, odd, name, as_text):
    rows = [(i, t, None if i == 4 else f"s{k}") for k, (i, t) in enumerate([*odd, (9, "mail a@b.org or 10.0.0.1\none"), (10, "one\nx")])]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if as_text:
        plain = plain.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    full = plain.select("*", *(F.lit(k).alias(n) for k, n in enumerate(NAMES)))
    run, added = OPERATORS[name]
    want = run(plain).select("doc_id", "text", *added)
    done = run(full)
    names = passed(full, added)
    assert sorted(done.columns) == sorted([*names.values(), *added])
    assert sorted(map(repr, done.select("doc_id", "text", *added).collect())) == sorted(map(repr, want.collect()))
    kept = done.select(*(F.col(names[n]).alias(f"c{k}") for k, n in enumerate(NAMES))).distinct().collect()
    assert [tuple(r) for r in kept] == [tuple(range(len(NAMES)))]


def test_renamed_columns_take_no_name_twice(spark):
    df = spark.range(1).selectExpr("id AS n_lines", "1 AS n_lines_input", "2 AS other")
    assert passed(df, ["N_LINES"]) == {"n_lines": "n_lines_input_", "n_lines_input": "n_lines_input", "other": "other"}


def test_text_of_many_dropped_lines(spark):
    long = "\n".join(f"line {k}" for k in range(100_000))
    df = spark.createDataFrame([(k, long + f"\nown {k}", f"s{k}") for k in range(3)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in lines.remove_boilerplate(df, min_sites=3).collect()}
    assert got[0]["text"] == long + "\nown 0" and [got[k]["text"] for k in (1, 2)] == ["own 1", "own 2"]
    assert [got[k]["n_removed"] for k in range(3)] == [0, 100_000, 100_000]
