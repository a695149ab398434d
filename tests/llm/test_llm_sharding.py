import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_cases import odd, table  # noqa: F401

from cityobs.llm import sharding


@pytest.mark.parametrize("total", [1, 2, 3, 7, 16, 97, 1000])
def test_network_with_walk_is_a_permutation(total):
    places = {sharding.place(i, total, 4) for i in range(total)}
    assert len(places) == total
    counts = Counter(s for s, _ in places)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(4)) <= 1


@pytest.mark.parametrize("total", [1, 2, 5, 50, 997])
def test_expression_equals_plain_python(spark, total):
    got = spark.range(total).select("id", sharding.permuted_column(F.col("id"), total).alias("to")).collect()
    for r in got:
        shard, slot = sharding.place(r["id"], total, 1)
        assert (shard, slot) == (0, r["to"])


def test_no_walk_is_longer_than_what_is_unrolled():
    for total in (2, 3, 5, 10, 57, 300):
        for start in range(total):
            steps, value = 1, sharding.permuted(start, total)
            while value >= total:
                steps, value = steps + 1, sharding.permuted(value, total)
            assert steps <= sharding.longest_walk(total)


def test_odd_rows_get_gapless_slots(table, odd, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 3)
    rows = [*odd, *[(99, "copy")] * 10]
    got = sharding.shard(table(rows), 4).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert (r["shard"], r["slot"]) == sharding.place(r["row_number"], len(rows), 4)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_same_rows_in_other_partitions_get_the_same_places(table):
    rows = table([(i, f"text {i}") for i in range(200)])
    a = sharding.shard(rows.repartition(1), 8).collect()
    b = sharding.shard(rows.repartition(7, "text"), 8).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in a} == {r["doc_id"]: (r["shard"], r["slot"]) for r in b}


def test_empty_table(table):
    assert sharding.shard(table([(1, "x")]).limit(0)).count() == 0
