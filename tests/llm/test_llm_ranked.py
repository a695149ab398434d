import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return Counter(x.translate(LOWER) for x in TERM.findall(text or ""))


def by_hand(docs, queries, k):
    held = [(i, c) for i, t in docs if (c := terms(t))]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for q, text in queries:
        scores = []
        for i, c in held:
            m = 25 + (75 * c.total() * n) // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in terms(text).items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        out += [(q, place, i if known else None, -s) for place, (s, known, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def asked(spark):
    return lambda rows: spark.createDataFrame([(i, t, "own", 1.5, 9) for i, t in rows], "item_id long, text string, id string, score double, rank int")


def texts(make_prose, n):
    common = "the of and"
    return [(k, f"{common * (k % 4)} {make_prose(10 + k % 50, k % 170)} The THE x{k % 9}") for k in range(n)]


@pytest.mark.parametrize("sizes", [(32_768, 2_000_000), (50, 700)])
def test_search_matches_plain_python(table, odd, asked, make_prose, monkeypatch, sizes):
    monkeypatch.setattr(ranked, "BLOCK_DOCUMENTS", sizes[0])
    monkeypatch.setattr(ranked, "BLOCK_POSTINGS", sizes[1])
    docs = texts(make_prose, 400) + odd
    queries = [(k, make_prose(8, k) + " the of x3 x3") for k in range(20)]
    queries += [(50, None), (51, "..."), (52, "nothingofthis"), (3, "amber birch"), (3, "amber birch"), (None, "ÉTÉ 東京")]
    found = ranked.search(table(docs), asked(queries), 10)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(docs, queries, 10)


def test_queries_in_several_blocks(table, asked, make_prose, monkeypatch):
    monkeypatch.setattr(ranked, "QUERY_BYTES", 400)
    docs = texts(make_prose, 150)
    queries = [(k, make_prose(6 if k else 200, k)) for k in range(12)]
    found = ranked.search(table(docs), asked(queries), 3)
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(docs, queries, 3)


def test_best_equals_a_full_sum():
    pick = np.random.default_rng(5)
    for round_ in range(200):
        n, k = int(pick.integers(1, 3000)), int(pick.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(pick.integers(1, 9))):
            docs = np.flatnonzero(pick.random(n) < 10.0 ** -pick.uniform(0, 3))
            adds = pick.integers(0, int(pick.integers(2, 60)), len(docs))
            total[docs] += adds
            lists.append(ranked.List(docs, adds))
        floor = int(pick.integers(0, 20)) if round_ % 3 == 0 else 0
        docs, scores = ranked.best(lists, n, k, floor)
        order = [i for i in np.lexsort((np.arange(n), -total)) if total[i] > floor][:k]
        assert docs.tolist() == order and scores.tolist() == total[order].tolist()


def test_skipping_reads_few_postings():
    """A rare term of high weight makes the common list one that is only looked into."""
    n = 200_000
    common = ranked.List(np.arange(n), np.full(n, 3))
    rare = ranked.List(np.arange(0, n, 5000), np.full(40, 1000))
    docs, scores = ranked.best([common, rare], n, 10)
    assert docs.tolist() == list(range(0, 50_000, 5000)) and set(scores.tolist()) == {1003}
    assert common.at < 60_000  # read through until ten documents were known, then no more


def test_empty_tables_and_string_ids(spark, table, asked, odd):
    assert ranked.search(table([]), asked([(1, "amber")])).count() == 0
    assert ranked.search(table(odd), asked([])).count() == 0
    docs = spark.createDataFrame([("b", "amber"), ("a", "amber"), (None, "amber"), ("c", "birch amber")], "doc_id string, text string")
    found = ranked.search(docs, asked([(1, "amber birch")]), 4).orderBy("rank")
    assert [r["doc_id"] for r in found.where(F.col("score") > 0).collect()] == ["c", None, "a", "b"]
