import re

import pytest

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return WORD.findall((text or "").translate(low))


def expected(docs, items, width):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + width]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for window, owners in windows.items():
            for s in range(len(w) - len(window) + 1):
                if tuple(w[s : s + len(window)]) == window:
                    hit |= set(range(s, s + len(window)))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [0, 100_000])
def test_occurrences_equal_brute_force(table, spark, odd, make_prose, bound):
    text = make_prose(60, 1)
    parts = text.split(" ")
    items = [
        (1, text),
        (2, " ".join(parts[5:18])),
        (3, "the the the the the the the the the the the"),
        (4, "amber, Birch; cedar"),
        (5, "été à"),
        (6, None),
        (7, ""),
        (None, "amber birch cedar delta ember flint grove heath"),
        (8, "Été À 東京"),
        (9, "ONE"),
    ]
    docs = [
        *odd[:-1],
        (20, "x " + text.upper() + " y"),
        (21, "a b " + " ".join(parts[3:13]) + " c " + " ".join(parts[4:14])),
        (22, " ".join(parts[3:12])),
        (23, "the " * 40),
        (24, "amber birch cedar amber birch cedar"),
        (25, make_prose(5000, 2) + " " + " ".join(parts[:11])),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(table(docs), benchmark, broadcast_windows=bound).collect()
    assert all(r["key"] == "own" and r["h"] == "own" for r in got)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=repr) == expected(docs, items, 10)


def test_empty_tables(table, spark):
    docs = table([(1, "a b c")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_hit"], r["items"]) for r in decontaminate.contamination(docs, none).collect()] == [(0, [])]
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
