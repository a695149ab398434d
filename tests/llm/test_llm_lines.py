from collections import defaultdict

import pytest

from cityobs.llm import lines


def expected(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" ")
            if key:
                sites[key].add(site or "")
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    out = []
    for i, text, _ in rows:
        parts = (text or "").split("\n")
        drop = lambda x: i is not None and len(sites[x.strip(" ")]) >= min_sites and first[x.strip(" ")] != i  # noqa: E731, B023
        kept = [x for x in parts if not x.strip(" ") or not drop(x)]
        out.append((i, "\n".join(kept), sum(bool(x.strip(" ")) for x in parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [0, 200_000])
def test_spread_decides_and_one_copy_stays(spark, monkeypatch, few):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", few)
    rows = [(i, f"own {i}\nshared by all\n\n near {i % 4} \nrare {i % 30}", f"s{i % 7}") for i in range(60)]
    rows += [(100, None, "s1"), (101, "", None), (102, "shared by all", None), (None, "shared by all\nx", "s2"), (103, "\n \n", "s1")]
    rows += [(104, "shared by all\nshared by all\nlast", "s3")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "7 AS id", "'k' AS key")
    got = lines.remove_boilerplate(df, min_sites=5).collect()
    assert {(r["id"], r["key"]) for r in got} == {(7, "k")}
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got), key=repr) == expected(rows, 5)


def test_threshold_is_exact(spark):
    rows = [(10 * n + k, f"line {n}", f"s{k}") for n in range(1, 12) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.remove_boilerplate(df, min_sites=5).collect()
    removed = {r["doc_id"] for r in got if r["n_removed"]}
    assert removed == {10 * n + k for n in range(5, 12) for k in range(1, n)}


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    assert lines.remove_boilerplate(df.limit(0)).count() == 0
    long = "\n".join(f"line {i}" for i in range(50_000))
    df = spark.createDataFrame([(1, long, "s")], "doc_id long, text string, source string")
    assert lines.remove_boilerplate(df).first()["text"] == long
