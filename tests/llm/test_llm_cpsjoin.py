import random

import numpy as np
import pytest

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import cpsjoin


def sets_of(rows):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def expected(rows, percent=85):
    """Components over all pairs; rows that share an id are one document."""
    sets, parent = sets_of(rows), {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and None not in (rows[a][0], rows[b][0]) and 100 * len(x & y) >= percent * len(x | y):
                i, j = sorted((root(rows[a][0]), root(rows[b][0])))
                parent[j] = i
    return sorted(
        ((i, len(s), (i if not s else root(i)) if i is not None else None, i is None or not s or root(i) == i) for (i, _), s in zip(rows, sets, strict=True)),
        key=repr,
    )


def found(df):
    got = cpsjoin.near_duplicates(df).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=repr)


def near_copies(seed, base, copies, edits, make_prose):
    pick, words = random.Random(seed), make_prose(base, seed).split(" ")
    out = []
    for _ in range(copies):
        w = list(words)
        for _ in range(pick.randrange(edits + 1)):
            w[pick.randrange(len(w))] = f"x{pick.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small", [16, 3])
def test_components_equal_brute_force(table, odd, make_prose, monkeypatch, small):
    monkeypatch.setattr(cpsjoin, "SMALL", small)
    monkeypatch.setattr(cpsjoin, "CHUNK", 4)
    texts = [t for k in range(8) for t in near_copies(k, 40 + 30 * k, 6, 1 + k // 2, make_prose)]
    texts += near_copies(50, 150, 40, 6, make_prose) + ["w1 w2", "w1 w2", "W1  w2", "w1 w2 w3"]
    shared = make_prose(30, 77)
    texts += [f"{shared} {make_prose(60, 900 + k)}" for k in range(30)]
    order = list(range(100, 100 + len(texts)))
    random.Random(5).shuffle(order)
    rows = [*odd[:-1], *zip(order, texts, strict=True)]
    assert found(table(rows)) == expected(rows)


def test_dense_groups_are_joined_exactly(table, make_prose, monkeypatch):
    monkeypatch.setattr(cpsjoin, "SMALL", 2)
    monkeypatch.setattr(cpsjoin, "DEPTH", 1)
    texts = [t for k in range(3) for t in near_copies(k, 60 + 40 * k, 25, 8, make_prose)]
    rows = list(enumerate(texts))
    assert found(table(rows)) == expected(rows)


def merged(ids, links, labels=None):
    """Smallest id that each reaches over links and equal labels."""
    reached = {i: i for i in ids}
    pairs = [*links, *((i, j) for i in ids for j in ids if labels and labels[i] == labels[j])]
    for _ in ids:
        for a, b in pairs:
            reached[a] = reached[b] = min(reached[a], reached[b])
    return reached


@pytest.mark.parametrize("block", [50_000, 300])
def test_dense_links_lose_no_link_between_classes(spark, table, make_prose, monkeypatch, block):
    monkeypatch.setattr(cpsjoin, "BLOCK_HASHES", block)
    texts = near_copies(3, 50, 30, 4, make_prose)
    rows = list(enumerate(texts))
    sets = sets_of(rows)
    linked = {(b, a) for a in range(30) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    docs = table(rows).selectExpr("doc_id AS id", "text")
    nodes = docs.selectExpr("CAST(id > 14 AS long) AS node", "id").union(docs.where("id IN (3, 20)").selectExpr("7L", "id"))
    none = spark.createDataFrame([], "id long, label long")
    got = [tuple(r) for r in cpsjoin._dense_links(nodes, none, docs).collect()]
    assert {tuple(sorted(x)) for x in got} <= linked and merged(range(30), got) == merged(range(30), linked)
    halves = spark.createDataFrame([(i, i % 2) for i in range(30)], "id long, label long")
    got = [tuple(r) for r in cpsjoin._dense_links(nodes, halves, docs).collect()]
    label = {i: i % 2 for i in range(30)}
    assert merged(range(30), got, label) == merged(range(30), linked, label) and got


@pytest.mark.parametrize("two", [False, True])
def test_links_of_blocks_equal_all_pairs(two):
    pick = np.random.default_rng(4)
    base = np.unique(pick.integers(1, 1 << 63, 80, dtype=np.uint64))
    some = [np.unique(np.concatenate([base[pick.random(80) < 0.93], pick.integers(1, 1 << 63, 5, dtype=np.uint64)])) for _ in range(60)]
    first, second = (some[:25], some[25:]) if two else (some, [])
    close = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
    wanted = [(a, b) for a in range(60) for b in range(a + 1, 60) if close(some[a], some[b]) and (not two or a < 25 <= b)]
    got = cpsjoin.block_links(first, second, list(range(60)), 80)
    assert set(got) <= set(wanted) and len(got) < 60 < len(wanted) and merged(range(60), got) == merged(range(60), wanted)


def test_work_on_a_dense_group_grows_with_its_documents(spark, table, make_prose):
    """Copies of one text with three words changed in each, few of which are linked at 0.8."""
    given = {}
    for n in (150, 300):
        texts = near_copies(9, 200, n, 0, make_prose)
        pick = random.Random(n)
        rows = []
        for k, t in enumerate(texts):
            w = t.split(" ")
            for at in pick.sample(range(200), 3):
                w[at] = f"y{k}x{at}"
            rows.append((k, " ".join(w)))
        docs = table(rows).selectExpr("doc_id AS id", "text")
        _, labels = cpsjoin.link(docs, 80)
        given[n] = labels.count()
        wanted = {i: r for i, _, r, _ in expected(rows, 80)}
        assert {r["doc_id"]: r["component_id"] for r in cpsjoin.near_duplicates(table(rows), percent=80).collect()} == wanted
    assert given[300] <= 300


def test_pairs_at_the_threshold_are_met():
    """Share of pairs of similarity 0.85 that no tree brings together."""
    pick = np.random.default_rng(4)
    missed = 0
    for _ in range(300):
        common, a, b = (pick.integers(1, 1 << 63, n, dtype=np.uint64) for n in (170, 15, 15))
        values = [cpsjoin.minwise(np.unique(np.concatenate([common, x])))[: cpsjoin.COORDINATES] for x in (a, b)]
        nodes = [cpsjoin._ROOTS, cpsjoin._ROOTS]
        for _ in range(3):
            nodes = [cpsjoin.children(n, np.broadcast_to(v, (len(n), len(v))))[1] for n, v in zip(nodes, values, strict=True)]
        missed += not set(nodes[0].tolist()) & set(nodes[1].tolist())
    assert missed <= 1


def test_sketch_bits_let_links_pass():
    pick = np.random.default_rng(6)
    least = 128
    for _ in range(300):
        common, a, b = (pick.integers(1, 1 << 63, n, dtype=np.uint64) for n in (170, 15, 15))
        bits = [cpsjoin._mix(cpsjoin.minwise(np.concatenate([common, x]))) >> np.uint64(17) & np.uint64(1) for x in (a, b)]
        least = min(least, int((bits[0] == bits[1]).sum()))
    assert least >= cpsjoin.EQUAL_BITS


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_and_long_graphs(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(35)] + [(100 + k, 101 + k) for k in range(40)] + [(5, 5)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        i, j = sorted((root(a), root(b)))
        parent[j] = i
    got = cpsjoin.components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert {r["id"]: r["label"] for r in got} == {v: root(v) for v in linked}


def test_empty_and_single(table):
    assert found(table([(1, "x")]).limit(0)) == []
    assert found(table([(1, "x"), (2, None)])) == [(1, 1, 1, True), (2, 0, 2, True)]
