import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import odd, table  # noqa: F401

from cityobs.llm import quality, training


def texts(n, seed=1):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("etaoinshr") for _ in range(pick.randrange(2, 8)))
    out = []
    for k in range(n):
        w = [word() for _ in range(pick.randrange(5, 80))]
        kind = k % 4
        if kind == 0:
            w = [x.upper() + "!!" for x in w]
        elif kind == 1:
            w = [x + pick.choice(["###", "$$$", "%%%"]) for x in w]
        out.append((" ".join(w) + ".", int(kind > 1)))
    return out


def test_held_out_accuracy():
    samples = texts(400)
    model = quality.fit(samples[:300])
    hits = [(model.score(t) >= 0.5) == y for t, y in samples[300:]]
    assert np.mean(hits) >= 0.97


def test_descent_meets_the_optimality_conditions():
    samples = texts(60, seed=4)
    labels = np.array([y for _, y in samples])
    rows = [quality.features(t) for t, _ in samples]
    ratio = quality.log_count_ratio(rows, labels)
    values = [quality._scaled(ratio, r) for r in rows]
    signs, cost = 2.0 * labels - 1, 1.0
    weights = quality.coordinate_descent(rows, values, signs, np.full(len(rows), cost), epochs=2000)
    margins = np.array([s * (weights[r] @ v) for r, v, s in zip(rows, values, signs, strict=True)])
    primal = 0.5 * weights @ weights + cost * np.maximum(0, 1 - margins).sum()
    # No small step in any training direction lowers the objective by more than the tolerance.
    for r, v, s in zip(rows, values, signs, strict=True):
        for step in (1e-3, -1e-3):
            moved = weights.copy()
            moved[r] += step * s * v
            m = np.array([z * (moved[q] @ u) for q, u, z in zip(rows, values, signs, strict=True)])
            assert 0.5 * moved @ moved + cost * np.maximum(0, 1 - m).sum() >= primal - 1e-3


def test_features_of_a_long_text_are_those_of_the_whole(monkeypatch):
    text = " ".join(t for t, _ in texts(50))
    whole = quality.features(text)
    monkeypatch.setattr(quality, "STEP", 64)
    assert whole.tolist() == quality.features(text).tolist()
    assert quality.features("").tolist() == [quality.SLOTS]


def test_one_class_or_none():
    assert quality.fit([]).score("x") == pytest.approx(0.5)
    assert quality.fit([("a", 1)] * 9).score("x") == pytest.approx(0.95)


def test_scores_of_odd_rows(table, odd):
    model = quality.fit(texts(80))
    df = table(odd).drop("score")
    got = quality.score(df, model).collect()
    want = sorted((str(i), model.score(t or "")) for i, t in odd)
    assert sorted((str(r["doc_id"]), r["score"]) for r in got) == want
    assert all(0 <= r["score"] <= 1 and r["id"] == "own" for r in got)
    assert quality.score(df.limit(0), model).count() == 0
    assert "text" not in quality.score(df, model, drop_text=True).columns


def test_sample_reads_only_usable_labels_and_keeps_its_bounds(spark, table):
    docs = table([(i, f"text {i}") for i in range(50)] + [(None, "x"), (3, "again")])
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (45, None, 0), (46, 7, 0), (99, 1, 0), (5, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    usable = training.fold(F.col("doc_id"), 3) != 1
    rows = training.sample(docs, labels, "quality", usable)
    allowed = {r["doc_id"] for r in labels.where(usable & F.col("quality").isin(0, 1)).collect()} & set(range(50))
    want = sorted([(f"text {i}", i % 2) for i in allowed] + ([("again", 1)] if 3 in allowed else []))
    assert sorted(rows) == want
    assert len(training.sample(docs, labels, "quality", usable, max_texts=5)) <= 5
    assert sum(len(t) for t, _ in training.sample(docs, labels, "quality", usable, max_chars=30)) <= 30
    assert training.sample(docs, labels.limit(0), "quality", usable) == []
    assert rows == training.sample(docs.repartition(5), labels.repartition(3), "quality", usable)


def test_sample_passes_over_texts_that_do_not_fit(spark, table):
    order = [r[0] for r in spark.range(20).orderBy(F.xxhash64(F.col("id").cast("string")), "id").collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    plain = {i: f"text {i:02}" for i in order}

    def sampled(rows, **bounds):
        return {t for t, _ in training.sample(table(rows), labels, "quality", F.lit(True), **bounds)}

    first = plain | {order[0]: "x" * 1001}
    assert sampled(list(first.items()), max_chars=1000) == set(first.values()) - {"x" * 1001}
    some = plain | {i: "x" * (100 + i) for i in order[:3]}
    got = sampled(list(some.items()), max_chars=300, long_chars=50)
    assert set(some.values()) - {some[i] for i in order[:3]} < got and len(got) == 18
    assert sampled([(order[0], "ab"), *[(order[0], "cd")] * 9], max_chars=5) <= {"ab", "cd"}
    assert sum(len(t) for t, _ in training.sample(table([(order[0], "ab")] * 9), labels, "quality", F.lit(True), max_chars=5)) == 4
