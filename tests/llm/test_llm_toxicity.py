import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from llm_cases import odd, table  # noqa: F401

from cityobs.llm import toxicity


def naive(weights):
    """Best segment, then the same left and right of it: all maximum-scoring segments."""
    best = (0.0, 0, 0)
    for a in range(len(weights)):
        total = 0.0
        for b in range(a, len(weights)):
            total += weights[b]
            if total > best[0] + 1e-12:
                best = (total, a, b + 1)
    if best[0] <= 0:
        return []
    total, a, b = best
    return [*naive(weights[:a]), (a, b, total), *[(x + b, y + b, z) for x, y, z in naive(weights[b:])]]


def test_segments_equal_recursive_search():
    pick = random.Random(2)
    for _ in range(400):
        weights = [pick.choice([-3, -2, -1, 1, 2, 4]) + pick.random() for _ in range(pick.randrange(25))]
        got = toxicity.segments(np.array(weights))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in naive(weights)]
        assert [t for *_, t in got] == pytest.approx([t for *_, t in naive(weights)])


def texts(n, seed=5):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("etaoinshrdlu") for _ in range(pick.randrange(2, 7))) for _ in range(300)]
    out = []
    for k in range(n):
        w = [pick.choice(vocabulary) for _ in range(pick.randrange(20, 200))]
        if k % 5 == 0:
            for _ in range(2 + len(w) // 40):
                w.insert(pick.randrange(len(w)), pick.choice(["blockhead", "nitwit", "dunce"]))
        out.append((" ".join(w), int(k % 5 == 0)))
    return out


def test_held_out_accuracy_and_passages():
    samples = texts(400)
    model = toxicity.fit(samples[:300])
    scores = [(model.score(t), y) for t, y in samples[300:]]
    assert np.mean([(s >= 0.5) == bool(y) for s, y in scores]) >= 0.95
    text = "calm " * 40 + "Blockhead NITWIT dunce" + " calm" * 40
    found = model.passages(text)
    assert any("Blockhead" in text[a:b] for a, b, _ in found)
    assert model.passages("calm " * 80) == [] and model.score("") == min(model.score(""), *[s for s, _ in scores])


def test_one_class_or_none():
    assert toxicity.fit([]).score("x") == pytest.approx(0.5)
    assert toxicity.fit([("a", 0)] * 9).score("x") == pytest.approx(0.05)


def test_scores_of_odd_rows(table, odd):
    model = toxicity.fit(texts(100))
    df = table(odd).drop("score")
    got = toxicity.score(df, model, spans=True).collect()
    assert sorted((str(r["doc_id"]), r["score"]) for r in got) == sorted((str(i), model.score(t or "")) for i, t in odd)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(df.limit(0), model).count() == 0


def test_forgetting_words_changes_nothing(monkeypatch):
    model = toxicity.fit(texts(100))
    before = [model.score(t) for t, _ in texts(20, seed=9)]
    monkeypatch.setattr(toxicity, "REMEMBERED", 5)
    assert [model.score(t) for t, _ in texts(20, seed=9)] == before


@pytest.mark.parametrize(("n", "caught", "left_alone"), [(500, 0.4, 0.97), (1000, 0.75, 0.97), (3000, 0.88, 0.97)])
def test_recall_on_left_out_labels(n, caught, left_alone):
    folder = "/root/testdata/sf0.1"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    text = dict(zip(docs["doc_id"], docs["text"], strict=True))
    labels = pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "toxic"]).to_pydict()
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    known = sorted((zlib.crc32(b"x%d" % i), i, y) for i, y in zip(labels["doc_id"], labels["toxic"], strict=True) if y is not None)
    model = toxicity.fit([(text[i], y) for _, i, y in known if fold(i)][:n])
    out = [(model.score(text[i]) >= 0.5, y) for _, i, y in known if not fold(i)]
    assert sum(hit for hit, y in out if y) >= caught * sum(y for _, y in out)
    assert sum(not hit for hit, y in out if not y) >= left_alone * sum(not y for _, y in out)


def test_copies_are_one_piece_of_evidence():
    some = [("a fine day for a walk in the park", 0), ("you are a nasty toad", 1)]
    assert toxicity._without_copies([*some, *some, some[1]]) == some
    many = toxicity.fit([(f"{t} w{k}", y) for k in range(40) for t, y in some] + [("a fine day for a walk in the park x", 1)] * 500)
    assert many.score("a fine day for a walk") < 0.5 < many.score("what a nasty toad you are")
