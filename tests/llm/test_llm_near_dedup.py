import random

import numpy as np
import pytest

from llm_cases import make_prose  # noqa: F401

import corpus_pipeline
from cityobs.llm import cpsjoin


def copies(make_prose, seed, words, n, edits):
    pick, text = random.Random(seed), make_prose(words, seed).split(" ")
    out = [text]
    for _ in range(n):
        w = list(text)
        for at in pick.sample(range(len(w)), pick.randrange(1, edits + 1)):
            w[at] = f"x{pick.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def brute_force(rows, percent):
    """Smallest ids of the components over all pairs, and the similarities met."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows if (w := t.split())}
    label, met = {i: i for i, _ in rows}, []
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - common
            met.append(common / union)
            if a < b and 100 * common >= percent * union and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    return {i for i, x in label.items() if i == x}, met


@pytest.mark.parametrize("small", [16, 2])
def test_stage_links_from_four_fifths_on(spark, make_prose, monkeypatch, small):
    monkeypatch.setattr(cpsjoin, "SMALL", small)
    texts = [t for k in range(25) for t in copies(make_prose, k, 80 + 20 * (k % 4), 2, 6)]
    texts += copies(make_prose, 99, 150, 25, 6)
    rows = list(enumerate(texts))
    kept, met = brute_force(rows, 80)
    assert kept < brute_force(rows, 85)[0] and sum(0.8 <= x < 0.85 for x in met) > 20
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], schema)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert {r["doc_id"] for r in got.collect()} == kept


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_links_at_a_threshold_pass_sketches_and_meet(percent):
    pick = np.random.default_rng(percent)
    missed, least, roots = 0, cpsjoin.BITS, cpsjoin._roots(percent)
    for _ in range(300):
        common, a, b = (pick.integers(1, 1 << 63, n, dtype=np.uint64) for n in (2 * percent, 100 - percent, 100 - percent))
        mins = [cpsjoin.minwise(np.unique(np.concatenate([common, x]))) for x in (a, b)]
        bits = [cpsjoin._mix(m) >> np.uint64(17) & np.uint64(1) for m in mins]
        least = min(least, int((bits[0] == bits[1]).sum()))
        nodes = [roots, roots]
        for _ in range(cpsjoin.DEPTH):
            nodes = [
                cpsjoin.children(n, np.broadcast_to(m[: cpsjoin.COORDINATES], (len(n), cpsjoin.COORDINATES)), percent)[1]
                for n, m in zip(nodes, mins, strict=True)
            ]
        missed += not set(nodes[0].tolist()) & set(nodes[1].tolist())
    assert missed <= 1 and least >= cpsjoin.equal_bits(percent)


@pytest.mark.parametrize("percent", [80, 85])
def test_trees_branch_on_different_coordinates_first(percent):
    roots = cpsjoin._roots(percent)
    first = cpsjoin._mix(roots ^ cpsjoin._B) % np.uint64(cpsjoin.COORDINATES)
    assert len(set(first.tolist())) == len(roots) == cpsjoin.trees(percent)
