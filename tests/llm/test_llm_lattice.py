import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import lattice, training

PATH = public_tokenizers.path("piece_bpe_32k.model")


def spelled(pieces, text):
    """Sum over all segmentations, by recursion over the first piece."""
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        if text[:n] in pieces.log:
            total += math.exp(pieces.log[text[:n]]) * spelled(pieces, text[n:])
        elif n == 1:
            total += math.exp(sum(pieces.byte_log[b] for b in text[0].encode())) * spelled(pieces, text[1:])
    return total


@pytest.fixture(scope="module")
def pieces():
    processor = lattice._processor(PATH)
    used = Counter(i for w in ("therein", "another", "ether", "rein") for i in processor.encode(w))
    return lattice.Pieces(PATH, used)


def test_probabilities_sum_to_one(pieces):
    assert sum(map(math.exp, pieces.log.values())) + sum(map(math.exp, pieces.byte_log)) == pytest.approx(1)


@pytest.mark.parametrize("word", ["", "a", "therein", "reinether", "été", "東京🙂", "x\x00y"])
def test_likelihood_is_the_sum_over_segmentations(pieces, word):
    assert pieces.likelihood(word.encode()) == pytest.approx(math.log(spelled(pieces, "▁" + word)))


def test_long_words_stay_finite(pieces):
    assert -math.inf < pieces.likelihood(b"thereinanother" * 20_000) < 0
    assert -math.inf < pieces.likelihood(b"\xff\xfe") < 0


@pytest.mark.parametrize("common", [1e-6, 0.02])
def test_scores_equal_brute_force(table, odd, make_prose, monkeypatch, common):
    monkeypatch.setattr(lattice, "COMMON", common)
    monkeypatch.setattr(lattice, "COUNTED", 50)
    rows = [*odd[:-1], *((100 + i, make_prose(60, i % 20)) for i in range(30))]
    got = lattice.score(table(rows), training.fold(F.col("doc_id"), 10) != 0, PATH).collect()
    trains = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 != 0
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    counts = Counter(w for i, t in rows if trains(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    processor = lattice._processor(PATH)
    used = Counter(p for w in counts if w != b"\n" for p in processor.encode(w.decode()))
    pieces = lattice.Pieces(PATH, used)
    spare = lattice.DISCOUNT * distinct / total

    def log10(w):
        own = max(counts[w] - lattice.DISCOUNT, 0) / total
        end = 1 / (distinct + 2)
        return math.log10(own + spare * (end if w == b"\n" else (1 - end) * math.exp(pieces.likelihood(w))))

    want = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        want.append((str(i), len(w), sum(counts[x] > 0 for x in w), total, round(base, 6), round(sum(map(log10, w)), 6)))
    seen = [
        (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got
    ]
    assert sorted(seen) == sorted(want)


def test_without_training_documents_and_empty(table):
    rows = table([(1, "ab ab"), (2, None)])
    got = {r["doc_id"]: r for r in lattice.score(rows, F.lit(False), PATH).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[1]["score"] < got[2]["score"] < 0
    assert lattice.score(rows.limit(0), F.lit(True), PATH).count() == 0


def test_pieces_unused_in_training_give_paths(pieces):
    processor = lattice._processor(PATH)
    ordinary = [
        processor.id_to_piece(i)
        for i in range(processor.get_piece_size())
        if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i))
    ]
    assert set(ordinary) == set(pieces.log)
    letters = lattice.Pieces(PATH, {})
    letters.log = {p: x for p, x in pieces.log.items() if p != "▁people"}
    assert pieces.likelihood(b"people") > letters.likelihood(b"people")


@pytest.mark.parametrize("word", ["thereinanother" * 60, "東京тест🙂" * 100, "another" * 150 + "x"])
def test_long_words_sum_over_all_segmentations(pieces, word):
    text = "▁" + word
    back = [-math.inf] * len(text) + [0.0]
    for i in range(len(text) - 1, -1, -1):
        terms = []
        for j in range(i + 1, min(len(text), i + pieces.longest) + 1):
            if text[i:j] in pieces.log:
                terms.append(pieces.log[text[i:j]] + back[j])
            elif j == i + 1:
                terms.append(sum(pieces.byte_log[b] for b in text[i].encode()) + back[j])
        top = max(terms)
        back[i] = top + math.log(sum(math.exp(t - top) for t in terms))
    assert pieces.likelihood(word.encode()) == pytest.approx(back[0], rel=1e-12)
