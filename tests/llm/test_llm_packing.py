import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def used(planned, counts, capacity):
    """Sequences of a plan that holds every piece once."""
    held = Counter()
    for filling, times in planned:
        assert times > 0 and sum(n * k for n, k in filling) <= capacity
        for n, k in filling:
            held[n] += k * times
    assert held == Counter(counts)
    return sum(times for _, times in planned)


def fewest(lengths, capacity):
    """By trying every way."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[at]}:
            rest = list(rooms)
            rest.remove(room)
            go(at + 1, [*rest, room - lengths[at]])
        go(at + 1, [*rooms, capacity - lengths[at]])

    go(0, [])
    return best[0]


def as_array(counts, capacity):
    out = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        out[n] = c
    return out


def test_plans_of_few_pieces_are_the_fewest():
    pick, helped = random.Random(5), 0
    for _ in range(400):
        capacity = pick.choice([20, 50, 100])
        lengths = [pick.randint(max(1, capacity // 10), int(capacity * 0.6)) for _ in range(pick.randint(3, 10))]
        counts, want = Counter(lengths), fewest(lengths, capacity)
        assert packing.lower_bound(as_array(counts, capacity), capacity) <= want
        assert used(packing.plan(counts, capacity), counts, capacity) == want
        helped += used(packing.best_fit(counts, capacity), counts, capacity) > want
    assert helped


def test_fillings_that_another_dominates_are_left_out():
    counts = as_array({60: 1, 40: 1, 30: 2, 10: 3}, 100)
    assert packing.fillings(counts, 100) == [((60, 1), (40, 1))]  # one piece that fills the room
    found = packing.fillings(as_array({60: 1, 30: 1, 20: 1, 9: 1}, 100), 100)
    assert found == [((60, 1), (30, 1), (9, 1))]  # 20 and 9 give way to 30


def test_plans_of_many_pieces():
    lengths = np.random.default_rng(1).lognormal(6.6, 1.0, 100_000).astype(int) % 4096 + 1
    counts = {int(n): int(c) * 10**6 for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    least = packing.lower_bound(as_array(counts, 4096), 4096)
    assert used(packing.plan(counts), counts, 4096) <= 1.0005 * least
    thirds = Counter(random.Random(2).choices(range(1100, 1600), k=3000))
    assert used(packing.plan(thirds), thirds, 4096) < 0.95 * used(packing.best_fit(thirds, 4096), thirds, 4096)


@pytest.mark.parametrize("ranked", [100_000, 20])
def test_places_have_no_gaps(spark, monkeypatch, ranked):
    monkeypatch.setattr(packing, "RANKED", ranked)
    pick = random.Random(3)
    rows = [(k, 0, pick.choice([1, 5, 30, 30, 30, 100, *range(1, 101)]), 1, "x", 0) for k in range(2000)] + [(None, 0, 7, 1, "x", 0)] * 50
    df = spark.createDataFrame(rows, "doc_id long, piece int, length int, rank int, row string, part int")
    packed = packing.pack(df, 100).collect()
    assert sorted(((r["doc_id"], r["length"]) for r in packed), key=repr) == sorted(((r[0], r[2]) for r in rows), key=repr)
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 100 and len(ends) <= 1 - (-sum(r[2] for r in rows) // 100)


def test_lengths_and_names_that_cannot_be(spark):
    assert packing.pack(spark.createDataFrame([], "length long"), 10).count() == 0
    with pytest.raises(ValueError, match="outside 1 to 10"):
        packing.pack(spark.createDataFrame([(11,)], "length long"), 10)
    with pytest.raises(ValueError, match="offset"):
        packing.pack(spark.createDataFrame([(1, 1)], "length long, offset long"), 10)


def test_pieces_match_the_plain_library(table, odd, make_prose):
    plain = Tokenizer.from_file(PATH)
    more = [(20, "a b\x1cC\x1dd\tE's <|endoftext|>x İSTANBUL ﬁ ΣΑΣ é"), (23, "A\u030a H\u0331. É. ΣΣ. it's. IT'S. 5. 5, .. x., <|ENDOFTEXT|>"), (24, "H. End. O'RE, don't, W" + "." * 130), (21, "東京" * 400), (22, "x" * 9000)]
    rows = odd + more
    got = packing.pieces(table(rows), PATH, capacity=64)
    want = []
    for i, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i, k, 64 * k, len(ids[64 * k :][:64]), np.array(ids[64 * k :][:64], "<u4").tobytes()) for k in range(-(-len(ids) // 64))]
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_remembered_parts_change_nothing(monkeypatch, make_prose):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    plain, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    for k in range(60):
        text = make_prose(40, k % 17)
        assert np.frombuffer(encoder(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) + len(encoder.known.old) < 250


def test_sequences_hold_all_ids(table, make_prose):
    docs = table([(k, make_prose(5 + 9 * (k % 30), k)) for k in range(60)])
    cut = packing.pieces(docs, PATH, capacity=512)
    made = packing.sequences(packing.pack(cut, 512)).collect()
    plain = Tokenizer.from_file(PATH)
    ids = [i for r in docs.collect() for i in [*plain.encode(r["text"], add_special_tokens=False).ids, 1]]
    assert Counter(i for r in made for i in r["ids"]) == Counter(ids)
    assert all(len(r["ids"]) <= 512 for r in made) and sum(len(r["doc_ids"]) for r in made) == cut.count()
    assert made and docs.select(F.max("doc_id")).first()[0] == 59
