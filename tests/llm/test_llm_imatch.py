import hashlib
import random

import numpy as np
import pytest
import xxhash

from llm_cases import make_prose, odd, table  # noqa: F401

from cityobs.llm import imatch


@pytest.mark.parametrize("share", [0.02, 0.3])
def test_lexicon_is_the_band_by_exact_counts(table, odd, make_prose, share):
    rows = [*odd, *((100 + i, make_prose(30, i)) for i in range(80))]
    got = imatch.lexicon(table(rows).repartition(5), least=share, most=0.5)
    sets = [imatch.terms(t) for _, t in rows]
    n = {t: sum(t in s for s in sets) for t in set().union(*sets)}
    assert got == sorted(t for t, c in n.items() if max(2, share * len(rows)) <= c <= 0.5 * len(rows))


def test_neighbours_and_edits(spark, table, odd):
    rows = [(i, t) for i, t in odd if i not in (6, None)] + [(50 + 7 * i, "w%d " % i * (i % 9)) for i in range(200)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = {r["doc_id"]: r for r in imatch.compare_edits(table(rows).repartition(3), [b"one", b"w3"]).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1


def test_repeated_and_null_ids(table, odd):
    got = imatch.compare_edits(table(odd), [b"amber"]).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (6, 7)}
    assert len(same) == 1
    one = imatch.compare_edits(table([(1, "abcdefgh")]), []).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert imatch.compare_edits(table([(1, "x")]).limit(0), []).count() == 0


def test_order_and_repetition_make_no_difference():
    prints = imatch.Fingerprints([b"amber", b"birch", b"cedar"]).prepare()
    assert prints.of("amber birch")[1] == prints.of("Birch  amber birch rare")[1] != prints.of("amber cedar")[1]
    assert imatch.likeness(prints.of("x y"), prints.of("x y")) == 1 and imatch.likeness(prints.of("x y"), prints.of("y x")) == 0


def plain(lexicon, text):
    """Each subset's hash, term by term."""
    kept, out = [t for t in sorted(imatch.terms(text)) if t in lexicon], []
    for k in range(len(imatch.SHARES) * imatch.SUBSETS):
        sequence = b""
        for t in kept:
            h = xxhash.xxh3_64_intdigest(t)
            x = h ^ xxhash.xxh3_64_intdigest(b"%d" % k)
            x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 % 2**64
            x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            if (x >> 32) % 2048 < imatch.SHARES[k // imatch.SUBSETS]:
                sequence += h.to_bytes(8, "little")
        out.append(max(xxhash.xxh3_64_intdigest(sequence), 1) if sequence else 0)
    return out


def plain_likeness(a, b, same_text):
    if a == b and (any(a) or same_text):
        return 1.0
    shares, n = [], imatch.SUBSETS
    for s in range(0, len(a), n):
        pairs = [(x, y) for x, y in zip(a[s : s + n], b[s : s + n], strict=True) if x or y]
        shares.append((len(pairs), sum(x == y for x, y in pairs) / max(len(pairs), 1)))
    most = max(k for k, _ in shares)
    return max(v for k, v in shares if (3 * k >= n if 3 * most >= n else k == most))


def test_fingerprints_and_likeness_equal_brute_force(spark, table, odd, make_prose):
    rows = [(i, t) for i, t in odd if i not in (6, None)] + [(20 + i, make_prose(5 + 20 * i, i % 9)) for i in range(20)]
    lexicon = sorted(imatch.lexicon(table(rows), least=0.05, most=0.5))
    got = {r["doc_id"]: r for r in imatch.compare_edits(table(rows).repartition(3), lexicon).collect()}
    order, known = sorted(rows), set(lexicon)
    codes = {i: plain(known, t or "") for i, t in order}
    for k, (i, t) in enumerate(order):
        j, n = order[(k + 1) % len(order)]
        t, n = t or "", n or ""
        edited = t[: len(t) - len(t) // 4] + n[: len(t) // 4]
        other = plain(known, edited)
        assert got[i]["fingerprint"][: 16 * len(codes[i])] == "".join(f"{c:016x}" for c in codes[i])
        assert got[i]["edited_fingerprint"][: 16 * len(other)] == "".join(f"{c:016x}" for c in other)
        assert got[i]["near_edited"] == pytest.approx(plain_likeness(codes[i], other, t == edited))
        assert got[i]["near_next"] == pytest.approx(plain_likeness(codes[i], codes[j], t == n))


def test_ids_must_be_whole_numbers(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        imatch.compare_edits(spark.createDataFrame([("b2", "x")], "doc_id string, text string"), [])


def test_dense_subsets_agree_between_near_copies():
    words = [b"w%d" % i for i in range(2000)]
    prints, text = imatch.Fingerprints(words).prepare(), [f"w{i}" for i in range(0, 600, 2)]
    own, near = prints.of(" ".join(text)), prints.of(" ".join([*text[1:], "w1"]))
    dense = [(x == y) for x, y in zip(own[0][: 2 * imatch.SUBSETS], near[0][: 2 * imatch.SUBSETS], strict=True)]
    assert any(dense) and imatch.likeness(own, near) > 0.9


def test_likeness_falls_with_the_terms_that_differ():
    words = [b"w%d" % i for i in range(4000)]
    prints, pick = imatch.Fingerprints(words).prepare(), random.Random(3)
    for size in (40, 200, 1000):
        near = {0.1: [], 0.5: []}
        for _ in range(60):
            own = pick.sample(range(4000), size)
            for share, out in near.items():
                other = own[int(share * size) :] + pick.sample(range(4000), int(share * size))
                text = lambda x: " ".join(f"w{i}" for i in x)
                out.append(imatch.likeness(prints.of(text(own)), prints.of(text(other))))
        assert 0.55 < np.mean(near[0.1]) < 0.95 and 0.1 < np.mean(near[0.5]) < 0.5


def test_fingerprint_keeps_other_columns(table, odd):
    got = imatch.fingerprint(table(odd), [b"amber"]).collect()
    assert len(got) == len(odd) and all(r["id"] == "own" and r["fingerprint"] for r in got)
