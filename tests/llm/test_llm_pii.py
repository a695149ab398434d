import random
import re
from collections import defaultdict

from llm_cases import odd, table  # noqa: F401

from cityobs.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def expected(text):
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, p) in enumerate(PLAIN.items())
        for m in re.finditer(p, text or "")
        if passes(kind, m[0])
    ]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def spans(rows, base=True):
    return [[(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"] == base] for r in rows]


def test_base_spans_equal_the_plain_expressions(table, odd):
    pick = random.Random(11)
    alphabet = "0123456789999..--@@++ ()a_b%é🙂\n"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randrange(120))) for _ in range(400)]
    texts += [
        "a@b.c_d@e.f x.y@z-.w@q.r a@b.c.d@e.f",
        "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.01 00000000000000001.2.3.4 1.2.3.99999999999999999999",
        "4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 123-4567 +123",
        "9" * 20_000 + " a@b.co " + "b" * 20_000,
        "é🙂 me@site.org 東京 10.0.0.1",
    ]
    rows = [*odd[:-1], *((100 + i, t) for i, t in enumerate(texts))]
    got = pii.find(table(rows).drop("spans")).collect()
    assert len(got) == len(rows) and all(r["id"] == "own" and r["h"] == "own" for r in got)
    assert sorted(zip([r["doc_id"] for r in got], map(str, spans(got)), strict=True), key=repr) == sorted(
        ((i, str(expected(t))) for i, t in rows), key=repr
    )


def test_contexts_of_seeds_find_more(table):
    words = "amber birch cedar delta ember flint grove heath".split()
    rows = [(i, f"{words[i % 8]} call office +1 555 010 {1000 + i} now") for i in range(30)]
    rows += [(100 + i, f"{words[i % 8]} call office 555 020 {1000 + i} now") for i in range(3)]
    rows += [(200 + i, f"{words[i % 8]} {words[i // 8 % 8]}{i} 777 030 {1000 + i} now") for i in range(40)]
    got = {r["doc_id"]: r for r in pii.find(table(rows).drop("spans")).collect()}
    assert all(spans([got[i]])[0] for i in range(30))
    assert all([s[0] for s in spans([got[100 + i]], base=False)[0]] == ["phone"] for i in range(3))
    assert not any(spans([got[200 + i]], base=False)[0] for i in range(40))


def test_found_spans_overlap_no_base_span(table):
    rows = [(i, f"id 4111 1111 1111 1111 or 4111111111111112 x{i} at 10.0.0.{i}") for i in range(20)]
    for r in pii.find(table(rows).drop("spans")).collect():
        by = defaultdict(list)
        for s in r["spans"]:
            by[s["base"]].append((s["start"], s["end"]))
        assert all(b <= c or d <= a for a, b in by[False] for c, d in by[True])


def test_empty_table(table):
    assert pii.find(table([(1, "x")]).drop("spans").limit(0)).count() == 0
