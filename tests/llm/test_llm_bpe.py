import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from llm_cases import odd, table  # noqa: F401

from cityobs.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_of_odd_texts(table, odd, plain):
    done = bpe.decode(bpe.encode(table(odd), PATH, keep=("doc_id", "id", "n")), PATH).collect()
    want = sorted((str(i), plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd)
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in done) == want
    assert all(r["n"] == 7 and r["id"] == "own" for r in done)


@pytest.mark.parametrize("offsets", [True, False])
def test_remembered_parts_change_nothing(monkeypatch, plain, offsets):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 100)
    pick, encoder = random.Random(8), bpe._Encoder(PATH, offsets)
    vocabulary = [*"été Words naïve don't x. end, ok. Été ñandú 東京 a,b ﬁne ok end x".split(), *(f"w{k % 30}" for k in range(60)), *(chr(97 + k) * 3 for k in range(26))]
    texts = [" ".join(pick.choices(vocabulary, k=12)) for _ in range(200)]
    whole = bpe._tokenizer(PATH).encode_batch(texts, add_special_tokens=False)
    for text, (ids, spans), e in zip(texts, encoder(texts), whole, strict=True):
        assert ids.tolist() == plain.encode_ordinary(text)
        assert not offsets or [tuple(x) for x in spans.tolist()] == e.offsets


def test_random_texts_match_the_plain_library(plain):
    pick = random.Random(3)
    alphabet = "aB z.,'\n\t  é9_  東🙂\r!?|<>s"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|> it's we'll", " lead", "trail ", "a. b, c.\nD. e", ".", "x,\ny"]
    encoder = bpe._Encoder(PATH, True)
    whole = bpe._tokenizer(PATH).encode_batch(texts, add_special_tokens=False)
    for text, (ids, spans), e in zip(texts, encoder(texts), whole, strict=True):
        assert ids.tolist() == plain.encode_ordinary(text)
        assert [tuple(x) for x in spans.tolist()] == e.offsets


def test_forgetting_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 10)
    texts = ["some words, and some.", "more words.\nAnd more", "some words, again"]
    assert [x.tolist() for x, _ in bpe._Encoder(PATH, False)(texts)] == [plain.encode_ordinary(t) for t in texts]


def test_decoding_joins_split_characters_and_skips_special_ids(spark, plain):
    ids = plain.encode_ordinary("🙂")
    assert len(ids) > 1
    rows = spark.createDataFrame([(1, ids), (2, [50256]), (3, None)], "doc_id long, ids array<int>")
    done = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(rows, PATH, special=(50256,)).collect()}
    assert done == {1: "🙂".encode(), 2: b"", 3: b""}


def test_empty_table(table, spark):
    none = table([(1, "x")]).limit(0)
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0


def test_byte_table_is_one_to_one():
    table = bpe.byte_table()
    assert len(set(table.values())) == 256 and table[65] == "A" and ord(table[0]) >= 256
    assert hashlib.sha256(b"".join(bpe._token_bytes(PATH)[:256])).hexdigest()
