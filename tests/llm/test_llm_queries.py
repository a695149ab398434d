import base64
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F

from llm_cases import odd  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from cityobs.llm import quality, training
from cityobs.llm.oracles import ORACLES
from cityobs.llm.queries import QUERIES


TABLES = ("documents", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) == set(entry.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)


def test_fingerprints_of_edits(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op2_imatch_fingerprints"](spark, SMALL).collect()}
    seen = {}
    for k, (i, text) in enumerate(documents):
        follower = documents[(k + 1) % len(documents)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + follower[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    near = np.array([(r["near_edited"], r["near_next"]) for r in got.values()])
    assert (near[:, 0] > near[:, 1]).mean() > 0.9 and near[:, 0].mean() > 0.3 > 0.05 > near[:, 1].mean()


def test_base_scores(spark, documents):
    from collections import Counter

    got = {r["doc_id"]: r for r in QUERIES["op3_lattice_likelihood"](spark, SMALL).collect()}
    held_out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tokens = {i: [*t.encode().lower().split(), b"\n"] for i, t in documents}
    counts = Counter(w for i, ws in tokens.items() if not held_out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held_out(i), len(ws), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws) and r["base_score"] == pytest.approx(base, abs=1e-6)
        assert -math.inf < r["score"] < 0


@pytest.mark.parametrize(("name", "label", "least"), [("op4_nb_svm", "quality", 0.95), ("op5_toxic_segments", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    folder = SMALL.replace("0.001", "0.1")
    got = QUERIES[name](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    rows = got.join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r[label] for r in rows]) >= least
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_byte_bpe_is_the_plain_library(spark, documents):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op8_byte_bpe"](spark, SMALL).collect()}
    for i, text in documents:
        ids = plain.encode_ordinary(text)
        digest = lambda x: hashlib.sha256(x).hexdigest()
        assert got[i] == (len(ids), digest(" ".join(map(str, ids)).encode()), digest(text.encode()))


def test_base_spans_of_documents(spark, documents):
    from test_llm_pii import expected

    got = {r["doc_id"]: r for r in QUERIES["op10_bootstrapped_pii"](spark, SMALL).collect()}
    for i, text in documents:
        spans = [f"{kind}:{a}:{b}" for kind, a, b in expected(text)]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got[i]["spans"].split(",")) | {""}


def test_pipeline_equals_its_stages_in_plain_python(spark, duck):
    from test_llm_cpsjoin import expected as groups
    from test_llm_decontaminate import expected as hits
    from test_llm_lines import expected as cleaned

    columns = "doc_id, text, lang, source, n_chars"
    rows = {r[0]: r for r in duck.execute(f"SELECT {columns} FROM documents").fetchall()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(training.sample(docs, labels, "quality", training.fold(F.col("doc_id"), 3) != 1))
    rows = {i: r for i, r in rows.items() if model.score(r[1]) >= 0.5}
    lines = cleaned([(i, r[1], r[3]) for i, r in rows.items()], 5)
    texts = {i: text for i, text, n, gone in lines if not gone or gone < n}
    keep = {i for i, _, _, kept in groups(list(texts.items()), corpus_pipeline.NEAR_PERCENT) if kept}
    clean = {i for i, _, hit, _ in hits([(i, texts[i]) for i in keep], duck.execute("SELECT * FROM benchmark").fetchall(), 10) if not hit}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == clean and 0 < len(clean) < 200
    for i, r in got.items():
        assert r["exact"] and (r["lang"], r["source"]) == rows[i][2:4]
        assert r["n_chars"] == (len(texts[i]) if texts[i] != rows[i][1] else rows[i][4])


def test_stages_take_odd_rows_and_empty_tables(spark, odd):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = spark.createDataFrame([(i, t, None, "s", None) for i, t in odd], schema)
    for docs in (full, full.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMALL).columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert last.where("exact").count() == docs.count()
