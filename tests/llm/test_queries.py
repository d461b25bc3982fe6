"""Corpus queries against their SQL, and against plain versions where SQL can't say them."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from compare import database, difference
from llm.test_minhash import brute
from llm.test_small import plain_classes, plain_spans

import pricewright.llm
from pricewright.llm import simhash
from pricewright.llm.queries import QUERIES, SQL, vocabulary

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), database(FOLDER), SQL[name]) is None


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


def test_minhash_query(spark, documents):
    out = QUERIES["op7_minhash"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(brute(documents, 4))


def test_bpe_query(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    out = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, FOLDER).collect()}
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256((text or "").encode()).hexdigest()
        assert (out[doc_id].n_tokens, out[doc_id].ids_sha256, out[doc_id].decoded_sha256) == (len(ids), said, back)


def test_pii_query(spark, documents):
    out = {r.doc_id: r for r in QUERIES["op10_pii"](spark, FOLDER).collect()}
    for doc_id, text in documents:
        assert out[doc_id].base_sha256 == hashlib.sha256(plain_spans(text).encode()).hexdigest()
        assert plain_spans(text) in out[doc_id].spans


def test_simhash_query(spark, documents):
    out = {r.doc_id: r for r in QUERIES["op9_simhash"](spark, FOLDER).collect()}
    rows = sorted((i, t or "") for i, t in documents)
    assert sorted(out) == [i for i, _ in rows]
    hashes = simhash._WordHashes()
    own = [(i, simhash.fingerprint(t, hashes).hex()) for i, t in rows]
    classes = plain_classes(own, simhash.RADIUS)
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        part = len(t) // 4
        edited = t[: len(t) - part] + following[:part]
        prints = [simhash.fingerprint(x, hashes) for x in (t, edited, following)]
        near = [1 - (int.from_bytes(prints[0]) ^ int.from_bytes(x)).bit_count() / 128 for x in prints[1:]]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (prints[0].hex(), prints[1].hex())
        assert [r.near_edited, r.near_next, r.near_id] == [*near, classes[r.fingerprint]]


def test_plans(spark):
    """Native operators run no Python; encoding is evaluated once; nothing joins all with all."""
    for name, query in QUERIES.items():
        if name in ("op2_mixing", "op10_pii", "op4_chat", "op6_lines", "op1_bpe", "op9_simhash"):
            plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
            if name in ("op2_mixing", "op10_pii"):
                assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
            if name == "op1_bpe":
                assert plan.count("both(coalesce(text") == 1


def test_nothing_else_imports_the_subpackage():
    own = Path(pricewright.llm.__file__).parent
    for path in own.parent.rglob("*.py"):
        assert own in path.parents or "pricewright.llm" not in path.read_text()
