"""The pipeline stage by stage against plain versions of what each decides."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from llm.test_minhash import brute
from pricewright.llm.common import BATCH_ROWS, stage
from pricewright.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"


def plain_lines(rows):
    """Texts without the lines that too many documents of a source have."""
    pages, seen = Counter(), defaultdict(Counter)
    for r in {(r.source, r.text): r for r in rows}.values():
        pages[r.source] += 1
        seen[r.source].update({x.strip(" \t\n\v\f\r") for x in (r.text or "").split("\n")} - {""})
    out = {}
    for r in rows:
        often = {
            x for x, n in seen[r.source].items()
            if r.source is not None and pages[r.source] >= P.LEAST_DOCUMENTS and n >= 2 and n > P.LINE_RATIO * pages[r.source]
        }
        kept = [x for x in (r.text or "").split("\n") if x.strip(" \t\n\v\f\r") not in often]
        told = [x for x in (r.text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        copied = len(told) - len([x for x in kept if x.strip(" \t\n\v\f\r")]) > P.MOST_LINES * len(told)
        out[r.doc_id] = r.text if r.text is None or copied else "\n".join(kept)
    return out


def test_stages(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAST_DOCUMENTS", 5)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame(
        [(90001, None, "en", "src0", 0), (90002, "12 34 !", "en", "src0", 7), (90003, "", None, None, 0)], docs.schema
    )
    docs = docs.unionByName(extra)
    before = docs.collect()
    kept = stage(P.identify(spark, docs, FOLDER), "t")
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in before} - {r.doc_id for r in kept.collect()}
    assert {90001, 90002, 90003} <= gone and len(gone) <= 3 + 0.03 * len(before)

    rows = kept.collect()
    stripped = stage(P.strip_lines(spark, kept, FOLDER), "t")
    assert stripped.columns == docs.columns
    assert {r.doc_id: r.text for r in stripped.collect()} == plain_lines(rows)

    rows = [(r.doc_id, r.text) for r in stripped.collect()]
    single = stage(P.drop_near_copies(spark, stripped, FOLDER), "t")
    assert single.columns == docs.columns
    left = {d for d, _, c in brute(rows, 5) if d == c}
    assert sorted(r.doc_id for r in single.collect()) == sorted(left) and len(left) < len(rows)

    mixed = stage(P.mix_sources(spark, single, FOLDER), "t")
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    texts = {r.doc_id: r.text for r in single.collect()}
    assert set(times) <= left and max(times.values()) <= 3
    assert all(r.text == texts[r.doc_id] for r in mixed.collect())

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    out = P.encode(spark, mixed, FOLDER).collect()
    assert Counter(r.doc_id for r in out) == times
    for r in out:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == library.encode(text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, place string, copies int"
    text = " ".join(f"word{n}" for n in range(40))
    rows = [(1, text, "en", "a", 9, "p", 1), (1, text, "en", "a", 9, "p", 1), (None, text, "en", "a", 9, "p", 1), (2, None, None, None, None, None, None), (3, text + " more", "en", "b", 9, "", 2)]
    docs = spark.createDataFrame(rows, schema)
    for _, step in P.STAGES[:-1]:
        out = step(spark, docs, FOLDER)
        assert out.columns == docs.columns
        assert step(spark, docs.limit(0), FOLDER).count() == 0
    single = P.drop_near_copies(spark, docs, FOLDER).collect()
    assert sorted(str(r.doc_id) for r in single) == ["1", "2", "None"]
    assert P.encode(spark, docs, FOLDER).count() == len(rows)


def test_run_keeps_clean_documents(spark):
    out = P.run(spark, FOLDER)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
    assert out.where(F.size("ids") != F.col("n_tokens")).count() == 0
    assert out.select("doc_id").distinct().count() > 0


def test_short_pages_lose_their_boilerplate_and_near_copies_keep_their_body(spark):
    rows = [(n, f"site header\nown line {n}\nsite footer", "a") for n in range(50)]
    body = "\n".join(" ".join(f"w{m}x{k}" for k in range(8)) for m in range(10))
    rows += [(100 + n, f"site header\n{body}\ncopy {n}", "a") for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r.text for r in P.strip_lines(spark, docs, FOLDER).collect()}
    assert all(out[n] == f"own line {n}" for n in range(50))
    assert all(out[100 + n] == f"{body}\ncopy {n}" for n in range(20))


def test_mixing_keeps_tiny_sources(spark):
    rows = [(n, "w " * 500, "big") for n in range(100)] + [(1000 + n, "w " * 20, f"tiny{n // 2}") for n in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    left = Counter(r.source for r in P.mix_sources(spark, docs, FOLDER).collect())
    assert set(left) == {"big", "tiny0", "tiny1", "tiny2", "tiny3", "tiny4"}


def test_small_sources_lose_boilerplate_too(spark):
    rows = [(n, f"menu\nown line {n}", "small") for n in range(6)]
    rows += [(100 + n, ("foot\n" if n < 8 else "") + f"another line {n}", "large") for n in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r.text for r in P.strip_lines(spark, docs, FOLDER).collect()}
    assert all(out[n] == f"own line {n}" for n in range(6))
    assert all(out[100 + n] == f"another line {n}" for n in range(100))


def test_documents_of_one_id_or_none_are_judged_apart(spark):
    texts = [" ".join(f"t{n}w{k}" for k in range(30)) for n in range(40)]
    rows = [(1, t, "a") for t in texts] + [(2, texts[0] + " more", "a"), (0, texts[1], "b"), (1, texts[2], "a")]
    rows += [(None, t, "a") for t in texts]
    docs = spark.createDataFrame([(*r, {"a": 1}) for r in rows], "doc_id bigint, text string, source string, more map<string,int>")
    left = Counter((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, FOLDER).collect())
    want = {(1, t) for t in texts} - {(1, texts[1])} | {(0, texts[1])} | {(None, t) for t in texts}
    assert left == Counter(dict.fromkeys(want, 1))


def test_mixing_gives_rows_their_own_copies(spark):
    rows = [(None if n < 50 else 7, f"w{n} " * (1 + n % 9), f"s{n % 3}") for n in range(100)] + [(7, "same same", "s1")] * 9
    docs = spark.createDataFrame([(*r, {"a": 1}) for r in rows], "doc_id bigint, text string, source string, more map<string,int>")
    out = Counter((r.doc_id, r.text, r.source) for r in P.mix_sources(spark, docs, FOLDER).collect())
    key = F.xxhash64("doc_id", "text", "source")
    mixed = P.mixing.mix(docs.withColumn("k", key), key="k", whole=True).groupBy(F.col("doc_id").alias("k")).agg(F.sum("copies").alias("n"))
    want = {r.k: r.n for r in mixed.collect()}
    names = {r.k: (r.doc_id, r.text, r.source) for r in docs.select("*", key.alias("k")).collect()}
    assert out == Counter({names[k]: n for k, n in want.items() if n})


@pytest.mark.parametrize("name", [name for name, _ in P.STAGES if name != "mixing"])
def test_a_stage_alone_hands_small_batches_to_python(spark, name):
    """Also with docs that were not read by ``common.table``: a whole partition of texts was one batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    @F.arrow_udf("int")
    def rows(texts: pa.Array) -> pa.Array:
        return pa.array([len(texts)] * len(texts), pa.int32())

    docs = spark.range(2 * BATCH_ROWS + 5, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the words of "), F.col("id")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"),
    )
    try:
        spark.conf.set(key, "10000")
        dict(P.STAGES)[name](spark, docs, FOLDER)
        assert docs.select(F.max(rows("text"))).first()[0] == BATCH_ROWS
    finally:
        spark.conf.set(key, before)
