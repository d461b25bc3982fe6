from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pricewright.llm import bpe
from pricewright.llm.queries import vocabulary

TEXTS = [
    None, "", " ", "a", "Hello world!", "it's we'll  tabs\t\tand\nlines \n", "naïve Straße 北京 日本語",
    "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "0123456789 ٣٤ ½", "\x1c\x1d \x85   x",
    "emoji 👩‍👩‍👧‍👦 ok", "՘࢏ new letters \U000323b0", "a" * 5000, " " * 3000 + "b", "ab" * 20000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_same_ids_and_text_as_the_library(library):
    own = bpe.codec(vocabulary())
    rng = random.Random(4)
    pool = "aeinst \n.,'0127éß北👍 <|>"
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for text in [t or "" for t in TEXTS] + made:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text[:60]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_decoding_of_any_ids_matches_the_library(library):
    own, rng = bpe.codec(vocabulary()), random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.decode([None, 999_999_999]) == ""


def test_settled_characters_split_alike(library):
    own = bpe.codec(vocabulary())
    for point in [*range(0x80, 0x558), *range(0x2000, 0x2070), *range(0x3000, 0x3100)]:
        for text in (f"a{chr(point)}", f"1{chr(point)}", f" {chr(point)} !{chr(point)}"):
            pieces = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert own.pieces(text) == pieces, hex(point)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    own = bpe.Codec(vocabulary())
    words = "alpha beta gamma delta epsilon alpha"
    assert own.decode(own.encode(words)) == words and len(own._cache) <= 3


def test_frames(spark, library):
    rows = [(n, t, "clash") for n, t in enumerate(TEXTS)] + [(1, "", "clash")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = bpe.decode_frame(bpe.encode_frame(df, vocabulary()), vocabulary())
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    found = out.withColumn("joined", bpe.joined_ids(F.col("ids"))).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == library.encode(r.text, add_special_tokens=False).ids
            assert r.decoded == r.text and r.joined == ",".join(map(str, r.ids))
    both = df.select("doc_id", bpe.round_trip(F.col("text"), vocabulary()).alias("b")).select("doc_id", "b.*")
    assert sorted(map(str, both.collect())) == sorted(
        str(r) for r in out.select("doc_id", "ids", "decoded").collect()
    )
    assert bpe.encode_frame(df.limit(0), vocabulary()).count() == 0


def test_a_task_gives_memory_back(monkeypatch):
    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(True)

    monkeypatch.setattr(bpe.pa, "default_memory_pool", Pool)
    with bpe.codec(vocabulary()).remembering() as own:
        own.encode("some words")
        assert own._cache and not given_back
    assert given_back and not own._cache
