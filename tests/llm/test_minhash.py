from __future__ import annotations

import random

from pyspark.sql import functions as F

from pricewright.llm import minhash
from pricewright.sources import scratch


def brute(rows, words, similarity=80):
    """Component of each row's set by comparing all pairs; -1 marks an empty set."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        m = min(words, len(w))
        sets.append(frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= similarity * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups.setdefault(find(n), []).append(doc_id)
    out = []
    for n, (doc_id, _) in enumerate(rows):
        own = min(groups.get(find(n), [None]), key=lambda x: (x is None, x))
        out.append((doc_id, len(sets[n]), own if sets[n] else doc_id))
    return out


def edited(rng, words, share):
    return " ".join(f"e{rng.random()}" if rng.random() < share else w for w in words)


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for n in range(60):  # unrelated, some with a passage that many share
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        rows.append(" ".join(own + passage if n % 3 == 0 else own))
    for family in range(5):  # near copies around a base, at distances on either side of the threshold
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(25):
            rows.append(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.06])))
    chain = [rng.choice(vocabulary) for _ in range(100)]  # each edits the one before
    for n in range(12):
        chain = [*chain[3:], *(f"c{n}{k}" for k in range(3))]
        rows.append(" ".join(chain))
    for n in range(1, 8):  # short ones
        rows += [" ".join(f"s{k}" for k in range(n)), " ".join(f"S{k}" for k in range(n)), "same"]
    rows += ["", None, " \t\n", "a b c d e", "A  B\tC\nD E", "one two three four five", "long " * 3000]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(10 * k, rows[n]) for k, n in enumerate(order)]


def found(spark, rows, words, **more):
    df = spark.createDataFrame(
        [(d, t, 7, "x") for d, t in rows], "doc_id bigint, text string, class_id int, sketch string"
    )
    out = minhash.near_duplicates(df, words=words, **more).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 700)  # many blocks a group
    rows = corpus()
    expected = brute(rows, 4)
    assert len({c for _, _, c in expected}) < len(rows) - 60
    assert found(spark, rows, 4) == sorted(expected, key=repr)


def test_five_words_and_one_block(spark):
    rows = corpus(2)
    assert found(spark, rows, 5) == sorted(brute(rows, 5), key=repr)


def test_repeated_ids_nulls_and_empty_tables(spark):
    long = " ".join(f"w{n}" for n in range(50))
    rows = [(5, long), (5, long), (5, "other text of this id"), (3, long + " tail"), (None, long), (None, None), (9, ""), (9, "")]
    assert found(spark, rows, 4) == sorted(brute(rows, 4), key=repr)
    assert found(spark, [], 4) == []


def test_many_rows_without_id_and_many_texts_of_one_id(spark):
    rng = random.Random(8)
    words = [f"w{n}" for n in range(300)]
    bases = [[rng.choice(words) for _ in range(60)] for _ in range(20)]
    rows = [(None if n % 2 else 7, edited(rng, bases[n % 20], rng.choice([0, 0.01, 0.03]))) for n in range(300)]
    rows += [(100 + n, edited(rng, base, 0.01)) for n, base in enumerate(bases)]
    assert found(spark, rows, 4) == sorted(brute(rows, 4), key=repr)


def test_full_sets_meet_only_rows_of_their_text(spark):
    rows = [(n % 2 or None, f"a b c d e f{n}") for n in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = minhash.sketches(df, "doc_id", "text", 4)
    wanted = made.select(
        F.monotonically_increasing_id().alias("class_id"), F.col("doc_id").alias("rep"), "text_key", "set_key"
    )
    sets = minhash._full_sets(df, "doc_id", "text", 4, wanted)
    assert sets.count() == len(rows)
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "(text_key" in plan[plan.index("Join Inner"):].split("\n")[0]


def test_bottom_of_union_is_a_fair_estimate():
    rng = random.Random(3)
    hashes = minhash._WordHashes()
    words = [f"w{rng.random()}" for _ in range(2000)]
    a = minhash.shingle_set(" ".join(words), 4, hashes)
    b = minhash.shingle_set(" ".join(words[:1700]), 4, hashes)
    union = sorted({*a[:64], *b[:64]})[:64]
    near = len(set(union) & set(a[:64]) & set(b[:64])) / 64
    assert abs(near - 1697 / 1997) < 0.2


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + n, 1001 + n) for n in range(40)] + [(5000, 5001 + n) for n in range(300)]
    root = {}
    for pair in links:
        for x in pair:
            root.setdefault(x, x)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    out = minhash.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {(r.node, r.component) for r in out} == {(x, find(x)) for x in linked}
    assert minhash.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_few_links_are_few_files(spark, monkeypatch):
    """Without adaptive merging every table of the steps would be as many files as there are partitions."""
    written = []
    stored = scratch.stage

    def watched(df, name):
        out = stored(df, name)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(scratch, "stage", watched)
    known = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "48"}
    before = {k: spark.conf.get(k) for k in known}
    try:
        for k, v in known.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame([(n, n + 1) for n in range(12)], "a bigint, b bigint")
        assert {r["component"] for r in minhash.components(links).collect()} == {0}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(written) > 2 and max(written[1:]) <= spark.sparkContext.defaultParallelism
