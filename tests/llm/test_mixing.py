from __future__ import annotations

import re

import pytest

from pricewright.llm import mixing


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again what the full sources leave."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: full.get(s, level * weight[s]) for s in names}
        full |= {s: most * sizes[s] for s in over}


def highest_quotients(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda p: (votes[p] / (2 * won[p] + 1), -list(votes).index(p)))
        won[best] += 1
    return won


@pytest.mark.parametrize("votes,seats", [([53, 24, 23], 7), ([1, 1, 1, 1000], 13), ([5] * 9, 4), ([7, 0, 3], 100), ([90, 5, 5, 1, 1, 1], 11)])
def test_apportionment_is_by_highest_quotients(spark, votes, seats):
    df = spark.createDataFrame([(n, float(v), seats) for n, v in enumerate(votes)], "p int, v double, s bigint")
    out = {r.p: r.quota for r in mixing.apportion(df, [], [df["p"]], "v", "s").collect()}
    assert out == highest_quotients(dict(enumerate(map(float, votes))), seats)


def documents(spark):
    rows = []
    for n in range(900):
        source = ["b", "a", "Z", None, "é", "tiny"][0 if n % 3 == 0 else n % 5]
        rows.append((n, " ".join(["w"] * (n % 97)), source, "clash"))
    rows += [(9000, "one two", "tiny", ""), (9001, None, "tiny", ""), (9002, "", "none", ""), (5, " ".join(["w"] * 5), "b", ""), (None, "x y z", "a", "")]
    rows += [(9100, "long " * 30000, "a", "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, shard string"), rows


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 4000)
    df, rows = documents(spark)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    goal, taken = water(sizes), dict.fromkeys(sizes, 0)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and (r.size > 0 or r.taken == 0)
        assert r.copies in (0, 1, 2, 3)
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - goal[source]) <= 2 * mixing.BLOCK_WORDS + 0.01 * goal[source]
    assert abs(sum(goal.values()) - sum(sizes.values())) < 1e-6
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)


def test_nothing_to_mix(spark):
    schema = "doc_id bigint, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    out = mixing.mix(spark.createDataFrame([(1, "", None), (2, None, "a")], schema)).collect()
    assert all((r.size, r.target, r.taken) == (0, 0.0, 0) for r in out) and len(out) == 2


def test_whole_documents_keep_small_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 4000)
    rows = [(n, "w " * (20 + n % 70), "big" if n % 4 else "large") for n in range(600)]
    rows += [(1000 + n, "w " * (1 + n % 3), f"tiny{n // 2:02}") for n in range(40)]
    rows += [(2000 + n, "w " * 300, "middle") for n in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes, longest = {}, {}
    for _, text, source in rows:
        words = len(text.split())
        sizes[source] = sizes.get(source, 0) + words
        longest[source] = max(longest.get(source, 0), words)
    goal, taken, kept = water(sizes), dict.fromkeys(sizes, 0), set()
    for r in mixing.mix(df, whole=True).collect():
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        kept |= {r.source} if r.copies else set()
    assert kept == set(sizes)
    for source, words in taken.items():
        shards = -(-sizes[source] // 4000)
        assert abs(words - goal[source]) <= 2 * mixing.BLOCK_WORDS + shards * longest[source]
