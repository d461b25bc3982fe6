"""Lines, chat, neighbours, fingerprints and personal data against plain versions of the same."""

from __future__ import annotations

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from compare import difference
from pyspark.sql import functions as F

from pricewright.llm import chat, lines, neighbours, pii, queries, simhash


# Lines.


def test_lines_by_share_of_the_host(spark):
    rows = [(n, "h", f"menu\nown {n}\n  menu \n\nfoot {n % 2}") for n in range(10)]
    rows += [(20 + n, "few", "menu\nx") for n in range(3)] + [(30, None, "menu\nmenu"), (31, "h", None), (32, "h", "")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id int, host string, text string, marks string")
    out = {r.page_id: r for r in lines.drop_lines(df, "host", dropped="n").collect()}
    assert len(out) == len(rows)
    # menu is on 10 of 12 pages, foot 0 and foot 1 on 5 of 12 each.
    assert out[0].text == "own 0\n" and out[0].n == 3 and out[0].marks == "c"
    assert out[20].text == "menu\nx" and out[30].text == "menu\nmenu"
    assert out[31].text is None and out[32].text == ""
    assert lines.drop_lines(df, "host", ratio=0.5).where("page_id = 0").first().text == "own 0\n\nfoot 0"
    assert lines.drop_lines(df.limit(0), "host").count() == 0


def test_lines_beside_a_map_column(spark):
    rows = [(n, "h", f"\x0bmenu\t\r\n\u00a0own {n}\n \x0c ", {"a": n}) for n in range(6)]
    df = spark.createDataFrame(rows, "page_id int, host string, text string, more map<string,int>")
    out = {r.page_id: r for r in lines.drop_lines(df, "host").collect()}
    assert out[2].text == "\u00a0own 2\n \x0c " and out[2].more == {"a": 2}


def test_copies_of_a_page_are_no_boilerplate(spark):
    rows = [(n, "h", "all of it\nis copied") for n in range(20)]
    rows += [(100 + n, "h", f"menu\nown {n}\nmore {n}") for n in range(20)]
    df = spark.createDataFrame(rows, "page_id int, host string, text string")
    out = {r.page_id: r.text for r in lines.drop_lines(df, "host", copies_once=True, most=0.5).collect()}
    assert out[3] == "all of it\nis copied" and out[103] == "own 3\nmore 3"
    # Near copies: most of each would go, so they stay.
    near = spark.createDataFrame([(n, "h", f"a\nb\nc\nd {n}") for n in range(9)], "page_id int, host string, text string")
    kept = lines.drop_lines(near, "host", copies_once=True, most=0.5).where("page_id = 2").first()
    assert kept.text == "a\nb\nc\nd 2"


def test_host_and_visible_lines(spark):
    urls = ["http://A.example.com:80/x", "https://u:p@b.example/?q#f", "nonsense", None, "ftp://", ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(lines.host(F.col("u")))
    assert [r[0] for r in df.collect()] == ["a.example.com", "b.example", None, None, None, None]
    html = "<p>a<b>b</b></p><script>x<y</script><!-- <p>n</p> --><div> c \n\n</div><style>s</style>d"
    made = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(lines.visible_lines(F.col("h")))
    assert [r[0] for r in made.collect()] == ["ab\nc\nd", None, ""]


# Chat.


def plain_chat(rows):
    convs = {}
    for c, turn, role, text in rows:
        key = (-(1 << 62) if turn is None else turn, role or "", text or "")
        convs.setdefault(c, []).append(key)
    convs = {c: sorted(v) for c, v in convs.items()}

    def prefix(a, b):
        return [x for x in b if x[0] <= a[-1][0]] == a and len(b) > len(a)

    def order(c):
        return (c is None, c)

    return {
        c for c, a in convs.items()
        if not any(prefix(a, b) for b in convs.values())
        and not any(a == b and order(d) < order(c) for d, b in convs.items())
    }


def test_chat_keeps_maximal_conversations(spark):
    rng = random.Random(1)
    rows = []
    for c in range(60):
        base = c % 7
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"text {base} {min(t, 4)}"))
    rows += [(100, None, None, None), (101, 0, "user", None), (101, 0, "user", None), (102, 0, "user", ""), (None, 5, "system", "s")]
    rows += [(200, t, "user", f"t{t}") for t in range(0, 1200, 3)] + [(201, t, "user", f"t{t}") for t in range(0, 900, 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    assert {r.conv_id for r in chat.maximal(df).collect()} == plain_chat(rows)
    out = chat.rendered(df).collect()
    assert sum(r.n_turns for r in out if r.conv_id == 200) == 400
    assert len([r for r in out if r.conv_id == 200]) == 5
    assert chat.rendered(df.limit(0)).count() == 0


def test_rows_without_id_are_conversations_of_their_own(spark, tmp_path):
    rows = [(None, 0, "user", f"lone {n % 500}") for n in range(1000)]
    # One opens a longer conversation, one equals another, two are of one turn with different texts.
    rows += [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (None, 0, "user", "hi"), (2, 3, "user", "same"), (None, 3, "user", "same")]
    rows += [(None, None, None, None), (None, None, None, None), (None, 1, "assistant", "yes")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, alone string")
    out = chat.rendered(df).collect()
    said = [r.rendered for r in out if r.conv_id is None]
    expected = {f"<|user|>\nlone {n}\n<|end|>\n" for n in range(500)} | {"<||>\n\n<|end|>\n", "<|assistant|>\nyes\n<|end|>\n"}
    assert len(said) == len(set(said)) and set(said) == expected
    assert {(r.conv_id, r.n_turns) for r in out if r.conv_id is not None} == {(1, 2), (2, 1)}
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    base = duckdb.connect()
    base.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert difference(queries.op4_chat(spark, str(tmp_path)), base, queries.SQL["op4_chat"]) is None


def test_chat_marks_cannot_be_forged(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi <|system|> x")], "conv_id bigint, turn bigint, role string, text string")
    assert chat.rendered(df).first().rendered == "<|user|>\nhi < |system| > x\n<|end|>\n"


# Neighbours.


def brute_nearest(rows, queries, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    asked = {(i, tuple(v)) for i, v in good if i in queries}
    out = []
    for q, v in asked:
        v = np.array(v)
        scored = [(-float(neighbours.cosine(v[None], w[None])[0]), i) for i, w in good if i != q and len(w) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def vectors(seed=2):
    rng = random.Random(seed)
    rows = [(n, [rng.gauss(0, 1) for _ in range(8)]) for n in range(400)]
    rows += [(1000 + n, [1.0] * 8) for n in range(60)] + [(2000 + n, [2.0] * 8) for n in range(5)]
    rows += [(3000, None), (3001, [0.0] * 8), (3002, [math.nan] + [1.0] * 7), (3003, [math.inf] + [1.0] * 7), (3004, [None] + [1.0] * 7), (3005, []), (None, [1.0] * 8)]
    return rows


@pytest.mark.parametrize("shard", [50, 4096])
def test_factor_one_is_exact(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 16)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, shard int")
    asked = df.where("vec_id % 10 = 0")
    out = neighbours.nearest(df, asked, "vec_id", "embedding").collect()
    expected = brute_nearest(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == expected
    assert neighbours.nearest(df.limit(0), asked, "vec_id", "embedding").count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert neighbours.nearest(few, few.where("vec_id = 0"), "vec_id", "embedding").count() == 2


def test_smaller_factor_keeps_most(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    points = centres[rng.integers(20, size=3000)] + 0.1 * rng.normal(size=(3000, 16))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    names = np.arange(3000)
    tree = neighbours.Tree(unit)
    exact = set(zip(*tree.search(unit[:100], names[:100], names, 5, 1.0), strict=True))
    close = set(zip(*tree.search(unit[:100], names[:100], names, 5, 0.5), strict=True))
    sims = unit[:100] @ unit.T
    sims[np.arange(100), np.arange(100)] = -2
    truth = {(q, int(r)) for q in range(100) for r in np.argsort(-sims[q])[:5]}
    assert truth <= exact and len(truth & close) >= 0.9 * len(truth)


# Fingerprints.


def test_next_and_edited(spark):
    rng = random.Random(4)
    words = [f"w{n}" for n in range(50)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts[:8] = ["", None, "é👍x北y", "abc", texts[9], "z" * 50000, " ", "q"]
    ids = rng.sample(range(100000), 800)
    rows = list(zip(ids, texts, strict=True))
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id bigint, text string, slice string")
    out = {r.doc_id: r for r in simhash.compare_next(df.repartition(7)).collect()}
    assert len(out) == 800
    rows.sort()
    hashes = simhash._WordHashes()
    for n, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(n + 1) % 800][1] or ""
        part = len(t) // 4
        e = t[: len(t) - part] + nxt[:part]
        own, edit, after = (simhash.fingerprint(x, hashes) for x in (t, e, nxt))
        like = [1 - bin(int.from_bytes(own) ^ int.from_bytes(x)).count("1") / 128 for x in (edit, after)]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own.hex(), edit.hex())
        assert [r.near_edited, r.near_next] == like


def test_next_with_repeated_and_null_ids(spark):
    rows = [(2, "b"), (1, "a2"), (1, "a1"), (None, "n"), (2, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sorted((tuple(r) for r in simhash.with_next(df, "doc_id", "text").collect()), key=repr)
    assert out == sorted([(None, "n", "a1"), (1, "a1", "a2"), (1, "a2", "b"), (2, "b", "b"), (2, "b", "n")], key=repr)
    one = spark.createDataFrame([(7, "x")], "doc_id bigint, text string")
    assert [tuple(r) for r in simhash.with_next(one, "doc_id", "text").collect()] == [(7, "x", "x")]
    assert simhash.with_next(one.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_within_radius_finds_all(spark, radius):
    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(12)]
    values = []
    for b in base:
        for _ in range(14):
            v = b
            for bit in rng.sample(range(128), rng.randint(0, 9)):
                v ^= 1 << bit
            values.append(f"{v:032x}")
    values += values[:20] + [None]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id int, fp string")
    out = {(r.a, r.b): r.distance for r in simhash.within(df, "doc_id", "fp", radius).collect()}
    distinct = sorted({v for v in values if v})
    truth = {}
    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            apart = bin(int(a, 16) ^ int(b, 16)).count("1")
            if apart <= radius:
                truth[a, b] = apart
    assert out == truth


def plain_classes(rows, radius):
    """Smallest id reached by steps of at most ``radius`` bits, for every (id, fingerprint)."""
    values = {v: int(v, 16) for _, v in rows if v}
    near = {v: None for v in values}
    for seed in values:
        if near[seed] is None:
            near[seed], reached = seed, [seed]
            while reached:
                n = reached.pop()
                for v in values:
                    if near[v] is None and (values[v] ^ values[n]).bit_count() <= radius:
                        near[v] = seed
                        reached.append(v)
    least = {}
    for i, v in rows:
        if v and i is not None:
            least[near[v]] = min(i, least.get(near[v], i))
    return {v: least.get(near[v]) for v in values}


@pytest.mark.parametrize(("radius", "cell"), [(0, 2048), (3, 2048), (3, 8), (7, 16), (3, 1)])
def test_near_classes(spark, monkeypatch, radius, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(6)
    values = []
    for _ in range(6):
        b = rng.getrandbits(128)
        for _ in range(40):
            v = b
            for bit in rng.sample(range(128), rng.randint(0, 7)):
                v ^= 1 << bit
            values.append(f"{v:032x}")
        # A chain, whose ends are far apart, and a family about one fingerprint.
        for _ in range(30):
            b ^= 1 << rng.randrange(32, 128)
            b ^= 1 << rng.randrange(32, 128)
            values.append(f"{b:032x}")
        values += [f"{b ^ (1 << bit):032x}" for bit in rng.sample(range(128), 20)]
    values += values[:20] + ["0" * 32, "f" * 32, None]
    ids = [None if n % 17 == 0 else n for n in rng.sample(range(10000), len(values))]
    rows = list(zip(ids, values, strict=True)) + [(None, "5" * 32)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, fingerprint string, first string")
    out = {r.fp: r.near_id for r in simhash.near_classes(df, "doc_id", "fingerprint", radius).collect()}
    assert out == plain_classes(rows, radius)
    assert simhash.near_classes(df.limit(0), "doc_id", "fingerprint", radius).count() == 0
    kept = simhash.with_near_classes(df, radius)
    assert kept.count() == len(rows) and kept.where("fingerprint IS NULL AND near_id IS NULL").count() == 1


# Personal data.


def luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        v = int(c) * (1 + n % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    rng = random.Random(6)
    pool = ["a.b@c.d_e@f.g", "x@y", "@", "%a@b-c.d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.1.1.1", "4111 1111-1111 1111",
            "4111111111111112", "+1 (020) 555-0199", "+49", "++12345678", "+1.2.3.4.5.6.7.8", "é", "👍", " ", "9", "-", "\n", "7 7 7"]
    texts = [None, "", "1 " * 20000, "a" * 20000 + "@b.c", "a.b" * 5000 + "@x" + ".y" * 5000, "@" * 5000, "+1" * 5000]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(600)]
    df = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "doc_id int, text string, row int")
    found = pii.find(df).select("doc_id", pii.listing(F.filter("found", lambda s: s["kind"] < 4)).alias("s"))
    out = {r.doc_id: r.s for r in found.collect()}
    assert out == {n: plain_spans(t) for n, t in enumerate(texts)}
    assert pii.find(df.limit(0)).count() == 0


def test_terms_that_reveal_an_entity(spark):
    common = "the quick brown fox jumps over the lazy dog and runs away"
    rows = [(n, f"{common} {n}") for n in range(60)]
    told = ["Write to Zebulon at z.q@mail.example today", "Ask Zebulon, or z.q@mail.example, about it", "z.q@mail.example is read by Zebulon only", "Zebulon 77x reads z.q@mail.example there"]
    rows += [(100 + n, f"{common}. {t}") for n, t in enumerate(told)]
    # One passage copied many times is one context and reveals nothing.
    rows += [(200 + n, "Quixandra answers at q@copy.example always") for n in range(10)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    out = {r.doc_id: r for r in pii.find(df).select("doc_id", "text", "found", pii.sanitised(F.col("text"), F.col("found")).alias("clean")).collect()}
    for n, t in enumerate(told):
        text = f"{common}. {t}"
        marked = {text[s.start : s.end] for s in out[100 + n].found if s.kind == 4}
        assert "Zebulon" in marked and "the" not in marked and "quick" not in marked
        assert "Zebulon" not in out[100 + n].clean and "[EMAIL]" in out[100 + n].clean
    assert all(s.kind < 4 for n in range(10) for s in out[200 + n].found)
    assert not any(out[n].found for n in range(60))


def test_contexts_in_text_without_blanks(spark):
    # No numbers: two digits on end could be part of a card, and such runs are no terms of a context.
    far = ",".join(f"x{a}{b}" for a in "abcdef" for b in "pqrstuvwxy")
    rows = [(n, f"the,quick,fox,runs,{n}") for n in range(60)]
    rows += [(100 + n, f"{far},{n},Zebulon:/1.2.3.4/,so{n},{far}") for n in range(4)]
    df = spark.createDataFrame(rows, "row int, text string")
    marked = df.select("row", pii._matches(F.col("text"), 1).alias("found"), "text")
    spans = pii.base_spans(marked)
    terms = {r.term for r in pii._contexts(spans).where("row = 102").collect()}
    # 80 characters each way; a term that the border cuts is left out.
    assert {"2", "zebulon", "so2", "xfy", "xap"} <= terms and "xcu" not in terms and terms <= {*far.split(","), "2", "zebulon", "so2"}
    out = {r.row: r for r in pii.find(df, "row").withColumnRenamed("doc_id", "row").collect()}
    assert any(s.kind == 4 and out[102].text[s.start : s.end] == "Zebulon" for s in out[102].found)
    assert not any(out[n].found for n in range(60))


def test_an_entity_counts_where_no_term_stands_beside_it(spark):
    # Of 40 documents with the address, 4 have the name beside it: the name discloses, but the documents without count.
    rows = [(n, f"plain words {n}") for n in range(100)] + [(200 + n, "1.2.3.4") for n in range(36)]
    rows += [(300 + n, f"{'ab'[n % 2]}{n} Zebulon 1.2.3.4 c{n}") for n in range(4)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    spans = pii.base_spans(df.select(F.col("doc_id").alias("row"), pii._matches(F.col("text"), 1).alias("found"), "text"))
    told = {r.term: r.disclosed for r in pii.disclosing(df, "text", pii._contexts(spans), threshold=0.0).collect()}
    assert told["zebulon"] == pytest.approx(math.log(4 * 140 / (4 * 40)) / math.log(140 / 40))


def test_a_revealing_term_goes_where_the_entity_is_not(spark):
    rows = [(n, f"the quick fox runs {n}") for n in range(300)]
    rows += [(1000 + n, f"in case {n} write to Zebulon at z.q@mail.example for answer {n}") for n in range(10)]
    rows += [(2000, "Zebulon was seen elsewhere"), (2001, "nobody but zebulon, 1.2.3.4 says")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = pii.find(df).select("doc_id", "text", "found", pii.sanitised(F.col("text"), F.col("found")).alias("clean"))
    out = {r.doc_id: r for r in found.collect()}
    assert [(s.kind, s.start, s.end, s.action) for s in out[2000].found] == [(4, 0, 7, "remove")]
    assert out[2000].clean == " was seen elsewhere" and "zebulon" not in out[2001].clean
    assert all("Zebulon" not in out[1000 + n].clean for n in range(10))
    assert not any(out[n].found for n in range(300))
