"""Secret scans against the plain patterns; trigram queries against strings that match."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from pricewright.llm import secret_scan
from pricewright.llm.queries import QUERIES
from pricewright.llm.secret_scan import required

FOLDER = "/root/testdata/sf0.001"
KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
PLAIN = {
    "assign": (re.compile(rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def plain(text):
    return [
        (m.start(), kind, m.end()) for kind, (pattern, group, least) in PLAIN.items()
        for m in pattern.finditer(text or "") if len(m.group(group)) >= least
    ]


def said(spans):
    order = list(PLAIN)
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], order.index(s[1]))))


def test_query_equals_plain_patterns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op13_secrets"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = plain(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in found) for n in PLAIN)
        assert r.base_sha256 == hashlib.sha256(said(found).encode()).hexdigest()


def scanned(spark, texts, **more):
    df = spark.createDataFrame([(n, t, "x", {"a": 1}) for n, t in enumerate(texts)], "doc_id bigint, text string, row string, kinds map<string,int>")
    out = secret_scan.scan(df, **more).collect()
    assert len(out) == len(texts)
    return {r.doc_id: [(s.start, more.get("rules", secret_scan.RULES)[s.kind].name, s.end, s.match) for s in r.found] for r in out}


def test_base_kinds_on_made_up_texts(spark):
    rng = random.Random(4)
    bits = [
        "password", "PassWd", "toKen", "secret", "api_key", "APIKEY", "api__key", "paſsword", "toKen", '"', "'", " ", "  ",
        ":", "=", "==", "abc", "abcdef", "a1/+_.=-", "AKIA", "AKIAABCDEFGH", "IJKLMNOP0123", "0123456789ab", "cdef" * 5, "é", "😀",
        "\n", "\t", "G", "deadbeef",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(600)]
    texts += [None, "", "token=token:abcdefgh", "token=secret=abcdefg", "password:  'hunter2x'", "f" * 24, "f" * 23 + "G" + "0" * 30]
    texts += ["a" * 200_000 + " AKIA" + "B" * 16, ("token: abc " * 3000) + "token: abcdefg", "passwd=" + "x" * 100_000]
    found = scanned(spark, texts)
    for n, text in enumerate(texts):
        own = [(a, k, b) for a, k, b, _ in found[n] if k in PLAIN]
        assert sorted(own) == sorted(plain(text)), text
        assert all((text or "")[a:b] == m for a, _, b, m in found[n])


def test_further_credentials(spark):
    texts = [
        "x -----BEGIN RSA PRIVATE KEY-----\nMII", "-----BEGIN " + "A " * 5000 + "PRIVATE KEY-----", "é ghp_" + "a1" * 18 + "!",
        "AIza" + "x" * 35, "xoxb-1234567890-abc", "sk_live_" + "0" * 16, "eyJhbGciOi0.eyJzdWIiOiIx.s-_1", "see https://bob:pw1@host/x",
        "https://host:80/a@b", "ghp_short AIza xoxb-1 sk_live_1 eyJ.eyJ.",
    ]
    found = scanned(spark, texts)
    kinds = [[k for _, k, _, _ in found[n] if k not in PLAIN] for n in range(len(texts))]
    assert kinds == [["private_key"], [], ["github"], ["google"], ["slack"], ["stripe"], ["jwt"], ["url_login"], [], []]
    assert found[2][0][:3] == (2, "github", 42)


def test_rules_of_ones_own(spark):
    rules = [secret_scan.Rule("digits", r"[0-9]{3,}+"), secret_scan.Rule("word", r"foo(?:bar|baz)?-?x", 0, 4)]
    texts = ["foox fooba 12", "a foobar-x 1234", "FOOBAR-X", "", None]
    found = scanned(spark, texts, rules=rules)
    assert [found[n] for n in range(5)] == [
        [(0, "word", 4, "foox")], [(2, "word", 10, "foobar-x"), (11, "digits", 15, "1234")], [], [], []
    ]
    assert [x for x in scanned(spark, ["abc 123"], rules=rules[:1])[0]] == [(4, "digits", 7, "123")]
    assert secret_scan.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_trigram_queries():
    assert required("AKIA[A-Z0-9]{16,}") == {frozenset({"aki", "kia"})}
    assert required("[0-9a-f]{24,}") == {frozenset()} == required("ab") == required("abcd|x*")
    assert required("abc(?:d|e)f?") == {frozenset({"abc", "bcd"}), frozenset({"abc", "bce"})}
    assert required("(abc)+.*xyz") == {frozenset({"abc", "xyz"})}
    assert required("ab?cd") == {frozenset({"abc", "bcd"}), frozenset({"acd"})}
    assert required("[a-z]{3}_key") == {frozenset({"_ke", "key"})}
    assert required("(?:abc){0,4}def") == {frozenset({"def"})}


@pytest.mark.parametrize("seed", range(5))
def test_every_match_answers_its_query(seed):
    """Texts made from random expressions: one of the ANDs holds in each."""
    rng = random.Random(seed)

    def make(depth):
        kind = rng.randrange(6 if depth else 2)
        if kind < 2:
            word = "".join(rng.choice("abcDE_") for _ in range(rng.randrange(1, 5)))
            return word, lambda: word
        if kind == 2:
            chars = rng.sample("abcdefghijklmn", rng.randrange(1, 12))
            return f"[{''.join(chars)}]", lambda: rng.choice(chars)
        if kind == 3:
            ways = [make(depth - 1) for _ in range(rng.randrange(1, 4))]
            return f"(?:{'|'.join(w[0] for w in ways)})", lambda: rng.choice(ways)[1]()
        if kind == 4:
            inner, text = make(depth - 1)
            low, high = rng.choice([(0, 1), (0, 3), (1, 2), (2, 3), (1, 1)])
            return f"(?:{inner}){{{low},{high}}}", lambda: "".join(text() for _ in range(rng.randint(low, high)))
        parts = [make(depth - 1) for _ in range(rng.randrange(1, 5))]
        return "".join(p[0] for p in parts), lambda: "".join(p[1]() for p in parts)

    for _ in range(200):
        pattern, text = make(3)
        query = required(pattern)
        for _ in range(5):
            made = text()
            assert re.fullmatch(pattern, made)
            low = made.lower()
            assert any(all(t in low for t in wanted) for wanted in query), (pattern, made, query)


def test_candidates_come_from_postings(spark):
    index = spark.createDataFrame([("aki", 1), ("kia", 1), ("aki", 2), ("tok", 2), ("oke", 2), ("ken", 2)], "trigram string, row long")
    got = {r.row: sorted(r.kinds) for r in secret_scan.candidates(index, {0: required("token|passwd"), 1: required("AKIA")}).collect()}
    assert got == {1: [1], 2: [0]}


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_secrets"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
