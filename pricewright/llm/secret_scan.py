"""Secrets: rules that are regular expressions, found through an inverted index of trigrams.

1. From each rule's expression follows a Boolean query: which trigrams, of lower-cased text, every match
   must hold, as an OR of ANDs (``required``). Parts without a mandatory trigram ask for nothing; a rule
   of such parts only has no query and scans every document.
2. The index has a row per trigram that some rule asks for and document that holds it. A rule's postings
   are intersected by document: a document is a candidate where all trigrams of one AND meet.
3. Candidates are verified by the rule's expression, which gives the spans. Rules without a query are
   verified while the index is made, in the same reading.

Only DataFrame operations are used. Postings are grouped by document and AND, so a trigram that every
document holds is no hot key; only texts of candidates are read again, and a document's matches are
placed by running sums over the lengths of matches and of the text between them, in code points. No
rule's expression backtracks over a run of characters or recurses with it, however long a text is.

Edge cases: a null text counts as empty and has no span; equal rows are separate documents; spans of
different kinds may overlap; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm import common


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, otherwise the match is dropped."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


#: The first three kinds. A match that is too short in the plain pattern is no match in
#: ``access`` and ``hex``, as no later start in the same run is longer.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)
#: Public formats of further credentials.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@]{1,100}:[^\x00-\x20/@]{1,100}@"),
)
RULES = (*BASE, *MORE)

#: Strings that a part of an expression may stand for, and ANDs of a query, before they count as any text.
MOST_STRINGS = 64
#: Trigrams that one AND asks for. Fewer ask for less, so matches still answer, and the index is smaller.
MOST_ASKED = 4
#: Characters that a class may have to be spelled out.
MOST_CLASS = 8

#: Any text: one AND that asks for nothing.
_ANY = frozenset([frozenset()])


def _simple(query: frozenset) -> frozenset:
    """Without ANDs that ask for more than another one."""
    least = frozenset(a for a in query if not any(b < a for b in query))
    return least if len(least) <= MOST_STRINGS else _ANY


def _both(a: frozenset, b: frozenset) -> frozenset:
    return _simple(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= MOST_STRINGS**2 else a


def _of_strings(strings: frozenset) -> frozenset:
    """Query for texts that hold one of the strings."""
    return _simple(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _characters(node: list) -> frozenset | None:
    """Characters of a class in lower case, if there are few."""
    found: set[str] = set()
    for kind, value in node:
        if kind is K.LITERAL:
            found.add(chr(value).lower())
        elif kind is K.RANGE and value[1] - value[0] <= 2 * MOST_CLASS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CLASS else None


def _part(kind: object, value: object) -> tuple[frozenset | None, frozenset]:
    """Of one part: the strings it can be, None if they are too many, and the query it asks."""
    if kind is K.LITERAL:
        return frozenset([chr(value).lower()]), _ANY
    if kind is K.IN:
        return _characters(value), _ANY
    if kind in (K.AT, K.ASSERT, K.ASSERT_NOT):
        return frozenset([""]), _ANY
    if kind is K.SUBPATTERN:
        return _sequence(value[3])
    if kind is K.ATOMIC_GROUP:
        return _sequence(value)
    if kind is K.BRANCH:
        ways = [_sequence(way) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            every = frozenset().union(*[strings for strings, _ in ways])
            if len(every) <= MOST_STRINGS:
                return every, _ANY
        asked = [query if strings is None else _of_strings(strings) for strings, query in ways]
        return None, _simple(frozenset().union(*asked))
    if kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if least == 0:
            return (strings | {""} if strings is not None and most == 1 else None), _ANY
        if strings is not None and least == most == 1:
            return strings, query
        return None, query if strings is None else _of_strings(strings)
    return None, _ANY


def _sequence(parts: Sequence) -> tuple[frozenset | None, frozenset]:
    """The same of parts one after another. Strings are joined as long as they are few; what ends a run
    of them adds the run's query."""
    run, query, whole = frozenset([""]), _ANY, True
    for kind, value in parts:
        strings, asked = _part(kind, value)
        query = _both(query, asked)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        query = _both(query, _of_strings(run))
        whole = whole and strings is not None
        # Where strings are known, what follows goes on from them.
        run, whole = (strings, False) if strings is not None else (frozenset([""]), False)
    if whole:
        return run, query
    return None, _both(query, _of_strings(run))


def required(pattern: str) -> frozenset[frozenset[str]]:
    """ANDs of trigrams, one of which the lower-cased text of every match holds. One empty AND: any text."""
    strings, query = _sequence(parser.parse(pattern))
    query = query if strings is None else _both(query, _of_strings(strings))
    # Signs and digits are rarer than letters.
    return _simple(frozenset(frozenset(sorted(a, key=lambda t: (t.isalpha(), t))[:MOST_ASKED]) for a in query))


def trigram_index(marked: DataFrame, wanted: Sequence[str], text: str = "text") -> Column:
    """Those of the wanted trigrams that the lower-cased text holds."""
    # As a lambda's variable the lower-cased text is made once.
    held = F.transform(
        F.array(F.lower(marked[text])),
        lambda low: F.filter(F.lit(list(wanted)), lambda t: F.contains(low, t)),
    )
    return F.get(held, F.lit(0))


def _matches(text: Column, rules: Sequence[tuple[int, Rule]]) -> Column:
    """Array of (kind, n, gap before it, match, long enough) of all matches of the rules."""
    every = []
    for kind, rule in rules:
        pattern = F.lit(rule.pattern)
        found = F.regexp_extract_all(text, pattern, F.lit(0))
        told = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
        gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
        rows = F.transform(
            F.arrays_zip(found.alias("match"), gaps.alias("gap"), told.alias("told")),
            lambda x, n: F.struct(
                F.lit(kind).alias("kind"), n.alias("n"), x["gap"].alias("gap"), x["match"].alias("match"),
                (x["told"] >= rule.least).alias("fits"),
            ),
        )
        # The last gap has no match.
        some = F.filter(rows, lambda r: r["match"].isNotNull())
        none = F.array().cast("array<struct<kind:int,n:int,gap:int,match:string,fits:boolean>>")
        every.append(F.when(text.rlike(rule.pattern), some).otherwise(none))
    return F.concat(*every)


def _spans(rows: DataFrame, found: Column) -> DataFrame:
    """``row``, ``start``, ``kind``, ``end``, ``match`` of the matches that fit."""
    each = rows.select("row", F.explode(found).alias("f")).select("row", "f.*")
    line = Window.partitionBy(F.struct("row", "kind")).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    placed = each.withColumn("end", F.sum(F.col("gap") + size).over(line)).withColumn("start", F.col("end") - size)
    return placed.where("fits").select("row", "start", "kind", "end", "match")


def candidates(index: DataFrame, queries: dict[int, frozenset[frozenset[str]]]) -> DataFrame:
    """``row`` and the array ``kinds`` of rules whose query its postings answer."""
    spark = index.sparkSession
    terms = [
        (t, kind, number, len(wanted))
        for kind, query in queries.items()
        for number, wanted in enumerate(sorted(query, key=sorted))
        for t in sorted(wanted)
    ]
    # A row for each trigram that a rule asks for: the rules bound it.
    asked = spark.createDataFrame(terms, "trigram string, kind int, number int, size int")
    met = (
        index.join(F.broadcast(asked), "trigram")
        .groupBy(F.struct("row", "kind", "number", "size").alias("k"))
        .agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") == F.col("k.size"))
    )
    return met.groupBy(F.col("k.row").alias("row")).agg(F.collect_set("k.kind").alias("kinds"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id`` and ``found`` of every row: an array of (start, kind, end, match) in that order, ``kind``
    being the rule's number."""
    queries = {n: required(rule.pattern) for n, rule in enumerate(rules)}
    indexed = {n: q for n, q in queries.items() if q != _ANY}
    full = [(n, r) for n, r in enumerate(rules) if n not in indexed]
    wanted = sorted({t for q in indexed.values() for a in q for t in a})
    docs = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,match:string,fits:boolean>>")
    marked = common.stage(
        docs.select(
            "row", "doc_id", "text",
            (trigram_index(docs, wanted) if wanted else F.array().cast("array<string>")).alias("trigrams"),
            (_matches(F.col("text"), full) if full else none).alias("scanned"),
        ),
        "secrets-marked",
    )
    spans = _spans(marked.where(F.size("scanned") > 0), F.col("scanned"))
    if indexed:
        index = common.stage(marked.select(F.explode("trigrams").alias("trigram"), "row"), "secrets-index")
        chosen = candidates(index, indexed)
        read = marked.select("row", "text").join(chosen, "row")
        by_rule = [
            F.when(F.array_contains("kinds", n), _matches(F.col("text"), [(n, rules[n])])).otherwise(none)
            for n in indexed
        ]
        verified = common.stage(
            read.select("row", F.concat(*by_rule).alias("matches")).where(F.size("matches") > 0), "secrets-verified"
        )
        spans = spans.unionByName(_spans(verified, F.col("matches")))
    listed = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "match"))).alias("found")
    )
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")
    return marked.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id", F.coalesce("found", nothing).alias("found")
    )


def listing(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``kind:start:end`` of all spans, in their order, joined by commas."""
    names = F.lit([r.name for r in rules])
    said = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(said, ",")
