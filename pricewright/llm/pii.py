"""Personal data: fixed patterns, and terms that reveal it by their co-occurrence in the corpus.

1. Base spans: matches of the patterns for email, ip, card and phone that pass their tests.
2. The values found are the protected entities. A term is a run of letters and digits in lower case.
   Terms within ``REACH`` characters of an occurrence of an entity are its context, other matches
   of the patterns left out. The context is cut from the text beside the match, so no document is
   taken apart for it.
3. Over all documents, n(t) is the number with a term, n(e) with an entity, n(t, e) with the term in a
   context of the entity, N all. The pointwise mutual information ln(n(t,e) N / (n(t) n(e))), as a
   share of the entity's own information ln(N / n(e)), says how much of the entity the term discloses:
   1 if the term occurs in its contexts only, about 0 if it is independent.
4. A term that discloses at least ``THRESHOLD``, in at least ``SUPPORT`` different contexts of the
   entity (copies of a passage are one), adds a span wherever it stands, also in documents that do not
   hold the entity. With digits it is generalised, otherwise removed.

Only DataFrame operations are used. Positions come from the lengths of the matches and of the text
between them, in code points. The patterns are possessive, so no text makes them backtrack or recurse,
however long it is, and they match what the plain ones do.

Edge cases: a null text counts as empty and has no span; equal rows are separate documents; an empty
table gives an empty result; spans of different kinds may overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm import common

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: A run of name characters is tried from its start only, or from the end of the last match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]++"
REACH = 80
SUPPORT = 3
THRESHOLD = 0.8


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled, is divisible by 10."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0),
        lambda s, n: s + F.element_at(
            F.when((size - n) % 2 == 1, F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9])).otherwise(F.lit(list(range(10)))),
            F.substring(digits, n, F.lit(1)).cast("int") + 1,
        ),
    )
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(
        parts,
        lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")),
    )
    card = F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    return (
        F.when(kind == 1, small).when(kind == 2, card)
        .when(kind == 3, F.length(digits).between(8, 15)).otherwise(F.lit(True))
    )


def _matches(text: Column, kind: int) -> Column:
    """Array of (kind, n, gap before it, match, text beside it) of all matches of one kind."""
    pattern = F.lit(PATTERNS[KINDS[kind]])
    likely = {
        0: F.contains(text, F.lit("@")),
        1: text.rlike(r"[0-9]\.[0-9]"),
        2: text.rlike(r"(?:[0-9][\x20-]?){15}[0-9]"),
        3: F.contains(text, F.lit("+")),
    }[kind]
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    ends = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("gap"),
            # Whole terms only: what a border cuts through is left out.
            F.when(F.length(g) > REACH, F.regexp_replace(F.right(g, F.lit(REACH)), r"^[\p{L}\p{N}]+", "")).otherwise(g).alias("before"),
            F.when(F.length(g) > REACH, F.regexp_replace(F.left(g, F.lit(REACH)), r"[\p{L}\p{N}]+$", "")).otherwise(g).alias("after"),
        ),
    )
    rows = F.transform(
        F.arrays_zip(found.alias("found"), ends.alias("end"), F.slice(ends, F.lit(2), F.size(ends)).alias("next")),
        lambda x, n: F.struct(
            F.lit(kind).alias("kind"), n.alias("n"), x["end"]["gap"].alias("gap"), x["found"].alias("match"),
            x["end"]["before"].alias("before"), x["next"]["after"].alias("after"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,match:string,before:string,after:string>>")
    # The last gap has no match.
    return F.when(likely, F.filter(rows, lambda r: r["match"].isNotNull())).otherwise(none)


def _positions(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add ``start`` and ``end``, in code points, from gaps and matches in their order ``n``."""
    line = Window.partitionBy(F.struct(*by)).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(line)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - size)


def base_spans(marked: DataFrame) -> DataFrame:
    """``row``, ``kind``, ``start``, ``end``, ``match`` and the text ``before`` and ``after`` of the
    matches that pass their tests."""
    rows = marked.select("row", F.explode("found").alias("f")).select("row", "f.*")
    placed = _positions(rows, ["row", "kind"])
    return placed.where(_valid(F.col("kind"), F.col("match"))).select(
        "row", "kind", "start", "end", "match", "before", "after"
    )


def _terms(marked: DataFrame) -> DataFrame:
    """``row``, ``start``, ``end``, ``term`` of all terms of the given documents."""
    found = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    gaps = F.transform(F.split("text", TERM, -1), F.length)
    zipped = F.arrays_zip(found.alias("match"), gaps.alias("gap"))
    rows = marked.select("row", F.posexplode(zipped).alias("n", "z")).select("row", "n", "z.match", "z.gap")
    placed = _positions(rows.where("match IS NOT NULL"), ["row"])
    return placed.select("row", "start", "end", F.lower("match").alias("term"))


def _contexts(spans: DataFrame) -> DataFrame:
    """``row``, ``entity``, ``context``, ``term``: terms beside a span. Equal surroundings are one
    context, however often they were copied. A span without terms beside it has one row, of a null term."""
    everything = "|".join(f"(?:{p})" for p in PATTERNS.values())

    def terms(c: str) -> Column:
        return F.regexp_extract_all(F.lower(F.regexp_replace(c, everything, " ")), F.lit(TERM), F.lit(0))

    sides = spans.select(
        "row",
        F.concat_ws(":", F.col("kind").cast("string"), F.lower("match")).alias("entity"),
        terms("before").alias("b"),
        terms("after").alias("a"),
    )
    return sides.select(
        "row", "entity", F.xxhash64("b", "a").alias("context"), F.explode_outer(F.array_distinct(F.concat("b", "a"))).alias("term")
    )


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def disclosing(
    docs: DataFrame, text: str, contexts: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD
) -> DataFrame:
    """``entity``, ``term``, ``disclosed`` of the terms that disclose at least ``threshold`` of it."""
    seen = contexts.where("term IS NOT NULL").groupBy("entity", "term", "row", "context").agg(F.lit(1).alias("one"))
    pairs = (
        seen.groupBy("entity", "term")
        .agg(F.countDistinct("context").alias("contexts"), F.countDistinct("row").alias("together"))
        .where(F.col("contexts") >= support)
    )
    entities = contexts.select("entity", "row").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    words = docs.select(F.explode(_distinct_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = docs.select(F.count(F.lit(1)).alias("n"))
    size = total.first()["n"]
    own = F.ln(F.lit(float(max(size, 1))) / F.col("n_e"))
    shared = F.ln(F.col("together") * float(max(size, 1)) / (F.col("n_t") * F.col("n_e")))
    return (
        pairs.join(entities, "entity").join(words, "term")
        .withColumn("disclosed", F.try_divide(shared, own))
        .where(F.col("disclosed") >= threshold)
        .select("entity", "term", "disclosed")
    )


def find(
    df: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``text`` (of documents with matches or spans, else null) and ``found`` of every row: an array of
    (kind, start, end, action), base kinds by number and then ``term`` as number 4."""
    docs = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = F.concat(*[_matches(F.col("text"), n) for n in range(len(KINDS))])
    marked = common.stage(
        docs.select("doc_id", found.alias("found"), "text").withColumn("row", F.monotonically_increasing_id()),
        "pii-marked",
    )
    hits = marked.where(F.size("found") > 0)
    spans = common.stage(base_spans(hits), "pii-spans")
    contexts = _contexts(spans)
    telling = disclosing(docs, "text", contexts, support, threshold)
    revealing = common.stage(telling.select("term").distinct(), "pii-revealing")
    # A small table, which Spark broadcasts where it measures it so; every document meets it.
    each = marked.select("row", F.explode(_distinct_terms(F.col("text"))).alias("term"))
    revealed = common.stage(each.join(revealing, "term"), "pii-revealed")
    # Only documents that hold a revealing term are taken apart, with the entity or without.
    terms = _terms(marked.join(revealed.select("row").distinct(), "row", "left_semi"))
    covered = F.exists(
        "spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))
    )
    own = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    added = (
        terms.join(revealed, ["row", "term"]).join(own, "row", "left").where(F.coalesce(~covered, F.lit(True)))
        .select(
            "row", F.lit(len(KINDS)).alias("kind"), "start", "end",
            F.when(F.col("term").rlike(r"\p{N}"), "generalise").otherwise("remove").alias("action"),
        )
    )
    every = spans.select("row", "kind", "start", "end", F.lit("remove").alias("action")).unionByName(added)
    listed = every.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "action"))).alias("spans")
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,action:string>>")
    return (
        marked.select("row", "doc_id", "text", (F.size("found") > 0).alias("hit")).join(listed, "row", "left")
        .select(
            "doc_id", F.when(F.col("hit") | F.col("spans").isNotNull(), F.col("text")).alias("text"),
            F.coalesce("spans", none).alias("found"),
        )
    )


def listing(spans: Column) -> Column:
    """``kind:start:end`` of all spans, in their order, joined by commas."""
    names = F.lit([*KINDS, "term"])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with spans replaced: removed ones by their kind in brackets, generalised ones by #."""
    names = F.lit([f"[{k.upper()}]" for k in KINDS] + [""])
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s["kind"].alias("k"), s["action"].alias("c")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def put(acc: Column, s: Column) -> Column:
        sign = F.when(s["c"] == "generalise", F.lit("#")).otherwise(F.element_at(names, s["k"] + 1))
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["a"] - acc["at"]).cast("int"))
        moved = F.struct(F.concat(acc["out"], before, sign).alias("out"), (-s["b"]).alias("at"))
        inside = F.struct(acc["out"].alias("out"), F.greatest(acc["at"], -s["b"]).alias("at"))
        return F.when(s["a"] >= acc["at"], moved).otherwise(inside)

    done = F.aggregate(ordered, start, put)
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
