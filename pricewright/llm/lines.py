"""Line deduplication by site-relative frequency.

Lines are counted once for each page of a host; a line on more than ``ratio`` of the host's pages, of
which there must be at least ``least_pages``, is boilerplate there and is dropped from every page.

Counts are added up before the shuffle, so a hot host or line is a few rows. A host's boilerplate has
at most (lines of an average page) / ``ratio`` entries, so its list is small; pages meet it in a join
by host and a salt, so that a hot host is many tasks.

Where pages may be whole copies of each other, ``copies_once`` counts equal texts of a host once.
``near_once`` counts a line once for each group of near copies, by the links of ``minhash``, among the texts
that hold lines over ``ratio``; pages still number as without it, so it only takes lines off the list.
``most`` leaves a page alone that would lose more than that share of its lines.

Edge cases: a null text stays null, an empty one empty; a page without a host keeps its lines; lines
are compared without white space at their ends; blank lines are no lines and stay; repeated rows are
separate pages; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import common, minhash

RATIO = 0.3
LEAST_PAGES = 4
#: Places that the pages of one site are dealt to.
SALTS = 32


def host(url: Column) -> Column:
    """Host of a web address in lower case, without port; null where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def visible_lines(html: Column) -> Column:
    """Text of a page, a line for each block element."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)>", "")
    blocks = F.regexp_replace(
        bare, r"(?i)</?(?:p|div|li|ul|ol|nav|h[1-6]|article|section|br|table|tr|title|head|body|footer|header)\b[^>]*>", "\n"
    )
    plain = F.regexp_replace(blocks, r"<[^>]*>", "")
    return F.regexp_replace(F.regexp_replace(plain, r"[ \t\r]*\n[ \t\r\n]*", "\n"), r"^\n|\n$", "")


def _mark(line: Column) -> Column:
    """Hash of a line without white space at its ends."""
    return F.xxhash64(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def boilerplate(
    df: DataFrame,
    site: str,
    text: str,
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    copies_once: bool = False,
    near_once: bool = False,
) -> DataFrame:
    """``site`` and the array ``marks`` of its boilerplate lines' hashes; sites without any are absent."""
    pages = df.select(F.col(site).alias("site"), F.col(text).alias("text")).where(
        F.col("site").isNotNull()
    )
    pages = pages.select("site", F.array_distinct(_marks(F.col("text"))).alias("marks"), F.xxhash64("text").alias("h"))
    if copies_once:
        # One struct as key, so that a site is many tasks.
        once = pages.groupBy(F.struct("site", "h").alias("k")).agg(F.first("marks").alias("marks"))
        pages = once.select("k.site", "marks")
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    seen = (
        pages.select("site", F.explode("marks").alias("mark"))
        .groupBy("site", "mark")
        .agg(F.count(F.lit(1)).alias("on"))
        .where(F.col("on") >= F.lit(max(2.0, ratio * least_pages)))
    )
    frequent = seen.join(totals, "site").where(
        (F.col("pages") >= least_pages) & (F.col("on") > F.col("pages") * F.lit(ratio))
    )
    listed = frequent.groupBy("site").agg(
        F.array_sort(F.collect_list("mark")).alias("marks"), F.first("pages").alias("pages")
    )
    if near_once:
        return _of_families(df, site, text, listed, ratio, least_pages)
    return listed.select("site", "marks")


def _of_families(
    df: DataFrame, site: str, text: str, listed: DataFrame, ratio: float, least_pages: int
) -> DataFrame:
    """What is left of ``listed`` if near copies that hold its lines count once."""
    listed = common.stage(listed, "lines-listed")
    pages = df.select(F.col(site).alias("own"), F.col(text).alias("text"))
    met = _dealt(pages, "own", listed, "site", "marks", "salt", "their_salt", how="inner")
    held = (
        met.select("site", "text", F.array_intersect(_marks(F.col("text")), "marks").alias("marks"))
        .where(F.size("marks") > 0)
        .withColumn("h", F.xxhash64("text"))
    )
    held = common.stage(
        held.groupBy(F.struct("site", "h").alias("k"))
        .agg(F.first("text").alias("text"), F.first("marks").alias("marks"))
        .select("k.site", "k.h", "text", "marks"),
        "lines-held",
    )
    families = minhash.near_duplicates(held, key="h").select("doc_id", "component_id").distinct()
    seen = (
        held.join(families, held["h"] == families["doc_id"])
        .select("site", "component_id", F.explode("marks").alias("mark"))
        .groupBy(F.struct("site", "mark", "component_id").alias("k")).agg(F.lit(1).alias("one"))
        .groupBy("k.site", "k.mark").agg(F.count(F.lit(1)).alias("on"))
        .where(F.col("on") >= F.lit(max(2.0, ratio * least_pages)))
    )
    left = seen.join(listed.select("site", "pages"), "site").where(F.col("on") > F.col("pages") * F.lit(ratio))
    return left.groupBy("site").agg(F.array_sort(F.collect_list("mark")).alias("marks"))


def _dealt(
    df: DataFrame, site: str, listed: DataFrame, theirs: str, marks: str, salt: str, their_salt: str, how: str
) -> DataFrame:
    """``df`` with its site's list: pages are dealt to several places, and the small list to each of them."""
    salted = df.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    kept = [F.col("site").alias(theirs), F.col("marks").alias(marks)]
    spread = listed.select(*kept, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(their_salt))
    return salted.join(spread, (F.col(site) == F.col(theirs)) & (F.col(salt) == F.col(their_salt)), how)


def _marks(text: Column) -> Column:
    """Hashes of the lines that are not blank."""
    return F.filter(F.transform(F.split(text, "\n"), _mark), lambda m: m != _mark(F.lit("")))


def drop_lines(
    df: DataFrame,
    site: str,
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    dropped: str | None = None,
    copies_once: bool = False,
    most: float = 1.0,
    near_once: bool = False,
) -> DataFrame:
    """``df`` with the boilerplate lines taken out of ``text``; with their number in ``dropped``.

    A column named as ``dropped`` is replaced, all others stay as they are.
    """
    found = boilerplate(df, site, text, ratio, least_pages, copies_once, near_once)
    theirs, marks = common.fresh(df.columns, "site"), common.fresh(df.columns, "marks")
    lines = common.fresh(df.columns, "lines")
    kept = F.filter(
        lines, lambda x: F.coalesce(~F.array_contains(marks, _mark(x)), F.lit(True))
    )
    salt, their_salt = common.fresh(df.columns, "salt"), common.fresh(df.columns, "their_salt")
    joined = _dealt(df, site, found, theirs, marks, salt, their_salt, how="left").withColumn(
        lines, F.split(text, "\n")
    )
    cut = common.fresh([*joined.columns], "kept")
    out = joined.withColumn(cut, F.when(F.col(marks).isNotNull(), kept).otherwise(F.col(lines)))
    if most < 1:
        lost = F.size(lines) - F.size(cut)
        told = F.size(F.filter(lines, lambda x: _mark(x) != _mark(F.lit(""))))
        out = out.withColumn(cut, F.when(lost > told * F.lit(most), F.col(lines)).otherwise(F.col(cut)))
    columns = [
        F.when(F.col(text).isNotNull(), F.array_join(cut, "\n")).alias(text) if c == text else F.col(c)
        for c in df.columns
        if c != dropped
    ]
    if dropped:
        number = F.size(lines) - F.size(cut)
        columns.append(F.when(F.col(text).isNotNull(), number).otherwise(0).alias(dropped))
    return out.select(*columns)
