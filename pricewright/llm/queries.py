"""Registered queries of the corpus operators, and the same rows in DuckDB SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm import (
    bpe,
    chat,
    hard_negatives,
    language,
    lines,
    minhash,
    mixing,
    neighbours,
    pii,
    quality,
    resampling,
    secret_scan,
    simhash,
)
from pricewright.llm.common import held_out, stage, table


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def vocabulary() -> str:
    """Where the vocabulary file is on this machine and, installed alike, on the executors."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents, encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = docs.select("doc_id", bpe.round_trip(F.col("text"), vocabulary()).alias("b"))
    return both.select("doc_id", "b.ids", "b.decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(bpe.joined_ids(F.col("ids"))).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document, at the target weights of the sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a fifth of them was held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    found = docs.select("doc_id", language.predict(F.col("text"), model).alias("p"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that are no prefix of another, rendered."""
    made = chat.rendered(table(spark, sf_dir, "conversations"))
    return made.select("conv_id", "part", "n_turns", _sha(F.col("rendered")).alias("rendered_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of them was held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    vectors = quality.word_vectors(docs, "text")
    known = labels.where(~held_out(F.col("doc_id")))
    network = quality.fit(docs, known, vectors, "doc_id", "text", "quality")
    scored = docs.select("doc_id", quality.score(F.col("text"), vectors, network).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the lines that too many pages of their host have."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", lines.host(F.col("url")).alias("host"), lines.visible_lines(F.col("html")).alias("text")
    )
    # Counting and dropping both read the lines; taking pages apart is what costs.
    pages = stage(pages, "pages-lines")
    cut = lines.drop_lines(pages, "host", dropped="n_dropped")
    kept = F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))).otherwise(0)
    return cut.select(
        "page_id", "host", F.col("n_dropped").cast("long").alias("n_dropped"),
        kept.cast("long").alias("n_left"), _sha(F.col("text")).alias("text_sha256"),
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies by four-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, similarity=80)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest of every fiftieth vector, among all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = rows.where(F.col("vec_id") % 50 == 0)
    return neighbours.nearest(rows, asked, "vec_id", "embedding", k=5, factor=1.0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, likeness to these and to the next, and the
    smallest document that steps within the search radius reach."""
    return simhash.with_near_classes(simhash.compare_next(table(spark, sf_dir, "documents")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, and of terms that reveal it, in every document."""
    found = pii.find(table(spark, sf_dir, "documents"))

    def base(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    plain = F.filter("found", lambda s: s["kind"] < len(pii.KINDS))
    return found.select(
        "doc_id",
        *[base(n).alias(f"n_{k}") for n, k in enumerate(pii.KINDS)],
        _sha(pii.listing(plain)).alias("base_sha256"),
        pii.listing(F.col("found")).alias("spans"),
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the word runs of the benchmark, and all scores."""
    docs = table(spark, sf_dir, "documents")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark").select("text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of another label that score from 80 to 100 % of an anchor's positives, best first."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, label=label)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, of the three base kinds and of further credentials."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    plain = F.filter("found", lambda s: s["kind"] < len(secret_scan.BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{r.name}") for n, r in enumerate(secret_scan.BASE)],
        _sha(secret_scan.listing(plain)).alias("base_sha256"),
        secret_scan.listing(F.col("found")).alias("spans"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over the whole of documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_lines": op6_lines,
    "op7_minhash": op7_minhash,
    "op8_neighbours": op8_neighbours,
    "op9_simhash": op9_simhash,
    "op10_pii": op10_pii,
    "op11_resampling": op11_resampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secrets": op13_secrets,
    "pipeline": pipeline,
}


def _either(words: str) -> str:
    """A pattern for the words in either case, of ASCII letters only."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


#: The rules of op13 without possessive marks, group and least length.
_SECRETS = (
    ("assign", _either("(?:password|passwd|secret|token|api_?key)") + r"""["'']?[ ]*[:=][ ]*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("private_key", "-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
    ("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@]{1,100}:[^\x00-\x20/@]{1,100}@", 0, 1),
)


def _secrets_sql() -> str:
    parts = " UNION ALL ".join(
        f"""
  SELECT r, {n} AS kind, '{name}' AS name, {least} AS least, unnest(regexp_extract_all(t, '{pattern}')) AS m,
    unnest(regexp_extract_all(t, '{pattern}', {group})) AS told,
    unnest(list_slice(regexp_split_to_array(t, '{pattern}'), 1, len(regexp_extract_all(t, '{pattern}')))) AS gap,
    generate_subscripts(regexp_extract_all(t, '{pattern}'), 1) AS n
  FROM d WHERE regexp_matches(t, '{pattern}')"""
        for n, (name, pattern, group, least) in enumerate(_SECRETS)
    )
    counts = ", ".join(f"count(*) FILTER (kind = {n}) AS n_{_SECRETS[n][0]}" for n in range(3))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents),
m AS ({parts}),
placed AS (
  SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY n) AS BIGINT) AS e FROM m),
span AS (SELECT r, kind, e - length(m) AS s, name || ':' || (e - length(m)) || ':' || e AS said
         FROM placed WHERE length(told) >= least)
SELECT doc_id, {counts},
  sha256(coalesce(string_agg(said, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY s, kind), '') AS spans
FROM d LEFT JOIN span USING (r) GROUP BY r, doc_id
"""


#: Ids of the contract's columns that SQL can compute are checked row by row; what is learned, sampled by
#: Spark's own hash or a method's own score has no SQL and is tested against brute force instead.
SQL: dict[str, str] = {
    "op4_chat": r"""
WITH said AS (
  SELECT conv_id, coalesce(turn, -4611686018427387904) AS turn, coalesce(role, '') AS role,
         coalesce("text", '') AS "text", count(*) AS n
  FROM conversations GROUP BY ALL),
turns AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN 1 ELSE n END AS times,
         CASE WHEN conv_id IS NULL THEN turn || sha256(role) || sha256("text") ELSE '' END AS alone
  FROM said),
steps AS (
  SELECT conv_id, alone, turn, sum(times) AS times,
         string_agg(sha256(role) || sha256("text") || times, ',' ORDER BY role, "text") AS said
  FROM turns GROUP BY conv_id, alone, turn),
prefixes AS (
  SELECT conv_id, alone, turn,
         string_agg(turn || ':' || said, ';') OVER (PARTITION BY conv_id, alone ORDER BY turn) AS prefix,
         row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn DESC) = 1 AS final
  FROM steps),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id, CASE WHEN min(conv_id) IS NULL THEN max(alone) ELSE '' END AS alone
  FROM prefixes WHERE final GROUP BY prefix),
kept AS (
  SELECT conv_id, alone FROM whole WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE NOT final))
SELECT t.conv_id, CAST(floor(t.turn / 256) AS BIGINT) AS part, CAST(sum(t.times) AS BIGINT) AS n_turns,
  sha256(string_agg(repeat('<|' || replace(replace(t.role, '<|', '< |'), '|>', '| >') || '|>' || chr(10)
    || replace(replace(t."text", '<|', '< |'), '|>', '| >') || chr(10) || '<|end|>' || chr(10), t.times), ''
    ORDER BY t.turn, t.role, t."text")) AS rendered_sha256
FROM turns t JOIN kept k ON t.conv_id IS NOT DISTINCT FROM k.conv_id AND t.alone = k.alone
GROUP BY t.conv_id, t.alone, floor(t.turn / 256)
""",
    "op6_lines": r"""
WITH bare AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(html, '(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)>', '', 'g') AS h,
    row_number() OVER () AS n
  FROM pages),
page AS (
  SELECT n, page_id, host, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
    '(?i)</?(?:p|div|li|ul|ol|nav|h[1-6]|article|section|br|table|tr|title|head|body|footer|header)\b[^>]*>', chr(10), 'g'),
    '<[^>]*>', '', 'g'), '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g'), '^\n|\n$', '', 'g') AS t
  FROM bare),
line AS (
  SELECT n, page_id, host, i, s, regexp_replace(s, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k
  FROM (SELECT n, page_id, host, unnest(string_split(t, chr(10))) AS s,
          generate_subscripts(string_split(t, chr(10)), 1) AS i FROM page)),
total AS (SELECT host, count(*) AS pages FROM page WHERE host IS NOT NULL GROUP BY host),
frequent AS (
  SELECT host, k FROM line JOIN total USING (host) WHERE k <> ''
  GROUP BY host, k, pages HAVING pages >= 4 AND count(DISTINCT n) > pages * 0.3 AND count(DISTINCT n) >= 2)
SELECT p.page_id, p.host, CAST(count(l.i) FILTER (f.k IS NOT NULL) AS BIGINT) AS n_dropped,
  CAST(CASE WHEN p.t IS NULL THEN 0 ELSE greatest(1, count(l.i) FILTER (f.k IS NULL)) END AS BIGINT) AS n_left,
  CASE WHEN p.t IS NULL THEN NULL
       ELSE sha256(coalesce(string_agg(l.s, chr(10) ORDER BY l.i) FILTER (f.k IS NULL), '')) END AS text_sha256
FROM page p LEFT JOIN line l ON l.n = p.n LEFT JOIN frequent f ON f.host = l.host AND f.k = l.k
GROUP BY p.n, p.page_id, p.host, p.t
""",
    "op8_neighbours": r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""",
    "op12_hard_negatives": r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
    CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
""",
    "op13_secrets": _secrets_sql(),
}
