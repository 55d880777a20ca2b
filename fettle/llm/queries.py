"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.llm import (
    alignment,
    exact,
    fingerprints,
    html,
    jaccard,
    language,
    lines,
    mixing,
    negatives,
    packing,
    secrets,
    substrings,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def packed_pieces(docs: DataFrame, place: str | None = None) -> DataFrame:
    """Pieces with their place; of the ids only the checksum goes through the shuffles."""
    pieces = packing.cut_documents(docs, tokenizer_path(), place=place)
    packed = packing.harmonic_pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), place=place)
    return packed.drop(place) if place else packed


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed_pieces(documents(spark, sf_dir)).select(*columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that over a tenth of their source's documents have."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs)


def op3_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of all documents, sources weighed by their size to the power 0.7."""
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from four fifths of them."""
    docs = documents(spark, sf_dir)
    out = language.held_out(F.col("doc_id"))
    learnt = language.sample_dictionaries(docs.where(~out))
    found = language.identify(docs.select("doc_id", "text"), learnt)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "accepted")


def op6_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    found = fingerprints.fingerprints(documents(spark, sf_dir))
    columns = ["fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *columns)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that are left where passages of 35 words and more that repeat are removed."""
    found = substrings.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan_secrets(documents(spark, sf_dir))
    n = {k: F.size(F.filter("kinds", lambda x: x == k)).cast("long") for k in secrets.KINDS}
    return found.select(
        "doc_id",
        n["assign"].alias("n_assign"),
        n["access"].alias("n_access"),
        n["hex"].alias("n_hex"),
        F.sha2(secrets.spans_text(secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.spans_text(secrets.KINDS).alias("spans"),
        n["entropy"].alias("n_entropy"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exact.exact_groups(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share most of their four-word shingles."""
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is wrong on purpose."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return negatives.hard_negatives(negatives.whole_vectors(vectors, label))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of a byte-level and a piece vocabulary lie over every document."""
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in (BYTES, PIECES)]
    return alignment.align_tokens(documents(spark, sf_dir), *paths)


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as records of archives, read back through their index."""
    return warc.archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def queries() -> dict[str, Query]:
    found = [
        op1_harmonic_packing,
        op2_line_dedup,
        op3_pfair_mixing,
        op4_html_extraction,
        op5_language_id,
        op6_iblt_fingerprints,
        op7_substring_dedup,
        op8_secret_scan,
        op9_exact_dedup,
        op10_jaccard_join,
        op11_hard_negatives,
        op12_token_alignment,
        op13_warc_archives,
    ]
    return {f.__name__: f for f in found}


OP2_SQL = """
WITH rows AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM rows
), counts AS (
  SELECT source, trim(line) AS line, count(DISTINCT doc_id) AS pages
  FROM lines WHERE trim(line) <> '' GROUP BY ALL
), totals AS (
  SELECT source, count(*) AS total FROM documents GROUP BY source
), boilerplate AS (
  SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.pages >= 3 AND c.pages > t.total * 0.1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE b.line IS NULL) AS text,
         count(*) AS n_lines, count(b.line) AS n_dropped
  FROM lines l LEFT JOIN boilerplate b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line
  GROUP BY l.doc_id
)
SELECT r.doc_id, r.source, CASE WHEN r.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0)::INT AS n_lines, coalesce(k.n_dropped, 0)::INT AS n_dropped
FROM rows r LEFT JOIN kept k USING (doc_id)
"""

# Lower-cases A-Z only.
OP9_SQL = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY text)
"""


OP7_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS place, w FROM words WHERE len(w) >= 35
), keyed AS (
  SELECT doc_id, place, array_to_string(w[place:place + 34], ' ') AS key FROM windows
), repeated AS (
  SELECT doc_id, place FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY key) AS n FROM keyed) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 35)) AS place FROM repeated
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
), kept AS (
  SELECT p.doc_id, count(g.place) AS n_removed,
         coalesce(string_agg(p.word, ' ' ORDER BY p.place) FILTER (WHERE g.place IS NULL), '') AS kept
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER best::INT AS rank, n.vec_id AS negative_id, positive_score,
       n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5
"""


OP13_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN first END AS refers_to
FROM rows
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_hard_negatives": OP11_SQL,
        "op13_warc_archives": OP13_SQL,
        "op2_line_dedup": OP2_SQL,
        "op7_substring_dedup": OP7_SQL,
        "op9_exact_dedup": OP9_SQL,
    }
