"""The operators bound to the driver tables, with equivalent SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import fold, prepared, table
from kpiloom.llm.config_packing import packed
from kpiloom.llm.decontamination import contamination
from kpiloom.llm.exact_dedup import exact_groups
from kpiloom.llm.language_id import language_id
from kpiloom.llm.licenses import license_scan
from kpiloom.llm.mixing import mix
from kpiloom.llm.near_dedup import near_groups
from kpiloom.llm.pii import personal_data
from kpiloom.llm.ranked_search import ranked_search
from kpiloom.llm.token_counts import token_counts
from kpiloom.llm.token_output import packed_matrices
from kpiloom.llm.toxicity import toxicity
from kpiloom.llm.whitening import whitened


def byte_tokenizer() -> tuple[str, str, str]:
    """Arguments of `encoding.text_encoder` for the byte-level vocabulary."""
    path = public_tokenizers.path
    return str(path("byte_bpe_50k.json")), str(path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(prepared(spark), folder, "documents")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two of three folds."""
    docs = _documents(spark, folder)
    held_out = fold(F.col("doc_id"), 3) == 1
    found = language_id(docs, held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with similar sets of five-word shingles."""
    return near_groups(_documents(spark, folder))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    return license_scan(_documents(spark, folder))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from four of five folds."""
    docs = _documents(spark, folder)
    held_out = fold(F.col("doc_id"), 5) == 0
    found = toxicity(docs, table(spark, folder, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return packed_matrices(_documents(spark, folder), byte_tokenizer())


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(_documents(spark, folder), str(public_tokenizers.path("piece_bpe_32k.model")))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    return contamination(_documents(spark, folder), table(spark, folder, "benchmark")).drop("spans")


def op8_config_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packed(_documents(spark, folder), byte_tokenizer())


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data(_documents(spark, folder))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_groups(_documents(spark, folder))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(_documents(spark, folder), table(spark, folder, "benchmark"))


def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words a mix by source weights takes of every document."""
    return mix(_documents(spark, folder)).taken()


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every whole embedding."""
    return whitened(table(prepared(spark), folder, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_language_id,
        op2_near_dedup,
        op3_license_scan,
        op4_toxicity,
        op5_token_output,
        op6_token_counts,
        op7_decontamination,
        op8_config_packing,
        op9_personal_data,
        op10_exact_dedup,
        op11_ranked_search,
        op12_source_mixing,
        op13_embedding_whitening,
    )
}

_SPACES = r"'[\x20\x09-\x0D]+'"

ORACLES = {
    "op2_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
            FROM words, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(i) WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM words
            UNION
            SELECT doc_id, b FROM reached JOIN links ON other = a
        ), components AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM components LEFT JOIN sizes USING (doc_id)
    """,
    "op10_exact_dedup": rf"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), {_SPACES}, ' ', 'g') AS plain FROM documents
        ), grouped AS (
            SELECT plain, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY plain
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
        FROM plain JOIN grouped USING (plain)
    """,
    "op7_decontamination": r"""
        WITH words AS (
            SELECT doc_id, list_filter(string_split_regex(lower_az, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                         AS lower_az FROM documents)
        ), item_words AS (
            SELECT item_id, list_filter(string_split_regex(lower_az, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM (SELECT CAST(item_id AS VARCHAR) AS item_id, translate(coalesce(text, ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
                  FROM benchmark WHERE item_id IS NOT NULL)
        ), windows AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS size,
                   array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
            FROM item_words, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
        ), sizes AS (
            SELECT DISTINCT size FROM windows
        ), places AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
            FROM words, sizes, unnest(range(1, greatest(0, len(w) - size + 1) + 1)) AS t(i) WHERE len(w) >= size
        ), found AS (
            SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON p.gram = v.gram AND p.size = v.size
        ), hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM found, unnest(range(i, i + size)) AS t(place) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_ranked_search": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS doc, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS terms FROM documents
        ), sizes AS (
            SELECT doc, doc_id, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0
        ), totals AS (
            SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
        ), asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term
                FROM (SELECT DISTINCT item_id, text FROM benchmark)
            ) GROUP BY item_id, term
        ), postings AS (
            SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM texts)
            WHERE term IN (SELECT term FROM asked) GROUP BY doc, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM postings, totals GROUP BY term, docs
        ), scores AS (
            SELECT item_id, doc, doc_id, CAST(sum(times * w * ((1000000000 * tf) //
                   (1000 * tf + 8 * (100 - 75 + ((75 * n * t.docs) // t.terms))))) AS BIGINT) AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc), totals t
            GROUP BY item_id, doc, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, doc) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, doc) <= 10
    """,
}
