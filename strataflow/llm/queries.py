"""The operators as registered queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm.bpe import encoded
from strataflow.llm.decontaminate import contamination
from strataflow.llm.exact_dedup import exact_groups
from strataflow.llm.fingerprint import fingerprints
from strataflow.llm.jaccard_join import jaccard_components
from strataflow.llm.masked_lm import pseudo_likelihood
from strataflow.llm.packing import pack_documents
from strataflow.llm.periodic import periodic_runs
from strataflow.llm.pii import private_report
from strataflow.llm.quality import quality_scores
from strataflow.llm.shared import ship, surrogate_key
from strataflow.llm.spelling import corpus_words, spelling_groups
from strataflow.llm.token_count import token_counts
from strataflow.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of the session and the data folder under a name."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(ship(spark), folder)
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op2_compression_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_best_fit_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder))


@query(
    "op7_exact_dedup",
    r"""
    WITH plain AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    ), ranked AS (
        SELECT doc_id, text_sha256,
            min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM plain
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder))


@query("op8_pii_surrogates")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return private_report(documents(spark, folder), surrogate_key(spark))


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(documents(spark, folder))


@query("op10_document_fingerprints")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(documents(spark, folder))


@query("op4_masked_lm")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(documents(spark, folder))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(documents(spark, folder), planted=True, full=False).drop("runs", "collapsed")


@query(
    "op12_decontamination",
    r"""
    WITH doc_words AS (
        SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n
        FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
    ), item_words AS (
        SELECT item_id, unnest(w) AS word, unnest(range(len(w))) AS i, least(len(w), 10) AS size
        FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    ), sizes AS (
        SELECT DISTINCT size FROM item_words
    ), item_windows AS (
        SELECT DISTINCT a.item_id, a.size, string_agg(b.word, ' ' ORDER BY b.i) AS gram
        FROM item_words a JOIN item_words b ON a.item_id = b.item_id AND b.i >= a.i AND b.i < a.i + a.size
        GROUP BY a.item_id, a.i, a.size HAVING count(*) = a.size
    ), ahead AS (
        SELECT doc_id, i, {leads} FROM doc_words WINDOW w AS (PARTITION BY doc_id ORDER BY i)
    ), doc_windows AS (
        SELECT doc_id, i, size, array_to_string(list_slice([{names}], 1, size), ' ') AS gram
        FROM ahead, sizes
        WHERE list_extract([{names}], size) IS NOT NULL
    ), hits AS (
        SELECT d.doc_id, d.i, d.size, t.item_id FROM doc_windows d JOIN item_windows t ON d.gram = t.gram AND d.size = t.size
    ), hit_words AS (
        SELECT doc_id, count(*) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
    ), found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
    ), lengths AS (
        SELECT doc_id, max(n) AS n_words FROM doc_words GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM documents LEFT JOIN lengths USING (doc_id) LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
    """.replace("{leads}", ", ".join(f"lead(word, {j}) OVER w AS w{j}" for j in range(10))).replace("{names}", ", ".join(f"w{j}" for j in range(10))),
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query(
    "op13_spelling_variants",
    r"""
    WITH RECURSIVE found AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
        WHERE length(run) >= 6 GROUP BY ALL
    ), coded AS (
        SELECT run, n, hex(encode(doc_id || ':' || run)) AS code FROM found
    ), summed AS (
        -- The register of a crc32, fed with each byte and shifted out over eight bits.
        SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
            list_prepend(4294967295::UBIGINT, flatten(list_transform(range(1, length(code), 2),
                lambda b: [('0x' || substr(code, b, 2))::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda c, x: xor(xor(c, x) // 2, (xor(c, x) % 2) * 3988292384::UBIGINT))) AS h
        FROM coded
    ), said AS (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM summed
    ), words AS (
        SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
    ), cut AS (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), near AS (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
    ), told AS (
        SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
            CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
        FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1
    ), chain AS (
        SELECT word, word AS root FROM told
        UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON c.root = t.word WHERE t.form IS NOT NULL
    ), ends AS (
        SELECT c.word, c.root FROM chain c JOIN told t ON c.root = t.word WHERE t.form IS NULL
    )
    SELECT t.word, t.form, e.root, t.n, t.n_near, t.form_n FROM told t JOIN ends e ON t.word = e.word
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(corpus_words(documents(spark, folder), garbled=199))
