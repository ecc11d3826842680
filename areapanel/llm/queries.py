"""One registered query per operator, on its whole table, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areapanel.llm import bounded_batches

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.jaccard_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"), width=3, percent=90)


SQL["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
         ELSE list_distinct([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id, doc_id AS to_id FROM documents
          UNION SELECT r.doc_id, b.v FROM reach r JOIN both_ways b ON r.to_id = b.u),
least AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""


@query
def op2_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join with each document's number of links."""
    from areapanel.llm.jaccard_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"), width=3, percent=90, links=True)


SQL["op2_ngram_jaccard_links"] = SQL["op2_ngram_jaccard_join"].rpartition("SELECT sets.doc_id")[0] + r"""
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id,
       (SELECT count(*) FROM both_ways b WHERE b.u = sets.doc_id)::BIGINT AS n_links
FROM sets JOIN least USING (doc_id)
"""


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


SQL["op9_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(s) AS text_sha256
FROM t WINDOW w AS (PARTITION BY s)
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.language_id import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.toxicity import score_toxicity, train

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.html_content import extract_text, learn_weights

    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, learn_weights(pages))


@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))



@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.bpe import encode_and_decode

    return encode_and_decode(table(spark, sf_dir, "documents"), _tokenizer())


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), _tokenizer())


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from areapanel.llm.alignment import align_tokens

    return align_tokens(table(spark, sf_dir, "documents"), _tokenizer(), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"), least=30, top=50)


SQL["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
found AS (SELECT id, lang, source,
                 unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT f.lang, f.source, f.term, count(*) AS c FROM found f JOIN kept k ON f.lang = k.lang AND f.term = k.term
      GROUP BY f.lang, f.source, f.term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (1000000000 * (coalesce(c.c, 0) + 5)::HUGEINT) // (coalesce(n.n, 0) + 5 * v.v)::HUGEINT AS p,
         1 + (1000000000 * (k.total + 5)::HUGEINT) // (v.n + 5 * v.v)::HUGEINT AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM cell x JOIN cell y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM cell WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from areapanel.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
