"""The queries of this package: one ``opN_<name>`` per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from foliary.llm import ball_tree, best_fit, chosen_path, chunk_store, duck_bpe, fill_middle, jpeg_media, language_fusion, learned_partitions, pu_quality, tag_paths, term_divergence, weak_toxicity
from foliary.llm.common import table


def op1_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_store.store_and_verify(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similarity_join(table(spark, sf_dir, "documents"), threshold=0.8, width=5)


def op4_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, modulus=4, remainder=2)


def op5_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_fusion.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, modulus=5, remainder=0)


def op7_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


def op8_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg_media.store_and_read(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


def op10_duck_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duck_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op11_term_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_divergence.audit(table(spark, sf_dir, "documents"), top=200, least_documents=3)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"), seed="7", rate=100, spm=50)


def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


#: DuckDB SQL by query. Integers below 2**53 are exact as doubles.
_OP1 = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


#: All terms times all sources, by joins.
_OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), n AS (SELECT lang, source, term, count(*) AS c, count(DISTINCT doc) AS docs FROM (SELECT lang, source, doc, unnest(terms) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(c) AS c FROM n GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
s AS (SELECT lang, source, sum(c) AS n FROM x GROUP BY ALL),
p AS (SELECT x.*, 1 + (1000000000::HUGEINT * (x.c + 1)::HUGEINT) // (s.n + v.v)::HUGEINT AS p FROM x JOIN s USING (lang, source) JOIN v USING (lang)),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.c + 1)::HUGEINT) // (v.n + v.v)::HUGEINT AS q FROM k JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""

_OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS l, [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) FOR i IN [0, 1, 2, 3]] AS h FROM d),
c AS (SELECT doc_id, t, l, CAST(len(l) AS BIGINT) AS n, h, least(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS a, greatest(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(l[1:a], ''), '') AS p, coalesce(array_to_string(l[a + 1:b], ''), '') AS m, coalesce(array_to_string(l[b + 1:], ''), '') AS s
  FROM c
)
SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ball_tree": _OP1, "op11_term_divergence": _OP11, "op12_fill_middle": _OP12}
