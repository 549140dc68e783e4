"""The operators over whole tables, one query each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.llm import (
    chat,
    ego,
    merkle,
    mixing,
    paragraph_sketch,
    pii,
    sentencepiece,
    simhash,
    token_counts,
    token_files,
    toxicity,
    warc,
    whitening,
)
from assayflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op7_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like markers."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    return chat.digests(turns.unionByName(extra))


# A piece is <turn>role\ntext</turn>\n: 15 characters more than role and text, and one more for each escaped one.
SQL["op7_chat_prefix_targets"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said, role AS by_role, text AS by_text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok', '', ''), (-7, 1, 'assistant', '\### Assistant: </turn> ok', '', '')
), sized AS (
  SELECT *, 15 + length(role || said) + length(role || said) - length(replace(replace(role || said, '\', ''), '<', ''))
      + length(role) - length(replace(role, chr(10), '')) AS chars
  FROM turns
), placed AS (
  SELECT *, row_number() OVER w AS position, sum(chars) OVER w AS upto, count(*) OVER (PARTITION BY conv_id) AS n
  FROM sized
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, by_role NULLS FIRST, by_text NULLS FIRST ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY position)) AS turns_sha256,
  CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(said, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR position = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


def label_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality weights of the labelled documents: 2 for good ones, a half for others."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("quality"))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weighted by their quality labels."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), label_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# Targets: a source is at its limit if the level of those before it, in the order of their limits, lifts it above.
SQL["op10_source_mix"] = r"""
WITH quality AS (
  SELECT doc_id, avg(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END) AS quality FROM labels GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    floor((1 - pow((CAST('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0,
      1 / coalesce(q.quality, 1.0))) * 1099511627776.0)::BIGINT AS k
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id
), sources AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST)) % 3 WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 1.0 ELSE 2.0 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, target, target - source_size * epochs AS rest, epochs
  FROM (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
    FROM (SELECT *, least(2.0::DOUBLE * source_size,
      coalesce(max(CASE WHEN level * w <= 2.0::DOUBLE * source_size THEN level END) OVER (), 1e300) * w) AS target FROM levels))
), keys AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM (SELECT source, k, sum(size) AS n FROM docs GROUP BY source, k)
)
SELECT d.doc_id, d.size::BIGINT AS size, t.source_size, t.target,
  CAST(d.size * (t.epochs + CASE WHEN upto <= rest OR (upto - n <= rest AND upto - rest < rest - (upto - n)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN keys x ON d.source IS NOT DISTINCT FROM x.source AND d.k = x.k
JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
"""


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


SQL["op5_warc_round_trip"] = r"""
WITH records AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder FROM pages
), typed AS (
  SELECT *, CASE WHEN holder IS NOT NULL AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to, sha1(payload) AS hex FROM records
)
SELECT page_id, strlen(payload) AS payload_bytes,
  translate(list_aggregate([lpad(to_base(CAST('0x' || substr(hex, 1 + 10 * i, 10) AS BIGINT), 32), 8, '0') FOR i IN range(4)], 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM typed
"""


@query
def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 64 bits over four-word shingles, linked at up to 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@query
def op2_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded with the 32,000 pieces and decoded again."""
    model = sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepiece.round_trip(table(spark, sf_dir, "documents"), model)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, counted as the tokenizer of 49,408 lower-case word pieces does."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), definition)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a field fitted on a sample of them."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op1_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked at a cosine of 0.9."""
    return ego.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op1_embedding_near_duplicates"] = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
  SELECT a AS vec_id, a AS other FROM (SELECT DISTINCT a FROM links)
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), grouped AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counted AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  e.vec_id = coalesce(component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN grouped g ON e.vec_id = g.vec_id LEFT JOIN counted c ON e.vec_id = c.vec_id
"""


@query
def op6_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against their edited texts and the next documents."""
    return paragraph_sketch.compare_versions(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as leaves, a seventh of them altered after the manifest was made."""
    return merkle.verify(table(spark, sf_dir, "documents"))


# Trees level by level; crc32 from its 256 remainders; a proof is folded over its siblings, each with its side.
SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, r) ORDER BY r) AS of_byte
  FROM range(256) t(r)
), docs AS (
  SELECT *, xor(4294967295, list_reduce([ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
      lambda c, b: xor(c >> 8, of_byte[(xor(c, b) & 255) + 1]), 4294967295)) % 7 = 0 AS touched,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents CROSS JOIN remainders
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN touched THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS claimed
  FROM docs
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, place, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM nodes WHERE n > 1
  GROUP BY tree, level, place // 2, n
), subroots AS (
  SELECT tree, h, count(*) OVER () AS n FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS place, n, h FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE n > 1
  GROUP BY level, place // 2, n
), steps AS (
  SELECT p.tree, p.place, s.level AS step, CAST((p.place >> s.level) & 1 AS VARCHAR) || coalesce(o.h, '') AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) s ON p.tree = s.tree
  LEFT JOIN nodes o ON o.tree = p.tree AND o.level = s.level AND o.place = xor(p.place >> s.level, 1)
  UNION ALL
  SELECT p.tree, p.place, 1000 + s.level, CAST((p.tree >> s.level) & 1 AS VARCHAR) || coalesce(o.h, '')
  FROM placed p CROSS JOIN (SELECT DISTINCT level FROM top WHERE n > 1) s
  LEFT JOIN top o ON o.level = s.level AND o.place = xor(p.tree >> s.level, 1)
), proofs AS (
  SELECT tree, place, list(sibling ORDER BY step) AS siblings FROM steps GROUP BY tree, place
), folded AS (
  SELECT p.*, sha256(array_to_string([s[2:] FOR s IN coalesce(siblings, [])], '')) AS proof_sha256,
    list_reduce(coalesce(siblings, CAST([] AS VARCHAR[])), lambda h, s: sha256(CASE s[1] WHEN '1' THEN s[2:] || h ELSE h || s[2:] END),
      coalesce(claimed, leaf)) AS folded_root
  FROM placed p LEFT JOIN proofs q ON p.tree = q.tree AND p.place = q.place
)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, proof_sha256, folded_root, folded_root = r.h AS verified
FROM folded f JOIN subroots s ON f.tree = s.tree CROSS JOIN (SELECT h FROM top WHERE n = 1) r
"""


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids of 16 bits in files, each ended by id 2, read back."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    return token_files.round_trip(table(spark, sf_dir, "documents"), definition, end_id=2)


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their four leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
