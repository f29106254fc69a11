"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    chat_format,
    cutting_stock,
    licenses,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    page_diff,
    pairwise_quality,
    projection_dedup,
    sharding,
    token_align,
    weak_rules,
)
from skyledger.llm.columns import LOWER, UPPER, table


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(table(spark, sf_dir, "documents"))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_dedup.dedup_vectors(table(spark, sf_dir, "embeddings"))


def ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract_pages(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.score_rules(table(spark, sf_dir, "documents"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        mixing.taken(F.col("draws")).alias("taken"))


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def deduped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# A conversation whose texts are the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def formatted_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    return chat_format.digests(chat_format.format_chats(rows.unionByName(control)))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every third document, by the CRC-32 of its id, A-Z of the text are made lower case."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = merkle.leaf_digest([
        F.translate("text", UPPER, LOWER) if name == "text" else F.col(name) for name in fields])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, "doc_id", "lang", fields, F.when(chosen, changed))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_align.align_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_license_scan": license_scan,
    "op2_quality_rules": quality_rules,
    "op3_packing": packing,
    "op4_embedding_dedup": embedding_dedup,
    "op5_quality_classifier": quality_classifier,
    "op6_mixing": mixing_targets,
    "op7_ngram_join": ngram_links,
    "op8_sharding": sharded,
    "op9_html_extraction": html_extraction,
    "op10_line_dedup": deduped_lines,
    "op11_chat_formatting": formatted_chats,
    "op12_merkle_manifest": merkle_manifest,
    "op13_token_alignment": token_alignment,
}

# Smallest node that the links (a, b) of either direction lead to.
_REACHED = """
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT node, root FROM nodes
  UNION
  SELECT both_ways.b, reached.root FROM reached JOIN both_ways ON both_ways.a = reached.node
),
counted AS (SELECT a AS node, count(*) AS n_links FROM both_ways GROUP BY a),
lowest AS (SELECT node, min(root) AS component FROM reached GROUP BY node)
"""

# CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                  lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(
    list_prepend(xor(crc, byte), range(8)),
    lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)))"""


def _encoded(value: str) -> str:
    return (f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')")


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_encoded, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


ORACLE = {
    "op4_embedding_dedup": f"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM able p JOIN able q
  ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.93
),
nodes AS (SELECT vec_id AS node, vec_id AS root FROM embeddings),
{_REACHED}
SELECT vec_id, coalesce(n_links, 0) AS n_links, component AS component_id,
       vec_id = component AS kept
FROM embeddings JOIN lowest ON lowest.node = vec_id LEFT JOIN counted ON counted.node = vec_id
""",
    "op7_ngram_join": f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
),
placed AS (
  SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i
  FROM worded WHERE len(words) > 0
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS gram FROM placed
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common
  FROM grams p JOIN grams q ON p.gram = q.gram AND p.doc_id < q.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 10 * common >= 8 * (x.n + y.n - common)
),
nodes AS (SELECT doc_id AS node, doc_id AS root FROM documents),
{_REACHED}
SELECT doc_id,
       CASE WHEN len(words) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY words) END
         AS copy_id,
       coalesce(n_links, 0) AS n_links, component AS class_id
FROM worded JOIN lowest ON lowest.node = doc_id LEFT JOIN counted ON counted.node = doc_id
""",
    "op6_mixing": """
WITH sized AS (
  SELECT doc_id, source, md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|'
                             || coalesce(text, '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT)
           AS size
  FROM documents
),
source_sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS number
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM source_sizes
),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - CAST(coalesce(sum(2 * source_size) OVER stops, 0) AS DOUBLE))
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER stops, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW stops AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, number
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size,
         least(CAST(2 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM levels
),
lined AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         (CAST(floor(target) AS BIGINT) // source_size) * size
         + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - start))
       END AS BIGINT) AS taken
FROM lined JOIN targets ON lined.source IS NOT DISTINCT FROM targets.source
""",
    "op10_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS number
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT keyed.*, common.key IS NOT NULL AND keyed.doc_id <> common.last AS gone
  FROM keyed LEFT JOIN common ON keyed.key = common.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_chat_formatting": f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place
  FROM said
),
beside AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER turns AS opens,
         role IS DISTINCT FROM lead(role) OVER turns AS closes
  FROM placed WINDOW turns AS (PARTITION BY conv_id ORDER BY place)
),
pieces AS (
  SELECT *, CASE WHEN opens THEN '<|im_start|>'
              || replace(
                   regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'),
                   chr(10), '<|lf|>') || chr(10)
            ELSE '<|turn|>' END
            || regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')
            || CASE WHEN closes THEN '<|im_end|>' || chr(10) ELSE '' END AS piece
  FROM beside
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC32} % 3 = 0
           THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
           ELSE {_leaf("text")} END AS claimed
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER () AS number, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves
),
nodes AS (
  SELECT lang, 0 AS level, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lang, level, place // 8, n
),
subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
         count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
tops AS (
  SELECT 0 AS level, place, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (n + 7) // 8
  FROM tops WHERE n > 1 GROUP BY level, place // 8, n
),
ways AS (
  SELECT number, level AS height, digest, nodes.place AS spot, placed.place >> (3 * level) AS own
  FROM placed JOIN nodes ON nodes.lang IS NOT DISTINCT FROM placed.lang AND nodes.n > 1
    AND nodes.place // 8 = placed.place >> (3 * level + 3)
  UNION ALL
  SELECT number, 100 + level, digest, tops.place, subroots.place >> (3 * level)
  FROM placed JOIN subroots ON subroots.lang IS NOT DISTINCT FROM placed.lang
  JOIN tops ON tops.n > 1 AND tops.place // 8 = subroots.place >> (3 * level + 3)
),
steps AS (
  SELECT number, row_number() OVER (PARTITION BY number ORDER BY height) AS step,
         coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE spot < own), '') AS lefts,
         coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE spot > own), '') AS rights
  FROM ways GROUP BY number, height
),
folds AS (
  SELECT number, 0 AS step, claimed AS digest FROM placed
  UNION ALL
  SELECT number, steps.step, sha256(lefts || digest || rights)
  FROM folds JOIN steps USING (number) WHERE steps.step = folds.step + 1
),
proofs AS (
  SELECT number, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof_sha256
  FROM steps GROUP BY number
),
ends AS (SELECT number, arg_max(digest, step) AS folded_root FROM folds GROUP BY number)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM placed JOIN subroots ON subroots.lang IS NOT DISTINCT FROM placed.lang
CROSS JOIN (SELECT digest AS root FROM tops WHERE n = 1)
JOIN ends USING (number) LEFT JOIN proofs USING (number)
""",
}
