"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import encode_decode
from millrace.llm.jaccard import similar_groups
from millrace.llm.manifest import manifest
from millrace.llm.near_vectors import near_duplicates
from millrace.llm.neighbours import nearest_neighbours
from millrace.llm.packing import pack
from millrace.llm.quality import fit_quality, score_quality
from millrace.llm.reply_trees import conversation_digests, conversation_trees, format_trees
from millrace.llm.sharding import external_shuffle, write_shards
from millrace.llm.suffixes import remove_repeats
from millrace.llm.token_files import token_files
from millrace.llm.warc import archive
from millrace.llm.zone_clusters import cluster_vectors
from millrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@register
def op1_bwt_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")


@register
def op2_collision_ann(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_decode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.withColumnRenamed("key", "doc_id")


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from."""
    return labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)


@register
def op4_quality_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = fit_quality(docs, training_rows(table(spark, folder, "labels")))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return score_quality(docs, field).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op5_kmeans_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


@register
def op6_heavy_light_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(table(spark, folder, "documents"))


@register
def op7_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    shards = spark.read.parquet(write_shards(external_shuffle(table(spark, folder, "documents"))))
    return shards.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op8_pack_nnls(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)
    return pieces.withColumnRenamed("key", "doc_id").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)
    return read.withColumnRenamed("key", "doc_id").select("doc_id", "start", "n_tokens", "ids_crc32")


@register
def op9_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    return archive(table(spark, folder, "pages"))


@register
def op11_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    speaker = F.when(F.col("id") == 0, "user").otherwise("assistant")
    given = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), speaker.alias("role"), F.lit(said).alias("text"))
    return conversation_digests(format_trees(conversation_trees(turns.union(given)))).withColumnRenamed("tree", "conv_id")


SQL["op11_reply_trees"] = r"""
WITH t AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t),
e AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS etext,
           replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS erole FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(etext) + length(erole) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

@register
def op12_zone_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"))


def _clusters_sql(rounds: int = 10) -> str:
    """The rounds one after another: a<r> are the nearest centroids, c<r> the centroids."""
    steps = [
        """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS c, x FROM v ORDER BY sha256('3:' || vec_id), x LIMIT 8)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
    SELECT row, vec_id, x, c, d FROM (
        SELECT v.row, v.vec_id, v.x, c.c, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d FROM v, c{r} c
    ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(n.x, o.x) AS x FROM c{r} o LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
        FROM (SELECT c, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY c, i) GROUP BY c
    ) n ON n.c = o.c
)""")
    return ",".join(steps) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c
"""


SQL["op12_zone_clusters"] = _clusters_sql()

@register
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = {"text": F.when(tampered, lowered).otherwise(F.col("text"))}
    return manifest(table(spark, folder, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", claimed)


def _manifest_sql(levels: int = 8, tops: int = 6) -> str:
    """Level by level, every leaf with the node above it (h), the folded node (f), the node's
    place (p) and the siblings so far."""
    h = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(h.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    # unsigned crc32 by a table of bytes
    steps = [f"""
WITH RECURSIVE bits AS (
    SELECT range AS b, 0 AS k, CAST(range AS BIGINT) AS c FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
tampered AS (
    SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
                       lambda c, b: xor(c >> 8, t[CAST(xor(c % 256, b) AS INTEGER) + 1])), 4294967295) % 5 = 0 AS bad
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table
), l AS (
    SELECT d.doc_id, d.source, {leaf("text")} AS leaf,
           CASE WHEN t.bad THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf("text")} END AS claim
    FROM (SELECT doc_id, source, lang, n_chars, text FROM documents) d LEFT JOIN tampered t USING (doc_id)
), s0 AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, source AS tree, leaf, leaf AS h, claim AS f, '' AS sib, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM l
)"""]

    def step(old: str, new: str) -> str:
        return f"""
{new}r AS (
    SELECT tree, p // 16 AS q, list('64:' || h ORDER BY p) AS run FROM (SELECT DISTINCT tree, p, h FROM {old}) GROUP BY tree, q
), {new}n AS (SELECT tree, count(DISTINCT p) AS n FROM {old} GROUP BY tree),
{new} AS MATERIALIZED (
    SELECT o.row, o.doc_id, o.tree, o.leaf, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE h END AS h,
           CASE WHEN n > 1 THEN sha256(array_to_string(run[: p % 16] || ['64:' || f] || run[p % 16 + 2 :], '')) ELSE f END AS f,
           CASE WHEN n > 1 THEN sib || array_to_string(run[: p % 16] || run[p % 16 + 2 :], '') ELSE sib END AS sib, CASE WHEN n > 1 THEN p // 16 ELSE p END AS p
    FROM {old} o JOIN {new}n n ON o.tree IS NOT DISTINCT FROM n.tree JOIN {new}r r ON o.tree IS NOT DISTINCT FROM r.tree AND p // 16 = q
)"""

    steps += [step(f"s{i}", f"s{i + 1}") for i in range(levels)]
    steps.append(f"""
t0 AS MATERIALIZED (SELECT row, doc_id, 0 AS tree, leaf, h, f, sib, dense_rank() OVER (ORDER BY tree NULLS FIRST) - 1 AS p, h AS subroot FROM s{levels})""")
    steps += [step(f"t{i}", f"t{i + 1}") for i in range(tops)]
    return ",".join(steps) + f"""
SELECT z.doc_id, z.leaf, t0.subroot, z.h AS root, sha256(z.sib) AS proof_sha256, z.f AS folded_root, z.f = z.h AS verified FROM t{tops} z JOIN t0 USING (row)
"""


SQL["op13_merkle_manifest"] = _manifest_sql()

SQL["op9_warc_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
     m AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
       CASE WHEN m.kept IS NOT NULL AND m.kept <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.kept <> d.page_id THEN m.kept END AS refers_to
FROM d LEFT JOIN m ON d.payload_digest = m.payload_digest AND d.payload_bytes >= 1000
"""

SQL["op5_kmeans_near_vectors"] = """
WITH RECURSIVE g AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), n AS (SELECT vec_id, x, len(x) AS dim, sqrt(list_inner_product(x, x)) AS norm FROM g),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.dim = b.dim AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.95
), reach AS (
    SELECT vec_id AS u, vec_id AS v FROM embeddings
    UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), degree AS (SELECT u, count(*) AS c FROM links GROUP BY u),
least_id AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT e.vec_id, CAST(coalesce(d.c, 0) AS BIGINT) AS n_links, m.m AS component_id, e.vec_id = m.m AS kept
FROM embeddings e LEFT JOIN degree d ON d.u = e.vec_id JOIN least_id m ON m.u = e.vec_id
"""

SQL["op6_heavy_light_jaccard"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.c + q.c - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""
