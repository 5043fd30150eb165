"""Registered queries of this subpackage over the given tables, with the SQL they are checked against."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    byte_bpe,
    centroids,
    chat,
    embeddings,
    exact_dedup,
    jaccard,
    mixing,
    packing,
    quality,
    runs,
    substrings,
    token_counts,
    token_files,
)
from ebbtide.llm.shipping import ship_package
from ebbtide.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
PACK_END_ID = 0
PACK_SIZE = 1024
TOKEN_LIMIT = 2048
# Shares of sources, languages and topics in proportion to their words to these powers; 70 % of all words are kept.
MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.8}
MIX_FRACTION = 0.7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact_dedup.deduplicate(docs, exact_dedup.temporary_index(spark), "all")


def site_columns() -> tuple[Column, Column]:
    """Host and path of a document: its source, and the language section of the source."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def mix_dimensions() -> dict[str, Column]:
    """Source, language, and as topic the kind of text, told by its form."""
    text = F.coalesce("text", F.lit(""))
    topic = (
        F.when(text.contains("@") | text.rlike(r"\d{4,}"), "records")
        .when(text.contains("License") | text.contains("Copyright"), "licensed")
        .when(F.length(text) < 500, "notes")
        .when(F.length(text) < 4000, "articles")
        .otherwise("long reads")
    )
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    decided, _ = mixing.mixture(table(spark, folder, "documents"), mix_dimensions(), MIX_POWERS, fraction=MIX_FRACTION)
    return decided.select(
        "row.doc_id", "source", "lang", "topic", F.col("tokens").cast("long").alias("tokens"), "probability", "kept"
    )


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return token_counts.count_tokens(table(spark, folder, "documents"), WORD_BPE, TOKEN_LIMIT)


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents")
    return byte_bpe.encode_documents(docs, BYTE_RANKS, public_tokenizers.PATTERN, decode=True).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.classify(docs, labels, *site_columns()).select("doc_id", "p_low", "p_toxic", "kept")


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return substrings.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), out, WORD_BPE, END_ID)
    return token_files.read_token_files(spark, out)


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return embeddings.near_vectors(table(spark, folder, "embeddings"), 0.9)


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    linked = jaccard.near_duplicates(table(spark, folder, "documents"), size=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.summarise(chat.parse_conversations(chat.format_conversations(rows)))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """About a tenth of the texts, told by their ids, end in a repetition of some of their words."""
    for batch in batches:
        texts = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            h = zlib.crc32(str(doc).encode())
            if doc is not None and h % 10 == 0 and (words := (text or "").encode().split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = runs.find_runs(docs.mapInArrow(_repeated, "doc_id long, text string"))
    # The longest; of equal ones the first, then the shortest period.
    order = F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period, r.alias("run")))
    best = F.array_max(order)["run"]
    listed = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, folder, "embeddings")).drop("centroid")


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, folder, "documents"), BYTE_BPE, public_tokenizers.PATTERN, PACK_END_ID, PACK_SIZE
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_token_counts": op3_token_counts,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality": op5_quality,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_files": op7_token_files,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_chat_format": op10_chat_format,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_packing": op13_packing,
}



def _cluster_sql(clusters: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The rounds of the clustering one after another, with vectors as rows of (vector, place, value)."""
    parts = [
        f"""
f AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) = {dim} AND list_aggregate(embedding, 'count') = {dim} AND isfinite(list_aggregate(embedding, 'sum'))),
v AS MATERIALIZED (SELECT r, unnest(e) AS x, unnest(range({dim})) AS i FROM f),
o AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c FROM f),
c0 AS MATERIALIZED (SELECT c, i, x FROM o JOIN v USING (r) WHERE c < {clusters})"""
    ]
    for k in range(rounds + 1):
        parts.append(f"""
d{k} AS (SELECT r, c, sum((v.x - c{k}.x) * (v.x - c{k}.x)) AS d FROM v JOIN c{k} USING (i) GROUP BY r, c),
a{k} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{k} GROUP BY r)""")
        if k < rounds:
            parts.append(f"""
s{k} AS (SELECT c, i, sum(v.x) AS s, count(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
  FROM c{k} LEFT JOIN s{k} USING (c, i))""")
    last = rounds
    parts.append(f"""
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c)""")
    return f"""
WITH {",".join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{last} JOIN f USING (r) JOIN h USING (c)"""


SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SQL = {
    "op1_exact_dedup": f"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n""",
    "op6_substring_dedup": f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT k, min(doc_id) AS m FROM g GROUP BY k),
h AS (
  SELECT DISTINCT doc_id, i + o AS pos
  FROM (SELECT doc_id, i, unnest(range(0, 13)) AS o FROM g JOIN f USING (k) WHERE m < doc_id)),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
s AS (
  SELECT x.doc_id, count(h.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE h.pos IS NULL) AS kept
  FROM x LEFT JOIN h ON x.doc_id = h.doc_id AND x.pos = h.pos GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN s USING (doc_id)""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_aggregate(embedding, 'count') = len(embedding)
    AND isfinite(list_aggregate(embedding, 'sum'))
    AND (list_aggregate(embedding, 'max') <> 0 OR list_aggregate(embedding, 'min') <> 0)),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT node AS vec_id, coalesce(any_value(n_links), 0) AS n_links, min(c) AS component_id, node = min(c) AS kept
FROM r LEFT JOIN n ON n.a = r.node GROUP BY node""",
    "op9_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (
  SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 90 * (p.n + q.n - i)),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node)
SELECT node AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.node GROUP BY node""",
    "op10_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role AS again,
         length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')) AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN again THEN length('</part>') ELSE length('### :' || role || '</turn>') + 2 END)
         AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op12_centroid_clusters": _cluster_sql(),
}
