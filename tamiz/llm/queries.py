"""One query per operator over its whole table, and the oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fingerprints, huffman, lines, neardup, packing, piecetokens, quality, resampling, sharding
from . import suffixes, turntrie


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.repeated_passages(_table(spark, sf, "documents"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op3_lines(spark: SparkSession, sf: str) -> DataFrame:
    cleared = lines.deduplicate_lines(_table(spark, sf, "documents"), min_words=1)
    return cleared.select("doc_id", "text", "lines_before", "lines_removed")


def op4_huffman(spark: SparkSession, sf: str) -> DataFrame:
    return huffman.round_trip(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels")).drop("mark")


def op6_rendezvous(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf, "documents"))


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.repair(_table(spark, sf, "conversations"))


def op9_containment(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf, "documents"))


def op11_trie(spark: SparkSession, sf: str) -> DataFrame:
    return turntrie.rebuilt_trie(_table(spark, sf, "conversations"))


def op12_pieces(spark: SparkSession, sf: str) -> DataFrame:
    texts = _table(spark, sf, "documents").select("doc_id", "text")
    done = piecetokens.round_trip(texts, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffixes": op1_suffixes,
    "op2_packing": op2_packing,
    "op3_lines": op3_lines,
    "op4_huffman": op4_huffman,
    "op5_quality": op5_quality,
    "op6_rendezvous": op6_rendezvous,
    "op7_minhash": op7_minhash,
    "op8_chat": op8_chat,
    "op9_containment": op9_containment,
    "op10_fingerprints": op10_fingerprints,
    "op11_trie": op11_trie,
    "op12_pieces": op12_pieces,
    "op13_resampling": op13_resampling,
    "pipeline": corpus_pipeline.run,
}

#: The words of a text, A-Z in lower case, as a list.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^ \\t-\\r]+')"
)


def _shingles(table: str, key: str) -> str:
    """(key, s): the distinct 5-word shingles of a table's texts; with fewer words the whole sequence."""
    return f"""SELECT DISTINCT {key}, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s FROM (
  SELECT {key}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM (SELECT {key}, {_WORDS} AS w FROM {table}) WHERE len(w) > 0)"""


#: (conv_id, h): the CRC-32 of the decimal conv_id modulo 9, bit by bit: 0xEDB88320 is 3988292384, all ones are 4294967295.
_CRC_SHARES = """crc(conv_id, d, i, v) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, 4294967295::BIGINT FROM conversations
  UNION ALL
  SELECT conv_id, d, i + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END FROM (
    SELECT conv_id, d, i, CASE WHEN i % 8 = 0 THEN xor(v, ord(substr(d, i // 8 + 1, 1))::BIGINT) ELSE v END AS x
    FROM crc WHERE i < 8 * length(d))),
share AS (SELECT conv_id, xor(v, 4294967295::BIGINT) % 9 AS h FROM crc WHERE i = 8 * length(d))"""

ORACLES: dict[str, str] = {
    "op11_trie": f"""
WITH RECURSIVE {_CRC_SHARES},
own AS (SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')] ORDER BY turn NULLS FIRST) AS t FROM conversations GROUP BY conv_id),
whole AS (SELECT o.conv_id, coalesce(b.t[1 : h], []) || o.t[h + 1 :] AS t
  FROM own o JOIN share USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
prefix AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM whole),
node AS (SELECT t[1 : d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(t) = d), '')) AS ends_sha256
  FROM prefix GROUP BY ALL),
child AS (SELECT p[1 : d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT x.p, count(*) FILTER (c.n IS NULL) AS n_leaves,
    sum(CASE WHEN y.d > 0 THEN (y.n_convs - 1) * strlen(y.p[y.d][2]) ELSE 0 END) AS saved
  FROM node x JOIN node y ON y.d >= x.d AND y.p[1 : x.d] = x.p LEFT JOIN child c ON c.p = y.p GROUP BY x.p)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children,
  below.n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.p = node.p LEFT JOIN child ON child.p = node.p
LEFT JOIN node up ON node.d > 0 AND up.p = node.p[1 : node.d - 1]""",
    "op7_minhash": f"""
WITH RECURSIVE s AS ({_shingles("documents", "doc_id")}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp c ON c.doc_id = d.doc_id""",
    "op9_containment": f"""
WITH d AS ({_shingles("documents", "doc_id")}), q AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id),
common AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN q USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, n AS item_shingles, CAST(shared AS DOUBLE) / n AS containment
FROM common JOIN n USING (item_id) WHERE 100 * shared >= 80 * n""",
}
