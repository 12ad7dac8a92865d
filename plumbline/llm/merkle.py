"""Fixity audit of archive replicas by Merkle trees over record offsets.

Every record is hashed once. Records of equal file and offset range hash to a leaf, a
fixed number of neighbouring ranges to a node, up to one root per file. Two replicas are
compared at the roots; below a node only ranges whose parents differ are looked at, down
to the records, so an intact file costs one comparison and a damaged record about one per
level. Ranges are fixed by offset, so a missing record disturbs its own branch only.

Null file: the empty name; null offset: -1; null payload: no bytes. Records that share
file and offset are compared as one, by their sorted digests. Other columns are ignored;
a replica without records leaves every record of the other one missing or extra; two
empty ones differ nowhere. Record length is not limited.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, table

#: Bytes of offset under one leaf, and children of a node.
RANGE, FANOUT = 1 << 18, 8


def record_digests(records: DataFrame) -> DataFrame:
    """Rows (file, offset, size, digest) from records (file, offset, payload)."""
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b"").cast("binary"))
    rows = records.select(
        F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"),
        F.coalesce(F.col("offset").cast("bigint"), F.lit(-1)).alias("offset"),
        F.octet_length(payload).cast("bigint").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    grouped = rows.groupBy("file", "offset").agg(
        F.sum("size").alias("size"), F.sort_array(F.collect_list("digest")).alias("digests"), F.first("digest").alias("digest")
    )
    several = F.when(F.size("digests") == 1, F.col("digest")).otherwise(F.sha2(F.array_join("digests", ","), 256))
    return grouped.select("file", "offset", "size", several.alias("digest"))


def _nodes(children: DataFrame, index, order: str, part) -> DataFrame:
    """One level up: digests of ordered children, at most a range's or a fan-out's worth."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, part.alias("part")))), lambda c: c["part"]), "|")
    return children.groupBy("file", index.alias("index")).agg(F.sha2(joined, 256).alias("digest"))


def tree(digests: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of the tree from leaves to roots: rows (file, index, digest)."""
    text = F.concat_ws(":", "offset", "size", "digest")
    found = [materialise(_nodes(digests, F.floor(F.col("offset") / RANGE), "offset", text), "merkle-leaves")]
    for level in range(1, levels + 1):
        up = _nodes(found[-1], F.floor(F.col("index") / FANOUT), "index", F.concat_ws(":", "index", "digest"))
        found.append(materialise(up, f"merkle-{level}"))
    return found


def _depth(digests: list[DataFrame]) -> int:
    """Levels until every file is one node; offset -1 has an index of its own below zero."""
    tops = [d.agg(F.max("offset")).first()[0] for d in digests]
    ranges, levels = max([t for t in tops if t is not None], default=0) // RANGE + 1, 0
    while FANOUT**levels < ranges:
        levels += 1
    return levels


def _different(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    left = a.select(*keys, F.col("digest").alias("left_digest"))
    right = b.select(*keys, F.col("digest").alias("right_digest"))
    return left.join(right, keys, "full").filter(~F.col("left_digest").eqNullSafe(F.col("right_digest")))


def fixity_audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (file, offset, status, left_digest, right_digest) of all records that differ.

    ``left`` and ``right``: records (file, offset, payload). Status is corrupt, missing
    (only left has the record) or extra.
    """
    digests = [materialise(record_digests(r), "merkle-records") for r in (left, right)]
    levels = _depth(digests)
    trees = [tree(d, levels) for d in digests]
    open_ = _different(trees[0][-1], trees[1][-1], ["file", "index"]).select("file", "index")
    for level in range(levels - 1, -1, -1):
        open_ = materialise(open_, "merkle-open").select("file", F.col("index").alias("up"))
        below = [
            t[level].withColumn("up", F.floor(F.col("index") / FANOUT)).join(open_, ["file", "up"], "left_semi") for t in trees
        ]
        open_ = _different(*below, ["file", "index"]).select("file", "index")
    open_ = materialise(open_, "merkle-open")
    records = [
        d.withColumn("index", F.floor(F.col("offset") / RANGE)).join(open_, ["file", "index"], "left_semi") for d in digests
    ]
    status = F.when(F.col("right_digest").isNull(), "missing").when(F.col("left_digest").isNull(), "extra").otherwise("corrupt")
    found = _different(*records, ["file", "offset"])
    return found.select("file", "offset", status.alias("status"), "left_digest", "right_digest")


FILE_PAGES = 500
#: Pages of the second replica whose first byte is flipped, and those that it lacks: id modulo, remainder.
FLIPPED, LOST = (89, 13), (211, 7)


def archive_records(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as archive records (page_id, file, offset, payload), in files of consecutive ids."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    payload = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    page = F.coalesce("page_id", F.lit(0)).cast("bigint")
    rows = table(spark, folder, "pages").select(
        page.alias("page_id"), F.floor(page / FILE_PAGES).cast("string").alias("file"), payload.alias("payload")
    )
    before = Window.partitionBy("file").orderBy("page_id", "payload").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.octet_length("payload")).over(before), F.lit(0))
    return rows.select("page_id", "file", offset.cast("bigint").alias("offset"), "payload")


def damaged(records: DataFrame) -> DataFrame:
    """A second replica with known damage, for the audit to find."""
    flip = F.concat(F.lit("w"), F.expr("substring(payload, 2)"))
    kept = records.filter(F.pmod("page_id", F.lit(LOST[0])) != LOST[1])
    return kept.withColumn("payload", F.when(F.pmod("page_id", F.lit(FLIPPED[0])) == FLIPPED[1], flip).otherwise(F.col("payload")))


SQL = """
WITH records AS (
  SELECT page_id, CAST(page_id // 500 AS VARCHAR) AS file,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
      || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages
), placed AS (
  SELECT page_id, file, payload,
    CAST(coalesce(sum(strlen(payload)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
      AS "offset"
  FROM records
)
SELECT file, "offset", CASE WHEN page_id % 211 = 7 THEN 'missing' ELSE 'corrupt' END AS status,
  sha256(payload) AS left_digest,
  CASE WHEN page_id % 211 = 7 THEN NULL ELSE sha256('w' || substring(payload, 2)) END AS right_digest
FROM placed WHERE page_id % 89 = 13 OR page_id % 211 = 7
"""
