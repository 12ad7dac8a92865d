"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is hashed to a leaf. The leaves of a group are numbered in order; each run of
``FANOUT`` consecutive nodes hashes to a node of the next level, up to one subroot per
group; the subroots, ordered by group, form one more tree up to the root. A level is an
equijoin of the node table with itself: a slot-zero node computes the indices of its run
(index + slot offset; for pairs index XOR 1), meets the nodes there and emits the parent.
A key of that join has one node on either side, a run at most ``FANOUT``. Numbering sorts
by range and adds the counts of the ranges before, so a group of any size is spread over
tasks.

A proof is the list of siblings left and right of a node on each level. Runs carry it
downwards, so a row meets it in a single join at the leaves.

Null group: a group of its own, before all others. Null key: before all others. Repeated
keys are ordered by leaf; equal rows are leaves of their own with equal digests. Null or
empty values have different leaves. A group of one row is its own subroot; an empty table
has no rows and no root. Columns that are not named are ignored; the length of a text is
limited by what a row may hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import lower_ascii, materialise, table

#: Children of a node, bytes of a digest, columns that a leaf covers.
FANOUT, DIGEST = 16, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """leaves: (group, index, width, digest, row columns); levels: runs of each level, from the
    leaves up; subroots: (group, digest, root and path above the subroot)."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame


def digest_of(fields: Sequence[Column]) -> Column:
    """Digest (binary) of values, each as its byte count, a colon and its text, or - if null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def combined(digests: Column) -> Column:
    """Digest of digests one behind the other, each as hex text."""
    return F.unhex(F.sha2(hex_of(digests).cast("binary"), 256))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds index, a row's place in its group from 0, and width, the rows of the group."""
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialise(placed.select("*", F.spark_partition_id().alias("part"), within.alias("at")), "manifest-order")
    cells = placed.groupBy(group, "part").agg(F.min("at").alias("start"), F.count("*").alias("held"))
    whole = Window.partitionBy(group)
    before = F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = F.coalesce(before, F.lit(0)) - F.col("start")
    cells = cells.select(group, "part", shift.alias("shift"), F.sum("held").over(whole).alias("width"))
    return placed.join(cells, [group, "part"]).withColumn("index", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _runs(nodes: DataFrame) -> DataFrame:
    """Rows (group, base, siblings, index, width, digest): the digests of a run, and its parent.

    A slot-zero node computes the indices of its run, meets each in an equijoin and emits the parent.
    """
    last = F.least(F.lit(FANOUT), F.col("width") - F.col("index")) - 1
    zero = nodes.filter(F.col("index") % FANOUT == 0).select(
        "group", F.col("index").alias("base"), "width", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("slot")
    )
    sibling = F.col("base").bitwiseXOR(F.col("slot")) if FANOUT == 2 else F.col("base") + F.col("slot")
    met = zero.withColumn("index", sibling).join(nodes.select("group", "index", "digest"), ["group", "index"])
    run = F.sort_array(F.collect_list(F.struct("slot", "digest")))
    runs = met.groupBy("group", "base", "width").agg(run.alias("run"))
    siblings = F.aggregate("run", F.lit(b""), lambda held, r: F.concat(held, r["digest"]))
    return runs.withColumn("siblings", siblings).select(
        "group",
        "base",
        "siblings",
        F.floor(F.col("base") / FANOUT).alias("index"),
        F.ceil(F.col("width") / FANOUT).alias("width"),
        combined(F.col("siblings")).alias("digest"),
    )


def climb(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level above ``leaves`` (group, index, width, digest), and the top of each group."""
    widest = leaves.agg(F.max("width")).first()[0] or 0
    levels, tops, nodes = [], leaves.filter("width = 1").select("group", "digest"), leaves
    while widest > 1:
        levels.append(materialise(_runs(nodes.filter("width > 1")), "manifest-level"))
        nodes, widest = levels[-1], -(-widest // FANOUT)
        tops = tops.union(nodes.filter("width = 1").select("group", "digest"))
    return levels, tops


def _beside(siblings: Column, slot: Column) -> Column:
    """What stands left and right of a slot in a run."""
    left = F.substr(siblings, F.lit(1), slot * DIGEST)
    right = F.substr(siblings, (slot + 1) * DIGEST + 1, F.lit(FANOUT * DIGEST))
    return F.struct(left.alias("left"), right.alias("right"))


def descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves with their proof: ``tops`` (group, path, other columns) carried down the levels.

    path: an array of (left, right), from the leaf's run upwards.
    """
    carried = [c for c in tops.columns if c != "group"]
    known = None  # runs of the level above with the path over them
    for nodes in [*levels[::-1], leaves]:
        own = nodes.columns
        met = nodes.filter("width = 1").join(tops, "group")
        if known is not None:
            slot = (F.col("index") % FANOUT).cast("int")
            below = nodes.filter("width > 1").select(*own, (F.col("index") - slot).alias("run"), slot.alias("place"))
            above = known.select("group", F.col("base").alias("run"), F.col("siblings").alias("around"), *carried)
            path = F.concat(F.array(_beside(F.col("around"), F.col("place"))), F.col("path"))
            joined = below.join(above, ["group", "run"]).withColumn("path", path)
            met = met.select(*own, *carried).unionByName(joined.select(*own, *carried))
        known = met
    return known.select(*leaves.columns, *carried)


def folded(digest: Column, path: Column) -> Column:
    """The root that follows from a digest and its proof."""
    return F.aggregate(path, digest, lambda held, p: combined(F.concat(p["left"], held, p["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, upwards and from left to right."""
    return combined(F.aggregate(path, F.lit(b""), lambda held, p: F.concat(held, p["left"], p["right"])))


def build(rows: DataFrame, group: Column, order: Column, digest: Column, *extra: Column) -> Manifest:
    """The manifest of ``rows``; ``extra`` columns stay with the leaves."""
    known = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    salt = F.monotonically_increasing_id()
    hashed = rows.select(known.alias("group"), order.alias("order"), digest.alias("digest"), salt.alias("salt"), *extra)
    hashed = materialise(hashed, "manifest-leaves")
    leaves = materialise(numbered(hashed, "group", ["order", "digest", "salt"]).drop("salt"), "manifest-numbered")
    levels, tops = climb(leaves)
    named = numbered(tops.select(F.lit("").alias("group"), F.col("group").alias("name"), "digest"), "group", ["name"])
    top_levels, top = climb(named)
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    above = descend(named, top_levels, top.select("group", none.alias("path"), F.col("digest").alias("root")))
    subroots = above.select(F.col("name").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    return Manifest(leaves, levels, materialise(subroots, "manifest-roots"))


def proofs(manifest: Manifest) -> DataFrame:
    """Leaves with subroot, root and path."""
    return descend(manifest.leaves, manifest.levels, manifest.subroots)


def tampered(text: Column) -> Column:
    """What an unnoticed clean-up might do to a text."""
    return lower_ascii(text)


def audited(documents: DataFrame, every: int = 5) -> DataFrame:
    """Manifest of documents, and the check of each row after tampering with some of them.

    Rows whose id's crc32 ``every`` divides are read again with their text lower-cased.
    """
    fields = [F.col(f) for f in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % every == 0, F.lit(False))
    changed = [F.col(f) if f != "text" else tampered(F.col(f).cast("string")) for f in FIELDS]
    again = F.when(hit, digest_of(changed))
    held = build(documents, F.col("source"), F.col("doc_id").cast("bigint"), digest_of(fields), again.alias("again"))
    rows = proofs(held).withColumn("folded", folded(F.coalesce("again", "digest"), F.col("path")))
    return rows.select(
        F.col("order").alias("doc_id"),
        hex_of(F.col("digest")).alias("leaf"),
        hex_of(F.col("subroot")).alias("subroot"),
        hex_of(F.col("root")).alias("root"),
        hex_of(proof_digest(F.col("path"))).alias("proof_sha256"),
        hex_of(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def documents_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return audited(table(spark, folder, "documents"))


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree(name: str, leaves: str) -> str:
    """Levels of a tree over ``leaves`` (grp, idx, h, w), with what stands beside each node."""
    return f"""{name}_nodes AS (
  SELECT 0 AS lvl, grp, idx, h, w FROM {leaves}
  UNION ALL
  SELECT lvl + 1, grp, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(w) + 15) // 16
  FROM {name}_nodes WHERE w > 1 GROUP BY lvl, grp, idx // 16
), {name}_beside AS (
  SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_nodes WINDOW run AS (PARTITION BY lvl, grp, idx // 16 ORDER BY idx)
)"""


def _walk(name: str, start: str) -> str:
    """From ``start`` (place, grp, idx, proof, folded) to the top of the tree."""
    return f"""{name}_walk AS (
  SELECT 0 AS lvl, place, grp, idx, proof, folded FROM {start}
  UNION ALL
  SELECT k.lvl + 1, k.place, k.grp, k.idx // 16, k.proof || b.l || b.r, sha256(b.l || k.folded || b.r)
  FROM {name}_walk k JOIN {name}_beside b ON k.lvl = b.lvl AND k.grp = b.grp AND k.idx = b.idx WHERE b.w > 1
), {name}_end AS (
  SELECT k.* FROM {name}_walk k JOIN {name}_beside b ON k.lvl = b.lvl AND k.grp = b.grp AND k.idx = b.idx WHERE b.w = 1
)"""


_LEAF = " || ".join(map(_field, FIELDS))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH RECURSIVE crc_steps AS (
  SELECT range AS i, 0 AS n, range AS c FROM range(256)
  UNION ALL
  SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE n < 8
), crc AS (
  SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE n = 8
), sums AS (
  SELECT documents.*, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295) AS crc
  FROM documents, crc
), hashed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS grp, sha256({_LEAF}) AS h,
    CASE WHEN crc % 5 = 0 THEN sha256({_LEAF.replace("CAST(text AS", f"CAST({_LOWER} AS")}) END AS again
  FROM sums
), leaves AS (
  SELECT *, row_number() OVER (ORDER BY grp, doc_id NULLS FIRST, h) AS place,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS w
  FROM hashed
), {_tree("source", "leaves")}, subroots AS (
  SELECT '' AS grp, grp AS name, row_number() OVER (ORDER BY grp) - 1 AS idx, h, count(*) OVER () AS w
  FROM source_nodes WHERE w = 1
), {_tree("top", "subroots")}, begun AS (
  SELECT place, grp, idx, '' AS proof, coalesce(again, h) AS folded FROM leaves
), {_walk("source", "begun")}, going AS (
  SELECT k.place, '' AS grp, s.idx, k.proof, k.folded FROM source_end k JOIN subroots s ON k.grp = s.name
), {_walk("top", "going")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(k.proof) AS proof_sha256, k.folded AS folded_root,
  k.folded = r.h AS verified
FROM leaves l JOIN top_end k ON l.place = k.place JOIN subroots s ON l.grp = s.name,
  (SELECT h FROM top_nodes WHERE w = 1) r
"""
