"""Merkle fixity audit of web archives.

Each page is a WARC record; records in the order of their keys make up archives of 4096 keys, in which a record has
an offset and a length. A leaf of the tree is a record's SHA-256, with its key; a node of level l covers the keys
that agree but for their last 4 * l bits, an ordered range of offsets, and hashes its up to 16 children's places and
hashes. Two replicas are compared from their roots; only children of nodes that differ are compared further, level by
level, down to the records that are corrupt, missing or extra. A level is a sixteenth of the one below it, so a
clean branch costs no more than its top.

All steps are joins and groups of at most 16 children; nothing of a whole archive meets in one task.

A null url or html is the empty text. Rows that repeat a key are one leaf of all its records, each different one with
its count. A null key gets a negative one from its record's hash; a corrupt copy of it is then missing and extra. An
empty replica misses everything; two empty ones agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.common import kept, stored

#: Bits of the key that one level of the tree covers, and levels of an archive.
STEP, ARCHIVE_LEVEL = 4, 3


def record(key: str, url: str, body: str) -> Column:
    """The bytes of a page's record, as text."""
    content = F.coalesce(F.col(body), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(content).cast("string"), F.lit("\r\n\r\n"), content, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(key, digest, length, copies): the different records of each key."""
    rows = pages.select(F.col(key).cast("long").alias("key"), record(key, url, body).alias("record"))
    rows = rows.select("key", F.sha2(F.col("record").cast("binary"), 256).alias("digest"), F.octet_length("record").cast("long").alias("length"))
    surrogate = -1 - F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    return rows.withColumn("key", F.coalesce("key", surrogate)).groupBy("key", "digest").agg(F.max("length").alias("length"), F.count("*").alias("copies"))


def manifest(rows: DataFrame) -> DataFrame:
    """(key, hash, digest, offset, length) of each leaf: where its first record begins in its archive, and the bytes of all."""
    each = F.struct("digest", "copies", "length")
    leaves = rows.groupBy("key").agg(F.array_sort(F.collect_list(each)).alias("r"), F.sum(F.col("length") * F.col("copies")).alias("length"))
    text = F.array_join(F.transform("r", lambda x: F.concat(x.digest, F.lit("*"), x.copies.cast("string"))), ",")
    before = Window.partitionBy(F.shiftright("key", STEP * ARCHIVE_LEVEL)).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.select("key", F.sha2(text.cast("binary"), 256).alias("hash"), F.col("r")[0].digest.alias("digest"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length")


def parents(nodes: DataFrame) -> DataFrame:
    """(key, hash) of the next level."""
    up = nodes.groupBy(F.shiftright("key", STEP).alias("up")).agg(F.array_sort(F.collect_list(F.struct(F.col("key").alias("k"), "hash"))).alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.concat(x.k.cast("string"), F.lit(":"), x.hash)), ",")
    return up.select(F.col("up").alias("key"), F.sha2(text.cast("binary"), 256).alias("hash"))


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (key, hash) of each level, the leaves first."""
    out = [leaves.select("key", "hash")]
    for _ in range(levels):
        out.append(kept(parents(out[-1])))
    return out


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.select("key", F.col("hash").alias("_a")).join(b.select("key", F.col("hash").alias("_b")), "key", "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b")))


def audit(primary: DataFrame, replica: DataFrame, **columns: str) -> DataFrame:
    """One row for each leaf of the two page tables that differs.

    key, kind (corrupt, missing, extra), archive, offset and length (in the primary, or in the replica if extra), both
    digests, and the archive's hash in the primary.
    """
    a, b = (stored(manifest(records(p, **columns))) for p in (primary, replica))
    least, most = a.select("key").union(b.select("key")).agg(F.min("key"), F.max("key")).first()
    levels = ARCHIVE_LEVEL
    while least is not None and (least >> STEP * levels, most >> STEP * levels) not in ((0, 0), (-1, -1), (-1, 0)):
        levels += 1
    trees = [tree(x, levels) for x in (a, b)]
    suspects = _differing(*(t[levels] for t in trees)).select("key")
    for level in range(levels - 1, -1, -1):
        of = suspects.select(F.col("key").alias("_up"))
        below = [t[level].join(of, F.shiftright("key", STEP) == F.col("_up"), "left_semi") for t in trees]
        suspects = kept(_differing(*below).select("key"))
    ours, theirs = (x.join(suspects, "key", "left_semi") for x in (a, b))
    theirs = theirs.select("key", F.col("digest").alias("_digest"), F.col("offset").alias("_offset"), F.col("length").alias("_length"))
    found = ours.join(theirs, "key", "full_outer").withColumn("archive", F.shiftright("key", STEP * ARCHIVE_LEVEL))
    roots = trees[0][ARCHIVE_LEVEL].select(F.col("key").alias("archive"), F.col("hash").alias("archive_hash"))
    kind = F.when(F.col("_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("corrupt")
    return found.join(roots, "archive", "left").select("key", kind.alias("kind"), "archive", F.coalesce("offset", "_offset").alias("offset"), F.coalesce("length", "_length").alias("length"), F.col("digest").alias("primary_digest"), F.col("_digest").alias("replica_digest"), "archive_hash")


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica as a failing store leaves it: one character in the middle of some pages turned, some pages lost."""
    half = F.expr("length(html) div 2")
    turned = F.concat(F.expr("substring(html, 1, length(html) div 2)"), F.lit("\x1a"), F.expr("substring(html, length(html) div 2 + 2)"))
    html = F.when((F.col("page_id") % 97 == 5) & (half > 0), turned).otherwise(F.col("html"))
    return pages.where(F.coalesce(F.col("page_id") % 389 != 7, F.lit(True))).withColumn("html", html)


_RECORDS = """SELECT key, sha256(r) AS digest, CAST(strlen(r) AS BIGINT) AS length, count(*) AS copies FROM (
    SELECT page_id AS key, 'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl || 'WARC-Record-ID: <urn:page:' || CAST(page_id AS VARCHAR)
      || '>' || nl || 'Content-Type: text/html' || nl || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || nl || nl || coalesce(html, '') || nl || nl AS r
    FROM {pages}, (SELECT chr(13) || chr(10) AS nl)) GROUP BY 1, 2, 3"""
_LEAVES = "SELECT key, sha256(string_agg(digest || '*' || copies, ',' ORDER BY digest)) AS hash, min(digest) AS digest, CAST(sum(length * copies) AS BIGINT) AS length FROM {records} GROUP BY key"
_UP = "SELECT key >> 4 AS key, sha256(string_agg(key || ':' || hash, ',' ORDER BY key)) AS hash FROM {nodes} GROUP BY key >> 4"
AUDIT_SQL = f"""
WITH damaged AS (SELECT page_id, url, CASE WHEN page_id % 97 = 5 AND length(html) // 2 > 0 THEN substr(html, 1, length(html) // 2) || chr(26) || substr(html, length(html) // 2 + 2) ELSE html END AS html FROM pages WHERE page_id % 389 <> 7),
ra AS ({_RECORDS.format(pages="pages")}), rb AS ({_RECORDS.format(pages="damaged")}),
a AS ({_LEAVES.format(records="ra")}), b AS ({_LEAVES.format(records="rb")}),
l1 AS ({_UP.format(nodes="a")}), l2 AS ({_UP.format(nodes="l1")}), l3 AS ({_UP.format(nodes="l2")}),
placed AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY key >> 12 ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM a)
SELECT p.key, CASE WHEN b.key IS NULL THEN 'missing' ELSE 'corrupt' END AS kind, p.key >> 12 AS archive, CAST(p."offset" AS BIGINT) AS "offset", p.length,
       p.digest AS primary_digest, b.digest AS replica_digest, l3.hash AS archive_hash
FROM placed p LEFT JOIN b USING (key) JOIN l3 ON l3.key = p.key >> 12 WHERE b.hash IS DISTINCT FROM p.hash
"""


def archive_audit(pages: DataFrame) -> DataFrame:
    """The audit of the pages' archives against a damaged copy of them."""
    pages = pages.select("page_id", "url", "html")
    return audit(pages, damaged_copy(pages))
