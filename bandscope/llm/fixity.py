"""Merkle fixity audit of WARC replicas.

Records lie one after another; the ranges of `RANGE` bytes they begin in are the leaves of a tree, each the
hash of its records' offsets, ids, lengths and digests in order. A node above is the hash of its children in
order. Two replicas are compared from the root down, and only the children of nodes that differ are looked
at, until the records of the differing ranges tell what is corrupt. All of it is aggregation and joins; a
group holds at most the records that begin in one range (few, since every record has a header), or
`FANOUT` nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandscope.session import broadcast_if_small, stored

RANGE = 1 << 18
FANOUT = 16
# Records that one task lays out, about.
LAID = 50_000


def warc_record(uri: Column, body: Column) -> Column:
    """A response record: header lines, an empty line, the body, two empty lines. Nulls count as empty."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(uri.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def digested(rows: DataFrame, record_id: str, record: Column) -> DataFrame:
    """record_id, length in bytes and SHA-256 of each record."""
    return rows.select(
        F.col(record_id).cast("string").alias("record_id"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
    )


def laid_out(records: DataFrame, order: tuple[str, ...], size: int = LAID) -> DataFrame:
    """`records` with the `offset` of each when they lie in the given order, without gaps.

    Records are range-partitioned by the order, `size` to a range; a range starts after the bytes of the
    ranges before it, one short row a range.
    """
    ranges = max(1, -(-records.count() // size))
    ranged = records.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "laid")
    sizes = ranged.groupBy("_part").agg(F.sum("length").alias("_bytes"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("_part"), F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("length").over(inside), F.lit(0))
    return ranged.withColumn("_own", own).join(F.broadcast(bases), "_part").select(
        *records.columns, (F.col("_base") + F.col("_own")).cast("long").alias("offset")
    )


def digest_of(rows: list[str]) -> Column:
    """SHA-256 of a group's rows in order. Written as JSON, which leaves out nulls with their names, no two lists look alike."""
    return F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct(*rows)))), 256)


def leaves(records: DataFrame, size: int) -> DataFrame:
    """(node, hash) of each range in which records begin. Equal records at one offset all count."""
    ranges = records.groupBy(F.floor(F.col("offset") / size).alias("node"))
    return ranges.agg(digest_of(["offset", "record_id", "length", "digest"]).alias("hash"))


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    return nodes.groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(digest_of(["node", "hash"]).alias("hash"))


def tree(records: DataFrame, levels: int, size: int, fanout: int) -> list[DataFrame]:
    """Nodes of all levels, stored, from the leaves up to the root."""
    out = [stored(leaves(records, size), "level0")]
    for level in range(1, levels):
        out.append(stored(parents(out[-1], fanout), f"level{level}"))
    return out


def differing(a: DataFrame, b: DataFrame, above: DataFrame | None, fanout: int) -> DataFrame:
    """Nodes that differ or that only one replica has; `above` are the differing nodes one level up."""
    if above is not None:
        up = broadcast_if_small(above.select(F.col("node").alias("up")))
        a, b = (x.join(up, F.floor(F.col("node") / fanout) == F.col("up"), "left_semi") for x in (a, b))
    b = b.select(F.col("node").alias("other"), F.col("hash").alias("its"))
    both = a.join(b, F.col("node") == F.col("other"), "full_outer")
    return both.filter(~F.col("hash").eqNullSafe(F.col("its"))).select(F.coalesce("node", "other").alias("node"))


def audit(ours: DataFrame, theirs: DataFrame, size: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """Corrupt records of two replicas: offset, record_id, status and both lengths and digests.

    Each replica has record_id, offset, length and digest; records belong together if their offset and id
    do. status is changed, missing (only ours has it) or surplus (only theirs has it); records without
    offset are left out. Of several records at one offset with one id, each is compared with each. Without
    a difference, and for empty replicas, there are no rows.
    """
    ours, theirs = (r.select("record_id", "offset", "length", "digest").filter("offset IS NOT NULL") for r in (ours, theirs))
    ends = [r.agg(F.max("offset")).first()[0] for r in (ours, theirs)]
    top, levels = max((e or 0) for e in ends) // size, 1
    while top:
        top, levels = top // fanout, levels + 1
    one, two = tree(ours, levels, size, fanout), tree(theirs, levels, size, fanout)
    bad = None
    for level in reversed(range(levels)):
        bad = stored(differing(one[level], two[level], bad, fanout), f"differs{level}")
        if bad.isEmpty():
            break
    ranges = broadcast_if_small(bad)
    a, b = (r.join(ranges, F.floor(F.col("offset") / size) == F.col("node"), "left_semi") for r in (ours, theirs))
    b = b.select(*(F.col(c).alias(f"their_{c}") for c in b.columns))
    same = (F.col("offset") == F.col("their_offset")) & F.col("record_id").eqNullSafe(F.col("their_record_id"))
    status = F.when(F.col("their_offset").isNull(), "missing").when(F.col("offset").isNull(), "surplus").otherwise("changed")
    equal = F.col("length").eqNullSafe(F.col("their_length")) & F.col("digest").eqNullSafe(F.col("their_digest"))
    return (
        a.join(b, same, "full_outer")
        .filter(~(equal & F.col("offset").isNotNull() & F.col("their_offset").isNotNull()))
        .select(
            F.coalesce("offset", "their_offset").alias("offset"),
            F.when(F.col("offset").isNull(), F.col("their_record_id")).otherwise(F.col("record_id")).alias("record_id"),
            status.alias("status"),
            "length",
            "digest",
            "their_length",
            "their_digest",
        )
    )
