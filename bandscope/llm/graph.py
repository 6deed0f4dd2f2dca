"""Connected components, and helpers for comparing the members of groups pair by pair in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.session import broadcast_if_small, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the smallest node it is connected with.

    Alternates the large-star and small-star steps, each round written to the shared folder, until nothing
    changes. A node's smallest neighbour is found with partial aggregation, written, and joined back: from a
    written table both sides of the join are shuffled, so that a hub is split like any skewed key. Edges of a node with itself and null ends are left out.
    """
    now = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    signed = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    sign = tuple(now.agg(*signed).first())
    while sign[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = tuple(now.agg(*signed).first())
        if new == sign:
            break
        sign = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def told_apart(rows: DataFrame) -> DataFrame:
    """`rows` with classes told by two hashes, 128 bits: things that share `cls` but not `cls2` get an id of both.

    Null classes are left alone. Where no class is shared, which is nearly always, the rows come back as they are.
    """
    shared = rows.groupBy("cls").agg(F.min("cls2").alias("lo"), F.max("cls2").alias("hi")).filter("lo < hi").select("cls")
    shared = stored(shared, "shared-ids")
    if shared.isEmpty():
        return rows
    marked = broadcast_if_small(shared.withColumn("again", F.lit(True)))
    both = F.when(F.col("again"), F.xxhash64("cls", "cls2")).otherwise(F.col("cls"))
    return stored(rows.join(marked, "cls", "left").withColumn("cls", both).drop("again"), "told-apart")


def in_blocks(members: DataFrame, group: str, member: str, blocks: str) -> DataFrame:
    """Rows of `members` for every pair of blocks of their group, with b1 <= b2 and their own block b.

    A group's `blocks` says how many blocks it has; members are spread over them by hash. All pairs of a
    group meet in exactly one pair of blocks, or in (b, b) for members of one block.
    """
    own = members.withColumn("b", F.pmod(F.xxhash64(member, F.lit("block")), F.col(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return (
        own.withColumn("_o", other)
        .withColumn("b1", F.least("b", "_o"))
        .withColumn("b2", F.greatest("b", "_o"))
        .drop("_o", blocks)
        .repartition(F.xxhash64(group, "b1", "b2"))
        .sortWithinPartitions(group, "b1", "b2")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables that hold all rows of each of their groups, from batches sorted by the columns `names`."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is not None and tuple(k[0] for k in keys) != last
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        at = np.flatnonzero(change)
        if len(at):
            if held or at[-1]:
                yield pa.Table.from_batches([*held, batch.slice(0, int(at[-1]))])
            held = [batch.slice(int(at[-1]))]
        else:
            held.append(batch)
        last = tuple(k[-1] for k in keys)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Where groups of equal neighbouring rows begin, and the end."""
    change = np.ones(table.num_rows + 1, bool)
    change[1:-1] = False
    for n in names:
        k = table.column(n).to_numpy()
        change[1:-1] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest position connected with each of n positions by the pairs (left, right)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label, new.copy())
        new = new[new]
        if (new == label).all():
            return label
        label = new


def pairs_in(blocks: np.ndarray, b1: int, b2: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the two sides to compare: the same for one block."""
    return np.flatnonzero(blocks == b1), np.flatnonzero(blocks == b2)


def linked_rows(
    table: pa.Table, group: str, linked: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block pair of the table the positions (left, right) of its linked members, each pair once.

    `linked` gets the positions of the two sides and yields pairs of positions.
    """
    bounds = group_bounds(table, (group, "b1", "b2"))
    block, b1, b2 = (table.column(n).to_numpy() for n in ("b", "b1", "b2"))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        x, y = pairs_in(block[lo:hi], b1[lo], b2[lo])
        if len(x) and len(y) and (hi - lo > 1):
            for left, right in linked(x + lo, y + lo):
                keep = left < right if b1[lo] == b2[lo] else slice(None)
                yield left[keep], right[keep]


Judge = Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]]


def bucket_edges(keyed: DataFrame, payload: DataFrame, block: int, judge: Judge) -> DataFrame:
    """Edges (u, v) that connect the classes of a bucket that `judge` finds alike.

    `keyed` has a row (cls, key) for each bucket a class is in, `payload` any number of equal rows for a
    class. A column `grp` of `keyed` names what a class is known to be connected with: classes of one grp need no edge.
    Only buckets with two of them are compared, and buckets with the same members once.
    """
    if "grp" not in keyed.columns:
        keyed = keyed.withColumn("grp", F.col("cls"))
    shared = keyed.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).filter("lo < hi").select("key")
    members = stored(keyed.join(broadcast_if_small(stored(shared, "shared")), "key").distinct(), "members")
    alike = (F.bit_xor(F.xxhash64("cls")).alias("h1"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("h2"))
    buckets = (
        members.groupBy("key")
        .agg(F.count("*").alias("size"), *alike)
        .groupBy("size", "h1", "h2")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / block).alias("blocks"))
    )
    members = members.join(broadcast_if_small(stored(buckets, "buckets")), "key")
    names = stored(members.select("cls").distinct(), "names")
    columns = [c for c in payload.columns if c != "cls"]
    one = payload.join(broadcast_if_small(names), "cls").groupBy("cls").agg(*(F.min(c).alias(c) for c in columns))
    blocks = in_blocks(members.join(stored(one, "payload"), "cls"), "key", "cls", "blocks")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("key", "b1", "b2")):
            cls, place = np.unique(table.column("cls").to_numpy(), return_inverse=True)
            found = list(linked_rows(table, "key", judge(table)))
            if found:
                label = roots(place[np.concatenate([a for a, _ in found])], place[np.concatenate([b for _, b in found])], len(cls))
                moved = np.flatnonzero(label != np.arange(len(cls)))
                yield pa.RecordBatch.from_arrays([pa.array(cls[moved]), pa.array(cls[label[moved]])], ["u", "v"])

    return blocks.select("key", "b1", "b2", "b", "cls", "grp", *columns).mapInArrow(W.tidy(connect), "u long, v long")


def link_counts(cls: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Rows (cls, links, root) of linked positions: rows linked with each class here, and what connects them."""
    names, place = np.unique(cls[np.append(left, right)], return_inverse=True)
    a, b = place[: len(left)], place[len(left) :]
    links = np.zeros(len(names), np.int64)
    np.add.at(links, a, copies[right])
    np.add.at(links, b, copies[left])
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(links), pa.array(names[roots(a, b, len(names))])], ["cls", "links", "root"]
    )


def joined_classes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(cls, component, class_id, group_size, n_links) of the classes with more than one row, stored.

    `rows` has a row (doc_id, cls) for each row that can be linked, `found` those of `link_counts`. The
    component is the same for all classes of a group and for no other; class_id is the smallest id
    reachable, group_size the rows reachable, n_links the other rows linked.
    """
    joined = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    classes = rows.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    known = classes.join(links, "cls", "left").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    known = stored(known.withColumn("component", F.coalesce("component", "cls")), "known")
    smallest = known.groupBy("component").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("group_size"))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    many = known.join(smallest, "component").filter("group_size > 1").select("cls", "component", "class_id", "group_size", n_links)
    return stored(many, "many")
