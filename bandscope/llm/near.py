"""N-gram Jaccard join: a MinHash LSH forest proposes pairs, exact shingle sets decide.

A text's shingles are the distinct runs of `WORDS` lower-cased words; a text of fewer words, but not none,
has one shingle of all its words. Texts with equal sets form a class, and only classes are compared.
Each class has a path of min-hashes in each of `TREES` tries: bytes whose order is the order of the trie, so a prefix
of a path is a node. Classes meet at the nodes they share. The deepest nodes are matched first; then
prefixes are shortened by one min-hash, round by round, for those classes that have not met their recall: a class
stops at the depth at which the least similarity a partner of it can have (which follows from its number of shingles,
and is the threshold or more) is met in some trie with a chance of `RECALL`. Classes that no partner is
possible for take no part. What earlier rounds connected is not compared again. Where one min-hash a tree misses the
recall, there are more trees. Members of a node whose signatures agree well enough are joined into candidate
groups; inside a group every pair of classes is compared exactly, once.

Nodes and groups of any size are cut into blocks by hash and compared block by block; pairs are never
written out, only each class's number of links and enough links to connect it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.graph import Judge, bucket_edges, components, in_blocks, joined_classes, link_counts, linked_rows, told_apart, whole_groups
from bandscope.session import broadcast_if_small, stored

WORDS = 5
THRESHOLD = 0.8
TREES, DEEPEST = 24, 6
RECALL = 0.9999
# Estimates lie this many standard deviations below the threshold at most.
DEVIATIONS = 5.5
# Members in a block of a bucket, and classes and shingles in a block of a group, about.
BUCKET_BLOCK = 2048
GROUP_BLOCK, GROUP_SHINGLES = 512, 1 << 20
# Classes of more shingles than this may have a partner at just the threshold.
FEW_SHINGLES = 400


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, one row after another, and the bounds of rows."""
    made = W.grams(hashes, tuple(range(1, n)))
    rows = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            rows.append(np.unique(made[a : b - n + 1]))
        elif b > a:
            rows.append(W.mix(W.grams(hashes[a:b], tuple(range(1, b - a))) + np.uint64(b - a)))
        else:
            rows.append(hashes[:0])
    bounds = np.cumsum([0, *map(len, rows)])
    return np.concatenate(rows) if rows else hashes[:0], bounds


def class_ids(sets: np.ndarray, bounds: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit id for each set, the same for equal sets; 0 for the empty one. Another seed gives independent ids."""
    total = np.append(np.uint64(0), np.cumsum(W.mix(sets ^ (W.BASE + np.uint64(2 * seed)))))
    ids = W.mix((total[bounds[1:]] - total[bounds[:-1]]) + np.diff(bounds).astype(np.uint64) * W.BASE)
    return np.where(np.diff(bounds) > 0, ids, 0).view(np.int64)


def prefix_depth(threshold: float, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """The longest prefix with which pairs of the threshold similarity are met with at least `recall`."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def forest(threshold: float) -> tuple[int, int]:
    """Trees and depth with which pairs of the threshold similarity are met with at least `RECALL`."""
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not above 0 and at most 1")
    trees = TREES
    while 1 - (1 - threshold) ** trees < RECALL:
        trees += 1
    return trees, prefix_depth(threshold, trees)


def least_similarity(n: int, threshold: float) -> float | None:
    """The smallest similarity of `threshold` or more that a set of n has with any other set; None if there is none."""
    if n > FEW_SHINGLES:
        return threshold
    best = None
    for m in range(max(1, math.floor(threshold * n)), math.ceil(n / threshold) + 1):
        both = math.ceil(threshold * (n + m) / (1 + threshold) - 1e-9)
        if both <= min(n, m) and not both == n == m:
            found = both / (n + m - both)
            best = found if best is None else min(best, found)
    return best


def stop_depths(threshold: float, trees: int, deepest: int) -> np.ndarray:
    """For sets of 0, 1, ... FEW_SHINGLES and more shingles the depth at which their recall is met; beyond the deepest: no part."""
    out = np.full(FEW_SHINGLES + 2, deepest + 1, np.int32)
    for n in range(1, FEW_SHINGLES + 2):
        least = least_similarity(n, threshold)
        if least is not None:
            out[n] = prefix_depth(min(1.0, max(least, threshold)), trees, deepest)
    return out


def signatures(sets: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """n min-hashes for each non-empty set."""
    some = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(some), n), np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    spread = (sets & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    seeds = W.mix(np.arange(1, n + 1, dtype=np.uint64) * W.BASE)
    for k in range(n if len(some) else 0):
        out[:, k] = np.minimum.reduceat((short * np.uint32(seeds[k] >> np.uint64(33) | np.uint64(1))) ^ (spread * np.uint32(seeds[k] & np.uint64(0xFFFFFFFE) | np.uint64(1))), some)
    return out


def signed(docs: DataFrame, threshold: float, doc_id: str, text: str) -> DataFrame:
    """For every row doc_id, th (hash of the text), cls and cls2, n (shingles), stop (depth), paths (of all trees) and sig (one byte a min-hash)."""
    trees, _ = forest(threshold)
    deepest = DEEPEST if trees == TREES else 1
    stops = stop_depths(threshold, trees, deepest)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                _, _, hashes, first = W.words(W.column(part.column("text")))
                sets, bounds = shingles(hashes, first, WORDS)
                n = np.diff(bounds)
                # More trees than usual are one min-hash deep.
                made = signatures(sets, bounds, max(trees, TREES * DEEPEST))
                paths = made[:, : trees * deepest].astype(">u4")
                sig = made[:, : TREES * DEEPEST].astype(np.uint8)
                row = np.cumsum(n > 0) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("th"),
                        pa.array(class_ids(sets, bounds)),
                        pa.array(class_ids(sets, bounds, 1)),
                        pa.array(n),
                        pa.array(stops[np.minimum(n, FEW_SHINGLES + 1)]),
                        pa.array([paths[r].tobytes() if s else b"" for r, s in zip(row, n > 0, strict=True)], pa.binary()),
                        pa.array([sig[r].tobytes() if s else b"" for r, s in zip(row, n > 0, strict=True)], pa.binary()),
                    ],
                    ["doc_id", "th", "cls", "cls2", "n", "stop", "paths", "sig"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(W.tidy(sign), "doc_id long, th long, cls long, cls2 long, n long, stop int, paths binary, sig binary")


def nodes_at(depth: int, trees: int, deepest: int) -> Column:
    """The node of each tree that a class's path passes at a depth, as a hash of the tree and the prefix."""
    prefix = lambda t: F.substring("paths", t * deepest * 4 + 1, depth * 4)
    return F.array(*(F.xxhash64(F.lit(t), prefix(t)) for t in range(trees)))


def judged(threshold: float) -> Judge:
    """Pairs of a node whose signatures make the threshold likely enough, but for those of one grp."""
    n = TREES * DEEPEST
    need = threshold - DEVIATIONS * (threshold * (1 - threshold) / n) ** 0.5

    def judge(table: pa.Table):
        bytes_ = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, n)
        grp = table.column("grp").to_numpy()

        def compared(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for at in range(0, len(x), 32):
                some = x[at : at + 32]
                # By chance one byte in 256 agrees, which only adds candidates.
                equal = (bytes_[some][:, None, :] == bytes_[y][None]).sum(2, dtype=np.int32)
                a, b = np.nonzero((equal >= need * n) & (grp[some][:, None] != grp[y][None]))
                yield some[a], y[b]

        def linked(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            # Inside the largest grp there is nothing to find.
            names, sizes = np.unique(grp[np.union1d(x, y)], return_counts=True)
            if len(names) > 1:
                most = names[sizes.argmax()]
                yield from compared(x[grp[x] != most], y)
                yield from compared(x[grp[x] == most], y[grp[y] != most])

        return linked

    return judge


def candidate_groups(sig: DataFrame, threshold: float) -> DataFrame:
    """(node, component) of the classes that may be linked with another, found from the deepest prefixes to the shortest.

    Between rounds classes are told by the least class that one edge leads to; what that leaves apart is joined at the end.
    """
    trees, depth = forest(threshold)
    deepest = DEEPEST if trees == TREES else 1
    edges = known = None
    for at in range(deepest, depth - 1, -1):
        here = sig.filter(F.col("stop") <= at).withColumn("grp", F.col("cls"))
        if known is not None:
            here = here.join(broadcast_if_small(known), F.col("cls") == F.col("u"), "left").withColumn("grp", F.coalesce("least", "cls"))
        keyed = here.select("cls", "grp", F.explode(nodes_at(at, trees, deepest)).alias("key"))
        met = stored(bucket_edges(keyed, here.select("cls", "sig"), BUCKET_BLOCK, judged(threshold)), "met")
        edges = met if edges is None else edges.unionByName(met)
        if at > depth:
            known = stored(edges.groupBy("u").agg(F.min("v").alias("least")), "known-edges")
    return stored(components(edges), "groups")


def intersections(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For shingles that several sets have: set number and shingle number, one row for each occurrence."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(every, return_inverse=True, return_counts=True)
    common = count[number] > 1
    renumber = np.cumsum(count > 1) - 1
    return owner[common], renumber[number[common]]


def overlap(x: list[np.ndarray], y: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Common shingles of each set of x with each of y."""
    owner, shingle = intersections([*x, *y])
    out = np.zeros((len(x), len(y)), np.float32)
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    for begin in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, width):
        a, b = np.searchsorted(shingle, (begin, begin + width))
        grid = np.zeros((len(x) + len(y), width), np.float32)
        grid[owner[a:b], shingle[a:b] - begin] = 1
        out += grid[: len(x)] @ grid[len(x) :].T
    return out


def verified(docs: DataFrame, sig: DataFrame, groups: DataFrame, threshold: float, doc_id: str, text: str) -> DataFrame:
    """Exact links inside candidate groups: rows (cls, links, root) for parts of each class's links.

    links counts the documents of other classes; (cls, root) are edges that connect what is linked.
    """
    classes = stored(
        sig.join(broadcast_if_small(groups), sig["cls"] == groups["node"])
        .groupBy("cls", "component")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n"), F.min("cls2").alias("cls2")),
        "classes",
    )
    sizes = classes.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / GROUP_BLOCK, F.sum("n") / GROUP_SHINGLES)).alias("blocks")
    )
    few = broadcast_if_small(stored(classes.join(sizes, "component"), "grouped"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = texts.join(few, F.col("id").eqNullSafe(F.col("rep"))).select("component", "cls", "cls2", "copies", "text", "blocks")
    blocks = in_blocks(rows, "component", "cls", "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("component", "b1", "b2")):
            cls = table.column("cls").to_numpy()
            copies = table.column("copies").to_numpy()
            _, _, hashes, first = W.words(W.column(table.column("text")))
            sets, bounds = shingles(hashes, first, WORDS)
            # Another text may have the representative's id.
            own = class_ids(sets, bounds, 1) == table.column("cls2").to_numpy()

            def linked(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                x, y = x[own[x]], y[own[y]]
                x, y = x[np.unique(cls[x], return_index=True)[1]], y[np.unique(cls[y], return_index=True)[1]]
                if len(x) and len(y):
                    both = overlap([sets[bounds[i] : bounds[i + 1]] for i in x], [sets[bounds[i] : bounds[i + 1]] for i in y])
                    size = np.diff(bounds)
                    union = size[x][:, None] + size[y][None] - both
                    a, b = np.nonzero(both >= threshold * union - 1e-9)
                    yield x[a], y[b]

            for left, right in linked_rows(table, "component", linked):
                yield link_counts(cls, copies, left, right)

    return blocks.select("component", "b1", "b2", "b", "cls", "cls2", "copies", "text").mapInArrow(W.tidy(compare), "cls long, links long, root long")


def grouped_rows(docs: DataFrame, threshold: float, doc_id: str, text: str) -> DataFrame:
    """The columns of `jaccard_join` and `component`: one value for each group, null for rows linked with nothing."""
    sig = told_apart(stored(signed(docs, threshold, doc_id, text), "signed"))
    groups = candidate_groups(sig, threshold)
    found = stored(verified(docs, sig, groups, threshold, doc_id, text), "links")
    many = joined_classes(sig.filter("n > 0").select("doc_id", "cls"), found)
    # A row whose class has no other is its own class.
    return sig.join(broadcast_if_small(many), "cls", "left").select(
        "doc_id",
        "th",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "component",
    )


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, th (xxhash64 of the text), class_id, n_links, group_size.

    Two rows are linked if their texts' shingle sets have a Jaccard similarity of `threshold` or more.
    n_links counts the other rows linked directly; class_id is the smallest doc_id among the rows reachable
    by links, group_size their number. Null texts and texts without words have no shingles: they are
    linked with nothing, and their class_id is their own doc_id. Ids must be whole numbers. Rows with a null doc_id take part; their
    class_id is null only if no reachable row has an id. Repeated rows are copies of each other.
    """
    return grouped_rows(docs, threshold, doc_id, text).drop("component")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group stays, that with the smallest doc_id, with the columns of `docs`.

    Texts without words are no duplicates of anything. Rows alike in id and text count as one row; where a
    group's smallest id has several texts, or no row of it has an id, the one with the smallest hash stays.
    """
    found = stored(grouped_rows(docs, threshold, "doc_id", "text"), "joined").filter("group_size > 1")
    # Ids may be shared by groups, or missing: a group is told by its component.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    marked = found.join(broadcast_if_small(stored(first, "kept")), "component")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    per_row = stored(
        marked.groupBy("doc_id", "th").agg(F.max(stays).alias("stays"), F.count("*").alias("times")), "marked"
    )
    own = "_th"
    while own in docs.columns:
        own += "_"
    keyed = docs.select("*", F.xxhash64("text").alias(own))
    same = keyed["doc_id"].cast("long").eqNullSafe(per_row["doc_id"]) & (keyed[own] == per_row["th"])
    gone = broadcast_if_small(per_row.filter("NOT stays OR times > 1").select("doc_id", "th"))
    rest = keyed.join(gone, same, "left_anti").select(*docs.columns)
    twice = per_row.filter("stays AND times > 1").select("doc_id", "th")
    if twice.isEmpty():
        return rest
    again = keyed.join(broadcast_if_small(twice), same, "left_semi").dropDuplicates(["doc_id", own])
    return rest.unionByName(again.select(*docs.columns))
