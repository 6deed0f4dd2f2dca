"""Near duplicates among embeddings, by binary codes of randomly rotated vectors.

A unit vector is rotated, and the signs of its coordinates are its code. With the stored factor f, the
inner product of the vector and its own code, <code, rotated q> / f estimates <vector, q> without bias,
and sqrt((1 - f * f) / (f * f * (d - 1))) bounds its error in standard deviations. Several independent
rotations are averaged. The same signs, some at a time, key the buckets in which vectors of one label
meet. A pair whose upper bound is below the threshold is settled; every other pair is computed exactly, in
double precision.

Equal vectors form a class, and classes are compared in blocks of bounded size; pairs are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.graph import bucket_edges, components, in_blocks, joined_classes, link_counts, linked_rows, told_apart, whole_groups
from bandscope.session import broadcast_if_small, stored

THRESHOLD = 0.98
RECALL = 0.999
# Rotations in the stored code, and error bounds in standard deviations.
ROTATIONS, DEVIATIONS = 4, 5.0
BUCKET_BLOCK, GROUP_BLOCK = 256, 256
SEED = 20240229


@lru_cache(maxsize=256)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation of vectors of this size, always the same for the same number."""
    q, r = np.linalg.qr(np.random.default_rng((SEED, size, number)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def bucket_plan(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a bucket key and number of keys.

    Enough bits that unrelated vectors seldom meet, and so many keys that a pair at the threshold misses
    all of them with a chance of 1 - recall; a sign agrees with the chance 1 - angle / pi.
    """
    bits = min(48, max(12, math.ceil(math.log2(max(2, rows))) + 2))
    agree = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))) if agree < 1 else 1


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def coded(rows: DataFrame, bits: int, trees: int) -> DataFrame:
    """(doc_id, cls, vector, code, keys) of linkable rows (doc_id, group, vector array<double>).

    cls tells the group and the vector, vector is the unit vector's doubles, code holds the signs of
    `ROTATIONS` rotations and a factor for each.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = np.diff(np.asarray(column.offsets))
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                x = unit(some.column("vector").flatten().to_numpy().reshape(some.num_rows, size))
                need = max(ROTATIONS, -(-trees * bits // int(size)))
                turned = [x @ rotation(int(size), r).T for r in range(need)]
                factors = np.stack([np.abs(t).sum(1) / math.sqrt(size) for t in turned[:ROTATIONS]], 1)
                signs = np.concatenate(turned, 1) > 0
                codes = np.packbits(signs[:, : ROTATIONS * size], axis=1)
                weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
                group = some.column("group").to_numpy().view(np.uint64)
                salts = W.mix(np.arange(1, trees + 1, dtype=np.uint64))
                keys = np.stack([signs[:, t * bits : (t + 1) * bits] @ weights for t in range(trees)], 1)
                keys = W.mix(W.mix(keys ^ salts) ^ group[:, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id"),
                        some.column("cls"),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                        pa.array([c.tobytes() + f.tobytes() for c, f in zip(codes, factors, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, keys.size + 1, trees, dtype=np.int32), np.ascontiguousarray(keys).view(np.int64).ravel()),
                    ],
                    ["doc_id", "cls", "vector", "code", "keys"],
                )

    return rows.mapInArrow(W.tidy(code), "doc_id long, cls long, vector binary, code binary, keys array<long>")


@lru_cache(maxsize=16)
def rotations(size: int) -> np.ndarray:
    """All rotations of vectors of this size side by side, as `possible` multiplies by them."""
    return np.concatenate([rotation(size, r).T for r in range(ROTATIONS)], 1).astype(np.float32)


def possible(codes: np.ndarray, vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in codes, in vectors) of the pairs whose estimated inner product may reach the threshold.

    codes has a code of bytes in each row. The estimate is taken in single precision, whose error of some 1e-6 is added to the bound.
    """
    size = vectors.shape[1]
    packed = -(-ROTATIONS * size // 8)
    factors = np.ascontiguousarray(codes[:, packed:]).view(np.float64)
    signs = np.unpackbits(codes[:, :packed], axis=1, count=ROTATIONS * size).astype(np.float32)
    signs *= 2
    signs -= 1
    signs.reshape(len(codes), ROTATIONS, size)[:] /= (factors * math.sqrt(size) * ROTATIONS)[:, :, None]
    spread = np.sqrt(np.maximum(0, 1 / factors**2 - 1).sum(1)) / (ROTATIONS * math.sqrt(max(1, size - 1)))
    estimate = signs @ (vectors.astype(np.float32) @ rotations(size)).T
    return np.nonzero(estimate >= (threshold - 1e-4 - DEVIATIONS * spread)[:, None])


def judged(table: pa.Table, threshold: float, exact: bool):
    """Linked positions: by bounds alone, or with an exact computation of what the bounds leave open."""
    codes, cells = table.column("code").to_pylist(), table.column("vector").to_pylist()
    sizes = np.array([len(c) for c in cells], np.int64)
    # Vectors and codes of one length as one matrix, and the row of each position in it.
    row, held = np.zeros(len(cells), np.int64), {}
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        row[own] = np.arange(len(own))
        held[size] = (
            np.frombuffer(b"".join(cells[i] for i in own), np.float64).reshape(len(own), -1),
            np.frombuffer(b"".join(codes[i] for i in own), np.uint8).reshape(len(own), -1),
        )

    def linked(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for size in np.unique(sizes[x]).tolist():
            p, q = x[sizes[x] == size], y[sizes[y] == size]
            if not len(q):
                continue
            vectors, signs = held[size]
            a, b = possible(signs[row[p]], vectors[row[q]], threshold)
            if exact and len(a):
                for at in range(0, len(a), 1 << 14):
                    s, t = p[a[at : at + (1 << 14)]], q[b[at : at + (1 << 14)]]
                    keep = (vectors[row[s]] * vectors[row[t]]).sum(1) >= threshold
                    yield s[keep], t[keep]
            else:
                yield p[a], q[b]

    return linked


def near_embeddings(
    table: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row for each row: vec_id, n_links, component_id, kept.

    Rows are linked if their labels are equal and not null, their vectors are equally long and their cosine
    in double precision is `threshold` or more. Vectors that are null, empty or zero, or hold a null or a
    number that is not finite, are linked with nothing. Links are never wrong; a pair at the threshold is
    met in a bucket with a chance of `recall`, closer ones and larger groups with a higher one. component_id is
    the smallest vec_id reachable, the row's own for a row without links; kept says vec_id is component_id.
    Repeated rows are linked with each other; null ids take part.
    """
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.col(label).isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0)
    rows = table.select(
        F.col(vec_id).cast("long").alias("doc_id"),
        F.coalesce(fit, F.lit(False)).alias("fit"),
        F.xxhash64(label, F.lit("group")).alias("group"),
        F.when(fit, F.xxhash64(label, embedding)).alias("cls"),
        F.when(fit, F.xxhash64(embedding, label, F.lit("again"))).alias("cls2"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    rows = told_apart(rows)
    live = rows.filter("fit")
    bits, trees = bucket_plan(live.count(), threshold, recall)
    made = stored(coded(live.select("doc_id", "group", "cls", "vector"), bits, trees), "coded")
    edges = bucket_edges(
        made.select("cls", F.explode("keys").alias("key")),
        made.select("cls", "vector", "code"),
        BUCKET_BLOCK,
        lambda t: judged(t, threshold, exact=False),
    )
    groups = stored(components(edges), "groups")
    members = (
        made.join(broadcast_if_small(groups), made["cls"] == groups["node"])
        .groupBy("cls", "component")
        .agg(F.count("*").alias("copies"), F.min("vector").alias("vector"), F.min("code").alias("code"))
    )
    members = stored(members, "members")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / GROUP_BLOCK).alias("blocks"))
    blocks = in_blocks(members.join(broadcast_if_small(stored(sizes, "sizes")), "component"), "component", "cls", "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, ("component", "b1", "b2")):
            cls, copies = part.column("cls").to_numpy(), part.column("copies").to_numpy()
            found = list(linked_rows(part, "component", judged(part, threshold, exact=True)))
            left, right = (np.concatenate([np.zeros(0, np.int64), *(f[side] for f in found)]) for side in (0, 1))
            if len(left):
                yield link_counts(cls, copies, left, right)

    links = blocks.select("component", "b1", "b2", "b", "cls", "copies", "vector", "code").mapInArrow(W.tidy(compare), "cls long, links long, root long")
    many = joined_classes(made.select("doc_id", "cls"), stored(links, "links"))
    found = F.col("group_size").isNotNull()
    component = F.when(found, F.col("class_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "cls").join(broadcast_if_small(many), "cls", "left").select(
        F.col("doc_id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
