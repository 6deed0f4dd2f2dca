"""Whitening of embeddings from singular values of the centred rows, without forming a covariance.

Vectors become whole numbers, so that their sums are exact and the same on every run. Blocks of centred
rows are reduced to a triangle by QR, triangles of blocks and of tasks again, until one of the vectors' own
size is left. On the driver that triangle is made bidiagonal by Householder reflections, its squared singular values come from the
differential qd algorithm with shifts (dqds), each to high relative accuracy, and a vector of each wanted
value from a twisted factorisation of the bidiagonal's tridiagonal square. What the driver holds is a few
matrices of the vectors' size, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W

# Fixed values of the grid that vectors are put on.
SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
# Rows of one QR step, and triangles that one task merges.
BLOCK_ROWS, FANIN = 4096, 16
EPS = np.finfo(float).eps
# Vectors of values closer than this, relatively, are made orthogonal to each other.
CLUSTER = 1e-3
# Steps, and ten more for each dimension, in which one singular value must be found; a few are usual.
STEPS = 100


# -- singular values and vectors of one triangle


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, tau, beta with (I - tau v v') x = (beta, 0, ...) and v[0] = 1."""
    scale = np.abs(x).max(initial=0.0)
    v = np.zeros_like(x)
    v[:1] = 1
    if scale == 0 or len(x) < 2:
        return v, 0.0, float(x[0]) if len(x) else 0.0
    y = x / scale
    norm = math.sqrt(float(y @ y))
    beta = -math.copysign(norm, y[0])
    v = y / (y[0] - beta)
    v[0] = 1
    return v, (beta - float(y[0])) / beta, beta * scale


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w): r = u B w' with diagonal a and upper diagonal b of B, and w orthogonal. u is not kept."""
    m = np.array(r, float)
    n = len(m)
    w = np.eye(n)
    for k in range(n):
        v, tau, m[k, k] = reflector(m[k:, k].copy())
        m[k + 1 :, k] = 0
        m[k:, k + 1 :] -= tau * np.outer(v, v @ m[k:, k + 1 :])
        if k + 1 < n:
            v, tau, m[k, k + 1] = reflector(m[k, k + 1 :].copy())
            m[k, k + 2 :] = 0
            m[k + 1 :, k + 1 :] -= tau * np.outer(m[k + 1 :, k + 1 :] @ v, v)
            w[:, k + 1 :] -= tau * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def newton_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue of a qd array: 1 / trace of the inverse. 0 if it is singular.

    Each diagonal entry of the inverse follows from the one before; all terms are positive, so nothing cancels.
    """
    entry, trace = 0.0, 0.0
    for k in range(len(q)):
        if q[k] <= 0:
            return 0.0
        entry = (1.0 + (e[k - 1] * entry if k else 0.0)) / q[k]
        trace += entry
    return 1.0 / trace if math.isfinite(trace) else 0.0


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], bool]:
    """One step: the qd array of the same matrix less the shift, and whether all of it stayed positive."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for k in range(n - 1):
        if d < 0:
            return new_q, new_e, False
        new_q[k] = d + e[k]
        if new_q[k] == 0:
            # d and e are both 0: the array falls apart here.
            new_e[k] = 0.0
            d = q[k + 1] - shift
        else:
            ratio = q[k + 1] / new_q[k]
            new_e[k] = e[k] * ratio
            d = d * ratio - shift
    new_q[n - 1] = d
    return new_q, new_e, d >= 0


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal (a, b), falling.

    Shifts never pass the smallest value of the array at hand (a step that would turn negative is made
    anew with a smaller shift, at last with none), so no digit is lost by cancellation; what has been shifted is added
    up. An array is parted where an e is negligible against what it would change.
    """
    out: list[float] = []
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    a, b = a / scale, b / scale
    todo = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        stalled = 0
        while q:
            n = len(q)
            if n == 1:
                out.append(sigma + q[0])
                break
            tiny = EPS * EPS
            if e[n - 2] <= tiny * (sigma + q[n - 1]) or (sigma == 0 and q[n - 1] == 0 and e[n - 2] <= tiny * min(q[n - 2], 1.0)):
                out.append(sigma + q[n - 1])
                q, e = q[:-1], e[:-1]
                stalled = 0
                continue
            part = next((k for k in range(n - 2, -1, -1) if e[k] <= tiny * (sigma + min(q[k], q[k + 1])) or e[k] == 0), None)
            if part is not None:
                todo.append((q[: part + 1], e[:part], sigma))
                q, e = q[part + 1 :], e[part + 1 :]
                stalled = 0
                continue
            if q[0] < q[n - 1] and stalled == 0:
                # The small end last: the array read backwards has the same values.
                q, e = flipped(q, e)
            shift = newton_shift(q, e) * (1 - 4 * EPS * n)
            # The bound is safe and often far too low; a larger one that works is as good.
            for guess in (min(q[n - 1], 0.9 * n * shift), 2 * shift, shift, shift / 2, 0.0):
                new_q, new_e, fine = dqds(q, e, max(0.0, guess))
                if fine:
                    break
            if stalled > STEPS + 10 * n:
                raise ArithmeticError("the qd array does not converge")
            q, e, sigma = new_q, new_e, sigma + max(0.0, guess)
            stalled += 1
    return np.sort(np.array(out))[::-1] * scale * scale


def flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The qd array of the bidiagonal read from its other corner, where B' takes the place of B."""
    return q[::-1], e[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B (B upper bidiagonal: a, b) for an eigenvalue, by a twisted factorisation.

    B'B = L D L' with D = a * a and L's lower diagonal b / a. L D L' - value is factored from the top (L+ D+ L+')
    and from the bottom (U- D- U-'); where the two meet with the smallest gamma the vector is 1, and
    from there it follows up and down without a solve.
    """
    n = len(a)
    d, l = (a * a).tolist(), (b / a[:-1]).tolist()
    safe = lambda x: x if x != 0 else EPS * EPS * max(value, 1e-300)
    s, p = [-value] * n, [0.0] * n
    plus, minus = [0.0] * max(0, n - 1), [0.0] * max(0, n - 1)
    for k in range(n - 1):
        top = safe(s[k] + d[k])
        plus[k] = d[k] * l[k] / top
        s[k + 1] = plus[k] * l[k] * s[k] - value
    p[n - 1] = d[n - 1] - value
    for k in range(n - 2, -1, -1):
        bottom = safe(d[k] * l[k] * l[k] + p[k + 1])
        minus[k] = d[k] * l[k] / bottom
        p[k] = p[k + 1] * (d[k] / bottom) - value
    gamma = [abs(s[k] + p[k] + value) for k in range(n)]
    r = int(np.argmin(np.nan_to_num(np.array(gamma), nan=np.inf)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -plus[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -minus[k] * z[k]
    z /= np.abs(z).max()
    return z / math.sqrt(float(z @ z))


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, columns, total) of a triangle r: the largest eigenvalues of r'r, their unit vectors, and the sum of all values.

    Values that are 0 up to rounding are left out, so there may be fewer than count. Where the bidiagonal
    falls apart, each part has its own values and vectors; inside a part no value comes twice.
    """
    a, b, w = bidiagonal(r)
    n, largest = len(a), max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if largest == 0:
        return np.zeros(0), np.zeros((n, 0)), 0.0
    # An entry of 0 is as good as one far below rounding, and the factorisation divides by it.
    a = np.where(np.abs(a) < EPS * EPS * largest, EPS * EPS * largest, a)
    apart = np.abs(b) <= np.maximum(EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])), EPS * EPS * largest)
    edges = [0, *(np.flatnonzero(apart) + 1).tolist(), n]
    parts = [(lo, hi, squared_singular_values(a[lo:hi], b[lo : hi - 1])) for lo, hi in zip(edges, edges[1:])]
    total = float(sum(v.sum() for _, _, v in parts))
    ranked = sorted(((float(v), lo, hi) for lo, hi, some in parts for v in some), key=lambda x: (-x[0], x[1]))[:count]
    ranked = [x for x in ranked if x[0] > (n * EPS) ** 2 * ranked[0][0]]
    found = np.zeros((n, len(ranked)))
    for k, (value, lo, hi) in enumerate(ranked):
        near = [found[lo:hi, j] for j in range(k) if ranked[j][1] == lo and ranked[j][0] - value <= CLUSTER * ranked[j][0]]
        found[lo:hi, k] = beside(near, a[lo:hi], b[lo : hi - 1], value)
    return np.array([x[0] for x in ranked]), w @ found, total


def beside(near: list[np.ndarray], a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of a value that is orthogonal to those of close values."""
    z = twisted_vector(a, b, value)
    for start in np.eye(len(a)):
        for _ in range(2):
            for other in near:
                z = z - (other @ z) * other
        size = math.sqrt(float(z @ z))
        if size > 0.1:
            break
        # The factorisation gave a vector found before: inverse iteration from an axis that leads elsewhere.
        z = start - sum(((other @ start) * other for other in near), np.zeros(len(a)))
        z = iterated(a, b, value, z)
    return z / math.sqrt(float(z @ z))


def iterated(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """One step of inverse iteration with B'B - value from z."""
    square = np.diag(a) + np.diag(b, 1)
    try:
        out = np.linalg.solve(square.T @ square - value * (1 + 2 * EPS) * np.eye(len(a)), z)
    except np.linalg.LinAlgError:
        return z
    size = float(np.abs(out).max())
    return out / size if math.isfinite(size) and size else z


# -- rows


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """The whole numbers of vectors of doubles."""
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("vector")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def fit_rows(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that count: vector not null, without null and non-finite entries.

    Empty vectors have no entries and no components; they are left out too.
    """
    # Spark's NaN equals itself and is the largest of all doubles.
    wrong = F.exists("vector", lambda c: c.isNull() | (c >= F.lit(math.inf)) | (c <= F.lit(-math.inf)))
    return (
        rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
        .filter(~wrong)
    )


def reduce_blocks(parts: DataFrame, merge, schema: str) -> list:
    """Rows of partial results, one a partition, merged by FANIN at a time until FANIN or fewer are left, which come to the driver.

    Each step shuffles these rows, so the steps before it keep their own number of tasks.
    """
    n = parts.rdd.getNumPartitions()
    while n > FANIN:
        n = -(-n // FANIN)
        parts = parts.repartition(n).mapInArrow(W.tidy(merge), schema)
    return parts.collect()


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sum of each dimension. Vectors of different lengths fail, telling the lengths."""
    size = F.size("vector")
    facts = rows.agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most")).first()
    if not facts["n"]:
        return 0, np.zeros(0, object)
    if facts["least"] != facts["most"]:
        raise ValueError(f"vectors of {facts['least']} to {facts['most']} dimensions have no covariance")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * facts["most"]
        for batch in batches:
            # A batch has fewer than 2 ** 20 rows, and entries up to 2 ** 43 are summed without overflow.
            x = on_grid(matrix(batch)) if batch.num_rows else np.zeros((0, facts["most"]), np.int64)
            low, high = x & 0xFFFFF, x >> 20
            total = [t + (int(h) << 20) + int(o) for t, h, o in zip(total, high.sum(0), low.sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([[str(t) for t in total]], pa.list_(pa.string()))], ["sums"])

    parts = rows.select("vector").mapInArrow(W.tidy(add), "sums array<string>")
    exact = parts.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = np.zeros(facts["most"], object)
    for row in exact.collect():
        out[row["at"]] = int(row["s"])
    return facts["n"], out


def triangle(rows: DataFrame, centre: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of all centred rows, block by block and then triangle by triangle."""
    d = len(centre)

    def folded(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for block in blocks:
            r = np.linalg.qr(np.vstack((r, block)), "r")
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from folded(
            on_grid(matrix(batch.slice(at, BLOCK_ROWS))) - centre
            for batch in batches
            for at in range(0, batch.num_rows, BLOCK_ROWS)
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from folded(np.frombuffer(r).reshape(-1, d) for batch in batches for r in batch.column("r").to_pylist())

    last = reduce_blocks(rows.select("vector").mapInArrow(W.tidy(reduce_rows), "r binary"), merge, "r binary")
    r = np.vstack([np.zeros((0, d)), *(np.frombuffer(bytes(row["r"])).reshape(-1, d) for row in last)])
    # Fewer rows than dimensions leave a triangle with rows of zeros.
    return np.linalg.qr(np.vstack((r, np.zeros((d, d)))), "r")


def moments(rows: DataFrame, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, int]:
    """Co-moments (sums of products about the mean) of the whitened rows, and their number."""
    k = turn.shape[1]

    def joined(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        n, mean, m = 0, np.zeros(k), np.zeros((k, k))
        for some, its_mean, its in parts:
            if some:
                apart = its_mean - mean
                m = m + its + np.outer(apart, apart) * (n * some / (n + some))
                mean = mean + apart * (some / (n + some))
                n += some
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([mean.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], ["n", "mean", "m"]
        )

    def own(block: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        w = block @ turn
        mean = w.mean(0)
        return len(w), mean, (w - mean).T @ (w - mean)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from joined(own(on_grid(matrix(batch)) - centre) for batch in batches if batch.num_rows)

    def unpacked(n: int, mean: bytes, m: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        return n, np.frombuffer(mean), np.frombuffer(m).reshape(k, k)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from joined(unpacked(*r.values()) for batch in batches for r in batch.to_pylist())

    schema = "n long, mean binary, m binary"
    last = reduce_blocks(rows.select("vector").mapInArrow(W.tidy(count), schema), merge, schema)
    whole = pa.RecordBatch.from_pylist([{"n": r["n"], "mean": bytes(r["mean"]), "m": bytes(r["m"])} for r in last])
    row = next(merge(iter([whole]))).to_pylist()[0]
    return np.frombuffer(row["m"]).reshape(k, k), row["n"]


def exact_deviation(x: np.ndarray, n: int, s: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n * x - s) ** 2 of each row, exact; null where it is beyond a long."""
    far = float(max((abs(int(v)) for v in s), default=0)) + float(np.abs(x).max(initial=0)) * n
    if far < 2**62:
        apart = n * x - np.array([int(v) for v in s], np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2**62:
            return pa.array((apart * apart).sum(1), pa.int64())
    rows = ((n * x.astype(object) - s) ** 2).sum(1)
    return pa.array([int(v) if v < 2**63 else None for v in rows], pa.int64())


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict:
    """n, sums, centre, values (of the covariance), turn (columns that whiten), explained and identity_error of vectors."""
    n, s = sums(rows)
    if not n:
        return {"n": 0}
    centre = np.array([int(v) / n for v in s])
    values, vectors, total = directions(triangle(rows, centre) / math.sqrt(n), components)
    turn = vectors / np.sqrt(values)
    error = 0.0
    if len(values):
        m, count = moments(rows, centre, turn)
        error = float(np.abs(m / count - np.eye(len(values))).max())
    return {"n": n, "sums": s, "centre": centre, "values": values, "turn": turn, "explained": values / total, "identity_error": error}


def whitened(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Components run from 1 by falling variance; there are fewer than asked for where the vectors span fewer, and
    none (no rows) if all vectors are equal or there are none. Rows whose vector is null, empty or holds null or
    non-finite entries are left out; vectors of different lengths fail. Repeated rows, null and repeated vec_id come
    back as often as they are there; other columns are left out. deviation is null where it is beyond a long.
    """
    kept = fit_rows(rows, vec_id, vector)
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(kept, components)
    if not found["n"] or not len(found["values"]):
        return rows.sparkSession.createDataFrame([], schema)
    # A few matrices of the vectors' size.
    model = rows.sparkSession.sparkContext.broadcast(found)

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k = len(m["values"])
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = on_grid(matrix(batch))
                w = (x - m["centre"]) @ m["turn"]
                index = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(index)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(index), m["n"], np.int64)),
                        exact_deviation(x, m["n"], m["sums"]).take(pa.array(index)),
                        pa.array(w.ravel()),
                        pa.array(np.tile(m["explained"], len(x))),
                        pa.array(np.full(len(index), m["identity_error"])),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(W.tidy(project_rows), schema)
