"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Every entry c becomes the integer x = floor(64 * c) + OFFSET. The offset cancels in all that follows, so
the work is done on z = floor(64 * c), a small number. The fit list holds each distinct vector once:

1. Spark tasks add up n, S = sum(z) and sum(z z^T) exactly (products of 20-bit limbs in blocks whose sums
   a double holds exactly; 40-bit digits to Spark's sums). M = n * sum(z z^T) - S S^T is an integer
   matrix, n^2 times the covariance V of the centred x.
2. The characteristic polynomial of M modulo primes below 2^31, by Hessenberg reduction, one Spark
   task for a few primes; Chinese remaindering gives its integer coefficients.
3. All roots are real, so Descartes' rule counts the roots beyond a point exactly: the largest roots
   are isolated by bisection with such counts, multiplicities included, and narrowed by exact signs.
4. A component is the null space of M - root * I: elimination with complete pivoting in fixed-point
   integers, then a step of inverse iteration; a root of multiplicity m gives m orthonormal
   vectors. One Spark task per root.
5. Spark tasks project every row; the covariance of the whitened fit list is measured by one more pass.

The driver holds numbers of the matrix only, nothing that grows with the rows.

Edge cases: vectors that are null or hold null or non-finite entries are dropped; vectors of different
lengths are whitened by length, each length with its own fit; components are those with a
positive eigenvalue, so constant vectors and those of length 0 give no rows; a null vec_id is kept;
repeated rows all come out; a deviation beyond a long is null; 64 * c beyond a long counts as the
outermost long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm.shared import stored

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
LIMB = 20
LIMB_ROWS = 4096  # 2^(20 + 20 + 12) is below 2^53
DIGIT = 40
DIGITS = 5
PRIME_BELOW = 1 << 31
PRIMES_PER_TASK = 4
#: Fractional bits of roots and of the elimination, beyond those that told the roots apart.
BITS = 192
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---------------------------------------------------------------------------- exact sums


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """z as sum(limb[k] << LIMB * k), all limbs but the last in [0, 2^LIMB), the last signed."""
    out, rest = [], z
    while rest.size and int(np.abs(rest, dtype=np.float64).max()) >= 1 << (LIMB - 1):
        out.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB
    return [*out, rest.astype(np.float64)]


def scatter(z: np.ndarray) -> np.ndarray:
    """sum(z z^T) over the rows of z (int64), as Python integers."""
    d = z.shape[1]
    total = np.zeros((d, d), object)
    for at in range(0, len(z), LIMB_ROWS):
        limbs = _limbs(z[at : at + LIMB_ROWS])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total = total + ((a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j)))
    return total


def column_sums(z: np.ndarray) -> np.ndarray:
    low, high = z & 0xFFFFFFFF, z >> 32
    return low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) << 32)


def _digits(value: int) -> list[int]:
    out = []
    for _ in range(DIGITS - 1):
        out.append(value & ((1 << DIGIT) - 1))
        value >>= DIGIT
    return [*out, value]


def _partial_sums(length: int):
    """A task's sums as (i, j, digits): i, j < length for z_i * z_j, i = -1 for z_j, j = -1 for rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums, products = 0, np.zeros(length, object), np.zeros((length, length), object)
        for batch in batches:
            if len(batch):
                z = _vectors(batch.column("z"), length)
                rows, sums, products = rows + len(z), sums + column_sums(z), products + scatter(z)
        if not rows:
            return
        entries = [(-1, -1, rows)] + [(-1, j, int(sums[j])) for j in range(length)]
        entries += [(i, j, int(products[i, j])) for i in range(length) for j in range(i, length)]
        for at in range(0, len(entries), 1 << 16):
            part = entries[at : at + (1 << 16)]
            digits = zip(*(_digits(v) for _, _, v in part), strict=True)
            columns = [pa.array([e[k] for e in part], pa.int32()) for k in (0, 1)] + [pa.array(c, pa.int64()) for c in digits]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *(f"d{k}" for k in range(DIGITS))])

    return add


def total_sums(fit: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sum(z), sum(z z^T)) over the rows of fit (z), exactly."""
    digits = [f"d{k}" for k in range(DIGITS)]
    parts = fit.mapInArrow(_partial_sums(length), f"i int, j int, {', '.join(f'{d} long' for d in digits)}")
    n, sums, products = 0, [0] * length, [[0] * length for _ in range(length)]
    for r in parts.groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in digits]).collect():
        value = sum(r[d] << (DIGIT * k) for k, d in enumerate(digits))
        if r["j"] < 0:
            n = value
        elif r["i"] < 0:
            sums[r["j"]] = value
        else:
            products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = value
    return n, sums, products


# ---------------------------------------------------------------------------- characteristic polynomial


def primes(count: int) -> list[int]:
    """The largest primes below PRIME_BELOW."""

    def prime(p: int) -> bool:  # Miller-Rabin; these bases decide every number below 3.2e9
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
                return False
        return True

    found, p = [], PRIME_BELOW - 1
    while len(found) < count:
        if prime(p):
            found.append(p)
        p -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - matrix) modulo p, constant first, by Hessenberg reduction."""
    h = np.array(matrix % p, np.int64)
    d = len(h)
    for k in range(1, d - 1):
        nonzero = np.flatnonzero(h[k:, k - 1])
        if not len(nonzero):
            continue
        pivot = k + int(nonzero[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for m in range(1, d + 1):
        previous = polynomials[m - 1]
        new = np.roll(previous, 1)
        new = (new - h[m - 1, m - 1] * previous % p) % p
        down, factors = 1, []
        for i in range(m - 1, 0, -1):
            down = down * int(h[i, i - 1]) % p
            factors.append(down * int(h[i - 1, m - 1]) % p)
        if factors:  # of the polynomials m - 2, m - 3, .. 0
            taken = polynomials[m - 2 :: -1] if m >= 2 else polynomials[:0]
            new = (new - (np.array(factors, np.int64)[:, None] * taken[: len(factors)] % p).sum(axis=0)) % p
        polynomials[m] = new
    return polynomials[d]


def _spread(spark: SparkSession, items: list[tuple], fields: str, work: Callable, result: str, tasks: int) -> list:
    """work(rows) over a few rows per task; the items are numbers of the matrix, never of the data."""
    frame = spark.createDataFrame(items, fields).repartition(max(1, tasks))
    return frame.mapInArrow(work, result).collect()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x I - matrix), constant first, for a positive semidefinite matrix."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The coefficients' absolute values add up to at most (1 + trace / d)^d.
    bound = 2 * ((d + trace) ** d // d**d + 1)
    chosen = primes(bound.bit_length() // 30 + 1)
    shared = spark.sparkContext.broadcast(matrix)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.array(shared.value, object)
        for batch in batches:
            moduli = batch.column("p").to_pylist()
            rests = [polynomial_modulo(full, p).tolist() for p in moduli]
            yield pa.RecordBatch.from_arrays([pa.array(moduli, pa.int64()), pa.array(rests, pa.list_(pa.int64()))], names=["p", "rest"])

    rows = _spread(spark, [(p,) for p in chosen], "p long", work, "p long, rest array<long>", -(-len(chosen) // PRIMES_PER_TASK))
    shared.destroy()
    return remainders_to_integers({r["p"]: list(r["rest"]) for r in rows})


def remainders_to_integers(rests: dict[int, list[int]]) -> list[int]:
    """The integers of least absolute value with these remainders."""
    values, modulus = [0] * len(next(iter(rests.values()))), 1
    for p, rest in rests.items():
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, rest, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


# ---------------------------------------------------------------------------- roots


def _primitive(f: list[int]) -> list[int]:
    while f and f[-1] == 0:
        f = f[:-1]
    content = reduce(gcd, f, 0)
    return [c // content for c in f] if content else []


def _remainder(f: list[int], g: list[int]) -> list[int]:
    """A multiple of the remainder of f by g."""
    f = list(f)
    while len(f) >= len(g):
        lead, shift = f[-1], len(f) - len(g)
        f = [c * g[-1] for c in f]
        for k, c in enumerate(g):
            f[k + shift] -= lead * c
        f.pop()
    return _primitive(f)


def _quotient(f: list[int], g: list[int]) -> list[int]:
    """f / g, up to a factor, where g divides f."""
    f, out = list(f), [0] * (len(f) - len(g) + 1)
    for at in range(len(out) - 1, -1, -1):
        if f[at + len(g) - 1] % g[-1]:
            f, out = [c * g[-1] for c in f], [c * g[-1] for c in out]
        out[at] = f[at + len(g) - 1] // g[-1]
        for k, c in enumerate(g):
            f[at + k] -= out[at] * c
    return _primitive(out)


def squarefree(f: list[int]) -> list[int]:
    """The polynomial with each root of f once."""
    derived = [k * c for k, c in enumerate(f)][1:]
    p = primes(1)[0]
    # No common factor modulo one prime that keeps the degrees: none over the integers.
    a, b = [c % p for c in f], [c % p for c in derived]
    if b and b[-1] and a[-1]:
        while b:
            inverse = pow(b[-1], -1, p)
            while len(a) >= len(b):
                factor, shift = a[-1] * inverse % p, len(a) - len(b)
                for k, c in enumerate(b):
                    a[k + shift] = (a[k + shift] - factor * c) % p
                a.pop()
            while a and a[-1] == 0:
                a.pop()
            a, b = b, a
        if len(a) == 1:
            return f
    a, b = _primitive(f), _primitive(derived)
    while b:
        a, b = b, _remainder(a, b) if len(b) > 1 else []
    g = a if len(a) > 1 else [1]
    f = _quotient(_primitive(f), g)
    return f if f[-1] > 0 else [-c for c in f]


def roots_beyond(f: list[int], point: int, bits: int) -> int:
    """How many roots of the real-rooted f, by multiplicity, lie beyond point / 2^bits (Descartes' rule)."""
    d = len(f) - 1
    c = [a << (bits * (d - k)) for k, a in enumerate(f)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += point * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(f: list[int], point: int, bits: int) -> int:
    value = 0
    for k in range(len(f) - 1, -1, -1):
        value = value * point + (f[k] << (bits * (len(f) - 1 - k)))
    return (value > 0) - (value < 0)


@dataclass
class Root:
    """A root in (low, high] / 2^bits, and how often it counts."""

    low: int
    high: int
    bits: int
    times: int


def largest_roots(f: list[int], count: int) -> list[Root]:
    """The largest positive roots of a real-rooted polynomial, falling, until `count` are had by multiplicity.

    Isolated by bisection with exact counts, then narrowed by exact signs to BITS bits beyond that.
    """
    zeros = next(k for k, c in enumerate(f) if c)
    f = f[zeros:]
    if len(f) == 1:
        return []
    once = squarefree(f)
    top = abs(f[-2]) + 1  # the sum of the roots bounds each
    found: list[Root] = []
    # Intervals still to be split, the rightmost last: (low, high, bits, roots of `once` beyond low and high).
    todo = [(0, top, 0, len(once) - 1, 0)]
    while todo and sum(r.times for r in found) < count:
        low, high, bits, beyond_low, beyond_high = todo.pop()
        if beyond_low - beyond_high == 0:
            continue
        if beyond_low - beyond_high == 1:
            times = roots_beyond(f, low, bits) - roots_beyond(f, high, bits) if len(once) < len(f) else 1
            found.append(_narrow(once, low, high, bits, beyond_high, times))
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        beyond = roots_beyond(once, middle, bits)
        todo.append((low, middle, bits, beyond_low, beyond))
        todo.append((middle, high, bits, beyond, beyond_high))
    return found


def _narrow(f: list[int], low: int, high: int, bits: int, beyond: int, times: int) -> Root:
    right = -1 if beyond % 2 else 1  # the sign between the root and the next one
    target = bits + BITS
    while bits < target or high - low > 1:
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        sign = sign_at(f, middle, bits)
        if sign == 0:
            return Root(middle << (target - bits), middle << (target - bits), target, times)
        low, high = (low, middle) if sign == right else (middle, high)
    return Root(low, high, bits, times)


# ---------------------------------------------------------------------------- components


def null_space(matrix: list[list[int]], root: int, bits: int, times: int) -> np.ndarray:
    """`times` orthonormal rows spanning the null space of matrix - root / 2^bits, in double precision.

    Elimination with complete pivoting in fixed-point integers, then one step of inverse iteration.
    """
    d = len(matrix)
    a = np.array([[v << bits for v in row] for row in matrix], object)
    a[np.diag_indices(d)] -= root
    across, down = list(range(d)), []
    rank = d - times
    for k in range(rank):
        sizes = np.abs(a[k:, k:])
        at = int(np.argmax(sizes))
        i, j = k + at // (d - k), k + at % (d - k)
        down.append(i)
        a[[k, i]] = a[[i, k]]
        a[:, [k, j]] = a[:, [j, k]]
        across[k], across[j] = across[j], across[k]
        factors = (a[k + 1 :, k] << bits) // a[k, k]
        a[k + 1 :, k] = factors
        a[k + 1 :, k + 1 :] -= (factors[:, None] * a[k, k + 1 :]) >> bits

    def back(right: np.ndarray, free: np.ndarray) -> np.ndarray:
        """x with the given free entries and (upper triangle) x = right."""
        x = np.zeros(d, object)
        x[rank:] = free
        for k in range(rank - 1, -1, -1):
            rest = right[k] - (int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> bits)
            x[k] = (rest << bits) // a[k, k]
        return x

    def whole(x: np.ndarray) -> np.ndarray:
        vector = np.zeros(d, object)
        vector[across] = x
        return vector

    vectors = []
    for t in range(times):
        free = np.zeros(times, object)
        free[t] = 1 << bits
        x = back(np.zeros(d, object), free)
        if times == 1 and a[rank, rank]:
            # Inverse iteration: the last pivot is what the root's approximation leaves. Solving with the
            # null vector on the right gives that vector over the pivot, plus a particular solution.
            y = whole(x)
            for k, i in enumerate(down):
                y[[k, i]] = y[[i, k]]
            for k in range(rank):
                y[k + 1 :] -= (a[k + 1 :, k] * y[k]) >> bits
            if y[rank]:
                x = x + (back(y, free * 0) * a[rank, rank]) // y[rank]
        vector = whole(x)
        for other in vectors:
            vector = vector - ((other * (int((vector * other).sum()) >> bits)) >> bits)
        length = isqrt(int((vector * vector).sum()))
        vectors.append((vector << bits) // length)
    return np.array([[v / (1 << bits) for v in vector] for vector in vectors], np.float64)


@dataclass
class Model:
    """What whitening a row needs: n, sums of z, the components over sqrt(eigenvalue), shares of the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: list[float]


def fit_model(spark: SparkSession, fit: DataFrame, length: int, components: int = COMPONENTS) -> Model:
    n, sums, products = total_sums(fit, length)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(length)] for i in range(length)]
    trace = sum(matrix[i][i] for i in range(length))
    if trace == 0:
        return Model(n, sums, np.zeros((0, length)), [])
    # Whole factors of the matrix leave before the polynomial; its roots are those of matrix / content.
    content = reduce(gcd, (v for row in matrix for v in row), 0)
    reduced = [[v // content for v in row] for row in matrix]
    roots = largest_roots(characteristic_polynomial(spark, reduced), components)
    shared = spark.sparkContext.broadcast(reduced)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                vectors = null_space(shared.value, int(r["value"]), r["bits"], r["times"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["number"]] * len(vectors), pa.int32()), pa.array(vectors.tolist(), pa.list_(pa.float64()))],
                    names=["number", "vector"],
                )

    items = [(k, str((r.low + r.high) // 2), r.bits, r.times) for k, r in enumerate(roots)]
    rows = _spread(spark, items, "number int, value string, bits int, times int", work, "number int, vector array<double>", len(items))
    shared.destroy()
    axes, explained = [], []
    for r in sorted(rows, key=lambda r: r["number"]):  # equal eigenvalues: the order of their vectors is any
        root = roots[r["number"]]
        whole = ((root.low + root.high) // 2) * content  # n^2 * eigenvalue, times 2^bits
        axes.append(np.array(r["vector"]) / np.sqrt(whole / (n * n << root.bits)))
        explained.append(whole / (trace << root.bits))
    return Model(n, sums, np.array(axes[:components]), explained[:components])


# ---------------------------------------------------------------------------- rows


def _project(z: np.ndarray, model: Model) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return (z.astype(np.float64) - mean) @ model.axes.T


def _deviations(z: np.ndarray, model: Model) -> list[int | None]:
    """sum((n * z - S)^2) of each row; None beyond a long."""
    most = model.n * max(abs(int(z.min())), abs(int(z.max()))) + max(map(abs, model.sums))
    kind = np.int64 if z.shape[1] * most * most < 1 << 63 else object
    centred = z.astype(kind) * model.n - np.array(model.sums, kind)
    return [int(v) if v < 1 << 63 else None for v in (centred * centred).sum(axis=1)]


def _moments(model: Model, length: int):
    """A task's sums of whitened values (i = -1) and of their products."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.axes)
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if len(batch):
                w = _project(_vectors(batch.column("z"), length), model)
                sums, products = sums + w.sum(axis=0), products + w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        columns = [np.concatenate([np.full(k, -1), i]), np.concatenate([np.arange(k), j]), np.concatenate([sums, products.ravel()])]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["i", "j", "total"])

    return add


def identity_error(fit: DataFrame, model: Model, length: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured."""
    parts = fit.mapInArrow(_moments(model, length), "i int, j int, total double")
    totals = {(r["i"], r["j"]): r["total"] / model.n for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    k = range(len(model.axes))
    return max(abs(totals[i, j] - totals[-1, i] * totals[-1, j] - (i == j)) for i in k for j in k)


def _whitened(model: Model, error: float, length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.axes)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                z = _vectors(part.column("z"), length)
                rows = pa.array(np.repeat(np.arange(len(z)), k))
                columns = [
                    part.column("vec_id").take(rows),
                    pa.array(np.tile(np.arange(1, k + 1), len(z)), pa.int32()),
                    pa.array(np.full(len(z) * k, model.n), pa.int64()),
                    pa.array(_deviations(z, model), pa.int64()).take(rows),
                    pa.array(_project(z, model).ravel()),
                    pa.array(np.tile(model.explained, len(z))),
                    pa.array(np.full(len(z) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return emit


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, z) of the vectors without null or non-finite entries; x is z + OFFSET."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(~bad)
    return kept.select("vec_id", F.transform("embedding", lambda c: F.floor(c * SCALE)).alias("z"))


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable vector."""
    rows = whole_numbers(vectors)
    fit = stored(spark, rows.select("z").distinct(), "whitening-fit")
    lengths = sorted(r["length"] for r in fit.select(F.size("z").alias("length")).distinct().collect())
    found = spark.createDataFrame([], SCHEMA)
    for length in lengths:
        own = fit.filter(F.size("z") == length)
        model = fit_model(spark, own, length, components)
        if len(model.axes):
            emit = _whitened(model, identity_error(own, model, length), length)
            found = found.unionAll(rows.filter(F.size("z") == length).mapInArrow(emit, SCHEMA))
    return found
