"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

An entry ``c`` is the whole number ``x = floor(1024 * c) + 100000``. Tasks sum the rows and
their products without rounding, so the scatter ``N = n * sum(x x') - S S'`` (``n * n`` times
the covariance) is an exact integer matrix. Its characteristic polynomial is found modulo
many primes, a few primes a task, by reduction to Hessenberg form, and put together by
Chinese remaindering; there are as many primes as a bound of the coefficients asks. All
roots are real, so the sign changes of the polynomial moved to ``a`` count the roots above
``a`` with their multiplicity. Bisection isolates the largest roots and carries them to many
more digits than a double has. A component is the null space of ``N`` less its root, by
inverse iteration in whole numbers of the same precision.

Only the sums (some ``d * d / 2`` numbers for ``d`` dimensions) reach the driver. Their number
follows the dimension, not the rows, and more than ``MAX_DIMENSION`` entries raise an error.

Defined results: a row whose vector is null, or holds null, non-finite entries or entries
beyond ``LARGEST`` (whose ``x`` is no long) is dropped. A vector shorter than the longest one
has zeros for the entries it lacks; an empty one is all zeros. A row without an id keeps
null as its id, and rows with the same id stay apart. A component without variance can't be
scaled to one, so there are as many components as the scatter's rank if that is below the
number asked for; equal vectors and empty tables give no rows. Components of equal variance
are any orthonormal basis of their space. ``deviation`` is null beyond a long;
``deviation_decimal`` holds it up to 38 digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
MAX_DIMENSION = 1024
#: Largest size of an entry: 1024 times more is still a long.
LARGEST = 9.0e15
LIMB = 20
#: Bits that a wanted root has at least, and that fractions of the elimination have.
ROOT_BITS, WORK_BITS = 120, 192
PRIMES_A_TASK = 8
LONG = 2**63


@dataclass(frozen=True)
class Spectrum:
    """Exact sums of the rows, and the components of largest variance."""

    n: int
    #: Sums of the entries less ``SHIFT``.
    sums: list[int]
    vectors: np.ndarray
    #: Roots of the scatter, as doubles, and their shares of its trace.
    roots: list[float]
    explained: list[float]


# Exact sums


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that stay; ``v`` is an array of doubles."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    return rows.where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)))


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """floor(1024 * c) of all rows; rows that lack entries get zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    held = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
    if len(held) == len(sizes) * width:
        return held.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = held
    return out


def products(y: np.ndarray) -> np.ndarray:
    """y'y as exact Python numbers, from products of limbs that a double holds exactly."""
    wide = len(y) and int(np.abs(y).max()) >= 1 << LIMB
    last = 3 if wide else 0
    limbs = [((y >> (LIMB * k)) & ((1 << LIMB) - 1) if k < last else y >> (LIMB * k)) for k in range(last + 1)]
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for start in range(0, len(y), 4096):
        part = [x[start : start + 4096].astype(np.float64) for x in limbs]
        for a, left in enumerate(part):
            for b, right in enumerate(part):
                total += (left.T @ right).astype(np.int64).astype(object) << (LIMB * (a + b))
    return total


def _scatter_task(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, square = np.zeros(width, dtype=object), np.zeros((width, width), dtype=object)
        for batch in batches:
            y = whole_numbers(batch.column("v"), width)
            sums += y.astype(object).sum(axis=0) if len(y) else 0
            square += products(y)
        above = np.triu_indices(width)
        i = np.concatenate([above[0], np.arange(width)])
        j = np.concatenate([above[1], np.full(width, -1)])
        values = [*square[above], *sums]
        mask = (1 << 40) - 1
        columns = {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())}
        for k in range(4):
            part = [(v >> (40 * k)) & mask if k < 3 else v >> 120 for v in values]
            columns[f"c{k}"] = pa.array(part, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)

    return run


def exact_sums(rows: DataFrame, width: int) -> tuple[list[int], list[list[int]]]:
    """Sums of all entries and of their products, over all rows."""
    partial = rows.select("v").mapInArrow(_scatter_task(width), "i int, j int, c0 long, c1 long, c2 long, c3 long")
    added = partial.groupBy("i", "j").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(4)])
    sums, square = [0] * width, [[0] * width for _ in range(width)]
    for r in added.collect():
        value = sum(r[f"c{k}"] << (40 * k) for k in range(4))
        if r["j"] < 0:
            sums[r["i"]] = value
        else:
            square[r["i"]][r["j"]] = square[r["j"]][r["i"]] = value
    return sums, square


# Characteristic polynomial


def primes_below(limit: int, count: int) -> list[int]:
    def is_prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # certain below 3,215,031,751
            x = pow(base, odd, p)
            if x in (1, p - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    found, p = [], limit - 1 - limit % 2
    while len(found) < count:
        if is_prime(p):
            found.append(p)
        p -= 2
    return found


def polynomial_residues(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime, lowest power first."""
    d, p = len(matrix), np.array(primes, dtype=np.int64)
    exact = np.array(matrix, dtype=object).reshape(d, d)
    a = np.stack([(exact % q).astype(np.int64) for q in primes])
    row, cell = p[:, None], p[:, None, None]

    def inverse(x: np.ndarray) -> np.ndarray:
        out, base, power = np.ones_like(x), x.copy(), p - 2
        while power.any():
            out = np.where(power % 2 == 1, out * base % p, out)
            base, power = base * base % p, power // 2
        return out

    for k in range(d - 2):
        below = a[:, k + 1 :, k] != 0
        for q in np.flatnonzero(~below[:, 0] & below.any(axis=1)):
            other = k + 1 + int(below[q].argmax())
            a[q, [k + 1, other]] = a[q, [other, k + 1]]
            a[q][:, [k + 1, other]] = a[q][:, [other, k + 1]]
        factors = a[:, k + 2 :, k] * inverse(a[:, k + 1, k])[:, None] % row
        a[:, k + 2 :] = (a[:, k + 2 :] - factors[:, :, None] * a[:, k + 1, None, :] % cell) % cell
        moved = (a[:, :, k + 2 :] * factors[:, None, :] % cell).sum(axis=2)
        a[:, :, k + 1] = (a[:, :, k + 1] + moved) % row
    # One polynomial for each leading block, from those before it.
    leading = np.zeros((d + 1, len(p), d + 1), dtype=np.int64)
    leading[0, :, 0] = 1
    for k in range(1, d + 1):
        now = np.roll(leading[k - 1], 1, axis=1) - a[:, k - 1, k - 1, None] * leading[k - 1] % row
        along = np.ones_like(p)
        for i in range(1, k):
            along = along * a[:, k - i, k - i - 1] % p
            weight = along * a[:, k - i - 1, k - 1] % p
            now -= weight[:, None] * leading[k - i - 1] % row
        leading[k] = now % row
    return leading[d]


def _residue_task(matrix: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            primes = batch.column("prime").to_pylist()
            for start in range(0, len(primes), PRIMES_A_TASK):
                some = primes[start : start + PRIMES_A_TASK]
                found = polynomial_residues(matrix, some).tolist()
                yield pa.RecordBatch.from_pydict(
                    {"prime": pa.array(some, pa.int64()), "residues": pa.array(found, pa.list_(pa.int64()))}
                )

    return run


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient is larger: the k-th is a sum of products of k roots, which are not negative."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean**k for k in range(d + 1))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - matrix), lowest power first; primes are shared out to tasks."""
    bits = 2 * coefficient_bound(matrix)
    primes = primes_below(2**31, bits.bit_length() // 30 + 1)
    tasks = -(-len(primes) // PRIMES_A_TASK)
    frame = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    residues = frame.mapInArrow(_residue_task(matrix), "prime long, residues array<long>").collect()
    modulus, total = math.prod(primes), [0] * (len(matrix) + 1)
    for r in residues:
        other = modulus // r["prime"]
        unit = other * pow(other, -1, r["prime"])
        for k, value in enumerate(r["residues"]):
            total[k] += value * unit
    total = [t % modulus for t in total]
    return [t - modulus if 2 * t > modulus else t for t in total]


# Roots and components


def roots_above(polynomial: list[int], a: int) -> int:
    """How many roots are larger than ``a``: sign changes after moving the polynomial there."""
    c = polynomial[::-1]
    for end in range(len(c) - 1, 0, -1):
        for i in range(1, end + 1):
            c[i] += a * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_at(polynomial: list[int], a: int) -> int:
    out = 0
    for c in reversed(polynomial):
        out = out * a + c
    return out


def largest_roots(polynomial: list[int], trace: int, count: int) -> tuple[list[int], int]:
    """The largest roots, the largest first, as whole numbers times 2**-s, and s.

    Roots of zero are left out. Each number is the root rounded down, and s is raised until
    the smallest of them has ``ROOT_BITS``.
    """
    d = len(polynomial) - 1
    rank = d - next(k for k, c in enumerate(polynomial) if c)
    count, s = min(count, rank), max(0, 2 * ROOT_BITS - trace.bit_length())
    while count:
        scaled = [c << (s * (d - k)) for k, c in enumerate(polynomial)]
        found, top = [], (trace << s) + 1
        # Intervals (low, high] with the number of roots above each end, the highest on top.
        todo = [(0, top, rank, 0)]
        while todo and len(found) < count:
            low, high, above_low, above_high = todo.pop()
            inside = above_low - above_high
            if high - low == 1:  # the root lies in it; an exact root is its upper end
                found += [high if value_at(scaled, high) == 0 else low] * inside
                continue
            if inside == 1:
                sign = value_at(scaled, low) > 0
                if value_at(scaled, low) != 0:
                    while high - low > 1:
                        middle = (low + high) // 2
                        value = value_at(scaled, middle)
                        low, high = (middle, high) if value and (value > 0) == sign else (low, middle)
                    found.append(high if value_at(scaled, high) == 0 else low)
                    continue
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            if above_low > above:
                todo.append((low, middle, above_low, above))
            if above > above_high:
                todo.append((middle, high, above, above_high))
        found = found[:count]
        if found[-1].bit_length() >= ROOT_BITS:
            return found, s
        s += 2 * ROOT_BITS
    return [], s


def _eliminated(matrix: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Triangular factors in one array, with fractions of ``WORK_BITS``, and the order of rows."""
    a, d = matrix.copy(), len(matrix)
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            factors = (a[k + 1 :, k] << WORK_BITS) // a[k, k]
            a[k + 1 :, k + 1 :] -= (factors[:, None] * a[None, k, k + 1 :]) >> WORK_BITS
            a[k + 1 :, k] = factors
    return a, order


def _solved(a: np.ndarray, order: list[int], right: np.ndarray) -> np.ndarray:
    d = len(a)
    x = right[order]
    for k in range(d - 1):
        x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> WORK_BITS
    for k in range(d - 1, -1, -1):
        x[k] = (x[k] << WORK_BITS) // a[k, k]
        x[:k] -= (a[:k, k] * x[k]) >> WORK_BITS
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """The vector at length 2**WORK_BITS."""
    return (x << WORK_BITS) // max(1, math.isqrt(int((x * x).sum())))


def components(matrix: list[list[int]], roots: list[int], s: int) -> np.ndarray:
    """Unit vectors of the null spaces of matrix - root, one row for each root, as doubles."""
    d = len(matrix)
    exact = np.array(matrix, dtype=object).reshape(d, d) << s
    found: list[np.ndarray] = []
    for number, root in enumerate(roots):
        a, order = _eliminated(exact - np.diag(np.array([root] * d, dtype=object)))
        close = [found[k] for k in range(number) if roots[k] - root <= roots[k] >> (ROOT_BITS - 16)]
        # Any start that isn't orthogonal to the space will do.
        x = np.array([((i + 1) * (2 * number + 3) * 7919) % 1009 + 1 for i in range(d)], dtype=object) << WORK_BITS
        for _ in range(3):
            for other in close:
                x = x - ((int((x * other).sum()) * other) >> (2 * WORK_BITS))
            x = _unit(_solved(a, order, _unit(x)))
        for other in close:
            x = x - ((int((x * other).sum()) * other) >> (2 * WORK_BITS))
        x = _unit(x)
        x = -x if x[np.argmax(np.abs(x))] < 0 else x
        found.append(x)
    return np.array([[int(c) / (1 << WORK_BITS) for c in x] for x in found], dtype=np.float64).reshape(-1, d)


def spectrum(rows: DataFrame, count: int = COMPONENTS) -> Spectrum | None:
    """Sums and largest components of all rows (id, v); None without variance."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if width > MAX_DIMENSION:
        raise ValueError(f"vectors of {width} entries, {MAX_DIMENSION} at most")
    if not width:
        return None
    sums, square = exact_sums(rows, width)
    scatter = [[n * square[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace = sum(scatter[i][i] for i in range(width))
    if not trace:
        return None
    polynomial = characteristic_polynomial(rows.sparkSession, scatter)
    roots, s = largest_roots(polynomial, trace, count)
    return Spectrum(
        n, sums, components(scatter, roots, s), [r / (1 << s) for r in roots], [r / (trace << s) for r in roots]
    )


# Whitening


def deviations(y: np.ndarray, found: Spectrum) -> np.ndarray:
    """n * x - S, as long where that is surely enough and as Python numbers elsewhere."""
    largest = int(np.abs(y).max(initial=0)) * found.n + max(map(abs, found.sums))
    if largest < LONG:
        return y * found.n - np.array(found.sums, dtype=np.int64)
    return y.astype(object) * found.n - np.array(found.sums, dtype=object)


def squared_lengths(deviation: np.ndarray) -> list[int]:
    largest = int(np.abs(deviation).max(initial=0))
    if largest * largest * deviation.shape[1] >= LONG:
        deviation = deviation.astype(object)
    return (deviation * deviation).sum(axis=1).tolist()


def projected(deviation: np.ndarray, found: Spectrum) -> np.ndarray:
    return deviation.astype(np.float64) @ (found.vectors / np.sqrt(found.roots)[:, None]).T


def _gram_task(found: Spectrum):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found.roots)
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = projected(deviations(whole_numbers(batch.column("v"), len(found.sums)), found), found)
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array(np.arange(total.size), pa.int32()),
                "value": pa.array(total.ravel(), pa.float64()),
            }
        )

    return run


def identity_error(rows: DataFrame, found: Spectrum) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    partial = rows.select("v").mapInArrow(_gram_task(found), "cell int, value double")
    cells = {r["cell"]: r["value"] for r in partial.groupBy("cell").agg(F.sum("value").alias("value")).collect()}
    k = len(found.roots)
    total = np.array([cells[i] for i in range(k * (k + 1))]).reshape(k + 1, k) / found.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


WHITENED = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_decimal decimal(38,0)"
)


def _whiten_task(found: Spectrum, error: float, id_type: pa.DataType, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found.roots)
        for batch in batches:
            deviation = deviations(whole_numbers(batch.column("v"), len(found.sums)), found)
            rows = len(deviation)
            each = np.repeat(np.arange(rows), k)
            exact = squared_lengths(deviation)
            long = pa.array([v if v < LONG else None for v in exact], pa.int64())
            decimal = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: batch.column("id").take(pa.array(each)).cast(id_type),
                    "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    "n": pa.array(np.full(rows * k, found.n), pa.int64()),
                    "deviation": long.take(pa.array(each)),
                    "whitened": pa.array(projected(deviation, found).ravel(), pa.float64()),
                    "explained": pa.array(np.tile(found.explained, rows), pa.float64()),
                    "identity_error": pa.array(np.full(rows * k, error), pa.float64()),
                    "deviation_decimal": decimal.take(pa.array(each)),
                }
            )

    return run


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """A row for each vector that stays and each of its ``count`` largest components.

    ``whitened`` has mean 0, variance 1 and no correlation between components;
    ``identity_error`` says how far the rows are from that.
    """
    rows = usable(vectors.withColumn(id_col, F.col(id_col).cast("long")), id_col, vector_col)
    found = spectrum(rows, count)
    schema = f"`{id_col}` long, {WHITENED}"
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_whiten_task(found, identity_error(rows, found), pa.int64(), id_col), schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
