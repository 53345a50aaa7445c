"""Operator 11: embedding whitening by FEAST contour integration.

1. Entries become integers x = floor(64 * c) + 1,000,000. Spark sums them, and then the products of the entries less the
   integer part of their mean. Both are exact integers, so the covariance does not depend on how rows are dealt to tasks
   and no digit is lost to the large offset.
2. The spectrum of the covariance V is cut into intervals with a few eigenvalues each. How many lie below a cut is the
   inertia of V - cut * I, read from the signs of its block LDL^T factor; cuts keep clear of eigenvalues.
3. Every interval is a Spark task of its own: the quadrature of complex shifted solves (z I - V)^-1 Y over a half circle
   around the interval projects a block onto its eigenvectors, Rayleigh-Ritz extracts them, and this goes on until the
   residuals are at rounding level and as many values lie inside as the inertia says, so none is missed. A block that
   does not get there is widened, at most to the whole space, where one Rayleigh-Ritz step is exact.
4. The leading components whiten every row in Arrow batches; the covariance of the whitened rows is summed once more to
   report its distance from the identity.

Only sums over the entries of a vector reach the driver: d and d * d numbers, whatever the number of rows. ``MAX_DIM``
bounds d and with it what is broadcast.

Defined results: vectors that are null or hold a null, infinite or NaN entry are dropped, as are those with an entry
beyond 2^33 (their squares would not sum exactly) and those whose length is not the most common one (ties: the longer);
repeated rows count as often as they occur; a null id passes through; equal eigenvalues get an orthonormal basis of their
space; eigenvalues that are zero to rounding have no component, so there are fewer rows; equal vectors only, or none,
give an empty result; a deviation beyond a long is null; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critica.llm.common import free_name, read

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LIMIT = 1 << 33  # of entries
MAX_DIM = 4096
NODES = 8  # quadrature nodes on the upper half circle
PER_INTERVAL = 8  # eigenvalues an interval should hold
ZERO = 1e-12  # eigenvalues below this share of the largest count as zero


# --- exact sums ----------------------------------------------------------------------------------------------------

def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows of ``df`` whose vector can be used; all have the most common length."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)
    vector = F.col(vector_col).cast("array<double>")
    rows = df.where(F.col(vector_col).isNotNull()).where(F.forall(vector, entry) & (F.size(vector) > 0))
    lengths = rows.groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return rows
    if top.d > MAX_DIM:
        raise ValueError(f"vectors of {top.d} entries; MAX_DIM is {MAX_DIM}")
    return rows.where(F.size(vector_col) == top.d)


def entries(column, rows: int = 1024):
    """Blocks (start, integers x - OFFSET as float64) of an Arrow column of lists without nulls, all of one length."""
    import numpy as np

    for a in range(0, len(column), rows):
        part = column.slice(a, rows)
        values = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield a, np.floor(values * SCALE).reshape(len(part), -1)


def _cells(names, arrays):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names)


def entry_sums(rows: DataFrame, vector_col: str):
    """(n, [sum of x - OFFSET per dimension]) as exact integers."""
    def run(batches):
        import numpy as np

        n, total = 0, 0
        for batch in batches:
            for _, x in entries(batch.column(0)):
                n += len(x)
                total = total + x.astype(np.int64).sum(axis=0)
        if n:
            yield _cells(["i", "n", "s"], [np.arange(len(total)), np.full(len(total), n), total])

    cells = rows.select(vector_col).mapInArrow(run, "i bigint, n bigint, s bigint")
    found = (cells.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
             .orderBy("i").collect())
    return (int(found[0].n), [int(r.s) for r in found]) if found else (0, [])


def exact_products(z):
    """Integers sum_k z[k, i] * z[k, j] of a block of integers in float64: as int64, or as Python integers."""
    import numpy as np

    top = np.abs(z).max(initial=0.0)
    if len(z) * top * top < 2.0 ** 53:
        return (z.T @ z).astype(np.int64)  # every partial sum is an integer that float64 holds
    whole = z.astype(np.int64)
    if len(z) * int(top) ** 2 < 1 << 63:
        return whole.T @ whole
    whole = whole.astype(object)
    return whole.T.dot(whole)


def entry_products(rows: DataFrame, vector_col: str, shift):
    """{(i, j): sum of z_i z_j} for i <= j with z = x - OFFSET - shift, as exact integers."""
    def run(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        back = np.array(shift, np.float64)
        i, j = np.triu_indices(len(back))
        total = None
        for batch in batches:
            for _, x in entries(batch.column(0)):
                made = exact_products(x - back)[i, j]
                if total is not None and made.dtype != object and total.dtype != object:
                    total = made + total if max(np.abs(made).max(), np.abs(total).max()) < 1 << 61 else made.astype(object) + total
                else:
                    total = made if total is None else made.astype(object) + total
        if total is not None:
            for a in range(0, len(i), 65_536):
                cut = slice(a, a + 65_536)
                yield pa.RecordBatch.from_arrays([pa.array(i[cut] * len(back) + j[cut], pa.int64()), pa.array(
                    [Decimal(int(v)) for v in total[cut]], pa.decimal128(38, 0))], ["cell", "s"])

    cells = rows.select(vector_col).mapInArrow(run, "cell bigint, s decimal(38,0)")
    found = cells.groupBy("cell").agg(F.sum("s").alias("s")).collect()
    return {divmod(r.cell, len(shift)): int(r.s) for r in found}


# --- eigenvalues by contour integration ----------------------------------------------------------------------------

def eigenvalues_below(v, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``v`` below ``shift``: the negative signs of a block LDL^T factor of
    v - shift * I (symmetric complete pivoting with 1 x 1 and 2 x 2 blocks), by Sylvester's law of inertia."""
    import numpy as np

    a = v - shift * np.eye(len(v))
    alpha = (1 + 17 ** 0.5) / 8
    below = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        q, r = divmod(int(off.argmax()), len(a))
        if diagonal[p] >= alpha * off[q, r]:
            if diagonal[p] == 0:
                return below  # the rest is zero
            order = [p] + [k for k in range(len(a)) if k != p]
            below += a[p, p] < 0
            a = a[np.ix_(order, order)]
            a = a[1:, 1:] - np.outer(a[1:, 0], a[0, 1:] / a[0, 0])
        else:
            order = [q, r] + [k for k in range(len(a)) if k not in (q, r)]
            a = a[np.ix_(order, order)]
            below += 1  # an indefinite 2 x 2 block has one eigenvalue of each sign
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(below)


@dataclass
class Interval:
    low: float
    high: float
    count: int  # eigenvalues inside, by inertia


def spectrum_intervals(v, wanted: int, per_interval: int = PER_INTERVAL) -> list[Interval]:
    """Disjoint intervals that hold the ``wanted`` largest eigenvalues of ``v``, highest first; cuts lie in gaps."""
    import numpy as np

    d = len(v)
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9) or 1.0  # Gershgorin bound
    margin = 1e-9 * top

    def clear_cut(low, high):
        """A cut inside (low, high) that no eigenvalue is close to, and the number below it; None if there is none."""
        for share in (0.5, 0.42, 0.58, 0.34, 0.66, 0.25, 0.75):
            at = low + share * (high - low)
            n = eigenvalues_below(v, at - margin)
            if n == eigenvalues_below(v, at + margin):
                return at, n
        return None

    found, todo = [], [(-top, top, 0, d)]
    above = 0
    while todo and above < wanted:
        low, high, n_low, n_high = todo.pop()
        if n_high == n_low:
            continue
        cut = clear_cut(low, high) if n_high - n_low > per_interval and high - low > 64 * margin else None
        if cut is None:
            found.append(Interval(low, high, n_high - n_low))
            above += n_high - n_low
            continue
        todo += [(low, cut[0], n_low, cut[1]), (cut[0], high, cut[1], n_high)]  # the upper part is taken first
    return found


def feast(v, interval: Interval, nodes: int = NODES, seed: int = 11, rounds: int = 24):
    """(eigenvalues, eigenvectors as columns) of ``v`` inside the interval, as many as it counts."""
    import numpy as np

    d = len(v)
    scale = max(float(np.abs(v).max()), 1e-300)
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = -np.pi / 2 * (points - 1)
    shifts = centre + radius * np.exp(1j * angles)
    block = min(d, interval.count + max(4, interval.count // 2))
    rng = np.random.default_rng(seed)
    while True:
        y = np.linalg.qr(rng.standard_normal((d, block)))[0]
        last = np.inf
        for _ in range(rounds):
            if block < d:
                q = np.zeros((d, block))
                for z, w, angle in zip(shifts, weights, angles):
                    solved = np.linalg.solve(z * np.eye(d) - v, y.astype(complex))
                    q += w / 2 * (radius * np.exp(1j * angle) * solved).real
                y = np.linalg.qr(q)[0]
            values, mix = np.linalg.eigh(y.T @ v @ y)
            y = y @ mix
            inside = (values > interval.low) & (values < interval.high)
            residual = np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max(initial=0.0)
            if block == d and int(inside.sum()) != interval.count:  # a value on the border by rounding: nearest ones
                inside = np.zeros(d, bool)
                inside[np.argsort(np.maximum(interval.low - values, values - interval.high))[:interval.count]] = True
            if int(inside.sum()) == interval.count and residual <= 1e-14 * scale * d:
                return values[inside], y[:, inside]
            if int(inside.sum()) == interval.count and residual >= last / 2 and (residual <= 1e-11 * scale * d or block == d):
                return values[inside], y[:, inside]  # no further progress: rounding level
            last = residual
        block = min(d, 2 * block)


def leading_eigenpairs(spark: SparkSession, v, wanted: int):
    """(values, vectors as columns), highest first: one Spark task per interval, then one Rayleigh-Ritz step over all."""
    import numpy as np

    intervals = spectrum_intervals(v, wanted)
    if not intervals:
        return np.zeros(0), np.zeros((len(v), 0))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for low, high, count in zip(*(batch.column(k).to_pylist() for k in range(3))):
                values, vectors = feast(v, Interval(low, high, count))
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))],
                                                 ["value", "vector"])

    rows = spark.createDataFrame([(x.low, x.high, x.count) for x in intervals], "low double, high double, count int")
    pairs = rows.repartition(len(intervals)).mapInArrow(run, "value double, vector array<double>").collect()
    basis = np.linalg.qr(np.array([r.vector for r in sorted(pairs, key=lambda r: -r.value)]).T)[0]
    values, mix = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values)[:wanted]
    return values[order], (basis @ mix)[:, order]


# --- the operator --------------------------------------------------------------------------------------------------

@dataclass
class Whitening:
    """Fitted whitening: counts, exact means, components by falling eigenvalue and the check over the fitted rows."""

    vector_col: str
    n: int = 0
    sums: list[int] = field(default_factory=list)  # of x - OFFSET
    shift: list[int] = field(default_factory=list)  # integer part of the mean of x - OFFSET
    values: object = None  # eigenvalues
    vectors: object = None  # components as columns
    explained: list[float] = field(default_factory=list)
    identity_error: float = 0.0

    def projection(self):
        """(fractional means, matrix) such that whitened = (z - fractions) @ matrix for z = x - OFFSET - shift."""
        import numpy as np

        fractions = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, self.shift)])
        return fractions, self.vectors / np.sqrt(self.values)

    def transform(self, df: DataFrame, out: str = "whitened", deviation: str = "deviation") -> DataFrame:
        """The usable rows of ``df`` with the whitened vector and the exact squared deviation added as last columns;
        a name that ``df`` has already gets underscores."""
        rows = usable(df, self.vector_col)
        names = [free_name(df, out), free_name(df, deviation)]
        if not self.explained:
            return rows.where(F.lit(False)).select("*", F.lit(None).cast("array<double>").alias(names[0]),
                                                   F.lit(None).cast("bigint").alias(names[1]))
        fractions, matrix = self.projection()
        shift, n = self.shift, self.n
        rest = [s - n * m for s, m in zip(self.sums, self.shift)]
        at = df.columns.index(self.vector_col)

        def run(batches):
            import numpy as np
            import pyarrow as pa

            back = np.array(shift, np.float64)
            for whole in batches:
                for a in range(0, len(whole), 2048):
                    batch = whole.slice(a, 2048)
                    w, dev = [], []
                    for _, x in entries(batch.column(at)):
                        z = x - back
                        w.append((z - fractions) @ matrix)
                        dev += squared_deviations(z.astype(np.int64), n, rest)
                    flat = np.concatenate(w) if w else np.zeros((0, matrix.shape[1]))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()),
                                                     pa.array(flat.ravel()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(dev, pa.int64())],
                                                     [*batch.schema.names, *names])

        wide = T.StructType([*df.schema.fields, T.StructField(names[0], T.ArrayType(T.DoubleType())),
                             T.StructField(names[1], T.LongType())])
        return rows.mapInArrow(run, wide)


def squared_deviations(z, n: int, rest: list[int]) -> list:
    """sum over dimensions of (n * z - rest)^2 per row, exact; None where it exceeds a long."""
    import numpy as np

    bound = n * (int(np.abs(z).max(initial=0)) + 1)
    if z.shape[1] * bound * bound < 1 << 63:
        y = n * z - np.array(rest, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * z.astype(object) - np.array(rest, object)
    return [int(s) if s < 1 << 63 else None for s in (y * y).sum(axis=1)]


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening over all usable rows of ``df``."""
    import numpy as np

    fitted = Whitening(vector_col)
    rows = usable(df, vector_col)
    fitted.n, fitted.sums = entry_sums(rows, vector_col)
    n, d = fitted.n, len(fitted.sums)
    if not n:
        return fitted
    fitted.shift = [s // n for s in fitted.sums]
    rest = [s - n * m for s, m in zip(fitted.sums, fitted.shift)]
    v = np.zeros((d, d))
    for (i, j), s in entry_products(rows, vector_col, fitted.shift).items():
        v[i, j] = v[j, i] = (n * s - rest[i] * rest[j]) / (n * n)  # Python integers: one rounding
    trace = float(np.trace(v))
    if trace <= 0:
        return fitted
    values, vectors = leading_eigenpairs(df.sparkSession, v, min(components, d))
    live = values > ZERO * values[0]
    fitted.values, fitted.vectors = values[live], vectors[:, live]
    fitted.explained = (fitted.values / trace).tolist()
    fitted.identity_error = whitened_identity_error(fitted, rows)
    return fitted


def whitened_identity_error(fitted: Whitening, rows: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, summed over all of them."""
    import numpy as np

    fractions, matrix = fitted.projection()
    shift, k = fitted.shift, matrix.shape[1]

    def run(batches):
        import pyarrow as pa

        back = np.array(shift, np.float64)
        first, second = np.zeros(k), np.zeros((k, k))
        n = 0
        for batch in batches:
            for _, x in entries(batch.column(0)):
                w = (x - back - fractions) @ matrix
                n += len(w)
                first += w.sum(axis=0)
                second += w.T @ w
        if n:
            cells = np.concatenate([first, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int64()), pa.array(cells)], ["cell", "s"])

    found = rows.select(fitted.vector_col).mapInArrow(run, "cell bigint, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    cells = np.zeros(k + k * k)
    for r in found.collect():
        cells[r.cell] = r.s
    mean = cells[:k] / fitted.n  # zero but for rounding, as rows were centred before
    return float(np.abs(cells[k:].reshape(k, k) / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = fit_whitening(table)
    rows = fitted.transform(table)
    explained = F.array(*[F.lit(e) for e in fitted.explained]).cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(fitted.n).cast("bigint").alias("n"), "deviation",
                    "whitened", explained[F.col("k")].alias("explained"), F.lit(fitted.identity_error).alias("identity_error")))
