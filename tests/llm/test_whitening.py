import numpy as np
import pytest

from critica.llm.whitening import (Interval, Whitening, eigenvalues_below, exact_products, feast, fit_whitening,
                                   op11_embedding_whitening, spectrum_intervals, squared_deviations)

SF = "/root/testdata/sf0.001"


def whole(v, wanted):
    pairs = [feast(v, i) for i in spectrum_intervals(v, wanted)]
    return np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs], axis=1)


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        v = a + a.T
        values = np.linalg.eigvalsh(v)
        for shift in (-100.0, 100.0, 0.0, *(values[:-1] + values[1:]) / 2):
            assert eigenvalues_below(v, shift) == (values < shift).sum()
    assert eigenvalues_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # needs a 2 x 2 pivot
    assert eigenvalues_below(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("v", [
    np.eye(40) * 3, np.diag([5.0] * 30 + [0.0] * 10), np.diag(np.r_[np.full(20, 2.0), np.full(20, 2 + 1e-11)]),
    np.diag(2.0 ** -np.arange(40)), np.array([[2.0]])])
def test_feast_with_equal_close_and_falling_eigenvalues(v):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal(v.shape))[0]
    v = q @ v @ q.T
    v = (v + v.T) / 2
    values, vectors = whole(v, 12)
    expected = np.sort(np.linalg.eigvalsh(v))[::-1]
    assert len(values) >= min(12, len(v))
    assert np.allclose(np.sort(values)[::-1], expected[:len(values)], atol=1e-13 * expected[0], rtol=0)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-10 * expected[0]


def test_intervals_hold_every_wanted_eigenvalue_and_feast_finds_as_many():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((300, 60))
    v = a.T @ a / 300
    found = spectrum_intervals(v, 32)
    values = np.linalg.eigvalsh(v)
    for i in found:
        assert i.count == ((values > i.low) & (values < i.high)).sum()
    assert sum(i.count for i in found) >= 32 and len(found) > 3
    assert len(feast(v, found[0])[0]) == found[0].count


def test_exact_sums_and_deviations_beyond_floats():
    rng = np.random.default_rng(4)
    for top in (20, 2 ** 28, 2 ** 32):
        z = rng.integers(-top, top, (50, 3))
        expected = z.astype(object).T.dot(z.astype(object))
        assert (exact_products(z.astype(float)).astype(object) == expected).all()
        rest = [5, 0, 9]
        slow = [sum((10 * int(x) - r) ** 2 for x, r in zip(row, rest)) for row in z]
        assert squared_deviations(z, 10, rest) == [s if s < 2 ** 63 else None for s in slow]


def brute(vectors, k=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(k, int((values > 1e-12 * values[0]).sum()))
    return n, ((n * x - s) ** 2).sum(axis=1), y @ basis[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_query_equals_brute_force(spark):
    got = op11_embedding_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    n, deviation, white, explained = brute(np.stack(table["embedding"].to_numpy()))
    assert len(got) == n * 32 and (got["n"] == n).all()
    w = got["whitened"].to_numpy().reshape(n, 32)
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < 1e-8
    assert (got["deviation"].to_numpy().reshape(n, 32) == deviation[:, None]).all()
    assert np.abs(got["explained"].to_numpy().reshape(n, 32) / explained - 1).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    good = [[float(x) for x in row] for row in rng.standard_normal((40, 3))]
    rows = [(i, e, "x", 1.0) for i, e in enumerate(good)]
    rows += [rows[0], rows[0], (None, good[1], "x", 1.0)]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    df = spark.createDataFrame(rows + [(100 + i, e, "x", 1.0) for i, e in enumerate(bad)],
                               "vec_id long, embedding array<double>, whitened string, deviation double")
    fitted = fit_whitening(df)
    n, deviation, white, explained = brute([r[1] for r in rows])
    assert fitted.n == n == 43 and np.allclose(fitted.explained, explained)
    got = fitted.transform(df)
    assert got.columns == ["vec_id", "embedding", "whitened", "deviation", "whitened_", "deviation_"]
    got = got.collect()
    assert sorted(r.deviation_ for r in got) == sorted(deviation.tolist()) and len(got) == 43
    assert sorted(r.vec_id for r in got if r.vec_id is not None) == sorted(r[0] for r in rows if r[0] is not None)


def test_empty_and_constant_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        df = spark.createDataFrame(rows, schema)
        fitted = fit_whitening(df)
        assert fitted.explained == [] and fitted.transform(df).count() == 0
    line = spark.createDataFrame([(i, [float(i), float(2 * i)]) for i in range(5)], schema)  # rank one
    assert len(fit_whitening(line).explained) == 1


def test_split_over_partitions_changes_nothing(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, many = fit_whitening(df.coalesce(1)), fit_whitening(df.repartition(7))
    assert one.sums == many.sums and (one.values == many.values).all() and (one.vectors == many.vectors).all()
    assert isinstance(one, Whitening) and Interval(0, 1, 2).count == 2
