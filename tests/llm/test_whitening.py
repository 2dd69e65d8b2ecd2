from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from agentlake.llm.queries import QUERIES
from agentlake.llm.whitening import SHIFT, eigenvectors, fit_whitening, identity_error, whiten

L = np.longdouble


def vectors_of(spark, vectors):
    return spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def spectrum(values, seed=1):
    size = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(L)
    for _ in range(4):
        q = q @ (1.5 * np.eye(size, dtype=L) - 0.5 * (q.T @ q))
    return (q * np.array(values, L)) @ q.T, q[:, np.argsort(-np.array(values, L), kind="stable")]


SPECTRA = [
    ([5, 4, 3, 2, 1], 1e-17), (np.linspace(1, 2, 64), 1e-15), (np.logspace(-9, 0, 30), 1e-9),
    ([1 + 1e-8, 1, 1 - 1e-8, 0.5, 0.1], 1e-9), (list(1 + 1e-10 * np.arange(6)) + [0.5, 1e-6], 1e-7),
    ([1.0] * 7, None), ([2, 1, 1, 1, 0.5, 0, 0], None), ([0.0] * 3, None),
]


@pytest.mark.parametrize(("values", "most"), SPECTRA)
def test_eigenvectors_are_right_beyond_double_precision(values, most):
    matrix, exact = spectrum(values)
    found, x = eigenvectors(matrix)
    assert np.abs(found - np.sort(np.array(values, L))[::-1]).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17 and np.abs(matrix @ x - x * found).max() < 1e-17
    if most:
        assert np.abs(np.abs((exact.T @ x).astype(float)) - np.eye(len(values))).max() < most


def test_correction_beats_its_start():
    matrix, exact = spectrum(np.linspace(1, 1.01, 40))
    single = np.linalg.eigh(matrix.astype(np.float32))[1][:, ::-1].astype(float)
    error = lambda x: np.abs(np.abs(exact.T.astype(float) @ x) - np.eye(40)).max()
    assert error(single) > 1e-5 and error(eigenvectors(matrix)[1].astype(float)) < 1e-14


def plain(vectors, components):
    """From exact fractions: n, deviations, eigenvalues, whitened components up to sign."""
    x = [[int(np.floor(1024 * float(c))) + SHIFT for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = [[n * c - s for c, s in zip(v, sums)] for v in x]
    size = len(sums)
    cov = np.array([[float(Fraction(sum(v[i] * v[j] for v in centred), n**3)) for j in range(size)] for i in range(size)])
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    made = np.array(centred, float) / n @ basis[:, order] / np.sqrt(values[order])
    return n, [sum(c * c for c in v) for v in centred], values[order] / np.trace(cov), made


def test_equals_plain_numbers(spark):
    r = np.random.default_rng(5)
    good = (r.normal(size=(700, 6)) * [3, 2, 1.5, 1, 0.2, 0.1]).tolist()
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    df = vectors_of(spark, good[:300] + odd + good[300:]).repartition(7).selectExpr("*", "1 AS Deviation", "vec_id AS whitened")
    model = fit_whitening(df)
    n, deviations, explained, made = plain(good, 4)
    assert model.n == n and np.allclose(model.explained(4), explained, rtol=1e-12)
    rows = whiten(df, model, 4)
    assert rows.columns == ["vec_id", "embedding", "whitened", "deviation"]
    got = {r.vec_id: r for r in rows.collect()}
    assert sorted(got) == [k for k in range(706) if not 300 <= k < 306]
    got = [got[k] for k in sorted(got)]
    assert [int(r.deviation) for r in got] == deviations
    own = np.array([r.whitened for r in got])
    assert np.abs(own * np.sign((own * made).sum(axis=0)) - made).max() < 1e-11
    assert identity_error(rows) < 1e-12


def test_constant_repeated_and_huge_entries(spark):
    df = vectors_of(spark, [[1.0, 2.0, 5.0], [2.0, 4.0, 5.0], [2.0, 4.0, 5.0], [1.0, 2.0, 5.0]])
    model = fit_whitening(df)
    assert model.rank() == 1 and model.explained(3)[0] == 1.0
    got = whiten(df, model, 8).orderBy("vec_id").collect()
    assert [[abs(x) if x is not None else None for x in r.whitened] for r in got] == [[pytest.approx(1.0), None, None]] * 4
    assert identity_error(whiten(df, model)) < 1e-12
    alone = vectors_of(spark, [[3.0, 4.0]])
    assert [(r.whitened, int(r.deviation)) for r in whiten(alone, fit_whitening(alone)).collect()] == [([None, None], 0)]
    huge = vectors_of(spark, [[1e300, 0.0], [-1e300, 0.0], [0.0, 1.0], [0.0, -1.0]])
    rows = whiten(huge, fit_whitening(huge))
    assert identity_error(rows) < 1e-9 and rows.where("vec_id = 0").first().deviation == (4 * 1024 * 2**30) ** 2


def test_single_precision_entries_and_empty_tables(spark):
    df = vectors_of(spark, np.random.default_rng(0).normal(size=(50, 3)).tolist())
    single = df.select("vec_id", F.col("embedding").cast("array<float>"))
    assert fit_whitening(single).sums == fit_whitening(single.select("vec_id", F.col("embedding").cast("array<double>"))).sums
    for empty in (df.limit(0), vectors_of(spark, [None, []])):
        assert fit_whitening(empty) is None
        assert whiten(empty, None).collect() == [] and identity_error(whiten(empty, None)) is None


def test_query(spark):
    rows = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    data = rows.toPandas()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("embedding IS NOT NULL").orderBy("vec_id").toPandas()
    n, deviations, explained, made = plain(table.embedding.tolist(), 8)
    assert len(data) == 8 * n and data.identity_error.max() < 1e-12 and set(data.n) == {n}
    for k in range(8):
        own = data[data.component == k + 1].sort_values("vec_id")
        assert own.deviation.tolist() == deviations and np.allclose(own.explained, explained[k], rtol=1e-10)
        w = own.whitened.to_numpy()
        assert np.abs(w * np.sign(w @ made[:, k]) - made[:, k]).max() < 1e-7


def test_query_without_usable_vectors(spark, tmp_path):
    for k, vectors in enumerate(([], [None, [], [None, 1.0]])):
        folder = str(tmp_path / str(k))
        spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        rows = QUERIES["op13_whitening"](spark, folder)
        assert rows.collect() == [] and dict(rows.dtypes)["explained"] == dict(rows.dtypes)["whitened"] == "double"
