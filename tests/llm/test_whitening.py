import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF

from tidewatch.llm import whitening
from tidewatch.llm.whitening import Covariance, fit, op11_whitening, sums, whole_vectors, whitened_rows


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain(x, k):
    """Eigenvectors of the covariance as numpy finds them."""
    centred = x - x.mean(0)
    cov = centred.T @ centred / len(x)
    values, turn = np.linalg.eigh(cov)
    return cov, values[::-1][:k], turn[:, ::-1][:, :k]


def test_query_against_a_dense_decomposition(spark):
    stored = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in stored], float)).astype(np.int64) + 1_000_000
    cov, values, turn = plain(x, 32)
    rows = op11_whitening(spark, SF).orderBy("vec_id", "component").toPandas()
    assert len(rows) == 32 * len(x) and set(rows["n"]) == {len(x)}
    assert rows["deviation"].to_list()[::32] == np.square(len(x) * x - x.sum(0)).sum(1).tolist()
    got = rows["whitened"].to_numpy().reshape(-1, 32)
    want = (x - x.sum(0) / len(x)) @ turn / np.sqrt(values)
    np.testing.assert_allclose(got * np.sign((got * want).sum(0)), want, atol=1e-8)
    np.testing.assert_allclose(rows["explained"].to_numpy()[:32], values / np.trace(cov), rtol=1e-9)
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-10


@pytest.mark.parametrize("spectrum", [[1.0] * 20, [50.0, 9.0, 9.0, 9.0] + [1.0] * 16, [2.0**-i for i in range(20)]])
def test_filter_finds_the_leading_components(spark, spectrum):
    draw = np.random.default_rng(3)
    x = np.rint(draw.standard_normal((400, 20)) * np.sqrt(spectrum) * 300 + 10**9).astype(np.int64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, x array<long>").repartition(3)
    basis = fit(df, 4)
    cov, values, turn = plain(x - 10**9, 4)
    np.testing.assert_allclose(basis.values, values, rtol=1e-9)
    assert np.abs(cov @ basis.components - basis.components * basis.values).max() <= 1e-9 * values[0]
    assert basis.passes > 2


def test_polynomial_is_that_of_the_recurrence(spark):
    """Scaled Chebyshev values on the spectrum, at one pass a degree."""
    x = np.diag([6, 5, 4, 3, 2]).repeat(2, axis=0) * np.array([[1], [-1]] * 5) * 10
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, x array<long>")
    v = Covariance(df, sums(df))
    spectrum = np.square([60, 50, 40, 30, 20]) / 5
    out = whitening.filtered(v, np.eye(5), 80.0, 400.0, 720.0, 6)
    cheb = lambda t: np.polynomial.chebyshev.chebval((t - 240) / 160, [0] * 6 + [1])
    np.testing.assert_allclose(np.diag(out), cheb(spectrum) / cheb(720.0), atol=1e-12)
    assert v.passes == 6


def test_odd_rows(spark):
    df = vectors(
        spark,
        [
            (1, [1.0, 2.0], 0), (2, [3.0, -1.0], None), (2, [3.0, -1.0], 1), (None, [0.0, 0.5], 1),
            (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, [], 1), (8, [1.0, 2.0, 3.0], 1), (9, [1e30, 1.0], 1),
        ],
    )
    df = df.select("*", F.lit("?").alias("x"), F.lit("?").alias("n"), F.lit("?").alias("whitened"))
    rows = whitened_rows(df, "vec_id", "embedding").collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 2), *[(2, 1)] * 2, *[(2, 2)] * 2]
    assert {r["n"] for r in rows} == {4} and sum(r["explained"] for r in rows) == pytest.approx(4)


def test_flat_components_and_none(spark):
    same = vectors(spark, [(i, [1.0, 2.0], 0) for i in range(5)])
    rows = whitened_rows(same, "vec_id", "embedding").collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in rows} == {(0.0, None, 0.0, 0)}
    line = vectors(spark, [(i, [float(i), 2.0 * i], 0) for i in range(5)])
    rows = whitened_rows(line, "vec_id", "embedding").collect()
    assert {r["whitened"] for r in rows if r["component"] == 2} == {0.0}
    assert max(r["identity_error"] for r in rows) < 1e-10
    empty = whitened_rows(same.limit(0), "vec_id", "embedding")
    assert empty.count() == 0 and empty.columns == whitened_rows(line, "vec_id", "embedding").columns


def test_sums_and_deviations_are_exact_beyond_doubles(spark):
    big = (1 << 52) + 1
    df = spark.createDataFrame([(i, [big + i, -i]) for i in range(7)], "vec_id long, x array<long>")
    of = sums(df)
    assert of.sums == (7 * big + 21, -21)
    out = {r["vec_id"]: r["deviation"] for r in whitening.whitened(df, "vec_id", fit(df)).collect()}
    assert out == {i: 2 * (7 * i - 21) ** 2 for i in range(7)}
    wide = spark.createDataFrame([(0, [0]), (1, [big])], "vec_id long, x array<long>")
    assert {r["deviation"] for r in whitening.whitened(wide, "vec_id", fit(wide)).collect()} == {None}


def test_components_keep_their_rows(spark):
    df = whole_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding")
    a, b = fit(df, 5), fit(df.repartition(7), 5)
    np.testing.assert_allclose(np.abs((a.components * b.components).sum(0)), 1, atol=1e-9)
