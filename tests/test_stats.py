"""Statistics against NumPy, with degenerate and skewed input."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.operators.distribution import column_spread, deviation_spread, histogram, kernel_density
from gaugeworks.operators.features import category_index, coerce_and_drop, group_deviation, group_profile, one_hot, one_hot_sparse
from gaugeworks.operators.quantiles import box_summary, group_quantiles
from gaugeworks.operators.stats import correlation, group_mean, top_groups
from gaugeworks.session import setting
from tests.test_plans import plan


def values(spark, numbers, group=1):
    return spark.createDataFrame([(group, None if n is None else float(n)) for n in numbers], "g int, v double")


@pytest.fixture(scope="module")
def skewed():
    random = np.random.default_rng(7)
    heavy = np.concatenate([np.full(700, 3.25), random.normal(0, 1, 900), [1e300, -1e300], random.exponential(9, 400)])
    return {1: heavy, 2: random.integers(0, 4, 1000).astype(float), 3: np.array([5.0]), 4: np.array([1.0, 2.0])}


@pytest.mark.parametrize(("cells", "limit"), [(4096, 500_000), (4, 10), (2, 1), (64, 40)])
def test_quantiles_equal_numpy(spark, skewed, cells, limit):
    rows = spark.createDataFrame([(g, float(v)) for g, vs in skewed.items() for v in vs], "g int, v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = group_quantiles(rows.repartition(4), "g", "v", wanted, cells=cells, rank_limit=limit).collect()
    assert len(got) == 4 * len(wanted)
    for row in got:
        assert row.quantile == pytest.approx(np.quantile(skewed[row.g], row.probability), rel=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_quantiles_of_any_numbers(spark, numbers):
    rows = values(spark, numbers)
    for cells, limit in ((4096, 500_000), (3, 2)):
        got = {r.probability: r.quantile for r in group_quantiles(rows, "g", "v", [0.25, 0.5], cells, limit).collect()}
        for p, quantile in got.items():
            want = float(np.quantile(np.array(numbers, dtype=float), p))
            assert math.isclose(quantile, want, rel_tol=1e-9, abs_tol=1e-30 + 1e-9 * max(map(abs, numbers)))


@pytest.mark.parametrize(
    "numbers",
    [
        [0.0, 5e-324] * 20,
        [1.7976931348623157e308, math.inf] * 20,
        [-math.inf, -1.0, 0.0, 5e-324, 1e-323, math.inf] * 6,
        [s * 10.0**e for e in range(-100, 101, 5) for s in (1, -1)],
        [1.0 + k * 2.0**-52 for k in range(60)],
    ],
)
def test_quantiles_end_for_every_double(spark, numbers, monkeypatch):
    from gaugeworks.operators import quantiles

    rounds = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    found = group_quantiles(values(spark, numbers), "g", "v", [0.0, 0.3, 1.0], cells=8, rank_limit=3).collect()
    assert len(rounds) <= 20
    ordered = sorted(numbers)
    for row in found:
        position = row.probability * (len(ordered) - 1)
        low, high = ordered[math.floor(position)], ordered[min(math.floor(position) + 1, len(ordered) - 1)]
        assert low <= row.quantile <= high


def test_numbers_that_are_none(spark):
    rows = spark.createDataFrame([("a", 2.0), ("a", float("nan")), ("b", float("nan")), ("a", 4.0)], "g string, v double")
    assert {r.g: r.mean_value for r in group_mean(rows, "g", "v").collect()} == {"a": 3.0, "b": None}
    profile = group_profile(rows, "g", "v")
    assert [(r.g, r.group_mean, r.group_max, r.group_count) for r in profile.collect()] == [("a", 3.0, 4.0, 2)]
    spread = deviation_spread(profile)
    assert (spread.low, spread.high, spread.count) == (-1.0, 1.0, 2)


def test_quantiles_without_rows(spark):
    assert group_quantiles(values(spark, [None, float("nan")]), "g", "v", [0.5]).count() == 0


def test_box_summary(spark):
    row = box_summary(values(spark, [1, 2, 3, 4, 5, 100, None]), "g", "v").first()
    q1, median, q3 = np.quantile([1, 2, 3, 4, 5, 100], [0.25, 0.5, 0.75])
    assert (row.q1, row.median, row.q3, row.n) == (q1, median, q3, 6)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1, 5, 1)


def test_correlation(spark):
    random = np.random.default_rng(3)
    x, y = random.integers(1, 5, 500).astype(float), random.normal(1e6, 1, 500)
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "x double, y double")
    rows = rows.unionByName(spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 2.0)], rows.schema))
    assert correlation(rows, "x", "y").first()[0] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


@pytest.mark.parametrize("numbers", [[], [2.0], [2.0, 2.0, 2.0]])
def test_correlation_degenerate(spark, numbers):
    rows = spark.createDataFrame([(n, float(i)) for i, n in enumerate(numbers)], "x double, y double")
    assert [r[0] for r in correlation(rows, "x", "y").collect()] == [None]


def test_group_mean_top_and_deviation(spark):
    rows = spark.createDataFrame(
        [("b", 1.0), ("b", 3.0), ("a", 2.0), (None, 9.0), ("c", None)], "geo_place_name string, data_value double"
    )
    assert {r.geo_place_name: r.mean_value for r in group_mean(rows).collect()} == {"a": 2.0, "b": 2.0, "c": None}
    assert [r.geo_place_name for r in top_groups(rows, top=2).collect()] == ["a", "b"]
    got = group_deviation(rows).collect()
    assert sorted(r.pollution_deviation for r in got if r.pollution_deviation is not None) == [-1.0, 0.0, 1.0]
    assert len(got) == 5
    sums = group_deviation(rows).groupBy("geo_place_name").agg(F.sum("pollution_deviation").alias("s")).collect()
    assert all(abs(r.s or 0.0) < 1e-9 for r in sums)


def test_deviation_spread_equals_row_by_row(spark):
    random = np.random.default_rng(1)
    rows = spark.createDataFrame(
        [(int(g), float(v)) for g, v in zip(random.integers(0, 9, 800), random.normal(50, 9, 800), strict=True)],
        "g int, v double",
    )
    profile = group_profile(rows, "g", "v")
    deviations = group_deviation(rows, "g", "v", "m", "d", profile)
    short, long = deviation_spread(profile), column_spread(deviations, "d")
    assert (short.low, short.high, short.count) == (long.low, long.high, long.count)
    assert short.deviation == pytest.approx(long.deviation, rel=1e-12)


def test_histogram_equals_numpy(spark):
    numbers = np.random.default_rng(2).normal(0, 3, 2000)
    counts, edges = np.histogram(numbers, bins=50)
    got = histogram(values(spark, [*numbers, None, float("nan")]), "v").orderBy("bin").collect()
    assert [r.bin_count for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.bin_end for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_degenerate(spark):
    got = histogram(values(spark, [4.0, 4.0]), "v").filter("bin_count > 0").collect()
    assert [(r.bin, r.bin_count) for r in got] == [(25, 2)]
    assert histogram(values(spark, [None]), "v").count() == 0


def _density(numbers, points=200, bins=50):
    numbers = np.asarray(numbers)
    h = numbers.std(ddof=1) * len(numbers) ** -0.2
    grid = np.linspace(numbers.min(), numbers.max(), points)
    kernel = np.exp(-0.5 * ((grid[:, None] - numbers[None, :]) / h) ** 2)
    return kernel.sum(axis=1) / (h * np.sqrt(2 * np.pi)) * (numbers.max() - numbers.min()) / bins


@pytest.mark.parametrize("tail", [[], [1e5], [1e9]])
def test_density(spark, tail):
    numbers = [*np.random.default_rng(4).normal(0, 1, 300), *tail]
    got = [r.density for r in kernel_density(values(spark, numbers), "v", resolution=None).orderBy("point").collect()]
    assert len(got) == 200
    assert got == pytest.approx(_density(numbers).tolist(), rel=1e-9, abs=1e-300)


SHAPES = {
    "normal": np.random.default_rng(4).normal(0, 1, 3000),
    "skewed": np.random.default_rng(5).lognormal(0, 2, 3000),
    "far": np.concatenate([np.random.default_rng(6).normal(1e9, 1, 2000), [1e9 + 1e6]]),
    "ties": np.random.default_rng(7).integers(0, 4, 2000).astype(float),
    "two": np.array([-1.0, 3.0]),
}


@pytest.mark.parametrize("resolution", [4, 256])
@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_binned_density_stays_within_its_bound(spark, shape, resolution):
    numbers = SHAPES[shape]
    got = [r.density for r in kernel_density(values(spark, numbers.tolist()), "v", resolution=resolution).orderBy("point").collect()]
    h = numbers.std(ddof=1) * len(numbers) ** -0.2
    peak = len(numbers) / (h * np.sqrt(2 * np.pi)) * (numbers.max() - numbers.min()) / 50
    rounding = 1e-6 if shape == "far" else 1e-9  # a value's distance from the grid has fewer digits there
    assert np.abs(np.array(got) - _density(numbers)).max() <= peak * (1 / (8 * resolution**2) + rounding)


def test_binned_density_reads_rows_into_one_aggregate(spark):
    rows = spark.range(1000).select((F.col("id") % 37 * 1.5).alias("v"))
    text = plan(kernel_density(rows, "v"), "simple")
    steps = [line for line in text.splitlines() if "Generate" in line or "partial_" in line]
    assert "partial_count" in steps[-1] and sum("Generate" in line for line in steps) == 2


def test_density_degenerate(spark):
    for numbers in ([], [1.0], [2.0, 2.0]):
        got = kernel_density(values(spark, numbers), "v").collect()
        assert len(got) == 200 and {r.density for r in got} == {None}


def test_one_hot(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "C"), (3, None), (4, "a (x.y)")], "id int, name string")
    got = one_hot(rows)
    assert got.columns == ["id", "name_a (x.y)", "name_b"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 1), (2, 0, 0), (3, 0, 0), (4, 1, 0)]
    assert one_hot(rows.filter("id = 1")).columns == ["id"]
    assert one_hot(rows, categories=["a", "b", "z"]).columns == ["id", "name_b", "name_z"]
    with pytest.raises(ValueError, match="more than 2"):
        one_hot(rows, limit=2)
    many = spark.range(1200).select(F.col("id").cast("string").alias("name"))
    assert len(one_hot(many).columns) == 1199


def test_coerce_and_drop(spark):
    rows = spark.createDataFrame(
        [("2020-01-01", "1", "p"), ("x", "1", "p"), ("2020-01-01", "x", "p"), ("2020-01-01", "1", None)],
        "start_date string, data_value string, geo_place_name string",
    )
    assert coerce_and_drop(rows).count() == 1


def _vector(row):
    v = row.name_vector
    return v.size, v.indices, v.values


def test_sparse_vectors_say_what_the_dense_columns_say(spark):
    names = ["b", "a", None, "C", "b", "é", "a.b (c)"]
    rows = spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], "id int, name string, `category_index` string")
    dense = {r.id: [r[c] for c in r.__fields__ if c.startswith("name_")] for r in one_hot(rows).collect()}
    sparse = one_hot_sparse(rows)
    assert sparse.columns == ["id", "category_index", "name_vector"]
    for r in sparse.collect():
        size, indices, ones = _vector(r)
        assert dense[r.id] == [int(k in indices) for k in range(size)] and ones == [1.0] * len(indices)
    other = spark.createDataFrame([(1, "z"), (2, "é"), (3, "C")], "id int, name string")
    assert {r.id: _vector(r)[1] for r in one_hot_sparse(other, index=category_index(rows)).collect()} == {1: [], 2: [3], 3: []}


@pytest.mark.parametrize("names", [[], [None], ["only"]])
def test_sparse_vectors_of_few_categories(spark, names):
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    assert [_vector(r) for r in one_hot_sparse(rows).collect()] == [(0, [], [])] * len(names)


def test_many_categories_never_reach_the_driver(spark, monkeypatch):
    """200,000 names, one of them in a third of the rows."""
    number = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200_000)
    rows = spark.range(600_000).select("id", F.concat(F.lit("n"), F.lpad(number.cast("string"), 6, "0")).alias("name"))
    with monkeypatch.context() as patch:
        patch.setattr(type(rows), "collect", lambda self: pytest.fail("collected"))
        encoded = one_hot_sparse(rows)
    vector = F.col("name_vector")
    # Names sort as their numbers do, and all 200,000 occur.
    wrong = F.when(number == 0, F.size(vector["indices"]) != 0).otherwise(F.get(vector["indices"], F.lit(0)) != number - 1)
    found = encoded.agg(F.count("*"), F.count_if(wrong), F.max(vector["size"]), F.min(vector["size"])).first()
    assert tuple(found) == (600_000, 0, 199_999, 199_999)


def test_category_index_orders_over_many_ranges(spark):
    rows = spark.range(5000).select(F.sha2((F.col("id") % 1700).cast("string"), 256).alias("name"))
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        found = category_index(rows).collect()
    assert [r.category_index for r in sorted(found)] == list(range(1700))
