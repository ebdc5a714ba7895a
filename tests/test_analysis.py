"""The analysis on a loaded warehouse, against pandas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.plans.analysis import run_analysis
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.sources.spec import SourceSpec

pd = pytest.importorskip("pandas")


@pytest.fixture(scope="module")
def frame():
    random = np.random.default_rng(5)
    n = 600
    ids = random.choice([365, 375, 386], n)
    geo = random.integers(1, 8, n)
    days = pd.Timestamp("2008-12-01") + pd.to_timedelta(random.integers(0, 2000, n), unit="D")
    return pd.DataFrame(
        {
            "Unique ID": np.arange(n),
            "Indicator ID": ids,
            "Name": pd.Series(ids).map({365: "PM 2.5", 375: "NO2", 386: "Ozone (O3)"}),
            "Measure": "Mean",
            "Measure Info": "mcg/m3",
            "Geo Type Name": "CD",
            "Geo Join ID": geo,
            "Geo Place Name": [f"Place {g}" for g in geo],
            "Time Period": "Season",
            "Start_Date": days.strftime("%m/%d/%Y"),
            "Data Value": np.where(random.random(n) < 0.05, np.nan, random.normal(10, 3, n).round(2)),
            "Message": "",
        }
    )


@pytest.fixture(scope="module")
def analysis(spark, frame, tmp_path_factory):
    home = tmp_path_factory.mktemp("analysis")
    frame.to_csv(home / "in.csv", index=False)
    report = run_ingest(spark, SourceSpec(path=str(home / "in.csv")), str(home / "tables"))
    assert report.inserted_records == len(frame)
    return run_analysis(spark, str(home / "tables"), export_to=str(home / "out")), home


@pytest.fixture(scope="module")
def expected(frame):
    rows = frame[frame["Indicator ID"] == 365].copy()
    month = pd.to_datetime(rows["Start_Date"]).dt.month
    rows["season"] = month.map({12: 1, 1: 1, 2: 1, 6: 2, 7: 2, 8: 2, 9: 3, 10: 3, 11: 3, 3: 4, 4: 4, 5: 4})
    return rows


def test_correlation_and_boxes(analysis, expected):
    result, _ = analysis
    want = expected["season"].corr(expected["Data Value"])
    assert result.season_correlation.first()[0] == pytest.approx(want, abs=1e-12)
    for row in result.season_boxes.collect():
        values = expected[expected["season"] == row.season_idx]["Data Value"].dropna()
        assert (row.n, row.q1, row.median, row.q3) == (len(values), *values.quantile([0.25, 0.5, 0.75]).tolist())


def test_places(analysis, expected):
    result, _ = analysis
    rows = expected.dropna(subset=["Data Value"])
    means = rows.groupby("Geo Place Name")["Data Value"].mean()
    got = result.top_places.collect()
    assert [r.geo_place_name for r in got] == means.sort_values(ascending=False).head(10).index.tolist()
    deviation = rows["Data Value"] - rows["Geo Place Name"].map(means)
    mine = {r.unique_id: r.pollution_deviation for r in result.deviations.collect()}
    assert mine == pytest.approx(dict(zip(rows["Unique ID"], deviation, strict=True)))
    counts, _ = np.histogram(deviation, bins=50)
    assert sum(r.bin_count for r in result.deviation_histogram.collect()) == counts.sum()
    assert result.deviation_density.filter("density > 0").count() == 200


def test_exports(spark, analysis, frame):
    result, home = analysis
    encoded = spark.read.option("header", True).csv(f"{home}/out/encoded_measurements.csv")
    assert encoded.columns[-2:] == ["name_Ozone (O3)", "name_PM 2.5"] and "name_NO2" not in encoded.columns
    assert encoded.count() == len(frame)
    ones = encoded.agg(F.sum(F.col("`name_PM 2.5`").cast("int"))).first()[0]
    assert ones == (frame["Indicator ID"] == 365).sum()
    split = spark.read.option("header", True).csv(f"{home}/out/split_measurements.csv")
    assert split.columns[-3:] == ["year", "month", "day"] and split.count() == len(frame)


def test_sparse_names(spark, analysis, frame):
    _, home = analysis
    result = run_analysis(spark, f"{home}/tables", export_to=f"{home}/sparse", sparse_names=True)
    dense = {r["unique_id"]: [r["name_Ozone (O3)"], r["name_PM 2.5"]] for r in analysis[0].encoded.collect()}
    assert {r.unique_id: [int(k in r.name_vector.indices) for k in range(r.name_vector.size)] for r in result.encoded.collect()} == dense
    written = spark.read.option("header", True).option("escape", '"').csv(f"{home}/sparse/encoded_measurements.csv")
    assert written.count() == len(frame) and written.filter("name_vector LIKE '{\"size\":2,%'").count() == len(frame)


def test_nothing_stored(spark, tmp_path):
    result = run_analysis(spark, str(tmp_path / "none"))
    assert result.top_places.count() == 0 and result.deviation_histogram.count() == 0
    assert {r.density for r in result.deviation_density.collect()} == {None}
