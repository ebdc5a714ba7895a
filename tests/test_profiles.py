"""Profiles of parts merge into the profile of the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import profiles
from gaugeworks.operators.distribution import deviation_spread
from gaugeworks.plans.analysis import run_analysis
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.plans.profiled import missing_loads, run_profiled, stored_profiles, update_profiles
from gaugeworks.sources.spec import SourceSpec
from tests.test_ingest import HEADER

random = np.random.default_rng(11)
SHAPES = {
    "normal": random.normal(5, 2, 20_000),
    "skewed": random.lognormal(0, 3, 20_000),
    "constant": np.full(5_000, 7.25),
    "ties": random.choice([1.0, 2.0, 2.5], 20_000, p=[0.1, 0.85, 0.05]),
    "offset": 1e9 + random.normal(0, 1, 20_000),
    "one": np.array([3.0]),
}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    data = [(g, i % 7 if g != "normal" else i // 3000, float(v), float(v * 0.5 + i % 13)) for g, vs in SHAPES.items() for i, v in enumerate(vs)]
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    spark.createDataFrame([*data, ("normal", 0, None, 1.0), ("normal", 0, float("nan"), 1.0), ("ties", 1, 2.0, None)], "g string, run int, v double, w double").write.parquet(path)
    return spark.read.parquet(path)


def test_merged_moments_equal_one_pass(rows):
    merged = profiles.merge_profiles(profiles.profile(rows, ["g", "run"], "v", "w"), ["g"])
    found = {r.g: r for r in merged.select("*", profiles.deviation().alias("sd"), profiles.correlation().alias("r")).collect()}
    once = {r.g: r for r in profiles.profile(rows, ["g"], "v", "w").collect()}
    for g, vs in SHAPES.items():
        others = np.array([v * 0.5 + i % 13 for i, v in enumerate(vs)])
        got = found[g]
        assert (got.n, got.low, got.high) == (len(vs), vs.min(), vs.max()) == (once[g].n, once[g].low, once[g].high)
        assert got.mean == pytest.approx(vs.mean(), rel=1e-12)
        if len(vs) > 1:
            assert got.sd == pytest.approx(vs.std(ddof=1), rel=1e-9, abs=1e-12)
            assert got.m2 == pytest.approx(once[g].m2, rel=1e-6, abs=1e-9)  # the one pass has lost more digits
            assert got.co_moment == pytest.approx(((vs - vs.mean()) * (others - others.mean())).sum(), rel=1e-8, abs=1e-6)
        else:
            assert got.sd is None
        if vs.std() > 0:
            # A value near 1e9 has but 7 digits after the point.
            assert got.r == pytest.approx(np.corrcoef(vs, others)[0, 1], rel=1e-7 if g == "offset" else 1e-9)
        else:
            assert got.r is None


def test_rank_error_of_merged_sketches(rows):
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    merged = profiles.merge_profiles(profiles.profile(rows, ["g", "run"], "v"), ["g"])
    found = profiles.sketch_quantiles(merged, ["g"], wanted).collect()
    assert len(found) == len(SHAPES) * len(wanted)
    for r in found:
        vs = np.sort(SHAPES[r.g])
        first, last = np.searchsorted(vs, r.quantile, "left") / len(vs), np.searchsorted(vs, r.quantile, "right") / len(vs)
        assert first - profiles.RANK_ERROR <= r.probability <= last + profiles.RANK_ERROR
        assert r.quantile in vs


def test_boxes(rows):
    boxes = {r.g: r for r in profiles.sketch_boxes(profiles.merge_profiles(profiles.profile(rows, ["g", "run"], "v"), ["g"]), ["g"]).collect()}
    for g, vs in SHAPES.items():
        box = boxes[g]
        assert vs.min() <= box.whisker_low <= box.q1 <= box.median <= box.q3 <= box.whisker_high <= vs.max()
        reach = 1.5 * (box.q3 - box.q1)
        outliers = ((vs < box.q1 - reach) | (vs > box.q3 + reach)).sum()
        assert abs(box.outliers - outliers) <= 2 * profiles.RANK_ERROR * len(vs)
    assert boxes["constant"].outliers == 0 and boxes["one"].n == 1


def test_null_keys_merge_and_empty_stays_empty(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 3.0), ("a", 1, None)], "g string, run int, v double")
    merged = profiles.merge_profiles(profiles.profile(df, ["g", "run"], "v"), ["g"]).collect()
    assert [(r.g, r.n, r.mean, r.m2) for r in merged] == [(None, 2, 2.0, 2.0)]
    assert profiles.merge_profiles(profiles.profile(df.limit(0), ["g"], "v"), ["g"]).count() == 0
    with pytest.raises(ValueError, match="key"):
        profiles.merge_profiles(profiles.profile(df, ["g"], "v"), [])


LOADS = [
    [(1, "Bronx", "2008-12-01", 10.5), (2, "Queens", "2009-06-01", 11), (3, "Bronx", "2009-07-01", 2.25)],
    [(4, "Bronx", "2009-01-01", 4.5), (5, "Staten", "2010-10-01", 8), (1, "Bronx", "2008-12-01", 99)],
    [(6, "Queens", "2011-03-01", 1.75), (7, "Queens", "2011-04-01", "NA")],
]
PLACES = {"Bronx": 101, "Queens": 102, "Staten": 103}


def test_profiled_statistics_follow_the_loads(spark, tmp_path):
    home, parts = str(tmp_path / "home"), []
    for k, load in enumerate(LOADS):
        lines = [f"{i},365,PM2.5,Mean,mcg,CD,{PLACES[p]},{p},T,{d},{v},\n" for i, p, d, v in load]
        (tmp_path / f"{k}.csv").write_text(HEADER + "".join(lines) + f"{k + 50},375,NO2,Mean,ppb,CD,101,Bronx,T,2009-01-01,7,\n")
        run_ingest(spark, SourceSpec(path=str(tmp_path / f"{k}.csv")), home, f"r{k}")
        assert [run for run, _ in missing_loads(spark, home)] == [f"r{k}"]
        found, full = run_profiled(spark, home), run_analysis(spark, home)
        assert missing_loads(spark, home) == [] and update_profiles(spark, home) == 0
        parts.append(stored_profiles(spark, home).count())
        assert found.season_correlation.first()[0] == pytest.approx(full.season_correlation.first()[0], rel=1e-9)
        assert [(r[0], pytest.approx(r[1])) for r in found.top_places.collect()] == [tuple(r) for r in full.top_places.collect()]
        boxes = {r.season_idx: r for r in full.season_boxes.collect()}
        assert {r.season_idx: r.n for r in found.season_boxes.collect()} == {s: b.n for s, b in boxes.items()}
        spread = deviation_spread(found.place_profile)
        deviations = [r.pollution_deviation for r in full.deviations.collect()]
        assert (spread.count, spread.low, spread.high) == (len(deviations), pytest.approx(min(deviations)), pytest.approx(max(deviations)))
    assert parts == sorted(parts) and parts[0] < parts[-1]


def test_an_update_reads_the_new_load_only(spark, tmp_path, monkeypatch):
    home = str(tmp_path / "home")
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(HEADER + f"{k},365,PM2.5,Mean,mcg,CD,101,Bronx,T,2009-01-01,{k},\n")
        run_ingest(spark, SourceSpec(path=str(tmp_path / f"{k}.csv")), home, f"r{k}")
        seen = []
        whole = profiles.profile
        monkeypatch.setattr(profiles, "profile", lambda df, *a, seen=seen, whole=whole, **b: (seen.append(df.inputFiles()), whole(df, *a, **b))[1])
        assert update_profiles(spark, home) == 1
        monkeypatch.undo()
        assert len(seen) == 1 and seen[0] and all(f"/run_id=r{k}/" in file for file in seen[0])
    assert stored_profiles(spark, home).agg(F.sum("n")).first()[0] == 2
