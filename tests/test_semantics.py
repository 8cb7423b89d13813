"""Hand-made rows for the rules that decide the numbers."""

import pytest
from pyspark.sql import functions as F

from pixelseries.functions import pixel as px
from pixelseries.operators import bands as bd
from pixelseries.operators import catalog as cat
from pixelseries.operators import composite as cp
from pixelseries.operators import diagnostics as dg
from pixelseries.operators import features as ft
from pixelseries.operators import metrics as mt
from pixelseries.sources import adapter as ad
from pixelseries.sources import tilestore
from pixelseries.sources.adapter import BANDS, PIXEL
from pixelseries.streaming.observations import clean_stream, read_composites, write_clean_stream, write_composite_stream

from .conftest import SF

OBS = "h int, v int, season_year int, pixel long, day int, idx int, " + ", ".join(f"b{k} int" for k in range(1, 8)) + ", b31 int, state int, zenith int"


def days(year=2019):
    return [year * 1000 + 65 + 16 * i for i in range(19)] + [(year + 1) * 1000 + 1 + 16 * i for i in range(4)]


def season(spark, value=lambda i, b: 100 * b + i, state=lambda i: 0, zenith=lambda i: 30, skip=()):
    rows = [(9, 5, 2019, 1, d, i, *[value(i, b) for b in range(1, 8)], 14000 + i, state(i), zenith(i)) for i, d in enumerate(days()) if i not in skip]
    other = [(9, 5, 2019, 2, d, i, *[b for b in range(1, 8)], 14000, 0, 30) for i, d in enumerate(days())]
    return spark.createDataFrame(rows + other, OBS)


def one(spark, sql_row, column):
    return spark.sql(f"SELECT {sql_row}").select(column.alias("x")).first()["x"]


def test_zenith_limit_and_missing(spark):
    clamp = px.zenith_clamp(F.col("v"), F.col("z"))
    for z, v, want in ((71, 5, 5), (72, 5, 16000), ("NULL", 5, 5), (72, "NULL", 16000), (30, "NULL", None)):
        assert one(spark, f"cast({v} as int) v, cast({z} as int) z", clamp) == want


@pytest.mark.parametrize("state, ok", [(0, True), (1, False), (2, False), (4, False), (64, True), (128, True), (192, False), (8192, False), ("NULL", False)])
def test_quality_bits(spark, state, ok):
    assert one(spark, f"cast({state} as int) s, 30 z", px.qa_ok(F.col("s"), F.col("z"))) is ok


def test_ndvi_rules(spark):
    index = px.ndvi(F.col("a"), F.col("b"))
    for a, b, want in ((100.0, 300.0, 500), (-5.0, 5.0, 0), ("NULL", 5.0, 0), (300.0, 101.0, -496)):
        assert one(spark, f"cast({a} as double) a, cast({b} as double) b", index) == want
    assert one(spark, "cast(NULL as double) a, 1D b", px.ndvi(F.col("a"), F.col("b"), "null")) is None


def test_calendar(spark):
    rows = cat.calendar(spark.createDataFrame([(2019,)], "season_year int")).orderBy("idx").collect()
    assert [r["day"] for r in rows] == days() and rows[0]["day"] == 2019065 and rows[-1]["day"] == 2020049


def test_names_and_tiles(spark):
    names = [("REF44CH.A2019065.h09v05.006.0000000000001.hdf",), ("REF44CX.A2019065.h09v05.006.1.hdf",), ("REF44CQ.A2019065.h007v05.006.1.hdf",), ("x",), (None,)]
    got = {r["path"]: r for r in cat.granule_catalog(spark.createDataFrame(names, "path string")).collect()}
    first = got[names[0][0]]
    assert (first["product"], first["day"], first["h"], first["v"], first["doy"], first["valid"]) == ("CH", 2019065, 9, 5, 65, True)
    assert [got[n[0]]["valid"] for n in names[1:]] == [False] * 4
    tiles = cat.parse_tile_id(spark.createDataFrame([("h09v05",), ("y01v02",), ("h007v05",), ("H01V02",)], "tile string"))
    assert {r["tile"]: r["valid"] for r in tiles.collect()} == {"h09v05": True, "y01v02": False, "h007v05": False, "H01V02": True}


def test_latest_pairs_missing_and_incomplete(spark):
    days23 = days()
    names = [f"REF44{p}.A{d}.h09v05.006.{s:013d}.hdf" for d in days23 for p in ("CH", "CQ") for s in (1, 2)]
    names += [f"REF44CH.A{d}.h10v05.006.{1:013d}.hdf" for d in days23]
    found = cat.granule_catalog(spark.createDataFrame([(n,) for n in names], "path string"))
    pairs = cat.pair_granules(found).collect()
    assert len(pairs) == 23 and all(r["ch_path"].endswith("2.hdf") and r["cq_path"].endswith("2.hdf") for r in pairs)
    assert cat.missing_granules(found).count() == 23
    assert [(r["tile"], r["days"]) for r in cat.incomplete_tiles(found).collect()] == [("h10v05", 0)]


def test_composites_pair_dates_and_end_alone(spark):
    obs = season(spark)
    comp = cp.composites(obs).filter("pixel = 1").orderBy("period").collect()
    assert len(comp) == 12
    assert comp[0]["b1"] == 100.5 and comp[7]["b1"] == 114.5 and comp[11]["b1"] == 122.0
    assert cp.period_map(bd.tile_calendar(obs), 1).filter("period = 22").count() == 1


def test_missing_values_by_metric(spark):
    bad = lambda i: 1 if i in (0, 1) else 0
    obs = season(spark, state=bad, skip=(2,))
    comp = cp.composites(obs)
    at = lambda name: mt.metric_long(comp, name).filter("pixel = 1 AND band = 'b1'").first()["value"]
    assert comp.filter("pixel = 1").count() == 12 and comp.filter("pixel = 1 AND b1 IS NULL").count() == 1
    assert at("band_min") == 103.0
    assert at("band_max") is None and at("band_median") is None and at("band_amplitude") is None
    assert at("lowest_8_mean") is not None and at("lowest_3_mean") == pytest.approx((103 + 104.5 + 106.5) / 3)
    warm = mt.metric_long(comp, "temp_mean_warmest3").filter("pixel = 1").first()["value"]
    assert warm is None


def test_ties_take_the_last_for_max_and_the_first_for_min(spark):
    obs = season(spark, value=lambda i, b: 1000 + i if b == 5 else (200 if b == 2 else 100))
    comp = cp.composites(obs)
    at = lambda name: mt.metric_long(comp, name).filter("pixel = 1 AND band = 'b5'").first()["value"]
    assert at("green_max") == 1022.0 and at("green_min") == 1000.5 and at("green_median") == 1012.5


def test_bounds_between_metrics(spark):
    obs = season(spark, value=lambda i, b: (i * 37 + b * 11) % 500)
    wide = ft.feature_table(cp.composites(obs))
    assert len([c for c in wide.columns if c not in PIXEL]) == 263 == ft.metric_catalog(spark).count()
    for row in wide.collect():
        for b in BANDS:
            assert row[f"band_min__{b}"] <= row[f"band_median__{b}"] <= row[f"band_max__{b}"]
            assert row[f"lowest_3_mean__{b}"] <= row[f"lowest_6_mean__{b}"] <= row[f"lowest_8_mean__{b}"]
            assert row[f"amp_greenest__{b}"] == row[f"band_amplitude__{b}"] >= 0


def test_unknown_names_are_errors(spark):
    obs = season(spark)
    with pytest.raises(ValueError):
        bd.day_slice(obs, "b99", [2019065])
    with pytest.raises(ValueError):
        ft.feature_table(obs, ["no_such_metric"])


def test_metrics_take_one_exchange_after_the_layout(spark):
    """Both aggregates and their join reuse the layout by pixel."""
    comp = spark.createDataFrame([], "h int, v int, season_year int, pixel long, period int, " + ", ".join(f"{b} double" for b in [*BANDS, "b31"]) + ", ndvi int, therm int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ft.feature_table(comp, ["band_min", "green_max"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" in plan and "SortAggregate" not in plan


def test_metrics_use_the_layout_of_composites(spark):
    """Composites are dealt by pixel, and aggregates over them do not deal them again."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        comp = cp.composites(ad.observations(spark, SF))
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (comp, ft.feature_table(comp, ["band_min", "lowest_3_mean"]))]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    dealt = [[x for x in p.split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x and "pixel" in x] for p in plans]
    assert len(dealt[0]) == len(dealt[1]) > 0


def test_stream_cleans_as_the_table_does(spark, tmp_path):
    obs = season(spark, state=lambda i: i % 2)
    obs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(obs.schema).parquet(str(tmp_path / "in"))
    write_clean_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, clean_stream(obs).collect()), key=repr)
    dense = bd.clean(obs).select(got.columns)
    assert sorted(map(tuple, dense.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)


def test_stream_of_composites_equals_the_batch(spark, tmp_path):
    """Dates come in any order over several runs; periods close once, their state goes, and a restart goes on."""
    shared, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    obs = season(spark, state=lambda i: (i % 5 == 0) * 1 + (i in (6, 7)) * 1, skip=(3, 12, 13))
    obs = obs.unionByName(obs.withColumns({"season_year": F.lit(2018), "day": F.col("day") - 1000})).filter("NOT (season_year = 2018 AND idx = 9)")
    obs = obs.unionByName(obs.filter("idx = 4").withColumns({"day": F.col("day") + 1, "b1": F.lit(9)}))  # off the calendar
    spark.createDataFrame([], OBS).write.parquet(shared)
    run = lambda: write_composite_stream(spark.readStream.schema(obs.schema).parquet(shared), out, state, "500 days").awaitTermination()
    for part in ("idx % 3 = 2 AND season_year = 2019", "idx % 3 = 0 AND season_year = 2018", "idx % 3 = 1 OR season_year = 2018 AND idx % 3 = 2", "idx % 3 = 0 AND season_year = 2019"):
        obs.filter(part).write.mode("append").parquet(shared)
        run()
        assert read_composites(spark, out).isEmpty()  # nothing closes before its time
    for year in (2022, 2024):  # what comes much later lets the watermark pass
        obs.filter("season_year = 2019 AND idx = 0").withColumns({"season_year": F.lit(year), "day": F.col("day") + (year - 2019) * 1000}).write.mode("append").parquet(shared)
        run()
    got = read_composites(spark, out).filter("season_year < 2022")
    want = cp.composites(obs)
    assert {r["season_year"] for r in got.collect()} == {2019}  # 2018 lacks a date
    plain = lambda df: sorted(map(str, df.select(sorted(want.columns)).collect()))
    assert plain(got) == plain(want) and got.count() == 24
    last = run_progress(spark, obs, shared, out, state)
    assert last <= 2  # of 2022 and 2024 alone: closed periods have left the state


def run_progress(spark, obs, shared, out, state):
    """Rows of state after one more run."""
    obs.limit(0).write.mode("append").parquet(shared)
    obs.filter("season_year = 2019 AND idx = 0").withColumns({"season_year": F.lit(2024), "day": F.col("day") + 5000}).write.mode("append").parquet(shared)
    query = write_composite_stream(spark.readStream.schema(obs.schema).parquet(shared), out, state, "500 days")
    query.awaitTermination()
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def season_of(spark, year, value=lambda i, b: 100 * b + i, dates=23):
    at = days(year)[:dates]
    rows = [(9, 5, year, p, d, i, *[value(i, b) for b in range(1, 8)], 14000 + i, 0, 30) for p in (1, 2 << 20) for i, d in enumerate(at)]
    return spark.createDataFrame(rows, OBS)


def test_bands_add_new_tile_years_and_redo_changed_ones(spark, tmp_path):
    path, first = str(tmp_path / "bands"), bd.clean(season_of(spark, 1995))
    bd.write_bands(first, path)
    bd.write_bands(bd.clean(season_of(spark, 1996)).unionByName(first), path)
    runs = tilestore.read(spark, path, constant=bd.BANDS_LAYER).select("season_year", "run").distinct().collect()
    assert len({r["run"] for r in runs}) == 2  # 1995 stays as the first run wrote it
    bd.write_bands(first.withColumn("b1", F.lit(-1)), path)
    got = bd.read_bands(spark, path).groupBy("season_year").agg(F.count("*").alias("n"), F.min("b1").alias("low")).collect()
    assert {(r["season_year"], r["n"], r["low"]) for r in got} == {(1995, 46, -1), (1996, 46, 100)}


def test_a_write_that_is_killed_is_done_again(spark, tmp_path, monkeypatch):
    """Rows without an entry of the log are read by nobody, and the next run makes them anew."""
    path, obs = str(tmp_path / "bands"), season_of(spark, 1995)
    bd.collate_batch(obs.filter("pixel = 1"), path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(tilestore, "digest", killed)  # the rows are written, the log is not
        tilestore.put(bd.clean(season_of(spark, 1996)), path, constant=bd.BANDS_LAYER)
    assert spark.read.parquet(path).select("season_year").distinct().count() == 2
    assert {r["season_year"] for r in bd.read_bands(spark, path).collect()} == {1995}
    report = bd.collate_batch(obs.filter("pixel = 1").unionByName(season_of(spark, 1996)), path).collect()
    assert {(r["season_year"], r["status"]) for r in report} == {(1995, "stored"), (1996, "written")}
    assert bd.read_bands(spark, path).groupBy("season_year").count().filter("season_year = 1996").first()["count"] == 46


def test_late_pixels_and_newer_values_are_taken_in(spark, tmp_path):
    path, obs = str(tmp_path / "bands"), season_of(spark, 1995)
    status = lambda o: {r["status"] for r in bd.collate_batch(o, path).collect()}
    pixels = lambda: {r["pixel"] for r in bd.read_bands(spark, path).collect()}
    assert status(obs.filter("pixel = 1")) == {"written"} and pixels() == {1}
    assert status(obs) == {"redone"} and pixels() == {1, 2 << 20}
    assert status(obs) == {"stored"}
    newer = obs.withColumn("b1", F.when(F.col("day") == 1995065, 7).otherwise(F.col("b1")))
    assert status(newer) == {"redone"} and bd.read_bands(spark, path).filter("day = 1995065").agg(F.max("b1")).first()[0] == 7
    assert tilestore.stale_runs(spark, path).count() == 2  # the first pixel's run, and that of the older values
    layers, read = str(tmp_path / "layers"), lambda o: bd.read_values(o, "b5", True).withColumnRenamed("day", "step")
    reused = lambda o: {r["reused"] for r in ft.reuse_or_compute_band(o, read, "b5", layers).collect()}
    assert [reused(o) for o in (obs.filter("pixel = 1"), obs, obs, newer)] == [{False}, {False}, {True}, {False}]


def test_masks_replace_only_the_tile_years_they_hold(spark, tmp_path):
    path = str(tmp_path / "masks")
    for obs in (season_of(spark, 1995), season_of(spark, 1996), season_of(spark, 1996).withColumn("state", F.lit(1))):
        bd.write_mask(obs, path)
    got = spark.read.parquet(path).groupBy("season_year").agg(F.count("*").alias("n"), F.max("mask").alias("m")).collect()
    assert {tuple(r) for r in got} == {(1995, 46, 1), (1996, 46, px.MISSING)}


def test_metrics_are_reused_and_never_doubled(spark, tmp_path):
    path, comp = str(tmp_path / "metrics"), cp.composites(season_of(spark, 1995).unionByName(season_of(spark, 1996)))
    count = lambda df: {(r["season_year"], r["reused"]): r["count"] for r in df.groupBy("season_year", "reused").count().collect()}
    assert count(ft.reuse_or_compute(comp.filter("season_year = 1995"), "band_min", path)) == {(1995, False): 16}
    assert count(ft.reuse_or_compute(comp, "band_min", path)) == {(1995, True): 16, (1996, False): 16}
    assert count(ft.reuse_or_compute(comp, "band_min", path)) == {(1995, True): 16, (1996, True): 16}
    assert ft.stored_metrics(spark, path).count() == 32
    # Another metric in the same store is computed anew; tile-years that are not asked for are not given.
    assert count(ft.reuse_or_compute(comp, "green_max", path)) == {(1995, False): 16, (1996, False): 16}
    assert count(ft.reuse_or_compute(comp.filter("season_year = 1996"), "band_min", path)) == {(1996, True): 16}
    # Stored metrics whose composites are known are reused as well.
    ft.write_metrics(mt.metric_long(comp, "temp_max").withColumn("metric", F.lit("temp_max")), path, source=comp)
    assert count(ft.reuse_or_compute(comp, "temp_max", path)) == {(1995, True): 16, (1996, True): 16}


def test_bands_of_a_tile_year_are_reused_together(spark, tmp_path):
    path, obs, passes = str(tmp_path / "layers"), season_of(spark, 1995).unionByName(season_of(spark, 1996)), []

    def make(o):
        passes.append({r["season_year"] for r in o.select("season_year").distinct().collect()})
        return bd.cleaned_rows(o).withColumnRenamed("day", "step").unpivot([*PIXEL, "step"], ad.ALL_BANDS, "band", "value")

    two = lambda o: make(o).filter(F.col("band").isin("b1", "b2"))
    ft.reuse_or_compute_bands(obs.filter("season_year = 1995"), two, ["b1", "b2"], path)
    got = ft.reuse_or_compute_bands(obs, make, ad.ALL_BANDS, path)
    assert passes == [{1995}, {1995, 1996}]  # one pass over the tile-years that miss a band
    assert {(r["season_year"], r["band"]) for r in got.filter("reused").collect()} == {(1995, "b1"), (1995, "b2")}
    assert got.count() == 2 * 8 * 46 and got.groupBy(*PIXEL, "step", "band").count().filter("count > 1").isEmpty()
    assert ft.reuse_or_compute_bands(obs, make, ad.ALL_BANDS, path).filter("NOT reused").isEmpty() and passes[-1] == set()


def test_bands_and_composites_are_reused(spark, tmp_path):
    path, obs = str(tmp_path / "layers"), season_of(spark, 1995).unionByName(season_of(spark, 1996))
    read = lambda o: bd.read_values(o, "b5", True).withColumnRenamed("day", "step")
    mean = lambda o: cp.composites(o).select(*PIXEL, F.col("period").alias("step"), F.col("b5").alias("value"))
    got = ft.reuse_or_compute_band(obs.filter("season_year = 1995"), read, "b5", path)
    assert {r["reused"] for r in got.collect()} == {False}
    got = ft.reuse_or_compute_band(obs, read, "b5", path).collect()
    assert len(got) == 92 and all(r["reused"] == (r["season_year"] == 1995) for r in got)
    for reused in (False, True):
        got = ft.reuse_or_compute_band(obs, mean, "b5-composite", path).collect()
        assert len(got) == 48 and {r["reused"] for r in got} == {reused}
        assert {r["value"] for r in got if r["step"] == 0} == {500.5}


def test_a_batch_skips_incomplete_tile_years(spark, tmp_path):
    path = str(tmp_path / "bands")
    whole, part = season_of(spark, 1995), season_of(spark, 1996, dates=22)
    report = lambda obs: {r["season_year"]: (r["dates"], r["status"]) for r in bd.collate_batch(obs, path).collect()}
    assert report(whole.unionByName(part)) == {1995: (23, "written"), 1996: (22, "incomplete")}
    assert report(whole.unionByName(season_of(spark, 1997))) == {1995: (23, "stored"), 1997: (23, "written")}
    assert bd.read_bands(spark, path).select("season_year").distinct().count() == 2


def test_days_off_the_calendar_never_count(spark, tmp_path):
    """One date moved by a day leaves a tile-year incomplete; one day more changes nothing."""
    obs = season_of(spark, 1995)
    moved = obs.withColumn("day", F.when(F.col("idx") == 3, F.col("day") + 1).otherwise(F.col("day")))
    more = obs.unionByName(obs.filter("idx = 3").withColumn("day", F.col("day") + 1).withColumn("b1", F.lit(9999)))
    assert cp.composites(moved).isEmpty() and bd.tile_calendar(moved).isEmpty() and bd.dense_grid(moved).isEmpty()
    assert cp.period_map(bd.tile_calendar(more)).select("period").distinct().count() == 12
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(cp.composites(more), cp.composites(obs)) and same(bd.clean(more), bd.clean(obs))
    for k, (o, want) in enumerate(((moved, (22, 2, "incomplete")), (more, (23, 2, "written")))):
        assert [(r["dates"], r["off_calendar"], r["status"]) for r in bd.collate_batch(o, str(tmp_path / str(k))).collect()] == [want]
    names = [f"REF44{p}.A{d + (d == 2019081)}.h09v05.006.1.hdf" for d in days() for p in ("CH", "CQ")]
    files = lambda n: cat.granule_catalog(spark.createDataFrame([(x,) for x in n], "path string"))
    assert [(r["tile"], r["days"]) for r in cat.incomplete_tiles(files(names)).collect()] == [("h09v05", 22)]
    assert {(r["day"], r["product"]) for r in cat.missing_granules(files(names)).collect()} == {(2019081, "CH"), (2019081, "CQ")}
    assert cat.off_calendar(files(names)).count() == 2
    names += [n.replace("2019082", "2019081") for n in names if "2019082" in n]
    assert cat.incomplete_tiles(files(names)).isEmpty() and cat.missing_granules(files(names)).isEmpty()


def test_stamps_are_compared_as_numbers(spark):
    names = [(f"REF44CH.A2019065.h09v05.006.{stamp}.hdf",) for stamp in ("9", "10", "0000008", "x9")]
    found = cat.latest_granule(cat.granule_catalog(spark.createDataFrame(names, "path string"))).collect()
    assert [r["stamp"] for r in found] == ["10"]


def test_options_reach_the_composites(spark):
    """A missing index, composites as stored files hold them, and a missing zenith that fails."""
    gone = season(spark, state=lambda i: 1 if i < 2 else 0, zenith=lambda i: 255 if i in (2, 3) else 30)
    first = lambda period, **o: cp.composites(gone, **o).filter(f"pixel = 1 AND period = {period}").first()
    assert first(0)["ndvi"] == 0 and first(0, ndvi_missing="null")["ndvi"] is None
    assert first(2)["b1"] == 104.5 and first(2, as_int16=True)["b1"] == 104.0
    assert first(1)["b1"] == 102.5 and first(1, missing_zenith_passes=False)["b1"] is None
    assert one(spark, "5 v, cast(NULL as int) z", px.zenith_clamp(F.col("v"), F.col("z"), False)) == 16000


def test_metrics_are_stored_with_their_descriptions(spark, tmp_path):
    path, comp = str(tmp_path / "metrics"), cp.composites(season(spark))
    ft.write_metrics(ft.run_metrics(comp, ["green_max", "unsorted_monthly"]), path)
    says = {(r["metric"], r["band"]): r["description"] for r in ft.stored_metrics(spark, path, described=True).collect()}
    assert says["green_max", "b5"] == "value at the greenest period" and says["unsorted_monthly", "b1-p00"] == "value of a period"
    assert len(says) == 104 and ft.stored_metrics(spark, path).count() == 208


def test_dumps_are_stored_by_tile_year_and_sorted_by_day(spark, tmp_path):
    path = str(tmp_path / "layers")
    for obs in (season_of(spark, 1995), season_of(spark, 1996), season_of(spark, 1996).filter("idx = 2").withColumn("state", F.lit(4))):
        dg.write_dump(dg.qa_component_layers(obs), path)
    got = dg.read_dump(spark, path)
    assert got.count() == 92 and {(r["season_year"], r["day"]) for r in got.filter("shadow = 4").collect()} == {(1996, 1996097)}
    # Two blocks of pixels of a tile-year make two files at most; days and layers are no folders.
    assert len(list((tmp_path / "layers").glob("run=*/h=*/v=*/season_year=1995/*.parquet"))) <= 2
    plan = got.filter(F.col("day").isin(1996065, 1996241))._jdf.queryExecution().executedPlan().toString()
    assert "In(day, [1996065,1996241])" in plan


def test_users_add_metrics(spark):
    """A registered metric is in the catalog, in feature tables and in runs, and its name is taken."""
    comp = cp.composites(season(spark))
    span = mt.Metric(("b1", "b31"), lambda b: mt.at_highest("green", b) - mt.lowest(b), "value at the greenest period less the lowest", ("green", "own"))
    mt.register("green_span", span)
    try:
        with pytest.raises(ValueError):
            mt.register("green_span", span)
        with pytest.raises(ValueError):
            mt.register("band_min", span)
        with pytest.raises(ValueError):
            mt.register("other", mt.Metric(("b1",), mt.lowest, "", ("rank",)))
        assert {(r["layer"], r["description"]) for r in ft.metric_catalog(spark).filter("metric = 'green_span'").collect()} == {
            ("green_span-b1", span.says), ("green_span-b31", span.says)
        }
        wide = {r["pixel"]: r for r in ft.feature_table(comp).collect()}
        long = {(r["pixel"], r["band"]): r["value"] for r in ft.run_metrics(comp, ["green_span", "band_max"]).filter("metric = 'green_span'").collect()}
        for p, row in wide.items():
            assert row["green_span__b1"] == row["green_max__b1"] - row["band_min__b1"] == long[p, "b1"]
            assert row["green_span__b31"] == long[p, "b31"]
        assert ft.catalog_report(comp).filter("metric = 'green_span' AND present = 2").count() == 2
    finally:
        mt.unregister("green_span")
    assert "green_span" not in mt.registry()


def test_any_number_of_periods(spark):
    """Metrics hold where pixels lack periods, and where keys are missing."""
    comp = cp.composites(season(spark, state=lambda i: 1 if i < 4 else 0), ndvi_missing="null").filter("period < 7")
    at = lambda name, b="b1": mt.metric_long(comp, name).filter(f"pixel = 1 AND band = '{b}'").first()["value"]
    values = [r["b1"] for r in comp.filter("pixel = 1").orderBy("period").collect()]
    assert values[:2] == [None, None] and len(values) == 7
    assert at("band_min") == values[2] and at("band_max") is None and at("lowest_3_mean") == pytest.approx(sum(values[2:5]) / 3)
    ranked = sorted((r["ndvi"] is not None, r["ndvi"] or 0, r["period"], r["b1"]) for r in comp.filter("pixel = 1").collect())
    assert at("green_max") == ranked[-1][3] and at("green_min") == ranked[2][3] and at("green_median") == ranked[3][3]
    assert at("greenest_3_mean") == pytest.approx(sum(r[3] for r in ranked[-3:]) / 3) and at("greenest_6_mean") is None


def test_samples_prune_observations(spark):
    """Composites are made of the samples' pixels alone, and the semi-join stands below the first exchange by pixel."""
    obs = season_of(spark, 1995).unionByName(season_of(spark, 1996))
    samples = spark.createDataFrame([(9, 5, 1995, 1, 40), (9, 5, 1995, 77, 50)], "h int, v int, season_year int, pixel long, label int")
    got = ft.sampled_training_table(samples, obs, ["green_max"])
    whole = ft.training_table(samples, ft.feature_table(cp.composites(obs), ["green_max"]))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and {r["matched"] for r in got.collect()} == {True, False}
    assert cp.composites(obs, pixels=samples).count() == 12
    plan = cp.composites(obs, pixels=samples)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("LeftSemi")


def test_stage_dump_makes_composites_of_its_day_alone(spark):
    obs = season_of(spark, 1995).unionByName(season_of(spark, 1996))
    dump = dg.stage_dump(obs, cp.composites(obs), cp.period_map(bd.tile_calendar(obs)), "b5", 1995065)
    assert {(r["pixel"], r["composite"]) for r in dump.collect()} == {(1, 500.5), (2 << 20, 500.5)}
    plan = dump._jdf.queryExecution().optimizedPlan().toString()
    means = plan[plan.index("avg(") :]
    assert "LeftSemi" in means  # below the aggregate that makes composites


def test_observations_take_one_exchange(spark):
    """Both products come from one hash aggregate: an exchange of line items, no second side, no join of sides, no sort."""
    plan = ad.observations(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "Window" not in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_packed_values_and_orders(spark):
    rows = spark.createDataFrame([(-28672, None, 16000), (0, 0, None), (-10001, 32767, -32768), (None, None, None)], "a int, b int, c int")
    back = rows.withColumn("v", ad.pack([F.col(c) for c in "abc"])).select("a", "b", "c", *ad.unpack(F.col("v"), ["x", "y", "z"]))
    assert all((r["a"], r["b"], r["c"]) == (r["x"], r["y"], r["z"]) for r in back.collect())


def test_features_take_one_aggregate(spark):
    """All 263 features from one hash aggregate over composites, without a join."""
    comp = spark.createDataFrame([], "h int, v int, season_year int, pixel long, period int, " + ", ".join(f"{b} double" for b in [*BANDS, "b31"]) + ", ndvi int, therm int")
    plan = ft.feature_table(comp)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_reports_count_before_they_unpivot(spark):
    """Neither report lays observations out by band or component before its exchange."""
    obs = season(spark, state=lambda i: (0, 1, 4, 192, 8192)[i % 5], zenith=lambda i: (30, 75, 255)[i % 3])
    for made in (dg.qa_component_counts(obs), dg.band_day_report(obs)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("Generate") < plan.rindex("Exchange")  # the plan is printed from the top
    report = {(r["day"], r["band"]): r for r in dg.band_day_report(obs).collect()}
    assert report[2019065, "b1"]["mask_values"] == "1" and report[2019081, "b2"]["mask_values"] == "0,1"


def test_bands_stored_by_pixel_need_no_exchange(spark, tmp_path):
    """From the scan of stored bands to all features there is no exchange, and appends add tile-years."""
    for year in (1995, 1996):
        bd.write_bucketed_bands(bd.clean(season_of(spark, year)), "pixel_bands_test", str(tmp_path / "bands"), 4)
    comp = cp.composites_of_bands(spark.table("pixel_bands_test"))
    want = cp.composites(season_of(spark, 1995).unionByName(season_of(spark, 1996)))
    assert sorted(map(str, comp.select(want.columns).collect())) == sorted(map(str, want.collect()))
    for made in (comp, ft.feature_table(comp)):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE pixel_bands_test")


def exchanges_by_pixel(df):
    """Lines of the plan of ``df`` that deal rows by pixel, besides those of tables that are held."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [x for x in plan if "Exchange hashpartitioning" in x and "pixel" in x and "REPARTITION_BY_COL" not in x]


def test_line_items_are_dealt_as_they_are(spark):
    """No aggregate stands below the exchange of observations: no task of the scan holds states of its pixels and dates."""
    plan = ad.observations(spark, SF.replace("0.001", "0.01"))._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning")  # the plan is printed from the top
    assert len([x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "rank" in x]) == 0


@pytest.fixture
def held(spark):
    """Observations of the adapter, held as the registered queries hold them; joins are not made small by statistics."""
    obs = ad.observations(spark, SF).persist()
    obs.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield obs
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    obs.unpersist()


@pytest.mark.parametrize("made", [ft.feature_table, mt.sorted_by_self, lambda c: mt.metric_long(c, "temp_median")], ids=["features", "self", "temp"])
def test_composites_of_dealt_observations_need_no_exchange(spark, held, made):
    """From held observations to features there is no exchange by pixel, and the values are those of undealt ones."""
    dealt = made(cp.composites(held, dealt=True))
    assert "RepartitionByExpression" not in dealt._jdf.queryExecution().optimizedPlan().toString() and exchanges_by_pixel(dealt) == []
    want = made(cp.composites(held.repartition(3)))
    assert dealt.count() > 0 and dealt.exceptAll(want).isEmpty() and want.exceptAll(dealt).isEmpty()


def test_undealt_observations_may_be_called_dealt(spark):
    obs = season(spark)
    assert sorted(map(str, cp.composites(obs, dealt=True).collect())) == sorted(map(str, cp.composites(obs).collect()))


def test_dense_grid_of_held_observations_is_joined_with_nothing_by_pixel(spark, held):
    """Rows of missing dates come from bits of each pixel: no exchange, sort or join of a grid, and the rows are those of undealt observations."""
    dense = bd.clean(held)
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert exchanges_by_pixel(dense) == [] and "SortMergeJoin" not in plan and "Sort [" not in plan
    want = bd.clean(held.repartition(3))
    assert dense.count() > 0 and dense.exceptAll(want).isEmpty() and want.exceptAll(dense).isEmpty()
    assert {r["count"] for r in dense.groupBy(*PIXEL).count().collect()} == {ad.DATES}


def test_dense_grid_fills_what_is_missing_and_keeps_the_rest(spark):
    """Pixels without a date, without any date of the calendar, and with an index that does not fit their day."""
    obs = season(spark, skip=(0, 7, 22))
    off = obs.filter("pixel = 2 AND idx = 4").withColumns({"pixel": F.lit(3).cast("long"), "day": F.col("day") + 1})
    shifted = obs.filter("pixel = 2").withColumns({"pixel": F.lit(4).cast("long"), "idx": F.lit(0)})
    rows = bd.dense_grid(obs.unionByName(off).unionByName(shifted)).collect()
    at = lambda p, value: {r["idx"] for r in rows if r["pixel"] == p and r["day"] == days()[r["idx"]] and (r["b1"] is not None) == value}
    assert len(rows) == 4 * 23 and at(1, False) == {0, 7, 22} and len(at(1, True)) == 20
    assert len(at(2, True)) == 23 and len(at(3, False)) == 23 and len(at(4, True)) == 23
