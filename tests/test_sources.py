from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from statewatt import sources as src
from statewatt.functions import in_years, since, year_column
from statewatt.plans import grid
from statewatt.sources.schemas import GEO_PROPERTIES, SCHEMAS


def test_table_is_cleaned_pruned_and_typed(spark, tmp_path):
    path = str(tmp_path / "raw.parquet")
    raw = spark.createDataFrame(
        [("A", dt.datetime(2020, 1, 1), float("inf"), 1.0, float("nan"), "extra"), ("A", dt.datetime(2018, 1, 1), 2.0, None, 3.0, "x")],
        "balancing_authority_code_eia string, datetime_utc timestamp_ntz, net_generation_imputed_eia_mwh double, "
        "demand_imputed_pudl_mwh float, interchange_adjusted_mwh double, other string",
    )
    src.write_table(raw, path)
    df = src.load_table(spark, path, SCHEMAS["out_eia930__hourly_operations"])
    types = dict(df.dtypes)
    assert list(types) == SCHEMAS["out_eia930__hourly_operations"].fieldNames()
    assert types["demand_imputed_pudl_mwh"] == "double" and types["datetime_utc"] == "timestamp_ntz"
    recent = df.filter(F.col("datetime_utc") >= F.lit(dt.date(2019, 1, 1)))
    assert "GreaterThanOrEqual(datetime_utc,2019-01-01T00:00)" in recent._jdf.queryExecution().executedPlan().toString()
    got = df.orderBy("datetime_utc").collect()
    assert [r.net_generation_imputed_eia_mwh for r in got] == [2.0, None]
    assert [r.interchange_adjusted_mwh for r in got] == [3.0, None]
    plan = df.select("demand_imputed_pudl_mwh")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<demand_imputed_pudl_mwh:float>" in plan


def test_time_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "gen.parquet")
    spark.createDataFrame([(1, dt.date(2020, 1, 1), "gas", 1.0)], SCHEMAS["out_eia923__monthly_generation_fuel_combined"]).write.parquet(path)
    df = src.load_table(spark, path, SCHEMAS["out_eia923__monthly_generation_fuel_combined"])
    plan = df.filter(F.col("report_date") >= F.lit(dt.date(2019, 1, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(report_date,2019-01-01)" in plan


def test_a_missing_column_fails_early(spark, tmp_path):
    path = str(tmp_path / "short.parquet")
    spark.range(1).write.parquet(path)
    with pytest.raises(ValueError, match="lacks the columns"):
        src.load_table(spark, path, SCHEMAS["raw_dsire_incentive_scores"])


def test_codes_can_be_normalised_on_load(spark, tmp_path):
    path = str(tmp_path / "ref.parquet")
    spark.createDataFrame([("tx ", "Ercot", "Regulated", 1.0)], SCHEMAS["market_structure_ref"]).write.parquet(path)
    df = src.load_table(spark, path, SCHEMAS["market_structure_ref"], codes={"state": "upper", "market_structure": "lower"})
    assert tuple(df.first())[:3] == ("TX", "Ercot", "regulated")
    with pytest.raises(ValueError):
        src.load_table(spark, path, codes={"state": "title"})


def test_yearly_partitions_replace_the_table(spark, tmp_path):
    path = str(tmp_path / "hourly")
    df = spark.createDataFrame([(dt.datetime(2019, 5, 1), 1.0), (dt.datetime(2020, 5, 1), 2.0)], "datetime_utc timestamp, x double")
    src.write_table(df, path, year_of="datetime_utc")
    src.write_table(df.filter("x > 1"), path, year_of="datetime_utc")
    assert [r.year for r in spark.read.parquet(path).collect()] == [2020]


def test_a_time_filter_prunes_yearly_folders(spark, tmp_path):
    path = str(tmp_path / "hourly")
    name = "out_eia930__hourly_operations"
    days = [None] + [dt.datetime(y, m, 1) + dt.timedelta(hours=h) for y in range(2016, 2023) for m in (1, 12) for h in (-1, 0, 1)]
    rows = [("A", d, float(i), 1.0, 2.0) for i, d in enumerate(days)]
    raw = spark.createDataFrame(rows, SCHEMAS[name])
    src.write_table(raw, path, year_of="datetime_utc")
    df = src.load_table(spark, path, SCHEMAS[name], year_of="datetime_utc")
    year = year_column(df, "datetime_utc")
    assert year == "datetime_utc_year" and year_column(raw, "datetime_utc") is None
    for with_year, without in [
        (since("datetime_utc", "2019-01-01", year), since("datetime_utc", "2019-01-01")),
        (in_years("datetime_utc", 2018, 2019, year), in_years("datetime_utc", 2018, 2019)),
    ]:
        pruned, plain = df.filter(with_year), raw.filter(without)
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
        assert "year" in parts and ">=" in parts and "GreaterThanOrEqual(datetime_utc" in plan
        assert sorted(pruned.drop(year).collect()) == sorted(plain.collect())
    recent = grid._recent(df)
    assert "year" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", recent._jdf.queryExecution().executedPlan().toString()).group(1)
    assert sorted(grid.generation_ramps(df).collect()) == sorted(grid.generation_ramps(raw).collect())
    with pytest.raises(ValueError, match="not partitioned"):
        src.write_table(raw, str(tmp_path / "flat"))
        src.load_table(spark, str(tmp_path / "flat"), SCHEMAS[name], year_of="datetime_utc")


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    schema = SCHEMAS["cooperative_utilities"]
    src.write_csv(spark.createDataFrame([(1, "A, B", "TX"), (2, None, "OK")], schema), path)
    got = sorted(map(tuple, src.read_csv(spark, path, schema).collect()))
    assert got == [(1, "A, B", "TX"), (2, None, "OK")]


def test_stage_table_is_replaced(spark):
    first = src.write_stage(spark.range(3), "stage_check")
    assert first.count() == 3
    assert src.write_stage(spark.range(2), "stage_check").count() == 2
    spark.sql("DROP TABLE stage_check")


def test_counters_come_with_the_run(spark):
    df, watch = src.counted(spark.range(10), "load", even=F.count_if(F.col("id") % 2 == 0))
    assert df.count() == 10
    assert watch.get == {"rows": 10, "even": 5}


RING = [[0.5, 0], [4, 0], [4, 4], [0.5, 0]]


def feature(kind, name, multi=False):
    props = {"NAME": name, "STATE": "TX"} | ({"TYPE": kind} if kind else {})
    return {"type": "Feature", "properties": props, "geometry": {"type": "MultiPolygon" if multi else "Polygon", "coordinates": [[RING]] if multi else [RING]}}


FEATURES = [feature("COOPERATIVE", "a"), feature("Cooperative", "b", True), feature("MUNICIPAL", "c"), feature(None, "d")]


@pytest.fixture
def collection(tmp_path):
    path = tmp_path / "all.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": FEATURES}))
    return str(path)


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "lines.geojson"
    body = ",\n".join(json.dumps(f) for f in FEATURES)
    path.write_text('{"type": "FeatureCollection",\n"features": [\n' + body + "\n]}\n")
    return str(path)


@pytest.mark.parametrize("layout", ["document", "lines"])
def test_features_are_read_and_filtered(spark, collection, lines, layout):
    df = src.read_geojson(spark, collection if layout == "document" else lines, GEO_PROPERTIES, layout)
    assert df.count() == 4
    kept = src.feature_filter(df, "COOPERATIVE").orderBy("ordinal").collect()
    assert [r.properties.NAME for r in kept] == ["a", "b"]
    assert [len(r.polygons) for r in kept] == [1, 1]
    assert [(v.x, v.y) for v in kept[1].polygons[0][0]] == [tuple(map(float, p)) for p in RING]


def test_written_features_read_back(spark, collection, tmp_path):
    kept = src.feature_filter(src.read_geojson(spark, collection, GEO_PROPERTIES, "document"), "COOPERATIVE")
    out = str(tmp_path / "coops")
    src.write_geojson(kept, out)
    text = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(t["properties"]["NAME"] for t in text) == ["a", "b"]
    assert {t["geometry"]["type"] for t in text} == {"Polygon", "MultiPolygon"}
    back = src.read_geojson(spark, out, GEO_PROPERTIES, "lines")
    assert back.select("polygons").exceptAll(kept.select("polygons")).count() == 0 and back.count() == 2


def test_unknown_layout(spark, collection):
    with pytest.raises(ValueError):
        src.read_geojson(spark, collection, GEO_PROPERTIES, "xml")


def test_features_come_back_as_they_were(spark, tmp_path):
    odd = [
        '{"type":"Feature","id":7,"properties":{"NAME":"a","TYPE":"COOPERATIVE","STATE":null,"SQ_M":1.50},"geometry":null}',
        '{"type": "Feature", "bbox":[0,0,1,1], "properties":{"TYPE":"COOPERATIVE"},"geometry":{"type":"Point","coordinates":[1.10,2]}}',
    ]
    (tmp_path / "in.geojson").write_text('{\n"type": "FeatureCollection",\n"name": "x",\n"features": [\n' + ",\n".join(odd) + "\n]\n}\n")
    (tmp_path / "doc.geojson").write_text('{"type": "FeatureCollection", "features": [' + ",\n".join(odd) + "]}")
    for name, layout in (("in", "lines"), ("doc", "document")):
        read = src.read_geojson(spark, str(tmp_path / f"{name}.geojson"), GEO_PROPERTIES, layout)
        assert [(r.ordinal, r.geometry_type, r.polygons) for r in read.orderBy("ordinal").collect()][0][1:] == (None, None)
        src.write_geojson(read, str(tmp_path / f"{name}-out"))
        assert sorted(r.value for r in spark.read.text(str(tmp_path / f"{name}-out")).collect()) == sorted(odd)


def test_a_row_without_geometry_is_written_without_one(spark, collection, tmp_path):
    few = src.read_geojson(spark, collection, GEO_PROPERTIES, "document").drop("feature").limit(1)
    src.write_geojson(few.withColumn("geometry_type", F.lit(None).cast("string")), str(tmp_path / "none"))
    assert json.loads(spark.read.text(str(tmp_path / "none")).first().value)["geometry"] is None


@pytest.mark.parametrize("bad", ['{"type":"Feature","properties":{"NAME":"b"', "rubbish", '{"type":"Point","coordinates":[1,2]}', '"type": "Feature"'])
def test_what_is_no_feature_fails_the_read(spark, tmp_path, bad):
    (tmp_path / "bad.geojson").write_text(json.dumps(FEATURES[0]) + "\n" + bad + "\n")
    with pytest.raises(Exception, match="not a GeoJSON feature"):
        src.read_geojson(spark, str(tmp_path / "bad.geojson"), GEO_PROPERTIES).collect()


def test_a_whole_collection_on_a_line_is_no_frame(spark, collection):
    with pytest.raises(Exception, match="not a GeoJSON feature"):
        src.read_geojson(spark, collection, GEO_PROPERTIES).collect()


def test_places_follow_files_and_lines(spark, tmp_path):
    for name, rows in (("a.json", 3), ("b.json", 400)):  # the larger file is dealt first
        (tmp_path / name).write_text("\n".join(json.dumps(feature("x", f"{name}{i:03}")) for i in range(rows)))
    read = src.read_geojson(spark, str(tmp_path), GEO_PROPERTIES).select("ordinal", "properties.NAME").orderBy("ordinal").collect()
    assert [r.NAME for r in read] == sorted(r.NAME for r in read) and [r.ordinal for r in read] == list(range(403))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        split = src.read_geojson(spark, str(tmp_path), GEO_PROPERTIES).select("ordinal", "properties.NAME").orderBy("ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split == read


def crs(name):
    return {"crs": {"type": "name", "properties": {"name": name}}}


MERCATOR, DEGREES, OTHER = crs("urn:ogc:def:crs:EPSG::3857"), crs("urn:ogc:def:crs:OGC:1.3:CRS84"), crs("EPSG:5070")


@pytest.mark.parametrize("layout", ["document", "lines", "one_head"])
@pytest.mark.parametrize("member,fits", [(MERCATOR, {3857}), (DEGREES, {4326}), (crs("EPSG:4326"), {4326}), (OTHER, set()), ({}, {3857, 4326}), ({"crs": None}, {3857, 4326})])
def test_the_declared_system_is_the_files(spark, tmp_path, layout, member, fits):
    path = tmp_path / "some.geojson"
    head = {"type": "FeatureCollection", "name": "x", **member}
    if layout == "document":
        path.write_text(json.dumps({**head, "features": FEATURES}))
    else:
        parts = [json.dumps({k: v})[1:-1] for k, v in head.items()] + ['"features": [']
        joint = ", " if layout == "one_head" else ",\n"
        path.write_text("{ " + joint.join(parts) + "\n" + ",\n".join(json.dumps(f) for f in FEATURES) + "\n]}\n")
    how = "document" if layout == "document" else "lines"
    assert src.read_geojson(spark, str(path), GEO_PROPERTIES, how).count() == 4
    for srid in (3857, 4326):
        if srid in fits:
            df = src.read_geojson(spark, str(path), GEO_PROPERTIES, how, srid)
            assert [r.properties.NAME for r in df.orderBy("ordinal").collect()] == ["a", "b", "c", "d"]
        else:
            with pytest.raises(Exception, match=f"crs is not {srid}"):
                src.read_geojson(spark, str(path), GEO_PROPERTIES, how, srid).collect()
    with pytest.raises(ValueError, match="srid"):
        src.read_geojson(spark, str(path), GEO_PROPERTIES, how, 5070)
