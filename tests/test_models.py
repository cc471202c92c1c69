"""The whole stage graph on small hand-made inputs of all kinds."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from statewatt.plans import REPORT_ORDER, TABLES, Models, config, facilities_in_territory, territory_report
from statewatt.plans.territory import facilities_by_territory
from statewatt.sources import SCHEMAS, load_inputs, read_csv, read_geojson, write_csv, write_table
from statewatt.sources.schemas import GEO_PROPERTIES

STATES = ["TX", "CA", "VA", "DC", "AK", "US"]
MONTHS = [dt.date(y, m, 1) for y in (2018, 2019, 2021, 2022, 2024, 2025) for m in (1, 7)]
YEAR = dt.date(2024, 1, 1)


def _data() -> dict[str, list[tuple]]:
    generation, generators, receipts = [], [], []
    for i, state in enumerate(STATES):
        for plant in (10 * i, 10 * i + 1):
            for n, month in enumerate(MONTHS):
                fuels = ["gas", "solar"] if plant % 2 else ["coal", "wind", None]
                generation += [(plant, month, f, float(100 + 10 * i + 7 * n * (k + 1))) for k, f in enumerate(fuels)]
                # plant 11 also stands in Texas
                homes = [state, "TX"] if plant == 11 else [state]
                generators += [(plant, month, s, fuels[0], 0.1 * (i + 1), f"B{i}" if state != "DC" else "B0") for s in homes]
        receipts += [(state, f, m, 1000.0 * (i + 1) + 50 * n, 100.0, 10.0 if n % 2 else None) for n, m in enumerate(MONTHS) for f in ("gas", "coal") if not (state == "CA" and f == "coal")]
    start = dt.datetime(2018, 12, 31, 20)
    hourly = [
        (f"B{i}", start + dt.timedelta(hours=h), float(50 + 5 * i + (h * (i + 3)) % 17), 60.0 + (h * 5) % 11 + i, float((h % 5) - i))
        for i in range(6)
        for h in range(60)
    ]
    hourly += [(None, start + dt.timedelta(hours=40), 1.0, 1.0, 1.0)]
    sales = [
        (s, YEAR, c, e, 100.0 * (i + 1) + 10 * j, 1000.0 * (i + 1) + 100 * j, 50000.0 * (j + 1))
        for i, s in enumerate(STATES)
        for j, (c, e) in enumerate((("residential", "cooperative"), ("commercial", "municipal"), ("industrial", "municipal"), ("transportation", "municipal")))
    ]
    sales += [("TX", dt.date(2023, 1, 1), "residential", "cooperative", 9e9, 9e9, 9e9)]
    return {
        "out_eia923__monthly_generation_fuel_combined": generation,
        "out_eia__monthly_generators": generators,
        "out_eia930__hourly_operations": hourly,
        "out_eia923__monthly_fuel_receipts_costs": receipts,
        "raw_eia861__yearly_sales": sales,
        "raw_eia861__yearly_reliability": [(s, dt.date(2020 + i % 3, 1, 1), "ieee_standard", 100.0 - 10 * i, 5.0) for i, s in enumerate(STATES[:5])],
        "raw_eia861__yearly_energy_efficiency": [(i, s, YEAR, 10.0 * (i + 1), 1.0) for i, s in enumerate(STATES)],
        "raw_eia861__yearly_demand_response": [(i, s, YEAR, 3.0, 2.0) for i, s in enumerate(STATES) if i % 2],
        "raw_eia860__storage_generators": [(10 * i, YEAR, 5.0 * (i + 1), True, False, None, None, True) for i in (0, 2, 4)],
        "raw_dc_metrics": [(s, 10 * (i + 1), 0.3 * i if i else None, 1.0, 2.0 * i, 10.0, i % 2, None, 0, "hub", "op") for i, s in enumerate(STATES[:5])],
        "market_structure_ref": [
            ("TX", "ERCOT", "deregulated", 60.0),
            ("CA", "CAISO", "restricted", 12.0),
            ("VA", "PJM", "regulated", None),
            ("DC", "PJM", "deregulated", 50.0),
            ("AK", "non_ISO", "regulated", 0.0),
        ],
        "raw_dsire_incentive_scores": [("TX", Decimal("2.25")), ("CA", Decimal("5.00"))],
    }


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("inputs"))
    for name, data in _data().items():
        write_table(spark.createDataFrame(data, SCHEMAS[name]), f"{folder}/{name}.parquet")
    return Models(load_inputs(spark, folder, list(_data())))


GRAINS = {
    "module_a_base": ["state", "fuel_type_code_pudl", "period"],
    "module_a_monthly_metrics": ["state", "fuel_type_code_pudl"],
    "ba_state_mapping": ["balancing_authority_code_eia", "state"],
    "module_a_ramp_rates": ["balancing_authority_code_eia"],
    "module_a_additional_ramps": ["balancing_authority_code_eia"],
    "module_a_hourly_final": ["balancing_authority_code_eia"],
    "module_b_base": ["state", "fuel_type_code_pudl", "period"],
    "module_b_cost_per_mwh": ["state", "fuel_type_code_pudl", "period"],
    "module_b_metrics": ["state", "fuel_type_code_pudl"],
    "module_c_fuel_share": ["state", "fuel_type_code_pudl"],
}


@pytest.mark.parametrize("name", TABLES)
def test_grain(models, name):
    keys = GRAINS.get(name, ["state"])
    df = models[name]
    n = df.count()
    assert n > 0
    assert df.select(*keys).distinct().count() == n
    assert all(str(f.dataType) != "NullType()" for f in df.schema.fields)


def test_unknown_table(models):
    with pytest.raises(KeyError):
        models["module_z"]


def _by_state(df):
    return {r.state: r for r in df.collect()}


def test_scores_rank_lookups_before_the_join(models):
    got = _by_state(models["integration_scores"])
    assert set(got) == set(STATES)
    # SAIDI falls from TX to AK, but AK is left out of the table: four states in five buckets
    assert {s: r.reliability_score for s, r in got.items()} == {
        "TX": Decimal("4.0"),
        "CA": Decimal("3.0"),
        "VA": Decimal("2.0"),
        "DC": Decimal("1.0"),
        "AK": None,
        "US": None,
    }
    # no storage: 1; 'US' is ranked with the states where its table has it
    assert got["CA"].storage_deployment_score == Decimal("1.0") == got["US"].storage_deployment_score
    assert got["US"].regulatory_receptiveness_score == Decimal("5.0")
    assert got["TX"].market_structure_score == Decimal("5.0") and got["US"].market_structure_score is None
    assert got["TX"].incentive_score == Decimal("2.3") and got["VA"].incentive_score is None


def test_a_missing_fuel_cost_scores_one(models):
    base, scores = _by_state(models["integration_base"]), _by_state(models["integration_scores"])
    assert base["CA"].gas_coal_spread is None and base["TX"].gas_coal_spread is not None
    assert base["TX"].oil_avg_cost_per_mwh is None and scores["TX"].oil_coal_spread is None
    assert all(r.cost_volatility_score is not None for r in scores.values())


def test_final_grid_counts_missing_scores_as_zero(models):
    scores = _by_state(models["integration_scores"])
    final = _by_state(models["integration_final_grid"])
    from statewatt.plans.integration import GRID_DIMENSIONS

    for state, row in final.items():
        total = sum(Decimal(str(scores[state][d] or 0)) for d in GRID_DIMENSIONS)
        assert row.composite_score == (total / 11).quantize(Decimal("0.01"), "ROUND_HALF_UP")
    ranks = sorted(r.opportunity_rank for r in final.values())
    assert ranks[0] == 1 and len(final) == 6


def test_residential_ranks_after_the_joins(models):
    got = _by_state(models["module_e_residential_score"])
    # AK is excluded by the market, US by the structure reference: four states are ranked
    assert set(got) == {"TX", "CA", "VA", "DC"}
    assert [got[s].residential_market_size_score for s in ("TX", "CA", "VA", "DC")] == [1, 2, 3, 4]
    final = _by_state(models["integration_final_residential"])
    assert final["TX"].business_model == config.RETAIL_DIRECT == final["DC"].business_model
    assert final["CA"].business_model == config.RETAIL_PARTNERSHIP
    assert final["VA"].business_model == config.UTILITY_ONLY
    assert "—" in config.RETAIL_LIMITED and "—" in config.RETAIL_PARTNERSHIP and "—" in config.CENTER_PIPELINE


def test_business_models_and_overrides(models):
    centers = _by_state(models["module_f_dc_score"])
    assert centers["VA"].dc_growth_flag == "High" and centers["CA"].dc_growth_flag == "Medium"
    final = _by_state(models["integration_final_ci"])
    # AK is in this model, but it has no reliability score
    assert set(final) == {"TX", "CA", "VA", "DC", "AK"}
    assert final["AK"].ci_composite_score is None
    assert final["AK"].opportunity_rank == 5
    assert final["VA"].ci_access_score == 1


def test_the_null_area_stays_apart(models):
    hourly = {r.balancing_authority_code_eia: r for r in models["module_a_hourly_final"].collect()}
    assert hourly[None].avg_ramp_rate_mwh is None and hourly[None].null_count == 2
    assert hourly["B0"].null_count == 0
    assert "DC" in _by_state(models["module_a2_state_hourly_metrics"])


def test_fan_out_option(models):
    kept = models["module_a_base"].agg(F.sum("monthly_gen_mwh")).first()[0]
    once = Models(models.inputs, fanout="dedup")["module_a_base"].agg(F.sum("monthly_gen_mwh")).first()[0]
    assert once <= kept


def test_tables_can_be_kept_by_name(models, spark, tmp_path):
    seen = []

    def keep(name, df):
        seen.append(name)
        write_table(df, f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    again = Models(models.inputs, keep)
    got = again["integration_final_grid"].select("state", "composite_score")
    assert got.exceptAll(models["integration_final_grid"].select("state", "composite_score")).count() == 0
    assert seen == ["module_a_base", "module_a_monthly_metrics", "module_b_metrics", "integration_base", "integration_scores"]


def _square(x, y, w):
    return [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]


def test_facilities_from_files_to_files(spark, tmp_path, rows):
    import json

    def land(kind, name, state, *squares):
        return {"type": "Feature", "properties": {"TYPE": kind, "NAME": name, "STATE": state}, "geometry": {"type": "MultiPolygon", "coordinates": [[s] for s in squares]}}

    features = [
        land("COOPERATIVE", "Alpha Electric Coop", "TX", _square(0, 0, 4), _square(10, 0, 2)),
        land("Cooperative", "Beta Power Assn", "TX", _square(2, 2, 4)),
        land("MUNICIPAL", "City", "TX", _square(-50, -50, 100)),
        land("COOPERATIVE", "Zzzzzz", "OK", _square(20, 0, 4)),
    ]
    (tmp_path / "lands.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "atlas.csv").write_text(
        "id,lat,lon,sqft\na,1,1,100\nb,3,3,50.5\nc,5,5,10\nd,1,11,\ne,,1,1\nf,1,21,7\ng,-20,-20,9\nb,3,3,50.5\n,5.5,5.5,3\n,5.2,5.2,4\n"
    )
    utilities = [(1, "ALPHA ELECTRIC COOPERATIVE", "TX"), (1, "Alpha Cooperative Electric", "TX"), (2, "Beta Power Association", "TX"), (None, "Nobody", "TX"), (3, "Gamma", "NM")]
    write_csv(spark.createDataFrame(utilities, SCHEMAS["cooperative_utilities"]).coalesce(1), str(tmp_path / "utilities"))
    listed = read_csv(spark, str(tmp_path / "utilities"), SCHEMAS["cooperative_utilities"], position="position")
    out = facilities_in_territory(
        read_geojson(spark, str(tmp_path / "lands.geojson"), GEO_PROPERTIES, "document"),
        read_csv(spark, str(tmp_path / "atlas.csv"), SCHEMAS["data_center_atlas"], position="position"),
        listed,
    )
    matched = rows(out["territory_matches"], "NAME", "dc_facility_count", "dc_sqft_in_territory", "match")
    # b lies in both territories and counts in the first; ids without a value are one facility that no count sees, with its first row's area
    assert matched == [
        ("Alpha Electric Coop", 3, 150, "ALPHA ELECTRIC COOPERATIVE"),
        ("Beta Power Assn", 1, 13, "BETA POWER ASSOCIATION"),
        ("Zzzzzz", 1, 7, None),
    ]
    counts = territory_report(
        read_geojson(spark, str(tmp_path / "lands.geojson"), GEO_PROPERTIES, "document"),
        read_csv(spark, str(tmp_path / "atlas.csv"), SCHEMAS["data_center_atlas"], position="position"),
        out["territory_matches"],
    )
    assert dict(rows(counts)) == {"inside_rows": 10, "inside_facilities": 6, "outside_rows": 1, "territories": 3, "unmatched_territories": 1}
    assert dict(rows(out["run_counts"])) == {k: v for k, v in dict(rows(counts)).items() if k != "outside_rows"}
    assert rows(out["unmatched_territories"]) == [("Zzzzzz", "OK", 1, 7)]
    assert [r.NAME for r in out["top_territories"].collect()] == ["Alpha Electric Coop", "Beta Power Assn", "Zzzzzz"]
    raw = rows(out["dc_in_coop_territory"], "utility_name_eia", "dc_facility_count")
    assert raw == [("ALPHA ELECTRIC COOPERATIVE", 3), ("Alpha Cooperative Electric", 0), ("Beta Power Association", 1), ("Gamma", 0), ("Nobody", 0)]
    deduped = rows(out["dc_in_coop_territory_deduped"])
    assert deduped == [(1, "ALPHA ELECTRIC COOPERATIVE", "TX", 3, 150), (2, "Beta Power Association", "TX", 1, 13), (3, "Gamma", "NM", 0, 0)]
    write_csv(out["dc_in_coop_territory_deduped"], str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out"), out["dc_in_coop_territory_deduped"].schema).count() == 3


def test_reports_are_ordered(models):
    ranks = [r.opportunity_rank for r in models.report("integration_final_grid").collect()]
    assert ranks == sorted(ranks)
    assert set(REPORT_ORDER) <= set(TABLES)
    for name in ("module_b_cost_spread", "module_f_dc_score", "module_a_hourly_final", "module_a_base"):
        assert models.report(name).count() == models[name].count()


def test_the_first_row_of_a_facility_counts(spark):
    ring = lambda x: [[[(x, 0.0), (x + 4.0, 0.0), (x + 4.0, 4.0), (x, 4.0)]]]
    shape = "ordinal long, properties struct<TYPE: string, NAME: string, STATE: string>, polygons array<array<array<struct<x: double, y: double>>>>"
    lands = spark.createDataFrame([(0, ("COOPERATIVE", "P0", "TX"), ring(0.0)), (1, ("COOPERATIVE", "P1", "TX"), ring(10.0))], shape)
    atlas = spark.createDataFrame([("a", 1.0, 11.0, 20.0, 0), ("a", 1.0, 1.0, 10.0, 1)], "id string, lat double, lon double, sqft double, position long")
    got = [tuple(r) for r in facilities_by_territory(lands, atlas).collect()]
    assert got == [("P1", "TX", 1, 20)]


def test_a_run_without_facilities_counts_none(spark):
    shape = "ordinal long, properties struct<TYPE: string, NAME: string, STATE: string>, polygons array<array<array<struct<x: double, y: double>>>>"
    atlas = spark.createDataFrame([("a", 1.0, 1.0, 20.0, 0)], "id string, lat double, lon double, sqft double, position long")
    utilities = spark.createDataFrame([(1, "A", "TX", 0)], "utility_id_eia int, utility_name_eia string, state string, position long")
    out = facilities_in_territory(spark.createDataFrame([], shape), atlas, utilities)
    assert {r.metric: r.value for r in out["run_counts"].collect()} == {"inside_rows": 0, "inside_facilities": 0, "territories": 0, "unmatched_territories": 0}
    assert out["unmatched_territories"].count() == out["top_territories"].count() == 0


def test_published_values():
    assert (config.RENEWABLE, config.VARIABLE_RENEWABLE, config.FOSSIL) == (["solar", "wind", "hydro"], ["solar", "wind"], ["gas", "coal", "oil"])
    assert config.NON_CONTIGUOUS == ["AK", "HI", "PR"]
    assert config.CUSTOMER_CLASSES == ["residential", "commercial", "industrial"] and config.BUSINESS_CLASSES == ["commercial", "industrial"]
    assert config.RESIDENTIAL_ACCESS == [
        (["TX", "OH", "PA", "IL", "NH", "RI", "MA"], 5),
        (["NY", "NJ", "MD", "CT", "ME", "DC"], 4),
        (["DE"], 3),
        (["OR", "NV", "CA"], 2),
    ]
    assert config.WHOLESALE_COMPLEXITY == [(["ERCOT"], 5), (["PJM", "MISO", "NYISO", "ISO_NE"], 3)]
