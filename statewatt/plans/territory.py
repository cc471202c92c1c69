"""Facilities inside cooperative territories, attached to the utility list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from statewatt.operators import (
    attach_matches,
    dedup_collapse,
    dedup_first,
    fuzzy_best_match,
    normalise_crs,
    spatial_join,
    territory_rollup,
)
from statewatt.plans import config as c
from statewatt.session import stored
from statewatt.sources import counted, feature_filter

COUNT, AREA = "dc_facility_count", "dc_sqft_in_territory"


def _located(features: DataFrame, atlas: DataFrame, srid: int, how: str) -> DataFrame:
    lands = feature_filter(features, c.TERRITORY_TYPE).select("ordinal", "properties.NAME", "properties.STATE", "polygons")
    lands = normalise_crs(lands, srid, geometry="polygons")
    points = atlas.dropna(subset=["lat", "lon"])
    return spatial_join(points, lands, "lon", "lat", "polygons", ["ordinal", "NAME", "STATE"], how)


def _one_territory_each(inside: DataFrame, order: str) -> DataFrame:
    return dedup_first(inside.filter(F.col("NAME").isNotNull()), "id", [order, "ordinal"])


def facilities_by_territory(
    features: DataFrame, atlas: DataFrame, order: str = "position", srid: int = 4326
) -> DataFrame:
    """Facility count and area per territory (NAME, STATE).

    Territories are narrowed to cooperatives before the join. A facility counts
    once: by its first row in the atlas, whose place ``order`` tells, that lies
    in a territory, and there in the first feature around it. Facilities outside
    all of them matter to the run report alone, so this join is inner.
    """
    return _counted_by_territory(features, atlas, order, srid)[0]


def _counted_by_territory(features: DataFrame, atlas: DataFrame, order: str, srid: int) -> tuple[DataFrame, dict[str, Observation]]:
    """The roll-up, and what its run counts on the way."""
    inside = _located(features, atlas, srid, "inner").filter(F.col("NAME").isNotNull())
    inside, rows = counted(inside, "inside_rows")
    each, facilities = counted(_one_territory_each(inside, order), "inside_facilities")
    territories = territory_rollup(each, ["NAME", "STATE"], "id", "sqft", COUNT, AREA)
    return territories, {"inside_rows": rows, "inside_facilities": facilities}


def _as_metrics(counts: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("value")) for n in counts.columns]
    return counts.select(F.inline(F.array(*pairs)))


def territory_report(features: DataFrame, atlas: DataFrame, matched: DataFrame, srid: int = 4326) -> DataFrame:
    """Run counts as (metric, value) rows: facilities inside before and after
    each is given one territory, those outside, territories in use, and
    territory names without a match."""
    located = _located(features, atlas, srid, "left")
    known = F.col("NAME").isNotNull()
    per_id = located.groupBy("id").agg(F.count_if(known).alias("_in"), F.count_if(~known).alias("_out"))
    facilities = per_id.agg(
        F.coalesce(F.sum("_in"), F.lit(0)).alias("inside_rows"),
        F.count_if(F.col("_in") > 0).alias("inside_facilities"),
        F.coalesce(F.sum("_out"), F.lit(0)).alias("outside_rows"),
    )
    names = matched.agg(
        F.count(F.lit(1)).alias("territories"), F.count_if(F.col("match").isNull()).alias("unmatched_territories")
    )
    return _as_metrics(facilities).union(_as_metrics(names))


def facilities_in_territory(
    features: DataFrame,
    atlas: DataFrame,
    utilities: DataFrame,
    order: str = "position",
    srid: int = 4326,
) -> dict[str, DataFrame]:
    """Utility list with facility counts, raw and collapsed per utility.

    ``order`` is a row's place in the atlas and in the utility list. In the
    atlas it decides which row of a repeated facility counts; in the list it
    breaks fuzzy ties and decides which name and state a repeated utility keeps.

    ``run_counts`` holds what the run that fills the tables counted by itself, as
    (metric, value) rows; ``unmatched_territories`` and ``top_territories``, the ten
    with most facilities, are read from its small result. Facilities outside all
    territories need a join of their own: see ``territory_report``.
    """
    # both are one row per territory; the join and the scoring run once for all outputs
    counts, watches = _counted_by_territory(features, atlas, order, srid)
    territories = stored(counts)
    found = fuzzy_best_match(territories, "NAME", utilities, "utility_name_eia", order, c.MATCH_THRESHOLD)
    found, watch = counted(found, "territories", unmatched_territories=F.count_if(F.col("match").isNull()))
    matched = stored(found)
    metrics = dict.fromkeys([*watches, "territories", "unmatched_territories"], 0)
    if not territories.isEmpty():  # of an empty plan the observed stages may be optimised away
        metrics |= {name: w.get["rows"] for name, w in watches.items()}
        metrics |= {"territories": watch.get["rows"], "unmatched_territories": watch.get["unmatched_territories"]}
    in_order = [F.col(COUNT).desc(), F.col(AREA).desc_nulls_last(), F.col("NAME"), F.col("STATE")]
    raw = attach_matches(utilities, "utility_name_eia", matched, "match", [COUNT, AREA])
    collapsed = dedup_collapse(raw, "utility_id_eia", ["utility_name_eia", "state"], [COUNT, AREA], [order])
    return {
        "territory_matches": matched,
        "dc_in_coop_territory": raw.select("utility_id_eia", "utility_name_eia", "state", COUNT, AREA),
        "dc_in_coop_territory_deduped": collapsed,
        "run_counts": features.sparkSession.createDataFrame(list(metrics.items()), "metric string, value long"),
        "unmatched_territories": matched.filter(F.col("match").isNull()).select("NAME", "STATE", COUNT, AREA),
        "top_territories": matched.orderBy(*in_order).limit(10),
    }
