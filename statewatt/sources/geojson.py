"""GeoJSON features as rows: properties plus a polygon -> ring -> vertex array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from statewatt.operators.ordering import with_position
from statewatt.sources.tables import with_file_position

_VERTICES = "array<array<double>>"  # one ring of [lon, lat] pairs


def _feature_schema(properties: StructType) -> StructType:
    # coordinates nest to a depth that depends on the geometry type, so they
    # are read as text and parsed per type
    geometry = StructType([StructField("type", StringType()), StructField("coordinates", StringType())])
    return StructType(
        [StructField("type", StringType()), StructField("properties", properties), StructField("geometry", geometry)]
    )


def parse_polygons(kind: Column, coordinates: Column) -> Column:
    """Polygon or MultiPolygon coordinates as polygon -> ring -> struct<x, y>."""
    single = F.array(F.from_json(coordinates, f"array<{_VERTICES}>"))
    multi = F.from_json(coordinates, f"array<array<{_VERTICES}>>")
    nested = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multi)

    def vertex(v: Column) -> Column:
        return F.struct(F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y"))

    return F.transform(nested, lambda p: F.transform(p, lambda ring: F.transform(ring, vertex)))


def features_from_text(rows: DataFrame, text: str, ordinal: str, properties: StructType) -> DataFrame:
    """Feature rows from one GeoJSON feature per row. NULL text gives no row; text
    that is no feature, or does not fit the declared properties, fails the job."""
    schema = _feature_schema(properties).add("_broken", StringType())
    parsed = rows.select(
        F.col(ordinal).cast("long").alias("ordinal"),
        F.col(text).alias("feature"),
        F.from_json(text, schema, {"columnNameOfCorruptRecord": "_broken"}).alias("_f"),
    )
    kind, coordinates = F.col("_f.geometry.type"), F.col("_f.geometry.coordinates")
    sound = F.coalesce((F.col("_f.type") == "Feature") & F.col("_f._broken").isNull(), F.lit(False))
    failure = F.raise_error(F.concat(F.lit("not a GeoJSON feature: "), F.substring("feature", 1, 100)))
    return parsed.filter(F.col("feature").isNotNull() & F.when(sound, F.lit(True)).otherwise(failure.cast("boolean"))).select(
        "ordinal",
        F.col("_f.properties").alias("properties"),
        kind.alias("geometry_type"),
        coordinates.alias("coordinates"),
        parse_polygons(kind, coordinates).alias("polygons"),
        "feature",
    )


#: Lines of a collection that hold no feature: brackets, its other members, its
#: first line. A feature spread over lines, or all on one line, is not among them.
_FRAME = (
    r'^(?:[\[\]{}\s]*|"(?!type"\s*:\s*"Feature"\s*$).*|'
    r'\{\s*"type"\s*:\s*"FeatureCollection"(?!.*"features"\s*:\s*\[\s*\{).*)$'
)


#: Names of the two coordinate systems, as converters write them.
_SRIDS = {4326: r"(?:CRS84|EPSG:+4326)$", 3857: r"EPSG:+(?:3857|900913)$"}


def _agrees(crs: Column, srid: int) -> Column:
    """Whether a ``crs`` member (text; NULL if there is none) names ``srid``; fails if another."""
    name = F.get_json_object(crs, "$.properties.name")
    none = crs.isNull() | (F.btrim(crs) == "null")
    failure = F.raise_error(F.concat(F.lit(f"the file's crs is not {srid}: "), F.substring(crs, 1, 200)))
    return F.when(none | F.coalesce(name.rlike("(?i)" + _SRIDS[srid]), F.lit(False)), F.lit(True)).otherwise(failure.cast("boolean"))


def read_geojson(spark: SparkSession, path: str, properties: StructType, layout: str = "lines", srid: int | None = None) -> DataFrame:
    """Rows (ordinal, properties, geometry_type, coordinates, polygons, feature).

    ``layout='lines'`` reads one feature per line, as newline-delimited
    GeoJSON or as written inside a collection by common converters; such files
    split over tasks. ``'document'`` reads FeatureCollection documents, each
    by one task, so convert a large one to lines first. ``ordinal`` is the
    feature's place in the input: files by path, features as they stand in them.
    ``feature`` is its text, with the members and properties that are not
    declared. A line or element that is no feature fails the read.

    With ``srid`` (4326 or 3857) the read also fails if a collection's ``crs`` member
    names another system; one without the member is taken to be as declared.
    With ``'lines'`` the member has to stand on one line, as converters write it.
    """
    if srid is not None and srid not in _SRIDS:
        raise ValueError(f"srid must be 4326 or 3857, not {srid!r}")
    if layout == "document":
        schema = StructType().add("features", ArrayType(StringType()))
        if srid is not None:
            schema = schema.add("crs", StringType())
        docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
        if srid is not None:
            docs = docs.filter(_agrees(F.col("crs"), srid))
        placed = docs.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("features").alias("_at", "_text"))
        rows = with_position(placed, ["_file", "_at"], "_pos")
    elif layout == "lines":
        text = F.regexp_replace(F.btrim("value", F.lit(" \t\r\ufeff")), r",$", "")
        rows = with_file_position(spark.read.text(path), "_pos").select("_pos", text.alias("_text"))
        feature = ~F.col("_text").rlike(_FRAME)
        if srid is not None:
            crs = F.regexp_extract("_text", r'^\{?(?:\s*"(?:type|name)"\s*:\s*"[^"]*"\s*,)*\s*"crs"\s*:\s*(null|\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\})', 1)
            feature = F.when(feature, F.lit(True)).otherwise((crs != "") & ~_agrees(crs, srid))
        rows = rows.filter(feature)
    else:
        raise ValueError(f"layout must be 'document' or 'lines', not {layout!r}")
    return features_from_text(rows, "_text", "_pos", properties)


def feature_filter(features: DataFrame, kind: str, prop: str = "properties.TYPE") -> DataFrame:
    """Features whose property equals ``kind`` in any letter case; a feature
    without the property is not matched."""
    return features.filter(F.upper(F.coalesce(F.col(prop).cast("string"), F.lit(""))) == kind.upper())


def write_geojson(features: DataFrame, path: str) -> None:
    """One GeoJSON feature per line, written in parallel.

    Features that ``read_geojson`` returned are written as the text they were
    read as. Rows without a ``feature`` column are put together from properties,
    geometry type and coordinates; those without a geometry type have none.
    """
    if "feature" in features.columns:
        text = F.regexp_replace("feature", r"[\r\n]+", " ")
    else:
        geometry = F.concat(F.lit('{"type":"'), F.col("geometry_type"), F.lit('","coordinates":'), F.coalesce("coordinates", F.lit("[]")), F.lit("}"))
        text = F.concat(
            F.lit('{"type":"Feature","properties":'),
            F.coalesce(F.to_json("properties", {"ignoreNullFields": "false"}), F.lit("null")),
            F.lit(',"geometry":'),
            F.coalesce(geometry, F.lit("null")),
            F.lit("}"),
        )
    features.select(text.alias("value")).write.mode("overwrite").text(path)
