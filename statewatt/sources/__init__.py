from statewatt.sources.geojson import feature_filter, features_from_text, read_geojson, write_geojson
from statewatt.sources.jdbc import read_jdbc, write_jdbc
from statewatt.sources.metrics import counted
from statewatt.sources.schemas import SCHEMAS
from statewatt.sources.tables import load_inputs, load_table, read_csv, with_file_position, write_csv, write_stage, write_table

__all__ = [
    "SCHEMAS",
    "counted",
    "feature_filter",
    "features_from_text",
    "load_inputs",
    "load_table",
    "read_csv",
    "read_geojson",
    "read_jdbc",
    "with_file_position",
    "write_csv",
    "write_geojson",
    "write_jdbc",
    "write_stage",
    "write_table",
]
