from .census import path_census, spec_from_census, unread_paths
from .json_flatten import flatten_json, json_outcomes, json_rejects
from .xml_flatten import flatten_xml, xml_outcomes, xml_rejects
from .relational import apply_mapping, map_to_columns, previous_day, sql_file, sql_over

__all__ = [
    "apply_mapping", "flatten_json", "flatten_xml", "json_outcomes", "json_rejects", "map_to_columns", "path_census", "previous_day", "spec_from_census", "unread_paths",
    "sql_file", "sql_over", "xml_outcomes", "xml_rejects",
]
