"""unfurl: spec-driven flattening of semi-structured payload columns on Spark.

A flatten is declared as data (:mod:`unfurl.plans.spec`) and compiled to
built-in Spark expressions (Variant for JSON, ``from_xml`` for XML).
"""

from .functions import json_leaf_text, parse_json_strict
from .operators.census import path_census, spec_from_census, unread_paths
from .operators.json_flatten import flatten_json, json_outcomes, json_rejects
from .operators.xml_flatten import flatten_xml, xml_outcomes, xml_rejects
from .operators.relational import apply_mapping, map_to_columns, previous_day, sql_file, sql_over
from .plans.catalog import BM, BM_XML, CEP_XML, SCAN, SPECS
from .plans.spec import FlattenSpec, Group
from .sinks.files import write_csv, write_parquet, write_single_csv
from .sinks.outcomes import Outcomes, write_outcomes
from .sinks.versions import replace_table
from .sources.export import read_export, read_table, unnest_typed

__all__ = [
    "BM", "BM_XML", "CEP_XML", "SCAN", "SPECS", "FlattenSpec", "Group",
    "Outcomes", "apply_mapping", "flatten_json", "json_outcomes", "write_outcomes", "xml_outcomes", "json_leaf_text", "parse_json_strict", "flatten_xml", "json_rejects", "map_to_columns", "path_census", "previous_day", "spec_from_census", "unread_paths",
    "replace_table", "read_export", "read_table", "sql_file", "sql_over", "unnest_typed", "write_csv", "write_parquet",
    "write_single_csv", "xml_rejects",
]
