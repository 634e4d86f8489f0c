from .export import export_attributes, export_lines, export_rejects, read_export, read_table, unnest_typed

__all__ = ["export_attributes", "export_lines", "export_rejects", "read_export", "read_table", "unnest_typed"]
