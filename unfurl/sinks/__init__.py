from .files import CSV_OPTIONS, write_csv, write_parquet, write_single_csv
from .outcomes import Outcomes, write_outcomes
from .versions import drop_old_versions, read_current, replace_table, roll_back

__all__ = ["CSV_OPTIONS", "Outcomes", "drop_old_versions", "read_current", "replace_table", "roll_back", "write_csv", "write_outcomes", "write_parquet", "write_single_csv"]
