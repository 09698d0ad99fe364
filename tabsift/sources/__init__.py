from tabsift.sources.tables import nan_to_null, read_columns, read_table, table_info
from tabsift.sources.sinks import (
    log_run,
    read_stage,
    write_evaluation,
    write_feature_report,
    write_stage,
)

__all__ = [
    "log_run",
    "nan_to_null",
    "read_columns",
    "read_stage",
    "read_table",
    "table_info",
    "write_evaluation",
    "write_feature_report",
    "write_stage",
]
