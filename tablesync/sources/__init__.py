from .archives import expand_archives, expand_members
from .catalog import catalog_columns, read_table
from .connections import Connections, UnknownServer
from .files import load_new_files, read_csv_strings, read_files, read_parquet_tree, read_whole_text
from .jdbc import export_tree, read_jdbc, text_splits, write_jdbc
from .runlog import parse_log_lines, parse_run_logs
from .splits import even_bounds, even_predicates

__all__ = [
    "Connections", "UnknownServer", "catalog_columns", "expand_archives", "expand_members",
    "even_bounds", "even_predicates", "export_tree", "load_new_files", "parse_log_lines", "parse_run_logs", "read_csv_strings", "read_files", "read_jdbc",
    "read_parquet_tree", "read_table", "read_whole_text", "text_splits", "write_jdbc",
]
