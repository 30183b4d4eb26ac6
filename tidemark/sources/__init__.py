from .csv_records import csv_records, read_split_csv
from .files import read_delimited, read_inferred_once, read_json_lines, read_parquet_dir, read_text_lines
from .jdbc import Split, jdbc_split, read_jdbc, read_jdbc_since

__all__ = [
    "Split", "csv_records", "jdbc_split", "read_inferred_once", "read_split_csv", "read_delimited",
    "read_jdbc", "read_jdbc_since", "read_json_lines", "read_parquet_dir", "read_text_lines",
]
