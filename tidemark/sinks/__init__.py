from .catalog import create_managed, create_schema, describe_kv, drop_table, register_external
from .files import land_batch, land_increment, write_delimited, write_json, write_parquet
from .jdbc import write_jdbc

__all__ = [
    "create_managed", "create_schema", "describe_kv", "drop_table", "land_batch", "land_increment",
    "register_external", "write_delimited", "write_jdbc", "write_json", "write_parquet",
]
