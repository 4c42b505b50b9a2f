from .files import append_if_any, insert_rows, save_table, write_csv, write_parquet
from .jdbc import jdbc_options, jdbc_url, write_jdbc

__all__ = ["write_parquet", "write_csv", "save_table", "insert_rows", "append_if_any", "jdbc_options", "jdbc_url", "write_jdbc"]
