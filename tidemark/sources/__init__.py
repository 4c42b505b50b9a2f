from .files import read_csv, read_extract, read_parquet, read_table
from .rows import from_pandas, from_rows

__all__ = ["from_rows", "from_pandas", "read_csv", "read_parquet", "read_extract", "read_table"]
