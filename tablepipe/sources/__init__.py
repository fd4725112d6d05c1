from .files import read_table, read_csv, write_csv, head, row_counts, table_format  # noqa: F401
from .jdbc import read_jdbc  # noqa: F401
