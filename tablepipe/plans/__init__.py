from .query import register_tables, register_dir, run_sql, register_jdbc_catalog, avg_by_group  # noqa: F401
from .load import run_load  # noqa: F401
