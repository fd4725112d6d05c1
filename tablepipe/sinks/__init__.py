from .tables import (write_table, create_target, read_target, check_target, target_exists,  # noqa: F401
                     write_report, write_jdbc, TargetExists, SPARK_MODE)
