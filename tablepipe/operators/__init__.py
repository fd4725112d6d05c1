from .rename import rename_columns  # noqa: F401
from .cast import cast_columns, cast_probe, safe_cast, flag_cast_failures, resolve_cast_map, REJECT_REASON  # noqa: F401
from .dates import (date_detection_report, detect_date_columns, parse_date_columns,  # noqa: F401
                    widen_date_columns, clean_dates, string_columns)
from .rounding import round_floats  # noqa: F401
from .clean import clean, clean_with  # noqa: F401
from .contract import (capture_contract, check_contract, split_by_contract, enforce,  # noqa: F401
                       catalog_schema_drift, settings_drift, observed_schema, ensure_contract,
                       load_contracts, save_contract, latest, evolve_contract, ContractViolation,
                       CONTRACT_SCHEMA)
from .sample import keyed_sample, head_rows, head_fraction, validation_rows, key_hash32  # noqa: F401
