from .incremental import incremental_ingest, read_ingested, split_into_files, frozen_plan, BATCH_COL, STREAM_COL  # noqa: F401
from .incremental import files_per_trigger  # noqa: F401
