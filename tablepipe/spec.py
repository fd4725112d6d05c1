"""Job settings as one plain dataclass (the defaults of the published config)."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from .functions.naming import RENAME_RULES, target_name
from .functions.types import cast_type

IF_EXISTS = ("fail", "append", "replace")


@dataclass
class JobSpec:
    input_path: str = ""
    input_format: str | None = None          # 'csv' / 'parquet'; None -> by suffix
    column_naming: str = "lower"             # lower | upper | capitalize
    date_format: bool = True                 # T3/T4 on or off (really off when False)
    data_type: dict[str, str] = field(default_factory=dict)  # cast map (T2)
    decimal_precision: int | None = None     # T6 rounding; None leaves floats alone
    date_columns: list[str] | None = None    # freeze T3's result (no detection pass)
    sample_size: float = 1.0                 # share of rows validated (V7), (0, 1]
    sample_keys: list[str] = field(default_factory=list)
    table_name: str = ""
    if_table_exists: str = "fail"            # fail | append | replace
    on_violation: str = "fail"               # fail | report | quarantine
    multiline: bool = False                  # CSV: quoted newlines inside a record
    bad_rows: str = "fail"                   # CSV rows with too many or too few fields: fail | keep

    def __post_init__(self) -> None:
        self.column_naming = (self.column_naming or "lower").lower()
        if self.column_naming not in RENAME_RULES:
            raise ValueError(f"column_naming must be one of {RENAME_RULES}")
        for t in (self.data_type or {}).values():
            cast_type(t)
        if not 0.0 < float(self.sample_size) <= 1.0:
            raise ValueError("sample_size must be in (0, 1]")
        self.if_table_exists = (self.if_table_exists or "fail").lower()
        if self.if_table_exists not in IF_EXISTS:
            raise ValueError(f"if_table_exists must be one of {IF_EXISTS}")
        if self.on_violation not in ("fail", "report", "quarantine"):
            raise ValueError("on_violation must be fail, report or quarantine")
        if self.bad_rows not in ("fail", "keep"):
            raise ValueError("bad_rows must be fail or keep")
        if self.decimal_precision is not None and int(self.decimal_precision) < 0:
            raise ValueError("decimal_precision must be >= 0")

    @classmethod
    def from_config(cls, cfg: dict) -> "JobSpec":
        """Build from the nested config layout users already have:
        ``path.input_path``, ``schema_config.{column_naming, date_format,
        data_type, decimal_precision}``, ``validation_data.sample_size``,
        ``database.{table_name, if_table_exists}``.  ``os_configuration`` is
        single-machine tuning and is ignored.  A ``decimal_precision`` key
        left empty means the documented default of 2."""
        path = cfg.get("path") or {}
        sc = cfg.get("schema_config") or {}
        vd = cfg.get("validation_data") or {}
        db = cfg.get("database") or {}
        precision = sc.get("decimal_precision", None)
        if "decimal_precision" in sc and precision is None:
            precision = 2
        date_format = sc.get("date_format")
        return cls(
            input_path=str(path.get("input_path") or ""),
            multiline=bool(path.get("multiline") or False),
            bad_rows=path.get("bad_rows") or "fail",
            column_naming=sc.get("column_naming") or "lower",
            date_format=True if date_format is None else bool(date_format),
            data_type=dict(sc.get("data_type") or {}),
            decimal_precision=precision,
            sample_size=float(vd.get("sample_size") or 1.0),
            table_name=str(db.get("table_name") or ""),
            if_table_exists=db.get("if_table_exists") or "fail",
        )

    @property
    def target(self) -> str:
        return target_name(self.table_name, self.input_path)

    def csv_options(self) -> dict[str, str]:
        """Reader options of the CSV settings."""
        return {"multiLine": str(self.multiline).lower(), "mode": "FAILFAST" if self.bad_rows == "fail" else "PERMISSIVE"}

    def settings(self) -> dict[str, str]:
        """The settings that must stay equal across loads (V8), as text."""
        d = asdict(self)
        cast_map = d["data_type"] or {}
        return {
            "column_naming": str(d["column_naming"]),
            "date_format": str(bool(d["date_format"])).lower(),
            "data_type": ",".join(sorted(f"{k.lower()}:{v.lower()}" for k, v in cast_map.items())),
            "decimal_precision": "" if d["decimal_precision"] is None else str(int(d["decimal_precision"])),
        }
