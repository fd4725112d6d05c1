"""Config layout and the command line."""

import json

from tablepipe.__main__ import main
from tablepipe.spec import JobSpec

CONFIG = """
path:
  input_path: '/root/testdata/sf0.001/orders.parquet'
schema_config:
  column_naming: 'upper'
  date_format: True
  data_type:
    o_custkey: int32
  decimal_precision:
validation_data:
    sample_size: 0.5
os_configuration:
  os_margin: 0.3
  n_rows_sample: 10
database:
  table_name: ''
  if_table_exists: 'replace'
"""


def test_from_config_layout():
    import yaml
    spec = JobSpec.from_config(yaml.safe_load(CONFIG))
    assert spec.column_naming == "upper" and spec.data_type == {"o_custkey": "int32"}
    assert spec.decimal_precision == 2 and spec.sample_size == 0.5
    assert spec.if_table_exists == "replace" and spec.target == "orders"
    assert JobSpec.from_config({}).decimal_precision is None


def test_cli_load_sql_plan(spark, tmp_dir, capsys):
    cfg = f"{tmp_dir}/config.yml"
    with open(cfg, "w") as f:
        f.write(CONFIG)
    target = f"{tmp_dir}/orders_out"
    main(["load", cfg, "--contracts", f"{tmp_dir}/contracts", "--target", target], spark=spark)
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["rows_written"] == 1500 and rep["contract_created"] is True
    assert spark.read.parquet(target).columns[0] == "O_ORDERKEY"
    main(["sql", "SELECT count(*) AS n FROM o", "--table", f"o={target}"], spark=spark)
    assert "1500" in capsys.readouterr().out
    main(["plan", "--budget", "1000000", "nation=/root/testdata/sf0.001/nation.parquet"], spark=spark)
    assert json.loads(capsys.readouterr().out.strip())["decision"] == "eager"


def test_recommended_conf():
    from tablepipe.session import recommended_conf
    small = recommended_conf(600e6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 ** 2)
    big = recommended_conf(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 524288      # 100 TiB / 200 MiB
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_config_formats(tmp_dir):
    from tablepipe.__main__ import read_config
    with open(f"{tmp_dir}/c.json", "w") as f:
        json.dump({"schema_config": {"column_naming": "capitalize"}, "database": {"table_name": "x"}}, f)
    with open(f"{tmp_dir}/c.toml", "w") as f:
        f.write('[schema_config]\ncolumn_naming = "upper"\ndate_format = false\n[database]\nif_table_exists = "append"\n')
    j = JobSpec.from_config(read_config(f"{tmp_dir}/c.json"))
    t = JobSpec.from_config(read_config(f"{tmp_dir}/c.toml"))
    assert (j.column_naming, j.target) == ("capitalize", "x")
    assert (t.column_naming, t.date_format, t.if_table_exists) == ("upper", False, "append")


def test_cli_check_dry_run(spark, tmp_dir, capsys):
    cfg = f"{tmp_dir}/config.yml"
    with open(cfg, "w") as f:
        f.write(CONFIG)
    contracts = f"{tmp_dir}/contracts"
    assert main(["check", cfg, "--contracts", contracts], spark=spark) == 0
    assert "no_contract_yet" in capsys.readouterr().out
    main(["load", cfg, "--contracts", contracts, "--target", f"{tmp_dir}/o"], spark=spark)
    capsys.readouterr()
    assert main(["check", cfg, "--contracts", contracts], spark=spark) == 0
    assert capsys.readouterr().out.strip() == ""
    with open(cfg, "w") as f:
        f.write(CONFIG.replace("column_naming: 'upper'", "column_naming: 'lower'"))
    assert main(["check", cfg, "--contracts", contracts], spark=spark) == 1
    assert "setting_changed" in capsys.readouterr().out
