"""The command line builds the right settings and runs jobs."""

import json

import pytest

from rows import many, zones
from tierline import __main__ as cli
from tierline.sources.tables import read_gold
from tierline.trips import RAW_SCHEMA, RAW_SCHEMA_OLDER


def test_settings():
    args = cli.parser().parse_args(
        "silver --raw a --raw-older b --zones z --period 2024-2 --period none "
        "--max-year 2030 --run-ts 2024-07-01 --null-rate-limit 0.1".split()
    )
    cfg = cli.config(args)
    assert [(i.path, i.file_schema) for i in cfg.raw] == [("a", RAW_SCHEMA), ("b", RAW_SCHEMA_OLDER)]
    assert cfg.periods == (("2024", "02"), (None, None))
    assert cfg.rules[0].name == "pickup_year_out_of_range(2019-2030)"
    assert (cfg.run_ts, cfg.null_rate_limit) == ("2024-07-01", 0.1)
    assert cli.config(cli.parser().parse_args(["gold"])).periods is None


@pytest.mark.parametrize(
    "line, missing",
    [
        ("gold --silver s", "--gold"),
        ("bronze --bronze b", "--raw"),
        ("backfill --zones z --bronze b --silver s --quarantine q --gold g --months 0", "--months"),
        ("pipeline", "--raw"),
    ],
)
def test_missing_paths_are_refused_before_a_session_starts(line, missing, capsys, monkeypatch):
    monkeypatch.setattr(cli, "SparkSession", None)
    with pytest.raises(SystemExit):
        cli.main(line.split())
    assert missing in capsys.readouterr().err


def test_pipeline_from_the_command_line(spark, tmp_path, capsys):
    many(spark, 40, PULocationID="id % 4", total_amount="id").write.parquet(str(tmp_path / "raw"))
    zones(spark).write.option("header", True).csv(str(tmp_path / "zones"))
    paths = [
        part
        for name in ("raw", "zones", "bronze", "silver", "quarantine", "gold")
        for part in (f"--{name}", str(tmp_path / name))
    ]
    cli.main(["pipeline", *paths, "--database", "from_cli"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["silver"] == 40
    assert read_gold(spark, str(tmp_path / "gold"), "payment_type_summary").count() == 1
    cli.main(["register", *paths, "--database", "from_cli"])
    assert spark.sql("SELECT sum(total_trips) FROM from_cli.hourly_demand").first()[0] == 40
    cli.main(["backfill", *paths, "--database", "from_cli", "--months", "2"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["silver"] == 40
    cli.main(["drift", *paths])
    assert "retyped" not in capsys.readouterr().out
