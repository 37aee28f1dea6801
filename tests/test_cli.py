"""The command line runs the configured jobs in-process."""

from __future__ import annotations

import json

import pytest

from conformkit.cli import main, parse_measure
from conformkit.specs import MeasureSpec, SpecError


def test_parse_measure():
    assert parse_measure("total=sum:mark") == MeasureSpec("total", "sum", "mark")
    assert parse_measure("n=count_star") == MeasureSpec("n", "count_star", None)
    with pytest.raises(SpecError):
        parse_measure("nonsense")


def test_mapping_from_the_command_line(spark, write_text_file, tmp_path, capsys):
    a = write_text_file("a.csv", "id,v\n1,10\n1,5\n")
    cfg = {"data_sources": [{"source_name": "A", "path": a, "transformations": [
        {"column_name": "source_key", "expression": "'A'"}]}],
        "output_path": str(tmp_path / "out")}
    path = write_text_file("m.json", json.dumps(cfg))
    assert main(["mapping", path, "--key", "source_key", "--key", "id",
                 "--measure", "n=count_star", "--measure", "total=sum:v"], spark=spark) == 0
    assert "15.0" in capsys.readouterr().out
    back = spark.read.csv(str(tmp_path / "out"), header=True).collect()
    assert [(r.source_key, r.id, r.n, r.total) for r in back] == [("A", "1", "2", "15.0")]


def test_services_from_the_command_line(spark, write_text_file, tmp_path, capsys):
    mod = tmp_path / "my_services_mod.py"
    mod.write_text(
        "from conformkit.plans.jobs import JobSpec, service\n"
        "from conformkit.specs import LoadSpec, SourceSpec\n"
        f"@service('cli.copy_region')\n"
        "def _f():\n"
        f"    return JobSpec('copy', SourceSpec('r', '/root/testdata/sf0.001/region.parquet', 'parquet'),"
        f" LoadSpec({str(tmp_path / 'copy')!r}))\n")
    import sys
    sys.path.insert(0, str(tmp_path))
    try:
        cfg = write_text_file("s.json", json.dumps({"services": ["cli.copy_region"]}))
        assert main(["services", cfg, "--run-date", "2024-01-15", "--register", "my_services_mod"],
                    spark=spark) == 0
        assert "full" in capsys.readouterr().out
        ledger = ["services", cfg, "--run-date", "2024-01-15", "--ledger", str(tmp_path / "ledger")]
        for more, done in (([], False), ([], True), (["--force"], False)):
            assert main([*ledger, *more], spark=spark) == 0
            assert ("done before" in capsys.readouterr().out) == done
    finally:
        sys.path.remove(str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 5


def test_clean_from_the_command_line(spark, tmp_path, capsys, monkeypatch):
    from conformkit import session

    monkeypatch.setattr(session, "checkpoint_root", lambda s: str(tmp_path))
    spark.range(1).write.parquet(session.scratch_path(spark, "left"))
    assert main(["clean"], spark=spark) == 0
    assert "deleted" in capsys.readouterr().out and not (tmp_path / "conformkit").exists()
