from __future__ import annotations

import shutil

from kpiloom import cli
from kpiloom.registry import SHIPPED, Registry


def test_scaffold_adds_a_vendor_once(tmp_path):
    shutil.copy(SHIPPED / "amf.yaml", tmp_path / "amf.yaml")
    scenarios = tmp_path / "s"
    scenarios.mkdir()
    assert len(cli.scaffold(tmp_path, scenarios, "amf", "newco")) == 2
    assert cli.scaffold(tmp_path, scenarios, "amf", "newco") == []
    added = Registry.load(tmp_path).namespaces["ran.amf"].mappings["newco"]
    assert added["registration.attempt_count"].kind == "counter" and "registration.success_rate" not in added


def test_listing(capsys):
    assert cli.main(["list-scenarios"]) == 0
    assert "alarm_storm" in capsys.readouterr().out
    assert cli.main(["version"]) == 0
