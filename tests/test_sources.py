from __future__ import annotations

import base64
import json

import pytest

from kpiloom.operators.normalize import normalize
from kpiloom.registry import Registry
from kpiloom.sources import scrape


def test_landed_files_become_records_by_instance(spark, tmp_path):
    for i in ("a", "b"):
        (tmp_path / i).mkdir()
        (tmp_path / i / "1.prom").write_text(f'open5gs_amf_registration_total{{status="attempted"}} {len(i) * 7}\nopen5gs_amf_ue_connected 3\n')
    raw = scrape.landed(spark, str(tmp_path), scrape.COLLECTORS.get("open5gs-amf", endpoint="e"))
    rows = normalize(raw, Registry.load()).records.where("kpi_name = 'registration.attempt_count'").collect()
    assert {(r.attributes.nf_instance_id, r.value) for r in rows} == {("a", 7.0), ("b", 7.0)}


def test_bus_messages_round_trip(spark, tmp_path):
    message = {
        "Source": {"Vendor": "open5gs", "NFType": "AMF", "InstanceID": "x", "Endpoint": "e"},
        "Payload": base64.b64encode(b"open5gs_amf_ue_connected 3").decode(),
        "Protocol": "prometheus",
        "Timestamp": "2024-01-01T00:00:00Z",
        "Meta": {"plmn": "1-2", "sst": "1", "sd": "010203"},
        "SchemaVersion": "v1",
    }
    (tmp_path / "p.raw").mkdir()
    (tmp_path / "p.raw" / "f.json").write_text(json.dumps(message))
    rows = scrape.from_bus(scrape.bus(spark, "raw", prefix="p", streaming=False, path=str(tmp_path)))
    r = normalize(rows, Registry.load()).records.where("kpi_name = 'ue.connected_count'").first()
    assert (r.value, r.attributes.plmn_id, r.attributes.slice_id.sst, r.attributes.slice_id.sd) == (3.0, "1-2", 1, "010203")
    with pytest.raises(ValueError):
        scrape.bus(spark, "raw", kind="carrier-pigeon")
