"""Collectors on small files, and the compactors on what they make."""

import json

import pytest
from pyspark.sql import functions as F

from granary.operators import compaction
from granary.sources import collectors, jsonl

yaml = pytest.importorskip("yaml")


def rule(**more):
    return {"id": "r1", "title": "T", "level": "high", "tags": ["attack.t1059.001", "attack.ta0005", "attack.initial-access", "x"], "logsource": {"product": "windows"}, "detection": {"a": 1}, "falsepositives": ["none"], **more}


def test_rules(spark, tmp_path):
    (tmp_path / "a.yml").write_text(yaml.safe_dump_all([rule(), rule(id="r2", level="informational"), {"title": "no id", "level": "low"}, rule(title="again")]))
    (tmp_path / "b.yml").write_text(yaml.safe_dump(rule(title="other file", level="odd")) + "---\n- list\n")
    found = jsonl.yaml_documents(spark, str(tmp_path))
    s = {r.title: r for r in collectors.sigma(found).collect()}
    assert set(s) == {"T", "no id", "again"} and s["no id"].doc_id == "sigma-a"
    meta = json.loads(s["T"].metadata_json)
    assert meta["mitre_attack_ids"] == ["T1059.001", "TA0005"] and meta["mitre_attack_tactics"] == ["initial_access"]
    assert "## Log source\n- **Product**: windows" in s["T"].content_markdown and s["T"].word_count > 5
    h = collectors.hayabusa(found).collect()
    assert [(r.doc_id, r.title) for r in h] == [("hayabusa-r1", "T")]


def test_atomic_tests(spark, tmp_path):
    d = tmp_path / "T1059"
    d.mkdir()
    test = {"name": "N", "auto_generated_guid": "g", "supported_platforms": ["linux"], "input_arguments": {"p": {"description": "a|b", "type": "path", "default": "x"}}, "executor": {"name": "sh", "command": " ls ", "elevation_required": True}}
    (d / "T1059.yaml").write_text(yaml.safe_dump({"attack_technique": "T1059", "display_name": "Shell", "atomic_tests": [test, {"auto_generated_guid": "h"}]}))
    got = {r.doc_id: r for r in collectors.atomic_tests(jsonl.yaml_documents(spark, str(tmp_path))).collect()}
    assert set(got) == {"atomic-rt-g", "atomic-rt-h"} and got["atomic-rt-h"].title == "T1059: T1059 - Test 1"
    assert "| `p` | a\\|b | path | `x` |" in got["atomic-rt-g"].content_markdown and "```sh\nls\n```" in got["atomic-rt-g"].content_markdown


@pytest.fixture
def catalogue(spark, tmp_path):
    entries = [{"cveID": f"CVE-2021-{1000 + k}", "vendorProject": "Acme Inc/X" if k < 30 else "Solo", "product": f"p{k % 3}", "vulnerabilityName": "v", "dateAdded": f"2022-01-{k % 28 + 1:02d}", "dueDate": "2022-03-01", "knownRansomwareCampaignUse": "Known" if k in (0, 7) else "Unknown", "shortDescription": "d " * 150} for k in range(31)]
    (tmp_path / "k.json").write_text(json.dumps({"catalogVersion": "1", "dateReleased": "2024-01-01T00:00:00Z", "vulnerabilities": entries}))
    return jsonl.json_file(spark, str(tmp_path / "k.json"), collectors.KEV)


def test_kev(spark, catalogue):
    got = {r.doc_id: r for r in collectors.kev(catalogue).collect()}
    assert set(got) == {"kev-acme-inc-x", "kev-solo"} and set(r.doc_id for r in collectors.kev(catalogue, 2).collect()) == {"kev-acme-inc-x"}
    m = json.loads(got["kev-acme-inc-x"].metadata_json)
    assert m["cve_count"] == 30 and m["ransomware_linked_count"] == 2 and m["products"] == ["p0", "p1", "p2"]
    one = collectors.kev(catalogue).withColumn("c", compaction.compacted(F.col("source"), F.col("content_markdown"))).filter("doc_id = 'kev-acme-inc-x'").first()
    kept = [int(x[13:17]) - 1000 for x in one.c.split("\n") if x.startswith("### CVE")]
    by_score = sorted(range(30), key=lambda k: (-((10_000 if k in (0, 7) else 0) + k % 28), k))[:20]
    assert kept == sorted(by_score) and len(one.c) < len(one.content_markdown)
    solo = collectors.kev(catalogue).filter("doc_id = 'kev-solo'").select("content_markdown", compaction.kev(F.col("content_markdown")).alias("c")).first()
    assert len(solo.c) <= len(solo.content_markdown)


def test_ossem(spark, tmp_path):
    for k, (v, fields) in enumerate([("1.9", 3), ("1.10", 2), ("2", 1)]):
        (tmp_path / f"e{k}.yml").write_text(yaml.safe_dump({"name": f"n{k}", "event_id": "4624", "event_version": v, "platform": "windows", "log_source": "s", "event_fields": [{"name": f"f{i}", "description": "d"} for i in range(fields)]}))
    (tmp_path / "none.yml").write_text(yaml.safe_dump({"name": "x", "event_fields": []}))
    got = collectors.ossem(jsonl.yaml_documents(spark, str(tmp_path))).collect()
    assert [r.title for r in got] == ["OSSEM: n2"]


def test_attack(spark, tmp_path):
    ref = lambda x: [{"source_name": "mitre-attack", "external_id": x, "url": "u"}]
    objects = [
        {"id": "a1", "type": "attack-pattern", "name": "Shell", "description": "D", "external_references": ref("T1059"), "x_mitre_platforms": ["Linux"], "kill_chain_phases": [{"kill_chain_name": "mitre-attack", "phase_name": "execution"}, {"kill_chain_name": "o", "phase_name": "no"}]},
        {"id": "a2", "type": "attack-pattern", "name": "Sub", "external_references": ref("T1059.001"), "x_mitre_is_subtechnique": True},
        {"id": "a3", "type": "attack-pattern", "name": "Old", "revoked": True, "external_references": ref("T1")},
        {"id": "g", "type": "intrusion-set", "name": "Group"}, {"id": "m", "type": "course-of-action", "name": "Block"}, {"id": "s", "type": "x-strategy", "name": "Watch", "x_mitre_analytic_refs": ["n1", "n2"]}, {"id": "n1", "type": "x-analytic", "description": "One."}, {"id": "n2", "type": "x-analytic", "description": "Two."},
        {"id": "r1", "type": "relationship", "relationship_type": "uses", "source_ref": "g", "target_ref": "a1", "description": "ran it"}, {"id": "r2", "type": "relationship", "relationship_type": "mitigates", "source_ref": "m", "target_ref": "a1", "description": "blocks"},
        {"id": "r3", "type": "relationship", "relationship_type": "detects", "source_ref": "s", "target_ref": "a1"}, {"id": "r4", "type": "relationship", "relationship_type": "subtechnique-of", "source_ref": "a2", "target_ref": "a1"},
    ]
    (tmp_path / "e.json").write_text(json.dumps({"objects": objects}))
    got = {r.doc_id: r for r in collectors.attack(jsonl.json_file(spark, str(tmp_path / "e.json"), collectors.STIX)).collect()}
    assert set(got) == {"mitre-attack-T1059", "mitre-attack-T1059.001"}
    body = got["mitre-attack-T1059"].content_markdown
    assert "**Tactics**: execution\n" in body and "- **Group**: ran it" in body and "- **Block**: blocks" in body and "- **Watch**: One. Two." in body
    assert json.loads(got["mitre-attack-T1059.001"].metadata_json)["parent_technique"] == "T1059"


def test_sections(spark):
    t = "intro\n## A\none\n```\ncode " + "x" * 200 + "\n```\n## B\ntwo\n## A\nthree"
    r = spark.createDataFrame([(t,)], "t string").select(compaction.headed(F.col("t")).alias("h"), compaction.body(compaction.headed(F.col("t")), "A").alias("a")).first()
    assert [x.heading for x in r.h] == [None, "A", "B", "A"] and r.a.endswith("\n\nthree")
