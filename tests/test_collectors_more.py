"""The further collectors on small files."""

import json

import pytest

from granary.sources import collectors, jsonl
from granary.sources import collectors_more as M

yaml = pytest.importorskip("yaml")


def put(folder, files):
    for name, data in files.items():
        p = folder / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(data if isinstance(data, str) else yaml.safe_dump(data))
    return str(folder)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_kape(spark, tmp_path):
    d = put(tmp_path, {"a/Web.tkape": {"Description": "D", "Targets": [{"Name": "n", "Category": "c2", "Path": "C:\\x"}, {"Category": "c1", "Path": "y"}]}, "a/Run.mkape": {"Category": "m", "Processors": [{"Executable": "e.exe", "CommandLine": "-x"}]}, "a/!Disabled/No.tkape": {"Description": "x"}})
    got = by_id(M.kape(jsonl.yaml_documents(spark, d, "*.?kape")))
    assert set(got) == {"kape-target-web", "kape-module-run"} and json.loads(got["kape-target-web"].metadata_json)["categories"] == ["c1", "c2"]
    assert "**e.exe**: `-x`" in got["kape-module-run"].content_markdown


def test_lolbas_and_gtfobins(spark, tmp_path):
    d = put(tmp_path, {"A.yml": {"Name": "A.exe", "Aliases": [{"Alias": "b.exe"}], "Full_Path": [{"Path": f"c{k}"} for k in range(22)], "Commands": [{"Command": "x", "MitreID": "T1", "Category": "Execute"}]}, "B.yml": {"Name": "B.exe", "Aliases": ["z"]}})
    got = by_id(M.lolbas(jsonl.yaml_documents(spark, d)))
    assert got["lolbas-a-exe"].content_type == "lolbas_entry" and got["lolbas-b-exe"].content_type == "lolbas_alias" and "and 2 more" in got["lolbas-a-exe"].content_markdown
    assert len(json.loads(got["lolbas-a-exe"].metadata_json)["full_paths"]) == 22 and got["lolbas-a-exe"].source_path.endswith("A.yml")
    g = put(tmp_path / "g", {"awk.yaml": {"functions": {"shell": [{"code": "awk"}], "file-read": [{"code": "x", "comment": "c"}]}}})
    assert json.loads(by_id(M.gtfobins(jsonl.yaml_documents(spark, g)))["gtfobins-awk"].metadata_json)["functions"] == ["file-read", "shell"]


def test_artifacts(spark, tmp_path):
    d = put(tmp_path, {"a.yaml": {"name": "Prefetch", "supported_os": ["Windows"], "sources": [{"type": "FILE", "attributes": {"paths": [f"p{k}" for k in range(25)]}}, {"type": "REGISTRY_VALUE", "attributes": {"key_value_pairs": [{"key": "k", "value": "v"}]}}]}})
    r = by_id(M.forensic_artifacts(jsonl.yaml_documents(spark, d)))["forensic-artifact-prefetch"]
    m = json.loads(r.metadata_json)
    assert len(m["file_paths"]) == 20 and m["registry_keys"] == ["k"] and m["source_types"] == ["FILE", "REGISTRY_VALUE"] and "Key: `k`, Value: `v`" in r.content_markdown


def test_velociraptor_and_skills(spark, tmp_path):
    page = '---\ntags: [Client Artifact]\n---\nintro\n<pre><code class="language-yaml">\nname: Windows.Sys\nquery: SELECT &lt;a&gt; &amp;amp;\n</code></pre>\nafter'
    d = put(tmp_path / "v", {"sys.md": page, "none.md": "---\nx: 1\n---\nno block"})
    got = M.velociraptor(jsonl.markdown_files(spark, d)).collect()
    assert len(got) == 1 and got[0].content_type == "velociraptor_client_artifact" and "```yaml\nname: Windows.Sys\nquery: SELECT <a> &amp;\n```" in got[0].content_markdown and "**OS**: Windows" in got[0].content_markdown
    s = put(tmp_path / "s", {"one/SKILL.md": "---\nname: Hunt X\nattack: T1059\n---\n## Step 1: look\n" + "w " * 600, "two/SKILL.md": "---\nname: short\n---\nfew", "three/SKILL.md": "w " * 600})
    got = by_id(M.skills(jsonl.markdown_files(spark, s)))
    assert set(got) == {"cybersec-skill-hunt-x"} and json.loads(got["cybersec-skill-hunt-x"].metadata_json)["workflow_steps"] == ["Step 1: look"]


def test_drivers_and_hijacks(spark, tmp_path):
    d = put(tmp_path / "d", {"a.yaml": {"Id": "AB", "Tags": ["x.sys"], "CVE": ["CVE-1", "CVE-2"], "CVEs": "CVE-1", "KnownVulnerableSamples": [{"SHA256": "f" * 64, "Company": "C"}, {"Filename": "y.sys", "Publisher": "B"}]}})
    r = by_id(M.loldrivers(jsonl.yaml_documents(spark, d)))["loldriver-ab"]
    m = json.loads(r.metadata_json)
    assert m["cves"] == ["CVE-1", "CVE-2"] and m["vendors"] == ["B", "C"] and "### x.sys" in r.content_markdown and "### y.sys" in r.content_markdown
    h = put(tmp_path / "h", {"a.yml": {"Name": "v.dll", "CVE": "CVE-9", "VulnerableExecutables": [{"Path": "p", "Type": "Sideloading", "AutoElevate": True}, {"Path": "q", "Type": "Phantom"}]}})
    m = json.loads(M.hijacklibs(jsonl.yaml_documents(spark, h)).first().metadata_json)
    assert m["hijack_types"] == ["Phantom", "Sideloading"] and m["cves"] == ["CVE-9"] and m["mitre_attack_ids"] == ["T1574"]


def test_advisories(spark, tmp_path):
    (tmp_path / "OT").mkdir()
    doc = {"document": {"title": "T", "notes": [{"category": "general", "text": "n"}], "tracking": {"id": "ICSA-1", "initial_release_date": "2024-01-01T00:00:00Z"}}, "vulnerabilities": [{"cve": "CVE-1", "notes": [{"category": "x"}, {"category": "summary", "text": "s"}], "scores": [{"cvss_v2": {"baseScore": 5.0}}]}, {"cve": "CVE-2", "scores": [{"cvss_v3": {"baseScore": 9.8, "baseSeverity": "CRITICAL"}}]}]}
    (tmp_path / "OT" / "a.json").write_text(json.dumps(doc))
    (tmp_path / "OT" / "b.json").write_text("{}")
    files = spark.read.schema(M.CSAF).option("multiLine", True).json(str(tmp_path / "OT")).selectExpr("*", "_metadata.file_path as file_path")
    got = by_id(M.advisories(files))
    assert set(got) == {"cisa-icsa-1"} and json.loads(got["cisa-icsa-1"].metadata_json)["highest_score"] == 9.8 and "**Summary**: s" in got["cisa-icsa-1"].content_markdown


def test_atlas(spark, tmp_path):
    data = {"matrices": [{"techniques": [{"id": "AML.T0001", "name": "T1", "tactics": ["x"]}, {"id": "bad", "name": "B"}], "mitigations": [{"id": "AML.M1", "name": "M", "techniques": [{"id": "AML.T0001", "use": "u"}]}]}], "case-studies": [{"id": "AML.CS1", "name": "C", "summary": "s", "procedure": [{"technique": "AML.T0001", "description": "first"}, {"technique": "AML.T0001", "description": "second"}]}]}
    found = jsonl.yaml_documents(spark, put(tmp_path, {"ATLAS.yaml": data}))
    assert [r.id for r in M.atlas_ids(found).collect()] == ["AML.T0001"]
    got = by_id(M.atlas(found))
    assert set(got) == {"atlas-AML.T0001", "atlas-bad", "atlas-mit-AML.M1", "atlas-case-AML.CS1"}
    assert "- **M**: u" in got["atlas-AML.T0001"].content_markdown and "- **T1**: first\n- **T1**: second" in got["atlas-case-AML.CS1"].content_markdown
    assert {r.collector: r.document_count for r in collectors.manifest(M.atlas(found)).collect()} == {"mitre_atlas": 4}


def test_volatility(spark, tmp_path):
    code = 'class PsList(interfaces.plugins.PluginInterface):\n    """Lists."""\n    def r(cls):\n        return [requirements.ModuleRequirement(name="kernel")]\n    def run(self):\n        return renderers.TreeGrid([("PID", int), ("Name", str)], self.g())\nclass Other:\n    pass\n'
    d = put(tmp_path, {"windows/pslist.py": code, "windows/bad.py": "def ("})
    rows = spark.read.option("recursiveFileLookup", True).text(d, wholetext=True).selectExpr("_metadata.file_path as file_path", "value")
    got = M.volatility_plugins(rows).collect()
    assert [r.doc_id for r in got] == ["vol3-plugin-windows-pslist-pslist"] and json.loads(got[0].metadata_json)["columns"] == ["PID", "Name"] and json.loads(got[0].metadata_json)["needs"] == ["kernel"]
