"""Compaction rules, run policies and what else has no query."""

import pytest
from pyspark.sql import functions as F

from granary.functions import text
from granary.operators import compaction, evaluation, runs


def compact(spark, source, t, most=24_000, meta="{}"):
    return spark.createDataFrame([(source, t, meta)], "s string, t string, m string").select(compaction.compacted(F.col("s"), F.col("t"), F.col("m"), most)).first()[0]


def test_attack_keeps_the_concrete(spark):
    lines = [f"- **G{k}**: " + ("used `cmd.exe` " if k % 3 == 0 else "was vague ") + "z" * 300 for k in range(40)]
    t = "# T1\n\n## Description\nd\n\n## Procedures\n" + "\n".join(lines) + "\n\n## Mitigations\n" + "\n".join(f"- m{k} " + "y" * 60 for k in range(12))
    out = compact(spark, "mitre_attack", t)
    shown = [int(x.split("**")[1][1:]) for x in out.split("\n") if x.startswith("- **G")]
    concrete = [k for k in range(40) if k % 3 == 0]
    assert shown == sorted(concrete + [k for k in range(40) if k % 3][: 18 - len(concrete)]) and out.count("- m") == 8 and len(out) < len(t)
    assert compact(spark, "mitre_attack", "# T2\n\nshort") == "# T2\n\nshort"


def test_advisory(spark):
    vulns = [f"### CVE-{k}\n**Title**: t{k} " + "y" * 300 + f"\n**Other**: no\n- **CVSS Score**: {x} (x)\n- **Vector**: `v`\n**Remediations**:\n- **a**: one\n  - URL: u1\n- **b**: two\n  - URL: u2\n- **c**: three\n  - URL: u3" for k, x in enumerate([5.0, 9.8, 7.5, 9.8] + [1.0] * 12)]
    advice = "".join(f"## Recommended Practices\npractice {k}\n  more\n" for k in [*range(10), 0, 1])
    t = "# A\n\n## Summary\ns\n\n## Noise\nn\n" + advice + "## Vulnerabilities\n" + "\n".join(vulns)
    out = compact(spark, "cisa_advisories", t)
    shown = [x for x in out.split("\n") if x.startswith("### ")]
    assert shown[:4] == ["### CVE-1", "### CVE-3", "### CVE-2", "### CVE-0"] and len(shown) == 12 and "12 of 16" in out
    assert "## Summary\ns" in out and "Noise" not in out and "**Other**" not in out
    assert out.count("- practice ") == 8 and "- practice 0 more" in out and "[2 more practices left out]" in out
    assert out.count("- **b**: two") == 12 and "three" not in out and "u2" in out and "u3" not in out and out.count("**Remediations**:") == 12
    assert all(len(x) <= 260 for x in out.split("\n") if x.startswith("**Title**"))


def test_hijack_rule(spark):
    exes = "\n".join(f"### `p{k}`\n- **Type**: x" + ("\n- **Raises privileges**: yes" if k >= 40 else "") + "\n" + "q" * 50 for k in range(45))
    out = compact(spark, "hijacklibs", "# H\n\n## Vulnerable executables\n" + exes)
    assert all(f"`p{k}`" in out for k in range(40, 45)) and out.count("### ") == 28
    assert len(compact(spark, "other", "x" * 30_000, 900)) < 1000


def test_driver(spark):
    import json

    sample = lambda k, **more: {"filename": f"f{k}", "machine_type": "AMD64", "hashes": {"sha256": f"s{k}"}, **more}
    samples = [sample(0)] * 6 + [sample(k) for k in range(1, 20)] + [sample(30, loads_despite_hvci="TRUE"), sample(31, imphash="i", company="c"), {"filename": "f0", "machine_type": "AMD64", "imphash": "other", "hashes": {"sha256": "s0"}}]
    meta = json.dumps({"hashes": [f"h{k}" for k in range(40)], "samples": samples, "detections": [{"type": "yara", "value": "rule"}, {"type": "", "value": "x"}]})
    t = "# D\n\n## Abuse Details\nbad\n\n## Samples\n" + "x" * 9000 + "\n\n## Resources\n" + "\n".join(f"- r{k}" for k in range(12))
    out = compact(spark, "loldrivers", t, meta=meta)
    shown = [x[4:] for x in out.split("\n") if x.startswith("### ")]
    # the best in their order: HVCI, then an import hash, then the first of equal ones, each once
    assert shown == ["f0", *[f"f{k}" for k in range(1, 11)], "f30", "f31", "f0"] and "14 of 28" in out
    assert out.count("- `h") == 30 and "[10 more hashes left out]" in out and "## Abuse Details\nbad" in out and "- **yara**: rule" in out and out.count("- r") == 8 and "[4 more resources left out]" in out
    assert compact(spark, "loldrivers", "# D\n\nshort", meta=meta) == "# D\n\nshort"


def test_skill(spark):
    code = "```python\n" + "\n".join(f"line {k}" for k in range(30)) + "\n```"
    steps = "\n".join(f"### Step {k}\ndo {k}\n{code}" for k in range(11))
    t = f"# S\n\n## Description\nd\n\n## Framework Mappings\nmaps\n\n## Overview\nsee\n{code}\n\n## Noise\n{'n' * 3000}\n\n## Workflow\nintro\n{steps}\n\n## Objectives\n```\n{'o' * 2500}"
    out = compact(spark, "cybersec_skills", t)
    assert "## Framework Mappings\nmaps" in out and "Noise" not in out and "8 of 11 subsections" in out and "### Step 7" in out and "### Step 8" not in out
    assert out.count("line 11\n# [18 more lines left out]\n```") == 9 and "line 12" not in out  # the overview's and eight steps'
    assert sum(x.lstrip().startswith("```") for x in out.split("\n")) % 2 == 0
    assert compact(spark, "cybersec_skills", "# S\n\n## Overview\nshort") == "# S\n\n## Overview\nshort" and compact(spark, "cybersec_skills", None) is None


def test_fences_and_limits():
    assert compaction.fences_shortened("a\n```\nx\n\ny") == "a\n```\nx\n\ny\n```"
    assert compaction.fences_shortened("```sh\n" + "z" * 800 + "\n```") == "```sh\n# [1 more lines left out]\n```"
    assert compaction.limited_whole_lines("```\nabc\nlong line", 9) == "```\nabc\n```\n[truncated]"
    assert compaction.limited_whole_lines("x" * 30, 10) == "x" * 10 + "\n[truncated]" and compaction.limited_whole_lines("ab", 2) == "ab"


def test_artifact(spark):
    rows = "\n".join(f"    a{k},b{k}" for k in range(80))
    yaml_ = f"""name: Win.X
description: {"d" * 2000}
type: CLIENT
reference: [r1, r2]
parameters:
- name: P
  type: csv
  default: |
{rows}
- name: Q
  default: {"q" * 300}
  choices: [a, b]
- name: V
  default: SELECT 1 FROM x
sources:
- name: Main
  precondition: SELECT 2
  query: |
    SELECT {"x" * 5000} FROM y
- queries: [LET a = 1, SELECT 3]
reports:
- name: R
  template: t
"""
    t = f"# V\n\n```yaml\n{yaml_}\n```\n" + "tail " * 10
    out = compact(spark, "velociraptor_artifacts", t, 900, '{"os_platform": "Windows"}')
    assert "# Velociraptor artifact: Win.X" in out and "**Platform**: Windows" in out and "**Type**: CLIENT" in out
    assert "x" * 5000 in out and "SELECT 2" in out and "LET a = 1" in out and "SELECT 3" in out  # queries are never cut, nor is their middle
    assert "d" * 1801 not in out and "## Default of P\n```csv\n" in out and "a79,b79" in out and "default=" + "q" * 220 + " [truncated]" in out and "choices=a, b" in out and "## Default of V\n```vql" in out
    assert "- r1\n- r2" in out and "- **R**: t" in out
    for same in ("no yaml here " * 3000, "```yaml\n: [\n```", "```yaml\n- a\n```"):
        assert compact(spark, "velociraptor_artifacts", same, 900) == same


def test_default_languages():
    of = compaction.default_language
    long = "x" * 300
    assert of("short, with\ncommas, in") is None and of("let x = 1") == "vql" and of("rule a {\n" + long) == "yara" and of('{"a": "' + long + '"}') == "json"
    assert of(f"a,b\nc,d\n{long}") == "csv" and of(f"- a\n- b\n{long}") == "yaml" and of(f"C*.x\nD*.y\n{long}") == "text" and of(long) is None


def test_policies():
    good = {"junior": 0.3, "mid": 0.5, "senior": 0.2}
    assert runs.policy_problems(good, {"a": "a.md"}, {"s": ["a"]}) == []
    assert len(runs.policy_problems({"junior": -1, "mid": "x"}, {"a": None}, {"s": [], "t": ["b"]})) == 6
    assert runs.policy_problems({k: 0 for k in good}, {}, {}) == ["weights add up to nothing"]
    assert runs.breaker_problem("pilot", 0, 9) is None and runs.breaker_problem("full", 0, 0.2) and runs.breaker_problem("subset", 5, 1.5) and runs.breaker_problem("full", 20, 0.2) is None


def test_incompatible_runs_and_missing_predictions(spark):
    make = lambda rows: spark.createDataFrame(rows, "case_id string, judge string")
    same = [("a", "j"), ("b", "j")]
    assert evaluation.incompatible(make(same), make(same), ["judge"]).count() == 0
    assert {r.problem for r in evaluation.incompatible(make(same), make([("a", "k"), ("c", "j")]), ["judge"]).collect()} == {"cases differ", "judge differs"}
    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    with pytest.raises(Exception, match="no prediction for b"):
        evaluation.predicted(cases, spark.createDataFrame([("a", "x")], "case_id string, prediction string")).collect()
    m = spark.range(1).select(evaluation.judge_messages("r", F.lit("q"), F.lit("e"), F.lit("p"), F.lit(5.0)).alias("m")).first().m
    assert m[1].content == '{"question":"q","expected":"e","prediction":"p","max_points":5.0}'


def test_checkpointed_scores_resume(spark, tmp_path):
    seen = []

    def score(df):
        seen.append(df.count())
        return df.withColumn("score", F.lit(1.0))

    cases = spark.createDataFrame([("a",), ("b",)], "case_id string")
    path = str(tmp_path / "scores")
    assert runs.checkpointed(cases.limit(1), path, score).count() == 1
    assert runs.checkpointed(cases, path, score).count() == 2 and seen == [1, 1]


def test_urls(spark):
    got = spark.range(1).select(text.blob_url("https://host/x/y.git", "main", F.lit("a b/c+d/é.yml"))).first()[0]
    assert got == "https://host/x/y/blob/main/a%20b/c%2Bd/%C3%A9.yml"


def test_connectors(tmp_path):
    from granary.sources import connectors

    called = []
    folder = str(tmp_path / "a" / "repo")
    assert connectors.repository("https://host/x.git", folder, run=lambda args, **_: called.append(args))
    assert called == [["git", "clone", "--depth", "1", "--", "https://host/x.git", folder]]
    (tmp_path / "a" / "repo").mkdir()
    assert not connectors.repository("https://host/x.git", folder, run=lambda *_, **__: called.append(1)) and len(called) == 1
    assert connectors.commit_of(folder) == "unknown"
    (tmp_path / "feed.json").write_text('{"a": 1}')
    url, copy = f"file://{tmp_path}/feed.json", str(tmp_path / "b" / "copy.json")
    assert connectors.download(url, copy) and not connectors.download(url, copy) and open(copy).read() == '{"a": 1}'
    with pytest.raises(Exception, match="none"):
        connectors.download(f"file://{tmp_path}/none", str(tmp_path / "b" / "none"))
    assert [p.name for p in (tmp_path / "b").iterdir()] == ["copy.json"]
    (tmp_path / ".env").write_text("# note\nA=1\nB = 'two words'\nno sign\nC=x=y\n=empty\nD=old\n")
    into = {"D": "kept"}
    assert connectors.environment(str(tmp_path / ".env"), into) == {"A": "1", "B": "two words", "C": "x=y"} and into["D"] == "kept"
    assert connectors.environment(str(tmp_path / "none"), into) == {}


def test_ascii_json(spark, tmp_path):
    import json

    from granary.sources import jsonl, sinks

    texts = ["plain", "é\n\t\"", "😀 and ß", "", None, "\x00\u2028"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert sinks.json_lines(rows, str(tmp_path / "out")) == len(texts)
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert all(x.isascii() for x in lines) and sorted((json.loads(x)["k"], json.loads(x)["t"]) for x in lines if "null" not in x) == [(k, t) for k, t in enumerate(texts) if t is not None]
    assert {r.k: r.t for r in jsonl.json_lines(spark, str(tmp_path / "out"), "k int, t string").collect()} == dict(enumerate(texts))


def test_line_numbers_over_splits(spark, tmp_path):
    """Files are read in splits of some bytes; numbers go through."""
    from granary.sources import jsonl

    for name, n in (("a", 5000), ("b", 3), ("c", 2000)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} line {k}\r\n" if k % 7 == 0 else f"{name} line {k}\n" for k in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000b")
    try:
        got = jsonl.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 7003 and all(r.value == f"{r.file_path[-5]} line {r.line_number}" for r in got)


def test_numbered_documents_fail_on_bad_lines(spark, tmp_path):
    from granary.sources import jsonl

    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "x.jsonl").write_text('{"doc_id": "a"}\n\n{"doc_id": "b"}\n')
    with pytest.raises(Exception, match="no document at .*:2"):
        jsonl.numbered_documents(spark, str(tmp_path)).collect()
