"""Files of larger tables: no task writes or reads all of them."""

from granary.operators import compaction
from granary.plans import files
from granary.sources import jsonl


def test_candidates_are_written_by_several_tasks_and_numbered_through(spark, sf, monkeypatch):
    seen = {}
    checked = jsonl.checked
    monkeypatch.setattr(jsonl, "checked", lambda s, path, *more, **kw: checked(s, seen.setdefault("path", path), *more, **kw))
    rows = files.src_07_candidates(spark, sf).select("line_number").collect()
    assert sorted(r.line_number for r in rows) == list(range(1, len(rows) + 1))
    assert spark.read.text(seen["path"]).select("_metadata.file_path").distinct().count() > 1


def test_artifacts_are_parsed_by_libyaml_with_the_same_outcome(monkeypatch):
    import yaml

    text = "# V\n\n```yaml\nname: A\ndescription: 'é: x'\nparameters: [{name: p, default: \"" + "a,b\\n" * 80 + "\"}]\nsources: [{query: SELECT 1}]\n```\n"
    plain = compaction.short_artifact(text, "{}")
    if hasattr(yaml, "CSafeLoader"):
        monkeypatch.setattr(yaml, "SafeLoader", None)
        monkeypatch.setattr(yaml, "safe_load", None)
        assert compaction.short_artifact(text, "{}") == plain
        monkeypatch.undo()
        monkeypatch.delattr(yaml, "CSafeLoader")
    assert compaction.short_artifact(text, "{}") == plain and "SELECT 1" in plain
    assert compaction.short_artifact("```yaml\na: [\n```", "{}") == "```yaml\na: [\n```"
