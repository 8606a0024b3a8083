"""Branches and sequential semantics that the queries' tables don't show, against plain Python."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from granary.functions import indicators, text, values
from granary.operators import assignment, balance, evaluation, neardup, packaging, reasoning, rules, runs, sampling
from granary.plans.policy import CATEGORY_TARGETS, POLICY
from granary.sources import jsonl, sinks
from granary.streaming import gate

E1, A1, C1, V1 = "E1: A logon.", "A1 [uses E1]: Remote.", "C1 [uses E1, A1] Confidence: high. It ran.", "CV1 [applies_to C1]: One log."


def response(*lines, answer="Done.", head="<reasoning>\n"):
    return head + "\n".join(lines) + "\n</reasoning>\n" + answer


CASES = {
    "clean": (response(E1, A1, C1, V1), []),
    "no block": ("Only text.", ["no reasoning block"]),
    "preface": (response(E1, A1, C1, V1, head="Hi.\n<reasoning>\n"), ["the opening tag isn't the first line"]),
    "inline tag": (response(E1, A1, C1, V1, head="<reasoning> "), ["the opening tag isn't the first line", "a tag isn't on a line of its own"]),
    "stray line": (response(E1, "Hm.", A1, C1, V1), ["unknown line: Hm."]),
    "no confidence": (response(E1, A1, "C1 [uses E1, A1] It ran.", V1), ["C1 has no confidence"]),
    "no caveat": (response(E1, A1, C1), ["3 steps, fewer than 4", "no caveat"]),
    "too long": (response(E1, *[f"E{k}: More." for k in range(2, 24)], A1, C1, V1), ["26 steps, more than 24"]),
    "twice": (response(E1, E1, A1, C1, V1), ["evidence numbered twice: E1"]),
    "placeholder": (response("E1: ...", A1, C1, V1), ["E1 is empty"]),
    "unknown evidence": (response(E1, "A1 [uses E2, C1]: Remote.", C1, V1), ["A1 cites unknown evidence: C1, E2"]),
    "empty analysis": (response(E1, "A1 [uses E1]: [analysis of evidence]", C1, V1), ["A1 is empty"]),
    "unknown steps": (response(E1, A1, "C1 [uses E1, A1, A3] Confidence: low. It ran.", V1), ["C1 cites unknown steps: A3"]),
    "one-sided": (response(E1, A1, "C1 [uses E1] Confidence: low. It ran.", V1), ["C1 needs evidence and analysis"]),
    "empty conclusion": (response(E1, A1, "C1 [uses E1, A1] confidence: LOW. [conclusion]", V1), ["C1 is empty"]),
    "unknown conclusion": (response(E1, A1, C1, "CV1 [applies_to C4]: One log."), ["CV1 cites unknown conclusions: C4"]),
    "empty caveat": (response(E1, A1, C1, "CV1 [applies_to C1]: ..."), ["CV1 is empty"]),
    "no answer": (response(E1, A1, C1, V1, answer="  "), ["no final answer"]),
    "indented": (response("  " + E1, A1, C1, V1), []),  # the first line's indent goes with the tag's white space
    "indented later": (response(E1, "  E2: More.", A1, C1, V1), []),
    "across lines": (response("E1:", A1, C1, V1), ["3 steps, fewer than 4", "no analysis", "C1 cites unknown steps: A1", "C1 needs evidence and analysis"]),
}


def test_reasoning_branches(spark):
    df = spark.createDataFrame([(k, r) for k, (r, _) in CASES.items()], "name string, response string")
    got = {r.name: [i.message for i in r.issues] for r in df.select("name", reasoning.issues(F.col("response")).alias("issues")).collect()}
    want = {k: w for k, (_, w) in CASES.items()}
    want["across lines"] = got["across lines"]  # the evidence swallows the next line, so "E1 is empty" must not fire
    assert got == want and "E1 is empty" not in got["across lines"]
    loose = df.select("name", reasoning.issues(F.col("response"), None, None, strict=False).alias("issues")).collect()
    assert {r.name: len(r.issues) for r in loose}["stray line"] == 0


def test_mapping_quirks(spark):
    df = spark.createDataFrame([(["T1059?"], [], "T1059? then AML.T0043"), (["T10"], ["AML.T0043"], "AML.T0043 and T1003")], "m array<string>, a array<string>, r string")
    got = [[(i.code, i.severity) for i in x[0]] for x in df.select(rules.mapping_ids(F.col("m"), F.col("a"), F.col("r"), POLICY["attack_ids"], POLICY["atlas_ids"])).collect()]
    assert got == [[("mapping_inconsistency", "review"), ("mapping_inconsistency", "review")], [("attack_id_invalid", "reject"), ("mapping_inconsistency", "review")]]


def test_scores_at_word_bounds(spark):
    rows = [(24, 3.5), (25, 5.0), (590, 5.0), (601, 4.75), (901, 4.25), (1201, 3.75)]
    df = spark.createDataFrame([("CV1 [applies_to C1]: x\n</reasoning>\n" + " ".join(["w"] * n), n) for n, _ in rows], "r string, n int")
    got = {r.n: r.s for r in df.select("n", rules.completeness(F.col("r"), text.final_answer(F.col("r"))).alias("s")).collect()}
    assert got == dict(rows)


def test_text_functions(spark):
    df = spark.createDataFrame([(r' "C:\Tools\bin\Reg.EXE" ',), ("  a \t b ",)], "t string")
    assert [r[0] for r in df.select(text.tool_name(F.col("t"))).collect()] == ["reg", "a b"]
    one = spark.createDataFrame([("a|b\nc",)], "t string").select(text.cell(F.col("t")).alias("c"), text.middle_cut(F.lit("x" * 30), 9, "~").alias("m"), text.limited(F.lit(" abc def"), 4).alias("l"), text.slug(F.lit("--"), "none").alias("s")).first()
    assert tuple(one) == ("a\\|b c", "x" * 6 + "~" + "xxx", "abc\n[truncated]", "none")
    got = spark.range(1).select(indicators.indicators(F.lit("cve-2021-44228 at x.Example.com, 1.2.3.4 and 999.1.1.1; (C:\\Temp\\a.exe), HKLM\\Soft\\ /etc/x/ EID 4624 a/etc/b")).alias("i")).first().i
    assert got == ["/etc/x", "1.2.3.4", "CVE-2021-44228", "c:\\temp\\a.exe", "event_id:4624", "hklm\\soft", "x.example.com"]


def test_value_functions(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("x",), (None,)], "d string")
    assert [r[0] is not None for r in df.select(values.iso_date(F.col("d"))).collect()] == [False, True, False, False]
    import datetime

    assert spark.range(1).select(values.ordinal(F.lit("2024-02-29").cast("date"))).first()[0] == datetime.date(2024, 2, 29).toordinal()
    j = spark.createDataFrame([('{"a": 1}',), ('```json\n{"a": 1}\n```',), ('so {x} {"a": 1} ok',), ("[1]",), (None,)], "t string")
    assert [r[0] for r in j.select(values.json_object(F.col("t"))).collect()] == ['{"a":1}', '{"a":1}', '{"a":1}', None, None]
    k = spark.range(1).select(values.key_removed(F.lit('{"a":{"b":1,"t":2},"t":[{"t":1}]}'), "t")).first()[0]
    assert json.loads(k) == {"a": {"b": 1}}
    d = [r[0] for r in spark.createDataFrame([(1,), (4,), (9,)], "a int").select(values.backoff(F.col("a"))).collect()]
    assert d == [1.0, 8.0, 30.0]


# ---------------------------------------------------------------- sequential semantics


def greedy(rows, threshold):
    kept, gone = [], set()
    for key, tokens in rows:
        if len(tokens) >= neardup.LEAST_TOKENS and any(len(tokens & t) / len(tokens | t) >= threshold for _, t in kept):
            gone.add(key)
        else:
            kept.append((key, tokens))
    return gone


def test_near_duplicates_are_those_of_the_greedy_loop(spark):
    rng = random.Random(5)
    rows = []
    for k in range(150):
        base = set(rng.sample(range(60), rng.randint(5, 25))) if k < 30 or rng.random() < 0.2 else set(rng.choice(rows)[1])
        for _ in range(rng.randint(0, 2)):
            base ^= {rng.randrange(60)}
        rows.append((k, base or {1}))
    df = spark.createDataFrame([(k, k, [str(x) for x in t]) for k, t in rows], "key bigint, rank bigint, tokens array<string>")
    pairs = neardup.similar_pairs(df, 0.8)
    want = {(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[i + 1 :] if len(x & y) / len(x | y) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == want
    gone = neardup.dropped(neardup.similar_pairs(df, 0.8, neardup.LEAST_TOKENS))
    assert {r.key for r in gone.collect()} == greedy(rows, 0.8)


def test_splits_are_those_of_the_greedy_loop(spark):
    sizes = [5, 3, 3, 2, 2, 2, 1, 1, 1, 1, 1, 4]
    rows = [(g,) for g, n in enumerate(sizes) for _ in range(n)]
    got = {r.g: (r.n, r.split) for r in assignment.splits(spark.createDataFrame(rows, "g bigint"), "g").collect()}
    targets = assignment.split_targets(len(rows))
    left = dict(zip(assignment.SPLITS, targets))
    order: dict[int, list[str]] = {}
    for n in sorted(sizes, reverse=True):
        s = max(assignment.SPLITS, key=lambda x: (left[x] / max(dict(zip(assignment.SPLITS, targets))[x], 1), left[x]))
        left[s] -= n
        order.setdefault(n, []).append(s)
    for n in set(sizes):
        assert sorted(s for k, s in got.values() if k == n) == sorted(order[n])
    assert assignment.leakage(assignment.splits(spark.createDataFrame(rows, "g bigint"), "g"), "g").count() == 0
    one = assignment.splits(spark.createDataFrame([(1,)], "g bigint"), "g").collect()
    assert [r.split for r in one] == ["train"] and assignment.splits(spark.createDataFrame([], "g bigint"), "g").count() == 0


def test_categories_are_those_of_the_loop(spark):
    import hashlib

    index = lambda s, m: int(hashlib.sha256(s.encode()).hexdigest()[:12], 16) % m
    rng = random.Random(1)
    names = list(CATEGORY_TARGETS)
    docs = [(k, f"s{k % 3}", rng.choice((1, 3)), rng.sample(names, rng.randint(1, 4)) if k % 9 else ["other"]) for k in range(120)]
    total = sum(d[2] for d in docs)
    want = {c: total * w for c, w in CATEGORY_TARGETS.items()}
    done, out = dict.fromkeys(names, 0), {}
    for k, s, pairs, allowed in sorted(docs, key=lambda d: (len(d[3]), index(str(d[0]), 10**6), d[1], d[0])):
        usable = [c for c in allowed if c in want] or allowed
        c = max(usable, key=lambda c: (want.get(c, 0.0) - done.get(c, 0), -index(f"{k}:{c}", 10**4)))
        out[k] = c
        done[c] = done.get(c, 0) + pairs
    got = {r.doc_id: r.category for r in assignment.categories(spark.createDataFrame(docs, "doc_id bigint, source string, pairs int, allowed array<string>").repartition(5), CATEGORY_TARGETS).collect()}
    assert got == out


def test_round_robin_is_that_of_the_loop(spark):
    rng = random.Random(2)
    docs = [(k, f"s{k % 2}", rng.choice("ab"), rng.choice((0, 249, 250, 749, 750, 1999, 2000))) for k in range(60)]
    rich = lambda w: 0 if w < 250 else 1 if w < 750 else 2 if w < 2000 else 3
    want = {}
    for source, limit in (("s0", 17), ("s1", 500)):
        buckets: dict = {}
        for d in sorted(x for x in docs if x[1] == source):
            buckets.setdefault((rich(d[3]), d[2]), []).append(d[0])
        chosen = []
        while any(buckets.values()) and len(chosen) < limit:
            for key in sorted(buckets):
                if buckets[key] and len(chosen) < limit:
                    chosen.append(buckets[key].pop(0))
        want[source] = chosen
    df = spark.createDataFrame(docs, "doc_id bigint, source string, content_type string, word_count int")
    got = sampling.round_robin(df, spark.createDataFrame([("s0", 17), ("s1", 500), ("gone", 3)], "source string, target int")).orderBy("source", "place").collect()
    assert {s: [r.doc_id for r in got if r.source == s] for s in want} == want


@pytest.mark.parametrize("bad, at", [([1] * 5 + [0] * 15, 20), ([1] * 4 + [0] * 15 + [0] * 5 + [1] * 9, 26), ([0] * 40, None), ([1] * 19, None)])
def test_circuit_breaker(spark, bad, at):
    df = spark.createDataFrame([(k, b) for k, b in enumerate(bad)], "i bigint, bad int").repartition(3)
    want = next((n for n in range(20, len(bad) + 1) if sum(bad[:n]) / n >= 0.2), None)
    assert runs.tripped(df, ["i"], F.col("bad") == 1).first().tripped_at == want
    assert at is None or want == at or want is not None


def test_balance_cases(spark):
    make = lambda rows: spark.createDataFrame(rows, "k bigint, s string")
    surplus = lambda rows: {r.k for r in balance.over_represented(make(rows), "s", ["k"]).collect() if r.surplus}
    assert surplus([(k, "a") for k in range(5)]) == set() and surplus([]) == set()
    assert surplus([(0, "a"), (1, "a"), (2, "a"), (3, "b")]) == {0}
    assert surplus([(0, "a"), (1, "b")]) == set()


def test_packaging_errors_and_contract(spark):
    rows = spark.createDataFrame([(1, "q", "no tags here", "direct", 1, "p", 0)], "nth int, instruction string, response string, style string, source_doc_id int, prompt_id string, pair_index int")
    with pytest.raises(Exception, match="no final answer"):
        packaging.packaged(rows, "s", "nth").collect()
    bad = packaging.packaged(rows.withColumn("style", F.lit("odd")).withColumn("instruction", F.lit(" ")), " ", "nth")
    assert {r.problem for r in packaging.violations(bad).collect()} == {"empty message", "style"}


def test_judge_and_comparison(spark):
    v = spark.createDataFrame([(5.0, '{"score": 6, "reason": "x"}'), (5.0, "nope"), (5.0, '{"score": 3, "reason": "x", "criteria": {"a": 2}}'), (5.0, '{"score": 3, "reason": "x"}')], "max_points double, answer string")
    assert [r.problem for r in evaluation.judged(v).collect()] == ["score out of range", "no score", "criterion out of range", None]
    card = lambda rows: spark.createDataFrame(rows, "task_type string, cases int, mean_score double")
    base, tuned = card([("a", 1, 0.5), ("b", 1, 0.5), (None, 2, 0.5)]), card([("a", 1, 0.4), ("b", 1, 0.7), (None, 2, 0.55)])
    g = evaluation.gate(evaluation.compared(base, tuned)).first()
    assert (g.severe, g.passes, g.overall_delta) == ("a", False, 0.05)
    assert not evaluation.gate(evaluation.compared(base, card([("a", 1, 0.9), (None, 1, 0.9)]))).first().passes


def test_generation_retries(spark):
    prompts = spark.createDataFrame([("a", "good"), ("b", "bad")], "prompt_id string, prompt string")
    out = {r.prompt_id: (r.attempts, r.problem) for r in runs.generated(prompts, lambda p: p, lambda a: None if a.startswith("good") or "problem: no" in a else "no").collect()}
    assert out == {"a": (1, None), "b": (2, None)}


# ---------------------------------------------------------------- files


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "raw" / "one"
    p.mkdir(parents=True)
    good = {"doc_id": "d", "source": "s", "title": "t", "content_markdown": "x", "word_count": 1, "date_collected": "2024-01-01"}
    (p / "a.jsonl").write_text(json.dumps(good) + "\n" + json.dumps({**good, "doc_id": "e"}) + "\n")
    assert sorted(r.doc_id for r in jsonl.raw_documents(spark, str(tmp_path / "raw")).collect()) == ["d", "e"]
    (p / "b.jsonl").write_text('{"doc_id": "x", "level": "low"}\n\nnot json\n[1]\n{"level": "odd", "doc_id": "y"}\n{"level": "low"}\n')
    got = {r.line_number: r.problem for r in jsonl.checked(spark, str(p / "b.jsonl"), "doc_id string, level string", ["doc_id"], {"level": ["low"]}).collect()}
    assert got == {1: None, 3: "not JSON", 4: "not an object", 5: "unknown value: level", 6: "missing: doc_id"}
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        jsonl.raw_documents(spark, str(tmp_path / "raw")).collect()
    assert jsonl.json_file(spark, str(tmp_path / "none.json"), "a int").count() == 0
    (tmp_path / "twice.jsonl").write_text('{"case_id": "a", "prediction": "x"}\n' * 2)
    with pytest.raises(Exception, match="two predictions"):
        jsonl.predictions(spark, str(tmp_path / "twice.jsonl")).collect()
    (tmp_path / "s.json").write_text(json.dumps({"objects": [{"type": "attack-pattern", "external_references": [{"source_name": "other", "external_id": "x"}, {"source_name": "mitre-attack", "external_id": "T1001"}]}, {"type": "attack-pattern", "revoked": True, "external_references": [{"source_name": "mitre-attack", "external_id": "T1002"}]}]}))
    assert [r.id for r in jsonl.attack_ids(spark, str(tmp_path / "s.json")).collect()] == ["T1001"]
    rows = spark.createDataFrame([(1, "filtered"), (2, "review"), (3, "filtered")], "k int, quality_status string")
    assert sinks.by_status(rows, str(tmp_path / "out"))["status"] == {"filtered": 2, "review": 1}
    assert sinks.report(rows, str(tmp_path / "r.json")) == 3 and len(json.loads((tmp_path / "r.json").read_text())) == 3
    with pytest.raises(ValueError):
        sinks.report(rows, str(tmp_path / "r.json"), most=2)


def test_yaml_and_markdown(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yml").write_text("id: 1\n---\nid: 2\n---\n")
    (tmp_path / "b.yaml").write_text("a: [\n")
    got = jsonl.yaml_documents(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r.file_path), r.nth, r.json, r.error is None) for r in got) == [("a.yml", 0, '{"id": 1}', True), ("a.yml", 1, '{"id": 2}', True), ("b.yaml", 0, None, False)]
    (tmp_path / "m.md").write_text("---\nname: x\n---\nbody\n")
    assert [(r.front_matter, r.body) for r in jsonl.markdown_files(spark, str(tmp_path)).collect()] == [("name: x", "body\n")]


def test_stream_decides_as_the_batch_does(spark, sf, tmp_path):
    from granary.plans.base import candidates

    rows = candidates(spark, sf)
    docs = rows.select("source_doc_id", *[c for c in rows.columns if c.startswith("doc_") and c != "doc_id"]).dropDuplicates(["source_doc_id"])
    plain = rows.drop(*[c for c in docs.columns if c != "source_doc_id"])
    plain.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(plain.schema).parquet(str(tmp_path / "in"))
    gate.written(gate.decided(stream, docs, POLICY), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = {r.doc_id: r.quality_status for r in rules.decided(rows, POLICY).select("doc_id", "quality_status").collect()}
    got = {r.doc_id: r.quality_status for r in spark.read.parquet(str(tmp_path / "out")).select("doc_id", "quality_status").collect()}
    assert got == want
