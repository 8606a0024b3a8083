"""Where queries are registered, and the relations that several of them derive from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.plans.policy import ALL_REFS, ATLAS_IDS, ATTACK_IDS, SIGNALS, TOOLS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listed(values) -> str:
    """A DuckDB list literal."""
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


#: Candidates with a response for each branch of the rules; reads the same in both engines.
CANDIDATES = """
SELECT doc_id, lang, v, instruction, source_doc_id, source, category, grounding, mitre, atlas, tools, refs,
  CASE WHEN v = 1 THEN text ELSE opening || evidence || chr(10) || analysis || chr(10) || conclusion || more || chr(10) || '</reasoning>' || chr(10) || answer END AS response
FROM (
  SELECT doc_id, lang, text, v,
    'Explain what document ' || CAST(doc_id AS STRING) || ' shows.' AS instruction,
    CASE WHEN v = 10 AND doc_id % 48 = 10 THEN doc_id + 1000000000 ELSE doc_id END AS source_doc_id,
    CASE WHEN v = 11 AND doc_id % 48 = 11 THEN 'srcX' ELSE source END AS source,
    CASE WHEN v = 12 THEN 'cooking' WHEN doc_id % 5 = 0 THEN 'artifact_analysis' WHEN doc_id % 5 = 1 THEN 'ttp_identification' WHEN doc_id % 5 = 2 THEN 'triage_and_hunting' WHEN doc_id % 5 = 3 THEN 'detection_engineering' ELSE 'report_generation' END AS category,
    CASE WHEN v IN (19, 23) THEN 'source_plus_general' ELSE 'source_only' END AS grounding,
    CASE v WHEN 5 THEN 'T10' WHEN 20 THEN 'T9999' WHEN 21 THEN 'T1059?' ELSE 'T1055' END AS mitre,
    CASE v WHEN 22 THEN 'AML.T0043,AML.T9999' ELSE '' END AS atlas,
    CASE v WHEN 23 THEN 'Zeek,C:' || chr(92) || 'Tools' || chr(92) || 'reg.exe' WHEN 4 THEN 'PowerShell' ELSE '' END AS tools,
    CASE v WHEN 13 THEN '' WHEN 14 THEN 'W1,X9' ELSE 'W1,S1' END AS refs,
    CASE v WHEN 2 THEN 'Preface.' || chr(10) || '<reasoning>' || chr(10) WHEN 3 THEN '<reasoning> ' ELSE '<reasoning>' || chr(10) END AS opening,
    CASE v WHEN 7 THEN 'E1: A logon.' || chr(10) || 'E1: Once more.' WHEN 8 THEN 'E1: ...' ELSE 'E1: A logon.' END AS evidence,
    CASE v WHEN 9 THEN 'A1 [uses E9]: It was remote.' WHEN 16 THEN 'A1 [uses E1]: It was remote.' || repeat(chr(10) || 'E2: Another line.', 24) ELSE 'A1 [uses E1]: It was remote.' END AS analysis,
    CASE v WHEN 4 THEN 'A stray line.' || chr(10) || 'C1 [uses E1, A1] Confidence: high. A user came in.' WHEN 5 THEN 'C1 [uses E1, A1] A user came in.' WHEN 10 THEN 'C1 [uses E1, A7] Confidence: low. A user came in.' WHEN 11 THEN 'C1 [uses E1] Confidence: low. A user came in.' WHEN 12 THEN 'C1 [uses E1, A1] Confidence: medium. [conclusion]' ELSE 'C1 [uses E1, A1] Confidence: high. A user came in.' END AS conclusion,
    CASE v WHEN 6 THEN '' WHEN 13 THEN chr(10) || 'CV1 [applies_to C5]: One log only.' WHEN 14 THEN chr(10) || 'CV1 [applies_to C1]: ...' ELSE chr(10) || 'CV1 [applies_to C1]: One log only.' END AS more,
    CASE v WHEN 15 THEN '' WHEN 17 THEN text || ' [general knowledge] Logons are common.' WHEN 18 THEN text || ' It came from 10.11.12.13 and wrote /etc/passwd under CVE-2021-44228.' WHEN 19 THEN text || ' [GENERAL KNOWLEDGE] Often from 10.11.12.13, Event ID 4624.' WHEN 21 THEN text || ' It maps to T1003 here.' WHEN 22 THEN text || ' Compare AML.T0016 first. Review logs, collect evidence and triage scope.' ELSE text END AS answer
  FROM (SELECT doc_id, lang, text, source, doc_id % 24 AS v FROM {documents}) AS d
) AS parts
"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with arrays, each left-joined to its source document (doc_source is null where there is none)."""
    docs = table(spark, sf_dir, "documents")
    rows = spark.sql(CANDIDATES, documents=docs)
    split = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))
    rows = rows.withColumns({"mitre_techniques": split("mitre"), "atlas_techniques": split("atlas"), "tools_referenced": split("tools"), "taxonomy_refs": split("refs")}).drop("mitre", "atlas", "tools", "refs")
    there = docs.select(F.col("doc_id").alias("source_doc_id"), F.col("source").alias("doc_source"), F.col("text").alias("doc_text"), F.lit("").alias("doc_title"), F.lit("").alias("doc_url"), F.lit("{}").alias("doc_metadata"))
    return rows.join(there, "source_doc_id", "left")


# The patterns and word lists below are the oracle's own, written out from the contract in RE2's syntax: it shares
# none with the expressions it checks, but for the policy tables that both are given.
_WORDS = "about after also because been before being between could does from have into more should that their there these this those when where which will with would your".split()
_TOKEN = r"[a-zA-Z][\w.\\/-]{2,}"
_OCTET = "(?:1[0-9][0-9]|2[0-4][0-9]|25[0-5]|[0-9]?[0-9])"
_TOPS = "com|net|org|io|gov|edu|mil|co|uk|ru|cn|de|jp|br|au|ca|fr|nl|info|biz|dev|cloud|app|tech|site|online"
_INDICATORS = {
    "cve": r"\b((?i:cve)-[0-9]{4}-[0-9]{4,7})\b",
    "hash": r"\b([a-fA-F0-9]{64}|[a-fA-F0-9]{40}|[a-fA-F0-9]{32})\b",
    "ip": rf"\b({_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET})\b",
    "domain": rf"\b((?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{{0,61}}[a-zA-Z0-9])?\.)+(?:{_TOPS}))\b",
    "drive": r"""(?i)\b([a-z]:\\[^\s"'<>|]+)""",
    "registry": r"(?i)\b((?:hklm|hkcu|hkcr|hku|hkcc|hkey_local_machine|hkey_current_user|hkey_classes_root|hkey_users|hkey_current_config)\\[\w\\/*.$%{}-]+)",
    "unix": r"""(?:^|[^\w])(/(?:etc|var|tmp|home|usr|bin|sbin|opt|root|Users|Library|System|Applications|private|Volumes)/[^\s"'<>]+)""",
    "event": r"(?i)\b(?:event\s+id|eid)\s*[:#-]?\s*([0-9]{3,5})\b",
}
_VERBS = "acquire collect compare confirm correlate decode extract inspect isolate pivot preserve query review scope triage validate".split()
_VAGUE = ["suspicious activity", "this may indicate malicious activity", "check logs", "review logs", "more investigation is needed", "further investigation is needed", "further analysis is needed", "best practices", "follow best practices", "consult your security team"]
_LINE = {
    "block": r"(?s)<reasoning>\s*(.*?)\s*</reasoning>",
    "e": r"(?m)^E([0-9]+):\s*(.*)$",
    "a": r"(?m)^A([0-9]+)\s+\[uses\s+([^\]]+)\]:\s*(.*)$",
    "c": r"(?m)^C([0-9]+)\s+\[uses\s+([^\]]+)\].*$",
    "sure": r"(?mi)^C([0-9]+)\s+\[uses\s+([^\]]+)\]\s+Confidence:\s+(?:high|medium|low)\.\s*(.*)$",
    "cv": r"(?m)^CV([0-9]+)\s+\[applies_to\s+([^\]]+)\]:\s*(.*)$",
    "known": r"^(?:E[0-9]+:|A[0-9]+\s+\[uses|C[0-9]+\s+\[uses|CV[0-9]+\s+\[applies_to)",
    "cited": r"\b((?:CV|E|A|C)[0-9]+)\b",
}
_NOTHING = ["", "...", "[source-grounded evidence]", "[analysis of evidence]", "[conclusion]"]
_ATTACK, _ATLAS = r"T[0-9]{4}(?:\.[0-9]{3})?\??", r"AML\.T[0-9]{4}(?:\.[0-9]{3})?\??"


def sql_tokens(text: str) -> str:
    edges = """[.,:;()\\[\\]{}''"`]+"""
    return f"list_distinct(list_filter(list_transform(regexp_extract_all({text}, '{_TOKEN}'), lambda t: lower(regexp_replace(t, '^{edges}|{edges}$', '', 'g'))), lambda t: length(t) >= 4 AND NOT list_contains({listed(_WORDS)}, t)))"


def sql_indicators(text: str) -> str:
    edges = """[.,:;()\\[\\]{}''"`]+"""
    norm = f"lambda x: lower(regexp_replace(regexp_replace(x, '^{edges}|{edges}$', '', 'g'), '[\\\\/]+$', ''))"
    every = {k: "regexp_extract_all(" + text + ", '" + p.replace("'", "''") + "', 1)" for k, p in _INDICATORS.items()}
    parts = [f"list_transform({every['cve']}, lambda x: upper(x))", f"list_transform({every['hash']}, lambda x: lower(x))", every["ip"], f"list_transform({every['domain']}, lambda x: lower(x))", *[f"list_transform({every[k]}, {norm})" for k in ("drive", "registry", "unix")], f"list_transform({every['event']}, lambda x: 'event_id:' || x)"]
    return f"list_distinct(list_filter(flatten([{', '.join(parts)}]), lambda x: x <> ''))"


def sql_terms(text: str, terms: list[str]) -> str:
    single = [t for t in terms if " " not in t]
    return " + ".join([f"len(list_intersect(list_distinct(regexp_extract_all({text}, '{_TOKEN}')), {listed(single)}))", *[f"CASE WHEN contains({text}, '{t}') THEN 1 ELSE 0 END" for t in terms if " " in t]])


def _stepped(n: str, gains: list[tuple[int, float]]) -> str:
    return " + ".join(f"CASE WHEN {n} >= {k} THEN {g} ELSE 0.0 END" for k, g in gains)


def sql_decisions() -> str:
    """DuckDB CTEs up to ``decided``: issue counts by code, status and scores of every candidate."""
    ext = lambda p, g: f"regexp_extract_all(block, '{_LINE[p]}', {g})"
    named = lambda p, n: f"list_transform({ext(p, 1)}, lambda x: '{n}' || x)"
    refs = f"list_distinct(regexp_extract_all(z[2], '{_LINE['cited']}', 1))"
    empty = f"lambda x: list_contains({listed(_NOTHING)}, lower(trim(x)))"
    twice = lambda c: f"CASE WHEN len({c}) > len(list_distinct({c})) THEN 1 ELSE 0 END"
    none = lambda c: f"CASE WHEN len({c}) = 0 THEN 1 ELSE 0 END"
    zipped = lambda p, last: f"list_zip({ext(p, 1)}, {ext(p, 2)}, {ext(p, last)})"
    count = lambda lst, cond: f"len(list_filter({lst}, lambda z: {cond}))"
    links = " + ".join([
        "CASE WHEN list_filter(list_transform(string_split(response, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1] <> '<reasoning>' THEN 1 ELSE 0 END",
        "CASE WHEN regexp_matches(response, '(?m)^\\s*<reasoning>\\s*$') AND regexp_matches(response, '(?m)^\\s*</reasoning>\\s*$') THEN 0 ELSE 1 END",
        f"len(list_filter(list_transform(string_split(block, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, '{_LINE["known"]}')))",
        "len(list_filter(c, lambda x: NOT list_contains(sure, x)))",
        "CASE WHEN steps < 4 THEN 1 ELSE 0 END", none("e"), none("a"), none("c"), none("cv"), twice("e"), twice("a"), twice("c"), twice("cv"),
        f"len(list_filter({ext("e", 2)}, {empty}))",
        count(zipped("a", 3), f"len(list_filter({refs}, lambda r: NOT list_contains(e, r))) > 0"), f"len(list_filter({ext("a", 3)}, {empty}))",
        count(zipped("c", 2), f"len(list_filter({refs}, lambda r: (r[1] = 'E' OR r[1] = 'A') AND NOT list_contains(e, r) AND NOT list_contains(a, r))) > 0"),
        count(zipped("c", 2), f"NOT (list_has_any({refs}, e) AND list_has_any({refs}, a))"),
        f"len(list_filter({ext("sure", 3)}, {empty}))",
        count(zipped("cv", 3), f"len(list_filter({refs}, lambda r: NOT list_contains(c, r))) > 0"), f"len(list_filter({ext("cv", 3)}, {empty}))",
        "CASE WHEN final_answer = '' THEN 1 ELSE 0 END",
    ])
    id_check = lambda ids, shape, known: f"(CASE WHEN len(list_filter({ids}, lambda x: NOT regexp_matches(x, '{shape}'))) > 0 THEN 1 ELSE 0 END + CASE WHEN len(list_filter({ids}, lambda x: regexp_matches(x, '{shape}') AND NOT list_contains({listed(known)}, rtrim(x, '?')))) > 0 THEN 1 ELSE 0 END)"
    loose = lambda ids, pattern: f"CASE WHEN len(list_filter(regexp_extract_all(response, '{pattern}', 1), lambda x: NOT list_contains({ids}, x))) > 0 THEN 1 ELSE 0 END"
    tool = """regexp_replace(lower(trim(regexp_extract(replace(t, chr(92), '/'), '([^/]*)$', 1))), '\\.exe$', '')"""
    signal = "CASE category " + " ".join(f"WHEN '{k}' THEN {sql_terms('low', v)}" for k, v in SIGNALS.items()) + " ELSE 0 END"
    clamp = lambda x: f"greatest(1.0, least(5.0, round(({x})::DOUBLE, 3)))"
    n_words = lambda x: f"len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+'))"
    return f"""
WITH raw AS ({CANDIDATES.replace("{documents}", "documents")}),
split_up AS (
  SELECT r.*, list_filter(string_split(mitre, ','), lambda x: x <> '') AS m, list_filter(string_split(atlas, ','), lambda x: x <> '') AS al,
         list_filter(string_split(tools, ','), lambda x: x <> '') AS ts, list_filter(string_split(refs, ','), lambda x: x <> '') AS rf,
         d.source AS doc_source, chr(10) || chr(10) || d.text || chr(10) || '{{}}' AS corpus,
         regexp_extract(response, '{_LINE["block"]}', 1) AS block, regexp_matches(response, '{_LINE["block"]}') AS has,
         CASE WHEN contains(response, '</reasoning>') THEN trim(substr(response, strpos(response, '</reasoning>') + 12), chr(10) || ' ') ELSE '' END AS final_answer
  FROM raw r LEFT JOIN documents d ON r.source_doc_id = d.doc_id
),
ids AS (SELECT *, {named("e", "E")} AS e, {named("a", "A")} AS a, {named("c", "C")} AS c, {named("cv", "CV")} AS cv, {named("sure", "C")} AS sure FROM split_up),
stepped AS (
  SELECT *, len(e) + len(a) + len(c) + len(cv) AS steps, lower(final_answer) AS low,
         concat_ws(chr(10), instruction, response, array_to_string(m, ' '), array_to_string(al, ' '), array_to_string(ts, ' ')) AS output
  FROM ids
),
counted AS (
  SELECT *, CASE WHEN has THEN {links} ELSE 1 END AS links, CASE WHEN has AND steps > 24 THEN 1 ELSE 0 END AS too_long,
         {sql_indicators("output")} AS out_ind, {sql_indicators("corpus")} AS in_ind, {sql_indicators("final_answer")} AS answer_ind,
         {sql_tokens("corpus")} AS corpus_tokens, {sql_tokens("final_answer")} AS answer_tokens, {signal} AS n_signals, {sql_terms("low", _VERBS)} AS n_verbs, {sql_terms("low", _VAGUE)} AS n_generic
  FROM stepped
),
issues AS (
  SELECT *, doc_source IS NULL AS gone,
    CASE WHEN source <> doc_source THEN 1 ELSE 0 END AS n_mismatch,
    CASE WHEN NOT list_contains({listed(SIGNALS)}, category) THEN 1 ELSE 0 END AS n_category,
    CASE WHEN len(rf) = 0 THEN 1 ELSE 0 END + CASE WHEN len(list_filter(rf, lambda x: NOT list_contains({listed(ALL_REFS)}, x))) > 0 THEN 1 ELSE 0 END AS n_taxonomy,
    {id_check("m", f"^{_ATTACK}$", ATTACK_IDS)} AS n_attack, {id_check("al", f"^{_ATLAS}$", ATLAS_IDS)} AS n_atlas,
    {loose("m", f"\\b({_ATTACK})\\b")} + {loose("al", f"\\b({_ATLAS})\\b")} AS n_mapping,
    CASE WHEN len(list_filter(ts, lambda t: {tool} <> '' AND NOT list_contains({listed(TOOLS)}, {tool}) AND NOT contains(lower(corpus), lower(t)) AND NOT contains(lower(corpus), {tool}))) > 0 THEN 1 ELSE 0 END AS n_tools,
    CASE WHEN (grounding = 'source_only') = regexp_matches(response, '(?i)\\[GENERAL KNOWLEDGE\\]') THEN 1 ELSE 0 END AS n_grounding,
    CASE WHEN len(list_filter(out_ind, lambda x: NOT list_contains(in_ind, x))) > 0 THEN 1 ELSE 0 END AS n_invented
  FROM counted
),
scored AS (
  SELECT *,
    CASE WHEN gone THEN 'rejected' WHEN n_mismatch + n_category + n_taxonomy + n_attack + n_atlas + links + n_grounding + CASE WHEN grounding = 'source_plus_general' THEN 0 ELSE n_invented END > 0 THEN 'rejected'
         WHEN n_mapping + n_tools + too_long + n_invented > 0 THEN 'review' ELSE 'filtered' END AS quality_status,
    CASE WHEN n_invented > 0 AND grounding <> 'source_plus_general' THEN 1.0 WHEN n_grounding > 0 THEN 2.0 ELSE 5.0 END AS factual_accuracy,
    CASE WHEN links > 0 THEN 1.0 ELSE 5.0 END AS reasoning_quality,
    CASE WHEN final_answer = '' THEN 1.0 ELSE {clamp("2.0 + " + _stepped("n_signals", [(1, 1.0), (2, 0.75), (4, 0.5)]) + " + " + _stepped("n_verbs", [(1, 0.5), (3, 0.25)]) + " - least(n_generic, 3) * 0.4")} END AS operational_relevance,
    CASE WHEN final_answer = '' THEN 1.0 ELSE {clamp("CASE WHEN len(list_intersect(corpus_tokens, answer_tokens)) >= 6 THEN 4.5 WHEN len(list_intersect(corpus_tokens, answer_tokens)) >= 3 THEN 4.0 WHEN len(list_intersect(corpus_tokens, answer_tokens)) >= 1 THEN 3.0 ELSE 2.0 END + " + _stepped("len(answer_ind)", [(1, 0.5), (3, 0.25)]))} END AS specificity,
    {clamp(f"5.0 - CASE WHEN {n_words('final_answer')} < 25 THEN 1.5 ELSE 0 END - CASE WHEN len(regexp_extract_all(response, '{_LINE["cv"]}')) = 0 THEN 1.0 ELSE 0 END - CASE WHEN {n_words('response')} > 1200 THEN 1.25 WHEN {n_words('response')} > 900 THEN 0.75 WHEN {n_words('response')} > 600 THEN 0.25 ELSE 0 END")} AS completeness
  FROM issues
),
decided AS (SELECT *, round((0.25 * factual_accuracy + 0.25 * reasoning_quality + 0.2 * operational_relevance + 0.15 * specificity + 0.15 * completeness)::DOUBLE, 3) AS score_total FROM scored)
"""
