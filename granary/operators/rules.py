"""Row rules of the quality gate: issues, status and scores of a candidate against its source document.

``decided`` expects candidates already joined to their documents (columns ``doc_*``; all null where the document is
missing) and adds issues, status and the five scores. Every rule is a column expression; reference sets are small
policy tables and travel as array literals. What texts may hold is told for all rules by one search (functions/signs.py).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import indicators as I
from granary.functions import signs as S
from granary.functions import text as X
from granary.functions.values import clamped
from granary.operators import reasoning as R

_NUMBER = r"T[0-9]{4}(?:\.[0-9]{3})?\??"
MITRE, ATLAS = f"^{_NUMBER}$", rf"^AML\.{_NUMBER}$"
MITRE_IN, ATLAS_IN = rf"(?=T)\b({_NUMBER})\b", rf"(?=AML)\b(AML\.{_NUMBER})\b"
#: What both hold, without the costly test for a word's start.
NUMBER_SIGN = "T[0-9]{4}"
WEIGHTS = dict(zip("factual_accuracy reasoning_quality operational_relevance specificity completeness".split(), (0.25, 0.25, 0.2, 0.15, 0.15)))
PENALTIES = sorted(["this may indicate malicious activity", "suspicious activity", "check logs", "review logs", "more investigation is needed", "further investigation is needed", "further analysis is needed", "follow best practices", "consult your security team", "best practices"], key=len)
VERBS = "validate triage scope review query preserve pivot isolate inspect extract decode correlate confirm compare collect acquire".split()


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def mismatch(c: Column, doc_source: Column) -> Column:
    return R.when(c != doc_source, R.issue("source_mismatch", "reject", F.concat(c, F.lit(" is not "), doc_source)))


def category(c: Column, known: list[str]) -> Column:
    return R.when(~c.isin(known), R.issue("category_invalid", "reject", F.concat(F.lit("unknown category "), c)))


def taxonomy(refs: Column, known: list[str]) -> Column:
    bad = F.array_sort(F.array_except(refs, _array(known)))
    return F.concat(
        R.when(F.size(refs) == 0, R.issue("taxonomy_invalid", "reject", "no taxonomy reference")),
        R.when(F.size(bad) > 0, R.issue("taxonomy_invalid", "reject", F.concat(F.lit("unknown taxonomy references: "), F.array_join(bad, ", ")))),
    )


def _misshapen(ids: Column, shape: str) -> Column:
    return F.filter(ids, lambda x: ~F.regexp_like(x, F.lit(shape)))


def _unknown(ids: Column, shape: str, known: list[str]) -> Column:
    return F.array_sort(F.filter(ids, lambda x: F.regexp_like(x, F.lit(shape)) & ~F.array_contains(_array(known), F.regexp_replace(x, r"\?+$", ""))))


def mapping_ids(mitre: Column, atlas: Column, response: Column, attack_ids: list[str], atlas_ids: list[str], may_have: Column | None = None) -> Column:
    """may_have: false where the response has no number."""
    found = []
    for ids, shape, known, code in ((mitre, MITRE, attack_ids, "attack_id_invalid"), (atlas, ATLAS, atlas_ids, "atlas_id_invalid")):
        bad, new = _misshapen(ids, shape), _unknown(ids, shape, known)
        found.append(R.when(F.size(bad) > 0, R.issue(code, "reject", F.concat(F.lit("misshapen ids: "), F.array_join(bad, ", ")))))
        found.append(R.when(F.size(new) > 0, R.issue(code, "reject", F.concat(F.lit("ids outside the reference: "), F.array_join(new, ", ")))))
    may_have = F.regexp_like(response, F.lit(NUMBER_SIGN)) if may_have is None else may_have
    for ids, pattern, sign in ((mitre, MITRE_IN, "T"), (atlas, ATLAS_IN, "AML.T")):
        every = F.when(may_have & F.contains(response, F.lit(sign)), F.regexp_extract_all(response, F.lit(pattern), F.lit(1))).otherwise(_array([]))
        loose = F.array_sort(F.array_except(every, ids))
        found.append(R.when(F.size(loose) > 0, R.issue("mapping_inconsistency", "review", F.concat(F.lit("ids in the response alone: "), F.array_join(loose, ", ")))))
    return F.concat(*found)


def tools(names: Column, corpus: Column, allowed: list[str]) -> Column:
    low = F.lower(corpus)
    strange = F.array_sort(F.array_distinct(F.filter(names, lambda t: (X.tool_name(t) != "") & ~X.tool_name(t).isin(allowed) & ~F.contains(low, F.lower(t)) & ~F.contains(low, X.tool_name(t)))))
    return R.when(F.size(strange) > 0, R.issue("tool_name_unknown", "review", F.concat(F.lit("unknown tools: "), F.array_join(strange, ", "))))


def grounding(kind: Column, response: Column, may_have: Column | None = None) -> Column:
    """may_have: false where the response has no tag."""
    tagged = F.regexp_like(response, F.lit(X.GENERAL))
    tagged = tagged if may_have is None else F.when(may_have, tagged).otherwise(False)
    wrong = ((kind == "source_only") & tagged) | ((kind == "source_plus_general") & ~tagged)
    return R.when(wrong, R.issue("grounding_mismatch", "reject", F.concat(kind, F.lit(" contradicts the tags"))))


def output_text(instruction: Column, response: Column, *lists: Column) -> Column:
    return F.concat_ws("\n", instruction, response, *[F.array_join(x, " ") for x in lists])


def invented(output: Column, corpus: Column, kind: Column, may_have: dict[str, Column] | None = None) -> Column:
    """may_have: by pattern of the indicators, false where the output has none."""

    def found(new: Column) -> Column:
        message = F.concat(F.lit("not in the source: "), F.array_join(new, ", "))
        return F.when(F.size(new) == 0, F.array().cast(R.ISSUE)).when(kind == "source_plus_general", F.array(R.issue("invented_indicator", "review", message))).otherwise(F.array(R.issue("invented_indicator", "reject", message)))

    issues = X.let(I.invented(output, corpus, may_have), found)
    return issues if may_have is None else F.when(_any(may_have), issues).otherwise(F.array().cast(R.ISSUE))


def _any(tests: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a | b, tests.values())


def only(rows: DataFrame, test: Column) -> DataFrame:
    """rows where the test holds, filtered after their columns are made: else the optimiser makes what it reads twice.

    No filter moves below a column that isn't deterministic.
    """
    return rows.withColumn("_gr_row", F.monotonically_increasing_id()).filter(test & (F.col("_gr_row") >= 0)).drop("_gr_row")


def status(issues: Column) -> Column:
    return F.when(F.exists(issues, lambda x: x["severity"] == "reject"), "rejected").when(F.size(issues) > 0, "review").otherwise("filtered")


def _steps(n: Column, gains: list[tuple[int, float]]) -> Column:
    def sum_(n: Column) -> Column:
        out = F.lit(0.0)
        for least, gain in gains:
            out = out + F.when(n >= least, gain).otherwise(0.0)
        return out

    return X.let(n, sum_)


def relevance(answer: Column, category: Column, signals: dict[str, list[str]], verbs: list[str] = VERBS, penalties: list[str] = PENALTIES, may_have: Column | None = None) -> Column:
    """may_have: false where the answer has none of all the terms."""

    def score(low: Column, whole: Column) -> Column:
        hits = F.lit(0)
        for name, terms in signals.items():
            hits = F.when(category == name, X.term_count(low, whole, terms)).otherwise(hits)
        gained = F.lit(2.0) + _steps(hits, [(1, 1.0), (2, 0.75), (4, 0.5)]) + _steps(X.term_count(low, whole, verbs), [(1, 0.5), (3, 0.25)])
        return gained - F.least(X.term_count(low, whole, penalties), F.lit(3)) * 0.4

    def whole(low: Column) -> Column:
        terms = X.whole_terms(low, [*verbs, *penalties])
        for name, more in signals.items():
            terms = F.when(category == name, X.whole_terms(low, [*more, *verbs, *penalties])).otherwise(terms)
        return terms

    gained = X.let(F.lower(answer), lambda low: X.let(whole(low), lambda w: score(low, w)))
    gained = gained if may_have is None else F.when(may_have, gained).otherwise(2.0)
    return F.when(answer == "", 1.0).otherwise(X.let(gained, clamped))


def specificity(answer: Column, corpus: Column, may_have: dict[str, Column] | None = None) -> Column:
    """may_have: by pattern of the indicators, false where the answer has none.

    Where the openings share enough tokens, so do the whole texts, and these are read for tokens only where they don't."""
    shared = lambda a, b: F.size(F.array_intersect(X.distinctive_tokens(a), X.distinctive_tokens(b)))
    base = X.let(shared(corpus, answer), lambda n: F.when(n >= 6, 4.5).when(n >= 3, 4.0).when(n >= 1, 3.0).otherwise(2.0))
    for size in (500, 150):
        base = F.when(shared(X.opening(corpus, size), X.opening(answer, size)) >= 6, 4.5).otherwise(base)
    named = F.size(I.indicators(answer, may_have=may_have))
    named = named if may_have is None else F.when(_any(may_have), named).otherwise(0)
    return F.when(answer == "", 1.0).otherwise(X.let(base + _steps(named, [(1, 0.5), (3, 0.25)]), clamped))


def completeness(response: Column, answer: Column, most_words: Column | None = None, exact: Column | None = None) -> Column:
    """most_words: at most so many has the response; exact: whether it has as many."""
    lost = F.when(~X.has_words(answer, 25), 1.5).otherwise(0.0) + F.when(~F.regexp_like(response, F.lit(X.CAVEAT)), 1.0).otherwise(0.0)
    over = lambda n: X.has_words(response, n + 1) if most_words is None else F.when((most_words <= n) | exact, most_words > n).otherwise(X.has_words(response, n + 1))
    lost = lost + F.when((F.length(response) > 1200) & over(600), F.when(over(1200), 1.25).when(over(900), 0.75).otherwise(0.25)).otherwise(0.0)
    return X.let(F.lit(5.0) - lost, clamped)


def _rejected_for(issues: Column, code: str) -> Column:
    return F.exists(issues, lambda x: (x["code"] == code) & (x["severity"] == "reject"))


def _kinds(signs: Column) -> dict[str, Column]:
    """By pattern of the indicators, false where the output has none, nor the answer, which is a part of it."""
    return {p: S.has(signs, 1 << k) for k, p in enumerate(I.RE2_SIGNS)}


#: Rules in the order in which their issues stand.
RULES = ("schema", "source_missing", "source_mismatch", "category", "taxonomy", "mapping_ids", "tools", "reasoning", "grounding", "invented")


def checked(rows: DataFrame, policy: dict) -> DataFrame:
    """rows with one column of issues for each rule, ``issues_<rule>``: what isn't selected isn't evaluated.

    A row that is no candidate (column ``schema_problem``, null or absent where it is one) has that issue alone, one
    without its document ``source_missing`` alone.
    """
    c = F.col
    rows = rows.withColumn("final_answer", X.final_answer(c("response"))).withColumn("_gr_corpus", I.source_corpus(c("doc_title"), c("doc_url"), c("doc_text"), c("doc_metadata")))
    rows, parts = R.prepared(rows)
    lists = [c(k) for k in ("mitre_techniques", "atlas_techniques", "tools_referenced")]
    output = output_text(c("instruction"), c("response"), *lists)
    terms = [*VERBS, *PENALTIES, *(t for of in policy["signals"].values() for t in of)]
    rows = rows.withColumn("_gr_signs", S.signs(c("instruction"), c("response"), F.concat_ws("\n", *[F.array_join(x, " ") for x in lists]), c("final_answer"), list(I.RE2_SIGNS.values()), NUMBER_SIGN, X.GENERAL, terms))
    may_have = lambda sign: S.has(c("_gr_signs"), sign)
    bad = c("schema_problem").isNotNull() if "schema_problem" in rows.columns else F.lit(False)
    gone = c("doc_source").isNull()
    none = F.array().cast(R.ISSUE)
    found = {
        "source_mismatch": mismatch(c("source"), c("doc_source")), "category": category(c("category"), list(policy["signals"])), "taxonomy": taxonomy(c("taxonomy_refs"), policy["taxonomy"]),
        "mapping_ids": mapping_ids(c("mitre_techniques"), c("atlas_techniques"), c("response"), policy["attack_ids"], policy["atlas_ids"], may_have(S.NUMBER)), "tools": tools(c("tools_referenced"), c("_gr_corpus"), policy["tools"]),
        "reasoning": R.issues(c("response"), p=parts, answer=c("final_answer")), "grounding": grounding(c("grounding"), c("response"), may_have(S.GENERAL)), "invented": invented(output, c("_gr_corpus"), c("grounding"), _kinds(c("_gr_signs"))),
    }
    columns = {f"issues_{k}": F.when(bad | gone, none).otherwise(v) for k, v in found.items()}
    columns["issues_source_missing"] = R.when(gone & ~bad, R.issue("source_missing", "reject", F.concat(F.lit("no document "), F.coalesce(c("source_doc_id").cast("string"), F.lit("(null)")))))
    columns["issues_schema"] = R.when(bad, R.issue("schema_invalid", "reject", c("schema_problem"))) if "schema_problem" in rows.columns else none
    return rows.withColumns(columns).drop(*[f"_gr_{k}" for k in parts])


def decided(rows: DataFrame, policy: dict) -> DataFrame:
    """rows with issues, quality_status, final_answer and the scores; null scores where the source document is missing."""
    c = F.col
    rows = checked(rows, policy)
    rows = rows.withColumn("issues", F.concat(*[c(f"issues_{k}") for k in RULES])).drop(*[f"issues_{k}" for k in RULES]).withColumn("quality_status", status(c("issues")))
    scored = {
        "factual_accuracy": F.when(_rejected_for(c("issues"), "invented_indicator"), 1.0).when(_rejected_for(c("issues"), "grounding_mismatch"), 2.0).otherwise(5.0),
        "reasoning_quality": F.when(_rejected_for(c("issues"), "reasoning_links_invalid"), 1.0).otherwise(5.0),
        "operational_relevance": relevance(c("final_answer"), c("category"), policy["signals"], may_have=S.has(c("_gr_signs"), S.TERM)),
        "specificity": specificity(c("final_answer"), c("_gr_corpus"), _kinds(c("_gr_signs"))),
        "completeness": completeness(c("response"), c("final_answer"), c("_gr_signs")["words"], S.has(c("_gr_signs"), S.ASCII)),
    }
    there = ~F.exists("issues", lambda x: x["code"].isin("schema_invalid", "source_missing"))
    rows = rows.withColumns({k: F.when(there, v) for k, v in scored.items()})
    total = sum((c(k) * w for k, w in WEIGHTS.items()), F.lit(0.0)) / sum(WEIGHTS.values())
    return rows.withColumn("score_total", F.round(total, 3)).drop("_gr_corpus", "_gr_signs")
