"""The reasoning-link grammar as one column expression: no rows move and no Python runs.

A response opens with a block of numbered evidence, analysis, conclusion and caveat lines that cite one another,
followed by the final answer. ``issues`` lists what is wrong with it in the order of the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X

_GAP, _REST = r"\s+", r"\s*(.*)$"
_VERB = {"A": "uses", "C": "uses", "CV": "applies_to"}


def _step(name: str, flags: str = "md") -> str:
    """The start of a step's line: its number and, in brackets, what it cites."""
    head = f"(?{flags})^{name}" + r"(\d+)"
    return head + _GAP + r"\[" + _VERB[name] + _GAP + r"([^\]]+)" + r"\]" if name in _VERB else head


BLOCK = "(?s)" + X.OPENING + r"\s*(.*?)\s*" + X.CLOSING
EVIDENCE = _step("E") + ":" + _REST
ANALYSIS = _step("A") + ":" + _REST
CONCLUSION = _step("C") + ".*$"
CONFIDENT = _step("C", "mid") + _GAP + "Confidence:" + _GAP + "(?:" + "|".join(("low", "medium", "high")) + r")\." + _REST
CAVEAT = _step("CV") + ":" + _REST
KNOWN = "^(?:" + "|".join([r"E\d+:", *[rf"{k}\d+{_GAP}\[{v}" for k, v in _VERB.items()]]) + ")"
REFERENCE = r"\b((?:CV|E|A|C)\d+)\b"
EMPTY = ["", "...", "[conclusion]", "[analysis of evidence]", "[source-grounded evidence]"]
ISSUE = "array<struct<code:string,severity:string,message:string>>"


def issue(code: str, severity: str, message: Column | str) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def when(test: Column, one: Column) -> Column:
    """An array of one issue where the test holds, else none."""
    return F.when(test, F.array(one)).otherwise(F.array().cast(ISSUE))


def _wrong(message: Column | str) -> Column:
    return issue("reasoning_links_invalid", "reject", message)


def _all(block: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(block, F.lit(pattern), F.lit(group))


def _is_empty(c: Column) -> Column:
    return F.lower(X.strip(c)).isin(EMPTY)


def _references(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1))))


def parts(response: Column, block: Column | None = None) -> dict[str, Column]:
    block = F.regexp_extract(response, BLOCK, 1) if block is None else block
    lead = lambda p, name: F.transform(_all(block, p, 1), lambda n: F.concat(F.lit(name), n))
    return {"block": block, "E": lead(EVIDENCE, "E"), "A": lead(ANALYSIS, "A"), "C": lead(CONCLUSION, "C"), "CV": lead(CAVEAT, "CV"), "sure": lead(CONFIDENT, "C")}


def prepared(rows: DataFrame, response: str = "response") -> tuple[DataFrame, dict[str, Column]]:
    """rows with the parts of the response as columns, so each is extracted once however often a check looks at it."""
    names = {k: f"_gr_{k}" for k in ("block", "E", "A", "C", "CV", "sure")}
    rows = rows.withColumn(names["block"], F.regexp_extract(F.col(response), BLOCK, 1))
    p = parts(F.col(response), F.col(names["block"]))
    return rows.withColumns({names[k]: p[k] for k in list(names)[1:]}), {k: F.col(n) for k, n in names.items()}


def _twice(ids: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(ids, lambda x: F.size(F.filter(ids, lambda y: y == x)) > 1)))


def issues(response: Column, least: int | None = 4, most: int | None = 24, strict: bool = True, p: dict[str, Column] | None = None, answer: Column | None = None) -> Column:
    """All issues of a response. strict: tags on their own lines, known lines only, confidences, and a final answer.

    p: the response's parts, from prepared(). answer: its final answer, where that is a column.
    """
    p = p or parts(response)
    block, e, a, c, cv = p["block"], p["E"], p["A"], p["C"], p["CV"]
    n = F.size(e) + F.size(a) + F.size(c) + F.size(cv)
    found: list[Column] = []
    if strict:
        first = X.strip(F.regexp_extract(response, f"(?s)\\A[{X.BLANKS}]*+(.*?)(?:{X.BREAK}|\\z)", 1))
        found.append(when(first != "<reasoning>", _wrong("the opening tag isn't the first line")))
        own = F.regexp_like(response, F.lit(r"(?md)^\s*<reasoning>\s*$")) & F.regexp_like(response, F.lit(r"(?md)^\s*</reasoning>\s*$"))
        found.append(when(~own, _wrong("a tag isn't on a line of its own")))
        odd = F.filter(F.transform(X.lines(block), X.strip), lambda x: (x != "") & ~F.regexp_like(x, F.lit(KNOWN)))
        found.append(F.transform(odd, lambda x: _wrong(F.concat(F.lit("unknown line: "), F.substring(x, 1, 80)))))
        found.append(F.transform(F.filter(c, lambda x: ~F.array_contains(p["sure"], x)), lambda x: _wrong(F.concat(x, F.lit(" has no confidence")))))
    if least is not None:
        found.append(when(n < least, _wrong(F.format_string(f"%d steps, fewer than {least}", n))))
    if most is not None:
        found.append(when(n > most, issue("reasoning_too_long", "review", F.format_string(f"%d steps, more than {most}", n))))
    names = (("evidence", e), ("analysis", a), ("conclusion", c), ("caveat", cv))
    found += [when(F.size(ids) == 0, _wrong(f"no {name}")) for name, ids in names]
    found += [when(F.size(_twice(ids)) > 0, _wrong(F.concat(F.lit(f"{name} numbered twice: "), F.array_join(_twice(ids), ", ")))) for name, ids in names]

    def each(pattern: str, name: str, rule) -> Column:
        """rule(id, references, text) over all lines of a class, flattened."""
        zipped = F.arrays_zip(_all(block, pattern, 1).alias("i"), _all(block, pattern, 2).alias("r"), _all(block, pattern, 3 if pattern != CONCLUSION else 2).alias("t"))
        return F.flatten(F.transform(zipped, lambda z: rule(F.concat(F.lit(name), z["i"]), _references(z["r"]), z["t"])))

    cites = lambda i, what, bad: when(F.size(bad) > 0, _wrong(F.concat(i, F.lit(f" cites unknown {what}: "), F.array_join(bad, ", "))))
    empty = lambda i, t: when(_is_empty(t), _wrong(F.concat(i, F.lit(" is empty"))))
    texts = F.arrays_zip(_all(block, EVIDENCE, 1).alias("i"), _all(block, EVIDENCE, 2).alias("t"))
    found.append(F.transform(F.filter(texts, lambda z: _is_empty(z["t"])), lambda z: _wrong(F.concat(F.lit("E"), z["i"], F.lit(" is empty")))))
    found.append(each(ANALYSIS, "A", lambda i, r, t: F.concat(cites(i, "evidence", F.array_except(r, e)), empty(i, t))))

    def conclusion(i: Column, r: Column, _: Column) -> Column:
        bad = F.filter(r, lambda x: F.substring(x, 1, 1).isin("E", "A") & ~F.array_contains(e, x) & ~F.array_contains(a, x))
        return F.concat(cites(i, "steps", bad), when(~(F.arrays_overlap(r, e) & F.arrays_overlap(r, a)), _wrong(F.concat(i, F.lit(" needs evidence and analysis")))))

    found.append(each(CONCLUSION, "C", conclusion))
    sure = F.arrays_zip(_all(block, CONFIDENT, 1).alias("i"), _all(block, CONFIDENT, 3).alias("t"))
    found.append(F.transform(F.filter(sure, lambda z: _is_empty(z["t"])), lambda z: _wrong(F.concat(F.lit("C"), z["i"], F.lit(" is empty")))))
    found.append(each(CAVEAT, "CV", lambda i, r, t: F.concat(cites(i, "conclusions", F.array_except(r, c)), empty(i, t))))
    if strict:
        found.append(when((X.final_answer(response) if answer is None else answer) == "", _wrong("no final answer")))
    missing = F.array(_wrong("no reasoning block"))
    return F.when(~F.regexp_like(response, F.lit(BLOCK)), missing).otherwise(F.concat(*found)).cast(ISSUE)
