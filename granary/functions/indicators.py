"""Concrete indicators in texts: vulnerabilities, hashes, addresses, domains, paths and event numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions import text as X

TOP_DOMAINS = sorted("app au biz br ca cloud cn co com de dev edu fr gov info io jp mil net nl online org ru site tech uk".split(), reverse=True)
_BYTE = r"(?:1?\d?\d|2[0-4]\d|25[0-5])"
_HIVES = "HKEY_(?:CURRENT_(?:CONFIG|USER)|LOCAL_MACHINE|CLASSES_ROOT|USERS)|HK(?:LM|CU|CR|U|CC)"
_ROOTS = "|".join(sorted("Applications Library System Users Volumes bin etc home opt private root sbin tmp usr var".split(), reverse=True))
#: What a match starts with is looked for before the costly test for a word's start, which says nothing new of it.
CVE = r"(?i)(?=C)\b(CVE-[0-9]{4}-[0-9]{4,7})\b"
HASH = r"\b([0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})\b"
IPV4 = rf"(?=[0-9])\b((?:{_BYTE}\.){{3}}{_BYTE})\b"
DOMAIN = rf"(?<!\w)(?=[0-9A-Za-z-]++\.)\b((?:[0-9A-Za-z](?:[0-9A-Za-z-]{{0,61}}[0-9A-Za-z])?\.)+(?:{'|'.join(TOP_DOMAINS)}))\b"
DRIVE = r"""(?i)(?=[A-Z]:)\b([A-Z]:\\[^\s"'<>|]+)"""
REGISTRY = rf"(?i)(?=HK)\b((?:{_HIVES})\\[\w\\/*.$%{{}}-]+)"
UNIX = rf"""(/(?<!\w/)(?:{_ROOTS})/[^\s"'<>]+)"""
EVENT = r"(?i)(?=E(?:ID|VENT))\b(?:EID|Event\s+ID)\s*[-:#]?\s*([0-9]{3,5})\b"
#: What every match of a pattern holds, without the costly tests for a word's start: a rare letter or sign comes first,
#: and sets of characters are spelt out, which are the fastest to search for.
_CVE_END, _DOMAIN_END, _IP_END, _UNIX_END, _EVENT_END = "(?<=[cC][vV][eE]-)[0-9]", f"(?:{'|'.join(TOP_DOMAINS)})", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]", f"(?:{_ROOTS})/", r"(?<=[iI][dD])\s*[-:#]?\s*[0-9]{3}"
SIGNS = {CVE: "-" + _CVE_END, HASH: "[0123456789abcdefABCDEF]{32}", IPV4: r"\." + _IP_END, DOMAIN: r"\." + _DOMAIN_END, DRIVE: r":\\", REGISTRY: r"\\", UNIX: "/" + _UNIX_END, EVENT: "[dD]" + _EVENT_END}
#: All of them but the hash's as one pattern.
ANY_SIGN = rf"[-.\\/dD](?:{_CVE_END}|(?<=\.)(?:{_IP_END}|{_DOMAIN_END})|(?<=\\)|(?<=/){_UNIX_END}|{_EVENT_END})"

_SPACE = r"[ \t\n\x0b\f\r]*"
#: The signs in RE2's syntax.
RE2_SIGNS = {CVE: "[cC][vV][eE]-[0-9]", HASH: "[0-9a-fA-F]{32}", IPV4: r"\." + _IP_END, DOMAIN: r"\." + _DOMAIN_END, DRIVE: r":\\", REGISTRY: r"\\", UNIX: "/" + _UNIX_END, EVENT: f"[iI][dD]{_SPACE}[-:#]?{_SPACE}[0-9]{{3}}"}


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(1))


def _some(c: Column, pattern: str, may_have: dict[str, Column] | None = None, sign: bool = True) -> Column:
    """As _all, for texts that hold the pattern's sign; others aren't searched. may_have: by pattern, false where no match counts."""
    tests = ([may_have[pattern]] if may_have else []) + ([F.regexp_like(c, F.lit(SIGNS[pattern]))] if sign else [])
    return F.when(reduce(lambda a, b: a & b, tests), _all(c, pattern)).otherwise(F.array().cast("array<string>"))


def normalised(c: Column) -> Column:
    return F.lower(F.regexp_replace(X.trimmed_edges(c), r"[\\/]+$", ""))


def indicators(c: Column, paths: bool = True, events: bool = True, may_have: dict[str, Column] | None = None, sign: bool | None = None) -> Column:
    """Distinct indicators of a text, sorted. may_have: by pattern, false where the text has none of the kind, or none that
    counts; signs are looked for in its place, or besides where sign is true."""
    some = lambda p: _some(c, p, may_have, may_have is None or bool(sign))
    parts = [F.transform(some(CVE), F.upper), F.transform(some(HASH), F.lower), some(IPV4), F.transform(some(DOMAIN), F.lower)]
    if paths:
        parts += [F.transform(some(p), normalised) for p in (DRIVE, REGISTRY, UNIX)]
    if events:
        parts.append(F.transform(some(EVENT), lambda x: F.concat(F.lit("event_id:"), x)))
    return F.when(c.isNotNull(), F.array_sort(F.array_distinct(F.filter(F.concat(*parts), lambda x: x != ""))))


def may_have(c: Column) -> Column:
    """False for texts that have no indicator, as has no part of them; most texts are read twice for this and no more."""
    return F.regexp_like(c, F.lit(ANY_SIGN)) | F.regexp_like(c, F.lit(SIGNS[HASH]))


def invented(output: Column, source: Column, may_have: dict[str, Column] | None = None) -> Column:
    """Indicators of the output that the source doesn't have, sorted.

    may_have: by pattern, false where the output has none; no two kinds share an indicator, so the source's don't count then.
    """
    new = lambda found: F.when((F.size(found) == 0) & source.isNotNull(), found).otherwise(F.array_sort(F.array_except(found, indicators(source, may_have=may_have, sign=True))))
    return X.let(indicators(output, may_have=may_have), new)


def source_corpus(title: Column, url: Column, markdown: Column, metadata_json: Column) -> Column:
    return F.concat_ws("\n", *[F.coalesce(c, F.lit("")) for c in (title, url, markdown, metadata_json)])
