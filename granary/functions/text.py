"""Text expressions: all JVM-side, none needs Python workers.

Regular expressions follow Python's reading of the same patterns: ``(?U)``-style classes where letters of all
scripts count, ``(?d)`` where only a line feed ends a line. A null argument gives a null.
"""

from __future__ import annotations

import re
import string
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
#: Spelt out, a set is searched for faster than as ranges.
ALNUM = string.digits + string.ascii_letters
TOKEN = r"[a-zA-Z][\w.\\/-]{2,}"
#: Longest first; membership is what counts.
STOPWORDS = "because between which where would those there these their should could before being about after your with will when this that more into have from does been also".split()
EDGES = r"""[.,:;()\[\]{}'"`]+"""
BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
OPENING, CLOSING, GENERAL = "<reasoning>", "</reasoning>", r"(?i)\[GENERAL KNOWLEDGE\]"


CAVEAT = r"(?md)^CV([0-9]+)\s+\[applies_to\s+([^\]]+)\]:\s*(.*)$"


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def has_words(c: Column, least: int) -> Column:
    """word_count(c) >= least, without a list of the words: read from the start as far as the last word that decides."""
    inner = WORD[1:-2]
    return F.regexp_like(c, F.lit(rf"\A[^{inner}]*+(?:[{inner}]++[^{inner}]*+){{{least}}}+"))


#: White space that strips off: ASCII's, the separators, next line, no-break space, line and paragraph separators.
BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029"


def let(value: Column, f) -> Column:
    """f of a value that is evaluated once, however often f refers to it."""
    return F.element_at(F.transform(F.array(value), lambda x: f(x)), 1)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def single_line(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"[\s\x1c-\x1f\x85   ]+", " "))


def trimmed_edges(c: Column, edges: str = EDGES) -> Column:
    return F.regexp_replace(c, f"^{edges}|{edges}$", "")


def raw_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1))


def distinctive_tokens(c: Column) -> Column:
    """Distinct lower-case tokens of four characters or more without stop words, in order of appearance.

    Of the characters of EDGES a raw token can have full stops alone, and these at its end.
    """
    cut = F.transform(raw_tokens(c), lambda t: F.lower(F.rtrim(t, F.lit("."))))
    return F.array_distinct(F.filter(cut, lambda t: (F.length(t) >= 4) & ~t.isin(STOPWORDS)))


def opening(c: Column, size: int) -> Column:
    """The text's start as far as the last white space in size characters: its tokens are the text's first ones."""
    return F.regexp_extract(F.substring(c, 1, size + 1), rf"(?s)\A.{{0,{size}}}(?=\s)", 0)


def final_answer(c: Column) -> Column:
    """What follows the first closing tag; empty where there is none."""
    at = F.locate(CLOSING, c)
    return F.when(at > 0, strip(F.substr(c, at + F.lit(len(CLOSING))))).when(c.isNotNull(), F.lit(""))


def caveats(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(CAVEAT), F.lit(3)), strip)


def slug(c: Column, fallback: str = "") -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out == "", F.lit(fallback)).otherwise(out)


def file_name(c: Column, fallback: str = "prompt") -> Column:
    out = F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9_.-]+", "-"), "^-+|-+$", "")
    return F.when(out == "", F.lit(fallback)).otherwise(out)


def label(c: Column) -> Column:
    """Lower-case run label: everything but letters and digits is an underscore, none at the ends."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", "_")), "^_+|_+$", "")


def middle_cut(c: Column, size: int, marker: str = "\n\n[... middle of the document left out ...]\n\n") -> Column:
    """The first two thirds and the last third of size characters, where c is longer."""
    head = size * 2 // 3
    tail = size - head
    cut = F.concat(F.regexp_replace(F.substring(c, 1, head), r"\s+$", ""), F.lit(marker), F.regexp_replace(F.substring(c, -tail, tail), r"^\s+", ""))
    return F.when(F.length(c) > size, cut).otherwise(c)


def limited(c: Column, size: int) -> Column:
    c = strip(c)
    return F.when(F.length(c) > size, F.concat(F.regexp_replace(F.substring(c, 1, size), r"\s+$", ""), F.lit("\n[truncated]"))).otherwise(c)


def tool_name(c: Column) -> Column:
    """A tool's plain name: no quotes, folders or .exe; single blanks; lower case."""
    bare = F.replace(F.regexp_replace(strip(c), "^[`'\"]+|[`'\"]+$", ""), F.lit("\\"), F.lit("/"))
    name = F.regexp_extract(F.regexp_replace(bare, "/+$", ""), "([^/]*)$", 1)
    return F.regexp_replace(F.lower(single_line(name)), r"\.exe$", "")


def cell(c: Column) -> Column:
    """A Markdown table cell."""
    return single_line(F.replace(c, F.lit("|"), F.lit("\\|")))


def whole_terms(low: Column, terms: list[str]) -> Column:
    """Those of the single words that are raw tokens of a text in lower case, each once.

    Raw tokens are runs of token characters from their first letter on, so a word is one where nothing but other
    characters stands before it in its run and nothing after it. No other token is made.
    """
    single = sorted({t for t in terms if re.fullmatch(TOKEN, t, re.ASCII)})
    if not single:
        return F.array().cast("array<string>")
    first, rest = "".join(sorted({t[0] for t in single})), r"\\/.-"
    pattern = rf"[^{ALNUM}_{rest}][0-9_{rest}]*+(?=[{first}])(" + "|".join(map(re.escape, single)) + rf")(?![\w{rest}])"
    return F.array_distinct(F.regexp_extract_all(F.concat(F.lit(" "), low), F.lit(pattern), F.lit(1)))


def term_count(low: Column, whole: Column, terms: list[str]) -> Column:
    """How many of the terms occur in a text in lower case, given its whole_terms(): read more than once, as is low."""
    several, single = [t for t in terms if " " in t], [t for t in terms if t and " " not in t]
    count = F.size(F.array_intersect(whole, F.array(*map(F.lit, single)))) if single else F.lit(0)
    if not several:
        return count
    held = reduce(lambda a, t: a + F.when(F.contains(low, F.lit(t)), 1).otherwise(0), several, F.lit(0))
    ends = F.lit(" (?:" + "|".join(sorted({re.escape(t[t.index(" ") + 1 :]) for t in several})) + ")")
    return count + (F.when(F.regexp_like(low, ends), held).otherwise(0) if len(several) > 2 else held)


def matching_terms(c: Column, terms: list[str]) -> Column:
    """How many of the terms occur: those of several words anywhere in the text, single words as whole raw tokens."""
    return let(F.lower(c), lambda low: let(whole_terms(low, terms), lambda whole: term_count(low, whole, terms)))


def lines(c: Column) -> Column:
    return F.split(c, BREAK)


def trimmed_lines(c: Column) -> Column:
    """Blanks and tabs off the ends of lines, white space off the ends of the text."""
    return strip(F.array_join(F.transform(lines(c), lambda x: F.regexp_replace(x, "[ \t]+$", "")), "\n"))


def front_matter(c: Column) -> tuple[Column, Column]:
    """YAML front matter and body; an empty string and the whole text where there is none."""
    rule = r"---\s*\n"
    pattern = r"(?s)\A" + rule + r"(.*?)\n" + rule + "?" + r"(.*)\z"
    has = F.regexp_like(c, F.lit(pattern))
    return F.when(has, F.regexp_extract(c, pattern, 1)).otherwise(""), F.when(has, F.regexp_extract(c, pattern, 2)).otherwise(c)


def json_fence(c: Column) -> Column:
    """The content of one outer code fence, else the stripped text."""
    pattern = r"(?is)\A```" + r"(?:json)?\s*" + r"(.*?)\s*```\z"
    c = strip(c)
    return F.when(F.regexp_like(c, F.lit(pattern)), strip(F.regexp_extract(c, pattern, 1))).otherwise(c)


def blob_url(repository: str, ref: str, path: Column) -> Column:
    """The address of a file in a hosted repository; each part of the path is percent-encoded, slashes stay."""
    base = repository.removesuffix(".git").rstrip("/")
    encoded = F.array_join(F.transform(F.split(path, "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
    return F.concat(F.lit(f"{base}/blob/{ref}/"), encoded)
