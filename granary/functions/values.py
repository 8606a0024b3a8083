"""Expressions on numbers, dates, arrays and JSON."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions import text as X


def hash_bucket(c: Column, modulo: int) -> Column:
    """The first 48 bits of SHA-256, modulo: the same number in any engine and run."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 12), 16, 10).cast("bigint") % modulo


def by_weight(bucket: Column, weights: dict[str, float], size: int = 10_000) -> Column:
    """The label whose cumulative share of size the bucket falls under, the last one beyond all."""
    total, reach, out = sum(weights.values()), 0.0, None
    names = list(weights)
    for name in names:
        reach += weights[name] / total
        test = bucket / F.lit(size) < F.lit(reach)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(names[-1])


def backoff(attempt: Column, first: float = 1.0, most: float = 30.0, jitter: float = 0.0) -> Column:
    """Seconds before the next attempt: doubling, bounded, plus up to jitter seconds."""
    delay = F.least(F.lit(first) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0))), F.lit(most))
    return F.least(delay + F.rand() * jitter, F.lit(most)) if jitter > 0 else delay


def split_sizes(total: Column, train: float = 0.8, validation: float = 0.1) -> tuple[Column, Column, Column]:
    """Target sizes, halves rounded to even; the test split has the rest."""
    a = F.bround(total * F.lit(train)).cast("bigint")
    b = F.bround(total * F.lit(validation)).cast("bigint")
    return a, b, total - a - b


def clamped(c: Column, low: float = 1.0, high: float = 5.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), F.round(c, 3)))


def at_least(value: Column, minimum: str, order: list[str]) -> Column:
    """Whether value's place in order is that of minimum or beyond; unknown values are below all, an unknown minimum is the first."""
    floor = order.index(minimum) if minimum in order else 0
    return F.array_position(F.array(*map(F.lit, order)), value) - 1 >= floor


def timestamp(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def iso_date(c: Column) -> Column:
    """A date of the form 2024-01-31, else null."""
    return F.when(F.regexp_like(c, F.lit(r"\A\d{4}-\d{2}-\d{2}\z")), F.try_to_date(c, "yyyy-MM-dd"))


def ordinal(date: Column) -> Column:
    """Days since the day before 1 January of year 1."""
    return F.datediff(date, F.lit("1970-01-01").cast("date")) + 719163


def as_list(c: Column) -> Column:
    """A string as a list of one, none if null or empty; a list without its nulls and empties."""
    return F.filter(c, lambda x: x.isNotNull() & (x != ""))


def scalar_list(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.array(c))


def ordered_distinct(c: Column) -> Column:
    return F.array_distinct(as_list(c))


def names(c: Column) -> Column:
    """The name field of each struct, without nulls and empties."""
    return as_list(F.transform(c, lambda x: x["name"]))


def json_object(c: Column) -> Column:
    """The JSON object in a model's answer, as canonical text: the whole answer, a fenced block, or the first that decodes."""
    whole = X.json_fence(c)
    parsed = F.try_parse_json(whole)
    return F.when(F.regexp_like(whole, F.lit(r"\A\s*\{")) & parsed.isNotNull(), F.to_json(parsed)).otherwise(_first_object(c))


def _first_object(c: Column) -> Column:
    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder()

        def one(t: str | None) -> str | None:
            at = t.find("{") if t else -1
            while at >= 0:
                try:
                    return json.dumps(decoder.raw_decode(t, at)[0], separators=(",", ":"), ensure_ascii=False)
                except ValueError:
                    at = t.find("{", at + 1)
            return None

        return texts.map(one)

    return find(c)


def key_removed(c: Column, key: str) -> Column:
    """A JSON text without any field of this name, at every depth."""
    def clean(v):
        if isinstance(v, dict):
            return {k: clean(x) for k, x in v.items() if k != key}
        return [clean(x) for x in v] if isinstance(v, list) else v

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(clean(json.loads(t)), separators=(",", ":")))

    return run(c)


def content_text(parts: Column) -> Column:
    """Multipart content (array of type, text) as one text."""
    return F.array_join(F.transform(F.filter(parts, lambda p: (p["type"] == "text") & p["text"].isNotNull()), lambda p: p["text"]), "\n")
