"""Substring dedup by hashing lines: normalised units are grouped by digest over the whole corpus.

Each non-empty line is a unit, however short. Passages that documents share often stand within a line, so the shortest
runs of whole sentences with at least ``MIN_WORDS`` words are units too, from every sentence of a line on and back from
every sentence; a sentence ends with a word that ends with a full stop, question or exclamation mark. A unit goes from
its first word to its last and is normalised by lower case and single blanks; equal words are equal units, be they a
line or a run. Of equal units the one with the least (doc_id, start, end) is kept.

All later occurrences of a line are removed. A later occurrence of a run is removed where it stands in a line that
occurs once (a line that recurs goes or stays as a whole) and doesn't touch a run that is kept. So removed and kept
units never overlap: what is said to be kept is there, whole, when all that is removed is gone.

Nulls and edges: a null or empty text has no units; a very long text is read whole, as a step of its own; a row with a
null doc_id can't be ranked, so it neither removes nor loses anything; of equal rows (one doc_id twice) the copies rank
as one, so equal units at the same place of the same doc_id stay together; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.llm import common as C

MIN_WORDS = 20
_BLANKS = bytes(32 if C._SPACE[k] else k for k in range(256))
_STOPS = np.zeros(256, bool)
_STOPS[[33, 46, 63]] = True


def sentence_runs(words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentences of the shortest runs of MIN_WORDS words from each sentence on, and back from each; all within a line."""
    reach = np.cumsum(words)
    behind = reach - words
    last = np.searchsorted(reach, behind + MIN_WORDS)
    first = np.searchsorted(behind, reach - MIN_WORDS, "right") - 1
    on = last < len(words)
    on[on] = line[last[on]] == line[on]
    back = first >= 0
    back[back] = line[first[back]] == line[back]
    return np.concatenate([np.flatnonzero(on), first[back]]), np.concatenate([last[on], np.flatnonzero(back)])


def units_of(ids: pa.Array, text: pa.Array) -> pa.RecordBatch:
    raw, offs = C.text_buffer(text)
    chars = C.char_index(raw)
    ws, we, of = C.runs(~C._SPACE[raw], offs)
    breaks = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw == 10, out=breaks[1:])
    opens = np.ones(len(ws), bool)  # words that start a line
    opens[1:] = (of[1:] != of[:-1]) | (breaks[ws[1:]] != breaks[ws[:-1]])
    starts = opens.copy()  # and those that start a sentence
    starts[1:] |= _STOPS[raw[we[:-1] - 1]] if len(ws) else False
    # units as numbers of their first word and the one behind their last
    line_at = np.flatnonzero(opens)
    lines = line_at << 32 | np.append(line_at[1:], len(ws))[: len(line_at)]
    at = np.flatnonzero(starts)
    to = np.append(at[1:], len(ws))[: len(at)]
    first, last = sentence_runs(to - at, np.cumsum(opens)[at])
    runs = np.setdiff1d(at[first] << 32 | to[last], lines)
    both = np.concatenate([lines, runs])
    whole_line = np.arange(len(both)) < len(lines)
    at, to = both >> 32, both & ((1 << 32) - 1)
    whole = np.insert(raw, offs[1:-1], 10).tobytes().decode("utf-8", "replace").lower().encode()  # a word ends with its text
    said = [w for w in whole.translate(_BLANKS).split(b" ") if w]
    made = [hashlib.md5(b" ".join(said[x:y])).digest() for x, y in zip(at.tolist(), to.tolist())]
    digest = np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)
    doc = of[at]
    zero = chars[offs[doc]]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(doc)).cast(pa.int64()), pa.array((chars[ws[at]] - zero).astype(np.int32)), pa.array((chars[we[to - 1]] - zero).astype(np.int32)), pa.array(whole_line), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
        names=["doc_id", "start", "end", "line", "da", "db"],
    )


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.steps(batch):
            yield units_of(part.column(0), part.column(1))


def repeated_units(docs: DataFrame) -> DataFrame:
    """Every unit that stands at several places: doc_id, start, end, line, kept (a struct of doc_id, start and end).

    Only digests and positions are shuffled, once as map-side combined extremes by digest and once to meet them; a
    digest that millions of documents share is combined before the shuffle.
    """
    units = C.same_names(docs, "doc_id", "text").filter("doc_id is not null").mapInArrow(_units, "doc_id bigint, start int, end int, line boolean, da bigint, db bigint")
    place = F.struct("doc_id", "start", "end")
    kept = units.groupBy("da", "db").agg(F.min(place).alias("kept"), F.max(place).alias("last")).filter("kept <> last").drop("last")
    return units.join(kept, ["da", "db"]).select("doc_id", "start", "end", "line", "kept")


def removed_units(docs: DataFrame) -> DataFrame:
    """One row for each line or run to remove: doc_id, start, end (characters), line, kept_doc_id, kept_start, kept_end."""
    stays = F.struct("doc_id", "start", "end") == F.col("kept")
    by_start = Window.partitionBy("doc_id").orderBy("start")
    fixed = F.col("line") | stays
    before = F.max(F.when(fixed, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # from the far end on, so that both extremes run along: a frame up to the last row is read anew for each row
    from_end = Window.partitionBy("doc_id").orderBy(F.col("start").desc())
    behind = F.min(F.when(fixed, F.col("start"))).over(from_end.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    free = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(behind, F.col("end")) >= F.col("end"))
    out = repeated_units(docs).withColumn("free", free).filter(~stays & (F.col("line") | F.col("free")))
    return out.select("doc_id", "start", "end", "line", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"), F.col("kept.end").alias("kept_end"))


def without_units(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs with the removed units cut out of text, and the cut behind each with it; rows and columns are kept."""
    key, spans_ = C.fresh(docs, "_gr_id"), C.fresh(docs, "_gr_spans")
    spans = removed.groupBy(F.col("doc_id").alias(key)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(spans_))
    cutter = F.udf(cut_out, T.StringType(), useArrow=True)
    new = F.when(F.col(spans_).isNull(), docs["text"]).otherwise(cutter(docs["text"], F.col(spans_)))
    out = docs.join(spans, docs["doc_id"] == F.col(key), "left")
    return out.select(*[new.alias("text") if c == "text" else docs[f"`{c}`"] for c in docs.columns])


def cut_out(text: str | None, spans: list) -> str | None:
    if text is None or not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        out.append(text[at : max(s, at)])
        at = max(at, min(len(text), e + 1))
    out.append(text[at:])
    return "".join(out)


SQL = f"""
WITH lines AS (
  SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL AND text <> ''
), placed AS (
  SELECT rid, doc_id, unnest(list_transform(parts, lambda x, i: struct_pack(said := x, zero := list_sum(list_transform(parts[1:i], lambda y: length(y) + 1))::BIGINT - length(x) - 1))) AS l FROM lines
), cut AS (
  SELECT rid, doc_id, l.said AS said, l.zero AS zero,
         list_filter(regexp_extract_all(l.said, '(?:\\s*\\S*[^\\s.!?](?:\\s+|$))*(?:\\s*\\S*[.!?](?:\\s+|$))?'), lambda x: x <> '') AS parts FROM placed WHERE regexp_matches(l.said, '\\S')
), summed AS (
  SELECT *, list_transform(parts, lambda x, i: list_sum(list_transform(parts[1:i], lambda y: len(regexp_extract_all(y, '\\S+'))))::BIGINT) AS reach,
         list_transform(parts, lambda x, i: list_sum(list_transform(parts[1:i], lambda y: length(y)))::BIGINT) AS behind FROM cut
), starts AS (
  SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM summed
), counted AS (
  SELECT *, CASE WHEN i > 1 THEN reach[i - 1] ELSE 0 END AS before, CASE WHEN i > 1 THEN behind[i - 1] ELSE 0 END AS left_ FROM starts
), ends AS (
  SELECT *, len(list_filter(reach, lambda r: r < before + {MIN_WORDS})) + 1 AS j,
         len(list_filter(reach, lambda r: r <= reach[i] - {MIN_WORDS})) + 1 AS k FROM counted
), spans AS (
  SELECT rid, doc_id, said, zero, left_ AS s, behind[j] AS e, false AS line FROM ends WHERE j <= len(reach)
  UNION SELECT rid, doc_id, said, zero, CASE WHEN k > 1 THEN behind[k - 1] ELSE 0 END, behind[i], false FROM ends WHERE reach[i] >= {MIN_WORDS}
  UNION SELECT rid, doc_id, said, zero, 0, length(said), true FROM cut
), own AS (
  SELECT rid, doc_id, zero + s AS s, zero + e AS e, line, substr(said, s + 1, e - s) AS said FROM spans
), units AS (
  SELECT rid, doc_id, s + length(regexp_extract(said, '^\\s*')) AS start, e - length(regexp_extract(said, '\\s*$')) AS "end", bool_or(line) AS line,
         md5(lower(trim(regexp_replace(said, '\\s+', ' ', 'g')))) AS digest FROM own GROUP BY ALL
), kept AS (
  SELECT digest, min(struct_pack(doc_id := doc_id, start := start, "end" := "end")) AS kept FROM units GROUP BY digest HAVING kept <> max(struct_pack(doc_id := doc_id, start := start, "end" := "end"))
), found AS (
  SELECT doc_id, start, "end", line, kept, struct_pack(doc_id := doc_id, start := start, "end" := "end") = kept AS stays FROM units JOIN kept USING (digest)
)
SELECT doc_id, start::INT AS start, "end"::INT AS "end", line, kept.doc_id AS kept_doc_id, kept.start::INT AS kept_start, kept."end"::INT AS kept_end
FROM found f WHERE NOT stays AND (line OR NOT EXISTS (
  SELECT 1 FROM found o WHERE o.doc_id = f.doc_id AND (o.line OR o.stays) AND o.start < f."end" AND o."end" > f.start))
"""
