"""What the texts of a candidate may hold, told by RE2's automata in Arrow batches: the JVM's patterns take many times as long.

A sign says what a text may hold, never that it does. Exact expressions read the texts that have it, and nulls.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits beyond those of the kinds of indicators.
NUMBER, GENERAL, TERM, ASCII = (1 << k for k in range(20, 24))
WORD = np.zeros(256, np.bool_)
WORD[list(map(ord, string.ascii_letters + string.digits + "_"))] = True


def has(signs: Column, bits: int) -> Column:
    return signs["bits"].bitwiseAND(F.lit(bits)) != 0


def term_pattern(terms: list[str]) -> str | None:
    """What every text holds whose lower case has one of the terms, single words by themselves; None where that isn't known.

    The capital I with a dot alone becomes more than one character, of which the first is ASCII.
    """
    if not all(t.isascii() for t in terms):
        return None
    folded = {t: re.escape(t).replace("i", r"[i\x{130}]") for t in sorted(terms) if t}
    single, several = ["|".join(p for t, p in folded.items() if (" " in t) == s) for s in (False, True)]
    return "|".join([*([f"(?:^|[^a-zA-Z])(?i:{single})(?:$|[^a-zA-Z])"] if single else []), *([f"(?i:{several})"] if several else [])])


def _found(texts: pa.Array, pattern: str | None) -> np.ndarray:
    if not pattern:
        return np.full(len(texts), pattern is None)
    return pc.fill_null(pc.match_substring_regex(texts, pattern), True).to_numpy(zero_copy_only=False)


def most_words(texts: pa.Array, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """At most so many words, and whether the text is ASCII, for which the number is exact: any other character may be a word.

    So many rows at a time are looked at: the flags take a byte each of their bytes.
    """
    words, exact = np.zeros(len(texts), np.int64), np.ones(len(texts), np.bool_)
    for k in range(0, len(texts), rows):
        some = pc.fill_null(texts.slice(k, rows).cast(pa.large_binary()), b"")
        at = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + len(some) + 1]
        full = np.flatnonzero(at[:-1] < at[1:])  # rows without a byte have no part of the flags
        if not len(full):
            continue
        data, first = np.frombuffer(some.buffers()[2], np.uint8)[at[0] : at[-1]], at[full] - at[0]
        starts = WORD[data]
        after = starts[:-1].copy()
        after[first[1:] - 1] = False
        starts[1:] &= ~after
        total = lambda flags, first=first: np.add.reduceat(flags, first, dtype=np.int64)
        words[k + full], exact[k + full] = total(starts) + total(data >= 0xC0), total(data >= 0x80) == 0
    return words, exact


def signs(instruction: Column, response: Column, lists: Column, answer: Column, kinds: list[str], number: str, general: str, terms: list[str]) -> Column:
    """bits: of the kinds of indicators in instruction, response and lists as lines of one text, of an ATT&CK number and a
    tag in the response, of a term in the answer, of a response in ASCII. words: at most so many in the response.

    kinds, number and general are patterns of RE2's.
    """
    term, some = term_pattern(terms), "|".join(kinds)

    def run(instruction: pa.Array, response: pa.Array, lists: pa.Array, answer: pa.Array) -> pa.Array:
        output = pc.binary_join_element_wise(*[pc.fill_null(x, "") for x in (instruction, response, lists)], "\n")
        any_kind = _found(output, some)
        bits, texts = np.zeros(len(output), np.int32), output.filter(pa.array(any_kind))
        bits[any_kind] = sum(_found(texts, p).astype(np.int32) << k for k, p in enumerate(kinds))
        words, ascii_ = most_words(response)
        for found, bit in ((_found(response, number), NUMBER), (_found(response, general), GENERAL), (_found(answer, term), TERM), (ascii_, ASCII)):
            bits |= found.astype(np.int32) * np.int32(bit)
        return pa.StructArray.from_arrays([pa.array(bits), pa.array(words)], ["bits", "words"])

    run.__annotations__ = dict.fromkeys(("instruction", "response", "lists", "answer", "return"), pa.Array)
    return F.arrow_udf(run, "bits int, words bigint")(instruction, response, lists, answer)
