"""Personal data by a semi-Markov conditional random field.

The model scores whole segments: a candidate span and a type get the sum of the weights of the span's features
(its shape, numbers of digits, octet and check-digit tests, what stands before and behind it), and neighbouring
segments a transition weight; tokens outside of entities are segments of one token. The Viterbi recursion over
segments of at most ``LONGEST`` tokens chooses boundaries and types jointly. Weights are fitted by ``fit``: maximum
likelihood, with segment marginals from the forward-backward recursion, on lines that a seeded generator writes
(entities in many forms among versions, dates, prices, identifiers and handles). They lie beside this module, so
no query waits for the fit; ``python -m granary.llm.pii`` makes them anew.

Every entity holds an ASCII digit or an @, and so does each of its parts between blanks; that is what a candidate
is. Names, streets and account numbers with a group of letters alone between blanks aren't found. So the text
splits into islands, runs of adjacent white-space separated chunks that hold one; outside of them the best
segmentation is known, and only islands are searched. They are found by array operations over whole texts.

Nulls and edges: null and empty texts have no entities; rows with a null doc_id are read like any other and carry
the null; equal rows give equal rows; of segmentations that score the same the one that is reached first stands; a
very long text is read whole, a long island of it block by block; the masking step keeps all rows and columns, sets
``n_chars`` to the new length where it changes a text, and leaves other columns alone, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import pkgutil
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm import common as C

KINDS = ("EMAIL", "PHONE", "IP", "CARD", "SECRET", "ID", "IBAN")
OUT = len(KINDS)  # the state outside of entities; also that before an island
LONGEST = 24
LINES, EPOCHS, STEP, DECAY, SEED = 1500, 6, 0.5, 1e-3, 7
CONTEXT = 32
#: Tokens of a long island, and spans of short ones, that are scored at once.
BLOCK, SPANS = 2048, 8192
WEIGHTS = "pii_weights.json"

_TOKEN = re.compile(r"[^\W_]+|\s+|[\W_]", re.UNICODE)
# digits are those of ASCII: others, as raised ones, are letters like any
_RUNS = re.compile(r"[0-9]+|[^\W0-9_]+")
_DIGITS = re.compile(r"[0-9]+")
_EMAIL = re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_GROUPS = re.compile(r"[0-9A-Fa-f]{1,4}(::?[0-9A-Fa-f]{1,4}){1,7}")
_BEFORE = re.compile(r"[^\W_]+")


def _bucket(n: int) -> str:
    return str(n) if n <= 4 else "5-6" if n <= 6 else "7-9" if n <= 9 else "10-12" if n <= 12 else "13-16" if n <= 16 else "17-19" if n <= 19 else "20-31" if n <= 31 else "32+"


def _digit(s: str) -> bool:
    return s.isascii() and s.isdigit()


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _mod_97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _side(c: str) -> str:
    return "edge" if not c else "digit" if _digit(c) else "letter" if c.isalnum() else "space" if c.isspace() else c


def span_features(s: str, before: str, after: str, word: str) -> list[str]:
    """Features of the span s; before, after: the characters beside it; word: the word before it."""
    shape = _RUNS.sub(lambda m: "9" if _digit(m.group()[0]) else "a", s)
    digits = _DIGITS.findall(s)
    n = sum(map(len, digits))
    out = ["bias", "n" + _bucket(n), "b" + _side(before), "a" + _side(after), "w" + word]
    if len(shape) <= 24:
        out.append("s" + shape)
        if len(s) <= 24 and "@" not in s:
            out.append("f" + re.sub(r"[0-9]", "9", _RUNS.sub(lambda m: m.group() if _digit(m.group()[0]) else "a", s)))
    if "@" in s:
        out.append("email" if _EMAIL.fullmatch(s) else "at")
    parts = s.split(".")
    if len(parts) == 4 and all(_digit(p) and len(p) <= 3 for p in parts):
        out.append("octets" if all(int(p) <= 255 for p in parts) else "big octets")
    if len(parts) > 4 and all(_digit(p) for p in parts):
        out.append("many parts")
    if ":" in s and _GROUPS.fullmatch(s):
        colons = s.count(":")
        out.append("v6" if s.count("::") == 1 and colons <= 7 or colons == 7 and "::" not in s else f"groups{min(colons, 8)}")
    flat = s.replace(" ", "")
    if 15 <= len(flat) <= 34 and _IBAN.fullmatch(flat):
        out += ["account", "mod 97" if _mod_97(flat) else "not mod 97"]
    if s.isalnum():
        kind = "digits" if _digit(s) else "hex" if all(c in "0123456789abcdefABCDEF" for c in s) else "word"
        out += [f"{kind}{_bucket(len(s))}", kind]
        if kind == "word" and n and len(s) >= 16:
            turns = sum(_digit(a) != _digit(b) for a, b in zip(s, s[1:]))
            out.append("mixed" + _bucket(turns))
    elif 13 <= n <= 19 and not s.strip("0123456789 -"):
        out.append("grouped card")
    if 13 <= n <= 19 and not s.strip("0123456789 -"):
        out.append("luhn" if _luhn("".join(digits)) else "no luhn")
    if s[0] in "+(":
        out.append("^" + s[0])
    if " " in s:
        out.append("blank")
    return out


class Island:
    """Tokens of a stretch of text and its candidate spans with their features."""

    def __init__(self, text: str, before: str, after: str) -> None:
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        self.text, self.after = text, after
        self.kinds = [0 if text[a].isspace() else 1 if text[a].isalnum() else 2 for a, _ in self.tokens]
        self.marked = [any(c in "0123456789@" for c in text[a:b]) for a, b in self.tokens]
        self.context, self.skip = before + text, len(before)

    def between(self, first: int, last: int) -> tuple[list[tuple[int, int]], list[list[str]]]:
        """The candidate spans that start at tokens first..last-1, and their features."""
        spans: list[tuple[int, int]] = []
        found: list[list[str]] = []
        text, tokens, kinds, n = self.text, self.tokens, self.kinds, len(self.tokens)
        for i in range(first, min(last, n)):
            a = tokens[i][0]
            if kinds[i] == 0 or kinds[i] == 2 and text[a] not in "+(":
                continue
            words = _BEFORE.findall(self.context[max(0, self.skip + a - CONTEXT) : self.skip + a])
            word = words[-1].lower() if words and not _digit(words[-1]) else ""
            left = self.context[self.skip + a - 1 : self.skip + a] if self.skip + a else ""
            part = False  # the part since the last blank holds a mark
            for j in range(i, min(n, i + LONGEST)):
                if kinds[j] == 0:
                    if not part:
                        break
                    part = False
                    continue
                part |= self.marked[j]
                if kinds[j] == 1 and part:
                    b = tokens[j][1]
                    spans.append((i, j + 1))
                    found.append(span_features(text[a:b], left, text[b] if b < len(text) else self.after[:1], word))
        return spans, found

    @cached_property
    def whole(self) -> tuple[list[tuple[int, int]], list[list[str]]]:
        return self.between(0, len(self.tokens))

    @property
    def spans(self) -> list[tuple[int, int]]:
        return self.whole[0]

    @property
    def found(self) -> list[list[str]]:
        return self.whole[1]


class Model:
    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.weights = np.zeros((0, OUT))
        self.transitions = np.zeros((OUT + 1, OUT + 1))

    def scored(self, found: list[list[str]]) -> np.ndarray:
        """Scores by type of spans with these features, summed by one array operation."""
        if not found:
            return np.zeros((0, OUT))
        number, none = self.number, len(self.weights)
        ids = np.array([number.get(f, none) for span in found for f in span], np.int64)
        first = np.cumsum([0, *map(len, found)])[:-1]
        return np.add.reduceat(np.vstack([self.weights, np.zeros((1, OUT))])[ids], first, axis=0)

    def scores(self, island: Island) -> np.ndarray:
        """Scores of the island's spans by type."""
        return self.scored(island.found)

    def best(self, island: Island, spans: list[tuple[int, int]] | None = None, score: np.ndarray | None = None) -> list[tuple[int, int, int]]:
        """Segments (start, end, type) in characters of the island, by Viterbi over segments.

        Spans and scores are made here, BLOCK tokens at a time, where they aren't given: so a text that is one
        long island takes no more memory than its back pointers.
        """
        n, t, given = len(island.tokens), self.transitions, spans
        value = np.full((n + 1, OUT + 1), -np.inf)
        value[0, OUT] = 0.0
        from_token, from_type = np.zeros((n + 1, OUT + 1), np.int32), np.zeros((n + 1, OUT + 1), np.int8)
        types = np.arange(OUT)
        for block in range(0, n, BLOCK):
            if given is None:
                spans, found = island.between(block, block + BLOCK)
                score = self.scored(found)
            k = 0 if given is None else bisect_left(spans, (block, 0))
            for i in range(block, min(n, block + BLOCK)):
                v = value[i] + t[:, OUT]
                y = int(v.argmax())
                value[i + 1, OUT], from_token[i + 1, OUT], from_type[i + 1, OUT] = v[y], i, y
                if k < len(spans) and spans[k][0] == i:
                    reach = value[i][:, None] + t[:, :OUT]
                    y_of = reach.argmax(axis=0)
                    top = reach[y_of, types]
                    while k < len(spans) and spans[k][0] == i:
                        j = spans[k][1]
                        v = top + score[k]
                        for y in np.flatnonzero(v > value[j, :OUT]).tolist():
                            value[j, y], from_token[j, y], from_type[j, y] = v[y], i, y_of[y]
                        k += 1
        out, j, y = [], n, int(value[n].argmax())
        while j:
            i, before = int(from_token[j, y]), int(from_type[j, y])
            if y != OUT:
                out.append((island.tokens[i][0], island.tokens[j - 1][1], y))
            j, y = i, before
        return out[::-1]

    def gradient(self, island: Island, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Gold minus expected counts, of spans by type and of transitions; gold in tokens."""
        n, spans = len(island.tokens), island.spans
        score = self.scores(island)
        t = self.transitions
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j) in enumerate(spans):
            starting[i].append(k), ending[j].append(k)
        alpha = np.full((n + 1, OUT + 1), -np.inf)
        alpha[0, OUT] = 0.0
        reach = np.full((n + 1, OUT + 1), -np.inf)  # by the next segment's type

        def total(x: np.ndarray) -> np.ndarray:
            top = x.max(axis=0)
            top = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                return top + np.log(np.exp(x - top).sum(axis=0))

        for j in range(n + 1):
            if j:
                alpha[j, OUT] = reach[j - 1, OUT]
                if ending[j]:
                    alpha[j, :OUT] = total(np.array([reach[spans[k][0], :OUT] + score[k] for k in ending[j]]))
            reach[j] = total(alpha[j][:, None] + t)
        z = float(total(alpha[n]))
        beta = np.zeros((n + 1, OUT + 1))
        follow = np.full((n + 1, OUT + 1), -np.inf)  # by the type of the segment that starts here
        expected, pairs = np.zeros((len(spans), OUT)), np.zeros((OUT + 1, OUT + 1))
        for i in range(n - 1, -1, -1):
            follow[i, OUT] = beta[i + 1, OUT]
            if starting[i]:
                each = np.array([score[k] + beta[spans[k][1], :OUT] for k in starting[i]])
                follow[i, :OUT] = total(each)
                expected[starting[i]] = np.exp(reach[i, :OUT] + each - z)
            beta[i] = total((t + follow[i][None, :]).T)
            pairs += np.exp(alpha[i][:, None] + t + follow[i][None, :] - z)
        at = {s: k for k, s in enumerate(spans)}
        seen, state, place = np.zeros_like(pairs), OUT, 0
        for i, j, y in gold:
            for _ in range(i - place):
                seen[state, OUT] += 1
                state = OUT
            seen[state, y] += 1
            state, place = y, j
            expected[at[i, j], y] -= 1
        for _ in range(n - place):
            seen[state, OUT] += 1
            state = OUT
        return -expected, seen - pairs


# ---------------------------------------------------------------- training lines


_SYLLABLES = "ba be bi bo da de di do fa fe fi ga ge go ha he hi ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi wa we zu schu mente eau tion".split()


class _Writer:
    """Random pieces of text; what they look like is a matter of the world's formats, not of any table's."""

    def __init__(self, rng: random.Random) -> None:
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def of(self, alphabet: str, n: int) -> str:
        return "".join(self.rng.choice(alphabet) for _ in range(n))

    def num(self, n: int) -> str:
        return self.of("0123456789", n)

    def hexa(self, n: int) -> str:
        return self.of("0123456789abcdef", n)

    def upper(self, n: int) -> str:
        return self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", n)

    def domain(self) -> str:
        top = self.rng.choice(("com", "org", "net", "de", "io", "edu", "co.uk"))
        host = self.rng.choice((self.word(), f"{self.word()}-{self.word()}", f"{self.word()}{self.num(self.rng.randint(1, 2))}"))
        return f"{host}.{self.word()}.{top}" if self.rng.random() < 0.4 else f"{host}.{top}"

    def email(self) -> str:
        a, b, n = self.word(), self.word(), self.num(self.rng.randint(1, 4))
        return self.rng.choice((a, f"{a}.{b}", f"{a}_{b}", f"{a}-{b}", f"{a}{n}", f"{a}.{n}", f"{a}+{b}", f"{a[0]}.{b}")) + "@" + self.domain()

    def phone(self) -> str:
        num, land = self.num, f"+{self.rng.randint(1, 99)}"
        return self.rng.choice((
            f"{land} ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"{land} {num(3)} {num(3)} {num(4)}",
            f"{land} {num(2)} {num(4)} {num(4)}", f"{land} {num(3)} {num(7)}", f"{land}-{num(3)}-{num(3)}-{num(4)}", f"{land}{num(10)}", f"0{num(3)} {num(3)} {num(4)}", f"{land} ({num(2)}) {num(4)} {num(4)}",
        ))

    def address(self) -> str:
        if self.rng.random() < 0.6:
            return ".".join(str(self.rng.randint(0, 255)) for _ in range(4))
        groups = [self.hexa(self.rng.randint(1, 4)) for _ in range(8)]
        if self.rng.random() < 0.5:
            return ":".join([self.num(4), *groups[1:7], self.num(2)])
        return ":".join([self.rng.choice(("fe80", "2001", "2a02")), *groups[: self.rng.randint(0, 2)]]) + "::" + ":".join([*groups[4 : 4 + self.rng.randint(0, 2)], self.num(self.rng.randint(1, 4))])

    def card(self) -> str:
        n = self.rng.choice((16, 16, 16, 15))
        body = self.num(n - 1)
        digits = body + next(c for c in "0123456789" if _luhn(body + c)) if self.rng.random() < 0.7 else self.num(n)
        if n == 15:
            return self.rng.choice((digits, f"{digits[:4]} {digits[4:10]} {digits[10:]}"))
        return self.rng.choice(("", "-", " ")).join(digits[k : k + 4] for k in range(0, 16, 4))

    def account(self) -> str:
        land, n = self.rng.choice((("DE", 18), ("FR", 23), ("GB", 18), ("NL", 14), ("ES", 20), ("NO", 11), ("PL", 24)))
        body = self.upper(4) + self.num(n - 4) if land in ("GB", "NL", "FR") and self.rng.random() < 0.5 else self.num(n)
        check = next(f"{k:02}" for k in range(2, 100) if _mod_97(f"{land}{k:02}{body}")) if self.rng.random() < 0.9 else self.num(2)
        whole = land + check + body
        return whole if self.rng.random() < 0.5 or not body.isdigit() else " ".join(whole[k : k + 4] for k in range(0, len(whole), 4))

    def secret(self) -> tuple[str, str, str]:
        quote = self.rng.choice(('"', "'", ""))
        name = self.rng.choice(("token", "secret", "api_key", "password", "key", "auth", "access_token", "client_secret", "bearer", ""))
        sign = self.rng.choice((" = ", "=", ": ", " ")) if name else ""
        letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
        body = self.rng.choice((self.hexa(32), self.hexa(40), self.hexa(64), "AKIA" + self.upper(16), self.rng.choice(("sk", "pk", "xx")) + self.of(letters, self.rng.randint(24, 48)), self.of(letters, self.rng.randint(28, 44))))
        if not any(c in "0123456789" for c in body):
            body = body[:-2] + self.num(2)
        return name + sign + quote, body, quote

    def entity(self) -> tuple[int, str, str, str]:
        """Type, what stands before it, the entity, what stands behind it."""
        rng, num = self.rng, self.num
        kind = rng.randrange(len(KINDS))
        if KINDS[kind] == "SECRET":
            return kind, *self.secret()
        if KINDS[kind] == "ID":
            return kind, "", f"{num(3)}-{num(2)}-{num(4)}", ""
        if KINDS[kind] == "IP":
            found = self.address()
            return kind, "", found, rng.choice(("", "", ":8080", "/24")) if "." in found else ""
        return kind, "", {"EMAIL": self.email, "PHONE": self.phone, "CARD": self.card, "IBAN": self.account}[KINDS[kind]](), ""

    def other(self) -> str:
        """What holds digits or an @ and is no personal data."""
        rng, num, word, hexa = self.rng, self.num, self.word, self.hexa
        low = lambda n: str(rng.randint(0, n))
        return rng.choice((
            lambda: f"{low(20)}.{low(20)}", lambda: f"{low(9)}.", lambda: f"{word()} {low(20)}.{low(20)}.{low(99)}", lambda: f"v{low(9)}.{num(2)}", lambda: f"{word()}, {word()} {low(9)}.{low(9)}.", lambda: f"{low(9)}.{low(9)}.{low(9)}-rc{low(9)}",
            lambda: f"20{num(2)}-0{low(9)}-1{low(9)}", lambda: f"{low(12)}/{low(28)}/20{num(2)}", lambda: f"{low(23)}:{num(2)}", lambda: f"{low(23)}:{num(2)}:{num(2)}", lambda: f"20{num(2)}-0{low(9)}-1{low(9)}T{num(2)}:{num(2)}:{num(2)}Z", lambda: f"{rng.randint(1700, 2030)}",
            lambda: num(rng.randint(1, 9)), lambda: num(rng.randint(20, 30)), lambda: f"${num(3)}.{num(2)}", lambda: f"{num(2)}%", lambda: f"{num(1)},{num(3)},{num(3)}", lambda: f"{num(3)} {num(3)}", lambda: f"{num(3)}-{num(4)}", lambda: f"{num(4)}-{num(4)}", lambda: f"{low(90)}-{low(90)}",
            lambda: "@" + word(), lambda: f"{word()} @ {word()}", lambda: "#" + hexa(6), lambda: hexa(rng.choice((7, 8, 10, 12))), lambda: f"{word()}{num(2)}", lambda: f"{word()}_{num(2)}_{word()}", lambda: f"{word()}-{low(99)}", lambda: f"0x{hexa(8)}",
            lambda: ".".join(num(1) for _ in range(5)), lambda: ".".join(str(rng.randint(256, 999)) for _ in range(4)), lambda: f"ISBN 978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", lambda: f"https://{self.domain()}/{num(4)}", lambda: f"{self.domain()}/{word()}?{word()}={low(99)}",
            lambda: ":".join(self.of("0123456789ABCDEF", 2) for _ in range(6)), lambda: "-".join((hexa(8), hexa(4), hexa(4), hexa(4), hexa(12))), lambda: f"{word()}({low(9)})", lambda: f"CVE-20{num(2)}-{num(5)}", lambda: f"{low(360)}.{num(4)}, {low(90)}.{num(4)}", lambda: f"{num(2)}th", lambda: f"{num(1)}x{num(1)}",
        ))()


def _line(rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A line of text and its entities."""
    write = _Writer(rng)
    text, found = "", []
    junk = "" if rng.random() < 0.5 else rng.choice("!*#%&$|~=_") * rng.randint(1, 3)
    upper = rng.random() < 0.15
    for _ in range(rng.randint(3, 6)):
        text += write.word() + rng.choice((" ", " ", ", ", ". ", junk + " "))
        if rng.random() < 0.5:
            y, head, body, tail = write.entity()
            text += head
            found.append((len(text), len(text) + len(body), y))
            text += body + tail
        else:
            text += write.other()
        text += rng.choice(("", "", junk, ",", ".", "!", ")", "...")) + " "
    return (text.upper() if upper else text), found


def islands_of(text: str) -> list[tuple[int, int]]:
    """Where the islands of a text lie; the definition that islands() follows on Arrow buffers."""
    out: list[tuple[int, int]] = []
    for m in re.finditer(r"[^\s\x1c-\x1f]+", text, re.ASCII):
        if re.search(r"[0-9@]", m.group()):
            if out and m.start() - out[-1][1] == 1 and text[out[-1][1]] in " \t" and last == out[-1][1]:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
        last = m.end()
    return out


def fit(lines: int = LINES, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """The model, fitted on lines of the generator by stochastic gradient steps of adaptive size."""
    rng = random.Random(seed)
    examples = []
    for _ in range(lines):
        text, found = _line(rng)
        for a, b in islands_of(text):
            island = Island(text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + 1])
            start, end = {x: k for k, (x, _) in enumerate(island.tokens)}, {y: k + 1 for k, (_, y) in enumerate(island.tokens)}
            gold = [(start.get(x - a), end.get(y - a), kind) for x, y, kind in found if a <= x and y <= b]
            spans = set(island.spans)
            if all((i, j) in spans for i, j, _ in gold):
                examples.append((island, gold))
    count: dict[str, int] = {}
    for island, _ in examples:
        for f in {x for y in island.found for x in y}:
            count[f] = count.get(f, 0) + 1
    model = Model()
    model.number = {f: k for k, f in enumerate(sorted(f for f, n in count.items() if n >= 2))}
    model.weights = np.zeros((len(model.number), OUT))
    size_w, size_t = np.full(model.weights.shape, 1e-3), np.full(model.transitions.shape, 1e-3)
    for _ in range(epochs):
        rng.shuffle(examples)
        for island, gold in examples:
            gs, gt = model.gradient(island, gold)
            live = np.flatnonzero(np.abs(gs).max(axis=1, initial=0) > 1e-4) if len(gs) else []
            for k in live:
                ids = [x for x in map(model.number.get, island.found[k]) if x is not None]
                g = gs[k][None, :] - DECAY * model.weights[ids]
                size_w[ids] += g**2
                model.weights[ids] += STEP * g / np.sqrt(size_w[ids])
            gt = gt - DECAY * model.transitions
            size_t += gt**2
            model.transitions += STEP * gt / np.sqrt(size_t)
    return model


def save(model: Model, path: str) -> None:
    """The weights as JSON; a feature whose weights all round to nothing is left out."""
    rows = {f: [round(x, 3) for x in model.weights[k].tolist()] for f, k in model.number.items()}
    kept = {f: w for f, w in sorted(rows.items()) if any(w)}
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"transitions": ' + json.dumps([[round(x, 3) for x in row] for row in model.transitions.tolist()]) + ', "weights": {\n')
        out.write(",\n".join(f"{json.dumps(f)}: {json.dumps(w, separators=(',', ':'))}" for f, w in kept.items()) + "\n}}\n")


@lru_cache(maxsize=1)
def fitted() -> Model:
    """The model of the package's weights, which ``python -m granary.llm.pii`` fits and writes anew."""
    data = json.loads(pkgutil.get_data("granary.llm", WEIGHTS))
    model = Model()
    model.number = {f: k for k, f in enumerate(data["weights"])}
    model.weights = np.array(list(data["weights"].values()), float).reshape(-1, OUT)
    model.transitions = np.array(data["transitions"], float)
    return model


# ---------------------------------------------------------------- tables

_MARK = np.zeros(256, bool)
_MARK[[*range(48, 58), 64]] = True


def islands(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (bytes) and documents of all islands."""
    s, e, doc = C.runs(~C._SPACE[raw], offs)
    marks = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_MARK[raw], out=marks[1:])
    k = np.flatnonzero(marks[e] > marks[s])
    if not len(k):
        return k, k, k
    gap = raw[np.minimum(e[k[:-1]], len(raw) - 1)]
    joined = (k[1:] == k[:-1] + 1) & (doc[k[1:]] == doc[k[:-1]]) & (s[k[1:]] == e[k[:-1]] + 1) & ((gap == 32) | (gap == 9))
    head = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.append(head[1:], len(k)) - 1
    return s[k[head]], e[k[last]], doc[k[head]]


def entities_of(column: pa.Array, model: Model) -> tuple[np.ndarray, ...]:
    """Document, start, end (characters) and type of all entities, in order."""
    raw, offs = C.text_buffer(column)
    s, e, doc = islands(raw, offs)
    chars = C.char_index(raw)
    whole = raw.tobytes()
    out: list[tuple[int, int, int, int]] = []
    low, high = offs[:-1][doc], offs[1:][doc]
    waiting: list[tuple[int, int, Island, int, int]] = []
    spans: list[tuple[int, int]] = []
    found: list[list[str]] = []

    def flush() -> None:
        score = model.scored(found)
        for d, zero, island, x, y in waiting:
            out.extend((d, zero + p, zero + q, kind) for p, q, kind in model.best(island, spans[x:y], score[x:y]))
        waiting.clear(), spans.clear(), found.clear()

    for a, b, d, lo, hi, zero in zip(s.tolist(), e.tolist(), doc.tolist(), low.tolist(), high.tolist(), (chars[s] - chars[low]).tolist()):
        island = Island(whole[a:b].decode("utf-8", "replace"), whole[max(lo, a - CONTEXT) : a].decode("utf-8", "ignore"), whole[b : min(hi, b + 4)].decode("utf-8", "ignore"))
        if len(island.tokens) > BLOCK:
            flush()
            out.extend((d, zero + x, zero + y, kind) for x, y, kind in model.best(island))
            continue
        at = len(spans)
        mine, of_mine = island.between(0, len(island.tokens))
        if mine:
            spans.extend(mine)
            found.extend(of_mine)
            waiting.append((d, zero, island, at, len(spans)))
        if len(spans) > SPANS:
            flush()
    flush()
    table = np.array(out, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def entities(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, kind, start, end) of every entity, offsets in characters."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fitted())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.steps(batch):
                d, a, b, kind = entities_of(part.column(1), sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(d)).cast(pa.int64()), pa.array([KINDS[k] for k in kind.tolist()], pa.string()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["doc_id", "kind", "start", "end"])

    return C.same_names(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, kind string, start int, end int")


def masked(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with each entity of text replaced by its type in brackets: one Arrow step, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fitted())
    names, place = list(docs.columns), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, place):
                columns = list(part.columns)
                text = columns[place]
                d, a, b, kind = entities_of(text, sent.value)
                if len(d):
                    texts = text.to_pylist()
                    changed: dict[int, list[tuple[int, int, int]]] = {}
                    for row, x, y, k in zip(d.tolist(), a.tolist(), b.tolist(), kind.tolist()):
                        changed.setdefault(row, []).append((x, y, k))
                    sizes = columns[names.index("n_chars")].to_pylist() if "n_chars" in names else None
                    for row, spans in changed.items():
                        texts[row] = replaced(texts[row], spans)
                        if sizes:
                            sizes[row] = len(texts[row])
                    columns[place] = pa.array(texts, text.type)
                    if sizes:
                        columns[names.index("n_chars")] = pa.array(sizes, part.schema.field(names.index("n_chars")).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, b, k in spans:
        out += [text[at:a], f"[{KINDS[k]}]"]
        at = b
    return "".join([*out, text[at:]])


if __name__ == "__main__":
    save(fit(), os.path.join(os.path.dirname(os.path.abspath(__file__)), WEIGHTS))
