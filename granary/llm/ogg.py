"""Ogg media columns: packets of all logical streams, with their times.

A file is a row's binary value. Pages are found by their capture pattern, and after damage by the next one; a page
whose checksum is wrong, or that ends beyond the file, is dropped and counts as a loss. Packets are put together
from lacing values, over pages where the last value of a page is 255, and separately for each serial number, so
interleaved and chained streams come apart. The first packet names the codec, which says how a granule position
reads as a time. It is the end of the last packet that ends on its page; packets before it on the page lie evenly
between the granule positions of this page and the stream's page before, unless pages were lost in between.

The checksum is a CRC-32 that shifts left (polynomial 04c11db7, no inversions): the same as zlib's over the bytes'
mirror images, so it runs at zlib's speed.

Nulls and edges: a null or empty value, or one without a valid page, has no rows; a null id is carried through; equal
rows give equal rows; other columns are ignored; an empty table gives no rows. A packet cut off by the end of the
file or by a loss isn't returned; ``after_loss`` marks the next one of its stream.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm import common as C

MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4


def checksum(page: bytes) -> int:
    """The checksum of a page whose own checksum field is zero."""
    return int(f"{zlib.crc32(page.translate(MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


@dataclass
class Page:
    flags: int
    granule: int
    serial: int
    number: int
    lacing: bytes
    body: bytes


def pages(data: bytes) -> Iterator[Page | None]:
    """The valid pages of a file, None for each stretch of damage."""
    at, n, lost = 0, len(data), False
    while True:
        found = data.find(b"OggS", at)
        if found < 0 or found + 27 > n:
            if at < n:
                yield None
            return
        if found > at and not lost:
            lost = True
            yield None
        version, flags, granule, serial, number, crc, segments = struct.unpack_from("<BBqIIIB", data, found + 4)
        lacing = data[found + 27 : found + 27 + segments]
        start = found + 27 + segments
        end = start + sum(lacing)
        if version == 0 and end <= n and checksum(data[found : found + 22] + b"\0\0\0\0" + data[found + 26 : end]) == crc:
            lost = False
            yield Page(flags, granule, serial, number, lacing, data[start:end])
            at = end
        else:
            if not lost:
                lost = True
                yield None
            at = found + 4


@dataclass
class Codec:
    name: str = "unknown"
    rate: float = 0.0
    skip: int = 0
    headers: int = 1
    shift: int = -1

    def seconds(self, granule: float) -> float | None:
        if not self.rate:
            return None
        if self.shift >= 0:  # frames up to the key frame, and since
            g = int(granule)
            granule = (g >> self.shift) + (g & ((1 << self.shift) - 1))
        return max(0.0, granule - self.skip) / self.rate


def codec_of(p: bytes) -> Codec:
    try:
        if p[:8] == b"OpusHead":
            return Codec("opus", 48000.0, struct.unpack_from("<H", p, 10)[0], 2)
        if p[:7] == b"\x01vorbis":
            return Codec("vorbis", float(struct.unpack_from("<I", p, 12)[0]), 0, 3)
        if p[:7] == b"\x80theora":
            top, bottom = struct.unpack_from(">II", p, 22)
            return Codec("theora", top / bottom if bottom else 0.0, 0, 3, ((p[40] & 3) << 3) | (p[41] >> 5))
        if p[:8] == b"Speex   ":
            return Codec("speex", float(struct.unpack_from("<I", p, 36)[0]), 0, 2 + struct.unpack_from("<I", p, 68)[0])
        if p[:5] == b"\x7fFLAC":
            return Codec("flac", float(int.from_bytes(p[27:30], "big") >> 4), 0, 1 + struct.unpack_from(">H", p, 7)[0])
    except (struct.error, IndexError):
        pass
    return Codec()


@dataclass
class Stream:
    codec: Codec | None = None
    next_page: int = -1
    part: list[bytes] = field(default_factory=list)
    open: bool = False  # a packet goes on on the next page
    lost: bool = False
    before: int | None = 0  # granule position of the page before; None: unknown
    packets: int = 0


def packets(data: bytes) -> Iterator[tuple]:
    """serial, codec, packet number, header, after_loss, granule, end_s, payload of each whole packet."""
    streams: dict[int, Stream] = {}
    for page in pages(data):
        if page is None:  # which stream lost something shows in its page numbers
            continue
        s = streams.get(page.serial)
        if s is None or page.flags & FIRST:
            s = streams[page.serial] = Stream(next_page=page.number)
            if not page.flags & FIRST:
                s.lost, s.before = True, None
        if page.number != s.next_page:
            s.part, s.open, s.lost, s.before = [], False, True, None
        s.next_page = (page.number + 1) & 0xFFFFFFFF
        skipping = bool(page.flags & CONTINUED) and not s.open
        if s.open and not page.flags & CONTINUED:
            s.part, s.open, s.lost = [], False, True
        if skipping:
            s.lost = True
        done: list[bytes] = []
        at = size = 0
        for v in page.lacing:
            size += v
            if v < 255:
                s.part.append(page.body[at : at + size])
                if skipping:
                    skipping = False
                else:
                    done.append(b"".join(s.part))
                s.part = []
                at, size = at + size, 0
        s.open = bool(page.lacing) and page.lacing[-1] == 255
        if s.open:
            if skipping:
                s.open = False
            else:
                s.part.append(page.body[at:])
        known = page.granule >= 0
        timed = 0
        for k, p in enumerate(done):
            if s.codec is None:
                s.codec = codec_of(p)
            header = s.packets < s.codec.headers
            final = k == len(done) - 1
            seconds = None
            if not header and known:
                timed = timed or len(done) - k
                if final:
                    seconds = s.codec.seconds(page.granule)
                elif s.before is not None:
                    seconds = s.codec.seconds(s.before + (page.granule - s.before) * (timed - (len(done) - 1 - k)) / timed)
            yield page.serial, s.codec.name, s.packets, header, s.lost, page.granule if final and known else None, seconds, p
            s.packets += 1
            s.lost = False
        if known and done:
            s.before = s.codec.skip if s.packets <= s.codec.headers else page.granule


_KINDS = [("serial", pa.int64()), ("codec", pa.string()), ("packet", pa.int32()), ("header", pa.bool_()), ("after_loss", pa.bool_()), ("granule", pa.int64()), ("end_s", pa.float64()), ("n_bytes", pa.int32()), ("digest", pa.string())]


def demuxed(media: DataFrame, key: str = "page_id", column: str = "media") -> DataFrame:
    """One row for each packet: key, serial, codec, packet, header, after_loss, granule, end_s, n_bytes, digest (md5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, files = batch.column(0), batch.column(1)
            rows: list[tuple] = []
            owner: list[int] = []
            for i in range(batch.num_rows):
                data = files[i].as_py()
                if data:
                    found = [(*p[:7], len(p[7]), hashlib.md5(p[7]).hexdigest()) for p in packets(data)]
                    rows += found
                    owner += [i] * len(found)
                if len(rows) > 1 << 14 or i == batch.num_rows - 1:
                    columns = list(zip(*rows)) or [()] * len(_KINDS)
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner, pa.int64())).cast(pa.int64()), *[pa.array(c, t) for c, (_, t) in zip(columns, _KINDS)]], names=[key, *[n for n, _ in _KINDS]])
                    rows, owner = [], []

    schema = f"`{key}` bigint, serial bigint, codec string, packet int, header boolean, after_loss boolean, granule bigint, end_s double, n_bytes int, digest string"
    return C.same_names(media, key, column).mapInArrow(run, schema)


# ---------------------------------------------------------------- writing


def page_bytes(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqII", b"OggS", 0, flags, granule, serial, number)
    rest = bytes([len(lacing)]) + lacing + body
    return head + struct.pack("<I", checksum(head + b"\0\0\0\0" + rest)) + rest


class Writer:
    """Pages of one logical stream."""

    def __init__(self, serial: int) -> None:
        self.serial, self.number = serial, 0

    def pages(self, payloads: list[bytes], granule: int, flags: int = 0) -> list[bytes]:
        """payloads on as few pages as they need; the last one has the granule position, those before none."""
        lacing = b"".join(b"\xff" * (len(p) // 255) + bytes([len(p) % 255]) for p in payloads)
        body = b"".join(payloads)
        out, at = [], 0
        for k in range(0, max(1, len(lacing)), 255):
            values = lacing[k : k + 255]
            size = sum(values)
            mine = flags & ~LAST if k + 255 < len(lacing) else flags
            if k:
                mine = (mine & ~FIRST) | (CONTINUED if lacing[k - 1] == 255 else 0)
            out.append(page_bytes(mine, granule if k + 255 >= len(lacing) else -1, self.serial, self.number, values, body[at : at + size]))
            self.number += 1
            at += size
        return out


OPUS = [b"OpusHead" + struct.pack("<BBHIHB", 1, 2, 312, 48000, 0, 0), b"OpusTags" + struct.pack("<II", 0, 0)]
VORBIS = [b"\x01vorbis" + struct.pack("<IBIIIIBB", 0, 2, 44100, 0, 128000, 0, 0xB8, 1), b"\x03vorbis" + struct.pack("<II", 0, 0) + b"\x01", b"\x05vorbis"]
CHUNK, A_PAGE, FRAME, DAMAGED = 700, 4, 960, 17


def written(page_id: int, text: str) -> bytes:
    """text as an Ogg file with two interleaved streams: in CHUNK characters a packet, A_PAGE packets a page, and whole.

    Of every DAMAGED-th file a byte of the first stream's first page of text is changed afterwards.
    """
    a, b = Writer((2 * page_id) & 0xFFFFFFFF), Writer((2 * page_id + 1) & 0xFFFFFFFF)
    out = [*a.pages(OPUS[:1], 0, FIRST), *b.pages(VORBIS[:1], 0, FIRST), *a.pages(OPUS[1:], 0), *b.pages(VORBIS[1:], 0)]
    chunks = [text[k : k + CHUNK].encode() for k in range(0, len(text), CHUNK)]
    whole = b.pages([text.encode()], len(text), LAST)
    for k in range(0, len(chunks), A_PAGE):
        some = chunks[k : k + A_PAGE]
        mine = a.pages(some, 312 + FRAME * (k + len(some)), LAST if k + A_PAGE >= len(chunks) else 0)
        if k == 0 and page_id % DAMAGED == 0:
            mine[0] = mine[0][:-1] + bytes([mine[0][-1] ^ 1])
        out += mine + whole[:1]
        whole = whole[1:]
    return b"".join(out + whole)


def media_of(texts: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """(key, media): each text as an Ogg file; a null text, or key, gives a null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 1):
                made = [None if i is None or t is None else written(i, t) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(made, pa.binary())], names=[key, "media"])

    return C.same_names(texts, key, column).mapInArrow(run, f"`{key}` bigint, media binary")


def _constant(packets_: list[bytes], codec: str, serial: str) -> str:
    return " UNION ALL ".join(
        f"SELECT page_id, {serial} AS serial, '{codec}' AS codec, {k} AS packet, true AS header, false AS after_loss, {0 if k == 0 or k == len(packets_) - 1 else 'NULL'}::BIGINT AS granule, NULL::DOUBLE AS end_s, {len(p)} AS n_bytes, '{hashlib.md5(p).hexdigest()}' AS digest FROM src"
        for k, p in enumerate(packets_)
    )


SQL = f"""
WITH src AS (SELECT page_id, html, length(html) AS n, CASE WHEN page_id % {DAMAGED} = 0 THEN {A_PAGE} ELSE 0 END AS gone FROM pages WHERE page_id IS NOT NULL AND html IS NOT NULL),
parts AS (
  SELECT page_id, gone, (n + {CHUNK - 1}) // {CHUNK} AS parts, k, substr(html, 1 + {CHUNK} * k, {CHUNK}) AS part
  FROM (SELECT *, unnest(range(0, (n + {CHUNK - 1}) // {CHUNK})) AS k FROM src)
)
SELECT page_id, (2 * page_id)::BIGINT AS serial, codec, packet::INT AS packet, header, after_loss, granule, end_s, n_bytes::INT AS n_bytes, digest FROM (
  {_constant(OPUS, "opus", "2 * page_id")}
  UNION ALL
  SELECT page_id, 2 * page_id, 'opus', 2 + k - gone, false, gone > 0 AND k = gone,
         CASE WHEN k % {A_PAGE} = {A_PAGE - 1} OR k = parts - 1 THEN 312 + {FRAME} * (k + 1) END,
         CASE WHEN gone = 0 OR k >= gone + {A_PAGE} OR k % {A_PAGE} = {A_PAGE - 1} OR k = parts - 1 THEN {FRAME} * (k + 1) / 48000.0::DOUBLE END,
         octet_length(encode(part)), md5(part)
  FROM parts WHERE k >= gone
)
UNION ALL
SELECT page_id, (2 * page_id + 1)::BIGINT, codec, packet::INT, header, after_loss, granule, end_s, n_bytes::INT, digest FROM (
  {_constant(VORBIS, "vorbis", "2 * page_id + 1")}
  UNION ALL
  SELECT page_id, 2 * page_id + 1, 'vorbis', 3, false, false, n, n / 44100.0::DOUBLE, octet_length(encode(html)), md5(html) FROM src
)
"""
