"""Ogg: checksums, lacing, streams, granule positions and damage."""

import random

import pytest

from granary.llm import ogg


def slow_checksum(data: bytes) -> int:
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum():
    rng = random.Random(0)
    for n in (0, 1, 5, 300):
        data = rng.randbytes(n)
        assert ogg.checksum(data) == slow_checksum(data)


def stream(serial, sizes, per_page, head, rng):
    w = ogg.Writer(serial)
    payloads = [rng.randbytes(n) for n in sizes]
    pages = w.pages(head[:1], 0, ogg.FIRST) + w.pages(head[1:], 0)
    for k in range(0, len(payloads), per_page):
        pages += w.pages(payloads[k : k + per_page], 1000 * (k + len(payloads[k : k + per_page])), ogg.LAST if k + per_page >= len(payloads) else 0)
    return pages, payloads


def test_round_trip_of_interleaved_streams():
    rng = random.Random(1)
    sizes = [0, 1, 254, 255, 256, 510, 70_000, 3, 200_000, 255 * 255]
    a, pa_ = stream(1, sizes, 3, ogg.OPUS, rng)
    b, pb = stream(2, sizes[::-1], 4, ogg.VORBIS, rng)
    mixed, x, y = [], list(a), list(b)
    while x or y:
        side = x if x and (not y or rng.random() < 0.5) else y
        mixed.append(side.pop(0))
    got = list(ogg.packets(b"".join(mixed)))
    assert [p[7] for p in got if p[0] == 1 and not p[3]] == pa_ and [p[7] for p in got if p[0] == 2 and not p[3]] == pb
    assert [p[2] for p in got if p[0] == 1] == list(range(len(sizes) + 2)) and not any(p[4] for p in got)
    ends = [p[6] for p in got if p[0] == 2 and p[5] is not None and not p[3]]
    assert ends == pytest.approx([1000 * k / 44100 for k in (4, 8, 10)])


def test_damage_loses_what_it_touches_only():
    rng = random.Random(2)
    pages, payloads = stream(5, [100] * 12, 2, ogg.OPUS, rng)
    broken = pages.copy()
    broken[4] = broken[4][:40] + bytes([broken[4][40] ^ 1]) + broken[4][41:]  # packets 4 and 5
    got = [p for p in ogg.packets(b"junk" + b"".join(broken[:6]) + b"OggSxx" + b"".join(broken[6:])[:-1]) if not p[3]]
    assert [p[7] for p in got] == payloads[:4] + payloads[6:10]  # the last page is cut off
    assert [p[4] for p in got] == [False] * 4 + [True] + [False] * 3
    assert got[4][6] is None and got[5][6] is not None  # no time between unknown ends


def test_continued_packet_without_its_start():
    w = ogg.Writer(9)
    pages = w.pages(ogg.OPUS[:1], 0, ogg.FIRST) + w.pages(ogg.OPUS[1:], 0) + w.pages([b"x" * 70_000, b"end"], 960)
    assert len(pages) == 4
    got = list(ogg.packets(b"".join(pages[:2] + pages[3:])))
    assert [p[7] for p in got] == [*ogg.OPUS, b"end"] and got[-1][4]


def test_chained_streams_start_anew():
    one = ogg.written(3, "a" * 900) + ogg.written(4, "b" * 10)
    got = list(ogg.packets(one))
    assert {p[0] for p in got} == {6, 7, 8, 9}


def test_codecs():
    theora = bytearray(42)
    theora[:7] = b"\x80theora"
    theora[22:30] = (30).to_bytes(4, "big") + (1).to_bytes(4, "big")
    theora[40], theora[41] = 0, 6 << 5
    c = ogg.codec_of(bytes(theora))
    assert c.name == "theora" and c.seconds((60 << 6) + 30) == 3.0
    assert ogg.codec_of(b"OpusHead").name == "unknown" and ogg.codec_of(b"").seconds(5) is None
    flac = b"\x7fFLAC\x01\x00\x00\x02fLaC" + bytes(14) + (48000 << 4).to_bytes(3, "big") + bytes(20)
    assert ogg.codec_of(flac).rate == 48000.0 and ogg.codec_of(flac).headers == 3


def test_query_against_sql(spark, sf, duck, same):
    same(ogg.demuxed(ogg.media_of(spark.read.parquet(f"{sf}/pages.parquet"))), duck(ogg.SQL))


def test_odd_rows(spark):
    rows = [(None, bytearray(ogg.written(1, "x"))), (1, None), (2, bytearray()), (3, bytearray(b"no ogg")), (4, bytearray(ogg.written(4, "é" * 200_000))), (5, bytearray(ogg.written(5, ""))), (5, bytearray(ogg.written(5, "")))]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id bigint, media binary, packet int")
    got = ogg.demuxed(df).groupBy("page_id").count().collect()
    assert {r.page_id: r["count"] for r in got} == {None: 7, 4: 2 + 286 + 4, 5: 12}
    assert ogg.demuxed(df.limit(0)).count() == 0
