"""Transport streams: round trips, a reader that goes packet by packet, and damaged streams."""

import hashlib
import random
import zlib

import pytest

from docweave.llm.queries import op12_transport_stream
from docweave.llm.transport_stream import DELAY, PES_UNITS, UNIT_TICKS, WRAP, clock, demux, demuxed, mux, muxed, section, section_crc, timestamp

KEPT = ["n_bytes", "_payload", "_media", "PACKETS", "a b", "_carried"]


def packets_of(raw):
    return [raw[i : i + 188] for i in range(0, len(raw), 188)]


def plain_read(raw, pid=0x100):
    """The elementary data, timestamps and random-access offsets of one pid, packet by packet."""
    data, marks, counters = b"", [], {}
    for n, p in enumerate(packets_of(raw)):
        assert p[0] == 0x47 and len(p) == 188
        own = (p[1] & 31) << 8 | p[2]
        counters.setdefault(own, []).append(p[3] & 15)
        at = 4 + (1 + p[4] if p[3] & 0x20 else 0)
        if own != pid:
            continue
        body = p[at:]
        if p[1] & 0x40:
            assert body[:4] == b"\0\0\1\xbd"
            size = int.from_bytes(body[4:6], "big")
            t = body[9:14]
            marks.append(((t[0] >> 1 & 7) << 30 | int.from_bytes(t[1:3], "big") >> 1 << 15 | int.from_bytes(t[3:5], "big") >> 1, n * 188, bool(p[5] & 0x40), size - 8))
            body = body[9 + body[8] :]
        data += body
    for seen in counters.values():
        assert all((a + 1) % 16 == b for a, b in zip(seen, seen[1:], strict=False))
    return data, marks


def stream_of(found):
    return found["streams"][0]


@pytest.mark.parametrize("size", [576, 576 * 2, 576 * 64, 576 * 65, 576 * 200, 162, 163, 346, 345, 347, 1, 576 * 64 + 13])
def test_round_trip(size):
    random.seed(size)
    payload = random.randbytes(size)
    raw = mux(payload, 576)
    data, marks = plain_read(raw)
    assert data == payload and [m[0] for m in marks] == [DELAY + k * PES_UNITS * UNIT_TICKS for k in range(len(marks))]
    found = demux(raw)
    own = stream_of(found)
    assert own["data"] == payload and found["faults"] == [] and found["packets"] * 188 == len(raw)
    assert [(u["pts"], u["offset"], u["random_access"], u["size"]) for u in own["units"]] == marks
    assert all(u["complete"] and u["dts"] == u["pts"] and payload[u["start"] : u["start"] + u["size"]] for u in own["units"])
    assert found["programs"] == [{"program": 1, "pmt_pid": 0x1000, "pcr_pid": 0x100}] and own["stream_type"] == 6


def test_empty_payload_and_nothing():
    found = demux(mux(b"", 576))
    assert found["packets"] == 2 and stream_of(found)["data"] == b"" and stream_of(found)["units"] == []
    assert demux(b"") == {"packets": 0, "faults": [], "programs": [], "streams": []}
    assert demux(b"no stream") == {"packets": 0, "faults": [{"kind": "sync", "pid": None, "offset": 0}], "programs": [], "streams": []}


def test_crc_of_known_bytes():
    # The check value of this CRC over "123456789".
    assert section_crc(b"123456789") == 0x0376E6E7
    assert section_crc(section(0, 1, b"1234")) == 0


def kinds(found):
    return [f["kind"] for f in found["faults"]]


def test_lost_repeated_and_damaged_packets():
    payload = random.Random(1).randbytes(576 * 130)
    raw = mux(payload, 576)
    parts = packets_of(raw)
    unit = PES_UNITS * 576
    # A packet within the second elementary packet is lost.
    second = [i for i, p in enumerate(parts) if p[1] & 0x40 and (p[1] & 31, p[2]) == (1, 0)][1]
    found = demux(b"".join(parts[: second + 5] + parts[second + 6 :]))
    assert kinds(found) == ["pes", "continuity"] and [u["complete"] for u in stream_of(found)["units"]] == [True, False, True]
    assert stream_of(found)["data"][:unit] == payload[:unit] and stream_of(found)["data"].endswith(payload[2 * unit :])
    # One that is sent twice is taken once; three times is a fault.
    assert demux(b"".join(parts[:10] + parts[9:])) == {**demux(raw), "packets": len(parts) + 1, "streams": demux(b"".join(parts[:10] + parts[9:]))["streams"]}
    assert stream_of(demux(b"".join(parts[:10] + parts[9:])))["data"] == payload
    # An error flag hides a packet; a scrambled one can't be read.
    flagged = parts[second + 3][:1] + bytes([parts[second + 3][1] | 0x80]) + parts[second + 3][2:]
    assert kinds(demux(b"".join([*parts[: second + 3], flagged, *parts[second + 4 :]]))) == ["pes", "transport_error", "continuity"]
    hidden = parts[second + 3][:3] + bytes([parts[second + 3][3] | 0xC0]) + parts[second + 3][4:]
    assert "scrambled" in kinds(demux(b"".join([*parts[: second + 3], hidden, *parts[second + 4 :]])))
    # A table whose CRC is wrong isn't believed; the next one is.
    wrong = parts[0][:14] + bytes([parts[0][14] ^ 1]) + parts[0][15:]
    found = demux(b"".join([wrong, *parts[1:]]))
    assert kinds(found) == ["crc"] and stream_of(found)["data"] == payload


def test_bytes_between_packets():
    payload = random.Random(2).randbytes(576 * 70)
    raw = mux(payload, 576)
    for junk in (b"\x00" * 5, b"\x47" * 3, b"\x47" + b"x" * 100, raw[188 * 4 : 188 * 4 + 77]):
        for at in (0, 188 * 2, 188 * 50):
            found = demux(raw[:at] + junk + raw[at:])
            assert "sync" in kinds(found) or found["packets"] != len(raw) // 188
            if junk[0] != 0x47:
                assert stream_of(found)["data"] == payload and kinds(found) == ["sync"]
    cut = demux(raw[: 188 * 40 + 60])
    assert kinds(cut)[-1] == "sync" and not stream_of(cut)["units"][-1]["complete"]


def build(pid, counter, payload, begins=False, adaptation=b""):
    room = 184 - (1 + len(adaptation) if adaptation else 0) - len(payload)
    field = b""
    if adaptation or room:
        body = adaptation or (b"\0" if room > 1 else b"")
        stuffed = body + b"\xff" * (184 - len(payload) - 1 - len(body))
        field = bytes([len(stuffed)]) + stuffed
    out = b"\x47" + ((0x4000 if begins else 0) | pid).to_bytes(2, "big") + bytes([(0x30 if field else 0x10) | counter % 16]) + field + payload
    assert len(out) == 188, len(out)
    return out


def pes(stream_id, data, pts=None, dts=None, length=None):
    head = b""
    if pts is not None:
        head = timestamp(2 if dts is None else 3, pts) + (b"" if dts is None else timestamp(1, dts))
    flags = (0x80 if pts is not None else 0) | (0x40 if dts is not None else 0)
    body = bytes([0x80, flags, len(head)]) + head + data
    return b"\0\0\1" + bytes([stream_id]) + (len(body) if length is None else length).to_bytes(2, "big") + body


def test_two_programs_long_tables_and_wrapped_timestamps():
    pat = section(0, 7, b"\0\0\xe0\x10" + b"\0\1\xe1\0" + b"\0\2\xe2\0")
    wide = b"".join(b"\x1b" + (0xE300 + i).to_bytes(2, "big") + b"\xf0\0" for i in range(60))  # longer than a packet
    first = section(2, 1, b"\xe3\0\xf0\0" + wide)
    second = section(2, 2, b"\xe4\0\xf0\3abc" + b"\x0f\xe4\0\xf0\2zz")
    stream = [build(0, 0, b"\0" + pat, True)]
    stream += [build(0x100, 0, (b"\0" + first)[:184], True), build(0x100, 1, (b"\0" + first)[184:])]
    stream += [build(0x200, 0, b"\0" + second, True)]
    video, audio = [], []
    for k in range(4):
        time = WRAP - 2 * 3600 + k * 3600
        frame = bytes([k]) * (300 + k)
        whole = pes(0xE0, frame, time + 7200, time, length=0)
        chunks = [whole[:150], whole[150:300], whole[300:]]
        for n, c in enumerate(chunks):
            video.append(build(0x300, 3 * k + n, c, n == 0, b"\x40" if n == 0 and k % 2 == 0 else b""))
        audio.append(build(0x400, k, pes(0xC0, bytes([k]) * 20, time), True))
    stream += [x for k, one in enumerate(audio) for x in (*video[3 * k : 3 * k + 2], one, video[3 * k + 2])]  # interleaved
    stream.insert(5, build(0x1FFF, 0, b"\xff" * 184))
    found = demux(b"".join(stream))
    assert found["faults"] == [] and found["programs"] == [{"program": 1, "pmt_pid": 0x100, "pcr_pid": 0x300}, {"program": 2, "pmt_pid": 0x200, "pcr_pid": 0x400}]
    by = {s["pid"]: s for s in found["streams"]}
    assert len(by) == 61 and by[0x400]["program"] == 2 and by[0x400]["stream_type"] == 0x0F
    units = by[0x300]["units"]
    assert [u["pts"] for u in units] == [WRAP - 7200 + k * 3600 + 7200 - WRAP for k in range(4)]
    assert [u["pts"] - u["dts"] for u in units] == [7200] * 4 and [u["random_access"] for u in units] == [True, False, True, False]
    assert [u["size"] for u in units] == [300, 301, 302, 303] and by[0x300]["data"] == b"".join(bytes([k]) * (300 + k) for k in range(4))
    assert [u["pts"] for u in by[0x400]["units"]] == [WRAP - 7200 + k * 3600 for k in range(4)]  # on from the first, over the turn


def test_clock_and_timestamp_bits():
    assert clock(WRAP + 5) == clock(5) and int.from_bytes(clock(5), "big") >> 15 == 5
    for t in (0, 1, 1 << 15, 1 << 30, WRAP - 1, 123456789):
        five = timestamp(2, t)
        assert five[0] & 1 and five[2] & 1 and five[4] & 1 and five[0] >> 4 == 2


def test_columns(spark):
    payload = b"abc" * 400
    rows = [(1, payload, *"uvwxy", 7), (2, None, *"uvwxy", 7), (3, b"", *"uvwxy", 7), (1, payload, *"uvwxy", 7)]
    df = spark.createDataFrame(rows, "id long, payload binary, n_bytes string, _payload string, _media string, `a b` string, _carried string, PACKETS long")
    out = muxed(df)
    assert out.columns == ["id", "n_bytes", "_payload", "_media", "a b", "_carried", "PACKETS", "media"]
    read = demuxed(out)
    assert len({c.lower() for c in read.columns}) == len(read.columns)  # the own packets take the place of PACKETS
    by = [(r.id, bytes(r.streams[0].data), r.packets, r["a b"]) for r in read.collect()]
    assert sorted(by) == sorted([(1, payload, 9, "x"), (1, payload, 9, "x"), (2, b"", 2, "x"), (3, b"", 2, "x")])
    assert demuxed(out.limit(0)).collect() == []
    with pytest.raises(ValueError, match="access unit"):
        muxed(df, unit=70_000)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_transport_stream(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        media = mux(payload, 576)
        assert plain_read(media)[0] == payload
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        assert r.feature.startswith("programs=1;streams=1;type=6;") and "faults=0" in r.feature
