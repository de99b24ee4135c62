"""MPEG transport streams in a binary column: written, and read back with checks.

``muxed`` stores a payload as access units in packetised elementary packets with
timestamps, behind program tables that come again before each of them, so that each
is a random-access point.  ``demuxed`` reads any stream: it finds the packets (again
after lost bytes), parses the program tables, checks each pid's continuity
counter, drops repeated packets, puts the elementary packets together again and
gives their timestamps, unwrapped, with the places where a reader can begin.

Rows are independent: both are narrow, on numpy arrays of a stream's packets, and
their memory is that of some rows of the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docweave.llm.blocks import blocks
from docweave.llm.carry import CARRIED, carried, extended, quoted
from docweave.ship import shipped

# Fixed values of ISO/IEC 13818-1.
PACKET, SYNC = 188, 0x47
PAT_PID, NULL_PID = 0, 0x1FFF
PAT_TABLE, PMT_TABLE = 0, 2
CRC_POLYNOMIAL = 0x04C11DB7
#: Private data in PES packets, and the stream id that goes with it.
PRIVATE_TYPE, PRIVATE_ID = 6, 0xBD
#: Stream ids whose packets have no optional header: maps, padding, private 2, control, directory.
PLAIN_IDS = frozenset((0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF))
LARGEST_PES = 65_535
#: Timestamps are 33 bits of a 90 kHz clock.
WRAP = 1 << 33

# How this module writes.
PROGRAM, PMT_PID, MEDIA_PID = 1, 0x1000, 0x100
#: Ticks of an access unit (24 ms), access units of an elementary packet, and ticks by which presentation follows the clock.
UNIT_TICKS, PES_UNITS, DELAY = 2_160, 64, 9_000

UNIT = "struct<pts: bigint, dts: bigint, start: bigint, size: bigint, offset: bigint, random_access: boolean, complete: boolean>"
READ = {
    "packets": "bigint",
    "faults": "array<struct<kind: string, pid: int, offset: bigint>>",
    "programs": "array<struct<program: int, pmt_pid: int, pcr_pid: int>>",
    "streams": f"array<struct<program: int, pid: int, stream_type: int, data: binary, units: array<{UNIT}>>>",
}


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        value = byte << 24
        for _ in range(8):
            value = (value << 1) ^ (CRC_POLYNOMIAL if value & 0x80000000 else 0)
        table.append(value & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    """The CRC of program tables; 0 over a section with its own CRC at the end."""
    value = 0xFFFFFFFF
    for byte in data:
        value = ((value << 8) & 0xFFFFFFFF) ^ _CRC[(value >> 24) ^ byte]
    return value


# Writing


def section(table: int, number: int, body: bytes) -> bytes:
    """A whole, current section of a program table."""
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\0\0"
    return head + body + section_crc(head + body).to_bytes(4, "big")


@lru_cache(64)
def table_packets(counter: int, pmt_pid: int, pid: int, stream_type: int) -> bytes:
    """The packets of both program tables."""
    pat = section(PAT_TABLE, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | pmt_pid).to_bytes(2, "big"))
    pmt = section(PMT_TABLE, PROGRAM, (0xE000 | pid).to_bytes(2, "big") + b"\xf0\0" + bytes([stream_type]) + (0xE000 | pid).to_bytes(2, "big") + b"\xf0\0")
    out = b""
    for at, data in ((PAT_PID, pat), (pmt_pid, pmt)):
        out += (bytes([SYNC]) + (0x4000 | at).to_bytes(2, "big") + bytes([0x10 | counter, 0]) + data).ljust(PACKET, b"\xff")
    return out


def timestamp(mark: int, ticks: int) -> bytes:
    """Five bytes of a timestamp behind its mark (2: alone, 3: with a decoding time, 1: that)."""
    t = ticks % WRAP
    return bytes([mark << 4 | (t >> 30) << 1 | 1]) + ((t >> 15 & 0x7FFF) << 1 | 1).to_bytes(2, "big") + ((t & 0x7FFF) << 1 | 1).to_bytes(2, "big")


def clock(ticks: int) -> bytes:
    """Six bytes of a clock reference at a 90 kHz tick."""
    return ((ticks % WRAP) << 15 | 0x7E00).to_bytes(6, "big")


def mux(payload: bytes, unit: int, pes_units: int = PES_UNITS, ticks: int = UNIT_TICKS, pid: int = MEDIA_PID, pmt_pid: int = PMT_PID, stream_type: int = PRIVATE_TYPE) -> bytes:
    """A stream of one program that holds ``payload`` in access units of ``unit`` bytes (the last may be shorter)."""
    pes_units = min(pes_units, (LARGEST_PES - 8) // unit)
    out, counter = [], 0
    for number, start in enumerate(range(0, len(payload), unit * pes_units)):
        data = payload[start : start + unit * pes_units]
        time = number * pes_units * ticks
        pes = b"\0\0\1" + bytes([PRIVATE_ID]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + timestamp(2, time + DELAY) + data
        first = min(len(pes), PACKET - 12)
        full, tail = divmod(len(pes) - first, PACKET - 4)
        packets = np.full((1 + full + (tail > 0), PACKET), 0xFF, np.uint8)
        packets[:, 0] = SYNC
        packets[:, 1], packets[:, 2] = pid >> 8, pid & 0xFF
        packets[:, 3] = 0x10 | (counter + np.arange(len(packets)) & 15)
        counter = (counter + len(packets)) & 15
        body = np.frombuffer(pes, np.uint8)
        # The first packet: start of a unit, an adaptation field that says "random access" and gives the clock.
        packets[0, 1] |= 0x40
        packets[0, 3] |= 0x20
        packets[0, 4], packets[0, 5] = PACKET - 5 - first, 0x50
        packets[0, 6:12] = np.frombuffer(clock(time), np.uint8)
        packets[0, PACKET - first :] = body[:first]
        packets[1 : 1 + full, 4:] = body[first : first + full * (PACKET - 4)].reshape(full, PACKET - 4)
        if tail:
            packets[-1, 3] |= 0x20
            packets[-1, 4] = PACKET - 5 - tail
            if tail < PACKET - 5:
                packets[-1, 5] = 0
            packets[-1, PACKET - tail :] = body[len(pes) - tail :]
        out += [table_packets(number & 15, pmt_pid, pid, stream_type), packets.tobytes()]
    return b"".join(out) or table_packets(0, pmt_pid, pid, stream_type)


# Reading


def aligned(raw: bytes) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The packets, their offsets, and the offsets at which their sequence was lost."""
    data, size = np.frombuffer(raw, np.uint8), len(raw)
    if size % PACKET == 0 and (data[::PACKET] == SYNC).all():
        return data.reshape(-1, PACKET), np.arange(0, size, PACKET), []
    starts, lost, at = [], [], 0
    while at + PACKET <= size:
        whole = (size - at) // PACKET
        wrong = np.flatnonzero(data[at : at + whole * PACKET : PACKET] != SYNC)
        good = int(wrong[0]) if len(wrong) else whole
        starts.append(at + PACKET * np.arange(good))
        at += good * PACKET
        if good == whole:
            break
        lost.append(at)
        # Again from where two packets in a row begin, or one that ends the data.
        at = raw.find(SYNC, at + 1)
        while at >= 0 and not (at + PACKET == size or (at + PACKET < size and raw[at + PACKET] == SYNC)):
            at = raw.find(SYNC, at + 1)
        if at < 0:
            at = size
    if at < size and (not lost or lost[-1] != at):
        lost.append(at)  # the end of the data is no whole packet
    offsets = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return data[offsets[:, None] + np.arange(PACKET)] if len(offsets) else data[:0].reshape(0, PACKET), offsets, lost


@lru_cache(4096)
def read_section(data: bytes) -> tuple | None:
    """("pat", {program: pid}) or ("pmt", program, pcr pid, ((type, pid), ...)); None of a section that isn't current; ("crc",)."""
    if section_crc(data):
        return ("crc",)
    if len(data) < 12 or not data[5] & 1:
        return None
    number = int.from_bytes(data[3:5], "big")
    if data[0] == PAT_TABLE:
        entries = [(int.from_bytes(data[i : i + 2], "big"), int.from_bytes(data[i + 2 : i + 4], "big") & 0x1FFF) for i in range(8, len(data) - 7, 4)]
        return ("pat", tuple((program, pid) for program, pid in entries if program))
    if data[0] != PMT_TABLE or len(data) < 16:
        return None
    streams, at = [], 12 + (int.from_bytes(data[10:12], "big") & 0xFFF)
    while at + 5 <= len(data) - 4:
        streams.append((data[at], int.from_bytes(data[at + 1 : at + 3], "big") & 0x1FFF))
        at += 5 + (int.from_bytes(data[at + 3 : at + 5], "big") & 0xFFF)
    return ("pmt", number, int.from_bytes(data[8:10], "big") & 0x1FFF, tuple(streams))


class Reader:
    """One stream: its packets' header fields as arrays, and what is read from them."""

    def __init__(self, raw: bytes):
        self.rows, self.offsets, lost = aligned(raw)
        self.faults = [("sync", None, at) for at in lost]
        rows = self.rows
        head = rows[:, 1:6].astype(np.int64)
        self.pid = (head[:, 0] & 0x1F) << 8 | head[:, 1]
        self.begins = (head[:, 0] & 0x40) > 0
        extra, has_payload = (head[:, 2] & 0x20) > 0, (head[:, 2] & 0x10) > 0
        length = np.where(extra, head[:, 3] + 1, 0)
        flags = np.where(length > 1, head[:, 4], 0)
        self.jumps, self.random = (flags & 0x80) > 0, (flags & 0x40) > 0
        self.at = 4 + length
        self.counter = head[:, 2] & 15
        wrong = (head[:, 0] & 0x80) > 0
        self._fault("transport_error", wrong)
        long = ~wrong & (self.at > PACKET)
        self._fault("adaptation_field", long)
        hidden = ~wrong & ~long & ((head[:, 2] & 0xC0) > 0) & (self.pid != NULL_PID)
        self._fault("scrambled", hidden)
        #: Packets whose payload can be read; those behind a gap of their pid are ``broken``.
        self.usable = has_payload & ~wrong & ~long & (self.pid != NULL_PID)
        self.broken = np.zeros(len(rows), bool)
        order = np.flatnonzero(self.usable)
        order = order[np.argsort(self.pid[order], kind="stable")]
        self._check_counters(order)
        self.usable &= ~hidden
        self.broken &= self.usable | hidden
        kept = order[self.usable[order]]
        pids, first = np.unique(self.pid[kept], return_index=True)
        self.of = dict(zip(pids.tolist(), np.split(kept, first[1:]), strict=True)) if len(kept) else {}

    def _fault(self, kind: str, where: np.ndarray) -> None:
        if where.any():
            self.faults += [(kind, int(self.pid[i]), int(self.offsets[i])) for i in np.flatnonzero(where)]

    def _check_counters(self, order: np.ndarray) -> None:
        """Marks gaps of the pids' counters; of two equal packets in a row the second goes."""
        before, after = order[:-1], order[1:]
        step = (self.counter[after] - self.counter[before]) & 15
        odd = np.flatnonzero((step != 1) & (self.pid[before] == self.pid[after]) & ~self.jumps[after])
        for i in odd.tolist():
            a, b = before[i], after[i]
            again = step[i] == 0 and self.usable[a] and self.at[a] == self.at[b] and np.array_equal(self.rows[a, self.at[a] :], self.rows[b, self.at[b] :])
            if again:
                self.usable[b] = False
            elif not (step[i] == 1 and self.usable[a]):
                self.broken[b] = True
                self.faults.append(("continuity", int(self.pid[b]), int(self.offsets[b])))

    def sections(self, pid: int) -> Iterator[tuple]:
        """The sections that stand in the packets of a pid, each once in a row."""
        held, last = None, None
        for i in self.of.get(pid, ()):
            payload = self.rows[i, self.at[i] :].tobytes()
            if self.broken[i]:
                held = None
            parts = []
            if self.begins[i]:
                pointer = payload[0] if payload else 0
                if held is not None:
                    parts.append(held + payload[1 : 1 + pointer])
                held = payload[1 + pointer :]
            elif held is not None:
                held += payload
            if held is not None:
                parts.append(held)
            for data in parts:
                held = None
                while len(data) >= 3 and data[0] != 0xFF:
                    size = 3 + (int.from_bytes(data[1:3], "big") & 0xFFF)
                    if len(data) < size:
                        held = data
                        break
                    if data[:size] != last:
                        last = data[:size]
                        found = read_section(last)
                        if found == ("crc",):
                            self.faults.append(("crc", pid, int(self.offsets[i])))
                        elif found is not None:
                            yield found
                    data = data[size:]
                else:
                    held = data if 0 < len(data) < 3 and data[0] != 0xFF else None

    def programs(self) -> list[tuple[int, int, int | None, list[tuple[int, int]]]]:
        """(program, pmt pid, pcr pid, [(type, pid)]) as the last tables say."""
        maps: dict[int, int] = {}
        for found in self.sections(PAT_PID):
            if found[0] == "pat":
                maps.update(found[1])
        tables = {}
        for pid in sorted(set(maps.values())):
            for found in self.sections(pid):
                if found[0] == "pmt" and maps.get(found[1]) == pid:
                    tables[found[1]] = (found[2], list(found[3]))
        return [(n, pid, *tables.get(n, (None, []))) for n, pid in sorted(maps.items())]

    def elementary(self, pid: int) -> tuple[bytes, list[dict]]:
        """The data of a pid's elementary packets and a unit for each; what stands before the first of them is left out."""
        own = self.of.get(pid)
        if own is None or not self.begins[own].any():
            return b"", []
        own = own[int(np.argmax(self.begins[own])) :]
        at = self.at[own]
        flat = self.rows[own][np.arange(PACKET) >= at[:, None]]
        ends = np.cumsum(PACKET - at)
        places = ends - (PACKET - at)
        first = np.flatnonzero(self.begins[own])
        gaps = np.cumsum(self.broken[own])
        out, units, size, last = [], [], 0, None
        for k, p in enumerate(first.tolist()):
            after = int(first[k + 1]) if k + 1 < len(first) else len(own)
            begin, end = int(places[p]), int(ends[after - 1])
            head = flat[begin : min(end, begin + 19)].tobytes()
            if len(head) < 6 or head[:3] != b"\0\0\1":
                self.faults.append(("pes", pid, int(self.offsets[own[p]])))
                continue
            length = int.from_bytes(head[4:6], "big")
            stop = begin + 6 + length if length else end
            whole = stop <= end and gaps[after - 1] == gaps[p]
            pts = dts = None
            begin += 6
            if head[3] not in PLAIN_IDS and len(head) >= 9:
                begin += 3 + head[8]
                if head[7] & 0x80 and len(head) >= 14:
                    last = pts = _ticks(head[9:14], last)
                    dts = _ticks(head[14:19], pts) if head[7] & 0x40 and len(head) >= 19 else pts
            stop = max(begin, min(stop, end))
            i = own[p]
            if not whole:
                self.faults.append(("pes", pid, int(self.offsets[i])))
            units.append({"pts": pts, "dts": dts, "start": size, "size": min(stop, end) - begin if begin <= end else 0, "offset": int(self.offsets[i]), "random_access": bool(self.random[i]), "complete": bool(whole)})
            out.append(flat[begin:stop].tobytes())
            size += len(out[-1])
        return b"".join(out), units


def _ticks(field: bytes, near: int | None) -> int:
    """A timestamp; of the values that differ by whole turns of the clock that next to ``near``."""
    t = (field[0] >> 1 & 7) << 30 | (int.from_bytes(field[1:3], "big") >> 1) << 15 | int.from_bytes(field[3:5], "big") >> 1
    return t if near is None else near + (t - near + WRAP // 2) % WRAP - WRAP // 2


def demux(raw: bytes) -> dict:
    """packets, faults (by offset), programs and streams of one transport stream."""
    reader = Reader(raw)
    programs = reader.programs()
    streams, seen = [], set()
    for program, _, _, listed in programs:
        for stream_type, pid in listed:
            if pid not in seen:
                seen.add(pid)
                data, units = reader.elementary(pid)
                streams.append({"program": program, "pid": pid, "stream_type": stream_type, "data": data, "units": units})
    faults = [{"kind": k, "pid": p, "offset": int(at)} for k, p, at in sorted(reader.faults, key=lambda f: (f[2], f[0]))]
    return {"packets": len(reader.rows), "faults": faults, "programs": [{"program": n, "pmt_pid": p, "pcr_pid": c} for n, p, c, _ in programs], "streams": streams}


def muxed(df: DataFrame, payload: str = "payload", keep: list[str] | None = None, unit: int = 576) -> DataFrame:
    """``keep`` columns of ``df`` (all but the payload by default) plus ``media``: the payload as a transport stream.

    A null payload is an empty one, whose stream has tables alone; rows that repeat have
    equal streams, whatever their order or partition.  A column named media is replaced.
    """
    if not 0 < unit <= LARGEST_PES - 8:
        raise ValueError("an access unit must fit in one elementary packet")
    shipped(df.sparkSession)
    source = df.select(carried(df, keep or [c for c in df.columns if c != payload], ["media"]), F.col(quoted(payload)).cast("binary").alias("_payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_payload"):
                media = [mux(p.as_py() or b"", unit) for p in part.column("_payload")]
                yield pa.RecordBatch.from_arrays([part.column(CARRIED), pa.array(media, pa.binary())], names=[CARRIED, "_media"])

    return source.mapInArrow(run, extended(source, [CARRIED], "_media binary")).select(f"{CARRIED}.*", F.col("_media").alias("media"))


def demuxed(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all by default) plus packets, faults, programs and streams of the transport stream ``media``.

    faults: sync (bytes that are no packets), transport_error, adaptation_field,
    scrambled, continuity, crc, pes (an elementary packet that isn't whole), by
    offset.  streams: for each listed pid its data and units (pts and dts in 90 kHz
    ticks that don't wrap, place in the data, offset of the first packet, random access).
    Packets that can't be read are left out; a null or empty stream has nothing.
    Rows that repeat are read each.  Columns of these names are replaced; others may have any name.
    """
    shipped(df.sparkSession)
    source = df.select(carried(df, keep, list(READ)), F.col(quoted(media)).alias("_media"))
    schema = extended(source, [CARRIED], ", ".join(f"_{c} {kind}" for c, kind in READ.items()))
    arrow = {c: to_arrow_type(schema[f"_{c}"].dataType) for c in READ}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_media"):
                read = [demux(m.as_py() or b"") for m in part.column("_media")]
                yield pa.RecordBatch.from_arrays([part.column(CARRIED), *[pa.array([r[c] for r in read], arrow[c]) for c in READ]], names=[CARRIED, *[f"_{c}" for c in READ]])

    return source.mapInArrow(run, schema).select(f"{CARRIED}.*", *[F.col(f"_{c}").alias(c) for c in READ])
