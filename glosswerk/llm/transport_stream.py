"""Media columns: MPEG transport streams.

``store`` packs each payload, bytes as 8-bit samples of a private stream, into
a transport stream: a program association table, a program map table, then
packets of access units with presentation times, the first and every
``RANDOM_ACCESS_EVERY``-th of them marked as a random-access point.  The program
has no clock, which its map says by the PID of no packets.
``read_back`` parses any such stream: the program tables (with their CRC), the
continuity counters of every program's elementary streams (but for signalled
discontinuities), and the elementary
packets, of which it returns the payload, the times and the random-access
points.

Defined results: a null text is the empty payload, 64 bytes of 0 after
padding; equal texts give equal streams.  A null or damaged stream does not
stop a run: ``read_back`` returns what it could reassemble, counts continuity
errors and states the first fault in ``fault``.  Repeated rows give repeated
rows; an empty table gives an empty table.  Only the named columns are read,
so other columns may have any name.  Memory: one Arrow batch and one stream.
"""

from __future__ import annotations

import binascii
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, string_buffers

PACKET, HEAD = 188, 4
SYNC = 0x47
PAT_PID, PMT_PID, MEDIA_PID, NO_PID = 0x0000, 0x1000, 0x0100, 0x1FFF
PROGRAM, STREAM_ID, STREAM_TYPE = 1, 0xBD, 0x06
#: Bytes of payload in an access unit, the 90 kHz ticks of one, and how many share a random-access point.
UNIT_BYTES, UNIT_TICKS, RANDOM_ACCESS_EVERY = 16_384, 3_600, 4
PAD = 64
#: Bytes of texts or streams that a batch returned to Spark holds, or one row.
BATCH_BYTES = 8 << 20
PES_HEAD = 14


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | (len(body) + 9), number, 0xC1, 0, 0)
    return head + body + struct.pack(">I", crc32_mpeg(head + body))


def _table_packet(pid: int, section: bytes) -> bytes:
    body = b"\0" + section
    return struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + body + b"\xff" * (PACKET - HEAD - len(body))


_TABLES = _table_packet(PAT_PID, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, struct.pack(">HHBHH", 0xE000 | NO_PID, 0xF000, STREAM_TYPE, 0xE000 | MEDIA_PID, 0xF000))
)


def _stamp(ticks: int) -> bytes:
    t = ticks & ((1 << 33) - 1)
    return bytes([0x21 | (t >> 30) << 1, (t >> 22) & 0xFF, 1 | ((t >> 15) & 0x7F) << 1, (t >> 7) & 0xFF, 1 | (t & 0x7F) << 1])


def _unstamp(b: np.ndarray) -> int:
    return (int(b[0]) >> 1 & 7) << 30 | int(b[1]) << 22 | (int(b[2]) >> 1) << 15 | int(b[3]) << 7 | int(b[4]) >> 1


def mux(payload: np.ndarray) -> bytes:
    """Transport stream of ``payload`` (uint8)."""
    parts, counter = [_TABLES], 0
    for unit, at in enumerate(range(0, max(len(payload), 1), UNIT_BYTES)):
        data = payload[at : at + UNIT_BYTES]
        head = struct.pack(">IHBBB", 0x100 | STREAM_ID, len(data) + PES_HEAD - 6, 0x84, 0x80, 5) + _stamp(unit * UNIT_TICKS)
        pes = np.concatenate([np.frombuffer(head, np.uint8), data])
        # the first packet has an adaptation field of two bytes, the last one is stuffed by a longer one
        first = PACKET - HEAD - 2
        rest = max(0, len(pes) - first)
        n = 1 + -(-rest // (PACKET - HEAD))
        out = np.empty((n, PACKET), np.uint8)
        out[:, 0] = SYNC
        out[:, 1] = MEDIA_PID >> 8
        out[0, 1] |= 0x40
        out[:, 2] = MEDIA_PID & 0xFF
        out[:, 3] = 0x10 | (np.arange(counter, counter + n) & 15)
        counter += n
        fresh = 0x40 if unit % RANDOM_ACCESS_EVERY == 0 else 0
        if n == 1:
            free = first - len(pes)
            out[0, 3] |= 0x20
            out[0, 4] = 1 + free
            out[0, 5] = fresh
            out[0, 6 : 6 + free] = 0xFF
            out[0, 6 + free :] = pes
        else:
            out[0, 3] |= 0x20
            out[0, 4], out[0, 5] = 1, fresh
            out[0, 6:] = pes[:first]
            whole = n - 2
            out[1 : 1 + whole, HEAD:] = pes[first : first + whole * (PACKET - HEAD)].reshape(whole, PACKET - HEAD)
            tail = pes[first + whole * (PACKET - HEAD) :]
            if free := PACKET - HEAD - len(tail):
                out[-1, 3] |= 0x20
                out[-1, 4] = free - 1
                if free > 1:
                    out[-1, 5] = 0
                    out[-1, 6 : HEAD + free] = 0xFF
            out[-1, HEAD + free :] = tail
        parts.append(out.tobytes())
    return b"".join(parts)


def _payload_starts(packets: np.ndarray) -> np.ndarray:
    """Column at which each packet's payload begins; PACKET if it has none."""
    control = packets[:, 3] >> 4 & 3
    start = np.where(control & 2, HEAD + 1 + packets[:, 4].astype(np.int64), HEAD)
    return np.where(control & 1, np.minimum(start, PACKET), PACKET)


def _sections(packets: np.ndarray, table_id: int) -> Iterator[bytes]:
    """Bodies of the sections that these packets of one PID hold, without head and CRC."""
    data = b""
    starts = _payload_starts(packets)
    for row, at in zip(packets, starts, strict=True):
        part = row[at:].tobytes()
        if row[1] & 0x40 and part:
            part, data = part[1 + part[0] :], b""
        data += part
        while len(data) >= 3 and data[0] != 0xFF:
            size = 3 + (struct.unpack(">H", data[1:3])[0] & 0x0FFF)
            if len(data) < size:
                break
            section, data = data[:size], data[size:]
            if size >= 12 and section[0] == table_id and crc32_mpeg(section) == 0:
                yield section[8:-4]


def demux(stream: bytes | np.ndarray) -> dict:
    """Programs, payload, times, random-access points, continuity errors and the first fault of a stream.

    Units are concatenated in the order of elementary PIDs, then of the stream.
    ``points`` has (ticks, packet number, payload byte) for each random-access point.
    """
    out = {"payload": b"", "programs": {}, "packets": 0, "units": 0, "first_pts": None, "last_pts": None, "points": [], "continuity_errors": 0, "fault": None}
    raw = np.frombuffer(stream, np.uint8) if isinstance(stream, bytes) else stream
    if len(raw) % PACKET:
        out["fault"] = "the last packet is cut"
    packets = raw[: len(raw) // PACKET * PACKET].reshape(-1, PACKET)
    out["packets"] = len(packets)
    good = packets[:, 0] == SYNC
    if not good.all():
        out["fault"] = out["fault"] or "a packet without its sync byte"
    number = np.flatnonzero(good)
    packets = packets[good]
    pid = (packets[:, 1].astype(np.int64) & 0x1F) << 8 | packets[:, 2]
    for body in _sections(packets[pid == PAT_PID], 0):
        for program, at in struct.iter_unpack(">HH", body[: len(body) // 4 * 4]):
            if program:
                out["programs"][program] = {"pid": at & 0x1FFF, "streams": {}}
    if not out["programs"]:
        out["fault"] = out["fault"] or "no program"
    for table in out["programs"].values():
        for body in _sections(packets[pid == table["pid"]], 2):
            if len(body) < 4:
                out["fault"] = out["fault"] or "a program map without its length"
                continue
            at = 4 + (struct.unpack(">H", body[2:4])[0] & 0x0FFF)
            while at + 5 <= len(body):
                kind, where, more = struct.unpack(">BHH", body[at : at + 5])
                table["streams"][where & 0x1FFF] = kind
                at += 5 + (more & 0x0FFF)
    payload, size = [], 0
    for media in sorted({p for t in out["programs"].values() for p in t["streams"]}):
        rows = pid == media
        own, names = packets[rows], number[rows]
        starts = _payload_starts(own)
        carries = starts < PACKET
        own, names, starts = own[carries], names[carries], starts[carries]
        counter = own[:, 3] & 15
        step = (counter[1:].astype(np.int64) - counter[:-1]) & 15
        # a packet may be sent twice; a copy is left out, any other step but 1 is an error unless the packet signals it
        copy = np.concatenate([[False], (step == 0) & (own[1:] == own[:-1]).all(axis=1)]) if len(own) > 1 and (step == 0).any() else np.zeros(len(own), bool)
        signalled = (own[:, 3] & 0x20 != 0) & (own[:, 4] > 0) & (own[:, 5] & 0x80 != 0)
        out["continuity_errors"] += int(((step != 1) & ~copy[1:] & ~signalled[1:]).sum())
        own, names, starts = own[~copy], names[~copy], starts[~copy]
        data = own[np.arange(PACKET) >= starts[:, None]]
        ends = np.cumsum(PACKET - starts)
        heads = np.flatnonzero(own[:, 1] & 0x40)
        bounds = np.concatenate([ends[heads] - (PACKET - starts[heads]), ends[-1:]])
        for k, row in enumerate(heads):
            pes = data[bounds[k] : bounds[k + 1]]
            if len(pes) < 9 or pes[0] or pes[1] or pes[2] != 1:
                out["fault"] = out["fault"] or "an elementary packet without its start code"
                continue
            length = int(pes[4]) << 8 | int(pes[5])
            body = pes[9 + int(pes[8]) : 6 + length if length else None]
            if length and 6 + length > len(pes):
                out["fault"] = out["fault"] or "an elementary packet is cut"
            pts = _unstamp(pes[9:14]) if pes[7] & 0x80 and len(pes) >= 14 else None
            if pts is not None:
                out["first_pts"] = pts if out["first_pts"] is None else out["first_pts"]
                out["last_pts"] = pts
            if own[row, 3] & 0x20 and own[row, 4] and own[row, 5] & 0x40:
                out["points"].append((pts, int(names[row]), size))
            out["units"] += 1
            payload.append(body)
            size += len(body)
    out["payload"] = np.concatenate(payload).tobytes() if payload else b""
    return out


MEDIA = "media binary, n_bytes long"
READ = "payload binary, packets long, units long, first_pts long, last_pts long, points array<struct<pts:long,packet:long,byte:long>>, continuity_errors long, fault string"


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = string_buffers(batch.column(1))
        for lo, hi in slices(offs, BATCH_BYTES):
            media = []
            for i in range(lo, hi):
                n = int(offs[i + 1] - offs[i])
                padded = np.zeros(max(PAD, -(-n // PAD) * PAD), np.uint8)
                padded[:n] = data[offs[i] : offs[i + 1]]
                media.append(mux(padded))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(media, pa.binary()), pa.array(np.diff(offs[lo : hi + 1]))], names=["id", "media", "n_bytes"])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media, n_bytes): the text's bytes, padded by 0 to a positive multiple of 64, as a transport stream."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_store, f"id long, {MEDIA}").withColumnRenamed("id", id_col)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["packets", "units", "first_pts", "last_pts"]
    point = pa.list_(pa.struct([("pts", pa.int64()), ("packet", pa.int64()), ("byte", pa.int64())]))
    for batch in batches:
        data, offs = string_buffers(batch.column(1))
        for lo, hi in slices(offs, BATCH_BYTES):
            got = [demux(data[offs[i] : offs[i + 1]]) for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([g["payload"] for g in got], pa.binary()),
                    *(pa.array([g[f] for g in got], pa.int64()) for f in fields),
                    pa.array([[dict(zip(("pts", "packet", "byte"), p, strict=True)) for p in g["points"]] for g in got], point),
                    pa.array([g["continuity_errors"] for g in got], pa.int64()),
                    pa.array([g["fault"] for g in got], pa.string()),
                ],
                names=["id", "payload", *fields, "points", "continuity_errors", "fault"],
            )


def read_back(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """(id, payload, packets, units, first_pts, last_pts, points, continuity_errors, fault) of each stream."""
    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"))
    return rows.mapInArrow(_read, f"id long, {READ}").withColumnRenamed("id", id_col)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes = batch.column(0), batch.column(2)
        data, offs = string_buffers(batch.column(1))
        for lo, hi in slices(offs, BATCH_BYTES):
            cols: list[list] = [[] for _ in range(6)]
            for i in range(lo, hi):
                stream = data[offs[i] : offs[i + 1]]
                got = demux(stream)
                payload = got["payload"]
                samples = np.frombuffer(payload, np.uint8)
                feature = (
                    f"packets={got['packets']};units={got['units']};pts={got['first_pts']}-{got['last_pts']};random_access={len(got['points'])};"
                    f"continuity_errors={got['continuity_errors']};fault={got['fault'] or 'none'};peak={int(samples.max(initial=0))};sum={int(samples.sum(dtype=np.int64))}"
                )
                for col, v in zip(cols, (len(payload), hashlib.sha256(payload).hexdigest(), binascii.crc32(payload[-PAD:]), len(stream), hashlib.sha256(stream).hexdigest(), feature), strict=True):
                    col.append(v)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), sizes.slice(lo, hi - lo), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_features(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Reads stored streams (id, media, n_bytes) and returns what was read as sizes, digests and a feature string."""
    rows = media.select(F.col(id_col).cast("long").alias("id"), "media", "n_bytes")
    schema = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(_digest, schema).withColumnRenamed("id", id_col)
