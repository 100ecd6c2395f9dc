"""MPEG audio as a media column: a writer of lossless carrier streams and a reader that resynchronises.

The writer stores a payload in the ancillary bytes of silent MPEG-2 Layer III frames: 576 payload bytes, one for each of a
frame's 576 samples. The stream opens with an ID3v2 tag and a variable-bitrate table ("Xing") and closes with an ID3v1 tag.
The streams are written to the shared folder as a media table, and read from there.
The reader takes MPEG audio of layers I to III (free format excepted, whose frame length a header doesn't tell): it parses the tags, the Xing, Info
and VBRI tables with their seek points, and the encoder's delay and padding, finds frame headers again after damage, verifies the CRC-16 of
protected frames, and gives every frame's offset and the exact duration, as samples and rate.

Nulls and empty texts: the payload is one unit of 576 bytes 255. Long texts give more frames; nothing is cut. Rows that
repeat give equal rows. Columns beside doc_id and text are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialize, whole_text

UNIT = 576
PAD = 255

# Fixed values of the MPEG audio format: kbit/s by (MPEG-1?, layer), samples/s by version bits, samples of a frame.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
SAMPLE_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
FRAME_SAMPLES = {(True, 1): 384, (True, 2): 1152, (True, 3): 1152, (False, 1): 384, (False, 2): 1152, (False, 3): 576}

#: The writer's frames: MPEG-2 Layer III, mono, 16 kHz, with checksum, 144 kbit/s (648 bytes); the table's frame 32 kbit/s (144 bytes).
_AUDIO_HEADER = bytes((0xFF, 0xF2, 0xD8, 0xC0))
_TABLE_HEADER = bytes((0xFF, 0xF2, 0x48, 0xC0))
_SIDE = 9
_LEAD = 4 + 2 + _SIDE


# Fixed values of Layer II: bits of a subband's allocation as (bits, subbands) in order, for each of the format's tables.
ALLOCATION = {
    "a": ((4, 11), (3, 12), (2, 4)),
    "b": ((4, 11), (3, 12), (2, 7)),
    "c": ((4, 2), (3, 6)),
    "d": ((4, 2), (3, 10)),
    "lsf": ((4, 4), (3, 7), (2, 19)),
}


@dataclass(frozen=True)
class Header:
    version: int
    layer: int
    kbps: int
    sample_rate: int
    channels: int
    protected: bool
    samples: int
    length: int
    side: int
    #: Subbands from which on both channels share their samples; 32 where none do.
    bound: int = 32


@functools.lru_cache(maxsize=1 << 14)
def read_header(word: bytes) -> Header | None:
    """The frame header in four bytes; None if they are none, or of free format, whose length a header doesn't tell."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    bitrate, rate = word[2] >> 4, word[2] >> 2 & 3
    if version == 1 or layer == 4 or bitrate in (0, 15) or rate == 3 or word[3] & 3 == 2:
        return None
    first = version == 3
    kbps, hz, padding = BITRATES[first, layer][bitrate], SAMPLE_RATES[version][rate], word[2] >> 1 & 1
    samples = FRAME_SAMPLES[first, layer]
    slot = 4 if layer == 1 else 1
    length = (samples // 8 // slot * kbps * 1000 // hz + padding) * slot
    mono = word[3] >> 6 == 3
    side = ((17 if mono else 32) if first else (9 if mono else 17)) if layer == 3 else 0
    bound = 4 * ((word[3] >> 4 & 3) + 1) if word[3] >> 6 == 1 else 32
    return Header(version, layer, kbps, hz, 1 if mono else 2, not word[1] & 1, samples, length, side, bound)


@functools.lru_cache(maxsize=1 << 14)
def crc16(data: bytes) -> int:
    """CRC-16 of the polynomial 0x8005 from 0xFFFF, most significant bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


def allocation_table(h: Header) -> str:
    """Which table of Layer II a header chooses: by rate and bits per channel."""
    if h.version != 3:
        return "lsf"
    each = h.kbps // h.channels
    if h.sample_rate == 48000 and each >= 56 or 56 <= each <= 80:
        return "a"
    if h.sample_rate != 48000 and each >= 96:
        return "b"
    return "d" if h.sample_rate == 32000 else "c"


def protected_bits(h: Header, body: bytes) -> int:
    """How many bits after the checksum it covers: side information; allocations, in Layer II with the scale factors' selection."""
    if h.layer == 3:
        return 8 * h.side
    if h.layer == 1:
        shared = min(h.bound, 32)
        return 4 * (h.channels * shared + 32 - shared)
    widths = [bits for bits, n in ALLOCATION[allocation_table(h)] for _ in range(n)]
    value, at, used = int.from_bytes(body[:64], "big"), 0, 0
    for k, bits in enumerate(widths):
        own = h.channels if k < h.bound else 1
        for _ in range(own):
            given = value >> (512 - at - bits) & (1 << bits) - 1
            at += bits
            used += (1 if own == h.channels else h.channels) * (given > 0)
    return at + 2 * used


def crc16_bits(data: bytes, bits: int) -> int:
    """CRC-16 of the first bits of data."""
    crc = crc16(data[: bits // 8])
    for k in range(bits % 8):
        bit = data[bits // 8] >> (7 - k) & 1
        crc = (crc << 1 ^ (0x8005 if (crc >> 15) ^ bit else 0)) & 0xFFFF
    return crc


def _syncsafe(n: int) -> bytes:
    return bytes((n >> s & 0x7F) for s in (21, 14, 7, 0))


def _text_frame(name: bytes, text: str) -> bytes:
    body = b"\x00" + text.encode("latin-1")
    return name + struct.pack(">I", len(body)) + b"\x00\x00" + body


def pad_payload(data: bytes) -> bytes:
    """Appends bytes 255 up to a positive multiple of 576."""
    return data + bytes((PAD,)) * (-len(data) % UNIT if data else UNIT)


def write_stream(data: bytes) -> bytes:
    """The carrier stream of data (UTF-8 bytes or any other)."""
    payload = pad_payload(data)
    n = len(payload) // UNIT
    size = read_header(_AUDIO_HEADER).length
    frames = np.zeros((n, size), np.uint8)
    side = bytes(_SIDE)
    frames[:, :_LEAD] = np.frombuffer(_AUDIO_HEADER + struct.pack(">H", crc16(_AUDIO_HEADER[2:] + side)) + side, np.uint8)
    frames[:, _LEAD : _LEAD + UNIT] = np.frombuffer(payload, np.uint8).reshape(n, UNIT)
    table_length = read_header(_TABLE_HEADER).length
    total = table_length + n * size
    toc = bytes(min(255, (table_length + p * n // 100 * size) * 256 // total) for p in range(100))
    table = _TABLE_HEADER + struct.pack(">H", crc16(_TABLE_HEADER[2:] + side)) + side
    table += b"Xing" + struct.pack(">III", 7, n, total) + toc
    table = table.ljust(table_length, b"\x00")
    tags = _text_frame(b"TLEN", str(n * 36)) + _text_frame(b"TXXX", f"payload-bytes\x00{len(data)}")
    tags += _text_frame(b"TXXX", "payload-sha256\x00" + hashlib.sha256(payload).hexdigest())
    head = b"ID3\x03\x00\x00" + _syncsafe(len(tags)) + tags
    tail = b"TAG" + hashlib.sha256(payload).hexdigest()[:30].encode() + bytes(94) + b"\xff"
    return head + table + frames.tobytes() + tail


@dataclass
class Stream:
    """What a reader finds in a stream. offsets: of the audio frames, tables not counted."""

    tags: dict[str, str] = field(default_factory=dict)
    id3v1: bytes | None = None
    table: str | None = None
    table_frames: int | None = None
    table_bytes: int | None = None
    toc: bytes | None = None
    #: Places in the stream that a VBRI table's entries give.
    seek_table: list[int] = field(default_factory=list)
    #: Samples that the encoder put before and after the audio.
    delay: int = 0
    padding: int = 0
    offsets: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    crc_checked: int = 0
    crc_wrong: int = 0
    resyncs: int = 0
    skipped: int = 0
    truncated: int = 0

    @property
    def samples(self) -> int:
        return sum(h.samples for h in self.headers)

    @property
    def audible(self) -> int:
        """Samples without the encoder's delay and padding."""
        return max(0, self.samples - self.delay - self.padding)

    @property
    def duration_us(self) -> int:
        """Exact but for the last rounding down (samples and rate are exact); rates may change from frame to frame."""
        by_rate: dict[int, int] = {}
        for h in self.headers:
            by_rate[h.sample_rate] = by_rate.get(h.sample_rate, 0) + h.samples
        scale = 14_112_000  # the least common multiple of all sample rates
        return sum(n * (scale // hz) for hz, n in by_rate.items()) * 1_000_000 // scale


def _parse_id3v2(data: bytes) -> tuple[dict[str, str], int]:
    if data[:3] != b"ID3" or len(data) < 10 or data[3] > 4:
        return {}, 0
    version, safe = data[3], lambda b: b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]
    end, tags = min(len(data), 10 + safe(data[6:10])), {}
    block = data[10:end]
    if data[5] & 0x80 and version < 4:
        block = block.replace(b"\xff\x00", b"\xff")  # unsynchronised as a whole
    at = 0
    if data[5] & 0x40 and version >= 3 and len(block) >= 4:  # an extended header; its size counts itself in version 4 only
        at = safe(block[:4]) if version == 4 else 4 + struct.unpack(">I", block[:4])[0]
    wide, head = (4, 10) if version >= 3 else (3, 6)
    while at + head <= len(block) and block[at]:
        name, raw = block[at : at + wide].decode("latin-1"), block[at + wide : at + 2 * wide]
        length = safe(raw) if version == 4 else int.from_bytes(raw, "big")
        body = block[at + head : at + head + length]
        if name[0] == "T" and body:
            coding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
            key, _, value = body[1:].decode(coding, "replace").rstrip("\x00").partition("\x00")
            tags |= {f"TXXX:{key}": value} if name in ("TXXX", "TXX") else {name: key}
        at += head + length
    return tags, end + 10 * bool(version == 4 and data[5] & 0x10)


def _next_frame(data: bytes, at: int, end: int) -> int:
    """The first place from at on with a header that another header of its kind, or the stream's end, follows; end if there is none."""
    while 0 <= (at := data.find(b"\xff", at, end)):
        if h := read_header(data[at : at + 4]):
            after = at + h.length
            follower = read_header(data[after : after + 4]) if after + 4 <= end else None
            if after == end or follower and (follower.version, follower.layer, follower.sample_rate) == (h.version, h.layer, h.sample_rate):
                return at
        at += 1
    return end


def read_stream(data: bytes) -> Stream:
    out = Stream()
    out.tags, at = _parse_id3v2(data)
    end = len(data)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        out.id3v1, end = data[end - 128 :], end - 128
    while at < end:
        h = read_header(data[at : at + 4])
        if h is None:
            found = _next_frame(data, at, end)
            out.resyncs, out.skipped, at = out.resyncs + (found < end or not out.offsets), out.skipped + found - at, found
            continue
        if at + h.length > end:
            out.truncated += 1
            break
        lead = 4 + 2 * h.protected
        if h.protected:
            out.crc_checked += 1
            body = data[at + 6 : at + h.length]
            bits = protected_bits(h, body)
            covered = data[at + 2 : at + 4] + body[: (bits + 7) // 8]
            out.crc_wrong += 8 * len(covered) < 16 + bits or crc16_bits(covered, 16 + bits) != data[at + 4] << 8 | data[at + 5]
        if not out.offsets and out.table is None and _read_table(out, data[at : at + h.length], lead, h, at):
            at += h.length
            continue
        out.offsets.append(at)
        out.headers.append(h)
        at += h.length
    return out


def _read_table(out: Stream, frame: bytes, lead: int, h: Header, start: int = 0) -> bool:
    """Reads a Xing, Info or VBRI table; False if the frame holds none."""
    # encoders that protect their frames may place the table as if there were no checksum
    for at in (lead + h.side, 4 + h.side):
        if (name := frame[at : at + 4]) in (b"Xing", b"Info") and at + 8 <= len(frame):
            flags, at = struct.unpack(">I", frame[at + 4 : at + 8])[0], at + 8
            for bit, key in ((1, "table_frames"), (2, "table_bytes")):
                if flags & bit and at + 4 <= len(frame):
                    setattr(out, key, struct.unpack(">I", frame[at : at + 4])[0])
                    at += 4
            if flags & 4:
                out.toc = frame[at : at + 100]
            at += 100 * bool(flags & 4) + 4 * bool(flags & 8)
            if frame[at : at + 4] in (b"LAME", b"Lavf", b"Lavc") and at + 24 <= len(frame):
                out.delay, out.padding = frame[at + 21] << 4 | frame[at + 22] >> 4, (frame[at + 22] & 15) << 8 | frame[at + 23]
            out.table = name.decode()
            return True
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        out.table = "VBRI"
        out.delay = struct.unpack(">H", frame[42:44])[0]
        out.table_bytes, out.table_frames, n, scale, width = struct.unpack(">IIHHH", frame[46:60])
        place = start + h.length
        for k in range(n if 1 <= width <= 4 else 0):
            entry = frame[62 + k * width : 62 + (k + 1) * width]
            if len(entry) < width:
                break
            place += int.from_bytes(entry, "big") * scale
            out.seek_table.append(place)
        return True
    return False


def read_payload(data: bytes, stream: Stream | None = None) -> bytes:
    """The payload, with its padding, of a stream by write_stream."""
    stream = stream or read_stream(data)
    return b"".join(data[at + _LEAD : at + _LEAD + UNIT] for at in stream.offsets)


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, n_frames long, samples long, sample_rate int, duration_us long, crc_wrong long, resyncs long, seek_offsets array<long>"
)


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id and media: each text's carrier stream. The table is written to the shared folder."""
    streams = map_rows(
        docs.select("doc_id", whole_text().alias("text")),
        lambda: lambda row: [(row["doc_id"], write_stream(row["text"].encode()))],
        "doc_id long, media binary",
    )
    return materialize(streams, "media")


def _features(row: dict) -> list[tuple]:
    media = row["media"]
    s = read_stream(media)
    payload = read_payload(media, s)
    stored = s.tags.get("TXXX:payload-bytes")
    n_bytes = int(stored) if stored is not None else len(payload.rstrip(bytes((PAD,))))
    digest = hashlib.sha256(payload).hexdigest()
    offsets = np.array(s.offsets, "<i8")
    feature = {
        "kind": f"MPEG-{ {3: '1', 2: '2', 0: '2.5'}[s.headers[0].version] } L{s.headers[0].layer}" if s.headers else None,
        "sample_rate": s.headers[0].sample_rate if s.headers else None, "frames": len(s.offsets), "samples": s.samples, "duration_us": s.duration_us,
        "table": s.table, "table_ok": (s.table_frames, s.table_bytes) == (len(s.offsets), sum(h.length for h in s.headers) + (s.offsets[0] - _tag_end(media) if s.offsets else 0)),
        "crc_checked": s.crc_checked, "crc_wrong": s.crc_wrong, "payload_ok": s.tags.get("TXXX:payload-sha256") == digest,
        "resyncs": s.resyncs, "skipped": s.skipped, "seek_crc32": zlib.crc32(offsets.tobytes()),
    }
    return [
        (
            row["doc_id"], n_bytes, len(payload), digest, zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(),
            json.dumps(feature, sort_keys=True), len(s.offsets), s.audible, feature["sample_rate"], s.duration_us, s.crc_wrong, s.resyncs, s.offsets,
        )
    ]


def _tag_end(media: bytes) -> int:
    return _parse_id3v2(media)[1]


def media_features(media: DataFrame) -> DataFrame:
    """What the reader finds in each stream of (doc_id, media): SCHEMA's columns. A null stream counts as empty: no frames."""
    return map_rows(media.select("doc_id", F.coalesce("media", F.lit(b"")).alias("media")), lambda: _features, SCHEMA)


def audio_round_trip(docs: DataFrame) -> DataFrame:
    """Stores each whole text as a stream in a media table and reads the stored streams back."""
    return media_features(store_media(docs))
