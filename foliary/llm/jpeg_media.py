"""Baseline JPEG media columns: a writer of DC-only images and a reader of baseline scans, both vectorised in numpy.

The writer stores bytes without loss: each byte is the DC coefficient of one 8x8 block of a greyscale image (quantiser 8, so
that the block's sample is the byte), rows of 64 blocks are restart intervals. A payload of more than ``FRAME`` bytes is a
sequence of such files, one after the other (as in motion JPEG). The reader parses markers and quantisation and
Huffman tables, splits scans at restart markers, decodes all intervals of a batch of images in step (one numpy operation per
symbol for all lanes), skips AC coefficients, and gives the luminance thumbnail of the DC coefficients: one pixel per block.

Null texts are empty texts. An empty payload is one padding unit of zeros. Equal payloads give equal media. Payloads of any
length fit whose media fits a cell (2 GB); memory is bounded by a few frames beside the row itself. Extra columns are ignored,
repeated rows repeat, an empty table gives an empty result. Files that aren't baseline JPEG, or that end early, raise ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foliary.llm.common import quiet_threads, slices, stage, texts

UNIT = 64
FRAME = UNIT * 8191  # bytes of one file: the most rows of blocks that a height of 16 bits allows
# Lengths of the writer's codes. DC categories 0 to 8 (differences of -255 to 255); AC has the end of block alone.
_DC_LENGTHS = {0: 5, 1: 4, 2: 4, 3: 3, 4: 2, 5: 4, 6: 4, 7: 2, 8: 6}
_AC_LENGTHS = {0x00: 1}
# The zigzag place of each coefficient isn't needed for DC; markers of the format.
_SOI, _EOI, _SOF0, _DHT, _DQT, _DRI, _SOS, _COM = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE


def _canonical(lengths: dict[int, int]) -> tuple[dict[int, tuple[int, int]], bytes]:
    """symbol -> (code, length) in canonical order, and the body of the DHT segment."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    codes, code, before = {}, 0, 0
    for s in order:
        code <<= lengths[s] - before
        before = lengths[s]
        codes[s] = (code, before)
        code += 1
    counts = bytes(sum(1 for s in order if lengths[s] == n) for n in range(1, 17))
    return codes, counts + bytes(order)


_DC_CODES, _DC_BODY = _canonical(_DC_LENGTHS)
_AC_CODES, _AC_BODY = _canonical(_AC_LENGTHS)


def _block_codes() -> tuple[np.ndarray, np.ndarray]:
    """For each difference + 255: the bits of its block (DC code, value, end of block) and their number."""
    bits, sizes = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    eob, eob_size = _AC_CODES[0]
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, size = _DC_CODES[category]
        value = d if d >= 0 else d + (1 << category) - 1
        bits[d + 255] = (((code << category) | value) << eob_size) | eob
        sizes[d + 255] = size + category + eob_size
    return bits, sizes


_BITS, _SIZES = _block_codes()


def payload_of(raw: bytes) -> bytes:
    """Bytes 0 appended up to a positive multiple of 64."""
    return raw + b"\0" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def frames_of(payload: bytes) -> list[bytes]:
    return [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]


def _header(down: int, n_bytes: int) -> bytes:
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    return b"".join([
        struct.pack(">BB", 0xFF, _SOI),
        segment(_COM, b"payload " + str(n_bytes).encode()),
        segment(_DQT, b"\0" + bytes([8] + [1] * 63)),
        segment(_SOF0, struct.pack(">BHHBBBB", 8, down * 8, UNIT * 8, 1, 1, 0x11, 0)),
        segment(_DHT, b"\x00" + _DC_BODY + b"\x10" + _AC_BODY),
        segment(_DRI, struct.pack(">H", UNIT)),
        segment(_SOS, bytes([1, 1, 0, 0, 63, 0])),
    ])


def encode_images(payloads: list[bytes]) -> list[bytes]:
    """A JPEG file per payload (each of a positive multiple of 64 bytes, ``FRAME`` at most)."""
    if not payloads:
        return []
    rows = np.array([len(p) // UNIT for p in payloads])
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, UNIT).astype(np.int16) - 128
    diff = np.diff(samples, axis=1, prepend=np.int16(0)) + 255
    sizes = _SIZES[diff]
    ends = np.cumsum(sizes, axis=1)
    row_bytes = -(-ends[:, -1] // 8)
    starts = np.cumsum(row_bytes) - row_bytes
    # each block's bits are added to the (at most 3) bytes they touch; bits of blocks never overlap
    at = (starts[:, None] * 8 + ends - sizes).ravel()
    word = _BITS[diff].ravel() << (np.uint64(24) - (at % 8).astype(np.uint64) - sizes.ravel().astype(np.uint64))
    total = int(row_bytes.sum())
    stream = np.zeros(total + 3, np.uint32)
    for k in range(3):
        part = (word >> np.uint64(16 - 8 * k)) & np.uint64(0xFF)
        stream += np.bincount(at // 8 + k, part, total + 3).astype(np.uint32)
    stream = stream[:total].astype(np.uint8)
    pad = (8 - ends[:, -1] % 8) % 8
    stream[starts + row_bytes - 1] |= ((1 << pad) - 1).astype(np.uint8)
    # stuff a 0 after each 0xFF, then a restart marker after each row but an image's last
    row_of_image = np.concatenate([np.arange(n) for n in rows])
    inner = row_of_image < np.repeat(rows, rows) - 1
    stuffed = (stream == 0xFF).astype(np.int64)
    cut = np.concatenate([[0], np.cumsum(stuffed)])
    row_sizes = row_bytes + cut[starts + row_bytes] - cut[starts] + 2 * inner
    row_starts = np.cumsum(row_sizes) - row_sizes
    data = np.zeros(int(row_sizes.sum()), np.uint8)
    before = np.repeat(row_starts - starts - cut[starts], row_bytes)
    data[np.arange(total) + cut[:-1] + before] = stream
    marked = np.flatnonzero(inner)
    data[row_starts[marked] + row_sizes[marked] - 2] = 0xFF
    data[row_starts[marked] + row_sizes[marked] - 1] = 0xD0 + row_of_image[marked] % 8
    edges = np.concatenate([[0], np.cumsum(row_sizes)])[np.concatenate([[0], np.cumsum(rows)])].tolist()
    return [_header(int(n), len(p)) + data[a:b].tobytes() + b"\xff\xd9" for n, p, (a, b) in zip(rows, payloads, pairwise(edges), strict=True)]


def split_files(media: bytes) -> list[bytes]:
    """The JPEG files of a media cell: each ends with the first end marker after its scan begins."""
    out, start = [], 0
    while start < len(media):
        at = start + 2
        while True:
            if media[start : start + 2] != b"\xff\xd8" or at + 4 > len(media) or media[at] != 0xFF:
                raise ValueError("a marker is missing")
            marker = media[at + 1]
            at += 1 if marker == 0xFF else 2 + int.from_bytes(media[at + 2 : at + 4], "big")
            if marker == _SOS:
                break
        end = media.find(b"\xff\xd9", at)
        if end < 0:
            raise ValueError("the scan has no end")
        out.append(media[start : end + 2])
        start = end + 2
    return out


class Image:
    """What the markers of a file say, and where its entropy-coded data lies."""

    def __init__(self, data: bytes) -> None:
        self.comment, self.interval, self.quant, self.huffman = b"", 0, {}, {}
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        at = 2
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("a marker is missing")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            if marker == _DQT:
                i = 0
                while i < len(body):
                    wide, name = body[i] >> 4, body[i] & 15
                    self.quant[name] = int.from_bytes(body[i + 1 : i + 2 + wide], "big")  # the DC quantiser
                    i += 1 + 64 * (1 + wide)
            elif marker == _DHT:
                i = 0
                while i < len(body):
                    n = sum(body[i + 1 : i + 17])
                    self.huffman[body[i]] = bytes(body[i + 1 : i + 17 + n])
                    i += 17 + n
            elif marker == _SOF0:
                precision, self.height, self.width, parts = struct.unpack(">BHHB", body[:6])
                if precision != 8:
                    raise ValueError("not 8 bits a sample")
                self.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(parts)]
            elif marker == _DRI:
                self.interval = int.from_bytes(body[:2], "big")
            elif marker == _COM:
                self.comment = body
            elif marker == _SOS:
                self.scan = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
                self.start = at + 2 + size
                break
            elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a baseline JPEG file")
            elif marker == _EOI:
                raise ValueError("no scan")
            at += 2 + size
        if not hasattr(self, "parts") or len(self.scan) != len(self.parts):
            raise ValueError("not one scan of all components")
        across, down = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        if len(self.parts) == 1:
            across = down = 1
            self.parts = [(self.parts[0][0], 1, 1, self.parts[0][3])]
        self.mcus_across, self.mcus_down = -(-self.width // (8 * across)), -(-self.height // (8 * down))
        tables = {c: (dc, ac) for c, dc, ac in self.scan}
        #: per block of an MCU: component, its table names
        self.blocks = [(i, *tables[p[0]]) for i, p in enumerate(self.parts) for _ in range(p[1] * p[2])]

    def key(self):
        """Images with one key can be decoded in step."""
        return tuple(self.blocks), tuple(sorted(self.huffman.items()))


def _lookup(body: bytes) -> np.ndarray:
    """For each 16 bits ahead: symbol << 8 | length of its code (0: no code)."""
    table, code, at = np.zeros(1 << 16, np.int32), 0, 16
    for size in range(1, 17):
        for _ in range(body[size - 1]):
            table[code << (16 - size) : (code + 1) << (16 - size)] = body[at] << 8 | size
            at += 1
            code += 1
        code <<= 1
    return table


def decode_dc(files: list[bytes]) -> list[tuple[Image, np.ndarray]]:
    """Per file its markers and its luminance thumbnail: a uint8 pixel per block of the first component."""
    images = [Image(f) for f in files]
    out: list = [None] * len(files)
    groups: dict = {}
    for i, image in enumerate(images):
        groups.setdefault(image.key(), []).append(i)
    for (blocks, huffman), which in groups.items():
        tables = {name: _lookup(body) for name, body in huffman}
        lanes, counts, owner = [], [], []
        for i in which:
            raw, image = files[i], images[i]
            data = np.frombuffer(raw, np.uint8)[image.start :]
            marks = np.flatnonzero(data[:-1] == 0xFF)
            after = data[marks + 1]
            stops = marks[(after != 0) & ((after < 0xD0) | (after > 0xD7))]
            if not len(stops):
                raise ValueError("the scan has no end")
            end = int(stops[0])
            restarts = marks[(after >= 0xD0) & (after <= 0xD7) & (marks < end)]
            edges = [0, *(restarts + 2).tolist()]
            keep = np.ones(end, bool)
            keep[marks[(after == 0) & (marks + 1 < end)] + 1] = False
            keep[restarts] = keep[restarts + 1] = False
            kept = np.concatenate([[0], np.cumsum(keep)])
            total, each = image.mcus_across * image.mcus_down, image.interval or image.mcus_across * image.mcus_down
            if -(-total // each) != len(edges):
                raise ValueError("restart intervals are missing")
            lanes.append((data[:end][keep], kept[edges], end))
            counts += [min(each, total - k * each) for k in range(len(edges))]
            owner += [i] * len(edges)
        base, firsts = 0, []
        for data, edges, _ in lanes:
            firsts.append(base + edges)
            base += len(data)
        stream = np.concatenate([*(d for d, _, _ in lanes), np.zeros(8, np.uint8)])
        at = np.concatenate(firsts).astype(np.int64) * 8
        limit = np.append(at[1:], base * 8)
        counts_all = np.array(counts, np.int64)
        # 24 bits from each byte on: any 16 bits are then one gather and one shift
        s32 = stream.astype(np.uint32)
        ahead = (s32[:-2] << np.uint32(16)) | (s32[1:-1] << np.uint32(8)) | s32[2:]
        n_parts = 1 + max(b[0] for b in blocks)
        predicted = np.zeros((n_parts, len(at)), np.int32)
        luminance = np.zeros((len(at), int(counts_all.max()) * sum(b[0] == 0 for b in blocks)), np.int32)
        order = np.argsort(-counts_all, kind="stable")
        at, limit, sorted_counts = at[order], limit[order], counts_all[order]

        def peek(p: np.ndarray, ahead=ahead) -> np.ndarray:
            return (ahead[np.minimum(p >> 3, len(ahead) - 1)] >> (np.uint32(8) - (p & 7).astype(np.uint32))) & np.uint32(0xFFFF)

        column = 0
        for step in range(int(counts_all.max())):
            n = int(np.searchsorted(-sorted_counts, -step))  # lanes with more than ``step`` MCUs
            p = at[:n]
            for part, dc_name, ac_name in blocks:
                found = tables[dc_name][peek(p)]
                if (found == 0).any():
                    raise ValueError("a code is not in the table")
                p = p + (found & 0xFF)
                size = (found >> 8).astype(np.int64)
                value = (peek(p) >> (np.uint32(16) - size.astype(np.uint32))).astype(np.int32)
                value -= np.where(value < (1 << size) >> 1, (1 << size) - 1, 0).astype(np.int32)
                p = p + size
                predicted[part, :n] += value
                if part == 0:
                    luminance[:n, column] = predicted[0, :n]
                    column += 1
                k = np.ones(n, np.int64)
                live = slice(None)
                table = tables[16 | ac_name]
                while True:
                    here = p[live]
                    found = table[peek(here)]
                    if (found == 0).any():
                        raise ValueError("a code is not in the table")
                    symbol = found >> 8
                    p[live] = here + (found & 0xFF) + (symbol & 15)
                    k[live] += (symbol >> 4) + 1
                    going = (symbol != 0) & (k[live] < 64)
                    if not going.any():
                        break
                    live = np.flatnonzero(going) if isinstance(live, slice) else live[going]
            at[:n] = p
        if (at > limit).any():
            raise ValueError("the data ends early")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        luminance = luminance[back]
        lane = 0
        for i, (_, edges, _) in zip(which, lanes, strict=True):
            image = images[i]
            _, h, v, quant = image.parts[0]
            per = h * v
            own = counts_all[lane : lane + len(edges)]
            dc = luminance[lane] [: own[0] * per] if len(own) == 1 else luminance[lane : lane + len(own)][np.arange(luminance.shape[1]) < own[:, None] * per]
            lane += len(own)
            pixels = np.clip((dc * image.quant[quant] + 4 >> 3) + 128, 0, 255).astype(np.uint8)
            grid = pixels.reshape(image.mcus_down, image.mcus_across, v, h).transpose(0, 2, 1, 3).reshape(image.mcus_down * v, image.mcus_across * h)
            out[i] = (image, grid)
    return out


class Thumbnail:
    """64-bit average and difference hashes of a thumbnail that comes in strips (one per file), shrunk by means of its cells."""

    def __init__(self) -> None:
        self.width, self.sums = 0, []

    def add(self, grid: np.ndarray) -> None:
        if self.width and grid.shape[1] != self.width:
            raise ValueError("the files of a cell differ in width")
        self.width = grid.shape[1]
        self.sums.append(np.concatenate([np.zeros((len(grid), 1), np.int64), grid.cumsum(1, dtype=np.int64)], axis=1)[:, np.unique(np.concatenate([self._edges(n).ravel() for n in (8, 9)]))])

    def _edges(self, n: int) -> np.ndarray:
        """Start and end of n cells across, one pixel wide at least."""
        return self._spread(self.width, n)

    @staticmethod
    def _spread(size: int, n: int) -> np.ndarray:
        edges = np.linspace(0, size, n + 1).astype(np.int64)
        high = np.maximum(edges[1:], edges[:-1] + 1).clip(max=size)
        return np.array([np.minimum(edges[:-1], high - 1), high])

    def hashes(self) -> tuple[int, int]:
        sums = np.concatenate(self.sums)
        area = np.concatenate([np.zeros((1, sums.shape[1]), np.int64), sums.cumsum(0)])
        low_r, high_r = self._spread(len(sums), 8)
        known = np.unique(np.concatenate([self._edges(n).ravel() for n in (8, 9)]))

        def cells(n: int) -> np.ndarray:
            low, high = self._edges(n)
            a, b = np.searchsorted(known, low), np.searchsorted(known, high)
            found = area[high_r][:, b] - area[low_r][:, b] - area[high_r][:, a] + area[low_r][:, a]
            return found / ((high_r - low_r)[:, None] * (high - low)[None, :])

        square, wide = cells(8), cells(9)
        pack = lambda bits: int.from_bytes(np.packbits(bits.ravel()).tobytes(), "big")
        return pack(square > square.mean()), pack(wide[:, 1:] > wide[:, :-1])


def _groups(parts: list[list[bytes]], most: int) -> Iterator[list[tuple[int, bytes]]]:
    """(owner, part) in runs of about ``most`` bytes."""
    run, size = [], 0
    for owner, own in enumerate(parts):
        for x in own:
            run.append((owner, x))
            size += len(x)
            if size >= most:
                yield run
                run, size = [], 0
    if run:
        yield run


MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def to_media(docs: DataFrame, slice_bytes: int = 4_000_000) -> DataFrame:
    """A media column: each whole text as the JPEG files that hold its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), slice_bytes):
                part = batch.slice(start, stop - start)
                raw = [(t.as_py() or "").encode() for t in part.column("text")]
                media: list[list[bytes]] = [[] for _ in raw]
                for group in _groups([frames_of(payload_of(r)) for r in raw], slice_bytes):
                    for (owner, _), data in zip(group, encode_images([x for _, x in group]), strict=True):
                        media[owner].append(data)
                yield pa.record_batch([part.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()), pa.array([b"".join(m) for m in media], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return texts(docs).mapInArrow(run, MEDIA)


def features(media: DataFrame, slice_bytes: int = 4_000_000) -> DataFrame:
    """Read the stored files back: payload, its checks, dimensions and thumbnail hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("media"), slice_bytes):
                part = batch.slice(start, stop - start)
                cells = part.column("media").to_pylist()
                files = [split_files(c) for c in cells]
                # bytes, sha256, last unit, thumbnail, height
                found = [[0, hashlib.sha256(), b"", Thumbnail(), 0] for _ in cells]
                for group in _groups(files, slice_bytes):
                    for (owner, _), (image, grid) in zip(group, decode_dc([x for _, x in group]), strict=True):
                        x = found[owner]
                        payload = grid.tobytes()[: int(image.comment.split()[-1])]
                        x[0] += len(payload)
                        x[1].update(payload)
                        x[2] = (x[2] + payload)[-UNIT:]
                        x[3].add(grid)
                        x[4] += image.height
                rows = [(n, sha.hexdigest(), zlib.crc32(tail), len(c), hashlib.sha256(c).hexdigest(), "{}x{} {:016x} {:016x}".format(8 * thumbnail.width, height, *thumbnail.hashes())) for (n, sha, tail, thumbnail, height), c in zip(found, cells, strict=True)]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.record_batch([part.column("doc_id"), part.column("n_bytes"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[x.split()[0] for x in FEATURES.split(", ")])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)


def store_and_read(docs: DataFrame) -> DataFrame:
    """Write the media column to the shared folder and return the features of what is read back."""
    return features(stage(to_media(docs), "media"))
