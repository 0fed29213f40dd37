"""Secret scans with a recursive decoding worklist.

A text is layer 0. Each layer is scanned, and every part of it that is URL-escaped, Unicode-escaped,
base64 or compressed data is unwrapped into a further layer until none is left. A layer knows for each
character the part of its parent that it came from, by runs and not by character, so a finding deep inside is
a span of the text. Layers, and bytes that may be compressed once more, are entries of one list and never
nested calls; what has been met at the same place isn't entered again, which ends cycles. Data that inflates
to more than `WINDOW` bytes goes through in windows, so a text of a few kilobytes can't fill the memory.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.llm.texts import map_slices

# Fixed patterns and their kinds, in the order of the kinds.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# A run that is long enough is the same match as a run of any length that is then measured.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8

# The shortest secret (an assignment of 14 bytes) takes this many base64 characters.
MIN_BASE64 = 19
# Inflated data is held up to this many bytes at a time; what is beyond comes in windows of as many that share
# `OVERLAP` bytes, and encoded data inside such a stream is whole if it is within one window.
WINDOW = 32 << 20
OVERLAP = 4 << 20
# Bytes that one call of a decompressor gives at most, and that one is given at a time; a zstd one can't be told
# how much to give, but a small part of its input doesn't hold more than a few megabytes.
STEP = 1 << 20
INPUT, ZSTD_INPUT = 1 << 16, 256
# Characters and bytes that are scanned for one text in all. Only bombs, and escapes of escapes by the
# thousand, come near; a text that does is marked (`complete` is false), since it might never end.
MAX_SCANNED = 4 << 30

_ENCODED = re.compile(r"%[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4}|\\[ux]|&#|[A-Za-z0-9+/_-]{" + str(MIN_BASE64) + "}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|%u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{" + str(MIN_BASE64) + ",}={0,2}")
# Lines of data, however wide and indented; `_wrapped` takes those of one width together.
_LINES = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{" + str(MIN_BASE64) + r",}+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]++)+={0,2}"
)
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_PRINTABLE = re.compile(rb"[\x20-\x7e]{8}")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
# Beginnings that don't turn up by chance, looked for inside of data too.
_STRONG = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
# Bytes written as escapes, the printable ones perhaps as they are.
_BYTES = re.compile(
    r"(?:%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2})(?:%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|\\[nrtabfv0\\'\"]|[!-$&-;=?-\[\]-~])+"
)
_NAMED = {"n": 10, "r": 13, "t": 9, "a": 7, "b": 8, "f": 12, "v": 11, "0": 0, "\\": 92, "'": 39, '"': 34}
_UNIT = re.compile(r"%([0-9A-Fa-f]{2})|\\x([0-9A-Fa-f]{2})|\\(.)|(.)", re.S)
_READABLE = bytes(b if 32 <= b < 127 or b in (9, 10, 13) else 0 for b in range(256))


@dataclass
class Layer:
    """A text and where it came from: `behind(i)` is the first and the last character of `parent` behind
    character i. Without a parent, `fixed` is the span of the original text that all of it stands for; without
    either it is the original text."""

    text: str
    depth: int
    parent: Layer | None = None
    behind: Callable[[int], tuple[int, int]] | None = None
    fixed: tuple[int, int] | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text behind `text[start:end]`. Decoding keeps the order, so the first
        and the last character decide."""
        layer, first, last = self, start, end - 1
        while layer.parent is not None:
            first, last = layer.behind(first)[0], layer.behind(last)[1]
            layer = layer.parent
        return layer.fixed or (first, last + 1)

    def child(self, text: str, behind: Callable[[int], tuple[int, int]]) -> Layer:
        if self.parent is None and self.fixed is not None:
            return Layer(text, self.depth + 1, fixed=self.fixed)
        return Layer(text, self.depth + 1, self, behind)


class Pieces:
    """Where the runs of a rewritten text came from: character i of a run stands for `size` characters of the
    old text, the i-th `size` of them."""

    def __init__(self):
        self.new, self.old, self.size, self.length = array("i"), array("i"), array("i"), 0

    def add(self, old: int, size: int, n: int) -> None:
        if n:
            self.new.append(self.length)
            self.old.append(old)
            self.size.append(size)
            self.length += n

    def __call__(self, i: int) -> tuple[int, int]:
        at = bisect_right(self.new, i) - 1
        first = self.old[at] + (i - self.new[at]) * self.size[at]
        return first, first + self.size[at] - 1


def scan(text: str) -> list[tuple[int, int, int]]:
    """`(start, kind, end)` of the findings in one layer, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def _text_of(data: bytes) -> str:
    """Text of bytes; bytes that aren't UTF-8 are read as ASCII with anything else blanked out."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.translate(_READABLE).decode()


def _widths(text: str) -> list[int]:
    """UTF-8 bytes of each character."""
    return [1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in text]


def _rewritten(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match replaced by `decode(match)`: the new text, and the number of old characters
    behind each new one (one number if they are all the same), or None to leave the match."""
    texts, pieces, at = [], Pieces(), 0
    for m in pattern.finditer(layer.text):
        new = decode(m[0])
        if new is None:
            continue
        text, sizes = new
        texts += [layer.text[at : m.start()], text]
        pieces.add(at, 1, m.start() - at)
        at = m.start()
        if isinstance(sizes, int):
            pieces.add(at, sizes, len(text))
        else:
            for size in sizes:
                pieces.add(at, size, 1)
                at += size
        at = m.end()
    if not texts:
        return None
    texts.append(layer.text[at:])
    pieces.add(at, 1, len(layer.text) - at)
    return layer.child("".join(texts), pieces)


def _bytes_run(data: bytes, unit: int) -> tuple[str, int | list[int]]:
    """Text of a run of escaped bytes of `unit` characters each."""
    text = _text_of(data)
    return text, unit if text.isascii() else [unit * w for w in _widths(text)]


def _percent(run: str) -> tuple[str, int | list[int]]:
    return _bytes_run(bytes.fromhex(run.replace("%", "")), 3)


def _escape(run: str) -> tuple[str, int | list[int]] | None:
    if run[:2] == "\\x":
        return _bytes_run(bytes.fromhex(run.replace("\\x", "")), 4)
    if run[:2] in ("\\u", "%u") and run[2] != "{":
        text = bytes.fromhex(re.sub(r"[\\%]u", "", run)).decode("utf-16-be", "replace")
        return text, 6 if max(text) < "\U00010000" else [6 * (1 + (c > "\uffff")) for c in text]
    digits = run[2:-1] if run[0] == "&" else run[3:-1]
    code = int(digits) if run[0] == "&" and digits[0] not in "xX" else int(digits.lstrip("xX"), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), len(run)


def _escaped_bytes(run: str) -> bytes:
    return bytes(int(m[1] or m[2], 16) if m[1] or m[2] else _NAMED[m[3]] if m[3] else ord(m[4]) for m in _UNIT.finditer(run))


class _Zstd:
    """A zstd frame."""

    def __init__(self):
        import zstandard

        self.tool, self.unused_data, self.eof = zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj(), b"", False

    def chunks(self, data: bytes) -> Iterator[bytes]:
        for at in range(0, len(data), ZSTD_INPUT):
            yield self.tool.decompress(bytes(data[at : at + ZSTD_INPUT]))
            if self.tool.eof:
                self.eof, self.unused_data = True, self.tool.unused_data + bytes(data[at + ZSTD_INPUT :])
                return


class _Zlib:
    """A gzip or zlib stream."""

    def __init__(self):
        self.tool, self.unused_data, self.eof = zlib.decompressobj(47), b"", False

    def chunks(self, data: bytes) -> Iterator[bytes]:
        for at in range(0, len(data), INPUT):
            part = data[at : at + INPUT]
            while len(part) and not self.tool.eof:
                yield self.tool.decompress(part, STEP)
                part = self.tool.unconsumed_tail
            if self.tool.eof:
                self.eof, self.unused_data = True, self.tool.unused_data + bytes(data[at + INPUT :])
                return


class _Buffered:
    """A bzip2 or xz stream, whose decompressor keeps its own input."""

    def __init__(self, tool):
        self.tool = tool

    def chunks(self, data: bytes) -> Iterator[bytes]:
        yield self.tool.decompress(data, STEP)
        while not self.tool.eof and not self.tool.needs_input:
            yield self.tool.decompress(b"", STEP)

    eof = property(lambda self: self.tool.eof)
    unused_data = property(lambda self: self.tool.unused_data)


def _decompressor(data: bytes):
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78":
        return _Zlib()
    if data[:3] == b"BZh":
        return _Buffered(bz2.BZ2Decompressor())
    if data[:6] == b"\xfd7zXZ\x00":
        return _Buffered(lzma.LZMADecompressor(memlimit=256 << 20))
    return _Zstd()


class Inflated:
    """What compressed streams that follow each other hold, in parts of bounded size. Afterwards `whole` tells
    whether none was damaged or cut short, and `used` how many bytes they took. Data that fails at once is no
    stream."""

    def __init__(self, data: bytes | memoryview):
        self.data, self.whole, self.used = data, True, 0

    def parts(self) -> Iterator[bytes]:
        data = self.data
        while bytes(data[:8]).startswith(_MAGIC):
            held, given = b"", False
            try:
                tool = _decompressor(bytes(data[:8]))
                for part in tool.chunks(data):
                    # The first part is only given when there is a second: what fails before isn't a stream.
                    if len(held) + len(part) > STEP:
                        yield held
                        given, held = True, part
                    else:
                        held += part
            except Exception:  # damaged data of any of these formats
                if given:
                    self.whole = False
                    yield held
                return
            yield held
            if not tool.eof:
                self.whole, self.used = False, len(self.data)
                return
            self.used = len(self.data) - len(tool.unused_data)
            data = tool.unused_data.lstrip(b"\0")


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of base64 data: runs of lines of one width with a last one that may be shorter, and every
    line by itself."""
    for m in _LINES.finditer(text):
        lines = [x.span() for x in _LINE.finditer(text, m.start(), m.end())]
        at = 0
        while at < len(lines):
            begin, width, end = at, lines[at][1] - lines[at][0], at + 1
            while end < len(lines) and lines[end][1] - lines[end][0] == width:
                end += 1
            if end < len(lines) and lines[end][1] - lines[end][0] < width:
                end += 1
            if end - begin > 1:
                yield lines[begin][0], lines[end - 1][1]
            at = max(begin + 1, end - 1) if end < len(lines) else end
    for m in _BASE64.finditer(text):
        yield m.span()


_BASE64_LETTER = np.zeros(128, bool)
_BASE64_LETTER[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"]] = True
_TO_STANDARD = {ord("-"): "+", ord("_"): "/", **dict.fromkeys(map(ord, "=\r\n \t"))}


def _base64_places(start: int, letters: np.ndarray | None, skip: int, text: str) -> Callable[[int], tuple[int, int]]:
    """Characters of the layer behind each character of decoded `text`: bit 8b of the data is in character
    8b // 6 of the run, and bit 8b + 7 in (8b + 7) // 6. The run begins at `start`; `letters` are its places if lines were joined."""
    ends = None if text.isascii() else np.cumsum(np.array(_widths(text), np.int32))

    def behind(i: int) -> tuple[int, int]:
        first, last = (i, i) if ends is None else (int(ends[i - 1]) if i else 0, int(ends[i]) - 1)
        a, b = skip + first * 8 // 6, skip + (last * 8 + 7) // 6
        if letters is None:
            return start + a, start + b
        return start + int(letters[a]), start + int(letters[b])

    return behind


class _Worklist:
    """Entries are layers, bytes that may be compressed, and streams of windows."""

    def __init__(self, text: str):
        self.todo: deque = deque([Layer(text, 0)])
        self.seen: set[tuple[bytes, int, int]] = {self.key(text.encode("utf-8", "surrogatepass"), 0, len(text))}
        self.left, self.complete = MAX_SCANNED, True

    @staticmethod
    def key(data: bytes, low: int, high: int) -> tuple[bytes, int, int]:
        return blake2b(data, digest_size=16).digest(), low, high

    def is_new(self, data: bytes, low: int, high: int) -> bool:
        """Whether the content hasn't been met at this place: that ends cycles. Counts what is scanned."""
        key = self.key(data, low, high)
        if key in self.seen:
            return False
        self.left -= len(data)
        if self.left < 0:
            self.complete = False
            return False
        self.seen.add(key)
        return True

    def add(self, layer: Layer | None) -> None:
        if layer is not None and layer.text:
            span = layer.span(0, len(layer.text))
            if self.is_new(layer.text.encode("utf-8", "surrogatepass"), *span):
                self.todo.append(layer)

    def inflate(self, data: bytes, span: tuple[int, int], depth: int) -> bool:
        """Enter what the compressed streams in `data` hold; whether there is one at its beginning."""
        at_start, used = False, 0
        for at in sorted({0, *(m.start() for m in _STRONG.finditer(data))}):
            # Data that doesn't shrink lies open in a stream that holds it: it comes out of that one.
            if at < used:
                continue
            stream = Inflated(memoryview(data)[at:])
            held, parts = bytearray(), stream.parts()
            for part in parts:
                held += part
                if len(held) > WINDOW:
                    self.todo.append(self.windows(held, parts, stream, span, depth))
                    used = len(data)
                    break
            else:
                used = max(used, at + stream.used)
                if held:
                    self.complete &= stream.whole
                    if self.is_new(bytes(held), *span):
                        self.todo.append((bytes(held), span, depth))
            at_start |= at == 0 and bool(held)
        return at_start

    def windows(self, held: bytearray, parts: Iterator[bytes], stream: Inflated, span: tuple[int, int], depth: int):
        """Entries of bytes of at most about `WINDOW`, each beginning with the end of the one before."""
        while held:
            more = True
            while len(held) <= WINDOW and more:
                part = next(parts, None)
                more = part is not None
                held += part or b""
            if self.is_new(bytes(held), *span):
                yield bytes(held), span, depth
            if self.left < 0:
                return
            del held[: max(len(held) - OVERLAP, 0) if more else len(held)]
            # Not in the middle of a character.
            while held and held[0] & 0xC0 == 0x80 and more:
                del held[0]
        self.complete &= stream.whole

    def layers(self) -> Iterator[Layer]:
        while self.todo:
            entry = self.todo.popleft()
            if isinstance(entry, Layer):
                yield entry
            elif isinstance(entry, tuple):
                data, span, depth = entry
                if not ((data.startswith(_MAGIC) or _STRONG.search(data)) and self.inflate(data, span, depth + 1) and data.startswith(_MAGIC)):
                    yield Layer(_text_of(data), depth, fixed=span)
            else:
                following = next(entry, None)
                if following is not None:
                    self.todo.appendleft(entry)
                    self.todo.appendleft(following)

    def unwrap(self, layer: Layer) -> None:
        if not _ENCODED.search(layer.text):
            return
        for m in _BYTES.finditer(layer.text):
            data = _escaped_bytes(m[0])
            if _STRONG.search(data) or data.startswith(_MAGIC):
                self.inflate(data, layer.span(m.start(), m.end()), layer.depth + 2)
        self.add(_rewritten(layer, _PERCENT, _percent))
        self.add(_rewritten(layer, _ESCAPES, _escape))
        inflated: list[tuple[int, int]] = []
        for start, stop in _wrapped(layer.text):
            # The lines of a compressed payload are no payloads of their own.
            if any(a <= start and stop <= b + 2 for a, b in inflated):
                continue
            part = layer.text[start:stop]
            mask = _BASE64_LETTER[np.frombuffer(part.encode("ascii"), np.uint8)]
            run = part.translate(_TO_STANDARD)
            # Places of the letters, if anything stands between them.
            letters = None if mask[: len(run)].all() else np.flatnonzero(mask).astype(np.int32)
            # What stands before the data may have run into it: any of four starts can be the right one.
            for skip in range(4):
                own = run[skip:]
                own = own[: len(own) - (len(own) % 4 == 1)]
                try:
                    data = base64.b64decode(own + "=" * (-len(own) % 4))
                except binascii.Error:
                    continue
                packed = data.startswith(_MAGIC) or _STRONG.search(data)
                if not packed and not _PRINTABLE.search(data):
                    continue
                begin = start + (skip if letters is None else int(letters[skip]))
                if packed and self.inflate(data, layer.span(begin, stop), layer.depth + 2):
                    if _STRONG.match(data):
                        inflated.append((start, stop))
                    continue
                text = _text_of(data)
                if text:
                    self.add(layer.child(text, _base64_places(start, letters, skip, text)))


def find(text: str) -> tuple[list[tuple[int, int, int, int]], bool]:
    """`(start, kind, end, depth)` of all findings, and whether every layer was unwrapped whole.

    Layer 0 comes with all its findings; a finding of a deeper layer that is the same kind and span as
    an earlier one isn't repeated.
    """
    work = _Worklist(text)
    found: dict[tuple[int, int, int], int] = {}
    for layer in work.layers():
        for start, kind, end in scan(layer.text):
            low, high = layer.span(start, end)
            found.setdefault((low, kind, high), layer.depth)
        work.unwrap(layer)
        # Later layers only ask where their parents came from.
        layer.text = ""
    return sorted((*span, depth) for span, depth in found.items()), work.complete


SPANS = "array<struct<start: long, kind: string, end: long, depth: int>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, spans, complete)`, one row per row of `docs`.

    `spans` are ordered by start, then kind, then end (code points, end exclusive); depth 0 is the text
    itself. Null and empty texts have none. Repeated rows are scanned each. Extra columns aren't read.
    """
    item = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("depth", pa.int32())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t or "") for t in batch.column("text").to_pylist()]
        spans = [[{"start": s, "kind": KINDS[k], "end": e, "depth": d} for s, k, e, d in f] for f, _ in found]
        complete = pa.array([c for _, c in found], pa.bool_())
        return pa.record_batch([batch.column("doc_id"), pa.array(spans, pa.list_(item)), complete], names=["doc_id", "spans", "complete"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(rows, "text", run, f"doc_id {dict(rows.dtypes)['doc_id']}, spans {SPANS}, complete boolean")


def span_text(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
