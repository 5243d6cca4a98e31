"""Secrets in texts and in what is encoded in them, by a worklist of decoded layers.

A text is the first layer.  Every layer is scanned, and what can be unwrapped in it
(percent signs, Unicode escapes, base64 in one or more lines, compressed bytes) becomes a further layer, until
nothing new comes.  A layer that was seen before at the same place is not worked on again,
so cycles end.
Spans found in a layer are mapped to the place in the text that they were decoded from.
"""

from __future__ import annotations

import base64
import bisect
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.support import packed, slices, unpacked, wider

# The kinds, in their order, and what their base spans look like.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
NAMES = ("passw", "secret", "token", "api")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64, of either alphabet: MIME and PEM wrap them.
_WRAPPED = tuple(
    re.compile(rf"(?<![{a}])[{a}]{{16,}}+(?:\r?\n[ \t]*+[{a}]++)++={{0,2}}")
    for a in ("A-Za-z0-9+/", "A-Za-z0-9_-")
)
#: Bytes in percent signs, of which some may stand as they are, and how packed ones begin.
_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9._~!*'()/+$,;:@-])++")
_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
_LONE = re.compile("[\udc80-\udcff]")
#: A compressed layer of up to so many bytes is held whole; a longer one is unpacked and
#: scanned in windows.
MAX_UNPACKED = 64_000_000
#: Characters of a window, and how many of the last window the next one repeats.
WINDOW, OVERLAP = 1_000_000, 65_536
#: Bytes that are unpacked for the windows of one text, and packings around them.  Both
#: end texts that would be unpacked for ever; what is beyond marks a text as incomplete.
MAX_STREAMED, MAX_NESTED = 4_000_000_000, 200
#: Windows end behind characters that no encoded run has inside.
_OUTSIDE = re.compile(r"[^A-Za-z0-9+/_=%\\&#;{}.~!*'()$,:@\s-]|(?<=\S) ")
_PLAIN = bytes([9, 10, 13, *range(32, 127)])
_CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_SHORTEST = 12
#: Runs of printable bytes that may hold a secret, and the same in UTF-16 of either order.
_PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
_PRINTABLE_WIDE = (
    re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}"), re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){12,}"),
)


class Pieces:
    """Where the stretches of a rewritten text come from: copied or decoded ones."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.begins: list[int] = []
        self.ends: list[int] = []
        self.copied: list[bool] = []
        self.length = 0

    def add(self, length: int, begin: int, end: int, copied: bool) -> None:
        if length:
            self.starts.append(self.length)
            self.begins.append(begin)
            self.ends.append(end)
            self.copied.append(copied)
            self.length += length

    def back(self, start: int, end: int) -> tuple[int, int]:
        i = bisect.bisect_right(self.starts, start) - 1
        j = bisect.bisect_right(self.starts, end - 1) - 1
        first, last = self.begins[i], self.ends[j]
        if self.copied[i]:
            first += start - self.starts[i]
        if self.copied[j]:
            last = self.begins[j] + end - self.starts[j]
        return first, last


@dataclass(frozen=True)
class Layer:
    """Decoded text: all of it from ``outer`` in the first text, or by ``pieces`` from its
    ``parent``; the first text has neither."""

    text: str
    outer: tuple[int, int] | None = None
    parent: Layer | None = None
    pieces: Pieces | None = None
    via: str = ""

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.outer is None and layer.parent is not None and layer.pieces is not None:
            start, end = layer.pieces.back(start, end)
            layer = layer.parent
        return layer.outer or (start, end)

    def key(self) -> tuple:
        digest = hashlib.blake2b(self.text.encode(errors="surrogatepass"), digest_size=16)
        return digest.digest(), self.outer


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) of the base matches."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                found.append(("access", m.start(), m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _percent(run: str) -> str:
    """The run as UTF-8; bytes that are none are taken as Latin-1, one by one."""
    text = bytes.fromhex(run.replace("%", "")).decode(errors="surrogateescape")
    return _LONE.sub(lambda m: chr(ord(m[0]) - 0xDC00), text)


def _escape(run: str) -> str | None:
    try:
        if run.startswith("\\u") and run[2] != "{":
            units = bytes.fromhex("".join(run.split("\\u")))
            return units.decode("utf-16-be")
        digits = run.strip("\\&#;ux{}")
        return chr(int(digits, 10 if run[:2] == "&#" and run[2] != "x" else 16))
    except (ValueError, OverflowError):
        return None


def _rewritten(layer: Layer, pattern: re.Pattern[str], decode, via: str) -> Layer | None:
    """The layer with all matches decoded in place, or None if nothing was."""
    out: list[str] = []
    pieces = Pieces()
    text, at = layer.text, 0
    for m in pattern.finditer(text):
        decoded = decode(m[0])
        if decoded is None:
            continue
        out += [text[at : m.start()], decoded]
        pieces.add(m.start() - at, at, m.start(), True)
        pieces.add(len(decoded), m.start(), m.end(), False)
        at = m.end()
    if not out:
        return None
    out.append(text[at:])
    pieces.add(len(text) - at, at, len(text), True)
    return Layer("".join(out), layer.outer, layer, pieces, f"{layer.via}>{via}".lstrip(">"))


def _bounded(make, data: bytes) -> bytes:
    """The content of all members of packed data, or of what a cut or broken stream gives.
    """
    out, held = [], 0
    while True:
        unpacker, at = make(), 0
        try:
            while not unpacker.eof and at < len(data):
                piece = data[at : at + OVERLAP]
                at += len(piece)
                while piece or not getattr(unpacker, "needs_input", True):
                    got = unpacker.decompress(piece, MAX_UNPACKED - held + 1)
                    piece = getattr(unpacker, "unconsumed_tail", b"")
                    out.append(got)
                    held += len(got)
                    if held > MAX_UNPACKED:
                        raise OverflowError
                    if unpacker.eof or not (got or piece):
                        break
        except _ERRORS:
            break
        rest = unpacker.unused_data + data[at:] if unpacker.eof else b""
        if not rest.startswith(_MAGICS):
            break
        data = rest
    return b"".join(out)


_PACKINGS = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(31)),
    (b"x", lambda: zlib.decompressobj(15)),
    (b"BZh", bz2.BZ2Decompressor),
    (b"\xfd7zXZ", lzma.LZMADecompressor),
)
_MAGICS = tuple(magic for magic, _ in _PACKINGS)
_ERRORS = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)


def _unpacked(data: bytes) -> bytes | None:
    """The content of gzip, zlib, bzip2 or xz data, else None."""
    for magic, make in _PACKINGS:
        if data.startswith(magic):
            content = _bounded(make, data)
            if content:
                return content
    return None


def _odd(text: str) -> int:
    """How many characters are neither printable nor blanks."""
    if text.isascii():
        return len(text.encode().translate(None, _PLAIN))
    return sum(1 for c in text if not (c.isprintable() or c in "\t\r\n"))


def _readable(data: bytes) -> str | None:
    """The text that bytes are: UTF-8, UTF-16, or else their printable runs.

    Latin-1 letters, paddings and binary parts end runs; each run is a line.
    """
    try:
        text = data.decode()
        if text and _odd(text) * 20 <= len(text):
            return text
    except UnicodeDecodeError:
        pass
    runs = [m[0].decode() for m in _PRINTABLE.finditer(data)]
    for begin, pattern in enumerate(_PRINTABLE_WIDE):
        runs += [m[0][begin::2].decode() for m in pattern.finditer(data)]
    return "\n".join(runs) or None


@dataclass
class _Scan:
    """What is found in a text, and what is left to be unpacked in windows."""

    spans: dict[tuple[str, int, int], str]
    complete: bool = True
    left: int = field(default_factory=lambda: MAX_STREAMED)
    #: What windows of long contents held, by the digest of the packed bytes.
    known: dict[bytes, dict[str, str]] = field(default_factory=dict)

    def spend(self, size: int) -> None:
        self.left -= size
        if self.left < 0:
            raise OverflowError


def _steps(make, source: Iterator[bytes], scan: _Scan) -> Iterator[bytes]:
    """Packed pieces unpacked piece by piece, to the end of the last member or to where
    the stream breaks off."""
    unpacker, piece = make(), b""
    while True:
        try:
            out = unpacker.decompress(piece, WINDOW)
        except _ERRORS:
            return
        piece = getattr(unpacker, "unconsumed_tail", b"")
        if out:
            scan.spend(len(out))
            yield out
        if unpacker.eof:
            piece = unpacker.unused_data
            while len(piece) < 8 and (more := next(source, b"")):
                piece += more
            if not piece.startswith(_MAGICS):
                return
            unpacker = make()
        elif not out and not piece:
            piece = next(source, b"")
            if not piece:
                return


def _contents(data: bytes, scan: _Scan) -> tuple[Iterator[bytes], int]:
    """What is inside all packings of ``data``, in pieces, and how many there are."""
    source = (data[i : i + OVERLAP] for i in range(0, len(data), OVERLAP))
    for depth in range(MAX_NESTED):
        head = b""
        while len(head) < 64 and (piece := next(source, b"")):
            head += piece
        source = itertools.chain([head], source)
        for magic, make in _PACKINGS:
            if head.startswith(magic):
                try:
                    make().decompress(head[:OVERLAP], 64)
                except _ERRORS:
                    continue
                source = _steps(make, source, scan)
                break
        else:
            return source, depth
    raise OverflowError


def _boundary(text: str, end: int) -> int:
    """The last place up to ``end`` where no encoded run goes on, or 0."""
    while end > 0:
        start = max(0, end - 4096)
        places = [m.end() for m in _OUTSIDE.finditer(text, start, end)]
        if places:
            return places[-1]
        end = start
    return 0


def _windows(pieces: Iterator[str], scan: _Scan) -> Iterator[str]:
    """Text in windows that overlap and cut no encoded run of up to ``MAX_UNPACKED``."""
    held, looked = "", 0
    for piece in pieces:
        held += piece
        if len(held) < looked + WINDOW:
            continue
        cut = _boundary(held, len(held))
        if cut <= OVERLAP:
            looked = len(held)
            if looked <= MAX_UNPACKED:
                continue
            scan.complete, cut = False, looked
        yield held[:cut]
        held = held[_boundary(held, cut - OVERLAP) or cut - OVERLAP :]
        looked = len(held)
    yield held


def _long_contents(data: bytes, via: str, scan: _Scan) -> dict[str, str]:
    """Kinds of spans in packed data whose content is too long to be held, and how they
    were decoded."""
    key = hashlib.sha256(data).digest()
    if key in scan.known:
        return scan.known[key]
    found = _Scan({}, left=scan.left, known=scan.known)

    def texts(source: Iterator[bytes]) -> Iterator[str]:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        try:
            for piece in source:
                yield decoder.decode(piece)
        except OverflowError:
            found.complete = False

    try:
        source, depth = _contents(data, found)
        via += ">packed" * depth
        last = None
        for window in _windows(texts(source), found):
            if window != last:
                _walk(Layer(window, (0, 0), via=via), found)
            last = window
    except OverflowError:
        found.complete = False
    scan.left = found.left
    scan.complete &= found.complete
    scan.known[key] = {k: v for (k, _, _), v in found.spans.items()}
    return scan.known[key]


def _base64_layers(layer: Layer, scan: _Scan) -> Iterator[Layer]:
    """What base64 runs hold, wherever in a run they begin: four characters are three
    bytes, so four beginnings reach what stands behind a path, a name or a word."""
    via = f"{layer.via}>base64".lstrip(">")
    for m in itertools.chain(_BASE64.finditer(layer.text), _wrapped(layer.text)):
        start, end = m if isinstance(m, tuple) else m.span()
        run = "".join(layer.text[start:end].split()).rstrip("=")
        run = run.replace("-", "+").replace("_", "/")
        outer = layer.origin(start, end)
        for begin in range(4):
            body = run[begin:]
            body = body[: len(body) - (len(body) % 4 == 1)]
            if len(body) < 12:
                continue
            data = base64.b64decode(body + "=" * (-len(body) % 4))
            # Behind something else a text goes on to the end, without control bytes.
            text = _CONTROL.split(data)[-1] if begin else data
            if len(text) >= _SHORTEST or not begin:
                yield from _opened(text, outer, via, scan)
            for packing in _MAGIC.finditer(data, 1 if not begin else 0):
                if _starts_packed(data[packing.start() : packing.start() + 512]):
                    yield from _opened(data[packing.start() :], outer, via, scan)


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Where lines stand that may be one base64 text.

    Its lines are equally long but for the last one.  Since that may also be the begin of
    other text, they are given with and without it, and so are all lines of a run.
    """
    if "\n" not in text:
        return
    given = set()
    for pattern in _WRAPPED:
        for m in pattern.finditer(text):
            lines = [x.span() for x in re.finditer(r"\S+", m[0])]
            sizes = [len(m[0][a:b].rstrip("=")) for a, b in lines]
            parts = {(0, len(lines))}
            i = 0
            while i < len(lines):
                j = i + 1
                while j < len(lines) and sizes[j] == sizes[i]:
                    j += 1
                parts.add((i, j))
                if j < len(lines) and sizes[j] < sizes[i]:
                    parts.add((i, j + 1))
                i = j
            for i, j in sorted(parts):
                place = m.start() + lines[i][0], m.start() + lines[j - 1][1]
                if j - i > 1 and place not in given:
                    given.add(place)
                    yield place


def _percent_layers(layer: Layer, scan: _Scan) -> Iterator[Layer]:
    """What is packed in bytes written with percent signs."""
    via = f"{layer.via}>percent".lstrip(">")
    for run in _BYTES.finditer(layer.text):
        if "%" not in run[0]:
            continue
        raw = urllib.parse.unquote_to_bytes(run[0].replace("+", " "))
        begins = [m.start() for m in _MAGIC.finditer(raw)]
        if not begins:
            continue
        places = [m.start() for m in re.finditer("%[0-9A-Fa-f]{2}|.", run[0])]
        for at in begins:
            if _starts_packed(raw[at : at + 512]):
                outer = layer.origin(run.start() + places[at], run.end())
                yield from _opened(raw[at:], outer, via, scan)


def _starts_packed(head: bytes) -> bool:
    for magic, make in _PACKINGS:
        if head.startswith(magic):
            try:
                make().decompress(head, 64)
                return True
            except _ERRORS:
                continue
    return False


def _opened(data: bytes, outer: tuple[int, int], via: str, scan: _Scan) -> Iterator[Layer]:
    """The text in ``data`` and in all packings around it, as a layer of ``outer``."""
    seen = set()
    while (key := hashlib.sha256(data).digest()) not in seen:
        seen.add(key)
        try:
            opened = _unpacked(data)
        except OverflowError:
            for kind, path in _long_contents(data, via, scan).items():
                scan.spans.setdefault((kind, *outer), path)
            return
        if opened is None:
            break
        data, via = opened, f"{via}>packed"
    text = _readable(data)
    if text is not None:
        yield Layer(text, outer, via=via)


def scan_text(text: str) -> tuple[list[tuple[str, int, int, str]], bool]:
    """Spans as (kind, start, end, via) by start and kind, and whether all was unwrapped.

    ``via`` is empty for base spans of the text itself, else the path of decodings.
    """
    scan = _Scan({(k, a, b): "" for k, a, b in base_spans(text)})
    _walk(Layer(text), scan)
    order = sorted((a, KINDS.index(k), b, k, via) for (k, a, b), via in scan.spans.items())
    return [(k, a, b, via) for a, _, b, k, via in order], scan.complete


def _walk(first: Layer, scan: _Scan) -> None:
    """Add the spans of a layer and of all that is encoded in it."""
    work, seen = [first], {first.key()}
    while work:
        layer = work.pop()
        if layer.via:
            for kind, a, b in base_spans(layer.text):
                scan.spans.setdefault((kind, *layer.origin(a, b)), layer.via)
        new: list[Layer | None] = []
        if "%" in layer.text:
            new.append(_rewritten(layer, _PERCENT, _percent, "percent"))
            new += _percent_layers(layer, scan)
        if "\\" in layer.text or "&#" in layer.text:
            new.append(_rewritten(layer, _ESCAPE, _escape, "unicode"))
        new += _base64_layers(layer, scan)
        for found in new:
            if found is not None and (key := found.key()) not in seen:
                seen.add(key)
                work.append(found)


def _scan_task(replace: str | None):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("via", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                found = [scan_text(x or "") for x in texts]
                if replace is not None:
                    texts = [x and _redacted(x, s, replace)
                             for x, (s, _) in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()),
                     pa.array([[dict(zip(("kind", "start", "end", "via"), s, strict=True))
                                for s in spans] for spans, _ in found], kind),
                     pa.array([done for _, done in found], pa.bool_())],
                    ["_row", "_text", "spans", "complete"],
                )

    return run


def _redacted(text: str, spans: list[tuple[str, int, int, str]], replace: str) -> str:
    out, at = [], 0
    for _, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], replace]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text_col: str = "text", replace: str | None = None) -> DataFrame:
    """For each row of ``docs``: it as ``row``, ``spans`` and ``complete``.

    ``spans`` (kind, start, end in code points, via) are ordered by start and kind; with
    ``replace`` they are replaced in the text.  Compressed layers that are too long
    to be held are scanned in windows; ``complete`` is false if one text has more of them
    than ``MAX_STREAMED`` bytes or more than ``MAX_NESTED`` packings around one, or in one
    a single encoded run of more than ``MAX_UNPACKED``.  A null text has no spans and stays null;
    repeated rows are treated alike; other columns are handed on, whatever their names.
    """
    rows = packed(docs, text_col)
    found = rows.mapInArrow(
        _scan_task(replace),
        wider(rows, "spans array<struct<kind:string,start:int,end:int,via:string>>, "
                    "complete boolean"),
    )
    return found.select(
        F.struct(*unpacked(docs.columns, text_col)).alias("row"), "spans", "complete"
    )
