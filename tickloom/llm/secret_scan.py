"""Secrets in plain and in encoded text, by a worklist of decoded layers.

A text is scanned for three kinds of secrets. Then every layer that can be decoded from it joins the worklist: percent
escapes and Unicode escapes are decoded in place, so that a secret may begin outside them; the pieces of ASCII text in what
runs of base64 decode to become layers of their own, and so does all that zlib or gzip data in them unpack to. A run is
decoded at all four offsets, since a name, path or URL before a payload joins its run, and joined with those on the next
lines, besides by itself; a secret that a line break cuts may thus show by its first part too. Every layer is
scanned and decoded in turn until no new one appears; a layer that was seen before, in whatever way it came about, is not
taken up again, so cycles end. Spans found in a layer are mapped back to the characters of the text that they came from.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.text import only, slices

KINDS = ("assign", "access", "hex")
# What counts as a secret.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20}

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_ALPHABET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_BREAK = re.compile(r"[\x20\t]*\r?\n[\x20\t]*")
_NEXT_LINE = re.compile(r"[\x20\t]*\r?\n[\x20\t]*([A-Za-z0-9+/_-]+)")
#: Where zlib or gzip data may begin.
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78(?=[\x01\x5e\x9c\xda])")
#: Secrets, and whatever encodes them, are ASCII without control characters other than these, and the shortest ones have
#: twelve characters; bytes between such pieces hold nothing to find, be they other characters, a byte order mark or noise.
_ASCII = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
#: Unpacked data are read in windows of this size, with so much of the one before, far more than the shortest secret. All of
#: a packed run's secrets are mapped to the whole run, so that one cut by a window shows there all the same.
WINDOW, OVERLAP = 16 << 20, 64 << 10


@dataclass
class Layer:
    """A text and, for each of its characters, where the characters of the original begin and end that it came from."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    way: tuple[str, ...] = field(default=())


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the secrets of one layer, sorted."""
    found = []
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    if "pass" in low or "secret" in low or "token" in low or "key" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _in_place(layer: Layer, name: str, pieces: list[tuple[int, int, list[tuple[str, int, int]]]]) -> Layer:
    """The layer with each (start, end, decoded) replaced; decoded lists characters and their places in the layer."""
    text, starts, ends, at = [], [], [], 0
    for start, end, decoded in pieces:
        text.append(layer.text[at:start]), starts.append(layer.starts[at:start]), ends.append(layer.ends[at:start])
        text.append("".join(c for c, _, _ in decoded))
        starts.append(layer.starts[[a for _, a, _ in decoded]]), ends.append(layer.ends[[b - 1 for _, _, b in decoded]])
        at = end
    text.append(layer.text[at:]), starts.append(layer.starts[at:]), ends.append(layer.ends[at:])
    return Layer("".join(text), np.concatenate(starts), np.concatenate(ends), (*layer.way, name))


def _characters(raw: bytes, width: int, start: int) -> list[tuple[str, int, int]]:
    """The characters of UTF-8 bytes, each of which stood for ``width`` characters; other bytes become characters as they are."""
    out, i = [], 0
    while i < len(raw):
        n = 1 if raw[i] < 0xC0 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            c = raw[i : i + n].decode()
        except UnicodeDecodeError:
            c, n = chr(raw[i]), 1
        out.append((c, start + width * i, start + width * min(i + n, len(raw))))
        i += n
    return out


def _percent(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text and (runs := list(_PERCENT.finditer(layer.text))):
        yield _in_place(layer, "url", [(m.start(), m.end(), _characters(bytes.fromhex(m[0].replace("%", "")), 3, m.start())) for m in runs])


def _unicode(layer: Layer) -> Iterator[Layer]:
    if "\\u" not in layer.text and "\\x" not in layer.text:
        return
    pieces = []
    for m in _ESCAPE.finditer(layer.text):
        if m[1] is not None:
            if (code := int(m[1], 16)) < 0x110000 and not 0xD800 <= code < 0xE000:
                pieces.append((m.start(), m.end(), [(chr(code), m.start(), m.end())]))
            continue
        decoded, at = [], m.start()
        while at < m.end():
            n = 6 if layer.text[at + 1] == "u" else 4
            decoded.append((int(layer.text[at + 2 : at + n], 16), at, at + n))
            at += n
        merged: list[tuple[str, int, int]] = []
        k = 0
        while k < len(decoded):
            code, a, b = decoded[k]
            if 0xD800 <= code < 0xDC00 and k + 1 < len(decoded) and 0xDC00 <= decoded[k + 1][0] < 0xE000:
                code, b, k = 0x10000 + ((code - 0xD800) << 10) + decoded[k + 1][0] - 0xDC00, decoded[k + 1][2], k + 1
            merged.append((chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd", a, b))
            k += 1
        pieces.append((m.start(), m.end(), merged))
    if pieces:
        yield _in_place(layer, "unicode", pieces)


def _looks_packed(raw: bytes | memoryview) -> bool:
    return len(raw) >= 8 and (raw[:2] == b"\x1f\x8b" or raw[0] == 0x78 and int.from_bytes(raw[:2], "big") % 31 == 0)


def _inflated(chunks: Iterator[bytes | memoryview], used: list[int]) -> Iterator[bytes]:
    """What zlib or gzip data hold, all members one after the other, in pieces of ``WINDOW`` bytes at most.

    Data that break off or turn out to be wrong end it. ``used`` gets the size of the complete members.
    """
    unpack, taken = zlib.decompressobj(47), 0
    for chunk in chunks:
        rest, pending = bytes(chunk), False
        while rest or pending:
            try:
                out = unpack.decompress(rest, WINDOW)
            except zlib.error:
                return
            if out:
                yield out
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            taken, rest = taken + len(rest) - len(left), left
            pending = not unpack.eof and len(out) == WINDOW
            if unpack.eof:
                used[0] = taken
                if rest and not _looks_packed(rest):
                    return
                unpack = zlib.decompressobj(47)


def unpacked(raw: bytes | memoryview) -> tuple[list[str], Iterator[bytes], int] | None:
    """The decodings, the data in pieces and the packed size of what zlib or gzip data hold, None if they are neither.

    The outer layer must be complete; packed data within it are unpacked in turn, unless they come back to themselves.
    """
    if not _looks_packed(raw):
        return None
    used = [0]
    for _ in _inflated(iter([raw]), used):
        pass
    if not used[0]:
        return None

    def pieces(depth: int) -> Iterator[bytes]:
        data = iter([raw[: used[0]]])
        for _ in range(depth):
            data = _inflated(data, [0])
        return data

    depth, seen = 1, set()
    while True:
        head = b""
        for piece in pieces(depth):
            head += piece
            if len(head) >= OVERLAP:
                break
        digest = hashlib.sha256(head).digest()
        if digest in seen or not _looks_packed(head) or next(pieces(depth + 1), None) is None:
            return ["zlib"] * depth, pieces(depth), used[0]
        seen.add(digest)
        depth += 1


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    held, new = b"", False
    for piece in pieces:
        held, new = held + piece, True
        if len(held) >= WINDOW:
            yield held
            held, new = held[-OVERLAP:], False
    if new:
        yield held


def _line_before(text: str, at: int) -> tuple[int, int] | None:
    """The base64 characters at the end of the previous line, if only white space separates them from this place."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    if text[end - 1 : end] != "\n":
        return None
    end -= 2 if text[max(0, end - 2) : end] == "\r\n" else 1
    while end and text[end - 1] in " \t":
        end -= 1
    start = end
    while start and text[start - 1] in _ALPHABET:
        start -= 1
    return (start, end) if start < end else None


def _runs(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Runs of base64 characters, as they stand and joined where one goes on on the next line, and the places of their
    characters, with those of the padding after them."""
    group: list[tuple[int, int, int]] = []

    def joined() -> Iterator[tuple[str, np.ndarray]]:
        if before := _line_before(text, group[0][0]):
            group.insert(0, (*before, before[1]))
        _, end, last = group[-1]
        if end == last and (m := _NEXT_LINE.match(text, end)):
            group.append((m.start(1), m.end(1), m.end()))
        if len(group) > 1:
            yield "".join(text[a:b] for a, b, _ in group), np.concatenate([np.arange(a, c) for a, _, c in group])

    for m in _BASE64.finditer(text):
        start, end = m.start(), m.start() + len(m[0].rstrip("="))
        yield text[start:end], np.arange(start, m.end())
        if group and not _BREAK.fullmatch(text, group[-1][1], start):
            yield from joined()
            group = []
        group.append((start, end, m.end()))
    if group:
        yield from joined()


def _base64(layer: Layer) -> Iterator[Layer]:
    """Layers of base64 at each of the four places where a payload may begin amid other characters of the alphabet."""
    for run, at in _runs(layer.text):
        run = run.replace("-", "+").replace("_", "/")
        for skip in range(4):
            part = run[skip : len(run) - ((len(run) - skip) % 4 == 1)]
            yield from _decoded(layer, base64.b64decode(part + "=" * (-len(part) % 4)), at[skip:], len(part))


def _decoded(layer: Layer, raw: bytes, at: np.ndarray, n: int) -> Iterator[Layer]:
    """Layers of what ``n`` base64 characters at these places decode to: what is packed in it, and its pieces of text."""
    for m in _PACKED.finditer(raw):
        if (found := unpacked(memoryview(raw)[m.start() :])) is None:
            continue
        way, data, size = found
        end = m.start() + size - 1
        end = end // 3 * 4 + end % 3 + 2  # a byte ends in the second, third or fourth character
        own = at[m.start() // 3 * 4 : end if end < n else len(at)]
        first, last = layer.starts[own].min(), layer.ends[own].max()
        for window in _windows(data):
            text = window.decode("utf-8", "replace")
            yield Layer(text, np.broadcast_to(first, len(text)), np.broadcast_to(last, len(text)), (*layer.way, "base64", *way))
    for piece in _ASCII.finditer(raw):
        a = np.arange(piece.start(), piece.end()) // 3 * 4
        yield Layer(piece[0].decode(), layer.starts[at[a]], layer.ends[at[np.minimum(a + 3, n - 1)]], (*layer.way, "base64"))


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """Base spans, and spans that only a layer shows (start, kind number, end, way)."""
    base = find(text)
    if not ("%" in text or "\\" in text or _BASE64.search(text)):
        return base, []
    here = np.arange(len(text), dtype=np.int64)
    added: dict[tuple[int, int, int], str] = {}
    seen = {hashlib.sha256(text.encode("utf-8", "replace")).digest()}
    have = set(base)
    # What base64 holds is unpacked when its turn comes, and before the layer's other decodings, so that few layers are alive.
    work: list[Iterator[Layer]] = [iter([Layer(text, here, here + 1)])]
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        if layer.way:
            # The same layer at another place of the text shows other spans.
            place = f"{layer.starts.min() if len(layer.starts) else 0}:".encode()
            digest = hashlib.sha256(place + layer.text.encode("utf-8", "replace")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            for start, kind, end in find(layer.text):
                span = (int(layer.starts[start:end].min()), kind, int(layer.ends[start:end].max()))
                if span not in have and span not in added:
                    added[span] = ">".join(layer.way)
        work.append(iter([*_percent(layer), *_unicode(layer)]))
        work.append(_base64(layer))
    return base, sorted((*span, way) for span, way in added.items())


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_spans, spans, ways, n_added``.

    Spans are kind:start:end in code points, end exclusive, by start and then by kind, comma-joined; ``spans`` holds the
    base ones and those that layers add, ``ways`` the decodings that led to each added one. A null or empty text has no
    spans; texts of any length, and all that they unpack to, are read whole; identifiers may be null or repeated; an empty
    table gives an empty one; other columns are not looked at.
    """
    rows = only(docs, id_col, text_col)
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
        "base_spans string, spans string, ways string, n_added long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                base, added = scan(text)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                every = sorted([*base, *(x[:3] for x in added)])
                out.append((*counts, _joined(base), _joined(every), ",".join(x[3] for x in added), len(added)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in zip(*out))], names=names)

    return rows.mapInArrow(run, schema)
