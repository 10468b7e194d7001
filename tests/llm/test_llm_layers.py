"""Secrets in layers that are not clean text, and in base64 amid other characters."""

from __future__ import annotations

import base64
import gzip
import zlib

import pytest

from tickloom.llm import secret_scan

SECRET = "password=hunter2secret"


def added(text):
    return [(start, secret_scan.KINDS[kind], end, way) for start, kind, end, way in secret_scan.scan(text)[1]]


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("before, after", [(b"\xef\xbb\xbf", b""), (b"a\xc2\xa0", b""), (b"", b"\xff"), (b"\x00\x1b\x0c", b"\xe2\x80\x8b"), (b"\xc3\xa9 ", b" \xc3\xa9")])
@pytest.mark.parametrize("pack, way", [(bytes, "base64"), (zlib.compress, "base64>zlib"), (gzip.compress, "base64>zlib")])
def test_layers_that_are_not_clean_text(before, after, pack, way):
    hidden = b64(pack(before + SECRET.encode() + after))
    found = added(f"x {hidden} y")
    assert len(found) == 1 and found[0][1] == "assign" and found[0][3] == way
    first, last = (0, len(hidden)) if pack is not bytes else (len(before) // 3 * 4, -(-(len(before) + len(SECRET)) // 3) * 4)
    assert (found[0][0], found[0][2]) == (2 + first, 2 + min(last, len(hidden.rstrip("=")) if pack is bytes else last))


def test_layer_nested_in_one_that_is_not_clean_text():
    assert {way for *_, way in added(f"x {b64(bytes([0xFF, 0]) + b' ' + b64(SECRET.encode()).encode())} y")} == {"base64>base64"}


@pytest.mark.parametrize("prefix", ["https://x.io/cb/", "id-x_", "cfg_", "a/", "_", "abcde-", "/tmp/k"])
@pytest.mark.parametrize("suffix", ["", "/", "_x", "-abc"])
@pytest.mark.parametrize("pack, way", [(bytes, "base64"), (zlib.compress, "base64>zlib"), (gzip.compress, "base64>zlib")])
def test_payload_joined_to_other_characters(prefix, suffix, pack, way):
    hidden = b64(pack(b"x " + SECRET.encode() + b" y")).rstrip("=")
    found = added(f"see {prefix}{hidden}{suffix} .")
    assert [x[1:4:2] for x in found] == [("assign", way)]
    assert 4 + len(prefix) <= found[0][0] < found[0][2] <= 4 + len(prefix) + len(hidden)


@pytest.mark.parametrize("width", [19, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("pack, way", [(bytes, "base64"), (zlib.compress, "base64>zlib"), (gzip.compress, "base64>zlib")])
def test_wrapped_payload(width, end, pack, way):
    noise = base64.b64encode(bytes(i * i % 251 for i in range(150))).decode()
    for before in range(40, 58):
        hidden = b64(pack(f"{noise[:before]} {SECRET} {noise}".encode()))
        lines = [hidden[i : i + width] for i in range(0, len(hidden), width)]
        text = f"-----BEGIN X-----{end}{end.join(lines)}{end}-----END X-----"
        found = [x for x in added(text) if x[3] == way]
        whole = max(found, key=lambda x: x[2] - x[0])
        decoded = "".join(text[whole[0] : whole[2]].split())
        if pack is bytes:
            assert SECRET.encode() in base64.b64decode(decoded + "=" * (-len(decoded) % 4))
        else:
            assert decoded.rstrip("=") == hidden.rstrip("=")


def test_independent_payloads_on_consecutive_lines():
    one, two = b64(b"password=hunter1secrets."), b64(b"password=hunter2secrets.")
    found = added(f"{one}\n{two}")
    assert {(0, "assign", len(one), "base64"), (len(one) + 1, "assign", len(one) + 1 + len(two), "base64")} <= set(found)
