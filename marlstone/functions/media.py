"""Kinds of image bytes: by content type, by name, by signature; and bytes in data: urls."""

from __future__ import annotations

import base64
import re
from urllib.parse import unquote_to_bytes, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_BYTES = 8 * 1024 * 1024
#: Extensions in the order of sniffing, and their content types.
TYPES = {
    "svg": ("image/svg+xml",),
    "png": ("image/png",),
    "jpg": ("image/jpeg", "image/jpg"),
    "gif": ("image/gif",),
    "webp": ("image/webp",),
    "avif": ("image/avif",),
    "ico": ("image/x-icon", "image/vnd.microsoft.icon"),
    "bmp": ("image/bmp",),
}
#: Fixed values: (offset, bytes) that all must be there; an svg has its root element in the first 512 bytes.
SIGNATURES = {
    "png": ((0, b"\x89PNG"),),
    "jpg": ((0, b"\xff\xd8\xff"),),
    "gif": ((0, b"GIF8"),),
    "webp": ((0, b"RIFF"), (8, b"WEBP")),
    "avif": ((4, b"ftyp"),),
    "ico": ((0, b"\x00\x00\x01\x00"),),
    "bmp": ((0, b"BM"),),
}


def looks(ext: str, data: bytes) -> bool:
    if ext == "svg":
        return b"<svg" in data[:512].lower()
    return all(data[at : at + len(x)] == x for at, x in SIGNATURES[ext])


def ext_from_type(content_type: str | None) -> str | None:
    kind = (content_type or "").split(";")[0].strip().lower()
    return next((e for e, kinds in TYPES.items() if kind in kinds), None)


def ext_from_url(url: str | None) -> str | None:
    try:
        m = re.search(r"\.([a-z0-9]+)$", urlsplit(url or "").path.lower())
    except ValueError:
        return None
    ext = m and ("jpg" if m[1] == "jpeg" else m[1])
    return ext if ext in TYPES else None


def sniff(data: bytes) -> str | None:
    return next((e for e in TYPES if looks(e, data)), None)


def name_type(url: str | None, content_type: str | None, data: bytes) -> tuple[str | None, str | None]:
    """(extension, error): the declared, named or sniffed type, which the bytes must bear out."""
    ext = ext_from_type(content_type) or ext_from_url(url) or sniff(data)
    if ext is None:
        return None, f"no image type in {content_type or 'an absent content type'}, the url or the bytes"
    if not looks(ext, data):
        head = re.sub(r"[^\x20-\x7e]", ".", data[:24].decode("latin-1"))
        return None, f'not {ext} by its bytes, which begin "{head}"'
    return ext, None


def decode_data_url(url: str) -> tuple[bytes | None, str | None, str | None]:
    """(bytes, content type, error)."""
    m = re.match(r"data:([^;,]*)(;base64)?,(.*)$", url, re.I | re.S)
    if not m:
        return None, None, "not a readable data URI"
    if re.search(r"%(?![0-9A-Fa-f]{2})", m[3]):
        return None, None, "a malformed percent escape"
    data = unquote_to_bytes(m[3])
    if m[2]:
        packed = re.sub(rb"[^A-Za-z0-9+/]", b"", data.replace(b"-", b"+").replace(b"_", b"/"))
        packed = packed[: len(packed) - (len(packed) % 4 == 1)]
        data = base64.b64decode(packed + b"=" * (-len(packed) % 4))
    return (data, m[1] or None, None) if data else (None, None, "the data URI is empty")


# The same as columns, in the JVM.


def looks_col(ext: str, data: Column) -> Column:
    if ext == "svg":
        return F.contains(F.lower(F.decode(F.substring(data, 1, 512), "ISO-8859-1")), F.lit("<svg"))
    tests = [F.substring(data, at + 1, len(x)) == F.lit(x) for at, x in SIGNATURES[ext]]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def ext_from_type_col(content_type: Column) -> Column:
    kind = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    return F.coalesce(*(F.when(kind.isin(*kinds), F.lit(e)) for e, kinds in TYPES.items()))


def sniff_col(data: Column) -> Column:
    return F.coalesce(*(F.when(looks_col(e, data), F.lit(e)) for e in TYPES))


def ext_from_url_col(url: Column) -> Column:
    m = F.regexp_extract(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)), r"\.([a-z0-9]+)$", 1)
    m = F.when(m == "jpeg", "jpg").otherwise(m)
    return F.when(m.isin(*TYPES), m)
