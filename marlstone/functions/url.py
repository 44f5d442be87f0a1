"""URLs as browsers read them: resolution against a page, and the parts that operators need.

The plain functions are the definition; `*_col` wrap them as Arrow-batched columns where Spark has no equal. Parts
that Spark's own functions give right are plain column expressions.
"""

from __future__ import annotations

import re
from urllib.parse import quote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType

PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}
#: Links to files of these kinds are not pages.
ASSETS = ("pdf", "zip", "jpg", "jpeg", "png", "gif", "svg", "mp4", "mp3", "css", "js", "xml", "json")
_PATH, _QUERY, _FRAGMENT = "!$%&'()*+,-./:;=@_~[]|^", "!$%&()*+,-./:;=?@_~[]{}|^`\\'", "!#$%&'()*+,-./:;=?@_~[]{}|^\\"


#: Addresses that are in normal form as they stand: no user, port, escapes, parameters, nor (see `_plain`) segments that go.
_SITE, _PLACE = r"https?://[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?", r"[A-Za-z0-9_~-][A-Za-z0-9._~/-]*"
_PLAIN = re.compile(rf"(?:{_SITE}/|/?)(?:{_PLACE}(?:\?[A-Za-z0-9=&._~-]+)?)?(?:#[A-Za-z0-9._~-]+)?", re.A)
_PLAIN_BASE = re.compile(rf"({_SITE})(/(?:{_PLACE})?)?(\?[A-Za-z0-9=&._~-]+)?", re.A)


def _plain_base(base: str) -> tuple[str, str, str] | None:
    """Site, path and query of a page; its fragment takes no part."""
    m = _PLAIN_BASE.fullmatch(base.partition("#")[0])
    return m and (m[1], m[2] or "/", m[3] or "")


def _plain(url: str, base: str) -> str | None:
    """`absolute` for most addresses, by two patterns; None where it takes more."""
    return _plain_on(url, _plain_base(base))


def _plain_on(url: str, parts: tuple[str, str, str] | None) -> str | None:
    if not parts or not _PLAIN.fullmatch(url):
        return None
    site, path, query = parts
    if url[:1] == "#":
        out = site + path + query + url
    elif url[:4] == "http" and "://" in url:
        out = url
    else:
        out = site + (url if url[:1] == "/" else path[: path.rindex("/") + 1] + url)
    rest = out[8:].partition("/")[2]
    return None if not url or "//" in rest or "/." in rest or rest[:1] == "." else out


def absolute(url: str | None, base: str | None) -> str | None:
    """`url` resolved against `base` and put in normal form; None where either can't be read."""
    if url is not None and base is not None and (out := _plain(url, base)) is not None:
        return out
    return _absolute(url, base)


def _absolute(url: str | None, base: str | None) -> str | None:
    if url is None or not url.strip():
        return None
    text = re.sub(r"[\t\n\r]", "", url.strip("\x00\x01\x02\x03\x04\x05\x06\x07\x08\t\n\x0b\x0c\r \x1f"))
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", text)
    if scheme and scheme[1].lower() not in PORTS:
        return scheme[1].lower() + text[len(scheme[1]) :]
    head, mark, tail = re.match(r"([^?#]*)([?#]?)(.*)", text, re.S).groups()
    text = head.replace("\\", "/") + mark + tail
    if scheme and not re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", text):
        text = re.sub(r":/*", "://", text, count=1)
    try:
        joined = text if scheme else urljoin(base or "", text)
        parts = urlsplit(joined)
        kind, host, port = parts.scheme.lower(), parts.hostname, parts.port
    except ValueError:
        return None
    if kind not in PORTS or not host or re.search(r"[\s<>\"^`{|}%]", host):
        return None
    try:
        host = host.encode("ascii").decode() if host.isascii() else host.encode("idna").decode()
    except UnicodeError:
        return None
    if ":" in host:
        host = f"[{host}]"
    user = parts.netloc.rpartition("@")[0]
    place = (user + "@" if user else "") + host + (f":{port}" if port is not None and str(port) != PORTS[kind] else "")
    path = _dots(quote(parts.path, safe=_PATH)) or "/"
    query = "?" + quote(parts.query, safe=_QUERY) if "?" in joined.split("#")[0] and (parts.query or joined.split("#")[0].endswith("?")) else ""
    fragment = "#" + quote(parts.fragment, safe=_FRAGMENT) if "#" in joined else ""
    return f"{kind}://{place}{path}{query if query != '?' else '?'}{fragment}"


def _dots(path: str) -> str:
    out: list[str] = []
    pieces = path.split("/")
    for k, p in enumerate(pieces):
        low, last = p.lower().replace("%2e", "."), k == len(pieces) - 1
        if low == "..":
            if len(out) > 1:
                out.pop()
            if last:
                out.append("")
        elif low == ".":
            if last:
                out.append("")
        else:
            out.append(p)
    return "/".join(out)


def host_of(url: str | None) -> str | None:
    """Host with a port that isn't the scheme's own, in lower case."""
    whole = absolute(url, None)
    return urlsplit(whole).netloc.rpartition("@")[2] if whole and "://" in whole else None


def domain_of(url: str | None) -> str | None:
    host = host_of(url)
    return None if host is None else re.sub(r"^www\.", "", host)


def is_web(url: str | None) -> bool:
    return bool(url) and (absolute(url, None) or "").startswith(("http://", "https://"))


def origin_of(url: str) -> str | None:
    host = host_of(url)
    return None if host is None else f"{urlsplit(absolute(url, None)).scheme}://{host}"


def robots_path(url: str) -> str:
    """Path and query, which robots rules are held against."""
    parts = urlsplit(absolute(url, None) or "")
    return parts.path + ("?" + parts.query if parts.query else "")


def strip_hash(url: str) -> str:
    return url.split("#", 1)[0]


def _over(f, returns: DataType):
    @F.pandas_udf(returns)
    def column(s: pd.Series) -> pd.Series:
        known = {x: f(x) for x in s.unique() if isinstance(x, str)}  # many rows share a page
        return pd.Series([known.get(x) for x in s], dtype=object)

    return column


@F.pandas_udf(StringType())
def absolute_col(url: pd.Series, base: pd.Series) -> pd.Series:
    known = {b: _plain_base(b) for b in base.unique() if isinstance(b, str)}  # many rows share a page
    return pd.Series([(_plain_on(u, known[b]) or _absolute(u, b)) if isinstance(u, str) and isinstance(b, str) else None for u, b in zip(url, base, strict=True)], dtype=object)


host_col = _over(host_of, StringType())
domain_col = _over(domain_of, StringType())
is_web_col = _over(is_web, BooleanType())
origin_col = _over(origin_of, StringType())
robots_path_col = _over(robots_path, StringType())


def plain_host(url: Column) -> Column:
    """Host of an http(s) url in lower case without user and default port; in the JVM, for urls that hold no stray characters."""
    place = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(place, "^.*@", "")), ":(80|443)$", "")


def plain_domain(url: Column) -> Column:
    return F.regexp_replace(plain_host(url), r"^www\.", "")


def without_hash(url: Column) -> Column:
    return F.regexp_replace(url, "(?s)#.*$", "")


def plain_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_asset(path: Column) -> Column:
    return path.rlike(rf"(?i)\.({'|'.join(ASSETS)})$")


def query_string(pairs: list[tuple[str, Column]]) -> Column:
    """name=value joined by &, with form encoding."""
    return F.concat_ws("&", *(F.concat(F.lit(f"{name}="), F.url_encode(value)) for name, value in pairs))
