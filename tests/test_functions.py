"""Urls, markup and image bytes without Spark."""

import pytest

from marlstone.functions import html as H
from marlstone.functions import media as M
from marlstone.functions import url as U


@pytest.mark.parametrize(
    ("given", "base", "want"),
    [
        ("/a", "https://x.org/b/c", "https://x.org/a"),
        ("d?q#f", "https://x.org/b/c", "https://x.org/b/d?q#f"),
        ("//y.net", "https://x.org/b", "https://y.net/"),
        ("HTTP://X.Org:80", None, "http://x.org/"),
        ("https://x.org:8443/a/../b/./c", None, "https://x.org:8443/b/c"),
        ("  /für  ", "http://x.org/", "http://x.org/f%C3%BCr"),
        ("mailto:a@b", "http://x.org/", "mailto:a@b"),
        ("?a=1", "http://x.org/p?b", "http://x.org/p?a=1"),
        ("#top", "http://x.org/p", "http://x.org/p#top"),
        ("   ", "http://x.org/", None),
        (None, "http://x.org/", None),
        ("http://", None, None),
        ("http://a b/", None, None),
        ("/x", "not a url", None),
    ],
)
def test_absolute(given, base, want):
    assert U.absolute(given, base) == want


def test_hosts():
    assert U.domain_of("https://www.Example.com:443/a") == "example.com"
    assert U.host_of("https://www.example.com:8080/a") == "www.example.com:8080"
    assert U.is_web("https://a.b") and not U.is_web("mailto:x") and not U.is_web("")
    assert U.robots_path("http://a.b/c?d#e") == "/c?d"


def test_slices_are_exact():
    doc = '<body><p>one<p>two <b>three</p><a href="/x" DISABLED>é<img src=a alt="">&amp;</a><script>var t="</p>"</script></body>'
    o = H.outline(doc)
    assert o.tag == ["body", "p", "p", "b", "a", "img", "script"]
    for tag, a, z in zip(o.tag, o.start, o.end, strict=True):
        assert doc[a:z].startswith("<" + tag)
    assert doc[o.start[4] : o.end[4]] == '<a href="/x" DISABLED>é<img src=a alt="">&amp;</a>' and o.attrs[4] == {"href": "/x", "disabled": None}
    assert [t[2] for t in o.texts if t[2] != " "] == ["one", "two ", "three", "é", "&", 'var t="</p>"']
    assert H.anchors(doc) == [(4, "/x")]


def test_intervals_lie_inside_each_other_or_apart():
    doc = "<div><ul><li>a<li>b<p>c<table><tr><td>d<td>e<tr><td>f</ul><svg><title>t</title><g id=x><path/></svg></div>text<b>"
    o = H.outline(doc)
    spans = list(zip(o.start, o.end, strict=True))
    assert all(a < z for a, z in spans)
    assert all(b >= z or y <= z for k, (a, z) in enumerate(spans) for b, y in spans[k + 1 :])
    assert [o.tag[k] for k, s in enumerate(o.svg) if s is not None] == ["title", "g", "path"]
    assert [x for x in H.anchors("<svg><title><a href=1></title></svg><title><a href=2></title><!-- <a> --><a>")] == [(2, "1"), (4, None)]


BYTES = {
    "png": b"\x89PNG\r\n", "jpg": b"\xff\xd8\xff\xe0", "gif": b"GIF89a", "webp": b"RIFF....WEBP", "avif": b"\0\0\0 ftypavif", "ico": b"\0\0\1\0", "bmp": b"BM..",
    "svg": b"<?xml version='1.0'?><SVG></SVG>",
}


def test_image_types():
    for ext, data in BYTES.items():
        assert M.sniff(data) == ext and M.name_type(None, M.TYPES[ext][0] + "; x=y", data) == (ext, None)
    assert M.name_type("http://a/b.jpeg?c", None, BYTES["jpg"]) == ("jpg", None)
    assert M.name_type("http://a/b.png", None, b"<html>")[0] is None
    assert M.name_type("http://a/b", None, b"zzz")[1].startswith("no image type")


def test_data_urls():
    assert M.decode_data_url("data:image/png;base64,iVBORw==") == (b"\x89PNG", "image/png", None)
    assert M.decode_data_url("data:,a%20b+c") == (b"a b+c", None, None)
    assert M.decode_data_url("data:image/png;charset=x;base64,AAAA")[2] == "not a readable data URI"
    assert M.decode_data_url("data:image/png,")[2] and M.decode_data_url("data:,%zz")[2]


def test_plain_addresses_are_as_the_full_resolution_has_them():
    import random

    rng = random.Random(3)
    bits = ["/", "a", "B", "..", ".", "?", "#", "x=1", "&", "~", "-", "%20", "é", "http://", "https://", "h.org", "www.x.org", ":80", "@", ";", " ", "//", "c.png", "./", "../", "b/", "\\"]
    bases = ["https://www.x.org", "https://x.org/a/b", "http://x.org/a/", "http://x.org/a//b", "http://x.org/a/../b", "http://x.org/a?b=1", "http://x.org/a?b/c", "http://x.org:8080/a", "http://x.org/a#f", "", "http://x.org/.a/b", "http://x.org/a?"]
    plain = 0
    for _ in range(20_000):
        url, base = "".join(rng.choice(bits) for _ in range(rng.randint(0, 5))), rng.choice(bases)
        got = U._plain(url, base)
        plain += got is not None
        assert got is None or got == U._absolute(url, base), (url, base)
    assert plain > 500
