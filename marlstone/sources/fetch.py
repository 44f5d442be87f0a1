"""Pages, robots rules and images from the network or from a table. The getter is injected, so tests need no network.

A getter takes a url and returns a dict: {"body": bytes, "content_type": str | None, "url": final url}, {"redirect": url}
or {"error": text}.
"""

from __future__ import annotations

import subprocess
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import origin
from marlstone.functions.media import MAX_BYTES, decode_data_url
from marlstone.functions.url import absolute, origin_of

Getter = Callable[[str], dict]
TIMEOUT_S = 20
PAGE_BYTES = 4 * 1024 * 1024
AGENT = "marlstone-harvester"


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


def http_get(url: str, follow: bool = False, timeout: float = TIMEOUT_S, agent: str = AGENT, limit: int = MAX_BYTES) -> dict:
    """One request; a redirect is reported, not followed, unless `follow`."""
    opener = urllib.request.build_opener() if follow else urllib.request.build_opener(_NoRedirect)
    try:
        with opener.open(urllib.request.Request(url, headers={"User-Agent": agent, "Accept": "text/html,*/*"}), timeout=timeout) as got:
            return {"body": got.read(limit + 1), "content_type": got.headers.get("content-type"), "url": got.url}
    except urllib.error.HTTPError as e:
        if 300 <= e.code < 400:
            to = absolute(e.headers.get("location"), url)
            return {"redirect": to} if to else {"error": f"HTTP {e.code} without a usable location"}
        return {"error": f"HTTP {e.code}"}
    except (OSError, ValueError) as e:
        return {"error": f"request failed: {e}"}


def command_get(command: str, timeout: float = TIMEOUT_S) -> Getter:
    """A getter that runs an external command with the url as its argument; its output are the bytes."""

    def get(url: str) -> dict:
        try:
            done = subprocess.run([*command.split(), url], capture_output=True, timeout=timeout, check=True)
        except (OSError, subprocess.SubprocessError) as e:
            return {"error": f"the command failed: {e}"}
        return {"body": done.stdout[: MAX_BYTES + 1024], "content_type": None, "url": url}

    return get


def as_page(got: dict, limit: int = PAGE_BYTES) -> dict:
    """A getter's answer as a page: {"html", "url"}, {"redirect"} or {"error"}."""
    if "redirect" in got or "error" in got:
        return got
    kind = (got.get("content_type") or "").lower()
    if kind and "html" not in kind and "xml" not in kind:
        return {"error": f"not HTML but {kind.split(';')[0]}"}
    if len(got["body"]) > limit:
        return {"error": f"{len(got['body'])} bytes, more than {limit}"}
    return {"html": got["body"].decode("utf-8", "replace"), "url": got.get("url")}


def follow_redirects(start: str, allowed: Callable[[str], bool | str], get: Getter, most: int = 5) -> dict:
    """What stands at the end of a chain of redirects, or why it can't be had, with the chain.

    A hop is one answer for a place: a reason not to go there, or what `get` says; it ends the chain unless it names a
    further place.
    """

    def hop(place: str, before: list[str]) -> dict:
        if place in before:
            return {"error": "redirect loop", "chain": before}
        chain = [*before, place]
        if len(before) > most:
            return {"error": f"more than {most} redirects", "chain": chain}
        leave = allowed(place)
        if leave is not True:
            return {"error": leave or "disallowed by robots.txt", "chain": chain}
        answer = get(place)
        return hop(answer["redirect"], chain) if answer.get("redirect") else {**answer, "chain": chain}

    return hop(start, [])


def followed(get: Getter, most: int = 5) -> Getter:
    """A getter that goes on to where it is sent, up to `most` times."""
    return lambda url: follow_redirects(url, lambda _: True, get, most)


def image_bytes(url: str, get: Getter, most: int = 5) -> tuple[bytes | None, str | None, str | None]:
    """(bytes, content type, error) of an image's url; redirects are followed."""
    if url.lower().startswith("data:"):
        return decode_data_url(url)
    got = followed(get, most)(url)
    if "error" in got:
        return None, None, got["error"]
    return got["body"], got.get("content_type"), None


def politely(get: Getter, delay_s: float, at_once: bool = True) -> Getter:
    """Waits so that requests to one origin are `delay_s` apart; unless `at_once`, the first ones keep that distance, too."""
    last: dict[str, float] = {}
    begun = float("-inf") if at_once else time.monotonic()

    def polite(url: str) -> dict:
        there = origin_of(url) or url
        wait = last.get(there, begun) + delay_s - time.monotonic()
        if wait > 0:
            time.sleep(wait)
        last[there] = time.monotonic()
        return get(url)

    return polite


def dealt(rows: DataFrame, host: Column, url: Column, delay_s: float) -> DataFrame:
    """Rows for tasks that ask for them: where requests keep a distance, those of one host together, else by url.

    The number of tasks is given, since urls are small, and Spark would put very many of them into one.
    """
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(n, host if delay_s > 0 else url)


def portions(rows: Iterator[dict], columns: list[str], most: int = 256, size: int = 8 * 1024 * 1024) -> Iterator[pd.DataFrame]:
    """Rows as frames of up to `most` rows, or of about `size` bytes: a frame for each row costs more than the row."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
        if len(part) >= most or held >= size:
            yield pd.DataFrame(part, columns=columns)
            part, held = [], 0
    if part:
        yield pd.DataFrame(part, columns=columns)


def fetch(urls: DataFrame, get: Getter, delay_s: float = 1.0) -> DataFrame:
    """(url) -> (url, html, final_url, redirect, error). Where there is a distance to keep, urls of one origin go to one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        polite = politely(get, delay_s)
        pages = ((url, as_page(polite(url))) for batch in batches for url in batch["url"])
        yield from portions(({"url": u, "html": p.get("html"), "final_url": p.get("url"), "redirect": p.get("redirect"), "error": p.get("error")} for u, p in pages), ["url", "html", "final_url", "redirect", "error"])

    return dealt(urls.select("url"), origin("url"), F.col("url"), delay_s).mapInPandas(run, "url string, html string, final_url string, redirect string, error string")
