"""Table functions for SQL: elements of HTML, from a table of pages or from one text in a lateral join."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from marlstone.functions.html import outline

ELEMENT = "pos int, parent int, tag string, attrs map<string,string>, start int, end int"


def _elements(html: str | None) -> Iterator[tuple]:
    o = outline(html or "")
    yield from zip(range(len(o.tag)), o.parent, o.tag, o.attrs, o.start, o.end, strict=True)


class PageElements:
    """page_elements(TABLE(...) PARTITION BY page_id): the elements of each row's `html`, with its page_id."""

    def eval(self, row):
        for element in _elements(row["html"]):
            yield row["page_id"], *element


class HtmlElements:
    """html_elements(html): the elements of one text."""

    def eval(self, html):
        yield from _elements(html)


def register(spark: SparkSession) -> None:
    spark.udtf.register("page_elements", udtf(PageElements, returnType=f"page_id long, {ELEMENT}"))
    spark.udtf.register("html_elements", udtf(HtmlElements, returnType=ELEMENT))
