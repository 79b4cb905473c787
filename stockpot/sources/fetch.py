"""Fetching pages and images, each on its own, so that one that fails stops no other.

The call that fetches is injected; the one given here is the standard library's.
"""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpot.functions.classify import image_extension
from stockpot.sources.documents import _place
from stockpot.sources.pages import crawled_urls, index_page_url, last_index_page, page_links

# Fixed value: seconds after which a fetch is given up.
TIMEOUT = 30

Fetch = Callable[[str], tuple[bytes, str]]


def fetch(url: str) -> tuple[bytes, str]:
    """The body and content type of a URL; an error for any status that is no success."""
    with urllib.request.urlopen(urllib.request.Request(url), timeout=TIMEOUT) as reply:  # noqa: S310
        return reply.read(), reply.headers.get("Content-Type", "")


def _fetched(call: Fetch, key: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, url in zip(frame[key], frame["url"], strict=True):
                try:
                    content, kind = call(url)
                    rows.append((k, url, content, kind, None))
                except Exception as problem:
                    rows.append((k, url, None, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=[key, "url_", "content", "content_type", "error"])

    return run


def fetch_pages(urls: DataFrame, call: Fetch = fetch) -> tuple[DataFrame, DataFrame]:
    """Pages (url, html) and failures (url, error) of a table of URLs, each fetched once."""
    once = urls.where("url is not null").select("url").distinct()
    got = once.withColumn("key", F.col("url")).mapInPandas(_fetched(call, "key"), "key string, url_ string, content binary, content_type string, error string")
    return got.where("error is null").select(F.col("key").alias("url"), F.decode("content", "UTF-8").alias("html")), got.where("error is not null").select(F.col("key").alias("url"), "error")


def store_images(images: DataFrame, folder: str, call: Fetch = fetch) -> DataFrame:
    """id and path, null where an image could not be had: images (id, url) stored as <id>/cover and the ending of their kind."""
    got = images.select("id", "url").mapInPandas(_fetched(call, "id"), "id string, url_ string, content binary, content_type string, error string")
    named = got.select("id", "content", F.concat(F.col("id"), F.lit("/cover"), image_extension(F.col("url_"), F.col("content_type"))).alias("path"))

    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            paths = []
            for content, path in zip(frame["content"], frame["path"], strict=True):
                if content is not None:
                    system, where = _place(f"{folder.rstrip('/')}/{path}")
                    system.create_dir(where.rpartition("/")[0], recursive=True)
                    with system.open_output_stream(where) as stream:
                        stream.write(content)
                paths.append(None if content is None else path)
            yield pd.DataFrame({"id": frame["id"], "path": paths})

    return named.mapInPandas(store, "id string, path string")


def crawl(start: DataFrame, host: str, base: str, call: Fetch = fetch, confirm: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Recipe URLs (url) of an index and all its pages, and the failures (url, error).

    The pages that start from tell how many there are; those left are fetched next. Pages that
    fail are reported and left out. confirm: from ambiguous links (url) to those that are recipes.
    """
    first, failed = fetch_pages(start, call)
    last = last_index_page(page_links(first, host)).first().last_page
    numbers = start.sparkSession.range(1, last + 1).select(index_page_url(base, F.col("id")).alias("url"))
    more, also = fetch_pages(numbers.join(start.select("url"), "url", "left_anti"), call)
    links = page_links(first.unionByName(more), host)
    confirmed = confirm(links.select(F.explode("ambiguous_links").alias("url")).distinct()) if confirm else None
    return crawled_urls(links, confirmed), failed.unionByName(also)
