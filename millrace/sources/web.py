"""Sitemaps, link tables and page records; fetching is injected, everything after it is DataFrame work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import drop_boilerplate, drop_furniture, content_type, unique_chars, unique_line_ratio
from millrace.functions.unicode import html_to_text
from millrace.session import cut


def sitemap_urls(sitemaps: DataFrame, xml: str) -> DataFrame:
    """(url): the locations of sitemap documents, each once."""
    body = F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"', "")
    return sitemaps.select(F.explode(F.xpath(body, F.lit("//url/loc/text()"))).alias("url")).select(F.trim("url").alias("url")).distinct()


def clean_url(c: Column) -> Column:
    """Without a fragment."""
    return F.regexp_replace(c, "#.*$", "")


def crawl(links: DataFrame, seeds: DataFrame, depth: int, article: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(url, depth): breadth-first over same-host links(source, target) from seeds(url); seeds are exempt from the article rule."""
    e = cut(links.select(clean_url(F.col("source")).alias("s"), clean_url(F.col("target")).alias("t")).where(F.parse_url("s", F.lit("HOST")) == F.parse_url("t", F.lit("HOST"))).distinct())
    seen = seeds.select(clean_url(F.col("url")).alias("url"), F.lit(0).alias("depth")).distinct()
    front = seen
    for d in range(1, depth + 1):
        new = front.join(e, F.col("url") == F.col("s")).select(F.col("t").alias("url")).distinct().join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(d))
        if article is not None:
            new = new.where(article(F.col("url"), F.col("depth")))
        new = cut(new)
        seen, front = seen.union(new), new
    return seen


def plan_seeds(seeds: DataFrame) -> DataFrame:
    """(url, plan): how a seed in mode auto is resolved: exact where it has a path, else sitemap then crawl; other modes stay."""
    path = F.coalesce(F.parse_url("url", F.lit("PATH")), F.lit(""))
    return seeds.select("url", F.when(F.col("mode") != "auto", F.col("mode")).when(F.length(F.regexp_replace(path, "/+$", "")) > 0, "exact").otherwise("sitemap,crawl").alias("plan"))


def fetch(urls: DataFrame, get: Callable[[str], tuple[int, str]], allowed: Callable[[str], bool] | None = None) -> DataFrame:
    """(url, status, html, error) by an injected getter; addresses that may not be read, or can't be told, are blocked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u in b["url"]:
                try:
                    if allowed is not None and not allowed(u):
                        rows.append((u, None, None, "blocked"))
                        continue
                    status, html = get(u)
                    rows.append((u, status, html, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((u, None, None, str(e)[:500]))
            yield pd.DataFrame(rows, columns=["url", "status", "html", "error"])

    return urls.select("url").mapInPandas(run, "url string, status int, html string, error string")


def page_gates(text: Column, least_chars: int = 50, least_unique: int = 100, least_density: float = 0.01) -> Column:
    """Whether a page's text is long enough and has enough different characters, absolutely and for its length."""
    return (F.length(text) >= least_chars) & (unique_chars(text) >= least_unique) & (unique_chars(text) >= least_density * F.length(text))


def page_records(pages: DataFrame, least_chars: int = 50, least_unique: int = 100, least_density: float = 0.01) -> DataFrame:
    """Records of pages(url, html) that pass the gates: title, cleaned text, statistics, kind and hash."""
    t = pages.where("html is not null").select("url", html_to_text("html").alias("h")).select("url", "h.title", drop_furniture(F.col("h.text")).alias("text"))
    r = t.withColumn("flat", drop_boilerplate(F.col("text"))).withColumn("unique_chars", unique_chars(F.col("text")))
    r = r.where(page_gates(F.col("text"), least_chars, least_unique, least_density))
    return r.select("url", "title", "text", F.parse_url("url", F.lit("HOST")).alias("source_domain"), F.length("text").alias("content_length_chars"), "unique_chars", unique_line_ratio(F.col("text")).alias("unique_line_ratio"), content_type(F.col("url"), F.col("text")).alias("inferred_type"), F.sha2("text", 256).alias("content_hash"))
