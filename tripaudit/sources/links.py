"""Link harvest and incremental intake over a crawled-pages table
(SRC-7..10, JN-2).

The crawl is a table ``(page_id, url, html)``; every step is a DataFrame
transform, so thousands of pages are parsed in parallel and the
"last link wins" rule is an aggregate, not a driver-side dict.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.functions.text import contains_any, hrefs, last_segment


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed HTML files as a crawl table ``(page_id, url, html)``, each file read whole.
    The file path is the page id, so "last link wins" follows file-name order."""
    return (spark.read.option("wholetext", True).text(path)
            .select(F.input_file_name().alias("page_id"), F.input_file_name().alias("url"),
                    F.col("value").alias("html")))


def harvest_links(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every anchor href: ``page_id, pos, href, filename``.

    ``pos`` is the 0-based position of the anchor in its page, ``href`` is
    whitespace-stripped, ``filename`` its last path segment.  ``keep`` names
    page columns to carry along."""
    links = pages.select("page_id", *keep, F.posexplode(hrefs("html")).alias("pos", "href"))
    return links.withColumn("filename", last_segment(F.col("href")))


def _last_wins(links: DataFrame, order: list[str]) -> DataFrame:
    """One url per filename: the link latest in (``order``) wins, like
    repeated assignment into a dict.  ``max_by`` aggregates partially on
    the map side, so a filename that repeats across many pages does not
    concentrate its rows in one task."""
    return (links.groupBy("filename")
            .agg(F.max_by("href", F.struct(*order)).alias("url")))


def filter_links(links: DataFrame, years: Iterable[str | int],
                 fleets: Iterable[str], suffix: str = ".parquet") -> DataFrame:
    """Links whose href ends with ``suffix`` and whose filename contains any
    year token and any fleet token; keyed by filename, last one wins."""
    f = F.col("filename")
    kept = links.filter(F.col("href").endswith(suffix)
                        & contains_any(f, [str(y) for y in years])
                        & contains_any(f, fleets))
    return _last_wins(kept, ["page_id", "pos"])


def narrow_links(link_map: DataFrame, token: str) -> DataFrame:
    """Keep names containing a month token such as ``_2023-12``."""
    return link_map.filter(F.col("filename").contains(token))


def overlay_links(base: DataFrame, update: DataFrame) -> DataFrame:
    """``base`` updated by ``update`` (filename -> url maps): on a shared
    filename the update wins."""
    both = (base.select("filename", F.col("url").alias("href"), F.lit(0).alias("prio"))
            .unionByName(update.select("filename", F.col("url").alias("href"),
                                       F.lit(1).alias("prio"))))
    return _last_wins(both, ["prio"])


def overlaid_links(links: DataFrame, base: tuple, update: tuple, token: str,
                   suffix: str = ".parquet") -> DataFrame:
    """``filter_links`` with ``base`` (years, fleets), overlaid by the names holding ``token``
    among those of ``update``, from one pass over the links: a link that passes the update's
    filter ranks above all that only pass the base's."""
    f = F.col("filename")

    def passes(years, fleets):
        return contains_any(f, [str(y) for y in years]) & contains_any(f, fleets)

    first = passes(*update) & f.contains(token)
    kept = (links.filter(F.col("href").endswith(suffix) & (first | passes(*base)))
            .withColumn("prio", first.cast("int")))
    return _last_wins(kept, ["prio", "page_id", "pos"])


def new_links(links: DataFrame, taken: Column, years: Iterable[str | int], fleets: Iterable[str],
              suffix: str = ".parquet") -> DataFrame:
    """``filter_links`` without the names that any link marked ``taken`` carries, from one
    pass over the links."""
    f = F.col("filename")
    wanted = (F.col("href").endswith(suffix) & contains_any(f, [str(y) for y in years]) & contains_any(f, fleets))
    return (links.groupBy("filename")
            .agg(F.max_by("href", F.when(wanted, F.struct("page_id", "pos"))).alias("url"),
                 F.max(F.coalesce(taken, F.lit(False))).alias("_taken"),
                 F.max(wanted).alias("_wanted"))
            .filter(F.col("_wanted") & ~F.col("_taken")).select("filename", "url"))


def new_intake(candidates: DataFrame, existing: DataFrame, key: str = "filename") -> DataFrame:
    """Candidates not yet taken in: anti-join on ``key`` (the file-exists
    skip of a downloader, as a set operation).  ``existing`` is reduced to
    distinct keys first: the partial aggregate collapses a name repeated
    many times before the shuffle, and the join reuses its partitioning
    (skew handling cannot split the build side of an anti-join)."""
    return candidates.join(existing.select(key).distinct(), key, "left_anti")
