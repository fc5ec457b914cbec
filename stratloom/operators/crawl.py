"""Listing and article pages → screened, chunked, queued jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.common import let


def listing_items(listing: DataFrame, html: str = "html") -> DataFrame:
    return listing.select(F.explode(t.html_list_items(F.col(html))).alias("i")).select("i.*")


def topical_filter(items: DataFrame, title: str = "title", abstract: str = "abstract") -> DataFrame:
    return items.filter(t.is_relevant(F.col(title), F.col(abstract)))


def min_article_length(df: DataFrame, column: str = "text", n: int = 800) -> DataFrame:
    return df.filter(F.length(column) > n)


def crawl_to_jobs(items: DataFrame, articles: DataFrame, known: DataFrame, base_url: str = "",
                  created: int = 0) -> tuple[DataFrame, DataFrame]:
    """(jobs, pages) of relevant items whose article has text; known job ids are not queued again.

    ``articles``: slug, html; ``known``: job_id. Of several fetches of an article the longest page counts.
    """
    want = topical_filter(items).groupBy("slug").agg(F.min("title").alias("title")).withColumn("job_id", t.stable_job_id("slug"))
    want = want.join(known.select("job_id"), "job_id", "left_anti")
    art = articles.groupBy("slug").agg(F.max(F.struct(F.length("html").alias("n"), "html"))["html"].alias("html")).select(
        "slug", t.html_article(F.col("html")).alias("a"))
    j = min_article_length(want.join(art, "slug").withColumn("text", F.col("a.text"))).withColumn(
        "pages", t.chunk_text(F.col("text"))).filter(F.size("pages") > 0)
    title = F.when(F.col("a.title") != "", F.col("a.title")).otherwise(F.col("title"))
    name = F.concat(F.regexp_replace(title, r'[\\/:*?"<>|]', "_"), F.lit(".pdf"))
    jobs = j.select("job_id", name.alias("filename"), F.lit("queued").alias("status"), F.lit(created).cast("bigint").alias("created"),
                    F.lit("автопоиск").alias("user"), F.concat(F.lit(base_url), "slug").alias("url"), F.col("a.journal").alias("journal"),
                    F.col("a.year").alias("year"), F.array_join("a.authors", "; ").alias("authors"),
                    F.size("pages").alias("n_pages"))
    pages = j.select("job_id", F.explode("pages").alias("p")).select("job_id", "p.idx", "p.text")
    return jobs, pages


def snippets(df: DataFrame, text: str = "text", name: str = "name", n: int = 4, pad: int = 420) -> DataFrame:
    """Windows around the first ``n`` mentions of a name, else two around its six-letter stem.

    Adds an array ``snippets``; the positions come from the pieces between mentions.
    """
    def windows(needle, cap):
        low = F.lower(text)
        parts = F.split(low, F.concat(F.lit("\\Q"), F.lower(needle), F.lit("\\E")))
        return let(parts, lambda ps: F.transform(
            F.slice(F.transform(ps, lambda p, i: i), 2, cap),
            lambda k: let(F.aggregate(F.slice(ps, 1, k), F.lit(0), lambda a, p: a + F.length(p)) + (k - 1) * F.length(needle),
                          lambda at: F.substr(F.col(text), F.greatest(at - pad, F.lit(0)) + 1,
                                              F.least(at, F.lit(pad)) + pad))))

    nm = F.coalesce(F.col(name), F.lit(""))
    core = F.substring(F.regexp_replace(nm, "[^A-Za-zА-Яа-яЁё]", ""), 1, 6)
    none = F.array().cast("array<string>")
    full = F.when(nm != "", windows(nm, n)).otherwise(none)
    stem = F.when(F.length(core) >= 4, windows(core, 2)).otherwise(none)
    return df.withColumn("snippets", let(full, lambda f: F.when((F.size(f) > 0) | (nm == ""), f).otherwise(stem)))
