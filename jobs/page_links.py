"""Links of arriving pages: which site names which sites and profiles, each once, as page files come in.

Official sites name the social pages of their owners, so a crawl is read for its anchors and JSON-LD sameAs texts. This job follows a folder
of Parquet page files (page_id, url, html) with Spark's file stream: the checkpoint holds which files have been taken, so a run
works on new files only, and ends when there are none left. Each micro-batch is cut into links, which are resolved against their page, normalized,
classified by platform and marked as probable profiles. A link of a site that an earlier batch has written is dropped by an
anti-join; the rest is written as partition batch=N of the output, below it one for each platform.

A batch that is run again after a stop overwrites its own partition alone (dynamic partition overwrite) and reads only earlier ones,
so the output is the same as without the stop. Output and checkpoint belong together: start both anew or neither.

Results: site (host of the page without www), url, platform, profile, first_page (least page_id of the batch that names the link
first) and batch. Pages with a null or empty url or html have no links; nor has a page with a url of no host; repeated pages add nothing.

    python -m jobs.page_links --config jobs/page_links.json --pages DIR --output DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, session, settings
from tessera.functions import documents, urls

SCHEMA = "page_id long, url string, html string"
OUTPUT = "site string, url string, profile boolean, first_page long, batch long, platform string"
#: files_per_batch bounds a micro-batch, 0 takes all there are; profiles_only keeps probable profiles on known platforms alone.
DEFAULTS = {"files_per_batch": 0, "profiles_only": False}


def has_links(html: Column) -> Column:
    """Only pages with an anchor or a sameAs reach the HTML parser."""
    return html.rlike(r"(?i)<a\s") | F.contains(html, F.lit("sameAs"))


def links_of(pages: DataFrame) -> DataFrame:
    """site, url, platform, profile and first_page of the links of pages, each link of a site once."""
    fit = pages.where(has_links(F.col("html")) & (F.coalesce("url", F.lit("")) != ""))
    site = F.regexp_replace(urls.hostname(urls.normalize_url(F.col("url"))), r"^www\.", "")
    found = fit.select("page_id", site.alias("site"), F.explode(documents.raw_page_links(F.col("html"), F.col("url"))).alias("raw")).where("site <> ''")
    named = found.select("page_id", "site", urls.normalize_url(F.col("raw")).alias("url")).where(F.col("url").isNotNull() & urls.is_http_url(F.col("url")))
    once = named.groupBy("site", "url").agg(F.min("page_id").alias("first_page"))
    return once.select("site", "url", urls.detect_platform(F.col("url")).alias("platform"), urls.is_profile_url(F.col("url")).alias("profile"), "first_page")


def read_links(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(OUTPUT).parquet(output)


def write_batch(pages: DataFrame, number: int, output: str, profiles_only: bool = False) -> None:
    """The new links of one micro-batch as its partition of the output."""
    links = links_of(pages)
    if profiles_only:
        links = links.where((F.col("platform") != "website") & F.col("profile"))
    if number:
        earlier = read_links(pages.sparkSession, output).where(F.col("batch") < number).select("site", "url")
        links = links.join(earlier, ["site", "url"], "left_anti")
    rows = links.withColumn("batch", F.lit(number).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "platform").parquet(output)


def as_pattern(path: str) -> str:
    """The path as a pattern that fits it alone: the file stream takes a folder or a pattern, and a table may be a single file."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, pages: str, output: str, checkpoint: str, files_per_batch: int = 0, profiles_only: bool = False) -> DataFrame:
    """Take all page files that have come since the last run, and return the whole output."""
    stream = spark.readStream.schema(SCHEMA)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def work(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, output, profiles_only)
        LOG.info("batch %s: written to %s/batch=%s", number, output, number)

    query = stream.parquet(as_pattern(pages)).writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    taken = sum(p["numInputRows"] for p in query.recentProgress)
    links = read_links(spark, output)
    LOG.info("%s pages read from %s; %s links in %s", taken, pages, links.count(), output)
    return links


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("jobs.page_links")
    for name in ("config", "pages", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=name != "config")
    asked = parser.parse_args(arguments)
    spark = session("page-links")
    try:
        run(spark, asked.pages, asked.output, asked.checkpoint, **(settings(spark, asked.config, DEFAULTS) if asked.config else DEFAULTS))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
