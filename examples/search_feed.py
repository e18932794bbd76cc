"""A definition-style search over captured pages, written with the library.

    python examples/search_feed.py /root/testdata/sf0.01 "the"

Rows come out of the stored pages; fields are computed in declared order with filter
chains; categories are mapped through a broadcast dimension; keywords filter the records;
the newest 20 are returned.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from feedloom.functions.chain import apply_chain  # noqa: E402
from feedloom.operators.catalog import map_category_multi  # noqa: E402
from feedloom.operators.fields import canonical_project, field_chain, select_attribute, select_field  # noqa: E402
from feedloom.operators.query import limit_top, search_q, sort_requested  # noqa: E402
from feedloom.session import build_session  # noqa: E402
from feedloom.sources.extract import html_rows, scan_payloads  # noqa: E402


def main(sf_dir: str, keywords: str) -> None:
    spark = build_session("local[*]", shuffle_partitions=8)
    pages = scan_payloads(spark, f"{sf_dir}/pages.parquet", "parquet",
                          "page_id BIGINT, url STRING, html STRING")
    rows = html_rows(pages.withColumn("source", F.lit("pages")), "html",
                     r'<li><a href="[^"]*">[^<]*</a></li>', keep=["source", "page_id", "url"])
    fields = field_chain(rows, {
        "title": lambda f: select_field(f["element"]),
        "_href": lambda f: select_attribute(f["element"], "href"),
        "details": lambda f: apply_chain(f["_href"], [("prepend", "https://pages.example")]),
        "site_id": lambda f: apply_chain(f["url"], [("split", "?", 0), ("split", "/", 3)]),
        "seeders": lambda f: F.col("pos"),
    })
    cmap = spark.createDataFrame([("pages", "en", 7020), ("pages", "fr", 7060), ("pages", "de", 7060),
                                  ("pages", "es", 7060)], "source string, site_id string, cat_code bigint")
    recs = map_category_multi(fields, cmap).withColumn("category", F.col("categories").cast("array<int>"))
    recs = search_q(recs, keywords)
    top = limit_top(sort_requested(recs, [("page_id", "desc"), ("pos", "asc")]), 20)
    canonical_project(top.drop("element", "url", "categories", "page_id", "site_id"), strict=False).select(
        "source", "pos", "title", "details", "category", "seeders").show(truncate=60)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2] if len(sys.argv) > 2 else "the")
