"""Selection of crawled files by the hosts of a crawl log."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def host_of_line(line: Column) -> Column:
    """Host of the URL that is the third word of a log line, NULL where there is none."""
    url = F.get(F.split(F.trim(line), r"\s+"), F.lit(2))
    return F.nullif(F.get(F.split(url, "/"), F.lit(2)), F.lit(""))


def crawl_hosts(log: DataFrame) -> DataFrame:
    """Distinct hosts of the log lines (column ``value``) that start with ``--``."""
    hosts = log.filter(F.col("value").startswith("--")).select(host_of_line(F.col("value")).alias("host"))
    return hosts.filter(F.col("host").isNotNull()).distinct()


def top_folder(path: Column, root: str) -> Column:
    """First folder of a path below ``root``, NULL for files outside of it or directly in it. Both are compared from
    their start; a path may have a scheme that the root lacks."""
    bare = lambda p: re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)", "", p)
    base = bare(root).rstrip("/") + "/"
    plain = F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/", "/")
    below = F.split(F.substring(plain, F.lit(len(base) + 1), F.length(plain)), "/")
    return F.when(plain.startswith(base) & (F.array_size(below) > 1), F.get(below, F.lit(0)))


def select_hosts(rows: DataFrame, hosts: DataFrame, host: Column) -> DataFrame:
    """Rows whose host was crawled. The hosts are an aggregate, so their size is known
    before this join starts and Spark broadcasts them only below its own limit."""
    return rows.withColumn("host", host).join(hosts, "host", "left_semi")
