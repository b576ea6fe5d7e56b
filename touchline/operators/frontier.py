"""When to fetch which page: a crawl's frontier, all hosts at once.

A host is asked for one page at a time, GAP seconds apart at least. A page that failed waits longer after each try. Among
a host's pages the one that is ready first goes first, of equals the one with the higher priority. The time of a page is the
later of its own readiness and the time before it plus the gap; that recurrence has a closed form, place x gap + the greatest
of (readiness - place x gap) so far, so that one running maximum by host gives all times, without a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds between two pages of a host, seconds before the second try, which double with each further one up to MOST_WAIT.
GAP, FIRST_WAIT, MOST_WAIT = 1.0, 30.0, 86_400.0


def readiness(pages: DataFrame, now: float, first_wait: float = FIRST_WAIT, most_wait: float = MOST_WAIT) -> DataFrame:
    """pages(tries, failed_at) with ready, in seconds: now for a page that was never tried, else the wait after its last failure, but
    not before now."""
    tries = F.coalesce("tries", F.lit(0))
    wait = F.least(F.lit(first_wait) * F.pow(F.lit(2.0), F.least(tries - 1, F.lit(60))), F.lit(most_wait))
    return pages.withColumn("ready", F.when(tries < 1, F.lit(now)).otherwise(F.greatest(F.coalesce("failed_at", F.lit(now)) + wait, F.lit(now))))


def schedule(pages: DataFrame, landed: DataFrame, now: float, gap: float = GAP, horizon: float | None = None) -> DataFrame:
    """(host, url, place, due): when to fetch each url of pages(host, url, priority, tries, failed_at) that is not in landed(url).

    place counts from 0 by host. With a horizon, what would be fetched later than so many seconds from now is left for the next
    time. A url that repeats is fetched once, by its highest priority and most tries; a null url is no page, and pages without
    a host are one of their own."""
    each = pages.where("url is not null").groupBy("host", "url").agg(
        F.max("priority").alias("priority"), F.max("tries").alias("tries"), F.max("failed_at").alias("failed_at")
    )
    left = readiness(each.join(landed.select("url").distinct(), "url", "left_anti"), now)
    order = Window.partitionBy("host").orderBy("ready", F.desc_nulls_last("priority"), "url")
    placed = left.withColumn("place", F.row_number().over(order) - 1)
    latest = F.max(F.col("ready") - F.col("place") * gap).over(order.rowsBetween(Window.unboundedPreceding, 0))
    timed = placed.withColumn("due", F.col("place") * gap + latest)
    timed = timed if horizon is None else timed.where(F.col("due") <= now + horizon)
    return timed.select("host", "url", "place", "due")
