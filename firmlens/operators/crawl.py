"""The order in which a crawl would take the pages of sites: a frontier over the link graph, worked off in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.shared import find_package, written


def crawl_order(entries: DataFrame, links: DataFrame, *, pages: DataFrame | None = None, most: int = 20, bypass_score: int = 80, most_bypass: int = 5, least_score: int = 40, most_depth: int = 1) -> DataFrame:
    """(site, url, depth, score, place): the pages that a crawl fetches of each site, in its order.

    entries(site, url, score, position): where a site's crawl begins, at depth 0; the first by position counts of an address
    that comes twice. links(url, link, score, position): of each page the links that stay on its site; the first of a page to
    an address counts. pages(url): addresses that can be fetched; None: all of them.

    The frontier's best page by (score from above, depth, when it was found) is fetched next. A page above most_depth brings its
    links that score least_score at least and that the site hasn't had. After `most` pages (0: no limit) only most_bypass more of
    bypass_score or above are fetched.

    All sites go on together. Until the next page that brings links, the order of a site's frontier can't change, so a round
    takes all pages up to that one; there are at most as many rounds as a site fetches pages that bring links. A round ranks
    the first most + most_bypass pages a site only, which are cut before they are shuffled, so a site with very many links is
    no burden to one task; without a limit a site's frontier is sorted in one task. Each round is written to the shared folder.

    Null sites or addresses take no part; a null score or position counts as 0. Repeated rows change nothing. Empty tables give no
    rows; further columns are not read.
    """
    find_package(entries.sparkSession)
    limit = most + most_bypass if most else None
    can = None if pages is None else pages.select("url").distinct()
    fetchable = lambda df: df if can is None else df.join(can, "url", "left_semi")
    number = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.lit(0).cast(kind)).alias(c)
    links = links.where("link IS NOT NULL").select("url", "link", number("score", "int"), number("position", "long")).where(F.col("score") >= least_score)
    seeds = entries.where("site IS NOT NULL AND url IS NOT NULL").select("site", "url", number("score", "int"), number("position", "long"))
    seeds = seeds.groupBy("site", "url").agg(F.min(F.struct("position", F.negative("score").alias("s"))).alias("e"))
    # what each site has had so far: waiting where it has no place yet
    had = seeds.select("site", "url", F.lit(0).alias("depth"), (-F.col("e.s")).alias("score"), F.lit(0).alias("round"), F.col("e.position").alias("position"), F.lit(None).cast("int").alias("place"))
    had = written(fetchable(had), "frontier")
    for round_no in range(1, 1 << 30):
        order = [F.desc("score"), "depth", "round", "position", "url"]
        ranked = had.where("place IS NULL").drop("place").withColumn("n", F.row_number().over(Window.partitionBy("site").orderBy(*order)))
        if limit is not None:
            ranked = ranked.where(F.col("n") <= limit)
        brings = F.col("depth") < most_depth
        before = F.count_if(brings).over(Window.partitionBy("site").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
        ranked = ranked.withColumn("before", before).where(F.coalesce("before", F.lit(0)) == 0)
        if round_no == 1:
            place = F.col("n")
        else:
            ranked = ranked.join(had.groupBy("site").agg(F.max("place").alias("fetched")), "site")
            place = F.coalesce("fetched", F.lit(0)) + F.col("n")
        ranked = ranked.withColumn("now", place.cast("int"))
        if limit is not None:
            ranked = ranked.where((F.col("now") <= most) | ((F.col("score") >= bypass_score) & (F.col("now") <= limit)))
        now = written(ranked.select("site", "url", "depth", "now", brings.alias("brings")), "fetched")
        placed = had.join(now.select("site", "url", "now"), ["site", "url"], "left").withColumn("place", F.coalesce("place", "now")).drop("now")
        bringing = now.where("brings")
        if not bringing.head(1):
            return placed.where("place IS NOT NULL").select("site", "url", "depth", "score", "place")
        new = bringing.join(links, "url").groupBy("site", "link", (F.col("depth") + 1).alias("depth")).agg(F.min(F.struct("position", F.negative("score").alias("s"))).alias("e"))
        new = new.select("site", F.col("link").alias("url"), "depth", (-F.col("e.s")).alias("score"), F.lit(round_no).alias("round"), "e.position", F.lit(None).cast("int").alias("place"))
        had = written(placed.unionByName(fetchable(new).join(had.select("site", "url"), ["site", "url"], "left_anti")), "frontier")
    raise AssertionError("rounds end when no page brings links")
