"""The crawl order against a site-by-site simulation."""

import collections
import random

import pytest
from conftest import TINY

from firmlens.operators import crawl
from firmlens.plans import web


def simulated(entries, links, pages=None, most=20, bypass_score=80, most_bypass=5, least_score=40, most_depth=1):
    """One page after the other, site by site."""
    out_links = collections.defaultdict(list)
    for url, link, score, position in sorted(links, key=lambda x: (x[0], x[3])):
        if score >= least_score:
            out_links[url].append((link, score))
    sites = collections.defaultdict(list)
    for site, url, score, position in sorted(entries, key=lambda x: (x[3], -x[2])):
        if pages is None or url in pages:
            sites[site].append((url, score))
    out = []
    for site, first in sites.items():
        queue, seen, n, extra, found = [], set(), 0, 0, 0
        for url, score in first:
            if url not in seen:
                seen.add(url)
                queue.append((-score, 0, found, url))
                found += 1
        while queue:
            queue.sort()
            score, depth, _, url = queue.pop(0)
            if most and n >= most and (-score < bypass_score or extra >= most_bypass):
                continue
            n += 1
            extra += bool(most) and n > most
            out.append((site, url, depth, -score, n))
            if depth < most_depth:
                for link, s in out_links[url]:
                    if link not in seen and (pages is None or link in pages):
                        seen.add(link)
                        queue.append((-s, depth + 1, found, link))
                        found += 1
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"most": 3, "most_bypass": 2, "most_depth": 3}, {"most": 0, "most_depth": 2}, {"most": 4, "most_bypass": 0, "most_depth": 9, "least_score": 60}])
@pytest.mark.parametrize("known", [False, True])
def test_random_graphs(spark, options, known):
    rng = random.Random(len(options) + known)
    entries, links = [], []
    for site in range(6):
        n = rng.randint(1, 14)
        entries += [(f"s{site}", f"s{site}/{rng.randrange(n)}", rng.choice([100, 100, 70, 0]), k) for k in range(rng.randint(1, 3))]
        links += [(f"s{site}/{rng.randrange(n)}", f"s{site}/{rng.randrange(n)}", rng.choice([30, 40, 50, 80, 90, 100]), k) for k in range(rng.randint(0, 40))]
    pages = {u for _, u, *_ in entries if rng.random() < 0.8} | {x[1] for x in links if rng.random() < 0.7} if known else None
    e = spark.createDataFrame([*entries, *entries[:2], (None, "x", 1, 1), ("s0", None, 1, 1)], "site string, url string, score int, position long").withColumn("link", crawl.F.lit(1))
    k = spark.createDataFrame([*links, ("s0/0", None, 100, 0)], "url string, link string, score int, position long").withColumn("site", crawl.F.lit("z"))
    p = spark.createDataFrame([(u,) for u in sorted(pages)], "url string") if known else None
    got = sorted(map(tuple, crawl.crawl_order(e, k, pages=p, **options).collect()))
    assert got == simulated(entries, links, pages, **options)


def test_crawl_of_pages(spark):
    entries, links = (x.collect() for x in web.crawl_tables(spark, TINY))
    got = sorted(map(tuple, web.crawl_order(spark, TINY).collect()))
    assert got == simulated([tuple(r[c] for c in ("site", "url", "score", "position")) for r in entries], [tuple(r[c] for c in ("url", "link", "score", "position")) for r in links])
    assert max(r[4] for r in got) > 5


def test_empty(spark):
    e = spark.createDataFrame([], "site string, url string, score int, position long")
    k = spark.createDataFrame([], "url string, link string, score int, position long")
    assert not crawl.crawl_order(e, k).count()
