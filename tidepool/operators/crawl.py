"""The crawl over a snapshot: frontier, links, filters and the fixpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.urls import (acceptable_path, base_parts, document_base, fetchable, hrefs,
                                     in_scope, resolve_ref)
from tidepool.operators.ordered import row_numbers
from tidepool.schemas import FRONTIER
from tidepool.storage import fits_broadcast, materialize, scratch_path, sized_join

BUCKET_EDGES = 2_000_000  # edges of a hash bucket


def seed_source(spark: SparkSession, roots: Sequence[str] | DataFrame) -> DataFrame:
    """The root URLs, configured or a table with a column ``url``, as a frontier of depth 0."""
    if isinstance(roots, DataFrame):
        return roots.select("url").distinct().withColumn("depth", F.lit(0))
    return spark.createDataFrame([(r, 0) for r in dict.fromkeys(roots)], FRONTIER)


def scan_pages(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Fetch from the snapshot: (url, html) of the frontier's URLs."""
    return sized_join(pages.select("url", "html"), frontier.select("url").distinct(), ["url"],
                      spread="html", how="left_semi")


def extract_links(pages: DataFrame, roots: Sequence[str] | None = None,
                  scope: str = "contains") -> DataFrame:
    """One (src, dst) row per anchor that leads to a page of the web, limited to the roots if given.

    References are resolved against the document's base.
    """
    # A column of its own: the base is then found once for all parts that are taken from it.
    refs = pages.select(F.col("url").alias("src"), document_base("url", "html").alias("_at"),
                        hrefs("html").alias("_refs"))
    refs = refs.select("src", base_parts("_at").alias("_base"), "_refs")
    # Resolving inside the generator makes ``dst`` a plain column: filters on it are then evaluated
    # on its value, instead of being pushed down with a copy of the whole expression each.  Pages
    # without a base are left out in the same place for the same reason.
    links = refs.select("src", F.explode(F.when(F.col("_base").isNotNull(), F.transform(
        "_refs", lambda ref: resolve_ref(F.col("_base"), ref)))).alias("dst")).filter(
            fetchable("dst"))
    return links if roots is None else links.filter(in_scope("dst", roots, scope))


def unseen(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct candidates whose ``url`` was not visited.

    A round is usually far smaller than everything visited: if it was measured to fit, the visited
    table is only scanned for it and never shuffled.
    """
    new = materialize(candidates.distinct(), "candidates")
    urls = visited.select("url")
    if fits_broadcast(new):
        urls = urls.join(F.broadcast(new.select("url").distinct()), "url", "left_semi")
    return new.join(urls.distinct(), "url", "left_anti")


def not_visited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Each unseen URL once."""
    return unseen(candidates.select("url"), visited)


def link_graph(links: DataFrame) -> DataFrame:
    """(url, out_degree, in_degree) over the edges, duplicates counted."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("src").alias("url"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("url"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("e")).select("e.*")
    return ends.groupBy("url").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def _by_source(edges: DataFrame) -> DataFrame:
    """The edges, written once in hash buckets of ``src``, so that no round shuffles them again."""
    spark = edges.sparkSession
    edges = materialize(edges, "settled")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  -(-edges.count() // BUCKET_EDGES))
    path = scratch_path(spark, "edges")
    name = "tidepool_" + path.rsplit("/", 1)[-1].replace("-", "_")
    edges.repartition(buckets, "src").write.bucketBy(buckets, "src").sortBy("src").option(
        "path", path).saveAsTable(name)
    return spark.table(name)


def crawl_bfs(pages: DataFrame, seeds: DataFrame, roots: Sequence[str] | None = None,
              max_depth: int | None = None, scope: str = "contains") -> DataFrame:
    """(url, depth, status) of every URL the crawl reaches, status ``fetched`` or ``missing``.

    Links are extracted once and written before anything measures them, and whether a link's target
    is in the snapshot is settled once, too.  Each round is then a semi join of the edges with the
    round's URLs and an anti join with what was seen.  Rounds are written to the shared folder, so a
    lost executor costs one round.  The loop ends when a round brings nothing new.
    """
    spark = pages.sparkSession
    status = F.when(F.col("_known"), "fetched").otherwise("missing").alias("status")
    known = materialize(pages.select("url").distinct().withColumn("_known", F.lit(True)), "known")
    links = extract_links(pages, roots, scope).filter(acceptable_path("dst")).distinct()
    links = materialize(links, "links")
    targets = F.broadcast(known) if fits_broadcast(known) else known
    settled = sized_join(links.withColumnRenamed("dst", "url"), known, ["url"], spread="src",
                         how="left").select("src", "url", status)
    edges = _by_source(settled)
    rounds = scratch_path(spark, "rounds")
    row = "url STRING, status STRING"

    def keep(urls: DataFrame, depth: int) -> DataFrame:
        folder = f"{rounds}/depth={depth}"
        urls.select("url", "status").write.parquet(folder)
        return spark.read.schema(row).parquet(folder)

    def seen() -> DataFrame:
        return spark.read.schema(f"{row}, depth INT").parquet(rounds).select("url", "depth", "status")

    depth = 0
    first = seeds.filter(acceptable_path("url")).select("url").distinct()
    new = keep(first.join(targets, "url", "left").select("url", status), depth)
    while max_depth is None or depth < max_depth:
        fetched = new.filter("status = 'fetched'").select(F.col("url").alias("src"))
        found = edges.join(fetched, "src", "left_semi").select("url", "status")
        depth += 1
        new = keep(unseen(found, seen()), depth)
        if new.isEmpty():
            break
    return seen()


def preferred_merge(preferred: DataFrame, other: DataFrame) -> DataFrame:
    """Both inputs (url) in the order they are to be taken, the preferred one (priority 0) first."""
    both = preferred.select("url", F.lit(0).alias("priority")).unionByName(
        other.select("url", F.lit(1).alias("priority")))
    return row_numbers(both, ["priority", "url"], "position")


def crawl_counters(pages: DataFrame) -> DataFrame:
    """(stage, processed): pages read, links found and links accepted, from one pass over the pages."""
    base = base_parts(document_base("url", "html"))
    links = pages.select(F.filter(F.transform(F.coalesce(hrefs("html"), F.array().cast(
        "array<string>")), lambda ref: resolve_ref(base, ref)), lambda u: fetchable(u)).alias("links"))
    taken = F.size(F.filter("links", lambda u: acceptable_path(u)))
    sums = links.agg(F.count(F.lit(1)).alias("pages"), F.sum(F.size("links")).alias("links"),
                     F.sum(taken).alias("accepted"))
    stages = F.explode(F.array(*[F.struct(F.lit(c).alias("stage"), F.coalesce(
        F.col(c), F.lit(0)).alias("processed")) for c in ("pages", "links", "accepted")]))
    return sums.select(stages.alias("s")).select("s.stage", "s.processed")
