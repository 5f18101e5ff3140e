"""Catalogue pages (STAC item collections) -> station x asset rows (S13) and
the per-station file choice (S14).

Pages are JSON documents already landed as rows (one page per row); the
HTTP paging itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rejects import stage

ASSET = T.StructType([T.StructField("href", T.StringType(), True)])
FEATURE = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("properties", T.StructType([T.StructField("title", T.StringType(), True)]), True),
        T.StructField("assets", T.MapType(T.StringType(), ASSET), True),
    ]
)
LINK = T.StructType(
    [
        T.StructField("rel", T.StringType(), True),
        T.StructField("body", T.StructType([T.StructField("cursor", T.StringType(), True)]), True),
    ]
)
PAGE = T.StructType(
    [
        T.StructField("features", T.ArrayType(FEATURE), True),
        T.StructField("links", T.ArrayType(LINK), True),
    ]
)

# Asset-name rules per tier.
NOW_SUFFIX = "_t_now.csv"
RECENT_SUFFIX = "_t_recent.csv"
HISTORICAL_MARK = "_t_historical_"


def flatten_pages(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per (station, asset): station_id, title, asset_pos,
    asset_name, href.  ``asset_pos`` keeps the document order of assets."""
    page = pages.select(F.from_json(F.col(json_col), PAGE).alias("p"))
    feats = page.select(F.explode("p.features").alias("f"))
    return feats.select(
        F.col("f.id").alias("station_id"),
        F.col("f.properties.title").alias("title"),
        F.posexplode("f.assets").alias("asset_pos", "asset_name", "asset"),
    ).select("station_id", "title", "asset_pos", "asset_name", F.col("asset.href").alias("href"))


def next_cursors(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """The paging cursor of every page that has a ``next`` link."""
    page = pages.select(F.from_json(F.col(json_col), PAGE).alias("p"))
    return page.select(F.explode("p.links").alias("l")).filter(F.col("l.rel") == "next").select(
        F.col("l.body.cursor").alias("cursor")
    )


def page_chain(pages: DataFrame, by: list[str], cursor_col: str = "cursor", json_col: str = "json") -> DataFrame:
    """Whether the landed pages of each catalogue are its whole chain.

    ``pages``: one row per landed page, the columns ``by`` that name its
    catalogue (not NULL), the cursor it was asked for with (NULL for the
    first) and its JSON.  Output: ``by``, ``cursor``, ``position`` (from 0
    along the ``next`` links; NULL if they don't lead there) and ``status``:

    * ``missing`` - named by a landed page, or a catalogue's first, but not landed;
    * ``repeated`` - landed more than once (the smallest ``next`` counts);
    * ``unreachable`` - landed, but no chain from the first page leads there;
    * ``cyclic`` - its ``next`` leads back to a page at or before it;
    * ``ok``.

    Positions come from pointer doubling: after k rounds the first 2**k pages
    of every chain have theirs and every page knows the one 2**k ahead, so a
    chain of n pages takes about log2(n) joins, whatever the cycles.  All
    sides are as many as the pages: they are joined by merging, so none of
    them is collected by the driver to be broadcast, round after round."""
    key = [*by, "node"]
    link = F.try_element_at(F.filter("p.links", lambda x: x["rel"] == "next"), F.lit(1))["body"]["cursor"]
    # a cursor is marked, so that the first page's NULL is a node like others
    node = lambda c: F.concat(F.lit("="), c)
    read = pages.withColumn("p", F.from_json(F.col(json_col), PAGE))
    read = read.select(*by, F.coalesce(node(F.col(cursor_col)), F.lit("")).alias("node"), node(link).alias("next"))
    landed = read.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("next").alias("next"))
    landed = stage(landed, "pages-landed")
    jump = landed.filter(F.col("next").isNotNull()).select(*key, F.col("next").alias("ahead"))
    firsts = landed.select(*by).distinct()
    reached = stage(firsts.select(*by, F.lit("").alias("node"), F.lit(0).cast("long").alias("position")), "pages-reached")
    step, most = 1, landed.count()
    while step <= most:
        onward = reached.join(jump.hint("merge"), key).select(*by, F.col("ahead").alias("node"), (F.col("position") + step).alias("position"))
        reached = stage(reached.unionByName(onward).groupBy(*key).agg(F.min("position").alias("position")), "pages-reached")
        further = jump.select(*by, F.col("node").alias("__mid"), F.col("ahead").alias("__far"))
        mid = jump.withColumnRenamed("ahead", "__mid")
        jump = stage(mid.join(further.hint("merge"), [*by, "__mid"]).select(*key, F.col("__far").alias("ahead")), "pages-jump")
        step *= 2
    named = landed.filter(F.col("next").isNotNull()).select(*by, F.col("next").alias("node")).distinct()
    every = landed.select(*key).unionByName(named).unionByName(firsts.withColumn("node", F.lit(""))).distinct()
    then = reached.select(*by, F.col("node").alias("next"), F.col("position").alias("__then"))
    known = every.join(landed.hint("merge"), key, "left").join(reached.hint("merge"), key, "left").join(then.hint("merge"), [*by, "next"], "left")
    status = (
        F.when(F.col("copies").isNull(), "missing")
        .when(F.col("copies") > 1, "repeated")
        .when(F.col("position").isNull(), "unreachable")
        .when(F.col("__then") <= F.col("position"), "cyclic")
        .otherwise("ok")
    )
    cursor = F.when(F.col("node") != "", F.substring("node", 2, 1 << 30))
    return known.select(*by, cursor.alias("cursor"), "position", status.alias("status"))


def pick_assets(manifest: DataFrame) -> DataFrame:
    """Per station the first ``*_t_now.csv`` and first ``*_t_recent.csv``
    (document order), and every historical CSV.  Assets without href are
    dropped.  Output: station_id, data_tier, asset_name, href."""
    m = manifest.filter(F.col("href").isNotNull())
    name = F.col("asset_name")
    tiered = m.withColumn(
        "data_tier",
        F.when(name.endswith(NOW_SUFFIX), F.lit("now"))
        .when(name.endswith(RECENT_SUFFIX), F.lit("recent"))
        .when(name.contains(HISTORICAL_MARK) & name.endswith(".csv"), F.lit("historical")),
    ).filter(F.col("data_tier").isNotNull())
    firsts = (
        tiered.filter(F.col("data_tier") != "historical")
        .groupBy("station_id", "data_tier")
        .agg(F.min_by(F.struct("asset_name", "href"), F.col("asset_pos")).alias("a"))
        .select("station_id", "data_tier", F.col("a.asset_name").alias("asset_name"), F.col("a.href").alias("href"))
    )
    hist = tiered.filter(F.col("data_tier") == "historical").select("station_id", "data_tier", "asset_name", "href")
    return firsts.unionByName(hist)
