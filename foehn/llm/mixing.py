"""Mixing sources to target weights by entropy balancing (operator 2).

The rates closest to 1 in relative entropy that give each source its target
words are exponential in a document's size: exp(lambda * size), at most
``CAP``. lambda solves the source's convex dual by Newton steps, each one
grouped sum in Spark over (source, size) cells - all that the dual needs of
the corpus. Rates are rounded into whole copies cell by cell, the words lost
or won by rounding carried on to the next smaller size.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foehn.llm.store import numbered, stored

#: Most copies of a document, and so most of a source's words times its size.
CAP = 3
WEIGHTS = (1.0, 2.0, 3.0)
TOLERANCE = 1e-6
MOST_STEPS = 60

#: Documents of one cell that are ranked together for an extra copy; in a cell
#: of n documents sqrt(n) at least, so that neither parts nor their number grow
#: with n.
RANKED = 512


def word_count(text: str) -> Column:
    """Runs of anything but space and \\x09-\\x0D; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(spark: SparkSession, cells: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, mean): sources in code point order, null
    last, weigh as listed, repeating. Targets stop at CAP times the source's
    size; the excess goes to the others by weight until none is above."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = stored(spark, sources.withColumn("weight", weight), "sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, F.lit(False)
    limit = F.col("source_size") * float(CAP)
    while True:
        taken, free, n_full = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.count(F.when(full, 1))
        ).first()
        if not free:
            break
        level = (total - taken) / free
        above = F.col("weight") * level > limit
        if sources.where(above).count() == n_full:
            break
        full = above
    target = F.least(F.col("weight") * level, limit) if level else F.least(limit, F.lit(0.0))
    return sources.select("source", "source_size", target.alias("target"), F.greatest(F.lit(1.0), F.col("source_size") / F.col("docs")).alias("mean"))


def _rate() -> Column:
    return F.least(F.lit(float(CAP)), F.exp(F.least(F.lit(50.0), F.col("lam") * F.col("size") / F.col("mean"))))


def solve(spark: SparkSession, cells: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with ``lam``, each source's dual solution. Newton steps stay
    within the bracket found so far; where they would leave it, it is halved.
    A source that is not solved in MOST_STEPS steps is an error."""
    none = F.lit(None).cast("double")
    state = targets.withColumns({"lam": F.lit(0.0), "low": none, "high": none, "done": F.col("target") <= 0})
    for _ in range(MOST_STEPS):
        state = stored(spark, state, "dual")
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            return state
        joined = cells.join(open_, cells["source"].eqNullSafe(open_["source"])).select(open_["source"], "size", "n", "lam", "mean")
        words = F.col("n") * F.col("size") * _rate()
        slope = F.when(_rate() < CAP, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = joined.groupBy("source").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope")).withColumnRenamed("source", "key")
        step = state.join(sums, state["source"].eqNullSafe(sums["key"]), "left").drop("key")
        miss = F.col("words") - F.col("target")
        low = F.when(miss < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        inside = newton.isNotNull() & F.coalesce(newton > F.col("low"), F.lit(True)) & F.coalesce(newton < F.col("high"), F.lit(True))
        beside = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2).otherwise(
            F.col("lam") + F.when(miss < 0, 1.0).otherwise(-1.0) * F.greatest(F.lit(1.0), F.abs("lam"))
        )
        near = F.abs(miss) <= F.col("target") * TOLERANCE
        state = step.withColumns({"low": F.when(~F.col("done"), low), "high": F.when(~F.col("done"), high)}).select(
            "source", "source_size", "target", "mean",
            F.when(F.col("done") | near, F.col("lam")).when(inside, newton).otherwise(beside).alias("lam"), "low", "high", (F.col("done") | near).alias("done"),
        )
    raise RuntimeError(f"no solution of a source's dual in {MOST_STEPS} steps")


def _copies(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each size of one source, from the largest: base for
    every document and one more for ``extra`` of them."""
    cells = cells.sort_values("size", ascending=False)
    owed, base, extra = 0.0, [], []
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
        if size == 0:
            base.append(1)
            extra.append(0)
            continue
        owed += n * rate * size
        copies = int(min(max(round(owed / size), 0), CAP * n))
        owed -= copies * size
        base.append(copies // n)
        extra.append(copies % n)
    return cells.assign(base=base, extra=extra)


def mix_sources(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS
) -> DataFrame:
    """One row per input row: id_col, ``size``, ``source_size``, ``target``,
    ``rate`` (before rounding), ``copies`` (0 to CAP) and ``taken`` = copies *
    size. Which documents of equal source and size get one copy more is
    decided by a hash of id and size, so reruns agree.

    A null text has size 0 and, like an empty one, is kept once (0 words). A
    null source is a source of its own, a null id an ordinary value; repeated
    rows are documents each. Other columns are ignored."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    sized = stored(spark, sized.withColumn("pick", F.xxhash64("id", "size", F.lit(11))), "sizes")
    cells = stored(spark, sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    dual = solve(spark, cells, source_targets(spark, cells, weights))
    rated = cells.join(dual, cells["source"].eqNullSafe(dual["source"])).select(
        cells["source"], "size", "n", "source_size", "target", F.when(F.col("target") > 0, _rate()).otherwise(1.0).alias("rate")
    )
    schema = "source string, size long, n long, source_size long, target double, rate double, base int, extra long"
    plan = stored(spark, rated.groupBy("source").applyInPandas(_copies, schema), "copies")

    joined = sized.join(plan, sized["source"].eqNullSafe(plan["source"]) & (sized["size"] == plan["size"])).select(
        "id", sized["source"], sized["size"], "pick", "n", "source_size", "target", "rate", "base", "extra"
    )
    # a cell is ranked in parts by hash; of the cell's extra copies a part gets those between the shares of
    # the documents before it and with it, so that the parts' copies add up to the cell's
    n_parts = F.ceil(F.col("n") / F.greatest(F.lit(float(RANKED)), F.sqrt("n")))
    joined = stored(spark, joined.withColumn("part", F.pmod(F.col("pick"), n_parts)), "ranked")
    counts = joined.where("extra > 0").groupBy("source", "size", "part", "n", "extra").agg(F.count("*").alias("here"))
    upto = F.sum("here").over(Window.partitionBy("source", "size").orderBy("part"))
    part_share = lambda c: F.floor(F.col("extra").cast("decimal(19,0)") * c / F.col("n"))
    counts = counts.withColumn("upto", upto).select(
        F.col("source").alias("of_source"), F.col("size").alias("of_size"), F.col("part").alias("of_part"),
        (part_share(F.col("upto").cast("decimal(19,0)")) - part_share((F.col("upto") - F.col("here")).cast("decimal(19,0)"))).alias("share"),
    )
    same = joined["source"].eqNullSafe(counts["of_source"]) & (joined["size"] == counts["of_size"]) & (joined["part"] == counts["of_part"])
    joined = joined.join(counts, same, "left")
    nth = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("pick", "id"))
    copies = F.col("base") + F.when(nth <= F.coalesce("share", F.lit(0)), 1).otherwise(0)
    return joined.withColumn("copies", copies).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", F.col("copies").cast("int").alias("copies")
    )


def repeat_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """docs with every row as often as the mix takes it (0 to CAP times).
    Rows of equal id and size share their copies, most to the first by hash."""
    rows, name = numbered(docs)
    mix = mix_sources(spark, rows, name[id_col], name[text], name[source], **options).select(F.col(name[id_col]).alias("id"), F.col("size").alias("of"), "copies")
    mix = mix.withColumn("rank", F.row_number().over(Window.partitionBy("id", "of").orderBy(F.desc("copies"))))
    rows = rows.withColumns({"size": word_count(name[text]), "hash": F.xxhash64(*rows.columns)})
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(name[id_col], "size").orderBy("hash")))
    joined = rows.join(mix, rows[name[id_col]].eqNullSafe(mix["id"]) & (rows["size"] == mix["of"]) & (rows["nth"] == mix["rank"]))
    repeated = joined.where(joined["copies"] > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*name.values()).toDF(*docs.columns)
