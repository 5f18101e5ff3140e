"""Repeated paragraphs and passages (operator 3).

Paragraphs are the lines of a text. MinHash bands tie similar ones, exact
Jaccard similarity on word 5-grams verifies them, and components of verified
links are clusters, of which one copy is kept. Passages repeated inside
otherwise unlike paragraphs have no similar paragraph around them; they are
found as paragraphs cut by content: limits stand at 3-grams of least hash in
any WINDOW consecutive ones, so equal passages are cut alike wherever they
stand, and their cuts collide in a single band, the hash of all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foehn.llm.components import connected_components
from foehn.llm.ngram_join import N_WORDS, THRESHOLD, candidate_groups, class_of, shingle_sets, signatures, verified_links
from foehn.llm.store import stored
from foehn.llm.textvec import ALNUM, mix, slices

#: 16 bands of 4 rows miss a pair of similarity 0.8 with probability 0.0002.
BANDS, ROWS = 16, 4
#: Words from which on a repeated paragraph or run of passages counts. Of a
#: repeated passage of 51 words the parts cover 20 at least: its first limit is
#: among its first 16 3-grams, its last among the last 16.
LEAST_WORDS = 20
WINDOW = 16

_U = np.uint64
_MOST = _U(0xFFFFFFFFFFFFFFFF)


def _slid(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width] for every i, short at the end."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[: len(out) - step] = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def cuts(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first word, end word) of the content-defined parts of each
    text, by word numbers in the slice; a part takes in the 3-gram of its end."""
    h = words.hashes
    n = len(h)
    if n < WINDOW + 2:
        none = np.zeros(0, np.int64)
        return none, none, none
    text = words.text_of()
    grams = mix(h[:-2] * _U(0x9E3779B97F4A7C15) + mix(h[1:-1] * _U(0xC2B2AE3D27D4EB4F) + h[2:]))
    whole = np.zeros(len(grams), bool)  # windows within one text
    whole[: n - WINDOW - 1] = text[: n - WINDOW - 1] == text[WINDOW + 1 :]
    low = _slid(grams, WINDOW, np.minimum)
    low[~whole] = 0
    # a 3-gram is a limit if it is the least of some window: of those that hold it, the greatest minimum is its hash
    padded = np.concatenate((np.zeros(WINDOW - 1, _U), low))
    best = _slid(padded, WINDOW, np.maximum)[: len(grams)]
    at = np.flatnonzero((best >= grams) & (best > 0))
    follows = text[at[1:]] == text[at[:-1]]
    return text[at[:-1][follows]], at[:-1][follows], at[1:][follows] + 3


def passages(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(uid, id, first, words, key) of all content-defined parts: word numbers
    in the text and a hash of all words."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for row, to, texts in slices(batch.column(1)):
                words = texts.words(ALNUM)
                owner, first, end = cuts(words)
                steps = np.full(len(words) + 1, _U(0x9E3779B97F4A7C13), _U)
                steps[0] = 1
                up = np.cumprod(steps, dtype=_U)
                steps[1:] = _U(pow(0x9E3779B97F4A7C13, -1, 1 << 64))
                down = np.cumprod(steps, dtype=_U)
                total = np.concatenate((np.zeros(1, _U), np.cumsum(words.hashes * up[:-1], dtype=_U)))
                key = mix((total[end] - total[first]) * down[first] + (end - first).astype(_U))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid + owner), batch.column(0).slice(row, to - row).take(pa.array(owner)), pa.array((first - words.first[owner]).astype(np.int32)),
                        pa.array((end - 3 - first).astype(np.int32)), pa.array(key.view(np.int64)),
                    ],
                    names=["uid", "id", "first", "words", "key"],
                )
                uid += len(texts)

    return docs.select(id_col, F.lower(F.col(text)).alias("text")).mapInArrow(run, f"uid long, id {kind}, first int, words int, key long")


def repeated_passages(spark: SparkSession, docs: DataFrame, id_col: str, text: str, least: int) -> DataFrame:
    """Runs of parts that stand in more than one row of docs too, a row for
    each piece of a run whose parts have the same head."""
    parts = stored(spark, passages(docs, id_col, text), "passages")
    heads = parts.groupBy("key").agg(F.min("id").alias("head"), F.min("uid").alias("low"), F.max("uid").alias("high")).where("low != high")
    heads = stored(spark, heads.select("key", "head"), "passage-heads")  # a table of its own, so that a hot key's side of the join can be split
    hits = stored(spark, parts.join(heads, "key"), "repeated-passages")
    in_text = Window.partitionBy("uid").orderBy("first")
    starts = F.coalesce(F.lag(F.col("first") + F.col("words")).over(in_text) < F.col("first"), F.lit(True))
    turns = starts | ~F.lag("head").over(in_text).eqNullSafe(F.col("head"))
    hits = hits.withColumns({"run": F.sum(starts.cast("int")).over(in_text), "piece": F.sum(turns.cast("int")).over(in_text)})
    # a run counts as a whole, but is kept or removed piece by piece: neighbouring parts may have their heads in different rows
    pieces = hits.groupBy("uid", "run", "piece", "id").agg(
        F.min("first").alias("first"), F.sum("words").alias("words"), F.min("head").alias("keeper"), F.min("key").alias("low"), F.collect_set("key").alias("keys")
    )  # of one text
    whole = Window.partitionBy("uid", "run")
    in_run = whole.orderBy("first")
    removed = ~F.col("keeper").eqNullSafe(F.col("id"))
    # a part and the next share a 3-gram, which stays where one of them does
    kept_to = F.max(F.when(~removed, F.col("first") + F.col("words") + 3)).over(in_run.rowsBetween(Window.unboundedPreceding, -1))
    tail = F.when(F.lead("first").over(in_run).isNull(), 2).when(removed, 0).otherwise(3)
    runs = pieces.select(
        "id", "keeper", "keys", removed.alias("removed"), F.min("low").over(whole).alias("low"), (F.sum("words").over(whole) + 2).alias("run_words"),
        F.when(removed, F.greatest("first", kept_to)).otherwise(F.col("first")).alias("position"), (F.col("first") + F.col("words") + tail).alias("end"),
    )
    runs = stored(spark, runs.where(F.col("run_words") >= least), "passage-runs")
    stars = runs.select(F.explode("keys").alias("u"), F.col("low").alias("v"))
    named = runs.join(connected_components(spark, stars).withColumnRenamed("node", "low"), "low", "left").withColumn("component", F.coalesce("component", "low"))
    least_id = named.groupBy("component").agg(F.min("keeper").alias("component_id"))
    return named.join(least_id, "component").where("end > position").select(
        F.col("id").alias(id_col), F.lit("passage").alias("unit"), F.col("position").cast("long").alias("position"), (F.col("end") - F.col("position")).cast("long").alias("n_words"),
        "component_id", F.col("keeper").alias("keeper_id"), "removed",
    )


def repeated_lines(spark: SparkSession, docs: DataFrame, id_col: str, text: str, least: int, n: int, threshold: float) -> DataFrame:
    """Lines that equal or resemble lines elsewhere."""
    # a row is named by what it holds: the plans below read docs again, perhaps in another order
    row = F.xxhash64(F.col(id_col), F.col(text)).alias("row")
    lines = docs.select(F.col(id_col).alias("id"), row, F.posexplode(F.split(text, "\n")).alias("position", "text"))
    n_words = F.size(F.split(F.trim("text"), " +"))
    lines = lines.withColumn("n_words", n_words).where(F.col("n_words") >= least)
    marked = stored(spark, lines.select("id", "row", "position", "n_words", class_of("text")), "lines")
    groups = stored(spark, candidate_groups(spark, stored(spark, signatures(lines, "text", n, BANDS, ROWS), "line-bands")), "line-groups")
    # weight 1: links between different lines only say that there is a cluster
    heads = marked.groupBy("class").agg(F.min("id").alias("head"), F.min(F.struct("row", "position")).alias("spot"), F.count("*").alias("copies"))
    wanted = groups.join(heads.select("class", "spot.row", "spot.position"), "class")
    texts = lines.select(class_of("text"), "row", "position", "text").join(wanted, ["class", "row", "position"])
    texts = texts.groupBy("class", "grp").agg(F.min("text").alias("text"))  # repeated rows hold a line's text each
    texts = texts.select("class", "grp", F.lit(1).cast("long").alias("weight"), "text")
    sets = stored(spark, shingle_sets(texts, n, ["class", "grp", "weight"]), "line-sets").dropDuplicates(["class"])
    links, stars = verified_links(spark, sets, threshold)
    parts = connected_components(spark, stars).withColumnRenamed("node", "class")
    named = heads.join(parts, "class", "left").join(links, "class", "left").where("copies > 1 or n_links > 0").withColumn("component", F.coalesce("component", "class"))
    least_id = named.groupBy("component").agg(F.min("head").alias("component_id"))
    named = named.join(least_id, "component").select("class", "component_id")
    return marked.join(named, "class").select(
        F.col("id").alias(id_col), F.lit("line").alias("unit"), F.col("position").cast("long").alias("position"), F.col("n_words").cast("long").alias("n_words"),
        "component_id", F.col("component_id").alias("keeper_id"), (~F.col("id").eqNullSafe(F.col("component_id"))).alias("removed"),
    )


def repeated_text(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, n: int = N_WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """A row per repeated line or passage of at least ``least`` words: id_col,
    ``unit`` (line or passage), ``position`` (line number, or number of the
    first word), ``n_words``, ``component_id`` and ``keeper_id`` (smallest ids
    of its cluster and of the rows that hold it) and ``removed``. A passage
    whose parts are kept in different rows has a row, which may be shorter, for
    each piece.

    Case does not count. A row with the keeper's id keeps its copy; repeated
    rows of that id all do. Null and short texts have no rows; a null id keeps
    nothing unless all ids of its cluster are null. No documents, no rows."""
    return repeated_lines(spark, docs, id_col, text, least, n, threshold).unionByName(repeated_passages(spark, docs, id_col, text, least))
