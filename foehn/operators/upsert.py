"""Keyed upsert with MERGE semantics on plain files (K4) and its counters (K5).

``MERGE INTO t USING s ON keys WHEN MATCHED UPDATE ALL WHEN NOT MATCHED
INSERT ALL`` is rebuilt from joins:

* every target row whose key is in the source is replaced by the source row
  (one output row per target row, so target duplicates stay as they were);
* target rows without a match stay unchanged;
* source rows whose key is not in the target are inserted.

The source is first reduced to one row per key (a key twice in the source
makes MERGE non-deterministic) and rows with a NULL key are set aside (they
would never match and would be inserted again on every run).

Plan shape, with the target scanned once:

1. the prepared source is staged (one full-width shuffle, partial top-1
   first);
2. target LEFT OUTER JOIN source is staged: the source is broadcast if its
   measured size allows, so the target is not shuffled at all; beyond that a
   sort-merge join, of which AQE can split a hot target key;
3. what is inserted is source LEFT ANTI JOIN the distinct keys of *updated*
   rows, read from the staged copy (its action and key columns only).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first
from .rejects import stage, staged
from .sizes import BROADCAST_BYTES, broadcast_if_small

ACTION = "_merge_action"  # inserted | updated | unchanged


def split_null_keys(source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return source.filter(~any_null), source.filter(any_null)


def prepare_source(
    source: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Source without NULL keys and with one row per key (first by ``order``,
    then by all values, so the choice is repeatable)."""
    good, _ = split_null_keys(source, keys)
    return keep_first(good, keys, list(order), deterministic=True)


def _replaced(target: DataFrame, src: DataFrame, keys: Sequence[str], max_broadcast_bytes: int) -> DataFrame:
    """Target rows with the values of their source row, if there is one."""
    cols = target.columns
    s = src.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in cols if c not in keys], F.lit(True).alias("__matched"))
    joined = target.join(broadcast_if_small(s, max_broadcast_bytes), list(keys), "left_outer")
    matched = F.col("__matched").isNotNull()
    return joined.select(
        *[
            F.col(c) if c in keys else F.when(matched, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
            for c in cols
        ],
        F.when(matched, F.lit("updated")).otherwise(F.lit("unchanged")).alias(ACTION),
    )


def _with_inserted(kept: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``kept`` (staged) and the source rows whose key it does not hold."""
    there = kept.filter(F.col(ACTION) == "updated").select(*keys).distinct()
    inserted = src.join(there, list(keys), "left_anti")
    return kept.unionByName(inserted.select(*[c for c in kept.columns if c != ACTION], F.lit("inserted").alias(ACTION)))


def _checked(target: DataFrame, src: DataFrame) -> DataFrame:
    missing = [c for c in target.columns if c not in src.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return src.select(*target.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    with_action: bool = True,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The target after MERGE; ``_merge_action`` tells what happened per row.
    Runs the merge: the result reads copies staged in the checkpoint folder."""
    src = stage(prepare_source(_checked(target, source), keys, order), "merge-source")
    kept = stage(_replaced(target, src, keys, max_broadcast_bytes), "merge-kept")
    out = _with_inserted(kept, src, keys)
    return out if with_action else out.drop(ACTION)


@contextmanager
def merging(target: DataFrame, src: DataFrame, keys: Sequence[str], max_broadcast_bytes: int = BROADCAST_BYTES) -> Iterator[DataFrame]:
    """``merge_upsert`` of a prepared source (one row per key, staged) for one
    block of work; the staged copy goes when the block ends. Inside the block
    nothing reads the target any more, so it may be overwritten."""
    src = _checked(target, src)
    with staged(_replaced(target, src, keys, max_broadcast_bytes), "merge-kept") as kept:
        yield _with_inserted(kept, src, keys)


def merge_counts(merged: DataFrame) -> DataFrame:
    """K5: one row with rows_inserted, rows_updated, rows_unchanged, rows_total."""
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == "inserted").alias("rows_inserted"),
        F.count_if(a == "updated").alias("rows_updated"),
        F.count_if(a == "unchanged").alias("rows_unchanged"),
        F.count(F.lit(1)).alias("rows_total"),
    )
