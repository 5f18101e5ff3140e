"""Tier union (U1) and priority de-duplication.

``keep_first`` is ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.
Spark plans it as WindowGroupLimit(partial) -> Exchange(hash keys) ->
WindowGroupLimit(final): every map task already drops its losers, so a hot
key reaches the reducer as at most one row per map task, never as the whole
group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import FINGERPRINT, KEY_COLUMNS, TIER_PRIORITY

_RN = "__rn"


def _order_col(c: Column | str) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    deterministic: bool = True,
) -> DataFrame:
    """One row per key: the first by ``order``.

    With ``deterministic`` every remaining column is appended to the order
    (ascending, NULLs last), so ties inside ``order`` resolve the same way on
    every run; rows still tied are identical, so the choice cannot show.
    """
    return _numbered(df, keys, order, deterministic).filter(F.col(_RN) == 1).drop(_RN)


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], deterministic: bool) -> DataFrame:
    order_cols = [_order_col(c) for c in order]
    if deterministic:
        named = {c for c in order if isinstance(c, str)}
        rest = [c for c in df.columns if c not in set(keys) and c not in named]
        order_cols += [F.col(c).asc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w))


def tag_tier(df: DataFrame, tier: str) -> DataFrame:
    """P5: constant tier name and priority columns."""
    return df.withColumn("data_tier", F.lit(tier)).withColumn(
        "tier_priority", F.lit(TIER_PRIORITY[tier])
    )


def union_tiers(tiers: dict[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL of the tiers (by name), each tagged with tier and priority.
    Tiers are taken in priority order; missing tiers are skipped."""
    out = None
    for name in sorted(tiers, key=lambda t: TIER_PRIORITY[t]):
        df = tiers[name]
        if columns is not None:
            df = df.select(*columns)
        df = tag_tier(df, name)
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no tiers given")
    return out


def row_fingerprint(columns: Sequence[str]) -> Column:
    """60 bits of the MD5 of the columns' texts, in order; decides between
    rows that tie in all else.  Loads store it (``FINGERPRINT``), so that
    choosing a row reads and shuffles 8 bytes instead of all its values."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def dedup_tiers(
    tagged: DataFrame,
    keys: Sequence[str] = KEY_COLUMNS,
    keep_priority: bool = False,
) -> DataFrame:
    """Most trusted tier wins (historical > recent > now); inside one
    tier the newest load wins, then the file name, then the row fingerprint
    (rows that tie in it too hold the same values).

    The fingerprint is the stored one where the rows have it, else it is
    computed before the shuffle.  The window orders by it and by nothing else
    that a report doesn't ask for, so Catalyst prunes unused measures below
    the window."""
    order: list[Column | str] = [
        F.col("tier_priority").asc(),
        F.col("loaded_at").desc_nulls_last(),
        F.col("file_name").asc_nulls_last(),
        F.col(FINGERPRINT).asc_nulls_last(),
    ]
    if FINGERPRINT not in tagged.columns:
        named = ["tier_priority", "loaded_at", "file_name", "data_tier"]
        rest = [c for c in tagged.columns if c not in set(keys) and c not in named]
        tagged = tagged.withColumn(FINGERPRINT, row_fingerprint(rest))
    out = keep_first(tagged, keys, order, deterministic=False).drop(FINGERPRINT)
    return out if keep_priority else out.drop("tier_priority")


def drop_lower_tiers(tiers: dict[str, DataFrame], keep: Sequence[str]) -> dict[str, DataFrame]:
    """A tier filter above W1 equals dropping the tiers *before* W1 when
    the dropped tiers have the lowest priorities (``now`` is the lowest), so
    they are never scanned."""
    kept = set(keep)
    dropped = [t for t in tiers if t not in kept]
    if dropped and min(TIER_PRIORITY[t] for t in dropped) < max(TIER_PRIORITY[t] for t in kept):
        raise ValueError("only the lowest-priority tiers may be dropped before de-duplication")
    return {t: df for t, df in tiers.items() if t in kept}
