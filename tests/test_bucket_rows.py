"""Buckets of a fact by its rows."""

from foehn.operators import buckets


def test_buckets_follow_the_rows_of_the_fact():
    assert [buckets.bucket_count_of_rows(n) for n in (0, 1, 500_000, 500_001, 36_000_000)] == [1, 1, 1, 2, 72]
