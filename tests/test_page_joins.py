"""Joins of pages send none of them through the driver."""

import json

from foehn.sources import catalogue


def test_page_chain_broadcasts_no_pages(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans, stage = [], catalogue.stage
    kept = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(catalogue, "stage", lambda df, name: kept(df) or stage(df, name))
    page = lambda k: json.dumps({"features": [], "links": [{"rel": "next", "body": {"cursor": f"c{k + 1}"}}] if k < 5 else []})
    pages = spark.createDataFrame([(1, f"c{k}" if k else None, page(k)) for k in range(6)], "catalogue int, cursor string, json string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        out = catalogue.page_chain(pages, ["catalogue"])
        kept(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r["position"], r["status"]) for r in out.collect()) == [(k, "ok") for k in range(6)]
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
