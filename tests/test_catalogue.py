"""Catalogue flattening (S13), asset choice (S14), paging cursor."""

import json

from foehn.sources import catalogue


def test_flatten_and_pick(spark):
    page1 = {
        "features": [
            {"id": "bas", "properties": {"title": "Basel"}, "assets": {
                "ogd-smn_bas_t_historical_2000-2009.csv": {"href": "h1"},
                "ogd-smn_bas_t_historical_2010-2019.csv": {"href": "h2"},
                "ogd-smn_bas_t_recent.csv": {"href": "r"},
                "ogd-smn_bas_t_now.csv": {"href": "n"},
                "ogd-smn_bas_t_historical_2020-2029.csv": {},
            }},
            {"id": "abo", "properties": {"title": "Adelboden"}, "assets": {}},
        ],
        "links": [{"rel": "next", "body": {"cursor": "c2"}}],
    }
    page2 = {"features": [{"id": "gve", "properties": {"title": "Genf"},
                           "assets": {"ogd-smn_gve_t_now.csv": {"href": "gn"}}}], "links": []}
    pages = spark.createDataFrame([(json.dumps(page1),), (json.dumps(page2),)], "json string")
    m = catalogue.flatten_pages(pages)
    assert m.count() == 6
    picked = {(r["station_id"], r["data_tier"], r["asset_name"]) for r in catalogue.pick_assets(m).collect()}
    assert picked == {
        ("bas", "historical", "ogd-smn_bas_t_historical_2000-2009.csv"),
        ("bas", "historical", "ogd-smn_bas_t_historical_2010-2019.csv"),
        ("bas", "recent", "ogd-smn_bas_t_recent.csv"),
        ("bas", "now", "ogd-smn_bas_t_now.csv"),
        ("gve", "now", "ogd-smn_gve_t_now.csv"),
    }
    assert [r["cursor"] for r in catalogue.next_cursors(pages).collect()] == ["c2"]
