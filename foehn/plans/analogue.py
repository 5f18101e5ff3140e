"""Map the driver's test tables onto the weather data model.

The test data holds no weather tables, so the registered queries run every
operator on analogues derived (by Spark, from the whole tables) as follows:

* measurement tiers <- ``events``: station = ``user_id``, reference time =
  ``ts`` floored to 10 minutes, measures derived from ``value`` and
  ``event_type`` (some NULL by rule).  The tiers are overlapping time slices,
  so every overlap case of the de-duplication occurs.
* stations <- ``customer`` joined with ``nation`` (canton = nation name,
  elevation = account balance, no latitude for negative balances).
* raw CSV lines <- ``events`` rendered as ``;``-separated text with null
  tokens, bad numbers, quoting, short/long rows and bad codes by rule.
* upsert <- ``lineitem`` split into an older target and a newer, corrected
  source that overlap; its key is not unique.
* catalogue pages <- one JSON page per station listing its tier files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import floor_minutes
from ..schema import BRONZE_COLUMNS, MEASURE_CODES, MEASURE_TYPE, STATION_COLUMNS
from ..sources.splits import spread

# Fixed analogue parameters (the "current" date/time of the test data).
AS_OF = dt.date(2024, 1, 30)
AS_OF_TS = dt.datetime(2024, 1, 30, 12, 0, 0)
TIER_WINDOWS = {
    "historical": (None, "2024-01-20 00:00:00"),
    "recent": ("2024-01-10 00:00:00", "2024-01-28 00:00:00"),
    "now": ("2024-01-18 00:00:00", None),
}
TIER_FILE_SUFFIX = {
    "historical": "_t_historical_2020-2029.csv",
    "recent": "_t_recent.csv",
    "now": "_t_now.csv",
}
TIER_LOADED_AT = {
    "historical": "2024-01-20 03:00:00",
    "recent": "2024-01-29 13:00:00",
    "now": "2024-01-30 11:00:00",
}
STATIONS_LOADED_AT = "2024-01-28 02:00:00"
STATION_FILE = "ogd-smn_meta_stations.csv"
CSV_LOADED_AT = "2024-01-30 11:30:00"
UPSERT_KEYS = ["l_orderkey", "l_linenumber"]
UPSERT_TARGET_BEFORE = "1999-01-01 00:00:00"
UPSERT_SOURCE_FROM = "1998-01-01 00:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact-sized test table, spread over the cores when its file holds a
    single row group (the driver's files do; large tables pass unchanged)."""
    return spread(table(spark, sf_dir, name))


def _dec(c: Column) -> Column:
    return c.cast(MEASURE_TYPE)


def measure_columns() -> dict[str, Column]:
    """Analogue measures (DECIMAL(38,10)); unset measures are NULL."""
    v = _dec(F.col("value"))
    et = F.col("event_type")
    ok = et != "error"
    m = {code: F.lit(None).cast(MEASURE_TYPE) for code in MEASURE_CODES}
    m["tre200s0"] = _dec(F.when(ok, v - 10))
    m["ure200s0"] = _dec(F.when(ok, v + 40))
    m["tde200s0"] = _dec(F.when(ok, v - 15))
    m["prestas0"] = _dec(F.when(et != "signup", v + 900))
    m["rre150z0"] = _dec(F.when(et == "purchase", v).when(et == "error", F.lit(None)).otherwise(F.lit(0)))
    m["fkl010z1"] = v
    m["fkl010z0"] = _dec(v + v)
    m["gre000z0"] = _dec(F.when(et.isin("view", "click"), v))
    m["ods000z0"] = _dec(F.when(F.col("user_id") % 3 == 0, v))
    return m


def station_of(user_id: Column) -> Column:
    return user_id.cast("string")


def tier_file_name(tier: str, station: Column) -> Column:
    return F.concat(station, F.lit("/ogd-smn_"), station, F.lit(TIER_FILE_SUFFIX[tier]))


def tier_loaded_at(tier: str) -> Column:
    return ntz(TIER_LOADED_AT[tier]) + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("user_id") % 60).cast("int")
    )


def _window(df: DataFrame, tier: str) -> DataFrame:
    lo, hi = TIER_WINDOWS[tier]
    if lo is not None:
        df = df.filter(F.col("ts") >= ntz(lo))
    if hi is not None:
        df = df.filter(F.col("ts") < ntz(hi))
    return df


def bronze_tier(events: DataFrame, tier: str) -> DataFrame:
    """One bronze measurement tier (33 columns) from its slice of events."""
    e = _window(events, tier)
    station = station_of(F.col("user_id"))
    m = measure_columns()
    return e.select(
        station.alias("station_abbr"),
        floor_minutes("ts", 10).alias("reference_timestamp"),
        *[m[c].alias(c) for c in MEASURE_CODES],
        tier_file_name(tier, station).alias("file_name"),
        tier_loaded_at(tier).alias("loaded_at"),
    ).select(*BRONZE_COLUMNS)


def bronze_tiers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = fact_table(spark, sf_dir, "events")
    return {t: bronze_tier(events, t) for t in TIER_WINDOWS}


def bronze_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze station table (26 columns) from customer x nation."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    elev = F.col("c_acctbal").cast("decimal(10,2)")
    region = F.col("n_regionkey")
    expo = F.concat(F.lit("exposition-"), region.cast("string"))

    def url(lang: str) -> Column:
        return F.concat(F.lit("https://stations.example/"), key.cast("string"), F.lit("/" + lang))

    out = j.select(
        key.cast("string").alias("station_abbr"),
        F.col("c_name").alias("station_name"),
        F.col("n_name").alias("station_canton"),
        F.concat(F.lit("0-20000-0-"), key.cast("string")).alias("station_wigos_id"),
        seg.alias("station_type_de"),
        seg.alias("station_type_fr"),
        seg.alias("station_type_it"),
        seg.alias("station_type_en"),
        F.concat(F.lit("owner-"), region.cast("string")).alias("station_dataowner"),
        F.date_add(F.lit(dt.date(1980, 1, 1)), (key % 10000).cast("int")).alias("station_data_since"),
        elev.alias("station_height_masl"),
        (elev + F.lit(2)).cast("decimal(10,2)").alias("station_height_barometer_masl"),
        (F.lit(2600000) + key).cast("decimal(12,2)").alias("station_coordinates_lv95_east"),
        (F.lit(1200000) + F.col("c_nationkey") * 1000).cast("decimal(12,2)").alias("station_coordinates_lv95_north"),
        F.when(F.col("c_acctbal") >= 0, (F.lit(45) + region).cast("decimal(10,6)")).alias(
            "station_coordinates_wgs84_lat"
        ),
        (F.lit(6) + region).cast("decimal(10,6)").alias("station_coordinates_wgs84_lon"),
        expo.alias("station_exposition_de"),
        expo.alias("station_exposition_fr"),
        expo.alias("station_exposition_it"),
        expo.alias("station_exposition_en"),
        url("de").alias("station_url_de"),
        url("fr").alias("station_url_fr"),
        url("it").alias("station_url_it"),
        url("en").alias("station_url_en"),
        F.lit(STATION_FILE).alias("file_name"),
        (ntz(STATIONS_LOADED_AT) + F.make_dt_interval(F.lit(0), F.lit(0), (key % 1000).cast("int"))).alias(
            "loaded_at"
        ),
    )
    return out.select(*STATION_COLUMNS, "file_name", "loaded_at")


# --- raw CSV text ------------------------------------------------------------

def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _ts_text(ts: Column) -> Column:
    """``dd.MM.yyyy HH:mm`` of ``ts`` floored to 10 minutes, built from
    calendar parts (time-zone free)."""
    m = F.minute(ts)
    return F.concat(
        _two(F.dayofmonth(ts)), F.lit("."), _two(F.month(ts)), F.lit("."), F.year(ts).cast("string"),
        F.lit(" "), _two(F.hour(ts)), F.lit(":"), _two(m - m % 10),
    )


def raw_csv_lines(spark: SparkSession, sf_dir: str, tier: str | None = None, where: Column | None = None) -> DataFrame:
    """Every event (of ``tier``'s slice and ``where``, if given) as one measurement CSV line (``line``) plus the file it
    would come from (``file_name``).  Rules by ``event_id``:

    * %101 = 0: station code of 11 characters (row rejected)
    * %89 = 0: impossible timestamp text (row rejected)
    * %83 = 0: empty timestamp (row kept, NULL timestamp)
    * %5 = 0: station code padded with blanks (trimmed)
    * temperature: %7 '-', %11 'NULL', %13 'abc' (NULL, row kept), %17 quoted
    * wind speed: %19 an 11th decimal digit 5 (rounds half-up)
    * %31 = 0: short row (only two fields); %37 = 0: two extra fields
    """
    e = fact_table(spark, sf_dir, "events")
    if tier is not None:
        e = _window(e, tier)
    if where is not None:
        e = e.filter(where)
    eid = F.col("event_id")
    m = measure_columns()
    station = station_of(F.col("user_id"))

    def txt(code: str) -> Column:
        return F.coalesce(m[code].cast("string"), F.lit(""))

    st = F.when(eid % 101 == 0, F.lit("ABCDEFGHIJK")).otherwise(station)
    st = F.when(eid % 5 == 0, F.concat(F.lit("  "), st, F.lit(" "))).otherwise(st)
    ts_txt = (
        F.when(eid % 89 == 0, F.lit("31.02.2024 x"))
        .when(eid % 83 == 0, F.lit(""))
        .otherwise(_ts_text(F.col("ts")))
    )
    temp = txt("tre200s0")
    temp = (
        F.when(eid % 7 == 0, F.lit("-"))
        .when(eid % 11 == 0, F.lit("NULL"))
        .when(eid % 13 == 0, F.lit("abc"))
        .when(eid % 17 == 0, F.concat(F.lit('"'), temp, F.lit('"')))
        .otherwise(F.concat(F.lit(" "), temp, F.lit(" ")))
    )
    wind = F.when(eid % 19 == 0, F.concat(txt("fkl010z1"), F.lit("5"))).otherwise(txt("fkl010z1"))
    fields = []
    for code in MEASURE_CODES:
        if code == "tre200s0":
            fields.append(temp)
        elif code == "fkl010z1":
            fields.append(wind)
        else:
            fields.append(txt(code))
    full = F.concat_ws(";", st, ts_txt, *fields)
    line = (
        F.when(eid % 31 == 0, F.concat_ws(";", st, ts_txt))
        .when(eid % 37 == 0, F.concat(full, F.lit(";extra1;extra2")))
        .otherwise(full)
    )
    return e.select(line.alias("line"), tier_file_name("now", station).alias("file_name"))


# --- upsert pair -------------------------------------------------------------

def upsert_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, source): target = older lineitems, source = newer lineitems
    with a corrected quantity; the slices overlap by one year."""
    li = fact_table(spark, sf_dir, "lineitem")
    target = li.filter(F.col("l_shipdate") < ntz(UPSERT_TARGET_BEFORE))
    source = li.filter(F.col("l_shipdate") >= ntz(UPSERT_SOURCE_FROM)).withColumn(
        "l_quantity", F.col("l_quantity") + F.lit(1.0)
    )
    return target, source


def upsert_order() -> list[Column]:
    """Source tie-break: newest ship date first."""
    return [F.col("l_shipdate").desc_nulls_last()]


# --- files and catalogue -------------------------------------------------------

def tier_files(tiers: dict[str, DataFrame]) -> DataFrame:
    """Load ledger analogue: one row per (tier, file) with row count and load time."""
    out = None
    for tier, df in tiers.items():
        g = df.groupBy("file_name").agg(
            F.count(F.lit(1)).alias("rows_loaded"), F.max("loaded_at").alias("loaded_at")
        ).withColumn("data_tier", F.lit(tier))
        out = g if out is None else out.unionByName(g)
    return out.select("data_tier", "file_name", "rows_loaded", "loaded_at")


def catalogue_pages(tiers: dict[str, DataFrame]) -> DataFrame:
    """One JSON catalogue page per station listing its files (name-ordered)
    as assets; stations with several files exercise the asset choice."""
    files = None
    for df in tiers.values():
        f = df.select("station_abbr", "file_name").distinct()
        files = f if files is None else files.unionByName(f)
    files = files.distinct().withColumn(
        "asset_name", F.element_at(F.split("file_name", "/"), -1)
    )
    per_station = files.groupBy("station_abbr").agg(
        F.array_sort(F.collect_list(F.struct("asset_name", "file_name"))).alias("a")
    )
    assets = F.map_from_entries(
        F.transform(
            "a",
            lambda x: F.struct(
                x["asset_name"],
                F.struct(F.concat(F.lit("https://files.example/"), x["file_name"]).alias("href")),
            ),
        )
    )
    feature = F.struct(
        F.col("station_abbr").alias("id"),
        F.struct(F.concat(F.lit("Station "), F.col("station_abbr")).alias("title")).alias("properties"),
        assets.alias("assets"),
    )
    page = F.struct(F.array(feature).alias("features"), F.array().cast("array<struct<rel:string>>").alias("links"))
    return per_station.select(F.to_json(page).alias("json"))


def paged_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue per nation, one page per customer in key order: page k
    (from 0) was asked for with cursor ``c<k>`` (the first with none) and links
    to the next.  Faults by nation number modulo 4:

    * 1: page 5 has not landed; 2: page 7 links back to page 3; 3: page 4
      landed twice."""
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    c = table(spark, sf_dir, "customer")
    c = c.select("c_nationkey", "c_custkey", (F.row_number().over(w) - 1).alias("k"), F.lead("c_custkey").over(w).alias("later"))
    fault = F.col("c_nationkey") % 4
    c = c.filter(~((fault == 1) & (F.col("k") == 5)))
    onward = F.when((fault == 2) & (F.col("k") == 7), F.lit("c3")).when(F.col("later").isNotNull(), F.concat(F.lit("c"), (F.col("k") + 1).cast("string")))
    c = c.withColumn("copy", F.explode(F.when((fault == 3) & (F.col("k") == 4), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    link = F.struct(F.lit("next").alias("rel"), F.struct(onward.alias("cursor")).alias("body"))
    links = F.when(onward.isNotNull(), F.array(F.struct(F.lit("self").alias("rel"), F.struct(F.lit("x").alias("cursor")).alias("body")), link))
    page = F.struct(F.array(F.struct(F.col("c_custkey").cast("string").alias("id"))).alias("features"), F.coalesce(links, F.array().cast("array<struct<rel:string,body:struct<cursor:string>>>")).alias("links"))
    cursor = F.when(F.col("k") > 0, F.concat(F.lit("c"), F.col("k").cast("string")))
    return c.select(F.col("c_nationkey").alias("catalogue"), cursor.alias("cursor"), F.to_json(page).alias("json"))


def _date_text(d: Column) -> Column:
    return F.concat(_two(F.dayofmonth(d)), F.lit("."), _two(F.month(d)), F.lit("."), F.year(d).cast("string"))


def station_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as one 24-field station CSV line (``line``).  Rules by
    ``c_custkey``: %7 impossible date (NULL, kept), %11 empty latitude,
    negative balance '-' latitude (both NULL -> Incomplete), %13 height 'abc'
    (NULL, kept), %19 name of 201 characters and %23 canton of 15 characters
    (both rejected)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
    key = F.col("c_custkey")
    ks = key.cast("string")
    region = F.col("n_regionkey").cast("string")
    elev = F.col("c_acctbal").cast("decimal(10,2)")
    since = F.date_add(F.lit(dt.date(1980, 1, 1)), (key % 10000).cast("int"))
    expo = F.concat(F.lit("exposition-"), region)
    seg = F.col("c_mktsegment")

    def url(lang: str) -> Column:
        return F.concat(F.lit("https://stations.example/"), ks, F.lit("/" + lang))

    fields = [
        ks,
        F.when(key % 19 == 0, F.repeat(F.lit("x"), 201)).otherwise(F.col("c_name")),
        F.when(key % 23 == 0, F.lit("CANTON_TOO_LONG")).otherwise(F.col("n_name")),
        F.concat(F.lit("0-20000-0-"), ks),
        seg, seg, seg, seg,
        F.concat(F.lit("owner-"), region),
        F.when(key % 7 == 0, F.lit("31.02.1990")).otherwise(_date_text(since)),
        F.when(key % 13 == 0, F.lit("abc")).otherwise(elev.cast("string")),
        (elev + F.lit(2)).cast("decimal(10,2)").cast("string"),
        (F.lit(2600000) + key).cast("string"),
        (F.lit(1200000) + F.col("c_nationkey") * 1000).cast("string"),
        F.when(key % 11 == 0, F.lit(""))
        .when(F.col("c_acctbal") >= 0, (F.lit(45) + F.col("n_regionkey")).cast("string"))
        .otherwise(F.lit("-")),
        (F.lit(6) + F.col("n_regionkey")).cast("string"),
        expo, expo, expo, expo,
        url("de"), url("fr"), url("it"), url("en"),
    ]
    return j.select(F.concat_ws(";", *fields).alias("line"), F.lit(STATION_FILE).alias("file_name"))
