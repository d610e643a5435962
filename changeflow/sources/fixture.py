"""A dirty change feed derived from the ``events`` table, row by row, for the registry, tests and benchmark.

Every event becomes one delivery, and every tenth a second one (a replay). The modulo rules below do not pick
rows to work on; they decide which defect a delivery carries. FIXTURES.md lists the rules and golden counts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.sources import landing

REPLAY_OFFSET = 10_000_000
PAGE_SIZE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _member(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), value.cast("string"))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_raw_id, _raw, _window_start, _window_end, _ingested_at, page_no`` plus the ``replay`` marker."""
    e, u, v, replay = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("replay")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    rounds = F.when(e % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))

    kinds = F.create_map(
        *[
            F.lit(x)
            for pair in {
                "click": "edit",
                "view": "new",
                "signup": "log",
                "purchase": "categorize",
                "error": "external",
            }.items()
            for x in pair
        ]
    )
    clock = "yyyy-MM-dd'T'HH:mm:ss"
    stamp, ahead = F.date_format(ts, clock), F.date_format(ts + F.expr("interval 2 hours"), clock)
    members = [
        F.when(e % 3 == 0, _member("anon", F.lit("true"))),
        F.when(e % 7 == 0, _member("bot", F.lit("true"))).when(e % 7 == 1, _member("bot", F.lit("false"))),
        _member(
            "comment",
            F.when(replay == 1, F.lit('"replay"'))
            .when(e % 6 == 0, F.lit('""'))
            .otherwise(_quoted(F.concat(F.lit("c"), k))),
        ),
        F.when(e % 5 == 0, _member("minor", F.lit("null"))),
        _member("newlen", 1000 + F.floor(v)),
        _member("ns", F.when(e % 41 == 0, F.lit('"x"')).otherwise((k % 17 - 1).cast("string"))),
        F.when(e % 8 != 3, _member("old_revid", 200_000 + e)),
        F.when(e % 11 != 0, _member("oldlen", 1000 + u)),
        F.when(e % 43 == 0, _member("pageid", F.lit('"p"'))).when(e % 9 != 0, _member("pageid", 500 + k)),
        F.when(e % 97 == 13, _member("rcid", F.lit('"abc"'))).when(e % 101 != 17, _member("rcid", e)),
        F.when(e % 17 == 0, _member("redirect", F.lit('""'))),
        F.when(e % 8 != 3, _member("revid", 300_000 + e)),
        F.when(
            e % 4 == 0,
            _member(
                "tags",
                F.when(e % 3 == 0, F.lit("[]")).when(e % 3 == 1, F.lit('["t1"]')).otherwise(F.lit('["t1","t2"]')),
            ),
        ).when(e % 4 == 1, _member("tags", F.lit('"t"'))),
        F.when(
            e % 83 != 3,
            _member(
                "timestamp",
                _quoted(
                    F.when(e % 89 == 5, stamp)
                    .when(e % 13 == 6, F.concat(ahead, F.lit("+02:00")))
                    .otherwise(F.concat(stamp, F.lit("Z")))
                ),
            ),
        ),
        _member("title", _quoted(F.concat(F.lit("Page "), k))),
        _member("type", _quoted(kinds[F.col("event_type")])),
        F.when(e % 20 == 10, _member("user", F.lit('""'))).when(
            e % 20 != 0, _member("user", _quoted(F.concat(F.lit("u"), u)))
        ),
        F.when(e % 19 == 0, _member("userhidden", F.lit('""'))),
        _member("userid", u),
    ]
    day = F.date_trunc("day", ts)
    start = F.when(e % 50 == 7, day + F.expr("interval 1 day")).otherwise(day)
    # what a delivery is made of moves, not the delivery: its text is several times as long
    feed = (
        table(spark, sf_dir, "events")
        .withColumn("replay", F.explode(rounds))
        .withColumns({"_window_start": start, "_event": e})
    )
    # pages are cut by id within a window, originals first, so that none exceeds PAGE_SIZE records; a window's pages are
    # numbered over the cuts that hold events, as events moved in from the day before have no replays
    low = feed.groupBy("_window_start").agg(F.min("_event").alias("_low"))
    cut = feed.join(F.broadcast(low), "_window_start").withColumn("_cut", F.expr(f"(_event - _low) div {PAGE_SIZE}"))
    place = ["_window_start", "replay", "_cut"]
    number = F.row_number().over(W.partitionBy("_window_start").orderBy("replay", "_cut"))
    numbered = cut.select(place).distinct().withColumn("page_no", number.cast("long"))
    # spread by page, as pages land; the events file alone would make one or two tasks
    numbered_feed = cut.join(numbered, place).repartition("_window_start", "page_no")
    return numbered_feed.select(
        F.when(replay == 1, e + REPLAY_OFFSET + 1).otherwise(e + 1).alias("_raw_id"),
        F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("_raw"),
        "_window_start",
        (F.col("_window_start") + F.expr("interval 1 day")).alias("_window_end"),
        (F.col("_window_start") + F.make_dt_interval(1 + replay)).alias("_ingested_at"),
        "replay",
        "page_no",
    )


def pages(feed: DataFrame, faults: bool = True) -> DataFrame:
    """The deliveries packed into source pages, at most PAGE_SIZE records each.

    Every page but the last of its window says that more follow. With ``faults``, the last page of every
    seventh calendar day still says so, and some pages carry an error.
    """
    packed = (
        feed.groupBy("_window_start", "_window_end", "page_no")
        .agg(F.array_sort(F.collect_list(F.struct("_raw_id", "_raw"))).alias("records"))
        .withColumn("members", F.concat_ws(",", F.col("records._raw")))
    )
    last = feed.groupBy(F.col("_window_start").alias("_w")).agg(F.max("page_no").alias("last_page"))
    more = F.col("page_no") < F.col("last_page")
    error = F.lit(False)
    if faults:
        more = more | (F.dayofmonth("_window_start") % 7 == 0)
        error = (F.dayofmonth("_window_start") + F.col("page_no")) % 11 == 0
    body = F.concat(
        F.lit("{"),
        F.when(more, F.concat(F.lit('"continue":{"rccontinue":"'), F.col("page_no"), F.lit('"},'))).otherwise(F.lit("")),
        F.when(error, F.concat(F.lit('"error":{"code":"busy","page":'), F.col("page_no"), F.lit("},"))).otherwise(
            F.lit("")
        ),
        F.lit('"query":{"recentchanges":['),
        F.col("members"),
        F.lit("]}}"),
    )
    return packed.join(last, F.col("_window_start") == F.col("_w")).select(
        "_window_start", "_window_end", "page_no", body.alias("body")
    )


def disturbed_lines(feed: DataFrame) -> DataFrame:
    """Landed lines of a bad run, by day of the month and page number: pages and whole windows that did not land, pages
    with an error of which some were fetched again an hour later, good pages of which an older error copy exists, and
    lines that are no page."""
    day, n = F.dayofmonth("_window_start"), F.col("page_no")
    fetched = pages(feed).withColumn("fetched_at", F.col("_window_end"))
    clean = pages(feed, faults=False)
    again = clean.filter(((day + n) % 11 == 0) & (day % 2 == 0)).withColumn("fetched_at", F.col("_window_end") + F.expr("interval 1 hour"))
    body = F.lit('{"error":{"code":"late"}}')
    stale = clean.filter(day % 8 == 3).withColumn("body", body).withColumn("fetched_at", F.col("_window_start"))
    landed = fetched.unionByName(again).unionByName(stale).filter(((day * 3 + n) % 13 != 0) & (day % 10 != 5))
    broken = feed.select("_window_start").distinct().filter(day % 9 == 0).select(F.concat(F.lit("{broken "), day).alias("value"))
    return landed.select(landing.landed_line(F.col("body"), F.col("fetched_at")).alias("value")).unionByName(broken)


def untyped_keys(feed: DataFrame) -> DataFrame:
    """The deliveries with every seventieth event's key negative: a natural key, but none that staging types."""
    key = F.regexp_extract("_raw", '"rcid":([0-9]+)', 1)
    negative = F.regexp_replace("_raw", '"rcid":([0-9]+)', '"rcid":"-$1"')
    return feed.withColumn("_raw", F.when(key.try_cast("long") % 70 == 0, negative).otherwise(F.col("_raw")))


def damaged_raw(raw: DataFrame) -> DataFrame:
    """Raw rows of which some break a constraint, by row id."""
    n = F.col("_raw_id")
    return raw.withColumns(
        {
            "_raw": F.when(n % 97 != 0, F.col("_raw")),
            "_window_end": F.when(n % 89 == 0, F.col("_window_start")).otherwise(F.col("_window_end")),
            "_ingested_at": F.when(n % 83 != 0, F.col("_ingested_at")),
        }
    )


def mutated_raw(raw: DataFrame) -> DataFrame:
    """A later snapshot of raw that breaks the append-only rule: some payloads changed, some rows gone."""
    n = F.col("_raw_id")
    return raw.filter(n % 77 != 0).withColumn(
        "_raw", F.when(n % 50 == 0, F.replace("_raw", F.lit('"comment":"'), F.lit('"comment":"edited '))).otherwise(F.col("_raw"))
    )


def mutated_days(raw: DataFrame) -> DataFrame:
    """The same later snapshot, broken on the days of the month 3, 13 and 23 only; ``_event_date`` tells the day."""
    n, hit = F.col("_raw_id"), F.dayofmonth("_event_date") % 10 == 3
    edited = F.replace("_raw", F.lit('"comment":"'), F.lit('"comment":"edited '))
    return raw.filter(~(hit & (n % 77 == 0))).withColumn("_raw", F.when(hit & (n % 50 == 0), edited).otherwise(F.col("_raw")))


def damaged_mart(mart: DataFrame) -> DataFrame:
    """A mart of which some rows have a negative counter or a rate above one."""
    day = F.dayofmonth("activity_date")
    return mart.withColumns(
        {
            "log_count": F.when(day % 5 == 0, -1 - F.col("log_count")).otherwise(F.col("log_count")),
            "bot_rate": F.when(F.col("namespace_id") == 4, F.col("bot_rate") + 1).otherwise(F.col("bot_rate")),
        }
    )
