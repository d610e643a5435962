from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import inserts
from changeflow.operators.validation import classify, valid_records

from .helpers import plan_of, raw_table, record


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "k long, n long")


def test_first_writer_wins_and_known_keys_stay(spark):
    incoming = keyed(spark, [(1, 5), (1, 3), (2, 4), (3, 9), (3, 8)])
    existing = keyed(spark, [(2, 0)])
    got = sorted(tuple(r) for r in inserts.insert_if_absent(incoming, existing, "k", ["n"]).collect())
    assert got == [(1, 3), (3, 8)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12), max_size=40), st.integers(0, 40))
def test_loading_in_two_parts_stores_what_one_load_stores(spark, keys, cut):
    rows = [(k, n) for n, k in enumerate(keys)]
    first = inserts.first_per_key(keyed(spark, rows[:cut]), "k", ["n"])
    second = inserts.insert_if_absent(keyed(spark, rows), first, "k", ["n"])
    plain = {}
    for k, n in rows:
        plain.setdefault(k, n)
    assert {r["k"]: r["n"] for r in first.union(second).collect()} == plain


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    first = inserts.first_per_key(hot, "k", ["n"])
    lines = plan_of(first).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
    assert exchange < partial
    assert first.count() == 20000 and first.filter("k = 1").first()["n"] == 0


def test_history_is_cut_by_range_and_by_keys(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("payload")).write.parquet(path)
    history = inserts.in_ranges(spark.read.parquet(path), "k", [(10, 20)])
    new = inserts.insert_if_absent(keyed(spark, [(15, 1), (2000, 2)]), history, "k", ["n"])
    plan = plan_of(new)
    assert "GreaterThanOrEqual(k,10)" in plan and "LessThanOrEqual(k,20)" in plan
    assert "ReadSchema: struct<k:bigint>" in plan
    assert "LeftSemi" in plan and "LeftAnti" in plan
    assert [r["k"] for r in new.collect()] == [2000]


def test_copies_and_known_keys_move_without_their_payload(spark, tmp_path):
    path = str(tmp_path / "incoming")
    rows = [(n % 40, n, "x" * 2000) for n in range(400)]
    spark.createDataFrame(rows, "k long, n long, payload string").write.parquet(path)
    history = keyed(spark, [(k, 0) for k in range(30)])
    new = inserts.insert_if_absent(spark.read.parquet(path), history, "k", ["n"])
    # one scan reads the payload; those that decide read keys and arrival only
    schemas = [s.split("\n")[0] for s in plan_of(new).split("ReadSchema: ")[1:]]
    assert schemas.count("struct<k:bigint,n:bigint,payload:string>") == 1 and len(schemas) > 1
    assert sorted((r["k"], r["n"]) for r in new.collect()) == [(k, k) for k in range(30, 40)]


def test_no_range_matches_nothing(spark):
    assert inserts.in_ranges(keyed(spark, [(1, 1)]), "k", []).count() == 0
    assert inserts.in_ranges(keyed(spark, [(1, 1), (5, 1), (9, 1)]), "k", [(0, 2), (8, 9)]).count() == 2


def test_ids_rise_in_arrival_order_from_the_first_free_one(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("page"), F.col("id").alias("pos"))
    numbered = inserts.number_rows(rows, "n", 100, ["page", "pos"], 5000)
    ids = [r["n"] for r in numbered.orderBy("page", "pos").collect()]
    assert ids[0] >= 100 and all(a < b for a, b in zip(ids, ids[1:]))
    assert ids[-1] < 100 + inserts.id_span(rows, 5000) == 100 + 8 * 5000


def test_constraints_name_every_breach(spark):
    raw = raw_table(spark, [record(1), None]).withColumn(
        "_window_end", F.when(F.col("_raw_id") == 2, F.col("_window_start")).otherwise(F.col("_window_end"))
    )
    got = sorted(tuple(r) for r in inserts.constraint_violations(raw).collect())
    assert got == [(2, "_raw not null"), (2, "window order")]


def test_counters_add_up(spark):
    raw = raw_table(spark, [record(1), record(1), record(2), record(3, hour=30), {"rcid": "x"}, {"rcid": "x"}])
    judged = classify(raw.withColumn("page_no", F.lit(1)))
    new = inserts.first_per_key(valid_records(judged), "_key", ["_raw_id"])
    bad = judged.filter("status = 'error'").limit(1)
    empty_page = judged.limit(1).withColumn("page_no", F.lit(2))
    stats = inserts.load_stats(judged, new, bad, pages=empty_page.unionByName(judged.limit(1)))
    by_page = {r["page_no"]: r.asDict() for r in stats.collect()}
    assert {k: by_page[1][k] for k in inserts.COUNTERS} == {
        "fetched": 6,
        "inserted": 2,
        "duplicates": 1,
        "quarantined": 1,
        "outside_window": 1,
        "pages": 1,
    }
    assert by_page[2]["fetched"] == 0 and by_page[2]["pages"] == 1
    total = inserts.total_stats(stats).first()
    assert (total["fetched"], total["pages"]) == (6, 2)
    assert inserts.total_stats(stats.filter("false")).first()["fetched"] == 0


def test_golden_counts(spark, sf_dir):
    from changeflow.plans.registry import QUERIES

    total = QUERIES["load_stats_total"](spark, sf_dir).first()
    assert (total["fetched"], total["inserted"], total["duplicates"], total["outside_window"]) == (1100, 935, 96, 19)
