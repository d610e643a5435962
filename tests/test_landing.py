import json
from datetime import timedelta

from changeflow.operators import gates
from changeflow.sources import landing

from .helpers import DAY, optimized, page, pages_frame, plan_of, record

NEXT = DAY + timedelta(days=1)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def line(body, n=1, start="2024-05-01T00:00:00Z", end="2024-05-02T00:00:00Z"):
    return json.dumps({"window_start": start, "window_end": end, "page": n, "body": body})


def test_records_come_out_as_sent_and_in_order(spark):
    texts = ['{"rcid":1.5,"b":{"z":1,"a":[]},"é":"ü\\n"}', '{"rcid":12345678901234567890}', "5", "null"]
    body = '{"query":{"recentchanges":[' + ", ".join(texts) + "]}}"
    landed = lines(spark, line("BODY").replace('"BODY"', body))
    rows = landing.only_records(landing.page_records(landing.parse_pages(landed))).orderBy("pos").collect()
    assert [r["_raw"] for r in rows] == texts
    assert [r["pos"] for r in rows] == [0, 1, 2, 3] and rows[0]["page_no"] == 1


def test_pages_without_records_are_empty_and_not_lost(spark):
    bodies = [{}, {"query": {}}, {"query": None}, {"query": {"recentchanges": []}}, {"query": {"other": [1]}}]
    pages = landing.parse_pages(lines(spark, *[line(b, n) for n, b in enumerate(bodies)]))
    rows = landing.page_records(pages)
    assert rows.count() == 5 and landing.only_records(rows).count() == 0
    assert landing.page_headers(rows).filter("readable").count() == 5


def test_unreadable_lines_are_reported(spark):
    bad = ["{broken", "", "[]", '{"page":1}', line(page([record()]), start="2024-05-01T00:00:00"), line({"query": {"recentchanges": {"a": 1}}})]
    pages = landing.parse_pages(lines(spark, line(page([record()])), *bad))
    assert pages.filter("not readable").count() == len(bad)
    assert gates.page_errors(pages).filter("reason = 'unreadable_page'").count() == len(bad)
    assert landing.only_records(landing.page_records(pages)).count() == 1


def test_errors_are_found_by_key_not_by_value(spark):
    bodies = [page([], error={"code": "x"}), {"error": None}, page([record()])]
    pages = landing.parse_pages(lines(spark, *[line(b, n) for n, b in enumerate(bodies)]))
    got = {r["page_no"]: r["detail"] for r in gates.page_errors(pages).collect()}
    assert got == {0: '{"code":"x"}', 1: "null"}




def landed(spark, *triples):
    return landing.parse_pages(
        lines(
            spark,
            *[
                line(body, n, start.strftime("%Y-%m-%dT%H:%M:%SZ"), (start + timedelta(days=1)).strftime("%Y-%m-%dT%H:%M:%SZ"))
                for start, n, body in triples
            ],
        )
    )


def test_a_window_is_complete_if_its_last_page_says_so(spark):
    more = {"rccontinue": "x"}
    pages = landed(
        spark,
        (DAY, 1, page([record()], more)),
        (DAY, 2, page([record()], {})),
        (NEXT, 1, page([record()], more)),
        (NEXT, 2, page([record()], more)),
    )
    got = gates.incomplete_windows(pages).collect()
    assert [r["last_page"] for r in got] == [2] and got[0]["_window_start"].day == 2
    limited = {r["_window_start"].day: r["last_page"] for r in gates.pages_above_limit(pages, max_pages=1).collect()}
    assert limited == {1: 2, 2: 2}


def test_pages_before_the_first_bad_one_are_admitted(spark):
    pages = landed(
        spark,
        (DAY, 1, page([record(1)])),
        (DAY, 2, page([record(2)], error={"code": "busy"})),
        (DAY, 3, page([record(3)])),
        (NEXT, 1, page([record(4)])),
        (NEXT, 9, page([record(5)])),
    )
    rows = landing.page_records(pages)
    headers = landing.page_headers(rows)
    kept = gates.admit(rows, headers)
    assert sorted((r["_window_start"].day, r["page_no"]) for r in kept.collect()) == [(1, 1), (2, 1), (2, 9)]
    assert sorted((r["_window_start"].day, r["page_no"]) for r in gates.good_pages(rows).collect()) == [(1, 1), (1, 3), (2, 1), (2, 9)]
    gap = gates.page_gaps(headers).first()
    assert (gap["_window_start"].day, gap["first_missing"], gap["last_missing"]) == (2, 2, 8)


def test_the_newest_landing_of_a_page_counts(spark):
    def landing_of(n, at, body):
        text = line(body, n)
        return text[:-1] + f', "fetched_at": "{at}"}}' if at else text

    early, late = "2024-05-02T01:00:00Z", "2024-05-02T02:00:00Z"
    bad = page([record(9)], error={"code": "busy"})
    texts = [
        landing_of(1, early, bad), landing_of(1, late, page([record(1)])),
        landing_of(2, None, bad), landing_of(2, early, page([record(2)])),
        landing_of(3, early, page([record(30)])), landing_of(3, late, page([record(3)])),
        landing_of(4, early, page([record(4)])), landing_of(4, late, bad),
        landing_of(5, None, bad), landing_of(5, None, page([record(5)])),
        line(page([record(6)]), 6), "{broken",
    ]
    rows = landing.page_records(landing.parse_pages(lines(spark, *texts)))
    headers = landing.page_headers(rows)
    counted = landing.newest_landings(headers, headers)
    assert {r["page_no"]: r["has_error"] for r in counted.filter("readable").collect()} == {1: False, 2: False, 3: False, 4: True, 5: False, 6: False}
    assert counted.filter("not readable").count() == 1
    kept = landing.only_records(landing.newest_landings(rows, headers))
    assert sorted((r["page_no"], json.loads(r["_raw"])["rcid"]) for r in kept.collect()) == [(1, 1), (2, 2), (3, 3), (4, 9), (5, 5), (6, 6)]


def test_every_kind_of_violation_is_named(spark):
    pages = landed(
        spark,
        (DAY, 1, page([record(1)], {"c": 1})),
        (DAY, 4, page([record(2)], {"c": 1})),
        (NEXT, 1, page([record(3)], error={"code": "busy"})),
    )
    asked = spark.createDataFrame([(DAY, NEXT), (NEXT + timedelta(days=5), NEXT + timedelta(days=6))], "_window_start timestamp, _window_end timestamp")
    found = sorted((r["reason"], r["page_no"]) for r in gates.violations(pages, 3, asked).collect() if r["page_no"])
    assert found == [("incomplete_window", 4), ("page_gap", 2), ("page_limit", 4), ("source_error", 1)]
    assert gates.violations(pages, 3, asked).filter("reason = 'missing_window'").count() == 1


def test_landed_folders_are_pruned_by_window_date(spark, tmp_path):
    path = str(tmp_path / "landing")
    landing.write_pages(pages_frame(spark, [(DAY, 1, page([record(1)])), (NEXT, 1, page([record(2)]))]), path)
    one_day = landing.read_lines(spark, path, [NEXT.date()])
    assert "PartitionFilters: [isnotnull(window_date" in plan_of(one_day)
    rows = landing.only_records(landing.page_records(landing.parse_pages(one_day))).collect()
    assert [json.loads(r["_raw"])["rcid"] for r in rows] == [2]
    assert landing.parse_pages(landing.read_lines(spark, path)).count() == 2


def test_a_line_is_parsed_once(spark):
    rows = landing.page_records(landing.parse_pages(lines(spark, line(page([record()])))))
    assert optimized(landing.only_records(rows).filter("page_no < 5")).count("from_json") == 1
