import base64
import glob
import gzip
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from changeflow.llm import warc_chunks as wc
from check_oracles import compare, connect


def corpus():
    rng = random.Random(4)
    bodies = ["<p>same</p>", "", None, "é" * 1000, "x" * 200_000, "a\r\nb\r\n\r\nWARC/1.1\r\n", "".join(chr(rng.randrange(32, 300)) for _ in range(70_000))]
    rows = [(i, f"http://h{i}.org/é?q={i} #x\r\n", bodies[i % len(bodies)]) for i in range(40)]
    rows += [(3, "http://again", bodies[3]), (3, "http://again", bodies[3]), (None, None, bodies[0]), (None, "http://n", "only here")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).withColumn("sha1", F.lit("clash")).withColumn("id", F.lit(1))


def expected(rows, least=0):
    groups = defaultdict(list)
    for i, u, b in rows:
        body = (b or "").encode()
        key = body if len(body) >= least else object()
        groups[key].append((i is None, i or 0, u or "", i, body))
    out = []
    for members in groups.values():
        members.sort(key=lambda m: m[:3])
        for k, (_, _, _, i, body) in enumerate(members):
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            out.append((i, len(body), digest, "revisit" if k else "response", members[0][3] if k else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
@pytest.mark.parametrize("chunk", [64, 1 << 18])
def test_round_trip_says_what_a_plain_version_says(spark, least, chunk):
    rows = corpus()
    got = wc.round_trip(frame(spark, rows), least_bytes=least, chunk_bytes=chunk)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, least)


def test_chunks_read_back_are_the_payload_and_digests_grow(spark, tmp_path):
    rows = corpus()
    archives = wc.write_pages(frame(spark, rows), str(tmp_path / "w"), chunk_bytes=500)
    records = defaultdict(list)
    for r in wc.read(archives, chunk_bytes=700).filter("kind = 'response'").collect():
        records[r["record_id"]].append(r)
    bodies = {(b or "").encode() for _, _, b in rows}
    found = set()
    for chunks in records.values():
        chunks.sort(key=lambda r: r["chunk_no"])
        assert [c["chunk_no"] for c in chunks] == list(range(len(chunks))) and [c["is_last"] for c in chunks][:-1] == [False] * (len(chunks) - 1)
        body = b""
        for c in chunks:
            assert c["chunk_bytes"] == len(c["bytes"]) <= 700
            body += c["bytes"]
            assert c["digest_so_far"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert chunks[-1]["digest_so_far"] == chunks[-1]["payload_digest"] and chunks[-1]["n_bytes"] == len(body)
        found.add(bytes(body))
    assert found == bodies and len(records) == len(bodies)


def test_archives_are_gzip_members_with_the_fields_of_the_format(spark, tmp_path):
    wc.write_pages(frame(spark, [(1, "http://a", "x"), (2, "http://b", "x")]), str(tmp_path / "w"))
    whole = b"".join(gzip.open(p).read() for p in sorted(glob.glob(f"{tmp_path}/w/*.warc.gz")))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: response\r\n") == 1 and whole.count(b"WARC-Type: revisit\r\n") == 1
    for name in (b"WARC-Record-ID: <urn:", b"WARC-Date: ", b"WARC-Target-URI: http://a\r\n", b"WARC-Payload-Digest: sha1:", b"WARC-Refers-To: <urn:page:=1:1>"):
        assert name in whole


def test_files_left_by_a_lost_attempt_are_not_read(spark, tmp_path):
    archives = wc.write_pages(frame(spark, [(1, "u", "x")]), str(tmp_path / "w"))
    (tmp_path / "w" / "stray.warc.gz").write_bytes(b"broken")
    assert wc.read(archives).count() == 1


def test_a_broken_archive_is_an_error_not_a_short_result(spark, tmp_path):
    path = tmp_path / "bad.warc.gz"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:=1:1>\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 900\r\n\r\nHTTP/1.1 200 OK\r\n\r\nxyz"
    path.write_bytes(gzip.compress(head))
    with pytest.raises(Exception, match="ends within a record"):
        wc.read(spark.createDataFrame([(str(path),)], "path string")).collect()


def test_empty_table(spark):
    assert wc.round_trip(frame(spark, corpus()).limit(0)).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    good, note = compare(spark, connect(sf_dir), "op10_warc_chunks", sf_dir)
    assert good, note
    assert set(oracle_sql()) <= set(queries())
