import io
import random

from depot.llm import warc


def test_ranges_own_each_record_once():
    rng = random.Random(1)
    bodies = [b"", b"x", rng.randbytes(70_000), warc.MAGIC * 500, *(rng.randbytes(rng.randint(1, 3000)) for _ in range(60)), b"y" * 3_000_000]
    bodies[5] = warc.member(99, "http://inner", b"a member within a payload", "D", None, False)
    raw = b"".join(warc.member(i, f"http://e/{i}\r\n%0A", b, warc.base32_sha1(b), None, False) for i, b in enumerate(bodies))
    whole = [(a, h["WARC-Record-ID"], p) for a, h, p in warc.records_of_range(io.BytesIO(raw), 0, len(raw))]
    assert [p for _, _, p in whole] == bodies
    for step in (997, 5000, 65_536, 1 << 20):
        parts = [(a, h["WARC-Record-ID"], p) for s in range(0, len(raw), step) for a, h, p in warc.records_of_range(io.BytesIO(raw), s, s + step)]
        ids = [x[1] for x in parts if x[1] != "<urn:page:99>"]
        assert ids == [x[1] for x in whole]


def test_write_and_read(spark):
    rows = [(3, "u3", "same"), (1, "u1", "same"), (2, "u2", "ö" * 5), (4, None, None), (5, "u5", ""), (None, "n", "same"), (2, "again", "ö" * 5), (6, "a\r\nb%0A", "z" * 2_000_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    manifest = warc.write_archives(df)
    got = warc.read_archives(manifest, split_bytes=700).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.url): r for r in got}
    assert by[1, "u1"].record_type == "response" and (by[3, "u3"].record_type, by[3, "u3"].refers_to) == ("revisit", 1)
    assert by[3, "u3"].payload is None and by[3, "u3"].payload_bytes == 4 and by[3, "u3"].payload_digest == warc.base32_sha1(b"same")
    assert (by[5, "u5"].record_type, by[5, "u5"].refers_to) == ("revisit", 4) and by[4, ""].payload_bytes == 0
    assert by[None, "n"].record_type == "response" and by[2, "again"].record_type == "response"
    assert bytes(by[6, "a\r\nb%0A"].payload) == b"z" * 2_000_000
    assert {r.record_type for r in warc.read_archives(warc.write_archives(df, min_bytes=5)).where("page_id in (1, 3, 5)").collect()} == {"response"}
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_ranges_are_read_by_many_tasks(spark):
    from pyspark.sql import functions as F
    df = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html")).repartition(2)
    got = warc.read_archives(warc.write_archives(df), split_bytes=500)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 400 and len(per_task) > 4 and max(per_task) < 200
