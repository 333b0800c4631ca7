"""WARC bundles: round trips, the seek table, and which records are revisits."""

import io

import pytest
import zstandard

from saleslens.llm import warc_bundle as wb


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_bundle_is_plain_zstandard_with_a_seek_table():
    out, records = Bytes(), [bytes([i]) * (i * 300) for i in range(1, 40)]
    writer = wb.BundleWriter(out, frame_bytes=5000)
    places = [writer.add(r) for r in records]
    writer.close()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(records)
    reader = wb.BundleReader(out)
    assert len(reader.frames) > 5
    assert [reader.frame(f)[o:o + n] for f, o, n in places] == records


@pytest.mark.parametrize("payload", [b"", b"\r\n\r\n", b"WARC/1.1\r\n" * 3, "é".encode() * 9])
def test_record_round_trip(payload):
    first = wb.record_bytes("urn:page:7:ab", "http://a/\r\nX: é", payload, wb.bare_digest(payload), None)
    again = wb.record_bytes("urn:page:8:cd", "", payload, wb.bare_digest(payload), "urn:page:7:ab")
    (h1, _, p1), (h2, http, p2) = wb.parse_records(first + again)
    assert (p1, p2, h2["WARC-Type"], wb.page_of(h2["WARC-Refers-To"])) == (payload, b"", "revisit", 7)
    assert h1["WARC-Target-URI"] == "http://a/%0D%0AX: é" and int(http["Content-Length"]) == len(payload)


def test_odd_pages(spark, tmp_path):
    rows = [
        (5, "u", "same"), (3, "v", "same"), (3, "v", "same"), (9, None, None), (8, "w", ""), (None, "n", "same"), (None, "n", "alone"),
        (1, "x", "long" * 300_000), (2, "y", "é\r\n\r\n")]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS record_id", "3 AS _file", "4 AS _row").coalesce(1).write.parquet(path)
    pages = wb.with_row_ids(spark.read.parquet(path))
    index = wb.write_bundles(wb.decided(pages), str(tmp_path / "bundles"), frame_bytes=100)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in wb.read_bundles(index).collect()), key=str)
    want = [
        (5, 4, "revisit", 3), (3, 4, "response", None), (3, 4, "revisit", 3), (9, 0, "revisit", 8), (8, 0, "response", None),
        (None, 4, "revisit", 3), (None, 5, "response", None), (1, 1_200_000, "response", None), (2, 6, "response", None)]
    assert got == sorted(want, key=str)
    for r in index.collect():
        (head, _, _), = wb.parse_records(wb.fetch(r.bundle, r.frame, r.offset, r.length))
        assert head["WARC-Record-ID"] == f"<{r.record_id}>"
    few = wb.write_bundles(wb.decided(pages, min_payload=5), str(tmp_path / "few"))
    assert all(r.record_type == "response" for r in wb.read_bundles(few).collect())


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(path)
    index = wb.write_bundles(wb.decided(wb.with_row_ids(spark.read.parquet(path))), str(tmp_path / "b"))
    assert wb.read_bundles(index).count() == 0


def test_a_task_opens_a_bundle_once(spark, tmp_path):
    """Frames of a bundle lie side by side in the reading tasks."""
    path = str(tmp_path / "many")
    spark.createDataFrame([(i, "u", f"page {i} " * 40) for i in range(300)], "page_id long, url string, html string").repartition(3).write.parquet(path)
    index = wb.write_bundles(wb.decided(wb.with_row_ids(spark.read.parquet(path))), str(tmp_path / "out"), frame_bytes=1000)
    frames = index.select("bundle", "frame").distinct()
    bundles = index.select("bundle").distinct().count()
    parts = frames.repartitionByRange(max(1, frames.count() // wb.READ_FRAMES), "bundle", "frame")
    opened = parts.selectExpr("spark_partition_id() AS p", "bundle").distinct().count()
    assert frames.count() > 90 and opened <= parts.rdd.getNumPartitions() + bundles
    assert wb.read_bundles(index).count() == 300
    with pytest.raises(ValueError):
        wb.BundleWriter(None, frame_bytes=1 << 31)
