import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from hitloom.llm import warc
from hitloom.llm.warc import archive_pages, read_archives, write_archives

BIG = "<p>" + "long page " * 50_000 + "</p>"
PAGES = [
    (1, "http://a/1", "<html>same</html>"),
    (2, None, "<html>same</html>"),
    (3, "http://a/\r\nInjected: yes", "ünï 😀\r\n\r\nWARC/1.1\r\n"),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", BIG),
    (7, "http://a/7", BIG),
    (7, "http://a/7", BIG),
    (None, "http://a/none", "<html>same</html>"),
    (9, "http://a/9", "only"),
    (9, "http://a/9", "only"),
    (None, None, "without any id"),
    (None, None, "without any id"),
]
MANY = [(100 + i, f"http://b/{i}", f"<html><body>page {i} of many, {'text ' * (i % 40)}</body></html>") for i in range(400)]


def pages(spark, rows):
    full = [(i, u, h, "x", 1, "y") for i, u, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, sha1 string, first int, payload string")


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if i is not None and len(data) >= least:
            first[data] = min(first.get(data, i), i)
    made = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = data in first and (i is None or first[data] < i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        made.append((i, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    return sorted(made, key=str)


def result(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=str)


def test_round_trip(spark):
    rows = PAGES + MANY
    back = archive_pages(pages(spark, rows), payloads=True).cache()
    assert result(back) == expected(rows)
    stored = {r.page_id: r.payload for r in back.filter("record_type = 'response' and page_id is not null").collect()}
    want = {i: (h or "").encode() for i, _, h in rows if i is not None}
    assert all(bytes(v) == want[k] for k, v in stored.items())
    url = back.filter("page_id = 3").first().url
    assert "\r" not in url and url.endswith("%0D%0AInjected: yes")


def test_record_ids_are_unique_and_text_ids_come_back(spark, tmp_path):
    rows = [("a/b c", "u", "same"), ("ünï\r\nX: y", "u", "same"), (None, "u", "same"), ("a/b c", "u", "other"), ("a/b c", "u", "other")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    manifest = write_archives(df, f"{tmp_path}/w")
    heads = [warc.parse_record(data)[0] for m in manifest.collect() for _, data in warc.archive_records(m.path)]
    assert len({h["warc-record-id"] for h in heads}) == len(heads) >= len(rows)
    back = read_archives(spark, manifest, id_type="string").select("page_id", "record_type", "refers_to")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [
            ("a/b c", "response", None),
            ("ünï\r\nX: y", "revisit", "a/b c"),
            (None, "revisit", "a/b c"),
            ("a/b c", "response", None),
            ("a/b c", "response", None),
        ],
        key=str,
    )


def test_small_payloads_are_never_revisits(spark):
    assert result(archive_pages(pages(spark, PAGES), min_revisit_bytes=1000)) == expected(PAGES, 1000)


def test_archive_has_a_dictionary_in_front_and_one_frame_per_record(spark, tmp_path):
    manifest = write_archives(pages(spark, MANY).coalesce(1), f"file://{tmp_path}/w").collect()
    assert sum(m.records for m in manifest) == len(MANY)
    path = manifest[0].path.removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    offsets = [r.offset for r in read_archives(spark, spark.createDataFrame(manifest, warc.MANIFEST)).collect()]
    for offset in offsets[::50]:
        record = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[offset:])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    whole = sum(len(h) for _, _, h in MANY)
    assert manifest[0].file_bytes == len(data) < whole


def test_archives_roll_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    manifest = write_archives(pages(spark, MANY).coalesce(1), f"{tmp_path}/w")
    assert manifest.count() > 5
    assert result(read_archives(spark, manifest)) == expected(MANY)


def test_a_changed_payload_is_noticed(spark, tmp_path, monkeypatch):
    manifest = write_archives(pages(spark, PAGES[:1]), f"{tmp_path}/w")
    good = warc.parse_record

    def bad(data):
        headers, block = good(data)
        return headers, block.replace(b"same", b"sane")

    monkeypatch.setattr(warc, "parse_record", bad)
    with pytest.raises(Exception, match="does not have its digest"):
        read_archives(spark, manifest).collect()


def test_an_archive_that_ends_early_is_noticed(spark, tmp_path):
    path = write_archives(pages(spark, MANY).coalesce(1), f"{tmp_path}/w").first().path
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-3])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.archive_records(path))


def test_empty_table(spark):
    back = archive_pages(pages(spark, []))
    assert back.agg(F.count("*")).first()[0] == 0
