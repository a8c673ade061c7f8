"""Operator 13: exact round trips through written archives."""

import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from ranklight.llm import warc
from ranklight.llm.queries import QUERIES

ROWS = "page_id long, url string, html string"


def plain(rows):
    data = [(i, (html or "").encode()) for i, _, html in rows]
    largest = {}
    for i, body in data:
        largest[body] = max(largest.get(body, (False, 0)), (i is not None, i or 0))
    out, used = [], set()
    for i, body in data:
        there, first = largest[body]
        first = first if there else None
        repeats = len(body) >= 1000 and (i != first or (body, i) in used)  # of equal rows all but one
        if i == first:
            used.add((body, i))
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if repeats else "response", first if repeats else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"<p class='w{i}'>word{i}</p>" for i in range(400)]
    page = lambda n: "<html>" + "".join(rng.choice(words) for _ in range(n)) + "</html>"
    same, short = page(60), "x" * 999
    out = [(i, f"http://a.example/{i}?q=a b\r\nX: y", page(rng.randint(1, 90))) for i in range(600)]
    out += [(700 + i, "http://b.example/ü", same) for i in range(7)] + [(706, None, same), (None, None, same)]
    out += [(800, "", None), (801, None, ""), (802, "u", short), (803, "u", short), (804, "u", "é" * 500), (805, "u", "é" * 500)]
    return out + [(810, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (811, "u", "\x00🎉" * 300_000), (None, "z", "q" * 2000), (None, "z", "q" * 2000)]


def test_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    listed = warc.write(df, str(tmp_path / "w"), archive_bytes=1 << 20)
    files = {r.path: r for r in listed.collect()}
    back = warc.read(listed, str(tmp_path / "w"))
    assert got(back) == plain(rows)
    payloads = {(r.page_id, r.payload_digest): bytes(r.payload) for r in back.collect() if r.record_type == "response"}
    assert all(payloads[i, hashlib.sha1((h or "").encode()).hexdigest()] == (h or "").encode() for i, _, h in rows if i is not None and i < 600)
    assert sum(r.records for r in files.values()) == len(rows)
    assert any(r.dictionary_bytes > 0 for r in files.values())
    assert sorted(files) == sorted(p.name for p in (tmp_path / "w").iterdir() if p.name.endswith(".zst"))


def test_files_are_what_the_format_says(spark, rows, tmp_path):
    """A skippable frame with the dictionary first, then a frame for each record, read here by other means."""
    df = spark.createDataFrame([(i, u, h) for i, u, h in rows if i is not None and i < 600], ROWS).coalesce(1)
    listed = warc.write(df, str(tmp_path / "w"))
    data = (tmp_path / "w" / listed.first().path).read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    n = int.from_bytes(data[4:8], "little")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + n]))
    rest, kinds, reader = data[8 + n:], [], zstandard.ZstdDecompressor(dict_data=known)
    assert zstandard.get_frame_parameters(rest).dict_id == known.dict_id() != 0
    while rest:
        one = reader.decompressobj()
        record = one.decompress(rest)
        rest = one.unused_data
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
        head, _, tail = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert len(tail) == int(fields["Content-Length"]) + 4
        kinds.append(fields["WARC-Type"])
    assert kinds == ["warcinfo"] + ["response"] * 600
    alone = sum(len(zstandard.compress(h.encode(), warc.LEVEL)) for i, _, h in rows[:600])
    assert len(data) < alone + 112 * 1024


def test_small_archives_have_no_dictionary_and_damage_is_seen():
    records = [warc.page_record(i, i, "u", f"page {i}".encode(), None) for i in range(3)]
    data, known = warc.archive_bytes_of(records)
    assert known == 0 and data[:4] == warc.FRAME
    assert len(list(warc.records_of(io.BytesIO(data)))) == 3
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(data[:-3])))
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(b"abcd" + data)))


def test_empty_and_clashing(spark, rows, sf):
    df = spark.createDataFrame(rows, ROWS)
    assert warc.archive_and_read(df.limit(0)).count() == 0
    clash = df.withColumns({c: F.lit("extra") for c in "digest number d k first first_page path payload record_type".split()})
    assert got(warc.archive_and_read(clash)) == plain(rows)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert got(QUERIES["op13_warc_archive"](spark, sf)) == plain([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
