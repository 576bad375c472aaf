import base64
import gzip
import hashlib
import io
import os
import struct

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsift.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string, no int"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def restated(rows):
    """Sorted (page_id, bytes, digest, type, refers_to), from (page_id, html) rows."""
    by_payload = {}
    for page, html in rows:
        by_payload.setdefault((html or "").encode(), []).append(page)
    out = []
    for payload, pages in by_payload.items():
        pages.sort(key=lambda p: (p is None, p or 0))
        for i, p in enumerate(pages):
            out.append((p, len(payload), sha(payload), "revisit" if i else "response", pages[0] if i else None))
    return sorted(out, key=str)


def reported(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_query_on_the_whole_table(spark):
    import __spark_entry__ as ent
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/pages.parquet").select("page_id", "html").collect()]
    assert reported(ent.queries()["op13_warc"](spark, path)) == restated(rows)


def odd_pages():
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>") for i in range(60)]
    rows += [(100 + i, "http://hot/", "<html>the same page</html>" * 20) for i in range(200)]           # a hot group of copies
    rows += [(300, None, None), (301, "", ""), (302, "http://x/\r\nWARC-Type: response", "a\r\n\r\nb"), (None, "u", "<p>3</p>"), (None, "u", "only here")]
    rows += [(400, "http://r/", "twice")] * 3                                                             # repeated rows
    return rows + [(500, "http://long/", "é\x00" + "long text " * 300_000), (501, "http://long/", "<![foo[bar]]>")]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_pages(spark, tmp_path, parts):
    rows = odd_pages()
    df = pages_of(spark, rows).repartition(parts)
    assert reported(W.archived_pages(df, str(tmp_path))) == restated([(p, h) for p, _, h in rows])


def test_files_open_with_plain_zstandard(spark, tmp_path):
    """The archive as another program reads it: skippable dictionary frame, then a frame a record, in small archives."""
    rows = [(i, f"http://h/{i}", f"<html><body><div class='item'>page number {i} of the shop</div></body></html>" * 4) for i in range(400)]
    listed = W.write_archives(pages_of(spark, rows).coalesce(1), str(tmp_path), archive_bytes=8_000, sample_bytes=20_000).collect()
    assert len(listed) > 1 and sum(r["records"] for r in listed) == len(rows)
    seen = set()
    for r in listed:
        data = open(r["path"], "rb").read()
        assert len(data) == r["bytes"]
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D and size == r["dictionary_bytes"] and data[8:12] == b"\x37\xa4\x30\xec"
        shared = zstandard.ZstdCompressionDict(data[8:8 + size])
        rest = data[8 + size:]
        while rest:
            assert zstandard.get_frame_parameters(rest).dict_id == shared.dict_id()
            one = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
            record = one.decompress(rest)
            rest = one.unused_data
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            if b"\r\nWARC-Type: response" in record:
                seen.add(record.split(b"X-Page-ID: ")[1].split(b"\r\n")[0])
    assert len(seen) == len(rows)


def test_dictionary_saves_space(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><head><title>Shop</title></head><body><a href='/cart'>Cart</a><p>{hashlib.md5(str(i).encode()).hexdigest()}</p></body></html>")
            for i in range(3000)]
    with_ = W.write_archives(pages_of(spark, rows).coalesce(1), str(tmp_path / "a"), sample_bytes=100_000).agg(F.sum("bytes")).head()[0]
    without = sum(len(gzip.compress(h.encode())) for _, _, h in rows)
    assert with_ < without * 2                                  # headers included, still near the bare payloads one by one


def test_read_back_gives_payloads_and_no_dangling_revisit(spark, tmp_path):
    rows = odd_pages()
    listed = W.write_archives(pages_of(spark, rows), str(tmp_path))
    back = W.read_archives(listed, with_payload=True)
    got = {r["page_id"]: r["payload"] for r in back.where("record_type = 'response'").collect()}
    texts = {str(p): (h or "").encode() for p, _, h in rows if p is not None}
    assert all(bytes(got[p]) == texts[p] for p in got if p is not None)
    assert W.dangling_revisits(back).count() == 0
    assert W.dangling_revisits(back.where("payload_digest <> '%s' OR record_type = 'revisit'" % sha(b"twice"))).count() == 2


def test_unlisted_files_are_not_read(spark, tmp_path):
    """What a lost attempt has left behind is in the folder, not in the list."""
    listed = W.write_archives(pages_of(spark, odd_pages()), str(tmp_path))
    (tmp_path / "pages-00000-99999-00000.warc.zst").write_bytes(b"half a file")
    assert W.read_archives(listed).count() == len(odd_pages())


def test_damaged_archive_raises(spark, tmp_path):
    listed = W.write_archives(pages_of(spark, [(1, "u", "abc" * 100)]), str(tmp_path))
    path = listed.head()["path"]
    data = bytearray(open(path, "rb").read())
    data[-6] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception):
        W.read_archives(listed).collect()


def test_empty_table_and_least_bytes(spark, tmp_path):
    assert W.archived_pages(pages_of(spark, []), str(tmp_path)).collect() == []
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    back = W.read_archives(W.write_archives(pages_of(spark, rows), str(tmp_path), least_bytes=4))
    assert sorted((r["page_id"], r["record_type"]) for r in back.collect()) == [("1", "response"), ("2", "response"), ("3", "response"), ("4", "revisit")]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=30), st.integers(1, 64), st.integers(1, 2000))
def test_frames_round_trip(blocks, read_bytes, sample_bytes):
    out = io.BytesIO()
    writer = W.ArchiveWriter(out, sample_bytes)
    records = [W.record_bytes([("WARC-Type", "resource"), ("X", str(i))], b) for i, b in enumerate(blocks)]
    for r in records:
        writer.add(r)
    writer.close()
    back = list(W.read_frames(io.BytesIO(out.getvalue()), read_bytes))
    assert back == records and [W.parse_record(r).block for r in back] == blocks
    if records:
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.read_frames(io.BytesIO(out.getvalue()[:-1]), read_bytes))


def test_folder_names(tmp_path):
    for name in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        assert os.path.samefile(W.open_fs(name)[1], tmp_path)
