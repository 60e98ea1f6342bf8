import gzip
import hashlib
import pathlib
import random
import zlib

import pytest

from marquee.llm.warc import END, VERSION, Stream, checked, member, members, normalise, read_archives, read_index, records, warc, write_archives

SCHEMA = "page_id long, url string, html string, part string, offset string, digest string"
LONG = "x" * 99 + "é"
NASTY = [f"{END}{VERSION}\r\n", f"a\r\n{END}{VERSION}\r\n{END}", "\r\n" * 90, f"{VERSION}\r\nContent-Length: 7{END}" * 9, "\r", "\n\r\n\r"]


def odd_pages(spark):
    rows = [
        (1, "http://a/", None), (2, None, ""), (3, "http://a/ b\r\nX: y", LONG), (4, "u", LONG), (4, "u", LONG), (3, "v", LONG),
        (None, "w", LONG), (None, "w", "only without identifier" * 9), (None, "w", "only without identifier" * 9),
        (5, "x", "y" * 99), (6, "x", "y" * 99), (7, "z", "日本" * 40_000), (8, "z", "z" * 3_000_000),
    ]
    rows += [(20 + i, "n", text) for i, text in enumerate(NASTY)]
    return spark.createDataFrame([(*r, "o", "o", "o") for r in rows], SCHEMA).repartition(3), rows


def plain(rows):
    """What the contract says, by hand."""
    out, firsts = [], {}
    for i, _, html in rows:
        firsts.setdefault((html or "").encode(), []).append(i)
    for i, _, html in rows:
        payload = (html or "").encode()
        known = [x for x in firsts[payload] if x is not None]
        first = min(known) if known else None
        revisit = len(payload) >= 100 and i != first
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


@pytest.mark.parametrize("file_records", [2, 20_000])
def test_odd_pages(spark, file_records):
    pages, rows = odd_pages(spark)
    assert got(warc(pages, file_records=file_records)) == plain(rows)


def test_empty_table(spark):
    pages, _ = odd_pages(spark)
    assert warc(pages.where("false")).count() == 0


def test_random_payloads_and_text_identifiers(spark):
    chance = random.Random(5)
    parts = ["\r\n", "\r\n\r\n", VERSION, "WARC-Type: x", "\0", "a", "é", "b" * 50, END + VERSION + "\r\n"]
    rows = [(f"p {i}/%<>", None, "".join(chance.choices(parts, k=chance.randrange(40)))) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(2)
    assert got(warc(pages)) == plain(rows)


def test_a_third_of_all_rows_is_one_payload(spark):
    rows = [(i, "u", "copy " * 30 if i % 3 == 0 else f"own {i} " * 20) for i in range(3_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert got(warc(pages)) == plain(rows)


def test_files(spark, tmp_path):
    pages, rows = odd_pages(spark)
    write_archives(pages, f"{tmp_path}/crawled", 4)
    whole = [pathlib.Path(f) for f in (tmp_path / "crawled").glob("part-*")]
    assert all(f.name.endswith(".gz") and len(list(members(f.read_bytes()))) == 1 for f in whole)
    normalise(spark, f"{tmp_path}/crawled", f"{tmp_path}/n", 4)
    files = {}
    for f in (tmp_path / "n" / "archives").glob("part-*"):
        files[int(f.name[5:10]), int(f.name.split("-c")[1][:3])] = f.read_bytes()
    # Any reader of gzip files gives the bytes that were crawled.
    assert sorted(b"".join(gzip.decompress(f.read_bytes()) for f in whole)) == sorted(b"".join(map(gzip.decompress, files.values())))
    index = read_index(spark, f"{tmp_path}/n").collect()
    assert len(index) == len(rows)
    for r in index:
        content = files[r.part, r.chunk][r.offset : r.offset + r.length]
        record = gzip.decompress(content)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and len(list(members(content))) == 1
        assert f"<{r.record_id}>".encode() in record and f"WARC-Type: {r.record_type}\r\n".encode() in record
    assert sum(r.length for r in index) == sum(map(len, files.values()))
    payloads = {r.record_id: bytes(r.payload) for r in read_archives(spark, f"{tmp_path}/n").collect() if r.payload is not None}
    assert payloads["urn:x-page:7"].decode() == "日本" * 40_000


def test_foreign_archives_and_faults(spark, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(info))
    normalise(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert [(r.record_type, r.record_id, r.payload_bytes) for r in checked(spark, f"{tmp_path}/out").collect()] == [("warcinfo", "urn:uuid:1", 5)] * 2
    for name, bad in {"cut": info[:-6], "none": b"no record\r\n\r\n" + info, "long": info.replace(b": 5", b": 4")}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "b.warc.gz").write_bytes(gzip.compress(bad))
        with pytest.raises(Exception, match="b.warc.gz"):
            normalise(spark, f"{tmp_path}/{name}", f"{tmp_path}/{name}-out")


def test_index_and_archives_must_agree(spark, tmp_path):
    pages, rows = odd_pages(spark)
    write_archives(pages, f"{tmp_path}/c")
    normalise(spark, f"{tmp_path}/c", f"{tmp_path}/n")
    assert checked(spark, f"{tmp_path}/n").count() == len(rows)
    read_index(spark, f"{tmp_path}/n").where("payload_bytes <> 99").write.parquet(f"{tmp_path}/m/index")
    (tmp_path / "m" / "archives").symlink_to(tmp_path / "n" / "archives")
    with pytest.raises(Exception, match="differ"):
        checked(spark, f"{tmp_path}/m").collect()


def test_members_end_with_zero():
    for size in (0, 1, 5000, (1 << 24) - 1, 1 << 24, (1 << 24) + 7):
        made = member(b"a" * size, 1)
        assert made[-1] == 0 and gzip.decompress(made) == b"a" * size
    two = member(b"a" * (1 << 24), 1)
    assert [(at, n, len(x)) for at, n, x in members(two + member(b"b"))] == [(0, len(two), 1 << 24), (len(two), len(member(b"b")), 1)]
    with pytest.raises(ValueError, match="cut off"):
        list(members(two[:-30]))
    with pytest.raises(zlib.error):
        list(members(b"no member"))


def test_stream_gives_whole_records_only():
    one = b"WARC/1.1\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    stream, found = Stream("s"), []
    for i in range(len(one) * 2):
        stream.held += (one + one)[i : i + 1]
        found += [r for _, r in stream.records()]
    assert found == [one, one]
    stream.close()


def test_records_of_pages(spark):
    row = records(spark.createDataFrame([(1, "http://a/\r\nX-Y: 1", "p")], "page_id long, url string, html string")).first()
    assert "\r\nWARC-Target-URI: http://a/%20X-Y:%201\r\n" in row.value and row.value.endswith("\r\n\r\np")
