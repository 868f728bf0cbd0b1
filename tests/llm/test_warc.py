import hashlib
import zlib

import pytest

from tierline.llm.warc import Archives, archive_files, read_archives, records_in, write_archives

SCHEMA = "page_id long, url string, html string, size string, digest int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def rows():
    long_text = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 30_000
    found = [(i, f"http://h{i % 3}/{i}", f"<html>{'page ' * (i % 50)}{i}</html>") for i in range(60)]
    found += [(100 + i, "http://same/", "<b>" + "same " * 40) for i in range(50)]
    found += [(200 + i, "http://short/", "short") for i in range(3)]
    found += [(300, None, None), (301, "", ""), (302, "a b\r\nX: y", long_text), (303, "u", long_text)]
    return found + [(None, "http://none/", "<b>" + "same " * 40), (60, "u", "<html>twice</html>" * 9)] * 2


def brute(data, least=100):
    first = {}
    for i, _, html in data:
        key = (html or "").encode()
        if len(key) >= least and i is not None:
            first[key] = min(i, first.get(key, i))
    result = []
    for i, _, html in data:
        key = (html or "").encode()
        of = first.get(key) if data and sum((h or "").encode() == key for _, _, h in data) > 1 else None
        again = of is not None and i != of
        result.append(
            (i, len(key), hashlib.sha256(key).hexdigest(), "revisit" if again else "response",
             of if again else None)
        )
    return sorted(result, key=str)


def found(df):
    number = lambda x: None if x is None else int(x)
    return sorted(
        (
            (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to))
            for r in df.collect()
        ),
        key=str,
    )


@pytest.mark.parametrize("split", [37, 1_000, 1 << 26])
def test_round_trip_whatever_the_splits(spark, tmp_path, split):
    data = rows()
    params = Archives(split_bytes=split, file_bytes=4_000)
    files = write_archives(pages(spark, data), str(tmp_path / "w"), params)
    assert files.agg({"records": "sum"}).first()[0] == len(data)
    assert found(read_archives(files, params, payloads=False)) == brute(data)


def test_payloads_headers_and_listing(spark, tmp_path):
    data = rows()
    write_archives(pages(spark, data), f"file://{tmp_path}/w")
    records = read_archives(archive_files(spark, str(tmp_path / "w"))).collect()
    html = {i: (h or "").encode() for i, _, h in data}
    for r in records:
        if r.record_type == "response" and r.record_id is not None:
            assert bytes(r.payload) == html[int(r.record_id)]
        else:
            assert r.record_type == "response" or r.payload is None
    assert {r.uri for r in records if r.record_id == "302"} == {"a%20b%0D%0AX:%20y"}


def member(payload, kind="response"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def test_records_belong_to_the_range_they_start_in(tmp_path):
    parts = [member(b"x" * n) for n in (0, 5, 100_000, 3)]
    junk = b"\x1f\x8b\x08junk" + zlib.compress(b"no record")
    data = parts[0] + junk + parts[1] + parts[2] + b"\0" * 9 + parts[3]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    starts = [data.index(p) for p in parts]
    for step in (1, 7, 50, len(data)):
        got = [
            r
            for low in range(0, len(data), step)
            for r in records_in(f"file://{path}", low, low + step, True)
        ]
        assert [r[0] for r in got] == starts
        assert [len(r[-1]) for r in got] == [0, 5, 100_000, 3]


def test_a_record_that_breaks_off_is_an_error(tmp_path):
    path = tmp_path / "a.warc.gz"
    whole = member(bytes(range(256)) * 500)
    path.write_bytes(whole[:-20])
    with pytest.raises(ValueError):
        list(records_in(f"file://{path}", 0, 1 << 20, False))
    path.write_bytes(whole[:-6] + b"\0\0" + whole[-4:])
    with pytest.raises(zlib.error):
        list(records_in(f"file://{path}", 0, 1 << 20, False))


def test_empty_table(spark, tmp_path):
    files = write_archives(pages(spark, []), str(tmp_path / "w"))
    assert read_archives(files).count() == 0


@pytest.mark.parametrize("blanks", [400_000, 1_500_000])
def test_a_header_of_any_length_is_read(spark, tmp_path, blanks):
    data = [(1, "a" + " " * blanks + "b", "<p>one</p>" * 20), (2, "u", "two"), (3, "x" * blanks, "three")]
    params = Archives(split_bytes=900)
    files = write_archives(pages(spark, data).coalesce(1), str(tmp_path / "w"), params)
    found = {r.record_id: r for r in read_archives(files, params).collect()}
    assert {i: r.payload for i, r in found.items()} == {str(i): h.encode() for i, _, h in data}
    assert found["1"].uri == "a" + "%20" * blanks + "b" and found["3"].uri == "x" * blanks


def test_a_lost_record_is_an_error(spark, tmp_path):
    params = Archives(split_bytes=1 << 12)
    files = write_archives(pages(spark, rows()).repartition(2), str(tmp_path / "w"), params)
    table = files.collect()
    assert all(sum(r.starts) == r.records and len(r.starts) == -(-r.size // r.window) for r in table)
    assert read_archives(files, params, payloads=False).count() == len(rows())
    more = files.selectExpr("path", "size", "records", "window", "transform(starts, x -> x + 1) AS starts")
    with pytest.raises(Exception, match="were written"):
        read_archives(more, params, payloads=False).collect()
    # Splits of another size have no numbers to compare.
    assert read_archives(more, Archives(split_bytes=5_000), payloads=False).count() == len(rows())
