import gzip
import hashlib
import io
import json
import zipfile
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import archives
from holdfast.llm.queries import op13_page_archives

LONG = "é<p>" * 40


def brute(rows):
    """The multiset of results; rows alike are interchangeable."""
    groups = defaultdict(list)
    for key, _, html in rows:
        groups[html or ""].append(key)
    out = []
    for html, keys in groups.items():
        raw, keys = html.encode(), sorted(keys, key=lambda k: (k is None, k))
        for i, key in enumerate(keys):
            again = len(raw) >= 100 and i > 0
            out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", keys[0] if again else None))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def packed(members, *, stored=True):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def opened(data):
    return pa.BufferReader(data)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(min_size=1, max_size=8).filter(lambda s: "\0" not in s), st.binary(max_size=50)), max_size=6, unique_by=lambda m: m[0]), st.binary(max_size=30))
def test_streams_are_read_by_a_zip_library_and_by_the_parser(members, before):
    out = io.BytesIO()
    stream = archives.ZipStream(out)
    for name, data in members:
        stream.begin(name)
        stream.write(data)
        stream.end()
    stream.close()
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as z:
        assert z.testzip() is None and [z.read(i) for i in z.infolist()] == [d for _, d in members]
    for data in (out.getvalue(), before + out.getvalue(), packed(members), before + packed(members)):
        file = opened(data)
        found = list(archives.read_directory(file))
        assert [m.name for m in found] == [n for n, _ in members]
        assert [b"".join(archives.member_blocks(file, m)) for m in found] == [d for _, d in members]


def test_directories_larger_than_a_block_and_comments():
    members = [(f"archive/{'n' * 200}{i}", b"x" * (i % 7)) for i in range(9_000)]
    data = packed(members)
    assert len(data) > 2 * archives.BLOCK
    assert [(m.name, m.size) for m in archives.read_directory(opened(data))] == [(n, len(d)) for n, d in members]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"1")
        z.comment = b"PK\5\6 not the end"
    assert [m.name for m in archives.read_directory(opened(out.getvalue()))] == ["a"]
    deflated = opened(packed([("a", b"1" * 5_000)], stored=False))
    (member,) = archives.read_directory(deflated)
    assert member.method == 8 and b"".join(archives.member_blocks(deflated, member)) == b"1" * 5_000


@pytest.mark.parametrize("data", [b"", b"PK", b"x" * 100, packed([("a", b"b")])[:-30]])
def test_no_archives(data):
    with pytest.raises(ValueError, match="ZIP"):
        list(archives.read_directory(opened(data)))


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(max_size=10)), st.one_of(st.none(), st.text(max_size=20)), st.binary(max_size=200), st.booleans())
def test_records_round_trip(key, url, payload, again):
    digest = hashlib.sha256(payload).hexdigest()
    raw = archives.make_record(key, 3, url, digest, len(payload), payload, ("1", 2) if again else None)
    found, taken = archives.parse_record(raw + b"WARC/1.1 more")
    assert taken == len(raw) and found.payload == (None if again else payload) and found.payload_bytes == len(payload)
    assert found.type == ("revisit" if again else "response") and found.refers_to == ("urn:page:=1:2" if again else None)
    assert found.digest == f"sha256:{digest}" and found.record_id == archives.record_name(key, 3)
    for blocks in ([raw * 3], [bytes([b]) for b in raw * 2], [gzip.compress(raw) * 2 + raw]):
        walked = list(archives.walk(iter(blocks)))
        assert [w[0] for w in walked] == [found] * len(walked) and len(walked) == 3 - (len(blocks) > 1)


PAGES = [
    (1, "http://a/ ü\r\nx", LONG), (2, None, LONG), (2, "again", LONG), (5, "u", "short"), (6, "u", "short"), (7, "", None), (8, "", ""), (None, "null", LONG),
    (None, "z", "only null " * 30), (None, "z", "only null " * 30), (9, "v", "x" * 99), (10, "v", "x" * 99), (11, "v", "x" * 100), (12, "v", "x" * 100),
    (3, "w", LONG), (0, "first", "y" * 300_000), (13, "later", "y" * 300_000), *[(100 + i, "hot", "copy " * 50) for i in range(300)],
]


@pytest.mark.parametrize("archive_bytes,read_bytes", [(archives.ARCHIVE_BYTES, archives.READ_BYTES), (1_000, 500)])
def test_any_pages(spark, tmp_path, archive_bytes, read_bytes):
    extra = "'x' as row, 1 as size, 'y' as digest, 'z' as payload, 2 as salt, 'p' as path"
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", *extra.split(", ")).repartition(4, "page_id")
    folder = f"file://{tmp_path}/made"
    made = archives.write_archives(df, folder, archive_bytes=archive_bytes)
    assert sum(r.records for r in made.collect()) == len(PAGES) and (archive_bytes > 1_000 or made.count() > 20)
    for paths in (made, archives.archive_paths(spark, folder)):
        records = archives.read_records(paths, read_bytes=read_bytes)
        assert got(archives.page_records(records, "bigint")) == brute(PAGES)
    uris = {r.target_uri for r in records.collect()}
    assert "http://a/%20%C3%BC%0D%0Ax" in uris and None in uris
    for r in made.collect():
        with zipfile.ZipFile(r.path.removeprefix("file://")) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
            raw = z.read(archives.DATA)
            for line in z.read(archives.INDEX).splitlines():
                entry = json.loads(line[line.index(b"{") :])
                assert archives.parse_record(gzip.decompress(raw[entry["offset"] :][: entry["length"]]))[0].digest == entry["digest"]


def test_foreign_archives(spark, tmp_path):
    """Deflated and gzipped indexes, plain records, members without an index, archives without records."""
    one = [archives.make_record(str(i), i, None, "0", 3, b"abc", None) for i in range(3)]
    lines = "".join(f'com,a)/ 2020 {{"filename": "b.warc", "offset": "{sum(map(len, one[:i]))}", "length": "{len(one[i])}"}}\n' for i in (2, 0, 1))
    index = b'!meta {"format": "cdxj"}\n' + lines.encode()
    info = [("archive/b.warc", b"".join(one)), ("archive/c.warc.gz", b"".join(gzip.compress(r) for r in one)), ("pages/pages.jsonl", b"{}")]
    (tmp_path / "a.wacz").write_bytes(packed([*info, ("indexes/i.cdxj.gz", gzip.compress(index[:40]) + gzip.compress(index[40:]))]))
    (tmp_path / "b.zip").write_bytes(packed(info))
    (tmp_path / "c.wacz").write_bytes(packed([]))
    found = archives.read_records(archives.archive_paths(spark, str(tmp_path))).collect()
    assert Counter((r.path[-6:], r.name, r.record_id, bytes(r.payload)) for r in found) == Counter(
        (path, name, f"urn:page:={i}:{i}", b"abc") for path in ("a.wacz", "/b.zip") for name in ("archive/b.warc", "archive/c.warc.gz") for i in range(3))
    (tmp_path / "d.wacz").write_bytes(packed([*info, ("indexes/i.cdxj", index.replace(b'"b.warc"', b'"x.warc"'))]))
    with pytest.raises(Exception, match="d.wacz: the index names a record outside"):
        archives.read_records(archives.archive_paths(spark, str(tmp_path))).collect()


def test_empty_table(spark, nothing):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    made = archives.write_archives(none)
    assert made.count() == 0 and got(archives.page_records(archives.read_records(made), "bigint")) == Counter()


def test_query_against_brute_force(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    df = op13_page_archives(spark, sf)
    assert dict(df.dtypes) == {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}
    assert got(df) == brute(rows)
