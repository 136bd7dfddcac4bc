import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import host_reputation as hr
from tidemark.llm import queries, rendezvous, warc
from tidemark.llm.common import new_path


def test_shards_awkward_rows(awkward, empty):
    rows = rendezvous.assign_shards(awkward, [1.0] * 8, [1.0] * 9).collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in awkward.collect())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    for s in range(8):
        mine = sorted(r.slot for r in rows if r.shard == s)
        assert mine == list(range(len(mine)))
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    fives = [r for r in rows if r.doc_id == 5]
    assert len({r.shard for r in fives}) == 1 and len({r.slot for r in fives}) == 2
    assert rendezvous.assign_shards(empty, [1.0] * 8).collect() == []


def test_weights_and_growth(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = rendezvous.assign_shards(docs, [1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 4.0]).toPandas()
    share = rows["shard"].value_counts(normalize=True).sort_index().to_numpy()
    assert np.allclose(share, [0.25, 0.5, 0.25], atol=0.02)
    moved = rows[rows["shard"] != rows.grown_shard]
    assert set(moved.grown_shard) == {3} and abs(len(moved) / len(rows) - 0.5) < 0.02
    fewer = docs.where("doc_id % 7 = 3")
    again = rendezvous.assign_shards(fewer, [1.0, 2.0, 1.0]).toPandas().set_index("doc_id")["shard"]
    assert (rows.set_index("doc_id").loc[again.index, "shard"] == again).all()
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.lit("k"), [1.0, 0.0])


def test_written_shards_hold_the_assigned_rows(spark, awkward):
    folder = new_path(spark, "test-shards")
    rendezvous.write_shards(awkward.drop("shard"), [1.0] * 8, folder)
    back = spark.read.parquet(folder)
    assert sorted((str(r.doc_id), r.shard) for r in back.collect()) == sorted((str(r.doc_id), r.shard) for r in rendezvous.assign_shards(awkward, [1.0] * 8).collect())


BIG = "é" * 900_000
PAGES = [
    (1, "http://a/", "x" * 1000),
    (2, None, "x" * 1000),
    (2, None, "x" * 1000),
    (3, "http://b/\r\nEvil: 1", "x" * 999),
    (4, "http://b/%0A", "x" * 999),
    (5, "u", None),
    (6, "u", ""),
    (None, "u", "x" * 1000),
    (None, "u", "only"),
    (7, "u", BIG),
    (8, "u", BIG + "!"),
    (9, "u", "WARC/1.1\r\n\r\n" * 200),
    (10, "u", BIG),
]


@pytest.fixture(scope="module")
def pages(spark, awkward):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return df.withColumn("payload", F.lit("clash")).withColumn("refers_to", F.lit(1)).withColumn("total", F.lit("t")).repartition(3)


def test_archives_round_trip(pages):
    rows = warc.archive(pages, chunk_bytes=4096).collect()
    records = {}
    for r in rows:
        records.setdefault((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest), []).append(r)
    # rows that repeat a page are records of their own with equal chunks
    whole = []
    for key, chunks in records.items():
        copies = sum(c.chunk_no == 0 for c in chunks)
        body = b"".join(bytes(c.chunk) for c in sorted(chunks, key=lambda c: c.chunk_no)[::copies])
        assert max(len(c.chunk) for c in chunks) <= 4096 and sum(c.last for c in chunks) == copies
        for c in chunks:
            assert c.digest_so_far == hashlib.sha1(body[: c.bytes_so_far]).hexdigest()
        whole += [(key, body)] * copies
    assert len(whole) == len(PAGES)
    stores = {"x" * 1000: 2, BIG: 10}
    want = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        to = stores.get(html)
        to = None if to == page else to
        kind = "response" if to is None else "revisit"
        want.append(((page, url, kind, to, len(data), hashlib.sha1(data).hexdigest()), data if to is None else b""))
    assert sorted(whole, key=str) == sorted(want, key=str)


def test_archives_are_gzip_members_of_warc_records(spark, pages):
    import gzip
    import glob

    folder = new_path(spark, "test-warc")
    index = warc.write_archives(warc.chunk_rows(pages.where("page_id = 1 or page_id = 6")), folder).collect()
    local = folder.removeprefix("file://")
    blobs = {int(p.split("part-")[1][:6]): open(p, "rb").read() for p in glob.glob(f"{local}/archives/*.warc.gz")}
    for r in index:
        record = gzip.decompress(blobs[r.file][r.byte_offset : r.byte_offset + r.byte_length]).decode()
        head, _, body = record.partition("\r\n\r\n")
        assert head.startswith("WARC/1.1\r\n") and record.endswith("\r\n\r\n")
        length = int(head.split("Content-Length: ")[1].split("\r\n")[0])
        assert len(body.encode()) == length + 4


def test_damaged_archive_fails(spark, pages):
    import glob
    import gzip

    folder = new_path(spark, "test-warc")
    warc.write_archives(warc.chunk_rows(pages.where("page_id = 1")), folder)
    (path,) = glob.glob(folder.removeprefix("file://") + "/archives/*.warc.gz")
    text = gzip.decompress(open(path, "rb").read())
    open(path, "wb").write(gzip.compress(text.replace(b"xxx", b"xyx", 1)))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark, folder).collect()


def test_empty_archive(pages):
    assert warc.archive(pages.limit(0)).collect() == []


URLS = [
    (1, "http://WWW.Example.COM/en/1?x#y"), (2, "https://example.com/en/"), (3, "https://example.com/de/"), (4, "https://notexample.com/en/"),
    (5, "https://a.example.net/es/1"), (6, "https://net/fr/"), (7, "https://a.org"), (8, None), (9, "no scheme/com/"), (10, "http://com?en"),
    (11, "x://y://z.com/a"), (12, "http:///path#f"), (13, "http://ÄÖ.COM/En/"), (None, "http://a.com/"), (1, "http://WWW.Example.COM/en/1?x#y"), (14, "http://a.com\n/b?c"),
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:end]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string").withColumn("host", F.lit("clash")).withColumn("bound", F.lit(1))
    outcomes = spark.createDataFrame([], "page_id bigint, good int")
    rows = hr.judge_urls(pages, outcomes, queries.URL_RULES).collect()
    want = []
    for page, url in URLS:
        host, path = plain_url(url)
        fit = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        want.append((page, host, path, best and best.name, best.verdict if best else "allow"))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert hr.judge_urls(pages.limit(0), outcomes, queries.URL_RULES).collect() == []


def test_bad_hosts_are_blocked_and_doubt_allows(spark):
    """A host with many bad pages is blocked, one with a single bad page isn't; a domain's bad name passes to its unlabelled host."""
    rows = [(f"http://good{h}.fine.org/{i}", 1) for h in range(5) for i in range(40)]
    rows += [(f"http://bad.fine.org/{i}", int(i == 0)) for i in range(40)]
    rows += [("http://once.fine.org/0", 0)]
    rows += [(f"http://h{h}.evil.org/{i}", 0) for h in range(10) for i in range(30)]
    rows += [("http://new.evil.org/", None), ("http://new.fine.org/", None), ("http://other.net/", None)]
    df = spark.createDataFrame([(i, u, g) for i, (u, g) in enumerate(rows)], "page_id bigint, url string, good int")
    got = {r.host: r.verdict for r in hr.judge_urls(df.select("page_id", "url"), df.select("page_id", "good"), []).collect()}
    assert got["good0.fine.org"] == got["once.fine.org"] == got["new.fine.org"] == got["other.net"] == "allow"
    assert got["bad.fine.org"] == got["h0.evil.org"] == got["new.evil.org"] == "block"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_rows(spark, awkward, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    df = queries.QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_url_filter_runs_no_python(spark):
    from support import plan_text

    plan = plan_text(queries.QUERIES["op6_url_filter"](spark, "/root/testdata/sf0.001"))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
