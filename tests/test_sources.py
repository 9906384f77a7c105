"""Payload and page readers on awkward inputs; the CSV sink."""

import bz2
import csv
import glob
import gzip
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftline.sources import common as C
from siftline.sources import csv_sink, file_sink
from siftline.sources.file_source import unpacked
from siftline.sources import html_postings as H
from siftline.operators.numbering import dense_numbers
from siftline.sources import json_postings as J
from siftline.sources import markup
from tests.conftest import AS_OF


def ids(df):
    return [r.source_id for r in df.orderBy("seq").collect()]


def test_nested_json(spark):
    payloads = spark.createDataFrame(
        [
            (0, '{"jobs":{"job":[{"id":1,"position":{"experience-level":{"min":6}}},'
                '{"id":"2","position":{"title":"t","experience-level":{"min":"9"}},"posting-timestamp":1704067200},'
                '{"id":""},{"id":2,"position":{"title":"later"}}, {"position":{}}]}}'),
            (1, '{"jobs":{"job":{"id":3,"company":{"detail":{"name":"c"}}}}}'),
            (2, "<html>busy</html>"),
            (3, '{"jobs":{}}'),
            (4, '{"jobs":{"job":{"id":1,"position":{"title":"too late, 1 is taken"}}}}'),
        ],
        "payload_id long, payload string",
    )
    got = J.nested_json_postings(payloads, AS_OF).orderBy("seq").collect()
    assert [(r.source_id, r.title, r.company) for r in got] == [("2", "t", ""), ("3", "", "c")]
    assert got[0].posted_date == "2024-01-01T00:00:00"
    assert [r.payload_id for r in J.rejected_payloads(payloads).collect()] == [2]


def test_polymorphic_json(spark):
    payloads = spark.createDataFrame(
        [
            (0, '{"data":[{"id":1,"company":{"name":"c"},"position":"p","title":"t"},'
                '{"id":2,"company":"s","title":"t","address":"x"}]}'),
            (1, '[{"id":3,"address":{"full_location":"L"},"company":{}}]'),
            (2, '{"data":[]}'),
        ],
        "payload_id long, payload string",
    )
    got = J.polymorphic_json_postings(payloads, AS_OF).orderBy("seq").collect()
    assert [(r.source_id, r.title, r.company, r.location) for r in got] == [
        ("1", "p", "c", ""), ("2", "t", "s", ""), ("3", "", "", "L"),
    ]


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data":[{"id":\n1}]}')
    (tmp_path / "b.json").write_text("oops")
    payloads = J.read_payloads(spark, str(tmp_path))
    assert ids(J.polymorphic_json_postings(payloads, AS_OF)) == ["1"]
    assert J.rejected_payloads(payloads).count() == 1


def test_file_reports(spark, tmp_path):
    whole = b'{"data": [{"id": "1", "title": "t"}]}'
    given = {
        "good.json": whole,
        "good.gz": gzip.compress(whole) + gzip.compress(b" "),
        "mark.json": b"\xef\xbb\xbf" + whole,
        "cut.gz": gzip.compress(whole)[:-9],
        "bad.gz": b"\x1f\x8b" + b"\x00" * 30,
        "latin.json": "caf\u00e9".encode("latin-1"),
        "nothing.json": b"",
        "blank.json": b" \n",
        "no.json": b"oops",
    }
    for name, content in given.items():
        (tmp_path / name).write_bytes(content)
    got = {r.path.rpartition("/")[2]: (r.payload, r.reason) for r in J.payload_files(spark, str(tmp_path)).collect()}
    text = whole.decode()
    assert got == {
        "good.json": (text, None), "good.gz": (text + " ", None), "mark.json": (text, None),
        "cut.gz": (None, "truncated"), "bad.gz": (None, "damaged"), "latin.json": (None, "not UTF-8"),
        "blank.json": (None, "empty"), "no.json": ("oops", None),
    }
    unread = {r.path.rpartition("/")[2] for r in J.unread_payloads(spark, str(tmp_path)).collect()}
    assert unread == {n for n, (_, reason) in got.items() if reason}
    payloads = J.read_payloads(spark, str(tmp_path), pass_over=True)
    assert payloads.count() == 4 and len({r.payload_id for r in payloads.collect()}) == 4
    assert ids(J.polymorphic_json_postings(payloads.limit(9), AS_OF)) == ["1"]


def test_many_small_files_take_few_tasks(spark, tmp_path):
    rows = spark.range(300).select(F.lit("x.json").alias("name"), F.concat(F.lit('{"data":[{"id":'), "id", F.lit("}]}")).cast("binary").alias("content"))
    file_sink.write_files(rows, f"{tmp_path}/files", per_folder=200)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")  # a partition for each file
    try:
        for payloads in (J.read_payloads(spark, f"{tmp_path}/files"), J.read_payloads(spark, f"{tmp_path}/files/*")):
            assert payloads.rdd.getNumPartitions() <= 256
            found = J.polymorphic_json_postings(payloads, AS_OF).select("source_id").collect()
            assert sorted(int(r.source_id) for r in found) == list(range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_driver_has_no_list_of_files(spark, tmp_path):
    rows = spark.range(50).select(F.lit("x").alias("name"), F.concat(F.lit("["), "id", F.lit("]")).cast("binary").alias("content"))
    file_sink.write_files(rows, f"{tmp_path}/files", per_folder=20)
    for path in (f"{tmp_path}/files", f"file://{tmp_path}/files/*", f"{tmp_path}/files/folder=0"):
        payloads = J.read_payloads(spark, path)
        assert not payloads.inputFiles()  # those of Spark's own readers, which the driver lists
        assert not [x for x in ("FileScan", "InMemoryFileIndex") if x in payloads._jdf.queryExecution().toString()]
        found = payloads.collect()
        assert len({r.payload_id for r in found}) == len(found)
        if not path.endswith("=0"):
            assert sorted(int(r.payload[1:-1]) for r in found) == list(range(50))


def both_readings(spark, path):
    """The payloads as read here, without Spark's own reader, and by that."""
    ours, theirs = J.read_payloads(spark, path).select("payload"), spark.read.text(path, wholetext=True).select("value")
    assert not ours.inputFiles()
    return [sorted(bytes(b) for (b,) in df.select(F.col(df.columns[0]).cast("binary")).collect()) for df in (ours, theirs)]


def test_files_are_those_of_sparks_reader(spark, tmp_path):
    given = {
        "plain/latin.json": b"caf\xe9", "plain/mark.json": b"\xef\xbb\xbfx", "plain/empty": b"", "plain/two.gz": gzip.compress(b"a") + gzip.compress(b"b"),
        "plain/nothing.gz": gzip.compress(b""), "plain/a.bz2": bz2.compress(b"bz") * 2, "plain/a.deflate": zlib.compress(b"de"), "plain/q.GZ": gzip.compress(b"as any"),
        "plain/_hidden": b"1", "plain/.hidden": b"2", "plain/c._COPYING_": b"3", "plain/_k=v": b"4", "plain/_metadata.json": b"5", "plain/a b%20c\u00e4": b"6",
        "plain/sub/deep.json": b"passed over", "lone/_sub/k=1/x": b"passed over",
        "parts/k=1/x": b"7", "parts/k=2/x": b"8", "parts/k=2/plain/y": b"9", "parts/k=3/_no/z": b"no", "parts/_temporary-1/x": b"no", "parts/k=4/.z": b"no", "empty/k=1/x": b"", "empty/x": b"passed over",
        "deep/in/k=1/j=2/x": b"10", "deep/in/k=1/j=3/x": b"11", "none/.x": b"no",
    }
    for name, content in given.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    counts = {}
    for path in ("plain", "plain/*", "plain/a b%20c\u00e4", "plain/.hidden", "lone/_sub", "parts", "parts/*", "deep", "none", "empty", "{parts,deep}/*/k=1"):
        ours, theirs = both_readings(spark, f"{tmp_path}/{path}")
        assert ours == theirs, path
        counts[path] = len(ours)
    assert (counts["plain"], counts["parts"], counts["deep"], counts["none"]) == (9, 3, 2, 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        J.read_payloads(spark, f"{tmp_path}/missing")


def test_packed_files_as_sparks_reader(spark, tmp_path):
    lines = spark.range(0, 60_000, 1, 1).selectExpr("concat(repeat(cast(id % 997 as string), 9), sha1(cast(id as string)))")
    for codec in ("bzip2", "gzip", "lz4", "snappy", "deflate"):
        lines.write.option("compression", codec).text(f"{tmp_path}/{codec}")
        ours, theirs = both_readings(spark, f"{tmp_path}/{codec}")
        assert ours == theirs and len(ours[0]) > 1_000_000
    assert unpacked("x.zst", pa.Codec("zstd").compress(b"abc", asbytes=True)) == b"abc"
    for bad in (b"\x00\x00\x00\x09\x00\x00\x00\x05abc", b"\x00\x00\x00\x09\x00\x00\x00\x00"):
        with pytest.raises(EOFError):
            unpacked("x.snappy", bad)


def test_folders_and_files_that_fail(spark, tmp_path):
    for name in ("keys/k=1/x", "keys/j=1/x", "bases/k=1/x", "bases/in/k=1/x", "mixed/x", "mixed/in/k=1/x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"[1]")
    for name in ("keys", "bases", "mixed"):
        with pytest.raises(ValueError, match="conflicting"):
            J.read_payloads(spark, f"{tmp_path}/{name}")
    (tmp_path / "worn").mkdir()
    (tmp_path / "worn" / "x").write_bytes(b"[2]")
    sums = tmp_path / "worn" / ".x.crc"
    for crc, good in ((bytes(4), False), (b"", False), (zlib.crc32(b"[2]").to_bytes(4, "big"), True)):
        sums.write_bytes(b"crc\x00\x00\x00\x02\x00" + crc)
        for path in (f"{tmp_path}/worn", f"{tmp_path}/worn/x"):
            payloads = J.read_payloads(spark, path)
            if good:
                assert [r.payload for r in payloads.collect()] == ["[2]"]
            else:
                with pytest.raises(Exception, match="wrong checksum"):
                    payloads.collect()
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"[3]")[:-9])
    with pytest.raises(Exception, match="EOFError"):
        J.read_payloads(spark, f"{tmp_path}/cut.gz").collect()


def test_file_systems_that_arrow_cannot_open(spark, tmp_path):
    (tmp_path / "x.json").write_text("[1]")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.odd.link./in", f"file://{tmp_path}")
    assert [r.payload for r in J.read_payloads(spark, "viewfs://odd/in").collect()] == ["[1]"]


def test_contents_are_read_once(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "good.json").write_text("[1]")
    (tmp_path / "blank.json").write_text(" ")
    (tmp_path / "worn.json").write_text("[2]")
    (tmp_path / ".worn.json.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + bytes(4))  # not its checksum
    files = J.payload_files(spark, str(tmp_path))
    assert files._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = sorted((r.path.rpartition("/")[2], r.payload, r.reason) for r in files.collect())
    assert got == [("blank.json", None, "empty"), ("good.json", "[1]", None), ("worn.json", None, "unreadable")]
    assert sorted(r.reason for r in J.unread_payloads(spark, str(tmp_path)).collect()) == ["empty", "unreadable"]
    assert [r.payload for r in J.read_payloads(spark, str(tmp_path), pass_over=True).collect()] == ["[1]"]


def test_small_files_with_reports_take_few_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.json").write_text(f"[{i}]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")  # a partition for each file
    try:
        payloads = J.read_payloads(spark, str(tmp_path), pass_over=True)
        assert payloads.rdd.getNumPartitions() <= 256
        assert sorted(int(r.payload[1:-1]) for r in payloads.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_for_rows(spark, tmp_path):
    given = [("a", b"1"), ("a", b"1"), (None, b"2"), ("b=c", None), ("\u00e4.gz", b"\x00\xff")] * 3
    rows = spark.createDataFrame(given, "name string, content binary")
    for path in (f"{tmp_path}/plain", f"file:{tmp_path}/short", f"file://{tmp_path}/long"):
        file_sink.write_files(rows, path, per_folder=4)
        found = sorted((tmp_path / path.rpartition("/")[2]).glob("**/*-*"))
        assert len({f.parent for f in found}) > 1 and not list(tmp_path.glob("**/_temporary*"))
        assert sorted((f.name.partition("-")[2], f.read_bytes()) for f in found) == sorted((n or "", c or b"") for n, c in given)
    with pytest.raises(FileExistsError):
        file_sink.write_files(rows, f"{tmp_path}/plain")
    file_sink.write_files(rows.limit(0), f"{tmp_path}/none")
    assert J.read_payloads(spark, f"{tmp_path}/none").count() == 0


def test_numbers_of_any_size(spark):
    """Far more documents in one partition, and places in one document, than bits were once kept for."""
    documents = spark.range(0, 40_000, 1, 1).select(
        C.document_seq((1 << 61) - F.monotonically_increasing_id(), F.lit(0)).alias("seq"), F.lit("saramin").alias("source"), F.col("id").cast("string").alias("source_id")
    )
    places = spark.range(3).select(
        C.document_seq(F.lit(5), F.col("id") * (1 << 40)).alias("seq"), F.lit("incruit").alias("source"), F.col("id").cast("string").alias("source_id")
    )
    plain = spark.range(3).select(F.col("id").alias("seq"), F.lit("wanted").alias("source"), F.col("id").cast("string").alias("source_id"))
    got = C.numbered(C.union_sources({"wanted": plain, "incruit": places, "saramin": documents})).collect()
    got.sort(key=lambda r: r.seq)
    assert [r.seq for r in got] == list(range(40_006))
    want = [f"saramin:{39_999 - i}" for i in range(40_000)] + [f"{s}:{i}" for s in ("incruit", "wanted") for i in range(3)]
    assert [r.dedup_key for r in got] == want
    assert [r.arrival.rank for r in got[39_999:40_001]] == [0, 1]
    # Plain numbers stay.
    assert sorted((r.seq, r.arrival) for r in C.numbered(plain).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_dense_numbers_of_equal_leading_columns(spark):
    rows = spark.range(500).select(F.lit("hot").alias("a"), ((F.col("id") * 7919) % 500).alias("b"))
    got = sorted((r.b, r.n) for r in dense_numbers(rows, ["a", "b"], "n").collect())
    assert got == [(i, i) for i in range(500)]
    assert dense_numbers(rows.limit(0), ["a", "b"], "n").count() == 0


def test_embedded_json(spark):
    html = (
        "<script>var x = {};</script><script>\n window.__NEXT_DATA__ = "
        '{"props":{"pageProps":{"jobs":[{"id":7,"position":"p","company":{"name":"c"}}]}}} ;\n</script>'
    )
    pages = spark.createDataFrame([(0, html), (1, "<p>none</p>")], "page_id long, html string")
    got = J.embedded_json_postings(pages, AS_OF).collect()
    assert [(r.source_id, r.title, r.company) for r in got] == [("7", "p", "c")]


def list_item(href, title, extra=""):
    return (
        f'<li data-x="1" class="c_col"><div class="cell_first"><a class="cpname">A &amp; B</a></div>'
        f'<div class="cell_mid"><a href="{href}">{title}</a>{extra}</div>'
        '<div class="cell_last"> <b>~06.30</b> </div></li>'
    )


def test_html_list(spark):
    html = (
        '<li class="c_col"><div class="cell_mid"><a href="/out?job=9">outside</a></div></li>'
        '<div class="cBbslist_contenst">'
        + list_item("/v?job=1", " Sales <b> Rep </b>", '<span class="cl_md">서울</span><span class="cl_md">경력 3년</span>')
        + list_item("/v?job=1", "again")
        + list_item("http://x.org/2", "")
        + list_item("http://x.org/2", "id taken by the untitled one")
        + list_item("", "no address")
        + list_item("https://x.org/3", "Third")
        + "</div>"
    )
    pages = spark.createDataFrame([(0, html), (1, "<p>no list</p>")], "page_id long, html string")
    got = H.html_list_postings(pages, AS_OF).orderBy("seq").collect()
    assert [(r.source_id, r.url, r.title) for r in got] == [
        ("1", "https://job.incruit.com/v?job=1", "SalesRep"),
        ("https://x.org/3", "https://x.org/3", "Third"),
    ]
    assert (got[0].company, got[0].experience_required, got[0].posted_date) == ("A & B", "경력 3년", "~06.30")


def test_html_cards(spark):
    def card(*links, spans=""):
        anchors = "".join(f'<a href="{h}">{t}</a>' for h, t in links)
        return f'<div class="a shadow-list-x">{anchors}{spans}</div>'

    html = (
        card(("/GI_Read/1?a=1&amp;b=2", "logo"), ("/GI_Read/1", "Backend Dev"), ("/GI_Read/1", "X"),
             ("/GI_Read/1", "Acme Corp"), spans="<span>신입</span><span>경기 성남</span><span>서울</span>")
        + card(("/GI_Read/2", "short"))
        + card(("/GI_Read/2", "Long enough"), ("/other", "not a posting link"))
        + card(("/GI_Read/none", "Title without id"))
        + card(("/GI_Read/1", "Taken id here"))
    )
    pages = spark.createDataFrame([(5, html)], "page_id long, html string")
    got = H.html_card_postings(pages, AS_OF).orderBy("seq").collect()
    assert [(r.source_id, r.title, r.company) for r in got] == [
        ("1", "Backend Dev", "Acme Corp"), ("2", "Long enough", ""),
    ]
    assert got[0].url == "https://www.jobkorea.co.kr/GI_Read/1?a=1&b=2"
    assert (got[0].experience_required, got[0].location) == ("신입", "경기 성남")


def test_extract_with(spark):
    def reader(batches):
        for b in batches:
            yield b.assign(n=b["html"].str.count("<li")).drop(columns="html")

    pages = spark.createDataFrame([(0, "<li><li>"), (1, "")], "page_id long, html string")
    got = H.extract_with(pages, reader, "page_id long, n long").collect()
    assert {tuple(r) for r in got} == {(0, 2), (1, 0)}


def test_union_order_cap_and_counts(spark):
    def source(name, n):
        return spark.range(n).select(
            F.col("id").alias("seq"), F.lit(name).alias("source"), F.col("id").cast("string").alias("source_id")
        )

    batch = C.union_sources({"wanted": source("wanted", 3), "saramin": source("saramin", 5)}, max_per_source=4)
    got = [r.dedup_key for r in batch.orderBy("seq").collect()]
    assert got == [f"saramin:{i}" for i in range(4)] + [f"wanted:{i}" for i in range(3)]
    counts = C.source_counts(batch)
    assert {r.source: r.postings for r in counts.collect()} == {
        "saramin": 4, "incruit": 0, "jobkorea": 0, "wanted": 3,
    }
    assert C.zero_result_errors(counts).collect()[0][0] == "incruit: zero results; jobkorea: zero results"


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a\n"b", c\r'), (2, None)], "n int, t string").coalesce(1)
    path = str(tmp_path / "out")
    assert csv_sink.write_csv(df, path)
    assert not csv_sink.write_csv(df.where("n > 9"), path)
    (part,) = glob.glob(f"{path}/*.csv")
    with open(part, encoding="utf-8", newline="") as f:
        assert list(csv.reader(f)) == [["n", "t"], ["1", 'a | "b", c'], ["2", ""]]


def test_csv_file(spark, tmp_path):
    path = tmp_path / "out" / "rows.csv"
    df = spark.createDataFrame([(i, f'x "{i}", \u00e9\n ') for i in range(50)], "n int, t string").repartition(5).orderBy("n")
    assert csv_sink.write_csv_file(df, str(path))
    first = path.read_bytes()
    assert first.startswith(b"\xef\xbb\xbfn,t\n") and first.count(b"\xef\xbb\xbf") == 1
    with open(path, encoding="utf-8-sig", newline="") as f:
        header, *rows = csv.reader(f)
    assert header == ["n", "t"] and [r[0] for r in rows] == [str(i) for i in range(50)]
    # An empty frame and a write that fails leave the old file; another replaces it.
    assert not csv_sink.write_csv_file(df.where("n > 99"), str(path))
    with pytest.raises(Exception):
        csv_sink.write_csv_file(df.select(F.raise_error(F.lit("no")).alias("n")), str(path))
    assert path.read_bytes() == first
    assert csv_sink.write_csv_file(df.where("n < 2"), str(path)) and len(path.read_bytes()) < len(first)
    assert [p.name for p in path.parent.iterdir() if "crc" not in p.name] == ["rows.csv"]
    assert csv_sink.write_csv_file(df.where("n > 99"), str(path), skip_empty=False) and path.read_bytes() == b"\xef\xbb\xbfn,t\n"


def test_elements_end_at_their_own_closing_tag(spark):
    lists = (
        '<div class="cBbslist_contenst"><div>ad</div>'
        + list_item("/v?job=1", "In the list").replace('class="cell_mid">', 'class="cell_mid"><div><div></div></div>')
        + '</div><div class="side">' + list_item("/v?job=2", "Beside it") + "</div>"
    )
    pages = spark.createDataFrame([(0, lists), (1, '<div class="cBbslist_contenst">' + list_item("/v?job=3", "Never closed"))], "page_id long, html string")
    assert [r.source_id for r in H.html_list_postings(pages, AS_OF).orderBy("seq").collect()] == ["1", "3"]
    cards = (
        '<div class="shadow-list"><div><a href="/GI_Read/7">Title only</a></div></div>'
        '<div><a href="/GI_Read/7">Other company</a><span>서울</span><span>경력</span></div>'
    )
    (card,) = H.html_card_postings(spark.createDataFrame([(0, cards)], "page_id long, html string"), AS_OF).collect()
    assert (card.title, card.company, card.location, card.experience_required) == ("Title only", "", "", "")


def test_character_references():
    given = "&middot; &#44032;&#xAC00; &amp;lt; &lt; &nope; &#0; &#x110000; &#38;gt;&amp;"
    assert markup.unescaped(given) == "\u00b7 \uac00\uac00 &lt; < &nope; &#0; &#x110000; &gt;&"
    assert [markup.unescaped(x) for x in ("plain", "a & b")] == ["plain", "a & b"]


def test_elements_and_attributes():
    html = "<DIV class=x><div>a</div>b<br>c</DIV>d"
    assert markup.first_element(html, r"<div\b[^>]*>") == "<div>a</div>b<br>c"
    assert markup.first_element(html, r"<p>") is None
    assert markup.elements("<li>1<li>2</li>3<ul><li>4", "<li>") == ["1", "2", "4"]
    assert markup.inner_text(" a <b> c </b>\u3000d&nbsp; ") == "acd"
    assert markup.attribute("""<a title="href='x'" href = 'y&amp;z'>""", "href") == "y&z"
    assert markup.attribute('<a>< href="x">', "href") == ""


def test_pages_without_html(spark):
    pages = spark.createDataFrame([(1, None), (2, "")], "page_id long, html string")
    assert H.html_list_postings(pages, AS_OF).count() == H.html_card_postings(pages, AS_OF).count() == 0
