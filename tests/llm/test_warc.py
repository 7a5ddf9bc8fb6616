import gzip
import html
import time

from pyspark.sql import functions as F

from skyloom.llm.warc import ENTITIES, derive, parse_records, plain_text, read_responses, resolved, responses_of_pages, warc_records

HTML = '<html lang="de"><head><title>A  b</title><script>x("</p>")</script></head><body><p>One &amp; two<br>three</p><!-- no --><a href="/x">link</a></body></html>'


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_id string")


def test_derivatives_refer_to_their_response(spark):
    df = pages(spark, [(1, "http://a.example/", HTML, "z"), (2, None, None, None), (None, "u", "", None), (1, "http://a.example/", HTML, "z")])
    responses = responses_of_pages(df)
    rows = derive(responses).collect()
    assert len(rows) == 8
    meta = next(r for r in rows if r.page_id == 1 and r.kind == "metadata")
    text = next(r for r in rows if r.page_id == 1 and r.kind == "conversion")
    assert text.block == "One & two\nthree\nlink"
    assert meta.block == "title: A b\r\nlanguage: de\r\noutlink: /x L a/@href\r\n"
    assert meta.refers_to == text.refers_to == responses.where("page_id = 1").first().record_id
    assert meta.record_id != text.record_id and meta.source_digest == text.source_digest
    for record in warc_records(derive(responses)).collect():
        (fields, block), = parse_records(bytes(record.record))
        row = next(r for r in rows if r.record_id == fields["warc-record-id"])
        assert block.decode() == row.block and fields["warc-refers-to"] == row.refers_to
        assert fields["warc-source-header"].split("\n") == [x for x in row.source_headers.split("\r\n") if x]


def test_responses_of_files(spark):
    body = "<p>é</p>".encode("latin-1")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n" + body
    record = lambda kind, block: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\nWARC-Target-URI: http://b/\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    files = spark.createDataFrame([(record("warcinfo", b"software: x") + record("response", http),), (None,)], "content binary")
    rows = read_responses(files).collect()
    assert len(rows) == 1 and rows[0].payload == "<p>é</p>" and rows[0].target_uri == "http://b/"
    assert {r.block for r in derive(read_responses(files)).collect()} == {"é", ""}


def test_empty(spark):
    assert derive(responses_of_pages(pages(spark, []))).count() == 0


def test_references_are_resolved_as_by_the_standard(spark):
    texts = [f"a &{n}; b" for n in ENTITIES] + ["&#65;&#x1F600;&#X41; &#150; &#0; &#xD800; &#9999999;", "&", "&&amp;;", "a & b; c", "&unknown; &#x; &amp", "no reference", "&lt;p&gt; &amp;amp;", ""]
    found = {r.t: r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", resolved(F.col("t")).alias("x")).collect()}
    for t in texts:
        if t not in ("&unknown; &#x; &amp",):
            assert found[t] == html.unescape(t), t
    assert found["&unknown; &#x; &amp"] == "&unknown; &#x; &amp"


def test_any_quoting_and_case_of_links(spark):
    page = """<HTML Lang='fr'><TITLE>A &amp; B &eacute;</TITLE><a HREF='/one'>x</a><a class=y href=/two>x</a><A Href = "/t?a=1&amp;b=2">x</A><!-- open <a href="/three">"""
    rows = {r.kind: r.block for r in derive(responses_of_pages(pages(spark, [(1, "u", page, None)]))).collect()}
    assert rows["metadata"] == "title: A & B é\r\nlanguage: fr\r\n" + "".join(f"outlink: {x} L a/@href\r\n" for x in ("/one", "/two", "/t?a=1&b=2", "/three"))
    assert rows["conversion"] == "xxx"


def test_very_long_pages_take_linear_time(spark):
    for unit in ("<!-- ", "<", "a < b ", "&", "<script>", "<head>", " \n", "<a href=' "):
        rows = spark.createDataFrame([(unit * 200_000,)], "h string").select(F.length(plain_text(F.col("h"))).alias("n"))
        began = time.monotonic()
        rows.collect()
        assert time.monotonic() - began < 20, unit


def test_damaged_and_gzipped_files(spark):
    record = lambda uri, length, block: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {uri}\r\nContent-Length: {length}\r\n\r\n".encode() + block + b"\r\n\r\n"
    body = b"HTTP/1.1 200 OK\r\n\r\nhello WARC/1.0 not a record"
    good = record("a", len(body), body)
    files = [
        good + b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 10",  # a head without an end
        record("b", "many", body) + good,  # a length that is no number
        gzip.compress(good) + gzip.compress(good),
        gzip.compress(good) + gzip.compress(good)[:30],
        record("c", 10**9, body),  # cut off
        record("d", 5, b"HTTP/"),  # no body
        b"", b"\x1f\x8b", b"no records",
    ]
    rows = read_responses(spark.createDataFrame([(f,) for f in files], "content binary")).collect()
    found = sorted((r.target_uri, r.payload[:5]) for r in rows)
    assert found == [("a", "hello")] * 5 + [("b", ""), ("c", "hello"), ("d", "")]


def test_names_of_characters_are_looked_up_once(spark):
    plan = spark.range(1).selectExpr("string(id) as t").select(resolved(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("str_to_map(") == 2  # the name of the column and the expression
