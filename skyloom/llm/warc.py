"""WARC derivatives (operator 9): metadata and plain-text conversion records of response records.

Each response gives two records that refer to it: ``metadata`` (title, language, links as WARC fields) and
``conversion`` (the page's text). Both keep the response's identifier, address, date and payload digest and
its HTTP headers; their own ids follow from the response's id, so a repeated run writes equal records. All of
it is expressions over one scan; nothing is shuffled.

Edge cases: a null or empty body gives empty text and no title, language or links; a null address or id counts
as empty text in an identifier; repeated rows give records with equal ids; an empty table gives no rows; other
columns of the responses are ignored; very long bodies are treated whole, in time linear in their length; a
comment, title, script or style without an end goes to the end of the page; a reference to a character needs its
semicolon and stays as it is where it names none. Files may be gzipped, record by record or whole; a damaged end
of a file ends its records, and a record without a length has none of its block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: What is no text, and the ends of lines: patterns mean the same to Java and RE2.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<title\b.*?(?:</title>|\z)|<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)"
BLOCKS = r"(?i)</?(?:p|div|h[1-6]|li|ul|ol|tr|br|hr|article|section|nav|header|footer|main|aside|table|blockquote|pre|body|html)\b[^<>]*>"
TAGS = r"</?[a-zA-Z!?][^<>]*>"
#: (pattern, replacement) for white space, in order.
SPACES = [(r"[ \t\r\f\x{00A0}]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", "")]
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LANGUAGE = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]+)"
LINK = r"(?i)\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
#: Names of characters and what they stand for, those of HTML 5, the frequent ones first.
_FIRST = ["amp", "lt", "gt", "quot", "nbsp", "apos", "copy", "middot", "ndash", "mdash", "hellip", "eacute", "auml", "ouml", "uuml", "szlig"]
_NAMES = {n.removesuffix(";"): c for n, c in html5.items() if n.endswith(";")}
ENTITIES = {n: _NAMES[n] for n in _FIRST} | dict(sorted(_NAMES.items()))
#: Numbers that stand for another character: those of the code page 1252.
NUMBERS = {n: ord(bytes([n]).decode("cp1252")) for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
RECORDS = (
    "page_id long, kind string, record_id string, refers_to string, target_uri string, warc_date string,"
    " content_type string, source_headers string, source_digest string, block_digest string, content_length long, block string"
)


def resolved(text: Column) -> Column:
    """``text`` with its references to characters, named or by number, in place."""
    names = F.str_to_map(F.lit("\x01".join(f"{n}\x02{c}" for n, c in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))
    numbers = F.create_map(*(F.lit(x) for pair in NUMBERS.items() for x in pair))

    def one(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        digits = F.when(name.rlike(r"^#[0-9]{1,7}$"), F.substring(name, 2, 7).cast("int")).when(name.rlike(r"^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10).cast("int"))
        n = F.coalesce(numbers[digits], digits)
        n = F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), 0xFFFD).otherwise(n)
        char = F.when(part.startswith("#"), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(names[name])
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        known = F.when(F.contains(part, F.lit(";")), F.concat(char, rest))  # null where it names none, so it is looked up once
        return F.coalesce(known, F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")).otherwise(text)


def plain_text(html: Column) -> Column:
    """Text of a page: comments, title, scripts and styles go, block elements end lines, references are resolved."""
    out = F.coalesce(html, F.lit(""))
    for pattern, replacement in [(HIDDEN, ""), (BLOCKS, "\n"), (TAGS, "")]:
        out = F.regexp_replace(out, pattern, replacement)
    out = resolved(out)
    for pattern, replacement in SPACES:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def record_uuid(*parts: Column) -> Column:
    """``<urn:uuid:...>`` that follows from the parts."""
    h = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def responses_of_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record_id, target_uri, warc_date, http_headers, payload) of ``pages(page_id, url, html)``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    length = F.octet_length(html).cast("string")
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length, F.lit(CRLF * 2))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        record_uuid(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        headers.alias("http_headers"),
        html.alias("payload"),
    )


def derive(responses: DataFrame) -> DataFrame:
    """``RECORDS``: a metadata and a conversion record for each response (see ``responses_of_pages`` for its columns)."""
    body = F.coalesce(F.col("payload"), F.lit(""))
    field = lambda name, value: F.when(value != "", F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise("")
    title = F.trim(F.regexp_replace(resolved(F.regexp_extract(body, TITLE, 1)), r"[ \t\r\n\f]+", " "))
    address = lambda x: F.translate(resolved(F.when(F.substring(x, 1, 1).isin('"', "'"), F.substring(x, 2, F.length(x) - 2)).otherwise(x)), "\r\n\t", "")
    links = F.transform(F.regexp_extract_all(body, F.lit(LINK), 1), lambda x: F.concat(F.lit("outlink: "), address(x), F.lit(f" L a/@href{CRLF}")))
    fields = F.concat(field("title", title), field("language", F.lower(F.regexp_extract(body, LANGUAGE, 1))), F.array_join(links, ""))
    made = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("payload")).alias("block")),
    )
    digest = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    rows = responses.select(
        F.col("page_id"), F.col("record_id").alias("refers_to"), "target_uri", "warc_date",
        F.col("http_headers").alias("source_headers"), digest(body).alias("source_digest"), F.explode(made).alias("x"),
    )
    return rows.select(
        "page_id", "x.kind", record_uuid(F.col("x.kind"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri",
        "warc_date", "x.content_type", "source_headers", "source_digest", digest(F.col("x.block")).alias("block_digest"),
        F.octet_length("x.block").cast("long").alias("content_length"), "x.block",
    )


def warc_records(records: DataFrame) -> DataFrame:
    """(record_id, record binary): the records of ``derive`` as they stand in a WARC/1.1 file.

    Each line of the source's HTTP head is a field ``WARC-Source-Header``.
    """
    lines = F.filter(F.split(F.coalesce("source_headers", F.lit("")), CRLF), lambda x: x != "")
    source = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("WARC-Source-Header: "), x, F.lit(CRLF))), "")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit(CRLF))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("warc_date")),
        line("Content-Type", F.col("content_type")), line("WARC-Source-Payload-Digest", F.col("source_digest")),
        line("WARC-Block-Digest", F.col("block_digest")), source, line("Content-Length", F.col("content_length")), F.lit(CRLF),
    )
    return records.select("record_id", F.concat(head, F.col("block"), F.lit(CRLF * 2)).cast("binary").alias("record"))


def _unzipped(content: bytes) -> bytes:
    """Content of a gzip file of any number of members; what comes before a damaged place."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(content))
        except zlib.error:
            break
        content = member.unused_data
    return b"".join(out)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of each record of WARC content, gzipped or not."""
    content = _unzipped(content) if content[:2] == b"\x1f\x8b" else content
    starts, at = re.compile(rb"(?:\A|(?<=\n))WARC/\d"), 0
    while (found := starts.search(content, at)) and (end := content.find(b"\r\n\r\n", found.start())) >= 0:
        lines = content[found.start() : end].decode("utf-8", "replace").split(CRLF)[1:]
        fields: dict[str, str] = {}
        for name, _, value in (x.partition(":") for x in lines):
            key = name.strip().lower()
            fields[key] = f"{fields[key]}\n{value.strip()}" if key in fields else value.strip()
        length = fields.get("content-length", "")
        size = int(length) if re.fullmatch("[0-9]{1,18}", length) else 0
        yield fields, content[end + 4 : end + 4 + size]
        at = end + 4 + size


def read_responses(files: DataFrame) -> DataFrame:
    """Responses, in the columns of ``responses_of_pages``, of ``files(content binary)`` (a binaryFile scan)."""
    schema = "page_id long, record_id string, target_uri string, warc_date string, http_headers string, payload string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for fields, block in parse_records(content.as_py() or b""):
                    if fields.get("warc-type") == "response":
                        head, mark, body = block.partition(b"\r\n\r\n")
                        charset = re.search(rb"(?i)charset=([\w-]+)", head)
                        try:
                            text = body.decode(charset[1].decode() if charset else "utf-8", "replace")
                        except LookupError:
                            text = body.decode("utf-8", "replace")
                        row = [None, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"), (head + mark).decode("latin-1"), text]
                        kinds = [pa.int64()] + [pa.string()] * 5
                        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    return files.select("content").mapInArrow(run, schema)


def op9_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return derive(responses_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def _q(x: str) -> str:
    """A string literal; line ends by number."""
    return "'" + x.replace("'", "''").replace("\r", "' || chr(13) || '").replace("\n", "' || chr(10) || '") + "'"


def _sql_resolved(text: str) -> str:
    digits = "case when regexp_matches(n, '^#[0-9]{1,7}$') then cast(substr(n, 2) as int) when regexp_matches(n, '^#[xX][0-9a-fA-F]{1,6}$') then cast('0x' || substr(n, 3) as int) end"
    number = f"list_transform([{digits}], lambda d: coalesce([{', '.join(map(str, NUMBERS.values()))}][list_position([{', '.join(map(str, NUMBERS))}], d)], d))[1]"
    number = f"list_transform([{number}], lambda d: case when d = 0 or d between 55296 and 57343 or d > 1114111 then 65533 else d end)[1]"
    char = f"case when n like '#%' then chr({number}) else chars[list_position(names, n)] end"
    one = f"list_transform([split_part(p, ';', 1)], lambda n: case when contains(p, ';') then coalesce({char} || substr(p, length(n) + 2), '&' || p) else '&' || p end)[1]"
    return f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: case when i = 1 then p else {one} end), '')"


def _sql_replaced(text: str, rules: list[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(replacement)}, 'g')"
    return text


def _sql_text(column: str) -> str:
    shown = _sql_replaced(f"coalesce({column}, '')", [(HIDDEN, ""), (BLOCKS, "\n"), (TAGS, "")])
    return _sql_replaced(_sql_resolved(shown), SPACES)


def _sql_uuid(*parts: str) -> str:
    h = f"md5({" || '|' || ".join(f"coalesce(cast({p} as varchar), '')" for p in parts)})"
    cuts = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {cuts} || '>')"


ORACLE_SQL = rf"""
with entities as (select [{", ".join(map(_q, ENTITIES))}] as names, [{", ".join(map(_q, ENTITIES.values()))}] as chars),
r as (
  select page_id, coalesce(html, '') as payload, url as target_uri, {_sql_uuid("'response'", "page_id", "url")} as refers_to,
    'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) as source_headers
  from pages),
f as (
  select *, trim(regexp_replace({_sql_resolved(f"regexp_extract(payload, {_q(TITLE)}, 1)")}, '[ \t\r\n\f]+', ' ', 'g')) as title,
    lower(regexp_extract(payload, {_q(LANGUAGE)}, 1)) as lang,
    array_to_string(list_transform(regexp_extract_all(payload, {_q(LINK)}, 1),
      lambda x: 'outlink: ' || translate({_sql_resolved("case when x[1] in (chr(34), chr(39)) then x[2:-2] else x end")}, chr(13) || chr(10) || chr(9), '') || ' L a/@href' || chr(13) || chr(10)), '') as links
  from r, entities),
x as (
  select page_id, refers_to, target_uri, source_headers, payload, 'metadata' as kind, 'application/warc-fields' as content_type,
    case when title <> '' then 'title: ' || title || chr(13) || chr(10) else '' end
      || case when lang <> '' then 'language: ' || lang || chr(13) || chr(10) else '' end || coalesce(links, '') as block from f
  union all
  select page_id, refers_to, target_uri, source_headers, payload, 'conversion', 'text/plain; charset=utf-8', {_sql_text("payload")} from r, entities)
select page_id, kind, {_sql_uuid("kind", "refers_to")} as record_id, refers_to, target_uri, '2024-01-01T00:00:00Z' as warc_date,
  content_type, source_headers, 'sha256:' || sha256(payload) as source_digest, 'sha256:' || sha256(block) as block_digest,
  cast(strlen(block) as bigint) as content_length, block
from x
"""
