"""Queries of readers and writers: rows of the tables written in a format and read back by its reader.

A file holds the rows of one track or voxel; its content is put together by Spark.
"""

from __future__ import annotations

import math
import struct
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import checks, cloud, compose, windows
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, TELEMETRY_SQL, frames, points, rounded, small_cloud, table, telemetry
from skyloom.session import shared_dir
from skyloom.sources import autopilot, flight_record, sinks
from skyloom.sources import telemetry as readers

T, P, R = TELEMETRY_SQL, POINTS_SQL, FRAMES_SQL
#: Coordinates with three decimals, made of the row's number, as texts.
LAT_SQL, LON_SQL = "28 + (event_id % 1000) / 1000e0", "77 + (event_id * 7 % 1000) / 1000e0"


def _decimals(whole: int, n: Column) -> Column:
    return F.concat(F.lit(f"{whole}."), F.lpad(F.pmod(n, F.lit(1000)).cast("string"), 3, "0"))


def _rows(spark, sf_dir) -> DataFrame:
    i = F.col("event_id")
    made = telemetry(spark, sf_dir).withColumns({"lat_s": _decimals(28, i), "lon_s": _decimals(77, i * 7), "alt_s": F.col("value").cast("string")})
    return made.withColumn("iso", F.date_format(F.timestamp_seconds(F.lit(1704067200) + i), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def _texts(rows: DataFrame, line: Column, head: str = "", tail: str = "", between: str = "\n", key: str = "track", order: str = "event_id") -> DataFrame:
    """(source, text): a file for each key, its lines in order; made before they are gathered, as an aggregate's input is interpreted."""
    rows = rows.select(F.col(key).cast("string").alias("source"), F.struct(F.col(order).alias("o"), line.alias("line")).alias("__line"))
    lines = F.transform(F.array_sort(F.collect_list("__line")), lambda x: x["line"])
    return rows.groupBy("source").agg(F.concat(F.lit(head), F.array_join(lines, between), F.lit(tail)).alias("text"))


@register("srt_round_trip", f"""select cast(track as varchar) as source, round((us % 86400000000) / 1e6, 3) as t, round({LAT_SQL}, 6) as lat, round({LON_SQL}, 6) as lon, value as alt_gps, event_id % 120 + 0.5e0 as alt_baro, case when event_id % 2 = 0 then 24.0e0 end as focal_mm, event_id % 20 + 0.0e0 as sats from {T}""")
def srt_round_trip(spark, sf_dir):
    """Telemetry as cues of subtitle files."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    at = F.round((F.col("us") % 86400000000) / 1000000, 3)
    body = F.concat(F.lit("<font size=28>[latitude: "), F.col("lat_s"), F.lit("] [longitude: "), F.col("lon_s"), F.lit("] [rel_alt: "), (i % 120).cast("string"), F.lit(".500 abs_alt: "), F.col("alt_s"), F.when(i % 2 == 0, F.lit("] [focal_len : 240")).otherwise(F.lit("")), F.lit("] [satellites : "), (i % 20).cast("string"), F.lit("]</font>"))
    cue = F.concat(i.cast("string"), F.lit("\r\n"), S.format_cue(at), F.lit(" --> "), S.format_cue(at + 1), F.lit("\r\n"), body, F.lit("\r\n"))
    files = _texts(rows, cue, between="\r\n").select("source", readers.decode_text(F.encode("text", "UTF-8")).alias("text"))
    return rounded(readers.srt_rows(files).select("source", "t", "lat", "lon", "alt_gps", "alt_baro", "focal_mm", "sats"))


@register("csv_round_trip", f"""select event_id % 80000 + 0.0e0 as t, round({LAT_SQL}, 6) as lat, round({LON_SQL}, 6) as lon, case when event_id % 11 > 0 then value end as alt_gps from {T} where event_id % 13 > 0""")
def csv_round_trip(spark, sf_dir):
    """Telemetry as a flight table with odd headers, bad numbers and (0, 0) fixes."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    none = i % 13 == 0
    made = rows.select((i % 80000).cast("string").alias("Timestamp"), F.when(none, "0").otherwise(F.col("lat_s")).alias("OSD.latitude"), F.when(none, "0").otherwise(F.col("lon_s")).alias("OSD.longitude"), F.when(i % 11 > 0, F.col("alt_s")).otherwise(F.lit("n/a")).alias("OSD.altitude [m]"))
    path = f"{shared_dir(spark)}/flight-{uuid.uuid4().hex}"
    made.write.option("header", True).option("sep", ";").csv(path)
    return rounded(readers.csv_rows(spark, path).select("t", "lat", "lon", "alt_gps"))


_TIMED_SQL = f"""select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round({LAT_SQL}, 6) as lat, round({LON_SQL}, 6) as lon, value as alt_gps from {T}"""


def _timed(df: DataFrame) -> DataFrame:
    return rounded(df.select("source", "t", "lat", "lon", "alt_gps"))


@register("gpx_round_trip", _TIMED_SQL)
def gpx_round_trip(spark, sf_dir):
    """Telemetry as track points of GPX files."""
    line = F.concat(F.lit('<trkpt lat="'), F.col("lat_s"), F.lit('" lon="'), F.col("lon_s"), F.lit('"><ele>'), F.col("alt_s"), F.lit("</ele><time>"), F.col("iso"), F.lit("</time></trkpt>"))
    return _timed(readers.xml_points(_texts(_rows(spark, sf_dir), line, "<gpx><trk><trkseg>", "</trkseg></trk></gpx>")))


@register("kml_round_trip", _TIMED_SQL)
def kml_round_trip(spark, sf_dir):
    """Telemetry as a KML track."""
    line = F.concat(F.lit("<when>"), F.col("iso"), F.lit("</when><gx:coord>"), F.col("lon_s"), F.lit(" "), F.col("lat_s"), F.lit(" "), F.col("alt_s"), F.lit("</gx:coord>"))
    return _timed(readers.xml_points(_texts(_rows(spark, sf_dir), line, "<kml><gx:Track>", "</gx:Track></kml>")))


@register("geojson_round_trip", _TIMED_SQL)
def geojson_round_trip(spark, sf_dir):
    """Telemetry as timed points of GeoJSON files."""
    line = F.concat(F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), F.concat_ws(",", "lon_s", "lat_s", "alt_s"), F.lit(']},"properties":{"time":"'), F.col("iso"), F.lit('"}}'))
    return _timed(readers.geojson_points(_texts(_rows(spark, sf_dir), line, '{"type":"FeatureCollection","features":[', "]}", ",")))


@register("geo_round_trip", f"""select cast(track as varchar) as source, 'frame_' || event_id || '.jpg' as name, round({LON_SQL}, 6) as lon, round({LAT_SQL}, 6) as lat, round(value, 3) as alt from {T}""")
def geo_round_trip(spark, sf_dir):
    """Telemetry as geo.txt files."""
    line = F.concat(F.lit("frame_"), F.col("event_id").cast("string"), F.lit(".jpg  "), F.concat_ws(" ", "lon_s", "lat_s", "alt_s"))
    return rounded(readers.geo_rows(_texts(_rows(spark, sf_dir), line, "EPSG:4326\n", "\n")))


@register("geo_lines", f"""select 0 as n, 'EPSG:4326' as line union all select row_number() over (order by event_id), 'f' || event_id || ' 77.' || lpad(cast(event_id * 7 % 1000 as varchar), 3, '0') || '000000 28.' || lpad(cast(event_id % 1000 as varchar), 3, '0') || '000000 ' || (event_id % 90) || '.500' from {T} where event_id % 5 > 0""")
def geo_lines(spark, sf_dir):
    """Lines of one geo.txt, numbered without one task that holds them."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    names = rows.select("event_id", F.concat(F.lit("f"), i.cast("string")).alias("name"))
    fixes = rows.where(i % 5 > 0).select("event_id", F.col("lat_s").cast("double").alias("lat"), F.col("lon_s").cast("double").alias("lon"), (i % 90 + 0.5).alias("alt_gps"))
    return sinks.geo_lines(names, fixes, "event_id", "name")


@register("gcp_round_trip", f"""select cast(track as varchar) as source, 'EPSG:32643' as crs, name, count(*) as seen, name like 'chk%' as "check", min(x) as x, min(y) as y from
      (select *, case when event_id % 3 = 0 then 'chk' else 'gcp' end || (event_id % 4) as name, 700000 + event_id % 4 + 0.0e0 as x, 3100000 + event_id % 4 + 0.0e0 as y from {T}) group by all""")
def gcp_round_trip(spark, sf_dir):
    """Control points with their observations as GCP lists."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    name = F.concat(F.when(i % 3 == 0, "chk").otherwise("gcp"), (i % 4).cast("string"))
    line = F.concat_ws(" ", (700000 + i % 4).cast("string"), (3100000 + i % 4).cast("string"), F.lit("210.5"), (i % 1920).cast("string"), (i % 1080).cast("string"), F.concat(F.lit("f"), i.cast("string"), F.lit(".jpg")), name)
    found = readers.gcp_rows(_texts(rows, line, "EPSG:32643\n", "\n"))
    w = found.select("source", "crs", "name", F.explode("observations").alias("o"), "check", "x", "y")
    return w.groupBy("source", "crs", "name", "check").agg(F.count("*").alias("seen"), F.min("x").alias("x"), F.min("y").alias("y"))


def _hex(n: Column, bytes_: int) -> Column:
    """A whole number as big-endian hex digits of so many bytes."""
    return F.right(F.lpad(F.hex(n.cast("long")), F.lit(16), F.lit("0")), F.lit(2 * bytes_))


def _little(n: Column, bytes_: int) -> Column:
    h = _hex(n, bytes_)
    return F.concat(*(F.substring(h, 2 * k + 1, 2) for k in range(bytes_ - 1, -1, -1)))


def _contents(rows: DataFrame, piece: Column, head: Column | None = None, key: str = "track", order: str = "event_id") -> DataFrame:
    """(source, content): a file for each key of pieces given as hex digits, in order; see ``_texts``."""
    rows = rows.select(F.col(key).cast("string").alias("source"), F.struct(F.col(order).alias("o"), F.unhex(piece).alias("p")).alias("__piece"))
    pieces = F.transform(F.array_sort(F.collect_list("__piece")), lambda x: F.hex(x["p"]))
    made = rows.groupBy("source").agg(pieces.alias("pieces"))
    whole = F.array_join("pieces", "")
    return made.select("source", F.unhex(whole if head is None else F.concat(head, whole)).alias("content"))


@register("klv_round_trip", f"""select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round((event_id * 7919 % 2147483647) * (90 / 2147483647e0), 7) as lat, round(-(event_id * 104729 % 2147483647) * (180 / 2147483647e0), 7) as lon,
      round(-900 + (event_id % 65536) * (19900 / 65535e0), 7) as alt_gps, round((event_id * 31 % 65536) * (360 / 65535e0), 7) as yaw, event_id % 4 > 0 as checksum_ok, 1 as unknown_tags from {T}""")
def klv_round_trip(spark, sf_dir):
    """Telemetry as ST 0601 local sets with long lengths, an unknown tag and checksums."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    lon = F.lit(1 << 32) - (i * 104729 % 2147483647)
    tags = [("0208", _hex(F.lit(1704067200000000) + i * 1000000, 8)), ("0d04", _hex(i * 7919 % 2147483647, 4)), ("0e04", _hex(F.when(lon == 1 << 32, 0).otherwise(lon), 4)), ("0f02", _hex(i % 65536, 2)), ("0502", _hex(i * 31 % 65536, 2)), ("814803", F.lit("abcdef"))]
    body = F.concat(*(F.concat(F.lit(t), v) for t, v in tags))
    length = 10 + 6 + 6 + 4 + 4 + 6 + 4
    rows = rows.withColumn("set", F.concat(F.lit(readers.KLV_KEY.hex() + f"8200{length:02x}"), body, F.lit("0102")))
    size = F.length("set") / 2
    byte = lambda k: F.conv(F.substring(F.col("set"), 2 * k + 1, F.lit(2)), 16, 10).cast("long")
    check = F.aggregate(F.sequence(F.lit(0), (size - 1).cast("int")), F.lit(0).cast("long"), lambda a, k: a + byte(k) * F.when(k % 2 == 0, 256).otherwise(1)) % 65536
    rows = rows.withColumn("check", check)
    sound = F.when(i % 4 > 0, F.col("check")).otherwise((F.col("check") + 1) % 65536)
    found = readers.klv_rows(_contents(rows, F.concat("set", _hex(sound, 2))))
    return rounded(found.select("source", "t", "lat", "lon", "alt_gps", "yaw", "checksum_ok", "unknown_tags"), 7)


@register("klv_damaged", f"""with k as (select * from {T} where event_id % 3 < 2) select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round((event_id * 7919 % 2147483647) * (90 / 2147483647e0), 7) as lat,
      case when event_id % 3 = 0 then round((event_id * 104729 % 2147483647) * (180 / 2147483647e0), 7) end as lon, case when event_id % 3 = 0 then round((event_id * 31 % 65536) * (360 / 65535e0), 7) end as yaw, 1 as unknown_tags from k""")
def klv_damaged(spark, sf_dir):
    """A tag that runs over the end of its set ends the set, not the next one; a set with a bad length is passed over."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    head = F.concat(F.lit("0208"), _hex(F.lit(1704067200000000) + i * 1000000, 8), F.lit("814801ab0d04"), _hex(i * 7919 % 2147483647, 4))
    tail = F.concat(F.when(i % 3 == 1, F.lit("0528")).otherwise(F.lit("0502")), _hex(i * 31 % 65536, 2), F.lit("0e04"), _hex(i * 104729 % 2147483647, 4))
    length = F.when(i % 3 == 2, F.lit("88" + "7f" * 8)).otherwise(F.lit(f"{10 + 4 + 6 + 4 + 6:02x}"))
    found = readers.klv_rows(_contents(rows, F.concat(F.lit(readers.KLV_KEY.hex()), length, head, tail)))
    return rounded(found.select("source", "t", "lat", "lon", "yaw", "unknown_tags"), 7)


@register("srt_dialects", f"""select cast(track as varchar) as source, round((us % 86400000000) / 1e6, 3) as t, round({LAT_SQL}, 6) as lat, round({LON_SQL}, 6) as lon, case event_id % 3 when 1 then event_id % 90 + 0.5e0 when 2 then 12.25e0 end as alt_baro,
      case when event_id % 3 = 1 then event_id % 20 + 0.0e0 end as sats, event_id % 3 = 0 as rtk from {T}""")
def srt_dialects(spark, sf_dir):
    """Keys with digits, values in round or square brackets, heights in either case, markers of carrier-phase fixes."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    at = F.round((F.col("us") % 86400000000) / 1000000, 3)
    named = F.concat(F.lit("[latitude: "), F.col("lat_s"), F.lit("] [longitude: "), F.col("lon_s"), F.lit("] [rtk_flag: 50]"))
    tuple_ = F.concat(F.lit("F/2.8, GPS ["), F.concat_ws(", ", "lon_s", "lat_s", (i % 20).cast("string")), F.lit("], h "), (i % 90).cast("string"), F.lit(".5m"))
    mixed = F.concat(F.lit("<b>gps_lat: "), F.col("lat_s"), F.lit(", gps_long: "), F.col("lon_s"), F.lit(" iso2: x100 latitude: none</b> D 5m, H 12.25m"))
    body = F.when(i % 3 == 0, named).when(i % 3 == 1, tuple_).otherwise(mixed)
    cue = F.concat(i.cast("string"), F.lit("\n"), S.format_cue(at), F.lit(" --> "), S.format_cue(at + 1), F.lit("\n"), body, F.lit("\n"))
    return rounded(readers.srt_rows(_texts(rows, cue)).select("source", "t", "lat", "lon", "alt_baro", "sats", "rtk"))


def _headed_sql(yaw: str) -> str:
    """Headings of two rows in three, and of the third between its neighbours, the short way round."""
    return f"""h as (select *, {yaw} as own, last_value(case when event_id % 3 > 0 then {{'i': event_id, 'y': {yaw}}} end ignore nulls) over w as a,
      first_value(case when event_id % 3 > 0 then {{'i': event_id, 'y': {yaw}}} end ignore nulls) over (partition by track order by event_id rows between current row and unbounded following) as b
      from (select * exclude (yaw) from {T}) window w as (partition by track order by event_id rows between unbounded preceding and current row)),
    d as (select *, (((b.y - a.y + 180) % 360) + 360) % 360 - 180 as way from h),
    y as (select *, round((((case when a.y is null or b.y is null then coalesce(a.y, b.y) else a.y + case when way = -180 and b.y > a.y then 180 else way end * case when b.i > a.i then (event_id - a.i) / (b.i - a.i) else 0 end end) % 360) + 360) % 360 + 0.00137, 2) as yaw from d)"""


def _ulog_message(kind: str, body: str) -> str:
    return struct.pack("<H", len(body) // 2).hex() + kind.encode().hex() + body


@register("ulog_round_trip", f"""with {_headed_sql("(event_id % 15) * 24.0e0")}, o as (select track, median((event_id % 3 - 1) * 1000 + 1704067200000000 - 5) as shift from {T} where event_id % 4 > 0 group by track)
    select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round((event_id * 7919 % 900000000 + 1) / 1e7, 7) as lat, round((event_id * 104729 % 1800000000 + 1) / 1e7, 7) as lon, round((event_id % 5000) / 10e0, 7) as alt_gps,
      case when yaw = 360 then 0 else yaw end as yaw, (event_id * 1000000 + 5 + shift)::bigint as wall_us, (event_id % 20)::bigint as sats from y left join o using (track)""")
def ulog_round_trip(spark, sf_dir):
    """Telemetry as ULog files: format definitions, two topics, a clock by the median, headings between, damaged stretches."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    formats = ["vehicle_gps_position:uint64_t timestamp;uint64_t time_utc_usec;int32_t lat;int32_t lon;int32_t alt;uint8_t satellites_used;uint8_t[3] _padding0;", "vehicle_attitude:uint64_t timestamp;float[4] q;"]
    head = autopilot.ULOG_MAGIC.hex() + "01" + "00" * 8 + "".join(_ulog_message("F", f.encode().hex()) for f in formats)
    head += _ulog_message("A", "000700" + b"vehicle_gps_position".hex()) + _ulog_message("A", "000900" + b"vehicle_attitude".hex())
    at = _little(i * 1000000 + 5, 8)
    utc = F.when(i % 4 == 0, F.lit(0)).otherwise(F.lit(1704067200000000) + i * 1000000 + (i % 3 - 1) * 1000)
    fix = F.concat(F.lit("1f0044" + "0700"), at, _little(utc, 8), _little(i * 7919 % 900000000 + 1, 4), _little(i * 104729 % 1800000000 + 1, 4), _little(i % 5000 * 100, 4), _hex(i % 20, 1))
    turns = [struct.pack("<4f", math.cos(math.radians(h * 12)), 0, 0, math.sin(math.radians(h * 12))).hex() for h in range(15)]
    attitude = F.concat(F.lit("1a0044" + "0900"), at, F.element_at(F.array(*map(F.lit, turns)), (i % 15 + 1).cast("int")))
    damage = F.lit("05007a" + "ff" * 3 + _ulog_message("S", autopilot.ULOG_SYNC.hex()))
    piece = F.concat(F.when(i % 3 > 0, attitude).otherwise(F.lit("")), fix, F.when(i % 5 == 0, damage).otherwise(F.lit("")))
    found = autopilot.ulog_rows(_contents(rows, piece, F.lit(head)))
    yaw = F.round(F.col("yaw") + 0.00137, 2)  # off the halves
    return rounded(found.select("source", "t", "lat", "lon", "alt_gps", F.when(yaw == 360, 0.0).otherwise(yaw).alias("yaw"), F.unix_micros("wall_time").alias("wall_us"), "sats"), 7)


def _flash_format(kind: int, length: int, name: str, form: str, columns: str) -> str:
    return (autopilot.FLASH_HEAD + bytes([autopilot.FLASH_FMT, kind, length]) + name.encode().ljust(4, b"\0") + form.encode().ljust(16, b"\0") + columns.encode().ljust(64, b"\0")).hex()


@register("dataflash_round_trip", f"""with {_headed_sql("(event_id * 37 % 36000) / 100e0")}, g as (select * from y where event_id % 6 > 0)
    select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round((event_id * 7919 % 900000000 + 1) / 1e7, 7) as lat, round(-(event_id * 104729 % 1800000000 + 1) / 1e7, 7) as lon, round((event_id % 5000) / 100e0, 7) as alt_gps,
      case when yaw = 360 then 0 else yaw end as yaw, (315964800 + 2296 * 604800 + event_id - 18) * 1000000 as wall_us, (event_id % 20)::bigint as sats from g""")
def dataflash_round_trip(spark, sf_dir):
    """Telemetry as DataFlash logs: their own format messages, scaled numbers, week times, fixes below 3-D left out, damage."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    head = _flash_format(128, 89, "FMT", "BBnNZ", "Type,Length,Name,Format,Columns") + _flash_format(130, 31, "GPS", "QBIHBLLe", "TimeUS,Status,GMS,GWk,NSats,Lat,Lng,Alt") + _flash_format(131, 15, "ATT", "QhC", "TimeUS,Roll,Yaw")
    at = _little(i * 1000, 8)
    lon = F.lit(1 << 32) - (i * 104729 % 1800000000 + 1)
    fix = F.concat(F.lit("a39582"), at, _hex(F.when(i % 6 == 0, 2).otherwise(3), 1), _little(i % 604800 * 1000, 4), _little(F.lit(2296) + F.floor(i / 604800), 2), _hex(i % 20, 1), _little(i * 7919 % 900000000 + 1, 4), _little(lon, 4), _little(i % 5000, 4))
    attitude = F.concat(F.lit("a39583"), at, F.lit("0000"), _little(i * 37 % 36000, 2))
    # noise, a start of an unknown type, a message cut short
    damage = F.when(i % 5 == 0, F.lit("00a3ff")).when(i % 5 == 1, F.lit("a395f0a3")).when(i % 5 == 2, F.lit("a3958200000000")).otherwise(F.lit(""))
    piece = F.concat(F.when(i % 3 > 0, attitude).otherwise(F.lit("")), fix, damage)
    found = autopilot.dataflash_rows(_contents(rows, piece, F.lit(head)))
    yaw = F.round(F.col("yaw") + 0.00137, 2)  # off the halves
    return rounded(found.select("source", "t", "lat", "lon", "alt_gps", F.when(yaw == 360, 0.0).otherwise(yaw).alias("yaw"), F.unix_micros("wall_time").alias("wall_us"), "sats"), 7)


@register("mavlink_round_trip", f"""with g as (select * from {T} where event_id % 7 > 0)
    select cast(track as varchar) as source, event_id - min(event_id) over (partition by track) + 0.0e0 as t, round((event_id * 7919 % 900000000 + 1) / 1e7, 7) as lat, round((event_id * 104729 % 1800000000 + 1) / 1e7, 7) as lon, round((event_id % 5000) / 1e3, 7) as alt_gps,
      round((event_id % 300) / 1e3, 7) as alt_baro, case when event_id % 9 > 0 then round((event_id * 37 % 36000) / 100e0, 7) end as yaw from g""")
def mavlink_round_trip(spark, sf_dir):
    """Telemetry as a ground station's log: frames of both versions, cut zeros, a signature, bad checksums left out."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    heading = F.when(i % 9 == 0, 65535).otherwise(i * 37 % 36000)
    payload = F.concat(_little(i, 4), _little(i * 7919 % 900000000 + 1, 4), _little(i * 104729 % 1800000000 + 1, 4), _little(i % 5000, 4), _little(i % 300, 4), F.lit("00" * 6), _little(heading, 2))
    cut = F.regexp_replace(payload, "^((?:..)*?)(?:00)+$", "$1")
    signed = i % 4 == 1
    first = F.concat(F.lit("1c000101" + "21"), payload)
    second = F.concat(_hex(F.length(cut) / 2, 1), F.when(signed, "01").otherwise("00"), F.lit("00000101" + "210000"), cut)
    rows = rows.withColumn("covered", F.concat(F.when(i % 2 == 0, first).otherwise(second), F.lit(f"{autopilot.MAV_POSITION_SEED:02x}")))
    byte = lambda k: F.conv(F.substring(F.col("covered"), 2 * k + 1, F.lit(2)), 16, 10).cast("long")

    # a byte's place in the table is read once; the shifts written out would read it again in each of their terms
    table = F.array(*(F.lit(x) for x in autopilot.X25))

    def step(crc: Column, k: Column) -> Column:
        return F.shiftright(crc, 8).bitwiseXOR(F.get(table, byte(k).bitwiseXOR(crc).bitwiseAND(F.lit(255)).cast("int")))

    crc = F.aggregate(F.sequence(F.lit(0), (F.length("covered") / 2 - 1).cast("int")), F.lit(65535).cast("long"), step)
    rows = rows.withColumn("crc", crc)
    sound = F.when(i % 7 == 0, F.col("crc").bitwiseXOR(F.lit(1))).otherwise(F.col("crc"))
    frame = F.concat(F.when(i % 2 == 0, "fe").otherwise("fd"), F.expr("substr(covered, 1, length(covered) - 2)"), _little(sound, 2), F.when((i % 2 == 1) & signed, F.lit("ab" * 13)).otherwise(F.lit("")))
    found = autopilot.mavlink_rows(_contents(rows, F.concat(_hex(F.lit(1704067200000000) + i * 1000000, 8), frame)))
    return rounded(found.select("source", "t", "lat", "lon", "alt_gps", "alt_baro", "yaw"), 7)


@register("transport_round_trip", f"""select cast(track as varchar) as source, count(*) as sets, min(event_id) + 0.0e0 as first from {T} group by track""")
def transport_round_trip(spark, sf_dir):
    """Local sets carried in packets of a transport stream, between packets of another stream."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    body = F.concat(F.lit("0208"), _hex(i * 1000000 + 1, 8), F.lit("0d0400000001"), F.lit("0e0400000002"))
    piece = F.concat(F.lit(readers.KLV_KEY.hex() + "16"), body)  # 39 bytes
    packet = F.concat(F.lit("47410130" + f"{188 - 5 - 39:02x}"), F.repeat(F.lit("ff"), F.lit(188 - 5 - 39)), piece)
    other = F.concat(F.lit("47020010"), F.repeat(F.lit("00"), F.lit(184)))
    found = readers.klv_rows(_contents(rows, F.concat(other, packet, other)))
    first = F.min(F.floor(F.unix_micros("wall_time") / 1000000).cast("double"))
    return found.groupBy("source").agg(F.count("*").alias("sets"), first.alias("first"))


@register("gpmf_round_trip", f"""select cast(track as varchar) as source, event_id + 0.0e0 as t, round((event_id * 97 % 900000) / 10000e0, 6) as lat, round((event_id * 89 % 1800000) / 10000e0, 6) as lon, round((event_id % 5000) / 10e0, 6) as alt_gps from {T} where event_id % 6 > 0""")
def gpmf_round_trip(spark, sf_dir):
    """Telemetry as GPMF packets, those without a fix left out."""
    rows, i = _rows(spark, sf_dir), F.col("event_id")
    text = lambda x: x.encode().hex()
    scale = text("SCAL") + text("l") + "04" + "0005" + "".join(f"{n:08x}" for n in (10000, 10000, 10, 1000, 100))
    fix = F.concat(F.lit(text("GPSF") + text("L") + "04" + "0001"), _hex(F.when(i % 6 > 0, 3).otherwise(0), 4))
    sample = F.concat(F.lit(text("GPS5") + text("l") + "14" + "0001"), _hex(i * 97 % 900000, 4), _hex(i * 89 % 1800000, 4), _hex(i % 5000, 4), F.lit("00" * 8))
    inner = 8 + 28 + 12 + 28
    packet = F.concat(F.lit(text("DEVC") + "00" + "01" + f"{inner:04x}" + text("STRM") + "00" + "01" + f"{inner - 8:04x}" + scale), fix, sample)
    packets = rows.select(F.col("track").cast("string").alias("source"), i.cast("double").alias("start"), F.lit(1.0).alias("duration"), F.unhex(packet).alias("content"))
    return rounded(readers.gpmf_rows(packets).select("source", "t", "lat", "lon", "alt_gps"))


@register("ply_round_trip", f"""select cast(voxel as varchar) as source, x, round(y, 6) as y, z, view % 256 + 0.0e0 as r from {P}""")
def ply_round_trip(spark, sf_dir):
    """Points of each voxel as a PLY file."""
    p = points(spark, sf_dir).withColumn("y", F.round("y", 6))
    line = F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string"), F.col("z").cast("string"), (F.col("view") % 256).cast("string"))
    body = _texts(p, line, key="voxel", order="point_id").join(p.groupBy(F.col("voxel").cast("string").alias("source")).agg(F.count("*").alias("n")), "source")
    head = F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex "), F.col("n").cast("string"), F.lit("\nproperty double x\nproperty double y\nproperty double z\nproperty uchar red\nend_header\n"))
    files = body.select("source", F.encode(F.concat(head, "text"), "UTF-8").alias("content"))
    return readers.ply_rows(files).select("source", "x", "y", "z", "r")


@register("vis_round_trip", f"""select cast(voxel as varchar) as source, row_number() over (partition by voxel order by point_id, view) - 1 as point_id, cast(1 + point_id % 3 as bigint) as views, view as first_view, view + point_id % 3 as last_view from {P}""")
def vis_round_trip(spark, sf_dir):
    """Views of the points of each voxel as a visibility file."""
    p, k = points(spark, sf_dir).withColumn("place", F.struct("point_id", "view")), F.col("point_id") % 3
    ids = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), k), lambda d: _little(F.col("view") + d, 4)), "")
    files = _contents(p, F.concat(_little(1 + k, 4), ids), _little(F.size("pieces"), 8), "voxel", "place")
    return readers.vis_rows(files).select("source", "point_id", "views", F.element_at("view_ids", 1).alias("first_view"), F.element_at("view_ids", -1).alias("last_view"))


@register("obj_moved", f"""select event_id as n, case when event_id % 3 = 0 then 'f 1 2 3' else 'v ' || (2 * (event_id % 50) + 1) || '.0 ' || (-2 * (event_id % 70) + 5) || '.0 ' || (2 * (event_id % 9) - 3) || '.0' end as line from {T}""")
def obj_moved(spark, sf_dir):
    """Vertices of OBJ lines moved by a similarity, other lines as they were."""
    i = F.col("event_id")
    line = F.when(i % 3 == 0, "f 1 2 3").otherwise(F.concat_ws(" ", F.lit("v"), (i % 70).cast("string"), (i % 50).cast("string"), (i % 9).cast("string")))
    rows = telemetry(spark, sf_dir).select(i.alias("n"), line.alias("line"))
    return sinks.obj_moved(rows, 2.0, [0.0, 1.0, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 1.0], [1.0, 5.0, -3.0])


@register("report_json", f"""select channel, cast(json_object('channel', channel, 'n', count(*), 'last', max(event_id)) as varchar) as report from {T} group by channel""")
def report_json(spark, sf_dir):
    """Rows of reports as JSON."""
    rows = telemetry(spark, sf_dir).groupBy("channel").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
    return sinks.report_row(rows, ["channel"])


@register("history", f"""with s as (select video, priority as stage, count(*) as seconds, min(frame) as started from {R} group by 1, 2) select stage, started, seconds, row_number() over (partition by stage order by started) as run from s""")
def history(spark, sf_dir):
    """Runs added to a history in two goes and read with their numbers."""
    rows = frames(spark, sf_dir).groupBy("video", F.col("priority").alias("stage")).agg(F.count("*").alias("seconds"), F.min("frame").alias("started")).select("stage", "started", "seconds")
    path = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    for part in (0, 1):
        sinks.append_history(rows.where(F.col("started") % 2 == part), path)
    return compose.load_history(spark, path, "stage string, started long, seconds long").select("stage", "started", "seconds", "run")


@register("stored_table", f"""select class, source, count(*) as n, round(sum(z), 4) as z, 0 as absent from {P} where class = 'R' group by class, source""")
def stored_table(spark, sf_dir):
    """Points stored by class and read by it; a table that isn't there is empty."""
    path = f"{shared_dir(spark)}/points-{uuid.uuid4().hex}"
    sinks.write_table(points(spark, sf_dir), path, by=["class"])
    stored = compose.read_or_empty(spark, path, "z double, source string, class string").where("class = 'R'")
    absent = compose.read_or_empty(spark, f"{path}-none", "z double").agg(F.count("*").alias("absent"))
    return stored.groupBy("class", "source").agg(F.count("*").alias("n"), F.round(F.sum("z"), 4).alias("z")).crossJoin(F.broadcast(absent))


@register("widened", f"""select event_id, channel as a, case when event_id % 2 = 0 then 'even' end as b from {T}""")
def widened(spark, sf_dir):
    """Chosen entries of a map as columns."""
    i = F.col("event_id")
    pairs = F.map_from_entries(F.filter(F.array(F.struct(F.lit("a").alias("k"), F.col("channel").alias("v")), F.when(i % 2 == 0, F.struct(F.lit("b").alias("k"), F.lit("even").alias("v")))), lambda x: x.isNotNull()))
    return compose.widened(telemetry(spark, sf_dir).select("event_id", pairs.alias("m")), ["event_id"], "m", ["a", "b"])


@register("first_folder_wins", f"""select channel as kind, track as folder, event_id from (select *, row_number() over (partition by channel order by track, event_id) as k from {T}) where k = 1""")
def first_folder_wins(spark, sf_dir):
    """For each kind the row of the first folder."""
    rows = telemetry(spark, sf_dir).select(F.col("channel").alias("kind"), F.col("track").alias("folder"), "event_id")
    return compose.first_folder_wins(rows.withColumn("place", F.struct("folder", "event_id")), "kind", "place").select("kind", "folder", "event_id")


@register("posed_points", f"""select point_id, case when v in (select s_suppkey from supplier where s_suppkey % 3 > 0) then v else -1 end as view from (select point_id, unnest([view, view + 1]) as v from {P})""")
def posed_points(spark, sf_dir):
    """Views of points, -1 where the camera has no pose."""
    cams = table(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("cam"))
    rows = points(spark, sf_dir).select("point_id", F.array("view", F.col("view") + 1).alias("views"))
    return checks.posed_points(rows, cams, "views", "cam").select("point_id", "view")


@register("points_in_reach", """with e as (select vec_id as id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings) select a.id, count(*) as n from e a join e b on a.id <> b.id and sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.05 group by a.id""")
def points_in_reach(spark, sf_dir):
    """Points in a circle around each, by grid cells."""
    c = small_cloud(spark, sf_dir).withColumnRenamed("point_id", "id")
    return cloud.radius_pairs(c, c, "id", "id", ["x", "y"], 0.05).where("id <> other").groupBy("id").agg(F.count("*").alias("n"))


@register("nearest_confidence", """with e as (select vec_id as id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y, cast(embedding[3] as double) as z, label from embeddings), v as (select * from e where id % 3 = 0), m as (select * from e where id % 3 > 0),
    p as (select v.id, m.label, row_number() over (partition by v.id order by sqrt(pow(v.x - m.x, 2) + pow(v.y - m.y, 2) + pow(v.z - m.z, 2)), m.id) as k from v join m on sqrt(pow(v.x - m.x, 2) + pow(v.y - m.y, 2) + pow(v.z - m.z, 2)) <= 0.15)
    select v.id, case when p.label is null then 'fill' else 'measured' end as source, coalesce(p.label, -1) as confidence from v left join p on p.id = v.id and p.k = 1""")
def nearest_confidence(spark, sf_dir):
    """Faces and vertices with the confidence of the nearest measured point, else filled."""
    c = small_cloud(spark, sf_dir)
    mesh = c.where("point_id % 3 = 0").withColumnRenamed("point_id", "id")
    dense = c.where("point_id % 3 > 0")
    near = cloud.nearest_within(mesh, dense, "id", "point_id", ["x", "y", "z"], 0.15)
    found = near.join(dense.select(F.col("point_id").alias("nearest"), "zone"), "nearest", "left")
    return found.select("id", F.when(F.col("zone").isNull(), "fill").otherwise("measured").alias("source"), F.coalesce("zone", F.lit(-1)).alias("confidence"))


@register("authentic_places", f"""select track, round(min(2 * 6371000 * asin(sqrt(least(1, pow(sin((radians(28) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(28)) * pow(sin(radians(77 - lon) / 2), 2))))), 3) as metres, bool_or(channel not in ('click', 'view')) as odd from {T} group by track""")
def authentic_places(spark, sf_dir):
    """Distance of each track from a recorded place, and channels that aren't of its kind."""
    rows = telemetry(spark, sf_dir)
    near = checks.nearest_place(rows.withColumns({"hlat": F.lit(28.0), "hlon": F.lit(77.0)}), "track", "lat", "lon", "hlat", "hlon")
    odd = rows.withColumn("kind", F.lit("web")).groupBy("track").agg(F.bool_or(checks.extension_mismatch("channel", "kind", {"web": ("click", "view")})).alias("odd"))
    return near.withColumn("metres", F.round("metres", 3)).join(odd, "track")


@register("track_chunks", f"""with recursive n as (select video, count(*) as n from {R} group by video), c as (select video, n, 0::bigint as start, case when n - 4 <= 1 then n else 4 end as stop from n
      union all select video, n, stop - 1, case when n - (stop + 3) <= 1 then n else stop + 3 end from c where stop < n) select video, start, stop from c""")
def track_chunks(spark, sf_dir):
    """Overlapping chunks of each series; a short tail joins the chunk before."""
    n = frames(spark, sf_dir).groupBy("video").agg(F.count("*").alias("n"))
    return n.select("video", F.explode(windows.chunk_spans(F.col("n"), 4, 1)).alias("c")).select("video", "c.start", "c.stop")


_FLIGHT_SQL = f"""(select *, coalesce(last_value(case when event_id % 3 = 0 then event_id % 900 / 10e0 - 45 end ignore nulls) over w, null) as pitch, coalesce(last_value(case when event_id % 5 = 0 then event_id % 10 = 0 end ignore nulls) over w, false) as recording
    from (select *, row_number() over (partition by track order by event_id) - 1 as k from {T}) window w as (partition by track order by event_id rows between unbounded preceding and current row))"""


def _flights(spark, sf_dir) -> DataFrame:
    """(source, content): a flight record of each track: camera, gimbal and position records, scrambled."""
    rows = telemetry(spark, sf_dir).select("track", "event_id", "lat", "lon", "value")

    def file(pdf: pd.DataFrame) -> pd.DataFrame:
        body = []

        def add(kind: int, plain: bytes, seed: int) -> None:
            payload = flight_record.scrambled(plain, kind, seed & 0xFF)
            body.append(bytes([kind, len(payload)]) + payload + b"\xff")

        for k, r in enumerate(pdf.sort_values("event_id").itertuples()):
            i = int(r.event_id)
            if i % 5 == 0:
                add(flight_record.CAMERA, bytes([0xC0 if i % 10 == 0 else 0]) + bytes(26), i * 7)
            if i % 3 == 0:
                add(flight_record.GIMBAL, struct.pack("<hhh", i % 900 - 450, 0, 0) + bytes(6), i * 11)
            plain = bytearray(struct.pack("<ddh", r.lon * 0.017453292519943295, r.lat * 0.017453292519943295, i % 1000) + bytes(35))
            plain[33], plain[34], plain[36] = 0x80 if i % 7 else 0, i % 6 << 2, i % 20
            plain[42:44] = k.to_bytes(2, "little")
            add(flight_record.POSITION, bytes(plain), i)
        whole = b"".join(body)
        head = (100 + len(whole)).to_bytes(8, "little") + b"\x90\x01\x08" + bytes(89)
        return pd.DataFrame({"source": [str(pdf["track"].iloc[0])], "content": [head + whole + bytes(400)]})

    return rows.groupBy("track").applyInPandas(file, "source string, content binary")


@register("flight_record_round_trip", f"""select cast(track as varchar) as source, k / 10e0 as fly_time, round(lat, 9) as lat, round(lon, 9) as lon, event_id % 1000 / 10e0 as height, round(pitch, 6) as pitch, recording, event_id % 7 > 0 as gps_valid, event_id % 6 as gps_level, event_id % 20 as satellites from {_FLIGHT_SQL}""")
def flight_record_round_trip(spark, sf_dir):
    """Telemetry as scrambled binary flight records; positions carry the last attitude and camera state."""
    found = flight_record.flight_samples(_flights(spark, sf_dir))
    return rounded(found.select("source", "fly_time", "lat", "lon", "height", F.round("pitch", 6).alias("pitch"), "recording", "gps_valid", "gps_level", "satellites"), 9)


@register("flight_on_video", f"""with f as {_FLIGHT_SQL}, b as (select *, recording and not coalesce(lag(recording) over (partition by track order by k), false) as begins from f),
    r as (select *, sum(case when begins then 1 else 0 end) over (partition by track order by k) - 1 as seg from b), s as (select track, seg, min(k) / 10e0 as start, max(k) / 10e0 as stop from r where recording group by track, seg),
    v as (select track, start, stop from s qualify row_number() over (partition by track order by case when abs(stop - start - 0.4) <= 0.15 then abs(stop - start - 0.4) else 1e300 end, seg) = 1)
    select cast(f.track as varchar) as source, round(k / 10e0 - start, 6) as t, case when event_id % 7 > 0 then round(lat, 6) end as lat, event_id % 1000 / 10e0 as alt_baro, round(pitch, 6) as pitch from f join v on v.track = f.track and k / 10e0 between start - 0.25 and stop + 0.25""")
def flight_on_video(spark, sf_dir):
    """Samples around the recording that is as long as a video, on its clock."""
    samples = flight_record.flight_samples(_flights(spark, sf_dir))
    window = flight_record.video_window(flight_record.recordings(samples), 0.4, 0.15)
    return rounded(flight_record.on_video_clock(samples, window, 0.25).select("source", "t", "lat", "alt_baro", "pitch"))
