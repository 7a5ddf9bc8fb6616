"""Readers against encoders written here from the formats' descriptions."""

import struct

import pytest
from pyspark.sql import functions as F

from skyloom.sources import sinks
from skyloom.sources import telemetry as T

SRT = """1
00:00:00,000 --> 00:00:00,033
<font size="28">FrameCnt: 1
2024-01-02 03:04:05.678
[iso: 100] [latitude: 12.971] [longitude: 77.594] [rel_alt: 50.1 abs_alt: 920.5] [focal_len: 240.0] [gb_yaw: 12.5]</font>

2
00:00:00,033 --> 00:00:00,066
GPS (77.5950, 12.9720, 14) H 50.5m

3
00:00:00,066 --> 00:00:00,100
nothing here
"""


def test_srt_dialects(spark):
    rows = T.srt_rows(spark.createDataFrame([("a", SRT), ("b", ""), ("c", None)], "source string, text string")).orderBy("t").collect()
    assert len(rows) == 2
    assert (rows[0].lat, rows[0].lon, rows[0].alt_gps, rows[0].alt_baro, rows[0].focal_mm, rows[0].yaw) == (12.971, 77.594, 920.5, 50.1, 24.0, 12.5)
    assert str(rows[0].wall_time) == "2024-01-02 03:04:05.678000"
    assert (rows[1].lat, rows[1].lon, rows[1].sats, rows[1].alt_baro, rows[1].t) == (12.972, 77.595, 14.0, 50.5, 0.033)


@pytest.mark.parametrize(
    ("text", "lat"),
    [
        ("Timestamp,OSD.latitude,OSD.longitude,OSD.altitude [m],OSD.yaw\n0.0,12.5,77.5,920,10\n0.1,bad,77.5,921,11\n0.2,0,0,1,1\n0.3,12.6,77.6,922,12\n", [12.5, None, 12.6]),
        ("12.5;77.5;900\n12.6;77.6;901\n", [12.5, 12.6]),
        ("12.5 77.5\n12.6 77.6\n", [12.5, 12.6]),
    ],
)
def test_flight_tables(spark, tmp_path, text, lat):
    (tmp_path / "log.csv").write_text(text)
    rows = T.csv_rows(spark, f"{tmp_path}/log.csv").orderBy("t").collect()
    assert [r.lat for r in rows if r.lat is not None] == [x for x in lat if x is not None]


def test_resolver_claims_each_header_once():
    found = T.resolve_columns(["Lat", "latitude_raw", "longitude", "height above takeoff"], {"lat": ["latitude"], "lon": ["longitude"], "alt_baro": ["height"]})
    assert found == {"lat": "Lat", "lon": "longitude", "alt_baro": "height above takeoff"}


def klv(us, lat, lon, alt, yaw):
    signed = lambda v, limit: struct.pack(">i", round(v / limit * (2**31 - 1)))
    unsigned = lambda v, lo, hi: struct.pack(">H", round((v - lo) / (hi - lo) * 65535))
    items = [(2, struct.pack(">Q", us)), (5, unsigned(yaw, 0, 360)), (13, signed(lat, 90)), (14, signed(lon, 180)), (15, unsigned(alt, -900, 19000)), (99, b"xy"), (6, b"\x80\x00")]
    body = b"".join(bytes([t, len(v)]) + v for t, v in items) + b"\x01\x02"
    head = T.KLV_KEY + bytes([len(body) + 2])
    total = sum(b << 8 if k % 2 == 0 else b for k, b in enumerate(head + body)) & 0xFFFF
    return head + body + struct.pack(">H", total)


def transport(payload, pid=0x101):
    out = b""
    for at in range(0, len(payload), 184):
        part = payload[at : at + 184]
        if len(part) == 184:
            out += bytes([0x47, pid >> 8, pid & 255, 0x10]) + part
        else:
            pad = 183 - len(part)
            out += bytes([0x47, pid >> 8, pid & 255, 0x30, pad]) + b"\xff" * pad + part
        out += bytes([0x47, 0x1F, 0xFF, 0x10]) + b"\0" * 184
    return out


def test_klv(spark):
    sets = klv(1_700_000_000_000_000, 12.9, 77.6, 920, 45) + b"junk" + klv(1_700_000_001_500_000, 12.91, 77.61, 921, 46)
    broken = sets[: len(sets) - 10] + b"\x00" * 10
    files = [("raw", sets), ("ts", transport(sets)), ("bad", T.KLV_KEY + b"\x84\xff\xff\xff\xff" + sets), ("sum", broken), ("none", b""), ("null", None)]
    df = spark.createDataFrame(files, "source string, content binary")
    rows = T.klv_rows(df).collect()
    for name in ("raw", "ts", "bad"):
        got = sorted((r for r in rows if r.source == name), key=lambda r: r.t)
        assert [round(r.t, 6) for r in got] == [0.0, 1.5] and abs(got[0].lat - 12.9) < 1e-6 and abs(got[1].yaw - 46) < 0.01
        assert got[0].pitch is None and got[0].unknown_tags == 1 and got[0].checksum_ok
    assert sum(r.source == "sum" for r in T.klv_rows(df, require_checksum=True).collect()) == 1


def test_gpmf(spark):
    item = lambda key, kind, size, rows, raw: key.encode() + kind.encode() + bytes([size]) + struct.pack(">H", rows) + raw + b"\0" * (-len(raw) % 4)
    gps = struct.pack(">10i", 129000000, 776000000, 9200, 0, 0, 129100000, 776100000, 9300, 0, 0)
    stream = item("SCAL", "l", 4, 5, struct.pack(">5i", 10**7, 10**7, 10, 1, 1)) + item("GPSF", "L", 4, 1, struct.pack(">I", 3)) + item("GPS5", "l", 20, 2, gps)
    packet = item("DEVC", "\0", 1, len(item("STRM", "\0", 1, len(stream), stream)), item("STRM", "\0", 1, len(stream), stream))
    df = spark.createDataFrame([("v", 2.0, 1.0, packet)], "source string, start double, duration double, content binary")
    rows = T.gpmf_rows(df).orderBy("t").collect()
    assert [(r.t, round(r.lat, 4), round(r.lon, 4), r.alt_gps) for r in rows] == [(2.0, 12.9, 77.6, 920.0), (2.5, 12.91, 77.61, 930.0)]


def test_gpmf_packets_are_spread_each_by_itself_without_a_shuffle(spark):
    item = lambda key, kind, size, rows, raw: key.encode() + kind.encode() + bytes([size]) + struct.pack(">H", rows) + raw + b"\0" * (-len(raw) % 4)
    stream = item("GPS5", "l", 20, 2, struct.pack(">10i", 1, 2, 3, 0, 0, 4, 5, 6, 0, 0))
    strm = item("STRM", "\0", 1, len(stream), stream)
    packet = item("DEVC", "\0", 1, len(strm), strm)
    df = spark.createDataFrame([("v", 2.0, 1.0, packet)] * 2, "source string, start double, duration double, content binary").coalesce(1)
    rows = T.gpmf_rows(df)
    assert sorted(r.t for r in rows.collect()) == [2.0, 2.0, 2.5, 2.5]
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_rows_of_many_small_files_share_a_batch(spark, monkeypatch):
    made = []
    monkeypatch.setattr(T.pd, "DataFrame", lambda *a, **k: made.append(1))
    kept = {}
    files = type("Files", (), {"select": lambda self, *c: self, "mapInPandas": lambda self, run, schema: kept.setdefault("run", run)})()
    T._parsed(files, lambda data: iter([{"k": len(data), "x": 1}]), "source string, k long, x double")
    batch = {"source": T.pd.Series(["a"] * 500), "content": T.pd.Series([b"ab"] * 500)}
    assert len(list(kept["run"](iter([batch] * 4)))) == len(made) == 1


def test_maps(spark):
    gpx = '<gpx><trk><trkpt lat="1.5" lon="2.5"><ele>10</ele><time>2024-01-01T00:00:01Z</time></trkpt><trkpt lat="1.6" lon="2.6"></trkpt><trkpt lat="1.7" lon="2.7"><time>2024-01-01T00:00:03Z</time></trkpt></trk></gpx>'
    kml = "<kml><gx:Track><when>2024-01-01T00:00:00Z</when><when>2024-01-01T00:00:02Z</when><gx:coord>2.5 1.5 10</gx:coord><gx:coord>2.6 1.6 11</gx:coord></gx:Track></kml>"
    rows = T.xml_points(spark.createDataFrame([("g", gpx), ("k", kml)], "source string, text string")).orderBy("source", "t").collect()
    assert [(r.source, r.t, r.lat, r.lon, r.alt_gps) for r in rows] == [("g", 0.0, 1.5, 2.5, 10.0), ("g", 2.0, 1.7, 2.7, None), ("k", 0.0, 1.5, 2.5, 10.0), ("k", 2.0, 1.6, 2.6, 11.0)]
    geo = '{"type":"FeatureCollection","features":[{"geometry":{"type":"Point","coordinates":[2.5,1.5,9]},"properties":{"time":"2024-01-01T00:00:00Z"}},{"geometry":{"type":"LineString","coordinates":[[2.6,1.6],[2.7,1.7]]},"properties":{"coordTimes":["2024-01-01T00:00:01Z","2024-01-01T00:00:02Z"]}}]}'
    rows = T.geojson_points(spark.createDataFrame([("j", geo)], "source string, text string")).orderBy("t").collect()
    assert [(r.t, r.lat, r.lon, r.alt_gps) for r in rows] == [(0.0, 1.5, 2.5, 9.0), (1.0, 1.6, 2.6, None), (2.0, 1.7, 2.7, None)]


def test_control_points(spark):
    text = "EPSG:32643\n1 2 3 10 20 a.jpg p1\n1 2 3 11 21 b.jpg p1\n4 5 6 1 2 a.jpg chk_1\nbad line\n"
    rows = {r.name: r for r in T.gcp_rows(spark.createDataFrame([("g", text)], "source string, text string")).collect()}
    assert len(rows["p1"].observations) == 2 and not rows["p1"].check and rows["chk_1"].check and rows["p1"].crs == "EPSG:32643"


def test_point_clouds(spark):
    points = [(0.5, 1.0, 2.0, 1, 2, 3), (3.0, 4.0, 5.0, 4, 5, 6)]
    head = "element vertex 2\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nproperty uchar green\nproperty uchar blue\nend_header\n"
    binary = b"ply\nformat binary_little_endian 1.0\n" + head.encode() + b"".join(struct.pack("<fffBBB", *p) for p in points)
    text = b"ply\nformat ascii 1.0\n" + head.encode() + "".join(" ".join(map(str, p)) + "\n" for p in points).encode()
    df = spark.createDataFrame([("b", binary), ("a", text)], "source string, content binary")
    for name in "ab":
        assert [tuple(r)[1:] for r in T.ply_rows(df).where(f"source = '{name}'").collect()] == points
    vis = struct.pack("<Q", 2) + struct.pack("<III", 2, 7, 9) + struct.pack("<I", 0)
    assert [(r.view_ids, r.views) for r in T.vis_rows(spark.createDataFrame([("v", vis)], "source string, content binary")).collect()] == [([7, 9], 2), ([], 0)]


def test_load_sniffs(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(klv(1_700_000_000_000_000, 12.9, 77.6, 920, 45))
    (tmp_path / "b.txt").write_text(SRT)
    (tmp_path / "c.dat").write_text("nothing known")
    assert {(r.kind, r["count"]) for r in T.load(spark, str(tmp_path)).groupBy("kind").count().collect()} == {("klv", 1), ("srt", 2)}

def test_sniffs_all_it_is_given(spark):
    page = "x" * 70_000
    rows = [(1, f"a,{page}\nb"), (2, f"{page}<gpx"), (3, "\x0b{"), (4, f"{page} 0:0:1,5\x0b-->")]
    found = spark.createDataFrame(rows, "i int, text string").select("i", T.sniff(F.encode("text", "UTF-8")).alias("kind")).collect()
    assert {r.i: r.kind for r in found} == {1: "csv", 2: "gpx", 3: None, 4: None}


def test_sinks(spark, tmp_path):
    frames = spark.createDataFrame([(0, "f0"), (1, "f1"), (2, "f2")], "k long, name string")
    fixes = spark.createDataFrame([(0, 1.0, 2.0, None), (1, None, 2.0, 3.0)], "k long, lat double, lon double, alt_gps double")
    sinks.write_lines(sinks.geo_lines(frames, fixes, "k", "name"), f"{tmp_path}/geo")
    text = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/geo").collect())
    rows = T.geo_rows(spark.createDataFrame([("g", text)], "source string, text string")).collect()
    assert [(r.name, r.lat, r.lon, r.alt) for r in rows] == [("f0", 1.0, 2.0, 0.0)]
    points = spark.createDataFrame([(1.0, 2.0, 3.0), (11.0, 2.0, 4.0)], "x double, y double, z double")
    sinks.write_tiles(points, f"{tmp_path}/tiles", 10.0)
    assert spark.read.parquet(f"{tmp_path}/tiles").where("tile_x = 1").count() == 1
    ply = "\n".join(r.line for r in sinks.ply_lines(points).orderBy("n").collect()).encode() + b"\n"
    assert [(r["x"], r["z"]) for r in T.ply_points(ply)] == [(1.0, 3.0), (11.0, 4.0)]
    obj = spark.createDataFrame([(0, "v 1 2 3"), (1, "f 1 2 3")], "n long, line string")
    assert [r.line for r in sinks.obj_moved(obj, 2.0, [1, 0, 0, 0, 1, 0, 0, 0, 1], [1, 0, 0]).orderBy("n").collect()] == ["v 3.0 4.0 6.0", "f 1 2 3"]


def test_a_damaged_set_does_not_take_the_next_ones_bytes():
    good = klv(1_700_000_000_000_000, 12.9, 77.6, 920, 45)
    stamp = bytes.fromhex("0208") + (1_700_000_000_500_000).to_bytes(8, "big")
    bad = T.KLV_KEY + bytes([len(stamp) + 4]) + stamp + b"\x0d\x04\x01\x02"  # a latitude of four bytes with two left
    rows = list(T.klv_sets(good + bad + good))
    assert len(rows) == 3 and "lat" not in rows[1] and rows[1]["unix_us"] == 1_700_000_000_500_000 and rows[2] == rows[0]
    assert len(list(T.klv_sets(good * 5, 2))) == 2
    for cut in range(1, len(good)):
        assert len(list(T.klv_sets(good + good[:-cut]))) == 1
    assert list(T.klv_sets(T.KLV_KEY + b"\x00" + good))[0] == rows[0]


def test_checksums_of_made_files_are_worked_out_once_for_each_row(spark):
    from skyloom.plans import source_queries
    from skyloom.sources import autopilot

    for name, most in (("mavlink_round_trip", 1), ("klv_round_trip", 1)):
        plan = getattr(source_queries, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("conv(") == most and "collect_list(struct" not in plan and "collect_list(named_struct" not in plan, name
    assert autopilot.x25(b"123456789") == 0x6F91
