"""Autopilot logs: nested formats, instances, precedence of topics, damage, and frames by hand."""

import struct

import pytest

from skyloom.sources import autopilot as A


def message(kind, body):
    return struct.pack("<HB", len(body), ord(kind)) + body


HEAD = A.ULOG_MAGIC + b"\x01" + bytes(8)


def test_nested_formats_and_padding():
    data = HEAD + message("F", b"pair:float a;float[2] b;") + message("F", b"thing:uint64_t timestamp;pair[2] p;uint8_t n;uint8_t[7] _padding0;")
    data += message("A", b"\x00\x05\x00thing") + message("A", b"\x01\x06\x00thing")
    data += message("D", struct.pack("<HQ6fB", 5, 77, 1, 2, 3, 4, 5, 6, 9)) + message("D", struct.pack("<HQ6fB", 6, 78, *[0] * 6, 0))
    assert list(A.ulog_messages(data, {"thing"})) == [("thing", {"timestamp": 77, "p[0].a": 1, "p[0].b[0]": 2, "p[0].b[1]": 3, "p[1].a": 4, "p[1].b[0]": 5, "p[1].b[1]": 6, "n": 9})]


@pytest.mark.parametrize("cut", range(1, 40, 3))
def test_cut_and_foreign_files(cut):
    data = HEAD + message("F", b"sensor_gps:uint64_t timestamp;int32_t lat;int32_t lon;") + message("A", b"\x00\x01\x00sensor_gps") + message("D", struct.pack("<HQii", 1, 5, 10, 20)) * 3
    assert len(list(A.ulog_messages(data[:-cut], {"sensor_gps"}))) == 3 - -(-cut // 21)
    assert list(A.ulog_messages(data[1:], {"sensor_gps"})) == []
    assert list(A.ulog_messages(data[:cut], {"sensor_gps"})) == []


def test_preferred_topic_and_clock(spark):
    gps = b"uint64_t timestamp;uint64_t time_utc_usec;double latitude_deg;double longitude_deg;double altitude_msl_m;"
    data = HEAD + message("F", b"sensor_gps:" + gps) + message("F", b"vehicle_gps_position:" + gps)
    data += message("A", b"\x00\x01\x00sensor_gps") + message("A", b"\x00\x02\x00vehicle_gps_position")
    for k, utc in enumerate((0, 1_700_000_001_000_000, 1_700_000_002_000_400)):
        data += message("D", struct.pack("<HQQ3d", 1, k * 1_000_000, utc, 10 + k, 20, 30)) + message("D", struct.pack("<HQQ3d", 2, k * 1_000_000, 0, 1, 1, 1))
    data += message("D", struct.pack("<HQQ3d", 1, 9_000_000, 0, 0, 0, 0))  # no fix
    rows = A.ulog_rows(spark.createDataFrame([("a", data), ("b", b""), ("c", None)], "source string, content binary")).orderBy("t").collect()
    assert [(r.source, r.t, r.lat, r.yaw) for r in rows] == [("a", float(k), 10.0 + k, None) for k in range(3)]
    assert [r.wall_time.timestamp() for r in rows] == pytest.approx([1_700_000_000 + k + 0.0002 for k in range(3)], abs=1e-6)


def test_headings_go_the_short_way_round(spark):
    rows = [("a", k, t, y, p) for k, (p, t, y) in enumerate([("h", 0, 350.0), ("x", 5, None), ("h", 10, 20.0), ("x", 15, None), ("h", 20, 200.0), ("x", 40, None)])]
    df = spark.createDataFrame(rows, "source string, n long, t_us long, yaw double, topic string")
    assert [r.yaw for r in A.with_headings(df, "h").orderBy("t_us").collect()] == [5.0, 110.0, 200.0]


def test_flash_damage():
    fmt = lambda kind, name, form, columns: A.FLASH_HEAD + bytes([128, kind, 3 + struct.calcsize("<" + "".join(A.FLASH_TYPES[c] for c in form))]) + name.ljust(4, b"\0") + form.encode().ljust(16, b"\0") + columns.ljust(64, b"\0")
    one = lambda t: A.FLASH_HEAD + b"\x82" + struct.pack("<QC".replace("C", "H"), t, 1234)
    data = b"noise" + fmt(130, b"ATT", "QC", b"TimeUS,Yaw") + one(1) + one(2)[:6] + one(3) + b"\xa3\x95\xee" + one(4) + b"\xa3" + one(5) + one(6)[:-1]
    assert [(n, m["TimeUS"], m["Yaw"]) for n, m in A.flash_messages(data, {"ATT"})] == [("ATT", t, 12.34) for t in (1, 3, 4, 5)]
    assert list(A.flash_messages(one(1), {"ATT"})) == [] == list(A.flash_messages(b"", {"ATT"}))


def test_flash_message_whose_values_start_like_one_that_ends_at_a_start():
    fmt = lambda kind, name, form, columns: A.FLASH_HEAD + bytes([128, kind, 3 + struct.calcsize("<" + "".join(A.FLASH_TYPES[c] for c in form))]) + name.ljust(4, b"\0") + form.encode().ljust(16, b"\0") + columns.ljust(64, b"\0")
    gps = lambda t, lat: A.FLASH_HEAD + b"\x82" + struct.pack("<QBIHBii", t, 3, 7, 9, 6, lat, 5) + bytes(4)
    att = lambda t: A.FLASH_HEAD + b"\x83" + struct.pack("<QhH", t, 0, 1234)
    like = int.from_bytes(A.FLASH_HEAD + b"\x82\x21", "little", signed=True)
    # 4 bytes of damage: what starts at ``lat`` would run over the heading and end where the next position starts
    data = fmt(130, b"GPS", "QBIHBLLe", b"TimeUS,Status,GMS,GWk,NSats,Lat,Lng,Alt") + fmt(131, b"ATT", "QhC", b"TimeUS,Roll,Yaw")
    data += gps(1, 10) + gps(2, like) + b"\xa3\x95\xf0\xa3" + att(3) + gps(3, 10) + b"\0" + gps(4, 10)[:7] + att(5) + gps(5, 10) + b"\0" + gps(6, 10)
    found = [(n, m["TimeUS"]) for n, m in A.flash_messages(data, {"GPS", "ATT"})]
    assert found == [("GPS", 1), ("GPS", 2), ("ATT", 3), ("GPS", 3), ("ATT", 5), ("GPS", 5), ("GPS", 6)]


def test_checksum_of_frames():
    assert A.x25(b"123456789") == 0x6F91


def test_flash_start_bytes_among_values():
    fmt = A.FLASH_HEAD + bytes([128, 130, 13]) + b"ATT\0" + b"QH".ljust(16, b"\0") + b"TimeUS,Yaw".ljust(64, b"\0")
    one = lambda t: A.FLASH_HEAD + b"\x82" + struct.pack("<QH", t, 1234)
    unknown, known = (int.from_bytes(A.FLASH_HEAD + kind, "little") << 16 for kind in (b"\x10", b"\x82"))
    data = fmt + one(1) + one(unknown) + b"\0\xa3\xff" + one(2) + one(known) + b"\0\xa3\xff" + one(3)[:6] + one(4) + b"\0" + one(5)
    assert [m["TimeUS"] for _, m in A.flash_messages(data, {"ATT"})] == [1, unknown, 2, known, 4, 5]
