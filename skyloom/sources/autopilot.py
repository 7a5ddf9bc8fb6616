"""Autopilot logs (inventory S17, S18): self-describing binary streams become rows, the rest is Spark.

A log says itself how its messages are laid out; the parsers build their unpackers from that and yield positions and
headings as they come. Damaged stretches are passed over up to the next message that can be one. Clocks, headings at
the times of the positions and canonical columns are windows and aggregates over the rows. Logs hold the vehicle's
attitude, not the camera's, so only its heading is kept.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions.scalar import gps_time
from skyloom.sources.telemetry import _canonical, _parsed

ROWS = "source string, n long, topic string, t_us long, lat double, lon double, alt double, rel_alt double, utc_us long, week long, ms long, sats long, yaw double"

# Fixed values of the formats: marks, types and their widths.
ULOG_MAGIC, ULOG_SYNC = bytes.fromhex("554c6f67011235"), bytes.fromhex("2f731320250cbb12")
ULOG_MESSAGES = b"BFIMPAQDRLCSO"
ULOG_TYPES = {"int8_t": "b", "uint8_t": "B", "int16_t": "h", "uint16_t": "H", "int32_t": "i", "uint32_t": "I", "int64_t": "q", "uint64_t": "Q", "float": "f", "double": "d", "bool": "?", "char": "c"}
FLASH_HEAD, FLASH_FMT = b"\xa3\x95", 128
FLASH_TYPES = {
    "a": "32h", "b": "b", "B": "B", "h": "h", "H": "H", "i": "i", "I": "I", "f": "f", "d": "d", "n": "4s", "N": "16s", "Z": "64s",
    "c": "h", "C": "H", "e": "i", "E": "I", "L": "i", "M": "B", "q": "q", "Q": "Q", "g": "e",
}
FLASH_SCALES = {"c": 100, "C": 100, "e": 100, "E": 100, "L": 10_000_000}
MAV_V1, MAV_V2, MAV_POSITION, MAV_POSITION_SEED = 0xFE, 0xFD, 33, 104


class _Formats:
    """Layouts of ULog messages, resolved through the formats that they hold."""

    def __init__(self) -> None:
        self.texts: dict[str, list[tuple[str, int, str]]] = {}
        self.known: dict[str, tuple[struct.Struct, dict[str, int]] | None] = {}

    def add(self, text: str) -> None:
        name, _, fields = text.partition(":")
        found = re.findall(r"(\w+)(?:\[(\d+)\])?\s+(\w+)\s*;?", fields)
        self.texts[name] = [(kind, int(n or 0), field) for kind, n, field in found]

    def _flat(self, name: str, before: str, depth: int = 0) -> list[tuple[str, str]]:
        out = []
        for kind, n, field in self.texts[name]:
            for k in range(max(n, 1)):
                path = f"{before}{field}" + (f"[{k}]" if n else "")
                if kind in ULOG_TYPES:
                    out.append((ULOG_TYPES[kind], path))
                elif depth < 8:
                    out += self._flat(kind, path + ".", depth + 1)
        return out

    def unpacker(self, name: str) -> tuple[struct.Struct, dict[str, int]] | None:
        """(layout, place of each field); padding at the end of a message is not logged."""
        if name not in self.known:
            try:
                flat = self._flat(name, "")
                while flat and flat[-1][1].startswith("_padding"):
                    flat.pop()
                self.known[name] = struct.Struct("<" + "".join(c for c, _ in flat)), {p: k for k, (_, p) in enumerate(flat)}
            except KeyError:
                self.known[name] = None
        return self.known[name]


def ulog_messages(data: bytes, topics: set[str]) -> Iterator[tuple[str, dict]]:
    """(topic, fields) of the data messages of the wanted topics, first instances only.

    A message of an unknown type, or one that runs over the end, is damage: reading goes on behind the next sync mark.
    """
    if not data.startswith(ULOG_MAGIC):
        return
    formats, names = _Formats(), {}
    at = 16
    while at + 3 <= len(data):
        size, kind = int.from_bytes(data[at : at + 2], "little"), data[at + 2]
        body = data[at + 3 : at + 3 + size]
        if kind not in ULOG_MESSAGES or len(body) < size:
            mark = data.find(ULOG_SYNC, at)
            if mark < 0:
                return
            at = mark + len(ULOG_SYNC)
            continue
        at += 3 + size
        if kind == ord("F"):
            formats.add(body.decode("utf-8", "replace"))
        elif kind == ord("A") and size > 3 and body[0] == 0:
            names[int.from_bytes(body[1:3], "little")] = body[3:].decode("utf-8", "replace")
        elif kind == ord("D") and (topic := names.get(int.from_bytes(body[:2], "little"))) in topics:
            found = formats.unpacker(topic)
            if found and size - 2 >= found[0].size:
                values = found[0].unpack_from(body, 2)
                yield topic, {field: values[k] for field, k in found[1].items()}


def ulog_fixes(data: bytes) -> Iterator[dict]:
    """Positions and headings of a ULog file, positions under the name of their topic."""
    topics = {"sensor_gps", "vehicle_gps_position", "vehicle_attitude"}
    for n, (topic, m) in enumerate(ulog_messages(data, topics)):
        row: dict = {"n": n, "topic": topic, "t_us": m.get("timestamp")}
        if topic == "vehicle_attitude":
            if "q[3]" not in m:
                continue
            q0, q1, q2, q3 = (m[f"q[{k}]"] for k in range(4))
            row["yaw"] = math.degrees(math.atan2(2 * (q0 * q3 + q1 * q2), 1 - 2 * (q2 * q2 + q3 * q3)))
        else:
            degrees = "latitude_deg" in m
            row["lat"], row["lon"] = (m["latitude_deg"], m["longitude_deg"]) if degrees else (m["lat"] / 1e7, m["lon"] / 1e7)
            row["alt"] = m["altitude_msl_m"] if "altitude_msl_m" in m else m["alt"] / 1e3 if "alt" in m else None
            row["utc_us"], row["sats"] = m.get("time_utc_usec") or None, m.get("satellites_used")
        yield row


def flash_messages(data: bytes, wanted: set[str]) -> Iterator[tuple[str, dict]]:
    """(name, fields) of a DataFlash log's messages, by the layouts that its own format messages state.

    A message starts with two fixed bytes and a known type; anything else is damage, and reading goes on at the next such start.
    These bytes may also stand within a whole message's values: a message counts as cut short only if none starts at its end
    and one that starts within it is whole, that is, ends at a start or beyond this one's end without a start in itself. What
    starts within it is not whole if it runs over a message that starts beyond this one's end and ends at a start.
    """
    layouts: dict[int, tuple[str, struct.Struct, list[tuple[str, int]]]] = {}
    sizes = {FLASH_FMT: 89}

    def starts(p: int) -> bool:
        return data.startswith(FLASH_HEAD, p) and p + 2 < len(data) and data[p + 2] in sizes

    def within(a: int, b: int) -> list[int]:
        return [p for p in range(a + 1, b) if starts(p)] if data.find(FLASH_HEAD, a + 1, b + 1) >= 0 else []

    def cut_short(a: int, b: int) -> bool:
        if b >= len(data) or starts(b):
            return False
        inner = ((p, p + sizes[data[p + 2]]) for p in within(a, b))
        runs_over = lambda q: any(starts(r + sizes[data[r + 2]]) for r in within(b, q))
        return any(q <= len(data) and (starts(q) and not runs_over(q) or q > b and not within(p, q)) for p, q in inner)

    at = data.find(FLASH_HEAD)
    while 0 <= at and at + 3 <= len(data):
        kind = data[at + 2]
        end = at + sizes.get(kind, 0)
        if kind not in sizes or end > len(data) or cut_short(at, end):
            at = data.find(FLASH_HEAD, at + 1)
            continue
        body = data[at + 3 : end]
        if kind == FLASH_FMT:
            told, length = body[0], body[1]
            name, form, columns = (x.rstrip(b"\0").decode("ascii", "replace") for x in (body[2:6], body[6:22], body[22:86]))
            if all(c in FLASH_TYPES for c in form):
                layout = struct.Struct("<" + "".join(FLASH_TYPES[c] for c in form))
                if layout.size + 3 == length and told != FLASH_FMT:
                    sizes[told] = length
                    layouts[told] = name, layout, list(zip(columns.split(","), (FLASH_SCALES.get(c, 1) for c in form), strict=False))
        elif layouts[kind][0] in wanted:
            name, layout, columns = layouts[kind]
            values = layout.unpack(body)
            yield name, {c: v / s if s > 1 else v for (c, s), v in zip(columns, values, strict=False)}
        at = end if data.startswith(FLASH_HEAD, end) else data.find(FLASH_HEAD, end)


def flash_fixes(data: bytes) -> Iterator[dict]:
    """Positions with a 3-D fix and headings of a DataFlash log."""
    for n, (name, m) in enumerate(flash_messages(data, {"GPS", "ATT"})):
        if name == "ATT" and "Yaw" in m:
            yield {"n": n, "topic": name, "t_us": m.get("TimeUS"), "yaw": float(m["Yaw"])}
        elif name == "GPS" and m.get("Status", 3) >= 3 and "Lat" in m:
            yield {"n": n, "topic": name, "t_us": m.get("TimeUS"), "lat": m["Lat"], "lon": m["Lng"], "alt": m.get("Alt"), "week": m.get("GWk"), "ms": m.get("GMS"), "sats": m.get("NSats")}


def _x25_of(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0x8408 if byte & 1 else 0)
    return byte


#: What each byte does to the checksum.
X25 = [_x25_of(byte) for byte in range(256)]


def x25(data: bytes) -> int:
    """The checksum of MAVLink frames: CRC-16 with the polynomial 0x1021, reflected."""
    crc = 0xFFFF
    for byte in data:
        crc = crc >> 8 ^ X25[(crc ^ byte) & 0xFF]
    return crc


def mavlink_fixes(data: bytes) -> Iterator[dict]:
    """Global positions of a ground station's log: a time before each frame, frames of both versions, checksums held."""
    at, n = 0, 0
    while at + 16 <= len(data):
        kind, size = data[at + 8], data[at + 9]
        head = {MAV_V1: 6, MAV_V2: 10}.get(kind)
        if head is None:
            at += 1
            continue
        body = at + 8 + head
        end = body + size + 2 + (13 if kind == MAV_V2 and data[at + 10] & 1 else 0)
        message = data[at + 13] if kind == MAV_V1 else int.from_bytes(data[at + 15 : at + 18], "little")
        sure = message == MAV_POSITION and x25(data[at + 9 : body + size] + bytes([MAV_POSITION_SEED])) == int.from_bytes(data[body + size : body + size + 2], "little")
        # other frames' checksums are not known: they count where a frame, or nothing, follows
        if end > len(data) or not (sure or end == len(data) or data[end + 8 : end + 9] in (bytes([MAV_V1]), bytes([MAV_V2]))):
            at += 1
            continue
        if sure:
            # the second version leaves zeros at the end out
            boot, lat, lon, alt, above, *_, heading = struct.unpack("<IiiiihhhH", data[body : body + size].ljust(28, b"\0")[:28])
            yaw = None if heading == 0xFFFF else heading / 100
            yield {"n": n, "topic": "position", "t_us": boot * 1000, "lat": lat / 1e7, "lon": lon / 1e7, "alt": alt / 1e3, "rel_alt": above / 1e3, "utc_us": int.from_bytes(data[at : at + 8], "big"), "yaw": yaw}
            n += 1
        at = end


def turn(a: Column, b: Column) -> Column:
    """The way from heading ``a`` to ``b`` in degrees, the short way round; half a circle goes as the numbers say."""
    d = b - a
    way = F.pmod(d + 180, F.lit(360.0)) - 180
    return F.when((way == -180) & (d > 0), 180.0).otherwise(way)


def with_headings(rows: DataFrame, heading: str) -> DataFrame:
    """Positions with ``yaw`` between the headings before and after by time, the short way round; beyond the ends the nearest."""
    order = Window.partitionBy("source").orderBy("t_us", "n")
    held = F.when(F.col("topic") == heading, F.struct(F.col("t_us").alias("t"), F.col("yaw").alias("y")))
    a = F.last(held, True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first(held, True).over(order.rowsBetween(0, Window.unboundedFollowing))
    made = rows.withColumns({"__a": a, "__b": b}).where(F.col("topic") != heading)
    share = (F.col("t_us") - F.col("__a.t")) / F.nullif(F.col("__b.t") - F.col("__a.t"), F.lit(0))
    mixed = F.col("__a.y") + turn(F.col("__a.y"), F.col("__b.y")) * F.coalesce(share, F.lit(0.0))
    return made.withColumn("yaw", F.pmod(F.coalesce(mixed, F.col("__a.y"), F.col("__b.y")), F.lit(360.0))).drop("__a", "__b")


def _rows(fixes: DataFrame, wall: Column, t: Column) -> DataFrame:
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~((F.col("lat") == 0) & (F.col("lon") == 0))
    named = fixes.withColumns({"wall_time": wall, "alt_gps": F.col("alt"), "alt_baro": F.col("rel_alt")}).where(there).withColumn("t", t)
    return _canonical(named, ["wall_time", "sats"])


def ulog_rows(files: DataFrame) -> DataFrame:
    """Canonical rows of ``files(source, content)``: positions of ``sensor_gps``, else of ``vehicle_gps_position``.

    The clock is the median of UTC less log time over the positions with a UTC time; without any there is no wall time.
    """
    rows = _parsed(files, ulog_fixes, ROWS)
    log = Window.partitionBy("source")
    better = F.max((F.col("topic") == "sensor_gps").cast("int")).over(log)
    rows = rows.withColumn("__better", better).where("topic <> if(__better = 1, 'vehicle_gps_position', 'sensor_gps')")
    offset = rows.where("utc_us > 0").groupBy("source").agg(F.median(F.col("utc_us") - F.col("t_us")).alias("__offset"))
    rows = with_headings(rows, "vehicle_attitude").join(offset, "source", "left")
    wall = F.timestamp_micros((F.col("t_us") + F.col("__offset")).cast("long"))
    return _rows(rows, wall, (F.col("t_us") - F.min("t_us").over(log)) / 1000000)


def dataflash_rows(files: DataFrame) -> DataFrame:
    """Canonical rows of DataFlash logs ``files(source, content)``, in seconds from the first by their GPS clock."""
    rows = with_headings(_parsed(files, flash_fixes, ROWS), "ATT")
    wall = gps_time("week", "ms")
    return _rows(rows, wall, (F.unix_micros("wall_time") - F.min(F.unix_micros("wall_time")).over(Window.partitionBy("source"))) / 1000000)


def mavlink_rows(files: DataFrame) -> DataFrame:
    """Canonical rows of ground-station logs ``files(source, content)``."""
    rows = _parsed(files, mavlink_fixes, ROWS)
    return _rows(rows, F.timestamp_micros("utc_us"), (F.col("utc_us") - F.min("utc_us").over(Window.partitionBy("source"))) / 1000000)
