"""Writers (inventory K rows): canonical tables are Parquet; text formats are rows of text in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.windows import numbered_by


def write_table(df: DataFrame, path: str, *, by: list[str] = (), mode: str = "overwrite") -> None:
    """A table as Parquet, laid out by ``by``."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def geo_lines(frames: DataFrame, telemetry: DataFrame, key: str, name: str, crs: str = "EPSG:4326") -> DataFrame:
    """Lines (n, line) of a geo.txt: the CRS, then name lon lat alt of frames whose fix is there."""
    rows = frames.select(key, name).join(telemetry.select(key, "lat", "lon", "alt_gps"), key, "left").where("lat is not null and lon is not null")
    line = F.format_string("%s %.9f %.9f %.3f", F.col(name), F.col("lon"), F.col("lat"), F.coalesce("alt_gps", F.lit(0.0)))
    made = numbered_by(rows.select(key, name, line.alias("line")), [F.col(key), F.col(name)]).select(F.col("number").alias("n"), "line")
    return frames.sparkSession.createDataFrame([(0, crs)], "n long, line string").unionByName(made)


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines in order as text; one range-partitioned sort, files in order of names."""
    lines.repartitionByRange("n").sortWithinPartitions("n").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def write_tiles(points: DataFrame, path: str, tile_m: float) -> None:
    """K8: points in a folder for each tile."""
    tiles = {"tile_x": F.floor(F.col("x") / tile_m).cast("long"), "tile_y": F.floor(F.col("y") / tile_m).cast("long")}
    write_table(points.withColumns(tiles), path, by=["tile_x", "tile_y"])


def srt_stamp_lines(df: DataFrame, time: str, body: Column) -> DataFrame:
    """Cues (n, line) of a subtitle file."""
    from skyloom.functions.scalar import format_cue

    rows = numbered_by(df.select(F.col(time).alias("__t"), body.alias("__body")), [F.col("__t"), F.col("__body")])
    until = rows.select((F.col("number") - 1).alias("number"), F.col("__t").alias("__until"))
    rows = rows.join(until, "number", "left")  # each cue lasts until the next
    nxt = F.coalesce("__until", F.col("__t") + 0.1)
    line = F.concat(F.col("number").cast("string"), F.lit("\n"), format_cue(F.col("__t")), F.lit(" --> "), format_cue(nxt), F.lit("\n"), F.col("__body"), F.lit("\n"))
    return rows.select(F.col("number").alias("n"), line.alias("line"))


def gap_features(regions: DataFrame, rings: str = "rings") -> DataFrame:
    """One GeoJSON feature text for each region; several outer rings make a MultiPolygon."""
    outer = F.transform(F.col(rings), lambda r: F.transform(r, lambda p: F.array(F.round(p["x"], 7), F.round(p["y"], 7))))
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), outer.alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform(outer, lambda r: F.array(r)).alias("coordinates")))
    geometry = F.when(F.size(rings) <= 1, polygon).otherwise(multi)
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct("number", "area")), F.lit(',"geometry":'), geometry, F.lit("}"))
    return regions.select("number", text.alias("feature"))


def ply_lines(points: DataFrame, extra: list[str] = ()) -> DataFrame:
    """K6: lines (n, line) of an ASCII PLY file with further scalar properties."""
    count = points.agg(F.count("*").alias("c"))
    props = "".join(f"property double {c}\n" for c in ("x", "y", "z", *extra))
    head = count.select(F.lit(0).cast("long").alias("n"), F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex "), F.col("c").cast("string"), F.lit(f"\n{props}end_header")).alias("line"))
    cells = F.concat_ws(" ", *(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).cast("string") for c in ("x", "y", "z", *extra)))
    return head.unionByName(points.select((F.monotonically_increasing_id() + 1).alias("n"), cells.alias("line")))


def obj_moved(lines: DataFrame, scale: float, rotation: list[float], shift: list[float]) -> DataFrame:
    """Lines (n, line) of an OBJ text with its vertices moved by a similarity; other lines stay as they are."""
    w = F.split(F.trim("line"), r"\s+")
    xyz = [F.get(w, F.lit(k)).try_cast("double") for k in (1, 2, 3)]
    moved = [F.lit(scale) * sum((F.lit(rotation[3 * i + j]) * xyz[j] for j in range(3)), F.lit(0.0)) + shift[i] for i in range(3)]
    rest = F.slice(w, 5, 1000)
    line = F.concat_ws(" ", F.lit("v"), *(m.cast("string") for m in moved), rest)
    return lines.select("n", F.when(F.col("line").startswith("v "), line).otherwise(F.col("line")).alias("line"))


def append_history(df: DataFrame, path: str) -> None:
    """Rows added to an append-only history."""
    df.write.mode("append").json(path)


def report_row(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Each row as JSON text."""
    return df.select(*keys, F.to_json(F.struct(*df.columns)).alias("report"))
