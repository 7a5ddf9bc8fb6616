"""What leaves a run: resolution, light meshes, checks of files and of results (inventory A20, A46, A55, A81, G14, G15, J22, K26, S53, Y13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from skyloom.functions import scalar as S
from skyloom.operators.stats import error_stats, quantiles


def auto_resolution(points: DataFrame, keys: list[str], x: str, y: str, views: str, floor_m: float = 0.05) -> DataFrame:
    """Cell size near the spacing of single surface points, in steps of 0.05: root of occupied square metres over points by median views."""
    middle = quantiles(points, keys, views, [0.5]).select(*keys, F.col("q0").alias("views"))
    cells = points.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct(F.floor(x), F.floor(y)).alias("occupied"))
    single = F.greatest(F.col("n") / F.greatest(F.col("views"), F.lit(1.0)), F.lit(1.0))
    size = F.bround(F.sqrt(F.col("occupied") / single) / 0.05) * 0.05
    return cells.join(middle, keys).select(*keys, "n", "occupied", "views", F.greatest(F.lit(floor_m), size).alias("resolution"))


def _area(p: list[tuple[Column, Column]]) -> Column:
    (x0, y0), (x1, y1), (x2, y2) = p
    return F.abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2


def texel_size(faces: DataFrame, keys: list[str], xy: list[tuple[str, str]], uv: list[tuple[str, str]], width: int, height: int) -> DataFrame:
    """Median ground metres of a texel over all faces: root of the median of horizontal area over texture area."""
    ground = _area([(F.col(a), F.col(b)) for a, b in xy])
    texels = _area([(F.col(a) * width, F.col(b) * height) for a, b in uv])
    rows = faces.select(*keys, F.when((ground > 0) & (texels > 0), ground / texels).alias("__r"))
    return quantiles(rows, keys, "__r", [0.5]).select(*keys, F.col("n").alias("faces"), F.sqrt("q0").alias("texel_m"))


def welded(vertices: DataFrame, keys: list[str], xyz: list[str], colours: list[str], confidence: str, zone: str, digits: int = 3) -> DataFrame:
    """One vertex for each rounded place: mean colours, mean of the known confidences (-1 without any), the least trusted zone.

    Decimal colours are summed exactly, so that the order of rows doesn't show in their means.
    """
    mean = lambda c: F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))
    by = [F.round(c, digits).alias(c) for c in xyz]
    known = F.when(F.col(confidence) >= 0, F.col(confidence))
    return vertices.groupBy(*keys, *by).agg(
        F.count("*").alias("merged"), *(mean(c).alias(c) for c in colours), F.coalesce(F.avg(known), F.lit(-1.0)).alias(confidence), F.max(zone).alias(zone)
    )


def welded_faces(faces: DataFrame, corners: list[str]) -> DataFrame:
    """Faces whose corners are still three after welding."""
    a, b, c = (F.col(x) for x in corners)
    return faces.where((a != b) & (b != c) & (a != c))


def filled_in_sure(fill: DataFrame, voxels: DataFrame, key: str, zone: str = "zone") -> DataFrame:
    """(inside, filled): how many filled points lie in a voxel of zone 1."""
    sure = voxels.where(F.col(zone) == 1).select(key).distinct().withColumn("__sure", F.lit(1))
    return fill.join(sure, key, "left").agg(F.count("__sure").alias("inside"), F.count("*").alias("filled"))


def reopened(spark: SparkSession, exports: dict[str, tuple[str, str, int]]) -> DataFrame:
    """(name, ok, detail) of exported files, ``name -> (format, path, rows)``: read again and counted, each by itself."""
    out = []
    for name, (kind, path, rows) in exports.items():
        try:
            found = spark.read.format(kind).load(path).count()
            out.append((name, found == rows, f"{found} rows"))
        except AnalysisException as e:
            out.append((name, False, str(e).splitlines()[0]))
    return spark.createDataFrame(out, "name string, ok boolean, detail string")


def qa_pass(errors: DataFrame, keys: list[str], value: str, good: float, fair: float) -> DataFrame:
    """Error statistics of each group with their status and score."""
    made = error_stats(errors, keys, value).withColumn("status", S.lower_better("rms", good, fair))
    return made.withColumn("score", F.when(F.col("status") == "pass", 100).when(F.col("status") == "warn", 50).otherwise(0))


def report_rows(df: DataFrame, name: str, columns: dict[str, tuple[int, str]]) -> DataFrame:
    """(name, html): a table row of a report for each row; ``columns`` gives digits and unit."""
    cells = [F.concat(F.lit("<td>"), S.shown_number(c, digits, unit), F.lit("</td>")) for c, (digits, unit) in columns.items()]
    return df.select(name, F.concat(F.lit("<tr><th>"), S.html_text(F.col(name).cast("string")), F.lit("</th>"), *cells, F.lit("</tr>")).alias("html"))


def run_report(stages: DataFrame, run: str, stage: str, status: str, seconds: str) -> DataFrame:
    """A row for each run: seconds of the stages that are done, by name and together, and the names of those that aren't."""
    done = F.col(status) == "done"
    took = F.map_from_entries(F.array_sort(F.collect_list(F.when(done, F.struct(F.col(stage), F.round(F.coalesce(seconds, F.lit(0.0)), 1))))))
    return stages.groupBy(run).agg(
        took.alias("stage_seconds"), F.round(F.sum(F.when(done, F.round(F.coalesce(seconds, F.lit(0.0)), 1)).otherwise(0.0)), 1).alias("total_seconds"), F.array_sort(F.collect_list(F.when(~done, F.col(stage)))).alias("open")
    )


def ply_counts(files: DataFrame) -> DataFrame:
    """(path, element, n) of PLY headers, from ``files(path, content)`` (a binaryFile scan)."""
    head = F.substring_index(F.decode(F.substring(F.col("content"), 1, 65536), "ISO-8859-1"), "end_header", 1)
    found = F.regexp_extract_all(head, F.lit(r"(?m)^element (\w+ \d+)"), 1)
    rows = files.select("path", F.explode(found).alias("e"))
    return rows.select("path", F.substring_index("e", " ", 1).alias("element"), F.substring_index("e", " ", -1).cast("long").alias("n"))
