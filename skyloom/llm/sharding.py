"""Consistent-hash ring with virtual nodes and bounded loads (operator 4), native.

Keys stand on a ring at the hash of their id; each of the arcs between virtual nodes belongs to the shard of
the node at its clockwise end. A shard takes the keys of its arcs until it is full; the keys of an arc that
find no room go on clockwise to the next shard with room. What is counted, carried over and looked up is the
ring's arcs, whose number is fixed by the parameters, never the keys: each key then finds its shard by its
rank within its arc.

Capacities are ``floor`` or ``ceil`` of rows over shards (``slack`` 0), so counts are at most one apart, or
``ceil((1 + slack) * rows / shards)``.

Edge cases: a null id stands at the hash of null; repeated rows are placed one by one; equal positions are
told apart by the id and the row's place in the written key table; an empty table gives no rows; other
columns are ignored; a null text has size 8 and the crc32 of nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import materialise

#: Positions on the ring: the upper bits of a 64-bit hash.
RING_BITS = 32
#: Slices of an arc in which ranks are counted apart, so that a repeated id's rows are not all in one task.
SLICES = 16


def _position(c: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 64 - RING_BITS)


def ring(spark, shards: int, nodes: int) -> DataFrame:
    """(arc, lo, hi, shard): arcs in ring order; arc k holds the positions in [lo, hi)."""
    points = spark.range(shards * nodes, numPartitions=1).select(
        F.col("id").cast("int").alias("node"), (F.col("id") % shards).cast("int").alias("shard")
    )
    points = points.withColumn("at", F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", (F.col("node") / shards).cast("int")), 64 - RING_BITS))
    points = points.groupBy("at").agg(F.min("shard").alias("shard"))  # two nodes on one position are one
    order = Window.orderBy("at")
    arcs = points.select(
        (F.row_number().over(order) - 1).cast("int").alias("arc"),
        F.coalesce(F.lag("at").over(order) + 1, F.lit(0)).alias("lo"),
        (F.col("at") + 1).alias("hi"),
        "shard",
    )
    # positions behind the last node belong to the first node's shard
    last = points.agg(F.max("at").alias("at"), F.count("*").cast("int").alias("arc"), F.min_by("shard", "at").alias("shard"))
    tail = last.select("arc", (F.col("at") + 1).alias("lo"), F.lit(1 << RING_BITS).cast("long").alias("hi"), "shard")
    return arcs.unionByName(tail)


def _clockwise(arcs: DataFrame) -> DataFrame:
    """(arc, shard, route): the shards met clockwise from an arc, the nearest first. All arcs are one bounded list."""
    listed = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard"))).alias("all"))
    around = F.expr("concat(transform(all, x -> x.shard), transform(all, x -> x.shard))")
    return listed.select("all", around.alias("around")).select(F.explode("all").alias("x"), "around").select(
        "x.arc", "x.shard", F.expr("array_distinct(slice(around, x.arc + 1, size(around) div 2))").alias("route")
    )


def _plan(counts: DataFrame, route: DataFrame, shards: int, slack: float) -> DataFrame:
    """(arc, shard, first, n, slot): ranks [first, first + n) of an arc go to the shard's slots from ``slot`` on.

    A fold over the arcs in ring order, as native expressions on one row: first each shard takes what its own
    arcs hold, then the rest of each arc goes clockwise. The lists have an entry for each arc.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    own = route.join(counts, "arc", "left").fillna(0, ["n"])
    by_shard = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    cap = (
        F.expr(f"cast(total div {shards} + int(shard < total % {shards}) as long)")
        if not slack
        else F.ceil(F.lit(1 + slack) * F.col("total") / shards).cast("long")
    )
    before = F.coalesce(F.sum("n").over(by_shard), F.lit(0))
    own = own.crossJoin(total).select("arc", "shard", "route", "n", cap.alias("cap"), before.alias("before"))
    own = own.withColumn("took", F.greatest(F.lit(0), F.least("n", F.col("cap") - F.col("before"))))
    room = own.groupBy("shard").agg((F.first("cap") - F.sum("took")).alias("room"), F.sum("took").alias("used"))
    rooms = room.agg(F.expr("map_from_entries(collect_list(struct(shard, room)))").alias("rooms"))
    left = own.where("n > took").select("arc", "route", F.col("took").alias("first"), (F.col("n") - F.col("took")).alias("over"))
    lists = left.agg(F.expr("sort_array(collect_list(struct(arc, first, over, route)))").alias("arcs")).crossJoin(rooms)
    fold = f"""
      aggregate(arcs,
        struct(transform(sequence(0, {shards} - 1), s -> coalesce(rooms[s], 0L)) as room,
               cast(array() as array<struct<arc int, shard int, first bigint, n bigint>>) as moves),
        (acc, a) -> struct_of(acc, a))"""
    step = """
      named_struct(
        'room', transform(acc.room, (r, s) -> r - coalesce(get(filter(given, g -> g.shard = s), 0).n, 0L)),
        'moves', concat(acc.moves, transform(given, g -> named_struct('arc', a.arc, 'shard', g.shard, 'first', g.first, 'n', g.n))))"""
    # what each shard on the route takes: the overflow that is left when it is reached, its room at most
    given = """
      filter(aggregate(a.route,
        named_struct('left', a.over, 'out', cast(array() as array<struct<shard int, first bigint, n bigint>>)),
        (g, s) -> named_struct(
          'left', g.left - least(g.left, acc.room[s]),
          'out', concat(g.out, array(named_struct('shard', s, 'first', a.first + a.over - g.left, 'n', least(g.left, acc.room[s])))))
      ).out, g -> g.n > 0)"""
    step = f"element_at(transform(array({given}), given -> {step}), 1)"
    moves = lists.select(F.expr(fold.replace("struct_of(acc, a)", step)).alias("f")).select(F.explode("f.moves").alias("m")).select("m.*")
    moved = moves.join(room.select("shard", "used"), "shard", "left")
    after = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    moved = moved.select("arc", "shard", "first", "n", (F.coalesce("used", F.lit(0)) + F.coalesce(F.sum("n").over(after), F.lit(0))).alias("slot"))
    kept = own.where("took > 0").select("arc", "shard", F.lit(0).cast("long").alias("first"), F.col("took").alias("n"), F.col("before").alias("slot"))
    return kept.unionByName(moved)


def place(keys: DataFrame, shards: int = 24, *, nodes: int = 256, slack: float = 0.0) -> DataFrame:
    """``keys(id, ...)`` with ``shard`` and ``slot``.

    At most ``shards * nodes`` arcs and ``SLICES`` times as many counts are sorted, listed or broadcast,
    whatever the number of keys. ``keys`` is read twice and must be a written table (see ``materialise``).
    """
    spark = keys.sparkSession
    arcs = ring(spark, shards, nodes)
    # a key finds its arc by bisection in one bounded list
    starts = F.broadcast(arcs.agg(F.sort_array(F.collect_list("lo")).alias("__starts")))
    at = _position(F.col("id"))
    half = "shiftright(b.lo + b.hi, 1)"
    narrow = f"if(__starts[{half}] <= __at, named_struct('lo', {half}, 'hi', b.hi), named_struct('lo', b.lo, 'hi', {half}))"
    steps = (shards * nodes).bit_length() + 1
    arc = F.expr(f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', size(__starts)), (b, k) -> if(b.hi - b.lo <= 1, b, {narrow})).lo")
    rows = keys.withColumn("__at", at).crossJoin(starts).withColumn("__arc", arc).drop("__starts")
    rows = materialise(rows.withColumn("__slice", (F.monotonically_increasing_id() % SLICES).cast("int")), "ring-keys")
    sliced = rows.groupBy(F.col("__arc").alias("arc"), F.col("__slice").alias("slice")).agg(F.count("*").alias("n"))
    by_arc = Window.partitionBy("arc").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sliced = materialise(sliced.withColumn("before", F.coalesce(F.sum("n").over(by_arc), F.lit(0))), "ring-counts")
    counts = sliced.groupBy("arc").agg(F.sum("n").alias("n"))
    plan = _plan(counts, _clockwise(arcs), shards, slack)
    pieces = plan.groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("first", "n", "shard", "slot"))).alias("pieces"))
    # at most a row for each slice of an arc, and one with the pieces for each arc
    offsets = sliced.select(F.col("arc").alias("__arc"), F.col("slice").alias("__slice"), "before")
    pieces = pieces.withColumnRenamed("arc", "__arc")
    rank = F.row_number().over(Window.partitionBy("__arc", "__slice").orderBy("__at", "id")) - 1
    ranked = rows.withColumn("__rank", rank).join(F.broadcast(offsets), ["__arc", "__slice"]).join(F.broadcast(pieces), "__arc")
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("before"))
    piece = F.expr("get(filter(pieces, p -> __rank >= p.first and __rank < p.first + p.n), 0)")
    ranked = ranked.withColumn("__piece", piece)
    slot = F.col("__piece.slot") + F.col("__rank") - F.col("__piece.first")
    return ranked.select(*keys.columns, F.col("__piece.shard").alias("shard"), slot.alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, **options) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): counts at most one apart (law ``rows``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return place(keys, shards, **options).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents on 24 shards."""
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
