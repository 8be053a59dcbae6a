"""Sharding by balanced label propagation.

Documents with equal texts are linked (each to the hub of its group, never to
each other).  Every document starts in a shard drawn from its id.  Every linked
group goes through the propagation.  Its first move is that of groups larger
than half a shard, of which no two fit in one (twice the number of shards at
most): they claim their room, the largest first, in the fullest shard that still
holds them whole, else spread over the shards with most room, as few as fit; the
others start by the room that is left.  In each round every other group prefers the shard that holds most of it,
its documents elsewhere ask to move there, and the moves are granted under
quotas: between two shards as many as ask in both directions, plus the
receiving shard's free capacity.  In every other round a group prefers a shard
with room.  No move raises the number of cut edges (documents away from most of
their group); the rounds end when no edge is cut or ``PATIENCE`` rounds bring
no fewer.  Unlinked documents cut no edge wherever they go; they fill what
capacity the linked ones leave.  A last pass numbers all documents by label and
gives each label's documents the places of its shard, larger groups first; what
is over goes with the unlinked ones.  The counts of the shards differ by one at
most.

State is one row per linked group with its counts per shard, made by a
map-side aggregate: a group that holds a third of all documents is one row.
What reaches the driver is the shards x shards matrix of requested moves and
one row per claim.

Edge cases: a NULL text has no bytes (size 1, crc32 0) and equals an empty one;
repeated rows are documents of their own; NULL ids are placed like any other;
an empty table gives an empty result; fewer documents than shards leave shards
empty.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import release, write_through

GROUP = ["text_hash", "text_crc32", "size"]
# rounds without fewer cut edges after which the labels are settled (of both kinds of rounds two)
PATIENCE = 4


def _fraction(*cols) -> Column:
    """A number in [0, 1) drawn from the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _pick(fraction: Column, weights: Column, total: Column) -> Column:
    """The index whose share of ``weights`` holds ``fraction`` of ``total``."""
    before = F.aggregate(
        weights, F.struct(F.lit(0).cast("double").alias("sum"), F.lit(0).alias("ix"), F.lit(0).alias("passed")),
        lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["ix"] + 1).alias("ix"),
                              F.when(a["sum"] + w <= fraction * total, a["ix"] + 1)
                              .otherwise(a["passed"]).alias("passed")))
    return F.least(before["passed"], F.size(weights) - 1)


def _quotas(demand: list[list[int]], free: list[int]) -> list[list[float]]:
    """Granted share of the moves asked for from shard i to shard j."""
    k = len(free)
    granted = [[0.0] * k for _ in range(k)]
    for j in range(k):
        swap = [min(demand[i][j], demand[j][i]) for i in range(k)]
        left = sum(demand[i][j] - swap[i] for i in range(k))
        share = min(1.0, max(0, free[j]) / left) if left else 0.0
        for i in range(k):
            if demand[i][j]:
                granted[i][j] = (swap[i] + share * (demand[i][j] - swap[i])) / demand[i][j]
    return granted


def _reserve(sizes: list[int], room: list[int]) -> list[list[int]]:
    """For groups from the largest to the smallest the documents per shard; ``room`` is lowered by them."""
    out = []
    for n in sizes:
        held = [0] * len(room)
        while n:
            whole = [s for s, r in enumerate(room) if r >= n]
            s = min(whole, key=lambda s: room[s]) if whole else max(range(len(room)), key=lambda s: room[s])
            held[s] = min(n, room[s])
            room[s] -= held[s]
            n -= held[s]
        out.append(held)
    return out


def _whole(held: str) -> Column:
    return F.aggregate(held, F.lit(0).cast("bigint"), lambda a, n: a + n)


def _standing(state: DataFrame, shards: int) -> tuple[list[int], int]:
    """The load per shard and the number of cut edges but for those of claims."""
    cut = F.when(F.col("claimed"), 0).otherwise(_whole("held") - F.array_max("held"))
    sums = state.agg(*[F.sum(F.col("held")[s]).alias(f"s{s}") for s in range(shards)], F.sum(cut).alias("cut")).first()
    return [int(x or 0) for x in sums[:shards]], int(sums["cut"] or 0)


def propagate_labels(groups: DataFrame, claims: DataFrame, room: list[int], shards: int) -> DataFrame:
    """``GROUP columns, held`` (counts per shard) when the labels are settled; ``room`` is the capacity per shard.

    ``claims`` holds ``claim``, the counts per shard, of the groups that move first and then stay."""
    state = write_through(groups.join(F.broadcast(claims), GROUP, "left").select(
        *GROUP, F.coalesce("claim", "held").alias("held"), F.col("claim").isNotNull().alias("claimed")), "labels")
    load, cut = _standing(state, shards)
    r = idle = 0
    while cut and idle < PATIENCE:
        free = F.array(*[F.lit(max(0, c - x)) for c, x in zip(room, load, strict=True)])
        # the preferred shard: most of the group, ties by chance; in odd rounds shards without room only where no
        # shard that holds some of the group has any
        some = F.exists(F.arrays_zip(F.col("held").alias("n"), free.alias("room")), lambda x: (x["n"] > 0) & (x["room"] > 0))
        some = some & F.lit(r % 2 == 1)
        ranked = F.transform(F.col("held"), lambda n, i: F.struct(
            F.when(some & (F.get(free, i) <= 0), F.lit(-1).cast("bigint")).otherwise(n),
            F.xxhash64(*GROUP, i, F.lit(r)), i.alias("shard")))
        asking = state.withColumn("target", F.array_max(ranked)["shard"])
        asking = asking.withColumn("moving", F.transform("held", lambda n, i: F.when(
            ~F.col("claimed") & (i != F.col("target")) & (n <= F.get("held", F.col("target"))), n).otherwise(F.lit(0).cast("bigint"))))
        asked = (asking.select("target", F.posexplode("moving").alias("shard", "n")).where("n > 0")
                 .groupBy("shard", "target").agg(F.sum("n").alias("n")).collect())
        demand = [[0] * shards for _ in range(shards)]
        for row in asked:
            demand[row.shard][row.target] = row.n
        granted = _quotas(demand, [c - x for c, x in zip(room, load, strict=True)])
        before = cut
        if any(any(row) for row in granted):
            share = F.array(*[F.array(*[F.lit(granted[i][j]) for i in range(shards)]) for j in range(shards)])
            moved = asking.withColumn("share", F.get(share, F.col("target"))).withColumn("moved", F.transform(
                "moving", lambda n, i: F.least(n, F.floor(n * F.get("share", i) + _fraction(*GROUP, i, F.lit(r))))))
            arrived = F.aggregate("moved", F.lit(0).cast("bigint"), lambda a, m: a + m)
            following = write_through(moved.select(*GROUP, F.transform("held", lambda n, i: n - F.get("moved", i) + F.when(
                i == F.col("target"), arrived).otherwise(F.lit(0).cast("bigint"))).alias("held"), "claimed"), "labels")
            release(state)
            state = following
            load, cut = _standing(state, shards)
        r, idle = r + 1, 0 if cut < before else idle + 1
    return state


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``ix``, its place in the order; equal rows take any of their places."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_through(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(starts), "_part").withColumn("ix", place).drop("_part", "_at", "_n", "_start")


def _segments(spread: list[list[int]], labelled: list[int], total: int, quota: list[int]) -> list[tuple[int, int, int]]:
    """First place in the order, shard and first slot of each run of documents that follow each other in a shard.

    The order holds the ``spread`` groups (their documents per shard), then the ``labelled`` documents of each shard,
    then the others; labelled documents for which the shard has no slot left go with the others."""
    used, at, out, others = [0] * len(quota), 0, [], []

    def put(first: int, shard: int, n: int) -> None:
        if n:
            out.append((first, shard, used[shard]))
            used[shard] += n

    for held in spread:
        for shard, n in enumerate(held):
            put(at, shard, n)
            at += n
    for shard, n in enumerate(labelled):
        fitting = min(n, quota[shard] - used[shard])
        put(at, shard, fitting)
        others.append((at + fitting, n - fitting))
        at += n
    others.append((at, total - at))
    for first, n in others:
        for shard in range(len(quota)):
            take = min(n, quota[shard] - used[shard])
            put(first, shard, take)
            first, n = first + take, n - take
    return sorted(out)


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot``: counts of the shards differ by
    one at most, equal texts share a shard where the capacity allows it."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    nodes = write_through(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")), "nodes")
    total = nodes.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    n_docs = F.count(F.lit(1)).alias("n_docs")
    # at most twice the number of shards
    large = nodes.groupBy(*GROUP).agg(n_docs).where((F.col("n_docs") > 1) & (F.col("n_docs") * 2 > max(quota))).collect()
    large.sort(key=lambda g: (-g.n_docs, g.text_hash, g.text_crc32, g.size))
    room = list(quota)
    reserved = _reserve([g.n_docs for g in large], room)
    spread = [h for h in reserved if sum(n > 0 for n in h) > 1]
    runs = iter(range(len(spread)))
    claims = spark.createDataFrame(
        [(g.text_hash, g.text_crc32, g.size, h, next(runs) if h in spread else None)
         for g, h in zip(large, reserved, strict=True)],
        "text_hash bigint, text_crc32 bigint, size bigint, claim array<bigint>, spread_run int")

    weights = F.array(*[F.lit(float(x)) for x in room])
    start = _pick(_fraction("id", *GROUP, F.lit("start")), weights, F.lit(float(max(1, sum(room)))))
    counts = nodes.withColumn("start", start).groupBy(*GROUP).agg(
        F.array(*[F.count_if(F.col("start") == s) for s in range(shards)]).alias("held"))
    state = propagate_labels(counts.where(_whole("held") > 1), claims.drop("spread_run"), quota, shards)

    both = nodes.join(state, GROUP, "left").join(F.broadcast(claims.drop("claim")), GROUP, "left")
    held = F.transform("held", lambda n: n.cast("double"))
    whole = F.aggregate(held, F.lit(0.0), lambda a, n: a + n)
    label = F.lit(len(spread)) + _pick(_fraction("id", *GROUP, F.lit("place")), held, whole)
    run = F.when(F.col("spread_run").isNotNull(), F.col("spread_run")).when(F.col("held").isNotNull(), label).otherwise(
        F.lit(len(spread) + shards))
    # larger groups first
    rank = -F.coalesce(whole.cast("bigint"), F.lit(1).cast("bigint"))
    numbered = _numbered(both.select("id", *GROUP, run.cast("int").alias("run"), rank.alias("rank")),
                         ["run", "rank", *GROUP, "id"])
    found = {r.run: r.n_docs for r in numbered.groupBy("run").agg(n_docs).collect()}
    pieces = _segments(spread, [found.get(len(spread) + s, 0) for s in range(shards)], total, quota) or [(0, 0, 0)]
    places = F.array(*[F.struct(F.lit(a).cast("bigint").alias("first"), F.lit(s).alias("shard"),
                                F.lit(b).cast("bigint").alias("slot")) for a, s, b in pieces])
    placed = numbered.withColumn("piece", F.element_at(F.filter(places, lambda p: p["first"] <= F.col("ix")), -1))
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.col("piece.shard").alias("shard"),
                         (F.col("piece.slot") + F.col("ix") - F.col("piece.first")).alias("slot"))
