"""Filling fixed-capacity containers: shortest-pack-first over the length histogram.

An item longer than the capacity is cut into full pieces and a remainder; nothing else is cut.  The pieces' lengths are
counted; the histogram has at most ``capacity`` rows, whatever the number of items, and is packed on the driver: lengths
are placed longest first, each into the shortest pack that is open (the one with most room), a whole count at a time, so
packs of one content are one pattern with a count.  Patterns then go back to the pieces by rank: the pieces of a length
are numbered, and each pattern holds runs of those numbers.

The numbering is done within (length, hash) parts whose offsets are summed, so that a length that a third of all items
have is not sorted in one task.

Defined cases: an item of length 0 or null takes no room: one row, piece 1, no container; ties go by the key; repeated
keys are packed as often as they occur; an empty input gives an empty result; capacities below 1 are an error.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F

PARTS = 64


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, count) of packs whose lengths sum to ``capacity`` or less; every length is placed as often as counted."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, count]
    roomiest: list[int] = []  # a heap of negated rooms
    import heapq

    def add(room: int, pattern: tuple[int, ...], count: int) -> None:
        if not open_[room]:
            heapq.heappush(roomiest, -room)
        open_[room].append([pattern, count])

    done: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        changed: list[tuple[int, tuple[int, ...], int]] = []
        while left:
            while roomiest and not open_[-roomiest[0]]:
                heapq.heappop(roomiest)
            room = -roomiest[0] if roomiest else -1
            if room < length:
                # As many of this length as fit one pack, so that short ones do not open a pack each.
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    changed.append((capacity - each * length, (length,) * each, full))
                if rest:
                    changed.append((capacity - rest * length, (length,) * rest, 1))
                left = 0
                break
            pattern, count = open_[room].pop()
            fit = room // length  # a pack may take several of this length
            if left >= fit * count:
                changed.append((room - fit * length, pattern + (length,) * fit, count))
                left -= fit * count
            else:
                full, rest = divmod(left, fit)
                if full:
                    changed.append((room - fit * length, pattern + (length,) * fit, full))
                if rest:
                    changed.append((room - rest * length, pattern + (length,) * rest, 1))
                if count - full - (rest > 0):
                    add(room, pattern, count - full - (rest > 0))
                left = 0
        for room, pattern, count in changed:
            if room:
                add(room, pattern, count)
            else:
                done.append((pattern, count))
    return done + [(p, c) for group in open_.values() for p, c in group]


def ranked(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """The rows with ``__rank`` from 0 within ``by``, numbered in parts so that no value is sorted in one task."""
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int")
    parts = df.withColumn("__part", part)
    counts = parts.groupBy(by, "__part").agg(F.count("*").alias("__c"))
    offsets = counts.select(by, "__part", (F.sum("__c").over(Window.partitionBy(by).orderBy("__part")) - F.col("__c")).alias("__before"))
    inner = parts.withColumn("__in", F.row_number().over(Window.partitionBy(by, "__part").orderBy(*order)) - 1)
    return inner.join(offsets, [by, "__part"]).withColumn("__rank", F.col("__before") + F.col("__in")).drop("__part", "__in", "__before")


def pieces(items: DataFrame, key: str, size: Column, capacity: int) -> DataFrame:
    """(key, piece, tokens): one row for each piece of 1 to ``capacity`` tokens; none for empty items."""
    n = F.ceil(F.col("__n") / F.lit(capacity)).cast("int")
    return (
        items.select(F.col(key), size.cast("bigint").alias("__n")).filter(F.col("__n") > 0)
        .select(F.col(key), "__n", F.explode(F.sequence(F.lit(1), n)).alias("piece"))
        .select(F.col(key), "piece", F.least(F.lit(capacity), F.col("__n") - (F.col("piece") - 1) * F.lit(capacity)).cast("int").alias("tokens"))
    )


def pack(items: DataFrame, key: str, size: Column, capacity: int) -> DataFrame:
    """(key, piece, tokens, bin_id, slot): the container of every piece; containers count from 1."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = items.sparkSession
    cut = pieces(items, key, size, capacity)
    histogram = {r.tokens: r["n"] for r in cut.groupBy("tokens").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    taken: dict[int, int] = defaultdict(int)
    runs, first = [], 1
    for pattern, count in pack_histogram(histogram, capacity):
        for slot, length in enumerate(pattern, 1):
            runs.append((length, taken[length], taken[length] + count, first, slot))
            taken[length] += count
        first += count
    table = spark.createDataFrame(runs, "tokens int, __from bigint, __to bigint, __bin bigint, slot int")
    # Runs of a length are cut at blocks of ranks, so that the join has an equality for the range.
    width = 1024
    table = table.withColumn("__block", F.explode(F.sequence(F.floor(F.col("__from") / width), F.floor((F.col("__to") - 1) / width))))
    numbered = ranked(cut, "tokens", [key, "piece"]).withColumn("__block", F.floor(F.col("__rank") / width))
    held = numbered.join(table, ["tokens", "__block"]).filter((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    packed = held.select(F.col(key), "piece", "tokens", (F.col("__bin") + F.col("__rank") - F.col("__from")).alias("bin_id"), "slot")
    empty = items.select(F.col(key), F.coalesce(size.cast("bigint"), F.lit(0)).alias("__n")).filter("__n <= 0")
    return packed.unionByName(empty.select(F.col(key), F.lit(1).alias("piece"), F.lit(0).alias("tokens"), F.lit(None).cast("bigint").alias("bin_id"), F.lit(None).cast("int").alias("slot")))
