"""Mixing sources to target weights along a time-varying curriculum.

1. Targets: sources weigh 5, 2, 1 in turn and share all words; a source stops
   at ``MAX_EPOCHS`` times its own size, and the excess is shared again by
   weight until none is above. That fixed point is found in one sorted pass
   over the sources: by cap / weight ascending, the capped ones are a prefix.
2. A source's stream is its documents in the order of a content hash, read
   again from the start for a further epoch. A copy is taken when it ends
   before the target; the room left, less than one document, is filled by a
   stream of the documents that fit into it, ``FILLS`` times, and at last by the
   longest that fits. So documents stay whole and the words taken come close to
   the target. The running word count is taken in two
   levels: sums per hash range of a source, then a window inside each range, so
   a source holding a third of all rows is spread over many tasks.
3. Curriculum: a source's weight runs linearly from a start to an end value
   over training time t in [0, 1]. Its integral, scaled to the target, is the
   words asked of it until t; a copy's training position is the time at which
   that demand reaches the copy's middle (the inverse, a quadratic root). A
   filling copy comes at the end.
4. ``mixed_documents`` repeats the documents and range-sorts them by position;
   ``mix_taken`` counts what each document has in that sorted mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, write_once

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Start of the weight schedule by place in WEIGHTS; it ends at 2 - start, so
# that its integral over [0, 1] is 1.
SCHEDULE_STARTS = (1.5, 1.0, 0.5)
ROWS_PER_RANGE = 50_000
FILLS = 2


def _pick(values: tuple, at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, start``: one row per source of ``sizes``
    (``source, source_size``). The windows run over one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = ((F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("int")
    total = F.sum("source_size").over(Window.partitionBy())
    s = sizes.withColumn("place", place).withColumn("total", total)
    s = s.withColumns({"weight": _pick(WEIGHTS, F.col("place")).cast("long"), "start": _pick(SCHEDULE_STARTS, F.col("place"))})
    s = s.withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = s.withColumns({
        "left": F.col("total") - before,
        "weights_left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    capped = F.col("left") * F.col("weight") >= F.col("cap") * F.col("weights_left")
    s = s.withColumn("capped", capped)
    # left / weights_left of the first source that isn't capped holds for all of them.
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = {c: F.first(F.when(~F.col("capped"), F.col(c)), ignorenulls=True).over(everything) for c in ("left", "weights_left")}
    free = (F.col("weight") * share["left"]).cast("double") / share["weights_left"].cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free)
    return s.select("source", "source_size", target.alias("target"), "start")


def _position(start: Column, share: Column) -> Column:
    """Time t at which the integral of start + (end - start) t, with end = 2 -
    start, reaches ``share``."""
    slope = F.lit(2.0) - F.lit(2.0) * start
    root = (F.sqrt(start * start + F.lit(2.0) * slope * share) - start) / slope
    return F.when(slope == 0, share).otherwise(root)


def plan_mix(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken, copies, positions``.

    ``size`` is the number of words, ``copies`` how often the mix takes the
    document (0 to 3), ``taken`` = copies * size, ``positions`` the training
    time of each copy.

    Defined cases: a null or blank text has size 0 and is taken where its
    place in the stream is before the target, and once if its source has no
    words at all; a null source is a source of
    its own, after all others; documents equal in doc_id and text are ordered
    alike and each counts; an empty table gives an empty result; input columns
    with the names added here are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    sized = docs.withColumns({"size": F.regexp_count(text, F.lit(WORD)).cast("long"), "__key": key})
    narrow = write_once(sized.select("source", "doc_id", "size", F.col("__key").alias("key")), "mix-sizes")
    digits = max(1, math.ceil(math.log(max(1, narrow.count() / ROWS_PER_RANGE), 16)))
    ranges = narrow.groupBy("source", F.left("key", F.lit(digits)).alias("range")).agg(F.sum("size").alias("words"))
    ranges = write_once(ranges, "mix-ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    ranges = ranges.select(F.col("source").alias("__source"), F.col("range").alias("__of"), "__before")
    targets = targets.select(F.col("source").alias("__s"), "source_size", "target", F.col("start").alias("__start"))
    places = write_once(ranges.join(targets, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s"), "mix-places")

    fills = write_once(_fills(_streamed(narrow, places, "key", digits), digits), "mix-extra")
    rest = [c for c in sized.columns if c not in ("source_size", "target", "taken", "copies", "positions")]
    d = _streamed(sized.select(*rest), places, "__key", digits)
    d = d.join(fills, (F.col("__key") == F.col("__fill")) & F.col("source").eqNullSafe(F.col("__fs")) & ~F.col("__again"), "left")
    more = F.when(F.col("__fill").isNotNull(), 1).otherwise(0)
    target = F.nullif(F.col("target"), F.lit(0.0))
    middles = [(F.col("__ends")[e] - F.col("size") / F.lit(2.0)) / target for e in range(MAX_EPOCHS)]
    streamed = F.slice(F.array(*[_position(F.col("__start"), F.coalesce(m, F.lit(0.0))) for m in middles]), F.lit(1), F.col("copies"))
    d = d.withColumn("positions", F.concat(streamed, F.array_repeat(F.lit(1.0), more)))
    d = d.withColumn("copies", F.col("copies") + more)
    d = d.withColumn("taken", F.col("copies") * F.col("size"))
    kept = [c for c in rest if c != "__key"]
    return d.select(*kept, "source_size", "target", "taken", "copies", "positions")


def _streamed(rows: DataFrame, places: DataFrame, key: str, digits: int) -> DataFrame:
    """``rows`` with their source's numbers, ``__ends`` (the end of each copy in
    the source's stream), ``copies`` that end before the target, and
    ``__again``: an equal document comes before it."""
    d = rows.withColumn("__range", F.left(key, F.lit(digits)))
    ordered = Window.partitionBy("source", "__range").orderBy(key, "doc_id")
    d = d.withColumns({
        "__inside": F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
        "__again": F.coalesce(F.lag(key).over(ordered) == F.col(key), F.lit(False)),
    })
    d = d.join(places, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__of")))
    end = F.col("__before") + F.col("__inside")
    d = d.withColumn("__ends", F.array(*[F.lit(e) * F.col("source_size") + end for e in range(MAX_EPOCHS)]))
    copies = F.size(F.filter("__ends", lambda x: x <= F.col("target")))
    return d.withColumn("copies", F.when(F.col("source_size") == 0, F.lit(1)).otherwise(copies))


def _fills(streamed: DataFrame, digits: int) -> DataFrame:
    """``__fs, __fill``: per source the keys of documents that are taken once
    more to fill the room that the stream has left."""
    s = streamed.filter("source_size > 0").select(F.struct("source").alias("g"), "key", "size", "copies", "target", "__again")
    s = write_once(s, "mix-stream")
    room = s.groupBy("g").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("room"))
    free = s.filter((F.col("copies") < MAX_EPOCHS) & ~F.col("__again") & (F.col("size") > 0)).select("g", "key", "size")
    picked = None
    for fill in range(FILLS + 1):
        room = write_once(room, "mix-room")
        fits = free.join(room, "g").filter(F.col("size") <= F.col("room"))
        if picked is not None:
            fits = fits.join(picked.select("g", "key"), ["g", "key"], "left_anti")
        if fill < FILLS:
            # The two-level running count again, over what fits.
            fits = write_once(fits.withColumn("range", F.left("key", F.lit(digits))), "mix-fits")
            earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
            before = fits.groupBy("g", "range").agg(F.sum("size").alias("words"))
            before = before.select("g", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
            inside = F.sum("size").over(Window.partitionBy("g", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
            placed = fits.withColumn("inside", inside).join(before, ["g", "range"])
            taken = placed.filter(F.col("before") + F.col("inside") <= F.col("room")).select("g", "key", "size")
        else:
            best = fits.groupBy("g").agg(F.max(F.struct("size", "key")).alias("best"))
            taken = best.select("g", "best.key", "best.size")
        taken = write_once(taken, "mix-fills")
        spent = taken.groupBy("g").agg(F.sum("size").alias("spent"))
        room = room.join(spent, "g", "left").select("g", (F.col("room") - F.coalesce("spent", F.lit(0))).alias("room"))
        picked = taken if picked is None else picked.union(taken)
    return picked.select(F.col("g.source").alias("__fs"), F.col("key").alias("__fill"))


def in_training_order(planned: DataFrame, ident: Column) -> DataFrame:
    """``planned`` (with ``positions`` and ``__tie``) once per copy, with the copy's
    ``__position``: range-sorted by it over the output's partitions, ties by
    ``ident`` and ``__tie``."""
    copies = planned.withColumn("__position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("__position", "__tie").sortWithinPartitions("__position", ident, "__tie")


def _tie() -> Column:
    return F.xxhash64("doc_id", "text").alias("__tie")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix: ``docs`` rows repeated ``copies`` times, range-sorted by training
    position over the output's partitions, in the columns of ``docs``."""
    # The row travels whole, so that its columns may have the names of the plan's.
    rows = docs.select("doc_id", "text", "source", _tie(), F.struct(*docs.columns).alias("__row"))
    planned = plan_mix(rows).select("__row", "positions", "__tie")
    return in_training_order(planned, F.col("__row.doc_id")).select("__row.*")


def mix_taken(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``, read back from the mix in training order: ``doc_id,
    size, source_size, target, taken, first_position``.

    The copies are range-sorted as in ``mixed_documents`` and written, without
    their texts; ``taken`` counts the words of a row's copies found there,
    ``first_position`` is the training time of the one that comes first (null if
    there is none). A copy is known by its row's number, so that rows equal in
    all columns stay apart.
    """
    planned = plan_mix(docs.select("doc_id", "text", "source", _tie()))
    planned = planned.select("doc_id", "__tie", "size", "source_size", "target", "positions")
    rows = write_once(planned.withColumn("row", F.monotonically_increasing_id()), "mix-plan")
    mix = in_training_order(rows.select("row", "doc_id", "__tie", "size", "positions"), F.col("doc_id"))
    # The id rises along the partitions, and so along the sorted mix.
    mix = write_once(mix.select("row", "size", "__position", F.monotonically_increasing_id().alias("place")), "mix-order")
    found = mix.groupBy("row").agg(F.sum("size").alias("found"), F.min(F.struct("place", "__position")).alias("head"))
    taken = F.coalesce("found", F.lit(0)).alias("taken")
    return rows.join(found, "row", "left").select(
        "doc_id", "size", "source_size", "target", taken, F.col("head.__position").alias("first_position")
    )
