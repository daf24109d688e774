"""Shared steps of the training-data operators.

Intermediate tables are written below the folder of ``spark.checkpoint.dir``
(see ``strata.session``), never to executor-local disks, so a lost executor
costs only its running tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import delete_paths, scratch_path, scratch_scope

# White space of the word rule [^\x20\x09-\x0D]+ (ASCII only).
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Elements before one that are kept with it, to tell pairs that met already.
EARLIER = 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read again. The shuffle files of the write are removed as soon as it is done: nothing
    reads them later, and the steps of one operator would otherwise fill the
    local disks until the driver collects its garbage.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again."""
    return _write(df, scratch_path(df.sparkSession, name))


def distilled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written; all that it has written itself is deleted."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        return _write(make(), path)


def drop_written(*frames: DataFrame) -> None:
    """Delete tables of ``write_once`` that no later step reads."""
    for frame in frames:
        delete_paths(frame.sparkSession, [frame.written_to])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays (``lower`` would fold more)."""
    return F.translate(text, UPPER, UPPER.lower())


def word_array(text: Column) -> Column:
    """The words of a text, in order; empty for a null or blank text.

    ``split`` leaves an empty string before leading and after trailing white
    space, and one for an empty text; they are filtered out.
    """
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def shingle_hashes(words: str, width: int) -> Column:
    """64-bit hashes of the runs of ``width`` words of column ``words``; a
    shorter sequence is one run, an empty one has none.

    ``words`` must name a materialised column: the lambda reads it per element.
    """
    n = F.size(F.col(words))

    def run(w: Column, i: Column) -> Column:
        # xxhash64 skips null arguments, so a short text hashes as a whole.
        return F.xxhash64(w, *[F.get(F.col(words), i + F.lit(k)) for k in range(1, width)])

    runs = F.transform(F.col(words), run)
    return F.slice(runs, F.lit(1), F.greatest(n - F.lit(width - 1), F.least(n, F.lit(1))))


def with_places(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``: their number from 0 in their ``group`` (never
    null) by ``order``, nulls first. Rows equal in it take any order.

    The rows are range-sorted and written; a row's number is its place in its
    piece plus the rows of its group in earlier pieces, from one summary row per
    piece and group. No group passes through one task, and rows that tie spread
    over pieces.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
    ranged = ranged.sortWithinPartitions(*keys).drop("__tie")
    # The id counts the rows of a partition from 0 in its low 33 bits.
    written = write_once(ranged.withColumn("__at", F.monotonically_increasing_id()), name)
    piece = F.shiftrightunsigned("__at", 33)
    split = written.withColumns({"__piece": piece, "__at": F.col("__at") - F.shiftleft(piece, 33)})
    pieces = split.groupBy(group, "__piece").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    # Written, its size is known, and Spark chooses the join by it.
    pieces = write_once(pieces.select(group, "__piece", shift.alias("__shift")), f"{name}-pieces")
    placed = split.join(pieces, [group, "__piece"]).withColumn("place", F.col("__at") + F.col("__shift"))
    return placed.drop("__piece", "__at", "__shift")


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; ``component`` is the
    smallest node reachable. Nodes are longs; edges may repeat.

    Distributed union-find: each round a node takes the smallest label among
    itself and its neighbours, then the label of its label (path halving),
    until no label changes. Every step is a join or a grouped minimum with
    partial aggregation; a hub holding most edges is a skewed join key, which
    AQE splits. Rounds are written to the shared folder, which cuts lineage.
    Only the count of changed labels reaches the driver.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    both = write_once(pairs.union(pairs.select("y", "x")).distinct(), f"{name}-edges")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low"))
    labels = write_once(labels.select("node", F.least("node", "low").alias("label")), f"{name}-labels")
    while True:
        old = labels
        near = (
            both.join(labels.select(F.col("node").alias("y"), "label"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("low"))
        )
        hooked = write_once(
            labels.select("node", "label").join(near, "node").select(
                "node", F.col("label").alias("was"), F.least("label", "low").alias("label")
            ),
            f"{name}-hooked",
        )
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(up, "label").select("node", F.col("up").alias("label"), (F.col("up") != F.col("was")).alias("moved"))
        labels = write_once(jumped, f"{name}-labels")
        drop_written(old, hooked)
        if labels.filter("moved").limit(1).count() == 0:
            drop_written(both)
            found = labels.select("node", F.col("label").alias("component"))
            found.written_to = labels.written_to
            return found


def _fits(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int, hashes_of: Callable[[Column], Column]) -> DataFrame:
    """Pairs ``(centre, member)`` with 100 * intersection >= percent * union of
    their full sets in ``sets`` (``node, size, body``; ``hashes_of`` the body are
    the set's longs)."""
    left = sets.select(F.col("node").alias("member"), F.col("body").alias("bm"), F.col("size").alias("sm"))
    right = sets.select(F.col("node").alias("centre"), F.col("body").alias("bc"), F.col("size").alias("sc"))
    shared = pairs.join(left, "member").join(right, "centre").select(
        "centre",
        "member",
        F.size(F.array_intersect(hashes_of(F.col("bm")), hashes_of(F.col("bc")))).cast("long").alias("shared"),
        (F.col("sm") + F.col("sc")).cast("long").alias("total"),
    )
    # union = total - shared
    return shared.filter(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * percent).select("centre", "member")


def _prefixes(sets: DataFrame, percent: int, name: str, hashes_of: Callable[[Column], Column]) -> DataFrame:
    """``element, node, size, place, earlier``: the elements by which sets of the
    similarity are found; ``earlier`` are the ``EARLIER`` before it in the set's
    order.

    ``sets``: ``node, part, size, body`` (a node may have several sets). With the
    elements of all sets in one order, rarest first, two sets of the similarity
    share an element among the first |x| - ceil(percent / 100 |x|) + 1 of each
    (prefix filter). A passage that many texts hold is common, so it comes last
    and pairs nobody. The elements that only one set holds come first in every
    order; they are counted, not moved.
    """
    each = sets.select("node", "part", "size", F.explode(F.array_distinct(hashes_of(F.col("body")))).alias("element"))
    each = write_once(each, f"{name}-elements")
    common = write_once(each.groupBy("element").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), f"{name}-common")
    own = ["node", "part"]
    at = Window.partitionBy(*own).orderBy("df", "element")
    earlier = F.array_compact(F.array(*[F.lag("element", k).over(at) for k in range(1, EARLIER + 1)]))
    shared = each.join(common, "element").withColumns(
        {"nth": F.row_number().over(at), "earlier": earlier, "n": F.count(F.lit(1)).over(Window.partitionBy(*own))}
    )
    shared = shared.withColumn("place", F.col("size") - F.col("n") + F.col("nth") - 1)
    first = shared.filter(F.col("place") < F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
    first = write_once(first.select("element", "node", "size", "place", "earlier"), f"{name}-prefixes")
    drop_written(each, common)
    return first


def _mixed(first: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """``first`` with ``component`` and ``n``, the number of rows of the element,
    where an element's nodes lie in several components."""
    rows = first.join(comps.withColumnRenamed("component", "c"), "node", "left")
    rows = rows.withColumn("component", F.coalesce("c", "node")).drop("c")
    known = rows.groupBy("element").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    return write_once(rows.join(known.filter("low <> high").select("element", "n"), "element"), f"{name}-mixed")


def _paired(a: DataFrame, b: DataFrame, percent: int, more: Column) -> DataFrame:
    """Pairs of nodes of ``a`` and ``b`` with a common element, of different
    components, whose sizes and the element's places allow the similarity: two
    sets share at most what follows their first common element, and itself."""
    other = b.select("element", *[F.col(c).alias(f"other_{c}") for c in b.columns if c != "element"])
    shares = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    near = a.join(
        other,
        (a["element"] == other["element"])
        & (F.col("component") != F.col("other_component"))
        & _fits("size", "other_size", percent)
        & (shares * 100 >= (F.col("size") + F.col("other_size") - shares) * percent)
        & more,
    )
    return near.select(F.least("node", "other_node").alias("centre"), F.greatest("node", "other_node").alias("member"))


def _merged(comps: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``comps`` with the components that ``links`` (``centre, member``) connect
    made one: union-find over components, not over all nodes again."""
    label = comps.select("node", "component")
    ends = links
    for c in ("centre", "member"):
        of = label.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
        ends = ends.join(of, c, "left").withColumn(c, F.coalesce(f"{c}_of", c)).drop(f"{c}_of")
    joined = connected_components(ends.select("centre", "member").distinct(), "centre", "member", name)
    now = joined.select(F.col("node").alias("component"), F.col("component").alias("now"))
    known = label.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    # Nodes that had no link so far.
    alone = joined.select("node", "component").join(label.select("node"), "node", "left_anti")
    out = write_once(known.unionByName(alone), f"{name}-merged")
    drop_written(joined, comps)
    return out


def _linked_by_prefixes(
    sets: DataFrame, full: DataFrame, comps: DataFrame, percent: int, name: str, hashes_of: Callable[[Column], Column]
) -> DataFrame:
    """Components with all links among the nodes of ``sets`` added; ``full`` holds
    these sets (and others), written.

    First a star: of each prefix element the node that shares most with others is
    tried against the rest, which joins what belongs to one original. Then all
    pairs of nodes that still lie in different components, by ``_paired``.
    """
    first = _prefixes(sets, percent, name, hashes_of)
    for star in (True, False):
        mixed = _mixed(first.drop("earlier") if star else first, comps, name)
        if star:
            weights = mixed.groupBy("node").agg(F.sum("n").alias("weight"))
            rank = F.struct("weight", (-F.col("node")).alias("by"))
            heads = mixed.join(weights, "node").groupBy("element").agg(F.max(F.struct(rank.alias("rank"), "node", "component", "size", "place")).alias("head"))
            heads = write_once(heads.select("element", "head.node", "head.component", "head.size", "head.place"), f"{name}-heads")
            pairs = _paired(mixed, heads, percent, F.col("node") != F.col("other_node"))
        else:
            # Sets with a common element before this one meet there already, under wider bounds.
            met = F.arrays_overlap("earlier", "other_earlier")
            pairs = _paired(mixed, mixed, percent, (F.col("node") < F.col("other_node")) & ~met)
        pairs = write_once(pairs.distinct(), f"{name}-rare")
        links = write_once(confirmed_pairs(pairs, full, percent, hashes_of), f"{name}-links")
        drop_written(mixed, pairs)
        if links.limit(1).count():
            comps = _merged(comps, links, name)
    drop_written(first)
    return comps


def linked_in_buckets(
    nodes: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    name: str,
    links: DataFrame | None = None,
    hashes_of: Callable[[Column], Column] = lambda body: body,
    temporary: tuple[DataFrame, ...] = (),
    few: int = 0,
) -> DataFrame:
    """Components of the links that shared buckets and exact sets confirm.

    ``nodes``: ``node, bands`` (a long, its bucket keys; a node may have several
    rows), written. ``sets_of(frame of node)`` gives ``node, size, body`` for the
    nodes asked for: the number of elements of the set, and what ``hashes_of``
    makes them of (the array itself, or a text that is far smaller to move).
    ``links`` are known links (``a, b``). ``temporary`` are written tables that
    are read for buckets and sets only, and then deleted. Returns ``node,
    component`` for every linked node.

    A node's weight is the number of members of all its buckets together: the
    text that others were copied from shares more buckets with them than they
    share with each other. In each bucket the node of the largest weight is
    the centre (ties: the smallest node) and makes one candidate pair with
    every other member, so a bucket of n makes n - 1 pairs. Pairs whose set
    sizes rule the similarity out go; the rest are confirmed on full sets and
    joined by union-find.

    Members other than the centre that still lie in different components of
    their bucket are compared by their rarest elements (``_linked_by_prefixes``),
    which loses none of their links. Where at most ``few`` of them lie outside the
    bucket's largest component, these are compared with all others at once, which
    is far less than to deal out the elements of all. What they have in common is
    mostly a passage that brought them into the bucket, and that pairs nobody there.
    """
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    # Two rows of one node in a bucket make no pair later.
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = write_once(shared, f"{name}-shared")
    once = write_once(buckets.join(shared, "bucket"), f"{name}-drawn")
    weights = once.groupBy("node").agg(F.sum("n").alias("weight"))
    drawn = once.join(weights, "node").select("bucket", "node", F.struct("weight", (-F.col("node")).alias("by")).alias("rank"))
    drawn = write_once(drawn, f"{name}-ranked")
    drop_written(shared, once)
    heads = drawn.groupBy("bucket").agg(F.max("rank").alias("top"))
    members = drawn.join(heads.select("bucket", (-F.col("top.by")).alias("centre")), "bucket").filter("node <> centre")
    members = write_once(members.select("bucket", "centre", "node"), f"{name}-members")
    drop_written(drawn)
    involved = members.select("node").union(members.select("centre")).distinct()
    # Parts tell the sets of one node apart.
    sets = write_once(sets_of(involved).withColumn("part", F.monotonically_increasing_id()), f"{name}-sets")
    drop_written(*temporary)
    sizes = sets.select("node", "size")
    pairs = members.select("centre", F.col("node").alias("member")).distinct()
    sized = pairs.join(sizes.withColumnRenamed("node", "member"), "member").join(
        sizes.select(F.col("node").alias("centre"), F.col("size").alias("centre_size")), "centre"
    )
    pairs = write_once(sized.filter(_fits("size", "centre_size", percent)).select("centre", "member").distinct(), f"{name}-pairs")
    found = write_once(confirmed_pairs(pairs, sets, percent, hashes_of), f"{name}-links")
    drop_written(pairs)
    if links is not None:
        found = found.unionByName(links.select(F.col("a").alias("centre"), F.col("b").alias("member")))
    comps = connected_components(found, "centre", "member", name)
    rest = _apart(members.select("bucket", "node"), comps)
    if few:
        apart = write_once(rest, f"{name}-all-apart")
        comps = _linked_in_few(apart.filter(F.col("others") <= few), sets, comps, percent, name, hashes_of)
        rest = _apart(apart.filter(F.col("others") > few).select("bucket", "node"), comps)
    rest = write_once(rest.select("node", "component").distinct(), f"{name}-apart")
    drop_written(members, *([apart] if few else []))
    if rest.limit(1).count():
        comps = _linked_by_prefixes(sets.join(rest.select("node"), "node"), sets, comps, percent, name, hashes_of)
    drop_written(sets, rest)
    return comps


def _linked_in_few(
    rows: DataFrame, sets: DataFrame, comps: DataFrame, percent: int, name: str, hashes_of: Callable[[Column], Column]
) -> DataFrame:
    """Components with the links added between different ones in the buckets of
    ``rows`` (``bucket, node, component, most``): those outside the bucket's
    largest component, ``most``, are few, and are compared with all its rows."""
    rows = rows.select("bucket", "node", "component", "most").join(sets.select("node", "size"), "node")
    rows = write_once(rows, f"{name}-few")
    other = rows.filter("component <> most").select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("node", "component", "size")])
    pairs = rows.join(other, "bucket").filter((F.col("component") != F.col("other_component")) & _fits("size", "other_size", percent))
    pairs = pairs.select(F.least("node", "other_node").alias("centre"), F.greatest("node", "other_node").alias("member")).distinct()
    pairs = write_once(pairs, f"{name}-few-pairs")
    links = write_once(confirmed_pairs(pairs, sets, percent, hashes_of), f"{name}-few-links")
    if links.limit(1).count():
        comps = _merged(comps, links, name)
    drop_written(rows, pairs, links)
    return comps


def _apart(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` (``bucket, node, ...``) of buckets with several components, each
    row's ``component`` (the node itself where it has no link), and the bucket's
    largest one (``most``) and rows outside it (``others``)."""
    rows = rows.join(comps.withColumnRenamed("component", "c"), "node", "left")
    rows = rows.withColumn("component", F.coalesce("c", "node")).drop("c")
    counts = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))
    spread = top.filter("n > top.n").select("bucket", F.col("top.component").alias("most"), (F.col("n") - F.col("top.n")).alias("others"))
    return rows.join(spread, "bucket")
