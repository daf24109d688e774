"""Fuzzy line dedup: MinHash over character shingles, banding, exact check, union-find.

Built from SQL functions only. Every non-blank line of every text takes part:

1. A line is normalised (lower case, white space runs to one space). Its
   character shingles are the runs of 12 characters at every position, so the
   last one ends at the line's end. A line without a whole shingle is one
   shingle itself, and is like no other line.
2. Equal normalised lines are one node (64-bit hash), written once. MinHash: its
   shingles are unnested, cut out of its UTF-32 bytes (one position, one copy of
   48 bytes), hashed, and grouped by line: each hash is XORed with
   eight masks, and the smallest and the largest value under each mask are two of
   16 signature values (the largest is the smallest under the complemented mask).
   This runs as one compiled aggregation. Ten bands combine three values each,
   no two bands sharing more than one. A pair of similarity 0.75 shares no band with probability
   (1 - 0.75^3)^10, about 0.4 percent; at 0.9, 2 in a million. Lines of up to 21
   shingles, whose few values agree or differ together, have 16 bands of two
   values by hashes of their own, too.
3. Band buckets make star candidates; exact Jaccard on full shingle sets, made of
   the two lines anew as those are far smaller to move, confirms them; members
   that a bucket's centre doesn't link are compared with all others where they are
   few, else by their rarest shingles;
   distributed union-find joins them (see ``common.linked_in_buckets``).
4. Of each component the first occurrence by (doc_id, line) stays; all other
   occurrences are removed from their documents.

A line that fills a third of all rows is one node; its occurrences are counted
by partial aggregation and joined to their keeper with AQE's skew split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import distilled, drop_written, linked_in_buckets, write_once

PERCENT = 75
SHINGLE_CHARS = 12
N_MASKS = 8
N_BANDS = 10
# Most shingles of a line with bands of two values.
SHORT = 21
# Most rows outside a bucket's largest component with which all others are compared.
FEW = 8
# Lines are cut in UTF-32: a shingle is found at once, and has the same bytes in
# any line. Bytes of a character, and of a shingle.
_WIDE = 4
_RUN_BYTES = _WIDE * SHINGLE_CHARS
_WHITE = " \t\n\x0b\x0c\r"


def normal_line(line: Column) -> Column:
    """Lower case, white space runs to one space, trimmed; the pattern runs only
    where there may be such a run."""
    low = F.lower(line)
    odd = line.contains("  ")
    for mark in ("\t", "\r", "\x0b", "\x0c"):
        odd = odd | line.contains(mark)
    return F.trim(F.when(odd, F.regexp_replace(low, r"\s+", " ")).otherwise(low))


def _starts(code: Column) -> Column:
    """Where the shingles of a line in UTF-32 begin, from 1; null if there is none."""
    last = F.octet_length(code) - (_RUN_BYTES - 1)
    return F.when(last > 0, F.sequence(F.lit(1), last, F.lit(_WIDE)))


def line_hashes(line: Column) -> Column:
    """64-bit hashes of the character shingles of a line, normalised and not
    empty; a shingle that occurs again has its hash again."""

    def of(code: Column) -> Column:
        return F.transform(_starts(code), lambda at: F.xxhash64(F.substring(code, at, F.lit(_RUN_BYTES))))

    # As an element of an array, the bytes are fetched once and not for each shingle.
    runs = F.flatten(F.transform(F.array(F.encode(line, "UTF-32")), of))
    return F.when(F.length(line) < SHINGLE_CHARS, F.array(F.xxhash64(line))).otherwise(runs)


def _masks() -> list[int]:
    """Constants whose top four bits are 0 to 7; the complements cover 8 to 15."""
    out = []
    for k in range(N_MASKS):
        x = (0x9E3779B97F4A7C15 * (k + 1)) & ((1 << 60) - 1) | k << 60
        out.append(x)
    return out


def _signed(lines: DataFrame, values: list[Column], keys: list[list[int]], seed: int) -> DataFrame:
    """``node, bands``: per distinct line, the smallest and the largest of each of
    ``values`` (of a shingle's hash ``h``), combined by ``keys``."""
    coded = lines.select("node", F.encode("line", "UTF-32").alias("code"))
    runs = coded.select("node", "code", F.explode(_starts(F.col("code"))).alias("at"))
    hashed = runs.select("node", F.xxhash64(F.substring(F.col("code"), F.col("at"), F.lit(_RUN_BYTES))).alias("h"))
    ends = [f(v).alias(f"v{2 * k + i}") for k, v in enumerate(values) for i, f in enumerate((F.min, F.max))]
    bands = [F.xxhash64(F.lit(seed + j), *[F.col(f"v{k}") for k in key]) for j, key in enumerate(keys)]
    return hashed.groupBy("node").agg(*ends).select("node", F.array(*bands).alias("bands"))


def line_signatures(lines: DataFrame) -> DataFrame:
    """``node, bands`` of the distinct lines of ``lines`` (``node, line``) that have
    a whole shingle; two rows for lines of few shingles."""
    h, n = F.col("h"), 2 * N_MASKS
    # Differences 1, 2 and 3 occur once each: two bands share at most one value.
    firsts = [*range(0, n, 2), *range(1, n, 2)][:N_BANDS]
    threes = [[(j + d) % n for d in (0, 1, 3)] for j in firsts]
    twos = [[j, (j + 5) % n] for j in range(n)]
    whole = lines.filter(F.length("line") >= SHINGLE_CHARS)
    short = whole.filter(F.length("line") < SHINGLE_CHARS + SHORT)
    return _signed(whole, [h.bitwiseXOR(F.lit(m)) for m in _masks()], threes, 0).unionByName(
        _signed(short, [F.xxhash64(h, F.lit(k)) for k in range(N_MASKS)], twos, N_BANDS)
    )


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, slot, node, line``: the non-blank lines; slot holds the text's
    hash (high half) and the line number from 0 (low half)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        "doc_id",
        F.shiftleft(F.hash(text).cast("long"), 32).alias("high"),
        F.posexplode(F.split(text, "\n")).alias("no", "line"),
    )
    # By the line as it is: a condition on the normal one would make that twice.
    cut = cut.filter(F.ltrim("line", F.lit(_WHITE)) != "")
    normal = cut.select("doc_id", F.col("high").bitwiseOR(F.col("no").cast("long")).alias("slot"), normal_line(F.col("line")).alias("line"))
    return normal.withColumn("node", F.xxhash64("line"))


def duplicate_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, dropped``: per text with duplicates, the numbers of
    the lines to drop. Rows equal in doc_id and text give one row."""
    every = _lines(docs)
    lines = write_once(every.select("doc_id", "slot", "node"), "lines")
    texts = write_once(every.select("node", "line").distinct(), "line-texts")
    nodes = write_once(line_signatures(texts), "line-nodes")

    def sets_of(involved: DataFrame) -> DataFrame:
        wanted = texts.join(involved.hint("shuffle_hash"), "node", "left_semi")
        return wanted.select("node", F.size(F.array_distinct(line_hashes(F.col("line")))).alias("size"), F.col("line").alias("body"))

    comps = linked_in_buckets(nodes, sets_of, percent, "line", hashes_of=line_hashes, temporary=(nodes, texts), few=FEW)
    at = lines.select("doc_id", "slot", "node").join(comps, "node", "left").select(
        F.coalesce("component", "node").alias("component"), F.struct("doc_id", "slot").alias("at")
    )
    keepers = at.groupBy("component").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    gone = at.join(keepers.filter("not first <=> last"), "component").filter("not at <=> first")
    return gone.groupBy(F.col("at.doc_id").alias("doc_id"), F.shiftright("at.slot", 32).cast("int").alias("text_hash")).agg(
        F.collect_set(F.col("at.slot").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("dropped")
    )


def _cut(docs: DataFrame, percent: int) -> DataFrame:
    """``docs`` with ``__n_lines``, ``__dropped`` and ``__left``, the text left."""
    found = distilled(docs.sparkSession, lambda: duplicate_lines(docs, percent), "dropped-lines").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("dropped").alias("__gone")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn("__text_hash", F.hash(text))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    joined = keyed.join(found, same, "left")
    lines = F.split(text, "\n")
    none = F.array().cast("array<int>")
    joined = joined.withColumns({"__n_lines": F.size(lines), "__dropped": F.coalesce(F.array_sort("__gone"), none)})
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("__dropped"), i)), "\n")
    kept = F.when(F.size("__dropped") == 0, F.col("text")).otherwise(left)
    return joined.withColumn("__left", kept).drop("__id", "__hash", "__gone", "__text_hash")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with duplicate lines removed from ``text``, and two more columns:
    ``n_lines`` (before) and ``dropped_lines`` (their numbers from 0, ascending).

    Lines are linked when the Jaccard similarity of their character shingles is
    at least ``percent`` / 100; of each component one line stays, in the
    document with the smallest doc_id. Lines end at ``\\n``; blank lines stay.

    Defined cases: a null text stays null and has one, blank, line; a document
    all of whose lines go keeps its row with the text left; rows equal in
    doc_id and text are one document and are cut alike; a null doc_id comes
    first in the order of keepers; other columns pass through, and input columns
    named ``n_lines`` or ``dropped_lines`` are replaced; an empty table gives
    an empty result.
    """
    own = ("n_lines", "dropped_lines")
    columns = [F.col("__left").alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in own]
    return _cut(docs, percent).select(*columns, F.col("__n_lines").alias("n_lines"), F.col("__dropped").alias("dropped_lines"))


def without_duplicate_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` as ``dedup_lines`` cuts them, in their own columns, with
    ``n_chars`` counted anew; extra columns of whatever name stay as they are."""
    new = {"text": F.col("__left"), "n_chars": F.length("__left").cast("long")}
    return _cut(docs, percent).select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
