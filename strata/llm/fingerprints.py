"""Document fingerprints: one-permutation MinHash, packed to four bits a bin.

SQL functions only. The 64-bit hashes of a text's 5-word shingles are sorted;
their top eight bits name one of 256 bins, so each shingle is hashed and dealt
once, and the first hash of a bin's run is its minimum. An empty bin takes the
value of the first full bin among its own number XORed with a shuffled list of
masks (optimal densification: each bin asks the others in an order of its own).
Of each value the four lowest bits are kept: 256 hexadecimal digits, 128 bytes.
A value taken from another bin is hashed with the empty bin's number first, so
that a short text's few values don't agree by chance in all bins at once.
Unrelated values agree in four bits with probability 1/16, which the likeness
corrects for: (a - 1/16) / (1 - 1/16), where a is the share of equal bins.

The next document by id is found by ranges of doc_id (bounds from approximate
quantiles, at most ``MAX_RANGES`` numbers on the driver), each sorted in its
own task; each range also gets the first rows of the next one.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, shingle_hashes, word_array

WIDTH = 5
BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
BITS = 4
ROWS_PER_RANGE = 5_000
MAX_RANGES = 2_000
_DIGITS_PER_LONG = 8
# Order in which an empty bin asks: its number XOR each of these.
_MASKS = random.Random(20).sample(range(1, BINS), BINS - 1)
_LOTS = [1 << k for k in range(BINS_LOG2)]


def with_fingerprint(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with ``to``: the fingerprint of column ``text``, 256 hexadecimal
    digits, one per bin; an empty string for a text without words.

    Steps are columns of their own, as later ones use them more than once.
    """
    words, hashes, firsts, digits, full_bins = (f"{to}__{k}" for k in ("w", "h", "f", "d", "b"))

    def bin_of(h: Column) -> Column:
        # The sign bit turned, so that signed order is the order of the bins.
        return F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(1 << 63))), 64 - BINS_LOG2).cast("int")

    def before(i: Column) -> Column:
        return F.get(F.col(firsts), i - 1)

    df = df.withColumn(words, word_array(ascii_lower(F.col(text))))
    df = df.withColumn(hashes, F.sort_array(shingle_hashes(words, WIDTH)))
    run_starts = lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.coalesce(F.get(F.col(hashes), i - 1), F.lit(0))))
    df = df.withColumn(firsts, F.filter(F.col(hashes), run_starts))
    df = df.withColumn(full_bins, F.transform(F.col(firsts), bin_of))
    # One digit per full bin, one point per empty one.
    low = lambda h: F.lower(F.hex(h.bitwiseAND(F.lit((1 << BITS) - 1))))
    gap = lambda h, i: bin_of(h) - F.when(i == 0, F.lit(-1)).otherwise(bin_of(F.coalesce(before(i), F.lit(0)))) - 1
    drawn = F.transform(F.col(firsts), lambda h, i: F.concat(F.repeat(F.lit("."), gap(h, i)), low(h)))
    df = df.withColumn(digits, F.rpad(F.array_join(drawn, ""), F.lit(BINS), F.lit(".")))

    def digit(b: Column) -> Column:
        return F.substring(F.col(digits), b + 1, F.lit(1))

    def donor(b: Column, masks: list[int]) -> Column:
        asked = F.array(*[F.lit(m) for m in masks])
        return F.get(F.filter(F.transform(asked, lambda m: b.bitwiseXOR(m)), lambda d: digit(d) != "."), F.lit(0))

    def value(b: Column) -> Column:
        # Each next lot of donors, twice as many, is asked only if none before has a value.
        found = F.coalesce(*[donor(b, _MASKS[a - 1 : 2 * a - 1]) for a in _LOTS])
        given = F.get(F.col(firsts), F.array_position(F.col(full_bins), found).cast("int") - 1)
        return F.when(digit(b) != ".", digit(b)).otherwise(low(F.xxhash64(given, b)))

    filled = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value), "")
    # The bins are asked for their number too: a column used once only, inside a
    # lambda, would be computed anew for every element.
    full = F.when(F.size(full_bins) == BINS, F.col(digits)).otherwise(filled)
    df = df.withColumn(to, F.when(F.size(full_bins) == 0, F.lit("")).otherwise(full))
    return df.drop(words, hashes, firsts, digits, full_bins)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprint columns.

    Two empty fingerprints are alike (1), an empty and another aren't (0).
    """
    step, ones = _DIGITS_PER_LONG, int("1" * _DIGITS_PER_LONG, 16)

    def longs(c: str) -> Column:
        starts = F.sequence(F.lit(1), F.lit(BINS - step + 1), F.lit(step))
        return F.transform(starts, lambda s: F.conv(F.substring(F.col(c), s, F.lit(step)), 16, 10).cast("long"))

    def unequal(x: Column, y: Column) -> Column:
        # Every bit of a digit that differs is drawn down to its lowest bit.
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftright(d, 1))
        d = d.bitwiseOR(F.shiftright(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    differ = F.aggregate(F.zip_with(longs(a), longs(b), unequal), F.lit(0), lambda n, x: n + x)
    chance = 1 / (1 << BITS)
    share = 1 - differ / F.lit(float(BINS))
    corrected = F.greatest((share - chance) / (1 - chance), F.lit(0.0))
    return (
        F.when(F.col(a) == F.col(b), F.lit(1.0))
        .when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0))
        .otherwise(corrected)
    )


def _with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, fingerprint, next_text, next_fingerprint`` of ``docs``
    (``doc_id, text``), the next document being the one with the next smaller
    doc_id, and the first after the last."""
    spark = docs.sparkSession
    n = docs.count()
    ranges = min(MAX_RANGES, max(1, math.ceil(n / ROWS_PER_RANGE)))
    cuts = [k / ranges for k in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", cuts, 10_000)).first()[0] if cuts else []
    above = F.array(*[F.lit(b) for b in sorted(set(bounds or []))]).cast("array<long>")
    # Ranges count upwards as ids go down; rows without an id come last.
    of = F.when(F.col("doc_id").isNull(), F.lit(ranges)).otherwise(F.size(F.filter(above, lambda b: b > F.col("doc_id"))))
    placed = docs.withColumn("range", of)
    heads = placed.groupBy("range").agg(F.max("doc_id").alias("doc_id")).orderBy("range").collect()
    to = [(heads[(i + 1) % len(heads)].doc_id, heads[i].range) for i in range(len(heads))]
    copies = spark.createDataFrame(to, "head long, range int")
    seam = docs.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", "range", F.lit(1).alias("seam"))
    rows = placed.withColumn("seam", F.lit(0)).unionByName(seam)
    rows = with_fingerprint(rows, "text", "fingerprint")
    order = Window.partitionBy("range").orderBy("seam", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    rows = rows.withColumns({
        "next_text": F.lead("text").over(order),
        "next_fingerprint": F.lead("fingerprint").over(order),
    })
    return rows.filter("seam = 0").drop("seam", "range")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document. ``near_edited`` and
    ``near_next`` are the likeness of the text's fingerprint to the edited
    text's and to the next document's.

    Defined cases: a null text counts as empty; texts of fewer than five words
    are one shingle; rows that share a doc_id follow each other in the order of
    a text hash, and rows without a doc_id come last; the only row of a table
    is its own next; other columns aren't read; an empty table gives an empty
    result.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _with_next(whole).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half)))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
