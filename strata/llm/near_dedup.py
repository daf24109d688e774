"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges.

1. Each text becomes its set of distinct 5-word shingles (64-bit hashes).
   The hashes fall into 256 bins by their top bits, once; a bin keeps its
   smallest hash. Empty bins take the value of another bin, found by a fixed
   pseudo-random probe order per bin (optimal densification), so texts of any
   length have full signatures. 51 bands of 5 bins make 51 bucket keys: a pair
   of similarity 0.75 shares no bucket with probability (1 - 0.75^5)^51, about
   1e-6.
2. Texts with equal sets are one class, represented by its smallest doc_id;
   only representatives go on, so thousands of exact copies cost one row.
3. In each bucket the smallest representative is the centre, and every other
   member makes one candidate edge with it (a star), so a bucket of n makes
   n - 1 pairs. Candidates are confirmed by exact Jaccard on full sets.
4. Confirmed edges are joined by union-find. Members of a bucket that still lie
   in several components are compared by their rarest shingles
   (``common.linked_in_buckets``), which loses no link between them; what brought
   them together is mostly a passage that many texts hold, and such shingles
   pair nobody there.

The whole texts are read by Arrow batches (bounded by rows and bytes); the
joins and aggregates are Spark's. Hot keys: a class or bucket holding a third
of all rows is aggregated with partial minima, and its joins are split by AQE.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import distilled, linked_in_buckets, write_once

WIDTH = 5
PERCENT = 75
BINS_LOG2 = 8
ROWS_PER_BAND = 5
WORD_CACHE = 300_000
_BINS = 1 << BINS_LOG2
_BANDS = _BINS // ROWS_PER_BAND
_PROBES = np.stack([np.random.RandomState(1_000 + t).permutation(_BINS) for t in range(256)])
_MULT = np.uint64(0x9E3779B97F4A7C15)
_EDGES = np.arange(_BINS, dtype=np.uint64) << np.uint64(64 - BINS_LOG2)

SETS = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>"


class _WordHashes(dict):
    """Hash of a word, computed once per worker while the cache has room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text.

    ``bytes.lower`` folds A-Z only and ``bytes.split`` cuts at ASCII white
    space only, as the word rule asks.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    run = np.full(n, np.uint64(min(len(words), width)))
    for k in range(min(width, len(words))):
        run = run * _MULT + h[k : k + n]
    return np.unique(_mix(run))


def signature(hashes: np.ndarray) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set, densified."""
    at = np.searchsorted(hashes, _EDGES)
    value = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & (value >> np.uint64(64 - BINS_LOG2) == np.arange(_BINS, dtype=np.uint64))
    out = value.copy()
    empty = np.flatnonzero(~full)
    t = 0
    while len(empty):
        donor = _PROBES[t % len(_PROBES)][(empty + t // len(_PROBES)) % _BINS]
        hit = full[donor]
        out[empty[hit]] = value[donor[hit]]
        empty = empty[~hit]
        t += 1
    return out


def band_keys(hashes: np.ndarray, bands: int = _BANDS, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One bucket key per band of the signature."""
    values = signature(hashes)[: bands * rows].reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in values.T:
        key = _mix(key * _MULT + column)
    return key.view(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, a, b, bands = [], [], [], []
        for text in batch.column(2):
            s = shingle_set(text.as_py())
            n.append(len(s))
            digest = xxhash.xxh3_128_intdigest(s.tobytes())
            a.append(_signed(digest >> 64))
            b.append(_signed(digest & (1 << 64) - 1))
            bands.append(band_keys(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *[pa.array(x, pa.int64()) for x in (n, a, b)], pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t.as_py()).view(np.int64) for t in batch.column(1)]
        sizes = pa.array([len(s) for s in sets], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(sets, pa.list_(pa.int64()))], ["node", "size", "body"])


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _labelled(docs: DataFrame, percent: int, by_id: bool) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, component_id`` per row; rows
    that share a doc_id are linked if ``by_id``."""
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_key(docs).alias("text_key"), F.col("text").cast("binary").alias("text")
    )
    signed = write_once(whole.mapInArrow(_signatures, SETS), "near-signatures")
    linkable = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = write_once(
        linkable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "near-classes"
    )

    def sets_of(involved: DataFrame) -> DataFrame:
        texts = whole.join(involved.withColumnRenamed("node", "doc_id"), "doc_id").dropDuplicates(["doc_id", "text_key"])
        return texts.select("doc_id", "text").mapInArrow(_sets, "node long, size int, body array<long>")

    links = None
    if by_id:
        # Documents of several sets: their classes are linked.
        several = linkable.groupBy("doc_id").agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).filter("low <> high")
        owned = linkable.join(several.select("doc_id"), "doc_id").join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
        first = owned.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = write_once(owned.join(first, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b").distinct(), "near-ids")
    comps = linked_in_buckets(classes.select("node", "bands"), sets_of, percent, "near", links)
    named = classes.select("set_a", "set_b", "node").join(comps, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("component_id")
    )
    return signed.drop("bands").join(named, ["set_a", "set_b"], "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of distinct 5-word shingles; ``component_id`` is the smallest
    doc_id reachable over links, itself included.

    Defined cases: a null or blank text has no shingles and is linked with
    nothing; fewer than five words are one shingle; repeated rows give repeated
    result rows; rows that share a doc_id but not their text are one document
    with several sets, linked by any of them, and have one ``component_id``
    (those of them without words, their doc_id); a null doc_id is linked with
    nothing, its ``component_id`` is null and ``kept`` true; only ``doc_id`` and
    ``text`` are read, so extra columns don't matter; an empty table gives an
    empty result. ``percent`` below 60 would need more bands for the same recall.
    """
    def labels() -> DataFrame:
        return _labelled(docs, percent, by_id=True).select("doc_id", "n_shingles", "component_id")

    linked = distilled(docs.sparkSession, labels, "near-labels")
    alone = F.col("n_shingles") == 0
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each near-duplicate group kept, whole rows.

    Groups are of texts here: rows that share a doc_id but not their text are
    judged each by its own text, so no text goes without a near copy that
    stays. Of a group, the smallest doc_id stays; where that has several texts of
    the group, one of them (the smallest set hash). Repeated rows of what is kept
    all stay, as do documents without words, or without a doc_id.
    """

    def left_out() -> DataFrame:
        rows = _labelled(docs, percent, by_id=False).filter("n_shingles > 0 and doc_id is not null")
        rows = rows.select("doc_id", "text_key", "component_id", F.struct("doc_id", "set_a", "set_b").alias("own"))
        rows = write_once(rows, "near-rows")
        best = rows.groupBy("component_id").agg(F.min("own").alias("best"))
        return rows.join(best, "component_id").filter("own <> best").select("doc_id", "text_key").distinct()

    gone = distilled(docs.sparkSession, left_out, "near-gone").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    keyed = docs.withColumn("__text_key", _text_key(docs))
    left = keyed.join(gone, (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left_anti")
    return left.drop("__text_key")
