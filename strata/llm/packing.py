"""Packing documents into training sequences: best-fit decreasing.

A document's token ids (with an end id) are first cut into full windows; the
rest of it is one shorter piece. Pieces go, longest first, into the open
window with the least room that still holds them. A segment tree over the
room left (0 to the window size) finds that window in logarithmic time.

Tokenising is one pass by Arrow batches that keeps only lengths and checksums,
so the shuffle carries a few numbers per piece, never ids or texts. Pieces are
numbered in the order of the documents and dealt to shards of
``PIECES_PER_SHARD`` by it; each shard is packed by one task in memory that
doesn't grow with the corpus. Sequences are numbered by their earliest piece,
so ``sequence_id`` follows the documents' order from shard to shard, and two
runs agree.

The tokenizer drops white space and never joins characters across it, so a
text's ids are the ids of its white-space-free chunks in order. A chunk of
Latin letters followed by ASCII marks is cut between the two, as the tokenizer
does, and its lower-case word goes to the tokenizer's model alone; all other
chunks go through the whole tokenizer. Each worker keeps the ids of chunks and
words seen, in caches of bounded size.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import with_places, write_once

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
PIECES_PER_SHARD = 50_000
CHUNK_CACHE, WORD_CACHE = 400_000, 800_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"
_PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

# Latin letters that normalisation and lower case change one by one, then ASCII
# marks other than the apostrophe (which starts contractions).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file, as installed on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on in turn."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkIds(dict):
    """Little-endian unsigned 32-bit ids of a white-space-free UTF-8 chunk."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chars = byte_chars()
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            shown = word if word.isascii() else "".join([self.chars[b] for b in word.encode()])
            ids = _packed([t.id for t in self.model.tokenize(shown)])
            if len(self.words) >= WORD_CACHE:
                self.words.clear()
            self.words[word] = ids
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            ids = self._word(plain[1].lower()) + (self._word(plain[2]) if plain[2] else b"")
        if len(self) >= CHUNK_CACHE:
            self.clear()
        self[chunk] = ids
        return ids

    def text(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or b"").split()))


_IDS: dict[str, ChunkIds] = {}


def _pieces(name: str, window: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(name)
        ids = _IDS.get(path) or _IDS.setdefault(path, ChunkIds(path))
        end = _packed([end_id])
        for batch in batches:
            rows: list[tuple] = []
            of: list[int] = []
            for k, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                data = ids.text(text.as_py()) + end
                total = len(data) // 4
                for start in range(0, total, window):
                    part = data[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
                    of.append(k)
            columns = list(zip(*rows)) or [[]] * 5
            order = [c.take(pa.array(of, pa.int64())) for c in batch.columns[2:]]
            names = [*_PIECE_COLUMNS, *[f"order{k}" for k in range(len(order))]]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], *order], names)

    return run


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length, by best-fit decreasing; ties in length
    keep their order. ``tree`` holds per room the number of open bins with that
    much room, summed upwards."""
    size = 1 << window.bit_length()
    tree = [0] * (2 * size)
    open_bins: list[list[int]] = [[] for _ in range(window + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    n_bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        # First leaf at or right of `need` that has an open bin.
        node = need + size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            node = node + 1 if node > 1 else 0
            while node and node < size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - size if node else window
        if node:
            b = open_bins[room].pop()
            while node:
                tree[node] -= 1
                node >>= 1
        else:
            b, n_bins = n_bins, n_bins + 1
        bins[i], offsets[i] = b, window - room
        left = room - need
        if left:
            open_bins[left].append(b)
            node = left + size
            while node:
                tree[node] += 1
                node >>= 1
    return bins, offsets


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    pieces_per_shard: int = PIECES_PER_SHARD,
    order: Sequence[Column] = (),
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    ``start`` counts the document's ids before the piece, ``offset`` the ids
    before it in its sequence; pieces of a sequence follow each other without
    gaps, up to ``window`` ids. ``ids_crc32`` is the unsigned checksum of the
    piece's ids as little-endian unsigned 32-bit numbers. ``order`` gives the
    documents' order (columns of ``docs``); without it they go by doc_id.

    Defined cases: a null or empty text is the end id alone; repeated rows are
    packed once each; a null doc_id stays null; long texts give many full
    windows; only ``doc_id`` and ``text`` are read; an empty table gives an
    empty result.
    """
    keys = [c.alias(f"order{k}") for k, c in enumerate(order)]
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *keys)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields[2:]]
    pieces = write_once(whole.mapInArrow(_pieces(tokenizer, window, end_id), ", ".join([PIECES, *kinds])), "pieces")
    by = [f"order{k}" for k in range(len(keys))] + ["doc_id", "start", "ids_crc32", "length"]
    placed = with_places(pieces.withColumn("all", F.lit(0)), "all", by, "pieces-sorted")
    dealt = placed.select(*_PIECE_COLUMNS, "place", F.floor(F.col("place") / pieces_per_shard).cast("int").alias("shard"))

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Of equal lengths the earlier piece goes first.
        rows = rows.sort_values(["length", "place"], ascending=[False, True])
        bins, rows["offset"] = best_fit(rows["length"].to_numpy(), window)
        earliest = rows["place"].groupby(bins).min()
        numbered = np.empty(len(earliest), np.int64)
        numbered[earliest.sort_values().index.to_numpy()] = np.arange(len(earliest))
        rows["sequence_id"] = (int(key[0]) << 32) + numbered[bins]
        rows["doc_id"] = rows["doc_id"].astype("Int64")
        return rows.drop(columns=["shard", "place"])

    return dealt.groupBy("shard").applyInPandas(pack_shard, PACKED)
