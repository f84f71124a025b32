"""Token ids as directly addressable codes, written in document order and read back."""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outpulse.llm.common import by_batch, by_task, chunk_bounds, partitions, shared_dir, texts, with_chunk
from outpulse.llm.units import LETTERS, IdCache, bare_units, spaced_units

CHUNK_BITS = 8  # of an id held by each level
RANK_BLOCK = 512  # bits of a continuation bitmap per entry of its rank directory
SEGMENT_TOKENS = 1 << 20  # a segment is closed by the document that passes this
MAGIC = b"DAC1"
END = (0).to_bytes(4, "little")


ONE_MATCH = re.compile(rf" ?{LETTERS}\Z")  # the byte-level pattern takes such a unit as one piece
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies show as themselves
#: The character of each byte in them; the others follow each other from 256 on.
SHOWN = "".join(chr(b) if b in PRINTABLE else chr(256 + [x for x in range(256) if x not in PRINTABLE].index(b)) for b in range(256))


class Library:
    """A tokenizers file behind a bounded cache of the units it encodes.

    Where the file splits text by the byte-level pattern and does not change it
    before, a unit that is one piece goes straight to the library's merges.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split = spaced_units if keeps_space else bare_units
        self.cache = IdCache(self._units)
        steps = json.loads(self.tokenizer.to_str())
        cut = steps["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not steps["normalizer"] and not steps["post_processor"]
        self.model = self.tokenizer.model if plain else None

    def _units(self, units: list[str]):
        if self.model is None:
            yield from self._texts(units)
            return
        merged = self.model.tokenize
        others = iter(self._texts([u for u in units if not ONE_MATCH.match(u)]))
        for u in units:
            if ONE_MATCH.match(u):
                ids = [t.id for t in merged(u.encode().decode("latin-1").translate(SHOWN))]
                yield struct.pack(f"<{len(ids)}I", *ids)
            else:
                yield next(others)

    def _texts(self, units: list[str]):
        for i in range(0, len(units), 5000):
            for e in self.tokenizer.encode_batch_fast(units[i : i + 5000], add_special_tokens=False):
                yield struct.pack(f"<{len(e)}I", *e.ids)

    def encode(self, many: list[str]) -> list[bytes]:
        """Each text's ids, little-endian unsigned 32-bit, as the library gives them for the whole text."""
        collects = gc.isenabled()
        gc.disable()  # millions of strings without a cycle among them
        try:
            return self.cache.ids([self.split(t) for t in many])
        finally:
            if collects:
                gc.enable()


@lru_cache(maxsize=2)
def library(path: str, keeps_space: bool) -> Library:
    return Library(path, keeps_space)


def dac_encode(ids: np.ndarray) -> bytes:
    """Levels of 8-bit chunks; bit i of a level's bitmap says that its i-th id goes on in the next.

    Layout: magic, number of ids, number of levels; then per level its length,
    chunks, bitmap (little bit order) and rank directory (ones before each block).
    """
    out, rest = [b""], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS > 0
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        out.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + np.packbits(more, bitorder="little").tobytes() + (np.cumsum(ones) - ones).astype("<u4").tobytes())
        rest = rest[more] >> CHUNK_BITS
        if not len(rest):
            break
    out[0] = MAGIC + struct.pack("<QB", len(ids), len(out) - 1)
    return b"".join(out)


class Dac:
    """Reads a segment; ``at`` finds any id without decoding others, ``all`` gives every id."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.n, levels = struct.unpack_from("<QB", data, 4)
        self.levels, at = [], 13
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(data, "<u4", -(-n // RANK_BLOCK), at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + len(bitmap) + 4 * len(ranks)

    def at(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            first = i // RANK_BLOCK * RANK_BLOCK
            before = np.unpackbits(bitmap[first >> 3 : (i >> 3) + 1], bitorder="little")[: i - first]
            i = int(ranks[i // RANK_BLOCK]) + int(before.sum())
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(self.n, np.uint32)
        where = np.arange(self.n)
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value[where] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            where = where[np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)]
        return value


def write(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool = True) -> DataFrame:
    """Encodes every whole text (null: empty), ends it with id 0 and writes segments under ``path``.

    The documents are cut into ranges of ``doc_id`` and sorted inside, so that
    (range, segment) ascends with the document; null ids come first, repeated
    ids follow each other in the order of their texts.  One shuffle of the
    texts; the ids go straight into the files.  An empty table writes no segment.
    """
    rows = texts(docs)
    spark = docs.sparkSession
    parts = partitions(spark)
    bounds = chunk_bounds(rows, "doc_id", parts)
    sorted_rows = with_chunk(rows, "doc_id", bounds).repartitionById(len(bounds) + 1, F.col("chunk")).sortWithinPartitions("chunk", F.col("doc_id").asc_nulls_first(), "text")

    def work(batches):
        segment, chunk, ids, counts, payload, size = 0, None, [], [], [], 0

        def closed():
            return {
                "chunk": [chunk], "segment": [segment], "doc_ids": [ids], "counts": [counts], "n_tokens": [size // 4],
                "payload": [dac_encode(np.frombuffer(b"".join(payload), "<u4"))],
            }

        for batch in batches:
            found = library(tokenizer, keeps_space).encode(batch.column("text").to_pylist())
            for c, doc_id, tokens in zip(batch.column("chunk").to_pylist(), batch.column("doc_id").to_pylist(), found):
                if ids and (c != chunk or size >= 4 * SEGMENT_TOKENS):
                    yield closed()
                    segment, ids, counts, payload, size = segment + 1 if c == chunk else 0, [], [], [], 0
                chunk = c
                ids.append(doc_id)
                counts.append(len(tokens) // 4 + 1)
                payload += (tokens, END)
                size += len(tokens) + 4
        if ids:
            yield closed()

    by_task(sorted_rows, "chunk int, segment int, doc_ids array<long>, counts array<long>, n_tokens long, payload binary", work).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_back(segments: DataFrame) -> DataFrame:
    """Per document of the files: its start among all ids, its number of ids and their crc32.

    Only the token counts of the ranges are summed across ranges, one row each.
    """
    totals = segments.groupBy("chunk").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("chunk", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    inside = Window.partitionBy("chunk").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    narrow = segments.select("chunk", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("before"))
    starts = narrow.join(bases, "chunk").select("chunk", "segment", (F.col("base") + F.col("before")).alias("first"))

    def work(batch):
        out = {"chunk": [], "segment": [], "doc_id": [], "at": [], "n_tokens": [], "ids_crc32": []}
        for chunk, segment, doc_ids, counts, payload in zip(*(batch.column(c).to_pylist() for c in ("chunk", "segment", "doc_ids", "counts", "payload"))):
            ids = Dac(payload).all().astype("<u4").tobytes()
            at = 0
            for doc_id, n in zip(doc_ids, counts):
                for name, value in (("chunk", chunk), ("segment", segment), ("doc_id", doc_id), ("at", at), ("n_tokens", n), ("ids_crc32", zlib.crc32(ids[4 * at : 4 * (at + n)]))):
                    out[name].append(value)
                at += n
        return out

    found = by_batch(segments, "chunk int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long", work)
    return found.join(starts, ["chunk", "segment"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents to a new folder of the shared directory and reads them back."""
    return read_back(write(docs, f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}", tokenizer))
