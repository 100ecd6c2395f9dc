"""Token ids in binary blocks: Elias-Fano document boundaries over one concatenated array of ids.

Documents are dealt to tasks in ranges of ascending doc_id and sorted there. Each task encodes whole texts and closes a block
whenever it holds enough ids. A block is a self-contained file image:

    magic "TWEF", version u8, bytes of an id u8 (2 while all ids are under 65,536, else 4), 2 bytes 0,
    documents u64, ids u64, documents without a doc_id u64, least doc_id i64, then, in Elias-Fano form, what the other doc_ids are above the
    least one, and the boundaries; then the ids.

Boundaries b_0 = 0 .. b_n = ids are kept as low bits, packed, and high bits, unary, with a sample of every 64th one's place. A
select over the samples gives any offset; the whole takes about 2 + log2(ids / n) bits a document. Doc_ids ascend, and are kept in the same form.
A block ends with the document that fills it, so it holds less than BLOCK_IDS ids and one document; lengths have 64 bits.

Blocks are rows of a Parquet table, so that Spark's committer writes them to any store and a lost executor's task is repeated.
Their starts in the corpus come from one sum per range of ids and one window over the ranges' sums.

A null text is empty and gives the end id alone. Null ids come first. Rows that repeat an id are all kept, ordered by text. Long
texts are whole; a document never crosses blocks. Columns beside doc_id and text are ignored. An empty table gives no blocks.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, map_rows, materialize, to_batch, whole_text

MAGIC = b"TWEF"
SAMPLE = 64
#: A block is closed when it holds this many ids.
BLOCK_IDS = 1 << 20


class EliasFano:
    """A non-decreasing sequence from 0 in near-minimal space."""

    def __init__(self, count: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.count, self.universe, self.low_bits, self.low, self.high, self.samples = count, universe, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) if n else 0
        bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if bits and n:
            each = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(each.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        ones = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        ones[places] = 1
        return cls(n, universe, bits, low, np.packbits(ones, bitorder="little"), places[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQBxxxxxxxQQQ", self.count, self.universe, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        count, universe, bits, a, b, c = struct.unpack_from("<QQBxxxxxxxQQQ", data, at)
        at += struct.calcsize("<QQBxxxxxxxQQQ")
        low, high = np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a)
        return cls(count, universe, bits, low, high, np.frombuffer(data, "<u8", c, at + a + b)), at + a + b + 8 * c

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        raw = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
        return raw >> first % 8 & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """The i-th value: a jump to the sample before it, then a scan of a bounded number of ones."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        word = int(self.high[byte]) >> place % 8 << place % 8
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return (8 * byte + (word & -word).bit_length() - 1 - i) << self.low_bits | self._low(i)

    def stretch(self, k: int) -> list[int]:
        """The values from the k-th sample up to the next, by one jump and one scan; never more than SAMPLE at once."""
        first, n = k * SAMPLE, min(SAMPLE, self.count - k * SAMPLE)
        place = int(self.samples[k])
        end = int(self.samples[k + 1]) if k + 1 < len(self.samples) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[place // 8 : (end + 7) // 8], bitorder="little")) + place // 8 * 8
        high = ones[np.searchsorted(ones, place) :][:n] - np.arange(first, first + n)
        return [(int(h) << self.low_bits) | self._low(first + i) for i, h in enumerate(high)]

    def values(self) -> Iterator[int]:
        """All values in order, a sample's stretch at a time."""
        for k in range(len(self.samples)):
            yield from self.stretch(k)


def write_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A block of documents in ascending order of doc_id, those without one first."""
    n = len(doc_ids)
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    above = EliasFano.build(np.array([d - least for d in known], np.uint64))
    head = MAGIC + struct.pack("<BBxxQQQq", 2, width, n, len(ids), n - len(known), least)
    return head + above.to_bytes() + EliasFano.build(bounds).to_bytes() + ids.astype(f"<u{width}").tobytes()


class Block:
    """Random access to the documents of a block."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC or data[4] != 2:
            raise ValueError("not a block of token ids")
        width, (self.n, total, self.nulls, self.least) = data[5], struct.unpack_from("<QQQq", data, 8)
        self.above, at = EliasFano.from_bytes(data, 40)
        self.bounds, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", total, at)

    def __len__(self) -> int:
        return self.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.above.select(i - self.nulls)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """doc_id, first and last place of each document, from the samples' stretches."""
        numbers, first = self.above.values(), 0
        for i, last in enumerate(islice(self.bounds.values(), 1, None)):
            yield None if i < self.nulls else self.least + next(numbers), first, last
            first = last

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


#: Words whose ids a task keeps; beyond, it starts anew.
CACHE = 700_000
_TAIL = ".,;:!?#$%&*|"
_PLAIN_END = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
#: White space to str.split, but not to a tokenizer's patterns.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class WordEncoder:
    """The tokenizers library's ids of whole texts, with a cache of words where that can't change them.

    That is so for a tokenizer which normalises characters on their own (NFC, white space, lower case) and whose pre-tokens never
    hold white space: then no token crosses white space. It is tried on a probe before the cache is used. A text
    with a special token's opening is encoded whole. At an ASCII letter or digit before closing punctuation a pre-token ends, so
    such punctuation is looked up by itself. Words of letters alone are one pre-token each; where the model marks the last token of a
    pre-token, many of them are encoded in one call and told apart by those marks.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        from tokenizers import Tokenizer

        self.cache = cache
        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.kind = np.dtype("<u2" if len(self.ends) < 1 << 16 else "<u4")
        self.openings = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.table: dict[str, bytes] = {}
        probe = "A b's, Don't  c.\tÉtÉ́ 12,3!! ##x ǅİ Σας ΑΣ, é. X1, Y!! Z. thereafter ñandú wörter\n"
        whole = self._plain([probe])[0]
        self.by_word = bool(suffix) and self._by_words([probe])[0].tobytes() == whole

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> None:
        """Learns words of letters alone."""
        lots = [words[i : i + 64] for i in range(0, len(words), 64)]
        width = self.kind.itemsize
        for lot, e in zip(lots, self.tokenizer.encode_batch_fast([" ".join(lot) for lot in lots], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * width
            if len(stops) != len(lot):
                self.table.update(zip(lot, self._plain(lot), strict=True))
                continue
            raw, start = ids.tobytes(), 0
            for word, stop in zip(lot, stops.tolist(), strict=True):
                self.table[word] = raw[start:stop]
                start = stop

    def _learn(self, missing: set[str]) -> None:
        table = self.table
        cut, parts = [], set()
        for w in missing:
            core = w.rstrip(_TAIL)
            if len(core) < len(w) and core and core[-1] in _PLAIN_END:
                tail = w[len(core) :]
                cut.append((w, core, tail))
                parts.add(core)
                parts.add(tail)
            else:
                parts.add(w)
        parts = sorted(parts.difference(table))
        letters = [w for w in parts if w.isalpha()]
        others = [w for w in parts if not w.isalpha()]
        if letters:
            self._letters(letters)
        if others:
            table.update(zip(others, self._plain(others), strict=True))
        for w, core, tail in cut:
            table[w] = table[core] + table[tail]

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        split = [None if any(s in text for s in self.openings) or _SEPARATORS.search(text) else text.encode().lower().decode().split() for text in texts]
        table = self.table
        if len(table) > self.cache:
            table.clear()
        words = set().union(*(x for x in split if x))
        missing = words.difference(table)
        if missing:
            self._learn(missing)
        out = [self._plain([text])[0] if x is None else b"".join(map(table.__getitem__, x)) for text, x in zip(texts, split, strict=True)]
        for w in missing:
            if len(w) > 64:
                del table[w]
        return [np.frombuffer(x, self.kind) for x in out]

    def counts(self, texts: list[str]) -> list[int]:
        """How many ids each text has."""
        return [len(ids) for ids in self.encode(texts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return self._by_words(texts) if self.by_word else [np.frombuffer(x, self.kind) for x in self._plain(texts)]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_blocks(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of all documents' ids, each followed by end_id, in ascending doc_id order.

    Columns: shard (range of ids), block (place in the shard), n_docs, n_ids, data. The table is written to the shared folder.
    """
    schema = "shard int, block int, n_docs long, n_ids long, data binary"
    arrow = _arrow_schema(docs.sparkSession, schema)
    ranged = docs.select("doc_id", whole_text().alias("text")).repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard, block = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.kind)
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            data = write_block(doc_ids, lengths, np.concatenate(parts))
            return to_batch([(shard, block, len(doc_ids), held, data)], arrow)

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    doc_ids.append(doc_id)
                    lengths.append(len(ids) + 1)
                    parts += (ids, end)
                    held += len(ids) + 1
                    if held >= block_ids:
                        yield close()
                        doc_ids, parts, lengths, held, block = [], [], [], 0, block + 1
        if doc_ids:
            yield close()

    return materialize(ranged.mapInArrow(run, schema), "token-blocks")


def block_starts(blocks: DataFrame) -> DataFrame:
    """shard, block and start: the ids of all blocks before. One row per shard meets in the window over all of them."""
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", before.alias("shard_start"))
    inner = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.withColumn("inner", inner).join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("inner")).alias("start"))


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the blocks, whose offsets are decoded a sample's stretch at a time: doc_id, start, n_tokens, ids_crc32 and the block's place."""

    def one(row: dict) -> list[tuple]:
        b = Block(row["data"])
        return [(row["shard"], row["block"], doc_id, first, last - first, zlib.crc32(b.ids[first:last].astype("<u4").tobytes())) for doc_id, first, last in b.documents()]

    found = map_rows(blocks.select("shard", "block", "data"), lambda: one, "shard int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    starts = block_starts(blocks)
    joined = found.join(starts, ["shard", "block"])
    return joined.select("doc_id", (F.col("inner") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "shard", "block")


