"""Best-fit packing of documents into sequences of fixed length, under conflicts.

Bins are kept in order of what is left in them. A piece goes to the tightest bin that it fits and that it may share: a search for the
successor of its length continues bin by bin until one is compatible; if none is, a bin is opened. Each bin carries a bitmap of its
duplicate clusters and one of its sources. Two documents of one cluster never share a bin, and no more than per_source of one
source do (a source has as many bits): three times as many as a bin would hold of the most frequent source by chance, PER_SOURCE at least, so that
a source with most of the rows doesn't leave bins half empty.

Lengths are tokens: ids of the tokenizers library, whole texts, and one for the end (without a tokenizer: words and one). They are measured once
and written to the shared folder with the clusters; texts don't travel.

Documents are dealt by a hash (of id, cluster and a number of the row, so that rows which repeat don't meet) into groups of about GROUP, and each group is packed in order of falling length, streaming through a
task; a bin never crosses groups. So neither a large source nor a cluster of copies meets in one task, and the count of groups follows the
input. A text longer than a bin is cut: full bins of its own, then a rest that is packed. No token is dropped or padded away.

A null text is empty: its piece holds the end token alone. A null source is a source. Repeated rows are packed each, as duplicates of one another.
Very long texts give many full bins. Ties in length go by doc_id, then by cluster. Columns beside doc_id, text and source are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_ROWS, SCRATCH, _arrow_schema, materialize, release, to_batch, whole_text
from .elias_fano import WordEncoder

CAPACITY = 2048
GROUP = 4096
PER_SOURCE = 2
MOST_PER_SOURCE = 64
#: Words whose tokens a counting task keeps.
COUNTED_WORDS = 150_000
#: Packing tasks at most; with more groups each task packs several, one after another.
MOST_TASKS = 20_000

SCHEMA = "doc_id long, piece int, n_tokens long, bin string, bin_offset long"


class Packer:
    """The bins of one group."""

    def __init__(self, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []  # (what is left, bin), in order
        self.clusters: list[int] = []
        self.sources: list[int] = []
        self.cluster_bits: dict[object, int] = {}
        self.source_bits: dict[object, int] = {}

    def _new(self, left: int) -> int:
        number = len(self.clusters)
        self.clusters.append(0)
        self.sources.append(0)
        if left:
            insort(self.open, (left, number))
        return number

    def full(self) -> int:
        """A bin of its own that is full at once."""
        return self._new(0)

    def place(self, length: int, source: object, cluster: object) -> tuple[int, int]:
        """The bin and the place within it of a piece of 1 to capacity tokens."""
        cluster_bit = 1 << self.cluster_bits.setdefault(cluster, len(self.cluster_bits))
        shift = self.per_source * self.source_bits.setdefault(source, len(self.source_bits))
        source_mask = (1 << self.per_source) - 1
        for at in range(bisect_left(self.open, (length, -1)), len(self.open)):
            left, number = self.open[at]
            taken = self.sources[number] >> shift & source_mask
            if taken != source_mask and not self.clusters[number] & cluster_bit:
                del self.open[at]
                break
        else:
            left, number = self.capacity, self._new(0)
            taken = 0
        self.clusters[number] |= cluster_bit
        self.sources[number] |= ((taken << 1 | 1) & source_mask) << shift
        if left > length:
            insort(self.open, (left - length, number))
        return number, self.capacity - left


def pieces(packer: Packer, doc_id: int | None, length: int, source: object, cluster: object) -> Iterator[tuple]:
    """(doc_id, piece, length, bin, offset) of a document's pieces: full bins, then a rest."""
    whole, rest = divmod(length, packer.capacity)
    for piece in range(whole):
        yield doc_id, piece, packer.capacity, packer.full(), 0
    if rest:
        yield doc_id, whole, rest, *packer.place(rest, source, cluster)


def word_tokens(column: str = "text") -> Column:
    """A text's words between ASCII white space, and one for its end."""
    words = F.array_remove(F.split(F.col(column), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("long") + 1


def cluster_of(column: str = "text") -> Column:
    """Texts with equal lower-cased word sequences are one duplicate cluster."""
    return F.md5(F.lower(F.trim(F.regexp_replace(F.col(column), r"[\x20\x09-\x0D]+", " "))).cast("binary"))


def measured(docs: DataFrame, tokenizer: str | None = None, length: Column | None = None, cluster: Column | None = None) -> DataFrame:
    """doc_id, length, source, cluster and number (of the row) of all documents; written to the shared folder. tokenizer: a path that executors have."""
    rows = docs.select("doc_id", whole_text().alias("text"), "source")
    rows = rows.select("doc_id", "source", (cluster_of() if cluster is None else cluster).alias("cluster"), "text" if tokenizer else (word_tokens() if length is None else length).alias("length"))
    if tokenizer:
        schema = "doc_id long, source string, cluster string, length long"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = WordEncoder(tokenizer, COUNTED_WORDS)  # goes with the task
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    lengths = [n + 1 for n in encoder.counts(part.column(3).to_pylist())]
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(lengths, pa.int64())], names=["doc_id", "source", "cluster", "length"])
            del encoder
            release()

        rows = rows.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "cluster", "text").mapInArrow(run, schema)
    return materialize(rows.select("doc_id", "length", "source", "cluster", F.monotonically_increasing_id().alias("number")), "lengths", SCRATCH)


def source_bits(rows: DataFrame, capacity: int) -> int:
    """How many documents of one source may share a bin, from the rests' mean length and the largest source's share."""
    each = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("length") % capacity).alias("rest"))
    found = each.agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"), F.max("n").alias("largest")).first()
    if not found["n"] or not found["rest"]:
        return PER_SOURCE
    return min(MOST_PER_SOURCE, max(PER_SOURCE, math.ceil(3 * capacity * found["largest"] / found["rest"])))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: bins, n_tokens and fill, the share of the bins' places that hold a token."""
    bins = packed.groupBy("bin").agg(F.sum("n_tokens").alias("n"))
    return bins.agg(F.count("*").alias("bins"), F.sum("n").alias("n_tokens"), (F.sum("n") / (F.count("*") * capacity)).alias("fill"))


def pack(
    docs: DataFrame, length: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY, per_source: int | None = None, group: int = GROUP, tokenizer: str | None = None
) -> DataFrame:
    """The pieces of all documents: doc_id, piece, n_tokens, bin, bin_offset. length and cluster are columns over doc_id, text, source."""
    rows = measured(docs, tokenizer, length, cluster)
    per_source = per_source or source_bits(rows, capacity)
    groups = max(1, -(-rows.count() // group))
    rows = rows.select("doc_id", "length", "source", "cluster", F.pmod(F.xxhash64("doc_id", "cluster", "number"), F.lit(groups)).alias("g"))
    dealt = rows.repartition(min(groups, MOST_TASKS), "g").sortWithinPartitions("g", F.desc(F.col("length") % capacity), F.desc("length"), "doc_id", "cluster", "source")
    arrow = _arrow_schema(docs.sparkSession, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        current, packer = None, Packer(capacity, per_source)
        for batch in batches:
            for doc_id, n, source, key, g in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if g != current:
                    current, packer = g, Packer(capacity, per_source)
                out += [(d, piece, size, f"{g}-{number}", place) for d, piece, size, number, place in pieces(packer, doc_id, n, source, key)]
                if len(out) >= FLUSH_ROWS:
                    yield to_batch(out, arrow)
                    out = []
        if out:
            yield to_batch(out, arrow)

    return dealt.mapInArrow(run, SCHEMA)
