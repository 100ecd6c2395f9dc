"""Near-duplicates by SimHash, with BK-trees over shards of fingerprints.

Fingerprints within r bits of each other agree on at least one of r + 1 pieces of the 64 bits. So each fingerprint is sent to r + 1
shards, by a piece's place and value. A shard holds its fingerprints in a BK-tree, whose children are keyed by the integer Hamming
distance to their parent, and asks it for each of them, following only edges within r of the distance. A shard with more than
SHARD fingerprints is dealt again by the pieces of the bits that it doesn't fix yet, as often as needed: nothing is lost, and after five
dealings a shard can't hold more distinct fingerprints than its free bits allow. Trees are built where their probes are, as all of
them together grow with the corpus and have no bound for a broadcast.

Links leave a shard as a forest, fewer rows than fingerprints; components are found over distinct fingerprints.

Texts with fewer words than a shingle has give one shingle, texts without a word the fingerprint zero, which links like any other. Nulls
are empty texts. Very long texts are whole: their hashes are counted in pieces. A null doc_id takes part and gets its component's id; a component without any id has null. Repeated rows stay.
Columns beside doc_id and text are ignored (kept, by keep_one). An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SCRATCH, likely, lookup, map_rows, materialize, whole_text
from .components import components

SEED = 42
#: Fingerprints that a shard's tree holds at most, unless its free bits bound it.
SHARD = 2048
DEALINGS = 5
_ALL = (1 << 64) - 1


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of the space-joined shingles, repeats included; of the whole sequence if it is shorter."""
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[size:], strict=False)], np.uint64)


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def majority(hashes: np.ndarray) -> np.ndarray:
    """Per column of hashes (n, k) the bits that more than half of the rows have; as k unsigned integers."""
    hashes = hashes.reshape(len(hashes), -1)
    n, k = hashes.shape
    total = np.zeros(64 * k, np.int64)
    for start in range(0, n, 1 << 14):
        part = np.ascontiguousarray(hashes[start : start + (1 << 14)])
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8 * k), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * total > n, bitorder="little").view(np.uint64)


def fingerprint(text: str, size: int = 3) -> int:
    hashes = shingle_hashes(words_of(text), size)
    return int(majority(hashes)[0]) if len(hashes) else 0


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class BKTree:
    """A set of integers with search by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """The value's place; a value that is there keeps it."""
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return 0
        at = 0
        while distance := (value ^ self.values[at]).bit_count():
            following = self.children[at].get(distance)
            if following is None:
                self.children[at][distance] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return len(self.values) - 1
            at = following
        return at

    def within(self, value: int, radius: int) -> list[int]:
        """The places of all values within the radius."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    open_.append(child)
        return found


class Union:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


def linked_pairs(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Pairs of places, each within the radius of one another, that join all places which links within the radius join (a forest)."""
    tree, union, places, out = BKTree(), Union(len(values)), {}, []
    for i, value in enumerate(values):
        value &= _ALL
        first = places.setdefault(tree.add(value), i)
        near = [first] if first != i else [places[at] for at in tree.within(value, radius)]
        out += [(j, i) for j in near if union.join(j, i)]
    return out


def _pieces(bits: list[int], n: int) -> list[int]:
    """Masks of n stretches, of about equal length, of a list of bits."""
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:], strict=False) if x < y]


def _children(mask: int, radius: int) -> list[int]:
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | piece for piece in _pieces(free, radius + 1)] if len(free) > radius + 1 else []


def shards(points: DataFrame, radius: int, most: int = SHARD) -> DataFrame:
    """points: (seed, fp, node). Returns points (array of struct(fp, node)) of each shard with two or more."""
    keys = ["seed", "mask", "value"]
    level = {_signed(m): [] for m in _children(0, radius)}
    keyed = points.select("seed", "fp", "node", F.explode(F.array(*(F.lit(m).cast("long") for m in level))).alias("mask"))
    out: DataFrame | None = None
    for dealing in range(1, DEALINGS + 1):
        keyed = keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        counts = materialize(keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "shard-sizes", SCRATCH)
        level = {m: [_signed(c) for c in _children(m & _ALL, radius)] for m in level}
        last = dealing == DEALINGS or not any(level.values())
        cold = counts if last else counts.where(F.col("n") <= most)
        found = keyed.join(cold.select(*keys), keys).groupBy(*keys).agg(F.collect_list(F.struct("fp", "node")).alias("points")).select("points")
        out = found if out is None else out.union(found)
        hot = counts.where(F.col("n") > most)
        if last or hot.isEmpty():
            break
        following = F.map_from_entries(F.array(*(F.struct(F.lit(m).cast("long"), F.array(*(F.lit(c).cast("long") for c in cs))) for m, cs in level.items())))
        keyed = keyed.join(hot.select(*keys), keys).select("seed", "fp", "node", F.explode(F.element_at(following, F.col("mask"))).alias("mask"))
        level = dict.fromkeys((c for cs in level.values() for c in cs), [])
    return out


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fp (its bits as a signed integer) of every whole text; written to the shared folder."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    return materialize(map_rows(rows, lambda: lambda row: [(row["doc_id"], _signed(fingerprint(row["text"], size)))], "doc_id long, fp long"), "fingerprints", SCRATCH)


def link_components(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id: the smallest doc_id that links lead to.

    Every link comes through a BK-tree. The shards' trees aren't broadcast, as all of them together grow with the corpus: a shard's
    fingerprints meet in one task, which builds its tree and asks it.
    """
    fps = fingerprints(docs, size)
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "nodes", SCRATCH)
    points = nodes.select(F.lit(0).alias("seed"), "fp", F.lit(None).cast("long").alias("node"))

    def forest(row: dict) -> list[tuple]:
        values = [p["fp"] for p in row["points"]]
        return [(values[i], values[j]) for i, j in linked_pairs(values, radius)]

    found = components(map_rows(shards(points, radius), lambda: forest, "a long, b long"))
    linked = found.join(nodes.select(F.col("fp").alias("node"), "rep"), "node")
    least = linked.groupBy("root").agg(F.min("rep").alias("linked_id"))
    linked = linked.join(least, "root").select(F.col("node").alias("fp"), "linked_id")
    ids = nodes.join(linked, "fp", "left").where(F.col("linked_id").isNotNull() | (F.col("n") > 1)).select("fp", F.coalesce("linked_id", "rep").alias("component_id"), "n")
    rows = lookup(fps, "fp", materialize(ids, "component-ids", SCRATCH), F.xxhash64("doc_id").cast("string"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


# Near copies by similarity: SimHash and common rare shingles propose, an exact check of shingle sets decides.

#: Fingerprints per text, each with hashes of its own.
SEEDS = 2
RADIUS = 3
SHINGLE = 5
SIMILARITY = 0.8
#: Texts whose shingles are counted, about, to find frequent ones; how many of them count, and from how many texts on.
COUNTED = 10_000
FREQUENT = 50_000
FREQUENT_LEAST = 3
#: Members of a shingle that all others are compared with, by round; in the last round each one that is left meets each other.
PIVOTS = (1, 16, 64, None)
#: SimHashes of an outline; how far, in standard deviations, its bits may differ beyond what is expected; sets that are too small for it.
OUTLINE = 4
SPREADS = 7
SMALL = 32
#: Stretches into which the pairs of one text are dealt.
BLOCKS = 256
#: Classes that a task remembers, so as to sketch copies once.
SEEN = 500_000


def class_of(column: str = "text") -> Column:
    """A 128-bit digest of the text. Texts that differ in case of A-Z or white space have equal shingles and fingerprints, and so are found to be similar."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def _mixed(hashes: np.ndarray, seeds: int) -> np.ndarray:
    """seeds hashes of each hash, by a multiplication and two folds (splitmix64's constants)."""
    x = hashes[:, None] + np.arange(1, seeds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_fingerprints(text: str, seeds: int = SEEDS) -> np.ndarray:
    """seeds fingerprints of the set of words; edits of single words move them less than fingerprints of shingles."""
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in set(words_of(text))], np.uint64)
    return majority(_mixed(hashes, seeds)) if len(hashes) else np.zeros(seeds, np.uint64)


def similar(mine: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches the bound. Two empty sets are equal."""
    few, many = sorted((len(mine), len(other)))
    if few < similarity * many:
        return False
    common = len(np.intersect1d(mine, other, assume_unique=True))
    return common >= similarity * (few + many - common)


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """The text's distinct shingle hashes in ascending order."""
    return np.unique(shingle_hashes(words_of(text), size))


def frequent_shingles(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Hashes of shingles that many of about COUNTED texts have, in ascending order. They only order shingles: no result rests on the choice."""
    every = max(1, docs.count() // COUNTED)
    some = docs.select(whole_text().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    hashes = map_rows(some, lambda: lambda row: [(shingle_set(row["text"], size).view(np.int64).tolist(),)], "shingles array<long>")
    counts = hashes.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().where(F.col("count") >= FREQUENT_LEAST)
    found = counts.orderBy(F.desc("count"), "shingle").limit(FREQUENT).collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def prefix(shingles: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles by the order of all texts (frequent ones last, then by hash): sets that are similar enough have one of them in common.

    Of n shingles at least similarity * n are common with such a set, so fewer than those that this leaves out plus one can be absent.
    """
    n = len(shingles)
    late = np.zeros(n, bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles
    return np.concatenate([shingles[~late], shingles[late]])[: n - math.ceil(similarity * n - 1e-9) + 1]


def outline(shingles: np.ndarray) -> np.ndarray:
    """OUTLINE SimHashes of the set of shingles, by which pairs that share a few shingles by chance are told from similar ones."""
    return majority(_mixed(shingles, OUTLINE)) if len(shingles) else np.zeros(OUTLINE, np.uint64)


def plausible(similarity: float) -> Column:
    """Whether the outlines and sizes of columns o, p_o, n and p_n allow the similarity.

    The cosine of sets of that similarity is 2s / (1 + s) at least, whatever their sizes, and bits of their outlines differ with the angle's share of a
    half turn. Pairs go whose bits differ more often by SPREADS standard deviations (a similar pair is lost with a probability under 1e-11). Small sets,
    for which the angle doesn't tell enough, are all plausible.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = 64 * OUTLINE
    most = int(bits * share + SPREADS * math.sqrt(bits * share * (1 - share)))
    differ = F.aggregate(F.zip_with("o", "p_o", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x)
    return (F.least("n", "p_n") < SMALL) | (differ <= most)


def sketches(docs: DataFrame, similarity: float, size: int, seeds: int, radius: int) -> DataFrame:
    """One row per class, written to the shared folder: id (a number), class, fps, n (shingles), prefix and outline. A task sketches a class once."""
    frequent = frequent_shingles(docs, size)

    def make():
        seen: set[bytes] = set()

        def one(row: dict) -> list[tuple]:
            key = bytes(row["class"])
            if key in seen:
                return []
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
            shingles = shingle_set(row["text"], size)
            first = prefix(shingles, frequent, similarity)
            return [(key, word_fingerprints(row["text"], seeds).view(np.int64).tolist(), len(shingles), first.view(np.int64).tolist(), outline(shingles).view(np.int64).tolist())]

        return one

    found = map_rows(docs.select(class_of().alias("class"), whole_text().alias("text")), make, "class binary, fps array<long>, n int, prefix array<long>, outline array<long>")
    found = found.groupBy("class").agg(*(F.any_value(c).alias(c) for c in ("fps", "n", "prefix", "outline")))
    return materialize(found.withColumn("id", F.monotonically_increasing_id()), "sketches", SCRATCH)  # written once, so the numbers stay


def simhash_pairs(sketched: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of ids that equal or linked fingerprints of any seed propose.

    Trees hold distinct fingerprints; ids with equal ones are each paired with the least of them.
    """
    points = sketched.select("id", F.posexplode("fps").alias("seed", "fp"))
    nodes = materialize(points.groupBy("seed", "fp").agg(F.min("id").alias("node"), F.max("id").alias("last")), "fingerprint-nodes", SCRATCH)
    shared = nodes.where("last > node").select("seed", "fp", "node")
    equal = points.join(shared, ["seed", "fp"]).where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"))

    def forest(row: dict) -> list[tuple]:
        return [(row["points"][i]["node"], row["points"][j]["node"]) for i, j in linked_pairs([p["fp"] for p in row["points"]], radius)]

    return equal.union(map_rows(shards(nodes.select("seed", "fp", "node"), radius), lambda: forest, "a long, b long"))


def shared_prefixes(sketched: DataFrame) -> DataFrame:
    """shingle, id, n and place of the prefixes' shingles that two or more classes have, with past, the id's shared shingle before; written to the shared folder."""
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("place").cast("long"))
    rows = sketched.select("id", "n", F.posexplode("prefix").alias("place", "shingle")).select("shingle", "id", packed.alias("at"))
    dealt = rows.repartition("shingle").sortWithinPartitions("shingle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, and whether the one before it has its shingle
        last_shared = False
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(batch.columns, names=["shingle", "id", "at"])
            whole = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            s = whole.column(0).to_numpy()
            same = s[1:] == s[:-1]
            keep = np.zeros(len(s), bool)
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= last_shared
            last_shared = bool(keep[-1])
            if len(s) > 1:
                yield from whole.slice(0, len(s) - 1).filter(pa.array(keep[:-1])).to_batches()
            held = whole.slice(len(s) - 1).to_batches()[0]
        if held is not None and last_shared:
            yield held

    found = dealt.mapInArrow(run, "shingle long, id long, at long")
    found = found.select("shingle", "id", F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place"))
    return materialize(found.withColumn("past", F.lag("shingle").over(Window.partitionBy("id").orderBy("place"))), "shared-prefixes", SCRATCH)


def _rooted(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """rows (id and others) with root: the component's, or the id itself."""
    return rows.join(joined.select(F.col("node").alias("_node"), "root"), F.col("id") == F.col("_node"), "left").drop("_node").withColumn("root", F.coalesce("root", "id"))


def first_shingles(rows: DataFrame) -> DataFrame:
    """The shingles with two or more roots; of those with the same members only the first by the order of all texts.

    rows: shingle, id, place and root. The shingles of a passage have the same members and would propose the same pairs once each. The first shingle that two
    sets share always stays, as one with the same members before it would be shared, too. Members are told apart by their number and 128 bits.
    """
    members = [F.bit_xor(F.xxhash64(F.lit(k), "id")).alias(f"_members{k}") for k in (0, 1)]
    found = rows.groupBy("shingle").agg(F.min("root").alias("_least"), F.max("root").alias("_most"), F.count("*").alias("_n"), F.sum("place").alias("_places"), *members)
    # members have their shingles in one order, so the sum of the places ascends with it
    return found.where("_least < _most").groupBy("_n", "_members0", "_members1").agg(F.min_by("shingle", F.struct("_places", "shingle")).alias("shingle")).select("shingle")


def prefix_pairs(rows: DataFrame, similarity: float, pivots: int | None) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of members of one shingle with other roots that can be similar by their sizes and the shingle's places; and the rows that are left.

    rows: shingle, id, n, place, past and root, of shingles with two or more roots. The first pivots members of a shingle, by a hash that makes the
    same ids first in all shingles, meet all others and leave; None: each meets each. A pair is certain to come with the first shingle that its
    sets share. At another one that follows the same shared shingle in both sets it needn't come: the run of shingles that both have proposes it
    where it starts. Where rows have an outline, o, the join itself leaves out pairs that it doesn't allow.
    """
    outlined = ["o"] if "o" in rows.columns else []
    rows = rows.withColumn("rank", F.xxhash64("id"))
    order = F.struct("rank", "id")
    if pivots is None:
        first = rows
    elif pivots == 1:
        first = rows.groupBy("shingle").agg(F.min_by(F.struct("id", "n", "place", "past", "root", "rank"), order).alias("m")).select("shingle", "m.*")
    else:
        w = Window.partitionBy("shingle").orderBy("rank", "id")
        first = rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= pivots).drop("k")
    p = first.select("shingle", *(F.col(c).alias(f"p_{c}") for c in ("id", "n", "place", "past", "root", "rank", *outlined)))
    both = rows.join(p, "shingle").where((F.col("root") != F.col("p_root")) & (order > F.struct(F.col("p_rank").alias("rank"), F.col("p_id").alias("id"))))
    least = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place"))
    fits = (F.least("n", "p_n") >= similarity * F.greatest("n", "p_n") - 1e-9) & (least >= similarity / (1 + similarity) * (F.col("n") + F.col("p_n")) - 1e-6)
    fits = fits & F.coalesce(F.col("past") != F.col("p_past"), F.lit(True))
    fits = fits & plausible(similarity) if outlined else fits
    pairs = both.where(fits).select(F.col("p_id").alias("a"), F.col("id").alias("b"))
    last = first.groupBy("shingle").agg(F.max(order).alias("_last"))
    left = rows.join(last, "shingle").where(order > F.col("_last")).drop("_last", "rank")
    return pairs, left


def plausible_pairs(pairs: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose outlines allow the similarity."""
    narrow = sketched.select("id", "n", F.col("outline").alias("o"))
    both = pairs.join(narrow.select(F.col("id").alias("a"), F.col("n").alias("p_n"), F.col("o").alias("p_o")), "a").join(narrow.withColumnRenamed("id", "b"), "b")
    return both.where(plausible(similarity)).select("a", "b")


def verified(pairs: DataFrame, sketched: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """The pairs (a, b) whose texts' shingle sets are similar enough; written to the shared folder.

    texts: class and text. Only texts of wanted classes travel (those that a broadcast of bounded size can't rule out, then by class), one
    of each class. The pairs of a text a are dealt to BLOCKS stretches; in each, a comes first and the others stream past it.
    """
    dealt = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(BLOCKS)).cast("int").alias("block"), "b")
    need = dealt.select("a", "block", F.lit(1).alias("k"), F.col("b").alias("id")).union(dealt.select("a", "block", F.lit(0), "a").distinct())
    need = materialize(need.join(sketched.select("id", "class"), "id"), "wanted", SCRATCH)
    wanted = need.select("class").distinct()
    some = likely(texts, wanted, "class").join(wanted.hint("merge"), "class", "left_semi").groupBy("class").agg(F.any_value("text").alias("text"))
    rows = need.hint("merge").join(some, "class").select("a", "block", "k", "id", "text")
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", "k", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            a, k, ids = (batch.column(i).to_numpy() for i in (0, 2, 3))
            found = []
            for i in range(batch.num_rows):
                mine = shingle_set(batch.column(4)[i].as_py(), size)
                if k[i] == 0:
                    centre = mine
                elif similar(centre, mine, similarity):
                    found.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a[found], pa.int64()), pa.array(ids[found], pa.int64())], names=["a", "b"])

    return materialize(rows.mapInArrow(run, "a long, b long"), "links", SCRATCH)


def similar_classes(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, seeds: int = SEEDS, radius: int = RADIUS) -> DataFrame:
    """class, root: classes of equal word sequences whose sets of word shingles are similar enough, joined to components.

    A class without a similar one isn't listed. Two sources propose pairs: SimHash fingerprints that BK-trees link, and shingles in common among the
    first of both texts (a prefix filter, which loses no pair that is similar enough). Pairs whose outlines, 256 bits of SimHash, are far apart go at once. A shingle's members meet in rounds, first all with one, so
    that a large group of near copies is joined by about as many pairs as it has members; pairs that are joined aren't compared again. What
    texts hold in common is computed from their whole shingle sets.
    """
    texts = docs.select(class_of().alias("class"), whole_text().alias("text"))
    sketched = sketches(docs, similarity, size, seeds, radius)
    alive = shared_prefixes(sketched)
    rows = alive.withColumn("root", F.col("id"))
    links = None
    for k, pivots in enumerate(PIVOTS):
        pairs, left = prefix_pairs(rows, similarity, pivots)
        pairs = pairs.union(simhash_pairs(sketched, radius)) if k == 0 else pairs
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if k:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")  # noqa: F821
        pairs = materialize(plausible_pairs(pairs, sketched, similarity), "pairs", SCRATCH)
        asked = pairs if k == 0 else asked.union(pairs)  # noqa: F821
        if k == 0 or not pairs.isEmpty():
            found = verified(pairs, sketched, texts, similarity, size)
            links = found if links is None else links.union(found)
            joined = components(links)
        if pivots is None:
            break
        rows = _rooted(left.drop("root", "o"), joined)
        rows = rows.join(first_shingles(rows), "shingle").join(sketched.select("id", F.col("outline").alias("o")), "id")
        rows = materialize(rows, "open-shingles", SCRATCH)
        if rows.isEmpty():
            break
    return joined.join(sketched.select("id", "class"), F.col("node") == F.col("id")).select("class", "root")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, but one of each group only. A group is a component: texts that are copies or similar enough, linked
    by others if need be; so two texts of a group may be less similar than the bound.

    Of each group the smallest doc_id stays (null only if there is no other); of rows that repeat it, the one with the least
    digest of all columns. Empty texts are copies of one another. An empty table gives an empty table.
    """
    names = docs.columns
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), class_of().alias("class"))
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("id"), F.xxhash64("row").alias("digest"))
    whole = whole.withColumn("place", order)
    groups = similar_classes(docs, similarity)
    sizes = whole.groupBy("class").agg(F.min("place").alias("least"), F.count("*").alias("n"))
    sizes = materialize(sizes.join(groups, "class", "left").where("root is not null or n > 1"), "classes", SCRATCH)
    roots = sizes.where("root is not null").groupBy("root").agg(F.min("least").alias("root_least"))
    # only classes with copies or similar ones have rows to drop; of the others most never travel
    listed = materialize(sizes.join(roots, "root", "left").select("class", F.coalesce("root_least", "least").alias("least"), "n"), "winners", SCRATCH)
    alone = likely(whole, listed, "class", other=True)
    rows = lookup(likely(whole, listed, "class"), "class", listed, F.xxhash64("row").cast("string"), hint="merge")
    kept = rows.where(F.col("least").isNull() | F.col("least").eqNullSafe(F.col("place")))
    # rows that are equal in every column have one class; one of each stays
    repeated = materialize(likely(whole, listed, "class").groupBy("place").count().where("count > 1").select("place"), "repeated-rows", SCRATCH)
    if not repeated.isEmpty():
        once = kept.join(repeated, "place", "left_semi").groupBy("place").agg(F.any_value("row").alias("row"))
        kept = kept.join(repeated, "place", "left_anti").select("row").unionByName(once.select("row"))
    return alone.select("row.*").unionByName(kept.select("row.*"))
