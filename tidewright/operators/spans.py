"""What each row finds among the records of its interval of time, without a row per pair.

Rows are dealt by key and by the bucket in which their interval starts; records are copied to each bucket from which an interval reaches them. Each group's
records come first in its stream, then its rows, a batch at a time: bisection finds an interval's ends, and tables over spans of doubling lengths give its
extremes and its first hit. A row thus costs the logarithm of its group's records, however many lie in its interval. Memory holds the records of one bucket
up to the farthest end of its rows, however many rows there are. Rows that differ in a few values only are dealt and sorted once and expanded after that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import div

FIRST, LAST = -(1 << 63), (1 << 63) - 1
#: Longs up to here are exact doubles.
EXACT = 1 << 53


#: Partitions at least, a number that adaptive execution keeps: small ones are sorted and written without spilling, and over 200 of them Spark's shuffle writes
#: through one bounded buffer, not through one for each partition.
PARTS = 256
#: Gives what is found for a batch of rows, from the records of their group.
Find = Callable[[pa.Table], Callable[[pa.Table], dict[str, pa.Array]]]
#: Makes several rows of each; lines for which the condition doesn't hold are records and stay one each.
Expand = Callable[[DataFrame, Column], DataFrame]


def within(left: DataFrame, right: DataFrame, by: Sequence[str], start: str, end: str, time: str, bucket_ns: int, find: Find, found: str, expand: Expand | None = None) -> DataFrame:
    """left with the columns of found (a schema): what find gives for rows and the records that their group's intervals reach.

    Keys and times that are null meet no record. Intervals may have any length. With expand, rows are expanded after they are dealt and sorted, so that neither
    costs more for it; start and the keys stay, and left has the farthest end of each row's intervals in end.
    """
    rows = left.withColumn("_b", div(F.col(start), bucket_ns))
    reach = rows.groupBy(*by, "_b").agg(F.max(div(F.col(end), bucket_ns)).alias("_to")).where("_to >= _b")
    copies = reach.select(*by, "_b", F.explode(F.sequence("_b", "_to")).alias("_at"))
    near = right.withColumn("_at", div(F.col(time), bucket_ns)).join(copies, [*by, "_at"])
    values = [c for c in right.columns if c not in by]
    near = near.select(*by, "_b", F.lit(False).alias("_row"), *(F.col(c).alias(f"_r_{c}") for c in values))
    both = rows.withColumn("_row", F.lit(True)).unionByName(near, allowMissingColumns=True)
    parts = max(PARTS, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = both.repartition(parts, *by, "_b").sortWithinPartitions(*by, "_b", "_row")
    if expand:
        both = expand(both, F.col("_row"))
    theirs = [f"_r_{c}" for c in values]
    names = [c for c in both.columns if c not in ("_b", "_row", *theirs)]
    added = StructType.fromDDL(found)
    group = [*by, "_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, records, look = None, [], None
        for batch in batches:
            for part in _runs(batch, [*group, "_row"]):
                now = [part.column(c)[0].as_py() for c in group]
                if now != key:
                    key, records, look = now, [], None
                if not part.column("_row")[0].as_py():
                    records.append(part.select(theirs))
                    continue
                if look is None:
                    look, records = find(pa.Table.from_batches(records, part.select(theirs).schema).rename_columns(values)), []
                new = look(pa.Table.from_batches([part.select(names)]))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *(new[f.name] for f in added)], names=[*names, *added.names])

    return both.mapInArrow(run, StructType([*(both.schema[n] for n in names), *added.fields]))


def _runs(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose lines agree in these columns."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for n in names:
        codes = batch.column(n).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new |= codes[1:] != codes[:-1]
    cuts = [0, *(np.nonzero(new)[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def longs(table: pa.Table, name: str, null: int) -> np.ndarray:
    return pc.fill_null(table.column(name).cast(pa.int64()), null).to_numpy()


def doubles(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and which of them aren't null."""
    c = table.column(name).cast(pa.float64())
    return pc.fill_null(c, 0.0).to_numpy(), flags(pc.is_valid(c))


def comparable(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Doubles as engines compare them: NaN is the greatest, null (here NaN) meets nothing."""
    return np.where(known, np.where(np.isnan(values), np.inf, values), np.nan)


def flags(c: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return pc.fill_null(c, False).to_numpy(zero_copy_only=False)


def is_text(table: pa.Table, name: str, value: str) -> np.ndarray:
    return flags(pc.equal(table.column(name), value))


def units(table: pa.Table, name: str) -> np.ndarray:
    """The whole units of a decimal column, null as 0: longs, or Python's integers if their sum may be too large."""
    c = table.column(name).combine_chunks()
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    if len(c) == 0:
        return np.zeros(0, np.int64)
    words = np.frombuffer(c.buffers()[1], np.int64)[2 * c.offset : 2 * (c.offset + len(c))].reshape(-1, 2)
    known = flags(pc.is_valid(c)) if c.null_count else np.ones(len(c), bool)
    low, high = np.where(known, words[:, 0], 0), np.where(known, words[:, 1], 0)
    if np.array_equal(high, low >> 63) and np.abs(low.astype(np.float64)).sum() < 2.0**62:
        return low
    return np.array([(int(h) << 64) + (int(x) & ((1 << 64) - 1)) for x, h in zip(low, high, strict=True)], dtype=object)


def as_double(whole: np.ndarray, scale: int) -> np.ndarray:
    """whole / scale, correctly rounded."""
    if whole.dtype != object and (len(whole) == 0 or max(abs(int(whole.min())), abs(int(whole.max()))) <= EXACT):
        return whole / scale
    return np.array([int(v) / scale for v in whole], dtype=np.float64)


def in_order(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Places of the records in the order of columns of longs; null sorts last."""
    return np.lexsort([longs(table, n, LAST) for n in reversed(names)])


def before(sorted_values: np.ndarray) -> np.ndarray:
    """Running sums with a 0 in front."""
    return np.concatenate([np.zeros(1, sorted_values.dtype), np.cumsum(sorted_values)])


class Doubling:
    """The best value of each span of 1, 2, 4, ... records. best skips NaN (np.fmin, np.fmax)."""

    def __init__(self, values: np.ndarray, best: np.ufunc):
        self.best, self.levels, width = best, [values], 1
        while 2 * width <= len(values):
            self.levels.append(best(self.levels[-1][:-width], self.levels[-1][width:]))
            width *= 2

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The best value of [lo, hi), which must not be empty."""
        out = np.empty(len(lo), self.levels[0].dtype)
        size = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(size):
            at = np.nonzero(size == k)[0]
            out[at] = self.best(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << int(k))])
        return out

    def first(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place in [lo, hi) whose value reaches bound (by np.fmin: at or below, else at or above); hi if there is none."""
        reach = np.less_equal if self.best is np.fmin or self.best is np.minimum else np.greater_equal
        at = lo.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            open_ = np.nonzero(at + width <= hi)[0]
            if len(open_):
                free = open_[~reach(level[at[open_]], bound[open_]).astype(bool)]
                at[free] += width
        return at


def _ends(rows: pa.Table, times: np.ndarray, start: str, end: str, open_start: bool = True, open_end: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First and last place (not included) of each row's interval."""
    lo = np.searchsorted(times, longs(rows, start, LAST), "right" if open_start else "left")
    hi = np.searchsorted(times, longs(rows, end, FIRST), "left" if open_end else "right")
    return lo, np.maximum(lo, hi)


def extremes(left: DataFrame, right: DataFrame, by: Sequence[str], start: str, end: str, time: str, value: str, bucket_ns: int, expand: Expand | None = None) -> DataFrame:
    """left with n, the records whose time is in (start, end], and high, the largest value among them (a double); null where there is none."""

    def find(records: pa.Table) -> Callable[[pa.Table], dict[str, pa.Array]]:
        order = in_order(records, [time])
        times = longs(records, time, LAST)[order]
        values, known = (x[order] for x in doubles(records, value))
        counts, nan = before(known.astype(np.int64)), before(np.isnan(values).astype(np.int64))
        best = Doubling(comparable(values, known), np.fmax)

        def look(rows: pa.Table) -> dict[str, pa.Array]:
            lo, hi = _ends(rows, times, start, end)
            high, valid = np.zeros(len(lo)), counts[hi] > counts[lo]
            if valid.any():
                got = best.over(lo[valid], hi[valid])
                high[valid] = np.where(nan[hi[valid]] > nan[lo[valid]], np.nan, got)
            return {"n": pa.array(hi - lo, pa.int64()), "high": pa.array(high, mask=~valid, from_pandas=False)}

        return look

    records = right.select(*by, time, F.col(value).cast("double").alias(value))
    return within(left, records, by, start, end, time, bucket_ns, find, "n long, high double", expand)


_KEY = ("received_at_ns", "event_ts_ms", "sequence")
_KEY_TYPE = "struct<received_at_ns: bigint, event_ts_ms: bigint, sequence: bigint>"


class _Trades:
    """A group's trades in order, with their first hits of a bound and their last price."""

    def __init__(self, trades: pa.Table):
        order = in_order(trades, _KEY)
        self.key = [longs(trades, n, LAST)[order] for n in _KEY]
        self.sequence_known = flags(pc.is_valid(trades.column("sequence")))[order]
        self.price, self.known = (x[order] for x in doubles(trades, "price"))
        shown = comparable(self.price, self.known)
        self.low, self.high = Doubling(shown, np.fmin), Doubling(shown, np.fmax)

    def hits(self, rows: pa.Table, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first trade at the stop or beyond and of that at the profit; hi where there is none."""
        long = is_text(rows, "side", "LONG")
        stop, profit = (comparable(*doubles(rows, n)) for n in ("stop_price", "profit_price"))
        below = self.low.first(lo, hi, np.where(long, stop, profit))
        above = self.high.first(lo, hi, np.where(long, profit, stop))
        return np.where(long, below, above), np.where(long, above, below)

    def keys(self, at: np.ndarray, found: np.ndarray) -> pa.Array:
        at = np.where(found, at, 0)
        parts = [pa.array(k[at] if len(k) else np.zeros(len(at), np.int64)) for k in self.key]
        return pa.StructArray.from_arrays(parts, names=list(_KEY), mask=pa.array(~found))

    def last(self, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
        """The last price that isn't null."""
        seen = np.concatenate([[-1], np.maximum.accumulate(np.where(self.known, np.arange(len(self.known)), -1))]) if len(self.known) else np.array([-1])
        at = seen[hi]
        found = at >= lo
        price = self.price[np.where(found, at, 0)] if len(self.price) else np.zeros(len(at))
        return pa.array(price, mask=~found, from_pandas=False)


_HITS = f"stop_key {_KEY_TYPE}, profit_key {_KEY_TYPE}, last_price double, trades_seen long"


def first_hits(rows: DataFrame, trades: DataFrame, start: str, end: str, bucket_ns: int, expand: Expand | None = None) -> DataFrame:
    """rows (symbol, side, stop_price, profit_price) with the keys of the first trades in (start, end] at the stop and at the profit, the last price and
    trades_seen (null for none)."""

    def find(records: pa.Table) -> Callable[[pa.Table], dict[str, pa.Array]]:
        t = _Trades(records)

        def look(mine: pa.Table) -> dict[str, pa.Array]:
            lo, hi = _ends(mine, t.key[0], start, end)
            stop, profit = t.hits(mine, lo, hi)
            return {"stop_key": t.keys(stop, stop < hi), "profit_key": t.keys(profit, profit < hi), "last_price": t.last(lo, hi), "trades_seen": pa.array(hi - lo, pa.int64(), mask=hi == lo)}

        return look

    return within(rows, trades.select("symbol", "price", *_KEY), ["symbol"], start, end, "received_at_ns", bucket_ns, find, _HITS, expand)


def _least_units(queue: np.ndarray, need: np.ndarray, strict: bool, scale: int) -> np.ndarray:
    """The fewest whole units V with V / scale - queue at or over need (strict: over it); more than any sum where none is."""
    enough = (lambda v: v / scale - queue > need) if strict else (lambda v: v / scale - queue >= need)
    with np.errstate(invalid="ignore", over="ignore"):
        guess = np.ceil((queue + need) * scale)
        far = ~(np.abs(guess) < EXACT / 2)
        v = np.where(far, 0.0, guess)
        while (more := ~far & ~enough(v)).any():
            v[more] += 1
        while (less := ~far & enough(v - 1)).any():
            v[less] -= 1
        beyond = np.where(guess < 0, -(2.0**62), np.where(guess < 2.0**62, guess, 2.0**62))
    return np.where(far, beyond, v).astype(np.int64)


class _Contra:
    """The eligible trades of one side by price: first ones beyond a price, and running sizes at a price."""

    def __init__(self, price: np.ndarray, size: np.ndarray, may: np.ndarray, downward: bool):
        self.n, self.downward = len(price), downward
        self.at = np.nonzero(may)[0]
        self.levels, rank = np.unique(price[self.at], return_inverse=True)
        self.beyond = Doubling(rank, np.minimum if downward else np.maximum)
        by_level = np.argsort(rank, kind="stable")
        self.place = self.at[by_level]
        self.code = rank[by_level] * self.n + self.place
        self.rank = rank
        self.size = size
        self.sums = before(size[self.place])
        self.best = Doubling(self.sums[1:], np.maximum)

    def near(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The levels [a, b) at each entry price, but for rounding."""
        most = np.maximum(np.abs(entry) * 1e-10, 1e-12)
        a = np.searchsorted(self.levels, entry, "left")
        b = a.copy()
        padded = np.concatenate([self.levels, [np.nan]])
        while (down := (a > 0) & (np.abs(padded[a - 1] - entry) <= most)).any():
            a[down] -= 1
        while (up := np.abs(padded[b] - entry) <= most).any():
            b[up] += 1
        return a, b

    def through(self, lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of the first trade in [lo, hi) beyond the levels at the entry; n where there is none."""
        first, last = np.searchsorted(self.at, lo), np.searchsorted(self.at, hi)
        j = self.beyond.first(first, last, a - 1 if self.downward else b)
        return np.where(j < last, np.append(self.at, self.n)[np.minimum(j, len(self.at))], self.n)

    def reaching(self, lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray, volumes: Sequence[np.ndarray]) -> tuple[list[np.ndarray], Callable, np.ndarray]:
        """For each of volumes the place where the sum at the entry first reaches it (n: never); a function of the sum up to a place; the largest sum."""
        one = b - a == 1
        s = np.where(one, np.searchsorted(self.code, a * self.n + lo), 0)
        e = np.where(one, np.searchsorted(self.code, a * self.n + hi), 0)
        places = np.append(self.place, self.n)
        found = []
        for v in volumes:
            j = self.best.first(s, e, self.sums[s] + v)
            found.append(np.where(j < e, places[np.minimum(j, len(self.place))], self.n))
        largest = np.zeros(len(lo), self.sums.dtype)
        some = e > s
        if some.any():
            largest[some] = self.best.over(s[some], e[some]) - self.sums[s[some]]
        # prices that differ by rounding only: such an order's trades are gathered by themselves
        gathered = {}
        for i in np.nonzero(b - a > 1)[0]:
            mine = self.at[(self.rank >= a[i]) & (self.rank < b[i]) & (self.at >= lo[i]) & (self.at < hi[i])]
            sums = before(self.size[mine])
            gathered[i] = mine, sums
            largest[i] = sums[1:].max() if len(mine) else 0
            for f, v in zip(found, volumes, strict=True):
                reached = np.nonzero(sums[1:] >= v[i])[0]
                f[i] = mine[reached[0]] if len(reached) else self.n

        def upto(place: np.ndarray) -> np.ndarray:
            out = self.sums[np.where(one, np.searchsorted(self.code, a * self.n + place, "right"), 0)] - self.sums[s]
            for i, (mine, sums) in gathered.items():
                out[i] = sums[np.searchsorted(mine, place[i], "right")]
            return out

        return found, upto, largest


_SCALE = 1_000_000


def first_fills(orders: DataFrame, trades: DataFrame, bucket_ns: int, expand: Expand | None = None) -> DataFrame:
    """orders (symbol, side, entry_price, queue_ahead, size, active_at_ns, expires_at_ns) with what fills them in (active_at_ns, expires_at_ns).

    trades: symbol, price, trade_size (decimal(24,6), not negative), trade_side, ok, and their order. Adds _trades, _first_ns, _full_ns, _partial, _volume: all trades, the
    times of the first fill and of the full one, the part filled of an order that isn't full, and the volume at the price up to the full fill or the end.
    """

    def find(records: pa.Table) -> Callable[[pa.Table], dict[str, pa.Array]]:
        order = in_order(records, _KEY)
        times = longs(records, _KEY[0], LAST)[order]
        price, known = (x[order] for x in doubles(records, "price"))
        size, may = units(records, "trade_size")[order], flags(records.column("ok"))[order] & known
        n = len(times)
        sides = [(down, _Contra(price, size, may & is_text(records, "trade_side", side)[order], down)) for down, side in ((True, "Sell"), (False, "Buy"))]

        def look(rows: pa.Table) -> dict[str, pa.Array]:
            lo, hi = _ends(rows, times, "active_at_ns", "expires_at_ns", open_end=True)
            (entry, priced), (queue, queued), (want, sized) = (doubles(rows, c) for c in ("entry_price", "queue_ahead", "size"))
            enough = want - np.maximum(want * 1e-12, 1e-15)
            first_units = np.where(queued, _least_units(queue, np.zeros(len(want)), True, _SCALE), 1 << 62)
            full_units = np.where(queued & sized, _least_units(queue, enough, False, _SCALE), 1 << 62)
            first, full = np.full(len(lo), n), np.full(len(lo), n)
            volume, partial = np.zeros(len(lo)), np.zeros(len(lo))
            long = is_text(rows, "side", "LONG")
            for downward, contra in sides:
                mine = np.nonzero(long == downward)[0]
                if not len(mine):
                    continue
                l, h = lo[mine], hi[mine]
                a, b = contra.near(np.where(priced, entry, 0.0)[mine])
                none = ~priced[mine]
                a[none], b[none] = (0, 0) if downward else (len(contra.levels), len(contra.levels))
                beyond = contra.through(l, h, a, b)
                (one, all_), upto, largest = contra.reaching(l, h, a, b, (first_units[mine], full_units[mine]))
                some = h > l
                one = np.where(some & (first_units[mine] <= 0), l, one)
                all_ = np.where(some & ((full_units[mine] <= 0) | (sized[mine] & (enough[mine] <= 0))), l, all_)
                first[mine] = np.minimum(np.where((want[mine] > 0) | ~sized[mine], one, n), np.where(sized[mine] & (want[mine] > 0), beyond, n))
                full[mine] = np.minimum(all_, np.where(sized[mine], beyond, n))
                filled = full[mine] < n
                volume[mine] = as_double(np.where(filled, upto(np.minimum(full[mine], n - 1)), largest) if n else largest, _SCALE)
                left = np.where(queued[mine], np.maximum(0.0, volume[mine] - queue[mine]), 0.0)
                partial[mine] = np.where(sized[mine], np.minimum(want[mine], left), left)
            stamps = np.append(times, 0)
            full_ns = pa.array(stamps[full], pa.int64(), mask=full == n)
            return {
                "_trades": pa.array(hi - lo, pa.int64()), "_first_ns": pa.array(stamps[first], pa.int64(), mask=first == n), "_full_ns": full_ns,
                "_partial": pa.array(partial, mask=(full < n) | (hi == lo), from_pandas=False), "_volume": pa.array(volume, from_pandas=False),
            }

        return look

    records = trades.select("symbol", "price", "trade_size", "trade_side", "ok", *_KEY)
    return within(orders, records, ["symbol"], "active_at_ns", "expires_at_ns", _KEY[0], bucket_ns, find, "_trades long, _first_ns long, _full_ns long, _partial double, _volume double", expand)


def hits_after_fill(fills: DataFrame, trades: DataFrame, bucket_ns: int) -> DataFrame:
    """As first_hits, of trades after the fill: those later than fill_ns, or at it with a greater sequence than fill_sequence, to horizon_end_ns."""

    def find(records: pa.Table) -> Callable[[pa.Table], dict[str, pa.Array]]:
        t = _Trades(records)
        times, _, number = t.key
        same = times[1:] == times[:-1]
        odd = np.concatenate([[False], same & (number[1:] < number[:-1])])[: len(times)] | ~t.sequence_known
        odds = before(odd.astype(np.int64))

        def look(rows: pa.Table) -> dict[str, pa.Array]:
            lo, hi = _ends(rows, times, "fill_ns", "horizon_end_ns")
            tied, _ = _ends(rows, times, "fill_ns", "horizon_end_ns", open_start=False)
            # trades at the fill's time: a bisection by number where they stand in its order, else one by one
            own = longs(rows, "fill_sequence", LAST)
            some = (lo > tied) & (longs(rows, "horizon_end_ns", FIRST) >= longs(rows, "fill_ns", LAST))
            first, last = np.where(some, tied, lo), lo.copy()
            while (open_ := first < last).any():
                middle = (first + last) >> 1
                greater = number[np.where(open_, middle, 0)] > own
                last = np.where(open_ & greater, middle, last)
                first = np.where(open_ & ~greater, middle + 1, first)
            begin = last
            slow = np.nonzero(some & (odds[lo] > odds[tied]))[0]
            begin[slow] = lo[slow]
            stop, profit = t.hits(rows, begin, hi)
            count, price = hi - begin, t.last(begin, hi)
            if len(slow):
                long = is_text(rows, "side", "LONG")
                low, high = (comparable(*doubles(rows, n)) for n in ("stop_price", "profit_price"))
                shown, prices = comparable(t.price, t.known), price.to_pylist()
                for i in slow:
                    ties = np.arange(tied[i], lo[i])
                    ties = ties[(number[ties] > own[i]) & t.sequence_known[ties]]
                    count[i] += len(ties)
                    falls, rises = (low[i], high[i]) if long[i] else (high[i], low[i])
                    below, above = ties[shown[ties] <= falls], ties[shown[ties] >= rises]
                    for place, among in ((stop, below if long[i] else above), (profit, above if long[i] else below)):
                        place[i] = among[0] if len(among) else place[i]
                    if prices[i] is None and len(valued := ties[t.known[ties]]):
                        prices[i] = float(t.price[valued[-1]])
                price = pa.array(prices, pa.float64())
            return {"stop_key": t.keys(stop, stop < hi), "profit_key": t.keys(profit, profit < hi), "last_price": price, "trades_seen": pa.array(count, pa.int64(), mask=count == 0)}

        return look

    return within(fills, trades.select("symbol", "price", *_KEY), ["symbol"], "fill_ns", "horizon_end_ns", _KEY[0], bucket_ns, find, _HITS)


def trailing_sums(trades: DataFrame, by: Sequence[str], width_ns: int, sums: Sequence[str], scale: int) -> DataFrame:
    """Per trade of what was traded in [t - width, t]: trade_count, sums of decimal columns as doubles, and the first and the last price.

    Trades are dealt by key and bucket of the window's width; each also goes to the next bucket, as past only. So each group sees its windows whole, and no
    more than twice the rows move. Trades without a time are one window of their own.
    """
    own = trades.select(*by, *_KEY, "price", *sums, div(F.col(_KEY[0]), width_ns).alias("_b"), F.lit(False).alias("_past"))
    both = own.unionByName(own.where("_b is not null").withColumn("_b", F.col("_b") + 1).withColumn("_past", F.lit(True)))
    names = [*by, _KEY[0], "sequence"]
    found = StructType.fromDDL("trade_count long, " + "".join(f"{n} double, " for n in sums) + "first_price double, last_price double")

    def run(rows: pa.Table) -> pa.Table:
        order = in_order(rows, _KEY)
        times = longs(rows, _KEY[0], LAST)[order]
        n, mine = len(times), ~flags(rows.column("_past"))[order]
        at = times[mine]
        lo, hi = np.searchsorted(times, at - width_ns, "left"), np.searchsorted(times, at, "right")
        out = [rows.column(c).take(pa.array(order[mine])) for c in names] + [pa.array(hi - lo, pa.int64())]
        for c in sums:
            total = before(units(rows, c)[order])
            known = before(flags(pc.is_valid(rows.column(c)))[order].astype(np.int64))
            out.append(pa.array(as_double(total[hi] - total[lo], scale), mask=known[hi] == known[lo], from_pandas=False))
        price, known = (x[order] for x in doubles(rows, "price"))
        places = np.arange(n)
        following = np.minimum.accumulate(np.where(known, places, n)[::-1])[::-1][lo]
        preceding = np.maximum.accumulate(np.where(known, places, -1))[hi - 1]
        none = following >= hi
        out += [pa.array(price[np.where(none, 0, p)], mask=none, from_pandas=False) for p in (following, preceding)]
        return pa.table(out, names=[*names, *found.names])

    return both.groupBy(*by, "_b").applyInArrow(run, StructType([*(trades.schema[c] for c in names), *found.fields]))
