"""Best-fit packing: a best-fit start, then a local search that swaps documents between underfull bins.

Bins that hold the same lengths form one class with a count, so the search works on the histogram of lengths: its size
depends on the window, not on the number of documents.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .packing import WINDOW, WORD_BPE, pack

END = 0
#: Exchanges at most. A search that is stopped leaves a valid packing; those of the given tables end far below it.
EXCHANGES = 8_000

#: What a bin holds: length to how often.
Use = dict[int, int]


def with_more(use: Use, n: int, m: int) -> Use:
    """The same lengths with ``m`` more (or fewer) of ``n``."""
    out = {**use, n: use.get(n, 0) + m}
    if not out[n]:
        del out[n]
    return out


def best_fit(counts: np.ndarray, window: int) -> list[tuple[int, Use]]:
    """Best fit over falling lengths: each piece goes to the fullest bin that has room. A bin that takes one piece of a
    length is then the fullest with room, so it goes on to take as many as fit; whole classes of bins do so at once."""
    by_space: dict[int, list[tuple[int, Use]]] = {}
    for n in np.flatnonzero(counts)[::-1].tolist():
        left, new = int(counts[n]), []
        spaces = sorted(by_space)
        for space in spaces[bisect_left(spaces, n) :]:
            kept = []
            for times, use in by_space.pop(space):
                most = space // n
                whole = min(times, left // most)
                if whole:
                    new.append((space - most * n, whole, with_more(use, n, most)))
                    left -= whole * most
                times -= whole
                if times and left:
                    new.append((space - left * n, 1, with_more(use, n, left)))
                    left, times = 0, times - 1
                if times:
                    kept.append((times, use))
            if kept:
                by_space[space] = kept
            if not left:
                break
        most = window // n
        new += [(window - m * n, times, {n: m}) for times, m in ((left // most, most), (1, left % most)) if times and m]
        for space, times, use in new:
            by_space.setdefault(space, []).append((times, use))
    return [x for kind in by_space.values() for x in kind]


def fewest(counts: np.ndarray, window: int) -> int:
    """A number of bins that no packing can go below: pieces longer than half a window need bins of their own, and for each
    k those of at least k, too, beside pieces longer than window - k."""
    n = np.arange(len(counts))
    total, half, best = counts * n, window // 2, 0
    for k in range(half + 1):
        alone, large, small = n > window - k, (n > half) & (n <= window - k), (n >= k) & (n <= half)
        space = int(counts[large].sum()) * window - int(total[large].sum())
        best = max(best, int(counts[alone].sum() + counts[large].sum()) + max(0, -(-(int(total[small].sum()) - space) // window)))
    return best


class Bins:
    """Classes of underfull bins, and for each the sums of no, one and two of its pieces, as flat arrays."""

    def __init__(self, window: int):
        self.window, self.times, self.use, self.picks, self.fill = window, [], [], [], []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.known: dict[tuple, int] = {}

    def add(self, times: int, use: Use) -> None:
        key = tuple(sorted(use.items()))
        if key in self.known:
            self.times[self.known[key]] += times
            return
        self.known[key] = len(self.times)
        picks = [(), *((n,) for n, _ in key), *(p for p in combinations_with_replacement([n for n, _ in key], 2) if p[0] != p[1] or use[p[0]] > 1)]
        self.parts.append((np.array([sum(p) for p in picks]), np.array([len(p) for p in picks])))
        self.times.append(times)
        self.use.append(use)
        self.picks.append(picks)
        self.fill.append(sum(n * m for n, m in key))

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class, number in the class, sum and how many pieces, of every pick from a class that is there."""
        there = [k for k, t in enumerate(self.times) if t]
        sizes = [len(self.parts[k][0]) for k in there]
        return (
            np.repeat(there, sizes), np.concatenate([np.arange(s) for s in sizes]),
            np.concatenate([self.parts[k][0] for k in there]), np.concatenate([self.parts[k][1] for k in there]),
        )


def searched(packed: list[tuple[int, Use]], counts: np.ndarray, window: int, limit: int = EXCHANGES) -> list[tuple[int, Use]]:
    """The packing after exchanges between underfull bins that raise the sum of squared fills: move one piece, exchange
    one for one, or two for one either way. The emptiest bin is tried first, with the exchange that raises the sum most;
    a bin that has given all its pieces goes. Ends where no exchange is left, or no packing can have fewer bins."""
    least, total = fewest(counts, window), sum(t for t, _ in packed)
    done, bins = [], Bins(window)
    for times, use in packed:
        if sum(n * m for n, m in use.items()) == window:
            done.append((times, use))
        else:
            bins.add(times, use)
    stuck: set[int] = set()
    while total > least and limit:
        there = sorted((k for k, t in enumerate(bins.times) if t and k not in stuck), key=lambda k: (bins.fill[k], k))
        if not there:
            break
        limit -= 1
        source = there[0]
        found = exchange(bins, source)
        if found is None:
            stuck.add(source)
            continue
        target, give, get = found
        times = bins.times[source] // 2 if target == source else min(bins.times[source], bins.times[target])
        lost, won = bins.use[source], bins.use[target]
        for n in give:
            lost, won = with_more(lost, n, -1), with_more(won, n, 1)
        for n in get:
            lost, won = with_more(lost, n, 1), with_more(won, n, -1)
        bins.times[source] -= times
        bins.times[target] -= times
        for use in (lost, won):
            if not use:
                total -= times
            elif sum(n * m for n, m in use.items()) == window:
                done.append((times, use))
            else:
                bins.add(times, use)
        stuck.clear()
    return done + [(t, u) for t, u in zip(bins.times, bins.use, strict=True) if t]


def exchange(bins: Bins, source: int) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
    """The exchange of this bin with another underfull one that raises the sum of squared fills most: the other bin, what
    it gets, what it gives. None if there is none."""
    at, pick, sums, sizes = bins.flat()
    fill = np.array(bins.fill)
    other = fill[at]
    able = (at != source) | (bins.times[source] > 1)
    best, gain = None, 0
    for give in bins.picks[source][1:]:
        more = sum(give) - sums
        allowed = able & (sizes <= (2 if len(give) == 1 else 1)) & ((sizes > 0) | (len(give) == 1)) & (more != 0) & (other + more <= bins.window) & (fill[source] - more <= bins.window)
        raised = np.where(allowed, more * (other - fill[source] + more), 0)
        k = int(raised.argmax())
        if raised[k] > gain:
            best, gain = (int(at[k]), give, bins.picks[at[k]][pick[k]]), int(raised[k])
    return best


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (repeat count, [(length, how often), ...]) that use each length exactly ``counts`` times."""
    if not counts.any():
        return []
    packed = searched(best_fit(counts, window), counts, window)
    return [(times, sorted(use.items(), reverse=True)) for times, use in packed]


def best_fit_pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, columns: list[str] | None = None) -> DataFrame:
    """As ``packing.pack``, but documents of at most ``window`` ids stay whole and sequences are as few as a best-fit start
    and the local search make them. Longer documents are cut into whole windows and a shorter last piece. Column
    ``piece`` numbers a document's pieces from 0. A null text counts as empty: it has ``end`` alone. Repeated rows are
    packed as often as they occur, no rows give no rows, equal lengths may trade places; other columns are ignored."""
    own = ["doc_id", "start", "length", "ids", "ids_crc32"]
    rows = pack(docs, vocabulary, window, end, columns or own, planner=plan)
    return rows.withColumn("piece", (F.col("start") / window).cast("int"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed whole into as few sequences of at most 2048 ids as the search finds."""
    rows = best_fit_pack(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), columns=["doc_id", "start", "length", "ids_crc32"])
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
