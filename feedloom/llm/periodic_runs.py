"""Runs of repeating word groups in texts, from suffix trees of the words.

A run is a longest stretch of words with a smallest period q that fills at least
``least_words`` words and ``least_times`` periods. By the runs theorem, the period of
every run is the length of the longest Lyndon word that starts at some word of it, in
the order of the words or in the reverse order. So each word gives two candidates, and
each candidate is extended as far as its period holds, to both sides:

* A suffix tree (Ukkonen) of the words and one of the words backwards. The longest
  common extension of two places is the depth of the lowest common ancestor of their
  leaves: a smallest value in the Euler tour of the tree, in constant time.
* The longest Lyndon words come from the next smaller suffix; the order of the
  suffixes is the order of the leaves.

In a run of ``least_times`` periods every word occurs that often. Words that are
rarer in their stretch belong to no run, so the text is cut at them, again and again
until nothing changes; the trees are built of what is left between the cuts.
One task holds the trees of one text at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedloom.llm.common import free_name

LEAST_WORDS = 6
LEAST_TIMES = 4
# Texts are cut at rare words together, about so many words at a time.
_WORDS_AT_ONCE = 200_000
_BLOCK = 16

RUN = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
)
_ARROW_RUN = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


class RangeMin:
    """Smallest value of any range in constant time: a table over blocks, running values inside them."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // _BLOCK)
        grid = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        grid[: len(values)] = values
        self.values = grid
        grid = grid.reshape(blocks, _BLOCK)
        self.upto = np.minimum.accumulate(grid, axis=1).ravel()
        self.onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        rows = [grid.min(axis=1)]
        while (step := 1 << (len(rows) - 1)) * 2 <= blocks:
            row = rows[-1].copy()
            row[:-step] = np.minimum(row[:-step], rows[-1][step:])
            rows.append(row)
        self.table = np.stack(rows)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Smallest value from place a to place b, both included."""
        a, b = np.minimum(a, b), np.maximum(a, b)
        low, high = a // _BLOCK, b // _BLOCK
        out = np.minimum(self.onward[a], self.upto[b])
        far = np.flatnonzero(high - low > 1)
        if len(far):
            level = np.frexp((high - low - 1)[far].astype(np.float64))[1] - 1
            first = self.table[level, low[far] + 1]
            out[far] = np.minimum(out[far], np.minimum(first, self.table[level, high[far] - (1 << level)]))
        near = np.flatnonzero(low == high)
        if len(near):
            left, right = a[near], b[near]
            least = self.values[left]
            for _ in range(_BLOCK - 1):
                left = np.minimum(left + 1, right)
                least = np.minimum(least, self.values[left])
            out[near] = least
        return out


class SuffixTree:
    """Ukkonen's suffix tree of whole numbers above 0; a 0 is added at the end."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        n, width = len(s), max(s) + 1
        first, last, link, parent, leaves = [0], [0], [0], [-1], []
        edges: dict[int, int] = {}
        node = edge = length = open_ends = 0
        for i, c in enumerate(s):
            waiting = 0
            open_ends += 1
            while open_ends:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    leaves.append(len(first))
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    parent.append(node)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    at = first[child]
                    span = last[child] - at
                    if length >= span:
                        node = child
                        edge += span
                        length -= span
                        continue
                    if s[at + length] == c:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    middle = len(first)
                    edges[key] = middle
                    first.append(at)
                    last.append(at + length)
                    link.append(0)
                    parent.append(node)
                    at += length
                    first[child] = at
                    parent[child] = middle
                    edges[middle * width + s[at]] = child
                    edges[middle * width + c] = middle + 1
                    leaves.append(middle + 1)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    parent.append(middle)
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                open_ends -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_ends + 1
        self.size = n
        self.width = width
        self.span = np.array(last) - np.array(first)
        self.parent = np.array(parent)
        self.symbol = np.array(s)[np.array(first)]
        self.suffix = np.full(len(first), -1)  # of a leaf: where its suffix starts
        self.suffix[leaves] = np.arange(n)
        self._places = None

    def _children(self, backwards: bool) -> list[list[int]]:
        """Children by symbol; backwards: by falling symbol, but the end of the text first."""
        by = np.where(self.symbol > 0, self.width - self.symbol, 0) if backwards else self.symbol
        order = np.lexsort((by[1:], self.parent[1:])) + 1
        ends = np.searchsorted(self.parent[order], np.arange(len(self.parent) + 1)).tolist()
        order = order.tolist()
        return [order[a:b] for a, b in zip(ends, ends[1:])]

    def order(self, backwards: bool) -> np.ndarray:
        """Rank of every suffix; backwards: with the order of the symbols turned round."""
        children, suffix = self._children(backwards), self.suffix.tolist()
        found, stack = [], [0]
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                found.append(suffix[node])
            else:
                stack.extend(reversed(children[node]))
        rank = np.empty(self.size, np.int64)
        rank[found] = np.arange(self.size)
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of the suffixes at a and at b, which differ."""
        if self._places is None:
            self._tour()
        return self._least.of(self._places[a], self._places[b])

    def _tour(self) -> None:
        """Euler tour: the depth of the node at every step, and each leaf's step."""
        children, suffix, span = self._children(False), self.suffix.tolist(), self.span.tolist()
        depth, tour, stack = [0] * len(span), [], [0]
        places = [0] * self.size
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(depth[~node])
                continue
            if suffix[node] >= 0:
                places[suffix[node]] = len(tour)
                tour.append(self.size - suffix[node])
                continue
            own = depth[node]
            tour.append(own)
            for child in reversed(children[node]):
                depth[child] = own + span[child]
                stack.append(~node)
                stack.append(child)
        self._least = RangeMin(np.array(tour, np.int32))
        self._places = np.array(places)


def _lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every place: up to the next smaller suffix."""
    rank = rank.tolist()
    n = len(rank) - 1
    until, stack = [n] * n, []
    for i in range(n):
        own = rank[i]
        while stack and rank[stack[-1]] > own:
            until[stack.pop()] = i
        stack.append(i)
    return np.array(until) - np.arange(n)


def runs_of(
    symbols: np.ndarray, least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES
) -> np.ndarray:
    """Rows (start, length, period) of a sequence of whole numbers above 0, sorted by start, then period."""
    n = len(symbols)
    if not n:
        return np.empty((0, 3), np.int64)
    forward = SuffixTree(symbols.tolist())
    at = np.tile(np.arange(n), 2)
    period = np.concatenate([_lyndon(forward.order(b)) for b in (False, True)])
    right = forward.common(at, at + period)
    del forward
    left = SuffixTree(symbols[::-1].tolist()).common(n - at, n - at - period)
    length = left + period + right
    real = length >= np.maximum(least_words, least_times * period)
    found = np.stack([at - left, length, period], axis=1)[real].astype(np.int64)
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def _hopeful(place: np.ndarray, symbol: np.ndarray, least_words: int, least_times: int):
    """(place, stretch) of the words that may belong to a run; places of one text follow each other."""
    stretch = np.cumsum(np.diff(place, prepend=-2) != 1)
    while len(place):
        key = stretch * (symbol.max() + 1) + symbol
        _, which, often = np.unique(key, return_inverse=True, return_counts=True)
        stays = often[which] >= least_times
        place, symbol = place[stays], symbol[stays]
        cut = np.diff(place, prepend=-2) != 1
        long = np.bincount(np.cumsum(cut) - 1, minlength=1) if len(place) else np.empty(0, int)
        stays = np.repeat(long >= least_words, long)
        if stays.all() and len(place) == len(stretch):
            return place, symbol, stretch
        place, symbol = place[stays], symbol[stays]
        stretch = np.cumsum(np.diff(place, prepend=-2) != 1)
    return place, symbol, stretch


def _text_runs(
    texts: list[list[bytes]], least_words: int, least_times: int
) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given as words; sorted by start, then period."""
    number: defaultdict = defaultdict(count(1).__next__)
    symbols, starts, upto = [], [], 0
    for words in texts:
        symbols.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        starts.append(upto)
        upto += len(words) + 1  # a gap, so that no stretch crosses texts
    place = np.concatenate([np.arange(a, a + len(s)) for a, s in zip(starts, symbols)])
    place, symbol, stretch = _hopeful(place, np.concatenate(symbols), least_words, least_times)
    found: list[list] = [[] for _ in texts]
    ends = np.flatnonzero(np.diff(stretch, append=-1)) + 1
    begin = 0
    for end in ends.tolist():
        _, small = np.unique(symbol[begin:end], return_inverse=True)
        runs = runs_of(small + 1, least_words, least_times)
        if len(runs):
            which = int(np.searchsorted(starts, place[begin], side="right")) - 1
            runs[:, 0] += place[begin] - starts[which]
            found[which].extend(map(tuple, runs.tolist()))
        begin = end
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(step[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _pieces(texts: list) -> Iterator[list[list[bytes]]]:
    """Texts as words, some at a time."""
    held, size = [], 0
    for text in texts:
        words = text.split() if text else []
        held.append(words)
        size += len(words)
        if size >= _WORDS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    least_words: int = LEAST_WORDS,
    least_times: int = LEAST_TIMES,
) -> DataFrame:
    """The input rows with the runs of their text and the text without what they repeat.

    ``runs``: an array of (start, length, period) in words, by start, then period. ``collapsed``:
    UTF-8 of the words that no run holds after its first period, joined by one space.
    Words are cut at ASCII white space and compared byte for byte. Rows are independent: repeated
    rows and ids get a result each. A null or empty text has no runs and collapses to
    nothing (an empty value, not null); an empty table gives an empty one. An input column named like a
    new one keeps its name, the new one gets underscores in front. Very long texts are read whole.
    """
    if least_times < 2:
        raise ValueError("a run repeats its period at least twice")
    runs = free_name(docs.columns, runs)
    collapsed = free_name([*docs.columns, runs], collapsed)
    at = docs.columns.index(text)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(runs, RUN), T.StructField(collapsed, T.BinaryType())]
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            all_runs, left = [], []
            for piece in _pieces(texts):
                of_piece = _text_runs(piece, least_words, least_times)
                left.extend(map(_collapsed, piece, of_piece))
                all_runs.extend(of_piece)
            new = [pa.array(_rows(all_runs), _ARROW_RUN), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], names=[*batch.schema.names, runs, collapsed]
            )

    return docs.mapInArrow(found, schema)


def _rows(all_runs: list) -> list[list[dict]]:
    names = ("start", "length", "period")
    return [[dict(zip(names, r)) for r in own] for own in all_runs]
