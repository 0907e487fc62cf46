"""Token counts that follow edits, from segment trees over pre-tokens.

A text's pre-tokens are the leaves of a tree whose nodes hold characters and tokens of
what is below them. An edit re-reads only the leaves it touches, a little context to the
left and as much to the right as it takes until the cuts meet old ones again; the
leaves' sums are then updated up to the root.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name

# Fixed value: the pattern that cuts pre-tokens for the rank files.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# Pre-tokens a leaf may hold, and leaves an edit may leave empty, before the tree is laid out anew.
HOLDS, IDLE = 8, 64
# Rows whose results are sent together.
ROWS = 256
# A cut depends on two characters after it at most: white space before a word leaves its
# last space to the word.
CONTEXT = 2
_CACHE = 300_000


def packed(lengths: np.ndarray, tokens: np.ndarray) -> bytes:
    """Leaves as bytes: their number, a byte for each of up to 63 characters and 3 tokens, and the others' numbers in full."""
    short = (lengths < 64) & (tokens < 4) & ((lengths < 63) | (tokens < 3))
    codes = np.where(short, lengths * 4 + tokens, 255).astype(np.uint8)
    others = np.stack((lengths[~short], tokens[~short])).astype("<i4")
    return np.array([len(codes)], "<i4").tobytes() + codes.tobytes() + others.tobytes()


def unpacked(leaves: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and tokens of packed leaves."""
    n = int(np.frombuffer(leaves, "<i4", 1)[0])
    codes = np.frombuffer(leaves, np.uint8, n, 4)
    lengths, tokens = (codes // 4).astype(np.int64), (codes % 4).astype(np.int64)
    lengths[codes == 255], tokens[codes == 255] = np.frombuffer(leaves, "<i4", offset=4 + n).reshape(2, -1)
    return lengths, tokens


class _Known(dict):
    """Numbers of tokens by pre-token; new ones are encoded, and all are forgotten when they are too many."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n


class Counter:
    """Pre-tokens of a text and the number of tokens of each, by a rank file's merges."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import regex
        import tiktoken

        lines = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={}
        )
        self.pieces = regex.compile(pattern).findall
        self.known = _Known(self.encoding.encode_ordinary)

    def counts(self, pieces: list[str]) -> list[int]:
        return list(map(self.known.__getitem__, pieces))

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and tokens of a text's pre-tokens."""
        pieces = self.pieces(text)
        n = len(pieces)
        return np.fromiter(map(len, pieces), np.int64, n), np.fromiter(map(self.known.__getitem__, pieces), np.int64, n)


@lru_cache(maxsize=2)
def _counter(ranks: bytes, pattern: str) -> Counter:
    return Counter(ranks, pattern)


class TokenTree:
    """The pre-tokens of one text under edits; characters and tokens by subtree.

    A leaf is a pre-token of the first text. An edit deals the pre-tokens it re-reads out over the
    leaves it touches; where those are far too few or too many, the tree is laid out anew
    from the leaves' known numbers, with a leaf for each of them, and nothing else is encoded again.
    """

    def __init__(self, text: str, counter: Counter, leaves: Sequence[Sequence[int]] | None = None):
        """``leaves`` (lengths and tokens), as ``leaves()`` gives them, spare the encoding."""
        self.counter = counter
        if leaves is None:
            leaves = counter.leaves(text)
        n = len(leaves[0])
        self.first = 1 << max(0, n - 1).bit_length()
        self.n, self.text, self.changed = n, text, {}
        self.starts = np.zeros(n + 1, np.int64)
        np.cumsum(leaves[0], out=self.starts[1:])
        # plain lists: an edit reads and writes single numbers, which is slow in an array
        self.chars, self.tokens = self._sums(leaves)
        self.read = 0  # characters re-read by edits

    def _sums(self, leaves: Sequence[Sequence[int]]) -> list[list[int]]:
        trees = np.zeros((2, 2 * self.first), np.int64)
        trees[:, self.first : self.first + self.n] = leaves
        level = self.first
        while level > 1:
            np.add(trees[:, level : 2 * level : 2], trees[:, level + 1 : 2 * level : 2], out=trees[:, level // 2 : level])
            level //= 2
        return trees.tolist()

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and tokens of the leaves; for a text without edits, of its pre-tokens."""
        own = slice(self.first, self.first + self.n)
        return np.array(self.chars[own], np.int64), np.array(self.tokens[own], np.int64)

    def _set(self, leaf: int, chars: list[int], tokens: list[int]) -> None:
        """New numbers for leaves in a row from this one on, and for what is above them."""
        low = self.first + leaf
        high = low + len(chars)
        self.chars[low:high], self.tokens[low:high] = chars, tokens
        low, high = low // 2, (high - 1) // 2
        while low:
            for tree in (self.chars, self.tokens):
                for at in range(low, high + 1):
                    tree[at] = tree[2 * at] + tree[2 * at + 1]
            low, high = low // 2, high // 2

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts."""
        at, start, chars = 1, 0, self.chars
        while at < self.first:
            at *= 2
            if place >= start + chars[at]:
                start += chars[at]
                at += 1
        return at - self.first, start

    def _leaf_text(self, leaf: int) -> str:
        changed = self.changed.get(leaf)
        return self.text[self.starts[leaf] : self.starts[leaf + 1]] if changed is None else changed

    def _between(self, low: int, high: int) -> str:
        """The text of the leaves from low up to high."""
        parts, at = [], low
        for leaf in sorted(x for x in self.changed if low <= x < high):
            parts += [self.text[self.starts[at] : self.starts[leaf]], self.changed[leaf]]
            at = leaf + 1
        return "".join([*parts, self.text[self.starts[at] : self.starts[high]]])

    def whole(self) -> str:
        return self._between(0, self.n)

    def _lay_out(self, left: int, stop: int, pieces: list[str], tokens: list[int]) -> None:
        """A new tree with these pre-tokens in place of the leaves from left to stop, and without empty leaves."""
        text = "".join([self._between(0, left), *pieces, self._between(stop + 1, self.n)])
        own = slice(self.first, self.first + self.n)
        new = [len(p) for p in pieces], tokens
        chars, tokens = (
            np.array([*old[own][:left], *n, *old[own][stop + 1 :]], np.int64)
            for old, n in zip((self.chars, self.tokens), new)
        )
        read = self.read
        self.__init__(text, self.counter, (chars[chars > 0], tokens[chars > 0]))
        self.read = read

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from start up to end; places beyond the text are its end."""
        length = self.chars[1]
        start = min(max(start, 0), length)
        end = min(max(end, start), length)
        if self.n == 0:
            # no leaf to hold it: a new tree
            read = self.read + len(new)
            self.__init__(new, self.counter)
            self.read = read
            return
        left, at = self._leaf_at(min(max(start - CONTEXT, 0), length - 1)) if length else (0, 0)
        right, begins = self._leaf_at(end - 1) if end > start else self._leaf_at(min(start, length - 1)) if length else (0, 0)
        right, begins = max((left, at), (right, begins))
        region = "".join(map(self._leaf_text, range(left, right + 1)))
        region = region[: start - at] + new + region[end - at :]
        # ends of leaves after the edit, in the region's characters
        ends, last, more = {len(region): right}, right, 2
        reached = begins + self.chars[self.first + right]
        while True:
            for _ in range(more):
                if reached >= length:
                    break
                # empty leaves are stepped over
                last = self._leaf_at(reached)[0]
                reached += self.chars[self.first + last]
                region += self._leaf_text(last)
                ends[len(region)] = last
            pieces, cut, met = self.counter.pieces(region), 0, None
            done = reached >= length
            for i, piece in enumerate(pieces):
                cut += len(piece)
                if cut in ends and (done or cut + CONTEXT <= len(region)):
                    met = i + 1, cut, ends[cut]
                    break
            if met or done:
                break
            more = 2 * len(ends)
        count, cut, stop = met or (len(pieces), len(region), last)
        self.read += cut
        pieces, room = pieces[:count], stop - left + 1
        counts = self.counter.counts(pieces)
        if count > HOLDS * room or room > count + IDLE:
            self._lay_out(left, stop, pieces, counts)
            return
        each = max(1, -(-count // room))
        cuts = [slice(i * each, (i + 1) * each) for i in range(room)]
        held = ["".join(pieces[own]) for own in cuts]
        self.changed.update(zip(range(left, stop + 1), held))
        self._set(left, [len(text) for text in held], [sum(counts[own]) for own in cuts])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows some at a time, so that few trees' leaves wait to be sent."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def read_ranks(path: str) -> bytes:
    """A rank file, read where the job is planned; it travels to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def edited_counts(
    docs: DataFrame,
    ranks: bytes,
    text: str = "text",
    edits: str = "edits",
    pattern: str = PATTERN,
    leaves: str | None = None,
    keep_leaves: bool = False,
    keep_text: bool = False,
) -> DataFrame:
    """The rows of ``docs`` without text and edits, with token counts before and after the edits.

    ``edits`` is an array of structs (start, stop, new), applied in turn; places are
    code points of the text as it is by then, clipped to it; null arrays, edits and
    fields mean none, 0 and ''. Null texts count as empty. Added: pre_tokens,
    tokens_before, tokens_after, chars_after, chars_read (what edits made it re-read);
    with ``keep_leaves`` also leaves, the packed leaves of the text before its edits (``unpacked`` reads them).
    Passing such a column as ``leaves`` continues from a stored tree without encoding the text again;
    ``keep_text`` keeps the text with it. Input columns named like an added one are replaced. Repeated
    rows are counted each; a task holds one text's tree at a time, of whatever length.
    """
    numbers = ("pre_tokens", "tokens_before", "tokens_after", "chars_after", "chars_read")
    gone = {edits, *([leaves] if leaves else []), *([] if keep_text else [text])}
    added = (*numbers, "leaves") if keep_leaves else numbers
    rest = [c for c in docs.columns if c not in gone and c.lower() not in added]
    schema = docs.select(*rest).schema
    for name in numbers:
        schema = schema.add(name, "long")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if keep_leaves:
        ddl += ", leaves binary"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks, pattern)
        for batch in _slices(batches):
            rows, kept = [], []
            stored = batch.column(leaves) if leaves else None
            for i, (value, changes) in enumerate(zip(batch.column(text), batch.column(edits))):
                known, value = stored[i].as_py() if leaves else None, value.as_py() or ""
                changes = [c for c in changes.as_py() or () if c is not None]
                first = unpacked(known) if known else counter.leaves(value)
                before = len(first[0]), int(first[1].sum())
                if keep_leaves:
                    kept.append(packed(*first))
                if not changes:  # no tree is asked for
                    rows.append((*before, before[1], int(first[0].sum()), 0))
                    continue
                tree = TokenTree(value, counter, first)
                for change in changes:
                    tree.edit(change["start"] or 0, change["stop"] or 0, change["new"] or "")
                rows.append((*before, tree.total, tree.chars[1], tree.read))
            columns = [batch.column(c) for c in rest]
            columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(numbers))]
            names = [*rest, *numbers]
            if keep_leaves:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "leaves"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    used = list(dict.fromkeys([*rest, text, edits, *([leaves] if leaves else [])]))
    return docs.select(*used).mapInArrow(counted, ddl)


def stored_trees(docs: DataFrame, ranks: bytes, text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """The rows of ``docs`` with the leaves of their texts' trees, written to the shared folder."""
    none = F.lit(None).cast("array<struct<start: int, stop: int, new: string>>")
    edits = free_name(docs.columns, "edits")
    counted = edited_counts(docs.withColumn(edits, none), ranks, text, edits, pattern, keep_leaves=True, keep_text=True)
    return written(counted.select(*[c for c in docs.columns if c != "leaves"], "leaves"))


def drawn_edits(doc_id: str, text: str, n: int = 4, longest: int = 40) -> Column:
    """n edits of a row by hashes of its id: each puts a stretch of the text in place of another."""
    length = F.coalesce(F.length(text), F.lit(0))

    def draw(i: Column, what: int, below: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(doc_id), i, F.lit(what)), below).cast("int")

    def one(i: Column, length: Column) -> Column:
        start = draw(i, 1, length + 1)
        new = F.substring(F.col(text), draw(i, 2, length + 1) + 1, draw(i, 3, F.lit(longest)))
        return F.struct(
            start.alias("start"),
            (start + draw(i, 4, F.lit(longest))).alias("stop"),
            F.coalesce(new, F.lit("")).alias("new"),
        )

    # as a lambda's variable the length is taken once a row
    return F.transform(F.array(length), lambda own: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: one(i, own)))[0]
