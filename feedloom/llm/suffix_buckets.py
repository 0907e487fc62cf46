"""Byte strings that an earlier document holds too, by bucket-pointer refinement of suffixes.

Every place of a text starts a suffix; what matters is its first ``width`` bytes, its window. Windows
are dealt by a q-gram of theirs, the one with the smallest hash: equal windows have equal ones,
and neighbours mostly share theirs, so a bucket gets stretches of windows (items), not single ones.

1. An item is known by its bucket and the hash of its bytes. Equal items are settled at once: all but
   those of the smallest document repeat it. A bucket with one kind of item is settled too.
2. Other buckets are refined: their items' bytes are fetched from the texts, suffixes are sorted into
   buckets of eight bytes, and buckets again by the bucket pointers of the suffixes 8, then 16, then 32
   bytes on, until ``width`` bytes are told apart. A suffix alone in its bucket, or leading to
   one, is settled and not sorted again.
3. Bytes under windows that a smaller document has go.

Items travel packed, a row for many of them, and equal ones of a task are settled before they travel.
Buckets that hold more than some millionths of all items (counted in a pass of its own) are not
used: their windows are items of their own under the hash of all their bytes, so that they spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.frames import written
from feedloom.llm.common import free_name, text_key

_SLICE = 1 << 19  # window starts hashed together; longer texts are cut, with the overlap they need
_HELD = 1 << 19  # items a task settles among themselves before they travel
_BUCKET_BYTES = 1 << 24  # bytes of text to a bucket
_REFINED = 1 << 21  # bytes refined together, and those of one more q-gram
_HOT_ITEMS, _HOT_SHARE = 20_000, 1e-5

_FLAGS = "d long, k long, lo long, n int"
_PACKED = "bucket int, settled boolean, d binary, k binary, items binary, name binary, sub binary, low binary, high binary, n binary"
_PACKED_NAMES = [c.split()[0] for c in _PACKED.split(", ")]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


class _Hashes:
    """Hashes of all stretches of some sizes, from those of half the size."""

    def __init__(self, data: np.ndarray):
        first = _mixed((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9))
        self.powers = [first]

    def _joined(self, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
        n = max(0, len(right) - size)
        return _mixed(left[:n] * np.uint64(0x94D049BB133111EB) + right[size : size + n])

    def of(self, size: int) -> np.ndarray:
        """One hash per place from which ``size`` bytes follow."""
        while 1 << len(self.powers) <= size:
            last = self.powers[-1]
            self.powers.append(self._joined(last, last, 1 << (len(self.powers) - 1)))
        found, done = None, 0
        for power in reversed(range(size.bit_length())):
            if size >> power & 1:
                part = self.powers[power]
                found = part if found is None else self._joined(found, part, done)
                done += 1 << power
        return found


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` values in a row."""
    step, now = 1, values
    while step * 2 <= span:
        now = np.minimum(now[: len(now) - step], now[step:])
        step *= 2
    rest = span - step
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def _gram(width: int) -> int:
    return max(1, width * 2 // 5)


def _slices(texts: list, width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, start, bytes) of whole texts or overlapping cuts of long ones, some at a time."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(0, len(text or b"") - width + 1), _SLICE):
            part = text[start : start + _SLICE + width - 1]
            held.append((i, start, part))
            size += len(part)
            if size >= _SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _items(slices: list[tuple[int, int, bytes]], width: int, hot: np.ndarray | None):
    """(text number, name, sub, lo, n): stretches of windows with equal smallest q-gram.

    name is that q-gram's hash and sub that of all bytes; lo the first window's place, n their number. Windows
    of hot names come alone, under the hash of their own bytes. Without ``hot`` sub is left out.
    """
    data = np.frombuffer(b"".join(s[2] for s in slices), np.uint8)
    hashes, gram = _Hashes(data), _gram(width)
    least = _least(hashes.of(gram), width - gram + 1)
    sizes = np.array([len(s[2]) for s in slices])
    begin = np.cumsum(sizes) - sizes
    fits = np.ones(len(data) + 1, bool)
    for at in (begin + sizes).tolist():
        fits[max(0, at - width + 1) : at] = False
    fits = fits[: len(least)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (fits[1:] != fits[:-1])
    starts = np.flatnonzero(new)
    # repeating bytes make long stretches; cut, they stay small
    span = np.diff(starts, append=len(least))
    most = width - gram + 1
    pieces = -(-span // most)
    first = np.repeat(starts, pieces)
    turn = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lo = first + turn * most
    n = np.diff(lo, append=len(least))
    real = fits[lo]
    lo, n = lo[real], n[real]
    which = np.searchsorted(begin, lo, side="right") - 1
    name = least[lo]
    if hot is None:
        return name
    whole = hashes.of(width)
    sub = _mixed(whole[lo] * np.uint64(3) + _mixed(whole[lo + n - 1] + n.astype(np.uint64)))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
        alone = hot[at] == name
        count = np.where(alone, n, 1)
        lo = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        n, which, name, sub, alone = (np.repeat(x, count) for x in (np.where(alone, 1, n), which, name, sub, alone))
        name = np.where(alone, whole[lo], name)
        sub = np.where(alone, np.uint64(0), sub)
    texts, offsets = np.array([s[0] for s in slices]), np.array([s[1] for s in slices])
    return texts[which], _mixed(name.copy()), sub, lo - begin[which] + offsets[which], n


def _hot_names(keyed: DataFrame, width: int) -> np.ndarray:
    """q-grams that stand for more than a given share of all items, sorted.

    Counted per task first; those that are rarer in every piece of every task are rarer in all. At
    most 1 / share of them, so the driver holds less than a megabyte.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def tell() -> pa.RecordBatch:
            name, often = np.unique(np.concatenate(held), return_counts=True)
            often_enough = often >= max(2, 0.75 * _HOT_SHARE * size)
            name = np.concatenate([name[often_enough].view(np.int64), [0]])
            often = np.concatenate([often[often_enough], [size]])
            total = np.zeros(len(name), bool)
            total[-1] = True
            return pa.RecordBatch.from_arrays([pa.array(name), pa.array(often), pa.array(total)], names=["name", "n", "total"])

        for batch in batches:
            for part in _slices(batch.column("t").cast(pa.binary()).to_pylist(), width):
                names = _items(part, width, None)
                held.append(names)
                size += len(names)
                if size >= _HELD:
                    yield tell()
                    held, size = [], 0
        if held:
            yield tell()

    sums = written(
        keyed.mapInArrow(counted, "name long, n long, total boolean").groupBy("total", "name").agg(F.sum("n").alias("n"))
    )
    items = sums.filter("total").agg(F.max("n")).first()[0] or 0
    most = max(_HOT_ITEMS, items * _HOT_SHARE)
    found = [r[0] for r in sums.filter(f"not total and n > {most}").select("name").collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def _settled(name: np.ndarray, sub: np.ndarray, d: np.ndarray):
    """Order by (name, sub, d), where each pair's group starts in it, and each row's group."""
    order = np.lexsort((d, sub, name))
    name, sub = name[order], sub[order]
    new = np.ones(len(order), bool)
    new[1:] = (name[1:] != name[:-1]) | (sub[1:] != sub[:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _packed(held: list, ids: np.ndarray, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Items of many texts as a row per bucket; those that an equal one of a smaller text settles apart."""
    text, name, sub, lo, n = (np.concatenate(c) for c in zip(*held))
    d = ids[text]
    order, starts, group = _settled(name, sub, d)
    later = np.empty(len(order), bool)
    later[order] = d[order] > d[order[starts]][group]
    bucket = ((name >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((text, bucket, later))
    text, name, sub, lo, n, later, bucket = (x[order] for x in (text, name, sub, lo, n, later, bucket))
    cut = np.flatnonzero(np.diff(later * buckets + bucket, prepend=-1))
    rows = []
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(text)]):
        own, count = np.unique(text[a:b], return_counts=True)
        gone = bool(later[a])
        rows.append(
            (
                int(bucket[a]),
                gone,
                ids[own].tobytes(),
                keys[own].tobytes(),
                count.astype(np.uint32).tobytes(),
                b"" if gone else name[a:b].astype(np.uint32).tobytes(),
                b"" if gone else sub[a:b].tobytes(),
                lo[a:b].astype(np.uint16).tobytes(),
                (lo[a:b] >> 16).astype(np.uint16).tobytes(),
                n[a:b].astype(np.uint8).tobytes() if n.max() < 256 else n[a:b].astype(np.uint32).tobytes(),
            )
        )
    types = [pa.int32(), pa.bool_(), *[pa.binary()] * 8]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_PACKED_NAMES)


def _unpacked(table: pa.Table) -> tuple:
    """(d, k, lo, n, name, sub) of all rows; name and sub are empty for settled ones."""

    def numbers(column: str, kind) -> list[np.ndarray]:
        return [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]

    count = numbers("items", np.uint32)
    low, high = (np.concatenate(numbers(c, np.uint16)).astype(np.int64) for c in ("low", "high"))
    n = [np.frombuffer(x, np.uint8 if len(x) == c.sum() else np.uint32) for x, c in zip(table.column("n").to_pylist(), count)]
    count = np.concatenate(count)
    d, k = (np.repeat(np.concatenate(numbers(c, np.int64)), count) for c in ("d", "k"))
    name, sub = np.concatenate(numbers("name", np.uint32)), np.concatenate(numbers("sub", np.uint64))
    return d, k, low | high << 16, np.concatenate(n).astype(np.int32), name, sub


_SETTLED = pa.schema([("d", pa.int64()), ("k", pa.int64()), ("lo", pa.int64()), ("n", pa.int32()), ("name", pa.int64())])


def _settle(table: pa.Table) -> pa.Table:
    """Items of a bucket that repeat an equal one (null name), and those to refine, under their name."""
    out, done = [], table.column("settled").to_numpy()
    if done.any():
        out.append((*_unpacked(table.filter(pa.array(done)))[:4], None))
    if not done.all():
        table = table.filter(pa.array(~done))
        bucket = table.column("bucket")[0].as_py()
        d, k, lo, n, name, sub = _unpacked(table)
        order, starts, group = _settled(name, sub, d)
        d, k, lo, n, name = (x[order] for x in (d, k, lo, n, name))
        later = d > d[starts][group]
        out.append((d[later], k[later], lo[later], n[later], None))
        # kinds of a name, by the smallest text of each
        kind_name, kind_d = name[starts], d[starts]
        first = np.flatnonzero(np.concatenate([[True], kind_name[1:] != kind_name[:-1]]))
        several = np.minimum.reduceat(kind_d, first) < np.maximum.reduceat(kind_d, first)
        kinds = np.diff(first, append=len(kind_name))
        open_ = ~later & np.repeat(several, kinds)[group]
        out.append((d[open_], k[open_], lo[open_], n[open_], (bucket << 32) + name[open_].astype(np.int64)))
    tables = [
        pa.table([*map(pa.array, x[:4]), pa.nulls(len(x[0]), pa.int64()) if x[4] is None else pa.array(x[4])], schema=_SETTLED)
        for x in out
    ]
    return pa.concat_tables(tables)


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Bucket pointers: equal keys get equal numbers from 0, keys that occur once -1."""
    _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(often[which] > 1, which, -1)


def refined(data: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """For every place a number of its first ``width`` bytes, -1 if no other place has them or they don't fit.

    ``ends``: for every place the end of its text.
    """
    places = np.arange(len(data))
    size = 1
    while size * 2 <= min(width, 8):
        size *= 2
    value = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    for i in range(size):
        value = value << np.uint64(8) | padded[i : i + len(data)]
    pointer = np.full(len(data), -1)
    live = np.flatnonzero(places + size <= ends)
    pointer[live] = _numbered(value[live])
    while size < width:
        step = min(size, width - size)
        live = np.flatnonzero((places + size + step <= ends) & (pointer >= 0))
        live = live[pointer[live + step] >= 0]  # leads to a settled one: settled
        found = np.full(len(data), -1)
        if len(live):
            found[live] = _numbered(pointer[live] * (pointer.max() + 1) + pointer[live + step])
        pointer = found
        size += step
    return pointer


def _refine(table: pa.Table, width: int) -> pa.Table:
    """Windows of items that a smaller text has too, as stretches. Some q-grams at a time."""
    name, d, k, lo = (table.column(c).to_numpy() for c in ("name", "d", "k", "lo"))
    blobs = table.column("bytes").to_pylist()
    order = np.argsort(name, kind="stable")
    size = np.array([len(b) for b in blobs])[order]
    new = np.concatenate([[True], np.diff(name[order]) != 0])
    piece = (np.cumsum(size) - size)[new] // _REFINED
    starts = np.flatnonzero(new)[np.concatenate([[True], np.diff(piece) != 0])]
    out = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        own = order[a:b]
        out.append(_repeats(d[own], k[own], lo[own], [blobs[i] for i in own.tolist()], width))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, list(_SETTLED)[:4])], schema=pa.schema(list(_SETTLED)[:4]))


def _repeats(d: np.ndarray, k: np.ndarray, lo: np.ndarray, blobs: list[bytes], width: int) -> tuple:
    """(d, k, lo, n) of the stretches of windows in some items that an item of smaller d has too."""
    size = np.array([len(b) for b in blobs])
    data = np.frombuffer(b"".join(blobs), np.uint8)
    end = np.cumsum(size)
    item = np.repeat(np.arange(len(size)), size)
    pointer = refined(data, end[item], width)
    live = np.flatnonzero(pointer >= 0)
    least = np.full(int(pointer.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, pointer[live], d[item[live]])
    gone = live[least[pointer[live]] < d[item[live]]]
    new = np.ones(len(gone), bool)
    new[1:] = (np.diff(gone) != 1) | (np.diff(item[gone]) != 0)
    new = np.flatnonzero(new)
    own = item[gone[new]]
    return d[own], k[own], lo[own] + gone[new] - (end - size)[own], np.diff(new, append=len(gone))


def repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 50
) -> DataFrame:
    """(d, k, lo, n): n windows from byte lo on that also start in a document of smaller id.

    d is the id (null: the largest), k the hash of the text. A stretch may be told twice, and
    rows that agree in id and text are told together. Equal ids are not smaller than each other.
    """
    if width < 2:
        raise ValueError("windows need at least two bytes")
    keyed = _keyed(docs, doc_id, text)
    total = keyed.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(16, -(-total // _BUCKET_BYTES))
    hot = _hot_names(keyed, width)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, keys, size, seen = [], [], [], 0, 0
        for batch in batches:
            for part in _slices(batch.column("t").cast(pa.binary()).to_pylist(), width):
                which, *rest = _items(part, width, hot)
                held.append((which + seen, *rest))
                size += len(which)
                if size >= _HELD:
                    columns = [np.concatenate([*c, batch.column(x).to_numpy()]) for c, x in ((ids, "d"), (keys, "k"))]
                    yield _packed(held, *columns, buckets)
                    held, size = [], 0
            ids.append(batch.column("d").to_numpy())
            keys.append(batch.column("k").to_numpy())
            seen += batch.num_rows
            if not held:
                ids, keys, seen = [], [], 0
        if held:
            yield _packed(held, np.concatenate(ids), np.concatenate(keys), buckets)

    packed = keyed.mapInArrow(dealt, _PACKED)
    settled = written(packed.groupBy("bucket").applyInArrow(_settle, _FLAGS + ", name long"))

    open_ = settled.filter("name is not null")
    wanted = open_.groupBy("d", "k").agg(F.collect_set(F.struct("lo", "n", "name")).alias("wanted"))

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("d", "k", "wanted")]
            texts = batch.column("t").cast(pa.binary()).to_pylist()
            rows = [
                (w["name"], d, k, w["lo"], t[w["lo"] : w["lo"] + w["n"] + width - 1])
                for t, d, k, all_wanted in zip(texts, *(c.to_pylist() for c in columns))
                for w in all_wanted
            ]
            if rows:
                types = [*[pa.int64()] * 4, pa.binary()]
                names = ["name", "d", "k", "lo", "bytes"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    parts = keyed.join(wanted, ["d", "k"]).mapInArrow(fetched, "name long, d long, k long, lo long, bytes binary")
    dealt_again = parts.groupBy(F.shiftright("name", 32).alias("bucket"))
    found = dealt_again.applyInArrow(lambda table: _refine(table, width), _FLAGS)
    return written(settled.filter("name is null").drop("name").union(found))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    last = F.lit(2**63 - 1)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), last).alias("d"), text_key(content).alias("k"), content.alias("t")
    )


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 50,
    kept: str = "kept",
    n_removed: str = "n_removed",
    n_spans: str = "n_spans",
) -> DataFrame:
    """The input rows with what is left of their text without bytes that documents of smaller id have too.

    Every byte under a window of ``width`` bytes that also starts in a document of smaller id goes; windows
    are judged on the input. ``kept``: the bytes that stay, in a row (a cut may divide a character);
    ``n_removed``: bytes that went; ``n_spans``: maximal stretches of them. A null text counts as empty and
    keeps nothing; texts shorter than ``width`` stay whole. A null id comes last, so that row
    gives way to all others; rows of equal id do not give way to each other. Repeated rows get the same result each;
    an empty table gives an empty one; long texts are cut with overlaps, so no window is missed.
    An input column named like a new one keeps its name, the new one gets underscores in front.
    """
    taken = list(docs.columns)
    new = []
    for wanted in (kept, n_removed, n_spans):
        new.append(free_name([*taken, *new], wanted))
    own = {c: free_name([*taken, *new], c) for c in ("row_d", "row_k", "row_spans")}
    d, k, spans = own.values()
    flags = repeated_windows(docs, doc_id, text, width)
    listed = flags.groupBy("d", "k").agg(F.collect_set(F.struct("lo", "n")).alias(spans))
    listed = listed.withColumnsRenamed({"d": f"{d}_", "k": f"{k}_"})
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.withColumns(
        {d: F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)), k: text_key(content)}
    )
    joined = keyed.join(listed, (F.col(d) == F.col(f"{d}_")) & (F.col(k) == F.col(f"{k}_")), "left")
    joined = joined.select(*taken, spans)
    at = taken.index(text)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(new[0], T.BinaryType()),
            T.StructField(new[1], T.LongType()),
            T.StructField(new[2], T.LongType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            told = batch.column(len(taken))
            cuts = [_cut(t or b"", s, width) for t, s in zip(texts, _stretches(told))]
            columns = [pa.array(c, t) for c, t in zip(zip(*cuts), (pa.binary(), pa.int64(), pa.int64()))] if cuts else []
            if columns:
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(taken)], *columns], names=[*taken, *new])

    return joined.mapInArrow(cut, schema)


def _stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """(lo, n) of each row, None where it has none."""
    flat = column.flatten()
    lo, n = (flat.field(c).to_numpy() for c in ("lo", "n"))
    size = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
    end = np.cumsum(size)
    for a, b in zip((end - size).tolist(), end.tolist()):
        yield (lo[a:b], n[a:b]) if b > a else None


def _cut(text: bytes, told: tuple[np.ndarray, np.ndarray] | None, width: int) -> tuple[bytes, int, int]:
    if told is None:
        return text, 0, 0
    order = np.argsort(told[0], kind="stable")
    start = told[0][order]
    end = np.maximum.accumulate(start + told[1][order] + width - 1)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    start, end = start[new], end[np.concatenate([new[1:], [True]])]
    left, at = [], 0
    for a, b in zip(start.tolist(), end.tolist()):
        left.append(text[at:a])
        at = b
    left.append(text[at:])
    return b"".join(left), int((end - start).sum()), len(start)
