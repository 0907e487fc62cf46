"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens fall into classes, whose number follows the vocabulary: each of the most frequent
tokens is one, all others go by the hash of their ending. Classes in a row make a group. The two tokens
before predict the next one's group g, then its class c among the group, then the token among its class,

    r = (R[class of a] + D[a]) C1 + (R[class of b] + D[b]) C2,
    s(g | a, b) = r . U[g] + top[g],    s(c | g, a, b) = r . Q[c] + bias[c],
    s(w | c, a, b) = r . S[w] + log share of w in c,

all normalised exactly, so that a token asks for some groups, classes and words, not for all
classes. Every common word has a row of D and of S; the other words of a class
share one, and the probability of their row goes by their counts. Parameters
are learned by noise-contrastive estimation in numpy, on all training documents: every task
trains on its rows, the tasks' parameters are averaged, and further rounds go on from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from feedloom.functions.frames import written

SINGLES, ENDINGS, WIDTH, NOISE, BATCH = 256, 512, 16, 16, 16_384
CLASSES = SINGLES + ENDINGS  # at least
WITHIN, CHUNK, BLOCK = 8, 262_144, 1024
GROUP = 32  # classes of a group; their numbers are whole multiples of it
END = b""  # no word is empty
_PIECE = 1 << 21  # bytes of text whose words are looked up at once


def endings_for(distinct: int) -> int:
    """Ending classes for so many distinct words: about their square root, ENDINGS at least."""
    return ENDINGS << max(0, round(np.log2(max(distinct, 1) / ENDINGS**2) / 2))


def ending_class(token: bytes, endings: int = ENDINGS) -> int:
    """The class of the last three bytes; an ending's words are dealt to more classes as these grow."""
    # four at least, so that no ending makes its class far larger than the others
    piece = crc32(token) % (endings // ENDINGS * 4)
    return SINGLES + crc32(token[-3:] + piece.to_bytes(4, "little")) % endings


def _ending_classes(tokens: list[bytes], endings: int) -> list[int]:
    """The same for many tokens."""
    n = endings // ENDINGS * 4
    tails = [piece.to_bytes(4, "little") for piece in range(n)]
    return [SINGLES + crc32(tails[crc32(token) % n], crc32(token[-3:])) % endings for token in tokens]


class Parameters:
    """R, C1, C2, Q and bias of the classes, U and top of the groups, as views of one vector."""

    size = CLASSES * (2 * WIDTH + 1) + 2 * WIDTH**2 + CLASSES // GROUP * (WIDTH + 1)  # for the least number of classes

    def __init__(self, flat: np.ndarray):
        per_group = GROUP * (2 * WIDTH + 1) + WIDTH + 1
        n_groups = (len(flat) - 2 * WIDTH**2) // per_group
        n_classes = n_groups * GROUP
        shapes = (
            (n_classes, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (n_classes, WIDTH), (n_classes,),
            (n_groups, WIDTH), (n_groups,),
        )
        self.flat, parts, at = flat, [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            parts.append(flat[at : at + n].reshape(shape))
            at += n
        self.R, self.C1, self.C2, self.Q, self.bias, self.U, self.top = parts
        self.C = flat[self.R.size : self.R.size + 2 * WIDTH**2].reshape(2 * WIDTH, WIDTH)  # C1 above C2

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 42) -> Parameters:
        """Small random vectors; the biases are log shares of each group and of classes in it."""
        n_groups = len(share) // GROUP
        size = len(share) * (2 * WIDTH + 1) + 2 * WIDTH**2 + n_groups * (WIDTH + 1)
        made = cls(np.random.default_rng(seed).normal(0, 0.1, size).astype(np.float32))
        made.C1[:], made.C2[:] = np.eye(WIDTH), np.eye(WIDTH)
        top = np.log(share.reshape(n_groups, GROUP).sum(1))
        made.top[:] = top
        made.bias[:] = np.log(share) - np.repeat(top, GROUP)
        return made


class Slots:
    """What has a row of D and S: first the rest of each class, then each common word.

    ``order`` lists the slots by class; those of class c are order[first[c]:first[c + 1]].
    """

    def __init__(self, class_of: np.ndarray, mass: np.ndarray, n_classes: int):
        self.class_of = class_of
        self.order = np.argsort(class_of, kind="stable")
        self.first = np.searchsorted(class_of[self.order], np.arange(n_classes + 1))
        # a class without mass has even shares of next to nothing
        mass = mass + 1e-9
        own = np.bincount(class_of, mass, n_classes)
        self.log_share = np.log(mass / own[class_of])
        self.until = np.cumsum(mass[self.order])
        self.below = np.concatenate(([0.0], self.until))[self.first]

    def noise(self, classes: np.ndarray, dice: np.random.Generator) -> np.ndarray:
        """WITHIN slots of each class, drawn by their shares."""
        low, high = self.below[classes], self.below[classes + 1]
        drawn = low[:, None] + dice.random((len(classes), WITHIN)) * (high - low)[:, None]
        at = np.searchsorted(self.until, drawn, side="right")
        return self.order[np.clip(at, self.first[classes][:, None], self.first[classes + 1][:, None] - 1)]


def contexts(slots: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots one and two tokens before each token of one text; ends before its start."""
    padded = np.concatenate(([end, end], slots))
    return padded[1:-1], padded[:-2]


def _add(target: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to the places of a table, summing those that share one."""
    order = _by_class(at, len(target))
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    target[at[order[first]]] += _run_sums(_rows(rows, order), first)


def _runs(first: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Runs of n things by their lengths, so that those of like length are one stack: which, the places of each, and
    1 where a place is its own (None: all are); runs are filled up to a power of two."""
    lengths = np.diff(first, append=n)
    rank = np.frexp(lengths - 0.5)[1]  # the least power of two that holds them
    for power in np.flatnonzero(np.bincount(rank)).tolist():
        which, steps = np.flatnonzero(rank == power), np.arange(1 << power)
        at = first[which][:, None] + steps
        yield which, np.minimum(at, n - 1), (steps < lengths[which][:, None]).astype(np.float32) if power else None


def _run_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each run; several times as fast as ``add.reduceat`` or a count per column."""
    sums = np.empty((len(first), rows.shape[1]), rows.dtype)
    for which, at, own in _runs(first, len(rows)):
        found = _rows(rows, at)
        sums[which] = found[:, 0] if own is None else np.einsum("ik,ikj->ij", own, found)
    return sums


def _run_products(left: np.ndarray, right: np.ndarray, first: np.ndarray) -> np.ndarray:
    """left' right for the rows of each run."""
    products = np.empty((len(first), left.shape[1], right.shape[1]), right.dtype)
    for which, at, own in _runs(first, len(left)):
        pushes = _rows(left, at) if own is None else _rows(left, at) * own[:, :, None]
        products[which] = np.matmul(pushes.transpose(0, 2, 1), _rows(right, at))
    return products


def _odds_against(scores: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(scores)); may overwrite these."""
    with np.errstate(over="ignore"):  # of an endless exp comes a 0, as it should
        np.exp(scores, out=scores)
    scores += 1
    return np.reciprocal(scores, out=scores)


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a table; several times as fast as an index."""
    return table.take(at, axis=0)


def _by_class(classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Places in the order of their classes; two bytes are sorted by digits."""
    return np.argsort(classes.astype(np.uint16 if n_classes <= 1 << 16 else np.int64), kind="stable")


class Rows:
    """Rows of D or S in training: few change in a step, and each counts how often it did."""

    def __init__(self, start: np.ndarray, rate: float):
        self.x, self.rate = start.astype(np.float32), rate
        self.grown, self.times = np.ones_like(self.x), np.zeros(len(self.x), np.float32)
        self.place = np.empty(len(self.x), np.int64)  # of a row among those of a step

    def add(self, at: np.ndarray, rows: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Step along the rows' sums by place; the places and these sums. A row counts once, or ``times``."""
        # of equal places the last one stands for all
        self.place[at] = np.arange(len(at))
        own = at[self.place[at] == np.arange(len(at))]
        self.place[own] = np.arange(len(own))
        which = self.place[at]
        order = _by_class(which, len(own))
        g = _run_sums(_rows(rows, order), np.flatnonzero(np.diff(which[order], prepend=-1)))
        grown = _rows(self.grown, own) + g**2
        self.grown[own] = grown
        self.x[own] = _rows(self.x, own) + self.rate * g / np.sqrt(grown)
        self.times[own] += np.bincount(which, times, len(own))
        return own, g


class Trainer:
    """Noise-contrastive estimation by Adagrad over batches of tokens.

    A batch shares its noise classes, so its scores are one matrix product. Without
    ``slots`` a token is its class; with them D and S are learned too.
    """

    def __init__(
        self,
        start: np.ndarray,
        share: np.ndarray,
        seed: int,
        rate: float = 0.1,
        slots: Slots | None = None,
        words: np.ndarray | None = None,
    ):
        self.p, self.share, self.rate = Parameters(start.astype(np.float32)), share, rate
        self.start = start, words
        self.top_share = share.reshape(-1, GROUP).sum(1)
        self.top_share /= self.top_share.sum()
        self.log_kp = np.log(NOISE * self.top_share).astype(np.float32)
        self.groups = Slots(np.arange(len(share)) // GROUP, share, len(self.top_share))
        self.grown = np.full(len(start), 1e-2, np.float32)
        self.dice, self.tokens = np.random.default_rng(seed), 0
        self.slots = slots
        if slots is not None:
            self.D, self.S = Rows(words[0], rate), Rows(words[1], rate)

    def _within(
        self, word: np.ndarray, classes: np.ndarray, r: np.ndarray, dr: np.ndarray, class_up: np.ndarray, g: Parameters
    ) -> None:
        """Learn S from the tokens, in class order, that do not fill their class; adds what r learns to dr.

        class_up: what tokens push their classes' rows of Q by; these rows' sums of r come from the same products.
        """
        begin = np.searchsorted(classes, SINGLES)
        _add(g.Q, classes[:begin], class_up[:begin, None] * r[:begin])
        word, own_class, r = word[begin:], classes[begin:], r[begin:]
        if not len(word):
            return
        first = np.flatnonzero(np.diff(own_class, prepend=-1))
        noise = self.slots.noise(own_class[first], self.dice)  # a class shares its noise in a batch
        own = _rows(self.S.x, word)
        other = np.repeat(_rows(self.S.x, noise), np.diff(np.append(first, len(word))), axis=0)
        # shares are both the noise and the bias, so only their number is left
        up = _odds_against(np.einsum("ij,ij->i", r, own) - np.float32(np.log(WITHIN)))
        down = -_odds_against(np.float32(np.log(WITHIN)) - np.einsum("ij,ikj->ik", r, other))
        dr[begin:] += up[:, None] * own + np.einsum("ik,ikj->ij", down, other)
        pushes = np.column_stack((down, class_up[begin:]))
        pushed = _run_products(pushes, r, first)
        g.Q[own_class[first]] += pushed[:, WITHIN]
        self.S.add(
            np.concatenate((word, noise.ravel())),
            np.concatenate((up[:, None] * r, pushed[:, :WITHIN].reshape(-1, WIDTH))),
        )

    def _in_group(
        self, word: np.ndarray, r: np.ndarray, dr: np.ndarray, group_up: np.ndarray, g: Parameters
    ) -> np.ndarray:
        """Learn the classes, which are in order, among their groups; adds what r learns to dr.

        group_up: what tokens push their groups' rows of U by. Returns the like for classes, whose own rows of Q are
        left to the caller.
        """
        group = word // GROUP
        first = np.flatnonzero(np.diff(group, prepend=-1))
        noise = self.groups.noise(group[first], self.dice)  # a group shares its noise in a batch
        odds = (self.p.bias - self.groups.log_share - np.log(WITHIN)).astype(np.float32)
        own = _rows(self.p.Q, word)
        up = _odds_against(np.einsum("ij,ij->i", r, own) + odds[word])
        dr += up[:, None] * own
        other, ends = _rows(self.p.Q, noise), [*first.tolist(), len(word)]
        down = np.repeat(odds[noise], np.diff(ends), axis=0)
        for low, high, drawn in zip(ends[:-1], ends[1:], other):
            down[low:high] += np.dot(r[low:high], drawn.T)
        down = -_odds_against(-down)
        pushed, pushes = np.empty((len(first), WITHIN + 1, WIDTH), np.float32), np.column_stack((down, group_up))
        for low, high, drawn, out in zip(ends[:-1], ends[1:], other, pushed):
            dr[low:high] += np.dot(down[low:high], drawn)
            np.dot(pushes[low:high].T, r[low:high], out=out)
        g.U[group[first]] += pushed[:, WITHIN]
        _add(g.Q, noise.ravel(), pushed[:, :WITHIN].reshape(-1, WIDTH))
        g.bias += np.bincount(noise.ravel(), np.add.reduceat(down, first, axis=0).ravel(), len(self.share))
        g.bias += np.bincount(word, up, len(self.share))
        return up

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        p, g, slots = self.p, Parameters(np.zeros(len(self.p.flat), np.float32)), self.slots
        noise = self.dice.choice(len(self.top_share), NOISE, p=self.top_share)
        # groups are classes in a row, so that one order serves both
        order = _by_class(word if slots is None else slots.class_of[word], len(self.share))
        # a token is the one before its next and mostly the second before the one after that: what both teach is one row
        again = two[1:] == one[:-1]
        alone = np.flatnonzero(np.concatenate(([True], ~again)))
        at, times = np.concatenate((one, two[alone])), np.ones(len(one) + len(alone))
        times[: len(again)] += again
        word, before = word[order], np.column_stack((one, two))[order]
        target_slot = word
        if slots is None:
            ab = _rows(p.R, before)
        else:
            word = slots.class_of[word]
            ab = _rows(p.R, slots.class_of[before])
            ab += _rows(self.D.x, before)
        ab = ab.reshape(len(word), -1)
        r = ab @ p.C
        group = word // GROUP
        target, odds = _rows(p.U, group), p.top - self.log_kp
        data = np.einsum("ij,ij->i", r, target) + odds[group]
        other = r @ p.U[noise].T + odds[noise]
        up = _odds_against(data)
        down = -_odds_against(-other)
        dr = up[:, None] * target + down @ p.U[noise]
        class_up = self._in_group(word, r, dr, up, g)
        if slots is None:
            _add(g.Q, word, class_up[:, None] * r)
        else:
            self._within(target_slot, word, r, dr, class_up, g)
        np.add.at(g.U, noise, down.T @ r)
        g.top += np.bincount(group, up, len(self.top_share))
        np.add.at(g.top, noise, down.sum(0))
        g.C += ab.T @ dr
        both = np.empty((len(word), 2 * WIDTH), np.float32)
        both[order] = dr @ p.C.T
        rows = np.concatenate((both[:, :WIDTH], both[alone, WIDTH:]))
        rows[: len(again)] += both[1:, WIDTH:] * again[:, None]
        if slots is not None:
            at, rows = self.D.add(at, rows, times)
            at = slots.class_of[at]
        _add(g.R, at, rows)
        g.flat /= len(word)
        self.grown += g.flat**2
        p.flat += self.rate * g.flat / np.sqrt(self.grown)
        self.tokens += len(word)


class _Normalisers:
    """Log normalisers of every class after a and b: of its group and of the classes in it."""

    def __init__(self, p: Parameters):
        self.p = p

    def __getitem__(self, places: tuple[int, int]) -> np.ndarray:
        p = self.p
        r = p.R[places[0]] @ p.C1 + p.R[places[1]] @ p.C2
        inside = np.exp(p.Q @ r + p.bias).reshape(-1, GROUP).sum(1)
        return np.repeat(np.log(np.exp(p.U @ r + p.top).sum()) + np.log(inside), GROUP)


def log_probabilities(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Normalisers]:
    """Score tables of classes A1[a, c] (biases included) and A2[b, c], and log normalisers Z[a, b].

    For contexts without rows of their own.
    """
    p = Parameters(flat)
    score = p.Q + np.repeat(p.U, GROUP, axis=0)
    one = p.R @ p.C1 @ score.T + p.bias + np.repeat(p.top, GROUP)
    return one.astype(np.float32), (p.R @ p.C2 @ score.T).astype(np.float32), _Normalisers(p)


@lru_cache(maxsize=4096)
def _ones(n: int, kind: np.dtype) -> np.ndarray:
    return np.ones(n, kind)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    """Log of the rows' sums of exp(scores); may overwrite these."""
    with np.errstate(over="ignore"):
        sums = np.exp(scores) @ _ones(scores.shape[1], scores.dtype)
    if 1e-30 < sums.min() and sums.max() < 1e37:
        return np.log(sums).astype(float)
    top = scores.max(1)
    scores -= top[:, None]
    return np.log(np.exp(scores, out=scores).sum(1)).astype(float) + top


def log_likelihoods(
    flat: np.ndarray, words: np.ndarray, slots: Slots, word: np.ndarray, one: np.ndarray, two: np.ndarray
) -> np.ndarray:
    """Log probability of each slot ``word`` after the slots ``two`` and ``one``."""
    p, (D, S) = Parameters(flat), words
    found = np.empty(len(word))
    # the bias as a last component, for which contexts have a one
    to_group = np.column_stack((p.U, p.top)).T.copy()
    to_class = np.column_stack((p.Q, p.bias)).T.copy()
    to_word = np.column_stack((S, slots.log_share))[slots.order].astype(np.float32)
    # what a slot adds to r one and two tokens on; a token's own score for its group and class
    before = _rows(p.R, slots.class_of) + D
    after_one, after_two = before @ p.C1, before @ p.C2
    to_own, own_bias = p.Q + np.repeat(p.U, GROUP, axis=0), p.bias.astype(float) + np.repeat(p.top, GROUP)
    # a piece with one more text is not cut
    for i in range(0, len(word), 2 * CHUNK):
        c = slots.class_of[word[i : i + 2 * CHUNK]]
        # all tokens of a class, and so of a group, stand together
        order = _by_class(c, len(p.bias))
        c, (w, a, b) = c[order], [x[i : i + 2 * CHUNK][order] for x in (word, one, two)]
        g = c // GROUP
        r1 = np.ones((len(w), WIDTH + 1), np.float32)
        r = r1[:, :WIDTH]
        np.add(_rows(after_one, a), _rows(after_two, b), out=r)
        log_p = np.einsum("ij,ij->i", r, _rows(to_own, c)) + own_bias[c]
        for j in range(0, len(w), 2048):
            log_p[j : j + 2048] -= _log_sum(r1[j : j + 2048] @ to_group)
        bounds = np.flatnonzero(np.diff(g, prepend=-1, append=-1)).tolist()
        for low, high in zip(bounds[:-1], bounds[1:]):
            vectors = to_class[:, g[low] * GROUP : (g[low] + 1) * GROUP]
            for j in range(low, high, 4096):
                k = min(j + 4096, high)
                log_p[j:k] -= _log_sum(r1[j:k] @ vectors)
        begin = np.searchsorted(c, SINGLES)
        log_p[begin:] += np.einsum("ij,ij->i", r[begin:], _rows(S, w[begin:])) + slots.log_share[w[begin:]]
        bounds = (begin + np.flatnonzero(np.diff(c[begin:], prepend=-1, append=-1))).tolist()
        for low, high in zip(bounds[:-1], bounds[1:]):
            own = c[low]
            vectors = to_word[slots.first[own] : slots.first[own + 1]].T
            # a frequent class is cut too, so that the scores of a piece stay small
            piece = max(1, 250_000 // vectors.shape[1])
            for j in range(low, high, piece):
                k = min(j + piece, high)
                log_p[j:k] -= _log_sum(r1[j:k] @ vectors)
        found[i + order] = log_p
    return found


def _packed(words: np.ndarray) -> bytes:
    """Rows of D and S as they travel to tasks."""
    return compress(words.tobytes(), 1)


def _unpacked(sent: bytes) -> np.ndarray:
    return np.frombuffer(decompress(sent), np.float16).reshape(2, -1, WIDTH)


def _slot_bytes(slots: np.ndarray) -> bytes:
    """Two low bytes of each slot, then the high ones, which are mostly alike."""
    return (slots & 0xFFFF).astype(np.uint16).tobytes() + (slots >> 16).astype(np.uint16).tobytes()


def _slots_from(sent: bytes) -> np.ndarray:
    low, high = np.frombuffer(sent, np.uint16).astype(np.int64).reshape(2, -1)
    return low + (high << 16)


def _cut(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``most`` in all, a row at least."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=0)).tolist()
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        if high > low:
            yield batch.slice(low, high - low)


def _texts(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``most`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        yield from _cut(batch, sizes.astype(np.int64), most)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, cut and in lower case as ``lower_words`` does it, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = lists.flatten().cast(pa.binary()), lists.value_lengths().to_numpy().astype(np.int64)
    # of white space at an end, and of no words, come empty ones
    some = pc.binary_length(words).to_numpy() > 0
    if not some.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[some], minlength=len(sizes))
        words = words.filter(pa.array(some))
    return words, sizes


def _token_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, c) of all tokens, ends included; every task sends each word once or a few times."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _texts(batches, text, 4 * _PIECE):
            found = word_lists(piece.column(text))[0].value_counts()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())]),
                    pa.concat_arrays([found.field("counts"), pa.array([piece.num_rows], pa.int64())]),
                ],
                names=["word", "c"],
            )

    sent = texts.select(text).mapInArrow(counted, "word binary, c long")
    return sent.groupBy("word").agg(F.sum("c").alias("c"))


def _frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words of the highest counts and their counts, at most ``most``, in falling order.

    Counts are put into buckets of a sixteenth of a power of two; the words of the
    top buckets are taken as long as all of them fit, so no sort is needed.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 16)
    taken, least = 0, None
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    for row in sorted(sizes, key=lambda r: -r.step):  # a thousand rows at most
        taken += row.n
        if taken > most:
            break
        least = row.step
    if least is None:
        return {}
    rows = counts.filter(step >= least).collect()  # at most ``most`` rows
    found = [(bytes(r.word), r.c) for r in rows]
    return dict(sorted(found, key=lambda x: (-x[1], x[0])))


def _class_mass(counts: DataFrame, singles: dict[bytes, int], endings: int) -> np.ndarray:
    """Training tokens of each class."""
    n_classes = SINGLES + endings

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(n_classes, np.int64)
        for batch in batches:
            words = batch.column("word").to_pylist()
            at = [singles.get(w, own) for w, own in zip(words, _ending_classes(words, endings))]
            np.add.at(mass, at, batch.column("c").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n_classes), pa.int32()), pa.array(mass)], names=["class", "mass"]
        )

    rows = counts.mapInArrow(summed, "class int, mass long").groupBy("class").agg(F.sum("mass"))
    found = np.zeros(n_classes)
    for row in rows.toLocalIterator():  # one row per class
        found[row[0]] = row[1]
    return found


def _encoded(docs: DataFrame, text: str, common: dict[bytes, float], endings: int) -> DataFrame:
    """Texts as slots: n, slots (two low and two high bytes each), the words that are not common and their places.

    common: log10(c + 0.5) of the frequent words in the order of their slots; base is its
    sum over a text's common words.
    """
    n_classes = SINGLES + endings
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema
    for name, kind in (
        ("n", "long"), ("n_common", "long"), ("base", "double"),
        ("slots", "binary"), ("rare", ArrayType(BinaryType())), ("places", ArrayType(IntegerType())),
    ):
        schema = schema.add(name, kind)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, end = pa.array(common, pa.binary()), pa.array([END], pa.binary())
        base = np.array([*common.values(), 0.0])  # the last one for words that are not common
        for batch in _texts(batches, text, _PIECE):
            words, sizes = word_lists(batch.column(text))
            sizes = sizes + 1
            begins = np.concatenate(([0], np.cumsum(sizes)))
            words = pa.concat_arrays([words, end])
            which = np.full(begins[-1], len(words) - 1)  # of every token, the word
            is_word = np.ones(len(which), bool)
            is_word[begins[1:] - 1] = False
            which[is_word] = np.arange(len(words) - 1)
            at = pc.fill_null(pc.index_in(words, value_set=index), -1).to_numpy()[which]
            rare_at = np.flatnonzero(at < 0)
            rare = words.take(pa.array(which[rare_at]))
            own = at.astype(np.int64) + n_classes
            own[rare_at] = _ending_classes(rare.to_pylist(), endings)
            first = np.searchsorted(rare_at, begins)
            offsets = pa.array(first, pa.int32())
            places = rare_at - np.repeat(begins[:-1], np.diff(first))
            made = [
                pa.array(sizes, pa.int64()),
                pa.array(sizes - np.diff(first), pa.int64()),
                pa.array(np.add.reduceat(base[at], begins[:-1])),
                pa.array([_slot_bytes(own[low:high]) for low, high in zip(begins[:-1], begins[1:])], pa.binary()),
                pa.ListArray.from_arrays(offsets, rare),
                pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + made,
                names=[*rest, "n", "n_common", "base", "slots", "rare", "places"],
            )

    return docs.select(*rest, text).mapInArrow(encoded, schema)


def _sent(trainer: Trainer) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """A task's changes as (block, places, weights, values); of D and S the changed rows only."""
    yield -1, np.zeros(1, np.int32), np.array([trainer.tokens], np.float32), trainer.p.flat - trainer.start[0]
    for part, rows in enumerate((trainer.D, trainer.S)):
        for low in range(0, len(rows.x), BLOCK):
            at = low + np.flatnonzero(rows.times[low : low + BLOCK])
            if len(at):
                places = (part * len(rows.x) + at).astype(np.int32)
                yield part * (1 << 24) + low // BLOCK, places, rows.times[at], rows.x[at] - trainer.start[1][part][at]


_SENT = "block int, places binary, weights binary, rows binary"


def _message(block: int, places: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    # changes are small numbers, for which half precision is enough
    values = (block, places.tobytes(), weights.tobytes(), rows.astype(np.float16).tobytes())
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds)], names=["block", "places", "weights", "rows"]
    )


def _mean(messages: pa.Table) -> pa.Table:
    """The weighted mean change of each place of a block, over the tasks that sent it."""
    kinds = {"places": np.int32, "weights": np.float32, "rows": np.float16}
    sent = [[np.frombuffer(x.as_py(), k) for x in messages.column(c)] for c, k in kinds.items()]
    places = np.unique(np.concatenate(sent[0]))
    width = len(sent[2][0]) // len(sent[0][0])
    total, weight = np.zeros((len(places), width)), np.zeros(len(places))
    for own, times, rows in zip(*sent):
        at = np.searchsorted(places, own)  # a task sends a place once
        total[at] += times[:, None].astype(float) * rows.reshape(-1, width)
        weight[at] += times
    block = messages.column("block")[0].as_py()
    return pa.Table.from_batches([_message(block, places, weight.astype(np.float32), total / weight[:, None])])


def _trained(
    encoded: DataFrame, share: np.ndarray, slots: Slots, end: int, rounds: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Parameters of classes and slots after one pass over all rows, averaged over tasks after each round.

    Rows fall into sum(rounds) folds by a hash; a round takes the next of its folds, the
    first ones few, so that tasks part from a common, already useful model. A row of D or S
    is averaged over the tasks that changed it, by how often they did.
    """
    flat, folds, done = Parameters.start(share).flat, sum(rounds), 0
    words = np.zeros((2, len(slots.class_of), WIDTH), np.float16)
    for number, take in enumerate(rounds):
        start = flat, _packed(words)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # large blocks that were freed once make the allocator keep the work arrays of all steps
            np.empty(1 << 25, np.int8)
            trainer = Trainer(start[0], share, 42 + number, 0.2, slots, _unpacked(start[1]))
            kept, held = [], 0

            def learn() -> None:
                rows, i = [np.concatenate(x) for x in zip(*kept)], 0
                while i < len(rows[0]):
                    # small steps at first, so that little text makes many of them too
                    n = min(BATCH, max(256, trainer.tokens // 16))
                    trainer.step(*(x[i : i + n] for x in rows))
                    i += n

            for batch in batches:
                for value in batch.column("slots"):
                    own = _slots_from(value.as_py())
                    kept.append((own, *contexts(own, end)))
                    held += len(own)
                    if held >= BATCH:
                        learn()
                        kept, held = [], 0
            if held:
                learn()
            if trainer.tokens:
                for message in _sent(trainer):
                    yield _message(*message)

        fold = F.pmod(F.xxhash64(F.lit("fold"), "rid"), F.lit(folds))
        rows = encoded.filter((fold >= done) & (fold < done + take)).select("slots")
        means = rows.mapInArrow(task, _SENT).groupBy("block").applyInArrow(_mean, _SENT)
        words = words.copy()
        for row in means.toLocalIterator():  # as many rows as blocks
            if row.block < 0:
                flat = flat + np.frombuffer(row.rows, np.float16)
            else:
                at = np.frombuffer(row.places, np.int32)
                words.reshape(-1, WIDTH)[at] += np.frombuffer(row.rows, np.float16).reshape(-1, WIDTH)
        done += take
    return flat, words


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about a chunk of tokens, a row at least."""
    for batch in batches:
        yield from _cut(batch, pc.binary_length(batch.column("slots")).to_numpy() // 4, CHUNK)


def _scored(
    encoded: DataFrame, flat: np.ndarray, words: np.ndarray, slots: Slots, rest: np.ndarray, end: int
) -> DataFrame:
    """(rid, log10, rare): log10 of common tokens, and of each rare word's slot per training token in it.

    rest: training tokens of the rest of each class.
    """
    log10_rest, sent = np.log10(np.maximum(rest, 1.0)), _packed(words)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.empty(1 << 25, np.int8)  # as in training
        vectors = _unpacked(sent).astype(np.float32)
        for batch in _pieces(batches):
            texts = [_slots_from(v.as_py()) for v in batch.column("slots")]
            before = [contexts(own, end) for own in texts]
            word = np.concatenate(texts)
            one, two = (np.concatenate(x) for x in zip(*before))
            found = log_likelihoods(flat, vectors, slots, word, one, two) / np.log(10)
            begins = np.cumsum([0, *[len(own) for own in texts]])
            sizes = batch.column("rare").value_lengths().to_numpy()
            text = np.repeat(np.arange(len(texts)), sizes)
            at = begins[text] + batch.column("places").flatten().to_numpy()
            # a text's rare words, each once
            listed = batch.column("rare").flatten().dictionary_encode()
            key = text * max(1, len(listed.dictionary)) + listed.indices.to_numpy()
            _, first, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            each = np.bincount(which, found[at] - log10_rest[word[at]], len(first))
            found[at] = 0.0
            sums = np.add.reduceat(found, begins[:-1])
            rares = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text[first], np.arange(len(texts) + 1)), pa.int32()),
                pa.StructArray.from_arrays(
                    [listed.dictionary.take(listed.indices.take(pa.array(first))), pa.array(times, pa.int64()), pa.array(each)],
                    names=["word", "times", "log10"],
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(sums, pa.float64()), rares], names=["rid", "log10", "rare"]
            )

    return encoded.select("rid", "slots", "rare", "places").mapInArrow(
        scored, "rid long, log10 double, rare array<struct<word: binary, times: bigint, log10: double>>"
    )


def scores(
    docs: DataFrame,
    training: str,
    text: str = "text",
    common_words: int = 131_072,
    rounds: tuple[int, ...] = (1, 3, 12),
) -> DataFrame:
    """The rows of ``docs`` without their text, with counts and scores of the whole text.

    ``training`` is a boolean column; the model learns from all rows where it is
    true. Tokens are lower-case words and one end. Columns added: n_tokens,
    n_known, train_tokens, base_score (a smoothed unigram) and score (log10 of the text's
    probability), in place of input columns of these names; all others stay whatever their names.
    Repeated rows count as often as they come; of equally frequent words the first by bytes is taken first. A token never seen in training has the Good-Turing share
    of unseen tokens. Null and empty texts are an end alone; without
    training rows every token is certain to be unknown.
    Counts are exact and cover all words: the most frequent ones, ``common_words`` at most, travel
    to the tasks and have vectors of their own, the others are looked up by a join on the word.
    """
    counts = written(_token_counts(docs.filter(F.col(training)), text))
    total, distinct, once = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1)
    ).first()
    unseen = min(0.5, (once + 0.5) / (total + 1)) if total else 1.0
    words = _frequent(counts, common_words)
    singles = [END, *[w for w in words if w != END][: SINGLES - 1]]
    single_class = {w: i for i, w in enumerate(singles)}
    endings = endings_for(distinct)
    n_classes = SINGLES + endings
    mass = _class_mass(counts, single_class, endings)
    share = (mass + 0.5) / (mass + 0.5).sum()
    classes = [single_class[w] if w in single_class else ending_class(w, endings) for w in words]
    class_of = np.array([*range(n_classes), *classes], np.int64)
    own = np.array([*words.values()], float)
    rest_mass = np.maximum(mass - np.bincount(class_of[n_classes:], own, n_classes), 0.0)
    slots = Slots(class_of, np.concatenate((rest_mass, own)), n_classes)
    common = {w: float(np.log10(c + 0.5)) for w, c in words.items()}
    end = n_classes + list(words).index(END) if END in words else single_class[END]
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    row = F.struct(*[c for c in docs.columns if c != text and c.lower() not in added])
    slim = docs.select(row.alias("row"), F.col(training).alias("training"), F.col(text).alias("text"))
    encoded = written(_encoded(slim, "text", common, endings).withColumn("rid", F.monotonically_increasing_id()))
    learning = encoded.filter("training")
    flat, vectors = _trained(learning, share, slots, end, rounds)
    partial = written(_scored(encoded, flat, vectors, slots, rest_mass, end))

    asked = partial.select("rid", F.inline("rare"))
    looked = (
        asked.join(counts, "word", "left")
        .select(
            "rid",
            F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("known"),
            (F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("base"),
            F.when(F.col("c") > 0, F.col("log10") + F.col("times") * F.log10("c"))
            .otherwise(0.0)
            .alias("seen"),
        )
        .groupBy("rid")
        .agg(*[F.sum(c).alias(f"rare_{c}") for c in ("known", "base", "seen")])
    )
    joined = encoded.drop("slots", "rare", "places").join(partial.drop("rare"), "rid").join(
        looked, "rid", "left"
    )
    zero = F.lit(0.0)
    known = F.col("n_common") + F.coalesce("rare_known", F.lit(0))
    log_unseen = float(np.log10(unseen))
    log_known = float(np.log10(1 - unseen)) if total else 0.0
    score = (
        F.col("log10") + F.coalesce("rare_seen", zero)
        + known * log_known + (F.col("n") - known) * log_unseen
    )
    per_token = float(np.log10(total + 0.5 * (distinct + 1)))
    base = F.col("base") + F.coalesce("rare_base", zero) - F.col("n") * per_token
    return joined.select(
        "row.*",
        F.col("n").alias("n_tokens"),
        known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
