"""The language model and the toxicity classifier."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, documents, fully, odd_rows, prose, words

from feedloom.llm import language_model as lm
from feedloom.llm import toxicity
from feedloom.llm.common import lower_words
from pyspark.sql import functions as F


def trained_on(docs):
    return docs.withColumn("training", F.col("doc_id") % 5 != 1)


def test_counts_and_base_scores_match_a_plain_version(spark):
    texts = [prose(i, 40, 200) for i in range(30)] + [None, "", "A a B b", "never seen words", "Été ÉTÉ"]
    rows = fully(lm.scores(trained_on(documents(spark, texts)), "training", common_words=50))
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in tokens.items() if i % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), n)
        assert r["n_known"] == sum(w in counts for w in own)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert r["base_score"] == pytest.approx(base)


def test_words_looked_up_by_a_join_score_alike(spark):
    """Without training rounds the model is the classes' shares: the score can be told by hand."""
    texts = [prose(i, 60, 400) for i in range(25)]
    docs = documents(spark, [*texts, "w1 unseen w2", "unseen"]).withColumn("training", F.col("doc_id") < 25)
    few, many = (
        {r["doc_id"]: r["score"] for r in fully(lm.scores(docs, "training", common_words=n, rounds=()))}
        for n in (300, 10_000)
    )
    assert few == pytest.approx(many, abs=1e-5)
    counts = Counter(w for t in texts for w in [*words(t), ""])
    n, once = sum(counts.values()), sum(c == 1 for c in counts.values())
    unseen = min(0.5, (once + 0.5) / (n + 1))
    share_of_end = counts[""] / n
    assert few[26] == pytest.approx(math.log10(unseen) + math.log10(share_of_end * (1 - unseen)), abs=0.15)


def test_tables_are_normalised():
    flat = np.random.default_rng(1).normal(0, 0.5, lm.Parameters.size).astype(np.float32)
    one, two, z = lm.log_probabilities(flat)
    for a, b in ((0, 0), (3, 700), (767, 5)):
        assert np.exp(one[a] + two[b] - z[a, b]).sum() == pytest.approx(1, abs=1e-4)


def test_training_beats_the_unigram_on_held_out_texts(spark):
    """A language in which each word has three followers only."""
    dice = random.Random(1)
    follow = {w: [dice.randrange(120) for _ in range(3)] for w in range(120)}

    def text():
        w, out = dice.randrange(120), []
        for _ in range(300):
            out.append(f"w{w}")
            w = dice.choice(follow[w])
        return " ".join(out)

    docs = trained_on(documents(spark, [text() for _ in range(150)]).coalesce(1))
    held = [r for r in fully(lm.scores(docs, "training")) if not r["training"]]
    base, score = (sum(r[c] for r in held) / sum(r["n_tokens"] for r in held) for c in ("base_score", "score"))
    assert score > base + 0.2


def test_words_of_one_class_have_their_own_followers(spark):
    """Forty words of one ending, each with its own follower of another ending, among 300 more frequent words."""
    dice = random.Random(2)

    def text():
        out = []
        for _ in range(60):
            i = dice.randrange(40)
            out += [*(f"f{dice.randrange(300)}" for _ in range(9)), f"a{i}ing", f"b{i}ion"]
        return " ".join(out)

    learned = [*(text() for _ in range(250)), *(" ".join(f"f{i}" for i in range(300)) for _ in range(300))]
    pairs = [(i, (i + k) % 40) for k in (0, 7) for i in range(40)]
    docs = documents(spark, [*learned, *(f"f1 f2 a{i}ing b{j}ion" for i, j in pairs)])
    docs = docs.withColumn("training", F.col("doc_id") < len(learned)).coalesce(1)
    found = {r["doc_id"] - len(learned): r["score"] for r in fully(lm.scores(docs, "training", rounds=(1, 2)))}
    right, wrong = (sum(found[i + k] for i in range(40)) / 40 for k in (0, 40))
    assert right > wrong + 0.5


def test_slots_are_normalised_and_classes_follow_the_vocabulary():
    dice = np.random.default_rng(3)
    class_of = np.concatenate((np.arange(lm.CLASSES), dice.integers(256, lm.CLASSES, 3000), np.arange(256)))
    slots = lm.Slots(class_of, dice.integers(1, 50, len(class_of)) * (np.arange(len(class_of)) >= 256.0), lm.CLASSES)
    flat = dice.normal(0, 0.5, lm.Parameters.size).astype(np.float32)
    words = dice.normal(0, 0.5, (2, len(class_of), lm.WIDTH)).astype(np.float32)
    every = np.flatnonzero((class_of >= 256) | (np.arange(len(class_of)) >= 256))
    log_p = lm.log_likelihoods(flat, words, slots, every, np.full(len(every), 900), np.full(len(every), 5))
    assert np.exp(log_p).sum() == pytest.approx(1, abs=1e-3)
    drawn = slots.noise(np.repeat([300, 767], 500), dice)
    assert {*class_of[drawn[:500]].ravel()} == {300} and {*class_of[drawn[500:]].ravel()} == {767}
    assert [lm.endings_for(n) for n in (0, 1000, 2**18, 2**20, 2**24)] == [512, 512, 512, 1024, 4096]
    assert max(lm.ending_class(f"w{i}ing".encode(), 4096) for i in range(99)) < 256 + 4096
    assert len({lm.ending_class(f"w{i}ing".encode(), 4096) for i in range(999)}) == 32


def test_gradients_raise_the_odds_of_what_was_seen():
    share = np.full(lm.CLASSES, 1 / lm.CLASSES)
    trainer = lm.Trainer(lm.Parameters.start(share).flat, share, 1, 0.2)
    word, one, two = (np.full(512, c) for c in (7, 3, 4))
    for _ in range(200):
        trainer.step(word, one, two)
    a, b, z = lm.log_probabilities(trainer.p.flat)
    log_p = a[3] + b[4] - z[3, 4]
    assert log_p.argmax() == 7 and log_p[7] > math.log(20 / lm.CLASSES)


def test_language_model_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark).withColumn("training", F.coalesce(F.col("doc_id") != 5, F.lit(True)))
    for name in ("n", "rid", "base", "slots", "log10", "c", "row", "score"):
        docs = docs.withColumn(name, F.lit("clash"))
    rows = fully(lm.scores(docs, "training"))
    assert len(rows) == docs.count() and all(math.isfinite(r["score"]) for r in rows)
    assert {(r["n"], r["rid"], r["base"], r["c"], r["row"]) for r in rows} == {("clash",) * 5}
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    untrained = fully(lm.scores(docs.withColumn("training", F.lit(False)), "training"))
    assert {(r["n_known"], r["train_tokens"], r["score"]) for r in untrained} == {(0, 0, 0.0)}
    assert lm.scores(docs.limit(0), "training").count() == 0


def toxic_docs(spark, n=300, group="", share=0.5):
    """Texts of which every third holds insults; the toxic ones name a group more often."""
    dice = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        toxic = int(i % 3 == 0)
        w = [f"w{dice.randrange(60)}" for _ in range(30)]
        if toxic:
            w[dice.randrange(30)] = dice.choice(["idiot!", "Scum", "moron,"])
        if group and dice.random() < (share if toxic else 0.03):
            w[dice.randrange(30)] = group
        texts.append(" ".join(w))
        labels.append((i, toxic))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out("doc_id", 3, 1)))
    found = toxicity.scored(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    held = fully(found.filter(toxicity.held_out("doc_id", 3, 1)))
    right = sum((r["score"] >= 0.7) == bool(r["toxic"]) for r in held)
    assert held and right / len(held) > 0.97
    assert model.equals(toxicity.fit(docs.repartition(5), labels.filter(~toxicity.held_out("doc_id", 3, 1))))


def test_the_penalty_frees_neutral_mentions_of_a_group(spark):
    docs, labels = toxic_docs(spark, group="muslims", share=0.9)
    text = documents(spark, ["the muslims met w1", "the jews met w1"])

    def scores(penalty):
        model = toxicity.fit(docs, labels, penalty=penalty)
        return [r["score"] for r in fully(toxicity.scored(text.select("doc_id", "text"), model))]

    (free, other), (held, _) = scores(0.0), scores(100.0)
    assert abs(free - other) > 0.15
    assert abs(held - scores(100.0)[1]) < 0.3 * abs(free - other)


def test_counterfactuals_swap_terms_within_their_kind():
    found = toxicity.counterfactuals("Jews and women meet; Jewish song")
    assert len(found) == 5
    assert found[0] == "hindus and men meet; hindu song"
    assert toxicity.counterfactuals("nobody is named") == []


def test_toxicity_odd_rows_and_empty_tables(spark):
    docs = odd_rows(spark)
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (5, 0), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(docs, labels)
    rows = fully(toxicity.scored(docs, model))
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in fully(toxicity.scored(docs, none))} == {0.5}
    assert toxicity.scored(docs.limit(0), model).count() == 0
    one_label = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert len(one_label) == 1 and one_label.weight[0] < 0


def test_scores_equal_a_plain_softmax_of_the_trained_model(spark):
    """Groups, classes and words of every context, summed one by one."""
    dice = np.random.default_rng(5)
    n = lm.CLASSES
    class_of = np.concatenate((np.arange(n), dice.integers(256, n, 2000), np.arange(256)))
    mass = dice.integers(1, 50, len(class_of)) * (np.arange(len(class_of)) >= 256.0)
    slots = lm.Slots(class_of, mass, n)
    share = np.bincount(class_of, mass + 0.5, n)
    share /= share.sum()
    words = dice.normal(0, 0.3, (2, len(class_of), lm.WIDTH)).astype(np.float32)
    trainer = lm.Trainer(lm.Parameters.start(share).flat, share, 1, 0.2, slots, words)
    for _ in range(20):
        trainer.step(*dice.integers(256, len(class_of), (3, 512)))
    p, D, S = trainer.p, trainer.D.x, trainer.S.x
    word, one, two = dice.integers(256, len(class_of), (3, 40))
    found = lm.log_likelihoods(p.flat, np.stack([D, S]), slots, word, one, two)
    for w, a, b, log_p in zip(word, one, two, found):
        r = (p.R[class_of[a]] + D[a]) @ p.C1 + (p.R[class_of[b]] + D[b]) @ p.C2
        c = class_of[w]
        top = np.exp(p.U @ r + p.top)
        classes = [x for x in range(n) if x // lm.GROUP == c // lm.GROUP]
        inside = {x: math.exp(p.Q[x] @ r + p.bias[x]) for x in classes}
        plain = math.log(top[c // lm.GROUP] / top.sum()) + math.log(inside[c] / sum(inside.values()))
        if c >= lm.SINGLES:
            among = np.flatnonzero(class_of == c)
            each = np.exp(S[among] @ r + slots.log_share[among])
            plain += math.log(each[among == w][0] / each.sum())
        assert log_p == pytest.approx(plain, abs=1e-4)


def test_a_class_is_one_product_in_a_piece(monkeypatch):
    n_classes, dice, asked = lm.CLASSES, np.random.default_rng(3), []
    slots = lm.Slots(np.arange(n_classes), np.ones(n_classes), n_classes)
    flat = lm.Parameters.start(np.full(n_classes, 1 / n_classes)).flat
    words = dice.normal(size=(2, n_classes, lm.WIDTH)).astype(np.float32)
    word = dice.integers(lm.SINGLES, lm.SINGLES + 3, 200_000)
    plain = lm._log_sum
    monkeypatch.setattr(lm, "_log_sum", lambda scores: asked.append(scores.shape) or plain(scores))
    lm.log_likelihoods(flat, words, slots, word, word, word)
    # classes of one word each are cut at 250,000 scores only
    assert sum(wide == 1 for _, wide in asked) == 3


def test_log_sums_of_extreme_scores():
    scores = np.array([[500.0, 499.0], [-500.0, -501.0], [0.0, 0.0]], np.float32)
    both = [lm._log_sum(scores.copy()), lm._log_sum(scores[2:].copy())]
    expected = np.logaddexp(scores[:, 0].astype(float), scores[:, 1])
    assert np.allclose(np.concatenate(both), [*expected, expected[2]], rtol=1e-6)


def test_rows_step_along_sums_by_place():
    dice = np.random.default_rng(5)
    rows = lm.Rows(dice.normal(size=(50, 4)), 0.1)
    before, at, g = rows.x.copy(), dice.integers(0, 20, 64), dice.normal(size=(64, 4)).astype(np.float32)
    own, sums = rows.add(at, g)
    assert sorted(own.tolist()) == sorted(set(at.tolist()))
    for place, found in zip(own, sums):
        total = g[at == place].sum(0)
        assert np.allclose(found, total, atol=1e-5) and rows.times[place] == (at == place).sum()
        assert np.allclose(rows.x[place] - before[place], 0.1 * total / np.sqrt(1 + total**2), atol=1e-5)
    assert (rows.x[20:] == before[20:]).all() and not rows.times[20:].any()


def test_runs_are_summed_in_few_stacks():
    """As many products as powers of two among the runs' lengths, not as many as runs."""
    dice = np.random.default_rng(7)
    sizes = np.concatenate((dice.integers(1, 9, 2000), [1, 2, 3, 4, 5, 300]))
    first, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    left, right = dice.normal(size=(n, 3)).astype(np.float32), dice.normal(size=(n, 5)).astype(np.float32)
    assert len(list(lm._runs(first, n))) == 5
    sums, products = lm._run_sums(right, first), lm._run_products(left, right, first)
    for i, (low, size) in enumerate(zip(first, sizes)):
        own = slice(low, low + size)
        assert np.allclose(sums[i], right[own].sum(0), atol=1e-4)
        assert np.allclose(products[i], left[own].T @ right[own], atol=1e-4)
    table, at = np.zeros((40, 5), np.float32), dice.integers(0, 40, n)
    lm._add(table, at, right)
    assert np.allclose(table, np.stack([right[at == i].sum(0) for i in range(40)]), atol=1e-3)


def test_words_of_many_texts_are_cut_at_once():
    spaces = [*" \t\n\x0b\x0c\r", "  ", "\n\n", ""]
    letters = ["a", "B", "É", "日", "\x1c", "\x85", "\xa0", " ", "\x00", "The"]
    dice = random.Random(6)
    texts = [None, "", " ", *("".join(dice.choice(spaces + letters) for _ in range(dice.randrange(30))) for _ in range(300))]
    found, sizes = lm.word_lists(pa.array(texts, pa.string()))
    plain = [lower_words(t) for t in texts]
    assert sizes.tolist() == [len(x) for x in plain]
    assert found.to_pylist() == [w for x in plain for w in x]
    for endings in (512, 4096):
        tokens = [w for x in plain for w in x]
        assert lm._ending_classes(tokens, endings) == [lm.ending_class(w, endings) for w in tokens]


def test_a_token_teaches_as_first_and_second_before_in_one_row():
    """Two texts in a batch: what a token's row counts, and what the row learns, is as with every context by itself."""
    n = lm.CLASSES
    share, dice = np.full(n, 1 / n), np.random.default_rng(8)
    slots = lm.Slots(np.arange(n), np.ones(n), n)
    words = dice.normal(0, 0.3, (2, n, lm.WIDTH)).astype(np.float32)
    texts = [dice.integers(256, 300, 50), dice.integers(256, 300, 7)]
    before = [lm.contexts(x, 256) for x in texts]
    word, (one, two) = np.concatenate(texts), (np.concatenate(x) for x in zip(*before))
    mixed = dice.permutation(len(word))  # no two neighbours of a text in a row
    found = []
    for order in (np.arange(len(word)), mixed):
        trainer = lm.Trainer(lm.Parameters.start(share).flat, share, 1, 0.2, slots, words)
        trainer.step(word[order], one[order], two[order])
        found.append(trainer)
    assert (found[0].D.times == np.bincount(np.concatenate((one, two)), minlength=n)).all()
    assert (found[0].D.times == found[1].D.times).all()
    assert np.allclose(found[0].D.x, found[1].D.x, atol=1e-4) and np.allclose(found[0].p.flat, found[1].p.flat, atol=1e-4)
