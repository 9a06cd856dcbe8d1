"""Language-model scores against plain loops, normalisation, learning on held-out texts, edges."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import bilinear
from candlewick.llm.queries import QUERIES

from .conftest import EDGES, SMALL


def cut(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w.encode() for w in lower.split(" ") if w] + [bilinear.END]


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False


def base_rows(rows):
    """(id, held_out, n_tokens, n_known, train_tokens, base_score) by the definition."""
    counts = Counter(w for i, t in rows if not is_held_out(i) for w in cut(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = cut(t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out.append((i, is_held_out(i), len(words), sum(counts[w] > 0 for w in words), total, base))
    return sorted(out, key=repr)


def same_base(got, want):
    got = sorted((tuple(r)[:6] for r in got), key=repr)
    want = sorted(want, key=repr)
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def phrases(seed, n):
    """Texts whose next word depends on the one before."""
    dice = random.Random(seed)
    follows = {i: dice.sample(range(60), 3) for i in range(60)}
    rows = []
    for i in range(n):
        at, words = dice.randrange(60), []
        for _ in range(dice.randint(5, 60)):
            at = dice.choice(follows[at]) if dice.random() < 0.95 else dice.randrange(60)
            words.append(f"W{at}" if dice.random() < 0.95 else f"rare{dice.randrange(4000)}")
        rows.append((i, " ".join(words)))
    return rows


def test_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op11_bilinear_scores"](spark, SMALL).collect()
    same_base(got, base_rows([(r.doc_id, r.text) for r in docs.collect()]))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_learns_from_context(spark, docs_of):
    rows = phrases(1, 1500)
    got = bilinear.scores(docs_of(rows).repartition(2), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, singles=80, bands=8).collect()
    same_base(got, base_rows(rows))
    held = [r for r in got if r.held_out]
    per_token = lambda column: sum(r[column] for r in held) / sum(r.n_tokens for r in held)
    assert len(held) > 100
    assert per_token("score") > per_token("base_score") + 0.3  # a unigram model cannot reach that


@pytest.mark.parametrize("listed", [0, 20, 1000])
def test_scores_by_loops(spark, docs_of, listed):
    """The operator's sums equal those of single tokens, listed or joined, and probabilities add up to 1."""
    rows = phrases(2, 60) + [(900 + i, t) for i, t in EDGES if i] + [(None, "w1 w2"), (None, "w1 unknown")]
    docs = docs_of(rows).coalesce(1)
    held_out = F.col("doc_id") % 3 == 0
    got = bilinear.scores(docs, held_out, listed=listed, singles=10, bands=4).collect()
    training = docs.where(~F.coalesce(held_out, F.lit(False))).select(F.col("doc_id").alias("id"), "text")
    counts = bilinear.count_words(training)
    vocabulary, _ = bilinear.list_words(counts, listed, 10, 4)
    number = Counter({r.word: r.n for r in counts.collect()})
    assert len(vocabulary.words) <= listed and vocabulary.total == sum(number.values())
    model = bilinear.train(training, bilinear._Shared(vocabulary, docs), vocabulary)
    index = vocabulary.index()
    mass = Counter({vocabulary.classes - 1: 1})
    for word, n in number.items():
        mass[int(vocabulary.class_of[index[word]])] += n + 1
    wanted = {}
    for i, text in rows:
        words = cut(text)
        classes = [int(vocabulary.class_of[index[w]]) for w in words]
        start = int(vocabulary.class_of[index[bilinear.END]])
        total = 0.0
        for at, (word, c) in enumerate(zip(words, classes, strict=True)):
            context = np.array([[classes[at - 1] if at > 0 else start, classes[at - 2] if at > 1 else start]])
            scores = model.predicted(context)[0] @ model.parts()[1].T + model.parts()[2]
            chances = np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
            assert math.isclose(chances.sum(), 1, rel_tol=1e-5)
            total += math.log10(chances[c] * (number[word] + 1) / mass[c])
            if at > 300:
                total = None
                break
        wanted.setdefault((i, len(words)), []).append(total)
    for r in got:
        want = [x for x in wanted[r.doc_id, r.n_tokens]]
        assert None in want or any(math.isclose(r.score, x, rel_tol=1e-4) for x in want), (r, want)


def test_empty_tables(spark, docs_of):
    held_out = F.col("doc_id") == 2
    assert bilinear.scores(docs_of([]), held_out).collect() == []
    (row,) = bilinear.scores(docs_of([(2, "only held out")]), held_out).collect()
    assert tuple(row)[1:6] == (True, 4, 0, 0, 0.0) and abs(row.score) < 1e-6


def test_a_step_raises_the_objective():
    """Steps on one batch lift the probability of its tokens; totals are those of a plain sum."""
    dice = np.random.default_rng(0)
    frequency = dice.random(30)
    model = bilinear.Model(frequency / frequency.sum(), 8)
    contexts, targets = dice.integers(0, 30, (200, 2)), dice.integers(0, 30, 200)
    before = model.log10(contexts, targets, {}).sum()
    for _ in range(30):
        model.learn(contexts, targets, dice)
    assert model.log10(contexts, targets, {}).sum() > before
    _, target, bias, _ = model.parts()
    plain = np.log(np.exp(model.predicted(contexts) @ target.T + bias).sum(axis=1))
    assert np.allclose(model.log_totals(contexts), plain, atol=1e-4)
