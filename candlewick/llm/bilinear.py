"""Language-model scores of texts: a log-bilinear neural model, trained with noise-contrastive estimation.

Words are runs of anything but ASCII white space, A-Z in lower case; every text ends with an end token. Texts
of a training share are counted, all of them, and train the model, each once.

Model. The most frequent words are classes of their own; the other listed words are bands of neighbouring
frequency, and all remaining words, unknown ones included, are one class. With vectors ``r`` for classes as
context and ``q`` as target, weights ``m`` for each place of the context and a bias ``b``,

    P(class | context) = softmax over all classes of (sum of m_j * r_j) . q + b

and a word has the share of its class that its count plus one has; one unknown word counts as seen never. So
the probabilities of all known words and an unknown one add up to 1, and one matrix product for a batch of
contexts normalises them.

Training. Noise-contrastive estimation in numpy: a batch of tokens shares ``NOISE`` classes drawn by their
frequency, and the model learns to tell tokens from noise. Each of ``ROUNDS`` rounds takes another share of the
training texts. A task learns from its partition alone, starting from the parameters of the round before; the
parameters of a round are the means of the tasks', weighted by tokens, added up by a group-by. The driver sees
them (``(singles + bands) * (2 * width + 1)`` numbers), and the listed words with their counts: at most
``LISTED`` words of ``WORD_BYTES`` bytes, that is all words from some count on. Words that are not listed are
joined with the table of counts, so the base score and the class shares are exact for every word.

Scores depend a little on how the table is split into partitions, like every model that is trained in
parallel; counts and base scores do not.

Null and empty texts consist of the end token. A null id trains. Repeated rows are texts of their own. Without
training texts every probability is 1. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.graph import _dropped, _stored
from candlewick.llm.text import pieces

LISTED, WORD_BYTES = 1 << 18, 64
SINGLES, BANDS = 768, 255

WIDTH, CONTEXT = 24, 2
ROUNDS, BATCH, NOISE, RATE = 2, 2048, 32, 0.04

#: Words never hold white space.
END = b"\n"

#: Distinct words that a task counts before it passes the counts on.
COUNTED = 400_000

#: Contexts that are normalised at once.
AT_ONCE = 4096

#: Buckets of counts, for finding the count from which words are listed.
_STEPS = 16


def tokens(text: str | None) -> list[bytes]:
    words = text.encode().lower().split() if text else []
    words.append(END)
    return words


def count_words(texts: DataFrame) -> DataFrame:
    """Rows (word, n) of a table (text): every token's count."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            made = [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())]
            counted.clear()
            return pa.RecordBatch.from_arrays(made, ["word", "n"])

        for batch in pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                counted.update(tokens(text))
            if len(counted) > COUNTED:
                yield passed_on()
        yield passed_on()

    return texts.select("text").mapInArrow(make, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The listed words by falling count, and what tasks need of all words."""

    words: list[bytes]
    counts: np.ndarray
    #: Training tokens, distinct ones, and distinct ones that are not listed.
    total: int
    distinct: int
    rest: int
    singles: int = SINGLES
    bands: int = BANDS

    def __post_init__(self) -> None:
        n = len(self.words)
        mass = (self.counts + 1).astype(np.float64)
        self.class_of = np.minimum(np.arange(n + 1), self.singles)
        tail = mass[self.singles :]
        if len(tail):
            before = np.cumsum(tail) - tail
            band = np.floor(before * (self.bands / tail.sum())).astype(np.int64)
            self.class_of[self.singles : n] = self.singles + np.unique(band, return_inverse=True)[1]
        #: The class of all other words comes last; index -1 finds it.
        self.classes = int(self.class_of[:n].max(initial=-1)) + 2
        self.class_of[n] = self.classes - 1
        if self.classes < 1 << 16:
            self.class_of = self.class_of.astype(np.uint16)  # sorted by digits, which is faster
        self.rest_mass = float(self.total - self.counts.sum() + self.rest + 1)
        masses = np.bincount(self.class_of[:n], weights=mass, minlength=self.classes)
        masses[-1] += self.rest_mass
        self.frequency = masses / masses.sum()
        self.share = np.r_[np.log10(mass / masses[self.class_of[:n]]), 0.0]
        self.base = np.r_[np.log10(mass / self.denominator), 0.0]

    @property
    def denominator(self) -> int:
        return self.total + self.distinct + 1

    def index(self) -> _Index:
        return _Index(zip(self.words, range(len(self.words)), strict=True))


class _Index(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def list_words(counts: DataFrame, listed: int = LISTED, singles: int = SINGLES, bands: int = BANDS) -> tuple[Vocabulary, Column]:
    """The vocabulary, and the condition on (word, n) that its listed words meet."""
    step = F.floor(F.log2("n") * _STEPS)
    short = F.length("word") <= WORD_BYTES
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    sizes = counts.where(short).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, room = math.inf, listed
    for row in sizes:
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    chosen = short & (step >= F.lit(float(least)))
    rows = counts.where(chosen).toArrow()
    words, numbers = rows.column("word").to_pylist(), np.asarray(rows.column("n"), dtype=np.int64)
    order = sorted(range(len(words)), key=lambda i: (-numbers[i], words[i]))
    return Vocabulary([words[i] for i in order], numbers[order], total, distinct, distinct - len(words), singles, bands), chosen


class Model:
    """Parameters, and what one worker does with them."""

    def __init__(self, frequency: np.ndarray, width: int = WIDTH, parameters: np.ndarray | None = None) -> None:
        n = len(frequency)
        if parameters is None:
            dice = np.random.default_rng(0)
            parameters = np.zeros((n + 1, 2 * width + 1), np.float32)
            parameters[:n, :-1] = 0.1 * dice.normal(size=(n, 2 * width))
            parameters[:n, -1] = np.log(frequency)
            parameters[n, : CONTEXT * width] = 1.0  # both places of the context fit into one row
        #: A row per class (as context, as target, bias) and one for the weights of the places.
        self.parameters = parameters.astype(np.float32)
        self.frequency, self.width, self.classes = frequency, width, n
        self._sums: np.ndarray | None = None

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n, d = self.classes, self.width
        return (
            self.parameters[:n, :d], self.parameters[:n, d : 2 * d], self.parameters[:n, -1],
            self.parameters[n, : CONTEXT * d].reshape(CONTEXT, d),
        )

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """The vector that each context (a row of classes, the nearest first) predicts."""
        context, _, _, places = self.parts()
        return sum(context[contexts[:, j]] * places[j] for j in range(CONTEXT))

    def log_totals(self, contexts: np.ndarray) -> np.ndarray:
        """The log of the sum over all classes, for each context."""
        _, target, bias, _ = self.parts()
        out = np.empty(len(contexts), np.float64)
        for start in range(0, len(contexts), AT_ONCE):
            scores = self.predicted(contexts[start : start + AT_ONCE]) @ target.T + bias
            most = scores.max(axis=1)
            out[start : start + AT_ONCE] = most + np.log(np.exp(scores - most[:, None]).sum(axis=1, dtype=np.float64))
        return out

    def log10(self, contexts: np.ndarray, targets: np.ndarray, known: dict[str, np.ndarray]) -> np.ndarray:
        """Normalised log10 probabilities. Totals of contexts are remembered in ``known``."""
        totals = known.get("totals")
        if totals is None:
            totals = known["totals"] = np.full(self.classes**CONTEXT, np.nan, np.float32)
        number = contexts[:, 0].astype(np.int64)
        for j in range(1, CONTEXT):
            number = number * self.classes + contexts[:, j]
        missing, first = np.unique(number[np.isnan(totals[number])], return_index=True)
        if len(missing):
            at = np.flatnonzero(np.isnan(totals[number]))[first]
            totals[missing] = self.log_totals(contexts[at])
        _, target, bias, _ = self.parts()
        out = np.empty(len(targets), np.float64)
        for start in range(0, len(targets), 16 * AT_ONCE):
            own = slice(start, start + 16 * AT_ONCE)
            out[own] = np.einsum("ij,ij->i", self.predicted(contexts[own]), target[targets[own]]) + bias[targets[own]]
        return (out - totals[number]) / math.log(10)

    def learn(self, contexts: np.ndarray, targets: np.ndarray, dice: np.random.Generator, noise: int = NOISE, rate: float = RATE) -> None:
        """One step of noise-contrastive estimation, with a rate of its own for each parameter (AdaGrad)."""
        context, target, bias, places = self.parts()
        drawn = np.minimum(np.searchsorted(np.cumsum(self.frequency), dice.random(noise)), self.classes - 1)
        odds = np.log(noise * self.frequency).astype(np.float32)
        predicted = self.predicted(contexts)
        right = np.einsum("ij,ij->i", predicted, target[targets]) + bias[targets] - odds[targets]
        wrong = predicted @ target[drawn].T + (bias[drawn] - odds[drawn])
        up = 1 / (1 + np.exp(np.clip(right, -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-wrong, -30, 30)))
        step = np.zeros_like(self.parameters)
        d, n = self.width, self.classes
        back = up[:, None] * target[targets] + down @ target[drawn]
        _scatter(step[:, d : 2 * d], targets, up[:, None] * predicted)
        _scatter(step[:, d : 2 * d], drawn, down.T @ predicted)
        step[:n, -1] += np.bincount(targets, weights=up, minlength=n)
        step[:n, -1] += np.bincount(drawn, weights=down.sum(axis=0), minlength=n)
        for j in range(CONTEXT):
            _scatter(step[:, :d], contexts[:, j], back * places[j])
            step[n, j * d : (j + 1) * d] += np.einsum("ij,ij->j", back, context[contexts[:, j]])
        step /= len(targets)
        if self._sums is None:
            self._sums = np.full_like(self.parameters, 1e-8)
        self._sums += step * step
        self.parameters += rate * step / np.sqrt(self._sums)


def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds each value to its row."""
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    first = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    into[sorted_rows[first]] += np.add.reduceat(values[order], first)


def with_contexts(classes: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The context of each token of texts put one behind the other; ``start`` stands in front of a text."""
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(classes)) - np.repeat(first, lengths)
    out = np.empty((len(classes), CONTEXT), classes.dtype)
    for j in range(CONTEXT):
        out[:, j] = np.where(place > j, np.roll(classes, j + 1), start)
    return out


class _Shared:
    """The vocabulary as tasks see it: one broadcast of bounded size, one index for a worker process."""

    _here: dict[str, tuple[_Index, Vocabulary]] = {}

    def __init__(self, vocabulary: Vocabulary, docs: DataFrame) -> None:
        self._sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
        self._name = uuid.uuid4().hex

    def here(self) -> tuple[_Index, Vocabulary]:
        if self._name not in self._here:
            self._here.clear()
            vocabulary = self._sent.value
            self._here[self._name] = vocabulary.index(), vocabulary
        return self._here[self._name]


def _read(texts: list[str | None], index: _Index) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Tokens of each text, the listed number of all tokens, and the texts' lengths."""
    each = [tokens(x) for x in texts]
    lengths = np.array([len(x) for x in each], np.int64)
    numbers = np.fromiter((index[w] for x in each for w in x), np.int64, int(lengths.sum()))
    return each, numbers, lengths


def _round(texts: DataFrame, shared: _Shared, parameters: np.ndarray, width: int, number: int) -> np.ndarray:
    """The tasks' mean parameters after they learned from ``texts``."""
    columns = [f"v{i}" for i in range(parameters.shape[1])]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, vocabulary = shared.here()
        model, seen = Model(vocabulary.frequency, width, parameters), 0
        dice = np.random.default_rng([number, TaskContext.get().partitionId()])
        for batch in pieces(batches, "text"):
            _, numbers, lengths = _read(batch.column("text").to_pylist(), index)
            classes = vocabulary.class_of[numbers]
            contexts = with_contexts(classes, lengths, int(vocabulary.class_of[index[END]]))
            order = dice.permutation(len(classes))
            for start in range(0, len(order), BATCH):
                own = order[start : start + BATCH]
                model.learn(contexts[own], classes[own], dice)
            seen += len(classes)
        if seen:
            values = model.parameters.astype(np.float64) * seen
            rows = pa.array(np.arange(len(values)), pa.int32())
            weights = pa.array(np.full(len(values), float(seen)))
            yield pa.RecordBatch.from_arrays([rows, weights, *map(pa.array, values.T)], ["row", "weight", *columns])

    schema = "row int, weight double, " + ", ".join(f"{x} double" for x in columns)
    learned = texts.mapInArrow(make, schema).groupBy("row")
    means = learned.agg(*[(F.sum(x) / F.sum("weight")).alias(x) for x in columns]).toPandas()
    if not len(means):
        return parameters
    return means.sort_values("row")[columns].to_numpy(np.float32)


def train(texts: DataFrame, shared: _Shared, vocabulary: Vocabulary, rounds: int = ROUNDS, width: int = WIDTH) -> Model:
    """The model of a table (id, text); every row is learned from in one of the rounds."""
    model = Model(vocabulary.frequency, width)
    share = F.pmod(F.xxhash64("id", "text"), F.lit(rounds))
    for number in range(rounds):
        parameters = _round(texts.where(share == number).select("text"), shared, model.parameters, width, number)
        model = Model(vocabulary.frequency, width, parameters)
    return model


def _scored(rows: DataFrame, shared: _Shared, model: Model, kind: str) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_listed, base, score, others): sums over listed words, and the others.

    ``score`` has the class probabilities of all tokens."""
    parameters, width = model.parameters, model.width

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, vocabulary = shared.here()
        own, known = Model(vocabulary.frequency, width, parameters), {}
        for batch in pieces(batches, "text"):
            each, numbers, lengths = _read(batch.column("text").to_pylist(), index)
            classes = vocabulary.class_of[numbers]
            contexts = with_contexts(classes, lengths, int(vocabulary.class_of[index[END]]))
            score = own.log10(contexts, classes, known) + vocabulary.share[numbers]
            first = np.cumsum(lengths) - lengths
            add = lambda values, first=first: pa.array(np.add.reduceat(values, first))
            others = numbers < 0
            counts = np.add.reduceat(others.astype(np.int64), first)
            words = [w for x in each for w in x]
            listed = pa.array([words[i] for i in np.flatnonzero(others)], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), listed)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("held_out"), pa.array(lengths), pa.array(lengths - counts),
                    add(vocabulary.base[numbers]), add(score), lists,
                ],
                ["id", "held_out", "n_tokens", "n_listed", "base", "score", "others"],
            )

    return rows.mapInArrow(
        make, f"id {kind}, held_out boolean, n_tokens bigint, n_listed bigint, base double, score double, others array<binary>"
    )


def scores(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", listed: int = LISTED,
    singles: int = SINGLES, bands: int = BANDS, rounds: int = ROUNDS, width: int = WIDTH,
) -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score), one per row of ``docs``.

    Texts where ``held_out`` is true are scored only; null counts as false."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("id", "text")
    counts = _stored(count_words(training), "words")
    vocabulary, chosen = list_words(counts, listed, singles, bands)
    shared = _Shared(vocabulary, docs)
    model = train(training, shared, vocabulary, rounds, width)
    scored = _stored(_scored(rows, shared, model, kind).withColumn("row", F.monotonically_increasing_id()), "scored")

    others = scored.select("row", F.explode("others").alias("word")).join(counts.where(~chosen), "word", "left")
    seen = F.coalesce("n", F.lit(0))
    share = F.log10((seen + 1) / F.lit(vocabulary.rest_mass))
    sums = others.groupBy("row").agg(
        F.count("n").alias("found"), F.sum(F.log10((seen + 1) / F.lit(vocabulary.denominator))).alias("more_base"),
        F.sum(share).alias("more_score"),
    )
    joined = scored.drop("others").join(sums, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return joined.select(
        F.col("id").alias(key), "held_out", "n_tokens", plus("n_listed", "found").alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), plus("base", "more_base").alias("base_score"),
        plus("score", "more_score").alias("score"),
    )
