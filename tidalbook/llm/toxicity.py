"""Toxicity by weak supervision.

1. Voters. Lexicon voters are words, pattern voters are word beginnings of 4 to
   6 letters, which catch inflected forms. They are mined from a sample of
   labelled rows by how much oftener toxic texts hold them, or (CLEAN_VOTERS)
   clean ones. A voter fires on a text that holds it and otherwise abstains.
   Where no labelled row is toxic, the few words of SEEDS are the voters.
2. Label model. A generative model with a hidden label for each sampled text:
   each voter fires with one rate on toxic texts and one on clean ones, and so
   does the given label, as labels err too; its rates are estimated by what the
   voters alone say, from a prior of GOLD_PRIOR right and wrong labels of each
   class. EM estimates the rates and the hidden labels. Voters that fire together are
   not independent, so their correlations given the hidden label are estimated
   as well and each voter's evidence is divided by the number of votes that it
   effectively repeats.
3. Classifier. A logistic regression on the voters, and on how many of them
   fire, is fitted to the posterior labels. Its output is the score.

Bounds: the sample has at most TRAIN_ROWS labelled rows of each class, those
with the smallest hash of the doc_id, and one text of each doc_id; at most VOTERS
and CLEAN_VOTERS voters. Both classes are
counted over all allowed labels, and sampled rows are weighted by the true
shares of the classes, so the bound does not move the threshold. What the driver
holds is one vote bit per sampled row and voter, whatever the corpus. Scoring
is map-only over whole texts. A score sees the text alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import row_slices, stored

TRAIN_ROWS = 8_000
VOTERS = 192
MIN_SUPPORT = 3
MIN_LIFT = 4.0
CLEAN_VOTERS = 32
#: A voter for clean texts stands in this share of them, and is so many times as frequent there.
CLEAN_SHARE, CLEAN_LIFT = 0.02, 2.0
GOLD_PRIOR = (29.0, 1.0)
FOLDS = 5
STEMS = (4, 5, 6)
EM_ROUNDS = 30

#: Words that count as toxic where no label says so.
SEEDS = ("asshole", "bastard", "clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

_WORDS = re.compile(r"[^\W\d_]+").findall
#: Signs that are neither ASCII nor Latin letters; texts without them are cut as bytes.
_OTHER = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]").search
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def features(text: str | None) -> tuple[set[str], set[str]]:
    """The different words of a text in lower case, and their beginnings."""
    words = set(_WORDS((text or "").lower()))
    return words, {w[:n] for n in STEMS for w in words if len(w) >= n}


def encoded_words(text: str | None) -> set[bytes]:
    """The different words of ``features``, in UTF-8."""
    lower = (text or "").lower()
    if lower.isascii() or not _OTHER(lower):
        return set(lower.encode().translate(_LETTERS).split())
    return {w.encode("utf-8", "surrogatepass") for w in _WORDS(lower)}


def held_out(doc_id: Column) -> Column:
    """True for rows of which no label may be learned; false without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    """Weights of the voters; ``word`` and ``stem`` map to voter numbers."""

    word: dict[str, int]
    stem: dict[str, int]
    weights: np.ndarray
    bias: float
    encoded: dict[bytes, int] = field(init=False)
    heads: frozenset[bytes] = field(init=False)

    def __post_init__(self) -> None:
        self.encoded = {w.encode("utf-8", "surrogatepass"): number for w, number in self.word.items()}
        self.heads = frozenset(s.encode("utf-8", "surrogatepass")[: STEMS[0]] for s in self.stem)  # bytes, and no stem has fewer

    def votes(self, text: str | None) -> list[int]:
        words = encoded_words(text)
        fired = {self.encoded[w] for w in self.encoded.keys() & words}
        shortest, heads = STEMS[0], self.heads
        for encoded in words:
            if encoded[:shortest] in heads:
                w = encoded.decode("utf-8", "surrogatepass")
                for n in STEMS:
                    number = self.stem.get(w[:n])
                    if number is not None:
                        fired.add(number)
        return sorted(fired)

    def score(self, text: str | None) -> float:
        fired = self.votes(text)
        total = self.bias + float(self.weights[fired].sum()) + float(self.weights[-1]) * np.log1p(len(fired))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic, weight) of at most ``rows`` labelled rows of either class, none held out.

    weight restores the shares that the classes have among all allowed labels;
    its mean over the sampled labels is 1. A doc_id with several labels is toxic
    if one of them says so; of several texts of one doc_id the least is taken.
    """
    one = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    known = docs.select("doc_id").where("doc_id is not null").distinct()
    one = one.join(known, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    one = stored(one, "labels")
    picked = [one.where(F.col("toxic") == v).orderBy(*order).limit(rows) for v in (0, 1)]
    classes = [p.collect() for p in picked]  # 2 * rows short rows at most
    counted = {r.toxic: r["count"] for r in one.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    taken, known_rows = sum(map(len, classes)), sum(counted.values())
    chosen = [(r.doc_id, r.toxic, counted[r.toxic] * taken / (len(c) * known_rows)) for c in classes for r in c]
    sample = spark.createDataFrame(chosen, one.schema.add("weight", "double")).withColumnRenamed("doc_id", "labelled_id")
    found = docs.withColumnRenamed("doc_id", "text_id").join(F.broadcast(sample), F.col("text_id") == F.col("labelled_id"))
    return found.groupBy("labelled_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"), F.first("weight").alias("weight")).drop("labelled_id")


def mine_voters(sample: DataFrame, voters: int = VOTERS, support: int = MIN_SUPPORT, lift: float = MIN_LIFT, clean_voters: int = CLEAN_VOTERS) -> tuple[list[str], list[str]]:
    """Words and beginnings that toxic texts hold ``lift`` times as often as clean ones, and some that clean texts hold oftener."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        total = [0, 0]
        for part in row_slices(batches):
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words, stems = features(text)
                counts[toxic].update("w" + w for w in words)
                counts[toxic].update("s" + s for s in stems)
                total[toxic] += 1
        names = list(counts[1] | counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", *names]), pa.array([total[1], *(counts[1][n] for n in names)], pa.int64()), pa.array([total[0], *(counts[0][n] for n in names)], pa.int64())],
            names=["feature", "toxic", "clean"],
        )

    counts = stored(sample.mapInArrow(run, "feature string, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "features")
    total = counts.where("feature = ''").first()
    if total is None or not total.toxic:
        return list(SEEDS), []
    rate = lambda n, of: (F.col(n) + 0.5) / (of + 1.0)
    toxic, clean = rate("toxic", total.toxic), rate("clean", total.clean)
    named = counts.where(F.col("feature") != "")
    sides = (
        (named.where((F.col("toxic") >= min(support, total.toxic)) & (toxic >= lift * clean)), F.col("toxic") * F.ln(toxic / clean), voters),
        (named.where((clean >= CLEAN_SHARE) & (clean >= CLEAN_LIFT * toxic)), F.col("clean") * F.ln(clean / toxic), clean_voters),
    )
    best = [r.feature for side, gain, most in sides for r in side.select("feature", gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(most).collect()]
    words = [f[1:] for f in best if f[0] == "w"]
    return (words, [f[1:] for f in best if f[0] == "s"]) if best else (list(SEEDS), [])


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = EM_ROUNDS, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of toxic for each row, correlation matrix of the voters).

    votes: rows x voters, 0 or 1. gold: the given labels, which start EM and
    take part as a voter whose rates are estimated. weight: how many rows a row
    stands for.
    """
    weight = np.ones(len(votes)) if weight is None else weight
    right, wrong = GOLD_PRIOR
    posterior = np.where(gold == 1, right, wrong) / (right + wrong)
    share = np.ones(votes.shape[1])
    correlated = np.eye(votes.shape[1])
    for _ in range(rounds):
        toxic, clean = (weight * posterior).sum(), (weight * (1 - posterior)).sum()
        fires = np.clip((votes.T @ (weight * posterior) + 0.5) / (toxic + 1), 1e-4, 1 - 1e-4)
        falsely = np.clip((votes.T @ (weight * (1 - posterior)) + 0.5) / (clean + 1), 1e-4, 1 - 1e-4)
        rest = votes - np.outer(posterior, fires) - np.outer(1 - posterior, falsely)
        cover = (rest * weight[:, None]).T @ rest / weight.sum()
        spread = np.sqrt(np.maximum(np.diag(cover), 1e-9))
        correlated = np.clip(cover / np.outer(spread, spread), 0, 1)
        share = 1 / np.maximum(correlated.sum(axis=1), 1)
        odds = np.log(toxic / clean) + (votes * (np.log(fires / falsely) * share)).sum(axis=1) + ((1 - votes) * (np.log((1 - fires) / (1 - falsely)) * share)).sum(axis=1)
        voted = weight / (1 + np.exp(-np.clip(odds, -30, 30)))  # by the voters alone, so that the labels do not confirm themselves
        caught = ((voted * gold).sum() + right) / (voted.sum() + right + wrong)
        blamed = (((weight - voted) * gold).sum() + wrong) / ((weight - voted).sum() + right + wrong)
        odds += np.where(gold == 1, np.log(caught / blamed), np.log((1 - caught) / (1 - blamed)))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-4:
            posterior = new
            break
        posterior = new
    return posterior, correlated


def fit_linear(votes: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Logistic regression on votes and log(1 + fired) by Newton steps; (weights, bias)."""
    x = np.column_stack([votes, np.log1p(votes.sum(axis=1)), np.ones(len(votes))])
    weight = np.ones(len(votes)) if weight is None else weight
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _vote_table(sample: DataFrame, words: list[str], stems: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes, given labels and weights of the sampled rows, packed in bits on their way."""
    model = Model({w: k for k, w in enumerate(words)}, {s: len(words) + k for k, s in enumerate(stems)}, np.zeros(1), 0.0)
    width = len(words) + len(stems)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            rows = np.zeros((part.num_rows, width), dtype=bool)
            for k, text in enumerate(part.column(0).to_pylist()):
                rows[k, model.votes(text)] = True
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array([r.tobytes() for r in np.packbits(rows, axis=1)], pa.binary()), part.column(2)], names=["toxic", "votes", "weight"])

    got = sample.mapInArrow(run, "toxic int, votes binary, weight double").collect()  # 2 * TRAIN_ROWS rows of VOTERS bits
    got.sort(key=lambda r: (r.toxic, bytes(r.votes)))  # sums of floats come out the same whatever task was first
    bits = np.array([np.frombuffer(r.votes, dtype=np.uint8) for r in got], dtype=np.uint8).reshape(len(got), -(-width // 8))
    return np.unpackbits(bits, axis=1, count=width).astype(float), np.array([r.toxic for r in got]), np.array([r.weight for r in got])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, voters: int = VOTERS) -> Model:
    """Voters, label model and classifier from the labelled rows that are not held out."""
    sample = stored(training_sample(docs, labels, rows), "training-sample")
    words, stems = mine_voters(sample, voters)
    number = {w: k for k, w in enumerate(words)}, {s: len(words) + k for k, s in enumerate(stems)}
    votes, gold, weight = _vote_table(sample, words, stems)
    if not len(gold) or gold.min() == gold.max():
        return Model(*number, np.append(np.full(len(words) + len(stems), 3.0), 0.0), -2.0)  # nothing to learn from: a voter decides
    posterior, _ = label_model(votes, gold, weight=weight)
    weights, bias = fit_linear(votes, posterior, weight=weight)
    return Model(*number, weights, bias)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # VOTERS entries at most

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in row_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([model.score(t) for t in part.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Null and empty texts get the score of a text without votes. Repeated rows
    each keep a row. Labels that are null, or whose doc_id is null or unknown,
    teach nothing.
    """
    scored = score_texts(docs, fit(docs, labels, rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5; columns stay.

    Text and row go through the scorer together, so equal doc_ids do not mix.
    """
    model = fit(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in row_slices(batches):
            yield part.filter(pa.array([model.score(t) < 0.5 for t in part.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
