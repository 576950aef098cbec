"""Toxic passages as maximal scoring segments of token log-odds.

Fit, on a bounded sample of labelled rows (``max_training``): count in how many toxic and clean texts each
form occurs. The forms of a word are the word and its stems of ``STEMS`` leading letters, so that an
inflection never seen in training is weighed by its stem. A form's weight is a lower bound of its log-odds between
the classes under an informative Dirichlet prior (the form's share of all texts, times ``PRIOR_TEXTS``); forms whose
weight reaches a bar make up the lexicon. All other words weigh ``-DRIFT``, and the k-th occurrence of a word
in a text has a k-th of its weight, since words come in bursts.

Score, on whole texts: a linear scan finds all maximal scoring segments. Their scores S follow an
extreme-value law in clean text: about K * words * exp(-lambda * S) segments reach S by chance. Lambda and K are
fitted to the segments of clean training texts, each scored without its own counts. A text's evidence is the sum
statistic over its best segments, max over r of lambda * (S1 + .. + Sr) - r * ln(K * words) + ln r!, at
least 0. A logistic curve fitted to the evidence of the training rows turns it into a probability.

Rules for odd input: null and empty texts have no segment and evidence 0; a row with a null id, or with a label for
one class only in the whole table, is never trained on; copies of a text count once in training; several labels of one
document count as the highest; without rows of both classes every score is 0; other columns are untouched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, staged

STEMS = (6, 5, 4)
PRIOR_TEXTS = 50.0
#: A weight is the log-odds less so many standard errors, so that chance finds among rare forms weigh little.
ERRORS = 1.25
#: Weaker forms than ``bar`` weigh as neutral words, so that text without toxic words drifts downwards.
#: The more texts, the more forms are tried, so the bar rises with the logarithm of their number.
BAR, BAR_PER_LOG_TEXT = 0.3, 0.15
DRIFT = 0.3
#: Segments under this score are not counted when the extreme-value law is fitted.
ISLAND = 1.0
#: The fit reads at most so many labelled rows, those with the smallest hash of their id.
MAX_TRAINING = 20_000
#: A passage is significant if chance makes at most so many of its score in a text of the same length.
CHANCE = 0.05
REJECT = 0.7
BIN = 0.25
BINS = 400

WORD = re.compile(r"\w+")
PASSAGE = "array<struct<first_word:int,last_word:int,score:double>>"


def is_held_out(id_col: str) -> Column:
    """True for a third of all ids, which the fit never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def forms(word: str) -> list[str]:
    """The word, then its stems, longest first; a stem ends in ``~``."""
    return [word, *(f"{word[:n]}~" for n in STEMS if len(word) > n)]


def bar(texts: int) -> float:
    return BAR + BAR_PER_LOG_TEXT * math.log(max(texts, 1))


@dataclass(frozen=True)
class Counts:
    """Texts of each class, and how many of each contain a form."""

    toxic: int
    clean: int
    of_form: dict[str, tuple[int, int]]

    def weight(self, form: str, less_toxic: int = 0, less_clean: int = 0) -> float:
        """Weight of a form if it reaches the lexicon, else 0; optionally without one text."""
        if form not in self.of_form:
            return 0.0
        with_toxic, with_clean = self.of_form[form]
        bound = lower_log_odds(
            with_toxic - less_toxic,
            with_clean - less_clean,
            self.toxic - less_toxic,
            self.clean - less_clean,
        )
        return bound if bound >= bar(self.toxic + self.clean) else 0.0


def lower_log_odds(with_toxic: int, with_clean: int, toxic: int, clean: int) -> float:
    """Log-odds ratio under the informative Dirichlet prior, less ``ERRORS`` standard errors."""
    if with_toxic <= 0 or clean <= 0:
        return 0.0
    prior = PRIOR_TEXTS * (with_toxic + with_clean) / (toxic + clean)
    a, b = with_toxic + prior, with_clean + prior
    odds = math.log(a / (toxic + PRIOR_TEXTS - a)) - math.log(b / (clean + PRIOR_TEXTS - b))
    return odds - ERRORS * math.sqrt(1 / a + 1 / b)


class Weights(dict):
    """The weight of each word, looked up once; forgotten when it has grown large."""

    def __init__(self, counts: Counts, less_toxic: int = 0, less_clean: int = 0):
        super().__init__()
        self.counts, self.less = counts, (less_toxic, less_clean)

    def __missing__(self, word: str) -> float:
        if len(self) > 150_000:
            self.clear()
        found = max(self.counts.weight(form, *self.less) for form in forms(word))
        self[word] = found if found > 0 else 0.0
        return self[word]


def maximal_segments(places: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text.

    ``places`` are the words of positive weight; every other word weighs ``-DRIFT``. A segment is kept as
    (first, last, total before it, total at its end, the nearest segment before it that starts lower). A new one
    follows these links back to the nearest that starts lower, and absorbs all from there on if its own end
    is higher than that one's; the links skip what cannot start lower, so the scan is linear.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total, previous = 0.0, -1
    for place, weight in zip(places.tolist(), weights.tolist(), strict=True):
        total -= DRIFT * (place - previous - 1)
        first, before = place, total
        total, previous = total + weight, place
        back = len(found) - 1
        while True:
            while back >= 0 and found[back][2] >= before:
                back = found[back][4]
            if back < 0 or found[back][3] >= total:
                break
            first, _, before, _, lower = found[back]
            del found[back:]
            back = lower
        found.append((first, place, before, total, back))
    return [(first, last, end - before) for first, last, before, end, _ in found]


def segments_of(tokens: list[str], weights: Weights) -> list[tuple[int, int, float]]:
    values = np.fromiter(map(weights.__getitem__, tokens), dtype=np.float64, count=len(tokens))
    places = np.flatnonzero(values)
    if not len(places):
        return []
    seen: Counter = Counter()
    for place in places.tolist():
        seen[tokens[place]] += 1
        values[place] /= seen[tokens[place]]
    return maximal_segments(places, values[places])


def evidence(scores: list[float], n_words: int, law: tuple[float, float]) -> float:
    """The sum statistic of the best segments; 0 where chance explains them."""
    rate, constant = law
    expected = math.log(max(constant * max(n_words, 1), 1e-300))
    best = total = 0.0
    for r, score in enumerate(sorted(scores, reverse=True), start=1):
        total += rate * score - expected + math.log(r)
        best = max(best, total)
    return best


@dataclass(frozen=True)
class Model:
    counts: Counts
    law: tuple[float, float]
    slope: float
    shift: float

    def probability(self, found: float) -> float:
        if not self.counts.toxic or not self.counts.clean:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.slope * found + self.shift))))


def training_rows(docs: DataFrame, labels: DataFrame, max_training: int) -> DataFrame:
    """Distinct labelled texts outside the held-out third, of at most ``max_training`` ids."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out("doc_id"))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_training)
    )
    texts = docs.select(F.col("doc_id").alias("train_id"), F.col("text").alias("train_text"))
    return (
        texts.join(F.broadcast(chosen), F.col("train_id") == F.col("label_id"))
        .groupBy(F.sha2(F.coalesce("train_text", F.lit("")), 256).alias("text_key"))
        .agg(F.first("train_text").alias("text"), F.max("label").alias("label"))
        .select("text", "label")
    )


def _count_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts per form and class, combined within the task; the form '' counts the texts themselves."""
    tallies = (Counter(), Counter())

    def flush() -> pd.DataFrame:
        names = list(tallies[0] | tallies[1])
        out = pd.DataFrame(
            {
                "form": names,
                "with_clean": [tallies[0][x] for x in names],
                "with_toxic": [tallies[1][x] for x in names],
            }
        )
        tallies[0].clear()
        tallies[1].clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            seen = {""}
            for word in set(words(text)):
                seen.update(forms(word))
            tallies[int(label > 0)].update(seen)
            if len(tallies[0]) + len(tallies[1]) > 300_000:
                yield flush()
    if tallies[0] or tallies[1]:
        yield flush()


def fit_counts(training: DataFrame) -> Counts:
    """Class sizes and the counts of all forms of the lexicon, which are among those of a bounded number of rows."""
    counted = training.mapInPandas(
        _count_forms, "form string, with_clean long, with_toxic long"
    ).groupBy("form").agg(F.sum("with_clean").alias("with_clean"), F.sum("with_toxic").alias("with_toxic"))
    # A form of one toxic text only cannot reach the lexicon.
    counted = staged(counted.filter((F.col("with_toxic") >= 2) | (F.col("form") == "")), "forms")
    sizes = counted.filter("form = ''").collect()
    clean, toxic = (sizes[0]["with_clean"], sizes[0]["with_toxic"]) if sizes else (0, 0)
    if not clean or not toxic:
        return Counts(toxic, clean, {})
    # A text of its own class is left out in the calibration, so one clean text less must do too.
    a_share = (F.col("with_toxic") + F.col("with_clean")) * (PRIOR_TEXTS / (toxic + clean))
    fewer_clean = F.greatest(F.col("with_clean") - 1, F.lit(0))
    a, b = F.col("with_toxic") + a_share, fewer_clean + a_share
    odds = F.log(a / (toxic + PRIOR_TEXTS - a)) - F.log(b / (clean + PRIOR_TEXTS - b))
    lexicon = (
        counted.filter("form <> ''")
        .withColumn("weight", odds - ERRORS * F.sqrt(1 / a + 1 / b))
        .filter(F.col("weight") >= bar(toxic + clean))
        .collect()
    )
    return Counts(toxic, clean, {r["form"]: (r["with_toxic"], r["with_clean"]) for r in lexicon})


def _without_own(counts: Counts) -> dict[int, Weights]:
    """Weights for training texts of each class, without the text itself."""
    return {0: Weights(counts, 0, 1), 1: Weights(counts, 1, 0)}


def fit_law(training: DataFrame, counts: Counts) -> tuple[float, float]:
    """Lambda and K from the segments of clean texts ("islands") over the score ``ISLAND``."""

    def islands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = _without_own(counts)[0]
        for batch in batches:
            n_words = n_islands = 0
            excess = 0.0
            for text in batch["text"]:
                tokens = words(text)
                n_words += len(tokens)
                over = [s - ISLAND for _, _, s in segments_of(tokens, weights) if s > ISLAND]
                n_islands += len(over)
                excess += sum(over)
            yield pd.DataFrame({"n_words": [n_words], "n_islands": [n_islands], "excess": [excess]})

    row = (
        training.filter("label = 0")
        .mapInPandas(islands, "n_words long, n_islands long, excess double")
        .agg(F.sum("n_words"), F.sum("n_islands"), F.sum("excess"))
        .first()
    )
    n_words, n_islands, excess = (x or 0 for x in row)
    # Scores are log-odds, for which lambda is 1 in theory: that is worth five islands.
    rate = (n_islands + 5.0) / (excess + 5.0)
    return rate, (n_islands + 0.5) * math.exp(rate * ISLAND) / max(n_words, 1)


def fit_curve(training: DataFrame, counts: Counts, law: tuple[float, float]) -> tuple[float, float]:
    """Slope and shift of the logistic curve over binned evidence; at most ``BINS`` rows a class come here."""

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = _without_own(counts)
        for batch in batches:
            tally: Counter = Counter()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                tokens, y = words(text), int(label > 0)
                scores = [s for _, _, s in segments_of(tokens, weights[y])]
                tally[min(BINS - 1, int(evidence(scores, len(tokens), law) / BIN)), y] += 1
            yield pd.DataFrame([(b, y, n) for (b, y), n in tally.items()], columns=["bin", "y", "n"])

    rows = training.mapInPandas(binned, "bin int, y int, n long").groupBy("bin", "y").sum("n").collect()
    x, y, n = (np.array(c, dtype=float) for c in zip(*rows, strict=True))
    return logistic(x * BIN, y, n)


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit by damped Newton steps, towards targets just inside 0 and 1."""
    positive, negative = n[y == 1].sum(), n[y == 0].sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.column_stack([x, np.ones_like(x)])
    beta = np.array([0.0, math.log((positive + 1) / (negative + 1))])

    def loss(b: np.ndarray) -> float:
        line = design @ b
        return float((n * (np.logaddexp(0, line) - target * line)).sum() + 1e-3 * b[0] ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (n * (p - target)) + np.array([2e-3 * beta[0], 0.0])
        bend = design.T @ (design * (n * np.maximum(p * (1 - p), 1e-9))[:, None]) + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> Model:
    training = staged(training_rows(docs, labels, max_training), "training")
    counts = fit_counts(training)
    if not counts.toxic or not counts.clean:
        return Model(counts, (1.0, 1.0), 0.0, 0.0)
    law = fit_law(training, counts)
    return Model(counts, law, *fit_curve(training, counts, law))


def significant(segments: list[tuple[int, int, float]], n_words: int, law: tuple[float, float]) -> list[tuple[int, int, float]]:
    """The segments that chance explains too seldom."""
    rate, constant = law
    least = (math.log(max(constant * max(n_words, 1), 1e-300)) - math.log(CHANCE)) / rate
    return [segment for segment in segments if segment[2] >= least]


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``doc`` (all columns as a struct) and ``found``: probability, evidence and significant passages of each text."""

    @F.pandas_udf(f"struct<score:double,evidence:double,n_words:int,passages:{PASSAGE}>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = Weights(model.counts)
        for texts in parts:
            rows = []
            for text in texts:
                tokens = words(text)
                segments = segments_of(tokens, weights)
                total = evidence([s for _, _, s in segments], len(tokens), model.law)
                passages = significant(segments, len(tokens), model.law)
                rows.append((model.probability(total), total, len(tokens), passages))
            yield pd.DataFrame(rows, columns=["score", "evidence", "n_words", "passages"])

    return docs.select(as_row(docs), found(F.col(text_col)).alias("found"))


def keep_clean(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """``docs`` without those whose probability reaches ``reject``."""
    return score(docs, model).filter(F.col("found.score") < reject).select("doc.*")
