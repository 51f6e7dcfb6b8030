"""Toxicity by maximum-scoring segments.

Every word scores its log-odds between toxic and clean rows under a Dirichlet
prior; words that say nothing cost a small amount each. A linear-time scan finds
every maximal-scoring passage of a text. Long clean texts reach high scores by
chance, so a passage counts by its expected number in a clean text of the same
length, ``K n exp(-lambda S)``, and a text by the evidence of all its
significant passages, turned into a probability on the labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import stored

#: Labelled rows a model is fitted on at most.
SAMPLE_ROWS = 24_000
#: Words of the lexicon at most; the sample bounds the rest of the model.
LEXICON_WORDS = 50_000
#: Dirichlet prior: so many words dealt out by their overall share, and so many for
#: each word, between the labels as the words of all rows are. Without that a word
#: seen once, in a toxic row, would count against every text it comes up in.
PRIOR_WORDS = 1000.0
PRIOR_EACH = 4.0
#: Standard deviations a word's log-odds are lowered by, and what then must remain.
#: Of these the one is taken under which either half of the sample tells most about
#: the other: few labelled rows call for less of it than many.
CAUTIONS = (1.5, 2.0, 2.5, 3.0)
LEAST_SCORE = 1.25
#: What a word outside the lexicon costs.
DRIFT = 0.1
PREDICTED_FROM = 0.7
#: Two halves of the sample, each scored with the other's lexicon for calibration.
FOLDS = 2

#: Beginnings of words that are scored like words, for words not seen before.
STEMS = (4, 5)

WORD = re.compile(r"[^\W_]+")


def signs_of(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer ones marked with a star."""
    return words.union(w[:n] + "*" for w in words for n in STEMS if len(w) > n)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments as (score, first word, last word).

    ``hits`` are the words of positive score by place; every other place costs
    ``drift``. Each stacked candidate knows the nearest one before it whose left
    sum is lower, which keeps the scan linear.
    """
    stack: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, -1
    for place, score in hits:
        left = total - drift * (place - last - 1)
        right = left + score
        total, last = right, place
        first = place
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, place, j))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(right - left, first, end) for left, right, first, end, _ in stack]


@dataclass
class ToxicModel:
    lexicon: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    chance: float = 1.0
    offset: float = -20.0
    slope: float = 0.0

    def passages(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        words = words_of(text)
        known = {w: s for w in set(words) if (s := self.word_score(w)) > 0}
        hits, seen = [], {}
        if known:
            for i, w in enumerate(words):
                if w in known:
                    # A word that comes again says less each time.
                    seen[w] = seen.get(w, 0) + 1
                    hits.append((i, known[w] / seen[w]))
        return len(words), segments(hits, DRIFT)

    def word_score(self, word: str) -> float:
        """The best of the word's own score and those of its beginnings."""
        get = self.lexicon.get
        best = get(word, 0.0)
        for n in STEMS:
            if len(word) > n:
                best = max(best, get(word[:n] + "*", 0.0))
        return best

    def evidence(self, n: int, found: list[tuple[float, int, int]]) -> float:
        base = math.log(max(self.chance * max(n, 1), 1e-300))
        return sum(max(0.0, self.decay * score - base) for score, _, _ in found)

    def probability(self, evidence: float) -> float:
        x = self.offset + self.slope * evidence
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the sample that hold a word or beginning, by fold and label."""
    counts: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for fold, toxic, text in zip(batch["fold"], batch["toxic"], batch["text"]):
            counts.setdefault((int(fold), int(toxic)), Counter()).update(signs_of(set(words_of(text))))
    for (fold, toxic), found in counts.items():
        yield pd.DataFrame(
            {"word": list(found), "fold": fold, "toxic": toxic, "n": list(found.values())}
        )


def lexicon(counts: DataFrame) -> list[tuple[str, float, float, float]]:
    """Words that speak for toxicity: log-odds, their deviation, the clean share.

    ``counts`` has ``word``, ``toxic_n``, ``clean_n``. Everything but the words
    kept is summed up on the cluster.
    """
    total = counts.agg(F.sum("toxic_n"), F.sum("clean_n")).first()
    toxic, clean = float(total[0] or 0), float(total[1] or 0)
    if not toxic or not clean:
        return []
    share = (F.col("toxic_n") + F.col("clean_n")) / (toxic + clean)
    prior = F.lit(PRIOR_EACH) + F.lit(PRIOR_WORDS) * share
    bad = toxic / (toxic + clean)
    a, b = F.col("toxic_n") + prior * bad, F.col("clean_n") + prior * (1 - bad)
    in_toxic, in_clean = toxic + PRIOR_WORDS * bad, clean + PRIOR_WORDS * (1 - bad)
    odds = F.log(a / (in_toxic - a)) - F.log(b / (in_clean - b))
    deviation = F.sqrt(1 / a + 1 / b)
    score = F.col("odds") - min(CAUTIONS) * F.col("deviation")
    rows = (
        counts.where("toxic_n > 0")
        .select(
            "word",
            odds.alias("odds"),
            deviation.alias("deviation"),
            (b / in_clean).alias("share"),
        )
        .where(score > LEAST_SCORE)
        .orderBy(score.desc(), "word")
        .limit(LEXICON_WORDS)
        .collect()
    )
    return [tuple(r) for r in rows]


def cautious(words: list[tuple[str, float, float, float]], caution: float) -> ToxicModel:
    """A model of the words that still score after ``caution`` deviations."""
    scores, shares = {}, {}
    for word, odds, deviation, share in words:
        if (score := odds - caution * deviation) > LEAST_SCORE:
            scores[word], shares[word] = score, share
    return ToxicModel(scores, decay_rate(scores, shares))


def decay_rate(scores: dict[str, float], shares: dict[str, float]) -> float:
    """The positive lambda with ``E[exp(lambda s)] = 1`` over a clean text's words."""
    if not scores:
        return 1.0
    s = np.array([scores[w] for w in scores])
    p = np.array([shares[w] for w in scores])
    p = p * min(1.0, 0.5 / p.sum(), 0.5 * DRIFT / max((p * s).sum(), 1e-12))

    def excess(rate: float) -> float:
        return float((p * np.exp(rate * s)).sum() + (1 - p.sum()) * math.exp(-rate * DRIFT)) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(high, 1e-3)


def _scan_folds(models: dict[tuple[float, int], ToxicModel]):
    """Passages of each row under the models of every caution learnt without it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for fold, toxic, text in zip(batch["fold"], batch["toxic"], batch["text"]):
                for caution in CAUTIONS:
                    n, found = models[caution, int(fold)].passages(text)
                    rows.append((caution, int(fold), int(toxic), n, [s for s, _, _ in found]))
            yield pd.DataFrame(rows, columns=["caution", "fold", "toxic", "n", "scores"])

    return run


def _loss(x: np.ndarray, y: np.ndarray, offset: float, slope: float) -> float:
    """Mean negative log-likelihood of the labels."""
    z = np.clip(offset + slope * x, -30, 30)
    return float(np.mean(np.logaddexp(0, z) - y * z))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope by Newton steps; a weak prior keeps separable data finite."""
    w = np.zeros(2)
    z = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        ridge = np.array([1e-3, 1e-2])
        step = np.linalg.solve(
            (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w
        )
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(sample: DataFrame) -> ToxicModel:
    """A model from ``sample(text, toxic, fold)``, a bounded table.

    Without rows of either label nothing is learnt and every score is next to 0.
    """
    counts = stored(
        sample.mapInPandas(_count_words, "word string, fold int, toxic int, n long")
        .groupBy("word")
        .agg(
            *(
                F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0))
                .alias(f"n{f}{y}")
                for f in range(FOLDS)
                for y in (0, 1)
            )
        ),
        "word-counts",
    )

    def pick(folds) -> list[tuple[str, float, float, float]]:
        return lexicon(
            counts.select(
                "word",
                sum(F.col(f"n{f}1") for f in folds).alias("toxic_n"),
                sum(F.col(f"n{f}0") for f in folds).alias("clean_n"),
            )
        )

    words = {f: pick([g for g in range(FOLDS) if g != f]) for f in range(FOLDS)}
    others = {(c, f): cautious(words[f], c) for c in CAUTIONS for f in range(FOLDS)}
    schema = "caution double, fold int, toxic int, n int, scores array<double>"
    seen = sample.mapInPandas(_scan_folds(others), schema).collect()
    found = {}
    for caution in CAUTIONS:
        x, y = [], []
        for fold in range(FOLDS):
            rows = [r for r in seen if r["caution"] == caution and r["fold"] == fold]
            part = others[caution, fold]
            part.chance = _chance(rows, part.decay)
            x += [part.evidence(r["n"], [(s, 0, 0) for s in r["scores"]]) for r in rows]
            y += [r["toxic"] for r in rows]
        x, y = np.array(x, dtype=float), np.array(y, dtype=float)
        if not 0 < y.sum() < len(y):
            return ToxicModel()
        line = _logistic(x, y)
        found[caution] = (_loss(x, y, *line), line)
    caution = min(CAUTIONS, key=lambda c: (found[c][0], -c))
    model = cautious(pick(range(FOLDS)), caution)
    model.chance = float(np.mean([others[caution, f].chance for f in range(FOLDS)]))
    if model.lexicon:
        model.offset, model.slope = found[caution][1]
    return model


def _chance(rows: list, decay: float) -> float:
    """K by maximum likelihood from the best passages of the clean rows."""
    clean = [r for r in rows if r["toxic"] == 0 and r["n"]]
    total = sum(r["n"] * math.exp(-decay * max([0.0, *r["scores"]])) for r in clean)
    return len(clean) / total if total else 1.0


def held_out(doc_id: str = "doc_id"):
    """Rows no model may learn from; a null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Texts with their label and fold, for at most ``most`` labelled ids.

    An id labelled both ways counts as toxic. The chosen ids are few by
    construction, so they are broadcast and no other text moves. Of texts with the
    same two smallest word hashes and label, nearly all of them copies, one stays:
    a text that was copied often must not make all its words look toxic.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
        .withColumn("draw", F.xxhash64("id", F.lit("sample")))
        .orderBy("draw", "id")
        .limit(most)
        .select("id", "toxic", "draw", F.pmod("draw", F.lit(FOLDS)).cast("int").alias("fold"))
    )
    texts = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    )
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")

    def least(n: int):
        return F.array_min(F.transform(words, lambda w: F.xxhash64(w, F.lit(n))))

    chosen = texts.join(F.broadcast(known), "id")
    one = F.min(F.struct("draw", "id", "fold", "text")).alias("one")
    rows = chosen.groupBy(least(0).alias("least0"), least(1).alias("least1"), "toxic").agg(one)
    return stored(rows.select("one.text", "toxic", "one.fold"), "labelled")


def _score(model: ToxicModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, passages = [], []
            for text in batch["text"]:
                n, found = model.passages(text)
                scores.append(model.probability(model.evidence(n, found)))
                passages.append(
                    [
                        {"first_word": a, "last_word": b, "score": s}
                        for s, a, b in found
                        if model.evidence(n, [(s, a, b)]) > 0
                    ]
                )
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")})
            out["held_out"] = batch["held_out"]
            out["score"] = scores
            out["predicted"] = [int(s >= PREDICTED_FROM) for s in scores]
            out["passages"] = passages
            yield out

    return run


SCHEMA = (
    "doc_id long, held_out boolean, score double, predicted int, "
    "passages array<struct<first_word:int,last_word:int,score:double>>"
)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted, passages)``, one row for each input row.

    Scores come from ``text`` alone; null and empty texts score the base rate of
    a text without evidence, equal texts score the same. ``passages`` are the
    significant ones, words counted from 0. A null id is held out. Texts are read
    whole whatever their length, repeated rows each have their row, no rows give
    none. An id labelled both ways is toxic, null labels are none; without labels of
    both kinds every score is next to 0. Only ``doc_id`` and ``text`` are read, other
    columns are left aside whatever their names.
    """
    model = fit(training_sample(docs, labels))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out().alias("held_out"),
    )
    return rows.mapInPandas(_score(model), SCHEMA)
