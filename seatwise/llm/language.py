"""Language identification with blended-spectrum string kernels.

Two texts are compared by the n-grams of one to four characters that occur in
both (presence, not counts), each length weighing alike, normalised by the
texts' own sizes. Nystroem landmarks stand in for the whole training sample and
a kernel ridge regression against each language is solved in their space.
Because the kernel is an inner product of presence vectors, ``K(x, landmarks) @
alpha`` is computed as ``presence(x) @ (landmarks.T @ alpha)``: one matrix
product for a batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import mix

GRAMS = (1, 2, 3, 4)
#: Places of the presence vector, so many for each n-gram length.
BITS = 14
#: Labelled rows a model is fitted on at most, languages in turn.
SAMPLE_ROWS = 2400
#: Each training row is learnt whole, and a second time as an excerpt of one of these
#: lengths from a place drawn by the row's hash.
EXCERPTS = (30, 90)
LANDMARKS = 400
RIDGE = 1e-3
#: Steepness of the score over the difference of the two best regressions.
STEEPNESS = 6.0
BATCH_ROWS = 64
CHUNK_CHARS = 1 << 18

UNKNOWN = "und"


def _codes(text: str) -> np.ndarray:
    folded = " " + " ".join(text.lower().split()) + " "
    return np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def gram_places(text: str) -> np.ndarray:
    """Places of the presence vector that a text's n-grams set, repeats included.

    Case is folded and white space becomes one space. Digits, signs and letters
    all count as characters.
    """
    codes = _codes(text)
    out = []
    for i, n in enumerate(GRAMS):
        if len(codes) < n:
            break
        key = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        for k in range(n):
            key = key * np.uint64(0x110000) + codes[k : len(codes) - n + 1 + k]
        place = (mix(key, n) >> np.uint64(64 - BITS)).astype(np.int64)
        out.append(place + (i << BITS))
    return np.concatenate(out)


def packed_presence(text: str) -> bytes:
    """Presence of each n-gram of a whole text, a bit a place.

    Texts are read a piece at a time with an overlap, so memory does not follow them.
    """
    out = np.zeros(len(GRAMS) << BITS, dtype=bool)
    for at in range(0, len(text), CHUNK_CHARS):
        out[gram_places(text[max(0, at - 8) : at + CHUNK_CHARS])] = True
    return np.packbits(out).tobytes()


def presence(packed: list[bytes]) -> np.ndarray:
    """One row a text: presence of each n-gram, scaled to length one.

    Each n-gram length contributes the same to a text's length.
    """
    bits = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)
    out = np.unpackbits(bits, axis=1).astype(np.float32)
    by_length = out.reshape(len(packed), len(GRAMS), 1 << BITS)
    size = np.sqrt(by_length.sum(axis=2, keepdims=True) * len(GRAMS))
    by_length /= np.maximum(size, 1)
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores; ``und`` and 0 for null and for no letter at all."""
        found = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        for at in range(0, len(rows), BATCH_ROWS):
            some = rows[at : at + BATCH_ROWS]
            fits = presence([packed_presence(texts[i]) for i in some]) @ self.weights
            e = np.exp(STEEPNESS * (fits - fits.max(axis=1, keepdims=True)))
            share = e / e.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            for i, b, s in zip(some, best, share[np.arange(len(some)), best]):
                found[i], scores[i] = self.languages[b], float(s)
        return found, scores


def fit(texts: list[bytes], langs: list[str]) -> LanguageModel:
    """Kernel ridge regression, one language against the rest, over landmarks.

    ``texts`` are the packed presences of texts. Landmarks are taken evenly from the
    rows given, which come languages in turn. Without rows the model knows no language
    and predicts ``und``.
    """
    languages = sorted(set(langs))
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((len(GRAMS) << BITS, 1), dtype=np.float32))
    step = max(1, len(texts) // LANDMARKS)
    marks = presence(texts[::step][:LANDMARKS])
    inner = marks @ marks.T
    gram = np.zeros((len(marks), len(marks)))
    right = np.zeros((len(marks), len(languages)))
    for at in range(0, len(texts), BATCH_ROWS):
        seen = (presence(texts[at : at + BATCH_ROWS]) @ marks.T).astype(np.float64)
        goal = np.array(
            [[1.0 if x == y else -1.0 for y in languages] for x in langs[at : at + BATCH_ROWS]]
        )
        gram += seen.T @ seen
        right += seen.T @ goal
    ridge = RIDGE * len(texts)
    jitter = 1e-6 * np.eye(len(marks))
    alpha = np.linalg.solve(gram + ridge * inner + jitter, right)
    return LanguageModel(languages, (marks.T @ alpha.astype(np.float32)).astype(np.float32))


def _sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packed presence of whole texts and of an excerpt of each."""
    for batch in batches:
        whole, parts = [], []
        for text, draw in zip(batch["text"], batch["draw"].tolist()):
            size = EXCERPTS[len(text) % 2]
            at = draw % max(1, len(text) - size + 1)
            whole.append(packed_presence(text))
            parts.append(packed_presence(text[at : at + size]))
        yield pd.DataFrame(
            {"lang": batch["lang"], "turn": batch["turn"], "whole": whole, "excerpt": parts}
        )


def training_sample(docs: DataFrame, most: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """About ``most`` labelled texts, never more, the languages in turn.

    ``docs`` has ``doc_id``, ``text`` and ``lang``. Rows are drawn by a hash of
    the id, each language at a rate that follows from its count; of more than
    ``most`` languages the rarest have no row. Whole texts are read where they lie;
    what comes back is their presence, 8 KB a text.
    """
    langs = docs.where(F.col("lang").isNotNull()).groupBy("lang").count()
    counts = {r[0]: r[1] for r in langs.orderBy(F.desc("count"), "lang").limit(most).collect()}
    quota = max(1, most // max(1, len(counts)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    wanted = F.lit(False)
    for lang, count in counts.items():
        rate = min(1.0, 2 * quota / count)
        wanted |= (F.col("lang") == lang) & (draw < int(rate * (1 << 40)))
    chosen = docs.where(wanted & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        draw.alias("draw"),
    )
    order = Window.partitionBy("lang").orderBy("draw", "text")
    first = chosen.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= quota)
    packed = first.select("lang", "turn", "text", "draw").mapInPandas(
        _sampled, "lang string, turn int, whole binary, excerpt binary"
    )
    rows = packed.orderBy("turn", "lang").collect()
    # Short texts hold few n-grams, so the model sees excerpts of rows as well.
    turns = [(bytes(t), r["lang"]) for r in rows for t in (r["whole"], r["excerpt"])]
    return [t for t, _ in turns], [y for _, y in turns]


def _predict(model: LanguageModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores = model.predict(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "lang_pred": langs,
                    "score": scores,
                }
            )

    return run


def accepts(model: LanguageModel, lowest: float):
    """A column function of ``text``: whether its language is known well enough."""
    nothing = model.languages == [UNKNOWN]

    @F.pandas_udf("boolean")
    def accept(text: pd.Series) -> pd.Series:
        langs, scores = model.predict(text.tolist())
        # A model without languages tells texts with a letter by their score only.
        known = scores > 0 if nothing else np.array([y != UNKNOWN for y in langs], dtype=bool)
        return pd.Series(known & (scores >= lowest))

    return accept


def held_out(doc_id: str = "doc_id"):
    """Rows no model may learn from; a null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def keep_identified(docs: DataFrame, lowest: float = 0.0) -> DataFrame:
    """The rows whose language is recognised, all columns as they are.

    ``und`` and scores under ``lowest`` go. By default that is null and empty texts
    and texts without a letter: a few words may fit two languages and still be
    good text. Copies of a row stay or go together. Where no row has a ``lang`` to
    learn from, every text with a letter stays. No rows give none.
    """
    model = fit(*training_sample(docs.where(~held_out())))
    return docs.where(accepts(model, lowest)(F.col("text").cast("string")))


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row for each input row.

    Learns from the rows not held out that have a text and a ``lang``; predicts
    from ``text`` alone. Equal texts get equal predictions; null and empty texts and
    texts without a letter are ``und`` with score 0, and where there is nothing to
    learn from all are ``und``. A null id is held out. Texts are read whole whatever
    their length, repeated rows each have their row, no rows give none. Other columns
    are left aside whatever their names.
    """
    model = fit(*training_sample(docs.where(~held_out())))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out().alias("held_out"),
    )
    return rows.mapInPandas(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double"
    )
