"""Secret scans with a random forest against false positives.

Patterns propose candidates in every whole text: issued keys, private
key blocks, quoted values, values after secret names, passwords in addresses and
long mixed runs. A forest of decision trees over a
candidate's length, character transitions, coverage by dictionary words, path
and neighbouring words, trained on labelled findings, decides which ones stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.secret_findings import OTHER_NAMES, SECRET_NAMES, WORDS, labelled_findings

FINDINGS = 4000
TREES = 40
DEPTH = 9
LEAF_ROWS = 4
THRESHOLD = 0.5
#: Characters before and after a candidate that count as its neighbourhood.
NEAR = 48
REDACTED = "[redacted]"

RUN = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
#: Words of letters with a number at most behind each: what a value's name looks like.
VARIABLE = re.compile(r"[A-Za-z]+\d{0,3}(?:[_\-/]+[A-Za-z]*\d{0,3})*")
ASSIGNS = re.compile(r"[ \t]*(?:=[ \t]*[^\s=]|:[ \t]*[^\s:/])")
QUOTED = re.compile(r"""[=:]>?[^\w\s"']{0,4}\s?["']([^\s"']{8,})["']""")
#: Between a key's lines: quotes and signs of the text around, and line ends, escaped or not.
_SIGNS, _LINE_END = r"""[ \t"'`,>|#*;+]""", r"(?:[\r\n]|\\+[rn])"
_GAP = rf"{_SIGNS}*+{_LINE_END}(?:{_SIGNS}|{_LINE_END})*+"
_ALONE = rf"(?={_SIGNS}*+(?:[\r\n\\]|-----END|\Z))"
#: Markers with nothing but headers and base64 between them, and such a block without an end.
BLOCK = re.compile(
    rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_GAP}[A-Za-z][A-Za-z0-9\-]*+:[^\r\n\\]*+)*+(?:"
    rf"(?:(?:{_GAP}[A-Za-z0-9+/=]++{_ALONE})++|(?:[ \t]*+[A-Za-z0-9+/=]{{16,}}+)++(?:[ \t]++[A-Za-z0-9+/=]++)?)"
    rf"(?:{_SIGNS}|{_LINE_END})*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}[A-Za-z0-9+/=]{{32,}}+{_ALONE})++(?:{_LINE_END}[A-Za-z0-9+/=]++{_ALONE})?"
    rf"|(?:[ \t]*+[A-Za-z0-9+/=]{{32,}}+)++)"
)
#: A sign after a secret name, and the value that follows it, in quotes or not.
SIGN = re.compile("[=:]")
NAMED = re.compile(
    rf"(?:{'|'.join(SECRET_NAMES)})[\w.\-]{{0,16}}[\"'\]]?[^\w\s\"']{{0,4}}\s{{0,3}}$", re.I
)
VALUE = re.compile(r"""[=:]{1,2}>?(?:\*{3})?[ \t]{0,4}["']?([^\s"']{4,})""")
#: The password of an address.
LOGIN = re.compile(r"""://[^\s:/@"'<>]*+:([^\s/"'<>]+)@""")
TOKEN = re.compile(r"eyJ[\w\-]{8,}\.[\w\-]{8,}\.[\w\-]*")
ISSUED = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{30,}|sk-[\w\-]{20,}|[sr]k_live_\w{16,}|"
    r"xox[abprs]-[\w\-]{10,}|AIza[\w\-]{30,}|glpat-[\w\-]{16,}|npm_\w{30,}"
)
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")
CALM = re.compile(r"test|example|doc|fixture|sample|lock|vendor|mock|demo|readme", re.I)
CODE = re.compile(
    r"(?:\$\{?[a-z_.]+\}?|\{\{.*|<[^<>]*>|[a-z_.]+\(.*|[a-z_.]+\[.*|(?:[a-z_]+\.)+[a-z_]+)\W*", re.I
)
STAND_IN = re.compile(r"x{4,}|\*{3,}|your|insert|change|example|sample|dummy|placeholder|fake", re.I)


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Values after secret names; where one stands within another value, that one has it."""
    end = 0
    for sign in SIGN.finditer(text):
        at = sign.start()
        if at >= end and NAMED.search(text, max(0, at - NEAR), at):
            value = VALUE.match(text, at)
            if value:
                end = value.end(1)
                run = RUN.match(value[1])
                # Signs after a long run are not part of it; the run is a candidate itself.
                if not run or any(c.isalnum() for c in value[1][run.end() :]) or _plain(run[0]):
                    yield value.start(1), end - (value[1][-1] in ",;")


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Long runs of letters, digits and signs; signs of equality only as a base64's padding.

    A name that a value is assigned to is none, whatever its length.
    """
    for m in RUN.finditer(text):
        start, end = m.span()
        run = m[0].rstrip("=")
        named = VARIABLE.fullmatch(run) and ASSIGNS.match(text, start + len(run))
        if named and _worded(run):
            continue
        if len(m[0]) % 4 or len(m[0]) - len(run) + len(run) % 4 not in (0, 4):
            end = start + len(run)
        if not _plain(run):
            yield start, end


def _worded(name: str) -> bool:
    """Whether letters change their case as in words put together, not at random."""
    words = re.findall("[A-Z]?[a-z]+|[A-Z]+", name)
    return sum(map(len, words)) >= 3 * len(words)


def _plain(value: str) -> bool:
    return value.isalpha() and (value.islower() or value.isupper() or value.istitle())


def candidates(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in order, none within another."""
    found: list[tuple[int, int, str]] = []
    if "PRIVATE KEY" in text:
        found += [(*m.span(), "block") for m in BLOCK.finditer(text)]
    if "eyJ" in text:
        found += [(*m.span(), "token") for m in TOKEN.finditer(text)]
    found += [(*span, "run") for span in _runs(text)]
    if '"' in text or "'" in text:
        found += [(*m.span(1), "quoted") for m in QUOTED.finditer(text)]
    found += [(*span, "assigned") for span in _assigned(text)]
    if "://" in text:
        found += [(*m.span(1), "login") for m in LOGIN.finditer(text)]
    found.sort(key=lambda f: (f[0], -f[1]))
    out: list[tuple[int, int, str]] = []
    for f in found:
        if out and f[0] < out[-1][1]:
            if f[1] > out[-1][1]:
                out[-1] = (out[-1][0], f[1], out[-1][2])
            continue
        out.append(f)
    return out


def _kind(c: str) -> int:
    if c.isdigit():
        return 0
    if c.islower():
        return 1
    return 2 if c.isupper() else 3


def _covered(value: str) -> float:
    """Share of the characters that dictionary words cover."""
    low, inside = value.lower(), [False] * len(value)
    for word in WORDS:
        at = low.find(word)
        while at >= 0:
            inside[at : at + len(word)] = [True] * len(word)
            at = low.find(word, at + 1)
    return sum(inside) / max(1, len(value))


def _named(text: str, names: list[str]) -> float:
    """How near the last of some names stands before the end, 1 next to it."""
    low = text.lower()
    at = max(low.rfind(name) for name in names)
    return 0.0 if at < 0 else 1 - (len(low) - at) / (NEAR + 1)


def features(before: str, value: str, after: str, path: str) -> list[float]:
    before, after = before[-NEAR:], after[:NEAR]
    size = max(1, len(value))
    counts = Counter(value)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / size for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / size
    letters = [c for c in value.lower() if c.isalpha()]
    vowels = sum(c in "aeiou" for c in letters) / max(1, len(letters))
    steps = [abs(ord(a) - ord(b)) for a, b in zip(value, value[1:])]
    runs = re.findall(r"[A-Za-z]+", value)
    return [
        size,
        entropy,
        entropy / math.log2(size + 1),
        *share,
        changes,
        vowels,
        sum(s <= 1 for s in steps) / size,
        sum(steps) / size,
        len(counts) / size,
        max(map(len, runs), default=0) / size,
        _covered(value),
        float(all(c in "0123456789abcdefABCDEF" for c in value)),
        float(bool(UUID.fullmatch(value))),
        float(bool(ISSUED.match(value))),
        float(bool(STAND_IN.search(value))),
        float(bool(CODE.fullmatch(value))),
        float(bool(CALM.search(path or ""))),
        _named(before, SECRET_NAMES),
        _named(before, OTHER_NAMES),
        float(bool(re.search(r"[=:]\W{0,6}$", before))),
        float(bool(re.search(r"://[^\s:/@]*:$", before)) and after[:1] == "@"),
        float(before[-1:] in "\"'" and after[:1] in "\"'" and bool(before) and bool(after)),
    ]


@dataclass
class Tree:
    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH + 1):
            inner = self.feature[node] >= 0
            at = np.maximum(self.feature[node], 0)
            goes_low = x[np.arange(len(x)), at] <= self.limit[node]
            node = np.where(inner, np.where(goes_low, self.low[node], self.high[node]), node)
        return self.share[node]


def _best_split(x: np.ndarray, y: np.ndarray, draw: np.random.Generator):
    """Feature and limit of least Gini impurity among a few features drawn."""
    best = (np.inf, -1, 0.0)
    for f in draw.choice(x.shape[1], size=max(2, int(x.shape[1] ** 0.5) + 1), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        values, hits = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = hits[:-1], hits[-1] - hits[:-1]
        impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
        impurity[values[1:] <= values[:-1]] = np.inf
        impurity[: LEAF_ROWS - 1] = impurity[len(y) - LEAF_ROWS :] = np.inf
        i = int(impurity.argmin())
        if impurity[i] < best[0]:
            best = (impurity[i], int(f), (values[i] + values[i + 1]) / 2)
    return best


def _grow(x: np.ndarray, y: np.ndarray, draw: np.random.Generator) -> Tree:
    nodes: list[list] = [[-1, 0.0, 0, 0, y.mean()]]
    work = [(0, np.arange(len(y)), 0)]
    while work:
        at, rows, depth = work.pop()
        hits = y[rows].sum()
        if depth == DEPTH or len(rows) < 2 * LEAF_ROWS or hits in (0, len(rows)):
            continue
        impurity, f, limit = _best_split(x[rows], y[rows], draw)
        if not np.isfinite(impurity):
            continue
        goes_low = x[rows, f] <= limit
        nodes[at][:4] = [f, limit, len(nodes), len(nodes) + 1]
        for part in (rows[goes_low], rows[~goes_low]):
            work.append((len(nodes), part, depth + 1))
            nodes.append([-1, 0.0, 0, 0, y[part].mean()])
    columns = list(zip(*nodes))
    return Tree(*(np.array(c) for c in columns))


@dataclass
class Forest:
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0)


def train(findings: list[tuple], trees: int = TREES, seed: int = 17) -> Forest:
    """A forest from ``(before, value, after, path, label)``, each tree on its own draw."""
    x = np.array([features(*f[:4]) for f in findings])
    y = np.array([f[4] for f in findings], dtype=np.float64)
    draw = np.random.default_rng(seed)
    grown = []
    for _ in range(trees):
        rows = draw.integers(0, len(y), len(y))
        grown.append(_grow(x[rows], y[rows], draw))
    return Forest(grown)


def trained_forest(count: int = FINDINGS) -> Forest:
    return train(labelled_findings(count))


def find(forest: Forest, texts: list, paths: list) -> list[list[tuple[int, int, str, float]]]:
    """Secrets of each text as ``(start, end, kind, score)``; a batch at a time."""
    out: list[list] = [[] for _ in texts]
    found, rows = [], []
    for i, (text, path) in enumerate(zip(texts, paths)):
        for start, end, kind in candidates(text or ""):
            found.append((i, start, end, kind))
            before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
            rows.append(features(before, text[start:end], after, path or ""))
    if rows:
        scores = forest.predict(np.array(rows))
        for (i, start, end, kind), score in zip(found, scores.tolist()):
            if score >= THRESHOLD:
                out[i].append((start, end, kind, score))
    return out


def _scan(forest: Forest):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            rows = [
                (doc_id, start, end, kind, score, texts[i][start:end])
                for i, (doc_id, secrets) in enumerate(
                    zip(batch["doc_id"].astype("Int64"), find(forest, texts, batch["path"].tolist()))
                )
                for start, end, kind, score in secrets
            ]
            names = ["doc_id", "start", "end", "kind", "score", "value"]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def scan(docs: DataFrame, path: str = "source", forest: Forest | None = None) -> DataFrame:
    """One row for each secret: ``doc_id, start, end, kind, score, value_sha256``.

    Places count characters from 0; the value itself is not returned. Null and
    empty texts have no secrets, a document without the ``path`` column or value
    has an empty path, repeated rows each have their secrets, also such without an
    id. Texts are read whole whatever their length, no rows give none. Other columns
    are left aside whatever their names.
    """
    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        where.alias("path"),
    )
    found = rows.mapInPandas(
        _scan(forest or trained_forest()),
        "doc_id long, start long, end long, kind string, score double, value string",
    )
    return found.select(
        "doc_id", "start", "end", "kind", "score", F.sha2("value", 256).alias("value_sha256")
    )


def _redactor(forest: Forest):
    @F.pandas_udf("string")
    def redact(text: pd.Series, path: pd.Series) -> pd.Series:
        out = []
        for value, secrets in zip(text, find(forest, text.tolist(), path.tolist())):
            for start, end, _, _ in reversed(secrets):
                value = value[:start] + REDACTED + value[end:]
            out.append(value)
        return pd.Series(out, dtype=object)

    return redact


def redact(docs: DataFrame, path: str = "source", forest: Forest | None = None) -> DataFrame:
    """All rows and columns as they are, with each secret in ``text`` replaced.

    Where a text changes, ``n_chars`` follows it if there is such a column. Null,
    empty and clean texts stay as they are, very long ones are read whole, repeated
    rows all stay, no rows give none.
    """
    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    clean = _redactor(forest or trained_forest())(F.col("text"), where)
    out = docs.withColumn("text", clean)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    changed = F.contains("text", F.lit(REDACTED))
    size = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size)
