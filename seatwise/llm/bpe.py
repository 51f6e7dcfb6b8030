"""Encoding and decoding with a public BPE vocabulary.

Long texts are encoded as a tree: halves are encoded apart, on any machine, and
at each join a window around it is encoded again and grown until it agrees with
both sides. Agreement on one token at either side is exact for this kind of
vocabulary: BPE gives a sequence of tokens if and only if it gives each adjacent
pair, and the splitting pattern reads only forward.

The result is that of the tokenizers library on the whole text with
``add_special_tokens=False``; a null text counts as empty. Every input row gives
one row, repeated or not.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import chunks

#: Texts longer than this many characters are halved.
LEAF_CHARS = 65_536
#: Characters on each side of a join in the first window.
WINDOW = 64
#: No match of the splitting pattern and no special token looks further than this.
REACH = 16
#: Pieces of words kept by a task for words that come again.
CACHE_WORDS = 200_000
#: Characters of short texts whose new words are encoded in one call.
TOGETHER_CHARS = 1 << 20

SPECIAL = ("<|startoftext|>", "<|endoftext|>")
_LETTERS = "a-zªµºß-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
#: Texts of these characters only, before and after lower-casing, are split into words in
#: Python, all others by the library: some letters have their lower case beyond the range.
PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ]*")
WORD = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def cut_is_safe(text: str, at: int) -> bool:
    """Whether normalising both sides apart gives what normalising the whole gives."""
    code = ord(text[at])
    if code < 0x300:
        return True
    return not (0x1160 <= code <= 0x11FF or unicodedata.category(text[at])[0] == "M")


def halve(text: str, leaf: int, at: int = 0) -> list[tuple[int, str]]:
    """Leaves of the tree as (first character, text). Cuts avoid combining marks."""
    stack, leaves = [(at, text)], []
    while stack:
        first, part = stack.pop()
        middle = len(part) // 2
        while middle < len(part) and not cut_is_safe(part, middle):
            middle += 1
        if len(part) <= leaf or middle >= len(part):
            leaves.append((first, part))
        else:
            stack += [(first + middle, part[middle:]), (first, part[:middle])]
    return leaves


def encode_span(tokenizer, text: str, at: int = 0) -> np.ndarray:
    """One row a token: id, first character, character after it, starts a word."""
    found = tokenizer.encode(text, add_special_tokens=False)
    out = np.zeros((len(found.ids), 4), dtype=np.int64)
    if len(out):
        spans = np.array(found.offsets, dtype=np.int64)
        words = np.array([-1 if w is None else w for w in found.word_ids], dtype=np.int64)
        out[:, 0] = found.ids
        out[:, 1:3] = spans + at
        out[:, 3] = np.diff(words, prepend=-2) != 0
        out[out[:, 0] >= tokenizer.get_vocab_size(with_added_tokens=False), 3] = 1
    return out


def pack(tokens: np.ndarray) -> bytes:
    """Tokens with steps for positions, column by column, which compresses well."""
    steps = tokens.copy()
    steps[:, 2] -= steps[:, 1]
    steps[:, 1] = np.diff(steps[:, 1], prepend=0)
    return zlib.compress(steps.T.astype(np.int32).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed), dtype=np.int32).reshape(4, -1)
    tokens = steps.T.astype(np.int64)
    tokens[:, 1] = np.cumsum(tokens[:, 1])
    tokens[:, 2] += tokens[:, 1]
    return tokens


def _may_meet(text: str, tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of these tokens, those before which the text may be cut for a window."""
    good = []
    for i in rows:
        at = int(tokens[i, 1])
        clean = i == 0 or tokens[i - 1, 2] <= at
        inside = not tokens[i, 3]
        good.append(clean and cut_is_safe(text, at) and not (inside and text[at] == "'"))
    return rows[np.array(good, dtype=bool)] if len(rows) else rows


def join_encoded(
    tokenizer, text: str, left: np.ndarray, right: np.ndarray, at: int, window: int = WINDOW
) -> np.ndarray:
    """Tokens of ``text`` from those of ``text[:at]`` and ``text[at:]``.

    Both sides carry positions in ``text``. The window around the join doubles
    until a token on either side stands in it just as it stands there.
    """
    while True:
        low, high = max(0, at - window), min(len(text), at + window)
        first = 0
        if low > 0:
            near = np.flatnonzero((left[:, 1] >= low) & (left[:, 1] <= at - REACH))
            near = _may_meet(text, left, near)
            if not len(near):
                window *= 2
                continue
            first = int(near[0])
        start = int(left[first, 1]) if low > 0 else 0
        seen = encode_span(tokenizer, text[start:high], start)
        head = left[:first] if low > 0 else left[:0]
        if low > 0 and not (
            len(seen) and np.array_equal(seen[0, :3], left[first, :3])
        ):
            window *= 2
            continue
        if high == len(text):
            return np.concatenate([head, seen])
        after = np.flatnonzero((seen[:, 1] >= at + REACH) & (seen[:, 2] <= high - REACH))
        for i in _may_meet(text, seen, after):
            j = int(np.searchsorted(right[:, 1], seen[i, 1]))
            if j < len(right) and np.array_equal(right[j], seen[i]):
                if j == 0 or right[j - 1, 2] <= right[j, 1]:
                    return np.concatenate([head, seen[:i], right[j:]])
        window *= 2


def join_tree(tokenizer, text: str, nodes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Joins encoded leaves, in text order, pair by pair up to the whole text."""
    while len(nodes) > 1:
        merged = []
        for i in range(0, len(nodes) - 1, 2):
            (a, left), (b, right) = nodes[i], nodes[i + 1]
            end = nodes[i + 2][0] if i + 2 < len(nodes) else len(text)
            shift = np.array([0, a, a, 0])
            part = join_encoded(tokenizer, text[a:end], left - shift, right - shift, b - a)
            merged.append((a, part + shift))
        if len(nodes) % 2:
            merged.append(nodes[-1])
        nodes = merged
    return nodes[0][1]


class Encoder:
    """Encodes whole short texts, with the pieces of words seen before at hand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ids: dict[str, str] = {}
        self.pieces: dict[str, str] = {}

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def _learn(self, words: set[str]) -> None:
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
            self.pieces.clear()
        new = [w for w in words if w not in self.ids]
        if not new:
            return
        # White space parts words for good, so one call encodes all of them.
        found = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
        ids, pieces = list(map(str, found.ids)), found.tokens
        starts = np.flatnonzero(np.diff(found.word_ids, prepend=-1)).tolist()
        for word, a, b in zip(new, starts, [*starts[1:], len(ids)], strict=True):
            self.ids[word] = " ".join(ids[a:b])
            self.pieces[word] = " ".join(pieces[a:b])

    def texts(self, texts: list[str]) -> list[tuple[str, str]]:
        """Ids as decimal numbers, and the decoded text, for each of some texts."""
        words = [self._words(text) for text in texts]
        self._learn(set().union(*(w for w in words if w)))
        return [
            self._whole(text) if known is None else self._known(known)
            for text, known in zip(texts, words)
        ]

    def text(self, text: str) -> tuple[str, str]:
        return self.texts([text])[0]

    def _words(self, text: str) -> list[str] | None:
        """The words of a text made up of known characters, else None."""
        if not PLAIN.fullmatch(text) or any(s in text for s in SPECIAL):
            return None
        folded = unicodedata.normalize("NFC", text).lower()
        return WORD.findall(folded) if PLAIN.fullmatch(folded) else None

    def _whole(self, text: str) -> tuple[str, str]:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return " ".join(map(str, found)), self.decode(found)

    def _known(self, words: list[str]) -> tuple[str, str]:
        get, piece = self.ids.__getitem__, self.pieces.__getitem__
        return " ".join(map(get, words)), " ".join(map(piece, words))


def _encode_short(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            texts = batch["text"].tolist()
            for a, b in chunks(map(len, texts), TOGETHER_CHARS):
                for ids, decoded in encoder.texts(texts[a:b]):
                    rows.append((ids.count(" ") + 1 if ids else 0, digest(ids), digest(decoded)))
            yield _result(batch, rows)

    return run


def _result(batch: pd.DataFrame, rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
    out.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
    return out


def _split_long(leaf: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, row, text in zip(
                batch["doc_id"].astype("Int64"), batch["row"], batch["text"]
            ):
                leaves = halve(text, leaf)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([doc_id] * len(leaves), dtype="Int64"),
                        "row": row,
                        "first": [first for first, _ in leaves],
                        "part": [part for _, part in leaves],
                    }
                )

    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            batch["tokens"] = [pack(encode_span(tokenizer, part)) for part in batch["part"]]
            yield batch

    return run


def _join_leaves(path: str):
    loaded: list = []

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        from tokenizers import Tokenizer

        if not loaded:
            loaded.append(Tokenizer.from_file(path))
        tokenizer = loaded[0]
        copies = int((group["first"] == 0).sum())
        group = group.drop_duplicates("first").sort_values("first")
        nodes = []
        for first, tokens in zip(group["first"], group["tokens"]):
            nodes.append((int(first), unpack(tokens) + np.array([0, first, first, 0])))
        ids = join_tree(tokenizer, "".join(group["part"]), nodes)[:, 0].tolist()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = (len(ids), digest(" ".join(map(str, ids))), digest(decoded))
        return _result(group[["doc_id"]].iloc[[0] * copies], [row] * copies)

    return run


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, leaf: int = LEAF_CHARS) -> DataFrame:
    """Token count and digests of ids and decoded text, one row for each document.

    ``docs`` has ``doc_id`` and ``text``; other columns are left aside whatever
    their names. A text of no tokens, null or empty, has the digests of the empty
    string. Texts are encoded whole whatever their length, repeated rows, also such
    without an id, each have their row, no rows give none.

    Short texts are encoded where they are read. The leaves of long ones are
    dealt out evenly and come together by document, since the digest of a
    document's ids needs them in one place.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = F.length("text")
    short = texts.where(size <= leaf).mapInPandas(_encode_short(path), SCHEMA)
    long = (
        texts.where(size > leaf)
        .withColumn("row", F.concat_ws("-", F.sha2("text", 256), F.col("doc_id")))
        .mapInPandas(_split_long(leaf), "doc_id long, row string, first long, part string")
    )
    # The key follows from the row, so a repeated task deals a leaf out alike; rows
    # alike in id and text meet in one group and leave it as many.
    spread = long.repartition("row", "first")
    leaves = spread.mapInPandas(
        _encode_leaves(path), "doc_id long, row string, first long, part string, tokens binary"
    )
    joined = leaves.groupBy("row").applyInPandas(_join_leaves(path), SCHEMA)
    return short.union(joined)
