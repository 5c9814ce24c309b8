"""Problem 7: token ids of every text by a public byte-level BPE vocabulary.

Text is cut by the vocabulary's pre-split pattern; each piece is encoded in
time linear in its length: its bytes are read as Latin-1, a pyahocorasick
automaton over all tokens gives the longest token at each place, and tokens
are laid left to right, falling back to the next shorter token where a token
cannot stand beside its left neighbour. Two tokens may be neighbours if the
merges would not have joined anything across their border; that is decided
from the merge table and memoised per pair. The result is the same sequence
that applying the merges in rank order gives.

The pre-split never crosses the border of a non-blank and a blank, so a text
is looked up by whole blank-separated chunks, in a memo that each worker holds
(bounded by MEMO entries, then emptied); only unseen chunks are encoded.

The vocabulary has a fixed size (50 thousand tokens) and is broadcast. One
scan, no shuffle.

Defined results: null and empty texts have an empty list; a blank text has
the ids of its blanks; very long texts are encoded whole; strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ..session import spread

#: Where the vocabulary files of public tokenizers lie; a parameter, nothing is copied from there.
VOCABULARIES = os.environ.get("LEXWEAVE_TOKENIZERS", "/opt/tokenizers")
#: The pattern that cuts text before the merges.
PRESPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks that a worker remembers.
MEMO = 300_000
#: Pairs of tokens that a worker remembers; then it starts anew.
PAIRS = 2_000_000

# White space that the pattern's \s and Python's str.isspace do not judge alike is left to the whole-text path.
_ODD_SPACE = regex.compile(r"[\x1c-\x1f\x85]")
_RUNS = re.compile(r"\s*\S+|\s+")


def byte_alphabet() -> dict[str, int]:
    """The public mapping of byte-level vocabularies from printable characters to bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return table


def load_vocabulary(name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> tuple[list[bytes], dict[int, tuple[int, int]]]:
    """Token bytes by id, and of every merged token the two ids it is merged from."""
    with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet = byte_alphabet()
    ids = model["vocab"]
    tokens: dict[int, bytes] = {}
    for text, i in ids.items():
        if all(c in alphabet for c in text):
            tokens[i] = bytes(alphabet[c] for c in text)
    parts = {}
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        parts.setdefault(ids[left + right], (ids[left], ids[right]))
    used = set(parts) | {i for i, b in tokens.items() if len(b) == 1}
    return [tokens[i] if i in used else b"" for i in range(max(used) + 1)], parts


class Encoder:
    """Encodes pieces and texts; one per worker."""

    def __init__(self, tokens: list[bytes], parts: dict[int, tuple[int, int]]):
        import ahocorasick

        self.size = [len(b) for b in tokens]
        self.parts = parts
        self.joined = {pair: i for i, pair in parts.items()}
        self.single = {b: i for i, b in enumerate(tokens) if b}
        self.automaton = ahocorasick.Automaton()
        for i, b in enumerate(tokens):
            if b:
                self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.beside: list[dict[int, bool]] = [{} for _ in tokens]
        self.met = 0
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.pattern = regex.compile(PRESPLIT)
        self.chunks = _Memo(self._chunk)
        self.runs = _Memo(self._run)

    def _fits(self, a: int, b: int) -> bool:
        """Whether the merges leave a border between these two tokens."""
        parts, bound = self.parts, len(self.size) + 1
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < bound:
                return False  # an earlier merge would have taken the border's two sides
            # Undo the later of the two: what lay at the border before it was made.
            if (a > b and a in parts) or b not in parts:
                if a not in parts:
                    return True
                bound, a = a, parts[a][1]
            else:
                bound, b = b + 1, parts[b][0]

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece of the pre-split."""
        data = text.encode("utf-8")
        whole = self.single.get(data)
        if whole is not None:
            return (whole,)
        if self.met >= PAIRS:
            self.beside, self.met = [{} for _ in self.size], 0
        n, size, beside = len(data), self.size, self.beside
        at: list[list[int]] = [[] for _ in data]  # tokens that start here; they come shortest first
        for end, i in self.automaton.iter(data.decode("latin-1")):
            at[end - size[i] + 1].append(i)
        dead = bytearray(n + 1)
        out: list[int] = []
        tried: list[int] = []  # how many of the tokens at each laid token's place are still untried
        place, here, row = 0, at[0], None  # row: what may stand beside the last token
        left = len(here)
        while True:
            while left:
                left -= 1
                i = here[left]
                end = place + size[i]
                if dead[end]:
                    continue
                if row is not None:
                    fits = row.get(i)
                    if fits is None:
                        fits = row[i] = self._fits(out[-1], i)
                        self.met += 1
                    if not fits:
                        continue
                out.append(i)
                tried.append(left)
                if end == n:
                    return tuple(out)
                place, here, row = end, at[end], beside[i]
                left = len(here)
                break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                dead[place] = 1
                place -= size[out.pop()]
                here, left, row = at[place], tried.pop(), beside[out[-1]] if out else None

    def _piece(self, text: str) -> tuple[int, ...]:
        ids = self.pieces.get(text)
        if ids is None:
            ids = self.piece(text)
            if len(text) <= 64:
                if len(self.pieces) >= MEMO:
                    self.pieces.clear()
                self.pieces[text] = ids
        return ids

    def _cut(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._piece, self.pattern.findall(text))))

    def _chunk(self, chunk: str) -> tuple[int, ...] | None:
        """Ids of a blank and the chunk after it; None where that isn't a matter of the chunk alone."""
        if not chunk:
            return self.piece(" ")
        if chunk[0].isspace() or chunk[-1].isspace() or _ODD_SPACE.search(chunk):
            return None
        return tuple(self._cut(" " + chunk))

    def _run(self, run: str) -> tuple[int, ...] | None:
        """Ids of a run of blanks and the word after it."""
        return None if _ODD_SPACE.search(run) else tuple(self._cut(run))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text."""
        if not text:
            return []
        try:
            # Single blanks, and double ones, which leave one empty chunk, between chunks that hold no blank at their ends.
            first, *rest = text.split(" ")
            if first and rest and rest[-1] and not first[-1].isspace() and "   " not in text and not _ODD_SPACE.search(first):
                return self._cut(first) + list(chain.from_iterable(map(self.chunks.__getitem__, rest)))
        except TypeError:
            pass
        try:
            return list(chain.from_iterable(map(self.runs.__getitem__, _RUNS.findall(text))))
        except TypeError:  # odd blanks: the whole text is cut at once
            return self._cut(text)


class _Memo(dict):
    """A dict that makes what it lacks and is emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[key] = value
        return value


_encoders: dict[str, Encoder] = {}


class Vocabulary:
    """A vocabulary for the workers: broadcast once, an encoder built once per worker process."""

    def __init__(self, spark: SparkSession, name: str = "byte_bpe_50k", folder: str = VOCABULARIES):
        self.at = os.path.join(folder, name)
        self.shared = spark.sparkContext.broadcast(load_vocabulary(name, folder))

    def encoder(self) -> Encoder:
        if self.at not in _encoders:
            _encoders[self.at] = Encoder(*self.shared.value)
        return _encoders[self.at]


def encode_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = VOCABULARIES
) -> DataFrame:
    """(key, ids): the token ids of each text, one row per row."""
    vocabulary = Vocabulary(docs.sparkSession, name, folder)
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for t in batch.column(1).to_pylist():
                flat.extend(encoder.encode(t))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return spread(docs.select(key, text)).mapInArrow(run, f"{key} {kind}, ids array<int>")


def count_tokens(
    docs: DataFrame, text: str = "text", column: str = "n_tokens", name: str = "byte_bpe_50k", folder: str = VOCABULARIES
) -> DataFrame:
    """docs with the number of tokens of each text; the ids themselves are not kept."""
    vocabulary = Vocabulary(docs.sparkSession, name, folder)
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + f", `{column}` bigint"
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            sizes = pa.array([len(encoder.encode(t)) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], names=[*batch.schema.names, column])

    return spread(docs).mapInArrow(run, schema)
