"""Token counts by rank-synchronous array merging.

The vocabulary file of a word-end BPE tokenizer is read as data (symbols, ranked merges, added tokens, normalisers).
Distinct pre-tokens of a batch are held as one ragged numpy array of symbol ids; in every round each sequence finds its
own lowest-rank neighbouring pair and merges all its occurrences from left to right, all sequences at once, until no
pair has a rank. What is left are the tokens. Texts are split at spaces and line feeds first, and counts of
pieces are kept from batch to batch up to a bounded number, so that a frequent piece is merged once.

Defined results: a null or empty text has no bytes and no tokens; repeated rows are counted each; an empty table gives
an empty result; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import rows

LIMIT_TOKENS = 2048
#: Counts of at most so many pieces are kept in a worker.
CACHE_PIECES = 300_000
NO_RANK = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The usual printable stand-in of each byte: itself where printable, else the next letter from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    fresh = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(fresh)) for b in range(256)]


class MergeCounter:
    """Counts tokens of texts under one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([vocab.get(c + suffix, -1) for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = np.int64(max(vocab.values()) + 2)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.lower = any(n["type"] == "Lowercase" for n in spec["normalizer"]["normalizers"])
        self.compose = any(n["type"] == "NFC" for n in spec["normalizer"]["normalizers"])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        # the library's white space is Unicode's, without the four separators that Python adds
        self.pattern = regex.compile(split.replace("[^\\s", "[^\\p{White_Space}"))
        added = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(added)) if added else None
        self.pieces: dict[str, int] = {"": 0}

    def pre_tokens(self, piece: str) -> list[bytes]:
        if self.compose:
            piece = unicodedata.normalize("NFC", piece)
        if self.lower:  # letter by letter: the form of a final sigma does not depend on its place
            piece = piece.lower() if "Σ" not in piece else "".join(map(str.lower, piece))
        return [m.encode("utf-8", "surrogatepass") for m in self.pattern.findall(piece)]

    def merged_lengths(self, pre: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        lengths = np.fromiter(map(len, pre), np.int64, len(pre))
        raw = np.frombuffer(b"".join(pre), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[raw[ends]]
        owner = np.repeat(np.arange(len(pre)), lengths)
        known = symbols >= 0
        symbols, owner = symbols[known], owner[known]
        left = np.bincount(owner, minlength=len(pre))
        while len(symbols) > 1:
            rank = self.rank(symbols, owner)
            lowest = np.full(len(pre), NO_RANK)
            np.minimum.at(lowest, owner[:-1], rank)
            alive = lowest < NO_RANK
            if not alive.any():
                break
            hit = (rank == lowest[owner[:-1]]) & (rank < NO_RANK)
            # of overlapping occurrences (a run of one symbol) every second merges, from the left
            at = np.flatnonzero(hit)
            fresh = np.concatenate([[True], np.diff(at) > 1])
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            keep &= alive[owner]  # a finished sequence leaves the arrays with its length noted
            left -= np.bincount(owner[at], minlength=len(pre))
            symbols, owner = symbols[keep], owner[keep]
        return left

    def rank(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        key = symbols[:-1] * self.size + symbols[1:]
        spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        good = (self.keys[spot] == key) & (owner[:-1] == owner[1:])
        return np.where(good, self.ranks[spot], NO_RANK)

    def learn(self, pieces: list[str]) -> None:
        """Count the tokens of new pieces, in one ragged array of their distinct pre-tokens."""
        numbers: dict[bytes, int] = {}
        parts: list[tuple[str, int, list[int]]] = []
        for piece in pieces:
            special, texts = 0, [piece]
            if self.added and "<" in piece:
                special, texts = len(self.added.findall(piece)), self.added.split(piece)
            pre = [p for text in texts if text for p in self.pre_tokens(text)]
            parts.append((piece, special, [numbers.setdefault(p, len(numbers)) for p in pre]))
        lengths = self.merged_lengths(list(numbers)) if numbers else np.zeros(0, np.int64)
        for piece, special, which in parts:
            self.pieces[piece] = special + int(sum(lengths[k] for k in which))

    def count(self, texts: list[str]) -> list[int]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        known = self.pieces
        new = {p for s in split for p in s if p not in known}
        if len(known) + len(new) > CACHE_PIECES:
            known.clear()
            known[""] = 0
            new = {p for s in split for p in s if p}
        if new:
            self.learn(list(new))
        return [sum(map(known.__getitem__, s)) for s in split]


@lru_cache(maxsize=1)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document. `tokenizer` is the file's path, the same on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = counter(tokenizer)
        for batch in rows(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = pa.array(merge.count(texts), pa.int64())
            size = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
