"""Best-fit packing by exact-complement hashing.

Documents become token ids; only those longer than a sequence are cut, into full pieces behind a first shorter one. Which
piece goes where depends on lengths alone, so the plan is made from the table of lengths and their counts: at most
`capacity` numbers, whatever the size of the corpus. From the longest length down, the gap it leaves is looked up among
the sums of one, two and three lengths that are still available; a combination that fills it exactly is consumed as often
as the counts allow. Lengths without such a combination are packed best-fit: into the bins with the smallest gap that
holds them. The plan is a table of slots (length, range of ranks, first sequence, offset); pieces of a length are
numbered in parts, and each finds its slot by its number.

Defined results: a null text is an empty one; every document ends with `end_id`, so an empty one is a piece of one token;
repeated rows are packed each; a null id is packed too; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactframe.llm.common import rows, stage
from pactframe.llm.token_counts import byte_letters

CAPACITY, END_ID = 1024, 2
#: Pieces of one length are numbered in parts of about this many.
PART_ROWS = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOTS = "length long, low long, high long, first_sequence long, offset long"

#: Runs without a break that are too long for the quick loop, which takes quadratic time in the length of one run.
LONG_RUN = r"\S{2000}|\s{500}"


class Encoder:
    """Token ids as little-endian bytes: those that the library `tokenizers` gives for the file.

    The merge loop of `tiktoken` gives the same ids from the file's vocabulary, several times faster, where the order of
    the merges is that of the ids, which is checked. It does not know added tokens, so a text that has one of their
    strings, or a very long run, goes through `tokenizers` itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        self.quick = None
        if made == sorted(made) and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["normalizer"]:
            bytes_of = {c: bytes([k]) for k, c in enumerate(byte_letters())}
            ranks = {b"".join(map(bytes_of.__getitem__, token)): rank for token, rank in vocab.items()}
            self.quick = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = re.compile("|".join([LONG_RUN, *(re.escape(t["content"]) for t in spec["added_tokens"])]))

    def encode(self, text: str) -> bytes:
        if self.quick is None or self.slow.search(text):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return array("I", self.quick.encode_ordinary(text)).tobytes() if text else b""


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in rows(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    out.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def exact_fill(counts: np.ndarray, gap: int, parts: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to the gap; the largest possible length first."""
    if parts == 1:
        return (gap,) if counts[gap] else None
    there = np.flatnonzero(counts[: gap + 1])
    if parts == 2:
        return pair_for(counts, there, gap)
    for a in there[::-1]:
        rest = gap - int(a)
        if rest < 2:
            continue
        if 3 * a < gap:
            break
        counts[a] -= 1
        two = pair_for(counts, np.flatnonzero(counts[: min(rest, a) + 1]), rest)
        counts[a] += 1
        if two:
            return (int(a), *two)
    return None


def pair_for(counts: np.ndarray, there: np.ndarray, total: int) -> tuple[int, int] | None:
    big = there[(2 * there >= total) & (there < total)]
    small = total - big
    good = np.flatnonzero((counts[small] > 0) & ((small != big) | (counts[big] > 1)))
    return (int(big[good[-1]]), int(small[good[-1]])) if len(good) else None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence) and how many sequences have each.

    Filling a gap with two or three pieces can use up what would have filled another one; of the plans that fill gaps
    with up to three, two and one pieces, the one with the fewest sequences is taken, the first of equal ones.
    """
    return min((exact_plan(histogram, capacity, most) for most in (3, 2, 1)), key=lambda made: sum(n for _, n in made))


def exact_plan(histogram: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    for parts in range(1, most + 1):  # all single complements before the first pair, all pairs before the first triple
        for length in range(capacity - 1, 0, -1):
            while counts[length]:
                counts[length] -= 1
                fill = exact_fill(counts, capacity - length, parts)
                counts[length] += 1
                if fill is None:
                    break
                whole = (length, *fill)
                need = {x: whole.count(x) for x in whole}
                n = min(int(counts[x]) // k for x, k in need.items())
                for x, k in need.items():
                    counts[x] -= n * k
                patterns.append((whole, n))
    return patterns + best_fit(counts, capacity)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest lengths first, each into bins with the smallest gap that holds it; equal bins are handled together."""
    bins: dict[int, list[list]] = {}  # by gap: [lengths, how many]
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            gap = min((g for g in bins if g >= length), default=None)
            if gap is None:
                fits = capacity // length
                if left >= fits:
                    bins.setdefault(capacity - fits * length, []).append([(length,) * fits, left // fits])
                    left %= fits
                else:
                    bins.setdefault(capacity - left * length, []).append([(length,) * left, 1])
                    left = 0
                continue
            group = bins[gap][-1]
            n = min(left, group[1])
            group[1] -= n
            if not group[1]:
                bins[gap].pop()
                if not bins[gap]:
                    del bins[gap]
            bins.setdefault(gap - length, []).append([(*group[0], length), n])
            left -= n
    return [(tuple(lengths), n) for groups in bins.values() for lengths, n in groups]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows of `SLOTS`: pieces of a length with ranks in [low, high) go to sequences from first_sequence on, at offset."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            low = used.get(length, 0)
            out.append((length, low, low + n, sequence, offset))
            used[length] = low + n
            offset += length
        sequence += n
    return out


def ranked(pieces: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Pieces with `rank`, counted from 0 within their length. A frequent length is numbered in parts side by side."""
    parts = max(1, -(-pieces.count() // part_rows))
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    numbered = dealt.withColumn(
        "number", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    )
    each = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = each.select("length", "part", (F.sum("n").over(before) - F.col("n")).alias("before"))
    return numbered.join(offsets, ["length", "part"]).select(*own, (F.col("before") + F.col("number")).alias("rank"))


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence_id and offset. `pieces` is read three times, so it should be a written table."""
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = F.broadcast(spark.createDataFrame(slots(plan(histogram, capacity)), SLOTS))
    hit = (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked(pieces).alias("p").join(places.alias("s"), hit).select(
        "doc_id", "piece", "start", "p.length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset",
    )


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of all documents, packed; `tokenizer` is the file's path, the same on every executor."""
    return pack_pieces(spark, stage(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
