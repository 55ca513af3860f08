"""Helpers shared by the operators of this folder: staged tables, word rules, crc folds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.session import checkpoint_dir

# The word rule of every operator here, as a Java and RE2 pattern.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: For rows of packed data of some megabytes each: no second compression, and a page is closed behind each row, as
#: otherwise a hundred of them share a page and its buffers.
LARGE_ROWS = {"compression": "none", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def stage(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = staged_path(df.sparkSession, name)
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_dealt(df: DataFrame, name: str, key: str, large_rows: bool = False) -> DataFrame:
    """Like `stage`, but dealt into buckets by `key`: where rows meet others of their key, only the others are shuffled.
    A table of the session's catalog over the folder tells Spark of the buckets."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    table = f"{name}_{uuid.uuid4().hex}"
    options = (LARGE_ROWS if large_rows else {}) | {"path": path}
    df.write.format("parquet").options(**options).bucketBy(buckets, key).saveAsTable(table)
    return spark.table(table)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words as UTF-8; `bytes.split` breaks at exactly the six characters of the word rule, `lower` folds A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


class Powers:
    """Powers of a number modulo 2^64, as many as needed so far."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = np.uint64(pow(self.base, len(self.values), 1 << 64))
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


up, down = Powers(FACTOR), Powers(INVERSE)
#: Bytes hashed at a time; a longer word than `LONG` is hashed alone.
BLOCK, LONG = 1 << 17, 64
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: A random number for each byte, and the same with A-Z as a-z.
EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one behind the other, and the number of words of each text.

    They are read off the bytes: running sums of a number per byte times a power per place give the hash of every word,
    so that no object and no dictionary entry is made per word. `lower` folds A-Z only."""
    texts = texts if texts.null_count == 0 else texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    # a blank before and behind each text, so that no word goes on in the next one
    inside = ~BLANK[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    table, out = FOLDED if lower else EXACT, np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(raw) + BLOCK, BLOCK))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if a == b:
            continue
        low = k * BLOCK
        part = raw[low : low + BLOCK + LONG]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * up.first(len(part)), out=sums[1:])
        at, end = starts[a:b] - low, np.minimum(stops[a:b] - low, len(part))
        out[a:b] = (sums[end] - sums[at]) * down.first(len(part))[at]
    out = mix(out)
    for k in np.flatnonzero(stops - starts > LONG).tolist():
        word = raw[starts[k] : stops[k]].tobytes()
        out[k] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
    return out, np.diff(np.searchsorted(starts, offsets))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, in order; empty if there are fewer."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
    return out


def rows(batches: Iterator[pa.RecordBatch], size: float = 8e6) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds at most about `size` bytes, or one row."""
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
