"""Document fingerprints: context-triggered piecewise hashing.

A rolling hash over the last 7 bytes marks chunk ends wherever it is -1 modulo the block size, so an edit moves only the
chunk ends near it. Each chunk becomes one of 64 characters; a fingerprint is `block size:signature:signature at twice
the block size`. Two fingerprints are comparable if they share a block size; their likeness is the share of characters
left by the shortest insert-delete edit between two signatures, 0 unless they have a run of `COMMON` characters alike.

Neighbours: ids are cut into ranges at ids taken from the table itself; each range is one task, sorted by id. The first
document of a range is also sent, as a guest, to the range before it, so that the last document of each range meets its
follower; the first of all goes to the last range. Texts are shuffled once and stream through a task in batches.

Defined results: a null text is an empty one and has the fingerprint `3::`; equal fingerprints have likeness 1; a null id
comes first; rows with equal ids are ordered by text; in a table of one row the next document is that row itself; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import mix, rows

# Fixed values of the scheme.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW, SMALLEST_BLOCK, LENGTH, COMMON = 7, 3, 64, 7
#: Documents of one id range, by count; a range streams through its task and is sorted on disk if need be.
RANGE_ROWS = 8_000
MAX_RANGES = 100_000

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint(data: bytes) -> str:
    """`block size:signature:signature at twice the block size` of bytes of any length."""
    n = len(data)
    block = SMALLEST_BLOCK
    while block * LENGTH < n:
        block *= 2
    if not n:
        return f"{block}::"
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    raw += np.uint64(1)
    rolling = raw * np.uint64(0x9E3779B97F4A7C15)
    for back in range(1, min(WINDOW, n)):
        rolling[back:] += raw[:-back] * np.uint64(pow(0x9E3779B97F4A7C15, back + 1, 1 << 64))
    rolling = mix(rolling)
    trigger = rolling >> np.uint64(32)
    while True:
        first, second = signature(rolling, trigger, block), signature(rolling, trigger, 2 * block)
        if len(first) >= LENGTH // 2 or block == SMALLEST_BLOCK:
            return f"{block}:{first}:{second}"
        block //= 2


def signature(rolling: np.ndarray, trigger: np.ndarray, block: int) -> str:
    """One character per chunk, from the sum of the rolling hashes in it; the last one covers the rest of the text."""
    ends = np.flatnonzero(trigger % np.uint64(block) == block - 1)[: LENGTH - 1] + 1
    starts = np.concatenate([[0], ends[ends < len(rolling)]])
    return ALPHABET[(mix(np.add.reduceat(rolling, starts)) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the shorter text."""
    if len(a) > len(b):
        a, b = b, a
    full = (1 << len(a)) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    state = full
    for c in b:
        hit = state & at.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def signature_likeness(a: str, b: str) -> float:
    """1 - edit distance / length of both, with insertions and deletions as edits; 0 without a common run."""
    if not a or not b:
        return 0.0
    run = min(COMMON, len(a), len(b))
    pieces = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in pieces for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1; fingerprints whose block sizes are neither equal nor a factor of two apart are not comparable: 0."""
    if one == other:
        return 1.0
    (a, a1, a2), (b, b1, b2) = one.split(":"), other.split(":")
    if a == b:
        return max(signature_likeness(a1, b1), signature_likeness(a2, b2))
    if int(a) == 2 * int(b):
        return signature_likeness(a1, b2)
    return signature_likeness(a2, b1) if int(b) == 2 * int(a) else 0.0


def edit(text: str, following: str) -> str:
    """The last half (rounded down) of a text replaced by as many first characters of the next one, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@lru_cache(maxsize=2)
def own_print(text: str) -> str:
    return fingerprint(text.encode("utf-8", "surrogatepass"))


def compared(doc_id: int | None, text: str, following: str) -> tuple:
    edited = edit(text, following)
    data = edited.encode("utf-8", "surrogatepass")
    own, changed = own_print(text), fingerprint(data)
    after = own_print(following)
    digest = hashlib.sha256(data).hexdigest()
    return doc_id, len(text), digest, own, changed, likeness(own, changed), likeness(own, after)


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, guest, doc_id, text) in order: each own row is compared with the one that follows it in its range."""
    schema = pa.schema(
        [(n, t) for n, t in zip(
            (x.split()[0] for x in SCHEMA.split(", ")),
            (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)]
    )
    held: tuple | None = None
    out: list[tuple] = []
    for batch in rows(batches):
        columns = [batch.column(k).to_pylist() for k in range(4)]
        for part, guest, doc_id, text in zip(*columns, strict=True):
            if held is not None and held[0] == part:
                out.append(compared(held[1], held[2], text or ""))
                held = None
            if not guest:
                held = (part, doc_id, text or "")
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []


def range_starts(docs: DataFrame, range_rows: int = RANGE_ROWS) -> list[int]:
    """Ids at which ranges begin, the first being the smallest id: at most `MAX_RANGES`, from a quantile sketch of the ids."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    n, low = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    if not n:
        return []
    parts = min(MAX_RANGES, -(-n // range_rows))
    if parts == 1:
        return [low]
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0]
    return sorted({low, *cuts})


def sql_array(values: list[int]) -> str:
    return f"array({','.join(f'{v}L' for v in values)})" if values else "cast(array() as array<bigint>)"


def range_of(starts: list[int]) -> Column:
    """Number of the last start that is not above doc_id, found in two steps; ids before all starts, and null, are in 0."""
    step = max(1, int(len(starts) ** 0.5))
    coarse = f"size(filter({sql_array(starts[::step])}, x -> x <= doc_id)) - 1"
    fine = f"c * {step} + size(filter(slice({sql_array(starts)}, c * {step} + 1, {step}), x -> x <= doc_id)) - 1"
    found = f"element_at(transform(array(greatest(0, {coarse})), c -> {fine}), 1)"
    return F.expr(f"if(doc_id IS NULL, 0, greatest(0, {found}))").cast("int")


def starts_range(starts: list[int]) -> Column:
    return F.expr(f"doc_id IS NOT NULL AND array_contains(slice({sql_array(starts)}, range + 1, 1), doc_id)")


def with_neighbours(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """range, guest, doc_id, text: every document in its range, and the first of each range also in the range before."""
    starts = range_starts(docs, range_rows)
    nulls = docs.filter("doc_id IS NULL").limit(1).count() > 0
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("range", range_of(starts)).withColumn("first", starts_range(starts))
    last = max(len(starts) - 1, 0)
    wraps = F.col("doc_id").isNull() if nulls else F.col("first") & (F.col("range") == 0)
    homes = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")),
            F.when(F.col("first") & (F.col("range") > 0), F.struct((F.col("range") - 1).alias("range"), F.lit(1).alias("guest"))),
            F.when(wraps, F.struct(F.lit(last).alias("range"), F.lit(2).alias("guest"))),
        )
    )
    spread = placed.select(F.explode(homes).alias("home"), "doc_id", "text").select("home.*", "doc_id", "text")
    return spread.repartitionById(last + 1, F.col("range")).sortWithinPartitions(
        "range", "guest", F.col("doc_id").asc_nulls_first(), "text"
    )


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: its length, its fingerprint, that of its edited text, and both likenesses."""
    return with_neighbours(docs, range_rows).mapInArrow(neighbours, SCHEMA)
