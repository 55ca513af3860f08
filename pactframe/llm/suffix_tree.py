"""Language-model scores from a probabilistic suffix tree over words.

Texts are coded once into blocks: the distinct words of a block, and its texts as numbers of these. Words are counted over
all training documents by their 64-bit hashes, and every block gets the counts of its own words back; no table of words is
ever broadcast, collected or held whole.

Every word that stands in a training text is a symbol of its own; words that do not share `CLASSES` equal parts of what is
left for them. A context of up to `DEPTH` words is a candidate if it is found at least `LEAST` times, and is retained if
the next words after it diverge from those after its suffix: 2 * count * divergence must exceed the number of different
next words times `PENALTY`. Its distribution is smoothed towards that of its longest retained suffix (Witten and Bell);
next words found less than `LEAST` times count as what is left. These limits are counts, not shares: the tree grows with
the corpus, and no part of it is broadcast.

Its contexts and next words are kept by 64-bit hashes, as words are. Words first and then depth by depth, each block asks
for the counts of the runs of words in its own texts (a run with a word or a shorter run inside that is found once is not
asked for: it is itself found once), and for the sums of its own contexts, which it has added up over the runs that it is the first to hold. Requests are packed by ranges of the hash, added up there
over all blocks, and answered to each block; the blocks lie in buckets and are not shuffled for it. A frequent run or
context is one entry a block.

Defined results: a null or empty text is its end token alone; a null id counts as the empty text in the fold and is held
out; without training documents the base is uniform over one unknown word; repeated rows count each; an empty table
gives an empty result; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import gc
import math
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.llm.common import mix, rows, stage, stage_dealt, word_hashes

FOLDS = 10
#: Least counts as shares of the training tokens: none, so the tree keeps what it finds however large the corpus is.
SYMBOL_SHARE = CONTEXT_SHARE = ENTRY_SHARE = math.inf
#: Least count of a context and of a next word.
LEAST = 2
CLASSES, DEPTH, PENALTY = 64, 3, 2.0
SMOOTHING = 0.1
#: Hash of the end of a text.
END_HASH = np.uint64(0x2D06800538D394C2)
#: A block is closed at so many different words or tokens.
BLOCK_WORDS, BLOCK_TOKENS = 150_000, 1_500_000

#: Ranges of hashes for 1 to so many blocks, and as many again for further ones.
SHARDS = 256
#: Kinds of requests: words, runs of k + 1 words, contexts of k words.
WORD_KIND, COUNT_KIND, CONTEXT_KIND = 0, 0, 100

BLOCK = "block long, doc_ids binary, held binary, lengths binary, ids binary, hashes binary, counts binary"
REQUEST = "kind int, shard int, block long, keys binary, data binary"
REPLY = "block long, kind int, shard int, data binary, total long, different long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
MODEL = "kind int, key long, n long, back long"


def pack(values: np.ndarray) -> bytes:
    """Equal bytes of all numbers side by side, so that the high ones take no space."""
    flat = np.ascontiguousarray(values).reshape(-1)
    return zstandard.ZstdCompressor(level=1).compress(flat.view(np.uint8).reshape(len(flat), -1).T.tobytes() if len(flat) else b"")


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def is_held(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0


def code_blocks(docs: DataFrame) -> DataFrame:
    """Rows of `BLOCK`; ids may be null, so they are kept as text."""

    def close(number: int, doc_ids: list[int | None], hashes: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
        held = np.array([is_held(x) for x in doc_ids], bool)
        words, _, places = different(hashes)
        often = np.argsort(-np.bincount(places), kind="stable")  # frequent words get small numbers, which take less space
        rank = np.empty(len(often), np.int32)
        rank[often] = np.arange(len(often))
        ids = rank[places]
        n = np.bincount(ids[~np.repeat(held, lengths)], minlength=len(words)).astype(np.int32)
        known = ",".join("" if x is None else str(x) for x in doc_ids).encode()
        packed = (known, held.astype(np.uint8), lengths.astype(np.int32), ids, words[often], n)
        data = [pa.array([zstandard.ZstdCompressor(level=1).compress(v) if isinstance(v, bytes) else pack(v)], pa.binary()) for v in packed]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *data], [x.split()[0] for x in BLOCK.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        doc_ids, hashes, lengths, vocabulary, size = [], [], [], np.empty(0, np.uint64), 0
        for batch in rows(batches, 4e6):
            found, counts = word_hashes(batch.column(1), lower=True)
            found = np.insert(found, np.cumsum(counts), END_HASH)
            counts, of = counts + 1, batch.column(0).to_pylist()
            while len(of):
                # the document that fills the block, by tokens or by words that are new to it
                words, _, which = different(found)
                first = np.full(len(words), len(found))
                np.minimum.at(first, which, np.arange(len(found)))
                ends = np.cumsum(counts)
                new = np.sort(first[lookup(vocabulary, words) < 0])
                full = (len(vocabulary) + np.searchsorted(new, ends) >= BLOCK_WORDS) | (size + ends >= BLOCK_TOKENS)
                many = int(full.argmax()) + 1 if full.any() else len(of)
                end = int(ends[many - 1])
                doc_ids, size = doc_ids + of[:many], size + end
                hashes.append(found[:end])
                lengths.append(counts[:many])
                if not full.any():
                    vocabulary = np.union1d(vocabulary, words)
                    break
                yield close(part << 24 | made, doc_ids, np.concatenate(hashes), np.concatenate(lengths))
                doc_ids, hashes, lengths, vocabulary, size, made = [], [], [], np.empty(0, np.uint64), 0, made + 1
                found, counts, of = found[end:], counts[many:], of[many:]
        if doc_ids:
            yield close(part << 24 | made, doc_ids, np.concatenate(hashes), np.concatenate(lengths))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, BLOCK)


def shard_count(n_blocks: int) -> int:
    return SHARDS * max(1, -(-n_blocks // SHARDS))


def extended(runs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of runs of words with one more word behind each."""
    return mix(runs * np.uint64(0x9E3779B97F4A7C15) + words)


def different(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values in order, a place where each stands, and the number of each place's value; `np.unique` sorts stably
    for the first place, which takes longer and is not needed."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(ordered), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which


class Block:
    """One block with the replies it has got so far: what it can ask next, and at the end the probability of each token."""

    def __init__(self, data: dict, replies: dict[int, np.ndarray], depth: int, total: int, distinct: int):
        self.block, self.depth, self.replies = data["block"], depth, replies
        self.lengths, self.ids = unpack(data["lengths"], np.int32).astype(np.int64), unpack(data["ids"], np.int32)
        self.held = unpack(data["held"], np.uint8).astype(bool)
        self.doc_ids = zstandard.ZstdDecompressor().decompress(data["doc_ids"]).decode().split(",")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.ids)) - np.repeat(self.starts, self.lengths)
        self.train = ~np.repeat(self.held, self.lengths)
        self.words, self.n_words = unpack(data["hashes"], np.uint64), unpack(data["counts"], np.int32)
        self.order = np.argsort(self.words)
        self.total, self.distinct = total, distinct
        self.asked: list[tuple[int, np.ndarray, list[np.ndarray]]] = []
        self.found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.p: np.ndarray | None = None
        self.walk()

    def counts_of(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Count in training texts, and whether this block is the one that speaks for it, of each key asked for."""
        return self.replies[kind] >> 1, (self.replies[kind] & 1).astype(bool)

    def walk(self) -> None:
        ids, place = self.ids, self.place
        if WORD_KIND not in self.replies:
            self.asked.append((WORD_KIND, self.words[self.order], [self.n_words[self.order]]))
            return
        n, _ = self.counts_of(WORD_KIND)
        self.known = np.empty(len(n), np.int64)
        self.known[self.order] = n
        self.base = (self.known[ids] + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1))
        everything = self.total + SMOOTHING * (self.distinct + CLASSES)
        self.p = self.base * (self.total + SMOOTHING * (self.distinct + 1)) / everything
        use = n >= LEAST
        keys, totals = self.words[self.order][use], n[use]
        rank = np.full(len(n), -1, np.int64)
        rank[self.order[use]] = np.arange(len(keys))
        ends = rank[ids]  # the context, if any, that ends with each token
        gram = mix(self.words)[ids]
        for k in range(1, self.depth + 1):
            longer = np.zeros(len(ids), np.uint64)
            longer[1:] = extended(gram[:-1], self.words[ids[1:]])
            gram = longer
            context = np.full(len(ids), -1, np.int64)
            context[1:] = np.where(place[1:] >= k, ends[:-1], -1)
            # a run of words whose beginning or end is found once is itself found once, so it is not asked for
            at = np.flatnonzero((context >= 0) & (ends >= 0))
            runs, one, which = different(gram[at])
            if COUNT_KIND + k not in self.replies:
                self.asked.append((COUNT_KIND + k, runs, [np.bincount(which, self.train[at], len(runs)).astype(np.int32)]))
                return
            n, own = self.counts_of(COUNT_KIND + k)
            if self.p is not None:
                # a context is kept only for next words found `LEAST` times: one that has none here, and too few occurrences
                # besides those before words found once with it here, is not asked for
                state = context[at[one]]
                once = np.bincount(state[own & (n == 1)], minlength=len(keys))
                once += np.bincount(context[self.train & (context >= 0) & (ends < 0)], minlength=len(keys))
                ask = np.bincount(state[n >= LEAST], minlength=len(keys)) > 0
                ask |= (totals - once >= LEAST) & (np.bincount(context[context >= 0], minlength=len(keys)) > 0)
            if self.p is not None and CONTEXT_KIND + k not in self.replies:
                mine = own & (n >= LEAST)
                where, many, below = state[mine], n[mine], self.p[at[one]][mine]
                sums = [np.bincount(where, v, len(keys)) for v in (np.ones(len(many)), many, many * np.log(many / below), below)]
                sums[0] += once
                self.asked.append((CONTEXT_KIND + k, keys[ask], [totals[ask], *(v[ask].astype(np.int64) for v in sums[:2]), *(v[ask] for v in sums[2:])]))
                self.p = None
            elif self.p is not None:
                kept, back = np.zeros((2, len(keys)), np.int64)
                kept[ask], back[ask] = self.replies[CONTEXT_KIND + k].reshape(-1, 2).T
                seen = np.zeros(len(ids), np.int64)
                seen[at] = np.where(n >= LEAST, n, 0)[which]
                use = np.flatnonzero((context >= 0) & (back[context] > 0)) if len(back) else np.empty(0, np.int64)
                state = context[use]
                self.p[use] = (seen[use] + back[state] * self.p[use]) / (kept[state] + back[state])
                self.found.append((CONTEXT_KIND + k, keys, kept, back))
            live = n >= LEAST
            self.found.append((COUNT_KIND + k, runs[live], n[live], n[live] * 0))
            keys, totals = runs[live], n[live]
            rank = np.where(live, np.cumsum(live) - 1, -1)
            ends = np.full(len(ids), -1, np.int64)
            ends[at] = rank[which]


def requests(block: Block, shards: int) -> Iterator[pa.RecordBatch]:
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    for kind, keys, columns in block.asked:
        cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        parts = [(s, a, b) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        data = [pack(columns[0][a:b] if len(columns) == 1 else np.concatenate([c[a:b].view(np.int64) for c in columns])) for _, a, b in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(parts), pa.int32()), pa.array([s for s, _, _ in parts], pa.int32()), pa.array([block.block] * len(parts), pa.int64()),
             pa.array([pack(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in parts], pa.binary()), pa.array(data, pa.binary())],
            [x.split()[0] for x in REQUEST.split(", ")],
        )


def answer(group: pa.Table) -> pa.Table:
    """Rows of `REPLY`: sums over all blocks of what they asked for in one shard of keys, back to each block in its order."""
    kind, shard = group.column("kind")[0].as_py(), group.column("shard")[0].as_py()
    asked = sorted(zip(*(group.column(c).to_pylist() for c in ("block", "keys", "data")), strict=True))
    each = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for _, k, _ in asked]
    sizes = [len(x) for x in each]
    different, which = np.unique(np.concatenate(each), return_inverse=True)
    total = distinct = 0
    if kind < CONTEXT_KIND:
        n = np.concatenate([unpack(d, np.int32) for _, _, d in asked])
        sums = np.bincount(which, n).astype(np.int64)
        speaks, some = np.zeros(len(which), bool), np.flatnonzero(n)[::-1]
        first = np.full(len(different), -1, np.int64)
        first[which[some]] = some  # the last one written is the first in order
        speaks[first[first >= 0]] = True
        out = sums[which] << 1 | speaks
        if kind == WORD_KIND:
            total, distinct = int(sums.sum()), int((sums > 0).sum())
    else:
        raw = [unpack(d, np.int64).reshape(5, -1) for _, _, d in asked]
        whole, *parts = (np.concatenate([r[k].view(np.int64 if k < 3 else np.float64) for r in raw]) for k in range(5))
        totals = np.empty(len(different), np.int64)
        totals[which] = whole
        distinct_next, kept, gain, below = (np.bincount(which, v, len(different)) for v in parts)
        lost, rest = totals - kept, 1 - below
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gain - kept * np.log(totals) + np.where((lost > 0) & (rest > 0), lost * np.log(lost / totals / rest), 0)
        retained = 2 * gain > PENALTY * distinct_next
        pair = np.stack([np.where(retained, kept, 0), np.where(retained, distinct_next + lost, 0)], 1).astype(np.int64)
        out = pair[which]
    cuts = np.cumsum([0, *sizes])
    m = len(asked)
    return pa.table({
        "block": pa.array([b for b, _, _ in asked], pa.int64()), "kind": pa.array([kind] * m, pa.int32()), "shard": pa.array([shard] * m, pa.int32()),
        "data": pa.array([pack(out[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        "total": pa.array([total, *[0] * (m - 1)], pa.int64()), "different": pa.array([distinct, *[0] * (m - 1)], pa.int64()),
    })


@dataclass
class Learnt:
    """Blocks, and the replies that they have got."""

    blocks: DataFrame
    replies: DataFrame | None
    depth: int
    total: int = 0
    distinct: int = 0
    rounds: list[list[int]] = field(default_factory=list)

    @property
    def answered(self) -> list[int]:
        return [k for r in self.rounds for k in r]

    def each(self, make, schema: str) -> DataFrame:
        """Rows that `make` gives for each block with its replies."""
        names, depth, total, distinct = [x.split()[0] for x in schema.split(", ")], self.depth, self.total, self.distinct
        kinds = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}[k])
                           for n, k in (x.split() for x in schema.split(", "))])

        def meet(block: pa.Table, own: pa.Table) -> pa.Table:
            parts: dict[int, list] = {}
            for kind, _, data in sorted(zip(*(own.column(c).to_pylist() for c in ("kind", "shard", "data")), strict=True)):
                parts.setdefault(kind, []).append(unpack(data, np.int64))
            # an empty request has no reply: it counts as answered with nothing once any of its round is
            found = {k: np.concatenate(v) for k, v in parts.items()}
            for kind in answered:
                found.setdefault(kind, np.empty(0, np.int64))
            made = list(make(Block(block.to_pylist()[0], found, depth, total, distinct)))
            return pa.Table.from_batches(made, kinds) if made else kinds.empty_table()

        answered = self.answered
        left = self.blocks.groupBy("block")
        return left.cogroup(self.replies.select("block", "kind", "shard", "data").groupBy("block")).applyInArrow(meet, schema).select(*names)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of tables that are staged by now, which wait for the driver's garbage collection. What one
    collection frees may hold the plan of the last cogroup, so there is a second one a moment later."""
    for pause in (1, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


class Tree:
    """The tree collected, to look into one of a small corpus; scores never need it. Symbols are the words in training
    texts by hash, then the classes."""

    def __init__(self, learnt: Learnt):
        self.learnt = learnt

    @cached_property
    def tables(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By kind: sorted keys, counts of words and runs or kept counts of contexts, weight of the suffix."""

        def parts(b: Block) -> Iterator[pa.RecordBatch]:
            n = b.known[b.order]
            for kind, keys, n, back in [(WORD_KIND, b.words[b.order][n > 0], n[n > 0], n[n > 0] * 0), *b.found]:
                columns = [np.full(len(keys), kind, np.int32), keys.view(np.int64), n, back]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in MODEL.split(", ")])

        found = self.learnt.each(parts, MODEL).distinct().toPandas()
        out = {}
        for kind in self.learnt.answered:
            own = found[found.kind == kind]
            keys = own.key.to_numpy().view(np.uint64)
            order = np.argsort(keys)
            out[kind] = keys[order], own.n.to_numpy()[order], own.back.to_numpy()[order]
        return out

    @property
    def n_symbols(self) -> int:
        return len(self.tables[WORD_KIND][0]) + CLASSES

    @property
    def retained(self) -> list[np.ndarray]:
        return [self.tables[CONTEXT_KIND + k][2] > 0 for k in range(1, self.learnt.depth + 1)]

    def probabilities(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each symbol after the longest retained suffix of what stands before it. `first` marks text starts."""
        words, known, _ = self.tables[WORD_KIND]
        h = np.concatenate([words, np.arange(CLASSES, dtype=np.uint64)])[symbols]
        mass = np.concatenate([known, np.zeros(CLASSES, np.int64)]) + SMOOTHING
        p = (mass / mass.sum())[symbols]
        place = np.arange(len(symbols)) - np.maximum.accumulate(np.where(first, np.arange(len(symbols)), 0))
        gram = mix(h)
        for k in range(1, self.learnt.depth + 1):
            before = h if k == 1 else gram
            gram, shorter = np.zeros(len(h), np.uint64), gram
            gram[1:] = extended(shorter[:-1], h[1:])
            keys, kept, back = self.tables[CONTEXT_KIND + k]
            state = np.full(len(h), -1, np.int64)
            state[1:] = np.where(place[1:] >= k, lookup(keys, before[:-1]), -1)
            use = np.flatnonzero((state >= 0) & (back[state] > 0)) if len(keys) else np.empty(0, np.int64)
            runs, n, _ = self.tables[COUNT_KIND + k]
            spot = lookup(runs, gram[use])
            seen = np.where(spot >= 0, n[spot], 0) if len(runs) else 0
            p[use] = (seen + back[state[use]] * p[use]) / (kept[state[use]] + back[state[use]])
        return p


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[spot] == wanted, spot, -1)


def build(spark: SparkSession, docs: DataFrame, depth: int = DEPTH) -> tuple[Learnt, Tree]:
    """Coded blocks of all documents with all that they need of the tree, and the tree itself."""
    blocks = stage_dealt(code_blocks(docs), "blocks", "block", large_rows=True)
    shards = shard_count(blocks.count())
    learnt = Learnt(blocks, None, depth)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                yield from requests(Block(data, {}, depth, 0, 0), shards)

    for k in range(depth + 2):
        asked = learnt.each(lambda b: requests(b, shards), REQUEST) if k else blocks.mapInArrow(first, REQUEST)
        got = stage(asked.groupBy("kind", "shard").applyInArrow(answer, REPLY), "replies")
        if not k:
            learnt.total, learnt.distinct = got.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
        learnt.replies = got if learnt.replies is None else learnt.replies.union(got)
        learnt.rounds.append([WORD_KIND] if not k else ([CONTEXT_KIND + k - 1] if k > 1 else []) + ([COUNT_KIND + k] if k <= depth else []))
        del asked
        release(spark)
    return learnt, Tree(learnt)


def scored(learnt: Learnt) -> DataFrame:
    def sums(b: Block) -> Iterator[pa.RecordBatch]:
        values = ((b.known[b.ids] > 0).astype(np.int64), np.log10(b.base), np.log10(b.p))
        ids = [int(x) if x else None for x in b.doc_ids]
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = (ids, b.held, b.lengths, *(np.add.reduceat(v, b.starts) for v in values))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SCORES.split(", ")])

    return learnt.each(sums, SCORES)


def score(spark: SparkSession, docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    learnt, _ = build(spark, docs, depth)
    out = scored(learnt).withColumn("train_tokens", F.lit(learnt.total).cast("long"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
