"""Substring dedup: suffix automata of reference shards, matching statistics of documents streamed past them.

A window is `WINDOW` consecutive words. Of equal windows the one that starts first stays, words under any other are
removed. The reference is the text under first occurrences of windows that repeat; each window stands in it once.

1. Anchors: the smallest hash of the word runs of `RUN` words in a window. Equal windows have equal anchors, so windows
   whose anchor occurs once in all texts repeat nowhere and are left; that is most of a corpus.
2. The others are counted by hash. Of each that occurs twice or more, the first place names its shard: a bounded stretch
   of reference text. Documents send each stretch of repeated windows to its shard, first places as reference.
3. A shard builds one suffix automaton over words. It is broadcast to the tasks that stream the shard's documents: a
   shard with many documents is dealt to many tasks, each with the whole automaton. Matching statistics of at least
   `WINDOW` words prove a repeat word by word, and the place in the reference tells whether it is another one.

Defined results: a null text has no words; a null id comes before all others; rows with equal ids count as one document,
in which an equal window that starts at a smaller place is the earlier one; repeated rows get equal results; an empty
table gives an empty result; columns beyond those named are ignored by `dedup_words` and kept by `dedup_texts`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactframe.llm.common import down, mix, rows, stage, up, word_hashes, words_of

WINDOW, RUN = 20, 10
#: Reference words of one shard, and streamed words of one of its tasks, about.
SHARD_WORDS, TASK_WORDS = 50_000, 200_000
#: Bytes of texts that are handled as one array.
BATCH = 2e6
#: Stands for a null id: below all others.
NO_ID = -(1 << 63)

def run_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words from running sums: the same for equal runs, wherever they stand."""
    count = len(w) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up.first(len(w)), dtype=np.uint64)])
    return mix((sums[n:] - sums[:-n]) * down.first(count))


def sliding_least(v: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every n consecutive values, by doubling."""
    span = 1
    while 2 * span <= n:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[: len(v) - (n - span)], v[n - span :]) if span < n else v


def anchors_of(w: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every window, and the hashes of all runs they are taken from."""
    run = min(RUN, window)
    runs = run_hashes(w, run)
    return sliding_least(runs, window - run + 1), runs


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """key, anchor, doc_id, n: anchors of each text, to be counted by key; null in `anchor` means that it is the key.

    The texts of a batch are handled as one array. An anchor that the batch has once goes under its own key, with n = 1
    (2 if the run stands again nearby). One that it has more often is known to be shared: its rows go under keys of
    their own, and one row without a document tells the others. So a key gets at most two rows from a batch, however
    many texts share a passage."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = min(RUN, window)
        for batch in rows(batches, BATCH):
            words, lengths = word_hashes(batch.column(1))
            if len(words) < window:
                continue
            runs = run_hashes(words, run)
            anchors = sliding_least(runs, window - run + 1)
            text = np.repeat(np.arange(len(lengths)), lengths)
            whole = text[: len(anchors)] == text[window - 1 :]  # windows that lie in one text
            anchors, text = anchors[whole], text[: len(whole)][whole]
            if not len(anchors):
                continue
            again = np.zeros(len(runs), bool)
            for gap in range(1, window - run + 2):
                again[gap:] |= runs[gap:] == runs[:-gap]
            fresh = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])])
            anchors, text = anchors[fresh], text[fresh]
            ids = batch.column(0).to_numpy(zero_copy_only=False)[text]
            order = np.argsort(anchors, kind="stable")
            anchors, ids = anchors[order], ids[order]
            same = anchors[1:] == anchors[:-1]
            known = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            tell = anchors[known & np.concatenate([[True], ~same])]
            n = 1 + known.astype(np.int8)
            if again.any():
                n |= np.int8(2) * np.isin(anchors, runs[again]).astype(np.int8)
            key = np.where(known, mix(anchors ^ mix(ids.view(np.uint64))), anchors)
            columns = [
                pa.array(np.concatenate([key, tell]).view(np.int64)),
                pa.array(np.concatenate([anchors, tell]).view(np.int64), mask=np.concatenate([~known, np.ones(len(tell), bool)])),
                pa.array(np.concatenate([ids, np.zeros(len(tell), np.int64)]), mask=np.arange(len(key) + len(tell)) >= len(key)),
                pa.array(np.concatenate([n, np.full(len(tell), 2, np.int8)])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "anchor", "doc_id", "n"])

    return docs.select("doc_id", "text").mapInArrow(read, "key long, anchor long, doc_id long, n byte")


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """wh (window hash), doc_id, pos (first place in this text), n (1 or 2), of windows whose anchors are in `anchors`.

    The texts of a batch are handled as one array, and so are their anchors: one that two texts have is among those of both."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, BATCH):
            words, lengths = word_hashes(batch.column(1))
            if len(words) < window:
                continue
            anchors, _ = anchors_of(words, window)
            starts = np.cumsum(lengths) - lengths
            text = np.repeat(np.arange(len(lengths)), lengths)
            change = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
            known = np.isin(anchors[change], batch.column(2).flatten().to_numpy().view(np.uint64))
            wanted = np.repeat(known, np.diff(change, append=len(anchors)))
            at = np.flatnonzero(wanted & (text[: len(anchors)] == text[window - 1 :]))  # windows that lie in one text
            if not len(at):
                continue
            hashes, text, n = run_hashes(words, window)[at], text[at], np.ones(len(at), np.int8)
            # of a window that a text has more often, the first place stays
            least = np.sort(hashes)
            again = np.flatnonzero(np.isin(hashes, least[1:][least[1:] == least[:-1]]))
            order = again[np.lexsort((again, hashes[again], text[again]))]
            same = (hashes[order[1:]] == hashes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
            n[order[:-1][same]] = 2
            kept = np.ones(len(at), bool)
            kept[order[1:][same]] = False
            ids = batch.column(0).to_numpy(zero_copy_only=False)[text[kept]]
            columns = [hashes[kept].view(np.int64), ids, (at - starts[text])[kept].astype(np.int32), n[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["wh", "doc_id", "pos", "n"])

    return docs.select("doc_id", "text", "anchors").mapInArrow(read, "wh long, doc_id long, pos int, n byte")


PIECE = "shard long, reference boolean, doc_id long, pos int, text_key long, n int, words binary"


def piece_rows(docs: DataFrame, window: int) -> DataFrame:
    """Stretches of repeated windows of one shard: reference where a window stands at its first place, else to be streamed.

    `hits` of a document: structs of wh, first_doc, first_pos, shard."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, BATCH):
            out: list[tuple] = []
            every, lengths = word_hashes(batch.column(1))
            behind = np.cumsum(lengths)
            for k, (doc_id, text, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                words = words_of(text)
                if len(words) < window:
                    continue
                hits = batch.column(3)[k].values
                wh, first_doc, first_pos, shard = (hits.field(c).to_numpy(zero_copy_only=False) for c in range(4))
                order = np.argsort(wh)
                hashes = run_hashes(every[behind[k] - lengths[k] : behind[k]], window).view(np.int64)
                spot = order[np.minimum(np.searchsorted(wh, hashes, sorter=order), len(wh) - 1)]
                at = np.flatnonzero(wh[spot] == hashes)
                spot = spot[at]
                own = (first_doc[spot] == doc_id) & (first_pos[spot] == at)
                cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(shard[spot]) != 0) | (own[1:] != own[:-1])) + 1
                for run in np.split(np.arange(len(at)), cut):
                    # a long stretch is cut, so that a shard deals in small rows
                    for some in np.split(run, range(2000, len(run), 2000)):
                        if len(some):
                            a, b = int(at[some[0]]), int(at[some[-1]]) + window
                            out.append((int(shard[spot[some[0]]]), bool(own[some[0]]), doc_id, a, key, b - a, b" ".join(words[a:b])))
            if out:
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                names = [x.split()[0] for x in PIECE.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.select("doc_id", "text", "text_key", "hits").mapInArrow(read, PIECE)


class SuffixAutomaton:
    """Suffix automaton over words; each state keeps the last place of its first occurrence."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.end = [-1], [0], [-1]
        self.last = 0

    def add(self, word, place: int) -> None:
        following, link, length = self.next, self.link, self.length
        state = len(following)
        following.append({})
        link.append(0)
        length.append(length[self.last] + 1)
        self.end.append(place)
        p = self.last
        while p >= 0 and word not in following[p]:
            following[p][word] = state
            p = link[p]
        if p >= 0:
            q = following[p][word]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                self.end.append(self.end[q])
                while p >= 0 and following[p].get(word) == q:
                    following[p][word] = copy
                    p = link[p]
                link[q] = link[state] = copy
        self.last = state

    def statistics(self, words: list) -> Iterator[tuple[int, int]]:
        """For each word: length of the longest suffix of what came so far that stands in the reference, and its last place."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            else:
                matched = 0
            yield matched, self.end[state]


def build_automaton(passages: list[tuple[int, int, list[bytes]]]) -> tuple[SuffixAutomaton, list[tuple[int, int]]]:
    """One automaton over passages (doc_id, pos, words), kept apart by marks that no text has, and the place of each word."""
    automaton, places = SuffixAutomaton(), []
    for number, (doc_id, pos, words) in enumerate(passages):
        for k, word in enumerate(words):
            automaton.add(word, len(places))
            places.append((doc_id, pos + k))
        automaton.add(number, len(places))
        places.append((doc_id, -1))
    return automaton, places


def match_pieces(pieces: DataFrame, window: int, shard_tasks: DataFrame) -> DataFrame:
    """doc_id, text_key, spans (first place, place behind) of words under windows that stand earlier in the reference."""
    schema = "doc_id long, text_key long, start int, stop int"
    dealt = pieces.join(shard_tasks, "shard")
    tasks = F.when(F.col("reference"), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id", "pos"), F.col("tasks")).cast("int"))
    )
    spread = dealt.select("*", F.explode(tasks).alias("task")).drop("tasks")

    def match(group: pa.Table) -> pa.Table:
        known = group.filter(group.column("reference")).select(["doc_id", "pos", "text_key", "words"]).to_pylist()
        known = {(r["doc_id"], r["pos"], r["text_key"]): r["words"] for r in known}  # a repeated row gives each once
        automaton, places = build_automaton([(d, p, w.split(b" ")) for (d, p, _), w in sorted(known.items())])
        out: list[tuple] = []
        met: dict[bytes, list[tuple[int, int, int]]] = {}
        rest = group.filter(pa.compute.invert(group.column("reference")))
        for doc_id, pos, key, text in zip(*(rest.column(c).to_pylist() for c in ("doc_id", "pos", "text_key", "words")), strict=True):
            if text not in met:
                found = enumerate(automaton.statistics(text.split(b" ")))
                met[text] = [(k, *places[end]) for k, (n, end) in found if n >= window]
            start = stop = -1
            for k, first_doc, first_last in met[text]:
                a, b = pos + k - window + 1, pos + k + 1
                if (first_doc, first_last - window + 1) >= (doc_id, a):
                    continue
                if a > stop:
                    if stop > start:
                        out.append((doc_id, key, start, stop))
                    start = a
                stop = b
            if stop > start:
                out.append((doc_id, key, start, stop))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return spread.groupBy("shard", "task").applyInArrow(match, schema)


def removal_spans(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_key, spans of each text with removed words; and the documents that were candidates, with their texts.

    `docs`: doc_id (not null), text, text_key."""
    counted = anchor_rows(docs, window).withColumn("total", F.sum("n").over(Window.partitionBy("key")))
    shared = counted.filter("total > 1 AND doc_id IS NOT NULL").select("doc_id", F.coalesce("anchor", "key").alias("anchor"))
    of_doc = shared.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    regions = stage(docs.join(of_doc, "doc_id"), "dedup-candidates")
    windows = window_rows(regions, window)
    repeated = windows.groupBy("wh").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first")).filter("n > 1")
    repeated = stage(repeated.select("wh", F.col("first.doc_id").alias("first_doc"), F.col("first.pos").alias("first_pos")), "dedup-repeated")
    shards = max(1, -(-repeated.count() // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("first_doc", F.floor(F.col("first_pos") / (SHARD_WORDS // 4))), F.lit(shards))
    hits = windows.select("wh", "doc_id").join(repeated.withColumn("shard", shard), "wh").groupBy("doc_id").agg(
        F.collect_set(F.struct("wh", "first_doc", "first_pos", "shard")).alias("hits")
    )
    pieces = stage(piece_rows(regions.join(hits, "doc_id"), window), "dedup-pieces")
    tasks = pieces.groupBy("shard").agg(F.ceil(F.sum(F.when(F.col("reference"), 0).otherwise(F.col("n"))) / TASK_WORDS).alias("tasks"))
    spans = match_pieces(pieces, window, tasks.filter("tasks > 0").withColumn("tasks", F.col("tasks").cast("int")))
    spans = spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return stage(spans, "dedup-spans"), regions.drop("anchors")


def prepared(docs: DataFrame) -> DataFrame:
    """Documents with an id that is not null and a key of the text."""
    return docs.withColumn("text_key", F.xxhash64("text")).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))


def kept_words(words: list[bytes], spans) -> list[bytes]:
    out, at = [], 0
    for span in spans or ():
        if span["start"] > at:
            out += words[at : span["start"]]
        at = max(at, span["stop"])
    return out + words[at:]


def dedup_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Whole texts are digested where they are read; only candidates meet their spans, so most texts are not shuffled."""
    own = prepared(docs.select("doc_id", "text"))
    spans, candidates = removal_spans(own, window)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            n, whole = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                n.append(len(words))
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(whole, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words", "whole_sha256"])

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            removed, kept = [], []
            for text, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = words_of(text)
                left = kept_words(words, cut)
                removed.append(len(words) - len(left))
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
            columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "removed", "short_sha256"])

    every = own.select("doc_id", "text_key", "text").mapInArrow(digest, "doc_id long, text_key long, n_words long, whole_sha256 string")
    met = candidates.join(spans, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "spans")
    cut = met.mapInArrow(shorten, "doc_id long, text_key long, removed long, short_sha256 string").dropDuplicates(["doc_id", "text_key"])
    return every.join(cut, ["doc_id", "text_key"], "left").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
        "n_words",
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.coalesce("short_sha256", "whole_sha256").alias("kept_sha256"),
    )


def dedup_texts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents with all their columns; texts that lose words become the kept words joined by one space, others stay as
    they are, and documents that lose every word go."""
    spans, _ = removal_spans(prepared(docs.select("doc_id", "text")), window)
    renamed = spans.toDF("span_doc", "span_key", "span_list")
    key = (F.coalesce(F.col("doc.doc_id").cast("long"), F.lit(NO_ID)) == F.col("span_doc")) & (F.xxhash64("doc.text") == F.col("span_key"))
    met = docs.select(F.struct("*").alias("doc")).join(renamed, key, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            new = []
            for text, spans_of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new.append(text if not spans_of else b" ".join(kept_words(words_of(text), spans_of)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(new, pa.string())], ["doc", "new_text"])

    kind = met.schema["doc"].dataType.simpleString()
    texts = met.select(F.col("doc.text").alias("old"), "span_list", "doc").mapInArrow(cut, f"doc {kind}, new_text string")
    kept = texts.filter((F.col("new_text") != "") | F.col("new_text").eqNullSafe(F.col("doc.text")))
    return kept.select(F.col("doc").withField("text", F.col("new_text")).alias("doc")).select("doc.*")
