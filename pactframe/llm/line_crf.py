"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line has counts of what it is made of, next to those of the line before and after it. The field labels lines good or
bad; forward-backward gives each line's marginal, and a document's quality is the mean of its lines' marginals for good,
weighted by their lengths. The label of a document teaches all its lines.

The fit takes a bounded sample: at most `SAMPLE_DOCS` labelled documents of at most `SAMPLE_BYTES` bytes and `SAMPLE_LINES` lines, those with the
smallest hashes of their ids. Scoring covers every document and whole texts; the chain runs over all documents of a batch
side by side, so memory follows the batch.

Defined results: a null or empty text, and one of empty lines only, is one empty line; a null label teaches nothing;
without labelled documents, or with one label only, the field still answers with numbers from 0 to 1; repeated rows are
scored each; an empty table gives an empty result; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import fold, rows

#: A line is 192 bytes of features: the sample that the driver gets has at most 230 MB.
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_LINES = 3_000, 100_000, 400
STEPS, RATE, DECAY = 150, 0.15, 1e-3

# Byte classes that are counted in a line.
CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b"#*$%&|<>@^~\\/={}[]_+",
    b"!?",
    b".,;:'\"()-",
    bytes(range(128, 256)),
)
N_OWN = len(CLASSES) + 8
#: Own counts, those of both neighbours, whether there is a neighbour on either side, and a constant.
N_FEATURES = 3 * N_OWN + 3


def line_counts(line: bytes, seen: set[bytes]) -> list[float]:
    n = len(line) or 1
    words = line.split()
    m = len(words) or 1
    share = [(len(line) - len(line.translate(None, c))) / n for c in CLASSES]
    again = line in seen
    seen.add(line)
    return share + [
        len(line) / (len(line) + 100),
        len(words) / (len(words) + 10),
        min(len(line) / m, 30.0) / 10,
        1 - len(set(words)) / m if words else 0.0,
        sum(map(eq, words, words[1:])) / m,
        float(line.rstrip()[-1:] in (b".", b"!", b"?", b":")) if words else 0.0,
        float(again),
        float(not words),
    ]


def document_lines(text: str | None) -> list[bytes]:
    """Lines with a character in them; one empty line if there is none."""
    return [x for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if x.strip()] or [b""]


def features(lines: list[bytes]) -> np.ndarray:
    """One row per line: own counts, the neighbours' counts, the text's ends, a constant."""
    seen: set[bytes] = set()
    own = np.array([line_counts(x, seen) for x in lines], np.float32)
    out = np.zeros((len(lines), N_FEATURES), np.float32)
    out[:, :N_OWN] = own
    out[1:, N_OWN : 2 * N_OWN] = own[:-1]
    out[:-1, 2 * N_OWN : 3 * N_OWN] = own[1:]
    out[0, -3] = out[-1, -2] = out[:, -1] = 1
    return out


@dataclass
class Field:
    """weights: log-odds of a good line per feature; links: log-potential of each pair (label, next label)."""

    weights: np.ndarray
    links: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights, -30, 30)


def steps_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Documents by falling length, where each begins, and how many reach each step."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    longest = int(lengths.max(initial=0))
    reach = np.searchsorted(-lengths[order], -np.arange(longest), side="left").tolist()
    return order, starts, reach


def marginals(odds: np.ndarray, lengths: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for each line, and the expected number of each pair of labels. All chains run side by side."""
    _, starts, reach = steps_of(lengths)
    local = np.stack([np.ones_like(odds), np.exp(odds)], 1)
    local /= local.sum(1, keepdims=True)
    move = np.exp(links - links.max())
    forward, backward = np.empty_like(local), np.ones_like(local)
    now = np.empty((0, 2))
    for t, n in enumerate(reach):
        at = starts[:n] + t
        now = local[at] if t == 0 else (now[:n] @ move) * local[at]
        now /= now.sum(1, keepdims=True)
        forward[at] = now
    pairs = np.zeros((2, 2))
    for t in range(len(reach) - 1, 0, -1):
        at = starts[: reach[t]] + t
        later = local[at] * backward[at]
        joint = forward[at - 1][:, :, None] * move[None] * later[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        before = later @ move.T
        backward[at - 1] = before / before.sum(1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(1), pairs


def fit(x: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Gradient ascent (Adam) on the mean log-likelihood of the lines' labels, each document's label for all its lines."""
    field = Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    if not len(lengths):
        return field
    y = np.repeat(labels, lengths).astype(float)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    weight = 1.0 / lengths[owner]  # every document counts alike, however many lines it has
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels, labels), lengths - 1)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (field.weights, field.links)]
    for step in range(1, steps + 1):
        p, pairs = marginals(field.odds(x), lengths, field.links)
        slopes = (x.T @ ((y - p) * weight) / len(lengths), (seen - pairs) / max(len(y), 1))
        for value, slope, moment in zip((field.weights, field.links), slopes, state, strict=True):
            slope = slope - DECAY * value
            moment[0] = 0.9 * moment[0] + 0.1 * slope
            moment[1] = 0.99 * moment[1] + 0.01 * slope**2
            value += RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
    return field


def read_lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of some texts, lines per text, and bytes of each line (at least 1)."""
    lines = [document_lines(t) for t in texts]
    x = np.concatenate([features(d) for d in lines])
    return x, np.array([len(d) for d in lines]), np.array([max(len(v), 1) for d in lines for v in d], float)


def document_scores(field: Field, texts: list[str | None]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    x, lengths, size = read_lines(texts)
    p, _ = marginals(field.odds(x), lengths, field.links)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.clip(np.add.reduceat(p * size, starts) / np.add.reduceat(size, starts), 0, 1)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fit on labelled documents outside the held-out fold (crc32 of the id modulo 3 is 1)."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.filter(fold(F.col("doc_id"), 3) != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    text = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    sample = docs.select("doc_id", "text").filter((F.octet_length(text) <= SAMPLE_BYTES) & (breaks < SAMPLE_LINES))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            data = [features(document_lines(t)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(data, pa.binary())], ["doc_id", "quality", "x"])

    met = sample.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("int"))
    kind = met.schema["doc_id"].dataType.simpleString()
    got = met.mapInArrow(describe, f"doc_id {kind}, quality int, x binary").orderBy("doc_id", "x").limit(sample_docs).collect()
    got.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    x = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got]
    lengths = np.array([len(v) for v in x], np.int64)
    return fit(np.concatenate(x) if x else np.zeros((0, N_FEATURES)), lengths, np.array([int(r.quality > 0) for r in got], np.int64))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            found = document_scores(field, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def label_lines(docs: DataFrame, field: Field) -> DataFrame:
    """The lines themselves: doc_id, line (from 0, lines without characters left out), text, good (marginal)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            x, lengths, _ = read_lines(texts)
            p, _ = marginals(field.odds(x), lengths, field.links)
            lines = [v.decode("utf-8", "surrogatepass") for t in texts for v in document_lines(t)]
            number = np.arange(len(lines)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            owner = [i for i, n in zip(ids, lengths, strict=True) for _ in range(n)]
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64())
            columns = [pa.array(c, k) for c, k in zip((owner, number, lines, p), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "text", "good"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, line int, text string, good double")


def keep_good(docs: DataFrame, field: Field) -> DataFrame:
    """Documents scored 0.5 or more, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            yield batch.filter(pa.array(document_scores(field, batch.column(at).to_pylist()) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
