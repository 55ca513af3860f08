"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a sequence of units, runs of letters A-Z or single other code points. One full match of `(unit)*` with a library
that keeps every repetition of a group gives the ends of all units at once: their number n and both cut offsets are read
from that list. Which units are cut, and the form, come from a hash of seed and id, so a row depends on itself alone and
any task can be run again.

The match keeps some 20 bytes a unit, so a text of more than `BLOCK` code points is matched in blocks that end where a
unit ends; the ends are those of one match over the whole text.

Defined results: a null text counts as empty, an empty text is plain with n = 0; a null id is hashed as an empty one;
repeated rows give repeated rows; an empty table gives no rows; columns beyond doc_id and text are not carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import rows

# The unit, the sentinels, and the shares of plain and of suffix-first outputs in percent.
UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
NO_LETTER = regex.compile(r"[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

BLOCK = 1_000_000
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Parts(NamedTuple):
    n: int
    form: str
    prefix: str
    middle: str
    suffix: str


def unit_ends(text: str, block: int = BLOCK) -> list[np.ndarray]:
    """Ends of all units, in blocks; a block is closed before the first code point that is no letter."""
    ends, at = [], 0
    while at < len(text):
        stop = len(text)
        if stop - at > block:
            edge = NO_LETTER.search(text, at + block)
            stop = edge.start() if edge else stop
        ends.append(np.array(UNITS.fullmatch(text, at, stop).ends(1), np.int64))
        at = stop
    return ends


def end_of(ends: list[np.ndarray], k: int) -> int:
    """Offset behind the first k units."""
    if k == 0:
        return 0
    for block in ends:
        if k <= len(block):
            return int(block[k - 1])
        k -= len(block)
    raise IndexError(k)


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def split_text(doc_id: int | None, text: str, seed: int) -> Parts:
    ends = unit_ends(text)
    n = sum(map(len, ends))
    one, two, keep, order = draws(doc_id, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or keep % 100 >= PLAIN_FROM:
        return Parts(n, "plain", "", "", "")
    first, last = sorted((end_of(ends, one % (n + 1)), end_of(ends, two % (n + 1))))
    return Parts(n, "spm" if order % 100 < SPM_BELOW else "psm", text[:first], text[first:last], text[last:])


def arrange(text: str, parts: Parts) -> str:
    if parts.form == "plain":
        return text
    head, tail = PREFIX + parts.prefix, SUFFIX + parts.suffix
    return (tail + head if parts.form == "spm" else head + tail) + MIDDLE + parts.middle


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null where plain), output (the training text) per document."""

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            cut = [split_text(i, t, seed) for i, t in zip(ids, texts, strict=True)]
            plain = [p.form == "plain" for p in cut]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p.n for p in cut], pa.int64()),
                    pa.array([p.form for p in cut], pa.string()),
                    pa.array([None if x else len(p.prefix) for p, x in zip(cut, plain, strict=True)], pa.int64()),
                    pa.array([None if x else len(p.middle) for p, x in zip(cut, plain, strict=True)], pa.int64()),
                    pa.array([arrange(t, p) for t, p in zip(texts, cut, strict=True)], pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(transform, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text rebuilt from output and form alone; every sentinel stands once in an output that is not plain."""

    def between(mark: str, until: str) -> Column:
        return F.substring_index(F.substring_index(output, mark, -1), until, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Per document the counts of `fill_in_middle` and the hashes of its output and of the text rebuilt from that output."""
    made = fill_in_middle(docs, seed)
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


# DuckDB: units as a list of matches, cut by slices
FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
h AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""
