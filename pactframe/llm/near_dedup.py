"""Near-duplicates by HyperMinHash: compressed registers, bands over them, corrected estimates, and a check on full sets.

Sets: distinct runs of five lower-cased words, hashed to 64 bits. A sketch has `REGISTERS` buckets, each with a hash
function of its own; it keeps the count of leading zeros of the smallest hash (6 bits) and the 10 bits behind the first
one. Bands of `ROWS` registers are hashed; texts that share a band are candidates.

1. Documents with equal sets are one class; only classes are compared, so copies cost one row each.
2. In each band bucket one member leads and is compared with all others: estimate first (corrected for registers that
   are equal by chance), then full sets. No pairs are formed among the rest.
3. A bucket is settled when all members that have not led lie in one component: links inside a component change nothing.
   In open buckets, sketches of members of different components are compared inside the task, in parts of at most `PART`
   members: first each member of a smaller component gives its `BEST` likeliest partners; then, after these have joined
   what they can, all. That last round brings full sets to the bucket, at most `SET_PART` hashes a part, and checks its
   pairs where they are, each in the first bucket that both share: pairs stay in the task, and only links that join
   components leave it, fewer than it has members.
4. At last the same is done for the buckets of more than `CROWD` that are still open, so a pair whose only common bands
   are crowded ones is compared too.

A pair at the limit of 0.75 shares no band with probability 5e-6; an estimate 4 standard deviations under the limit
(`LEAST`) is not checked on full sets, which at 0.75 leaves out 7.5e-5 more.

Defined results: a text without words has an empty set and is linked with nothing; a shorter text than five words is one
run; a null id joins its class only, and a class of null ids has a null component; repeated rows are one class; an empty
table gives an empty result; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactframe.llm.common import gram_hashes, mix, rows, stage, word_hashes
from pactframe.llm.components import connected_components

SHINGLE, REGISTERS, ROWS = 5, 128, 4
MANTISSA = 10
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75
LEAST = 0.6
FACTORS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
#: Buckets of more members are compared last: by then many are settled.
CROWD = 512
#: Members of an open bucket compared in one task; likeliest partners in other components tried first.
PART, BEST = 4096, 3
#: Hashes of full sets of one part, where pairs of a bucket are checked.
SET_PART = 4_000_000


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its five-word runs."""
    words, lengths = word_hashes(texts, lower=True)
    for w in np.split(words, np.cumsum(lengths)[:-1]) if len(lengths) else ():
        yield np.unique(gram_hashes(w, min(SHINGLE, len(w)))) if len(w) else w


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word runs of a text."""
    return next(shingle_sets(pa.array([(text or "").encode("utf-8", "surrogatepass")], pa.binary())))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers (uint16) of a set that is not empty."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        low = np.minimum(low, (hashes[at : at + 2048, None] * FACTORS[None]).min(axis=0))
    low = np.maximum(low, np.uint64(1))
    top = np.log2(low.astype(np.float64)).astype(np.int64)  # place of the first one, at most 1 too high by rounding
    top -= (low >> top.clip(0, 63).astype(np.uint64)) == 0
    zeros = np.minimum(63 - top, 63)
    shift = top - MANTISSA
    mantissa = np.where(shift >= 0, low >> shift.clip(0).astype(np.uint64), low << (-shift).clip(0).astype(np.uint64))
    return (zeros << MANTISSA | (mantissa & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)).astype(np.uint16)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two sets without common elements are equal: both minima in one cell."""
    rate = (n + m).astype(float)[:, None]
    high = 2.0 ** -np.arange(0, 48)[None]
    low = high / 2
    inside = np.exp(-rate * low) - np.exp(-rate * high)
    cell = low / (1 << MANTISSA)
    return np.minimum((inside * cell).sum(1) * n * m / (n + m), 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of sketch rows a and b, corrected for chance."""
    c = chance(n, m)
    return ((a == b).mean(1) - c) / (1 - c)


def linked(inter: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * inter >= PERCENT * (n + m - inter)


def read_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), node (hash of the set; null if empty), sketch of every document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            n, node, sketches = [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                node.append(node_of(s) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, n long, node long, sketch binary")


def node_of(s: np.ndarray) -> int:
    """Number of a class: a 64-bit hash of its whole set."""
    spread = mix(s + np.uint64(0x632BE59BD9B4E019))
    folded = mix(spread.sum(keepdims=True)) * np.uint64(3) + np.bitwise_xor.reduce(spread, keepdims=True)
    return int(mix(folded).view(np.int64)[0])


def bands(classes: DataFrame) -> DataFrame:
    """band (hash of band number and registers), number, node."""
    n_bands = REGISTERS // ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            if not batch.num_rows:
                continue
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, n_bands, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), registers.shape[:2])
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, :, k])
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n_bands)
            number = np.tile(np.arange(n_bands, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(number), pa.array(node)], ["band", "number", "node"])

    return classes.select("node", "sketch").mapInArrow(cut, "band long, number int, node long")


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and whose corrected estimate is at least `LEAST`."""
    side = classes.select("node", "n", "sketch")
    met = pairs.join(side.toDF("a", "n_a", "sketch_a"), "a").join(side.toDF("b", "n_b", "sketch_b"), "b")
    met = met.filter(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            if not batch.num_rows:
                continue
            n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 4))
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (3, 5))
            good = pa.array(estimate(a, b, n, m) >= LEAST)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(good)

    return met.select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b").mapInArrow(keep, "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, whole set of the classes in `wanted` (node, rep), from the text of the document `rep`.

    Rows that have the same id but another text are told apart by their class."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            found = [(k, s) for k, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)), strict=True)
                     if len(s) and node_of(s) == k]
            columns = [pa.array([k for k, _ in found], pa.int64()), pa.array([s.tobytes() for _, s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "members"])

    own = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    return own.join(wanted, "rep").select("node", "text").mapInArrow(build, "node long, members binary").dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, likeness (Jaccard), linked of pairs, on full sets."""
    met = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            inter, n, m = [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                spot = np.minimum(np.searchsorted(one, other), len(one) - 1)
                inter.append(int((one[spot] == other).sum()))
                n.append(len(one))
                m.append(len(other))
            i, n, m = (np.array(v, np.int64) for v in (inter, n, m))
            columns = [batch.column(0), batch.column(1), pa.array(i / np.maximum(n + m - i, 1)), pa.array(linked(i, n, m))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "likeness", "linked"])

    return met.mapInArrow(count, "a long, b long, likeness double, linked boolean")


def ordered_pairs(df: DataFrame, one: str, other: str) -> DataFrame:
    return df.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).filter("a < b").distinct()


def buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Band buckets of two or more (band, number, node, leader, n), the leader being the smallest member; and the members
    (band, mask, node) that are compared where a bucket stays open, `mask` being the bit of the band's number: first those
    of other buckets, then those of crowded ones."""
    member = stage(bands(classes), "bands")
    sizes = member.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).filter("n > 1")
    shared = stage(member.join(sizes, "band").select("band", "number", "node", "leader", "n"), "shared-bands")
    member = shared.filter((F.col("n") > 2) & (F.col("node") != F.col("leader")))
    member = member.select("n", "band", F.expr("shiftleft(1L, number)").alias("mask"), "node")
    return shared, member.filter(F.col("n") <= CROWD).drop("n"), member.filter(F.col("n") > CROWD).drop("n")


def dealt(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of open buckets with size and sketch, once for every `task` of their bucket: each two of its parts meet."""
    places = members.groupBy("node").agg(F.bit_or("mask").alias("places"))  # its open buckets, as bits
    sketched = members.join(classes.select("node", F.col("n").alias("size"), "sketch"), "node").join(places, "node")
    parts = F.ceil(F.col("n") / PART)
    return met(sketched.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")), parts, "part", "task")


def met(rows: DataFrame, parts: Column, part: str, task: str) -> DataFrame:
    """Rows with `task`, which two of the `parts` meet in it: once for every part."""
    ends = lambda k: F.struct(F.least(part, k).alias("i"), F.greatest(part, k).alias("j"))
    return rows.withColumn(task, F.explode(F.transform(F.sequence(F.lit(0), parts.cast("int") - 1), ends)))


def likely(group: pa.Table, best: int | None, last: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, places of its partners, number of each row's component) of the members that have partners in one task of a
    bucket: of another component, with sizes and estimates that allow a link, and in no bucket that comes first.

    `last`: pairs that share another bucket than those that are open now were compared in it before."""
    node, label, size, part, places = (group.column(c).to_numpy() for c in ("node", "label", "size", "part", "places"))
    mask = group.column("mask")[0].as_py()
    _, kind, crowd = np.unique(label, return_inverse=True, return_counts=True)
    weight = crowd[kind]
    registers = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    mixed = part.min() != part.max()  # two parts meet here: pairs inside one part meet elsewhere
    for k in range(len(node)):
        # the member of the smaller component gives the pair
        fit = (weight > weight[k]) | ((weight == weight[k]) & (label > label[k]))
        fit &= 100 * np.minimum(size, size[k]) >= PERCENT * np.maximum(size, size[k])
        at = np.flatnonzero(fit & (part != part[k]) if mixed else fit)
        if not len(at):
            continue
        like = estimate(registers[at], registers[k][None], size[at], size[k : k + 1])
        at, like = at[like >= LEAST], like[like >= LEAST]
        if best:
            at = at[np.argsort(-like, kind="stable")[:best]]
        if len(at):
            alike = (registers[at] == registers[k]).reshape(len(at), -1, ROWS).all(2)
            bits = (alike * (1 << np.arange(alike.shape[1], dtype=np.int64))).sum(1)
            both = bits & places[at] & places[k]
            first = (both & -both) == mask  # this is the first bucket that both share
            at = at[first & (both == bits) if last else first]
        if len(at):
            yield k, at, kind


def partners(members: DataFrame, classes: DataFrame, best: int, last: bool = False) -> DataFrame:
    """Pairs (a, b) of one bucket: of each member the `best` likeliest of other components."""

    def meet(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        found = [(min(int(node[k]), int(x)), max(int(node[k]), int(x))) for k, at, _ in likely(group, best, last) for x in node[at]]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt(members, classes).groupBy("band", "task").applyInArrow(meet, "a long, b long").distinct()


def bridges(members: DataFrame, classes: DataFrame, sets: DataFrame, last: bool = False) -> DataFrame:
    """Links (a, b) that join what the open buckets hold of different components, checked on full sets inside the task.

    First the members that have a likely partner are told, then their sets are brought to their bucket. Pairs stay in the
    task: it gives a link only where that joins two components, so fewer than it has members."""
    names = ["band", "mask", "node", "label", "size", "sketch", "places", "part", "task"]
    spread = dealt(members, classes).select(*names)

    def hold(group: pa.Table) -> pa.Table:
        use = np.zeros(group.num_rows, bool)
        for k, at, _ in likely(group, None, last):
            use[k] = use[at] = True
        return group.filter(pa.array(use)).select(names)

    held = stage(spread.groupBy("band", "task").applyInArrow(hold, spread.schema), "held-members")
    # sets of one task are bounded too: what is more is cut into further parts, each two of which meet
    sums = held.groupBy("band", "task").agg(F.ceil(F.sum("size") / SET_PART).cast("int").alias("cuts"))
    cut = held.join(sums, ["band", "task"]).withColumn("piece", F.pmod(F.xxhash64("node", F.lit(1)), F.col("cuts")).cast("int"))
    ready = met(cut, F.col("cuts"), "piece", "pieces").select(*names, "piece", "pieces").join(sets, "node")

    def check(group: pa.Table) -> pa.Table:
        node, piece = group.column("node").to_numpy(), group.column("piece").to_numpy()
        members = [np.frombuffer(x, np.uint64) for x in group.column("members").to_pylist()]
        size, mixed = np.array([len(x) for x in members], np.int64), piece.min() != piece.max()
        root, found = None, []
        for k, at, kind in likely(group, None, last):
            root = np.arange(kind.max() + 1) if root is None else root
            at = at[(root[kind[at]] != root[kind[k]]) & ((piece[at] != piece[k]) | (not mixed))]
            if not len(at):
                continue
            own, other = members[k], np.concatenate([members[x] for x in at])
            same = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            inter = np.add.reduceat(same, np.cumsum(size[at]) - size[at], dtype=np.int64)
            for x in at[linked(inter, size[at], size[k])]:
                if root[kind[x]] != root[kind[k]]:
                    root[root == root[kind[x]]] = root[kind[k]]
                    found.append(sorted((int(node[k]), int(node[x]))))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return ready.groupBy("band", "task", "pieces").applyInArrow(check, "a long, b long")


def still_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (band, mask, node) of buckets that hold more than one component, with its label and the bucket's size n."""
    now = members.join(connected_components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = now.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    return stage(now.join(split.filter("low < high").select("band", "n"), "band"), "open-buckets")


def class_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes whose components are those of all links."""
    shared, rest, crowded = buckets(classes)
    tried = stage(ordered_pairs(shared, "node", "leader"), "tried-pairs")
    pairs = stage(estimated(tried, classes), "pairs")
    # sets of every class that shares a bucket of three or more, and of both sides of each pair
    wanted = shared.filter("n > 2").select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    sets = stage(full_sets(docs, wanted.join(classes.select("node", "rep"), "node")), "sets")
    links = stage(compared(pairs, sets).filter("linked").select("a", "b"), "links")
    for members, last in ((rest, False), (crowded, True)):
        still = still_open(members, links)
        fresh = stage(partners(still, classes, BEST, last).join(tried, ["a", "b"], "left_anti"), "more-pairs")
        tried = tried.union(fresh)
        links = stage(links.union(compared(fresh, sets).filter("linked").select("a", "b")), "links")
        still = still_open(still.select("band", "mask", "node"), links)
        links = stage(links.union(bridges(still, classes, sets, last)), "links")
    return links


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    each = stage(read_sets(docs), "sketches")
    classes = stage(
        each.filter("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    labels = stage(connected_components(class_links(docs, classes)), "class-labels")
    grouped = classes.select("node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("rep").alias("component"))
    named = stage(grouped.join(least, "label").select("node", "component"), "components")
    out = each.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """Documents with all their columns, of each group the one with the smallest id; rows with equal ids stay together."""
    kept = near_groups(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("doc"))  # columns of any name cannot clash
    return rows.join(kept, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("kept_id")), "left_semi").select("doc.*")
