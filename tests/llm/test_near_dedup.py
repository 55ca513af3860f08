import random

import numpy as np
import pytest

from pactframe.llm import near_dedup as nd
from pactframe.llm.components import connected_components


def sets_of(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    """Every pair of sets, then union-find."""
    sets = [sets_of(t) for _, t in docs]
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[top(i)], doc_id == least[top(i)]) for i, (doc_id, _) in enumerate(docs))


def corpus(seed, n=260):
    dice = random.Random(seed)
    word = lambda: "w" + str(dice.randint(0, 5000))
    docs, bases = [], [[word() for _ in range(dice.choice([3, 8, 40, 200]))] for _ in range(12)]
    shared = [word() for _ in range(60)]
    for k in range(n):
        w = list(dice.choice(bases)) if dice.random() < 0.7 else [word() for _ in range(dice.choice([2, 30, 120]))]
        for _ in range(int(len(w) * dice.choice([0, 0, 0.01, 0.03, 0.06, 0.1]))):
            w[dice.randrange(len(w))] = word()
        if dice.random() < 0.3:
            w += shared
        docs.append((k * 7 % 1009, " ".join(w).upper() if dice.random() < 0.2 else " ".join(w)))
    return docs + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "ONE two"), (2005, "one")]


@pytest.mark.parametrize(("seed", "crowd", "part"), [(1, 48, 4096), (2, 4, 5)])
def test_against_brute_force(frame, seed, crowd, part, monkeypatch):
    monkeypatch.setattr(nd, "CROWD", crowd)
    monkeypatch.setattr(nd, "PART", part)
    docs = corpus(seed)
    got = sorted(tuple(r) for r in nd.near_groups(frame(docs, extra=True)).collect())
    assert got == brute(docs)


def test_chain_that_only_bridges_connect(frame):
    """Neighbours in the chain are linked, most others are not: members after the leader have to be compared too."""
    base = [f"t{i}" for i in range(400)]
    docs = [(k, " ".join(base[8 * k : 8 * k + 120])) for k in range(30)]
    got = sorted(tuple(r) for r in nd.near_groups(frame(docs)).collect())
    assert got == brute(docs)


def test_repeats_null_ids_and_long_texts(frame, rows):
    long = " ".join(f"x{i}" for i in range(150_000))
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only here without id"), (2, long), (3, long + " y")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in rows(nd.near_groups(frame(docs)))]
    assert sorted(got[:2], key=repr) == [(None, 1, False), (None, None, True)]
    assert got[2:] == [(1, 1, True), (1, 1, True), (2, 2, True), (3, 2, False)]
    assert nd.near_groups(frame([])).collect() == []


def test_estimates_are_close_and_corrected():
    dice = np.random.default_rng(4)
    errors = []
    for size in (5, 60, 3000):
        for share in (0.0, 0.3, 0.75, 0.95):
            for _ in range(20):
                common = dice.integers(1, 1 << 63, max(1, int(size * share)), dtype=np.uint64)
                a, b = (np.unique(np.concatenate([common, dice.integers(1, 1 << 63, size - len(common), dtype=np.uint64)])) for _ in "ab")
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                n, m = np.array([len(a)]), np.array([len(b)])
                errors.append(nd.estimate(nd.sketch(a)[None], nd.sketch(b)[None], n, m)[0] - true)
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.2


def test_registers_keep_leading_zeros_and_mantissa():
    low = nd.sketch(np.array([1], np.uint64)).astype(int)
    for value, register in zip(nd.FACTORS, low, strict=True):
        bits = f"{int(value):064b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        assert register == zeros << 10 | int(bits[zeros + 1 : zeros + 11].ljust(10, "0"), 2)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (5, 5), (200, 201)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}


def test_a_pair_that_meets_only_in_a_crowded_bucket(spark, frame, monkeypatch):
    monkeypatch.setattr(nd, "CROWD", 4)
    dice = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), *(" ".join(f"{k}x{i}" for i in range(50)) for k in range(12))]
    sets = [nd.shingle_set(t) for t in texts]
    nodes = [nd.node_of(s) for s in sets]
    assert min(nodes) not in nodes[:2]  # the leader is neither
    registers = dice.integers(0, 1 << 16, (len(texts), nd.REGISTERS)).astype(np.uint16)
    registers[1] = registers[0]
    registers[1, 4::4] += 1  # alike, but equal in the first band only
    registers[:, :4] = 7
    rows = [(n, k, len(s), r.tobytes()) for k, (n, s, r) in enumerate(zip(nodes, sets, registers, strict=True))]
    classes = spark.createDataFrame(rows, "node long, rep long, n long, sketch binary")
    links = nd.class_links(frame(list(enumerate(texts))), classes).collect()
    assert {tuple(r) for r in links} == {tuple(sorted(nodes[:2]))}


def test_keep_first_with_a_column_of_its_own_names(frame):
    text = "one two three four five six seven eight"
    docs = frame([(1, text), (2, text), (3, "other words here only five")]).selectExpr("*", "'x' AS kept_id", "'y' AS doc", "'z' AS node")
    kept = nd.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_pairs_of_an_open_bucket_stay_in_the_task(frame, monkeypatch):
    """Many texts that are just less alike than a link needs: what is checked outside the tasks does not grow with their square."""
    dice = random.Random(5)
    base = [f"b{i}" for i in range(400)]
    docs = []
    for k in range(240):
        w = list(base)
        for i in dice.sample(range(400), 8):
            w[i] = f"d{k}x{i}"
        docs.append((k, " ".join(w)))
    checked = []
    real = nd.compared

    def counted(pairs, sets):
        checked.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(nd, "compared", counted)
    got = sorted(tuple(r) for r in nd.near_groups(frame(docs)).collect())
    assert got == brute(docs)
    assert sum(checked) < 240 * (32 + nd.BEST)  # 240 * 239 / 2 pairs of other components share a bucket


@pytest.mark.parametrize("size", [64, 500])
def test_sets_of_an_open_bucket_are_cut_into_parts(frame, size, monkeypatch):
    monkeypatch.setattr(nd, "SET_PART", size)
    monkeypatch.setattr(nd, "CROWD", 4)
    docs = corpus(7, 150)
    got = sorted(tuple(r) for r in nd.near_groups(frame(docs)).collect())
    assert got == brute(docs)
