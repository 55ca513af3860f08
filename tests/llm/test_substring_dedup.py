import hashlib
import random
import re

import numpy as np
import pytest

from pactframe.llm import substring_dedup as sd


def brute(docs, window):
    """Every window of every text in order of (id, start), by its words."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    order = lambda i: -(1 << 63) if i is None else i
    first = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, (order(i), k)), (order(i), k))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (order(i), k):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    dice = random.Random(seed)
    word = lambda: "w" + str(int(dice.paretovariate(0.4)) % 3000)
    passages = [[word() for _ in range(dice.choice([6, 19, 20, 21, 60, 300]))] for _ in range(8)]
    docs = []
    for k in range(150):
        w = []
        for _ in range(dice.randint(0, 4)):
            w += dice.choice(passages) if dice.random() < 0.5 else [word() for _ in range(dice.choice([1, 15, 40]))]
        if dice.random() < 0.2 and docs:
            w = docs[dice.randrange(len(docs))][1].split()
        docs.append((dice.randint(0, 10**6), dice.choice([" ", "\n", " \t"]).join(w)))
    docs += [(5, " ".join(["same"] * 100)), (6, " ".join(["same"] * 30)), (7, "a b " * 40), (8, None), (9, ""), (10, "É" * 9)]
    return docs


@pytest.mark.parametrize(("seed", "window"), [(1, 20), (2, 20), (3, 8)])
def test_against_brute_force(frame, seed, window, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_WORDS", 100)
    monkeypatch.setattr(sd, "TASK_WORDS", 300)
    docs = corpus(seed)
    got = sorted((tuple(r) for r in sd.dedup_words(frame(docs, extra=True), window).collect()), key=repr)
    assert got == brute(docs, window)


def test_equal_ids_null_ids_and_long_texts(frame):
    long = " ".join(f"x{i % 7000}" for i in range(60_000))
    docs = [(3, long), (1, "p q r s t " * 6), (1, "p q r s t " * 6), (1, "zz " + "p q r s t " * 6), (None, "p q r s t " * 6), (None, long[:40_000])]
    got = sorted((tuple(r) for r in sd.dedup_words(frame(docs)).collect()), key=repr)
    assert got == brute(docs, 20)
    assert sd.dedup_words(frame([])).collect() == []


def test_texts(frame, rows):
    base = " ".join(f"k{i}" for i in range(30))
    docs = [(1, f"one\n{base}  end"), (2, f"{base}  tail"), (3, base), (4, None), (5, "")]
    got = sd.dedup_texts(frame(docs, extra=True))
    assert got.columns == frame(docs, extra=True).columns
    assert [(r["doc_id"], r["text"]) for r in rows(got)] == [(1, f"one\n{base}  end"), (2, "tail"), (4, None), (5, "")]


def test_matching_statistics_against_search():
    dice = random.Random(2)
    reference = [[dice.choice("ab") for _ in range(40)] for _ in range(3)]
    automaton, places = sd.build_automaton([(k, 10, w) for k, w in enumerate(reference)])
    stream = [dice.choice("abc") for _ in range(200)]
    for k, (n, end) in enumerate(automaton.statistics(stream)):
        runs = [m for m in range(k + 2) if any(stream[k + 1 - m : k + 1] == w[s : s + m] for w in reference for s in range(41 - m))]
        assert n == max(runs)
        if n:
            doc, last = places[end]
            assert reference[doc][last - 10 - n + 1 : last - 10 + 1] == stream[k + 1 - n : k + 1]


def test_sliding_least_and_run_hashes():
    v = np.random.default_rng(1).integers(0, 1 << 60, 100, dtype=np.uint64)
    for n in (1, 2, 7, 8, 15):
        assert sd.sliding_least(v, n).tolist() == [int(v[i : i + n].min()) for i in range(101 - n)]
    h = sd.run_hashes(np.concatenate([v, v]), 20)
    assert (h[:81] == h[100:]).all() and len(set(h[:81].tolist())) == 81
