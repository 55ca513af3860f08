import hashlib
import random

import pytest

from pactframe.llm import fingerprints as fp


def brute_likeness(a: str, b: str) -> float:
    """Edit distance by the full table, insertions and deletions only."""
    if a == b:
        return 1.0
    best = 0.0
    (x, *xs), (y, *ys) = a.split(":"), b.split(":")
    for i, s in enumerate(xs):
        for j, t in enumerate(ys):
            if int(x) << i != int(y) << j or not s or not t:
                continue
            run = min(7, len(s), len(t))
            if not {s[k : k + run] for k in range(len(s) - run + 1)} & {t[k : k + run] for k in range(len(t) - run + 1)}:
                continue
            row = list(range(len(t) + 1))
            for k, c in enumerate(s, 1):
                prev, row[0] = row[0], k
                for m, d in enumerate(t, 1):
                    prev, row[m] = row[m], prev if c == d else 1 + min(row[m], row[m - 1])
            best = max(best, 1 - row[-1] / (len(s) + len(t)))
    return best


def brute(docs: list[tuple]) -> list[tuple]:
    order = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode("utf-8", "surrogatepass")
        a, b, c = fp.fingerprint(text.encode()), fp.fingerprint(edited), fp.fingerprint(following.encode())
        out.append((i, len(text), hashlib.sha256(edited).hexdigest(), a, b, brute_likeness(a, b), brute_likeness(a, c)))
    return out


@pytest.mark.parametrize("range_rows", [2, 7, 1000])
def test_against_brute_force(frame, range_rows):
    dice = random.Random(range_rows)
    docs = [(k * 3, "".join(dice.choice("abcdé ,€") for _ in range(dice.choice([0, 1, 5, 90, 3000])))) for k in range(40)]
    docs += [(None, "no id " * 30), (None, None), (6, "the same id"), (6, docs[2][1]), (500, docs[0][1])]
    got = [tuple(r) for r in fp.fingerprints(frame(docs, extra=True), range_rows).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:5])
    want = sorted(brute(docs), key=key)
    got = sorted(got, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:])


def test_small_edits_stay_near_and_other_texts_do_not():
    dice = random.Random(5)
    word = lambda: "".join(dice.choice("etaoinshrdlu") for _ in range(dice.randint(2, 9)))
    a = " ".join(word() for _ in range(900))
    b = a[:2000] + " a few more words " + a[2000:]
    c = " ".join(word() for _ in range(900))
    pa, pb, pc = (fp.fingerprint(x.encode()) for x in (a, b, c))
    assert fp.likeness(pa, pa) == 1.0
    assert fp.likeness(pa, pb) > 0.8
    assert fp.likeness(pa, pc) < 0.2
    assert fp.likeness(pa, fp.fingerprint((a * 20).encode())) == 0.0  # no block size in common


def test_empty_single_and_very_long(spark, frame, rows):
    assert fp.fingerprints(frame([])).collect() == []
    (one,) = rows(fp.fingerprints(frame([(1, None)])))
    assert (one["n_chars"], one["fingerprint"], one["near_edited"], one["near_next"]) == (0, "3::", 1.0, 1.0)
    long = "lorem ipsum dolor sit amet " * 100_000
    got = rows(fp.fingerprints(frame([(1, long), (2, "")])))
    assert got[0]["n_chars"] == len(long) and len(got[0]["fingerprint"]) < 150
