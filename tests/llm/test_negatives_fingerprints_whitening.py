import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives as mining
from starloom.llm.fingerprint import containment, fingerprints, merged, sketch
from starloom.llm.hard_negatives import Best, Block, hard_negatives, meet, shifted_label
from starloom.llm.whitening import components, polar, whiten

VECTORS = "vec_id long, embedding array<float>, label int"
CLASHING = ("id", "row", "rank", "number", "part", "text", "kept", "next_text", "_key", "_range", "a.b")


def vector_rows(n=900, width=64, seed=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((10, width))
    rows = []
    for k in range(n):
        v = centres[k % 10] * 0.1 + rnd.standard_normal(width) * 0.12
        rows.append((k, [float(np.float32(x)) for x in v], int(rnd.integers(10)) if k % 5 == 0 else k % 10))
    same = rows[50][1]
    rows += [(1000 + k, same, k % 4) for k in range(300)]  # a third of all are one vector
    return rows


def odd_vectors(width=64):
    good = [0.25] * width
    return [
        (None, good, 1), (2000, None, 1), (2050, good, None), (2100, [None] + good[1:], 1), (2150, [float("nan")] + good[1:], 2),
        (2200, [float("inf")] + good[1:], 2), (2250, [], 2), (2300, [1.0, -1.0], 2), (2301, [1.0, 2.0], 2), (2302, [0.5, 2.0], 3),
        (-50, good, 1), (-57, good, 9), (100, good, 1), (100, good, 1), (101, good, 1), (101, good, 1),
    ]


def mined(rows):
    """The contract by plain loops over all pairs; repeated anchors are asked once."""
    fine = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        fine.append((i, [math.floor(256 * x) for x in v], int(label)))
    out = Counter()
    for i, v, label in {(i, tuple(v), label) for i, v, label in fine if i % 50 == 0}:
        scored = [(-sum(map(int.__mul__, v, w)), j, other) for j, w, other in fine if j != i and len(w) == len(v)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            band = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            for rank, (s, k, _) in enumerate(band[:3], 1):
                out[(i, j, rank, k, -p, -s)] += 1
    return out


def mine(df, **options):
    got = hard_negatives(df, label=shifted_label(F.col("vec_id"), F.col("label")), **options)
    return Counter(tuple(r) for r in got.collect())


def test_hard_negatives_like_all_pairs(make, monkeypatch):
    monkeypatch.setattr(mining, "BLOCK", 100)
    monkeypatch.setattr(mining, "GROUP", 8)
    rows = vector_rows() + odd_vectors()
    assert mine(make(rows, VECTORS, CLASHING).repartition(5)) == mined(rows)


def test_hard_negatives_of_large_numbers_and_of_nothing(make):
    rnd = random.Random(4)
    rows = [(k, [rnd.choice([-1e6, 1e6, 3e5]) for _ in range(12)], k % 3) for k in range(0, 300, 5)]
    assert mine(make(rows, VECTORS)) == mined(rows)
    assert sum(mined(rows).values()) > 0
    for few in ([], rows[:1], [(0, None, 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]):
        assert mine(make(few, VECTORS)) == mined(few)


def test_bounds_leave_out_most_rows_and_lose_none(monkeypatch):
    rnd = np.random.default_rng(1)
    centres = rnd.standard_normal((20, 1, 8)) * 4  # smooth vectors, as segments suit them
    rows = np.floor(np.repeat(centres + 0.05 * rnd.standard_normal((20, 100, 8)), 8, axis=2).reshape(2000, 64) * 256)
    block = Block(np.arange(2000), np.arange(2000) % 2, rows)
    asked = Block(np.arange(5000, 5010), np.zeros(10, np.int64), rows[:2000:200])
    bests = [Best(5, [-(1 << 63)], [(1 << 63) - 1]) for _ in range(10)]
    scored = []
    monkeypatch.setattr(mining, "_exact", lambda rows, anchor, limit: scored.append(len(rows)) or (rows @ anchor).astype(np.int64))
    meet(asked, bests, block, same=False)
    for n, best in enumerate(bests):
        scores = (rows @ asked.rows[n]).astype(np.int64)
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i % 2)[:5]
        assert [(-s, i) for i, s in zip(best.ids[0].tolist(), best.scores[0].tolist(), strict=True)] == want
    assert sum(scored) < 10 * 2000 / 4


def kept_of(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = {" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    hashes = sorted(hashlib.md5(g.encode()).hexdigest() for g in grams)
    below = [h for h in hashes if h < "1"]
    return below if len(below) >= 16 else hashes[:16]


def reach_of(kept):
    return "g" if len(kept) < 16 else max(kept[15], "1") if len(kept) == 16 else "1"


def share_of(a, b):
    if a == b:
        return 1.0
    own = [h for h in a if h <= min(reach_of(a), reach_of(b))]
    return len(set(own) & set(b)) / len(own) if own else 0.0


def fingerprinted(rows):
    """The contract in plain Python; ``rows`` in the order in which they follow one another."""
    out = Counter()
    for n, (i, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = kept_of(text), kept_of(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out[(i, len(text), digest, ",".join(own), ",".join(changed), share_of(own, changed), share_of(own, kept_of(after)))] += 1
    return out


def test_fingerprints_like_plain_python(spark, make, prose):
    rnd = random.Random(2)
    texts = [prose(rnd.choice([1, 3, 4, 5, 9, 30, 300, 2000])) for _ in range(150)]
    texts += [None, "", "   ", "\t\n", "ä😀 ö 😀😀 é x y z ß", "one  two\tthree\nfour\x0bfive"]
    rows = [(rnd.randrange(-(10**12), 10**12), t) for t in texts + texts[:40]]
    rows += [(7, "same words over and over again here"), *[(k, "many copies of one text in a row here") for k in range(100, 200)]]
    want = fingerprinted(sorted(rows, key=lambda r: r[0]))
    got = fingerprints(make(rows, "doc_id long, text string", CLASHING[:3]).repartition(7))
    assert Counter(tuple(r) for r in got.collect()) == want
    for few in ([], rows[:1], [(None, None)], [(1, "")]):
        assert Counter(tuple(r) for r in fingerprints(make(few, "doc_id long, text string", CLASHING)).collect()) == fingerprinted(few)


def test_repeated_and_null_ids_follow_one_another_as_read(make):
    rows = [(None, "n1 n2 n3"), (None, "m"), *[(5, f"text {k} of five") for k in range(60)], (6, "end")]
    got = fingerprints(make(rows, "doc_id long, text string").coalesce(1)).collect()
    assert Counter(tuple(r) for r in got) == fingerprinted(rows)


def test_a_long_text_takes_time_in_proportion(make, prose):
    text = prose(400_000)  # about 4 MB
    rows = [(1, text), (2, "a b c"), (3, text)]
    got = fingerprints(make(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == fingerprinted(rows)


def test_merged_fingerprints_and_containment_of_unequal_texts(make, prose):
    long, short = prose(9000), prose(40)
    part = " ".join(long.split()[1000:2000])
    pairs = [(long, short), (short, ""), (long, part), (short, prose(12)), (long, prose(9000)), ("", "")]
    df = make([(n, a, b) for n, (a, b) in enumerate(pairs)], "n int, a string, b string").select("n", sketch(F.col("a")).alias("a"), sketch(F.col("b")).alias("b"))
    for r in df.select("n", "a", "b", merged(F.col("a"), F.col("b")).alias("both"), containment(F.col("b"), F.col("a")).alias("share")).collect():
        a, b = pairs[r.n]
        grams = [set(" ".join(t.split()[k : k + 5]) for k in range(max(len(t.split()) - 4, 1))) if t else set() for t in (a, b)]
        hashes = sorted(hashlib.md5(g.encode()).hexdigest() for g in grams[0] | grams[1])
        below = [h for h in hashes if h < "1"]
        assert r.both == (below if len(below) >= 16 else hashes[:16])
        if r.n == 2:
            assert r.share == 1.0
        if r.n == 4:
            assert r.share == 0.0


def test_polar_and_components_like_lapack():
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3, 10, 64, 100):
        a = rnd.standard_normal((n, n))
        v = a @ a.T
        u = polar(v - np.trace(v) / n * np.eye(n)) if n > 1 else np.eye(1)
        assert np.abs(u @ u - np.eye(n)).max() < 1e-12
        values, vectors = components(v)
        want = np.linalg.eigvalsh(v)[::-1]
        assert np.abs(values - want).max() <= 1e-13 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
        assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * want[0]
    for v in (np.zeros((4, 4)), np.eye(5), np.diag([1.0, 1, 1, 0, 0]), np.ones((6, 6)), np.diag([1e12, 1.0, 1e-6]), np.array([[0.0, 1], [1, 0]])):
        values, vectors = components(v)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1], rtol=1e-12, atol=1e-15 * np.abs(v).max())
        assert np.abs(vectors.T @ vectors - np.eye(len(v))).max() < 1e-12


def whitened_by_hand(rows):
    """(id, component) -> deviation, |whitened|, explained; from exact fractions and LAPACK."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    y = np.array([[n * a - s for a, s in zip(r, sums, strict=True)] for r in x], dtype=object)
    v = np.array([[float(Fraction(int(c), n**3)) for c in r] for r in y.T.dot(y)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    w = (y / n).astype(float) @ vectors / np.sqrt(values)
    return n, [int((r * r).sum()) for r in y], w, values / np.trace(v)


@pytest.mark.parametrize("width", [3, 40])
def test_whitening_like_lapack(make, width):
    rnd = np.random.default_rng(width)
    data = (rnd.standard_normal((700, width)) * np.geomspace(9, 0.5, width)).astype(np.float32)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(data)]
    rows += [(1000 + k, rows[5][1]) for k in range(300)] + [(None, rows[6][1])]
    odd = [(2000, None), (2001, [None] * width), (2002, [float("nan")] + rows[0][1][1:]), (2003, [float("-inf")] + rows[0][1][1:]), (2004, [])]
    df = make(rows + odd, "vec_id long, embedding array<float>", CLASHING).repartition(6)
    got = whiten(df).collect()
    n, deviations, w, explained = whitened_by_hand(rows)
    places = {i: k for k, (i, _) in enumerate(rows)}
    count = min(width, 32)
    assert len(got) == len(rows) * count and {r.n for r in got} == {n}
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter((i, d) for (i, _), d in zip(rows, deviations, strict=True))
    signs = {r.component: np.sign(r.whitened * w[0][r.component - 1]) for r in got if r.vec_id == 0}
    for r in got:
        assert abs(signs[r.component] * r.whitened - w[places[r.vec_id]][r.component - 1]) < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_whitening_of_few_equal_and_large_vectors(make):
    schema = "vec_id long, embedding array<double>"
    assert whiten(make([], schema, CLASHING)).collect() == []
    assert whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    flat = whiten(make([(k, [float(k), 2.0 * k, 5.0]) for k in range(4)], schema)).collect()  # a line: one component
    assert len(flat) == 4 and {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12
    mixed = whiten(make([(1, [1.0]), (2, [3.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])], schema)).collect()  # widths apart
    assert Counter((r.vec_id, r.n) for r in mixed) == Counter({(k, 2): 1 for k in (1, 2, 3, 4)})
    large = [(1, [1e17, -1e17]), (2, [-1e17, 3e16]), (3, [1e300, 5.0])]
    got = whiten(make(large, schema)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.deviation for r in got} == {(1 << 63) - 1}
    assert all(math.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-4
