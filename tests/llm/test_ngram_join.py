import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from starloom.llm.graph import components
from starloom.llm.ngram_join import Threshold, divide_skip, ngram_join, without_similar

SCHEMA = "doc_id long, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def shingles(text, n=4):
    words = BLANK.findall((text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def brute_force(rows, percent=85):
    """Component ids of all rows, comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return Counter((i, len(s), least.get(top(k))) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def answers(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(text, rnd, times):
    words = text.split(" ")
    for _ in range(times):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def test_odd_rows(make, prose):
    long = prose(30_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "a"), (8, long)]
    rows += [(9, long + " tail"), (None, "a b"), (None, ""), (None, "only here"), (4, "other text of id four"), (8, long)]
    assert answers(ngram_join(make(rows, SCHEMA))) == brute_force(rows)
    assert ngram_join(make([], SCHEMA)).collect() == []


def test_near_copies_and_shared_passages(make, prose):
    rnd = random.Random(11)
    passage, rows = prose(60, rnd), []
    for size in (6, 25, 120, 400):
        for _ in range(4):
            first = prose(size, rnd)
            rows += [(len(rows) + k, first if k < 2 else edited(first, rnd, k * size // 60)) for k in range(9)]
    # Many that are mostly a common passage, and many with a common passage among other words.
    rows += [(1000 + k, edited(passage, rnd, k % 3)) for k in range(60)]
    rows += [(2000 + k, prose(rnd.randrange(20, 400), rnd) + " " + passage) for k in range(60)]
    rows += [(3000 + k, passage + " " + prose(rnd.randrange(1, 16), rnd)) for k in range(60)]
    rnd.shuffle(rows)
    df = make(rows, SCHEMA)
    assert answers(ngram_join(df)) == brute_force(rows)


def test_a_chain_of_edits_is_one_component(make, prose):
    rnd, rows, text = random.Random(4), [], None
    for k in range(60):
        text = edited(text, rnd, 1) if text else prose(80, rnd)
        rows.append((500 - k, text))
    got = ngram_join(make(rows, SCHEMA))
    assert answers(got) == brute_force(rows)
    assert {r.component_id for r in got.collect()} == {441}


def test_test_tables_against_pairs_that_share_a_rare_ngram(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert answers(ngram_join(docs)) == brute_force(rows)


@pytest.mark.parametrize("percent", [60, 85, 97])
def test_thresholds(percent):
    threshold = Threshold(percent)
    for a in range(1, 70):
        for b in range(a, 70):
            least = next(k for k in range(a + b + 1) if threshold.similar(k, a, b))
            assert threshold.shared(a, b) == least
            if least <= a:
                assert threshold.least(b) <= a
                assert 1 <= threshold.shared_held_least(a) <= max(1, threshold.shared_held(a, b))
                assert threshold.shared_held_least(b) <= max(1, threshold.shared_held(a, b))
                # The least T' between two sizes of partners is at one of the two.
                ends = range(max(threshold.least(a), a - 5), min(100 * a // percent, b) + 1)
                if len(ends):
                    every = [threshold.shared_held(a, x) for x in ends]
                    assert min(every) == min(every[0], every[-1]) or min(every) >= min(every[0], every[-1]) - 1


def test_divide_skip_counts_like_a_counter():
    rnd = random.Random(9)
    for _ in range(200):
        lists = [sorted(rnd.sample(range(40), rnd.choice([1, 1, 2, 5, 30]))) for _ in range(rnd.randrange(1, 25))]
        least = rnd.randrange(1, len(lists) + 1)
        counts = Counter(x for entries in lists for x in entries)
        found, shared = divide_skip([np.array(x) for x in lists], least, 40)
        assert dict(zip(found.tolist(), shared.tolist(), strict=True)) == {x: c for x, c in counts.items() if c >= least}


def test_divide_skip_counts_long_lists_without_the_heap():
    rnd = random.Random(10)
    for least in (3, 40, 70):
        lists = [sorted(rnd.sample(range(3000), rnd.choice([10, 300, 2500]))) for _ in range(80)]
        counts = Counter(x for entries in lists for x in entries)
        found, shared = divide_skip([np.array(x) for x in lists], least, 3000)
        assert dict(zip(found.tolist(), shared.tolist(), strict=True)) == {x: c for x, c in counts.items() if c >= least}


def test_links_are_counted_exactly_also_inside_of_components(make, prose):
    rnd = random.Random(4)
    first = prose(120, rnd)
    rows = [(n, edited(first, rnd, n % 4)) for n in range(40)] + [(100, first), (101, first), (200, prose(50, rnd)), (300, ""), (301, None)]
    got = {r.doc_id: r.n_links for r in ngram_join(make(rows, SCHEMA), count_links=True).collect()}
    sets = {shingles(t) for _, t in rows} - {frozenset()}
    for i, text in rows:
        own = shingles(text)
        assert got[i] == sum(100 * len(own & s) >= 85 * len(own | s) for s in sets if s != own and own)


def test_one_row_of_each_group_stays(make, prose):
    rnd = random.Random(2)
    first = prose(90, rnd)
    upper = first.translate(UPPER)
    rows = [(7, first), (3, upper), (3, upper), (9, edited(first, rnd, 1)), (1, "another text"), (1, "quite another")]
    rows += [(None, ""), (None, ""), (None, first), (20, None), (21, "x y"), (None, "x y")]
    df = make(rows, SCHEMA)
    left = without_similar(df)
    assert left.columns == df.columns
    want = Counter([(3, upper), (1, "another text"), (1, "quite another"), (None, ""), (None, ""), (20, None), (21, "x y")])
    assert Counter((r.doc_id, r.text) for r in left.collect()) == want


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(70)]
    links += [(2000, 2001 + k) for k in range(500)] + [(5, 5), (None, 3), (4, None)]
    near = defaultdict(set)
    for a, b in links:
        if a is not None and b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for start in sorted(near):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in want:
                want[node] = start
                stack.extend(near[node])
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_set_leaves_aside_and_stored_tables_are_released(spark):
    import os

    from starloom.llm.graph import _leaves, components
    from starloom.llm.tables import released, stored

    links = spark.createDataFrame([(1, 5), (5, 1), (1, 6), (2, 7), (7, 3), (8, 8), (None, 9), (20, 21), (21, 22)], "a long, b long")
    got = sorted(tuple(r) for r in components(links).collect())
    assert got == [(1, 1), (2, 2), (3, 2), (5, 1), (6, 1), (7, 2), (20, 20), (21, 20), (22, 20)]
    star = spark.createDataFrame([(n, 0) for n in range(1, 200)], "a long, b long")
    assert _leaves(star).count() == 199 and {r.component for r in components(star).collect()} == {0}
    table = stored(star)
    released(table)
    assert not os.path.exists(table.stored_at.removeprefix("file:"))


def test_a_block_gives_no_more_links_than_hold_its_sets_together():
    from starloom.llm.ngram_join import Roots

    roots = Roots()
    names = [bytes([n]) for n in range(20)]
    for a in names[:10]:
        for b in names[:10]:
            if a != b:
                roots.join(a, b)
    roots.join(names[19], names[15])
    left, right = roots.links()
    assert sorted(zip(left, right, strict=True)) == [*((x, names[0]) for x in names[1:10]), (names[19], names[15])]
