import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm.decontaminate import align, contaminated, without_contaminated
from starloom.llm.secret_scan import KINDS, LINK_ENDPOINT, LINK_ID, LINK_SECRET, REACH, redact_secrets, scan_secrets

SCHEMA = "doc_id long, text string"
BITS = ["password", "PassWd=", "token", "SECRET", ":", "=", "  ", '"', "'", "api_key", "apikey = ", "abcd", "ABCDEFGH12", "AKIA"]
BITS += ["AKIAABCDEFGHIJKL", "0123456789abcdef", "f" * 32, "é", "\n", "user=bob1", "https://x.example.com/a", "pwd: abcd"]
BITS += ["z" * 150, "host=db.example.org", "aB3" + "x" * 37, " ", "ſecret=abcdefghi", "😀"]
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def all_spans(text):
    """The same by comparing each weak part with every other part."""
    base = base_spans(text)
    weak = [(m.start(), k, m.end()) for k, p in ((3, LINK_ID), (4, LINK_SECRET), (5, LINK_ENDPOINT)) for m in re.finditer(p, text, re.A)]

    def near(one, *ranks):
        ends = lambda s: {s[0], s[2] - 1}
        return any(abs(x - y) <= REACH for other in base + weak if other[1] in ranks for x in ends(one) for y in ends(other))

    kept = []
    for one in weak:
        identifier, secret = near(one, 1, 3), near(one, 0, 2, 4)
        if {3: secret, 4: identifier or near(one, 5), 5: identifier and secret}[one[1]]:
            kept.append(one)
    return sorted(set(base + kept))


def written(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def secret_rows():
    rnd = random.Random(3)
    rows = [(n, "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 25)))) for n in range(600)]
    rows += [(600, None), (601, ""), (602, "token=abcdefgh1 " * 1500), (603, "password:token:abcdefghijk"), (None, "secret=12345678")]
    return rows + rows[:20]


def test_scan_finds_what_brute_force_finds(make, secret_rows):
    got = scan_secrets(make(secret_rows, SCHEMA, ("spans", "_row", "_base", "text_hash")))
    want = Counter()
    for i, text in secret_rows:
        base, spans = base_spans(text or ""), written(all_spans(text or ""))
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        want[(i, *counts, hashlib.sha256(written(base).encode()).hexdigest(), spans)] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got.collect()) == want
    assert scan_secrets(make([], SCHEMA)).collect() == []


def test_masking_takes_just_the_spans(make, secret_rows):
    df = make(secret_rows, SCHEMA, ("spans", "_row", "_base"))
    got = redact_secrets(df)
    assert got.columns == df.columns
    want = Counter()
    for i, text in secret_rows:
        if text is not None:
            covered = [False] * len(text)
            for a, _, b in all_spans(text):
                covered[a:b] = [True] * (b - a)
            out = "".join(
                c if not hit else "[secret]" if k == 0 or not covered[k - 1] else "" for k, (c, hit) in enumerate(zip(text, covered))
            )
        want[(i, None if text is None else out)] += 1
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want


def test_texts_of_megabytes_take_time_in_proportion(make):
    rnd = random.Random(8)
    dense = "".join(rnd.choice(["password=abcdefgh1 ", "é😀 token: 'x1234567' ", "AKIAABCDEFGHIJKL.", "deadbeef" * 5 + "\n", "plain words "]) for _ in range(210_000))
    long = "a" * 4090 + " secret=" + "b" * 20_000 + "😀" * 5000 + " token=cccccccc" * 3
    rows = [(1, dense), (2, long), (3, "token=abcdefgh")]
    assert len(dense) > 3_500_000
    began = time.time()
    got = {r.doc_id: r for r in scan_secrets(make(rows, SCHEMA)).collect()}
    scanned = time.time()
    masked = {r.doc_id: r.text for r in redact_secrets(make(rows, SCHEMA)).collect()}
    assert scanned - began < 40 and time.time() - scanned < 40  # what grew with the square took minutes
    for i, text in rows:
        spans = base_spans(text)
        assert got[i].spans == written(spans) and got[i].n_assign == sum(k == 0 for _, k, _ in spans)
        out, at = [], 0
        for a, _, b in spans:
            if a > at or not out and a == 0:
                out += [text[at:a], "[secret]"]
            at = max(at, b)
        assert masked[i] == "".join(out) + text[at:]


def test_weak_parts_are_reported_only_together(make):
    secret = "aB3" + "x" * 37
    rows = [(1, secret), (2, f"login: bob {secret}"), (3, f"{secret} https://db.example.com"), (4, "https://db.example.com login: bob")]
    rows += [(5, f"{secret}{' ' * 300}login: bob"), (6, f"https://db.example.com user=bob {secret}")]
    linked = {r.doc_id: r.n_linked for r in scan_secrets(make(rows, SCHEMA)).collect()}
    assert linked == {1: 0, 2: 2, 3: 1, 4: 0, 5: 0, 6: 3}


def interval_spans(text):
    """As all_spans, by the distance of intervals: none for parts that lie in or over one another."""
    base = base_spans(text)
    weak = [(m.start(), k, m.end()) for k, p in ((3, LINK_ID), (4, LINK_SECRET), (5, LINK_ENDPOINT)) for m in re.finditer(p, text, re.A)]

    def near(one, *ranks):
        return any(o[1] in ranks and max(one[0] - (o[2] - 1), o[0] - (one[2] - 1), 0) <= REACH for o in base + weak)

    kept = []
    for one in weak:
        identifier, secret = near(one, 1, 3), near(one, 0, 2, 4)
        if {3: secret, 4: identifier or near(one, 5), 5: identifier and secret}[one[1]]:
            kept.append(one)
    return sorted(set(base + kept))


def test_parts_inside_long_parts_are_linked(make):
    url = "https://db.example.com/" + "u/" * 128 + "AKIAABCDEFGHIJKL" + "/v" * 119  # 533 long, the key at 279
    rows = [(0, f"{url} passphrase: abcdefg"), (1, f"token={'z' * 300}.user=bob1.{'y' * 300} https://db.example.com")]
    rnd = random.Random(9)
    long_bits = [*BITS, "z" * 500, "https://x.example.com/" + "q/" * 260, "token=" + "y" * 600, " " * 190, "/aB3" + "x" * 37 + "/", "0f" * 270]
    rows += [(n, "".join(rnd.choice(long_bits) for _ in range(rnd.randint(2, 20)))) for n in range(2, 400)]
    got = {r.doc_id: r.spans for r in scan_secrets(make(rows, SCHEMA, ("spans", "_row", "at", "last"))).collect()}
    assert got == {n: written(interval_spans(text)) for n, text in rows}
    assert "link_endpoint:0:533" in got[0] and sum(interval_spans(t) != all_spans(t) for _, t in rows) > 5


def smith_waterman(item, text):
    cells = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for a in range(1, len(item) + 1):
        for b in range(1, len(text) + 1):
            step = 2 if item[a - 1] == text[b - 1] else -1
            cells[a][b] = max(0, cells[a - 1][b - 1] + step, cells[a - 1][b] - 1, cells[a][b - 1] - 1)
    return max(map(max, cells))


def test_alignment_scores_like_the_full_table():
    rnd = random.Random(8)
    for _ in range(150):
        item, text = ([rnd.randrange(5) for _ in range(rnd.randrange(1, 15))] for _ in range(2))
        score, end = align(np.array(item), np.array(text))
        assert score == smith_waterman(item, text)
        assert score == 0 or smith_waterman(item, text[:end]) == score


BENCH = "item_id long, text string"


def leaks(prose):
    rnd = random.Random(6)
    items = [(k, prose(20 + k, rnd)) for k in range(12)]
    rows, want = [], set()
    for n in range(120):
        before, after = prose(rnd.randrange(0, 80), rnd), prose(rnd.randrange(0, 80), rnd)
        if n % 3:
            rows.append((n, f"{before} {after}"))
            continue
        number, text = rnd.choice(items)
        words = text.split(" ")
        for k in range(0, len(words), 7):
            words[k] = rnd.choice(["swapped", "", f"{words[k]} added", words[k].upper()])
        rows.append((n, f"{before} {' '.join(words)} {after}"))
        want.add((n, number))
    return items, rows, want


def test_edited_items_are_found_and_clean_texts_left(make, prose):
    items, rows, want = leaks(prose)
    odd_items = [(50, None), (51, ""), (52, "too few words"), (None, "an item without any number but with words enough to be found"), items[0]]
    odd = [(500, None), (501, ""), (None, items[3][1]), (0, rows[0][1]), (502, items[5][1] * 40 + " " + prose(5000))]
    odd += [(503, "see: An item without any number, but with words enough to be FOUND!")]
    docs = make(rows + odd, SCHEMA, ("item", "id", "text_hash", "score"))
    bench = make(items + odd_items, BENCH, ("id", "n"))
    got = contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 3), (502, 5), (503, None)}
    assert len(got) == len(want) + 3
    exact = next(r for r in got if r.doc_id is None)
    assert (exact.score, exact.first_word, exact.end_word) == (1.0, 0, len(re.findall(r"\w+", items[3][1])))
    left = without_contaminated(docs, bench)
    assert left.columns == docs.columns
    gone = {d for d, _ in want} | {502, 503}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows + odd if i is not None and i not in gone)


def test_a_single_copy_is_found_by_what_its_edit_has_left(make):
    words = [f"w{k}x" for k in range(18)]
    copy = ["new" if k in (3, 9, 15) else w for k, w in enumerate(words)]
    docs = make([(1, " ".join(copy)), (2, "other words that say nothing at all")], SCHEMA)
    got = contaminated(docs, make([(1, " ".join(words))], BENCH)).collect()
    assert [(r.doc_id, r.score, r.first_word, r.end_word) for r in got] == [(1, 27 / 36, 0, 18)]


def test_one_left_n_gram_is_enough_also_in_thousands_of_texts(make):
    words = [f"w{k}x" for k in range(10)]
    copy = " ".join(f"{w}" if k not in (3, 6, 9) else "new" for k, w in enumerate(words))
    rows = [(n, f"a{n} b{n} {copy} c{n}") for n in range(2500)] + [(5000 + n, f"a{n} w0x w1x w2x c{n}") for n in range(500)]
    got = contaminated(make(rows, SCHEMA), make([(1, " ".join(words))], BENCH)).collect()
    assert {r.doc_id for r in got} == set(range(2500)) and {r.score for r in got} == {12 / 20}


def test_texts_with_an_n_gram_of_an_item_are_judged_like_the_full_table(make):
    rnd = random.Random(12)
    vocabulary = [f"v{k}" for k in range(60)]
    items = [(k, [rnd.choice(vocabulary) for _ in range(rnd.randrange(12, 24))]) for k in range(12)]
    rows = []
    for n in range(48):
        copy = list(items[n % 12][1])
        for k in rnd.sample(range(len(copy)), round(len(copy) * rnd.choice([0.15, 0.2, 0.25]))):
            copy[k] = f"new{k}"
        if n % 4 == 0:  # words put in at one place
            copy[9:9] = [f"put{k}" for k in range(rnd.randrange(10, 16))]
        rows.append((n, [rnd.choice(vocabulary) for _ in range(8)] + copy + [f"end{n}"] * 3))
    want = {}
    for d, text in rows:
        grams = {tuple(text[k : k + 3]) for k in range(len(text))}
        for i, item in items:
            score = smith_waterman(item, text) / (2 * len(item))
            if score >= 0.42 and any(tuple(item[k : k + 3]) in grams for k in range(len(item) - 2)):
                want[d, i] = score
    got = contaminated(make([(d, " ".join(t)) for d, t in rows], SCHEMA), make([(i, " ".join(t)) for i, t in items], BENCH))
    assert {(r.doc_id, r.item_id): r.score for r in got.collect()} == want and len(want) > 40


def test_no_items_or_no_texts(make, prose):
    docs, none = make([(1, "some text")], SCHEMA), make([], BENCH)
    assert contaminated(docs, none).collect() == []
    assert without_contaminated(docs, none).count() == 1
    assert contaminated(make([], SCHEMA), make([(1, prose(30))], BENCH)).collect() == []


def test_an_item_in_very_many_texts_is_found_in_all(make, prose):
    item = prose(25)
    rows = [(n, f"{prose(10)} {item} {prose(10)}") for n in range(400)] + [(1000 + n, prose(40)) for n in range(400)]
    got = contaminated(make(rows, SCHEMA), make([(1, item)], BENCH)).collect()
    assert {r.doc_id for r in got} == set(range(400))


def test_short_items_are_found_where_they_stand_whole(make, prose):
    items = [(1, "Alpha beta gamma delta epsilon"), (2, "one"), (3, "one TWO"), (4, "alpha beta gamma delta epsilon"), (5, ""), (6, None), (7, "?!")]
    rows = [(1, "x alpha, beta gamma. delta EPSILON y alpha beta gamma delta epsilon"), (2, "alpha beta gamma other delta epsilon"), (3, "one"), (4, "on e two one two"), (5, None), (6, prose(50))]
    got = {(r.doc_id, r.item_id, r.score, r.first_word, r.end_word) for r in contaminated(make(rows, SCHEMA), make(items, BENCH)).collect()}
    assert got == {(1, 1, 1.0, 1, 6), (1, 4, 1.0, 1, 6), (3, 2, 1.0, 0, 1), (4, 2, 1.0, 3, 4), (4, 3, 1.0, 3, 5)}


def test_the_rarest_seed_decides_and_common_ones_find_the_rest(make, prose, monkeypatch):
    import starloom.llm.decontaminate as module

    common = prose(9)  # the beginning of both items, and of very many texts
    items = [(1, f"{common} {prose(12)}"), (2, f"{common} {prose(12)}")]
    half = " ".join(items[1][1].split()[:11])  # more than 0.42 of item 2, rare n-grams gone
    rows = [(n, f"{common} {prose(40)}") for n in range(200)] + [(1000, f"{prose(30)} {items[0][1]} {prose(30)}"), (1001, f"{prose(9)} {half} {prose(9)}")]
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(make(rows, SCHEMA), make(items, BENCH)).collect()}
    assert got[(1000, 1)] == 1.0 and (1001, 2) in got
    source = module._source(make(rows, SCHEMA), "doc_id", "text")
    block = module._Block([{"item": i, "text": t} for i, t in items], 3, 0.42)
    frequency = module._frequencies(source, block.grams, 3)
    texts = [list(module.ngram_hashes(w, 3)) for w in module.word_rows(pa.array([t for _, t in rows], pa.string()))]
    assert frequency.tolist() == [sum(int(g) in set(map(int, t)) for t in texts) for g in block.grams.tolist()]
    assert frequency.min() == 0 and frequency.max() == 202
