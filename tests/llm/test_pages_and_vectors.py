import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm.queries import URL_RULES
from starloom.llm.topk import top_k
from starloom.llm.url_filter import judge_urls
from starloom.llm.warc import LoserTree, archive_round_trip, members, packed, parsed, record, url_key
from starloom.session import scratch_dir

PAGES = "page_id long, url string, html string"


def page_rows():
    rnd = random.Random(7)
    bodies = [f"<p>{k} é\r\n\r\nWARC/1.1\r\n" + "x" * rnd.choice([3, 900, 990, 1500, 70_000]) for k in range(25)]
    rows = [(n, f"http://{rnd.choice('abc')}.Example.com/{n % 7}?q={n % 3}", rnd.choice(bodies)) for n in range(400)]
    rows += [(900 + n, "http://hot.example.com/", "same " * 400) for n in range(300)]
    rows += [(None, "http://x/", bodies[0] * 2), (None, None, bodies[0] * 2), (None, "http://x/", "same " * 400), (1199, "u", "same " * 400)]
    return rows + [(5000, None, None), (5001, "", ""), (5002, "no scheme\r\nX: y", "é" * 600), (5003, "http://é.example/ü", "é" * 600), (7, "again", "b" * 2000)]


def test_archives_round_trip(spark, make):
    rows = page_rows()
    pages = make(rows, PAGES, ("file", "part", "seconds", "digest")).repartition(6)
    path = f"{scratch_dir(spark)}/warc"
    got = archive_round_trip(pages, path, seconds=F.col("page_id") % 50, file_bytes=20_000).collect()
    largest = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000 and i is not None:
            largest[html] = max(i, largest.get(html, i))
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        first = largest.get(html)
        again = first is not None and i != first
        kind = "revisit" if again else "response"
        want[(i, len(body), hashlib.sha1(body).hexdigest(), kind, first if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    ordered = sorted(got, key=lambda r: (r.part, r.place))
    keys = [(r.url_key, r.seconds, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert len({r.file for r in got}) > 6
    empty = archive_round_trip(make([], PAGES), f"{scratch_dir(spark)}/none")
    assert empty.collect() == []


def test_a_record_is_read_by_its_offset_alone(spark, make):
    path = f"{scratch_dir(spark)}/warc"
    got = archive_round_trip(make([(n, f"http://h/{n}", f"body {n}") for n in range(9)], PAGES).coalesce(1), path).collect()
    content = bytes(spark.read.format("binaryFile").load(path + "/part-*").first()["content"])
    for row in got:
        part = content[row.record_offset : row.record_offset + row.record_length]
        ((_, _, data),) = members(part)
        assert parsed(data)[1].endswith(f"\r\n\r\nbody {row.page_id}".encode())
    with pytest.raises(ValueError):
        list(members(packed(record("x", {}, b"y"))[:-3]))


def test_url_keys():
    assert url_key("https://user@WWW.Example.com/A/b?C#d") == "com,example,www)/a/b?c"
    assert url_key("http://h") == "h)/" and url_key("http://h?x") == "h)?x" and url_key("") == ")/"


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges_like_sorted(count):
    rnd = random.Random(count)
    runs = [sorted((rnd.randrange(20),) for _ in range(rnd.randrange(0, 30))) for _ in range(count)]
    assert [runs[r][p] for r, p in LoserTree(runs)] == sorted(x for run in runs for x in run)


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    path = rest[cut:]
    path = path[: min((k for k in map(path.find, "?#") if k >= 0), default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


def judged(host, path):
    fits = [r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def test_urls(make):
    rnd = random.Random(5)
    hosts = ["example.com", "www.example.com", "WWW.EXAMPLE.com", "notexample.com", "com", "a.net", "É.org", "spam.org", "mail.spam.org", "x.org", ""]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/", "/buy/now", "?u=http://b.com/en/", "#f", "/en/x?y#z", "/a://b"]
    urls = [f"{rnd.choice(['http', 'https'])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(6000)]
    rows = [(n, u) for n, u in enumerate(urls)] + [(None, "http://a.net/es/"), (9000, None), (9001, ""), (9002, "a b"), (3, "http://x.org/again")]
    rows += [(9003, "http://long.org/" + "/".join(f"p{k}x" for k in range(3000))), (9004, "http://x\n.org/\n/en/")]
    bad = lambda u: "spam.org" in u and "/buy" in u
    labels = [(n, 0 if bad(u) else 1) for n, u in enumerate(urls) if n % 3] + [(1, None), (None, 0), (2, 1), (2, 1)]
    got = judge_urls(
        make(rows, "page_id long, url string", ("rule", "tokens", "id")), make(labels, "doc_id long, quality int", ("bad",)), URL_RULES, min_support=0.005
    ).collect()
    assert Counter((r.page_id, r.host, r.path) for r in got) == Counter((i, *parts_of(u)) for i, u in rows)
    for r in got:
        rule, verdict = judged(r.host, r.path)
        assert r.rule == rule and verdict in (None, r.verdict)
        if rule is None:
            assert r.verdict == ("block" if r.mined_confidence is not None else "allow")
            assert (r.verdict == "block") == ("spam.org" in r.host and r.path.startswith("/buy"))
    assert any(r.rule is None and r.verdict == "block" for r in got)


def surest(rows, labelled, min_support, min_confidence):
    """The surest rule's confidence for each token set, by trying all sets of tokens."""
    names = sorted(set().union(*rows))
    bits = [sum(1 << names.index(t) for t in r) for r in rows]
    sure = {}
    for x in range(1, 1 << len(names)):
        fits = [bad for b, bad in zip(bits, labelled) if bad is not None and b & x == x]
        if sum(fits) >= max(1, min_support * sum(bad is not None for bad in labelled)) and sum(fits) / len(fits) >= min_confidence:
            sure[x] = sum(fits) / len(fits)
    return [max((c for x, c in sure.items() if b & x == x), default=None) for b in bits]


@pytest.mark.parametrize("seed, count", [(1, 60), (2, 300)])
def test_mined_rules_are_those_of_all_token_sets(make, seed, count):
    rnd = random.Random(seed)
    rows, labelled = [], []
    for n in range(count):
        keys = {f"q:k{k}" for k in range(6) if rnd.random() < 0.4}
        if n % 7 < 3:
            keys |= {"q:one", "q:two"} if n < count * 0.8 else {rnd.choice(["q:one", "q:two"])}  # as one in labelled rows
        bad = rnd.random() < (0.8 if {"q:k1", "q:k2"} <= keys else 0.2) or "q:k3" in keys and "q:one" in keys
        rows.append(keys | {"h:org"})
        labelled.append(int(bad) if n < count * 0.8 else None)
    urls = [(n, "x://org?" + "&".join(sorted(t[2:] for t in r if t != "h:org"))) for n, r in enumerate(rows)]
    labels = [(n, 1 - bad) for n, bad in enumerate(labelled) if bad is not None]
    got = judge_urls(make(urls, "page_id long, url string"), make(labels, "doc_id long, quality int"), [], min_support=0.05, min_confidence=0.6).collect()
    want = surest(rows, labelled, 0.05, 0.6)
    assert {r.page_id: r.mined_confidence for r in got} == dict(enumerate(want)) and len(set(want)) > 5


@pytest.mark.parametrize("mixed", [True, False])
def test_rules_over_the_rarer_tokens_of_long_urls(make, mixed):
    rnd = random.Random(4)
    rows, labels = [], []
    for n in range(2000):
        tracks = rnd.sample(range(120), 36) if mixed else range(40) if n % 4 else []
        keys = [f"track{k}" for k in tracks] + ["ra"] * (n % 10 == 1) + ["rb"] * (n % 6 == 1)
        rows.append((n, f"https://shop.org/?{'&'.join(f'{k}x=1' for k in keys)}"))
        if n % 3 != 2:
            labels.append((n, 0 if n % 30 == 1 else 1))
    got = judge_urls(make(rows, "page_id long, url string"), make(labels, "doc_id long, quality int"), [], min_support=0.02, min_confidence=0.9).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == {n for n in range(2000) if n % 30 == 1}
    assert {r.mined_confidence for r in got} == {None, 1.0}


def test_urls_without_labels_or_pages(make):
    none = make([], "doc_id long, quality int")
    got = judge_urls(make([(1, "http://a.org/x")], "page_id long, url string"), none, URL_RULES).collect()
    assert [(r.verdict, r.rule) for r in got] == [("allow", None)]
    assert judge_urls(make([], "page_id long, url string"), none, URL_RULES).collect() == []


VECTORS = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("levels", [(2,), (2, 5), (4, 16)])
def test_top_k(make, levels):
    random_ = np.random.default_rng(3)
    rows = [(n, random_.normal(size=24).round(2).tolist()) for n in range(900)]
    rows += [(2000 + n, rows[100][1]) for n in range(200)]  # ties
    rows += [(5000, [0.0] * 24), (5100, [1e9] * 24), (5101, [-3e8] * 24), (5200, [0.5]), (5201, [0.25]), (5300, []), (100, rows[5][1])]
    odd = [(6000, None), (6100, [None] * 24), (6200, [float("nan")] * 24), (6300, [float("inf")] + [0.0] * 23), (None, [1.0] * 24)]
    got = top_k(make(rows + odd, VECTORS, ("ids", "width", "score")), k=7, levels=levels, candidate_block=128).collect()
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = {}
    for q in {i for i, _ in rows if i % 100 == 0}:
        scores = []
        for _, v in {(i, tuple(v)) for i, v in whole if i == q}:
            every = [(-sum(a * b for a, b in zip(v, u)), i) for i, u in whole if i != q and len(u) == len(v)]
            scores += sorted(every)[:7]
        want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:7])]
    found = {}
    for r in sorted(got, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert found == {q: x for q, x in want.items() if x}
    assert top_k(make([], VECTORS)).collect() == []
