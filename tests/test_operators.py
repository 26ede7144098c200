"""Operators against brute force on small skewed data, and the plans Spark makes of them."""

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from conftest import SF_DIR
from starloom import operators as ops
from starloom.operators import audit
from starloom.operators.joins import PARTS, _hot_grid
from starloom.operators.layout import sorted_within, to_buckets
from starloom.session import (
    fits_broadcast,
    plan_bytes,
    row_bytes,
    scratch_dir,
    scratch_root,
    through_table,
)
from starloom.sources import read_log, typed_log


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, rows, schema, partitions=6):
    """Rows in a Parquet table of several files, as a scan gives them."""
    return through_table(spark.createDataFrame(rows, schema).repartition(partitions))


EVENT = "user_id int, ts timestamp_ntz, first_name string, last_name string, gender string, level string"


@pytest.fixture(scope="module")
def skewed_events(spark):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        # A third is one user, half of it tied copies at that user's last time.
        user = 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)])
        ts = start + timedelta(days=30) if i % 6 == 0 else start + timedelta(hours=rng.randrange(48))
        if rng.random() < 0.05:
            ts = None
        rows.append((user, ts, f"F{user}", rng.choice(["L", None]), "F", rng.choice(["free", "paid"])))
    return rows, frame(spark, rows, EVENT)


def brute_latest(rows):
    peak = {}
    for user, ts, *_ in rows:
        if user is not None and ts is not None:
            peak[user] = max(ts, peak.get(user, ts))
    return Counter((u, *rest) for u, ts, *rest in rows if u in peak and ts == peak[u])


FIELDS = ["first_name", "last_name", "gender", "level"]


def test_latest_rows(skewed_events):
    rows, events = skewed_events
    expected = brute_latest(rows)
    assert max(expected.values()) > 100
    for limit in (None, 0, 10**9):
        assert bag(ops.latest_rows(events, "user_id", "ts", FIELDS, limit)) == expected
    assert bag(ops.latest_rows_by_join(events, "user_id", "ts", FIELDS)) == expected


def test_latest_rows_of_scattered_keys(spark):
    """Keys that hardly recur within a split go to the join as they are."""
    start = datetime(2024, 1, 1)
    rows = [(n % 500, start + timedelta(days=n % 7), f"F{n % 3}", "", "", "") for n in range(2000)]
    events = frame(spark, rows, EVENT, partitions=8)
    latest = ops.latest_rows(events, "user_id", "ts", FIELDS, 0)
    assert "WindowGroupLimit" not in plan(latest)
    assert bag(latest) == brute_latest(rows)


def test_latest_rows_stay_in_place_with_few_keys(spark, skewed_events):
    events = skewed_events[1]
    text = plan(ops.latest_rows(events, "user_id", "ts", FIELDS))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    text = plan(ops.latest_rows(events, "user_id", "ts", FIELDS, 100))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_latest_rows_limits_each_split_before_the_shuffle(skewed_events):
    text = plan(ops.latest_rows(skewed_events[1], "user_id", "ts", FIELDS, 0))
    below = text[re.search(r"Exchange hashpartitioning\(user_id#\d+, _split#\d+", text).end() :]
    assert re.match(r".*\n.*WindowGroupLimit .*Partial", below)


def test_latest_one(skewed_events):
    rows, events = skewed_events
    got = bag(ops.latest_one(events, "user_id", "ts", FIELDS))
    assert set(got.values()) == {1}
    assert {r[0] for r in got} == {r[0] for r in brute_latest(rows)}
    assert not set(got) - set(brute_latest(rows))
    text = plan(ops.latest_one(events, "user_id", "ts", FIELDS))
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning") :]


def test_max_per_key_keeps_the_null_group(spark):
    start = datetime(2024, 1, 1)
    rows = [(None, start, "", "", "", ""), (1, None, "", "", "", ""), (1, start, "", "", "", "")]
    assert bag(ops.max_per_key(frame(spark, rows, EVENT), "user_id", "ts")) == Counter(
        [(None, start), (1, start)]
    )


def brute_left(left, right):
    partners = defaultdict(list)
    for artist, title, song in right:
        if artist is not None and title is not None:
            partners[artist, title].append(song)
    return Counter(
        (n, artist, song, found)
        for n, artist, song in left
        for found in (partners.get((artist, song)) or [None])
    )


# Which side the hot key is hot on.
@pytest.mark.parametrize("hot", ["left", "right", "both", "none"])
@pytest.mark.parametrize("limits", [{"max_groups": 20, "min_rows": 5}, {"max_groups": 1000, "min_rows": 1}, {}])
def test_left_match_shuffled(spark, hot, limits):
    rng = random.Random(hot)

    def key():
        return rng.choice([None, *"abcdefgh"]), rng.choice([None, *"uvwxyz"])

    left = [
        (n % 50, *(("a", "hit") if hot in ("left", "both") and n % 3 == 0 else key())) for n in range(900)
    ]
    right = [
        (*(("a", "hit") if hot in ("right", "both") and n % 3 == 0 else key()), f"S{n % 40}")
        for n in range(150)
    ]
    if hot == "right":
        left += [(n, "a", "hit") for n in range(4)]
    plays = frame(spark, left, "n int, artist string, song string")
    catalogue = frame(spark, right, "artist_name string, title string, song_id string")
    on = [("artist", "artist_name"), ("song", "title")]
    expected = brute_left(left, right)
    shuffled = ops.left_match(plays, catalogue, on, ["song_id"], max_broadcast_bytes=0, **limits)
    assert bag(shuffled) == expected
    assert bag(ops.left_match(plays, catalogue, on, ["song_id"])) == expected


def test_left_match_with_empty_sides(spark):
    schema = "artist_name string, title string, song_id string"
    nothing = spark.createDataFrame([], schema)
    plays = frame(spark, [(1, "a", "u"), (2, None, "u")], "n int, artist string, song string")
    on = [("artist", "artist_name"), ("song", "title")]
    for limit in (0, None):
        matched = ops.left_match(plays, nothing, on, ["song_id"], max_broadcast_bytes=limit)
        assert bag(matched) == Counter([(1, "a", "u", None), (2, None, "u", None)])
        empty = ops.left_match(plays.where("n > 5"), nothing, on, ["song_id"], max_broadcast_bytes=limit)
        assert bag(empty) == Counter()


def test_left_match_broadcasts_by_size_only(spark):
    plays = frame(spark, [(1, "a", "u")], "n int, artist string, song string")
    catalogue = frame(spark, [("a", "u", "S")], "artist_name string, title string, song_id string")
    on = [("artist", "artist_name"), ("song", "title")]
    small = plan(ops.left_match(plays, catalogue, on, ["song_id"]))
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        assert "SortMergeJoin" in plan(ops.left_match(plays, catalogue, on, ["song_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_measured_not_their_files(spark):
    """A catalogue of copies compresses to next to nothing, and is still not broadcast."""
    copies = through_table(spark.range(200000, numPartitions=1).selectExpr("'a' k", "repeat('x', 50) t"))
    size = 200000 * (8 * 5 + 51)
    assert row_bytes(copies) == size
    assert plan_bytes(copies) < size / 10
    assert not fits_broadcast(copies, size - 1) and fits_broadcast(copies, size)
    plays = frame(spark, [("a",), ("b",), (None,)], "j string")
    matched = ops.left_match(plays, copies, [("j", "k")], ["t"], max_broadcast_bytes=size // 2)
    assert "SortMergeJoin" in plan(matched) and matched.count() == 200002


def test_hot_keys_are_few_and_dealt_out(spark):
    left = frame(spark, [("hit" if n % 3 == 0 else f"k{n}",) for n in range(3000)], "k string")
    right = frame(spark, [("hit",)] + [(f"k{n}",) for n in range(100)], "j string")
    grid = _hot_grid(left, right, [("k", "j")], max_groups=30, min_rows=1)
    # The right side's shares are of 101 rows: ceil(101 / 30) = 4, so nothing is hot there.
    assert bag(grid) == Counter([("hit", 10, 1)])
    dealt, copied = ops.salt_pair(left, right, [("k", "j")], max_groups=30, min_rows=1)
    cells = bag(dealt.where("k = 'hit'").groupBy("_left_part").count())
    assert len(cells) == 10 and max(n for _, n in cells) < 200
    assert copied.where("j = 'hit'").count() == 10
    assert copied.where("j <> 'hit'").count() == 100


def test_without_hot_keys_the_join_is_plain(spark):
    left = frame(spark, [(f"k{n}",) for n in range(300)], "k string")
    right = frame(spark, [(f"k{n}", n) for n in range(200)], "j string, n int")
    text = plan(ops.left_match(left, right, [("k", "j")], ["n"], max_broadcast_bytes=0))
    assert "Generate" not in text and "monotonically" not in text
    # With keys hot on the left only, no left row is copied.
    hot = frame(spark, [("hit" if n % 3 == 0 else f"k{n}",) for n in range(300)], "k string")
    dealt, copied = ops.salt_pair(hot, right, [("k", "j")], max_groups=30, min_rows=1)
    assert "Generate" not in plan(dealt) and "Generate" in plan(copied)


def test_ids(spark):
    data = frame(spark, [(n,) for n in range(1000)], "n int")
    ids = [r[0] for r in ops.with_id(data, "id", 50).select("id").collect()]
    assert len(set(ids)) == 1000 and min(ids) == 50
    dense = ops.with_dense_id(data, "id", 7)
    assert dense.columns == ["id", "n"]
    got = dense.collect()
    assert sorted(r.id for r in got) == list(range(7, 1007))
    assert sorted(r.n for r in got) == list(range(1000))
    assert ops.next_id(dense, "id") == 1007
    assert ops.next_id(dense.where("false"), "id") == 0
    nothing = ops.with_dense_id(data.where("n < 0"), "id", 7)
    assert nothing.count() == 0


def test_keep_filter_reaches_the_scan(spark):
    pages = frame(spark, [("NextSong", 1), ("Home", 2), (None, 3)], "page string, n int")
    kept = ops.drop_where_not_equal(pages, "page", "NextSong")
    assert bag(kept.select("n")) == Counter([(1,), (3,)])
    assert "Or(IsNull(page),EqualTo(page,NextSong))" in plan(kept)


def test_staging_is_one_pass_over_the_log(spark, log_dir):
    text = plan(typed_log(read_log(spark, log_dir, page="NextSong"), strict=True))
    assert "Exchange" not in text and text.count("FileScan") == 1
    # Top down: the full parse of what is left, the filter on one key, the records' texts.
    filters = [n for n, line in enumerate(text.splitlines()) if "Filter" in line and "from_json(StructField(page," in line]
    full = [n for n, line in enumerate(text.splitlines()) if "from_json(StructField(artist," in line]
    generate = [n for n, line in enumerate(text.splitlines()) if "Generate" in line]
    assert full and filters and generate and max(full) < min(filters) and min(filters) < generate[0], text
    assert not any("Filter" in line and "from_json(StructField(artist," in line for line in text.splitlines())


def test_values_are_parsed_and_converted_once(spark, log_dir):
    text = plan(typed_log(read_log(spark, log_dir, page="NextSong"), strict=True))
    kept = next(line for line in text.splitlines() if "Filter" in line)
    assert kept.count("from_json(StructField(page,") == 1, kept
    assert len(re.findall(r"try_cast\(record#\d+\.itemInSession as int\)", text)) == 1, text


def test_bucketed_tables_join_in_place(spark):
    text = plan(registry.bucketed_join(spark, SF_DIR))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_hot_bucket_is_written_by_several_tasks(spark):
    rows = [("hit" if n % 3 == 0 else f"k{n}", f"{n:040d}") for n in range(60000)]
    data = frame(spark, rows, "k string, text string")
    target = f"{scratch_dir(spark)}/bucketed"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        gathered = to_buckets(data, ["k"], 4)
        gathered.write.bucketBy(4, "k").option("path", target).saveAsTable("shared_buckets")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.table("shared_buckets").select("k", "text", F.input_file_name().alias("file"))
    files = {r.file for r in stored.select("file").distinct().collect()}
    per_bucket = Counter(re.search(r"_(\d{5})\.", f).group(1) for f in files)
    assert set(per_bucket) == {"00000", "00001", "00002", "00003"}
    hot = stored.where("k = 'hit'").groupBy("file").count().collect()
    assert len(hot) > 2 and max(r["count"] for r in hot) < 20000
    assert bag(stored.select("k", "text")) == Counter(rows)


def test_range_clustered_splits_a_hot_value(spark):
    rows = [(500 if n % 3 == 0 else n,) for n in range(3000)]
    data = frame(spark, rows, "t int")
    target = f"{scratch_dir(spark)}/ranges"
    ops.range_clustered(data, "t", 6).write.parquet(target)
    stored = spark.read.parquet(target)
    assert bag(stored) == Counter(rows)
    by_file = stored.groupBy(F.input_file_name()).agg(F.min("t"), F.max("t"), F.count("t")).collect()
    ranges = sorted((low, high) for _, low, high, _ in by_file)
    assert all(left[1] <= right[0] for left, right in zip(ranges, ranges[1:]))
    assert max(n for *_, n in by_file) < 1000


def test_sorted_within_does_not_shuffle(spark):
    assert "Exchange" not in plan(sorted_within(frame(spark, [(1,)], "t int"), "t"))


def test_replicated_checks_the_size(spark):
    data = frame(spark, [(1,)], "t int")
    assert "broadcast" in ops.replicated(data)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in ops.replicated(data, 1)._jdf.queryExecution().logical().toString()


def test_orphans_are_what_the_dimension_lacks(spark):
    fact = frame(spark, [("a",)] * 50 + [("b",)] * 3 + [(None,)] * 9, "k string")
    dimension = frame(spark, [("b",), ("b",), (None,)], "id string")
    assert bag(audit.orphans(fact, "k", dimension, "id")) == Counter([("a", 50)])
    assert bag(audit.orphans(fact, "k", dimension.where("false"), "id")) == Counter([("a", 50), ("b", 3)])
    assert audit.orphans(fact.where("false"), "k", dimension, "id").collect() == []


@pytest.mark.parametrize("limit", ["10MB", "100KB", "-1"])
def test_orphans_of_whole_numbers(spark, limit):
    more_ids, more_used = [-(1 << 63), (1 << 63) - 1], [1, 1, 1, -(1 << 63), (1 << 63) - 1, (1 << 63) - 2]
    ids = {*range(-40_000, 100_000, 2), *more_ids}
    used = [*range(-45_000, 105_000, 5), *more_used]
    few_ids = spark.createDataFrame([(n,) for n in more_ids + [None]], "id long")
    few_used = spark.createDataFrame([(n,) for n in more_used + [None, None]], "k long")
    root, even = scratch_dir(spark), spark.range(-40_000, 100_000, 2)
    even.unionAll(even).unionAll(few_ids).write.parquet(f"{root}/ids")
    spark.range(-45_000, 105_000, 5).toDF("k").unionAll(few_used).write.parquet(f"{root}/used")
    dimension, fact = spark.read.parquet(f"{root}/ids"), spark.read.parquet(f"{root}/used")
    want = Counter(Counter(n for n in used if n not in ids).items())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = audit.orphans(fact, "k", dimension, "id")
        assert bag(found) == want
        text = plan(found)
        assert ("_marks" in text) == (limit == "100KB")
        # Rows of the fact are dropped by the copied table before their first shuffle.
        assert ("BroadcastHashJoin" in text) == (limit != "-1")
        if limit != "-1":
            assert text.index(" Exchange ") < text.index("BroadcastHashJoin") < text.rindex("/used")
            assert " Exchange " not in text[text.index("BroadcastHashJoin") : text.index("/used")]
        narrow = frame(spark, [(1,), (2,), (None,)], "k int")
        assert bag(audit.orphans(narrow, "k", dimension, "id")) == Counter([(1, 1)])
        far = dimension.where("id % 100 = 0").select((F.col("id").cast("decimal(38)") / 100 * 33_000).cast("long").alias("id"))
        assert bag(audit.orphans(narrow, "k", far, "id")) == Counter([(1, 1), (2, 1)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_row_checks(spark):
    data = frame(spark, [("é" * 2, 1), ("ab", None), (None, 3)], "t string, n int")
    assert bag(audit.too_long(data, {"t": 3}).select("n")) == Counter([(1,)])
    assert bag(audit.missing(data, ["t", "n"])) == Counter([("ab", None), (None, 3)])


def test_scratch_is_below_the_configured_folder(spark, tmp_path):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir", scratch_root(spark))
    assert scratch_dir(spark).startswith(scratch_root(spark))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    def session(master):
        return SimpleNamespace(
            conf=Conf(), sparkContext=SimpleNamespace(master=master, applicationId="app-test")
        )

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn"))
    assert scratch_root(session("local[2]")) == scratch_root(session("local[2]"))


def test_only_used_columns_are_read(spark):
    text = plan(registry.time_dim(spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz>", text)
    assert "Exchange" not in text


def test_types_without_a_rule_are_refused():
    from starloom.functions import coerce_to

    with pytest.raises(TypeError):
        coerce_to(F.lit("1"), T.BooleanType())


def test_no_row_is_dealt_by_its_place_behind_a_shuffle(spark):
    shuffled = frame(spark, [("hit",)] * 900 + [(f"k{n}",) for n in range(90)], "k string").repartition(5)
    right = frame(spark, [("hit",)], "j string")
    dealt, _ = ops.salt_pair(shuffled, right, [("k", "j")], max_groups=30, min_rows=1)
    for df in (dealt, ops.range_clustered(shuffled, "k", 4)):
        text = plan(df)
        assert "monotonically" in text
        assert "Exchange" not in text[text.index("monotonically") :].replace("BroadcastExchange", "")
    assert dealt.count() == 990


def test_duplicates_of_dense_ids_are_found_by_bitmaps(spark):
    ids = [*range(-5000, 60_000), *range(1 << 34, (1 << 34) + 40_000)]
    twice = [-5000, 7, 7, 7, 32_768, (1 << 34) + 39_999, 59_999]
    data = frame(spark, [(n,) for n in ids + twice + [None, None]], "id long").repartition(7)
    counts = Counter(twice)
    want = Counter([(k, n + 1) for k, n in counts.items()] + [(None, 2)])
    found = audit.duplicate_keys(data, ["id"])
    assert bag(found) == want and "LeftSemi" in plan(found)
    sparse = frame(spark, [(n * 10**9,) for n in range(2000)] + [(10**9,), (None,)], "id long")
    found = audit.duplicate_keys(sparse, ["id"])
    assert bag(found) == Counter([(10**9, 2)]) and "LeftSemi" not in plan(found)
    assert audit.duplicate_keys(data.where("id = 1"), ["id"]).collect() == []
    assert audit.duplicate_keys(data.where("false"), ["id"]).collect() == []


def test_unique_dense_ids_are_not_shuffled(spark):
    spark.range(200_000).write.parquet(target := f"{scratch_dir(spark)}/ids")
    found = audit.duplicate_keys(spark.read.parquet(target), ["id"])
    assert found.collect() == []
    # The ranges that are shuffled by key are those with copies: none.
    assert "left_semi" in plan(found).lower() or "LeftSemi" in plan(found)


def test_dense_ids_of_very_many_tasks_are_summed_up_in_blocks(spark, monkeypatch):
    from starloom.operators import running

    monkeypatch.setattr(running, "PARTS_PER_BLOCK", 3)
    data = spark.range(1000).repartition(17, "id")
    got = ops.with_dense_id(data.withColumnRenamed("id", "n"), "id", 5).collect()
    assert sorted(r.id for r in got) == list(range(5, 1005)) and sorted(r.n for r in got) == list(range(1000))
    few = frame(spark, [("a", p, v) for p in range(20) for v in range(p % 4)] + [("b", 3, 9)], "g string, p long, v long")
    summed = running.running_total(few, ["g"], "p", ["v"], F.col("v") + 1, "upto").collect()
    for r in summed:
        earlier = [v + 1 for p in range(20) for v in range(p % 4) if (p, v) < (r.p, r.v)]
        assert r.upto == (sum(earlier) if r.g == "a" else 0)


def test_hot_keys_are_found_by_summaries_and_counted_exactly(spark):
    rows = [(f"hot{n % 9}", None) for n in range(900)] + [(f"k{n}", n) for n in range(4000)] + [(None, n) for n in range(100)]
    rows += [("pair", n % 2) for n in range(401)]
    data = frame(spark, rows, "k string, j int").repartition(13)
    from starloom.operators.joins import _hot_groups

    for keys, want in ((["k"], {("pair", 3)}), (["k", "j"], {("pair", 0, 2), ("pair", 1, 2)})):
        groups = _hot_groups(data, keys, 30, 1, "parts")  # more than 181 rows of 5401
        assert {tuple(r) for r in groups.collect()} == want
        assert " IN " in plan(groups) or "INSET" in plan(groups)
    assert {r.k for r in _hot_groups(data, ["k"], 60, 1, "parts").collect()} == {"pair", *[f"hot{n}" for n in range(9)]}
    assert _hot_groups(data.where("false"), ["k"], 30, 1, "parts").collect() == []
    assert _hot_groups(data, ["k"], 30, 10_000, "parts").collect() == []
    # Beyond what a summary can track, all keys are counted.
    assert {r.k for r in _hot_groups(data, ["k"], 40_000, 300, "parts").collect()} == {"pair"}
