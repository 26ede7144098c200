"""Join of texts by the Jaccard similarity of their word n-grams, by T-occurrence search.

Texts of equal sets are one class. Two sets of sizes a and b are similar if they share at least
T(a, b) n-grams; in a T-occurrence search a set finds its partners among inverted lists, one per
n-gram, as the sets that occur on T of its lists. As in DivideSkip, short lists are merged by a
heap and long ones only probed by binary search, for what the short ones leave possible.

The same idea is used twice.

* Which sets to compare: of each set the part with the smallest hashes is held in inverted lists
  over all texts. Similar sets share a number T' of these, so a set may skip its longest lists, up
  to one less than the least T'; what it shares on the others must still reach T' less these.
  Before that, each set is tried against the first text (by id) that has one of its smallest
  hashes; sets that turn out to be linked form clusters, and clusters with the same smallest hash
  that others have as well a family, which stands on a list only once. So a list of very many copies, or of
  very many texts that are much alike, has few entries.
* Comparing: sets go to blocks of target sets of bounded size, where DivideSkip runs over the lists
  of the whole sets.

No pair is missed: the hash order only decides where a pair is found. Hashes have 64 bits, those of
whole sets 128; two n-grams of one hash would count as equal.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.bytewise import BLANK, LOWER, cache_of, mix, ngram_hashes, portions, row_bounds, slices, span_hashes, words
from starloom.llm.graph import components
from starloom.llm.tables import beside, carried, quoted, released, ship, stored

#: N-grams of target sets in a block, and of the sets compared with them in one go.
BLOCK_GRAMS = 1_000_000
QUERY_GRAMS = 2_000_000
#: Smallest hashes by which clusters are sought.
FIRST_TRIES = 4
#: Percent of a set that is held on lists, beyond what the similarity leaves free. More of it lets
#: sets skip more of their long lists.
SPARE = 15
#: DivideSkip's weight of a probe against a heap step.
MU = 0.0085
#: Entries up to which short lists are merged by a heap.
HEAP_ENTRIES = 512
#: Entries of lists, at most, that the queries of one go meet among their own targets.
WORK = 1_000_000_000


class Threshold:
    """A similarity of at least percent / 100, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def similar(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def shared(self, a, b):
        """The least number of n-grams that similar sets of these sizes share."""
        return -((-self.percent * (a + b)) // (100 + self.percent))

    def least(self, size):
        """The least size of a set that is similar to one of this size."""
        return -((-self.percent * size) // 100)

    def held(self, size):
        """How many of the smallest hashes are on lists."""
        return size - self.loose(size)

    def loose(self, size):
        """The others."""
        return -((-(self.percent - SPARE) * size) // 100) - 1

    def shared_held(self, a, b):
        """The least number of shared hashes among those on lists."""
        return self.shared(a, b) - np.maximum(self.loose(a), self.loose(b))

    @lru_cache(maxsize=100_000)  # noqa: B019
    def shared_held_least(self, size: int) -> int:
        """The same for a partner of any size that can be similar."""
        sizes = np.arange(self.least(size), 100 * size // self.percent + 1)
        return int(max(1, self.shared_held(size, sizes).min()))


    def shared_held_sql(self, a: Column, b: Column) -> Column:
        """``shared_held`` of two columns."""
        shared = F.ceil((a + b) * self.percent / (100 + self.percent))
        loose = [F.ceil(x * (self.percent - SPARE) / 100) - 1 for x in (a, b)]
        return shared - F.greatest(*loose)


def gram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text. A text with fewer words has one for all of them."""
    cache_of("sets")
    for first, end, data, offsets in slices(texts):
        data = LOWER[data]
        starts, ends, row = words(data, offsets, BLANK)
        hashes = span_hashes(data, starts, ends)
        grams = ngram_hashes(hashes, n)
        bounds = row_bounds(row, end - first).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                yield mix(ngram_hashes(hashes[a:b], b - a))
            else:
                yield np.zeros(0, np.uint64)


def set_name(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def divide_skip(lists: list[np.ndarray], least: int, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers (below ``numbers``) on ``least`` or more of the lists, each sorted, and how often each is.

    Short lists are merged, by a heap while they have few entries, else by counting; long ones are
    probed by binary search for what the short ones left, or counted where that is most of them.
    """
    lists = sorted(lists, key=len)
    none = np.zeros(0, np.int64)
    if len(lists) < least:
        return none, none
    longest = max(1, int(least / (MU * log2(len(lists[-1]) + 1) + 1)))
    longest = min(longest, least - 1)
    short, long_lists = lists[: len(lists) - longest], lists[len(lists) - longest :]
    counts = np.zeros(numbers, np.int64)
    if sum(map(len, short)) <= HEAP_ENTRIES:
        for number, same in groupby(heapq.merge(*[x.tolist() for x in short])):
            counts[number] = sum(1 for _ in same)
    else:
        counts += np.bincount(np.concatenate(short), minlength=numbers)
    left = np.flatnonzero(counts >= least - longest)
    for rest, entries in zip(range(longest, 0, -1), long_lists, strict=True):
        left = left[counts[left] + rest >= least]
        if not len(left):
            return none, none
        if len(left) * log2(len(entries) + 2) < len(entries):
            place = np.searchsorted(entries, left)
            place[place == len(entries)] = 0
            counts[left] += entries[place] == left
        else:
            counts[entries] += 1
    left = left[counts[left] >= least]
    return left, counts[left]


class Index:
    """Inverted lists over a block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(grams, kind="stable")  # sets in order on every list
        self.owner = owner[order]
        self.grams, begins = np.unique(grams[order], return_index=True)
        self.bounds = np.append(begins, len(grams))

    def similar(self, grams: np.ndarray, threshold: Threshold) -> list[int]:
        """Numbers of the sets in the block that are similar to this one."""
        place = np.searchsorted(self.grams, grams)
        place[place == len(self.grams)] = 0
        place = place[self.grams[place] == grams] if len(self.grams) else place[:0]
        least = threshold.least(len(grams))
        if len(place) < least:
            return []
        lists = [self.owner[a:b] for a, b in zip(self.bounds[place].tolist(), self.bounds[place + 1].tolist(), strict=True)]
        found, shared = divide_skip(lists, least, len(self.sizes))
        return found[100 * shared >= threshold.percent * (len(grams) + self.sizes[found] - shared)].tolist()


class Roots:
    """What links hold together within a block; of each group the least name is the root."""

    def __init__(self):
        self.above: dict[bytes, bytes] = {}

    def root(self, name: bytes) -> bytes:
        top = name
        while (up := self.above.setdefault(top, top)) != top:
            top = up
        while name != top:
            self.above[name], name = top, self.above[name]
        return top

    def join(self, a: bytes, b: bytes) -> None:
        low, high = sorted((self.root(a), self.root(b)))
        self.above[high] = low

    def links(self) -> tuple[list[bytes], list[bytes]]:
        """Each name but the roots, and its root."""
        names = [x for x, up in self.above.items() if x != up]
        return names, [self.root(x) for x in names]


def _numbers(column: str) -> Column:
    """A row for each whole number from 0 to one below the column's."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))


class NgramJoin:
    """The join of one table; see ``ngram_join``."""

    def __init__(
        self, docs: DataFrame, percent: int, n: int, id_column: str, text_column: str, count_links: bool = False
    ):
        ship(docs.sparkSession)
        self.count_links = count_links
        self.threshold, self.n = Threshold(percent), n
        self.source = docs.select(
            F.col(id_column).cast("long").alias("id"),
            F.col(text_column).cast("string").alias("text"),
            F.xxhash64(F.col(text_column).cast("string")).alias("text_hash"),
        )
        self.sets = stored(self._sets())

    def _sets(self) -> DataFrame:
        threshold, n = self.threshold, self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in portions(whole)):
                sizes, names, needs, held = [], [], [], []
                for grams in gram_sets(batch.column(1), n):
                    size = len(grams)
                    sizes.append(size)
                    names.append(set_name(grams))
                    needs.append(threshold.shared_held_least(size) if size else 0)
                    held.append(grams[: threshold.held(size)].view(np.int64) if size else grams.view(np.int64))
                lengths = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in held]))), pa.int32())
                values = pa.array(np.concatenate(held) if held else np.zeros(0, np.int64))
                columns = [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(needs, pa.int32()),
                    pa.ListArray.from_arrays(lengths, values),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "size", "name", "need", "held"])

        return self.source.mapInArrow(run, "id long, text_hash long, size long, name binary, need int, held array<long>")

    def _whole_sets(self, wanted: DataFrame) -> DataFrame:
        """(name, size, grams) of the wanted (name, id): their texts are read and cut once more."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in portions(whole)):
                grams = list(gram_sets(batch.column(0), n))
                names = [set_name(x) for x in grams]
                kept = [k for k, (x, y) in enumerate(zip(names, batch.column(1).to_pylist(), strict=True)) if x == y]
                columns = [
                    pa.array([names[k] for k in kept], pa.binary()),
                    pa.array([len(grams[k]) for k in kept], pa.int64()),
                    pa.array([grams[k].tobytes() for k in kept], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["name", "size", "grams"])

        wanted = stored(wanted.withColumnRenamed("id", "wanted_id"))
        texts = self.source.join(beside(wanted), F.col("id").eqNullSafe(F.col("wanted_id"))).select("text", "name")
        whole = stored(texts.mapInArrow(run, "name binary, size long, grams binary"))
        # Every wanted set is there; only rows repeated with their ids give one more than once.
        several = whole.count() > wanted.count()
        return stored(whole.dropDuplicates(["name"])) if several else whole

    def _search(self, queries: DataFrame, members: DataFrame, count: bool = False) -> DataFrame:
        """Links (a, b) of sets a with similar sets b, for queries (a, target) and members (b, target).

        ``members`` also has their sizes. Targets are dealt to blocks, large ones to several; a set
        goes to every block of each of its targets. The queries of a block are cut by their n-grams and by
        the entries that they may meet. Of the links that a block finds only as many come out as hold its
        sets together, each to the least one. With ``count`` the result is (a, n): links only counted.
        """
        threshold = self.threshold
        given = stored(queries), stored(members)
        queries, members = self._gathered_targets(*given)
        released(*given)
        names = queries.select(F.col("a").alias("name")).unionAll(members.select(F.col("b").alias("name"))).distinct()
        sizes = self.classes.select("name", "id", "size")
        whole = self._whole_sets(sizes.join(names, "name").select("name", "id"))
        grams = members.agg(F.sum("size")).first()[0] or 0
        blocks = int(grams // BLOCK_GRAMS + 1)
        parts = members.groupBy("target").agg(F.ceil(F.sum("size") / BLOCK_GRAMS).alias("parts"), F.count(F.lit(1)).alias("members"))
        block = F.pmod(F.xxhash64("target"), F.lit(blocks)).alias("block")
        index = members.join(parts, "target").select(F.col("b").alias("name"), block, F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
        each = F.ceil(F.col("members") / F.col("parts")).alias("members")
        asked = queries.join(parts, "target").select(F.col("a").alias("name"), block, _numbers("parts").alias("part"), each)
        asked = asked.groupBy("name", "block", "part").agg(F.sum("members").alias("members"))
        asked = stored(asked.join(sizes.select("name", "size"), "name"))
        met = F.sum(F.col("size").cast("double") * F.col("members"))
        load = asked.groupBy("block", "part").agg(F.greatest(F.ceil(F.sum("size") / QUERY_GRAMS), F.ceil(met / WORK)).alias("turns"))
        asks = asked.join(load, ["block", "part"]).select(
            "name", "block", "part", F.pmod(F.xxhash64("name"), F.col("turns")).alias("turn"), F.lit(True).alias("asks")
        )
        held = index.distinct().join(load, ["block", "part"]).select(
            "name", "block", "part", _numbers("turns").alias("turn"), F.lit(False).alias("asks")
        )
        # Places are short rows; the sets themselves are sent to them once.
        places = stored(asks.unionAll(held))

        def run(table: pa.Table) -> pa.Table:
            cache_of("sets")
            asks = table.column("asks").to_pylist()
            named = table.column("name").to_pylist()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
            held = [k for k, x in enumerate(asks) if not x]
            lists = Index([sets[k] for k in held])
            left, right, roots = [], [], Roots()
            for k, x in enumerate(asks):
                if x:
                    found = [named[held[n]] for n in lists.similar(sets[k], threshold) if named[held[n]] != named[k]]
                    if count:
                        left.append(named[k])
                        right.append(len(found))
                    for other in [] if count else found:
                        roots.join(named[k], other)
            if not count:
                left, right = roots.links()
            kind = pa.int64() if count else pa.binary()
            return pa.table({"a": pa.array(left, pa.binary()), "n" if count else "b": pa.array(right, kind)})

        dealt = beside(places).join(whole.select("name", "grams"), "name").groupBy("block", "part", "turn")
        if count:
            found = dealt.applyInArrow(run, "a binary, n long").groupBy("a").agg(F.sum("n").alias("n"))
        else:
            found = dealt.applyInArrow(run, "a binary, b binary")
        found = stored(found)
        released(queries, members, asked, places, whole)
        return found

    def _gathered_targets(self, queries: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both with targets that are sought together made one, so that a set goes to fewer blocks.

        A target takes the name of the least one that is sought with it, unless what would share
        that name has more n-grams than a block.
        """
        least = F.min("target").over(Window.partitionBy("a")).alias("least")
        joint = queries.select("target", least).groupBy("target").agg(F.min("least").alias("joint"))
        sizes = members.groupBy("target").agg(F.sum("size").alias("grams")).join(joint, "target")
        fits = sizes.groupBy("joint").agg(F.sum("grams").alias("grams")).where(F.col("grams") <= BLOCK_GRAMS)
        renamed = joint.join(fits.select("joint"), "joint").where("joint <> target").select("target", "joint")
        renamed = beside(stored(renamed))

        def gathered(table: DataFrame) -> DataFrame:
            return table.join(renamed, "target", "left").withColumn("target", F.coalesce("joint", "target")).drop("joint")

        return stored(gathered(queries).distinct()), stored(gathered(members).distinct())

    def _first_links(self) -> DataFrame:
        """Links of sets with the first text that has one of the same smallest hashes."""
        few = self.different.select("id", "name", "size", F.explode(F.slice("held", 1, FIRST_TRIES)).alias("gram"))
        first = few.groupBy("gram").agg(F.min(F.struct("id", "name", "size")).alias("first"), F.count(F.lit(1)).alias("n"))
        first = first.where("n > 1").select("gram", F.col("first.name").alias("b"), F.col("first.size").alias("b_size"))
        near = (F.least("size", "b_size") * 100 >= F.greatest("size", "b_size") * self.threshold.percent) & (F.col("name") != F.col("b"))
        tries = stored(few.join(first, "gram").where(near).select(F.col("name").alias("a"), "b", "b_size").distinct())
        members = tries.select("b", F.col("b").alias("target"), F.col("b_size").alias("size")).distinct()
        links = self._search(tries.select("a", F.col("b").alias("target")), members)
        released(tries)
        return links

    def _other_links(self, clusters: DataFrame) -> DataFrame:
        """All links between sets of different clusters."""
        threshold, percent = self.threshold, self.threshold.percent
        clusters = clusters.select(F.col("node").alias("name"), "component")
        # Most n-grams are on a list of their own: rows are short, and dealt by n-gram only once. A set
        # outside of all clusters is its own group, which its row says by a null.
        cluster = F.when(F.col("component").isNotNull(), F.xxhash64("component")).alias("cluster")
        entries = self.different.join(beside(stored(clusters)), "name", "left").select(
            F.explode("held").alias("gram"), F.xxhash64("name").alias("set"), cluster
        )
        dealt = entries.repartition("gram").select("gram", "set", F.coalesce("cluster", "set").alias("group"))
        lists = dealt.groupBy("gram").agg(
            F.count(F.lit(1)).alias("length"), F.min("group").alias("g0"), F.max("group").alias("g1")
        )
        lists = lists.where("g0 <> g1").select("gram", "length").hint("shuffle_hash")
        live = stored(dealt.join(lists, "gram").distinct())
        sizes = self.classes.select(F.xxhash64("name").alias("set"), "name", "size", "need")
        # A set skips its need - 1 longest lists; one with fewer lists than it needs has no partner. Both
        # of a pair skip lists from the same end of one order, so of those that they share only as
        # many are missed as the one with the larger need skips.
        order = Window.partitionBy("set").orderBy("length", "gram")
        of_set = Window.partitionBy("set")
        ranked = live.withColumn("rank", F.row_number().over(order)).withColumns(
            {"lists": F.count(F.lit(1)).over(of_set), "head": F.min("gram").over(of_set)}
        )
        ranked = ranked.join(sizes, "set").where("rank <= lists - need + 1")
        probes = stored(ranked.select("set", "size", "need", F.col("group").alias("own"), "gram", "head"))
        released(live)
        # Sets are sought by families: clusters of the same smallest hash among those on lists of several
        # groups. Texts that are much alike but not linked are of few families, so they are few entries of
        # a list. (Of hashes that no other text has, each such text would be a family of its own.)
        family = stored(probes.groupBy("own").agg(F.min("head").alias("family")))
        sets = stored(probes.select("set", "own").distinct().join(beside(family), "own").join(sizes.select("set", "name", "size"), "set"))
        entries = probes.select("gram", "size", "need", "own").join(beside(family), "own")
        on_list = entries.groupBy("gram", "family").agg(
            F.min("size").alias("low"), F.max("size").alias("high"), F.max("need").alias("most"), F.min("own").alias("g0"), F.max("own").alias("g1")
        )
        near = (F.col("low") * percent <= F.col("size") * 100) & (F.col("high") * 100 >= F.col("size") * percent)
        met = probes.join(on_list, "gram").where(near & ((F.col("own") != F.col("g0")) | (F.col("own") != F.col("g1"))))
        shared = met.groupBy("set", "size", "need", "family").agg(
            F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("most").alias("most")
        )
        # T' grows with the other's size up to the own size and falls beyond it: the least is at an
        # end, or one less between them by rounding.
        low = F.greatest("low", F.ceil(F.col("size") * percent / 100))
        high = F.least("high", F.floor(F.col("size") * 100 / percent))
        least = F.least(*[threshold.shared_held_sql(F.col("size"), x) for x in (low, high)])
        # Needs are SPARE percent of the size and up to 3 more, so the larger need is bounded by the own one.
        need = F.greatest("need", F.least("most", F.ceil(F.col("need") * 100 / percent) + 4))
        enough = shared.where(F.col("n") >= least - need).select("set", F.col("family").alias("target"))
        tries = stored(enough.join(sets.select("set", F.col("name").alias("a")), "set").select("a", "target"))
        targets = tries.select("target").distinct()
        members = sets.select(F.col("name").alias("b"), F.col("family").alias("target"), "size").join(targets, "target", "left_semi")
        links = self._search(tries, members)
        released(probes, family, sets, tries)
        return links

    def run(self) -> DataFrame:
        named = self.sets.where("name IS NOT NULL")
        place = F.struct("id", "text_hash")
        classes = named.groupBy("name").agg(
            F.min(place).alias("first"), F.min("id").alias("id"), F.max("size").alias("size"), F.max("need").alias("need"), F.count(F.lit(1)).alias("n")
        )
        classes = stored(classes)
        self.classes = classes.select("name", "id", "size", "need")
        # Of rows with equal sets only one goes on; there are few others, or they are many of few.
        several = beside(stored(classes.where("n > 1").select("name", "first")))
        copies = named.select("name", place.alias("row")).join(several, "name").where(~F.col("row").eqNullSafe(F.col("first")))
        copies = beside(stored(copies.select(F.col("row.id").alias("gone_id"), F.col("row.text_hash").alias("gone_hash")).distinct()))
        gone = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
        self.different = named.join(copies, gone, "left_anti")
        clusters = stored(components(self._first_links()))
        links = clusters.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(self._other_links(clusters))
        slim = stored(self.sets.select("id", "text_hash", "size", "name"))
        released(self.sets)
        classes = self.classes.select("name", "id").join(
            components(links).select(F.col("node").alias("name"), "component"), "name", "left"
        )
        classes = stored(classes.select("name", "id", F.coalesce("component", "name").alias("component")))
        least = classes.groupBy("component").agg(F.min("id").alias("component_id"))
        columns = ["name", "component", "component_id"]
        answer = classes.join(least, "component")
        if self.count_links:
            answer = answer.join(self._link_counts(classes), "name", "left").withColumn("n_links", F.coalesce("n", F.lit(0)))
            columns.append("n_links")
        answer = stored(answer.select(*columns))
        joined = slim.join(answer, "name", "left")
        return joined.select(
            "id",
            "text_hash",
            F.col("size").alias("n_shingles"),
            F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            F.lower(F.hex("name")).alias("class_name"),
            F.lower(F.hex("component")).alias("component_name"),
            *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if self.count_links else []),
        )

    def _link_counts(self, classes: DataFrame) -> DataFrame:
        """(name, n): of each set the sets similar to it, all of which are in its component."""
        several = classes.groupBy("component").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
        sets = classes.join(several, "component", "left_semi").join(self.classes.select("name", "size"), "name")
        members = sets.select(F.col("name").alias("b"), F.col("component").alias("target"), "size")
        queries = sets.select(F.col("name").alias("a"), F.col("component").alias("target"))
        return self._search(queries, members, count=True).withColumnRenamed("a", "name")


def ngram_join(
    docs: DataFrame,
    percent: int = 85,
    n: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    count_links: bool = False,
) -> DataFrame:
    """(id, n_shingles, component_id, class_name, component_name) of each row, with ``count_links`` also n_links.

    Words are runs of anything but blanks, with A-Z in lower case; a text's set has its distinct
    n-grams of words, or all its words as one if there are fewer. Two rows are linked when the sets'
    Jaccard similarity is percent / 100 or more. ``component_id`` is the smallest id that links lead
    to, the row's own included. ``class_name`` is the same for rows of equal sets and
    ``component_name`` for linked ones; both are null for empty sets. ``n_links`` is how many different
    other sets are similar to the row's; counting them compares all sets of a component, in blocks.

    Null and empty texts have no n-grams and are their own component. Repeated rows are rows of one
    class. Texts of any length are cut and compared whole. A null id counts as larger than any other; a component of nothing but null ids is null.
    Other columns are not read. An empty table gives no rows.
    """
    joined = NgramJoin(docs, percent, n, id_column, text_column, count_links).run()
    return joined.drop("text_hash").withColumnRenamed("id", id_column)


def without_similar(
    docs: DataFrame, percent: int = 85, n: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of linked rows, that of the smallest id (null: the largest).

    Of rows of one id in a group the one with the smallest hash of its text stays; of rows with the
    same id and text, one. Rows with an empty set (null and empty texts) are in no group and all stay.
    Columns and their order stay, whatever their names; an empty table stays one. Texts of any length
    are hashed whole.
    """
    joined = stored(NgramJoin(docs, percent, n, id_column, text_column).run().where("component_name IS NOT NULL"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    kept = joined.groupBy("component_name").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = joined.join(kept.select("component_name", "kept.id", "kept.text_hash").withColumnsRenamed(
        {"id": "kept_id", "text_hash": "kept_hash"}), "component_name")
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    gone = rows.where(~same).select("id", "text_hash").distinct()
    again = rows.where(same).groupBy("id", "text_hash").count().where("count > 1").select("id", "text_hash")

    def keyed(table: DataFrame) -> DataFrame:
        return beside(stored(table.select(F.col("id").alias("its_id"), F.col("text_hash").alias("its_hash"))))

    text = F.col(quoted(text_column)).cast("string")
    rows = carried(docs, id=F.col(quoted(id_column)).cast("long"), text_hash=F.xxhash64(text), text=text)
    at = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash"))
    left = rows.join(keyed(gone), at, "left_anti")
    again = keyed(again)
    repeated = left.join(again, at, "left_semi").dropDuplicates(["id", "text"])
    return left.join(again, at, "left_anti").unionAll(repeated).select("row.*")
