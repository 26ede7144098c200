"""Secrets in texts, and credentials in several parts. DataFrame functions only.

Base kinds are certain by their form: ``assign``, ``access`` and ``hex``. Weak candidates mean little
alone: names of users and keys (``link_id``), short or unlabelled secrets (``link_secret``) and
addresses of services (``link_endpoint``). They are joined by interval within a scope of some
characters around each: a weak secret is reported if an identifier or an endpoint lies in its scope,
a weak identifier if a secret does, an endpoint if both do; base spans count as parts as well.

No match crosses the end of a line. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.tables import beside, carried, quoted, stored

#: Base kinds in the order of the digest, with the pattern and the group that must have a length.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8

#: Weak candidates. A value is group 1 where there is one.
LINK_ID = r"""(?i:user(?:name)?|login|client_?id|account_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
LINK_SECRET = (
    r"""(?i:pwd|passphrase|private_?key|signature|credential)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}"""
    r"""|(?<![A-Za-z0-9/+=])(?=[A-Za-z/+]*[0-9])(?=[a-z0-9/+]*[A-Z])(?=[A-Z0-9/+]*[a-z])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"""
)
LINK_ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+|(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"""

KINDS = ["assign", "access", "hex", "link_id", "link_secret", "link_endpoint"]
#: Code points on either side of a part that make its scope.
REACH = 200
MASK = "[secret]"

#: What a text must have for a kind's pattern to be tried on it.
_HINTS = {
    "assign": lambda t: t.rlike(r"(?i)password|passwd|secret|token|api_?key"),
    "access": lambda t: t.contains("AKIA"),
    "hex": lambda t: t.rlike(HEX),
    "link_id": lambda t: t.rlike(r"(?i)(?:user(?:name)?|login|id|key)[\"']?\x20*[:=]"),
    "link_secret": lambda t: t.rlike(r"(?i)(?:pwd|passphrase|key|signature|credential)[\"']?\x20*[:=]|[A-Za-z0-9/+]{40}"),
    "link_endpoint": lambda t: t.contains("://") | t.rlike(r"(?i)(?:host(?:name)?|endpoint|server)[\"']?\x20*[:=]"),
}
_SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"


#: Entries of an array that are walked over in one go.
_RUN = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside of lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def _runs(values: Column) -> Column:
    """An array cut into arrays of ``_RUN`` entries."""
    last = F.floor((F.size(values) - 1) / _RUN).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(values, n * _RUN + 1, _RUN))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(F.array(values), 1, 0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each entry of an array of longs (0 or more) the sum, or what ``join`` makes, of those before it; 0 before the first.

    An array grows by copying, so entries are walked over in runs of ``_RUN``, then the runs' totals.
    """
    empty = F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).cast("long").alias("upto"), empty.alias("each"))

    def step(state: Column, value: Column) -> Column:
        return F.struct(join(state["upto"], value).alias("upto"), F.concat(state["each"], F.array(state["upto"])).alias("each"))

    def shifted(walked: Column) -> Column:
        before = F.aggregate(walked, start, lambda state, run: step(state, run["upto"]), lambda state: state["each"])
        pairs = F.arrays_zip(walked.alias("run"), before.alias("before"))
        return F.flatten(F.transform(pairs, lambda p: F.transform(p["run"]["each"], lambda x: join(p["before"], x))))

    walked = F.transform(_let(values, _runs), lambda run: F.aggregate(run, start, step, lambda state: state))
    return _let(walked, shifted)


def _spans(text: Column, kind: str, pattern: str, value_group: int = 0, value_length: int = 0) -> Column:
    """All matches of one kind from left to right, as (start, rank, end), then those with too short a value dropped."""
    rank = KINDS.index(kind)
    # Each piece is what lies before a match, and the match; group numbers move up by one. The last
    # piece takes the rest of the text, which would else be searched anew from each of its places.
    piece = f"(?s).*?(?:({pattern})|\\z)"
    pieces = F.regexp_extract_all(text, F.lit(piece), F.lit(0))
    found = F.regexp_extract_all(text, F.lit(piece), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(piece), F.lit(value_group + 1)) if value_length else found
    def kept(pieces: Column, found: Column, values: Column) -> Column:
        lengths = lambda some: F.transform(some, lambda x: F.length(x).cast("long"))
        rows = _let(
            lengths(pieces),
            lambda p: F.arrays_zip(
                p.alias("p"), lengths(found).alias("f"), lengths(values).alias("v"), running(p, lambda a, b: a + b).alias("before")
            ),
        )
        fits = F.filter(rows, lambda r: (r["f"] > 0) & (r["v"] >= value_length))

        def span(r: Column) -> Column:
            end = r["before"] + r["p"]
            return F.struct((end - r["f"]).alias("start"), F.lit(rank).alias("rank"), end.alias("end"))

        return F.transform(fits, span).cast(_SPANS)

    return F.when(_HINTS[kind](text), kept(pieces, found, values)).otherwise(F.from_json(F.lit("[]"), _SPANS))


def _as_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )


def _with_parts(docs: DataFrame) -> DataFrame:
    """Adds ``_base`` and ``_weak`` spans, and ``_key``: the text's digest if its parts may be linked."""
    text = F.col("text")
    found = docs.withColumns(
        {
            "_assign": _spans(text, "assign", ASSIGN, 1, ASSIGN_VALUE),
            "_access": _spans(text, "access", ACCESS),
            "_hex": _spans(text, "hex", HEX),
            "_id": _spans(text, "link_id", LINK_ID),
            "_secret": _spans(text, "link_secret", LINK_SECRET),
            "_endpoint": _spans(text, "link_endpoint", LINK_ENDPOINT),
        }
    )
    found = found.withColumns(
        {
            "_base": F.array_sort(F.concat("_assign", "_access", "_hex")),
            "_weak": F.concat("_id", "_secret", "_endpoint"),
            "_n": F.array(F.size("_assign"), F.size("_access"), F.size("_hex")),
        }
    )
    identifiers = F.size("_id") + F.size("_access")
    secrets = F.size("_secret") + F.size("_assign") + F.size("_hex")
    linkable = (F.size("_weak") > 0) & (
        (identifiers > 0).cast("int") + (secrets > 0).cast("int") + (F.size("_endpoint") > 0).cast("int") >= 2
    )
    found = found.withColumn("_key", F.when(linkable, F.sha2("text", 256)))
    return found.drop("_assign", "_access", "_hex", "_id", "_secret", "_endpoint")


def _links(found: DataFrame, reach: int) -> DataFrame:
    """(_key, _linked): weak spans with complementary parts in scope, once per different text."""
    parts = found.where("_key IS NOT NULL").select("_key", "_base", "_weak").dropDuplicates(["_key"])
    parts = parts.select("_key", F.explode(F.concat("_base", "_weak")).alias("part")).select("_key", "part.*")
    # A part is in scope if it begins at most at the scope's end and ends at least at its start: if the
    # furthest end of all parts that begin up to the scope's end reaches its start. So each part is
    # met twice, where it begins, and where its scope ends.
    last, opens = F.col("end") - 1, F.lit(True).alias("opens")
    met = F.array(F.struct(F.col("start").alias("at"), opens), F.struct((last + reach).alias("at"), F.lit(False).alias("opens")))
    events = parts.select("*", F.inline(met))
    begun = Window.partitionBy("_key").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = {k: n for n, k in enumerate(KINDS)}

    def near(*kinds: str) -> Column:
        of_kind = F.col("opens") & F.col("rank").isin(*[ranks[k] for k in kinds])
        return F.coalesce(F.max(F.when(of_kind, last)).over(begun) >= F.col("start") - reach, F.lit(False))

    seen = events.withColumns(
        {
            "near_id": near("access", "link_id"),
            "near_secret": near("assign", "hex", "link_secret"),
            "near_endpoint": near("link_endpoint"),
        }
    ).where(~F.col("opens"))
    kept = (
        (F.col("rank") == ranks["link_secret"]) & (F.col("near_id") | F.col("near_endpoint"))
        | (F.col("rank") == ranks["link_id"]) & F.col("near_secret")
        | (F.col("rank") == ranks["link_endpoint"]) & F.col("near_id") & F.col("near_secret")
    )
    spans = seen.where(kept).select("_key", F.struct("start", "rank", "end").alias("span")).distinct()
    return spans.groupBy("_key").agg(F.sort_array(F.collect_list("span")).cast(_SPANS).alias("_linked"))


def _scanned(docs: DataFrame, reach: int, store_parts: bool) -> DataFrame:
    found = _with_parts(docs)
    if store_parts:
        found = stored(found.drop("text"))
        links = _links(found, reach)
    else:
        links = _links(found, reach)
    # Texts without a key match nothing; a key of their own each keeps them apart in a shuffle.
    links = beside(stored(links))
    joined = found.withColumn("_key", F.coalesce("_key", F.concat(F.lit("-"), F.coalesce(F.col("_row").cast("string"), F.lit("")))))
    joined = joined.join(links, "_key", "left")
    linked = F.coalesce("_linked", F.from_json(F.lit("[]"), _SPANS))
    return joined.withColumn("_spans", F.array_sort(F.concat("_base", linked))).withColumn("_n_linked", F.size(linked)).drop("_key", "_linked")


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = REACH
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of each row.

    ``spans`` has kind:start:end of every span by start, then kind, joined by commas; ``base_sha256``
    is the SHA-256 of the same for the base kinds alone. Matches of a kind don't overlap, those of
    different kinds may. A null text counts as empty and has no spans. Repeated rows and null ids are
    kept; other columns are not read. An empty table gives no rows. Texts of any length are scanned
    whole, in a time that grows with their length.
    """
    source = docs.select(F.col(quoted(id_column)).alias("_row"), F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit("")).alias("text"))
    scanned = _scanned(source, reach, store_parts=True)
    return scanned.select(
        F.col("_row").alias(id_column),
        *[F.col("_n")[k].cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])],
        F.sha2(_as_text(F.col("_base")), 256).alias("base_sha256"),
        _as_text(F.col("_spans")).alias("spans"),
        F.col("_n_linked").cast("long").alias("n_linked"),
    )


def redact_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = REACH, mask: str = MASK
) -> DataFrame:
    """``docs`` with every span in its texts replaced by ``mask``; overlapping spans become one.

    Columns, their order and the number of rows stay, whatever the columns' names, and so do repeated
    rows and null ids. Null texts stay null, empty ones empty, and an empty table stays one. Texts of any
    length are scanned whole, in a time that grows with their length.
    """
    text = F.col(quoted(text_column))
    inner = carried(docs, _row=F.col(quoted(id_column)), _null=text.isNull(), text=F.coalesce(text.cast("string"), F.lit("")))
    scanned = _scanned(inner, reach, store_parts=False)
    masked = F.when(F.size("_spans") == 0, F.col("text")).otherwise(_masked(F.col("text"), F.col("_spans"), mask))
    cleaned = F.when(~F.col("_null"), masked)
    return scanned.select(*[cleaned.alias(c) if c == text_column else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns])


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` for every run of spans that meet or touch; spans are in order of their starts.

    The text is cut into blocks and the runs are dealt to them, as a place in a long text is found by
    walking there from its beginning.
    """
    size = 4096
    ends = F.transform(spans, lambda s: s["end"])

    def merged(reached: Column) -> Column:
        """Runs as (start, end): each begins at a span that no earlier one reaches."""
        each = F.arrays_zip(spans.alias("span"), reached.alias("reached"))
        fresh = F.filter(F.transform(each, lambda e, n: F.struct(e["span"]["start"].alias("start"), e["reached"].alias("reached"), n.alias("n"))), lambda e: (e["n"] == 0) | (e["start"] > e["reached"]))
        later = F.concat(F.transform(F.slice(fresh, 2, F.greatest(F.size(fresh), F.lit(1))), lambda e: e["reached"]), F.array(F.array_max(ends)))
        return F.arrays_zip(F.transform(fresh, lambda e: e["start"]).alias("start"), later.alias("end"))

    def in_block(block: Column, number: Column, runs: Column) -> Column:
        begin = (number * size).cast("long")
        near = F.filter(runs, lambda run: (F.element_at(run, -1)["end"] > begin) & (run[0]["start"] < begin + size))
        own = F.filter(F.flatten(near), lambda r: (r["end"] > begin) & (r["start"] < begin + size))

        def step(state: Column, r: Column) -> Column:
            low, high = F.greatest(r["start"] - begin, F.lit(0)), F.least(r["end"] - begin, F.lit(size))
            between = F.substring(block, (state["at"] + 1).cast("int"), (low - state["at"]).cast("int"))
            sign = F.when(r["start"] >= begin, mask).otherwise("")
            return F.struct(high.cast("long").alias("at"), F.concat(state["out"], between, sign).alias("out"))

        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
        rest = lambda state: F.concat(state["out"], F.substring(block, (state["at"] + 1).cast("int"), F.lit(size)))
        return F.when(F.size(own) == 0, block).otherwise(F.aggregate(own, start, step, rest))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    runs = _let(_let(running(ends, F.greatest), merged), _runs)
    return _let(runs, lambda some: F.array_join(F.transform(blocks, lambda block, number: in_block(block, number, some)), ""))
