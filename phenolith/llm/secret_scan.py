"""Secret scans: spans by pattern, then the owners of each value over the whole corpus.

A value that many owners hold, or that many repositories of few owners hold, is an example that was copied around; one that a single
owner holds in few repositories and that looks random is live. Only built-in column functions: spans come from the pieces between matches, counts from two grouped
aggregations whose partial sums leave each task with one row per value and owner.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolith.llm.running import running_max, running_sum
from phenolith.session import write_once

# The base kinds in their order, each with its pattern and the group that holds the value.
KINDS = ["assign", "access", "hex", "live"]
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the base pattern and its length in one: a shorter run has no longer match inside
HEX = r"[0-9a-f]{24,}"
#: Further candidates: long runs of letters and digits; which of them are spans is decided by their owners.
CANDIDATE = r"[A-Za-z0-9_-]{24,}"

MAX_OWNERS, MAX_REPOSITORIES = 1, 3
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10
_SPAN = "array<struct<kind:string,start:int,stop:int,value:string>>"


def matches(text: Column, pattern: str, kind: str, value, keep) -> Column:
    """Leftmost non-overlapping matches as structs of kind, start, stop (code points) and value, without those failing ``keep``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(held: Column) -> Column:  # the pieces between matches and the matches, bound once
        lengths = F.transform(held["found"], lambda m, i: F.length(F.get(held["pieces"], i)) + F.length(m))
        place = lambda stops: F.transform(held["found"], lambda m, i: F.struct(
            F.lit(kind).alias("kind"), (F.get(stops, i) - F.length(m)).alias("start"), F.get(stops, i).alias("stop"), value(m).alias("value")))
        return F.get(F.transform(F.array(running_sum(lengths)), place), F.lit(0))

    every = F.get(F.transform(F.array(F.struct(F.split(text, pattern).alias("pieces"), found.alias("found"))), spans), F.lit(0))
    return F.when(text.rlike(pattern), F.filter(every, keep)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """The spans that patterns alone decide, by start and then kind."""
    whole = lambda m: m
    always = lambda s: s["start"] >= 0
    spans = [
        matches(text, ASSIGN, "assign", lambda m: F.regexp_extract(m, ASSIGN, 2), lambda s: F.length(s["value"]) >= 6),
        matches(text, ACCESS, "access", whole, always), matches(text, HEX, "hex", whole, always)]
    return F.concat(*spans)


def _random_looking(value: Column) -> Column:
    """Letters and digits mixed, with at least ten different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 10) & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= 4))


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str | None = None,
                 max_owners: int = MAX_OWNERS, example_owners: int = EXAMPLE_OWNERS,
                 max_repositories: int = MAX_REPOSITORIES, example_repositories: int = EXAMPLE_REPOSITORIES, carried: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``key`` and ``spans``, an array of structs in order of start, then kind.

    A span has ``kind``, ``start`` and ``stop`` (code points), ``value`` and the corpus counts of its value, ``n_owners`` and ``n_repositories``, with the
    ``verdict`` that follows: ``example`` (``example_owners`` owners or more, or ``example_repositories`` repositories or more, whoever owns them),
    ``live`` (at most ``max_owners`` owners, at most ``max_repositories`` repositories, and random-looking) or ``unclear``. Base kinds always stay; a live candidate that lies in no base span is added as kind ``live``.
    ``repository`` is ``key`` unless named: a document is the smallest thing that can be copied.

    Null texts are empty; null owners count together as one. Rows are told apart by a number of their own, so repeated
    keys keep their rows. An empty table gives an empty one; other columns are left out, whatever their names, unless ``carried``
    names a struct that is to hold all columns of the row.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(f"`{repository or key}`").cast("string"), F.lit("")).alias("repository"), t.alias("t"),
        *([F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("carried")] if carried else []))
    more_columns = ["carried"] if carried else []
    more = matches(F.col("t"), CANDIDATE, "live", lambda m: m, lambda s: _random_looking(s["value"]))
    rows = named.select(
        F.monotonically_increasing_id().alias("row"), "key", "owner", "repository", *more_columns, F.concat(base_spans(F.col("t")), more).alias("found"))
    scanned = write_once(rows, "secret-spans")
    spans = scanned.where(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("s")).select("row", "owner", "repository", "s.*")
    # A candidate meets a base span if one that begins before its end stops after its start: the farthest stop of those decides.
    live = F.col("kind") == "live"
    before = Window.partitionBy("row").orderBy(F.when(live, F.col("stop") - 1).otherwise(F.col("start")), live)
    reach = F.coalesce(F.max(F.when(~live, F.col("stop"))).over(before), F.lit(0))
    single = spans.withColumn("reach", reach).where(~live | (F.col("reach") <= F.col("start"))).drop("reach").withColumn("value_hash", F.sha2("value", 256))
    owners = single.groupBy("value_hash", "owner").agg(F.count("*").alias("n")).groupBy("value_hash").agg(F.count("*").alias("n_owners"))
    copies = single.groupBy("value_hash", "repository").agg(F.count("*").alias("n")).groupBy("value_hash").agg(F.count("*").alias("n_repositories"))
    judged = single.join(owners.join(copies, "value_hash"), "value_hash")
    verdict = F.when((F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories), F.lit("example")).when(
        (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories) & _random_looking(F.col("value")),
        F.lit("live")).otherwise(F.lit("unclear"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    kept = judged.withColumn("verdict", verdict).where((F.col("kind") != "live") | (F.col("verdict") == "live"))
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", order.alias("rank"), "stop", "kind", "value", "n_owners", "n_repositories", "verdict"))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return scanned.select("row", "key", *more_columns).join(spans, "row", "left").select(
        F.col("key").alias(key), F.coalesce("spans", empty).alias("spans"), *[F.col(c).alias(carried) for c in more_columns])


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every given span's characters replaced; overlapping spans are masked once. ``spans`` are in order of their starts."""

    def masked(held: Column) -> Column:
        chars, own = held["chars"], held["spans"]

        def cut(reach: Column) -> Column:
            begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1))  # noqa: E731  how far the spans before reach
            kept = F.transform(own, lambda s, i: F.when(
                s["start"] >= begin(i), F.concat(F.array_join(F.slice(chars, begin(i) + 1, s["start"] - begin(i)), ""), F.lit(mask))).otherwise(F.lit("")))
            last = F.coalesce(F.try_element_at(reach, F.lit(-1)), F.lit(0))
            return F.concat(F.array_join(kept, ""), F.array_join(F.slice(chars, last + 1, F.size(chars)), ""))

        return F.get(F.transform(F.array(running_max(F.transform(own, lambda s: s["stop"]))), cut), F.lit(0))

    # One array of characters: cutting a long text at a place far into it would read it from the start each time.
    return F.get(F.transform(F.array(F.struct(F.split(text, "").alias("chars"), spans.alias("spans"))), masked), F.lit(0))
