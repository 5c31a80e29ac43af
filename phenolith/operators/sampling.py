"""Exact-count splits and samples by hash order."""

from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.operators.numbering import number_rows
from phenolith.session import cut_lineage

_DIGITS = 3           # hash digits per refinement: 4,096 counts come to the driver
_FETCH_ROWS = 10_000  # a bucket of at most so many rows is fetched by key


def round_half_away(x: float) -> int:
    return int(Decimal(x).to_integral_value(ROUND_HALF_UP))


@dataclass(frozen=True)
class Quotas:
    eval_random: int
    eval_occurrence: int
    train_random: int
    train_occurrence: int


def split_quotas(occurrences: int, multiplier: int = 5, pct: float = 0.05) -> Quotas:
    total = multiplier * occurrences
    eval_random, eval_occurrence = round_half_away(total * pct), round_half_away(occurrences * pct)
    return Quotas(eval_random, eval_occurrence, total - eval_random, occurrences - eval_occurrence)


def split_quota_columns(counts: DataFrame, multiplier: int = 5, pct: float = 0.05) -> DataFrame:
    """The same quotas as columns, for a table with one ``occurrences`` count per row."""
    n = F.col("occurrences")
    eval_random = F.round(n * multiplier * F.lit(pct)).cast("long")
    eval_occurrence = F.round(n * F.lit(pct)).cast("long")
    return counts.withColumns({
        "eval_random": eval_random, "eval_occurrence": eval_occurrence,
        "train_random": n * multiplier - eval_random, "train_occurrence": n - eval_occurrence})


@dataclass(frozen=True)
class Cut:
    """Rows before ``(digest, key)`` belong to the first part, and ``copies`` of the rows at it."""

    digest: str
    key: str
    copies: int
    present: int


def _histogram(hashed: DataFrame, wanted: dict[str, set[str]], width: int) -> dict[str, dict[str, int]]:
    """Rows per part of the table and hash bucket, below the wanted prefixes only."""
    if any(prefixes != {""} for prefixes in wanted.values()):
        tests = [F.col("_class").eqNullSafe(c) & F.col("_digest").startswith(p) for c, ps in wanted.items() for p in sorted(ps)]
        hashed = hashed.where(reduce(lambda a, b: a | b, tests))
    rows = hashed.groupBy("_class", F.substring("_digest", 1, width).alias("_b")).agg(F.count("*").alias("n")).collect()
    counts: dict[str, dict[str, int]] = {}
    for r in rows:
        counts.setdefault(r["_class"], {})[r["_b"]] = r["n"]
    return counts


def _cuts(hashed: DataFrame, ranks) -> tuple[dict[str, int], dict[str, list]]:
    """For each class its row count and the places in hash order before which so many rows lie.

    ``ranks`` maps the counts per class to the wanted ranks. A histogram over a few hash digits finds the buckets with
    the wanted rows; large ones are split by the next digits. Only counts come to the driver, at most 4,096 per bucket
    split, however many rows or copies of a row there are. A place beyond the last row is None.
    """
    counts = _histogram(hashed, {}, _DIGITS)
    totals = {c: sum(buckets.values()) for c, buckets in counts.items()}
    # One search per class and rank: prefix so far and rows still to pass below it.
    searches = [[c, i, "", rank] for c, rs in ranks(totals).items() for i, rank in enumerate(rs)]
    found: dict[tuple[str, int], Cut | None] = {}
    width = _DIGITS
    small: list = []
    while searches:
        following = []
        for c, i, prefix, rest in searches:
            below = {b: n for b, n in counts.get(c, {}).items() if b.startswith(prefix)}
            for bucket in sorted(below):
                if rest < below[bucket]:
                    done = below[bucket] <= _FETCH_ROWS or width >= 32
                    (small if done else following).append([c, i, bucket, rest])
                    break
                rest -= below[bucket]
            else:
                found[c, i] = None
        searches = following
        if searches:
            width = min(width + _DIGITS, 32)
            wanted: dict[str, set[str]] = {}
            for c, _, prefix, _ in searches:
                wanted.setdefault(c, set()).add(prefix)
            counts = _histogram(hashed, wanted, width)
    if small:
        tests = [F.col("_class").eqNullSafe(c) & F.col("_digest").startswith(p) for c, p in sorted({(c, p) for c, _, p, _ in small})]
        keys = hashed.where(reduce(lambda a, b: a | b, tests)).groupBy("_class", "_digest", "_key").agg(F.count("*").alias("n")).collect()
        for c, i, prefix, rest in small:
            below = sorted((r["_digest"], r["_key"], r["n"]) for r in keys if r["_class"] == c and r["_digest"].startswith(prefix))
            for digest, key, n in below:
                if rest < n:
                    found[c, i] = Cut(digest, key, rest, n)
                    break
                rest -= n
    result: dict[str, list] = {}
    for (c, i), cut in sorted(found.items()):
        result.setdefault(c, []).append(cut)
    return totals, result


def split_by_hash(df: DataFrame, sizes, seed, key: str = "example_id", out: str = "split", by: Column | None = None) -> DataFrame:
    """Give the first rows in hash order to the first part, the next to the second and so on.

    ``sizes`` maps the row counts per class to ``{class: [(part, rows), ...]}``; ``by`` is the class, one
    for all rows by default. Rows beyond the last part are dropped. With the cuts known, the
    split is a filter: the table is read, not shuffled. Only when copies of one key lie across a
    cut are those copies numbered.
    """
    columns = df.columns
    hashed = df.withColumns({
        "_class": by if by is not None else F.lit("all"), "_digest": X.seeded_md5(seed, key), "_key": F.col(key)})
    plan: dict = {}

    def ranks(totals):
        plan.update(sizes(totals))
        return {c: list(accumulate(n for _, n in parts)) for c, parts in plan.items()}

    _, cuts = _cuts(hashed.select("_class", "_digest", "_key"), ranks)
    label, shared = F.lit(None).cast("string"), {}
    for c, parts in plan.items():
        for (name, _), cut in reversed(list(zip(parts, cuts.get(c, [])))):
            inside = F.col("_class") == c
            if cut is not None:
                inside = inside & ((F.col("_digest") < cut.digest) | ((F.col("_digest") == cut.digest) & (F.col("_key") < cut.key)))
                if cut.copies:
                    shared.setdefault((c, cut.digest, cut.key), []).insert(0, (name, cut.copies))
            label = F.when(inside, F.lit(name)).otherwise(label)

    def at(c, digest, value):
        return (F.col("_class") == c) & (F.col("_digest") == digest) & (F.col("_key") == value)

    whole = hashed
    for place in shared:
        whole = whole.where(~at(*place))
    result = whole.withColumn(out, label).where(F.col(out).isNotNull()).select(*columns, out)
    for (c, digest, value), shares in shared.items():
        numbered = number_rows(hashed.where(at(c, digest, value)).select(*columns), [key], "_n")
        after = [name for (name, _), cut in zip(plan[c], cuts[c]) if cut is None or (cut.digest, cut.key) > (digest, value)]
        share = F.lit(after[0] if after else None).cast("string")
        for name, upto in reversed(shares):
            share = F.when(F.col("_n") < upto, F.lit(name)).otherwise(share)
        result = result.unionByName(
            numbered.withColumn(out, share).where(F.col(out).isNotNull()).select(*columns, out))
    return result


def sample_positions(df: DataFrame, count: int, seed, key: str = "example_id") -> DataFrame:
    """Exactly ``count`` rows, uniform by hash; none when the count is 0 or there are no rows."""
    if count <= 0:
        return df.limit(0)
    return split_by_hash(df, lambda totals: {c: [("picked", count)] for c in totals}, seed, key, "_split").drop("_split")


def train_eval_split(rows: DataFrame, multiplier: int = 5, pct: float = 0.05, seed=0, key: str = "example_id",
                     presence: Column | None = None) -> DataFrame:
    """Exact-count stratified split of occurrences and random points.

    Eval gets its quota of both classes, train the other occurrences and as many random points as its quota
    allows. A quota is always met when the rows exist. ``presence`` tells the classes apart, by default the label.
    """
    kind = F.when(presence if presence is not None else X.label_presence(), "occurrence").otherwise("random")

    def sizes(totals):
        q = split_quotas(totals.get("occurrence", 0), multiplier, pct)
        return {
            "occurrence": [("eval", q.eval_occurrence), ("train", q.train_occurrence)],
            "random": [("eval", q.eval_random), ("train", q.train_random)]}

    return split_by_hash(rows, sizes, seed, key, by=kind)


def file_quotas(files: DataFrame, rows: int) -> DataFrame:
    """``file_no, n, quota``: ``rows`` dealt over the files in proportion to their rows ``n``, exactly as many in all as there are.

    Each file gets the whole part of its share, and the files with the largest remainders, the smaller number first of equal ones, one more.
    """
    total = files.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = max(0, min(rows, total))
    whole = F.expr(f"{rows}L * n div {max(total, 1)}L")
    shared = files.select("file_no", "n", whole.alias("_whole"), (F.lit(rows).cast("long") * F.col("n") - whole * F.lit(total).cast("long")).alias("_rest"))
    spare = rows - (shared.agg(F.sum("_whole").alias("n")).first()["n"] or 0)
    ranked = number_rows(shared, [F.desc("_rest"), "file_no"], "_rank")
    return ranked.select("file_no", "n", (F.col("_whole") + (F.col("_rank") < spare).cast("long")).alias("quota"))


def split_by_file(rows: DataFrame, eval_rows: int, train_rows: int, seed, file: str = "file_no", key: str = "example_id", out: str = "split") -> DataFrame:
    """Spread the evaluation rows over the files, with an exact quota for each, and take training rows from what is left.

    Both parts are drawn in hash order, so nothing depends on partitions. Rows are numbered by ranges of file and hash: a file with very many rows is cut.
    """
    counts = rows.groupBy(F.col(file).alias("file_no")).agg(F.count("*").alias("n"))
    quotas = file_quotas(counts, eval_rows).select(F.col("file_no").alias(file), "quota")
    hashed = rows.withColumn("_digest", X.seeded_md5(seed, key))
    numbered = number_rows(hashed, ["_digest", key], "_n", group=file).join(quotas, file)
    placed = cut_lineage(numbered.withColumn("_eval", F.col("_n") < F.col("quota")).select(*rows.columns, "_eval"))
    train = sample_positions(placed.where(~F.col("_eval")).drop("_eval"), train_rows, seed, key).withColumn(out, F.lit("train"))
    return placed.where("_eval").drop("_eval").withColumn(out, F.lit("eval")).unionByName(train)


def sample_random_files(files: DataFrame, wanted_rows: int, seed, include_last: bool = True) -> DataFrame:
    """Enough numbered files for the wanted rows plus one, in hash order.

    ``files`` has one row per file: ``file_no, n``. Without ``include_last`` the highest number is never drawn. Files count as holding
    one row at least on average; no files give none.
    """
    totals = files.agg(F.count("*").alias("files"), F.sum("n").alias("n"), F.max("file_no").alias("last")).first()
    per_file = max((totals["n"] or 0) // max(totals["files"], 1), 1)
    count = wanted_rows // per_file + 1
    pool = files if include_last else files.where(F.col("file_no") < totals["last"])
    return pool.orderBy(X.seeded_md5(seed, F.col("file_no").cast("string")), "file_no").limit(count)


def match_random_to_occurrences(random: DataFrame, occurrences: DataFrame, batch_rows: int) -> DataFrame:
    """Random points of as many batches as the occurrences would fill."""
    batches = -(-occurrences.count() // batch_rows)
    return random.where(X.random_batch_id() <= batches)
