"""Personal data by weak supervision: labelers vote on candidates, their reliabilities come from the votes alone.

One pass over the texts finds candidates and lets a pattern, a gazetteer, a context and a shape labeler vote on each. Votes are
summed up over the corpus as one row per combination (a few hundred, whatever its size); expectation-maximisation on these counts estimates, for each
kind by itself, how often each labeler is right. A logistic classifier is then fitted to the resulting probabilities, on features that the labelers don't see:
what the span is made of, the words beside it and signs of other uses. Candidates that meet their kind's exact rule are spans anyway; the classifier decides on the
others, together with the votes.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.llm.shingles import text_blocks
from phenolith.session import write_once

# Kinds in their order, patterns, and the words that labelers look for.
KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["pattern", "gazetteer", "context", "shape"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HIDDEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?[A-Za-z0-9-]{2,63}|\.[A-Za-z]{2,})+", re.IGNORECASE)
NATIONAL_PHONE = re.compile(r"(?<![0-9+()-])(?<!\+[0-9]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
TOP_DOMAINS = frozenset("com net org edu gov mil int info biz io co de fr es it nl uk us ca au at ch be pl se no fi dk pt ru jp cn in br mx eu".split())
WORDS = {
    "email": re.compile(r"e-?mail|contact|write to|reach|courriel|correo|@", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|address|server|host|client|adresse|dirección", re.IGNORECASE),
    "card": re.compile(r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", re.IGNORECASE),
    "phone": re.compile(r"phone|\btel\b|tel\.|call|mobile|fax|telefon|téléphone|teléfono", re.IGNORECASE)}
AGAINST = re.compile(r"version|\bv\.?$|isbn|issn|doi|order|invoice|ticket|serial|section|§", re.IGNORECASE)
CONTEXT_CHARS = 30
# Providers of mail, prefixes and lengths of card issuers, country calling codes, and address blocks that belong to nobody.
PROVIDERS = frozenset("gmail googlemail yahoo hotmail outlook live icloud aol gmx web proton protonmail mail yandex orange free wanadoo laposte libero terra".split())
ISSUERS = {13: ("4",), 14: ("300", "301", "302", "303", "304", "305", "36", "38"), 15: ("34", "37"), 16: ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "35", "6011", "65")}
CALLING = frozenset((
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "212 213 216 218 234 254 351 352 353 354 355 356 357 358 359 370 371 372 380 385 386 420 421 852 886 961 962 965 966 971 972 974").split())
NOBODYS = ("0.", "10.", "127.", "169.254.", "192.168.", "192.0.2.", "198.51.100.", "203.0.113.", "224.", "239.", "255.")

#: Buckets of neighbour words, features in all, and the candidates with the smallest hashes that the classifier is fitted on.
WORD_BUCKETS, FIT_CANDIDATES = 32, 50_000
FEATURES = 12 + 2 * WORD_BUCKETS

_SPANS = "array<struct<kind:string,start:int,stop:int,exact:boolean,votes:array<int>,features:array<float>>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern: around each @, as far left as the last match allows."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """Kind, start, stop (code points) and whether the kind's exact rule holds."""
    found = []
    if "@" in text:
        found += [("email", a, b, True) for a, b in _emails(text)]
    if "at" in text and ("[" in text or "(" in text or "{" in text):
        found += [("email", m.start(), m.end(), False) for m in HIDDEN_EMAIL.finditer(text)]
    if not any(d in text for d in "0123456789"):
        return found
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        found.append(("ip", m.start(), m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19:
            found.append(("card", m.start(), m.end(), len(digits) >= 16 and luhn(digits)))
    if "+" in text:
        for m in PHONE.finditer(text):
            found.append(("phone", m.start(), m.end(), 8 <= sum(c.isdigit() for c in m[0]) <= 15))
    found += [("phone", m.start(), m.end(), False) for m in NATIONAL_PHONE.finditer(text)]
    return found


def votes(text: str, kind: str, start: int, stop: int, exact: bool) -> list[int]:
    """1 for personal, -1 against, 0 for no opinion, one per labeler."""
    body, digits = text[start:stop], [c for c in text[start:stop] if c.isdigit()]
    around = text[max(0, start - CONTEXT_CHARS) : start], text[stop : stop + CONTEXT_CHARS]
    if kind == "email":
        parts = re.split(r"[^A-Za-z0-9-]+", re.sub(r"(?i)[\[({]\x20?(at|dot)\x20?[\])}]", ".", body).strip("])} ").lower())
        known = 1 if parts[-1] in TOP_DOMAINS or PROVIDERS.intersection(parts) else -1 if parts[-1] in ("png", "jpg", "js", "py", "html", "local", "test", "invalid") else 0
        shape = 1 if any(c.isalpha() for c in body) else -1
    elif kind == "ip":
        known = -1 if body.startswith(NOBODYS) else 1 if exact else 0
        shape = 1 if exact and len(body) >= 9 else 0 if exact else -1
    elif kind == "card":
        number = "".join(digits)
        known = 1 if number.startswith(ISSUERS.get(len(number), ISSUERS[16])) else -1
        shape = 1 if luhn(number) else -1
    else:
        number = "".join(digits)
        if body.startswith("+"):
            known = 1 if any(number.startswith(c) for c in (number[:1], number[:2], number[:3]) if c in CALLING) else -1
        else:  # area codes and exchanges of the North American plan begin with 2 to 9; 555-01xx is kept for fiction
            known = 1 if number[0] in "23456789" and number[3] in "23456789" and number[1:3] != "11" and number[3:8] != "55501" else -1
        shape = 1 if len(set(digits)) > 2 else -1
    context = 1 if WORDS[kind].search(around[0]) or WORDS[kind].search(around[1]) else -1 if AGAINST.search(around[0]) else 0
    return [1 if exact else -1, known, context, shape]


def features(text: str, kind: str, start: int, stop: int) -> list[float]:
    """What a span is made of and which words stand beside it, as numbers from 0 to 1."""
    body = text[start:stop]
    before, after = text[max(0, start - CONTEXT_CHARS) : start], text[stop : stop + CONTEXT_CHARS]
    n = len(body)
    share = lambda some: sum(c in some for c in body) / n
    out = [
        share("0123456789"), sum(c.isalpha() for c in body) / n, share("-. "), share("()[]{}+@"), min(n / 40, 1.0), len(set(body)) / n,
        float(bool(WORDS[kind].search(before))), float(bool(WORDS[kind].search(after))), float(bool(AGAINST.search(before))),
        float(before[-1:].isalnum() or before[-1:] in ("-", "/", "#")), float(after[:1].isalnum() or after[:1] in ("-", "/")), float(before.rstrip()[-1:] == ":")]
    words = [0.0] * (2 * WORD_BUCKETS)
    for place, found in enumerate((re.findall(r"\w+", before)[-1:], re.findall(r"\w+", after)[:1])):
        if found:
            words[place * WORD_BUCKETS + zlib.crc32(found[0].lower().encode()) % WORD_BUCKETS] = 1.0
    return out + words


def find_candidates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``candidates`` of every whole text, each with its votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("exact", pa.bool_()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.float32()))]))
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                rows = []
                for raw in texts:
                    t = raw.decode() if raw else ""
                    rows.append([dict(kind=k, start=a, stop=b, exact=ok, votes=votes(t, k, a, b, ok), features=features(t, k, a, b)) for k, a, b, ok in candidates(t)])
                yield pa.RecordBatch.from_arrays([batch.column("key")[lo:hi], pa.array(rows, kind)], names=["key", "candidates"])

    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(run, f"key {kind}, candidates {_SPANS}").withColumnRenamed("key", key)


def reliabilities(table: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over combinations of votes (rows of -1, 0, 1) with their counts.

    Returns the probability of each combination to be personal, and P(vote | class) by class, labeler and vote. The first guess
    is the mean vote; one case is added to every cell, so that a labeler that never spoke stays without opinion.
    """
    p = 1 / (1 + np.exp(-2 * table.sum(axis=1)))
    given = np.zeros((2, table.shape[1], 3))
    for _ in range(rounds):
        for c, weight in enumerate((counts * (1 - p), counts * p)):
            for v in range(3):
                given[c, :, v] = 1 + (weight[:, None] * (table == v - 1)).sum(axis=0)
            given[c] /= given[c].sum(axis=1, keepdims=True)
        prior = (1 + (counts * p).sum()) / (2 + counts.sum())
        logs = [np.log(given[c][np.arange(table.shape[1]), table + 1]).sum(axis=1) for c in (0, 1)]
        p = 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - prior) - logs[1] - np.log(prior), -500, 500)))
    return p, given


def fit_classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression on soft labels by Newton steps with a ridge of one; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share, w = counts / max(counts.sum(), 1) * 1000, np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (share * q * (1 - q) + 1e-6)[:, None]).T @ x + np.eye(len(w)), x.T @ (share * (q - p)) + w)
    return w


def _inputs(kind: str, votes_: list[int], features_: list[float]) -> np.ndarray:
    """Votes and a constant of each kind in places of their own, then the features."""
    own = np.zeros((len(KINDS), len(LABELERS) + 1))
    own[KINDS.index(kind)] = [1, *votes_]
    return np.concatenate([own.ravel(), features_])


def find_personal_data(df: DataFrame, key: str = "doc_id", text: str = "text", cut: float = 0.9) -> DataFrame:
    """One row per row of ``df``: ``key`` and ``spans``, an array of structs in order of kind, then start.

    A span has ``kind``, ``start``, ``stop`` (code points), ``exact`` and ``probability``. Exact spans (pattern and check of the kind) always stay;
    a further candidate becomes a span of kind ``more_<kind>`` if the classifier gives it ``cut`` or more and no exact span overlaps it.

    Null and empty texts have no spans. Texts are searched one by one, so repeated rows have the same result each; an empty table gives
    an empty one; null keys stay; other columns are left out. Within a kind, matches are the leftmost ones and don't overlap.
    """
    found = write_once(find_candidates(df, key, text).withColumnRenamed(key, "key"), "candidates")
    single = found.select(F.explode("candidates").alias("c")).select("c.*")
    sums = single.groupBy("kind", "votes").agg(F.count("*").alias("n")).orderBy("kind", "votes").collect()  # combinations of votes
    probability: dict[tuple, float] = {}
    for kind in KINDS:
        own = [r for r in sums if r["kind"] == kind]
        if own:
            p, _ = reliabilities(np.array([r["votes"] for r in own]), np.array([r["n"] for r in own], dtype=float))
            probability |= {(kind, tuple(r["votes"])): float(q) for r, q in zip(own, p, strict=True)}
    # Rows with the smallest hashes of all they hold, so that equal candidates, as in copied texts, are one of them.
    some = single.groupBy("kind", "votes", "features").agg(F.count("*").alias("n")).orderBy(F.xxhash64("kind", "votes", "features"), "kind", "n").limit(FIT_CANDIDATES).toPandas()
    width = len(KINDS) * (len(LABELERS) + 1) + FEATURES
    weights = np.zeros(width + 1)
    if len(some):
        x = np.array([_inputs(k, list(v), list(f)) for k, v, f in zip(some["kind"], some["votes"], some["features"], strict=True)])
        p = np.array([probability[k, tuple(int(i) for i in v)] for k, v in zip(some["kind"], some["votes"], strict=True)])
        weights = fit_classifier(x, p, np.log1p(some["n"].to_numpy(dtype=float)))
    own = {k: F.array(*[F.lit(float(w)) for w in weights[i * (len(LABELERS) + 1) : (i + 1) * (len(LABELERS) + 1)]]) for i, k in enumerate(KINDS)}
    of_kind = F.create_map(*[c for k in KINDS for c in (F.lit(k), own[k])])
    rest = F.array(*[F.lit(float(w)) for w in weights[len(KINDS) * (len(LABELERS) + 1) : width]])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)

    def judged(c: Column) -> Column:
        logit = F.lit(float(weights[-1])) + dot(F.concat(F.array(F.lit(1)), c["votes"]), F.element_at(of_kind, c["kind"])) + dot(c["features"], rest)
        place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), c["kind"]).cast("int") + F.when(c["exact"], 0).otherwise(len(KINDS))
        return F.struct(
            place.alias("place"), c["start"].alias("start"), c["stop"].alias("stop"), F.when(c["exact"], c["kind"]).otherwise(F.concat(F.lit("more_"), c["kind"])).alias("kind"),
            c["exact"].alias("exact"), (1 / (1 + F.exp(-logit))).alias("probability"))

    clear = lambda s: ~F.exists("_all", lambda o: o["exact"] & (o["start"] < s["stop"]) & (s["start"] < o["stop"]))
    every = found.select(F.col("key").alias(key), F.transform("candidates", judged).alias("_all"))
    return every.select(key, F.sort_array(F.filter("_all", lambda s: s["exact"] | ((s["probability"] >= cut) & clear(s)))).alias("spans"))
