"""Secret scans with DataFrame functions only.

Base kinds are regular expressions.  On top of them, candidate strings of a character class
are searched with a sliding window whose Shannon entropy is kept by incremental counts: a
character that enters or leaves changes one count and one term of the sum of c log2 c.  A
candidate whose windows reach the class's threshold gives one span, from the first such window
to the last, unless the allow-list matches the candidate.

Matches and the text between them give all positions as running sums, so nothing is searched
twice and no row leaves its task: the scan is one projection.
"""

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
#: A shorter run of these characters holds no longer one, so the bound may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

SUM_BLOCK = 256


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of a character class and the entropy, in bits, that makes them suspect."""

    kind: str
    candidate: str
    window: int
    threshold: float


CLASSES = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]{32,}", 32, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_=-]{24,}", 24, 3.9),
)

#: Candidates that are no secrets, as whole-string patterns.  A repeated group must be possessive: the
#: JVM's matcher calls itself for every repetition of another one, and a long candidate ends the executor.
ALLOW_LIST = (
    r"[A-Za-z]?[a-z]+",
    r"[A-Z]+",
    r"[0-9]+",
    r"[+/_=-]+",
    r"[A-Za-z]++(?:[-_/=+][A-Za-z]++)++",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i).*example.*",
)


def _add(total: Column, more: Column) -> Column:
    return total + more


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), _add)


def _with_matches(rows: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds ``name``: an array of (start, end, found, part) of all matches, in code points.

    ``part`` is the text of the group.  Running sums are taken in blocks, so that a text with
    very many matches costs little more than their number.
    """
    at = {k: f"_{name}_{k}" for k in ("found", "gap", "step", "sum")}
    regex = F.lit(pattern)
    rows = rows.withColumn(at["found"], F.regexp_extract_all("text", regex, F.lit(0)))
    some = F.size(at["found"]) > 0
    gaps = F.transform(F.split("text", pattern, -1), lambda s: F.length(s).cast("long"))
    rows = rows.withColumn(at["gap"], F.when(some, gaps))
    rows = rows.withColumn(
        at["step"],
        F.zip_with(
            F.slice(at["gap"], F.lit(1), F.size(at["found"])),
            at["found"],
            lambda gap, hit: gap + F.length(hit),
        ),
    )
    block = F.lit(SUM_BLOCK)
    numbers = F.sequence(F.lit(0), F.floor((F.size(at["found"]) - 1) / block).cast("int"))
    sums = F.transform(numbers, lambda k: _total(F.slice(at["step"], k * block + 1, block)))
    rows = rows.withColumn(
        at["sum"],
        F.when(
            some,
            F.aggregate(
                sums,
                F.array(F.lit(0).cast("long")),
                lambda held, more: F.concat(held, F.array(F.element_at(held, -1) + more)),
            ),
        ),
    )
    parts = F.regexp_extract_all("text", regex, F.lit(group)) if group else F.col(at["found"])

    def span(hit: Column, k: Column) -> Column:
        number = F.floor(k / block).cast("int")
        start = (
            F.element_at(at["sum"], number + 1)
            + _total(F.slice(at["step"], number * block + 1, k % block))
            + F.element_at(at["gap"], k + 1)
        )
        return F.struct(
            start.alias("start"), (start + F.length(hit["found"])).alias("end"), hit["found"], hit["part"]
        )

    zipped = F.zip_with(
        at["found"], parts, lambda found, part: F.struct(found.alias("found"), part.alias("part"))
    )
    # The sums are named twice: expressions named once may be moved into the lambda, where they
    # would be computed again for each match.
    ready = some & (F.size(at["sum"]) > 0)
    none = F.from_json(F.lit("[]"), "array<struct<start:bigint,end:bigint,found:string,part:string>>")
    rows = rows.withColumn(name, F.when(ready, F.transform(zipped, span)).otherwise(none))
    return rows.drop(*at.values())


def _entropy_window(text: Column, kind: EntropyClass) -> Column:
    """(first, last): the code points from the first window at the threshold to the last."""
    w = kind.window
    terms = F.lit([0.0] + [c * log2(c) for c in range(1, w + 1)])
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))
    start = F.struct(
        F.lit(0).alias("n"),
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        F.array_repeat(F.lit(-1), w).alias("ring"),
    )

    def step(s: Column, code: Column) -> Column:
        gone = F.element_at(s["ring"], s["n"] % w + 1)  # the character that leaves, -1 at first
        come_n = F.element_at(s["counts"], code + 1) - F.when(gone == code, 1).otherwise(0)
        gone_n = F.when(gone >= 0, F.element_at(s["counts"], gone + 1)).otherwise(0)
        total = (
            s["sum"]
            + F.when(
                gone >= 0, F.element_at(terms, gone_n) - F.element_at(terms, gone_n + 1)
            ).otherwise(0.0)
            + F.element_at(terms, come_n + 2)
            - F.element_at(terms, come_n + 1)
        )
        counts = F.transform(
            s["counts"],
            lambda c, k: c + F.when(k == code, 1).otherwise(0) - F.when(k == gone, 1).otherwise(0),
        )
        ring = F.transform(s["ring"], lambda c, k: F.when(k == s["n"] % w, code).otherwise(c))
        high = (s["n"] + 1 >= w) & (F.lit(log2(w)) - total / w >= kind.threshold)
        return F.struct(
            (s["n"] + 1).alias("n"),
            counts.alias("counts"),
            total.alias("sum"),
            F.when(high & (s["first"] < 0), s["n"] + 1 - w).otherwise(s["first"]).alias("first"),
            F.when(high, s["n"] + 1).otherwise(s["last"]).alias("last"),
            ring.alias("ring"),
        )

    return F.aggregate(codes, start, step, lambda s: F.struct(s["first"], s["last"]))


def _windows(kind: EntropyClass):
    """Of a match, where it starts and its first and last window."""

    def of(hit: Column) -> Column:
        return F.struct(hit["start"].alias("at"), _entropy_window(hit["found"], kind).alias("w"))

    return of


def _kind(spans: Column, order: int, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _joined(spans: Column) -> Column:
    said = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    )
    return F.array_join(said, ",")


def scan_secrets(docs: DataFrame, classes=CLASSES, allow=ALLOW_LIST) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy for each row of (doc_id, text).

    A null text counts as empty; texts without a match have zero counts, the digest of
    the empty string and empty spans.  Repeated rows repeat their answer.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = _with_matches(rows, "assign", ASSIGN, 2)
    rows = _with_matches(rows, "access", ACCESS)
    rows = _with_matches(rows, "hex", HEX)
    for kind in classes:
        rows = _with_matches(rows, kind.kind, kind.candidate)
    rows = rows.drop("text")

    def suspect(hit: Column) -> Column:
        allowed = reduce(lambda a, b: a | b, [hit["found"].rlike(f"^(?:{p})$") for p in allow], F.lit(False))
        return ~allowed

    added = []
    for order, kind in enumerate(classes, 3):
        rows = rows.withColumn(kind.kind, F.transform(F.filter(kind.kind, suspect), _windows(kind)))
        high = F.transform(
            F.filter(kind.kind, lambda hit: hit["w"]["first"] >= 0),
            lambda hit: F.struct(
                (hit["at"] + hit["w"]["first"]).alias("start"), (hit["at"] + hit["w"]["last"]).alias("end")
            ),
        )
        added.append(_kind(high, order, kind.kind))
    long_enough = F.filter("assign", lambda s: F.length(s["part"]) >= ASSIGN_LEAST)
    rows = rows.withColumn("assign", _kind(long_enough, 0, "assign"))
    rows = rows.withColumn("access", _kind(F.col("access"), 1, "access"))
    rows = rows.withColumn("hex", _kind(F.col("hex"), 2, "hex"))
    rows = rows.withColumn("added", F.concat(*added)) if added else rows.withColumn("added", F.slice("hex", 1, 0))
    base = F.concat("assign", "access", "hex")
    return rows.select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, F.col("added"))).alias("spans"),
        F.size("added").cast("long").alias("n_entropy"),
    )
