"""Secrets in texts, with DataFrame operations only.

Known shapes (assignments, access keys, long hexadecimal runs) are found by expression. The
rest is found by entropy: candidate strings are runs of the characters secrets are made of;
a window slides over each candidate, and its Shannon entropy follows from the sum of n * log2(n)
over its characters' counts n. The counts are carried along: sliding by one character changes two
of them, and the sum by two differences. A candidate counts as a secret if its highest window reaches
the threshold of its character class. Known shapes and allow-listed stretches are blanked out first,
so that what stands beside them is judged by itself. Long candidates are taken in overlapping blocks,
so each step is short.

Spans are in code points, end exclusive; all of them hold whole texts. Defined cases: a null or
empty text has no spans; equal spans of two kinds are both reported; overlapping spans of
different known kinds too; repeated rows are scanned like any other; an empty table gives an
empty result; a column of the input that is called like a result column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import table

ASSIGN, ACCESS, HEX, ENTROPY = "assign", "access", "hex", "entropy"
KINDS = (ASSIGN, ACCESS, HEX, ENTROPY)
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough is the same as a run, dropped if it is too short.
_PATTERNS = {ASSIGN: _ASSIGN, ACCESS: r"AKIA[A-Z0-9]{16,}", HEX: r"[0-9a-f]{24,}"}
_ASSIGN_CHARS = 6

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits a character that a window of each class has to reach: (name, pattern of the whole string, bits).
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", 3.0),
    ("alnum", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 3.7),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.7),
    ("lower", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+=*$", 3.5),
    ("upper", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+=*$", 3.5),
    # Letters next to digits, unlike file names and titles with dates and numbers.
    ("lower_parts", r"^(?=.*(?:[0-9][a-z]|[a-z][0-9]))[a-z0-9+/_=-]+$", 3.7),
    ("upper_parts", r"^(?=.*(?:[0-9][A-Z]|[A-Z][0-9]))[A-Z0-9+/_=-]+$", 3.7),
    # Long words stay below.
    ("letters", r"^[A-Za-z]+=*$", 3.7),
)
# Stretches that are no secrets (UUIDs, placeholder words between separators, alphabets, digits
# in order), longest first, and how many characters each takes.
ALLOWED = (
    (r"(?i)(?<![0-9a-f])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-f])", 36),
    (r"(?i)abcdefghijklmnopqrstuvwxyz", 26),
    (r"(?i)(?<![A-Za-z0-9])placeholder(?![A-Za-z0-9])", 11),
    (r"(?i)abcdefghij", 10),
    (r"0123456789", 10),
    (r"(?i)(?<![A-Za-z0-9])example(?![A-Za-z0-9])", 7),
    (r"(?i)(?<![A-Za-z0-9])sample(?![A-Za-z0-9])", 6),
    (r"(?i)(?<![A-Za-z0-9])dummy(?![A-Za-z0-9])", 5),
    (r"(?i)(?<![A-Za-z0-9])your(?![A-Za-z0-9])", 4),
)
# The codes of the characters of candidates.
_FIRST, _LAST = ord("+"), ord("z")
BLOCK = 1024
_SPANS = "array<struct<start:int,kind_at:int,stop:int>>"


def _found(text: Column, pattern: str, kind: str, keep) -> Column:
    """Spans of the leftmost matches that ``keep``: the texts between them give the places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def add(at: Column, pair: Column) -> Column:
        start = at["at"] + F.length(pair["between"])
        stop = start + F.length(pair["match"])
        one = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_at"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(keep(pair["match"]), F.concat(at["spans"], one))
                        .otherwise(at["spans"]).alias("spans"))

    pairs = F.arrays_zip(matches.alias("match"), F.slice(between, 1, F.size(matches)).alias("between"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, add, lambda at: at["spans"])).otherwise(
        F.array().cast(_SPANS)
    )


def known_spans(text: Column) -> Column:
    """Spans of the known shapes."""
    long_enough = lambda m: F.length(F.regexp_extract(m, _ASSIGN, 2)) >= _ASSIGN_CHARS
    always = lambda m: F.lit(True)
    return F.array_sort(F.concat(*[
        _found(text, pattern, kind, long_enough if kind == ASSIGN else always) for kind, pattern in _PATTERNS.items()
    ]))


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The highest entropy, in bits a character, of any ``window`` characters in a row of a candidate."""
    logs = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])
    log = lambda n: F.element_at(logs, n + 1)
    places = _LAST - _FIRST + 1

    def events(b: Column) -> Column:
        """Who leaves and who comes, in order: place of the character, change, whether the window is full then."""
        codes = F.transform(F.filter(F.split(b, ""), lambda c: c != ""), lambda c: F.ascii(c) - _FIRST + 1)
        # Nobody leaves before the window is full; -1 fills it.
        behind = F.concat(F.array_repeat(F.lit(0), window - 1), F.array(F.lit(-1)), codes)
        change = lambda at, by, full: F.struct(at.alias("at"), F.lit(by).alias("by"), full.alias("full"))
        both = F.zip_with(codes, F.slice(behind, F.lit(1), F.length(b)), lambda comes, leaves: F.array(
            change(leaves, -1, F.lit(False)), change(comes, 1, leaves != 0)))
        return F.filter(F.flatten(both), lambda e: e["at"] > 0)

    def step(state: Column, e: Column) -> Column:
        counts, at = state["counts"], e["at"]
        n = F.element_at(counts, at)
        now = state["sum"] - log(n) + log(n + e["by"])
        return F.struct(
            F.concat(F.slice(counts, F.lit(1), at - 1), F.array(n + e["by"]), F.slice(counts, at + 1, places - at)).alias("counts"),
            now.alias("sum"), F.when(e["full"], F.least(state["least"], now)).otherwise(state["least"]).alias("least"))

    def block(b: Column) -> Column:
        start = F.struct(F.array_repeat(F.lit(0), places).alias("counts"), F.lit(0.0).alias("sum"),
                         F.lit(math.inf).alias("least"))
        return F.aggregate(events(b), start, step, lambda state: state["least"])

    stride = BLOCK - window + 1
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - window + 1, F.lit(1)), F.lit(stride))
    least = F.array_min(F.transform(starts, lambda s: block(F.substring(text, s, F.lit(BLOCK)))))
    return F.when(F.length(text) >= window, math.log2(window) - least / window).otherwise(0.0)


def blank(body: Column, spans: Column, mark) -> Column:
    """``body`` with ``mark(length)`` in place of each stretch that spans cover; they come by start."""

    def add(at: Column, span: Column) -> Column:
        fresh = F.greatest(at["at"], span["start"])
        gap = F.substring(body, at["at"] + 1, fresh - at["at"])
        return F.struct(F.greatest(at["at"], span["stop"]).alias("at"),
                        F.concat(at["out"], gap, mark(at, span, fresh)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, add, lambda at: F.concat(at["out"], F.substring(body, at["at"] + 1, F.length(body))))
    return F.when(F.size(spans) > 0, whole).otherwise(body)


def judged_text(text: Column, known: Column) -> Column:
    """``text`` with blanks over the ``known`` spans and allow-listed stretches; places stay."""
    rest = blank(text, known, lambda at, span, fresh: F.repeat(F.lit(" "), F.greatest(span["stop"] - fresh, F.lit(0))))
    for pattern, length in ALLOWED:
        rest = F.regexp_replace(rest, pattern, " " * length)
    return rest


def entropy_spans(rest: Column, allow: Sequence[str] = ()) -> Column:
    """Spans of candidates of high entropy in ``judged_text``. A candidate that a pattern of ``allow`` fits is
    let off whole."""

    def secret(candidate: Column) -> Column:
        need = F.lit(None).cast("double")
        for _, pattern, bits in reversed(CLASSES):
            need = F.when(candidate.rlike(pattern), bits).otherwise(need)
        allowed = F.lit(False)
        for pattern in allow:
            allowed = allowed | candidate.rlike(pattern)
        return need.isNotNull() & ~allowed & (window_entropy(candidate) >= need)

    return _found(rest, CANDIDATE, ENTROPY, secret)


def scan(df: DataFrame, *, text: str = "text", allow: Sequence[str] = ()) -> DataFrame:
    """Adds ``secrets``: an array of (start, kind_at, stop), by start, then kind as listed in ``KINDS``."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    known = df.withColumn("secrets", known_spans(whole))
    rest = "_rest"
    while rest.lower() in [c.lower() for c in df.columns]:
        rest += "_"
    judged = known.withColumn(rest, judged_text(whole, F.col("secrets")))  # a column: computed once
    return judged.withColumn("secrets", F.array_sort(F.concat("secrets", entropy_spans(F.col(rest), allow)))).drop(rest)


def redact(df: DataFrame, *, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` (a result of ``scan``) with ``mark`` in place of each stretch of secrets; a null text stays."""
    body = F.col(f"`{text}`")
    marked = lambda at, span, fresh: F.when(span["start"] >= at["at"], F.lit(mark)).otherwise("")
    return df.withColumn(text, blank(body, F.col("secrets"), marked))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind_at"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["kind_at"] < KINDS.index(ENTROPY))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind_at"] == KINDS.index(kind))).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in (ASSIGN, ACCESS, HEX)]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("secrets")).alias("spans"))
