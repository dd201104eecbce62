"""Allow and block rules for URLs as a sort-merge range join.

A rule is a host and a path prefix; it fits its host and all subdomains. The canonical key of a
rule is its host's labels reversed, then its path: all keys that start with it form one interval
of the sorted keys. A URL is looked up under its host and each parent host (no more of them
than the rules have labels), each with the URL's path, so a rule fits exactly if one of these
keys lies in its interval.

Rules and URL keys are range-partitioned together and sorted. A sweep keeps the stack of rules
whose intervals are open; nested rules lie above each other, so the top one is the longest
that fits. A sweep starts with an empty stack; rules opened in an earlier partition are shorter
than any it finds itself, so only URL keys without a rule look at them afterwards. What a
partition tells the others is its first and last key and its open rules, a stack as deep as
rules nest. Keys end with the row's number: a host with a third of all URLs is many keys.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no rule;
repeated URLs are judged row by row; a rule with a null host fits nothing, a null path counts
as empty; of rules with the same host and path block wins; of fitting rules the longest string
wins, then the longer host; empty tables give the default verdicts or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import ascii_lower, table
from skyledger.session import stage_table

ALLOW, BLOCK = "allow", "block"

_SWEPT = "row long, key string, rule string, host string, verdict string, part int, last string, level int"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _rule_keys(rules: DataFrame) -> DataFrame:
    """One row a key: (key, rule, host, verdict)."""
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    named = rules.where(host.isNotNull()).select(
        F.concat(_reversed(F.split(host, r"\.")), F.lit("/"), path).alias("key"),
        F.concat(host, path).alias("rule"), host.alias("host"), "verdict",
    )
    return named.groupBy("key", "rule", "host").agg(
        F.max(F.when(F.col("verdict") == BLOCK, BLOCK).otherwise(ALLOW)).alias("verdict")
    )


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    stack: list[tuple[str, str, str, str]] = []
    first = last = None
    schema = pa.schema([("row", pa.int64()), ("key", pa.string()), ("rule", pa.string()), ("host", pa.string()),
                        ("verdict", pa.string()), ("part", pa.int32()), ("last", pa.string()), ("level", pa.int32())])
    for batch in batches:
        out = []
        for row, key, rule, host, verdict in zip(*(batch.column(i).to_pylist() for i in range(5))):
            first, last = key if first is None else first, key
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, host, verdict))
            elif stack:
                out.append((row, None, *stack[-1][1:], part, None, None))
            else:
                out.append((row, key, None, None, None, part, None, None))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
    if first is not None:
        told = [(None, first, None, None, None, part, last, -1)]
        told += [(None, *open_, part, None, level) for level, open_ in enumerate(stack)]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in told], schema=schema)


def _carried(told: list) -> list[tuple]:
    """For each partition the rules that are open where it starts: (part, key, rule, host, verdict)."""
    parts: dict[int, dict] = {}
    for r in told:
        one = parts.setdefault(r.part, {"open": []})
        if r.level == -1:
            one.update(first=r.key, last=r.last)
        else:
            one["open"].append((r.level, r.key, r.rule, r.host, r.verdict))
    out, stack = [], []
    for part in sorted(parts):
        stack = [r for r in stack if parts[part]["first"].startswith(r[0])]
        out += [(part, *r) for r in stack]
        stack = [r for r in stack if parts[part]["last"].startswith(r[0])]
        stack += [r[1:] for r in sorted(parts[part]["open"])]
    return out


def judge(urls: DataFrame, rules: DataFrame, *, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``urls`` with host, path, rule (null: none fits) and verdict. ``rules`` has host, path and
    verdict; it may be large, it is never broadcast whole. Columns of the input with these names
    are replaced."""
    spark = urls.sparkSession
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "__row")]
    rows = stage_table(
        urls.select(*[F.col(f"`{c}`") for c in kept], url_host(F.col(f"`{url}`")).alias("host"),
                    url_path(F.col(f"`{url}`")).alias("path"), F.monotonically_increasing_id().alias("__row")),
        "urls",
    )
    keyed = stage_table(_rule_keys(rules), "url_rules")
    most = keyed.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    depths = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))
    probes = rows.where((F.col("host") != "") & F.lit(most > 0)).select(
        F.col("__row").alias("row"), "path", labels.alias("labels"), F.explode(depths).alias("depth")
    ).select(
        "row",
        F.concat(_reversed(F.slice("labels", F.size("labels") - F.col("depth") + 1, F.col("depth"))), F.lit("/"),
                 "path").alias("key"),
        *[F.lit(None).cast("string").alias(c) for c in ("rule", "host", "verdict")],
    )
    both = probes.unionByName(keyed.select(F.lit(None).cast("long").alias("row"), "key", "rule", "host", "verdict"))
    swept = stage_table(
        both.repartitionByRange("key", F.col("row").asc_nulls_first())
        .sortWithinPartitions("key", F.col("row").asc_nulls_first())
        .select("row", "key", "rule", "host", "verdict").mapInArrow(_sweep, _SWEPT),
        "url_sweep",
    )
    carried = _carried(swept.where("level is not null").collect())
    open_ = spark.createDataFrame(carried, "p int, k string, rule string, host string, verdict string")
    late = swept.where("row is not null and rule is null").select("row", "key", "part").join(
        open_, (F.col("part") == F.col("p")) & F.col("key").startswith(F.col("k"))
    )
    found = swept.where("row is not null and rule is not null").select("row", "rule", "host", "verdict").unionByName(
        late.select("row", "rule", "host", "verdict")
    )
    best = found.groupBy("row").agg(
        F.max(F.struct(F.length("rule").alias("n"), F.length("host").alias("h"), "rule", "verdict")).alias("best")
    )
    joined = rows.join(best, rows["__row"] == best["row"], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


#: The rules of the registered query: (host, path, verdict).
RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")
