"""Token counts by source, language and tokenizer version, kept by signed deltas.

The state is a folder with one subfolder a batch. A batch brings events on documents: ``upsert`` (insert, or
a revised count if the document is there) and ``delete``. Its signed deltas are rows per document: minus what
the earlier batches left standing, plus the new count. Beside them stands what they add to each group, so
totals are sums of a few rows a batch: neither documents nor their deltas are read again for them.

A batch is committed by writing its deltas and then its sums whole. It only looks at batches with a smaller
number, so committing it again, after a lost job or by mistake, writes the same rows to the same
place: totals do not change. Batches whose sums lack Spark's success mark are not read.

Defined cases: of several events of a batch on one document the one with the largest ``seq`` counts,
ties go to the larger token count, source, language and version, deletes last; repeated rows count once;
each upsert without a doc_id is a document of its own that no later event can name, a delete without one names
nothing; null source, language or version
are groups of their own; a null text has no tokens; deleting an unknown document changes
nothing; an empty batch commits and changes nothing; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import table, top_by
from skyledger.llm.vocabulary import public_path, rank_counter
from skyledger.session import scratch_path, stage_table

GROUP = ("source", "lang", "version")
_SUMS = "source string, lang string, version string, documents long, tokens long"
_DELTA = f"doc_id long, {_SUMS}"


def count_tokens(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang and the number of tokens of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = rank_counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts = [sum(found) for found in cache.lookup(some.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(counts, pa.int64())], names=["doc_id", "source", "lang", "tokens"]
                )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                            F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, source string, lang string, tokens long")


class TokenRollup:
    """Totals below ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _batches(self) -> list[int]:
        """Numbers of the committed batches."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(conf)
        if not files.exists(path):
            return []
        found = [s.getPath() for s in files.listStatus(path)]
        return sorted(
            int(p.getName().removeprefix("batch-")) for p in found
            if p.getName().startswith("batch-") and files.exists(jvm.org.apache.hadoop.fs.Path(p, "sums/_SUCCESS"))
        )

    def _read(self, part: str, schema: str, before: int | None = None) -> DataFrame:
        paths = [f"{self.root}/batch-{b}/{part}" for b in self._batches() if before is None or b < before]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def deltas(self, before: int | None = None) -> DataFrame:
        """Committed rows per document, of batches below ``before`` if given."""
        return self._read("deltas", _DELTA, before)

    def commit(self, batch: int, events: DataFrame) -> None:
        """Apply a batch: events have doc_id, seq, kind (upsert or delete), source, lang, version, tokens."""
        order = [F.col(c).desc_nulls_last() for c in ("seq", "tokens", "source", "lang", "version", "kind")]
        wanted = events.where("doc_id is not null").select("doc_id", "seq", "kind", *GROUP, "tokens")
        last = stage_table(top_by(wanted, ["doc_id"], order, 1, "n"), "events")
        # Merged whatever the sizes: a batch may bring as many ids as there are documents.
        touched = self.deltas(batch).join(last.select("doc_id").hint("merge"), "doc_id", "left_semi")
        standing = touched.groupBy("doc_id", *GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        minus = standing.select("doc_id", *GROUP, (-F.col("documents")).alias("documents"),
                                (-F.col("tokens")).alias("tokens"))
        plus = last.where(F.col("kind") == "upsert").select(
            "doc_id", *GROUP, F.lit(1).cast("long").alias("documents"),
            F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        )
        added = [F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")]
        changed = minus.unionByName(plus).groupBy("doc_id", *GROUP).agg(*added).where("documents <> 0 or tokens <> 0")
        folder = f"{self.root}/batch-{batch}"
        changed.write.mode("overwrite").parquet(f"{folder}/deltas")
        nameless = events.where("doc_id is null and kind = 'upsert'").select(
            *GROUP, F.lit(1).cast("long").alias("documents"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        rows = self.spark.read.schema(_DELTA).parquet(f"{folder}/deltas").drop("doc_id").unionByName(nameless)
        rows.groupBy(*GROUP).agg(*added).write.mode("overwrite").parquet(f"{folder}/sums")

    def totals(self) -> DataFrame:
        """Documents and tokens of each group that has documents."""
        return self._read("sums", _SUMS).groupBy(*GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        ).where("documents <> 0")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: all of them arrive; those labelled toxic are taken down; those
    labelled as of low quality come again, counted as lower-cased text under a new version. The second
    batch is committed twice."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    path = public_path("byte_bpe_50k.tiktoken")
    counted = stage_table(count_tokens(documents, path), "token_counts")
    rollup = TokenRollup(spark, scratch_path(spark, "token_rollup"))
    seq = F.lit(0).alias("seq")
    rollup.commit(1, counted.select("doc_id", seq, F.lit("upsert").alias("kind"), "source", "lang",
                                    F.lit("byte_bpe_50k/1").alias("version"), "tokens"))
    nothing = [F.lit(None).cast("string").alias(c) for c in GROUP]
    toxic = labels.where("toxic = 1").select(
        "doc_id", seq, F.lit("delete").alias("kind"), *nothing, F.lit(None).cast("long").alias("tokens")
    )
    rollup.commit(2, toxic)
    rollup.commit(2, toxic)
    low = labels.where("quality = 0 and toxic = 0").select("doc_id").distinct()
    # Counted before the join, which then moves counts and no texts; written, as a commit reads its events twice.
    lowered = count_tokens(documents.withColumn("text", F.lower("text")), path)
    again = stage_table(lowered.join(low.hint("merge"), "doc_id", "left_semi"), "counted_again")
    rollup.commit(3, again.select(
        "doc_id", seq, F.lit("upsert").alias("kind"), "source", "lang", F.lit("byte_bpe_50k/2").alias("version"), "tokens"
    ))
    return rollup.totals()
