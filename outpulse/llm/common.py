"""What the operators of this subpackage share: table reading, row tasks, stable row order."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1000  # Arrow rows a Python worker holds at once


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of any frame that has them, other columns left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a folder of this machine is taken in local mode only; a
    cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="outpulse-llm-")
    return folder


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; what reads it survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a new folder of the shared one: typed, compressed and pruned when read."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def by_batch(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict[str, list]]) -> DataFrame:
    """Each Arrow batch of ``df`` through ``work``, which returns columns named as in ``schema``."""
    return by_task(df, schema, lambda batches: (work(b) for b in batches))


def by_task(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]]) -> DataFrame:
    """As ``by_batch``, but ``work`` sees all batches of a task, one after the other."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    fields = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])

    def run(batches):
        for columns in work(b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for judging: crc32 of its id as text leaves 2 modulo 4 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunk_bounds(ids: DataFrame, name: str, chunks: int) -> list[int]:
    """At most ``chunks`` - 1 increasing values that cut column ``name`` into about equal parts.

    Only these few numbers reach the driver; the quantiles come from a mergeable sketch.
    """
    if chunks < 2:
        return []
    steps = [i / chunks for i in range(1, chunks)]
    found = ids.agg(F.percentile_approx(name, F.array(*[F.lit(s) for s in steps]), F.lit(20 * chunks))).first()[0]
    return sorted(set(found or []))


def with_chunk(df: DataFrame, name: str, bounds: list[int], out: str = "chunk") -> DataFrame:
    """Adds the number of the part that column ``name`` falls in, ascending with it (null: 0)."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(splits=[float("-inf"), *map(float, bounds), float("inf")], inputCol="_cut", outputCol="_part", handleInvalid="keep")
    parts = cut.transform(df.withColumn("_cut", F.col(name).cast("double")))
    return parts.withColumn(out, F.when(F.col("_cut").isNull(), 0).otherwise(F.col("_part").cast("int"))).drop("_cut", "_part")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sample_labels(labels: DataFrame, target: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids of documents that may be learnt from, in hash order.

    An id with several labels counts once, with the larger label; other values
    than 0 and 1 and null ids are not labels.  Only the sample, ``rows`` pairs
    at most, is ever gathered.
    """
    kept = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    kept = kept.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    kept = kept.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = kept.count()
    if n > 2 * rows:  # twice the sample at least passes, so that no more than that meets in the sort
        kept = kept.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * 2 * rows / n))
    return kept.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of the sample; a repeated id gives one text, the least.

    The sample has at most ``rows`` ids and labels, so it may be broadcast.
    """
    few = F.broadcast(sample_labels(labels, target, rows))
    return texts(docs).join(few, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str) -> list[str]:
    """Runs of digits, letters a-z and all beyond ASCII, after lower-casing A-Z."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
