"""Labelling as a stream: files of labelled chunks arrive, quotas are counted or enforced by state, and the run ends when they are filled. The checkpoint is what a run resumes from."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tamis.operators.labeling import not_done
from tamis.workspace import shared_dir


def count_quotas(stream: DataFrame, path: str, checkpoint: str, flag_col: str = "flag") -> None:
    """Counts per flag of everything that has arrived, as a table at path; runs until what is there has been read, and takes up from the checkpoint when called again."""
    counts = stream.groupBy(F.col(flag_col).alias("flag")).agg(F.count("*").alias("n"))

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()


def admit(rows: pd.DataFrame, n: int, admitted: set, target: int, rfp: str) -> tuple[pd.DataFrame, int]:
    """Rows sorted by package: those of packages that were admitted before, or that are met while fewer than `target` rows are taken; and how many are taken then. Adds to admitted."""
    sizes = rows.groupby(rfp, sort=False).size()
    for package, size in sizes.items():
        if package in admitted or n < target:
            admitted.add(package)
            n += int(size)
    return rows[rows[rfp].isin(admitted)], n


def gate_quotas(stream: DataFrame, targets: dict[str, int], rfp: str = "rfp_id", order: str = "seq", flag: str = "flag") -> DataFrame:
    """The rows (flag, rfp, order) of a stream that a run takes which looks for a flag only while it has taken fewer than its target before the current package, with `taken`: how many of the flag are taken after their batch.

    The state of a flag is its count and the packages that were let in, as many as the target at most; so a package that goes on
    in a later batch, or after a restart from the checkpoint, goes on, and only the last one let in overshoots. Within a batch,
    packages come in their order. Flags without a target pass. While a flag is open its rows of one batch are sorted in a task:
    bound the batches by the reader's maxFilesPerTrigger or maxBytesPerTrigger. After that rows are only looked up. For append
    mode; rows without a flag or package are left out.
    """
    schema = stream.select(flag, rfp, order).schema
    kinds = [f.dataType.simpleString() for f in schema]

    def gate(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, admitted = (state.get[0], set(state.get[1])) if state.exists else (0, set())
        target = targets.get(key[0])
        if target is not None and n < target:
            parts = iter([pd.concat(list(parts)).sort_values([rfp, order], kind="stable")])
        out = []
        for rows in parts:
            rows, n = admit(rows, n, admitted, n if target is None else target, rfp) if target is not None else (rows, n + len(rows))
            out.append(rows)
        state.update((n, sorted(admitted)))
        for rows in out:
            yield rows.assign(taken=n)

    rows = stream.select(flag, rfp, order).where(F.col(flag).isNotNull() & F.col(rfp).isNotNull())
    return rows.groupBy(flag).applyInPandasWithState(gate, f"`{flag}` {kinds[0]}, `{rfp}` {kinds[1]}, `{order}` {kinds[2]}, taken bigint", f"n bigint, admitted array<{kinds[1]}>", "append", GroupStateTimeout.NoTimeout)


def write_gated(gated: DataFrame, path: str, checkpoint: str) -> None:
    """A gated stream as a Parquet table; runs until what is there has been read. The sink's log and the checkpoint take each batch once."""
    gated.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def label_until(stream: DataFrame, label: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: list[str], done: Callable[[DataFrame], bool], summary: Callable[[DataFrame], DataFrame] | None = None, already: DataFrame | None = None) -> int:
    """label(batch) for rows whose key has not come before, batch by batch, until done(summaries) says so; returns the batches written.

    Keys that came before are the stream's own state; already: a table of keys that other runs have done. A batch is written to
    a folder of its own below path, and what summary() says of it (its rows, if none is given) beside it: done() reads a few
    rows a batch, not the output. A batch that a run has written whole before it ended is not labelled again.
    """
    spark, written = stream.sparkSession, [0]
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    summary = summary or (lambda rows: rows.agg(F.count("*").alias("n")))
    summaries = f"{path.rstrip('/')}-summaries"

    def there(at: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(at)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    def write(batch: DataFrame, n: int) -> None:
        own, told, work = (f"{at}/run={run}/batch={n}" for at in (path, summaries, f"{path.rstrip('/')}-work"))
        whole = there(f"{own}/_SUCCESS")
        if whole or there(f"{told}/_SUCCESS") or (there(summaries) and done(spark.read.parquet(summaries))):
            batch.write.format("noop").mode("overwrite").save()  # the state takes note of keys that are not labelled, too
        else:
            batch.write.mode("overwrite").parquet(work)  # read once, however often label() reads it
            todo = spark.read.schema(batch.schema).parquet(work)
            label(not_done(todo, already, key) if already is not None else todo).write.mode("overwrite").parquet(own)
            whole = True
        if not whole or there(f"{told}/_SUCCESS"):
            return
        summary(spark.read.parquet(own)).write.mode("overwrite").parquet(told)
        written[0] += 1

    stream.dropDuplicates(key).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return written[0]


def quotas_filled(targets: dict[str, int]) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], bool]]:
    """(summary, done) for label_until(): counts per flag of labelled rows (flags), `no_flag` for rows without; done when each flag has its target."""

    def summary(rows: DataFrame) -> DataFrame:
        shown = F.when(F.size("flags") > 0, F.col("flags")).otherwise(F.array(F.lit("no_flag")))
        return rows.select(F.explode(shown).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))

    def done(summaries: DataFrame) -> bool:
        n = {r["flag"]: r["n"] for r in summaries.groupBy("flag").agg(F.sum("n").alias("n")).where(F.col("flag").isin(list(targets))).collect()}
        return all(n.get(f, 0) >= target for f, target in targets.items())

    return summary, done


def file_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, a file or a folder of files, as a stream of its files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{name}").schema)
    return reader.parquet(f"{folder}/{name}") if status.isDirectory() else reader.option("pathGlobFilter", name).parquet(folder)


def event_quotas(spark: SparkSession, folder: str, name: str = "events.parquet", flag_col: str = "event_type") -> DataFrame:
    """(flag, n) of an events table, read as a stream of files."""
    base = f"{shared_dir(spark)}/quotas-{uuid.uuid4().hex}"
    count_quotas(file_stream(spark, folder, name), f"{base}/counts", f"{base}/checkpoint", flag_col)
    return spark.read.parquet(f"{base}/counts")
