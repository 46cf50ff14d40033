"""File-arrival triggers of the monthly runner.

``monthly_trigger`` calls back with the months of new files;
``incremental_trigger`` loads the files into the posting table and runs what
they make stale."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.functions.columns import yyyymm
from branchbook.plans import runner
from branchbook.sources import io
from branchbook.sources import schemas as S
from branchbook.sources.publish import Publisher, log_of


def batch_months(batch: DataFrame, date_col: str = "transaction_date") -> list[int]:
    """Distinct posting months of a micro-batch (one row per month reaches the
    driver: the months to run, a parameter list)."""
    return sorted(r[0] for r in batch.select(yyyymm(date_col).alias("m")).where(F.col("m").isNotNull())
                  .distinct().collect())


def monthly_trigger(spark: SparkSession, postings_dir: str, checkpoint: str,
                    run: Callable[[list[int]], object], reported: Callable[[], list[int]] = list, schema=S.TXN,
                    once: bool = True):
    """Watch ``postings_dir`` (Parquet files of decoded postings) and call
    ``run(months)`` after each batch of new files, for the months present in
    it and every month of ``reported()`` after the earliest of them: reports
    are cumulative, so a late posting makes all later ones stale.

    ``once=True`` processes everything that has arrived and stops
    (``availableNow``); ``once=False`` keeps running and returns the query.
    ``checkpoint`` must be a shared folder (on a cluster, under
    ``spark.checkpoint.dir``).
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        months = batch_months(batch)
        if months:
            run(sorted({*months, *(m for m in reported() if m > months[0])}))

    stream = spark.readStream.schema(schema).parquet(postings_dir)
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if once:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()


def incremental_trigger(spark: SparkSession, raw_dir: str, checkpoint: str, t: runner.Tables, months=(), once: bool = True):
    """Watch ``raw_dir`` (Parquet files of raw postings): each batch of new
    files is added to ``t.postings`` and the stale months run.

    The load and the run of a batch are commits named after it, so a batch that
    is tried again (after a lost driver) loads nothing twice: what was committed
    is skipped, what was not is in no commit log.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{checkpoint}#{batch_id}"
        if not Publisher(spark, log_of(t.postings)).has_commit(name):
            io.stage_postings(batch, t.postings, append=True, load_id=name, commit_id=name)
        runner.run_changed(spark, t, months, commit_id=name)

    writer = (spark.readStream.schema(S.TXN_RAW).parquet(raw_dir).writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    if once:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()
