"""Month tables whose changes become visible all at once.

A write never touches what readers see.  It adds a *version* folder
``<table>/version=<id>/slot=<month>/`` with the rows of the months it brings,
and nothing more.  ``commit`` then appends **one** file to a commit log; its
rows say, for every table and slot of the run, which version is the live one
from now on.  Readers resolve the log first and open the live folders only.  So
a run that is killed between two months, or between two tables, leaves readers
on the old set, and what it had written is in no log entry (``vacuum`` removes
it).  The log itself is a Parquet table of one row per table and slot changed,
bounded by calendar months times runs, whatever the size of the data; a file
appears in it by one rename of Spark's commit protocol.

A slot is a month (``202301``) or, for rows without one, ``undated:<load>``: a
load replaces the months it brings and its own undated rows, never those of
another load.  ``adds`` entries add a version to a slot instead of replacing it.

Months are written by as many tasks as their bytes ask for: rows are rebalanced
by slot, so adaptive execution cuts a large month into tasks of the advisory
size and puts small months together.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDATED = "undated"
SLOT = "slot"

COMMITS = T.StructType([
    T.StructField("seq", T.LongType()),             # order of the commits (time of the commit in ns)
    T.StructField("commit_id", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("table_path", T.StringType()),
    T.StructField("slot", T.StringType()),
    T.StructField("version", T.StringType()),       # NULL: the slot is empty from now on
    T.StructField("adds", T.BooleanType()),
    T.StructField("fingerprint", T.StringType()),   # of the slot's rows in this version, where asked for
])


@dataclass(frozen=True)
class Entry:
    table: str
    slot: str
    version: str | None
    adds: bool = False
    fingerprint: str | None = None


def fingerprints(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """slot and an order-free fingerprint of its rows: their number and the sums
    of two 64-bit hashes.  Partial sums: one row per slot and task is shuffled."""
    cols = [F.col(f"`{c}`") for c in (columns or [c for c in rows.columns if c != SLOT])]
    total = lambda h: F.sum(h.cast("decimal(38,0)")).cast("string")
    return rows.groupBy(SLOT).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), total(F.xxhash64(*cols)),
                                              total(F.xxhash64(F.lit(1), *cols))).alias("fingerprint"))


@dataclass
class Publisher:
    """Stages versions of tables and commits them together through one log.

    One publisher writes to a log at a time (as one transaction at a time
    replaces a month); any number of readers may read meanwhile.
    """
    spark: SparkSession
    log: str
    pending: list[Entry] = field(default_factory=list)

    # -- the log -----------------------------------------------------------
    def entries(self) -> list[Entry]:
        """Committed entries, oldest first (one row per slot changed by a run)."""
        df = self.spark.read.schema(COMMITS).parquet(self.log)
        rows = df.orderBy("seq", "commit_id").collect()
        return [Entry(r.table_path, r.slot, r.version, r.adds, r.fingerprint) for r in rows]

    def committed(self) -> list[Entry]:
        try:
            return self.entries()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def live(self, table: str, pending: bool = True) -> dict[str, list[Entry]]:
        """Slot -> its live entries (with those of this run that are not
        committed yet, unless ``pending`` is false)."""
        out: dict[str, list[Entry]] = {}
        for e in [*self.committed(), *(self.pending if pending else [])]:
            if e.table == table:
                out[e.slot] = [*(out.get(e.slot, []) if e.adds else []), e]
        return out

    def has_commit(self, commit_id: str) -> bool:
        """Whether a commit of this name was made (a retried load asks first)."""
        try:
            return not self.spark.read.schema(COMMITS).parquet(self.log).where(F.col("commit_id") == commit_id).isEmpty()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def commit(self, commit_id: str | None = None) -> None:
        """Make everything staged since the last commit visible, in one step."""
        if not self.pending:
            return
        now, seq, commit_id = dt.datetime.now(dt.timezone.utc), time.time_ns(), commit_id or uuid.uuid4().hex
        rows = [(seq, commit_id, now, e.table, e.slot, e.version, e.adds, e.fingerprint) for e in self.pending]
        self.spark.createDataFrame(rows, COMMITS).coalesce(1).write.mode("append").parquet(self.log)
        self.pending.clear()

    # -- writing -----------------------------------------------------------
    def stage(self, df: DataFrame, table: str, month_col: str, months: Iterable[int] | None = None, adds: bool = False,
              load_id: str | None = None, fingerprint: bool = False, derive: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
        """Write ``df`` as a new version of its months; returns the slots written.

        ``months``: exactly these months are replaced (one that has no rows
        becomes empty); rows of others are left out.  Without it, the months
        that ``df`` brings and its undated rows are replaced (``adds``: added
        to).  ``load_id`` names the load for its undated rows; by default it is
        their fingerprint, so that the same load run again replaces itself.
        ``derive``: the stored rows from rows of ``df`` (it keeps ``slot``, if
        there); applied where they are written, so that only ``df`` moves.
        """
        version = uuid.uuid4().hex
        if months is not None:
            months = sorted({int(m) for m in months})
            df = df.where(F.col(month_col).isin(months))
        stored = derive(df) if derive else df
        folder = f"{table}/version={version}"
        rows = df.withColumn(SLOT, F.coalesce(F.col(month_col).cast("string"), F.lit(UNDATED))).hint("rebalance", SLOT)
        rows = derive(rows) if derive else rows
        rows.write.option("compression", "zstd").partitionBy(SLOT).parquet(folder)
        # the slots written are the folders of the version
        written = sorted(n.removeprefix(f"{SLOT}=") for n in self._folders(folder, f"{SLOT}="))
        files = self.spark.read.schema(T.StructType([*stored.schema.fields, T.StructField(SLOT, T.StringType())]))
        own = f"{UNDATED}:{load_id}"
        if UNDATED in written and not load_id:
            total = F.sum(F.xxhash64(*[f"`{c}`" for c in stored.columns]).cast("decimal(38,0)"))
            n, h = files.parquet(folder).where(F.col(SLOT) == UNDATED).agg(F.count(F.lit(1)), total).first()
            own = f"{UNDATED}:{n}-{h}"
        prints = {}
        if fingerprint and written:
            prints = {r[SLOT]: r.fingerprint for r in fingerprints(files.parquet(folder), stored.columns).collect()}     # one row per slot
        for s in written:
            self.pending.append(Entry(table, own if s == UNDATED else s, version, adds, prints.get(s)))
        for m in months or []:
            if str(m) not in written:
                self.pending.append(Entry(table, str(m), None))
        return [own if s == UNDATED else s for s in written]

    # -- reading -----------------------------------------------------------
    def read(self, table: str, schema: T.StructType | None, months: Iterable[int] | None = None, upto: int | None = None,
             pending: bool = True) -> DataFrame:
        """The live rows: all, of ``months``, or of months up to ``upto``
        (the last two leave undated rows out).  Only live folders of those
        months are listed and opened."""
        wanted = None if months is None else {str(int(m)) for m in months}

        def asked(slot: str) -> bool:
            if wanted is not None:
                return slot in wanted
            return upto is None or not slot.startswith(UNDATED) and int(slot) <= upto

        paths = [f"{table}/version={e.version}/{SLOT}={UNDATED if s.startswith(UNDATED) else s}"
                 for s, found in sorted(self.live(table, pending).items()) if asked(s) for e in found if e.version]
        if not paths and schema is not None:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(*paths)

    def fingerprint(self, table: str) -> dict[str, str]:
        """Slot -> fingerprint of its live content (dated slots that hold rows)."""
        return {s: "+".join(sorted(e.fingerprint or e.version for e in found))
                for s, found in self.live(table).items() if found[-1].version and not s.startswith(UNDATED)}

    def vacuum(self, table: str) -> list[str]:
        """Delete the version folders that no live slot names (replaced ones and
        what killed runs left).  Not while a run writes or an old reader reads."""
        keep = {e.version for found in self.live(table).values() for e in found}
        gone = [n for n in self._folders(table, "version=") if n.removeprefix("version=") not in keep]
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(table)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for n in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(root, n), True)
        return gone

    def _folders(self, path: str, prefix: str) -> list[str]:
        """Names of the folders in a folder that begin so (bounded by versions, or by calendar months)."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return [n for n in found if n.startswith(prefix)]


def log_of(table: str) -> str:
    """The commit log of a table that is loaded on its own."""
    return f"{table}/_commits"


def open_table(spark: SparkSession, table: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The live rows of a loaded table; a plain Parquet folder (no commit log)
    is read as it is."""
    p = Publisher(spark, log_of(table))
    if p.committed():
        return p.read(table, schema, upto=upto)
    return spark.read.schema(schema).parquet(table)

