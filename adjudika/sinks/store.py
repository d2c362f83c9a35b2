"""Parquet tables of tenders and their children.

Tenders are laid out by the publication month they had when first stored. That month never changes for a row, so an
upsert rewrites only the months it touches and no row can be left behind in another one. A month is rewritten whole: an update of
scattered references costs the bytes of all their months, once aside and once in place.

Beside the tenders lie their keys by hash prefix (``KeyTable``) and the ledger of runs. The keys are written after the rows; a run that broke off
in between shows in the ledger, and the next one makes them anew from the rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.operators.dedup import first_per_key, new_keys
from adjudika.operators.merge import counted, held_values, last_values, upsert
from adjudika.operators.quality import as_table
from adjudika.plans.summaries import READ, Summary, parts
from adjudika.schemas import CONSULTATIONS, TABLES
from adjudika.session import PACKED, cut_counted, cut_lineage, joined_where_they_lie, path_exists, work_dir
from adjudika.sinks.archive import PAGE_DAY
from adjudika.sinks.keys import PREFIXES, KeyTable
from adjudika.sinks.ledger import APPLIED, BEGUN, BROKEN, Run, RunLedger

KEY = "ref_consultation"
# ``lot_id``: the run that wrote the row last; ``seq``: its place among the runs, which guards the row against older ones.
_RUN = [T.StructField("lot_id", T.LongType(), True), T.StructField("seq", T.LongType(), True)]
_STORED = T.StructType([*CONSULTATIONS.fields, *_RUN, T.StructField("mois", T.StringType(), True)])
#: Tables whose rows the summary counts.
SUMMARISED = ("consultation", "attribution")
#: Rows in a slice of a folder, on average, when a folder is dealt out by reference.
SLICE_ROWS = 500_000
ARCHIVE = "content_md5 string, file_name string, copies bigint, html string, archive_date date"


class TenderStore:
    def __init__(self, spark: SparkSession, root: str, prefixes: int = PREFIXES, summarise: bool = False):
        """``prefixes``: folders of the key tables. ``summarise``: keep the report figures up to date with every write (``summary``)."""
        self.spark, self.root = spark, root.rstrip("/")
        self.summary = Summary(spark, self.path("summary")) if summarise else None
        self.ledger = RunLedger(spark, self.path("ledger"))
        self.keys = KeyTable(spark, self.path("keys"), KEY, f"{KEY} string, mois string, lot_id bigint", prefixes)
        self.archive_keys = KeyTable(spark, self.path("archive_keys"), "content_md5", "content_md5 string, file_name string, archive_date date", prefixes)

    def begin(self, kind: str, lot_id: int) -> Run:
        """Open a run, or find that it was applied before (``counters``). What a broken run left behind is put in order first."""
        run = self.ledger.look(kind, lot_id)
        if run.counters is not None:
            return run
        if run.broken or (self.keys.read() is None):
            self.rebuild_keys()
        if self.summary and (run.broken or not self.summary.exists()):
            self.summary.rebuild({kind: self.read(kind) for kind in SUMMARISED})
        self.ledger.note(*(r for r in run.broken if r[:2] != (kind, run.lot_id)), state=BROKEN)
        self.ledger.note((kind, run.lot_id, run.seq), state=BEGUN)
        return run

    def finish(self, run: Run, counters: dict[str, int]) -> None:
        self.ledger.note((run.kind, run.lot_id, run.seq), state=APPLIED, counters=counters)

    def rebuild_keys(self) -> None:
        """Make both key tables anew from the rows that are stored: a scan of the key columns."""
        self.keys.rebuild(self.read().select(KEY, "mois", "lot_id"))
        self.archive_keys.rebuild(self.archive().select("content_md5", "file_name", "archive_date"))

    def known(self, batch: DataFrame) -> DataFrame:
        """Stored keys ``(ref_consultation, mois, lot_id)`` in the hash prefixes of ``batch``."""
        return self.keys.lookup(batch.select(KEY))

    def path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def read(self, kind: str = "consultation") -> DataFrame:
        """The stored table; empty when nothing was stored yet."""
        schema = _STORED if kind == "consultation" else T.StructType(
            [*TABLES[kind].fields, T.StructField("lot_id", T.LongType(), True)])
        return self._read(self.path(kind), schema)

    def archive(self) -> DataFrame:
        """The page archive of this store."""
        return self._read(self.path("archive"), ARCHIVE)

    def _read(self, path: str, schema) -> DataFrame:
        if path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema).filter(F.lit(False))  # the planner knows it is empty: a join with it moves no row

    def insert_new(self, tenders: DataFrame, order: list[str], lot_id: int = 0, seq: int = 0) -> DataFrame:
        """Store the first record of every reference that is not stored yet. A repeated call stores nothing twice."""
        first = cut_lineage(first_per_key(tenders, [KEY], order), "first", PACKED)
        fresh = new_keys(first, self.known(first).hint("merge"), KEY)  # the keys of all tenders are no broadcast
        run = {"lot_id": F.lit(int(lot_id)).cast("bigint"), "seq": F.lit(int(seq)).cast("bigint")}
        rows = cut_lineage(self._dated(as_table(fresh, "consultation").withColumns(run)), "fresh", PACKED)
        self._by_month(rows).write.mode("append").partitionBy("mois").parquet(self.path("consultation"), compression=PACKED)
        self.keys.add(rows)
        if self.summary:
            self.summary.add(seq, parts(rows, "consultation"))
        return rows

    def upsert(self, tenders: DataFrame, order: list[str], now: Column, lot_id: int = 0, seq: int = 0) -> dict[str, int]:
        """Merge records into the table and return how many references were inserted and updated and how many rows kept.

        The references are matched on the key table; only the months found there, and the months of new tenders, are
        read in full and replaced. The list of months is bounded by the calendar. A month is replaced whole or not at all. Rows carry ``seq``, the
        number of the run that wrote them last: those that this run wrote before it broke off are left as they are, and those of a
        later run take nothing but values they lack.
        """
        typed = as_table(tenders, "consultation").select(
            *[c for c in CONSULTATIONS.fieldNames() if c != "date_derniere_maj"])
        extra = [c for c in order if c not in typed.columns]
        source = tenders.select(*(F.col(c).try_cast(CONSULTATIONS[c].dataType).alias(c) if c in CONSULTATIONS.fieldNames()
                                  and c in tenders.columns else F.lit(None).cast(CONSULTATIONS[c].dataType).alias(c)
                                  for c in typed.columns), *extra)
        incoming = cut_lineage(last_values(source, KEY, order, held_values(source)).drop(*extra), "upsert", PACKED)
        months = [r.mois for r in self._months(incoming).collect()]
        base = self.read().filter(F.col("mois").isin(months))
        # The result is written aside first: a task that is run again must not read a folder that is being replaced.
        merged, counts = cut_counted(upsert(base, incoming, KEY, now, seq=seq), "merged", PACKED, **counted())
        written = F.col("_action").isin("insert", "update")
        lot = F.when(written, F.lit(int(lot_id)).cast("bigint")).otherwise(F.col("lot_id"))
        rows = merged.withColumns({"lot_id": lot, "mois": F.coalesce("mois", self._month())})
        if self.summary:  # before the months are replaced: what stood there counts down
            old = base.join(incoming.select(KEY), KEY, "left_semi")
            self.summary.add(seq, parts(old, "consultation", -1), parts(rows.filter("_items > 0"), "consultation"))  # the merge marks what came in
        self._replace("consultation", rows.select(*_STORED.fieldNames()), "mois")
        self.keys.add(rows.filter("_action = 'insert'"))
        return counts

    def _months(self, incoming: DataFrame) -> DataFrame:
        """The months of stored references that ``incoming`` (unique by key) has, and those of new tenders.

        The join is a sorted one whatever its sides seem to weigh: next to the other columns of a wide file the keys look so
        small that a whole table of them would be broadcast through the driver.
        """
        met = self.known(incoming).join(incoming.select(KEY).hint("merge"), KEY, "left_semi").select("mois")
        return met.unionByName(self._dated(incoming).select("mois")).distinct()

    def append(self, kind: str, rows: DataFrame, lot_id: int, seq: int = 0) -> None:
        """Add children. One run writes one folder, which a repeated run replaces instead of adding to."""
        if self.summary and kind in SUMMARISED:
            before = self.read(kind).filter(F.col("lot_id") == int(lot_id))
            self.summary.add(seq, parts(before, kind, -1), parts(as_table(rows, kind), kind))
        as_table(rows, kind).write.mode("overwrite").parquet(f"{self.path(kind)}/lot_id={int(lot_id)}", compression=PACKED)

    def delete(self, refs: DataFrame) -> dict[str, int]:
        """Remove the references and all their children, and return how many rows of each table went.

        Children go first, so a delete that breaks off leaves no child without its tender; repeated, it finishes. Only the folders that hold
        such rows are read in full and replaced; a folder that is left without rows is replaced by an empty one.
        """
        last = self.ledger.runs().filter("kind = 'delete'").agg(F.max("lot_id")).first()[0]
        run = self.begin("delete", 0 if last is None else last + 1)
        gone, keys = {}, cut_lineage(refs.select(KEY).distinct(), "delete")
        kinds = [k for k in TABLES if k != "consultation"] + ["consultation"]
        doomed = {kind: self._doomed(kind, keys) for kind in kinds}
        if self.summary:
            self.summary.add(run.seq, *(parts(doomed[kind], kind, -1) for kind in SUMMARISED))
        for kind in kinds:
            part = self._part(kind)
            hit = {r[part]: r["n"] for r in doomed[kind].groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
            gone[kind] = sum(hit.values())
            if hit:
                with joined_where_they_lie(self.spark):
                    left = cut_lineage(self._without(self.read(kind).filter(F.col(part).isin(list(hit))), doomed[kind], part), "left", PACKED)
                self._replace(kind, left, part, dealt=True)
                held = {r[part] for r in left.select(part).distinct().collect()}
                for name in hit.keys() - held:
                    left.limit(0).drop(part).write.mode("overwrite").parquet(f"{self.path(kind)}/{part}={name}")
        self.keys.remove(keys, lambda df: cut_lineage(df, "keys"))
        self.finish(run, gone)
        return gone

    @staticmethod
    def _part(kind: str) -> str:
        return "mois" if kind == "consultation" else "lot_id"

    def _doomed(self, kind: str, keys: DataFrame) -> DataFrame:
        """The rows of a table that have one of the references: the reference, the folder, and what the summary counts of them."""
        used = READ[kind] if self.summary and kind in SUMMARISED else []
        return cut_lineage(self.read(kind).join(keys, KEY, "left_semi").select(KEY, self._part(kind), *used), "doomed", PACKED)

    @staticmethod
    def _without(rows: DataFrame, doomed: DataFrame, part: str) -> DataFrame:
        """The rows of whole folders without the doomed ones, which lie in the same folders.

        Whole rows move once: they are dealt out by folder and by a slice of its references, which serves the join (planned with
        ``joined_where_they_lie``) and leaves each task few folders to write. A large folder has more slices.
        """
        slices = F.broadcast(rows.groupBy(part).agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("bigint").alias("_slices")))  # one row a folder

        def sliced(df: DataFrame) -> DataFrame:
            cut = df.join(slices, part).withColumn("_slice", F.pmod(F.xxhash64(KEY), F.col("_slices")))
            return cut.drop("_slices").repartition(part, "_slice")  # both sides alike, so the join takes them as they lie

        # Not an anti join: the planner would move that below the dealing out, where it shuffles the rows by itself.
        marked = sliced(rows).join(sliced(doomed.select(KEY, part)).withColumn("_gone", F.lit(True)), [part, "_slice", KEY], "left")
        return marked.filter(F.col("_gone").isNull()).select(*rows.columns)

    def archive_days(self) -> list[dt.date]:
        """The days that the archive has a folder for: a listing of names."""
        folder, files = self._files("archive")
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith("archive_date="))

    def drop_archive(self, now: Column, months: int) -> list[dt.date]:
        """Drop the archive's folders of days more than ``months`` months before ``now`` and return those days.

        Folders go as a whole, by their names alone; the files of days that are kept are not touched. Records keep the paths they have (see
        ``dangling``). The key table of the archive is made anew without the dropped contents, so a page that comes again is archived again.
        """
        limit = self.spark.range(1).select((now - F.expr(f"INTERVAL {int(months)} MONTHS")).cast("timestamp_ntz")).first()[0]
        gone = [d for d in self.archive_days() if dt.datetime.combine(d, dt.time()) < limit]
        if gone:
            last = self.ledger.runs().filter("kind = 'rotation'").agg(F.max("lot_id")).first()[0]
            run = self.begin("rotation", 0 if last is None else last + 1)
            for day in gone:
                folder, files = self._files(f"archive/archive_date={day}")
                files.delete(folder, True)
            self.archive_keys.rebuild(self.archive().select("content_md5", "file_name", "archive_date"))
            self.finish(run, {"days": len(gone)})
        return gone

    def dangling(self) -> DataFrame:
        """Records whose page the archive no longer has, by the day in the page's name."""
        held = [str(d) for d in self.archive_days()]
        day = F.to_date(F.regexp_extract("page_html_archivee", PAGE_DAY, 1), "yyyyMMdd")
        return self.read().filter(F.col("page_html_archivee").isNotNull()).withColumn("jour", day).filter(~F.col("jour").cast("string").isin(held))

    def _files(self, name: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def fold_keys(self) -> None:
        """Rewrite the key tables with few files a prefix; for quiet hours."""
        for keys in (self.keys, self.archive_keys):
            keys.fold(f"{work_dir(self.spark, 'fold')}/table")

    def _replace(self, kind: str, rows: DataFrame, part: str, dealt: bool = False) -> None:
        """Replace the folders of a table that ``rows`` has rows for. ``dealt``: the rows lie by folder already and need not move."""
        rows = rows if dealt else rows.hint("rebalance", part)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part)
         .parquet(self.path(kind), compression=PACKED))

    @staticmethod
    def _month() -> Column:
        return F.coalesce(F.date_format("date_publication", "yyyy-MM"), F.lit("inconnu"))

    def _dated(self, df: DataFrame) -> DataFrame:
        return df.withColumn("mois", self._month())

    @staticmethod
    def _by_month(df: DataFrame) -> DataFrame:
        """Few files per month; AQE splits a month that is too large for one task."""
        return df.hint("rebalance", "mois")
