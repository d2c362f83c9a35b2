"""The ingest: ordered stages over a batch of records, then the store.

A stage is ``DataFrame -> DataFrame``. Checks only label rows (``_reason``, ``_field``), so a batch can be split into
good and quarantined rows at the end and counted in between.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.operators import quality as Q
from adjudika.operators.dedup import label_duplicates
from adjudika.plans.reports import item_counters
from adjudika.session import PACKED, cut_counted, cut_lineage
from adjudika.sinks.archive import archived_path, write_archive
from adjudika.sinks.store import KEY, TenderStore

Stage = Callable[[DataFrame], DataFrame]
SAVED = "saved"
OUTCOMES = (SAVED, Q.MISSING, Q.DUPLICATE, Q.DATABASE)
RUN_LOG = ("date_execution timestamp_ntz, spider_name string, statut string, items_extraits bigint, items_inseres bigint, "
           "items_mis_a_jour bigint, erreurs bigint")


@dataclass
class Ingest:
    """Settings of an ingest run. ``order`` is the arrival order of records; ``off`` names stages to leave out."""

    store: TenderStore
    kind: str = "consultation"
    order: list[str] = field(default_factory=lambda: ["date_extraction"])
    mode: str = "insert_only"  # or "upsert"
    off: frozenset[str] = frozenset()
    # Children only: columns that tell a child from its siblings; None stores every child of every run.
    child_key: list[str] | None = None
    extra_stages: list[tuple[int, str, Stage]] = field(default_factory=list)
    # Called with the name of each write that is done (labelled, quarantine, store, log).
    on_step: Callable[[str], None] | None = None

    def stages(self) -> list[tuple[int, str, Stage]]:
        """All stages by order number. Validation comes before cleaning, as on the portal side."""
        steps = [
            (100, "validate", lambda df: Q.check_required(df, self.kind)),
            (200, "clean", self._clean),
            (300, "dedup", self._dedup),
            (400, "archive", self._archive),
            (440, "parents", self._parents),
            (450, "check", lambda df: Q.check_storable(df, self.kind)),
        ]
        return sorted((s for s in steps + self.extra_stages if s[1] not in self.off), key=lambda s: s[0])

    def label(self, batch: DataFrame, lot_id: int = 0, now: Column | None = None) -> DataFrame:
        self._lot, self._now = int(lot_id), F.localtimestamp() if now is None else now
        for _, _, stage in self.stages():
            batch = batch.transform(stage)
        return batch

    def run(self, batch: DataFrame, lot_id: int, now: Column | None = None) -> DataFrame:
        """Label, archive, quarantine and store one batch, write its run log; returns the item counters by type and outcome.

        ``lot_id`` names the run: one that was applied before, last or long ago, changes nothing and returns its counters without reading the
        batch. A run that broke off is taken up again by repeating it: a batch is held against what *other* runs have stored, and rows of its own
        run are neither stored nor updated again. Rows that a later run has written in between keep its values.
        """
        run = self.store.begin(self.kind, lot_id)
        if run.counters is not None:
            return self._counters(run.counters)
        now = now if now is not None else F.localtimestamp()
        started = self.store.spark.range(1).select(now.alias("t")).first().t
        now = F.lit(started).cast("timestamp_ntz")  # one instant for all jobs of the run: names of archived pages are made in two of them
        # Written once, and counted while it is written: quarantine, store and counters all go by the same labels.
        outcomes = {f"n{k}": F.count_if(F.coalesce("_reason", F.lit(SAVED)) == name) for k, name in enumerate(OUTCOMES)}
        labelled, seen = cut_counted(self.label(batch, lot_id, now), "ingest", PACKED, n=F.count(F.lit(1)), **outcomes)
        counters = {name: seen[f"n{k}"] for k, name in enumerate(OUTCOMES)}
        if sum(counters.values()) < seen["n"]:  # a stage of the caller has reasons of its own
            counters = {r.issue: r.n for r in item_counters(labelled.withColumn("_type", F.lit(self.kind))).collect()}
        counters = {name: n for name, n in counters.items() if n}
        self._done("labelled")
        rejected = Q.quarantined(labelled)
        rejected.write.mode("overwrite").parquet(f"{self.store.path('quarantine')}/kind={self.kind}/lot_id={int(lot_id)}")
        self._done("quarantine")
        good = Q.good(labelled)
        saved = counters.get(SAVED, 0)
        stored = {"inserted": saved, "updated": 0}
        if self.kind != "consultation":
            self.store.append(self.kind, good, lot_id, run.seq)
        elif self.mode == "upsert":
            stored = self.store.upsert(good, self.order, now, lot_id, run.seq)
        else:
            self.store.insert_new(good, self.order, lot_id, run.seq)
        self._done("store")
        self._log(counters, stored, lot_id, started)
        self._done("log")
        self.store.finish(run, counters)
        return self._counters(counters)

    def _done(self, step: str) -> None:
        if self.on_step:
            self.on_step(step)

    def _counters(self, counters: dict[str, int]) -> DataFrame:
        rows = [(self.kind, issue, n) for issue, n in counters.items()]
        return self.store.spark.createDataFrame(rows, "_type string, issue string, n bigint")

    def _log(self, counters: dict[str, int], stored: dict[str, int], lot_id: int, started) -> None:
        """One run-log row per run, which a repeated run replaces."""
        errors = sum(n for issue, n in counters.items() if issue not in (SAVED, Q.DUPLICATE))
        status = ("partial" if counters.get(SAVED) else "failed") if errors else "success"
        row = (started, self.kind, status, sum(counters.values()), stored["inserted"], stored["updated"], errors)
        self.store.spark.createDataFrame([row], RUN_LOG).write.mode("overwrite").parquet(
            f"{self.store.path('extraction_log')}/kind={self.kind}/lot_id={int(lot_id)}")

    def _others(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        """Keys that other runs have stored: of tenders, only those in the hash prefixes of the batch are read."""
        stored = self.store.known(batch) if self.kind == "consultation" else self.store.read(self.kind)
        chosen = stored.filter(F.coalesce(F.col("lot_id") != self._lot, F.lit(True))).select(*keys)
        return chosen.distinct() if len(keys) > 1 else chosen

    def _archive(self, df: DataFrame) -> DataFrame:
        """Raw pages go to the archive, one copy per content, and the record keeps the path."""
        if "page_html" not in df.columns:
            return df
        df = cut_lineage(df.withColumn("content_md5", F.md5("page_html")), "pages")
        kept = df.filter(F.col("_reason").isNull()) if "_reason" in df.columns else df
        index = self.store.archive_keys
        pages = kept.filter(F.col("page_html").isNotNull())
        write_archive(pages.select(KEY, F.col("page_html").alias("html"), "content_md5"), self.store.path("archive"), self._now,
                      index.lookup(pages.select("content_md5")), index)
        held = df.filter(F.col("content_md5").isNotNull()).select("content_md5")
        return archived_path(df.drop("page_html_archivee"), index.lookup(held), self.store.path("archive"))

    def _parents(self, df: DataFrame) -> DataFrame:
        """Children of tenders that are not stored are refused, as a foreign key does."""
        if self.kind == "consultation":
            return df
        if "_reason" not in df.columns:
            df = df.withColumns({"_reason": F.lit(None).cast("string"), "_field": F.lit(None).cast("string")})
        df = cut_lineage(df, "children", PACKED)
        known = self.store.known(df.filter(F.col("_reason").isNull())).select(KEY, F.lit(True).alias("_known")).hint("merge")  # as in ``_dedup``
        orphan = F.col("_reason").isNull() & F.col("_known").isNull()
        return df.join(known, KEY, "left").withColumns({
            "_reason": F.when(orphan, F.lit(Q.DATABASE)).otherwise(F.col("_reason")),
            "_field": F.when(orphan, F.lit(KEY)).otherwise(F.col("_field"))}).select(*df.columns)

    def _clean(self, df: DataFrame) -> DataFrame:
        if "page_html" not in df.columns:
            return Q.clean_record(df)
        whole = df.withColumn("page_html", F.struct(F.col("page_html").alias("raw")))  # a raw page stays as it is
        return Q.clean_record(whole).withColumn("page_html", F.col("page_html.raw"))

    def _dedup(self, df: DataFrame) -> DataFrame:
        """Within the batch, and against what other runs stored: tenders by reference unless it is an upsert, children by ``child_key``."""
        keys = [KEY] if self.kind == "consultation" else [KEY, *self.child_key] if self.child_key else None
        if keys is None or (self.kind == "consultation" and self.mode == "upsert"):
            return df
        if "_reason" not in df.columns:
            df = df.withColumns({"_reason": F.lit(None).cast("string"), "_field": F.lit(None).cast("string")})
        # The branches below read the batch several times; without this each would extract and clean it again.
        df = cut_lineage(df, "clean", PACKED)
        kept, out = df.filter(F.col("_reason").isNull()), df.filter(F.col("_reason").isNotNull())
        stored = self._others(kept, keys)
        first = label_duplicates(kept, keys, self.order)
        same = reduce(lambda a, b: a & b, [first[k].eqNullSafe(F.col(f"_s.{k}")) for k in keys])
        # Sorted, as the keys of a whole table would be broadcast through the driver wherever its packed columns make them look small.
        met = first.join(stored.withColumn("_stored", F.lit(True)).hint("merge").alias("_s"), same, "left")
        reason = F.coalesce("_reason", F.when(F.col("_stored"), F.lit(Q.DUPLICATE)))
        return met.select(*[reason.alias(c) if c == "_reason" else first[c] for c in df.columns]).unionByName(out)


def dry_run(ingest: Ingest, batch: DataFrame) -> DataFrame:
    """Labels only, nothing stored and no page archived."""
    return replace(ingest, off=ingest.off | {"archive"}).label(batch)
