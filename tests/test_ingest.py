"""Ingest, store, streams and exports end to end on small inputs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from adjudika.plans import retention
from adjudika.plans.backfill import Backfill
from adjudika.plans.ingest import Ingest, dry_run
from adjudika.session import work_dir
from adjudika.sinks import archive, exports
from adjudika.sinks.store import TenderStore
from adjudika.sources import jsonl_records, new_arrivals, page_files
from adjudika.streaming import jobs

SCHEMA = ("ref_consultation string, titre string, organisme_acronyme string, type_marche string, statut string, "
          "date_publication timestamp_ntz, date_extraction timestamp_ntz, montant_estime string, arrivee int")


def batch(spark, *rows):
    out = []
    for i, (ref, titre, amount, month) in enumerate(rows):
        out.append((ref, titre, "ONEE", "travaux", "en_cours", dt.datetime(2025, month, 1), dt.datetime(2025, 6, 1), amount, i))
    return spark.createDataFrame(out, SCHEMA)


def ingest(spark, **options):
    return Ingest(TenderStore(spark, f"{work_dir(spark, 'test')}/store"), order=["arrivee"], **options)


def stored(job):
    return {r.ref_consultation: (r.titre, None if r.montant_estime is None else float(r.montant_estime), r.mois)
            for r in job.store.read().collect()}


def test_insert_only_is_idempotent_and_splits_rows(spark):
    job = ingest(spark)
    first = batch(spark, ("A", " t  1 ", "12,5", 1), ("A", "again", "1", 1), ("B", "", "1", 1), ("C", "c", "1e20", 2), ("D", "d", None, 2))
    counts = {r.issue: r.n for r in job.run(first, 0).collect()}
    assert counts == {"saved": 2, "duplicate": 1, "missing_required_field": 1, "database_error": 1}
    assert stored(job) == {"A": ("t 1", 12.5, "2025-01"), "D": ("d", None, "2025-02")}
    again = {r.issue: r.n for r in job.run(first, 0).collect()}
    assert again == counts and job.store.read().count() == 2
    assert spark.read.parquet(f"{job.store.path('quarantine')}").count() == 3
    other = {r.issue: r.n for r in job.run(first, 1).collect()}
    assert other == {"duplicate": 3, "missing_required_field": 1, "database_error": 1} and job.store.read().count() == 2


def test_identical_copies_are_stored_once(spark):
    job = ingest(spark)
    one = batch(spark, ("A", "t", "1", 1))
    counts = {r.issue: r.n for r in job.run(one.unionAll(one).unionAll(one), 0).collect()}
    assert job.store.read().count() == 1 and counts == {"saved": 1, "duplicate": 2}


def test_ties_and_missing_order_lose_no_record(spark):
    job = ingest(spark)
    rows = batch(spark, ("A", "x", "1", 1), ("A", "y", "2", 1), ("B", "b", "1", 1), ("C", "c", "1", 1), ("C", "d", "1", 1), ("C", "c", "1", 1))
    rows = rows.withColumn("arrivee", F.when(F.col("ref_consultation") == "A", 7).when(F.col("titre") == "d", 1))
    labelled = job.label(rows.unionAll(rows.filter("ref_consultation = 'B'")))
    got = sorted((r.ref_consultation, r.titre, r._reason) for r in labelled.collect() if r._reason is None)
    assert [g[0] for g in got] == ["A", "B", "C"] and got[2][1] == "d"
    counts = {r.issue: r.n for r in job.run(rows, 0).collect()}
    assert counts == {"saved": 3, "duplicate": 3} and job.store.read().count() == 3
    log = spark.read.parquet(job.store.path("extraction_log")).collect()
    assert [(r.items_extraits, r.items_inseres, r.items_mis_a_jour, r.erreurs, r.statut) for r in log] == [(6, 3, 0, 0, "success")]


def test_a_repeated_upsert_updates_nothing_twice(spark):
    job = ingest(spark, mode="upsert")
    times = [F.lit(f"2025-07-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2, 3)]
    job.run(batch(spark, ("A", "a", "1", 1)), 0, times[0])
    second = batch(spark, ("A", "a2", None, 1), ("B", "b", "1", 1))
    job.run(second, 1, times[1])
    before = sorted(map(tuple, job.store.read().collect()), key=str)
    job.run(second, 1, times[2])
    assert sorted(map(tuple, job.store.read().collect()), key=str) == before
    log = {r.lot_id: (r.items_inseres, r.items_mis_a_jour) for r in spark.read.parquet(job.store.path("extraction_log")).collect()}
    assert log == {0: (1, 0), 1: (1, 1)}


def test_an_old_run_repeated_after_a_newer_one_changes_nothing(spark):
    job = ingest(spark, mode="upsert")
    times = [F.lit(f"2025-07-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2, 3)]
    old, new = batch(spark, ("A", "old", "1", 1), ("B", "b", "1", 1)), batch(spark, ("A", "new", None, 1))
    first = job.run(old, 0, times[0]).collect()
    job.run(new, 1, times[1])
    before = sorted(map(tuple, job.store.read().collect()), key=str)
    assert job.run(old, 0, times[2]).collect() == first
    assert sorted(map(tuple, job.store.read().collect()), key=str) == before
    assert {(r.kind, r.lot_id, r.seq, r.state) for r in job.store.ledger.runs().collect()} == {("consultation", 0, 0, "applied"), ("consultation", 1, 1, "applied")}


@pytest.mark.parametrize("mode", ["upsert", "insert_only"])
def test_a_failure_between_any_two_writes_leaves_the_same_store(spark, mode):
    times = [F.lit(f"2025-07-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2, 3, 4)]
    batches = [batch(spark, ("A", "a", "1", 1), ("B", "b", "1", 2), ("B", "", "1", 2)), batch(spark, ("A", "a2", None, 1), ("C", "c", "1", 2), ("C", "c", "1", 2)),
               batch(spark, ("C", "c3", "3", 2), ("D", "d", "1", 3))]

    def final(job):
        tables = [job.store.read(), *(spark.read.parquet(job.store.path(t)) for t in ("quarantine", "extraction_log"))]
        rows = job.store.read().collect()
        assert sorted((r.ref_consultation, r.mois) for r in job.store.keys.read().collect()) == sorted((r.ref_consultation, r.mois) for r in rows)
        return [sorted((tuple(r) for r in t.collect()), key=str) for t in tables]

    whole = ingest(spark, mode=mode)
    counts = [whole.run(b, lot, times[lot]).collect() for lot, b in enumerate(batches)]
    want = final(whole)
    for step in ("labelled", "quarantine", "store", "log"):
        job = ingest(spark, mode=mode)
        job.run(batches[0], 0, times[0])

        def stop(done, step=step, job=job):
            if done == step:
                job.on_step = None
                raise InterruptedError

        job.on_step = stop
        with pytest.raises(InterruptedError):
            job.run(batches[1], 1, times[1])
        assert sorted(map(tuple, job.run(batches[1], 1, times[1]).collect())) == sorted(map(tuple, counts[1]))
        job.run(batches[2], 2, times[2])
        assert final(job) == want


def test_an_overtaken_run_brings_no_older_value(spark):
    job = ingest(spark, mode="upsert")
    times = [F.lit(f"2025-07-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2, 3)]
    job.on_step = lambda step: (_ for _ in ()).throw(InterruptedError) if step == "quarantine" else None
    old = batch(spark, ("A", "old", "1", 1), ("B", "b", "1", 1))
    with pytest.raises(InterruptedError):
        job.run(old, 0, times[0])
    job.on_step = None
    job.run(batch(spark, ("A", "new", None, 1)), 1, times[1])
    assert {r.lot_id: r.state for r in job.store.ledger.runs().collect()} == {0: "broken", 1: "applied"}
    job.run(old, 0, times[2])
    assert stored(job) == {"A": ("new", 1.0, "2025-01"), "B": ("b", 1.0, "2025-01")}
    assert {r.ref_consultation: (r.lot_id, r.seq) for r in job.store.read().collect()} == {"A": (1, 1), "B": (0, 0)}


def test_a_batch_reads_only_its_hash_prefixes(spark):
    store = TenderStore(spark, f"{work_dir(spark, 'test')}/store", prefixes=16)
    job = Ingest(store, order=["arrivee"])
    job.run(batch(spark, *((f"R{i}", "t", "1", 1 + i % 3) for i in range(200))), 0)
    asked = batch(spark, ("R1", "t", "1", 1), ("R7", "t", "1", 1), ("new", "t", "1", 1))
    found = store.known(asked)
    touched = set(store.keys.touched(asked))
    assert len(touched) <= 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [prefixe" in plan.replace("isnotnull(prefixe", "prefixe").replace("[cast(prefixe", "[prefixe") and "PushedFilters" in plan
    read = {int(r[0].split("prefixe=")[1].split("/")[0]) for r in store.keys.read().filter(F.col("prefixe").isin(list(touched))).select("_metadata.file_path").distinct().collect()}
    assert read <= touched and found.count() < 60 and {"R1", "R7"} <= {r.ref_consultation for r in found.collect()}
    counts = {r.issue: r.n for r in job.run(asked, 1).collect()}
    assert counts == {"duplicate": 2, "saved": 1} and store.read().count() == 201
    files = len(store.keys.read().select("_metadata.file_path").distinct().collect())
    before = sorted(map(tuple, store.keys.read().collect()))
    store.fold_keys()
    assert sorted(map(tuple, store.keys.read().collect())) == before and len(store.keys.read().select("_metadata.file_path").distinct().collect()) <= files


def test_a_backfill_goes_on_where_it_broke_off(spark):
    rows = batch(spark, *((f"R{i}", "t", "1", 1 + i % 12) for i in range(48)))
    whole, broken = (Backfill(ingest(spark), rows, days_per_run=90) for _ in range(2))
    assert whole.run(2025) == 5 and whole.run(2025) == 0
    assert broken.run(2025, groups=2) == 2 and broken.state(2025).filter("done").count() == 180
    broken.ingest.on_step = lambda step: (_ for _ in ()).throw(InterruptedError) if step == "log" else None
    with pytest.raises(InterruptedError):
        broken.run(2025)
    broken.ingest.on_step = None
    assert broken.run(2025) == 3 and broken.state(2025).filter("not done").count() == 0
    assert stored(broken.ingest) == stored(whole.ingest) and len(stored(whole.ingest)) == 48
    assert broken.state(2025).agg(F.sum("n")).first()[0] == 48


def test_rotation_drops_folders_and_touches_no_other_file(spark):
    job = ingest(spark)
    page = F.concat(F.lit("<p>"), F.col("ref_consultation"))
    days = [F.lit(f"2025-0{m}-15 00:00:00").cast("timestamp_ntz") for m in (1, 4, 6)]
    for lot, day in enumerate(days):
        job.run(batch(spark, (f"R{lot}", "t", "1", 1)).withColumn("page_html", page), lot, day)
    root = job.store.path("archive")

    def times():
        return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(root) for f in names if "2025-01" not in at and "=" in at}

    before = times()
    assert [str(d) for d in job.store.drop_archive(F.lit("2025-07-01 00:00:00").cast("timestamp_ntz"), 3)] == ["2025-01-15"]
    assert times() == before and [str(d) for d in job.store.archive_days()] == ["2025-04-15", "2025-06-15"]
    assert [r.ref_consultation for r in job.store.dangling().collect()] == ["R0"]
    html = {r.ref_consultation: r.html for r in archive.pages_at(job.store.read(), job.store.archive()).collect()}
    assert html == {"R0": None, "R1": "<p>R1", "R2": "<p>R2"}
    assert job.store.drop_archive(F.lit("2025-07-01 00:00:00").cast("timestamp_ntz"), 3) == []
    job.run(batch(spark, ("R9", "t", "1", 1)).withColumn("page_html", F.lit("<p>R0")), 9, days[2])
    assert {r.ref_consultation for r in job.store.dangling().collect()} == {"R0"} and job.store.archive().filter("html = '<p>R0'").count() == 1


def test_upsert_moves_nothing_between_months(spark):
    job = ingest(spark, mode="upsert")
    now = F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    job.run(batch(spark, ("A", "a", "1", 1), ("B", "b", "2", 2)), 0, now)
    job.run(batch(spark, ("A", "a2", None, 3), ("C", "c", "3", 2), ("C", "c2", None, 2)), 1, now)
    assert stored(job) == {"A": ("a2", 1.0, "2025-01"), "B": ("b", 2.0, "2025-02"), "C": ("c2", 3.0, "2025-02")}
    rows = {r.ref_consultation: r for r in job.store.read().collect()}
    assert rows["A"].date_publication == dt.datetime(2025, 3, 1) and rows["A"].date_derniere_maj and not rows["C"].date_derniere_maj


def test_stages_can_be_left_out_and_added(spark):
    job = ingest(spark, off=frozenset({"check", "dedup"}), extra_stages=[(50, "upper", lambda df: df.withColumn("titre", F.upper("titre")))])
    assert [s[1] for s in job.stages()] == ["upper", "validate", "clean", "archive", "parents"]
    assert [r.titre for r in dry_run(job, batch(spark, ("A", "x", "1", 1))).collect()] == ["X"]


def lots_of(spark, *rows):
    lots = spark.createDataFrame(list(rows), "ref_consultation string, numero_lot string, designation string")
    return lots.withColumn("date_extraction", F.lit("2025-01-01").cast("timestamp_ntz"))


def test_children_need_their_tender_and_replace_themselves(spark):
    tenders = ingest(spark)
    tenders.run(batch(spark, ("A", "a", "1", 1), ("B", "b", "1", 2)), 0)
    job = Ingest(tenders.store, kind="lot", order=["numero_lot"])
    lots = lots_of(spark, ("A", "1", "d"), ("A", "1", "d"), ("B", "", "e"), ("X", "1", "no tender"), ("B", "2", "f"))
    for run in (0, 0, 1):
        counts = {r.issue: r.n for r in job.run(lots, run).collect()}
        assert counts == {"saved": 3, "missing_required_field": 1, "database_error": 1}
    assert job.store.read("lot").count() == 6
    rejected = spark.read.parquet(job.store.path("quarantine")).filter("kind = 'lot' and lot_id = 1").collect()
    assert {(r.ref_consultation, r._reason, r._field) for r in rejected} == {("X", "database_error", "ref_consultation"), ("B", "missing_required_field", "numero_lot")}
    assert job.store.delete(spark.createDataFrame([("A",), ("Z",)], "ref_consultation string")) == {
        "lot": 4, "pv": 0, "attribution": 0, "achevement": 0, "consultation": 1}
    assert {r.ref_consultation for r in job.store.read("lot").collect()} == {"B"} == set(stored(tenders))
    job.store.delete(spark.createDataFrame([("B",)], "ref_consultation string"))
    assert job.store.read("lot").count() == 0 == job.store.read().count()


def test_children_with_a_key_are_stored_once(spark):
    tenders = ingest(spark)
    tenders.run(batch(spark, ("A", "a", "1", 1)), 0)
    job = Ingest(tenders.store, kind="lot", order=["designation"], child_key=["numero_lot"])
    job.run(lots_of(spark, ("A", "1", "x"), ("A", "1", "y"), ("A", "2", "z")), 0)
    counts = {r.issue: r.n for r in job.run(lots_of(spark, ("A", "2", "other"), ("A", "3", "z")), 1).collect()}
    assert counts == {"duplicate": 1, "saved": 1}
    assert sorted((r.numero_lot, r.designation) for r in job.store.read("lot").collect()) == [("1", "x"), ("2", "z"), ("3", "z")]


def test_records_name_the_archived_copy(spark):
    job = ingest(spark)
    page = F.when(F.col("ref_consultation").isin("A", "B"), "<p>same").when(F.col("ref_consultation") == "C", "<p>c")
    days = [F.lit(f"2025-07-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2)]
    job.run(batch(spark, ("A", "a", "1", 1), ("B", "b", "1", 1), ("D", "d", "1", 1)).withColumn("page_html", page), 0, days[0])
    job.run(batch(spark, ("C", "c", "1", 1)).withColumn("page_html", page).unionAll(
        batch(spark, ("E", "e", "1", 1)).withColumn("page_html", F.lit("<p>same"))), 1, days[1])
    paths = {r.ref_consultation: r.page_html_archivee for r in job.store.read().collect()}
    files = {f"{job.store.path('archive')}/{r.file_name}": r.html for r in job.store.archive().collect()}
    assert len(files) == 2 and {k: files.get(p) for k, p in paths.items()} == {"A": "<p>same", "B": "<p>same", "C": "<p>c", "D": None, "E": "<p>same"}
    count = job.store.archive().count()
    dry_run(job, batch(spark, ("F", "f", "1", 1)).withColumn("page_html", F.lit("<p>new"))).collect()
    assert job.store.archive().count() == count


def test_stream_ingest_over_several_runs(spark):
    home = work_dir(spark, "test")
    job = Ingest(TenderStore(spark, f"{home}/store"), order=["arrivee"])
    for rows in ((("A", "a", "1", 1), ("B", "b", "1", 1)), (("A", "other", "9", 1), ("C", "c", "1", 1))):
        batch(spark, *rows).write.mode("append").json(f"{home}/in")
        source = new_arrivals(spark, f"{home}/in", batch(spark, ("A", "a", "1", 1)).schema, max_files=1)
        jobs.ingest_arrivals(source, job, f"{home}/ckpt").awaitTermination()
    assert set(stored(job)) == {"A", "B", "C"} and stored(job)["A"][0] == "a"


def test_stream_windows_equal_batch_on_closed_windows(spark):
    home = work_dir(spark, "test")
    start = dt.datetime(2025, 1, 1)
    rows = [(start + dt.timedelta(seconds=97 * i), f"g{i % 2}") for i in range(200)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, g string")
    events.write.parquet(f"{home}/in")
    source = new_arrivals(spark, f"{home}/in", events.schema, "parquet")
    jobs.append_parquet(jobs.window_counts(source, ["g"]), f"{home}/out", f"{home}/ckpt").awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{home}/out").select("g", "debut", "fin", "n").collect()}
    limit = rows[-1][0] - dt.timedelta(minutes=10)
    want = {tuple(r) for r in jobs.window_counts(events, ["g"]).collect() if r.fin <= limit}
    assert got == want and got


def test_exports_keep_awkward_text(spark):
    rows = spark.createDataFrame([("R;1", ' a "b", \n c ', "O", None, None, dt.datetime(2025, 1, 1), None, None), ("R2", "é", "O", "travaux", "en_cours", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3, 10, 30), 0.0)],
                                 "ref_consultation string, titre string, organisme_acronyme string, type_marche string, statut string, date_publication timestamp_ntz, date_limite timestamp_ntz, montant_estime double")
    path = f"{work_dir(spark, 'test')}/csv"
    exports.tenders_csv(rows, path, cap=1)
    back = spark.read.options(**exports.CSV, multiLine="true").csv(path).collect()
    assert [(r.ref_consultation, r.titre, r.date_limite, r.montant_estime) for r in back] == [("R2", "é", "2025-01-03T10:30:00", None)]
    exports.full_csv(rows, path)
    full = spark.read.options(**exports.CSV, multiLine="true").csv(path)
    assert full.columns == list(exports.FULL_HEADERS.values()) and full.filter("`Référence` = 'R;1'").first()["Titre"] == ' a "b", \n c '


def test_a_bundle_is_packed_and_whole(spark, monkeypatch):
    """Rows, NULLs and awkward text come back from packed files of a bounded number of rows; the summary is plain."""
    monkeypatch.setattr(exports, "BUNDLE_ROWS", 300)
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 != 0, F.concat(F.lit('é "a"\n\\ '), F.col("id").cast("string"))).alias("titre"))
    path = f"{work_dir(spark, 'test')}/bundle"
    for _ in range(2):  # a repeated bundle replaces the first
        exports.run_bundle(path, spark.createDataFrame([(2000,)], "total bigint"), rows=rows, errors=rows.limit(0))
    back = spark.read.schema(rows.schema).json(f"{path}/rows")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) <= 300
    files = [f for f in os.listdir(f"{path}/rows".removeprefix("file:")) if f.startswith("part-")]
    plain = sum(len(r[0].encode()) + 1 for r in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())
    packed = sum(os.path.getsize(f"{path}/rows/{f}".removeprefix("file:")) for f in files)
    assert all(f.endswith(".json.gz") for f in files) and 3 * packed < plain
    assert spark.read.schema(rows.schema).json(f"{path}/errors").count() == 0
    assert [r[0] for r in spark.read.text(f"{path}/summary").collect()] == ['{"total":2000}']


def test_feeds(spark):
    path = work_dir(spark, "test")
    items = spark.createDataFrame([("é", None)], "a string, b string")
    assert exports.json_feed(items, f"{path}/f") and not exports.json_feed(items.limit(0), f"{path}/g")
    with pytest.raises(Exception, match="(?i)already exists"):
        exports.json_feed(items, f"{path}/f")
    assert json.loads(spark.read.text(f"{path}/f").first()[0]) == {"a": "é", "b": None}
    for overwrite, n in ((False, 2), (True, 1)):
        exports.jsonl_append(items, f"{path}/f", overwrite)
        assert spark.read.text(f"{path}/f").count() == n


def test_jsonl_reader_skips_blank_and_broken_lines(spark):
    path = f"{work_dir(spark, 'test')}/lines"
    lines = ['{"id": "a", "ref": "é"}', "", "   ", '{"id": "b", "re', '{"ref": "no id"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    assert sorted((r.id or "", r.ref) for r in jsonl_records(spark, path).collect()) == [("", "no id"), ("a", "é")]


def test_archive_holds_each_content_once(spark):
    path, stamp = f"{work_dir(spark, 'test')}/a", F.lit("2025-01-02 03:04:05").cast("timestamp_ntz")
    pages = spark.createDataFrame([("B", "<p>"), ("A", "<p>"), ("C", "<b>"), ("D", None)], "ref_consultation string, html string")
    archive.write_archive(pages, path, stamp)
    archive.write_archive(pages, path, stamp, spark.read.parquet(path))
    back = {r.html: (r.file_name, r.copies) for r in spark.read.parquet(path).collect()}
    assert set(back) == {"<p>", "<b>"} and back["<p>"][1] == 2 and back["<p>"][0].startswith("A_20250102_030405_")
    records = archive.archived_path(pages.withColumnRenamed("html", "page_html"), spark.read.parquet(path), "s3://x/").collect()
    assert {r.ref_consultation: r.page_html_archivee for r in records} == {
        "A": f"s3://x/{back['<p>'][0]}", "B": f"s3://x/{back['<p>'][0]}", "C": f"s3://x/{back['<b>'][0]}", "D": None}


def test_page_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>\n1</p>", encoding="utf-8")
    got = page_files(spark, str(tmp_path), "https://h/x/").first()
    assert got.url == "https://h/x/a.html" and got.html == "<p>\n1</p>"


def test_retention_and_calendar(spark):
    logs = spark.createDataFrame([(dt.datetime(2025, 1, 31),), (dt.datetime(2025, 6, 1),)], "d timestamp_ntz")
    now = F.lit("2025-07-31 00:00:00").cast("timestamp_ntz")
    assert retention.recent(logs, "d", now, 6).count() == 2 and retention.expired(logs, "d", now, 5).count() == 1
    assert retention.year_calendar(spark, 2024).count() == 366
    days = retention.backfill_state(logs, "d", 2025)
    assert days.count() == 365 and days.filter("not manquant").count() == 2


def test_work_dir_follows_the_session_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert not shared or work_dir(spark, "x").startswith(shared)


def test_upsert_broadcasts_no_keys(spark):
    """A wide file makes its keys look small: their join must not be chosen by that guess."""
    job = ingest(spark, mode="upsert")
    rows = spark.range(3000).select(
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("ref_consultation"), F.lit("t").alias("titre"), F.lit("O").alias("organisme_acronyme"),
        F.lit("travaux").alias("type_marche"), F.lit("en_cours").alias("statut"),
        *(F.lit("2025-01-01").cast("timestamp_ntz").alias(c) for c in ("date_publication", "date_extraction")), F.col("id").cast("int").alias("arrivee"))
    job.run(rows, 0)
    path = f"{work_dir(spark, 'test')}/wide"
    rows.withColumns({f"c{k}": F.lit("x" * 20) for k in range(20)}).write.parquet(path)
    months = job.store._months(spark.read.parquet(path))
    assert [r.mois for r in months.collect()] == ["2025-01"]
    assert "BroadcastHashJoin" not in months._jdf.queryExecution().executedPlan().toString()


def test_children_broadcast_no_keys(spark):
    """Packed files make places and keys look small: the joins of a batch must not be chosen by that guess, and an empty store costs none."""
    def plan(df, kind="executedPlan"):
        return getattr(df._jdf.queryExecution(), kind)().toString()

    ref = F.concat(F.lit("R"), F.col("id").cast("string")).alias("ref_consultation")
    stamp = F.lit("2025-01-01").cast("timestamp_ntz")
    tenders, children = ingest(spark), {"kind": "lot", "order": ["numero_lot"], "child_key": ["numero_lot"]}
    rows = spark.range(2000).select(
        ref, F.lit("t").alias("titre"), F.lit("O").alias("organisme_acronyme"), F.lit("travaux").alias("type_marche"), F.lit("en_cours").alias("statut"),
        stamp.alias("date_publication"), stamp.alias("date_extraction"), F.col("id").cast("int").alias("arrivee"))
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is chosen before anything has run
    try:
        tenders.store.begin("consultation", 0)
        first = tenders.label(rows, 0)
        assert plan(first, "optimizedPlan").count("Join") == 1  # the first of each key; nothing is stored to be met
        tenders.run(rows, 0)
        lots = spark.range(3000).select(ref, F.lit("1").alias("numero_lot"), F.lit("d").alias("designation"), stamp.alias("date_extraction"))
        job = Ingest(tenders.store, **children)
        job.run(lots.filter("id % 2 = 0"), 1)
        found = Ingest(tenders.store, **children, off=frozenset(["parents", "check"])).label(lots, 2)
        met = Ingest(tenders.store, **children, off=frozenset(["dedup", "check"])).label(lots, 2)
        again = tenders.label(rows, 1)
        for df, joins in ((found, 2), (met, 1), (again, 2)):
            assert plan(df).count("SortMergeJoin") == joins and "Broadcast" not in plan(df), plan(df)
        counts = {r.issue: r.n for r in job.run(lots, 2).collect()}
        assert counts == {"saved": 1000, "duplicate": 1000, "database_error": 1000}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)


def test_calendar_query_counts_every_order(spark):
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    days = entry.queries()["bck_calendar"](spark, sf_dir).collect()
    assert sum(r.n for r in days) == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert {r.jour.year for r in days if not r.manquant} == set(range(min(r.jour.year for r in days), max(r.jour.year for r in days) + 1))


def test_a_merge_into_nothing_moves_no_row(spark, tmp_path):
    """What a store has not got yet is known to be empty when the merge is planned: no join, so no exchange for it."""
    from adjudika.operators.merge import upsert

    stored = TenderStore(spark, str(tmp_path / "new")).read()
    batch = spark.createDataFrame([("A", "t")], "ref_consultation string, titre string")
    plan = upsert(stored, batch, "ref_consultation", F.lit(None))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.ref_consultation, r.titre, r["_action"]) for r in plan.collect()] == [("A", "t", "insert")]


def test_a_delete_moves_whole_rows_once(spark, monkeypatch):
    """The rows that stay are dealt out by folder and slice, and neither the join nor the write moves them again."""
    from adjudika.session import joined_where_they_lie
    from adjudika.sinks import store

    monkeypatch.setattr(store, "SLICE_ROWS", 7)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(60).selectExpr("concat('R', id % 40) ref_consultation", "concat('m', id % 3) mois", "id")
    doomed = rows.filter("id % 40 < 9").select("ref_consultation", "mois")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joined_where_they_lie(spark):
            left = TenderStore._without(rows, doomed, "mois")
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.id for r in left.collect()) == [k for k in range(60) if k % 40 >= 9]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "REPARTITION_BY_COL" in line]
    other = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ref_consultation" in line]
    assert len(wide) == 2 and other == [], plan  # the rows, and beside them the references
