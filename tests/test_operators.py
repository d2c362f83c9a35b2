"""Operator laws, checked against brute force on small inputs with hot keys and identical copies."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adjudika.operators import dedup, filters, merge, nesting, relations
from adjudika.operators import quality as Q
from adjudika.operators.running import held, on_timeline, sliding, span, timeline
from adjudika.plans import listings as L


def children(spark):
    rows = [("hot", "1", "x")] * 40 + [("hot", str(i), "y") for i in range(30)] + [(f"k{i}", "1", "z") for i in range(25)]
    return spark.createDataFrame(rows, "ref string, no string, label string").repartition(6), rows


@pytest.mark.parametrize("part_size", [1000, 8])
def test_nest_keeps_every_child_in_full_parts(spark, part_size):
    df, rows = children(spark)
    results = []
    for layout in (df, df.repartition(2), df.coalesce(1)):
        got = nesting.nest(layout, "ref", ("no", "label"), "items", part_size).collect()
        results.append(sorted((r.ref, r.part, [tuple(i) for i in r["items"]]) for r in got))
    assert results[0] == results[1] == results[2]
    assert Counter((ref, *i) for ref, _, items in results[0] for i in items) == Counter(rows)
    assert all(items == sorted(items) for _, _, items in results[0])
    sizes = {(ref, part): len(items) for ref, part, items in results[0]}
    hot = [sizes[k] for k in sorted(k for k in sizes if k[0] == "hot")]
    assert hot == ([70] if part_size == 1000 else [8] * 8 + [6]) and all(part == 0 for ref, part in sizes if ref != "hot")


def test_attach_aligns_relations_and_gives_empty_arrays(spark):
    df, _ = children(spark)
    a = nesting.nest(df, "ref", ("no",), "a", 8)
    b = nesting.nest(df.filter("ref like 'k%'"), "ref", ("label",), "b", 8)
    parents = spark.createDataFrame([("hot",), ("k1",), ("none",)], "ref string")
    got = nesting.attach(parents, "ref", a, b).collect()
    assert sum(len(r.a) for r in got if r.ref == "hot") == 70
    none = [r for r in got if r.ref == "none"]
    assert len(none) == 1 and none[0].a == [] and none[0].b == [] and none[0].part == 0
    assert [len(r.b) for r in got if r.ref == "k1"] == [1]


def test_dossier_equals_nested_relations_and_scans_each_once(spark, tmp_path):
    df, rows = children(spark)
    df.write.parquet(str(tmp_path / "c"))
    parents = spark.createDataFrame([(k, f"p{k}") for k in ("hot", "k1", "k2", "none")], "ref string, label string")
    parents.write.parquet(str(tmp_path / "p"))
    stored, parents = (spark.read.parquet(str(tmp_path / n)) for n in "cp")
    relations = {"a": (stored, ("no", "label")), "b": (stored.filter("ref like 'k%'"), ("label",))}
    for part_size in (1000, 8):
        whole = nesting.dossier(parents, "ref", relations, part_size)
        got = {(r.ref, r.part): r for r in whole.collect()}
        for name in relations:
            nested = {(r.ref, r.part): r[name] for r in nesting.nest(*relations[name][:1], "ref", relations[name][1], name, part_size).collect()}
            assert {k: r[name] for k, r in got.items() if r[name]} == {k: v for k, v in nested.items() if k[0] in ("hot", "k1", "k2")}
        assert got["none", 0].a == [] == got["none", 0].b and {r.label for k, r in got.items() if k[0] == "hot"} == {"phot"}
        final = whole._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        if part_size == 1000:  # no key is large: one scan a relation, one of the parents
            assert final.count("FileScan parquet") == 3, final


def arrivals(spark):
    rows = [("hot", i % 17, f"v{i % 5}") for i in range(60)] + [("a", 2, "x"), ("a", 1, None), ("b", 1, "y"), ("b", 1, "y")]
    return spark.createDataFrame(rows, "ref string, at int, v string").repartition(5), rows


def test_first_per_key_is_the_first_and_repeatable(spark):
    df, rows = arrivals(spark)
    once = dedup.first_per_key(df, ["ref"], ["at"])
    got = {r.ref: r.at for r in once.collect()}
    assert got == {"hot": 0, "a": 1, "b": 1} and once.count() == 3
    assert dedup.first_per_key(df.repartition(2), ["ref"], ["at"]).exceptAll(once).isEmpty()
    assert dedup.first_per_key(once, ["ref"], ["at"]).exceptAll(once).isEmpty()


def test_label_duplicates_keeps_all_rows(spark):
    df, rows = arrivals(spark)
    unique = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], "ref string, at int, v string, id int")
    got = dedup.label_duplicates(unique, ["ref"], ["at", "id"]).collect()
    assert len(got) == len(rows) and sum(r._reason is None for r in got) == 3
    earlier = dedup.label_duplicates(unique.withColumn("_reason", F.when(F.col("ref") == "a", "other")), ["ref"], ["at", "id"])
    assert {r._reason for r in earlier.filter("ref = 'a'").collect()} == {"other"}


def test_canonical_links_without_any_complete_link_keeps_all(spark):
    links = spark.createDataFrame([("/x",), ("/x",), ("/y?refConsultation=1",)], "url string")
    got = dedup.canonical_links(links).collect()
    assert sorted(r.url for r in got) == ["/x", "/x", "/y?refConsultation=1"] and {r.dropped for r in got} == {0}
    mixed = links.unionAll(spark.createDataFrame([("/z?refConsultation=1&orgAcronyme=o",), ("/w?orgAcronyme=o&refConsultation=1",)], "url string"))
    got = dedup.canonical_links(mixed).collect()
    assert [(r.ref, r.org, r.n, r.dropped) for r in got] == [("1", "o", 2, 3)]


def test_merge_equals_applying_rows_one_by_one(spark):
    stored = {"a": ("t", 1.0), "b": ("u", None)}
    batch = [("a", 3, None, 9.0), ("a", 1, "x", 2.0), ("c", 2, None, None), ("c", 5, "n", None), ("a", 4, None, None)]
    want = {k: list(v) for k, v in stored.items()}
    for ref, _, t, m in sorted(batch, key=lambda r: r[1]):
        row = want.setdefault(ref, [None, None])
        row[0], row[1] = t if t is not None else row[0], m if m is not None else row[1]
    old = spark.createDataFrame([(k, *v, None) for k, v in stored.items()], "ref string, t string, m double, date_derniere_maj timestamp_ntz")
    new = merge.last_values(spark.createDataFrame(batch, "ref string, at int, t string, m double"), "ref", ["at"]).drop("at")
    merged = merge.upsert(old, new, "ref", F.lit("2025-01-01").cast("timestamp_ntz"))
    got = {r.ref: r for r in merged.collect()}
    assert {k: [r.t, r.m] for k, r in got.items()} == want
    assert {k: r._action for k, r in got.items()} == {"a": "update", "b": "keep", "c": "insert"}
    assert got["b"].date_derniere_maj is None and got["c"].date_derniere_maj is None and got["a"].date_derniere_maj
    counts = merge.merge_counts(merged).first()
    assert (counts.inserted, counts.updated, counts.kept) == (1, 4, 1)


def test_merge_with_nothing_new_changes_nothing(spark):
    old = spark.createDataFrame([("a", "t")], "ref string, t string")
    new = spark.createDataFrame([("a", None)], "ref string, t string")
    assert merge.upsert(old, new, "ref", F.lit(None)).select("ref", "t").collect() == old.collect()


def test_relations(spark):
    kids = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "ref string, n int")
    parents = spark.createDataFrame([("a",)], "ref string")
    assert relations.with_parent(kids, parents, "ref").count() + relations.orphans(kids, parents, "ref").count() == 3
    assert [r.n for r in relations.cascade_delete(kids, parents, "ref").orderBy("n").collect()] == [2, 3]


def test_validation_rules(spark):
    rows = spark.createDataFrame([("R", "T", "O"), ("R", "", "O"), ("R", "T", None), ("R", "  ", "O"), (None, None, None)],
                                 "ref_consultation string, titre string, organisme_acronyme string")
    got = [r._field for r in Q.check_required(rows, "consultation").collect()]
    assert got == [None, "titre", "organisme_acronyme", None, "ref_consultation"]
    labelled = Q.check_required(rows, "consultation")
    assert Q.good(labelled).count() + Q.quarantined(labelled).count() == 5
    lots = spark.createDataFrame([("R", "1", "d" * 5), ("R", "x" * 21, "d")], "ref_consultation string, numero_lot string, designation string")
    assert [r._field for r in Q.check_storable(lots.withColumn("date_extraction", F.localtimestamp()), "lot").collect()] == [None, "numero_lot"]
    missing = Q.check_required(spark.createDataFrame([("R",)], "ref_consultation string"), "lot").first()
    assert missing._reason == Q.MISSING and missing._field == "numero_lot"


def test_cleaning_reads_text_amounts(spark):
    rows = spark.createDataFrame([("  Test   avec   espaces  ", "1 234 567,89"), ("t", "12,5")], "titre string, montant_estime string")
    assert [tuple(r) for r in Q.clean_record(rows).collect()] == [("Test avec espaces", None), ("t", 12.5)]


def test_filters_and_paging(spark):
    rows = spark.createDataFrame([(f"r{i}", "O%_x" if i == 3 else "Oabx", dt.datetime(2025, 1, 1 + i // 2, 12 * (i % 2)), None)
                                  for i in range(10)], "ref_consultation string, organisme_acronyme string, date_publication timestamp_ntz, x string")
    assert filters.contains(rows, "organisme_acronyme", "o%_x").count() == 10
    assert filters.contains(rows, "organisme_acronyme", "o%_x", literal=True).count() == 1
    assert filters.contains(rows, "organisme_acronyme", "").count() == 10
    assert filters.between(rows, "date_publication", dt.date(2025, 1, 2), dt.date(2025, 1, 3)).count() == 3
    assert filters.between(rows, "date_publication", dt.date(2025, 1, 2), dt.date(2025, 1, 3), whole_end_day=True).count() == 4
    pages = [[r.ref_consultation for r in filters.page(rows, "date_publication", ["ref_consultation"], 4, o).collect()] for o in (0, 4, 8)]
    assert sum(pages, []) == [f"r{i}" for i in range(9, -1, -1)]
    for limit, offset in ((0, 0), (1001, 0), (5, -1)):
        with pytest.raises(ValueError):
            filters.page(rows, "date_publication", [], limit, offset)
    with pytest.raises(ValueError):
        L.search_tenders(rows, "ab")
    assert filters.any_present(spark.createDataFrame([("", None), ("a", "")], "a string, b string"), "a", "b").count() == 1


def t(minute):
    return dt.datetime(2025, 1, 1, 23, 0) + dt.timedelta(minutes=minute)


def test_sliding_and_hold_against_brute_force(spark):
    """Counts across midnight, events before the time line, a hold that is broken once."""
    events = {-7: 2, -1: 1, 3: 4, 58: 1, 59: 1, 61: 5, 90: 1}
    counts = spark.createDataFrame([("s", t(m), n) for m, n in events.items()], "g string, at timestamp_ntz, n bigint")
    spine = timeline(counts, ["g"], F.lit(t(0)), F.lit(t(120)), span(minutes=1))
    series = on_timeline(spine, [sliding(counts, "at", "n", span(minutes=10), span(minutes=1), "v")], ["g"], ["v"])
    got = {r.t: r.v for r in series.collect()}
    want = {t(m): sum(n for e, n in events.items() if m - 10 <= e < m) for m in range(121)}
    assert got == want
    alerts = held(series.withColumn("cond", F.col("v") == 0), ["g"], span(minutes=5), span(minutes=1))
    firing = {r.t: r.firing for r in alerts.collect()}
    assert firing == {t(m): m >= 5 and all(want[t(k)] == 0 for k in range(m - 5, m + 1)) for m in range(121)}


def test_dossier_moves_small_keys_once_and_large_ones_in_the_same_parts(spark, tmp_path, monkeypatch):
    spark.range(600).selectExpr("CASE WHEN id < 90 THEN 'hot' WHEN id < 130 THEN 'warm' ELSE 'k' || id % 50 END AS ref",
                                "id % 41 AS no", "cast(id as string) AS label").write.parquet(f"{tmp_path}/c")
    children = spark.read.parquet(f"{tmp_path}/c")
    parents = spark.createDataFrame([(r,) for r in ("hot", "warm", "k7", "none")], "ref string")
    relations = {"a": (children, ("no",)), "b": (children.filter("no % 2 = 0"), ("no", "label"))}
    rows = nesting.dossier(parents, "ref", relations, 8)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # contents travel once
    whole = sorted(map(repr, rows.collect()))
    for size in (0, 60):  # all keys, or one, by slices
        monkeypatch.setattr(nesting, "ROW_SIZE", size)
        assert sorted(map(repr, nesting.dossier(parents, "ref", relations, 8).collect())) == whole


def test_the_fold_carries_one_rank_for_all_columns_that_are_never_null(spark):
    rows = [("A", 1, "x", None, 1.0, None), ("A", 3, "y", "n", 2.0, None), ("A", 2, "z", "m", None, None), ("B", 1, "b", None, None, None),
            ("A", 3, "y", None, 3.0, None)]
    batch = spark.createDataFrame(rows, "ref string, at int, t string, u string, m double, leer string")
    held = merge.held_values(batch)
    assert held == {"_rows": 5, "ref": 5, "at": 5, "t": 5, "u": 2, "m": 3, "leer": 0}
    slim, wide = merge.last_values(batch, "ref", ["at"], held), merge.last_values(batch, "ref", ["at"])
    assert slim.dtypes == wide.dtypes and sorted(map(repr, slim.collect())) == sorted(map(repr, wide.collect()))
    ranks = [f._jdf.queryExecution().optimizedPlan().toString().count("max_by(") for f in (slim, wide)]
    assert ranks == [3, 5]  # at and t together, u, m
    none = merge.last_values(batch.limit(0), "ref", ["at"], merge.held_values(batch.limit(0)))
    assert none.dtypes == wide.dtypes and none.count() == 0
