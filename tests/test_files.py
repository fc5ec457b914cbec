"""Readers on small folders, streams with restarts, and a whole batch."""

import json

from pyspark.sql import functions as F

from stratloom import vocab
from stratloom.operators import jobs as j
from stratloom.sources import readers, writers
from stratloom.streaming import jobs as st


def put(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj, ensure_ascii=False), encoding="utf-8")


def test_pages(spark, tmp_path):
    put(tmp_path / "arch/a.json", {"path": "/x/Том 1.pdf", "page_from": 0, "pages": [{"idx": 0, "text": "раз"}, {"idx": 1, "text": "два"}]})
    put(tmp_path / "img/b.json", {"path": "/x/Том 2.pdf", "pages": [{"idx": 5, "text": "три"}]})
    put(tmp_path / "img/broken.json", '{"path": "/x", "pages": [')
    rows = readers.read_ocr_pages(spark, str(tmp_path), ["arch", "img"]).collect()
    assert sorted((r.run, r.path, r.idx, r.text) for r in rows) == [
        ("arch", "/x/Том 1.pdf", 0, "раз"), ("arch", "/x/Том 1.pdf", 1, "два"), ("img", "/x/Том 2.pdf", 5, "три")]


def test_jobs(spark, tmp_path):
    put(tmp_path / "j1/status.json", {"job_id": "j1", "filename": "a.pdf", "status": "ready"})
    put(tmp_path / "j2/status.json", {"filename": "b.pdf", "status": "queued"})
    put(tmp_path / "j1/proposals.json", [{"locality": "А", "lat": 50.5, "lon": 40.1}])
    put(tmp_path / "j2/proposals.json", {"proposals": [{"locality": "Б"}, {"locality": "В", "pages": [1, 2]}]})
    put(tmp_path / "j1/decisions.json", {"0": {"verdict": "accept", "user": "u", "ts": 5}})
    s, p, d = readers.read_jobs(spark, str(tmp_path))
    assert sorted((r.job_id, r.status) for r in s.collect()) == [("j1", "ready"), ("j2", "queued")]
    assert sorted((r.job_id, r.i, r.p.locality) for r in p.collect()) == [("j1", 0, "А"), ("j2", 0, "Б"), ("j2", 1, "В")]
    assert [(r.job_id, r.i, r.verdict, r.reviewer) for r in d.collect()] == [("j1", 0, "accept", "u")]


def test_small_maps(spark, tmp_path):
    put(tmp_path / "dem.json", {"50.123456,40.5": 100.5, "bad": 1, "a,b": 2})
    assert [(r.lat5, r.lon5, r.v) for r in readers.read_sidecar(spark, str(tmp_path / "dem.json")).collect()] == [(50.12346, 40.5, 100.5)]
    put(tmp_path / "idx.json", {"Том.pdf": {"3": "scans/3.jpg"}})
    assert [tuple(r) for r in readers.read_scan_index(spark, str(tmp_path / "idx.json")).collect()] == [("Том.pdf", 3, "scans/3.jpg")]
    put(tmp_path / "scans/slug1/p7.lines.json", {"w": 10, "h": 20, "lines": [["текст", 1, 2, 3, 4]]})
    assert [tuple(r) for r in readers.read_line_boxes(spark, str(tmp_path / "scans")).collect()] == [("slug1", 7, 10, 20, 0, "текст", 1, 2, 3, 4)]
    put(tmp_path / "corr/50.140.2.json", [{"verdict": "partial", "comment": "c", "user": "u", "ts": 1}])
    assert [(r.marker_key, r.verdict) for r in readers.read_corrections(spark, str(tmp_path / "corr")).collect()] == [("50.140.2", "partial")]
    put(tmp_path / "pl.json", {"m": [{"src": "a", "pages": [1, 2], "approx": True}]})
    assert sorted(tuple(r) for r in readers.read_page_links(spark, str(tmp_path / "pl.json")).collect()) == [("m", "a", 1, True), ("m", "a", 2, True)]


def test_csv_with_mark_and_broken_line(spark, tmp_path):
    put(tmp_path / "r.csv", "﻿ID,N\n1,\n2,50.5,extra,cells\n3,51\n")
    assert [tuple(r) for r in readers.read_results_csv(spark, str(tmp_path / "r.csv"), ["ID", "N"]).collect()] == [("1", ""), ("3", "51")]


def _proposals(spark, rows):
    arr = F.array(F.lit("x"))
    base = spark.createDataFrame(rows, "job_id string, i int, locality string, lat double, lon double")
    cols = {c: arr for c in ("excavation", "geomorph", "deposits", "raw_terms", "strat", "dating", "source_kinds", "evidence")}
    return base.select("*", F.lit("ND").alias("admin"), F.lit("10-20").alias("elevation"), F.array(F.lit("studied: 5 м")).alias("thickness"),
                       F.lit(1).alias("n_records"), *[c.alias(k) for k, c in cols.items()])


def _master(spark, tmp_path):
    status = spark.createDataFrame([("j1", "a.pdf"), ("j2", "b.pdf")], "job_id string, filename string")
    seed = j.master_rows(_proposals(spark, [("seed", 0, "Отказное", 43.3, 43.6)]), status)
    path = str(tmp_path / "master")
    writers.write_table(seed.withColumn("job_id", F.lit(None).cast("string")).withColumn("i", F.lit(None).cast("int")), path)
    return status, path


def test_merge_stream_is_idempotent(spark, tmp_path):
    status, master = _master(spark, tmp_path)
    inbox, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    first = _proposals(spark, [("j1", 0, "отказное", 43.301, 43.6), ("j1", 1, "Новое", 45.0, 45.0)])
    first.coalesce(1).write.parquet(inbox)
    sink = st.MergeSink(spark, master, ledger, lambda rows: j.master_rows(rows, status))
    stream = lambda: spark.readStream.schema(first.schema).parquet(inbox)
    st.run_once(stream(), sink, str(tmp_path / "ckpt"))
    first.write.mode("append").parquet(inbox)                       # the same proposals once more, and one new
    _proposals(spark, [("j2", 0, "Другое", 46.0, 46.0)]).write.mode("append").parquet(inbox)
    st.run_once(stream(), sink, str(tmp_path / "ckpt"))             # restart from the checkpoint
    st.run_once(stream(), sink, str(tmp_path / "other-ckpt"))       # and everything again from the start
    rows = spark.read.parquet(master).filter("job_id is not null").orderBy("job_id", "i").collect()
    assert [(r.job_id, r.i) for r in rows] == [("j1", 0), ("j1", 1), ("j2", 0)]
    assert (rows[0].lat, rows[0].lon) == (43.3, 43.6) and rows[0].sources == "a.pdf" + vocab.UPLOAD_MARK
    assert spark.read.parquet(ledger).count() == 3


def test_crash_between_master_and_ledger(spark, tmp_path):
    status, master = _master(spark, tmp_path)
    sink = st.MergeSink(spark, master, str(tmp_path / "ledger"), lambda rows: j.master_rows(rows, status))
    batch = _proposals(spark, [("j1", 0, "Новое", 45.0, 45.0)])
    sink(batch, 0)
    again = st.MergeSink(spark, master, str(tmp_path / "lost-ledger"), lambda rows: j.master_rows(rows, status))
    again(batch, 0)
    assert spark.read.parquet(master).filter("job_id = 'j1'").count() == 1


def test_status_stream(spark, tmp_path):
    schema = "job_id string, updated bigint, status string, msg string"
    inbox = str(tmp_path / "s")
    sink = st.StatusSink(spark, str(tmp_path / "status"))
    for rows in ([("a", 1, "created", "m1")], [("a", 2, "queued", None), ("b", 1, "created", None)], [("a", 3, None, "m3")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(inbox)
        st.run_once(spark.readStream.schema(schema).json(inbox), sink, str(tmp_path / "ck"))
    assert sorted(tuple(r[c] for c in ("job_id", "status", "msg")) for r in sink.current().collect()) == [
        ("a", "queued", "m3"), ("b", "created", None)]


def test_late_status_update_counts(spark, tmp_path):
    """An update at 2 that arrives after updates at 1 and 3 of other columns."""
    schema = "job_id string, updated bigint, status string, msg string"
    sink = st.StatusSink(spark, str(tmp_path / "status"))
    sink(spark.createDataFrame([("a", 1, "old", "m1"), ("a", 3, None, "m3")], schema), 0)
    sink(spark.createDataFrame([("a", 2, "new", "m2")], schema), 1)
    assert [(r.updated, r.status, r.msg) for r in sink.current().collect()] == [(3, "new", "m3")]
    assert sink.current().columns == ["job_id", "updated", "status", "msg"]


def test_proposal_merged_once_located(spark, tmp_path):
    status, master = _master(spark, tmp_path)
    ledger = str(tmp_path / "ledger")
    sink = st.MergeSink(spark, master, ledger, lambda rows: j.master_rows(rows, status))
    sink(_proposals(spark, [("j1", 0, "Новое", None, None), ("j1", 1, "Другое", 45.0, 45.0)]), 0)
    assert [r.i for r in spark.read.parquet(ledger).collect()] == [1]
    sink(_proposals(spark, [("j1", 0, "Новое", 46.0, 46.0)]), 1)
    rows = spark.read.parquet(master).filter("job_id = 'j1'").collect()
    assert sorted((r.i, r.lat) for r in rows) == [(0, 46.0), (1, 45.0)]


def test_master_has_its_columns_only(spark, tmp_path):
    status, master = _master(spark, tmp_path)
    rows = j.master_rows(_proposals(spark, [("j1", 0, "Новое", 45.0, 45.0)]), status)
    assert j.append_accepted(spark.read.parquet(master), rows.withColumn("extra", F.lit(1))).columns == vocab.MASTER_COLUMNS


def test_proposals_keep_their_quotes_in_the_master(spark):
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    recs = spark.range(1).select(F.lit("j1").alias("job_id"), F.lit(1).alias("ord"), F.lit("Отказное").alias("locality"), F.lit("Край").alias("admin"), F.lit("10").alias("elevation"),
                                 *[arr("x").alias(c) for c in ("excavation", "geomorph", "deposits", "raw_terms", "thickness", "strat", "dating", "source_kinds")],
                                 arr(*[f"цитата {k}" for k in range(11)]).alias("quotes"))
    found = j.build_proposals(recs).withColumn("lat", F.lit(43.3)).withColumn("lon", F.lit(43.6))
    status = spark.createDataFrame([("j1", "a.pdf")], "job_id string, filename string")
    assert j.master_rows(found, status).first()["evidence"] == " || ".join(f"цитата {k}" for k in range(11))


def test_article_fetched_twice_is_one_job(spark):
    from stratloom.operators import crawl
    items = spark.createDataFrame([("a-1", "Лёссы", "")], "slug string, title string, abstract string")
    page = '<meta name="citation_title" content="T"><div itemprop="articleBody">' + "слово " * 300
    arts = spark.createDataFrame([("a-1", page), ("a-1", page + "ещё")], "slug string, html string")
    made, pages = crawl.crawl_to_jobs(items, arts, spark.createDataFrame([], "job_id string"))
    assert made.count() == 1 and pages.count() == 1


def test_archive_batch(spark, tmp_path):
    from stratloom.plans.archive import Lookups, archive_batch
    from stratloom.plans.review import publish
    quote = "Разрез Красный Яр расположен на правом берегу реки, мощность лёссов двенадцать метров"
    rec = {k: {"value": v, "evidence": quote} for k, v in {
        "nearest_locality": "Красный Яр", "administrative_unit": "Тестовая область", "excavation_type": "pit",
        "geomorphic_position": "терраса", "deposit_raw_terms": ["лёсс"], "type_of_deposits": ["loess"], "absolute_elevation_m": "120",
        "stratigraphic_position": ["Holocene"], "dating_methods": ["OSL"]}.items()}
    rec.update(thickness=[{"kind": "studied", "value_m": "12", "evidence": ""}], source_kind="prose")
    put(tmp_path / "ocr/arch/a.json", {"path": "/x/Том 1.pdf", "page_from": 0, "pages": [
        {"idx": 0, "text": "пусто " * 60}, {"idx": 1, "text": quote + " и далее " * 40}]})
    responses = spark.createDataFrame([("/x/Том 1.pdf", 1, json.dumps({"records": [rec]}, ensure_ascii=False)), ("/x/Том 1.pdf", 0, '{"rec')],
                                      "path string, idx int, content string")
    gaz = spark.createDataFrame([("Красный Яр", "Тестовая область", "place", "village", 50.5, 40.25, 1)],
                                "name string, admin string, class string, type string, lat double, lon double, rank int")
    box = "name string, class string, type string, rank int, lat0 double, lat1 double, lon0 double, lon1 double"
    out = str(tmp_path / "out")
    look = Lookups(gaz, spark.createDataFrame([], box), spark.createDataFrame([], box))
    rows = archive_batch(spark, str(tmp_path / "ocr"), responses, look, out).collect()
    assert len(rows) == 1 and (rows[0].lat, rows[0].lon, rows[0].thickness_studied) == (50.5, 40.25, "12")
    links = readers.read_page_links(spark, f"{out}/page_links", whole=False).collect()
    assert [(r.marker, r.src, r.page, r.approx) for r in links] == [("50.5,40.25", "Том 1.pdf", 2, False)]
    assert spark.read.json(f"{out}/map/markers").first()["title"] == "Красный Яр"
    assert publish(spark, f"{out}/master", f"{out}/map", f"{out}/map2").count() == 1
    # the next version computes heights for new coordinates only, and its markers carry them
    asked = []

    def height(points):
        asked.extend((r.lat, r.lon) for r in points.collect())
        return points.withColumn("v", F.lit(99.0))

    none = spark.createDataFrame([], "lat double, lon double, v double")
    link = spark.createDataFrame([("50.5,40.25", "Том 1.pdf", 2), ("50.5,40.25", "Том 1.pdf", 2)], "marker string, src string, page int")
    first = publish(spark, f"{out}/master", f"{out}/map", f"{out}/map3", heights=none, compute_height=height, links=link).first()
    assert (first.elev_dem, [tuple(x) for x in first.page_links]) == (99.0, [("Том 1.pdf", 2)]) and asked == [(50.5, 40.25)]
    kept = spark.read.parquet(f"{out}/map3/heights")
    publish(spark, f"{out}/master", f"{out}/map3", f"{out}/map4", heights=kept, compute_height=height)
    assert asked == [(50.5, 40.25)] and spark.read.json(f"{out}/map4/markers").first()["elev_dem"] == 99.0


def test_orphans_are_restored_once(spark):
    from stratloom.plans.review import restore_orphans
    corr = spark.createDataFrame([("50.140.2", "partial", "про Отказное", "u", 1), ("gone", "partial", "разрез Отказное далеко", "u", 2), ("lost", "correct", "", "u", 3)],
                                 "marker_key string, verdict string, comment string, reviewer string, ts long")
    now = spark.createDataFrame([("50.140.2", "50.140.2", "Отказное", 50.1, 40.2)], "marker string, marker_key string, name string, lat double, lon double")
    moved = spark.createDataFrame([("lost", "50.140.2")], "marker_key string, to string")
    once = restore_orphans(corr, now, moved)
    added = sorted((r.movedFrom, r.marker_key, r.origin) for r in once.filter("movedFrom is not null").collect())
    assert added == [("gone", "50.140.2", "named"), ("lost", "50.140.2", "ledger")] and once.count() == 5
    again = restore_orphans(once.select(corr.columns), now, moved)
    assert again.count() == 5


def test_write_delivery_sorts_no_rows(spark, tmp_path):
    """A task keeps one file per tier open; sorting its rows by tier would hold all of them in memory."""
    tiers = spark.range(400).select(F.col("id").alias("ID"), F.element_at(F.array(*map(F.lit, "ABCD")), (F.col("id") % 4 + 1).cast("int")).alias("confidence_tier"))
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    before = store.executionsCount()
    writers.write_delivery(tiers, tiers.select("ID"), str(tmp_path))
    bus.waitUntilEmpty()
    runs = [store.executionsList().apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
    assert len(runs) == 2 and any("confidence_tier" in p for p in runs)
    assert not any("Sort" in p for p in runs)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) in (None, "0")
    back = spark.read.parquet(f"{tmp_path}/full")
    assert sorted((r.ID, r.confidence_tier) for r in back.collect()) == [(i, "ABCD"[i % 4]) for i in range(400)]
    assert sorted(r.ID for r in writers.read_core(spark, str(tmp_path)).collect()) == list(range(0, 400, 4))
