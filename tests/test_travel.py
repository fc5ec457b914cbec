"""What travels between tasks and lands on disk: narrow rows, compressed files, one shuffle where one is enough."""

import glob

from stratloom.operators import jobs, links, tools
from stratloom.registry import all_queries
from stratloom.registry.core import Views
from stratloom.registry.jobs_web import _proposal_records
from stratloom.registry.records import nested_docs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_a_document_travel_flat(spark):
    lines = plan(nested_docs(Views(spark, SF))).split("\n")
    at = next(i for i, x in enumerate(lines) if "collect_list" in x)
    assert not any("thickness_visible" in x and "(kind, " in x for x in lines[at:])


def test_written_documents_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tools, "scratch_path", lambda s, name: str(tmp_path / name))
    assert all_queries()["scan_doc_results"](spark, SF).count() > 0
    files = glob.glob(f"{tmp_path}/docs/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)


def test_records_travel_once_to_their_proposals(spark):
    recs = _proposal_records(Views(spark, SF))
    once = jobs.build_proposals(recs)
    text = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in text and text.count("collect_list") == 1
    spread = jobs.build_proposals(recs, crowded=0)
    assert "Union" in spread._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, spread.select(once.columns).collect()), key=str)


def test_names_meet_section_names_as_distinct_texts(spark, monkeypatch):
    """Figures of linked pages are reduced before they meet names, and equal texts are compared once."""
    compared = []
    whole = links.containing
    monkeypatch.setattr(links, "containing", lambda a, b, *rest: compared.append(1) or whole(a, b, *rest))
    markers = spark.createDataFrame([("m", "Красный Яр 1"), ("k", "Лиман"), ("n", "Яр")], "marker string, locality string")
    figures = spark.createDataFrame([("s", 1, "Колонка Красный Яр 1", "u"), ("s", 1, "Колонка Красный Яр 1", "u"), ("s", 2, "Колонка Красный Яр 1", "u"),
                                     ("s", 2, "Лим", "v"), ("s", 3, "", "w"), ("s", 3, None, "x")], "slug string, page int, section_name string, units string")
    for kind in ("int", "bigint"):
        at = spark.createDataFrame([(m, "s", p, 5 - p) for m in "mkn" for p in (1, 2, 3)], f"marker string, slug string, page int, pos {kind}")
        got = sorted(map(tuple, links.figure_column_join(markers, at, figures).collect()))
        assert got == [("k", "", "w", 3), ("k", "Лим", "v", 2), ("m", "", "w", 3), ("m", "Колонка Красный Яр 1", "u", 2)]
    assert compared


def test_quotes_of_a_place_are_reduced_before_they_meet_markers(spark):
    markers = spark.createDataFrame([("m", "Яр", 2), ("m", " яр", 1), ("k", "Бор", 3)], "marker string, locality string, pos long")
    ev = spark.createDataFrame([("яр", "слой", i, i == 7) for i in range(50)] + [("яр", "а", 3, False), ("бор", "б", 1, None)],
                               "locality string, phrase string, n long, grounded boolean")
    out = links.evidence_by_locality_join(markers, ev)
    assert sorted(map(tuple, out.collect())) == [("k", None, ["б"]), ("m", True, ["слой", "а"])]
    lines = [x.split("- ")[-1].strip() for x in plan(out).split("\n")]
    joins = [i for i, x in enumerate(lines) if x.startswith("Join Inner")]
    assert joins and all(any(x.startswith("Aggregate") for x in lines[i:]) for i in joins)


def test_texts_are_stripped_a_few_at_a_time():
    import pyarrow as pa

    from stratloom.functions import python
    texts = ["Ёлка й é", None, "", "plain"] * 300
    got = python.nfd_strip.func(pa.array(texts))  # plain Arrow in and out, no whole batch of Python strings
    assert got.to_pylist() == ["Елка и e", None, "", "plain"] * 300
    assert python.nfd_strip.func(pa.array([], pa.string())).to_pylist() == []


def test_figures_of_links_leave_a_batch_once_a_marker(spark, monkeypatch):
    """Links times figures are never rows if tasks can hold the figures; both ways give the same, with nulls, ties and repeats."""
    import random
    rng = random.Random(9)
    markers = spark.createDataFrame([(f"m{i}", w) for i in range(6) for w in rng.sample(["Красный Яр", "Лиман", "Бор сухой", "Кут"], 2)] + [(None, "Лиман"), ("m1", None)],
                                    "marker string, locality string")
    names = ["Колонка Красный Яр", "Разрез Лиман", "лиман", "Бор", "", None, "Колонка Бор сухой"]
    for n, kind in ((300, "int"), (300, "bigint"), (40, "int")):  # pages that hold many figures, and few
        figures = [(rng.choice(["s", "t", None]), rng.choice([1, 2, 3, 4, None]), rng.choice(names), rng.choice(["u", "v", None])) for _ in range(n if n > 40 else 8)]
        at = [(rng.choice(["m0", "m1", "m2", "m3", "m4", "m5", None]), rng.choice(["s", "t", None]), rng.choice([1, 2, 3, 4, 5, None]), rng.choice([-3, 0, 1, 2, 7, None])) for _ in range(n)]
        figures = spark.createDataFrame(figures, "slug string, page int, section_name string, units string")
        at = spark.createDataFrame(at, f"marker string, slug string, page int, pos {kind}")
        monkeypatch.setattr(links, "_CELLS", 20)
        new = links.figure_column_join(markers, at, figures)
        assert "MapInArrow" in plan(new)
        monkeypatch.setattr(tools, "fits", lambda df, most=0: False)
        old = links.figure_column_join(markers, at, figures)
        assert "MapInArrow" not in plan(old)
        assert sorted(map(str, new.collect())) == sorted(map(str, old.collect())) and not new.isEmpty()
        monkeypatch.undo()


def test_asked_quotes_come_from_a_written_table(spark, monkeypatch):
    """Sources and quotes of sections were split anew for each of the readers."""
    asked = []
    whole = links.evidence_page_join
    monkeypatch.setattr(links, "evidence_page_join", lambda ev, pages: asked.append(plan(ev)) or whole(ev, pages))
    sections = spark.createDataFrame([(45.0, 30.0, "вскрыты суглинки лёссовидные палевые||нет такой цитаты нигде", "Том 1.pdf | другой.pdf")],
                                     "lat double, lon double, evidence string, sources string")
    pages = spark.createDataFrame([("Том 1.pdf", 4, 4, "в разрезе вскрыты суглинки лёссовидные палевые")], "publication string, idx long, ord long, text string")
    got = links.page_links(sections, pages).collect()
    assert [(r.src, r.page, r.approx) for r in got] == [("Том 1.pdf", 5, False)]
    assert "Generate" not in asked[0] and "Aggregate" not in asked[0]
