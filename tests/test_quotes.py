"""Quote search and publication look-up against plain versions."""

import random

from pyspark.sql import functions as F

from stratloom.operators import quotes

PAGES = "publication string, idx long, ord long, text string"


def plain_find(pages, ev):
    """(idx, stage) of a normalised quote among (ord, idx, text)."""
    words = ev.split(" ")
    starts = [("whole", ev), ("start60", ev[:60]), *((f"words{n}", " ".join(words[:n])) for n in (8, 6, 4))]
    for stage, s in starts:
        hits = sorted((o, i) for o, i, text in pages if s in text)
        if len(s) >= 12 and hits:
            return hits[0][1], stage
    toks = {w for w in words if len(w) >= 5}
    toks = toks if len(toks) >= 3 else {w for w in words if len(w) >= 4}
    scored = sorted((-len(toks & set(text.split(" "))), o, i) for o, i, text in pages)
    if len(toks) >= 3 and scored and -scored[0][0] >= max(3, int(0.6 * len(toks))):
        return scored[0][2], "fuzzy"
    return None


def test_quotes_of_odd_texts(spark):
    """Few different words, so that starts, ends and repeats overlap; quotes cut inside words, of one word to many."""
    rng = random.Random(11)
    vocab = ["a", "ab", "bab", "abba", "babab", "abbaabba", "bbbbbbbbbbbbbb", "abababababababab", "bababa", "aaaaaaa"]
    pages, asked = [], []
    for pub, n in (("hot", 60), ("p1", 9), ("p2", 1)):
        for i in range(n):
            pages.append((pub, i, 100 - i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 5, 25, 60])))))
        texts = [p[3] for p in pages if p[0] == pub]
        for _ in range(900):
            text = rng.choice(texts)
            a = rng.randrange(max(1, len(text) - 20))
            q = text[a:a + rng.choice([5, 12, 13, 20, 40, 58, 61, 75, 120])].strip()
            q = {0: q, 1: q + " zzq zzqq", 2: q + "q", 3: " ".join(reversed(q.split(" "))), 4: "q" + q}[rng.randrange(5)]
            asked.append((pub, q))
    pages.append(pages[3])  # a page that comes twice
    asked += [("hot", None), ("hot", ""), ("none", "bababa abba babab abba"), asked[0]]
    want = {}
    for pub, q in asked:
        own = [(o, i, text) for p, i, o, text in pages if p == pub]
        if q and len(q) >= 12 and (hit := plain_find(own, q)):
            want[pub, q] = (hit[0] + 1, hit[1])
    got = quotes.evidence_page_join(spark.createDataFrame(asked, "publication string, evidence string"), spark.createDataFrame(pages, PAGES)).collect()
    assert len(got) == len(want) > 200
    assert {(r.publication, r.evidence): (r.page, r.stage) for r in got} == want
    assert {r.stage for r in got} == set(quotes.STAGES)


def test_whole_quote_beats_an_earlier_start(spark):
    start = "в разрезе вскрыты суглинки лёссовидные палевые мощностью до трёх метров и "
    pages = [("p", 0, 0, start + "глины"), ("p", 1, 1, start + "пески мелкие")]
    got = quotes.evidence_page_join(spark.createDataFrame([("p", start + "пески мелкие"), ("p", start + "ил")], "publication string, evidence string"),
                                    spark.createDataFrame(pages, PAGES)).collect()
    assert sorted((r.page, r.stage) for r in got) == [(1, "start60"), (2, "whole")]


def test_no_quotes_and_no_pages(spark):
    ev = spark.createDataFrame([("p", "слова которых здесь нет")], "publication string, evidence string")
    pages = spark.createDataFrame([("p", 0, 0, None), ("p", 1, 1, "")], PAGES)
    assert quotes.evidence_page_join(ev, pages).count() == quotes.evidence_page_join(ev, pages.limit(0)).count() == 0
    assert quotes.evidence_page_join(ev.limit(0), pages).count() == 0


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def plain_lookup(src, pubs):
    """(publication, common, tied) by comparing with every name; names are in normal form."""
    for k in pubs:
        if k == src:
            return k, len(src), False
    stem = src.rsplit(".", 1)[0]
    long = max((common(stem, k) for k in pubs), default=0)
    if long >= 25:
        best = sorted(k for k in pubs if common(stem, k) == long)
        return best[0], long, len(best) > 1
    found = []
    for k in pubs:
        ks = k.rsplit(".", 1)[0]
        sizes = [len(p) for p, whole in ((stem[:25], k), (ks[:25], stem)) if whole.startswith(p)]
        if sizes:
            found.append((max(sizes), k))
    if not found:
        return None
    size = max(found)[0]
    best = sorted(k for n, k in found if n == size)
    return best[0], size, len(best) > 1


def test_longest_start_wins(spark):
    rng = random.Random(4)
    base = "геологическое строение и полезные ископаемые"
    names = {f"{base}, том {v}, вып. {w}.pdf" for v in range(1, 9) for w in range(1, 4)} | {"отчёт.pdf", "отчёт 1.pdf", "от.djvu", "записка.pdf", f"{base}.pdf"}
    names |= {"".join(rng.choice("аб") for _ in range(rng.randrange(3, 40))) + ".pdf" for _ in range(200)}
    srcs = {f"{base}, том {v}{end}" for v in range(0, 11) for end in (".pdf", ", вып. 2.djvu", ", вып. 9.pdf", " и 3.pdf", "")}
    srcs |= {"отчёт 12.pdf", "отчёт 1.pdf", "отче.pdf", "о.pdf", "zzz.pdf", "яяя.pdf", "0.pdf", base, "записка о разном.pdf"}
    srcs |= {"".join(rng.choice("аб") for _ in range(rng.randrange(3, 40))) + ".djvu" for _ in range(200)} | set(rng.sample(sorted(names), 20))
    pubs = spark.createDataFrame([(n.upper() if i % 3 else n, n) for i, n in enumerate(sorted(names))], "publication string, ord string")
    got = quotes.publication_lookup(spark.createDataFrame([(s,) for s in srcs] * 2, "src string").repartition(7), pubs).collect()
    want = {s: hit for s in srcs if (hit := plain_lookup(s, sorted(names)))}
    assert {r.src: (r.publication.lower(), r.common, r.tied) for r in got} == want and len(got) == len(want)
    assert want[f"{base}, том 7, вып. 9.pdf"] == (f"{base}, том 7, вып. 1.pdf", len(f"{base}, том 7, вып. "), True)
    assert want[f"{base}, том 3, вып. 2.djvu"][0] == f"{base}, том 3, вып. 2.pdf"


def test_neighbours_meet_across_partitions(spark):
    rng = random.Random(8)
    names = sorted({f"{rng.randrange(10**6):06d}" for _ in range(40)})
    texts = sorted({f"{rng.randrange(10**6):06d}" for _ in range(3000)} | {"", "zzz"})
    got = quotes.neighbours(spark.createDataFrame([(n,) for n in names], "k string"), spark.createDataFrame([(s,) for s in texts], "s string")).collect()
    assert sorted(r.s for r in got) == texts
    for r in got:
        assert r.before == max((n for n in names if n <= r.s), default=None)
        assert r.after == min((n for n in names if n > r.s), default=None)


def test_common_start_of_strings(spark):
    pairs = [("", "", 0), ("a", "", 0), ("abc", "abd", 2), ("abc", "abc", 3), ("abc", "abcd", 3), ("xbc", "abc", 0)]
    rows = spark.createDataFrame(pairs, "a string, b string, n int").withColumn("got", quotes.common_start(F.col("a"), F.col("b"))).collect()
    assert [r.got for r in rows] == [r.n for r in rows]


def test_keys_of_quotes_are_those_of_pages(spark):
    """The same key from a quote's columns and from a page's text, whatever its kind."""
    from stratloom.operators import marks
    texts = {"c": "аб два три вг", "t": "аб слово вг", "p": "аб начальное", "s": "оконча два", "g": "двенадцатьбукв"}
    rows = spark.createDataFrame([("п", s, [3] * len(s.split(" "))) for s in texts.values()], "publication string, s string, df array<long>")
    got = {r.s: r.a for r in rows.select("s", quotes._anchor(F.col("s"), F.col("df")).alias("a")).collect()}
    for kind, s in texts.items():
        page = f"до x{s}y после"
        assert got[s].kind == kind
        assert got[s].h in marks.text_keys(page, marks.np.uint64(marks._xx("п")), [kind], marks.Words()).view(marks.np.int64)


def test_many_quotes_that_share_words_make_few_rows(spark):
    """Pages and quotes that share some words are as many as their product; none of them is shuffled or written."""
    rng = random.Random(5)
    vocab = [f"слово{i:03d}" for i in range(60)]
    pages = [("p", i, i, " ".join(rng.sample(vocab, 30))) for i in range(300)]
    pages.append(("p", 300, 300, " ".join(f"иное{i}" for i in range(3000))))  # more words than a task has room for at first
    asked = [("p", " ".join(["zzq", *rng.sample(vocab, 12), f"нет{i}"])) for i in range(300)]
    store, sc = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext
    empty = sc._jvm.java.util.ArrayList()
    df = quotes.evidence_page_join(spark.createDataFrame(asked, "publication string, evidence string"), spark.createDataFrame(pages, PAGES))
    got = {r.evidence: r.page for r in df.collect()}
    want = {q: hit[0] + 1 for p, q in asked if (hit := plain_find([(o, i, x) for _, i, o, x in pages], q))}
    assert got == want and want
    stages = store.stageList(empty, False, False, sc._gateway.new_array(sc._jvm.double, 0), empty)
    last = [stages.apply(i).shuffleWriteRecords() for i in range(min(60, stages.size()))]
    assert max(last) < 20_000


def test_search_bytes_are_the_search_form(spark):
    from stratloom.functions import text
    from stratloom.functions.python import search_bytes
    chars = [chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000] + list("😀𐐀𝐀")
    texts = ["a".join(chars[i:i + 50]) for i in range(0, len(chars), 50)] + [" Ёж,  İÇ\tKm ΣΑΣ ", "", "  ", None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", text.norm_search("x").alias("n")).collect()
    for r in rows:
        got = search_bytes(r.x if r.x is None else r.x.encode())
        assert got.decode("cp1251") == r.n


def written(spark, df):
    """Rows of df, and the most rows that one of its stages gave to a shuffle."""
    store, sc = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext
    empty, spark_ids = sc._jvm.java.util.ArrayList(), sc._gateway.new_array(sc._jvm.double, 0)
    rows = df.collect()
    stages = store.stageList(empty, False, False, spark_ids, empty)
    return rows, max(stages.apply(i).shuffleWriteRecords() for i in range(min(60, stages.size())))


def test_quotes_with_one_key_make_few_rows(spark):
    """Quotes that differ only in a cut last word were compared with all pages that hold the words before it, one row a pair."""
    pages = [("p", i, i, f"слово раз два три четыре и {i}") for i in range(300)]
    asked = [("p", f"раз два три четыре{i}") for i in range(300)] + [("p", "раз два три четыре и 7")]
    got, most = written(spark, quotes.evidence_page_join(spark.createDataFrame(asked, "publication string, evidence string"), spark.createDataFrame(pages, PAGES)))
    assert sorted((r.page, r.stage) for r in got) == [(8, "whole")]
    assert most < 20_000


def test_many_rounds_and_small_parts_give_the_same(spark, monkeypatch):
    """Bounds of memory change no result: quotes in rounds, pages in parts, few pairs at a time, starts of the same hash told apart."""
    import pyarrow as pa

    from stratloom.functions.python import search_bytes
    from stratloom.operators import marks
    rng = random.Random(3)
    vocab = ["аб", "вгд", "еёжзи", "длинное слово", "ещё длиннее", "q" * 30]
    pages = [(rng.choice(["p", "o", None]), i, 50 - i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 5, 40])))) for i in range(60)]
    asked = []
    for _ in range(300):
        pub, _, _, text = rng.choice(pages)
        a = rng.randrange(max(1, len(text) - 20))
        asked.append((rng.choice([pub, "p"]), text[a:a + rng.choice([12, 30, 70, 150])].strip() + rng.choice(["", " конец", "я"])))
    ev, at = spark.createDataFrame(asked, "publication string, evidence string"), spark.createDataFrame(pages, PAGES)
    want = sorted(map(tuple, quotes.evidence_page_join(ev, at).collect()))
    texts = sorted({search_bytes(q.encode()) for _, q in asked})
    table = pa.table({"norm": texts, "asked": [[{"publication": "p", "q": i}] for i in range(len(texts))]})
    index = marks.QuoteStarts(marks.Quotes(table), 60, (8, 6, 4))
    monkeypatch.setattr(marks, "_MIX", marks.np.uint64(0))  # all hashes are equal
    alike = marks.QuoteStarts(marks.Quotes(table), 60, (8, 6, 4))
    assert {bytes(alike.data[b:b + n]) for b, n in zip(alike.begin, alike.size)} == {bytes(index.data[b:b + n]) for b, n in zip(index.begin, index.size)}
    monkeypatch.undo()
    monkeypatch.setattr(quotes, "_AT_ONCE", 20_000)
    assert sorted(map(tuple, quotes.evidence_page_join(ev, at).collect())) == want and len(want) > 50
