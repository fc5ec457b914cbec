"""Each operator against a plain version, on small tables with nulls, empty texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from stratloom.llm import bpe_chunks, decontam, language, licenses, quality, sharding, simhash, token_counts, toxicity, warc
from stratloom.llm.blockmax import BlockMaxIndex
from stratloom.llm.common import held_out

ODD = ["", " ", "\n\n", "a", "é", "a b", "All rights reserved.", "cc  by CC-BY cc by", "GENERAL public\nLicense!", "x" * 3000, " " * 700, "\t\n" * 300 + "z",
       "日本語" * 700, "<|endoftext|>", "ab  <|endoftext|>  cd<|endo", "don't we'll 'r 're", "12 345 6", "▁ ▁▁", "\u0000    x", "🙂 ok 🙂🙂", "#$%& *|<>", "İK ſ"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "loess", "terrace", "Ünder", "rivière", "sand;", "2.5", "(bore)", "clay,", "all", "rights", "reserved", "cc", "by"]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "a null id"), (7, "cc  by CC-BY cc by"), (7, "another text of the same id")]
    for i in range(100, 180):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 120, 700])))
        rows += [(i, text), (i + 1000, text), (i + 2000, text.replace("loess", "Loess", 1) + "\nend. end. end.")]
    # columns that clash with names the operators use
    return spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("x").alias(c) for c in ("score", "n_tokens", "toxicity", "lang_pred", "leaks", "shard", "slot", "_fp", "n_words", "w", "h", "id", "t")])


def rows_of(df, *cols):
    return sorted(map(repr, ((*r,) for r in df.select(*cols).collect())))


def empty(docs):
    return docs.filter("false")


def test_bpe_equals_library(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    want = []
    for d, t in docs.select("doc_id", "text").collect():
        ids = tk.encode(t or "", add_special_tokens=False).ids
        text = tk.decode(ids, skip_special_tokens=False)
        want.append(repr((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())))
    got = bpe_chunks.encode_corpus(docs, path, keep_ids=True)
    assert rows_of(got, "id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)
    back = bpe_chunks.decode_corpus(got, path)
    assert rows_of(back, "id", "decoded") == sorted(repr((d, t or "")) for d, t in docs.select("doc_id", "text").collect())
    assert bpe_chunks.encode_corpus(empty(docs), path).count() == 0


def test_bpe_joins_anywhere():
    c = bpe_chunks.codec(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'", "'re", "'s", "ll", "é", " don't", "12", " 34", "!!", "日本", "😀", "\r\n", "word", " word"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 4))))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        assert c.joined([c.encode(p) for p in pieces]).tolist() == c.encode(text).tolist()


def test_token_counts_equal_library(spark, docs):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [repr((d, len((t or "").encode()), n := len(model.encode(t or "")), n > 50)) for d, t in docs.select("doc_id", "text").collect()]
    got = token_counts.count_tokens(docs, path, limit=50)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want)
    assert sorted(got.columns) == sorted({*docs.columns, "n_bytes", "n_tokens", "over_limit"})
    assert token_counts.count_tokens(empty(docs), path).count() == 0


def test_merging_random_strings():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, count = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.Counter(path)
    rng = random.Random(8)
    texts = ["".join(rng.choice("aaabcdeeiinost  ▁.,'0129éß日\n") for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    assert count(texts).tolist() == [len(x) for x in model.encode(texts)] == count(texts).tolist()


def plain_notices(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in low)
    ws = [w for w in ws.split(" ") if w]
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(ws)) if ws[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_notices(spark, docs):
    want = [repr((d, *plain_notices(t))) for d, t in docs.select("doc_id", "text").collect()]
    got = licenses.find_notices(docs)
    assert rows_of(got, "id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want)
    assert licenses.find_notices(empty(docs)).count() == 0
    made = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0."), (2, "It is licensed under the Apache License, version 2"), (3, "the license")], "doc_id long, text string")
    found = {r["id"]: r for r in licenses.find_notices(made).collect()}
    assert found[1]["labels"] == "apache-2.0" and found[1]["score"] == 1.0 and found[1]["spans"][0][:2] == (0, 7)
    assert found[2]["labels"] == "apache-2.0" and found[2]["score"] < 1
    assert found[3]["labels"] == "" and found[3]["score"] == 0


def plain_fingerprint(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(values, radius=3):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    vs = sorted(root)
    for i, a in enumerate(vs):
        for b in vs[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(b)] = find(a)
    out = {}
    for v in vs:
        out.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in out.values()}


def test_simhash(spark, docs):
    rows = [(d, plain_fingerprint(t)) for d, t in docs.select("doc_id", "text").collect()]
    component = {v: min((d for d, f in rows if f in g and d is not None), default=None) for g in groups({f for _, f in rows}) for v in g}
    want = sorted(repr((d, f - (1 << 64) if f >> 63 else f, component[f])) for d, f in rows)
    assert rows_of(simhash.near_duplicates(docs), "id", "fp", "component") == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert len({plain_fingerprint(r["text"]) for r in kept.collect()}) == kept.count() == len(groups({f for _, f in rows}))
    assert simhash.near_duplicates(empty(docs)).count() == simhash.keep_one(empty(docs)).count() == 0


def test_simhash_links_in_hot_shards(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    values |= {rng.getrandbits(64) for _ in range(300)}
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = {}
    for r in simhash.connected(simhash.links(df, shard=20)).collect():
        found.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
    assert {frozenset(g) for g in found.values()} == {g for g in groups(values) if len(g) > 1}


def test_bk_tree_finds_all():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 14, 500).astype(np.uint64)
    q, node = simhash.BKTree(values).near(values, 2)
    want = {(i, j) for i in range(500) for j in range(500) if int(values[i] ^ values[j]).bit_count() <= 2}
    assert set(zip(q.tolist(), node.tolist(), strict=True)) == want


def plain_measures(text):
    text = text or ""
    flat = text
    for c in "\t\n\x0b\x0c\r":
        flat = flat.replace(c, " ")
    ws = [w for w in flat.split(" ") if w]
    grams = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    inside = {j for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(ws) < 50 or 100 * len(inside) > 50 * len(ws)


def test_quality(spark, docs):
    want = [repr((d, *plain_measures(t))) for d, t in docs.select("doc_id", "text").collect()]
    got = quality.judge(docs)
    assert rows_of(got, "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want)
    assert got.filter("kept and base_failed").count() == 0
    assert quality.judge(empty(docs)).count() == 0


def test_em_finds_rates(spark):
    rng = random.Random(6)
    names, rows = ["vote_a", "vote_b", "vote_c"], []
    for _ in range(6000):
        kind = "good" if rng.random() < 0.8 else rng.choice(names)
        rate = {k: 0.005 if kind == "good" else 0.9 if k == kind else 0.05 for k in names}
        rows.append([kind, *[0 if rng.random() < 0.1 else -1 if rng.random() < rate[k] else 1 for k in names]])
    votes = spark.createDataFrame(rows, "kind string, vote_a int, vote_b int, vote_c int")
    rates, shares = quality.learn(votes, names)
    assert abs(shares["good"] - 0.8) < 0.05 and all(abs(rates[k][k] - 0.9) < 0.12 and rates["good"][k] < 0.015 for k in names)
    right = votes.filter((quality._posterior(names, rates, shares) >= 0.5) == (F.col("kind") == "good")).count()
    assert right > 0.95 * len(rows)
    assert quality.learn(votes.filter("false"), names)[1]["good"] == quality.START_SHARE


def test_block_max_top_is_exact():
    rng = np.random.default_rng(1)
    item, term = rng.integers(0, 500, 6000), rng.integers(0, 40, 6000)
    key = np.unique(item * 40 + term)
    item, term = key // 40, key % 40
    weight = rng.integers(1, 5, len(key)) / 4
    index = BlockMaxIndex(500, 40, item, term, weight, block=16)
    dense = np.zeros((500, 40))
    dense[item, term] = weight
    for _ in range(50):
        terms = np.sort(rng.choice(40, 5, replace=False))
        w = rng.random(5).round(1)
        scores = dense[:, terms] @ w
        best = [i for i in np.lexsort((np.arange(500), -scores.round(9))) if scores[i] > 0][:7]
        near, got = index.top(terms, w, 7)
        assert np.allclose(got, scores[best]) and len(near) == len(best)


def test_toxicity(spark, docs):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choice(["sand", "loess", "river", "clay", "bone"]) for _ in range(30)) + (" vile rotten" if bad else " calm")))
        labels.append((i, int(bad)))
    known = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    model = toxicity.fit(known, marks, lambda i: ~held_out(i, 5, 0))
    scored = toxicity.score_toxicity(known.join(marks.filter("toxic in (0, 1)"), "doc_id"), model)
    assert scored.filter(held_out(F.col("doc_id"), 5, 0) & (F.col("predicted") != F.col("toxic"))).count() == 0
    # exact cosines: the nearest example by hand
    at, w = model.vector("vile sand calm")
    near, cosine = model.index.top(at, w, 5)
    dense = np.zeros((model.index.n_items, model.index.n_terms))
    dense[model.index.item, np.repeat(np.arange(model.index.n_terms), [model.index.entry_start[model.index.term_entries[t + 1]] - model.index.entry_start[model.index.term_entries[t]] for t in range(model.index.n_terms)])] = model.index.weight
    assert np.allclose(np.sort(dense[:, at] @ w)[::-1][:5], cosine)
    odd = toxicity.score_toxicity(docs, model)
    assert odd.count() == docs.count() and odd.filter("toxicity between 0 and 1").count() == odd.count()
    none = toxicity.fit(known, marks.filter("false"))
    assert toxicity.score_toxicity(docs, none).agg(F.max("toxicity")).first()[0] == 0
    assert toxicity.score_toxicity(empty(docs), model).count() == 0


def test_language(spark, docs):
    texts = [(i, "the river and the sand of the hill " * 3, "en") for i in range(20)] + [(i, "der Fluss und die Höhe über dem Tal " * 3, "de") for i in range(20, 40)] + [(50, "nothing", None), (None, "x", "en")]
    known = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = language.fit(known)
    made = spark.createDataFrame([(1, "the sand"), (2, "über die Höhe"), (3, "12 !"), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify_language(made, model).collect()}
    assert got == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und"}
    odd = language.identify_language(docs, model)
    assert odd.count() == docs.count() and odd.filter("lang_score between 0 and 1").count() == odd.count()
    assert language.fit(known.filter("false")).predict(["a"])[0] == ["und"]
    assert language.identify_language(empty(docs), model).count() == 0


def test_naive_bayes_by_hand(spark):
    known = spark.createDataFrame([(1, "aa ab", "x"), (2, "bb", "y")], "doc_id long, text string, lang string")
    model = language.fit(known)
    counts = np.zeros((language.BUCKETS, 2))
    for lang, text in ((0, "aa ab\n"), (1, "bb\n")):
        for b in language.hashed(text).ravel():
            counts[b, lang] += 1
    want = np.log((counts + 0.5) / (counts + 0.5).sum(axis=0))
    assert np.allclose(model.logs, want, atol=1e-4)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    return words, [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 60)))) for i in range(60)] + [(60, None), (61, ""), (62, "too short"), (3, "a repeated id of an item that stands nowhere at all")]


def test_decontamination(spark, docs, items):
    words, bench = items
    rng = random.Random(13)
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, want = [], set()
    for i in range(40):
        item = bench[i]
        rows.append((i, f"{noise(rng.randint(0, 300))} {item[1].upper()}! {noise(rng.randint(0, 300))}"))
        want.add((i, item[0]))
    rows += [(100 + i, noise(400)) for i in range(40)]
    # half an item is a question without its answer
    rows += [(200 + i, noise(100) + " " + " ".join(bench[i][1].split()[:len(bench[i][1].split()) // 2]) + " " + noise(100)) for i in range(20)]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r[0], r[1]) for r in decontam.find_items(made, benchmark).select("doc_id", F.explode("leaks.item_id")).collect()}
    assert got == want
    whole = decontam.SHARD_ITEMS
    try:
        decontam.SHARD_ITEMS = 20
        assert {(r[0], r[1]) for r in decontam.find_items(made, benchmark).select("doc_id", F.explode("leaks.item_id")).collect()} == want
    finally:
        decontam.SHARD_ITEMS = whole
    assert decontam.find_items(docs, benchmark).count() == docs.count()
    assert decontam.find_items(docs, benchmark.filter("false")).filter(F.size("leaks") > 0).count() == 0
    assert decontam.find_items(empty(docs), benchmark).count() == 0


def test_passages_lose_nothing(items):
    """Block bounds against all items scored plainly in every passage."""
    words, bench = items
    index = decontam.Index([x for x in bench if x[1]])
    rng = random.Random(14)
    text = " ".join([rng.choice(words) for _ in range(200)] + bench[5][1].split() + [rng.choice(words) for _ in range(90)])
    seen = {(start, int(b)) for _, start, _, blocks in index.passages([text]) for b in blocks}
    ws = decontam.tokens(text)
    for start in range(0, len(ws), index.stride):
        terms = np.array(sorted({index.terms[w] for w in ws[start:start + 2 * index.stride] if w in index.terms}))
        scores = index.index.score_blocks(terms, np.ones(len(terms)), np.arange(index.index.n_blocks))
        for i in np.flatnonzero(scores >= 1):
            assert (start, i // decontam.BLOCK) in seen


def test_warc(spark):
    pages = [(1, "http://www.a.org/x?q=1", "<p>é</p>"), (2, "http://a.org/x?q=1", "<p>é</p>"), (3, None, None), (4, "", ""), (None, "http://b.org", "<p>é</p>"),
             (5, "http://c.org/\r\nX: y", "a\r\n\r\nb"), (1, "http://www.a.org/x?q=1", "<p>é</p>"), (None, "u", "only null"), (6, "ht!tp://[", "z" * 100000), (7, "http://a.org/x?q=1", "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("sha1", F.lit(2))
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in pages:
        body, to = (h or "").encode(), first.get(h or "")
        again = to is not None and i != to
        want.append(repr((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", to if again else None)))
    assert rows_of(warc.archive(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want)
    assert warc.archive(df.filter("false")).count() == 0


def test_warc_index_over_many_blocks(spark):
    lines = warc.BLOCK_LINES
    try:
        warc.BLOCK_LINES = 4
        pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 3, F.lit(".org/same")).alias("url"), F.concat(F.lit("p"), F.col("id") % 50).alias("html"))
        folder = warc._folder(warc.scratch_path(spark, "warc"))
        captures = warc.write_archives(pages, folder)
        top = warc.write_index(captures, folder)
        index = warc.CaptureIndex(folder, top)
        assert [index.read(c)["page_id"] for c in index.find("org,h1)/same")] == list(range(1, 300, 3))
        assert [c[1] for c in index.find("org,h1)/same", 4)] == [4] and not list(index.find("org,h9)/same"))
        assert warc.read_captures(captures.select("key", "page_id"), folder, top).count() == 300
    finally:
        warc.BLOCK_LINES = lines


def test_sharding(spark, docs):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, slots=1009)
    # by hand: each shard walks its own permutation and takes the first free slot
    taken, walk = {}, {n: iter([(sharding._number(n, "start", 1009) + j * (sharding._number(n, "step", 1008) + 1)) % 1009 for j in range(1009)]) for n in names}
    while len(taken) < 1009:
        for n in names:
            if len(taken) < 1009:
                taken[next(s for s in walk[n] if s not in taken)] = n
    assert [taken[i] for i in range(1009)] == [names[i] for i in table]
    fewer = sharding.lookup_table(names[:-1], slots=1009)
    assert np.mean((table != 6) & (fewer != table)) < 0.15
    heavy = np.bincount(sharding.lookup_table(names, [2] + [1] * 6, slots=1009))
    assert heavy[0] > 1.8 * heavy[1]
    got = sharding.place(docs, "doc_id", names)
    big = sharding.lookup_table(names)
    want = []
    for (d,) in docs.select("doc_id").collect():
        slot = int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        want.append(repr((d, slot, names[big[slot]])))
    assert rows_of(got, "doc_id", "slot", "shard") == sorted(want)
    assert sharding.place(empty(docs), "doc_id", names).count() == 0


def test_write_shards(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs.select("doc_id", "text"), path, "doc_id", ["a", "b", "c"], files=2)
    assert spark.read.parquet(path).count() == docs.count()
