"""Benchmark items found in training passages: BM25 over a block-max index, then question and answer overlap."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tools import forget, materialise
from .blockmax import BlockMaxIndex
from .common import append_columns, ragged, unused

K1, B = 1.2, 0.75
SHARE = 0.6  # BM25 that a passage must reach, as a share of the item's score against itself
OVERLAP = 0.5  # share of the question's, and of the answer's, word n-grams that a passage must contain
GRAM = 4
LEAST_WORDS = 5  # items of fewer words are looked for as they stand, word by word; two characters of an unspaced script count as a word
LEAST_INSIDE = 3  # tokens; still shorter items are found only where they are the whole text
SHARD_ITEMS = 20_000  # items, and
SHARD_BYTES = 16 << 20  # bytes of their texts, in one broadcast index; more items make more indexes
BLOCK = 8

_TOKEN = re.compile(r"[^\W_]+")
# scripts written without spaces: Thai to Tibetan, Myanmar, Khmer, kana, Han and its later planes
_RANGES = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_RANGES}]")
_MIXED = re.compile(rf"(?=[^\W_])[{_RANGES}]|[^\W_{_RANGES}]+")


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; each character of a script without spaces stands alone."""
    low = (text or "").lower()
    return (_MIXED if _UNSPACED.search(low) else _TOKEN).findall(low)


def is_short(found: list[str]) -> bool:
    """Whether an item has too few words to be told from chance by shares of its words."""
    return sum(0.5 if _UNSPACED.match(t) else 1.0 for t in found) < LEAST_WORDS


def _overlap(part: list[str], grams: dict[int, set]) -> float:
    n = min(GRAM, len(part))
    if not n:
        return 1.0
    own = [tuple(part[i:i + n]) for i in range(len(part) - n + 1)]
    return sum(g in grams[n] for g in own) / len(own)


class Statistics:
    """What is asked of all items together: their number, mean and largest length, and in how many each term stands."""

    def __init__(self, n: int, mean: float, longest: int, df: dict[str, int]):
        self.n, self.mean, self.longest, self.df = n, mean, longest, df

    @classmethod
    def of(cls, items: list[list[str]]) -> Statistics:
        df: defaultdict[str, int] = defaultdict(int)
        for ws in items:
            for w in set(ws):
                df[w] += 1
        return cls(len(items), sum(map(len, items)) / max(1, len(items)), max(map(len, items), default=0), df)


class Index:
    """Items of one shard, sorted by length so that blocks hold items of like length.

    Weights are BM25 divided by what the item asks for, so a passage is retrieved from a score of 1 on. The
    first half of an item's words is its question, the rest its answer. ``whole`` are the numbers of the whole benchmark, so
    that an item's score does not depend on the shard it is in. Short items are kept apart, by their longest token.
    """

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None):
        split = sorted((len(t), i is None, i or 0, t) for i, x in items if (t := tokens(x)))
        known = [r for r in split if not is_short(r[3])]
        self.ids, self.items = [None if r[1] else r[2] for r in known], [r[3] for r in known]
        self.short = [(None if r[1] else r[2], r[3]) for r in split if is_short(r[3])]
        self.anchors: dict[str, list[int]] = {}
        for j, (_, ws) in enumerate(self.short):
            self.anchors.setdefault(max(ws, key=len), []).append(j)
        whole = whole or Statistics.of(self.items)
        # in order, so that an item's terms are added up in the same order in every shard
        self.terms = {w: i for i, w in enumerate(sorted({w for ws in self.items for w in ws}))}
        item, term, tf = [], [], []
        for i, ws in enumerate(self.items):
            for w in dict.fromkeys(ws):
                item.append(i)
                term.append(self.terms[w])
                tf.append(ws.count(w))
        item, term, tf = np.array(item, np.int64), np.array(term, np.int64), np.array(tf, float)
        n = len(known)
        df = np.array([whole.df[w] for w in self.terms], float)
        idf = np.log(1 + (whole.n - df + 0.5) / (df + 0.5))
        size = np.array([len(x) for x in self.items], float)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / max(1e-9, whole.mean))) if n else tf
        self.self_score = np.bincount(item, weight, n)
        self.index = BlockMaxIndex(n, len(self.terms), item, term, weight / (SHARE * self.self_score[item]) if n else weight, BLOCK)
        self.bounds = self.index.block_matrix()
        self.stride = max(1, whole.longest)

    def passages(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(text, first word, distinct terms, blocks) of passages whose bound allows an item there.

        Passages are two strides long and one stride apart, so any stretch of one stride, the longest item,
        lies whole in one of them.
        """
        get = self.terms.get
        coded = [np.array(list(map(get, tokens(t), repeat(-1))), np.int64) for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        segments = -(-size // self.stride)
        base = np.r_[0, np.cumsum(segments)[:-1]]
        owner = np.repeat(np.arange(len(texts)), segments)
        flat = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        seg = np.repeat(base, size) + ragged(np.zeros(len(size), np.int64), size) // self.stride
        key = np.unique(seg[flat >= 0] * len(self.terms) + flat[flat >= 0])
        if not len(key):
            return
        seg, term = np.divmod(key, len(self.terms))
        first = np.searchsorted(seg, np.arange(len(owner) + 1))
        bound = np.zeros((len(owner) + 1, self.bounds.shape[1]))
        some = np.flatnonzero(np.diff(first))
        step = max(1, (4 << 20) // self.bounds.shape[1])
        # runs of whole segments, so that the gathered rows stay small
        cuts = [0]
        while cuts[-1] < len(some):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(first[some], first[some[cuts[-1]]] + step))))
        for a, b in zip(cuts, cuts[1:], strict=False):
            rows = some[a:b]
            lo, hi = first[rows[0]], first[rows[-1] + 1]
            bound[rows] = np.add.reduceat(self.bounds[term[lo:hi]], first[rows] - lo, axis=0, dtype=np.float64)
        joined = np.r_[owner[1:] == owner[:-1], False]
        bound[:-1] += np.where(joined[:, None], bound[1:], 0)
        last = len(owner) - 1
        for s in np.flatnonzero((bound[:-1] >= 1).any(axis=1)):
            end = first[s + 2] if s < last and joined[s] else first[s + 1]
            own, blocks = np.unique(term[first[s]:end]), np.flatnonzero(bound[s] >= 1)
            # terms of both halves counted once: most passages end here
            blocks = blocks[self.bounds[np.ix_(own, blocks)].sum(axis=0, dtype=np.float64) >= 1]
            if len(blocks):
                yield int(owner[s]), int(s - base[owner[s]]) * self.stride, own, blocks

    def short_items(self, found: list[str]) -> list[int]:
        """Short items whose tokens stand in the text one after another; those below LEAST_INSIDE tokens must be all of it."""
        out = []
        for anchor in set(found) & self.anchors.keys():
            places = [p for p, t in enumerate(found) if t == anchor]
            for j in self.anchors[anchor]:
                ws = self.short[j][1]
                if len(ws) < LEAST_INSIDE:
                    hit = found == ws
                else:
                    back = ws.index(anchor)
                    hit = any(p >= back and found[p - back:p - back + len(ws)] == ws for p in places)
                if hit:
                    out.append(j)
        return out

    def rows(self, texts: list[str]) -> list[list[dict]]:
        """For each text the items found there, ordered by id, null first, and then by the other columns."""
        out = [[dict(zip(NAMES, (self.ids[h], *v), strict=True)) for h, v in found.items()] for found in self.search(texts)]
        if self.short:
            for mine, text in zip(out, texts, strict=True):
                mine += [dict(zip(NAMES, (self.short[j][0], 1.0, 1.0, 1.0), strict=True)) for j in self.short_items(tokens(text))]
        return [sorted(mine, key=lambda r: (r[NAMES[0]] is not None, *(r[k] or 0 for k in NAMES))) for mine in out]

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, float]]]:
        """For each text the items found there, with the best BM25 share of the self score, and both overlaps."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        split: tuple[int, list[str]] = (-1, [])
        for i, start, terms, blocks in self.passages(texts):
            scores = self.index.score_blocks(terms, np.ones(len(terms)), blocks)
            hits = np.flatnonzero(scores >= 1)
            if not len(hits):
                continue
            if split[0] != i:
                split = (i, tokens(texts[i]))
            passage = split[1][max(0, start - self.stride):start + 3 * self.stride]
            grams: dict[int, set] = {}
            for n in range(1, GRAM + 1):
                grams[n] = set(zip(*[passage[k:] for k in range(n)], strict=False))
            for h in hits:
                ws = self.items[h]
                half = len(ws) // 2
                q, a = _overlap(ws[:half], grams), _overlap(ws[half:], grams)
                if q >= OVERLAP and a >= OVERLAP:
                    new = (float(scores[h]) * SHARE, q, a)
                    out[i][int(h)] = max(new, out[i].get(int(h), new))
        return out


NAMES = ("item_id", "bm25_share", "question_overlap", "answer_overlap")
FOUND = T.ArrayType(T.StructType([T.StructField(k, T.DoubleType() if i else T.LongType()) for i, k in enumerate(NAMES)]))


def _words(items: DataFrame) -> DataFrame:
    """(id, t, words): the words of each item that is scored; none for short ones."""
    def run(batches):
        for batch in batches:
            found = [tokens(x.as_py()) for x in batch.column("t")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([[] if is_short(ws) else ws for ws in found], pa.list_(pa.string()))], names=["id", "t", "words"])

    return items.mapInArrow(run, "id long, t string, words array<string>")


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "item_id", item_text: str = "text",
               column: str = "leaks", shards: int | None = None) -> DataFrame:
    """Append the list of benchmark items found in each text; the list is empty where none is.

    Null and empty texts hold no item; items without a word are never found. Items of fewer than LEAST_WORDS words are found where
    all their words stand one after another, those of one or two words where they are the whole text. A long text is read
    whole, in passages. Repeated items are found each; repeated rows get equal lists, ordered by id.

    The size of the benchmark is measured: items beyond one index's bound go to further indexes, and the rows pass by each in
    turn. Item count, document frequencies and mean length are those of the whole benchmark, so the result does not depend on the number of
    indexes (``shards`` sets it).
    """
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(item_text).alias("t")).filter("t is not null")
    # three jobs and one pass for each index read the words
    items = materialise(_words(items))
    size = items.agg(F.count("t").alias("rows"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes"),
                     F.count(F.when(F.size("words") > 0, 1)).alias("n"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words"), F.coalesce(F.max(F.size("words")), F.lit(0)).alias("longest")).first()
    shards = shards or max(1, -(-size["rows"] // SHARD_ITEMS), -(-size["bytes"] // SHARD_BYTES))
    each = items.withColumn("shard", F.pmod(F.xxhash64("id", "t"), F.lit(shards)))
    terms = each.select("shard", F.explode(F.array_distinct("words")).alias("term")).groupBy("term", "shard").agg(F.count("term").alias("here"))
    everywhere = terms.groupBy("term").agg(F.sum("here").alias("df"))
    terms = materialise(terms.select("term", "shard").join(everywhere, "term"))
    out = docs.drop(column)
    parts: list[str] = []
    for s in range(shards):
        # one shard's terms and texts, which SHARD_ITEMS and SHARD_BYTES bound
        df = {r["term"]: r["df"] for r in terms.filter(F.col("shard") == s).select("term", "df").collect()}
        mine = each.filter(F.col("shard") == s).select("id", "t").collect()
        index = Index([(r["id"], r["t"]) for r in mine], Statistics(size["n"], size["words"] / max(1, size["n"]), size["longest"], df))
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def start(shared=shared):
            return lambda texts: [shared.value.rows(texts)]

        (name,) = unused(out, f"_{column}_{s}")
        out = append_columns(out, text, [T.StructField(name, FOUND)], start)
        parts.append(name)
    forget(items, terms)
    return out.withColumn(column, F.array_sort(F.concat(*parts)) if shards > 1 else F.col(parts[0])).drop(*parts)
