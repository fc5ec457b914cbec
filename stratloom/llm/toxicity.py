"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index of all their terms."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blockmax import BlockMaxIndex, coherent_order
from .common import append_columns, ragged, words

EXAMPLES = 12_000  # labelled rows the classifier is fitted on, at most
LEAST_WEIGHT = 0.005  # share of its idf that a term weighs which says nothing about the label
NEAREST = 15
PRIOR_WEIGHT = 0.5
BATCH = 128  # texts scored at once
BLOCK = 64  # examples that share their terms' maxima
FIRST = 3  # blocks of highest bound that are opened before there is a cosine to beat
FEATURES = 256  # heaviest terms, by which examples are put next to like ones
KNOWN_WORDS = 1 << 18  # terms whose place in the vocabulary a task remembers at once
MANY = 16  # terms of one in MANY examples or more are multiplied as a matrix
SLICE = 1 << 18  # postings that are weighed at once
SLACK = 1e-4  # far above what single precision can be wrong by in a cosine


STEM = 5  # the first letters of a longer word are a term of their own, so that inflected words meet


def terms_of(text: str) -> list[str]:
    found = words(text)
    return found + [w[:STEM] + "-" for w in found if len(w) > STEM]


def term_counts(text: str) -> Counter:
    """How often each of ``terms_of`` stands in the text."""
    out = Counter(words(text))
    starts = Counter()
    for w, n in out.items():
        if len(w) > STEM:
            starts[w[:STEM] + "-"] += n
    out.update(starts)
    return out


def hashes(terms) -> np.ndarray:
    """Terms as 64-bit numbers: a vocabulary of millions is one array."""
    return np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms], np.uint64)


class WordMemory:
    """Words a task has met, with the numbers of their terms; a matter of cost alone."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.start: dict[str, int] = {}
        self.word_at = self.start_at = np.zeros(0, np.int64)

    def add(self, new: list[str], word_at, start_at) -> None:
        n = len(self.number)
        self.number.update(zip(new, range(n, n + len(new)), strict=True))
        if n + len(new) > len(self.word_at):
            room = 2 * (n + len(new))
            self.word_at, self.start_at = (np.r_[x[:n], np.zeros(room - n, np.int64)] for x in (self.word_at, self.start_at))
        self.word_at[n:n + len(new)], self.start_at[n:n + len(new)] = word_at, start_at


class Model:
    """Sorted hash and weight of every term of the examples, index of unit vectors, labels and ids of the examples, base rate of the label.

    ``new`` is the weight of a term that no example has: it counts in a text's length. The examples are numbered so
    that neighbours are alike; ``place`` is their order for ties.
    """

    def __init__(self, terms, idf, item, df, tf, toxic, ids, rate, new=0.0):
        self.terms, self.idf, self.rate, self.new = terms, idf, rate, new
        self.df, self.tf = df, tf.astype(np.min_scalar_type(int(tf.max(initial=0))))
        order = coherent_order(self._features(item, len(ids)), BLOCK)
        number = np.empty(len(ids), np.min_scalar_type(len(ids)))
        number[order] = np.arange(len(ids))
        self.toxic, self.ids, self.place = toxic[order], ids[order], order
        # postings by term, in as few bytes as they need: this is what is sent to the tasks
        self.item = number[item]

    def _weights(self, item: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Weights in the unit vectors, made a slice at a time: temporary arrays of all postings are what a task's memory goes for."""
        weight, square = np.empty(len(term)), np.zeros(n)
        slices = [slice(a, a + SLICE) for a in range(0, len(term), SLICE)]
        for some in slices:
            weight[some] = (1 + np.log(self.tf[some].astype(float))) * self.idf[term[some]]
            np.add.at(square, item[some], weight[some] * weight[some])
        length = np.sqrt(square)
        for some in slices:
            weight[some] /= length[item[some]]
        self.length = length
        return weight

    def _features(self, item: np.ndarray, n: int) -> np.ndarray:
        term = np.repeat(np.arange(len(self.df), dtype=np.int32), self.df)
        weight = self._weights(item, term, n)
        heavy = np.argsort(-np.bincount(term, weight * weight, len(self.df)), kind="stable")[:FEATURES]
        row = np.full(len(self.df), -1, np.int32)
        row[heavy] = np.arange(len(heavy))
        mine = np.flatnonzero(row[term] >= 0)
        out = np.zeros((n, max(1, len(heavy))), np.float32)
        out[item[mine], row[term[mine]]] = weight[mine]
        return out

    @property
    def index(self) -> BlockMaxIndex:
        """The unit vectors, in blocks of like examples."""
        if "_index" not in self.__dict__:
            self._index = self._built()
        return self._index

    def _built(self) -> BlockMaxIndex:
        self._sort()
        n, term = len(self.ids), np.repeat(np.arange(len(self.df), dtype=np.int32), self.df)
        return BlockMaxIndex(n, len(self.df), self.item, term, self._weights(self.item, term, n), BLOCK, ordered=True)

    def _sort(self) -> None:
        """Order the postings of each term by example, in place where term, example and count fit in one number."""
        term = np.repeat(np.arange(len(self.df), dtype=np.int32), self.df)
        right, left = 8 * self.tf.itemsize, 8 * (self.tf.itemsize + self.item.itemsize)
        if left + len(self.df).bit_length() > 64:
            order = np.lexsort((self.item, term))
            self.item, self.tf = self.item[order], self.tf[order]
            return
        packed = term.astype(np.uint64)
        packed <<= np.uint64(left - right)
        packed |= self.item
        packed <<= np.uint64(right)
        packed |= self.tf
        packed.sort()
        self.tf = packed.astype(self.tf.dtype)  # the lowest bits
        packed >>= np.uint64(right)
        self.item = packed.astype(self.item.dtype)

    def _places(self, names: list[str]) -> np.ndarray:
        """Place of each term in the vocabulary, -1 where it has none."""
        hashed = hashes(names)
        at = np.searchsorted(self.terms, hashed)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == hashed[known]
        return np.where(known, at, -1)

    def _numbered(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Terms that the words and their starts are: places from 0 on, -1 for no term, other negative numbers for terms that no example has."""
        memory = self.__dict__.setdefault("_seen", WordMemory())
        at = list(map(memory.number.get, found))
        if None in at:
            if len(memory.number) > KNOWN_WORDS:
                memory = self._seen = WordMemory()
            new = [w for w in found if w not in memory.number]
            starts = [w[:STEM] + "-" if len(w) > STEM else None for w in new]
            unseen = [x for x in dict.fromkeys(starts) if x is not None and x not in memory.start]
            for x, place in zip(unseen, self._places(unseen).tolist(), strict=True):
                memory.start[x] = place if place >= 0 else -2 - len(memory.start)
            memory.add(new, self._places(new), [-1 if x is None else memory.start[x] for x in starts])
            at = list(map(memory.number.get, found))
        at = np.array(at, np.int64)
        return memory.word_at[at], memory.start_at[at]

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(words(text))
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0)
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        word, start = self._numbered(list(counts))
        at, which = np.unique(start, return_inverse=True)
        times = np.bincount(which, tf)
        if at[0] < 0 and -1 in at[:np.searchsorted(at, 0)]:
            times, at = times[at != -1], at[at != -1]
        at, times = np.concatenate((word, at)), 1 + np.log(np.concatenate((tf, times)))
        known = at >= 0
        w, other = times[known] * self.idf[at[known]], times[~known] * self.new
        at = at[known]
        order = np.argsort(at)
        at, w = at[order], w[order]
        norm = np.sqrt((w * w).sum() + (other * other).sum())
        return at, w / norm if norm else w

    def score(self, text: str) -> tuple[float, list[int], list[float]]:
        return self.score_all([text])[0]

    def score_all(self, texts: list[str]) -> list[tuple[float, list[int], list[float]]]:
        """Votes weigh the squared cosine; the base rate counts as one more vote. Equal texts are scored once."""
        found, different = {}, list(dict.fromkeys(texts))
        for base in range(0, len(different), BATCH):
            part = different[base:base + BATCH]
            for text, (near, cosine) in zip(part, self.nearest([self.vector(x) for x in part]), strict=True):
                if len(near):
                    vote = cosine * cosine
                    score = (vote @ self.toxic[near] + PRIOR_WEIGHT * self.rate) / (vote.sum() + PRIOR_WEIGHT)
                    found[text] = float(min(1.0, max(0.0, score))), self.ids[near].tolist(), np.minimum(cosine, 1.0).tolist()
                else:
                    found[text] = self.rate, [], []
        return [found[x] for x in texts]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_parts", "_index", "_seen", "_opened")}

    def opened(self) -> float:
        """Share of the blocks that the texts scored so far have opened."""
        some, of_all = self.__dict__.get("_opened", (0, 0))
        return some / of_all if of_all else 0.0

    def parts(self):
        """Terms of many examples as one matrix per block and as a matrix of their maxima, starts of each term's postings, and the postings by example.

        The index they are made of has an entry for almost every posting of a rare term; no one asks for these later, so it is not kept.
        """
        if "_parts" not in self.__dict__:
            x = self._built()
            start = x.entry_start[x.term_entries]
            df = np.diff(start)
            row = np.full(x.n_terms, -1)
            many = np.flatnonzero(df * MANY >= max(1, x.n_items))
            row[many] = np.arange(len(many))
            dense = np.zeros((x.n_blocks, len(many), BLOCK), np.float32)
            most = np.zeros((len(many), x.n_blocks), np.float32)
            for r, t in enumerate(many):
                own = slice(start[t], start[t + 1])
                dense[x.item[own] // BLOCK, r, x.item[own] % BLOCK] = x.weight[own]
                own = slice(x.term_entries[t], x.term_entries[t + 1])
                most[r, x.entry_block[own]] = x.entry_max[own]
            own = np.r_[0, np.cumsum(np.bincount(x.item, minlength=x.n_items))]
            # from here on the postings by term serve sums in single precision only; the few exact weights are made anew from the counts
            single, n_terms = x.weight.astype(np.float32), x.n_terms
            del x
            order = np.argsort(self.item, kind="stable")
            tf = self.tf[order]
            term = np.repeat(np.arange(n_terms, dtype=np.int32), df)[order]
            del order
            times = 1 + np.log(np.maximum(1, np.arange(int(tf.max(initial=0)) + 1)).astype(float))
            self._parts = dense, most, row, start, single, own, term, tf, times
        return self._parts

    def nearest(self, vectors):
        """The NEAREST examples of highest cosine above 0 of each vector, ties by place; exact.

        The short postings of rare terms are added up; the rest of a block is bounded by the sum of the maxima of its
        frequent terms. The FIRST blocks of each text give a cosine to beat, then the blocks are opened whose bound reaches it.
        Sums in single precision find all examples that can be among the nearest, which are then scored in double precision.
        """
        dense, most, row, start, single, own, term, tf, times = self.parts()
        n, items, blocks = len(vectors), len(self.ids), len(dense)
        asked = np.zeros((n, dense.shape[1]), np.float32)
        rough = np.zeros((n, blocks * BLOCK), np.float32)
        for q, (at, w) in enumerate(vectors):
            r = row[at]
            frequent = r >= 0
            asked[q, r[frequent]] = w[frequent]
            at, w = at[~frequent], w[~frequent]
            size = start[at + 1] - start[at]
            shift = start[at] - np.cumsum(size) + size
            posts = np.arange(size.sum(), dtype=np.int32) + np.repeat(shift.astype(np.int32), size)
            rough[q, :items] = np.bincount(self.item[posts], single[posts] * np.repeat(w.astype(np.float32), size), items)
        bound = asked @ most + rough.reshape(n, blocks, BLOCK).max(axis=2)

        def score(chosen):
            for b in np.flatnonzero(chosen.any(axis=0)):
                some = np.flatnonzero(chosen[:, b])
                rough[some, b * BLOCK:(b + 1) * BLOCK] += asked[some] @ dense[b]

        opened = np.ones(bound.shape, bool)
        least = np.zeros(n, np.float32)
        if blocks > FIRST:
            first = np.argpartition(-bound, FIRST, axis=1)[:, :FIRST]
            opened[:] = False
            np.put_along_axis(opened, first, True, axis=1)
            score(opened)
            got = np.take_along_axis(rough.reshape(n, blocks, BLOCK), first[:, :, None], axis=1).reshape(n, FIRST * BLOCK)
            least = np.partition(got, FIRST * BLOCK - NEAREST, axis=1)[:, FIRST * BLOCK - NEAREST]
            more = ~opened & (bound > 0) & (bound >= least[:, None] - SLACK)
            score(more)
            opened |= more
        else:
            score(opened)
        before = self.__dict__.get("_opened", (0, 0))
        self._opened = before[0] + int(opened.sum()), before[1] + opened.size
        full = np.zeros(len(self.df))
        for q, (at, w) in enumerate(vectors):
            some = np.flatnonzero((rough[q] > 0) & (rough[q] >= least[q] - SLACK))
            if len(some) > NEAREST:
                near = rough[q, some]
                some = some[near >= np.partition(near, len(some) - NEAREST)[len(some) - NEAREST] - SLACK]
            full[at] = w
            size = own[some + 1] - own[some]
            posts = ragged(own[some], size)
            weight = times[tf[posts]] * self.idf[term[posts]] / np.repeat(self.length[some], size)
            cosine = np.bincount(np.repeat(np.arange(len(some)), size), weight * full[term[posts]], len(some))
            full[at] = 0
            best = np.lexsort((self.place[some], -cosine))[:NEAREST]
            yield some[best], cosine[best]


def fit(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text: str = "text",
        label: str = "toxic", examples: int = EXAMPLES) -> Model:
    """A model from at most ``examples`` labelled rows, chosen by the hash of their id.

    ``usable`` is a condition on the id for rows that may be learnt from. Rows without id or label are not
    used; an id with several labels has the larger one; an id with several texts gives several examples. No
    labelled text at all gives a model whose score is 0 everywhere.

    Every term of every example is in the index. A term weighs its idf times LEAST_WEIGHT, and up to its whole idf as its
    correlation with the label, the root of chi-square over n, nears 1, whichever label it points to; below three
    examples chi-square says nothing.
    """
    chosen = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_y")) \
        .filter("_id is not null and _y in (0, 1)")
    if usable is not None:
        chosen = chosen.filter(usable(F.col("_id")))
    chosen = chosen.groupBy("_id").agg(F.max("_y").alias("_y")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(examples)
    # the sample has at most ``examples`` rows of two numbers
    known = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text")) \
        .join(F.broadcast(chosen), "_id")

    def count(batches):
        for batch in batches:
            found = [term_counts(x or "") for x in batch.column("_text").to_pylist()]
            names = [hashes(c) for c in found]
            # in the order of the hashes, so that equal texts make equal rows
            order = [np.argsort(h) for h in names]
            tf = [np.fromiter(c.values(), np.int32, len(c))[o] for c, o in zip(found, order, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), pa.array([h[o].view(np.int64) for h, o in zip(names, order, strict=True)], pa.list_(pa.int64())),
                                              pa.array(tf, pa.list_(pa.int32()))], names=["id", "y", "terms", "tf"])

    # at most ``examples`` texts, each a row of numbers
    got = known.select("_id", "_y", "_text").mapInArrow(count, "id long, y int, terms array<long>, tf array<int>").toArrow()
    n, pos = len(got), int(np.sum(got["y"].to_numpy()))
    if not n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), *[np.zeros(0, np.int64)] * 3, np.zeros(0), np.zeros(0, np.int64), 0.0)
    lists = got["terms"].combine_chunks()
    ids, y, size = got["id"].to_numpy(), got["y"].to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    flat, tf = lists.flatten().to_numpy().view(np.uint64), got["tf"].combine_chunks().flatten().to_numpy()
    del got, lists
    starts = np.r_[0, np.cumsum(size)[:-1]]
    # by id, and texts of one id by their terms
    order = np.array(sorted(range(n), key=lambda i: (ids[i], flat[starts[i]:starts[i] + size[i]].tobytes(), tf[starts[i]:starts[i] + size[i]].tobytes())), np.int64)
    at = ragged(starts[order], size[order])
    flat, tf, ids, y = flat[at], tf[at], ids[order], y[order].astype(float)
    item = np.repeat(np.arange(n, dtype=np.int32), size[order])
    del at
    vocabulary = np.unique(flat)
    code = np.searchsorted(vocabulary, flat).astype(np.int32)
    del flat
    df, a = np.bincount(code, minlength=len(vocabulary)), np.bincount(code, y[item], len(vocabulary))
    chi2 = n * (a * (n - pos) - (df - a) * pos) ** 2 / np.maximum(1.0, float(pos) * (n - pos) * df * (n - df))
    telling = np.where((df >= 3) & (df < n), np.minimum(1.0, np.sqrt(chi2 / n)), 0.0)
    weight_of = (np.log((n + 1) / (df + 1)) + 1) * (LEAST_WEIGHT + (1 - LEAST_WEIGHT) * telling)
    order = np.lexsort((item, code))
    return Model(vocabulary, weight_of, item[order], df, tf[order], y, ids, pos / n, LEAST_WEIGHT * (np.log(n + 1) + 1))


def score_toxicity(docs: DataFrame, model: Model, text: str = "text",
                   names: tuple[str, ...] = ("toxicity", "predicted", "nearest_ids", "nearest_cosines")) -> DataFrame:
    """Append ``toxicity`` (0 to 1), ``predicted`` (1 from 0.5 on) and the nearest examples as evidence.

    A null or empty text, and one without any term of the examples, has the base rate and no evidence.
    Repeated rows get equal scores; ties between examples go to the smaller position in the index.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value

        def compute(texts):
            found = m.score_all(texts)
            return [[f[0] for f in found], [int(f[0] >= 0.5) for f in found], [f[1] for f in found], [f[2] for f in found]]
        return compute

    return append_columns(docs, text, [
        T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType()),
        T.StructField(names[2], T.ArrayType(T.LongType())), T.StructField(names[3], T.ArrayType(T.DoubleType()))], start)
