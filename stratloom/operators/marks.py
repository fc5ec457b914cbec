"""What tasks hold while they read pages: the starts and the words of quotes, a bounded number of bytes at a time.

Pages and quotes are bytes of ``functions.python.search_bytes``; a batch of pages is looked through as one array of bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAGE_END = b"\0"  # behind every page; no quote has it
_QUOTE_END = b"\1"  # behind every quote; no page has it
_SPACE, _LEVELS = 32, (12, 16, 24, 40)  # the key of a text is so many of its first characters, the most it has; none has fewer than the least
_BLOCK = 1 << 17  # bytes of pages that are hashed at a time
_PART = 1 << 21  # bytes of pages that are looked through as one array
_PAIRS = 1 << 17  # quotes and places of pages with equal keys that are compared at a time
_WORD = 4  # letters of the shortest word that counts


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of every run, one behind another."""
    return np.arange(size.sum(), dtype=np.int64) + np.repeat(start - np.cumsum(size) + size, size)


def _xx(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), seed=42)


def _turn(x, n: int):
    """Bits turned left, of a Column or of numbers."""
    if isinstance(x, Column):
        return F.shiftleft(x, n).bitwiseOR(F.shiftrightunsigned(x, 64 - n))
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def mixed(*parts):
    """One number from several hashes, of Columns or of numbers; equal for both."""
    out = _turn(parts[0], 5)
    for i, x in enumerate(parts[1:]):
        turned = _turn(x, 17 + 12 * i)
        out = out.bitwiseXOR(turned) if isinstance(out, Column) else out ^ turned
    return out


# ---------------------------------------------------------------- keys of one text (the search below no longer uses them, tests/test_quotes.py does)
class Words:
    """Words a task has met, with the hashes of the word, of its last and first letter, and of its last and first six letters."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.hashes = np.zeros((1 << 10, 5), np.uint64)
        self.size = np.zeros(1 << 10, np.int64)

    def of(self, words: list[str]) -> np.ndarray:
        at = list(map(self.number.get, words))
        if None in at:
            for w in dict.fromkeys(words):
                if w not in self.number:
                    n = self.number[w] = len(self.number)
                    if n == len(self.size):
                        self.hashes, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.hashes, self.size))
                    self.hashes[n] = [_xx(x) for x in (w, w[-1:], w[:1], w[-6:], w[:6])]
                    self.size[n] = len(w)
            at = list(map(self.number.get, words))
        return np.array(at, np.int64)


def text_keys(text: str, pub: np.uint64, kinds: list[str], known: Words) -> np.ndarray:
    """All keys of these kinds of a page; ``quotes`` makes the same ones of the texts it looks for."""
    words = text.split(" ")
    at = known.of(words)
    word, last, first, end, start = known.hashes[at].T
    long, out = known.size[at] >= 6, []
    if "c" in kinds and len(at) > 3:
        out.append(mixed(pub, word[1:-2], word[2:-1], last[:-3], first[3:]))
    if "t" in kinds and len(at) > 2:
        out.append(mixed(pub, word[1:-1], last[:-2], first[2:]))
    if "p" in kinds and len(at) > 1:
        out.append(mixed(pub, start[1:], last[:-1])[long[1:]])
    if "s" in kinds and len(at) > 1:
        out.append(mixed(pub, end[:-1], first[1:])[long[:-1]])
    if "g" in kinds:
        runs = {w[j:j + 12] for w in words if len(w) >= 12 for j in range(len(w) - 11)}
        out.append(mixed(pub, np.array([_xx(x) for x in runs], np.uint64)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


# ---------------------------------------------------------------- hashes of bytes
_MOD = (1 << 64) - 1
_CODE = np.random.default_rng(1251).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x2545F4914F6CDD1D
_B1, _B2, _B4, _B8, _B16 = (np.uint64(pow(_BASE, n, 1 << 64)) for n in (1, 2, 4, 8, 16))
_MIX, _PUB = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)


def _windows(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of as many bytes from each byte on as the levels have."""
    one = _CODE[data]
    two = one[:-1] * _B1 + one[1:]
    four = two[:-2] * _B2 + two[2:]
    eight = four[:-4] * _B4 + four[4:]
    sixteen = eight[:-8] * _B8 + eight[8:]
    more = sixteen[:-8] * _B8 + eight[16:]
    return eight[:-4] * _B4 + four[8:], sixteen, more, more[:-16] * _B16 + sixteen[24:]


class Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, _BLOCK + 1)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


def _words(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and hash of the words of ``_WORD`` letters or more; ``data`` ends behind a word."""
    end = np.flatnonzero(data <= _SPACE)
    start = np.r_[0, end[:-1] + 1] if len(end) else end
    long = end - start >= _WORD
    start, end = start[long], end[long]
    up, down = powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * up[:len(data)], out=sums[1:])
    return start, end - start, (sums[end] - sums[start]) * down[start]


class Keys:
    """Distinct keys behind a table of flags that most other keys do not pass."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = min(24, max(16, int(len(keys)).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.flags = np.zeros(1 << bits, bool)
        self.flags[keys >> self.shift] = True

    def among(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these keys are known, and the numbers they have here."""
        some = np.flatnonzero(self.flags[keys >> self.shift])
        asked = keys[some]
        at = np.searchsorted(self.keys, asked)
        met = self.keys[np.minimum(at, len(self.keys) - 1)] == asked
        return some[met], at[met]


# ---------------------------------------------------------------- pages and quotes
class Pages:
    """Neighbouring pages of a batch as one array of bytes, with the numbers of their publications (-1 for one that is not asked for)."""

    def __init__(self, norm: pa.LargeBinaryArray, pub: np.ndarray, first: int):
        off = np.frombuffer(norm.buffers()[1], np.int64)[norm.offset:norm.offset + len(norm) + 1]
        self.start, self.pub, self.first = off - off[0], pub, first
        self.size = int(self.start[-1])
        self.data = np.zeros(self.size + 64, np.uint8)
        self.data[:self.size] = np.frombuffer(norm.buffers()[2], np.uint8)[off[0]:off[-1]]
        self.mark = pub.view(np.uint64) * _PUB

    def at(self, place: np.ndarray) -> np.ndarray:
        """The page of each place."""
        return np.searchsorted(self.start, place, "right") - 1


def _runs(start: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of ``size`` bytes or one text; ``start`` has where each begins and the last ends."""
    i, n = 0, len(start) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(start, start[i] + size, "right")) - 1)
        yield i, j
        i = j


def _parts(batch: pa.RecordBatch, pubs: dict[str, int]) -> Iterator[Pages]:
    """The pages of a batch, ``_PART`` bytes at a time."""
    norm = batch.column("norm").cast(pa.large_binary())
    pub = np.array([pubs.get(p, -1) for p in batch.column("publication").to_pylist()], np.int64)
    for i, j in _runs(np.frombuffer(norm.buffers()[1], np.int64)[norm.offset:norm.offset + len(norm) + 1], _PART):
        yield Pages(norm.slice(i, j - i), pub[i:j], i)


class Quotes:
    """Distinct texts of quotes, one behind another, and which of them is asked for in which publication."""

    def __init__(self, quotes: pa.Table):
        asked = quotes["asked"].combine_chunks()
        pub = asked.flatten().field("publication").dictionary_encode()
        self.pubs = {p: i for i, p in enumerate(pub.dictionary.to_pylist())}
        self.pub = pub.indices.to_numpy().astype(np.int64)
        self.ids = asked.flatten().field("q").to_numpy()
        self.text = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy())
        texts = quotes["norm"].combine_chunks().to_pylist()
        self.size = np.array([len(x) for x in texts], np.int64)
        self.start = np.r_[0, np.cumsum(self.size + 1)]
        self.data = np.frombuffer(_QUOTE_END.join([*texts, b""]) + _QUOTE_END * 64, np.uint8)


class QuoteStarts:
    """Distinct starts of quotes by level and key, and the starts of each quote in the order of the stages."""

    def __init__(self, quotes: Quotes, first: int, words: tuple[int, ...]):
        size, begin, self.data, self.pubs, self.ids = quotes.size, quotes.start[:-1], quotes.data, quotes.pubs, quotes.ids
        # the n-th space of a text ends its first n words
        space = np.r_[np.flatnonzero(self.data == _SPACE), np.full(max(words), len(self.data))]
        at = np.searchsorted(space, begin)
        length = np.stack([size, np.minimum(size, first), *[np.minimum(size, space[at + n - 1] - begin) for n in words]], 1).astype(np.int32)
        hashed, powers = np.zeros(length.shape, np.uint64), Powers()
        for i, j in _runs(quotes.start, _BLOCK):
            a, b = quotes.start[i], quotes.start[j]
            up, down = powers.of(b - a + 1)
            sums = np.r_[np.uint64(0), np.cumsum(_CODE[self.data[a:b]] * up[:b - a])]
            at = begin[i:j, None] - a
            hashed[i:j] = (sums[at + length[i:j]] - sums[at]) * down[at] * _MIX + length[i:j].astype(np.uint64)
        # quotes of a publication that start alike share the start
        long = (length >= _LEVELS[0])[quotes.text]
        quote, stage = np.nonzero(long)
        text = quotes.text[quote]
        _, one, same = np.unique((hashed[text, stage] + quotes.pub[quote].view(np.uint64) * _PUB) * _MIX, return_index=True, return_inverse=True)
        eight, size = _eights(self.data), length[text, stage]
        other = np.flatnonzero(one[same] != np.arange(len(same)))
        like = one[same[other]]
        unlike = other[(size[other] != size[like]) | (_common(eight, begin[text[other]], eight, begin[text[like]], size[other]) < size[other])]
        same[unlike], one = len(one) + np.arange(len(unlike)), np.r_[one, unlike]
        begin, self.size, mark = begin[text[one]], size[one], quotes.pub[quote[one]].view(np.uint64) * _PUB
        del text, size, other, like, hashed, length

        level = np.searchsorted(_LEVELS, self.size, "right") - 1
        key, keys, n = np.zeros(len(one), np.uint64), np.zeros(len(one), np.uint64), 0
        for k, m in enumerate(_LEVELS):
            for n in range(n, m):
                key = key * _B1 + _CODE[self.data[np.minimum(begin + n, len(self.data) - 1)]]
            n = m
            if k == 0:
                self.root = Keys(np.unique((key + mark) * _MIX))
            keys[level == k] = ((key + mark) * _MIX)[level == k]
        order = np.lexsort((keys, level))
        place = np.empty(len(order) + 1, np.int32)
        place[order], place[-1] = np.arange(len(order)), len(order)
        self.begin, self.size, self.levels = begin[order].astype(np.int32 if len(self.data) < 1 << 31 else np.int64), self.size[order], []
        for k in range(len(_LEVELS)):
            of, some = int((level < k).sum()), keys[order][level[order] == k]
            some, first_of = np.unique(some, return_index=True)
            self.levels.append((Keys(some), np.r_[first_of + of, int((level <= k).sum())].astype(np.int32)))
        self.start = np.full(long.shape, len(order), np.int32)  # a start that is too short is one behind the last
        self.start[quote, stage] = place[same]

    def find(self, pages: Pages) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and the pages that hold them."""
        there, here = _eights(pages.data), _eights(self.data)
        for a in range(0, pages.size if len(self.size) else 0, _BLOCK):
            b = min(a + _BLOCK, pages.size)
            i, j = pages.at(np.array([a, b - 1]))
            mark = np.repeat(pages.mark[i:j + 1], np.diff(np.clip(pages.start[i:j + 2], a, b)))
            hashes = _windows(pages.data[a:b + _LEVELS[-1] - 1])
            place, _ = self.root.among((hashes[0][:b - a] + mark) * _MIX)
            mark = mark[place]
            for hashed, (known, first) in zip(hashes, self.levels, strict=True):
                met, key = known.among((hashed[place] + mark) * _MIX)
                n = first[key + 1] - first[key]
                # cut where a multiple of _PAIRS is reached
                cut = np.flatnonzero(np.diff(np.cumsum(n, dtype=np.int64) // _PAIRS)) + 1
                for x, y in zip(np.r_[0, cut], np.r_[cut, len(n)], strict=True):
                    start, at = _ragged(first[key[x:y]], n[x:y]), np.repeat(place[met[x:y]] + a, n[x:y])
                    whole = _common(there, at, here, self.begin[start], self.size[start]) >= self.size[start]
                    yield start[whole], pages.at(at[whole])

    def best(self, pages: Iterable[Pages], rank: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotes, the first stage that a page holds, and the rank of the first of these pages."""
        none = np.iinfo(np.int32).max
        first = np.full(len(self.size) + 1, none, np.int32)
        for held in pages:
            for start, page in self.find(held):
                np.minimum.at(first, start, rank[page + held.first])
        first = first[self.start]
        stage = (first < none).argmax(1)
        quote = np.flatnonzero(first.min(1, initial=none) < none)
        return quote, stage[quote], first[quote, stage[quote]]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as a number."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def _common(a: np.ndarray, at: np.ndarray, b: np.ndarray, begin: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes are alike from these places on, eight at a time until ``most`` are."""
    same, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(open_):
        far = same[open_]
        unlike = a[at[open_] + far] ^ b[begin[open_] + far]
        more = unlike == 0
        bit = unlike & (~unlike + np.uint64(1))
        far[more] += 8
        far[~more] += np.log2(bit[~more]).astype(np.int64) >> 3
        same[open_] = far
        open_ = open_[more & (far < most[open_])]
    return same


class QuoteWords:
    """Hashed words of quotes: the rare ones as postings, the others by quote.

    A page with ``need`` of a quote's n words holds ``certain`` of its n - need + ``certain`` rarest; the others are looked for only then.
    Words are distinct, of five letters or more, of four if there are not ``certain`` of five; a word is rare if few of these quotes have it.
    """

    def __init__(self, quotes: Quotes, certain: int):
        self.certain, self.pubs, powers, found = certain, quotes.pubs, Powers(), []
        for i, j in _runs(quotes.start, _BLOCK):
            a = quotes.start[i]
            start, length, hashed = _words(quotes.data[a:quotes.start[j]], powers)
            of = np.searchsorted(quotes.start, start + a, "right") - 1
            order = np.lexsort((hashed, of))
            of, length, hashed = of[order], length[order], hashed[order]
            new = np.r_[True, (of[1:] != of[:-1]) | (hashed[1:] != hashed[:-1])] if len(of) else np.zeros(0, bool)
            found.append((of[new], length[new], hashed[new]))
        of, length, hashed = map(np.concatenate, zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        five = np.bincount(of[length >= 5], minlength=len(quotes.size)) >= certain
        counts = (length >= 5) | ~five[of]
        of, hashed = of[counts], hashed[counts].astype(np.uint64)
        n = np.bincount(of, minlength=len(quotes.size))
        first = np.cumsum(n) - n

        asked = np.flatnonzero(n[quotes.text] >= certain)
        asked = asked[np.argsort(quotes.pub[asked], kind="stable")]
        self.ids, pub, text = quotes.ids[asked], quotes.pub[asked], quotes.text[asked]
        n = n[text]
        self.need = np.maximum(certain, np.floor(0.6 * n).astype(np.int64))
        self.base = np.searchsorted(pub, np.arange(len(self.pubs) + 1))  # quotes of a publication are neighbours
        quote = np.repeat(np.arange(len(asked)), n)
        words, word, often = np.unique((hashed[_ragged(first[text], n)] + pub[quote].view(np.uint64) * _PUB) * _MIX, return_inverse=True, return_counts=True)
        order = np.lexsort((word, often[word], quote))
        quote, word = quote[order], word[order]
        rare = np.arange(len(quote)) - np.repeat(np.cumsum(n) - n, n) < (n - self.need + certain)[quote]
        order = np.argsort(word[rare], kind="stable")
        self.keys = Keys(words)
        self.start = np.r_[0, np.cumsum(np.bincount(word[rare], minlength=len(words)))].astype(np.int64)
        self.quote = (quote - self.base[pub[quote]])[rare][order].astype(np.int32)
        self.other = word[~rare].astype(np.int32)
        self.own = np.r_[0, np.cumsum(n - np.minimum(n, n - self.need + certain))].astype(np.int64)
        self.here = np.zeros(len(words), bool)

    def match(self, pub: int, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quotes that a page of these different words holds enough words of, and how many."""
        found = self.quote[_ragged(self.start[page], self.start[page + 1] - self.start[page])]
        if len(found) * 16 > self.base[pub + 1] - self.base[pub]:
            n = np.bincount(found)
            quote = np.flatnonzero(n >= self.certain)
            n = n[quote]
        else:
            quote, n = np.unique(found, return_counts=True)
            quote, n = quote[n >= self.certain], n[n >= self.certain]
        quote = quote + self.base[pub]
        size = self.own[quote + 1] - self.own[quote]
        self.here[page] = True
        met = self.here[self.other[_ragged(self.own[quote], size)]]
        self.here[page] = False
        n = n + np.bincount(np.repeat(np.arange(len(quote)), size)[met], minlength=len(quote))
        enough = n >= self.need[quote]
        return quote[enough], n[enough]

    def find(self, pages: Pages, powers: Powers) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Quotes that a page holds enough words of, the page, and how many."""
        for i, j in _runs(pages.start, _BLOCK) if len(self.ids) else ():
            a, b = pages.start[i], pages.start[j]
            start, _, hashed = _words(pages.data[a:b], powers)
            page = pages.at(start + a)
            met, word = self.keys.among((hashed + pages.mark[page]) * _MIX)
            each = np.unique(page[met] * len(self.here) + word)
            page, word = each // len(self.here), each % len(self.here)
            edge = np.searchsorted(page, np.arange(i, j + 1))
            for k in range(i, j):
                quote, n = self.match(pages.pub[k], word[edge[k - i]:edge[k - i + 1]]) if edge[k - i] < edge[k - i + 1] else (page[:0], page[:0])
                if len(quote):
                    yield quote, k, n

    def best(self, pages: Iterable[Pages], rank: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotes, minus the most words that a page holds, and the rank of the first of these pages."""
        best = np.zeros(len(self.ids), np.int64)
        for held in pages:
            for quote, page, n in self.find(held, powers):
                best[quote] = np.minimum(best[quote], rank[page + held.first] - (n << 32))
        quote = np.flatnonzero(best)
        return quote, best[quote] >> 32, best[quote] & ((1 << 32) - 1)


def _look_through(pages: DataFrame, index: QuoteStarts | QuoteWords) -> DataFrame:
    """(q, value, ord, idx): the best page of each quote in each batch of pages (publication, ord, idx, norm)."""
    shared = pages.sparkSession.sparkContext.broadcast(index)

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, powers = shared.value, Powers()
        for batch in batches:
            if not len(batch):
                continue
            # places in the order of the least struct (ord, idx)
            at = pc.sort_indices(batch, sort_keys=[("ord", "ascending"), ("idx", "ascending")], null_placement="at_start").to_numpy()
            rank = np.empty(len(at), np.int64)
            rank[at] = np.arange(len(at))
            quote, value, place = index.best(_parts(batch, index.pubs), rank, powers)
            if len(quote):
                page = pa.array(at[place])
                yield pa.RecordBatch.from_arrays([pa.array(index.ids[quote]), pa.array(value.astype(np.int64)), batch.column("ord").take(page),
                                                  batch.column("idx").take(page)], names=["q", "value", "ord", "idx"])

    pages = pages.select("publication", "ord", "idx", "norm")
    return pages.mapInArrow(matches, StructType().add("q", "long").add("value", "long").add(pages.schema["ord"]).add(pages.schema["idx"]))


def starts_in_pages(pages: DataFrame, quotes: DataFrame, first: int, words: tuple[int, ...]) -> DataFrame:
    """(q, value, ord, idx) of the quotes (norm, asked: q and publication) that pages hold: value is 0 for the whole quote, 1 for its ``first`` characters, 2 … for
    its first ``words``, of 12 characters or more each.

    Quotes are held by every task, so they must be bounded in number. Places of pages meet the distinct starts through their first
    characters and are compared with them byte by byte; a start that many quotes share is looked for once.
    """
    return _look_through(pages, QuoteStarts(Quotes(quotes.toArrow()), first, words))


def quotes_in_pages(pages: DataFrame, quotes: DataFrame, certain: int) -> DataFrame:
    """(q, value, ord, idx) of the quotes (norm, asked: q and publication) that pages hold enough words of: value is minus their number.

    Quotes are held by every task, so they must be bounded in number.
    """
    return _look_through(pages, QuoteWords(Quotes(quotes.toArrow()), certain))
