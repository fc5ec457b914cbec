"""Token counts by rank-synchronous merging of ragged arrays of symbols."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RollingHash, append_columns, ragged

SPACE = 0x2581  # stands for a space in the pieces
KNOWN = 1 << 21  # counts of pre-tokens a task remembers, at most
ROUND = 1 << 17  # pre-tokens that are merged at once, at most
NEVER = np.int32(2**31 - 1)


class Merger:
    """Pieces, merge ranks and unit costs of a BPE model with byte fallback.

    Symbols are numbered by piece. Two neighbouring symbols merge if their joined text is a piece; the better
    the piece's score, the lower its rank. A character that is no piece costs as many tokens as it has bytes.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        usable = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): i for i in usable}
        score = np.array([model.get_score(i) for i in range(n)])
        order = np.full(n, NEVER, np.int64)
        order[usable] = np.unique(-score[usable], return_inverse=True)[1]
        pairs: dict[tuple[int, int], int] = {}
        for text, i in pieces.items():
            for cut in range(1, len(text)):
                left, right = pieces.get(text[:cut]), pieces.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = i
        key = np.array([left << 32 | right for left, right in pairs], np.int64)
        merged = np.array(list(pairs.values()), np.int64)
        # pieces that can at once grow into a piece of better rank: of their places only the first may merge in a round
        self.careful = np.zeros(n, bool)
        parts = np.array(list(pairs), np.int64).reshape(-1, 2)
        for side in (0, 1):
            self.careful[parts[order[merged] < order[parts[:, side]], side]] = True
        sort = np.argsort(key)
        self.key, self.merged = key[sort], merged[sort].astype(np.int32)
        self.rank = order[self.merged].astype(np.int32)
        self._hash_pairs()
        self.symbol = np.full(0x110000, -1, np.int32)
        for text, i in pieces.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        code = np.arange(0x110000)
        self.bytes = (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)).astype(np.int32)
        # neighbours that stand in no piece can never merge; for low codes that is looked up
        self.together = np.zeros((257, 257), bool)
        for text in pieces:
            low = [256 if ord(c) == SPACE else ord(c) if ord(c) < 256 else -1 for c in text]
            for a, b in zip(low, low[1:], strict=False):
                if a >= 0 and b >= 0:
                    self.together[a, b] = True
        # a space after another character opens a new pre-token unless some piece holds both
        self.space_inside = any(ord(b) == SPACE and ord(a) != SPACE for text in pieces for a, b in zip(text, text[1:], strict=False))

    def _hash_pairs(self) -> None:
        """An open table: slot -> number of the pair, with the longest way any key has to go."""
        bits = max(4, int(4 * len(self.key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, -1, np.int32)
        self.steps = 1
        at = self._slot(self.key)
        for i, slot in enumerate(at.tolist()):
            step = 0
            while self.slots[slot + step] >= 0:
                step += 1
            self.slots[slot + step] = i
            self.steps = max(self.steps, step + 1)
        if self.steps > 64:
            raise ValueError("too many pairs meet in one slot")

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the pair of each two symbols, or -1."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(len(key), -1, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(key[open_])
        for step in range(self.steps):
            got = self.slots[slot + step]
            some = got >= 0
            hit = some & (self.key[np.where(some, got, 0)] == key[open_])
            out[open_[hit]] = got[hit]
            go = some & ~hit
            open_, slot = open_[go], slot[go]
            if not len(open_):
                break
        return out

    def count(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token codes[start:start + length]."""
        out = np.zeros(len(starts), np.int64)
        for a in range(0, len(starts), ROUND):
            n = lengths[a:a + ROUND]
            flat = codes[ragged(starts[a:a + ROUND], n)]
            ids = self.symbol[flat]
            cost = np.where(ids >= 0, 1, self.bytes[flat]).astype(np.int32)
            owner = np.repeat(np.arange(len(n)), n)
            out[a:a + len(n)] = self._merge(ids, cost, owner, len(n))
        return out

    def _merge(self, ids: np.ndarray, cost: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Rounds: every sequence merges all places of its lowest rank, from the left where they overlap."""
        out = np.bincount(owner, cost, n).astype(np.int64)
        pair = self.look_up(ids[:-1], ids[1:])
        pair[owner[:-1] != owner[1:]] = -1
        pair = np.r_[pair, np.int32(-1)][:len(ids)]
        while True:
            rank = np.where(pair >= 0, self.rank[pair], NEVER)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
            if not len(first):
                return out
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(owner)])
            # sequences without a pair are finished
            live = best != NEVER
            if not live.all():
                keep = np.repeat(live, size)
                ids, owner, pair, rank = ids[keep], owner[keep], pair[keep], rank[keep]
                best, size = best[live], size[live]
                if not len(ids):
                    return out
            chosen = rank == np.repeat(best, size)
            at = np.flatnonzero(chosen)
            # of places that overlap, every second one of a run is taken
            opens = np.r_[True, np.diff(at) > 1]
            run = at[np.flatnonzero(opens)][np.cumsum(opens) - 1]
            at = at[(at - run) % 2 == 0]
            alone = np.r_[True, owner[at][1:] != owner[at][:-1]]
            at = at[alone | ~self.careful[self.merged[pair[at]]]]
            ids[at] = self.merged[pair[at]]
            out -= np.bincount(owner[at], minlength=n)
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            # only the pairs that touch a merged symbol change
            new = np.cumsum(keep)[at] - 1
            ids, owner, pair = ids[keep], owner[keep], pair[keep]
            touched = np.unique(np.r_[new, new[new > 0] - 1])
            inner = touched[touched < len(ids) - 1]
            pair[touched] = -1
            inner = inner[owner[inner] == owner[inner + 1]]
            pair[inner] = self.look_up(ids[inner], ids[inner + 1])


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


class Counter:
    """Counts tokens of texts; remembers pre-tokens by their 128-bit hash."""

    def __init__(self, path: str):
        self.merger = merger(path)
        self.hashes = RollingHash(0), RollingHash(1)
        self.names, self.second, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> np.ndarray:
        m = self.merger
        used = [t for t in texts if t]
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        out = np.zeros(len(texts), np.int64)
        if not used:
            return out
        # every text starts with a space of its own
        codes = np.frombuffer((" " + " ".join(used)).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        codes[codes == 32] = SPACE
        low = np.where(codes == SPACE, 256, np.where(codes < 256, codes, 257)).astype(np.int64)
        a, b = low[:-1], low[1:]
        known = (a < 257) & (b < 257)
        opens = known & ~m.together[np.where(known, a, 0), np.where(known, b, 0)]
        if not m.space_inside:
            opens |= (codes[1:] == SPACE) & (codes[:-1] != SPACE)
        text_start = np.r_[0, np.cumsum(size[size > 0])[:-1]]
        begin = np.r_[True, opens]
        begin[text_start] = True
        starts = np.flatnonzero(begin)
        lengths = np.diff(np.r_[starts, len(codes)])
        n = self._counts(codes, starts, lengths)
        out[size > 0] = np.add.reduceat(n, np.searchsorted(starts, text_start))
        return out

    def _counts(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        mixed = RollingHash.mixed(codes)
        length = RollingHash.mixed(lengths)
        one, two = [h.spans(h.prefix(mixed), starts, starts + lengths) ^ length for h in self.hashes]
        names, first, group = np.unique(one, return_index=True, return_inverse=True)
        if not np.array_equal(two[first][group], two):
            # two pre-tokens share a 64-bit name: count each for itself
            return self.merger.count(codes, starts, lengths)
        at = np.searchsorted(self.names, names)
        inside = np.minimum(at, max(0, len(self.names) - 1))
        old = (self.names[inside] == names) & (self.second[inside] == two[first]) if len(self.names) else np.zeros(len(names), bool)
        out = np.zeros(len(names), np.int64)
        out[old] = self.counts[inside[old]]
        new = np.flatnonzero(~old)
        if len(new):
            out[new] = self.merger.count(codes, starts[first[new]], lengths[first[new]])
            if len(self.names) + len(new) > KNOWN:
                self.names, self.second, self.counts = names, two[first], out
            else:
                add = new[self.names[inside[new]] != names[new]] if len(self.names) else new
                self.second = np.insert(self.second, at[add], two[first[add]])
                self.counts = np.insert(self.counts, at[add], out[add])
                self.names = np.insert(self.names, at[add], names[add])
        return out[group]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """Append ``n_bytes`` (of UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts have none of either. Counts are those of the sentencepiece library for the model,
    without begin and end marks; strings of control pieces inside texts are ordinary text.
    """
    def start():
        return lambda texts, c=Counter(model): [c(texts)]

    counted = append_columns(docs.drop("n_bytes", "over_limit"), text, [T.StructField("n_tokens", T.LongType())], start)
    return counted.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long")) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
