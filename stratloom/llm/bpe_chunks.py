"""Byte-level BPE by content-defined chunks: shared chunks are encoded once, joins are repaired."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from ..operators.tools import materialise
from .common import RollingHash, text_slices

WINDOW = 24  # bytes that decide whether a chunk ends behind them
CHUNK_BITS = 10  # a chunk has 2**10 bytes on average
FILTER_BITS = 1 << 26  # of the broadcast filter of shared chunks, whatever the corpus
# the pattern that splits text before the merges of the byte-level vocabulary: a fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# behind a printable ASCII character, white space starts a new piece of the pattern whatever stands around
_CUT = re.compile(rb"[\x21-\x7e](?=[\t\n\x0b\x0c\r ])")


class Codec:
    """Vocabulary, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the 256 printable stand-ins of the byte-level alphabet: printable bytes are themselves, others follow
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        self.bytes = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        size = max(self.bytes) + 1
        self.lengths = np.array([len(self.bytes.get(i, b"")) for i in range(size)], np.int64)
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.stops = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), self.dtype)

    def spell(self, ids) -> bytes:
        return b"".join([self.bytes[i] for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that are no UTF-8 become replacement characters; special tokens are kept."""
        return self.spell(ids).decode("utf-8", "replace")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens of two neighbouring stretches of text as if they had been encoded in one.

        A window over the join is encoded anew and widened until it agrees with a piece of what stands on
        either side, or has taken in a whole side.
        """
        n = 16
        while True:
            tail, head = left[-n:], right[:n]
            whole_left, whole_right = len(tail) == len(left), len(head) == len(right)
            before, after = self.spell(tail), self.spell(head)
            # places where pieces start, as bytes from the start of the window, on the left and on the right
            both = before + after
            cuts = [m.end() for m in _CUT.finditer(both)]
            on_left = ([0] if whole_left else []) + [c for c in cuts if c < len(before)]
            on_right = [c for c in cuts if c >= len(before)] + ([len(both)] if whole_right else [])
            if (len(on_left) > 1 or whole_left) and (len(on_right) > 1 or whole_right):
                q = on_left[-1]
                q2 = on_left[-2] if len(on_left) > 1 else q
                r = on_right[0]
                r2 = on_right[1] if len(on_right) > 1 else r
                ends_l = np.r_[0, np.cumsum(self.lengths[tail])]
                ends_r = np.r_[0, np.cumsum(self.lengths[head])] + len(before)
                try:
                    new = self.encode(both[q2:r2].decode("utf-8"))
                except UnicodeDecodeError:
                    new = np.zeros(0, self.dtype)
                i, i2 = np.searchsorted(ends_l, [q, q2])
                j, j2 = np.searchsorted(ends_r, [r, r2])
                keep_l, keep_r = tail[i2:i], head[j:j2]
                if len(new) and ends_l[i2] == q2 and ends_r[j2] == r2 and len(new) >= len(keep_l) + len(keep_r) \
                        and np.array_equal(new[:len(keep_l)], keep_l) and np.array_equal(new[len(new) - len(keep_r):], keep_r):
                    return np.concatenate((left[:len(left) - len(tail) + i2], new, right[j2:]))
            if whole_left and whole_right:
                return self.encode(both.decode("utf-8"))
            n *= 2

    def joined(self, parts: list[np.ndarray]) -> np.ndarray:
        """One array; parts are joined from the left, and only the end of what stands there is looked at."""
        out: list[np.ndarray] = []
        for part in parts:
            if not len(part):
                continue
            if not out:
                out.append(part)
                continue
            last = out.pop()
            if len(last) < 64 and out:
                last = np.concatenate((out.pop(), last))
            # keep the untouched start apart, so that long texts are not copied at every join
            if len(last) > 4096:
                cut = self._safe(last, len(last) - 2048)
                out.append(last[:cut])
                last = last[cut:]
            out.append(self.join(last, part))
        return np.concatenate(out) if out else np.zeros(0, self.dtype)

    def _safe(self, ids: np.ndarray, near: int) -> int:
        """A token at or before ``near`` that starts a piece of the pattern; 0 where none is found."""
        n = 64
        while near > 0:
            part = ids[max(0, near - n):near + 1]
            text = self.spell(part)
            ends = np.r_[0, np.cumsum(self.lengths[part])]
            for m in reversed(list(_CUT.finditer(text))):
                i = int(np.searchsorted(ends, m.end()))
                if ends[i] == m.end() and i < len(part):
                    return max(0, near - n) + i
            if n >= near:
                return 0
            n *= 4
        return 0


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


class Chunker:
    """Splits text where a rolling hash of the last bytes says so, and names each chunk by its content."""

    def __init__(self):
        self.hashes = RollingHash(0), RollingHash(1)
        self.table = RollingHash.mixed(np.arange(256))

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end, name, second name) of the chunks of all texts, in order; starts within the joined bytes."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        base = np.r_[0, np.cumsum(size)]
        mixed = self.table[data]
        first = self.hashes[0].prefix(mixed)
        n = len(data)
        at = np.arange(WINDOW, n)
        rolling = self.hashes[0].spans(first, at - WINDOW, at)
        # the highest bits depend on all bytes of the window
        ends = at[(rolling >> np.uint64(64 - CHUNK_BITS) == 0) & (data[WINDOW:] & 0xC0 != 0x80)]
        text = np.searchsorted(base, ends, side="right") - 1
        ends = ends[ends - base[text] >= WINDOW]
        ends = np.unique(np.concatenate((ends, base[1:])))
        ends = ends[ends > 0]
        starts = np.r_[0, ends[:-1]]
        second = self.hashes[1].prefix(mixed)
        names = [h.spans(p, starts, ends) ^ RollingHash.mixed(ends - starts) for h, p in zip(self.hashes, (first, second), strict=True)]
        return np.searchsorted(base, starts, side="right") - 1, starts, ends, *names


def _segments(c: Codec, texts: list[str]) -> tuple[list[bytes], list[tuple[int, int | None]]]:
    """Texts cut at special tokens: (stretches, their (row, special id behind the stretch))."""
    stretches, owner = [], []
    for row, text in enumerate(texts):
        parts = c.stops.split(text) if c.stops and any(s in text for s in c.special) else [text]
        for i in range(0, len(parts), 2):
            stretches.append(parts[i].encode())
            owner.append((row, c.special[parts[i + 1]] if i + 1 < len(parts) else None))
    return stretches, owner


def shared_filter(docs: DataFrame, tokenizer: str, text: str = "text") -> np.ndarray:
    """Bits at the names of chunks that stand at two places or more of the corpus.

    Names are combined before the shuffle, so a chunk of a third of all texts sends one row per task. The
    filter has a fixed size; a bit set by another chunk makes a chunk travel that need not, and nothing else.
    """
    def names(batches):
        c, chunker = codec(tokenizer), Chunker()
        for batch in batches:
            found = []
            for _, texts in text_slices(batch.column("t")):
                _, _, _, a, _ = chunker.split(_segments(c, texts)[0])
                found.append(a)
            a, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n)], names=["a", "n"])

    shared = docs.select(F.col(text).alias("t")).mapInArrow(names, "a long, n long") \
        .groupBy("a").agg(F.sum("n").alias("n")).filter("n > 1")
    bit = F.col("a").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = shared.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    got = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out


OWN, SHARED, DONE = 0, 1, 2
PIECES = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", T.LongType()), T.StructField("seq", T.LongType()),
                       T.StructField("kind", T.IntegerType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                       T.StructField("body", T.BinaryType())])
_PIECE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
RESULT = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]


def digest(c: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()


def _pieces(c: Codec, chunker: Chunker, bits: np.ndarray, texts: list[str], cache: dict) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """For each text its pieces (kind, name, second name, body): own stretches as ids, shared chunks as bytes."""
    stretches, owner = _segments(c, texts)
    joined = b"".join(stretches)
    part, starts, ends, a, b = chunker.split(stretches)
    at = a & np.uint64(FILTER_BITS - 1)
    shared = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)).astype(np.int64) & 1).astype(bool)
    first = np.searchsorted(part, np.arange(len(stretches) + 1))
    out: list[tuple[int, int, int, bytes]] = []
    row = 0

    def own(run):
        return (OWN, 0, 0, c.joined(run).tobytes())

    for s, (of, special) in enumerate(owner):
        if of != row:
            yield out
            out, row = [], of
        run: list[np.ndarray] = []
        for k in range(first[s], first[s + 1]):
            body = joined[starts[k]:ends[k]]
            if shared[k]:
                if run:
                    out.append(own(run))
                    run = []
                out.append((SHARED, int(a[k].view(np.int64)), int(b[k].view(np.int64)), body))
            else:
                key = (int(a[k]), int(b[k]))
                if key not in cache:
                    if len(cache) >= 4096:
                        cache.clear()
                    cache[key] = c.encode(body.decode())
                run.append(cache[key])
        if run:
            out.append(own(run))
        if special is not None:
            # nothing joins over a special token
            out.append((OWN, 1, 0, np.array([special], c.dtype).tobytes()))
    if owner:
        yield out


def _assemble(c: Codec, parts: list[tuple[bool, np.ndarray]]) -> np.ndarray:
    """Ids of a text from its (is special, ids) in order."""
    out, run = [], []
    for special, ids in parts:
        if special:
            out += [c.joined(run), ids]
            run = []
        else:
            run.append(ids)
    return np.concatenate([*out, c.joined(run)])


def encode_corpus(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), one row per row of ``docs``; with ``keep_ids`` the ids too.

    1. Chunk names of all texts are counted; those that occur again fill a filter of fixed size.
    2. One pass encodes the other chunks where they stand. Texts without a shared chunk are finished there;
       of the rest, encoded stretches and shared chunks are written out.
    3. Each shared chunk is encoded once, sent to the places that hold it, and all joins are repaired.

    Ids, also of texts with special tokens inside, are those of the tokenizers library. Null and empty texts
    have no token. Ids of rows may be null or repeated; each row gets its own result.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(shared_filter(docs, tokenizer, text))

    def split(batches):
        c, chunker, cache = codec(tokenizer), Chunker(), {}
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for at, texts in text_slices(batch.column("t")):
                rows = []
                for i, pieces in enumerate(_pieces(c, chunker, bits.value, texts, cache)):
                    row += 1
                    if not any(p[0] == SHARED for p in pieces):
                        n, x, y, ids = finish([(p[1] == 1, np.frombuffer(p[3], c.dtype)) for p in pieces], c)
                        pieces = [(DONE, n, 0, bytes.fromhex(x + y) + (ids.tobytes() if keep_ids else b""))]
                    rows += [(row, keys[at + i], n, kind, a, b, body) for n, (kind, a, b, body) in enumerate(pieces)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)],
                                                 names=PIECES.names)

    def finish(parts, c):
        ids = _assemble(c, parts)
        return *digest(c, ids), ids

    pieces = materialise(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(split, PIECES))

    def encode(batches):
        c = codec(tokenizer)
        for batch in batches:
            ids = [c.encode(x.as_py().decode()).tobytes() for x in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ids, pa.binary())], names=["a", "b", "body"])

    open_ = pieces.filter(F.col("kind") == SHARED)
    once = open_.groupBy("a", "b").agg(F.first("body").alias("body")).mapInArrow(encode, "a long, b long, body binary")
    sent = open_.select("row", "id", "seq", "a", "b").join(once, ["a", "b"]).select("row", "id", "seq", F.lit(False).alias("special"), "body")
    kept = pieces.filter(F.col("kind") == OWN).select("row", "id", "seq", (F.col("a") == 1).alias("special"), "body")
    # the pieces of one text
    texts = sent.union(kept).groupBy("row").agg(F.max("id").alias("id"), F.sort_array(F.collect_list(F.struct("seq", "special", "body"))).alias("parts"))
    out_type = T.StructType([T.StructField("id", T.LongType()), *RESULT, *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def assemble(batches):
        c = codec(tokenizer)
        for batch in batches:
            for row in range(batch.num_rows):
                parts = [(p["special"], np.frombuffer(p["body"], c.dtype)) for p in batch.column("parts")[row].as_py()]
                n, x, y, ids = finish(parts, c)
                cols = [batch.column("id").slice(row, 1), pa.array([n], pa.int64()), pa.array([x]), pa.array([y])]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array([ids.tobytes()], pa.binary())] if keep_ids else []), names=out_type.names)

    whole = texts.select("id", "parts").mapInArrow(assemble, out_type)
    body = F.col("body")
    done = pieces.filter(F.col("kind") == DONE).select(
        "id", F.col("a").alias("n_tokens"), F.lower(F.hex(F.substring(body, 1, 32))).alias("ids_sha256"),
        F.lower(F.hex(F.substring(body, 33, 32))).alias("decoded_sha256"), *([F.expr("substring(body, 65)").alias("ids")] if keep_ids else []))
    return done.union(whole)


def decode_corpus(encoded: DataFrame, tokenizer: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Append the text of the ids that :func:`encode_corpus` keeps; null ids give a null text."""
    kept = encoded.drop(column)
    names = [*kept.columns, column]

    def run(batches):
        c = codec(tokenizer)
        for batch in batches:
            got = [None if x is None else c.decode(np.frombuffer(x, c.dtype)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.StringType())]))
