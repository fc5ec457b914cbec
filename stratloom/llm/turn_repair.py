"""Structure repair of conversations: bidirectional Dijkstra over the lattice of rows and roles."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tools import materialise

NULL = " "  # what a null role, text or number reads as
SPACE = r"\x20\x09-\x0D"

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5  # costs; the last is added to a truncated row that stays

# the roles (s?(ua)+)? as a machine: nothing yet, after the system turn, after a user, after an assistant
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
ACCEPTED = (NOTHING, ASSISTANT)
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURNED = (USER, USER, ASSISTANT, USER)  # by state, the state behind a turn whose role is changed or that is new
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Edges = Callable[[int], Iterator[tuple[str, int, int]]]


def _text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): five rows in twenty get one fault each, by the checksum of their id and turn.

    ``lost`` marks dropped rows; they stay so that a conversation without any other row is not forgotten.
    """
    kind = F.crc32(F.concat(_text_of(F.col("conv_id")), F.lit(":"), _text_of(F.col("turn"))).cast("binary")) % 20
    role, text = _text_of(F.col("role")), _text_of(F.col("text"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("lost"), F.explode(times).alias("copy")).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """Rows with ``key``, a SHA-256 of role and text, and the ``fault`` that a row shows by itself."""
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    ended = F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    fault = F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK).when(~ended, TRUNCATED).otherwise(SOUND)
    return rows.withColumn("key", key).withColumn("fault", fault)


class Search:
    """One direction of the search: costs, the least audit to each node as links, and a heap.

    A node is four times the number of rows behind it plus its state. Nodes of equal cost leave the heap in the
    direction's order of rows; an edge of cost 0 passes a row, so whatever gives a node an equal cost has left before it.
    """

    def __init__(self, size: int, starts: list[int], forward: bool):
        self.sign = 1 if forward else -1
        self.cost, self.back = array("q", [-1]) * size, array("q", [-1]) * size
        self.edit, self.done = bytearray(size), bytearray(size)
        self.settled = 0
        self.heap: list[tuple[int, int]] = []
        for node in starts:
            self.cost[node] = 0
            heappush(self.heap, (0, self.sign * node))

    def top(self) -> int | None:
        while self.heap and self.done[self.sign * self.heap[0][1]]:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self, edges: Edges) -> int:
        cost, entry = heappop(self.heap)
        node = self.sign * entry
        self.done[node] = 1
        self.settled += 1
        for edit, price, other in edges(node):
            held = self.cost[other]
            if held < 0 or cost + price < held:
                self.cost[other], self.edit[other], self.back[other] = cost + price, ord(edit), node
                heappush(self.heap, (cost + price, self.sign * other))
            elif cost + price == held and not self.done[other] and self._less(ord(edit), node, other):
                self.edit[other], self.back[other] = ord(edit), node
        return node

    def _less(self, edit: int, node: int, other: int) -> bool:
        """Is the audit through ``node`` less than the one that ``other`` holds? Both are read up to where they part or meet."""
        if self.back[other] < 0:
            return False
        x, y = (edit, node), (self.edit[other], self.back[other])
        if self.sign < 0:
            while x[0] == y[0] and x[1] != y[1] and self.back[x[1]] >= 0 and self.back[y[1]] >= 0:
                x, y = ((self.edit[n], self.back[n]) for n in (x[1], y[1]))
            return x[0] < y[0]
        mine, held = [x[0]], [y[0]]
        while x[1] != y[1]:  # the one further on steps back, until both stand on one node
            a, b = x[1], y[1]
            if (a >> 2, self.cost[a]) >= (b >> 2, self.cost[b]):
                x = (self.edit[a], self.back[a])
                mine.append(x[0])
            else:
                y = (self.edit[b], self.back[b])
                held.append(y[0])
        return mine[::-1] < held[::-1]

    def audit(self, node: int) -> str:
        out = bytearray()
        while self.back[node] >= 0:
            out.append(self.edit[node])
            node = self.back[node]
        return (out[::-1] if self.sign > 0 else out).decode()


def cheapest_repair(initials: list[str], faults: bytes | bytearray) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of those the least audit; one initial and one fault per row.

    Both directions go on until no path as cheap as the best can be left, so every cheapest path has a node that the reverse
    search has settled and the forward search has reached; the audits of both sides are joined there.
    """
    n = len(initials)

    def stays(row: int) -> bool:
        return faults[row] not in (BLANK, DUPLICATE)

    def price(row: int, base: int) -> int:
        return base + (UNFINISHED if faults[row] == TRUNCATED else 0)

    def ahead(node: int) -> Iterator[tuple[str, int, int]]:
        row, state = node >> 2, node & 3
        if row < n:
            yield "D", DELETE, node + 4
            if stays(row):
                kept = KEPT.get((state, initials[row]))
                if kept is not None:
                    yield "K", price(row, KEEP), node + 4 - state + kept
                yield "R", price(row, REROLE), node + 4 - state + TURNED[state]
        yield "I", INSERT, node - state + TURNED[state]

    def behind(node: int) -> Iterator[tuple[str, int, int]]:
        row, state = (node >> 2) - 1, node & 3
        for before in STATES:
            at = node - state + before
            if row >= 0:
                if before == state:
                    yield "D", DELETE, at - 4
                if stays(row):
                    if KEPT.get((before, initials[row])) == state:
                        yield "K", price(row, KEEP), at - 4
                    if TURNED[before] == state:
                        yield "R", price(row, REROLE), at - 4
            if TURNED[before] == state:
                yield "I", INSERT, at

    size, goals = 4 * (n + 1), [4 * n + s for s in ACCEPTED]
    forward, reverse = Search(size, [NOTHING], True), Search(size, goals, False)
    best: int | None = None
    while (a := forward.top()) is not None and (b := reverse.top()) is not None and (best is None or a + b <= best):
        one, other, edges = (forward, reverse, ahead) if forward.settled <= reverse.settled else (reverse, forward, behind)
        node = one.settle(edges)
        if other.cost[node] >= 0:
            met = one.cost[node] + other.cost[node]
            best = met if best is None else min(best, met)
    ended = bytearray(reverse.done)
    for node in goals:
        ended[node] = 1
    # the first node of a path that the reverse search has settled: one crossing for each way to come there
    crossings = [x for x in range(size) if ended[x] and forward.cost[x] >= 0 and forward.cost[x] + reverse.cost[x] == best
                 and (forward.back[x] < 0 or not ended[forward.back[x]])]
    return best, min(forward.audit(x) + reverse.audit(x) for x in crossings)


def edits(audit: str) -> Iterator[tuple[str, int]]:
    """(edit, state behind it) of an audit; whether a system turn leads follows from the number of turns that stay."""
    odd = (len(audit) - audit.count("D")) % 2
    state = NOTHING
    for edit in audit:
        if edit != "D":
            state = SYSTEM if state == NOTHING and odd else TURNED[state]
        yield edit, state


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``size`` rows; a batch that would pass 1 MiB of text ends earlier."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += sum(len(x) for x in row if isinstance(x, str))
        if len(out) == size or held > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def assess(rows: DataFrame) -> DataFrame:
    """(conv_id, stats, audit) of each conversation of :func:`marked` rows; ``stats`` are the numbers of ``STATS``.

    Rows of a conversation are streamed in order; a task keeps their initials, faults and digests, never their texts.
    """
    small = rows.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "key", "fault", "lost", "role")
    ordered = small.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "key").drop("role")
    schema = pa.schema([("conv_id", pa.int64()), ("stats", pa.list_(pa.int64())), ("audit", pa.string())])

    def judged(group: Iterator[tuple]) -> tuple[list[int], str]:
        initials, faults, seen = [], bytearray(), set()
        low = high = None
        turns = 0
        for _, turn, initial, key, fault, lost in group:
            if lost:
                continue
            if turn is not None:
                turns += turn != high
                low, high = turn if low is None else low, turn
            faults.append(DUPLICATE if fault != BLANK and key in seen else fault)
            seen.add(key)
            initials.append(initial)
        gaps = 0 if low is None else high - low + 1 - turns
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = cheapest_repair(initials, faults)
        return [gaps, *(faults.count(x) for x in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost], audit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((conv, *judged(group)) for conv, group in groupby(_rows(batches), key=lambda r: r[0])), schema)

    return ordered.mapInArrow(run, "conv_id bigint, stats array<bigint>, audit string")


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text, stats, audit): the repaired turns of each conversation of ``rows``, in order.

    ``rows`` has conv_id, turn, role, text and ``lost`` (true: the row only names its conversation), without nulls in role and
    text. Place 0 is one row per conversation with its ``stats`` and ``audit``; places from 1 on are its turns and the edit
    that made them. Rows of one partition come conversation by conversation and place by place.

    Rows stand by turn (null first), of one turn by role and digest. Texts are sent once and streamed past the audit of
    their conversation, so a long conversation or text does not fill a task.
    """
    known = materialise(marked(rows))
    found = materialise(assess(known))
    heads = found.select("conv_id", F.lit(0).alias("at"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                         F.lit(None).cast("binary").alias("key"), "stats", "audit")
    body = known.filter(~F.col("lost")).select("conv_id", F.lit(1).alias("at"), "turn", "role", "text", "key",
                                               F.lit(None).cast("array<bigint>").alias("stats"), F.lit(None).cast("string").alias("audit"))
    ordered = heads.unionByName(body).repartition("conv_id") \
        .sortWithinPartitions("conv_id", "at", F.col("turn").asc_nulls_first(), "role", "key").select("conv_id", "role", "text", "stats", "audit")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
                        ("stats", pa.list_(pa.int64())), ("audit", pa.string())])

    def turns(group: Iterator[tuple]) -> Iterator[tuple]:
        conv, _, _, stats, audit = next(group)
        yield conv, 0, None, None, None, stats, audit
        place = 0
        for edit, state in edits(audit):
            _, role, text, _, _ = next(group) if edit != "I" else (conv, "", "", None, None)
            if edit != "D":
                place += 1
                yield conv, place, edit, role if edit == "K" else ROLE[state], text, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((row for _, group in groupby(_rows(batches), key=lambda r: r[0]) for row in turns(group)), schema)

    return ordered.mapInArrow(run, "conv_id bigint, place bigint, edit string, role string, text string, stats array<bigint>, audit string")


def summaries(turns: DataFrame) -> DataFrame:
    """(conv_id, the numbers of ``STATS``, audit, repaired_sha256) from the rows of :func:`repair`, without another shuffle."""
    schema = pa.schema([("conv_id", pa.int64()), ("stats", pa.list_(pa.int64())), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digest(group: Iterator[tuple]) -> tuple:
        conv, _, _, _, stats, audit = next(group)
        sha = hashlib.sha256()
        for _, place, role, text, _, _ in group:
            sha.update(("\n" if place > 1 else "").encode() + f"{role}:{text}".encode())
        return conv, stats, audit, sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((digest(group) for _, group in groupby(_rows(batches), key=lambda r: r[0])), schema)

    found = turns.select("conv_id", "place", "role", "text", "stats", "audit") \
        .mapInArrow(run, "conv_id bigint, stats array<bigint>, audit string, repaired_sha256 string")
    return found.select("conv_id", *[F.col("stats")[i].alias(c) for i, c in enumerate(STATS)], "audit", "repaired_sha256")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation id: faults after :func:`damage`, the cheapest repair and the digest of the repaired turns.

    Null roles and texts and nulls in the damage key read as one space; rows with a null id are a conversation of their
    own. Repeated rows are duplicates of the first. A conversation with no row left has zeros, an empty audit and the
    digest of nothing. Other columns are ignored. No rows give no rows.
    """
    return summaries(repair(damage(conversations)))
