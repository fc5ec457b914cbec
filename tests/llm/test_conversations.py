"""Prefix trie and structure repair of conversations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratloom.llm import prefix_trie, turn_repair
from stratloom.llm.prefix_trie import TernaryTree, build_trie, conversation_trie, medians
from stratloom.llm.turn_repair import cheapest_repair, damaged_and_repaired, edits

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# ---- trie

def plain_nodes(sequences, words):
    """Nodes of {conv: sequence} by enumerating all prefixes."""
    members = defaultdict(list)
    for conv, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(conv)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (words(p[-1]) if p else 0)
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, own + sum(total[k][1] for k in kids[p]))
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if sequences[c] == p)
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids[p]), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, role, key), (role, text)))
    own = {c: tuple(t for _, t in sorted(v)) for c, v in own.items()}
    built = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, ())[:h] + s[h:]
    return plain_nodes(built, lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t[1])))


def null_last(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


def test_trie_of_odd_conversations(spark):
    rng = random.Random(1)
    texts = ["", None, "a", "a b", "b  a\tc", "long " * 3000]
    rows = []
    for conv in [*range(90), 2_000_000_011, None, 400]:
        for turn in range(rng.randrange(7)):
            rows.append((conv, None if rng.random() < 0.1 else turn, rng.choice(["user", "assistant", None]), rng.choice(texts)))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit("x")).withColumn("key", F.lit(1)).repartition(5)
    got = null_last(tuple(r) for r in conversation_trie(df).collect())
    assert got == null_last(plain_trie(rows))
    assert conversation_trie(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed,alphabet,longest", [(1, 2, 12), (2, 5, 6), (3, 1, 40), (4, 300, 3)])
def test_trie_of_deep_shared_prefixes(spark, seed, alphabet, longest):
    """Few different turns: nodes that span many shards, sequences that are prefixes of others, whole copies."""
    rng = random.Random(seed)
    seqs = {c: tuple(rng.randrange(alphabet) for _ in range(rng.randrange(longest + 1))) for c in range(0, 1200, 3)}
    common = tuple(rng.randrange(alphabet) for _ in range(longest + 30))
    for c in range(1, 1200, 3):  # a third share one long start, half of these are copies of it
        seqs[c] = common if c % 2 else common + seqs[c - 1]
    df = spark.createDataFrame([(c, list(s), [x % 7 for x in s]) for c, s in seqs.items()], "conv_id bigint, ids array<bigint>, words array<bigint>")
    got = [tuple(r) for r in build_trie(df).collect()]
    none = hashlib.sha256(b"").hexdigest()
    got = null_last((*r[:-1], r[-1] or none) for r in got)
    assert got == null_last(plain_nodes(seqs, lambda t: t % 7))


def test_common_turns_are_looked_up_like_rare_ones(spark, monkeypatch):
    rows = [(c, t, "user", "same" if t == 0 else f"{c} {t}") for c in range(60) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = rows_of(conversation_trie(df).fillna(-1))
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 2)
    assert rows_of(conversation_trie(df).fillna(-1)) == one


def test_ternary_tree_is_balanced_by_medians():
    assert sorted(medians(100)) == list(range(100)) and next(medians(101)) == 50 and list(medians(0)) == []
    tree = TernaryTree()
    nodes = {i: tree.insert([i, 5], [1, 1]) for i in medians(1023)}
    def below(at):
        return 0 if at < 0 else 1 + max(below(tree.low[at]), below(tree.high[at]))
    assert below(tree.equal[0]) == 10
    assert all(tree.insert([i, 5], [1, 1]) == n and len(tree.path(n)) == 3 for i, n in nodes.items())


# ---- repair

def plain_repair(initials, faults):
    """Least (cost, audit) by going through rows with the best entry of each state."""
    t = turn_repair
    far = (10**9, "")

    def inserts(q):
        q[t.USER] = min([q[t.USER], *[(q[s][0] + 5, q[s][1] + "I") for s in (t.NOTHING, t.SYSTEM, t.ASSISTANT)]])
        q[t.ASSISTANT] = min(q[t.ASSISTANT], (q[t.USER][0] + 5, q[t.USER][1] + "I"))
        return q
    q = inserts([(0, ""), far, far, far])
    for initial, fault in zip(initials, faults, strict=True):
        new = [(c + 2, a + "D") for c, a in q]
        if fault in (t.SOUND, t.TRUNCATED):
            extra = 5 if fault == t.TRUNCATED else 0
            for s, (c, a) in enumerate(q):
                if (s, initial) in t.KEPT:
                    new[t.KEPT[s, initial]] = min(new[t.KEPT[s, initial]], (c + extra, a + "K"))
                new[t.TURNED[s]] = min(new[t.TURNED[s]], (c + extra + 1, a + "R"))
        q = inserts(new)
    return min(q[t.NOTHING], q[t.ASSISTANT])


def test_cheapest_repair_against_row_by_row():
    rng = random.Random(7)
    for _ in range(4000):
        n = rng.randrange(13)
        initials = [rng.choice("ssuuuuaaaat ") for _ in range(n)]
        faults = bytes(rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert cheapest_repair(initials, faults) == plain_repair(initials, faults), (initials, list(faults))
    for n in (400, 3000):
        initials, faults = [rng.choice("sua") for _ in range(n)], bytes(rng.choice([0, 0, 0, 1, 3]) for _ in range(n))
        assert cheapest_repair(initials, faults) == plain_repair(initials, faults)
    assert cheapest_repair([], b"") == (0, "")
    clean = list("s" + "ua" * 3000)
    assert cheapest_repair(clean, bytes(len(clean))) == (0, "K" * len(clean))


def test_audit_is_least_of_all_edit_sequences():
    """All audits of short conversations, listed one by one."""
    t = turn_repair

    def walk(initials, faults, i, state, cost, audit, out, spare):
        if i == len(initials) and state in t.ACCEPTED:
            out.append((cost, audit))
        if spare:
            walk(initials, faults, i, t.TURNED[state], cost + 5, audit + "I", out, spare - 1)
        if i < len(initials):
            walk(initials, faults, i + 1, state, cost + 2, audit + "D", out, spare)
            if faults[i] in (0, 3):
                extra = 5 if faults[i] == 3 else 0
                if (state, initials[i]) in t.KEPT:
                    walk(initials, faults, i + 1, t.KEPT[state, initials[i]], cost + extra, audit + "K", out, spare)
                walk(initials, faults, i + 1, t.TURNED[state], cost + extra + 1, audit + "R", out, spare)
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randrange(6)
        initials, faults = [rng.choice("suat") for _ in range(n)], bytes(rng.choice([0, 0, 1, 2, 3]) for _ in range(n))
        out = []
        walk(initials, faults, 0, t.NOTHING, 0, "", out, 2)
        assert cheapest_repair(initials, faults) == min(out)


def test_edits_name_the_states():
    assert [s for _, s in edits("KKKD")] == [1, 2, 3, 3] and [s for _, s in edits("DRI")] == [0, 2, 3] and list(edits("")) == []


def plain_damaged(rows):
    byconv = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        byconv[conv]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            byconv[conv] += [(turn is not None, turn or 0, role, digest, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, group in byconv.items():
        group.sort(key=lambda r: r[:4])
        seen, faults = set(), []
        for _, _, role, _, text in group:
            bare = text.strip(BLANKS)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[2][:1] for r in group]
        turns = [r[1] for r in group if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = plain_repair(initials, faults)
        lines, rest = [], iter(group)
        odd = (len(audit) - audit.count("D")) % 2
        for e in audit:
            row = next(rest) if e != "I" else None
            if e != "D":
                role = row[2] if e == "K" else "assistant" if (len(lines) - odd) % 2 else "user"
                lines.append(f"{role}:{row[4] if row else ''}")
        out.append((conv, gaps, *(faults.count(x) for x in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_repair_of_odd_conversations(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?  \n", "cut", "cut. ", "", None, " \t", "Great. " * 40000, "é?"]
    roles = ["user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in [*range(150), None, -3, 10**12]:
        for turn in range(rng.randrange(9)):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]), role, rng.choice(texts[:2] if rng.random() < 0.6 else texts)))
    rows += [(7, 3, "user", "Yes."), (7, 3, "user", "Yes."), (7, 3, "assistant", "Aha.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit(1)).withColumn("lost", F.lit("x")).repartition(6)
    got = damaged_and_repaired(df)
    assert null_last(tuple(r) for r in got.collect()) == null_last(plain_damaged(rows))
    assert damaged_and_repaired(df.limit(0)).collect() == []


def test_conversation_whose_rows_are_all_lost(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = damaged_and_repaired(spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_of_a_long_conversation(spark):
    """One conversation holds a third of all rows; its turns come in order, with their texts."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(2001)] + [(c, 0, "user", "Hi.") for c in range(2, 4000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("lost", F.lit(False))
    turns = turn_repair.repair(df)
    long = [tuple(r) for r in turns.filter("conv_id = 1 and place > 0").select("place", "edit", "role", "text").collect()]
    assert len(long) == 2000 and [r[0] for r in long] == list(range(1, 2001)) and {r[1] for r in long} == {"K"}
    (head,) = turns.filter("conv_id = 1 and place = 0").collect()
    assert head["stats"][-1] == 2 and head["audit"].count("D") == 1
