"""Prefix trie and structure repair against brute force, with odd rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from tessera.llm import prefixtrie, structure
from tessera.llm.turns import numbered, running

SCHEMA = "conv_id long, turn long, role string, text string, depth string, seq int"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def crc(s):
    return zlib.crc32(s.encode())


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def nulls_first(turn):
    return (turn is not None, turn or 0)


def make(seed, n_convs=60, texts=4):
    """Conversations with nulls, gaps, repeats, equal turns and whole copies;
    the last two columns clash with names used inside."""
    rng = random.Random(seed)
    said = ["Yes.", "no", "", None, " \t", "Why?", "ü 漢字 😀!", "a " * 40][:texts + 4]
    roles = ["user", "assistant", "system", "user", "assistant", "", None, "tool", "usher"]
    rows, made = [], []
    for k in range(n_convs):
        c = rng.choice([k, k, 100 + k, 200 * k, -k, 7 * k])
        if made and rng.random() < 0.3:
            turns = rng.choice(made)[:rng.randint(1, 9)]
        else:
            turns = [(rng.choice([i, i, i, i + 3, None, 0]), rng.choice(roles[:2] if rng.random() < 0.7 else roles),
                      rng.choice(said)) for i in range(rng.randint(1, 9))]
        made.append(turns)
        rows += [(c, *t, "x", 1) for t in turns]
    rows += [rows[0], rows[3]]
    rows += [(4000, i, "user" if i % 2 == 0 else "assistant", rng.choice(["Yes.", "no.", "well"]) + str(i), "x", 1)
             for i in range(60)]
    return rows


# ---------------------------------------------------------------- prefix trie
def rebuilt_by_hand(rows):
    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by[c].append((nulls_first(turn), role or "", md5(text or ""), text or ""))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, turns in own.items():
        h = crc(str(c)) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_by_hand(rows):
    convs = rebuilt_by_hand(rows)
    member = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            member[tuple(turns[:d])].add(c)
    children = defaultdict(set)
    for k in member:
        if k:
            children[k[:-1]].add(k)
    out = []
    for k, m in member.items():
        below = [x for x in member if x[:len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(member[k[:-1]]) if k else None, len(m), len(children[k]),
                    sum(not children[x] for x in below),
                    sum((len(member[x]) - 1) * len(x[-1][1]) for x in below if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed):
    rows = make(seed) + [(None, 0, "user", "lost", "x", 1)]
    got = prefixtrie.digest(spark.createDataFrame(rows, SCHEMA))
    assert sorted([tuple(r) for r in got.collect()], key=str) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefixtrie.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    # ids whose head is longer than they are and whose block has no first conversation
    lone = [c for c in range(1, 3000) if crc(str(c)) % 6 >= 1 and c % 100][:5]
    rows = [(c, None, None, None, "x", 1) for c in lone]
    got = prefixtrie.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in got] == trie_by_hand(rows)
    assert got[0].n_convs == 5 and got[0].n_leaves == 1


def test_trie_of_copies_hashes_their_ids_range_by_range(spark):
    # a group of copies over several ranges of ids
    ids = [c for c in range(1, 30_000, 7) if crc(str(c)) % 6 == 0]
    df = spark.createDataFrame([(c, 0, "user", "same", "x", 1) for c in ids], SCHEMA)
    got = {r.depth: r for r in prefixtrie.digest(df).collect()}
    assert len(got) == 2 and got[1].n_convs == len(ids) and got[1].saved_tokens == (len(ids) - 1) * 4
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[0].ends_sha256 == EMPTY_SHA


def test_members_of_nodes(spark):
    turns, ids = prefixtrie.rebuilt(prefixtrie.turn_rows(spark.createDataFrame(make(5), SCHEMA)))
    rows = prefixtrie.members(turns, ids).collect()
    want = rebuilt_by_hand(make(5))
    assert {r.conv_id: r.depth for r in rows} == {c: len(t) for c, t in want.items()}


def test_positions_and_running_values_across_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), k, rng.getrandbits(40), k % 5) for k in range(900)]
    df = spark.createDataFrame(rows, "key long, at long, f long, n long").repartition(7)
    want, seen = {}, defaultdict(lambda: [0, 0, 0])
    for key, at, f, n in sorted(rows):
        x = seen[key]
        want[at] = (x[0], x[1] ^ f, x[2] + n)
        seen[key] = [x[0] + 1, x[1] ^ f, x[2] + n]
    got = running(numbered(df, "key", ["at"]), "key", "at", ["f"], ["n"]).collect()
    assert {r["at"]: (r.pos, r.run_f, r.run_n) for r in got} == want


# ---------------------------------------------------------------- structure repair
WORDLESS = re.compile(r"[\x20\x09-\x0d]*")


def damaged_by_hand(rows):
    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        key = (" " if c is None else str(c)) + ":" + (" " if turn is None else str(turn))
        code = crc(key) % 20
        role0, text0 = " " if role is None else role, " " if text is None else text
        role, text = role0, text0
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        by[c] += [(nulls_first(turn), role0, md5(text0), copy, role, text, turn)
                  for copy in range({0: 0, 3: 2}.get(code, 1))]
    return {c: [x[4:] for x in sorted(v, key=lambda x: x[:4])] for c, v in by.items()}


def repair_by_hand(rows):
    """Dijkstra over (row, grammar state) with (cost, audit) as the distance."""
    out = []
    for c, turns in damaged_by_hand(rows).items():
        seen, faults = set(), []
        for role, text, _ in turns:
            visible = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else
                          "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        accepts = re.compile("(s?(ua)+)?")
        queue, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, k, said, texts = heapq.heappop(queue)
            state = said[-1:] if said else ""
            if k == len(turns) and accepts.fullmatch(said):
                break
            if (k, state) in done:
                continue
            done.add((k, state))
            moves = [(5, "I", k, x, ("user:" if x == "u" else "assistant:")) for x in "ua"]
            if k < len(turns):
                role, text, _ = turns[k]
                moves.append((2, "D", k + 1, "", None))
                if faults[k] not in ("blank", "duplicate"):
                    more = 5 * (faults[k] == "truncated")
                    moves.append((more, "K", k + 1, role[:1] or "-", f"{role}:{text}"))
                    moves += [(1 + more, "R", k + 1, x, ("user:" if x == "u" else "assistant:") + text) for x in "ua"]
            for price, letter, to, x, t in moves:
                if x and (state + x) not in ("s", "u", "su", "ua", "au"):
                    continue
                heapq.heappush(queue, (cost + price, audit + letter, to, (said + x)[-300:] if x else said,
                                       texts + ((t,) if t is not None else ())))
        numbers = [t for *_, t in turns if t is not None]
        roles = [role[:1] or "-" for role, *_ in turns]
        out.append((c, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                    *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,segment", [(1, 1024), (2, 3), (3, 1)])
def test_repair_against_brute_force(spark, seed, segment):
    rows = make(seed) + [(None, 2, "user", "lost?", "x", 1), (None, None, "system", "first.", "x", 1)]
    got = structure.digest(spark.createDataFrame(rows, SCHEMA), segment)
    assert sorted([tuple(r) for r in got.collect()], key=str) == repair_by_hand(rows)


def test_repair_of_nothing_and_of_dropped_conversations(spark):
    assert structure.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(1000) if crc(f"{c}:0") % 20 == 0)
    got = structure.digest(spark.createDataFrame([(gone, 0, "user", "x", "x", 1)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY_SHA)]


def test_repaired_turns_follow_the_grammar(spark):
    df = spark.createDataFrame(make(4), SCHEMA)
    turns = structure.repaired(df, 4).collect()
    by = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.conv_id, r.place)):
        by[r.conv_id].append(r)
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in v)) for v in by.values())
    want = {r.conv_id: r.repaired_sha256 for r in structure.digest(df).collect()}
    for c, v in by.items():
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in v).encode()).hexdigest() == want[c]


def test_shared_suffixes_are_solved_once(spark):
    # signatures with one end: the walk gives each what it gets alone
    sigs = ["uaua", "aua", "dua", "Uaua", "xd", "d", "sua", "aa", "uu"]
    both = structure.solve(spark.createDataFrame([(b, s) for b in (-1, 0, 5) for s in sigs], "behind int, sig string")).collect()
    assert len(both) == 3 * len(sigs)
    for r in both:
        alone = structure.END if r.behind == -1 else [(c, 0, "", s) for s, c in enumerate(structure.VECTORS[r.behind])]
        for symbol in reversed(r.sig):
            alone = structure.step(symbol, alone)
        assert (r.costs, r.audits, r.outs) == tuple([s[k] for s in alone] for k in (1, 2, 3))
        assert structure.VECTORS[r["head"]] == structure.relative(alone)
