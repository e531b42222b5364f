"""Operator 13: conversation structure repair over a suffix-shared automaton.

Every turn becomes a symbol: the class of its role's initial, upper case if the
text is cut off, or `d` if it has to go (blank or a repeat).  A conversation is
then a short signature, and conversations with the same signature, or the same
end of one, share their solution: the distinct signatures are sorted from the
end and walked as a trie, so that each automaton node (a distinct suffix) gets
the cost to go and the best audit suffix of the four grammar states once.  At a
node the edits open with different letters, so of equal costs the smallest
letter decides.

A long conversation's signature is cut into segments of SEGMENT turns.  What
follows a segment matters only through the differences of its four costs, of
which there are few (`VECTORS`): segments are solved for each of these, and one
small fold per long conversation picks the ones that fit together.

No task holds a conversation's rows: positions come from range partitions, repeats
from a grouped minimum, and the repaired turns are streamed in order, with the
audit of one conversation (at most two letters a turn, part of its result) and
one Arrow batch in memory.

Defined results: a null role or text is one space, and so is a null id or turn in
the damage key; rows without conversation id are a conversation of their own,
with a null id; rows that share a turn follow role, then the MD5 of the text, as
they were before the damage; null turns come first; equal rows are repeats of the
first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.turns import CRC32_SQL, numbered
from tessera.session import materialize

SEGMENT = 1024
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "suaxSUAXd"
#: Grammar `(s?(ua)+)?`: start, after s, after u, after a.
KEEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: State after a turn that the edit may choose: user, or assistant after a user.
CHOSEN = [2, 2, 3, 2]
#: (cost to go, cost of the edits, audit, state behind them) of each state behind the last turn.
END = [(0, 0, "", 0), (10, 10, "II", 3), (5, 5, "I", 3), (0, 0, "", 3)]

State = tuple[int, int, str, int]


def step(symbol: str, after: list[State]) -> list[State]:
    """The four states' best edits from a turn on, given those behind it."""
    def best(options: list[tuple[int, str, State]]) -> State:
        cost, letter, then = min(options, key=lambda o: (o[0] + o[2][0], o[1]))
        return cost + then[0], cost + then[1], letter + then[2], then[3]

    fine, here = symbol.lower(), []
    more = 0 if fine == symbol else TRUNCATED
    for state in range(4):
        options = [(DELETE, "D", after[state])]
        if symbol != "d":
            options.append((REROLE + more, "R", after[CHOSEN[state]]))
            if fine in KEEP[state]:
                options.append((more, "K", after[KEEP[state][fine]]))
        here.append(best(options))

    def inserted(state: int, then: State) -> State:
        """The state's best edits if `then` are those of the state that an insert leads to."""
        if (then[0] + INSERT, "I") < (here[state][0], here[state][2][0]):
            return INSERT + then[0], INSERT + then[1], "I" + then[2], then[3]
        return here[state]

    user, assistant = inserted(2, here[3]), inserted(3, here[2])
    return [inserted(0, user), inserted(1, user), user, assistant]


def relative(states: list[State]) -> tuple[int, ...]:
    low = min(s[0] for s in states)
    return tuple(s[0] - low for s in states)


def _vectors() -> list[tuple[int, ...]]:
    """Relative costs to go that can stand behind a segment, those of the end first."""
    found = [relative(END)]
    for v in found:
        for symbol in SYMBOLS:
            w = relative(step(symbol, [(c, 0, "", s) for s, c in enumerate(v)]))
            if w not in found:
                found.append(w)
    return found


VECTORS = _vectors()
#: What follows the last segment; other segments have the index of a vector.
LAST = -1


def solve(signatures: DataFrame, audits: bool = True) -> DataFrame:
    """`signatures` (behind, sig), distinct -> with head (the vector before its
    first turn) and per state cost, audit and the state behind the segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below, path, stack = None, "", []
        for batch in batches:
            out = []
            for behind, turned in zip(batch.column("behind").to_pylist(), batch.column("turned").to_pylist()):
                if behind != below:
                    below, path = behind, ""
                    stack = [END if behind == LAST else [(c, 0, "", s) for s, c in enumerate(VECTORS[behind])]]
                shared = 0
                for a, b in zip(path, turned):
                    if a != b:
                        break
                    shared += 1
                del stack[shared + 1:]  # the nodes of the common suffix stay
                for symbol in turned[shared:]:
                    node = step(symbol, stack[-1])
                    stack.append(node if audits else [(c, w, t[:1], s) for c, w, t, s in node])
                path, top = turned, stack[-1]
                out.append((behind, turned[::-1], VECTORS.index(relative(top)), [s[1] for s in top],
                            [s[2] for s in top] if audits else [], [s[3] for s in top]))
            types = [pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)] if out else
                                             [pa.array([], t) for t in types],
                                             names=["behind", "sig", "head", "costs", "audits", "outs"])

    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turned = signatures.select(F.col("behind").cast("int"), F.reverse("sig").alias("turned"))
    return (turned.repartitionByRange(n, "behind", "turned").sortWithinPartitions("behind", "turned").mapInArrow(
        run, "behind int, sig string, head int, costs array<long>, audits array<string>, outs array<int>"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after damage: conv_key (text), conv_id, turn, role, text, and
    by_role, by_text, copy, which order the turns of equal number."""
    def or_space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    role, text = F.col("role0"), F.col("text0")
    code = F.crc32(F.concat_ws(":", or_space("conv_id"), or_space("turn")).cast("binary")) % 20
    rows = conversations.select(or_space("conv_id").alias("conv_key"), "conv_id", "turn", or_space("role").alias("role0"),
                                or_space("text").alias("text0"), code.alias("code")).where(F.col("code") != 0)
    return rows.select(
        "conv_key", "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        role.alias("by_role"), F.md5(text).alias("by_text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def symbols(turns: DataFrame) -> DataFrame:
    """(conv_key, pos, turn, initial, fault) of each damaged turn."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    light = turns.select(
        "conv_key", "turn", "by_role", "by_text", "copy",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.md5(F.concat_ws(":", "conv_key", F.length("role").cast("string"), "role", "text")).alias("said"))
    # equal rows differ in nothing: their input split and place make the order total
    light = light.withColumn("row", F.monotonically_increasing_id())
    placed = materialize(numbered(light, "conv_key", ["turn", "by_role", "by_text", "copy", "row"]).select(
        "conv_key", "pos", "turn", "initial", "blank", "cut", "said"), "symbols")
    repeated = (placed.where(~F.col("blank")).groupBy("said").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1).drop("n"))
    fault = (F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("cut"), "t").otherwise(""))
    return placed.join(repeated, "said", "left").select("conv_key", "pos", "turn", "initial", fault.alias("fault"))


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a long conversation's segments, each solved for every vector: the ones
    that fit together, from the end, and the state each begins in."""
    at: dict[int, dict[int, tuple]] = {}
    for seg, behind, head, outs in zip(rows.seg, rows.behind, rows["head"], rows.outs):
        at.setdefault(seg, {})[behind] = (head, outs)
    behind, picked = LAST, {}
    for seg in sorted(at, reverse=True):
        picked[seg] = behind
        behind = at[seg][behind][0]
    state, out = 0, []
    for seg in sorted(at):
        out.append((rows.conv_key.iloc[0], seg, picked[seg], state))
        state = int(at[seg][picked[seg]][1][state])
    return pd.DataFrame(out, columns=["conv_key", "seg", "behind", "state"])


def audits(marked: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_key, illegal, cost, audit) of each conversation of `symbols` rows."""
    symbol = F.when(F.col("fault").isin("b", "d"), "d").when(F.col("fault") == "t", F.upper("initial")).otherwise(
        F.col("initial"))
    items = F.sort_array(F.collect_list(F.struct("pos", symbol.alias("s"), "initial")))  # at most `segment` items
    segments = materialize(
        marked.groupBy("conv_key", F.floor(F.col("pos") / segment).cast("int").alias("seg")).agg(items.alias("i"))
        .select("conv_key", "seg", F.array_join("i.s", "").alias("sig"), F.array_join("i.initial", "").alias("initials")),
        "segments")
    last = segments.groupBy("conv_key").agg(F.max("seg").alias("last"))
    short = segments.join(last.where("last = 0"), "conv_key").select(
        "conv_key", "seg", "sig", F.lit(LAST).alias("behind"), F.lit(0).alias("state"))
    long = segments.join(last.where("last > 0"), "conv_key")
    wanted = F.when(F.col("seg") == F.col("last"), F.array(F.lit(LAST))).otherwise(
        F.sequence(F.lit(0), F.lit(len(VECTORS) - 1)))
    asked = materialize(long.select("conv_key", "seg", "sig", F.explode(wanted).alias("behind")), "asked")
    maps = solve(asked.select("behind", "sig").distinct(), audits=False)
    picked = (asked.join(maps, ["behind", "sig"]).select("conv_key", "seg", "behind", "head", "outs")
              .groupBy("conv_key").applyInPandas(_fold, "conv_key string, seg int, behind int, state int"))
    chosen = materialize(short.unionByName(
        long.select("conv_key", "seg", "sig").join(picked, ["conv_key", "seg"])), "chosen")
    solved = solve(chosen.select("behind", "sig").distinct())
    state = F.col("state") + 1
    parts = chosen.join(solved, ["behind", "sig"]).select(
        "conv_key", "seg", F.element_at("costs", state).alias("cost"), F.element_at("audits", state).alias("audit"))
    totals = parts.groupBy("conv_key").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    before = F.lag(F.right("initials", F.lit(1)), 1, "").over(Window.partitionBy("conv_key").orderBy("seg"))
    run = segments.select("conv_key", F.concat(before, F.col("initials")).alias("r"))
    pairs = F.when(F.length("r") > 1, F.size(F.filter(
        F.transform(F.sequence(F.lit(1), F.length("r") - 1), lambda i: F.substr("r", i, F.lit(2))),
        lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    return totals.join(run.groupBy("conv_key").agg(F.sum(pairs).alias("illegal")), "conv_key")


def report(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: conv_key, conv_id, n_rows after damage, gaps, the
    fault counts, illegal, cost and audit."""
    marked = materialize(symbols(damaged(conversations)), "marked")
    counts = marked.groupBy("conv_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(n) for f, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))])
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    every = conversations.groupBy(key.alias("conv_key")).agg(F.max("conv_id").alias("conv_id"))
    numbers = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (every.join(counts, "conv_key", "left").join(audits(marked, segment), "conv_key", "left")
            .select("conv_key", "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit")))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """In order: ("conversation", its row) before its turns, and ("turn", (edit,
    role, text)) of each turn that the audit leaves or inserts."""
    audit, at, state = "", 0, 0

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, CHOSEN[state]
            yield "turn", ("I", "user" if state == 2 else "assistant", "")

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("kind", "role", "text", "head")]
        for kind, role, text, head in zip(*columns):
            if kind == 0:
                yield from inserts()
                audit, at, state = head["audit"], 0, 0
                yield "conversation", head
                continue
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = KEEP[state][role[:1]]
            elif edit == "R":
                state = CHOSEN[state]
                role = "user" if state == 2 else "assistant"
            if edit != "D":
                yield "turn", (edit, role, text)
    yield from inserts()


def _streams(conversations: DataFrame, heads: DataFrame) -> DataFrame:
    """Each conversation's row, then its damaged turns in order, in one task."""
    order = ["conv_key", "kind", "turn", "by_role", "by_text", "copy"]
    kept = [c for c in heads.columns if c != "conv_key"]
    turns = damaged(conversations).select(*[c for c in order if c != "kind"], "role", "text", F.lit(1).alias("kind"))
    first = heads.select("conv_key", F.lit(0).alias("kind"), F.struct(*kept).alias("head"))
    both = turns.unionByName(first, allowMissingColumns=True)
    return both.repartition("conv_key").sortWithinPartitions(*order).select("kind", "role", "text", "head")


def repaired(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns after damage and repair."""
    heads = report(conversations, segment).select("conv_key", "conv_id", "audit")
    id_type = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        head, place, out = None, 0, []
        names = ["conv_id", "place", "edit", "role", "text"]
        for kind, row in _edited(batches):
            if kind == "conversation":
                head, place = row, 0
            else:
                out.append((head["conv_id"], place, *row))
                place += 1
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)

    return _streams(conversations, heads).mapInArrow(
        run, f"conv_id {id_type}, place long, edit string, role string, text string")


def digest(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The report with the hash of the repaired conversation."""
    heads = materialize(report(conversations, segment), "report")
    names = [c for c in heads.columns if c not in ("conv_key", "n_rows")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in heads.schema if f.name in names)
    types = [pa.string() if c == "audit" else pa.int64() for c in names] + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, some, out = None, hashlib.sha256(), False, []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                              names=[*names, "repaired_sha256"])

        for kind, row in _edited(batches):
            if kind == "turn":
                state.update((("\n" if some else "") + f"{row[1]}:{row[2]}").encode())
                some = True
                continue
            if head is not None:
                out.append((*[head[c] for c in names], state.hexdigest()))
            head, state, some = row, hashlib.sha256(), False
            if len(out) >= 4096:
                yield block()
                out = []
        if head is not None:
            out.append((*[head[c] for c in names], state.hexdigest()))
        if out:
            yield block()

    return _streams(conversations, heads).mapInArrow(run, f"{schema}, repaired_sha256 string")


def _sql_best(*options: tuple[str, str, str, str, str]) -> str:
    """Least (cost, audit) of (condition, edit's cost, letter, turn put out, state behind)."""
    return "list_min([" + ", ".join(
        f"CASE WHEN {when} THEN {{'c': {s}.c + {cost}, 'a': '{letter}' || {s}.a, 't': list_concat({turn}, {s}.t)}} END"
        for when, cost, letter, turn, s in options) + "])"


def _sql_state(name: str, keep: dict[str, str], chosen: str) -> str:
    role = "user" if chosen == "u" else "assistant"
    more = f"CASE WHEN cut THEN {TRUNCATED} ELSE 0 END"
    own = "[role || ':' || text]"
    options = [("true", str(DELETE), "D", "[]::varchar[]", name),
               ("NOT gone", f"{REROLE} + {more}", "R", f"['{role}:' || text]", chosen)]
    options += [(f"NOT gone AND initial = '{i}'", more, "K", own, to) for i, to in keep.items()]
    return f"{_sql_best(*options)} AS {name}"


def _sql_insert(state: str, to: str) -> str:
    role = "user" if to in ("u", "iu") else "assistant"
    return (f"list_min([{state}, {{'c': {to}.c + {INSERT}, 'a': 'I' || {to}.a, "
            f"'t': list_concat(['{role}:'], {to}.t)}}])")


ORACLE = f"""
with recursive src as (
  select conv_id, coalesce(conv_id::varchar, ' ') as key, turn, coalesce(role, ' ') as role0, coalesce(text, ' ') as text0,
         {CRC32_SQL.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as code
  from conversations),
damaged as (
  select key, turn, role0, md5(text0) as m, copy, case when code = 4 then 'user' else role0 end as role,
         case when code = 1 then '' when code = 2 then translate(text0, '.!?', '') else text0 end as text
  from src, (select unnest([0, 1]) as copy) where code <> 0 and (copy = 0 or code = 3)),
placed as (
  select *, row_number() over (partition by key order by turn nulls first, role0, m, copy) as pos from damaged),
faults as (
  select *, left(role, 1) as initial, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
         row_number() over (partition by key, role, text order by pos) > 1 as again,
         not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') as open
  from placed),
marked as (
  select *, blank or again as gone, open and not blank and not again as cut,
         lag(initial) over (partition by key order by pos) as before,
         row_number() over (partition by key order by pos desc) as back
  from faults),
dp as (
  select key, 0::bigint as back, {{'c': 0, 'a': '', 't': []::varchar[]}} as o, {{'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}} as s,
         {{'c': 5, 'a': 'I', 't': ['assistant:']}} as u, {{'c': 0, 'a': '', 't': []::varchar[]}} as a
  from (select distinct key from src)
  union all
  select key, back, {_sql_insert('io', 'iu')}, {_sql_insert('xs', 'iu')}, iu, ia
  from (select key, back, io, xs, {_sql_insert('xu', 'xa')} as iu, {_sql_insert('xa', 'xu')} as ia
        from (select dp.key, m.back, {_sql_state('o', {'s': 's', 'u': 'u'}, 'u').replace(' AS o', ' AS io')},
                     {_sql_state('s', {'u': 'u'}, 'u').replace(' AS s', ' AS xs')},
                     {_sql_state('u', {'a': 'a'}, 'a').replace(' AS u', ' AS xu')},
                     {_sql_state('a', {'u': 'u'}, 'u').replace(' AS a', ' AS xa')}
              from dp join marked m on m.key = dp.key and m.back = dp.back + 1))),
best as (select key, arg_max(o, back) as o from dp group by key),
sums as (
  select key, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count_if(blank) as blank,
         count_if(again and not blank) as duplicate, count_if(cut) as truncated,
         count_if(pos > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
  from marked group by key)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, b.o.c::bigint as cost, b.o.a as audit,
       sha256(array_to_string(b.o.t, chr(10))) as repaired_sha256
from (select distinct conv_id, key from src) e join best b using (key) left join sums using (key)
"""
