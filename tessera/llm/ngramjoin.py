"""Operator 10: exact n-gram Jaccard self-join by universe partition.

Every text is its set of five-word shingles; texts with equal sets form a class
that is joined once.  Sets are put into size bands, whose borders grow by 1.25, so
the smaller set of a linked pair (Jaccard >= 0.8) lies in the larger one's band or
the band below.  A band has m segments; a hash deals every shingle of the universe
into one of them.

Pigeonhole: linked sets of sizes s and l differ in at most t = (s + l) / 9
shingles.  A segment of the larger set that is probed exactly and does not match
accounts for one difference; one that is probed with its one-deletion
neighbourhood and does not match, for two.  So probes of a total weight above t
cannot all miss.  The index holds every non-empty segment, and one-deletion
neighbours for bands of small sets.  A set probes the cheapest allocation of that
weight: a cost model that counts signatures and expected matches (by the number of
shingles in the signature and the number of sets in the band) skips segments of
few shingles, which are the ones that common passages make frequent.  m comes
from a ladder: a first pass finds for every set which steps give it such an
allocation, and a band takes the smallest step that suits all of its sets.  Where
none does, it takes several: its index holds each of them, and a set probes the
first that suits it.

Signatures meet in one shuffle and are streamed in order.  Up to RUN members of a
signature are paired in place.  Longer runs give each member to one pivot, which
is linear, and are kept: after the links found so far are turned into components,
only pairs of members in different components are left to look at, and all of them
are, block by block inside a task.  No run is cut.  Candidates are verified by
short hashes of their whole sets, and what passes by the whole sets.

Defined results: null, empty and wordless texts have n_shingles 0 and are linked
with nothing; a text of one to four words is one shingle of its own length; copies
(equal sets) link; rows that repeat an id are each returned, and if their texts
differ, what links with one of them links with the id; rows without an id take no
part and have a null component.  Only id and text are read, so other columns do
not matter; `keep_one` keeps them, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import spare_name
from tessera.llm.components import components
from tessera.llm.shingles import WordHasher, mixed, set_keys, shingle_set
from tessera.session import materialize

#: Links hold when SIMILAR * intersection size >= ... in percent of the union.
PERCENT = 80
#: Members of a signature that are paired in place.
RUN = 16
#: Rows of one signature that a task holds at a time.
HELD = 32_768
#: Bytes of a block of a long run; two blocks meet in a task.
CELL_BYTES = 16 << 20
#: Largest lower border of a band whose index holds one-deletion neighbours.
SMALL = 32
#: Share of sets taken to hold a shingle, per shingle of a signature (cost model).
COMMON = 0.2
LADDER = (1.0, 1.3, 1.7, 2.3, 3.0, 4.5, 7.0, 12.0, 25.0, 80.0, 400.0, 4000.0)
#: Needed sets that are broadcast as a list of ids; above it they are joined.
BROADCAST_IDS = 1_000_000


def borders(largest: int) -> list[int]:
    """Lower borders of the bands."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, ceil(out[-1] * 1.25)))
    return out


_BORDERS = np.array(borders(1 << 40))


def band_of(size: int) -> int:
    return int(np.searchsorted(_BORDERS, size, side="right")) - 1


def segments(band: int, step: float) -> int:
    low = int(_BORDERS[band])
    return max(1, ceil((0.34 * low + 1) * step)) if low > SMALL else max(1, ceil((0.2 * low + 1) * step))


def most_differences(size: int, band: int) -> int:
    """Of a set of `size` and a linked one of no larger size in the band; -1 if
    there is none."""
    smaller = min(size, int(_BORDERS[band + 1]) - 1)
    return (smaller + size) // 9 if 100 * smaller >= PERCENT * size else -1


def _counts(s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each shingle, shingles per segment.  The hashes are mixed well
    enough to be dealt out by their high bits."""
    seg = ((s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    return seg, np.bincount(seg, minlength=m)


def _sums(seg: np.ndarray, s: np.ndarray, m: int) -> np.ndarray:
    """Sum of the hashes in each segment, modulo 2**64.  Sums of 32-bit halves
    are exact as floats for sets of up to 2**21 shingles."""
    if len(s) > 1 << 21:
        out = np.zeros(m, np.uint64)
        np.add.at(out, seg, s)
        return out
    low, high = (np.bincount(seg, x.astype(np.float64), m).astype(np.uint64) for x in (s & np.uint64(0xFFFFFFFF), s >> np.uint64(32)))
    return (high << np.uint64(32)) + low


def weight(count: np.ndarray, band: int) -> int:
    """Most that probes of segments with `count` shingles can weigh."""
    return int((count > 0).sum() + ((count > 1).sum() if _BORDERS[band] <= SMALL else 0))


def steps_that_suit(s: np.ndarray, band: int) -> int:
    """Bit mask of the ladder's steps at which the set has an allocation in the
    band.  Another step deals the shingles anew, so one that suits says nothing
    of the next.  For larger sets only the first step that suits is looked for."""
    need, mask = most_differences(len(s), band) + 1, 0
    for k, step in enumerate(LADDER):
        if weight(_counts(s, segments(band, step))[1], band) >= need:
            mask |= 1 << k
            if len(s) > 2 * SMALL:
                break
    if not mask:
        raise ValueError(f"no allocation for a set of {len(s)}")
    return mask


def chosen_steps(masks: dict[int, int]) -> list[int]:
    """Steps of a band, given the number of sets by mask: one that suits all, or
    else one after another that suits most of the rest."""
    out, rest = [], dict(masks)
    while rest:
        k = max(range(len(LADDER)), key=lambda k: (sum(n for m, n in rest.items() if m >> k & 1), -k))
        out.append(k)
        rest = {m: n for m, n in rest.items() if not m >> k & 1}
    return out


def allocation(count: np.ndarray, need: int, deletions: bool, sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which segments are probed exactly, and which also by deletions: the
    cheapest units of weight until they make `need`."""
    if (count > 0).sum() + (deletions and (count > 1).sum()) < need:
        raise ValueError("the segments can't make the weight that no linked set escapes")
    cost = 1.0 + sets * COMMON ** np.arange(1, int(count.max(initial=0)) + 2, dtype=float)
    exact_cost = np.where(count > 0, cost[np.maximum(count, 1) - 1], np.inf)
    if not deletions:
        chosen = np.zeros(len(count), bool)
        chosen[np.argsort(exact_cost, kind="stable")[:need]] = True
        return chosen, np.zeros(len(count), bool)
    more_cost = np.where(count > 1, count * cost[np.maximum(count, 2) - 2], np.inf)
    more_cost = np.maximum(more_cost, exact_cost)  # the exact unit comes first
    order = np.argsort(np.concatenate([exact_cost, more_cost]), kind="stable")[:need]
    exact, more = np.zeros(len(count), bool), np.zeros(len(count), bool)
    exact[order[order < len(count)]] = True
    more[order[order >= len(count)] - len(count)] = True
    return exact | more, more


INDEX, BOTH, PROBE = 0, 1, 2


def signatures(s: np.ndarray, steps: dict[int, list[int]], sizes: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signatures, roles) of a set: index and probes in its own band, probes in
    the band below."""
    own = band_of(len(s))
    for band in (own, own - 1):
        if band < 0 or band not in steps or (band != own and most_differences(len(s), band) < 0):
            continue
        need = most_differences(len(s), band) + 1
        small = _BORDERS[band] <= SMALL
        probed = False
        for k in steps[band]:
            m = segments(band, LADDER[k])
            seg, count = _counts(s, m)
            probe = not probed and (weight(count, band) >= need or k == steps[band][-1])
            if not probe and band != own:
                continue
            exact, more = (allocation(count, need, small, sizes.get(band, 1)) if probe else
                           (np.zeros(m, bool), np.zeros(m, bool)))
            probed |= probe
            total = _sums(seg, s, m)
            place = mixed(np.arange(m, dtype=np.uint64), 5000 + band + 100_000 * k)
            filled = count > 0
            take = filled if band == own else filled & exact
            yield mixed(total[take] ^ place[take]), np.where(exact[take], BOTH if band == own else PROBE, INDEX)
            if small:
                at = count[seg] > 1
                if band != own:
                    at &= more[seg]
                left = mixed((total[seg[at]] - s[at]) ^ place[seg[at]])
                yield left, np.where(more[seg[at]], BOTH if band == own else PROBE, INDEX)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    hasher = WordHasher()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield part.column(0).to_pylist(), [shingle_set(w) for w in hasher.texts(part.column(1).to_pylist())]


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _sets(batches):
        rows = []
        for s in sets:
            if len(s):
                own = band_of(len(s))
                low = own > 0 and most_differences(len(s), own - 1) >= 0
                rows.append((*set_keys(s), len(s), own, steps_that_suit(s, own), steps_that_suit(s, own - 1) if low else 0))
            else:
                rows.append((None, None, 0, None, None, None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in zip(*rows)]],
            names=["id", "k1", "k2", "n", "band", "own_steps", "low_steps"])


def _pairs_of(keys: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a probe and an index entry among a few sorted members."""
    i, j = np.triu_indices(len(keys), 1)
    ri, rj = roles[i], roles[j]
    fits = ((ri >= BOTH) & (rj <= BOTH)) | ((rj >= BOTH) & (ri <= BOTH))
    return keys[i[fits]], keys[j[fits]]


class _Meeting:
    """Members of each signature, from rows sorted by signature and key."""

    def __init__(self) -> None:
        self.open: tuple[int, int] | None = None  # signature and pivot of a run that goes on

    def runs(self, sig: np.ndarray, key: np.ndarray, role: np.ndarray, more: bool) -> Iterator[pa.RecordBatch]:
        """Candidate pairs (kind 0: a, b) and members of long runs (kind 1: key
        a, sig).  `more`: the last run goes on in later rows."""
        # copies in several tasks give equal rows: one entry for each member
        first = np.flatnonzero(np.r_[True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
        is_probe = np.logical_or.reduceat(role >= BOTH, first)
        is_index = np.logical_or.reduceat(role <= BOTH, first)
        sig, key, role = sig[first], key[first], np.where(is_probe & is_index, BOTH, np.where(is_probe, PROBE, INDEX))
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        lengths = np.diff(np.r_[starts, len(sig)])
        probes = np.add.reduceat((role >= BOTH).astype(np.int64), starts)
        going_on = np.zeros(len(starts), bool)
        going_on[0] = self.open is not None and self.open[0] == sig[0]
        going_on[-1] |= more
        two = starts[(lengths == 2) & (probes > 0) & ~going_on]
        two = two[(role[two] <= BOTH) & (role[two + 1] >= BOTH) | (role[two] >= BOTH) & (role[two + 1] <= BOTH)]
        a, b = [key[two]], [key[two + 1]]
        for k in np.flatnonzero((lengths > 2) & (probes > 0) | going_on):
            at = slice(starts[k], starts[k] + lengths[k])
            keys, roles = key[at], role[at]
            if len(keys) <= RUN and not going_on[k]:
                x, y = _pairs_of(keys, roles)
            else:
                this = int(sig[starts[k]])
                if self.open is None or self.open[0] != this:
                    # one of four orders picks the pivot: a group's signatures share few pivots
                    self.open = this, int(keys[mixed(keys.view(np.uint64), this >> 2 & 3).argmin()])
                x, y = np.minimum(keys, self.open[1]), np.maximum(keys, self.open[1])
                yield self._rows(1, keys, keys, np.full(len(keys), this))
            a.append(x)
            b.append(y)
        if len(two) or len(a) > 1:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield self._rows(0, pairs[:, 0], pairs[:, 1], np.zeros(len(pairs)))

    @staticmethod
    def _rows(kind: int, a, b, sig) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             pa.array(sig.astype(np.int64))],
            names=["kind", "a", "b", "sig"])


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    meeting, carry = _Meeting(), None
    for batch in batches:
        rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if carry is not None:
            rows = [np.concatenate(x) for x in zip(carry, rows)]
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if last:
            yield from meeting.runs(*[x[:last] for x in rows], more=False)
        carry = [x[last:] for x in rows]
        if len(carry[0]) > HELD:  # a run is never held whole
            yield from meeting.runs(*carry, more=True)
            carry = None
    if carry is not None and len(carry[0]):
        yield from meeting.runs(*carry, more=False)


def short_set(s: np.ndarray) -> np.ndarray:
    """A set as 32-bit hashes, led by its size: half the bytes, and never fewer
    common shingles than may_link allows for."""
    return np.concatenate([[len(s)], np.unique(s >> np.uint64(32))]).astype(np.uint32)


def may_link(x: np.ndarray, y: np.ndarray, same: int | np.ndarray) -> bool | np.ndarray:
    """Whether short sets with `same` common hashes can be those of linked sets:
    shingles of one text that share a short hash count as common."""
    nx, ny = int(x[0]), int(y[0])
    most = min(same + min(nx - len(x) + 1, ny - len(y) + 1), nx, ny)
    return 100 * most >= PERCENT * (nx + ny - most)


#: Looks up (id, set) of the members in a table of ids, as short sets or whole ones.
SetsOf = Callable[[DataFrame, bool], DataFrame]


def _needed_sets(docs: DataFrame, ids: DataFrame, short: bool) -> DataFrame:
    """(id, set) of the documents in `ids`."""
    ids = materialize(ids.distinct(), "needed")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got, sets in _sets(batches):
            rows = [(short_set(s) if short else s).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64()), pa.array(rows, pa.binary())], names=["id", "set"])

    return docs.join(ids, "id").select("id", "text").mapInArrow(run, "id long, set binary")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def filter_pairs(pairs: DataFrame, sets_of: SetsOf, short: bool) -> DataFrame:
    """The pairs (a, b) that link, or may link by their short sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32 if short else np.uint64) for v in (x, y))
                if short:
                    keep.append(may_link(x, y, _common(x[1:], y[1:])))
                else:
                    same = _common(x, y)
                    keep.append(100 * same >= PERCENT * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    sets = materialize(sets_of(ids, short), "sets")
    x = sets.select(F.col("id").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    found = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
    return materialize(found, "links")


def links_of(pairs: DataFrame, sets_of: SetsOf) -> DataFrame:
    """The pairs (a, b) that link: short sets first, whole ones for the rest."""
    return filter_pairs(filter_pairs(pairs, sets_of, True), sets_of, False)


def _in_cell(frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one cell of a run that may link: members in different components
    and no smaller signature in common (the run of that one looks at the pair)."""
    node, part, block = (frame[c].to_numpy() for c in ("node", "part", "block"))
    sig, first, second = int(frame["sig"].iloc[0]), int(frame["ci"].iloc[0]), int(frame["cj"].iloc[0])
    sets = [np.frombuffer(v, np.uint32) for v in frame["set"]]
    lists = [np.asarray(v, np.int64) for v in frame["sigs"]]
    flat, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(v) for v in lists])
    names, place = np.unique(np.where(flat < sig, flat, sig), return_inverse=True)
    marks = np.zeros((len(node), len(names)), bool)
    marks[owner, place] = True
    smaller = np.packbits(marks[:, :-1], axis=1) if len(names) > 1 else np.zeros((len(node), 1), np.uint8)
    tokens = np.concatenate([v[1:] for v in sets])
    holder = np.repeat(np.arange(len(sets)), [len(v) - 1 for v in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], holder[order]
    size, kinds = np.array([v[0] for v in sets], np.int64), np.array([len(v) - 1 for v in sets], np.int64)
    values, counts = np.unique(part, return_counts=True)
    most = values[counts.argmax()]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for k in np.flatnonzero((block == first) | (block == second)):
        if part[k] == most and first == second:
            continue  # its partners look at it
        fits = (part != part[k]) & (np.minimum(size, size[k]) * 100 >= PERCENT * np.maximum(size, size[k]))
        fits &= (block == first) & (block[k] == second) if first != second else (part == most) | (node > node[k])
        at = np.flatnonzero(fits)
        at = at[~(smaller[at] & smaller[k]).any(axis=1)]
        if not len(at):
            continue
        if len(at) <= 32:
            same = np.array([_common(sets[k][1:], sets[j][1:]) for j in at])
        else:
            mine = sets[k][1:]
            lo, hi = np.searchsorted(tokens, mine), np.searchsorted(tokens, mine, side="right")
            hits = np.concatenate([holder[a:b] for a, b in zip(lo, hi)])
            same = np.bincount(hits, minlength=len(node))[at]
        spare = np.minimum(size[at] - kinds[at], size[k] - kinds[k])
        common = np.minimum(same + spare, np.minimum(size[at], size[k]))
        at = at[100 * common >= PERCENT * (size[at] + size[k] - common)]
        out.append((np.minimum(node[at], node[k]), np.maximum(node[at], node[k])))
    return pd.DataFrame({"a": np.concatenate([x for x, _ in out] or [np.zeros(0, np.int64)]),
                         "b": np.concatenate([y for _, y in out] or [np.zeros(0, np.int64)])})


def compare_long_runs(members: DataFrame, sets_of: SetsOf) -> DataFrame | None:
    """Links between members (sig, node, part) of long runs that are in different
    components (part) yet, or None if every run lies in one.  A run is cut into
    blocks of bounded bytes, and each two blocks meet in a cell that compares their
    members in place: no row is made for a pair that does not link."""
    split = members.groupBy("sig").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("sig")
    open_runs = materialize(members.join(split, "sig"), "open-runs")
    if not open_runs.head(1):
        return None
    sets = materialize(sets_of(open_runs.select(F.col("node").alias("id")), True), "sets")
    lists = open_runs.groupBy("node").agg(F.collect_set("sig").alias("sigs"))
    whole = open_runs.join(lists.join(sets.withColumnRenamed("id", "node"), "node"), "node")
    weight = F.length("set") + 8 * F.size("sigs") + 64
    blocks = (whole.groupBy("sig").agg(F.sum(weight).alias("bytes"))
              .select("sig", F.ceil(F.col("bytes") / CELL_BYTES).cast("int").alias("blocks")))
    placed = whole.join(blocks, "sig").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sig", F.least("block", "other").alias("ci"), F.greatest("block", "other").alias("cj"), "block", "node", "part",
        "sigs", "set")
    found = dealt.groupBy("sig", "ci", "cj").applyInPandas(_in_cell, "a long, b long").distinct()
    return filter_pairs(materialize(found, "near"), sets_of, False)


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row of `docs`."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    classed = materialize(docs.mapInArrow(
        _classes, "id long, k1 long, k2 long, n long, band long, own_steps long, low_steps long"), "classes")
    joined = classed.where(F.col("id").isNotNull() & F.col("k1").isNotNull())
    # one node per set: the smallest id that has it
    nodes = materialize(joined.groupBy("k1", "k2", "n", "band", "own_steps", "low_steps").agg(
        F.min("id").alias("node")), "nodes")
    # a row per band (about 5 for each doubling of the largest set) and pair of masks, nearly all the same
    sizes: Counter[int] = Counter()
    masks: dict[int, Counter[int]] = defaultdict(Counter)
    for r in nodes.groupBy("band", "own_steps", "low_steps").count().collect():
        sizes[r.band] += r["count"]
        masks[r.band][r.own_steps] += r["count"]
        if r.low_steps:
            masks[r.band - 1][r.low_steps] += r["count"]
    steps = {b: chosen_steps(m) for b, m in masks.items() if b in sizes}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # copies within a task give their signatures once
        for _, sets in _sets(batches):
            sigs, keys, roles = [], [], []
            for s in sets:
                if len(s):
                    key = set_keys(s)[0]
                    if key in done:
                        continue
                    done.add(key)
                    for sig, role in signatures(s, steps, sizes):
                        sigs.append(sig)
                        roles.append(role)
                        keys.append(np.full(len(sig), key, np.int64))
            if sigs:
                # the role rides in the two lowest bits of the signature
                packed = (np.concatenate(sigs) & ~np.uint64(3)) | np.concatenate(roles).astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(packed.view(np.int64)), pa.array(np.concatenate(keys))],
                                                 names=["packed", "key"])

    sig = F.col("packed").bitwiseAND(F.lit(-4))
    role = F.col("packed").bitwiseAND(F.lit(3))
    rows = (docs.where(F.col("id").isNotNull()).mapInArrow(emit, "packed long, key long")
            .select(sig.alias("sig"), "key", role.alias("role")).repartition(F.col("sig"))
            .sortWithinPartitions("sig", "key"))
    met = materialize(rows.mapInArrow(meet, "kind int, a long, b long, sig long"), "met")

    keyed = nodes.select(F.col("k1").alias("key"), "node")

    def as_nodes(pairs: DataFrame) -> DataFrame:
        at = pairs.join(keyed.select(F.col("key").alias("a"), F.col("node").alias("na")), "a").join(
            keyed.select(F.col("key").alias("b"), F.col("node").alias("nb")), "b")
        return at.where(F.col("na") != F.col("nb")).select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()

    def sets_of(ids: DataFrame, short: bool) -> DataFrame:
        return _needed_sets(docs, ids, short)

    links = links_of(materialize(as_nodes(met.where("kind = 0").select("a", "b").distinct()), "pairs"), sets_of)
    parts = components(links)
    members = met.where("kind = 1").select("sig", F.col("a").alias("key")).join(keyed, "key")
    more = compare_long_runs(members.join(parts, "node", "left").select(
        "sig", "node", F.coalesce("component", "node").alias("part")), sets_of)
    if more is not None:
        parts = components(links.unionByName(more))

    keys = ["k1", "k2", "n"]
    by_set = nodes.join(parts.withColumnRenamed("component", "part"), "node", "left").select(
        *keys, F.coalesce("part", "node").alias("component_id"))
    return classed.join(by_set, keys, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each component: the one whose id names it.
    Rows without an id stay."""
    found = link_components(docs, id_col, text_col)
    name = spare_name(docs, "gone")
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(name)).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")


#: The definition itself: all pairs with a common shingle, and the closure of links.
ORACLE = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y
  where 100 * common.n >= 80 * (a.n + b.n - common.n)),
reach as (
  select doc_id, doc_id as other from documents
  union
  select reach.doc_id, links.y from reach join links on links.x = reach.other)
select d.doc_id, coalesce(any_value(s.n), 0)::bigint as n_shingles, min(r.other)::bigint as component_id
from documents d join reach r on r.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id
"""
