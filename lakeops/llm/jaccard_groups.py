"""Exact Jaccard join of word shingles by a token-group matrix.

Equal shingle sets are one node. What remains is narrowed in steps, each of which loses no link:

1. A set of n shingles links only if at least share * n of them also occur in other sets. Every shingle goes once per batch
   to its hash range, which finds the shingles of one set only; sets with too many of those are done.
2. The rest are partitioned into groups of similar sets: sets with the same minimum under a hash stand together, and each is
   compared with the few leaders of its place. Links found here are exact; linked sets are one group.
3. The token-group matrix says which groups hold a shingle. A set links with another group only if share * n of its
   shingles are in other groups' unions; all others are done, so a large group of near copies leaves here as a whole.
4. What is left is partitioned again, into families of sets that share half of their shingles, linked or not, so that near
   copies that miss a link by little stand together. Families are cut into units of bounded size. Units meet inside their
   family, and across families where a set's rarest shingles name the other unit; a set is held against the union of the
   other unit, and only where that could hold a link are the sets themselves compared, as one product of 0-1 matrices.

Components of the links of 2 and 4 are the classes. No step sends all shingles of a text but the first, and none lists the
pairs inside a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import components, discard, distinct, free_name, give_back, mix, raw_bytes, row_key, slices, small, word_hashes, written

#: Shingles that one hash range counts.
PER_RANGE = 1_500_000
#: Sets and shingles of a unit of step 4 (one larger set is a unit by itself); shingles multiplied at once.
PART, PART_TOKENS, COLUMNS = 512, 1_000_000, 2048
#: Rounds of step 3, and of looking for families: both only save work.
ROUNDS, FAMILY_ROUNDS = 3, 5
#: Leaders that a place compares with in step 2 (a matter of speed: step 4 finds what they miss).
LEADERS, GROUPINGS = 6, 3
#: Shingles that a task holds before it sends them on.
HELD = 1_200_000
_STEPS = np.random.default_rng(11).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- shingles


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; texts of fewer words have their whole sequence as one shingle."""
    words, many = word_hashes(*raw_bytes(column))
    ends = np.cumsum(many)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled += words[k:len(words) - width + 1 + k] * _STEPS[k]
    rolled = mix(rolled)
    sets = []
    for n, end in zip(many.tolist(), ends.tolist(), strict=True):
        if n >= width:
            sets.append(distinct(rolled[end - n:end - width + 1]))
        elif n:
            total = (words[end - n:end] * _STEPS[:n]).sum(keepdims=True)
            sets.append(mix(total + np.array([n], np.uint64) * _STEPS[width:width + 1]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_key(s: np.ndarray) -> int:
    """64 bits that identify a set of shingles."""
    total = mix(s + np.uint64(1)).sum(keepdims=True)
    return int(mix(total + np.array([len(s)], np.uint64) * _STEPS[:1]).view(np.int64)[0])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """docs (doc_id, row_key, text) -> (doc_id, row_key, n, node); node is null for a text without words."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("row_key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                sets = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())], schema.names)

    return docs.select("doc_id", "row_key", "text").mapInArrow(run, schema)


def token_table(docs: DataFrame, width: int) -> DataFrame:
    """docs (text) -> (node, n, tokens), without texts that have no words; tokens are the sorted shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                sets = [s for s in shingle_sets(part.column("text"), width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "n", "tokens"])

    return docs.select("text").mapInArrow(run, "node long, n long, tokens binary")


# ---------------------------------------------------------------- steps 1 and 3


def own_counts(sets: DataFrame, ranges: int, width: int | None = None) -> DataFrame:
    """(node, own): how many shingles of a node occur in no other group.

    sets: (group, node, tokens), or (text) with ``width``, where every node is its own group. A task first drops what it
    sees in two groups (sent once, without nodes), so a shingle of a third of all texts is sent once per batch.
    """

    def flush(groups: list[int], nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        code = np.concatenate(sets)
        node = np.repeat(np.array(nodes, np.int64), sizes)
        group = np.repeat(np.array(groups, np.int64), sizes)
        order = np.argsort(code, kind="stable")
        code, node, group = code[order], node[order], group[order]
        begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        many = np.diff(np.r_[begins, len(code)])
        shared = np.maximum.reduceat(group, begins) != np.minimum.reduceat(group, begins)
        common = code[begins[shared]]
        alone = ~np.repeat(shared, many)
        code, node, group = code[alone], node[alone], group[alone]
        # by range, then by node, so that each node is named once per range
        place, common_place = _range(code, ranges), _range(common, ranges)
        order = np.lexsort((node, group, place))
        code, node, group, place = code[order], node[order], group[order], place[order]
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        common_cuts = np.searchsorted(common_place, np.arange(ranges + 1))
        rows, name = [], int(np.array(nodes, np.int64).sum())  # any number will do: what carries the same one is added up together
        for r in range(ranges):
            c, m, g = code[cuts[r]:cuts[r + 1]], node[cuts[r]:cuts[r + 1]], group[cuts[r]:cuts[r + 1]]
            begins = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (g[1:] != g[:-1])]) if len(m) else np.zeros(0, np.int64)
            rows.append((r, name, m[begins].tobytes(), g[begins].tobytes(), np.diff(np.r_[begins, len(m)]).astype(np.int32).tobytes(), _packed(c), _packed(common[common_cuts[r]:common_cuts[r + 1]])))
        columns = list(zip(*rows, strict=True))
        give_back()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])], ["part", "batch", "nodes", "groups", "sizes", "tokens", "common"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, nodes, held, total = [], [], [], 0
        known: set[int] = set()
        for batch in batches:
            if width is None:
                found = zip(batch.column("group").to_pylist(), batch.column("node").to_pylist(), (np.frombuffer(t.as_buffer(), np.uint64) for t in batch.column("tokens")), strict=True)
            else:
                found = ((k := set_key(s), k, s) for part in slices(batch, "text", 2 << 20) for s in shingle_sets(part.column("text"), width) if len(s))
            for g, k, s in found:
                if k in known:
                    continue
                known.add(k)
                groups.append(g)
                nodes.append(k)
                held.append(s)
                total += len(s)
                if total >= HELD:
                    yield flush(groups, nodes, held)
                    groups, nodes, held, total, known = [], [], [], 0, set()
        if held:
            yield flush(groups, nodes, held)

    def receive(t: pa.Table) -> pa.Table:
        columns = [[np.frombuffer(v, k) for v in t.column(c).to_pylist()] for c, k in (("nodes", np.int64), ("groups", np.int64), ("sizes", np.int32), ("tokens", np.uint8), ("common", np.uint8))]
        node, group, size, token, common = (np.concatenate(c) for c in columns)
        token, common = _unpacked(token), distinct(_unpacked(common))
        size = size.astype(np.int64)
        order = np.argsort(token, kind="stable")
        token = token[order]
        g = np.repeat(group, size)[order]
        own = np.zeros(len(token), bool)
        if len(token):
            begins = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            many = np.diff(np.r_[begins, len(token)])
            single = np.maximum.reduceat(g, begins) == np.minimum.reduceat(g, begins)
            if len(common):
                at = np.minimum(np.searchsorted(common, token[begins]), len(common) - 1)
                single &= common[at] != token[begins]
            own[order] = np.repeat(single, many)
            # a node that came in several batches names its shingle several times; it counts once
            several = np.flatnonzero(np.repeat(single & (many > 1), many))
            if len(several):
                named, what = np.repeat(node, size)[order[several]], token[several]
                again = np.lexsort((named, what))
                same = np.r_[False, (what[again][1:] == what[again][:-1]) & (named[again][1:] == named[again][:-1])]
                own[order[several[again[same]]]] = False
        count = np.add.reduceat(own.astype(np.int32), np.cumsum(size) - size).astype(np.int32) if len(size) else np.zeros(0, np.int32)
        give_back()
        ends = np.cumsum([len(x) for x in columns[0]])
        back = [count[end - len(x):end].tobytes() for x, end in zip(columns[0], ends.tolist(), strict=True)]
        return pa.table({"batch": t.column("batch"), "nodes": t.column("nodes"), "own": pa.array(back, pa.binary())})

    def add_up(t: pa.Table) -> pa.Table:
        node = np.concatenate([np.frombuffer(k, np.int64) for k in t.column("nodes").to_pylist()])
        own = np.concatenate([np.frombuffer(k, np.int32) for k in t.column("own").to_pylist()]).astype(np.int64)
        order = np.argsort(node, kind="stable")
        begins = np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]]) if len(node) else np.zeros(0, np.int64)
        return pa.table({"node": node[order][begins], "own": np.add.reduceat(own[order], begins) if len(node) else own})

    source = sets.select("text") if width is not None else sets.select("group", "node", "tokens")
    sent = source.mapInArrow(send, "part int, batch long, nodes binary, groups binary, sizes binary, tokens binary, common binary")
    counted = sent.groupBy("part").applyInArrow(lambda t: receive(t), "batch long, nodes binary, own binary")
    return counted.groupBy("batch").applyInArrow(lambda t: add_up(t), "node long, own long").groupBy("node").agg(F.sum("own").alias("own"))


def _range(code: np.ndarray, ranges: int) -> np.ndarray:
    return (code >> np.uint64(40)).astype(np.int64) * ranges >> 24


def _packed(code: np.ndarray) -> bytes:
    """Low 40 bits of each code; the range holds the others in effect."""
    return code.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = data.reshape(-1, 5)
    return out.view(np.uint64).ravel()


# ---------------------------------------------------------------- steps 2 and 4


def linked(a: np.ndarray, b: np.ndarray, part: int, whole: int) -> bool:
    """Whether whole * |a and b| >= part * |a or b|, for sorted distinct codes."""
    if min(len(a), len(b)) * whole < part * max(len(a), len(b)):
        return False
    both = _overlap(a, b)
    return both * whole >= part * (len(a) + len(b) - both)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def grouping(sets: DataFrame, seed: int, part: int, whole: int, tasks: int) -> DataFrame:
    """Links (u, v) between sets with the same minimum under one hash and one of the leaders met there."""
    salt = _STEPS[1 + seed]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(mix(np.frombuffer(t.as_buffer(), np.uint64) ^ salt).min()) - (1 << 63) for t in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays([pa.array(least, pa.int64()), batch.column("node"), batch.column("tokens")], ["place", "node", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, leaders = None, []
        for batch in batches:
            u, v = [], []
            for at, node, tokens in zip(batch.column("place").to_pylist(), batch.column("node").to_pylist(), batch.column("tokens"), strict=True):
                s = np.frombuffer(tokens.as_buffer(), np.uint64)
                if at != here:
                    here, leaders = at, []
                for leader, other in leaders:
                    if node != leader and linked(s, other, part, whole):
                        u.append(node)
                        v.append(leader)
                        break
                else:
                    if len(leaders) < LEADERS:
                        leaders.append((node, s.copy()))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    placed = sets.select("node", "tokens").mapInArrow(place, "place long, node long, tokens binary")
    # By range of (place, node): a place with very many sets falls into several ranges, each with leaders of its own.
    return placed.repartitionByRange(tasks, "place", "node").sortWithinPartitions("place", "node").mapInArrow(compare, "u long, v long")


def families(sets: DataFrame, tasks: int) -> DataFrame:
    """(node, family) of every set; a family is named by a leader that its sets share at least half of all shingles with.

    Round by round, the sets left over meet by the minimum of another hash; a set joins the first similar leader of its place
    or becomes one. Whoever has joined or been joined is out, so rounds get shorter and families never chain. They only
    decide which blocks are compared.
    """
    rest, found = sets.select("node", "tokens"), None
    for seed in range(FAMILY_ROUNDS):
        met = written(grouping(rest, GROUPINGS + seed, 1, 2, tasks), "met")
        joined = written(met.select(F.col("u").alias("node"), F.col("v").alias("family")).unionByName(met.select(F.col("v").alias("node"), F.col("v").alias("family")).distinct()), "family")
        found = joined if found is None else found.unionByName(joined)
        rest = rest.join(joined.select("node"), "node", "left_anti")
    return sets.select("node").join(found, "node", "left").select("node", F.coalesce("family", "node").alias("family"))


def spanning_links(a_sets: list[np.ndarray], a_group: np.ndarray, b_sets: list[np.ndarray], b_group: np.ndarray, part: int, whole: int) -> list[tuple[int, int]]:
    """Links between two blocks of sets as a few pairs (place in a, place in b) that connect what the links connect.

    A set is held against the union of the other block first; shingles of those that may link become the columns of two 0-1
    matrices, whose product is the sizes of all intersections. Sets of one group are connected already and not asked for.
    """
    size_a, size_b = (np.array(list(map(len, s)), np.int64) for s in (a_sets, b_sets))

    def may_link(sets: list[np.ndarray], sizes: np.ndarray, others: np.ndarray, least: int) -> np.ndarray:
        inside = np.add.reduceat(np.isin(np.concatenate(sets), others), np.cumsum(sizes) - sizes)
        return np.flatnonzero(inside * (part + whole) >= part * (sizes + least))

    rows = may_link(a_sets, size_a, np.concatenate(b_sets), int(size_b.min()))
    cols = may_link(b_sets, size_b, np.concatenate([a_sets[i] for i in rows]), int(size_a[rows].min())) if len(rows) else rows
    if not len(rows) or not len(cols):
        return []
    code_a, code_b = (np.concatenate([s[i] for i in chosen]) for s, chosen in ((a_sets, rows), (b_sets, cols)))
    common = np.intersect1d(code_a, code_b)
    places = []
    for code, sizes in ((code_a, size_a[rows]), (code_b, size_b[cols])):
        at = np.minimum(np.searchsorted(common, code), max(len(common) - 1, 0))
        hit = common[at] == code if len(common) else np.zeros(len(code), bool)
        owner, at = np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]
        order = np.argsort(at, kind="stable")
        places.append((owner[order], at[order]))
    both = np.zeros((len(rows), len(cols)), np.float64)
    for begin in range(0, len(common), COLUMNS):
        wide = min(COLUMNS, len(common) - begin)
        left, right = (np.zeros((n, wide), np.float32) for n in (len(rows), len(cols)))
        for matrix, (owner, at) in ((left, places[0]), (right, places[1])):
            x, y = np.searchsorted(at, [begin, begin + wide])
            matrix[owner[x:y], at[x:y] - begin] = 1
        both += left @ right.T
    link = both * whole >= part * (size_a[rows][:, None] + size_b[cols][None, :] - both)
    link &= a_group[rows][:, None] != b_group[cols][None, :]
    mark_a, mark_b = np.arange(len(rows)), np.full(len(cols), len(rows))
    while True:  # the smallest row that links reach
        mark_b = np.where(link, mark_a[:, None], len(rows)).min(axis=0)
        now = np.minimum(mark_a, np.where(link, mark_b[None, :], len(rows)).min(axis=1))
        if (now == mark_a).all():
            break
        mark_a = now
    # A row is connected to its mark by way of any of its columns, which carry the same mark.
    found = [(int(rows[mark_b[j]]), int(cols[j])) for j in np.flatnonzero(mark_b < len(rows))]
    return found + [(int(rows[i]), int(cols[j])) for i, j in zip(np.flatnonzero(link.any(axis=1)), link[link.any(axis=1)].argmax(axis=1), strict=True)]


def across_groups(sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Links (u, v) that connect all sets of different groups that link; sets: (group, node, n, tokens).

    Sets are cut into units: sets of one family and nearly one size, at most ``PART`` of them and ``PART_TOKENS`` shingles.
    Units of a family meet by their sizes; units of different families only where a set's rare shingles name the other. All
    else is a comparison of two units as blocks, so the rows grow with pairs of units, never with pairs of sets.
    """
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    named = sets.join(families(sets, max(4, -(-tokens // 500_000))), "node")
    # Sizes of a unit differ by 3 % at most.
    named = written(named.withColumn("size", F.floor(F.log("n") * 33).cast("int")), "families")
    parts = F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("n") / PART_TOKENS)).alias("parts")
    sizes = written(named.groupBy("family", "size").agg(parts), "sizes")
    dealt = named.join(sizes, ["family", "size"]).withColumn("unit", F.xxhash64("family", "size", F.pmod(F.xxhash64("node"), "parts")))
    units = written(dealt.select("unit", "family", "group", "node", "n", "tokens"), "units")
    about = units.groupBy("unit", "family").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("group").alias("g0"), F.max("group").alias("g1"))
    about = written(about, "about")

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{c}_{name}") for c in df.columns))

    near = (F.col("low_a") * part <= F.col("high_b") * whole) & (F.col("low_b") * part <= F.col("high_a") * whole)
    one = (F.col("g0_a") == F.col("g1_a")) & (F.col("g0_b") == F.col("g1_b")) & (F.col("g0_a") == F.col("g0_b"))
    inside = side("a", about).join(side("b", about), F.col("family_a") == F.col("family_b")).where((F.col("unit_a") <= F.col("unit_b")) & near & ~one)
    pairs = written(inside.select("unit_a", "unit_b"), "inside")

    # A set links with another family only if enough of its shingles occur there.
    own = own_counts(units.select(F.col("family").alias("group"), "node", "tokens"), max(4, -(-tokens // PER_RANGE)))
    able = units.select("node", "n").join(own, "node", "left").where((F.col("n") - F.coalesce("own", F.lit(0))) * whole >= F.col("n") * part)
    able = written(able.select("node"), "able")
    if able.limit(1).count():
        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    codes = np.frombuffer(batch.column("tokens")[row].as_buffer(), np.int64)
                    one = [pa.array(np.full(len(codes), batch.column(c)[row].as_py()), pa.int64()) for c in ("unit", "family", "node", "n")]
                    yield pa.RecordBatch.from_arrays([*one, pa.array(codes)], ["unit", "family", "node", "n", "token"])

        single = units.join(able, "node", "left_semi").select("unit", "family", "node", "n", "tokens")
        single = written(single.mapInArrow(explode, "unit long, family long, node long, n long, token long"), "left-tokens")
        spread = single.groupBy("token").agg(F.countDistinct("family").alias("families")).where("families > 1")
        order = Window.partitionBy("node").orderBy("families", "token")
        # Shingles of one family come first in the order of rarity, and there are n - able of them.
        ranked = single.join(written(spread, "spread"), "token").withColumn("able", F.count("*").over(Window.partitionBy("node")))
        ranked = ranked.withColumn("rank", F.row_number().over(order) + F.col("n") - F.col("able"))
        # Of n shingles at least ceil(n * part / whole) are shared, so one of the others + 1 rarest is.
        prefix = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * part / whole) + 1)
        index = prefix.groupBy("token", "unit", "family").agg(F.min("rank").alias("first"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("able").alias("most"))
        index = written(index, "index")
        both = side("a", index).join(side("b", index), F.col("token_a") == F.col("token_b")).where((F.col("family_a") < F.col("family_b")) & near)
        for x, y in ("ab", "ba"):
            # Two sets of n and m shingles share at least part * (n + m) / (part + whole) of them: as many must be able to,
            # and the first shared one stands early enough.
            both = both.where(F.col(f"most_{x}") * (part + whole) >= (F.col(f"low_{x}") + F.col(f"low_{y}")) * part)
            both = both.where(F.col(f"first_{x}") <= F.col(f"high_{x}") - F.ceil((F.col(f"high_{x}") + F.col(f"low_{y}")) * part / (part + whole)) + 1)
        pairs = pairs.unionByName(written(both.select("unit_a", "unit_b").distinct(), "outside"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        u, v = [], []
        if left.num_rows and right.num_rows:
            a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column(f"tokens_{x}")] for t, x in ((left, "a"), (right, "b")))
            a_node, b_node = left.column("node_a").to_pylist(), right.column("node_b").to_pylist()
            for i, j in spanning_links(a, left.column("group_a").to_numpy(), b, right.column("group_b").to_numpy(), part, whole):
                u.append(a_node[i])
                v.append(b_node[j])
        give_back()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    sent = []
    for x, keys in (("a", ["ua", "ub"]), ("b", ["va", "vb"])):
        asked = pairs.select(F.col("unit_a").alias(keys[0]), F.col("unit_b").alias(keys[1]))
        members = side(x, units.select("unit", "group", "node", "tokens"))
        sent.append(asked.join(members, F.col(keys[0 if x == "a" else 1]) == F.col(f"unit_{x}")).drop(f"unit_{x}").groupBy(*keys))
    return sent[0].cogroup(sent[1]).applyInArrow(lambda a, b: compare(a, b), "u long, v long")


def jaccard_classes(docs: DataFrame, width: int = 4, part: int = 85, whole: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, row_key, n_shingles, root (a number for its class, null for an empty set) and
    component_id (smallest id reachable by links, itself included).

    Two documents link when whole * intersection >= part * union of their shingle sets. A null text, or one without words,
    has an empty set and links with nothing; a text of fewer than ``width`` words has one shingle. Repeated rows link (equal
    sets), null ids keep their row and never name a component of others. Codes of 64 bits stand for shingles and sets.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    rows = written(signatures(narrow, width), "signatures")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.max("n").alias("n"), F.min("row_key").alias("row_key"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    own = own_counts(narrow, max(4, -(-total // PER_RANGE)), width)
    can_link = lambda df: df.where((F.col("n") - F.coalesce("own", F.lit(0))) * whole >= F.col("n") * part)
    alive = written(can_link(nodes.join(own, "node", "left")).select("row_key", "n"), "candidates")
    count, tokens = alive.agg(F.count("*"), F.sum("n")).first()
    links = None
    if count:
        chosen = narrow.join(small(alive.select("row_key"), count), "row_key", "left_semi")
        twice = written(rows.where("node IS NOT NULL").groupBy("row_key").agg(F.count("*").alias("rows")).where("rows > 1").select("row_key"), "twice")
        repeated = twice.count()
        if repeated:
            # A set stands in ``sets`` once: ranks and counts below go by its shingles.
            again = small(twice, repeated)
            chosen = chosen.join(again, "row_key", "left_anti").unionByName(chosen.join(again, "row_key", "left_semi").dropDuplicates(["row_key"]))
        sets = written(token_table(chosen, width), "sets")
        tasks = max(4, -(-tokens // 500_000))
        for seed in range(GROUPINGS):
            found = written(grouping(sets, seed, part, whole, tasks), "links")
            links = found if links is None else links.unionByName(found)
        grouped = components(links)
        groups = grouped.count()
        left = written(sets.join(small(grouped, groups), "node", "left").select(F.coalesce("root", "node").alias("group"), "node", "n", "tokens"), "grouped")
        for _ in range(ROUNDS):
            counts = own_counts(left, max(4, -(-tokens // PER_RANGE)))
            known = written(can_link(left.select("node", "n").distinct().join(counts, "node", "left")).select("node", "n"), "left")
            after, tokens = known.agg(F.count("*"), F.sum("n")).first()
            if after == count:
                break
            count, before = after, left
            if not count:
                break
            left = written(before.join(small(known.select("node"), count), "node", "left_semi"), "grouped")
            discard(before)
        if count:
            links = links.unionByName(across_groups(left, part, whole))
    roots = components(links) if links is not None else nodes.select("node", F.col("node").alias("root")).limit(0)
    placed = written(rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    least = written(placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return placed.join(least, "root", "left").select("doc_id", "row_key", "root", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_class(docs: DataFrame, width: int = 4, part: int = 85, whole: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id (null last); rows without words all stay."""
    classes = written(jaccard_classes(docs, width, part, whole, id_col, text_col), "classes").where("root IS NOT NULL")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    best = written(classes.groupBy("root").agg(F.min(first).alias("best")).select("root", F.col("best.row_key").alias("stays")), "best")
    key = free_name(docs, "row_key")
    gone = written(classes.join(best, "root").where("row_key <> stays").select(F.col("row_key").alias(key)).distinct(), "gone")
    twice = written(classes.groupBy(F.col("row_key").alias(key)).agg(F.count("*").alias("rows")).where("rows > 1").select(key), "twice")
    rest = docs.withColumn(key, row_key(id_col, text_col)).join(small(gone, gone.count()), key, "left_anti")
    repeated = twice.count()
    if repeated:
        again = small(twice, repeated)
        rest = rest.join(again, key, "left_anti").unionByName(rest.join(again, key, "left_semi").dropDuplicates([key]))
    return rest.select(docs.columns)
