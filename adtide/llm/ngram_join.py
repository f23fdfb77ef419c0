"""Similarity self-join of n-gram sets with a prefix tree.

Sets are put into one global order, rare n-grams first. Two sets that are similar enough share an
n-gram among the rarest of both, so sets meet in a bucket for each of these. In a bucket the sets
are stored in a trie; a set walks down the trie, shares the overlap counted so far among all sets
below, and leaves a subtree when what remains on either side cannot reach the needed overlap.

Work is kept linear where sets are alike: equal sets are one node; sets with too many n-grams that
nothing else has are left out early; buckets with the same members are joined once; each bucket
first meets its most central set, and only buckets that still hold several components are joined
in full, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import LOWER, spread
from adtide.sources.files import stage

WORDS = 3
PERCENT = 90
BLOCK = 1_000
#: Hash range (of the upper 16 bits) in which n-grams are counted over all sets to leave sets out.
RANGE = 1 << 14
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def ngram_set(text: str | None, known: dict[bytes, int], words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of lower-cased words; fewer words are one n-gram."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = []
    for w in found:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(h)
    h = np.array(hashes, dtype=np.uint64)
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        n = len(h) - size + 1
        mixed = np.full(n, np.uint64(size))
        for i in range(size):
            mixed = (mixed ^ (h[i : i + n] + _K[i % len(_K)])) * _K[(i + 3) % len(_K)]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sign_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, high, low, parts, counts = [], [], [], [], []
            for text in batch.column(1):
                if len(known) > 400_000:
                    known.clear()
                s = ngram_set(text.as_py(), known, words)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                sizes.append(len(s))
                high.append(_signed(d >> 64))
                low.append(_signed(d & 0xFFFFFFFFFFFFFFFF))
                part = s[: np.searchsorted(s, np.uint64(RANGE << 48))]
                parts.append(part)
                counts.append(len(part))
            flat = np.concatenate(parts).astype("<i8") if parts else np.zeros(0, dtype="<i8")
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["id", "n", "hi", "lo", "part"],
            )

    return run


def _whole_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            nodes, sizes, sets = [], [], []
            for node, hi, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = ngram_set(text.as_py(), known, words)
                if _signed(xxhash.xxh3_128_intdigest(s.tobytes()) >> 64) != hi:
                    continue  # another text with the same id
                nodes.append(node)
                sizes.append(len(s))
                sets.append(s.view("<i8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "n", "grams"]
            )

    return run


def least_overlap(n: Column, percent: int) -> Column:
    """The least overlap of a set of n with any set that is similar enough."""
    return F.ceil(F.lit(percent) * n / F.lit(100)).cast("bigint")


class Trie:
    """Sets of ranks in ascending order, as a tree of shared beginnings kept in arrays.

    A node is a run of ranks that the same sets share. Nodes are numbered parent before child.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, groups: np.ndarray) -> None:
        keys = [s.astype(">u4").tobytes() for s in sets]
        order = sorted(range(len(sets)), key=keys.__getitem__)
        self.order = np.array(order)
        length = [len(sets[k]) for k in order]
        parent, begin, end, first, last = [-1], [0], [0], [0], [len(order)]
        open_nodes = [0]
        self.leaf = np.zeros(len(order), dtype=np.int64)  # node where each sorted set ends
        for i, k in enumerate(order):
            shared = 0
            if i:
                a, b = sets[order[i - 1]], sets[k]
                m = min(len(a), len(b))
                unequal = a[:m] != b[:m]
                shared = int(unequal.argmax()) if unequal.any() else m
            while end[open_nodes[-1]] > shared:
                top = open_nodes.pop()
                last[top] = i
                if end[open_nodes[-1]] < shared:  # split: the upper part gets a node of its own
                    mid = len(parent)
                    parent.append(open_nodes[-1])
                    begin.append(begin[top])
                    end.append(shared)
                    first.append(first[top])
                    last.append(len(order))
                    parent[top], begin[top] = mid, shared
                    open_nodes.append(mid)
            if length[i] > shared:
                parent.append(open_nodes[-1])
                begin.append(shared)
                end.append(length[i])
                first.append(i)
                last.append(len(order))
                open_nodes.append(len(parent) - 1)
            self.leaf[i] = open_nodes[-1]
        self.mask: np.ndarray | None = None
        self.first, self.last = np.array(first), np.array(last)
        self.end = np.array(end)
        n = len(parent)
        runs = [sets[order[first[v]]][begin[v] : end[v]] for v in range(n)]
        self.ranks = np.concatenate(runs) if runs else np.zeros(0, dtype=np.int64)
        self.run_size = np.array([len(r) for r in runs])
        self.run_at = np.concatenate([[0], np.cumsum(self.run_size)[:-1]])
        self.last_rank = np.array([r[-1] if len(r) else -1 for r in runs])
        kids = np.array(parent[1:], dtype=np.int64)
        by_parent = np.argsort(kids, kind="stable")
        self.children = by_parent + 1
        self.child_at = np.searchsorted(kids[by_parent], np.arange(n + 1))
        sizes, groups = sizes[self.order], groups[self.order]
        self.sizes, self.groups = sizes, groups
        lengths = np.array(length)
        # over the sets below each node: largest length, least size, and the group if they share one
        self.max_length = np.array([lengths[a:b].max() for a, b in zip(self.first, self.last, strict=True)])
        self.min_size = np.array([sizes[a:b].min() for a, b in zip(self.first, self.last, strict=True)])
        self.group = np.array([groups[a] if (groups[a:b] == groups[a]).all() else -1 for a, b in zip(self.first, self.last, strict=True)])
        ends = np.argsort(self.leaf, kind="stable")
        self.ending, self.ending_at = ends, np.searchsorted(self.leaf[ends], np.arange(n + 1))

    @staticmethod
    def _spans(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Positions of several runs, one after the other."""
        total = int(size.sum())
        return np.repeat(at - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)

    def similar(self, ranks: np.ndarray, size: int, group: int, n_ranks: int, percent: int) -> np.ndarray:
        """Input positions of the sets with enough overlap with the given one, of other groups.

        The overlap of a node is its parent's plus that of its own run. A subtree is left if its
        sets are all of the given group, or if the overlap so far and what remains (of the given
        set after the node's last rank, and of the longest set below) stay under what the smallest
        set below needs.
        """
        # one array for all walks: its length is that of the group's n-grams, not of this set's
        if self.mask is None:
            self.mask = np.zeros(n_ranks + 1, dtype=np.int64)
        mask = self.mask
        mask[ranks] = 1
        overlap = np.zeros(len(self.end), dtype=np.int64)
        frontier, found = np.zeros(1, dtype=np.int64), []
        while len(frontier):
            ends = self.ending[self._spans(self.ending_at[frontier], self.ending_at[frontier + 1] - self.ending_at[frontier])]
            if len(ends):
                enough = (100 + percent) * overlap[self.leaf[ends]] >= percent * (size + self.sizes[ends])
                found.append(ends[enough & (self.groups[ends] != group)])
            number = self.child_at[frontier + 1] - self.child_at[frontier]
            kids = self.children[self._spans(self.child_at[frontier], number)]
            above = np.repeat(overlap[frontier], number)
            open_ = self.group[kids] != group
            need = -(-percent * (size + self.min_size[kids]) // (100 + percent))
            open_ &= above + np.minimum(len(ranks), self.max_length[kids]) >= need
            kids, above, need = kids[open_], above[open_], need[open_]
            if not len(kids):
                break
            runs = self.run_size[kids]
            hits = np.add.reduceat(mask[self.ranks[self._spans(self.run_at[kids], runs)]], np.concatenate([[0], np.cumsum(runs)[:-1]]))
            overlap[kids] = above + hits
            passed = np.searchsorted(ranks, self.last_rank[kids], side="right")
            left = np.minimum(len(ranks) - passed, self.max_length[kids] - self.end[kids])
            frontier = kids[overlap[kids] + left >= need]
        mask[ranks] = 0
        return self.order[np.concatenate(found)] if found else np.zeros(0, dtype=np.int64)


def join_group(
    nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], groups: np.ndarray, sides: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that connect what is similar: sets of side 0 and 2 walk through a trie of sides 1 and 2.

    A link is given only where it joins two parts that the links so far leave apart.
    """
    grams, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(grams))  # common first: long shared beginnings
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    ranked = [np.sort(x) for x in np.split(rank[inverse], cuts)]
    member = np.flatnonzero(sides > 0)
    if not len(member):
        return []
    trie = Trie([ranked[k] for k in member], sizes[member], groups[member])
    root = {g: g for g in groups.tolist()}

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    links = []
    for k in np.flatnonzero(sides != 1).tolist():
        for j in member[trie.similar(ranked[k], int(sizes[k]), int(groups[k]), len(grams), percent)].tolist():
            a, b = find(int(groups[k])), find(int(groups[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(nodes[k]), int(nodes[j])))
    return links


def _join_groups(keys: int, percent: int):
    """Rows sorted by group key to links; one group is in memory at a time."""

    def links_of(rows: list[tuple]) -> list[tuple[int, int]]:
        nodes, sizes, groups, sides, sets = zip(*rows, strict=True)
        return join_group(np.array(nodes), np.array(sizes), list(sets), np.array(groups), np.array(sides), percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def give(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(keys + 4)]
            grams = batch.column(keys + 4)
            offsets, values = grams.offsets.to_numpy(), grams.values.to_numpy()
            out: list[tuple[int, int]] = []
            for i in range(batch.num_rows):
                mine = tuple(c[i] for c in columns[:keys])
                if mine != key:
                    if len(rows) > 1:
                        out += links_of(rows)
                    key, rows = mine, []
                rows.append((*(c[i] for c in columns[keys:]), values[offsets[i] : offsets[i + 1]].copy()))
            yield give(out)
        if len(rows) > 1:
            yield give(links_of(rows))

    return run


def _links(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Join within each group of ``rows`` (keys, node, n, group, side, grams)."""
    ordered = spread(rows.select(*keys, "node", "n", "group", "side", "grams"), *keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(_join_groups(len(keys), percent), "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Rounds of taking the least label around and then the label's own label, until none changes.
    Counts and minima are combined before the shuffle, labels come back by equi-joins.
    """
    both = stage(links.union(links.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(around, labels["node"] == around["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        nearer = stage(nearer, "nearer")
        jump = nearer.select(F.col("node").alias("to"), F.col("label").alias("further"))
        new = stage(nearer.join(jump, nearer["label"] == jump["to"], "left").select("node", "old", F.least("label", "further").alias("label")), "labels")
        changed = not new.where("label != old").isEmpty()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")


def _candidates(signed: DataFrame, percent: int) -> DataFrame:
    """(hi, lo, n, id) of the different sets that may have a similar one.

    In a fixed quarter of the hash range every n-gram is counted over all sets. A set with more
    n-grams there that no other set has than a similar pair may differ in is left out.
    """
    own = F.min("hi") == F.max("hi")
    lone = (
        signed.select("hi", "lo", F.explode("part").alias("gram")).groupBy("gram")
        .agg(own.alias("own"), F.min("hi").alias("hi"), F.min("lo").alias("lo"), (F.min("lo") == F.max("lo")).alias("own_lo"))
        .where("own and own_lo").groupBy("hi", "lo").agg(F.count("*").alias("lone"))
    )
    sets = signed.where("n > 0").groupBy("hi", "lo").agg(F.max("n").alias("n"), F.min("id").alias("id"))
    kept = sets.join(lone, ["hi", "lo"], "left").where(F.coalesce("lone", F.lit(0)) <= F.col("n") - least_overlap(F.col("n"), percent))
    return kept.where("id is not null").select("hi", "lo", "n", "id")


def _ordered_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, weight, prefix, grams): n-grams that other candidates have, rarest first.

    ``prefix`` is how many of them belong to the set's rarest n - least overlap + 1; the n-grams of
    its own come before them. ``weight`` is how common the set's n-grams are on average. A set that
    is given twice stays one.
    """
    grams = sets.select("node", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    kept = grams.join(shared, "gram").groupBy("node").agg(F.array_sort(F.collect_set(F.struct("df", "gram"))).alias("g"))
    kept = kept.join(sets.select("node", "n").distinct(), "node")
    prefix = F.size("g") - least_overlap(F.col("n"), percent) + 1
    weight = F.aggregate("g.df", F.lit(0).cast("bigint"), lambda a, x: a + x) / F.col("n")
    return stage(
        kept.select("node", "n", weight.alias("weight"), prefix.alias("prefix"), F.col("g.gram").alias("grams")).where("prefix > 0"),
        "ordered_sets",
    )


def similar_sets(sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(node, component) of the sets (node, n, grams) that are linked with others.

    Every pair that reaches the similarity ends in one component: a bucket of sets is left out of
    the full join only where its sets are in one component already.
    """
    sets = _ordered_sets(sets, percent)
    postings = sets.select("node", "n", "weight", F.explode(F.slice("grams", F.lit(1), F.col("prefix").cast("int"))).alias("gram"))
    mark = F.xxhash64("node").cast("decimal(38,0)")
    buckets = (
        postings.groupBy("gram").agg(
            F.count("*").alias("m"), F.sum(mark).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("x"),
            F.max_by("node", "weight").alias("hub"),
        )
        .where("m > 1").groupBy("m", "s", "x").agg(F.min("gram").alias("gram"), F.min("hub").alias("hub"))
        .select("gram", "m", "hub")
    )
    buckets = stage(buckets, "buckets")
    postings = stage(postings.select("gram", "node").join(buckets, "gram"), "postings")
    # every bucket with its most central set
    body = sets.select("node", "n", "grams")
    alone = F.col("node").alias("group")
    pairs = postings.where("node != hub").select("hub", "node").distinct()
    salts = F.ceil(F.col("k") / block)
    counts = stage(pairs.groupBy("hub").agg(F.count("*").alias("k")), "hub_sizes")
    pairs = pairs.join(counts, "hub").select("hub", F.pmod(F.xxhash64("node"), salts).alias("salt"), "node")
    members = pairs.join(body, "node").select("hub", "salt", "node", "n", alone, F.lit(1).alias("side"), "grams")
    centres = counts.select(F.col("hub").alias("node"), F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt")).join(body, "node")
    centres = centres.select(F.col("node").alias("hub"), "salt", "node", "n", alone, F.lit(0).alias("side"), "grams")
    links = stage(_links(centres.unionByName(members), ["hub", "salt"], percent), "hub_links")
    joined = components(links)
    # what still holds several components, in full
    placed = postings.select("gram", "m", "node").join(joined, "node", "left").select("gram", "m", "node", F.coalesce("component", "node").alias("group"))
    placed = stage(placed, "placed")
    mixed = placed.groupBy("gram").agg(F.min("group").alias("least"), F.max("group").alias("most"), F.max("m").alias("m")).where("least != most")
    blocks = F.ceil(F.col("m") / block).cast("int")
    mixed = mixed.select("gram", blocks.alias("blocks"))
    placed = placed.drop("m").join(mixed, "gram").withColumn("mine", F.pmod(F.xxhash64("node", "gram"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select(
        "gram", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node", "group",
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    rest = _links(dealt.join(body, "node"), ["gram", "i", "j"], percent)
    return components(stage(links.unionByName(rest), "all_links"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Rows are linked if 100 * overlap >= percent * union of their sets of n-grams of ``words`` words;
    ``component_id`` is the smallest id that links reach. Null and empty texts have an empty set, are
    linked with nothing and keep their own id. Repeated ids are rows of their own. Rows without an id
    have no component of their own to give and take that of equal texts.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stage(rows.mapInArrow(_sign_sets(words), "id bigint, n bigint, hi bigint, lo bigint, part array<bigint>"), "signed")
    chosen = stage(_candidates(signed, percent), "candidates")
    named = chosen.withColumn("node", F.monotonically_increasing_id())
    named = stage(named, "nodes")
    # candidates grow with the corpus, so they meet their texts by a shuffle at any size
    texts = rows.join(named.select("id", "hi", "node").hint("merge"), "id").select("node", "hi", "text")
    sets = stage(texts.mapInArrow(_whole_sets(words), "node bigint, n bigint, grams array<bigint>"), "sets")
    found = stage(similar_sets(sets, percent, block).join(named, "node").select("hi", "lo", "component", "id"), "found")
    least = found.groupBy("component").agg(F.min("id").alias("component_id"))
    by_set = signed.where("n > 0").groupBy("hi", "lo").agg(F.min("id").alias("first"))
    by_set = by_set.join(found.join(least, "component").select("hi", "lo", "component_id"), ["hi", "lo"], "left")
    by_set = stage(by_set.select("hi", "lo", F.coalesce("component_id", "first").alias("component_id")), "by_set")
    some = signed.where("n > 0").select("id", "n", "hi", "lo").join(by_set, ["hi", "lo"]).select("id", "n", "component_id")
    none = signed.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.unionByName(none).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group, with all their columns.

    Texts without words and rows without an id stay. Rows that repeat an id stay or go together, and stay
    if any of them is its group's smallest; exact deduplication takes equal rows out before.
    """
    groups = near_duplicates(docs, id_col, text_col, words, percent)
    stay = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_id")).distinct()
    kept = docs.join(stay, docs[id_col] == stay["_id"], "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
