"""Exact Jaccard join of word shingles, verified by signature trees.

A document's set is its distinct 5-word shingles (a shorter text whole), as 64-bit hashes; equal sets are one node, named
by the hash of the set. Two nodes link at a similarity of 4/5 or more. The steps:

1. Signatures. Sets that link differ in at most (|x| + |y|) / 9 shingles. Sizes fall into classes of ratio 5/4, and two
   neighbouring classes share one cut of the hash range into more parts than such sets can differ in; so linked sets
   agree on the content of a part, and each part's content is a signature. Agreement on empty parts doesn't count: a set
   with too few filled parts for the argument, like any small set, also gives the least 1/5 of its hashes, of which
   linked sets share one (the prefix filter in hash order). No link is lost; a shared passage, though, seldom fills
   whole parts. Exact copies are dropped where they meet, first in a task.
2. Leaves. The nodes that share a signature are put in clusters, each with the OR of its bitmaps and its range of sizes;
   a node gets an edge to each cluster that it could link with a member of, by the largest possible overlap. Signatures
   with more than SLICE nodes are clustered by slices, then the slices' clusters with one another, a task a pair of slices.
   Candidate groups are the components of these edges: a link never leaves one.
3. Verification: the sets of each group meet in a task, and a signature tree joins them: nodes hold the OR of their
   sets' bitmaps and their range of sizes, and the dual traversal drops a pair of nodes if the sizes are too far apart
   or the bits they share, with what bit collisions may hide, can't make the overlap. Pairs already connected are
   skipped; the others are counted exactly. Groups beyond CUT_ITEMS shingles are dealt in slices, a task a pair of
   slices: in a few, and beyond GROUP_ITEMS in as many as keep a task below that.
4. The components of the verified links give every document the smallest id it reaches.

Texts are read whole, as bytes. Documents without words are linked with nothing. Rows with a null id get their set's size
but no component and link nothing. Rows of one id with different texts are nodes of their own. Repeated rows get
repeated results; an empty table gives an empty one. Shingles and sets count as equal if their 64-bit hashes are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import is_small, lookup, own, settle, space_tokens, tidy, with_computed
from .components import components

WORDS = 5
#: Sets up to this size use prefixes only; the size classes begin here.
SMALL = 40
SIGNATURES_A_BUCKET = 1_000_000
#: Shingles of a verification task at most, and from which on a candidate group is dealt over several tasks.
GROUP_ITEMS, CUT_ITEMS = 3_000_000, 200_000
FANOUT = 8

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_PREFIX_TAG = np.uint64(0x8EBC6AF09C88C6E3)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Sets of shingle hashes, with a bounded memory of word hashes."""

    def __init__(self, n: int = WORDS) -> None:
        self.n, self.memo = n, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        tokens = space_tokens(text)
        if not tokens:
            return np.zeros(0, np.uint64)
        known = self.memo
        if len(known) > 200_000:
            known.clear()
        w = np.fromiter((x if (x := known.get(t)) is not None else known.setdefault(t, xxhash.xxh3_64_intdigest(t)) for t in tokens), np.uint64, len(tokens))
        k = min(self.n, len(w))
        h = np.full(len(w) - k + 1, np.uint64(k))
        for j in range(k):
            h = (h ^ w[j : len(w) - k + 1 + j]) * _MULTIPLIERS[j % 5]
            h ^= h >> np.uint64(29)
        return np.unique(mixed(h))


def set_key(h: np.ndarray) -> int:
    """A set's node: a signed 64-bit hash."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64)))


def _bounds() -> list[int]:
    b = [SMALL]
    while b[-1] < 1 << 40:
        b.append(-(-5 * b[-1] // 4))
    return b


BOUNDS = np.array(_bounds())


def signatures(h: np.ndarray) -> np.ndarray:
    """Hashes of which two sets share one if their similarity is 4/5 or more."""
    s, out, short = len(h), [], False
    if s > SMALL:
        c = int(np.searchsorted(BOUNDS, s, "right")) - 1
        for k in (c, c - 1):
            if k < -1:
                continue
            end = int(BOUNDS[k + 2])  # sizes below it share this cut
            differ = 2 * (end - 1) // 9
            parts = int(1.06 * differ) + 3
            part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascends with h
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            content = np.add.reduceat(mixed(h ^ np.uint64(k + 7)), first)
            out.append(mixed(content + part[first] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)))
            short |= len(first) <= (s + min(5 * s // 4, end - 1)) // 9
    if s and (short or s <= 5 * SMALL // 4):
        out.append(mixed(h[: s - (4 * s + 4) // 5 + 1] ^ _PREFIX_TAG))
    return np.concatenate(out) if out else h[:0]


# Candidates


#: Sets up to so many shingles have bitmaps of 2 to the power of so many bits; the last level holds all larger ones. At
#: two bits a shingle or more, unrelated sets hardly ever seem to link.
LEVELS = (*((1 << k, k + 1) for k in range(6, 19)), (1 << 62, 20))
SLICE = 4_096


def level_of(n: int) -> int:
    return next(k for k, (most, _) in enumerate(LEVELS) if n <= most)


def bitmap(h: np.ndarray, log_width: int) -> int:
    flags = np.zeros(1 << log_width, np.uint8)
    flags[(h & np.uint64((1 << log_width) - 1)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def folded(bits: int, level: int, to: int) -> int:
    """A bitmap at a lower level: bit k of it stands for all bits that are k modulo its width."""
    while level > to:
        level -= 1
        width, out = 1 << LEVELS[level][1], 0
        while bits:
            out |= bits & ((1 << width) - 1)
            bits >>= width
        bits = out
    return bits


class Cluster:
    """A leaf of the tree over one signature's sets: the OR of their bitmaps and their range of sizes. excess: by level,
    how many shingles of a set its bit collisions hide at most."""

    __slots__ = ("bits", "excess", "hub", "largest", "level", "smallest")

    def __init__(self, hub: int, level: int, bits: int, smallest: int, largest: int, excess: tuple[int, ...]) -> None:
        self.hub, self.level, self.bits, self.smallest, self.largest, self.excess = hub, level, bits, smallest, largest, excess

    def may_link(self, x: Cluster) -> bool:
        """Whether any of its sets could link with any of x's, by sizes and the largest possible overlap."""
        if 5 * self.largest < 4 * x.smallest or 5 * x.largest < 4 * self.smallest:
            return False
        k = min(self.level, x.level)
        common = (folded(self.bits, self.level, k) & folded(x.bits, x.level, k)).bit_count()
        return 9 * (common + min(self.excess[k], x.excess[k])) >= 4 * (self.smallest + x.smallest)

    def absorb(self, x: Cluster) -> None:
        k = min(self.level, x.level)
        self.bits = folded(self.bits, self.level, k) | folded(x.bits, x.level, k)
        self.level, self.smallest, self.largest = k, min(self.smallest, x.smallest), max(self.largest, x.largest)
        self.excess = tuple(max(a, b) for a, b in zip(self.excess[: k + 1], x.excess[: k + 1], strict=True))


def leaf_of(node: int, h: np.ndarray) -> Cluster:
    level = level_of(len(h))
    bits = bitmap(h, LEVELS[level][1])
    return Cluster(node, level, bits, len(h), len(h), tuple(len(h) - folded(bits, level, k).bit_count() for k in range(level + 1)))


def clustered(leaves: list[Cluster]) -> tuple[list[tuple[int, int]], list[Cluster]]:
    """Edges that connect all sets that could link, and the clusters. A set joins the first cluster that it could link
    with a member of, and gets an edge to the hub of every other one: no pair that could link stays apart."""
    edges, active, done = [], [], []
    for x in sorted(leaves, key=lambda x: (x.smallest, x.hub)):
        if any(5 * c.largest < 4 * x.smallest for c in active):
            done += [c for c in active if 5 * c.largest < 4 * x.smallest]
            active = [c for c in active if 5 * c.largest >= 4 * x.smallest]
        home = None
        for c in active:
            if c.may_link(x):
                if c.hub != x.hub:
                    edges.append((c.hub, x.hub))
                home = home or c
        if home:
            home.absorb(x)
        else:
            active.append(x)
    return edges, done + active


def _put(cluster: Cluster) -> tuple:
    return cluster.hub, cluster.level, cluster.bits.to_bytes((1 << LEVELS[cluster.level][1]) // 8, "little"), cluster.smallest, cluster.largest, list(cluster.excess)


def _got(row) -> Cluster:
    return Cluster(int(row.node), int(row.level), int.from_bytes(row.bits, "little"), int(row.smallest), int(row.largest), tuple(int(x) for x in row.excess))


_LEAF = "node long, level int, bits binary, smallest int, largest int, excess array<int>"
_MET = f"run long, piece int, n int, nodes array<long>, leaf struct<{_LEAF.replace(' ', ':').replace(',:', ',')}>"


def candidate_edges(docs: DataFrame, buckets: int) -> DataFrame:
    """(text binary) -> a, b: edges whose components hold all links."""
    met_schema = to_arrow_schema(StructType.fromDDL(_MET))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(), set()
        for batch in batches:
            held, size = [], 0
            for text in batch.column("text").to_pylist():
                h = shingle(text)
                node = set_key(h) if len(h) else None
                if node is None or node in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(node)
                held.append((signatures(h), node, _put(leaf_of(node, h))))
                size += len(held[-1][0])
                if size > SIGNATURES_A_BUCKET:
                    yield told(held)
                    held, size = [], 0
            if held:
                yield told(held)
        held = []
        tidy()

    def told(held: list[tuple]) -> pa.RecordBatch:
        """One row a bucket: signatures and nodes, packed; and the bitmaps, dealt over as many buckets below zero."""
        sigs = np.concatenate([s for s, _, _ in held])
        nodes = np.repeat(np.array([n for _, n, _ in held], np.int64), [len(s) for s, _, _ in held])
        at = (sigs % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(at, kind="stable")  # a node's signatures stay side by side, which compresses
        sigs, nodes, at = sigs[order], nodes[order], at[order]
        cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])).tolist() if len(at) else []
        rows = [(int(at[i]), sigs[i:j].tobytes(), nodes[i:j].tobytes()) for i, j in zip(cuts, [*cuts[1:], len(at)], strict=True)]
        leaves: dict[int, list] = {}
        for _, n, leaf in held:
            leaves.setdefault(-1 - n % buckets, []).append(leaf)
        rows += [(b, pickle.dumps(x), b"") for b, x in leaves.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "x", "y"])

    def meet(group: pa.Table) -> pa.Table:
        """Signatures that several nodes have, as lists of nodes in pieces; lists that return are told once. Bitmaps pass, once a node."""
        xs, ys = group.column("x").to_pylist(), group.column("y").to_pylist()
        if group.column("bucket")[0].as_py() < 0:
            leaves = {leaf[0]: leaf for x in xs for leaf in pickle.loads(x)}
            names = _LEAF.replace(" long", "").replace(" int", "").replace(" binary", "").replace(" array<int>", "").split(", ")
            rows = [(None, None, None, None, dict(zip(names, leaf, strict=True))) for leaf in leaves.values()]
        else:
            sigs = np.concatenate([np.frombuffer(x, np.uint64) for x in xs])
            nodes = np.concatenate([np.frombuffer(y, np.int64) for y in ys])
            order = np.lexsort((nodes, sigs))
            sigs, nodes = sigs[order], nodes[order]
            keep = np.concatenate([[True], (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1])])  # a node comes from several tasks
            sigs, nodes = sigs[keep], nodes[keep]
            first = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
            ends = np.append(first[1:], len(sigs))
            runs = {}
            for i, j in zip(first[ends - first > 1].tolist(), ends[ends - first > 1].tolist(), strict=True):
                runs.setdefault(set_key(nodes[i:j]), nodes[i:j])
            rows = [(k, i // SLICE, len(v), v[i : i + SLICE].tolist(), None) for k, v in runs.items() for i in range(0, len(v), SLICE)]
        columns = zip(*rows, strict=True) if rows else ([],) * 5
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, met_schema, strict=True)], schema=met_schema)

    met = settle(docs.mapInArrow(sign, "bucket int, x binary, y binary").groupBy("bucket").applyInArrow(meet, _MET), "jaccard-signatures")
    runs = met.filter("run IS NOT NULL").select("run", "piece", "n", "nodes").dropDuplicates(["run", "piece"])
    parts = F.ceil(F.col("n") / SLICE).cast("int")
    members = runs.select("run", parts.alias("slices"), F.explode("nodes").alias("node")).withColumn("slice", F.pmod(F.xxhash64("node"), "slices").cast("int"))
    leaves = met.filter("leaf IS NOT NULL").select("leaf.*")
    members = members.join(leaves, "node")

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        """Edges (a, b); and of runs in several slices the clusters, for the next step."""
        edges, more, over = [], [], {}

        def top(x: int) -> int:
            while (y := over.get(x, x)) != x:
                over[x] = x = over.get(y, y)
            return x

        for (run, *at), one in group.groupby(["run", "slice", "other"], sort=False):
            found, clusters = clustered([_got(r) for r in one.itertuples()])
            for a, b in found:  # of the task's edges those that connect anything new
                if (x := top(a)) != (y := top(b)):
                    over[x] = y
                    edges.append((a, b))
            slices = one["slices"].iloc[0]
            if slices > 1 and at[0] == at[1]:
                more += [(run, at[0], slices, *_put(c)) for c in clusters]
        return _frame(edges, more)

    def _frame(edges: list, more: list) -> pd.DataFrame:
        names = ["a", "b", "run", "slice", "slices", "node", "level", "bits", "smallest", "largest", "excess"]
        rows = [(a, b, *[None] * 9) for a, b in edges] + [(None, None, *m) for m in more]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        # Column by column: hashes among nulls must not pass through floats.
        return pd.DataFrame({n: pd.Series(list(c), dtype=object) if n in ("bits", "excess") else pd.array(list(c), "Int64") for n, c in zip(names, columns, strict=True)})

    schema = f"a long, b long, run long, slice int, slices int, {_LEAF}"
    bins = max(64, buckets)
    first = members.withColumn("other", F.col("slice")).withColumn("bin", F.pmod(F.xxhash64("run", "slice"), F.lit(bins)))
    first = settle(first.groupBy("bin").applyInPandas(cluster, schema), "jaccard-edges")
    held = first.filter("run IS NOT NULL").drop("a", "b").withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).filter("_x <> slice")
    held = held.withColumn("other", F.greatest("slice", "_x")).withColumn("slice", F.least("slice", "_x")).drop("_x")
    second = held.groupBy("run", "slice", "other").applyInPandas(cluster, schema)
    return first.filter("a IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


# Verification


class _Node:
    __slots__ = ("bits", "children", "excess", "largest", "one", "row", "smallest")

    def __init__(self, bits: int, smallest: int, largest: int, excess: int, children: list[_Node], row: int = -1) -> None:
        self.bits, self.smallest, self.largest, self.excess, self.children, self.row = bits, smallest, largest, excess, children, row
        self.one = row >= 0  # whether all rows below are known to be connected


class SignatureTree:
    """Links among sets, as a spanning forest of their graph."""

    def __init__(self, sets: list[np.ndarray], fanout: int = FANOUT) -> None:
        self.sets = sets
        self.parent = list(range(len(sets)))
        width = 1 << max(6, int(4 * np.median([len(s) for s in sets])).bit_length()) if sets else 64
        level = []
        for row in sorted(range(len(sets)), key=lambda k: (sets[k][0], len(sets[k]))):  # similar sets tend to share their least hash
            flags = np.zeros(width, np.uint8)
            flags[(sets[row] & np.uint64(width - 1)).astype(np.int64)] = 1
            bits = int.from_bytes(np.packbits(flags).tobytes(), "big")
            n = len(sets[row])
            level.append(_Node(bits, n, n, n - bits.bit_count(), [], row))
        self.order = [x.row for x in level]
        while len(level) > 1:
            level = [self._over(level[k : k + fanout]) for k in range(0, len(level), fanout)]
        self.root = level[0] if level else None

    @staticmethod
    def _over(children: list[_Node]) -> _Node:
        bits = 0
        for c in children:
            bits |= c.bits
        return _Node(bits, min(c.smallest for c in children), max(c.largest for c in children), max(c.excess for c in children), children)

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def any_row(self, node: _Node) -> int:
        while node.row < 0:
            node = node.children[0]
        return node.row

    def connected(self, node: _Node) -> bool:
        """Whether all rows below are connected; once so, always so."""
        if not node.one and all(self.connected(c) for c in node.children):
            node.one = len({self.find(self.any_row(c)) for c in node.children}) == 1
        return node.one

    def linked(self, a: int, b: int) -> bool:
        both = np.concatenate([self.sets[a], self.sets[b]])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= 80 * (len(both) - common)

    def can_link(self, a: _Node, b: _Node) -> bool:
        if 5 * a.largest < 4 * b.smallest or 5 * b.largest < 4 * a.smallest:
            return False
        return 9 * ((a.bits & b.bits).bit_count() + min(a.excess, b.excess)) >= 4 * (a.smallest + b.smallest)

    def links(self, allowed=None) -> list[tuple[int, int]]:
        """Verified links that connect what links connect; allowed(a, b) may exclude pairs that another task has."""
        found: list[tuple[int, int]] = []

        def meet(a: int, b: int) -> None:
            if (x := self.find(a)) != (y := self.find(b)) and (allowed is None or allowed(a, b)) and self.linked(a, b):
                self.parent[x] = y
                found.append((a, b))

        for a, b in zip(self.order, self.order[1:], strict=False):
            meet(a, b)
        stack = [(self.root, self.root)] if self.root else []
        while stack:
            a, b = stack.pop()
            if self.connected(a) and self.connected(b) and self.find(self.any_row(a)) == self.find(self.any_row(b)):
                continue
            if a is b:
                stack += [(x, y) for k, x in enumerate(a.children) for y in a.children[k:]]
            elif self.can_link(a, b):
                if a.row >= 0 and b.row >= 0:
                    meet(a.row, b.row)
                elif b.row >= 0 or (a.row < 0 and a.largest - a.smallest > b.largest - b.smallest):
                    stack += [(x, b) for x in a.children]
                else:
                    stack += [(a, y) for y in b.children]
        return found


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, items: int = GROUP_ITEMS) -> DataFrame:
    """docs (doc_id, text), sets (doc_id, n, node), groups (node, root) -> a, b: links that connect what links connect."""
    members = groups.select("node", "root").unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    # One document a node brings its set.
    firsts = sets.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    members = settle(members.join(firsts, "node"), "jaccard-members")
    sizes = members.groupBy("root").agg(F.sum("n").alias("items"), F.count("*").alias("n_sets"))
    members = settle(lookup(members, settle(sizes, "jaccard-groups"), "root", "n_sets"), "jaccard-members")
    cut = min(items, CUT_ITEMS)
    needed, wanted = F.ceil(F.col("items") / (items // 2)), F.least(F.lit(6), F.ceil(F.col("items") / (cut // 4)))
    slices = F.when(F.col("items") > cut, F.greatest(needed, wanted)).otherwise(1).cast("int")
    members = members.withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("node"), "slices").cast("int"))
    brought = members.select("doc_id", "node", "root", "slices", "slice")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    texts = texts.join(F.broadcast(brought) if is_small(brought) else brought, "doc_id")

    def bring():
        shingle = Shingler()

        def run(rows: list[bytes | None], nodes: list[int]) -> list:
            found = [shingle(t) for t in rows]
            return [[h.tobytes() if len(h) and set_key(h) == n else None for h, n in zip(found, nodes, strict=True)]]

        return run

    held = with_computed(texts, ["text", "node"], "items binary", bring, ("text", "doc_id")).filter("items IS NOT NULL")
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    held = held.withColumn("first", F.least("slice", "other")).withColumn("second", F.greatest("slice", "other"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for _, one in group.drop_duplicates(["root", "first", "second", "node"]).groupby(["root", "first", "second"], sort=False):
            nodes, slices = one["node"].to_numpy(), one["slice"].to_numpy()
            tree = SignatureTree([np.frombuffer(x, np.uint64) for x in one["items"]])
            # Within a slice its own pair of slices decides.
            across = one["first"].iloc[0] != one["second"].iloc[0]
            found += [(nodes[a], nodes[b]) for a, b in tree.links((lambda a, b, s=slices: s[a] != s[b]) if across else None)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    total = int(members.agg(F.coalesce(F.sum(F.col("n") * F.col("slices")), F.lit(0))).first()[0])
    bins = max(64, -(-16 * total // items))  # a task gets the groups of a bin; a bin holds about a sixteenth of the largest group
    bin_of = F.when(F.col("slices") > 1, F.xxhash64("root", "first", "second")).otherwise(F.pmod(F.xxhash64("root"), F.lit(bins)))
    return held.withColumn("bin", bin_of).groupBy("bin").applyInPandas(verify, "a long, b long")


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def measure():
        shingle = Shingler()

        def run(texts: list[bytes | None]) -> list[list]:
            found = [shingle(t) for t in texts]
            return [[len(h) for h in found], [set_key(h) if len(h) else None for h in found]]

        return run

    sets = settle(with_computed(docs, ["text"], "n long, node long", measure, ("text",)), "jaccard-sets")
    total = int(sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    known = docs.filter("doc_id IS NOT NULL").select(F.col("text").cast("binary").alias("text"))
    groups = components(candidate_edges(known, max(8, -(-total // SIGNATURES_A_BUCKET))))
    found = components(settle(verified_links(docs, sets, groups), "jaccard-links"))
    own = sets.filter("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("own"), F.count("*").alias("times"))
    rooted = own.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = settle(rooted.groupBy("root").agg(F.min("own").alias("component_id"), F.count("*").alias("n_nodes")), "jaccard-least")
    named = settle(lookup(rooted.select("node", "times", "root"), least, "root", "n_nodes").select("node", "times", "component_id"), "jaccard-named")
    out = lookup(sets, named, "node", "times")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The documents whose id is their component's; rows without an id stay. Other columns pass through.

    A document that a repeated id brings twice stays twice only if its texts differ."""
    kept = settle(report(docs).filter("doc_id = component_id").select("doc_id").distinct(), "jaccard-kept")
    rows = docs.filter("doc_id IS NOT NULL").join(F.broadcast(kept) if is_small(kept) else kept, "doc_id", "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]).select(*own(docs)).unionByName(docs.filter("doc_id IS NULL"))
