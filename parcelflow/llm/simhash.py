"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Fingerprints: XXH64 of every word shingle votes on 64 bits. Links: distinct fingerprints form a binary
trie. Its upper part is cut into subtrees of bounded size by counts of prefixes; every pair of subtrees
whose prefixes differ in no more than the budget becomes one task. A task walks its two subtrees
together, adds up the differing bits of node pairs and drops a pair as soon as they exceed the budget;
small node pairs are compared directly. A task keeps a spanning forest of the links it finds, which is
all that components need, and components are joined in Spark.

Only distinct fingerprints are compared, so copies cost nothing, and a fingerprint has at most 2,080
others within two bits. A fingerprint travels to as many tasks as its prefix has neighbours: at most
1 + d + d(d-1)/2 for a cut at depth d. The driver sees prefix counts and subtree pairs only.

Defined cases: a null or empty text, or one without words, has fingerprint 0, which is linked like any
other; repeated rows share a class; null ids are ignored when the smallest id is sought (a class of
null ids alone has a null id); clashing column names in the input do not matter.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import map_texts, store
from parcelflow.llm.components import components, merge_links

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 2
#: Fingerprints in a subtree at most, and the part of all that it holds at least one subtree per.
SUBTREE, SUBTREES = 1 << 16, 32
#: Node pairs with no more comparisons than this are compared directly.
DIRECT = 64
_CHUNK = 1 << 17


def shingle_hashes(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of the shingles of ``size`` words of a UTF-8 text after lower-casing A-Z (ASCII white space separates)."""
    words = text.lower().split() if text else []
    if len(words) < size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def _votes(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    hashes = shingle_hashes(text, size)
    return int(_POWERS[2 * _votes(hashes) > len(hashes)].sum(dtype=np.uint64))


def with_fingerprint(documents: DataFrame, column: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with the SimHash of each whole text as a signed 64-bit number."""

    def make():
        return lambda texts: [
            pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64), pa.int64())
        ]

    return map_texts(documents, {column: "long"}, make, keep)


def close_pairs(a: np.ndarray, b: np.ndarray, budget: int, same: bool):
    """Index arrays ``(i, j)`` of all pairs within ``budget`` bits, piece by piece; ``a``, ``b`` sorted and distinct.

    With ``same`` (``a`` is ``b``) each unordered pair comes once.
    """
    start = [np.array([v], np.int64) for v in (0, len(a), 0, len(b), 0)]
    stack = [(0, start)]
    while stack:
        depth, (al, ah, bl, bh, err) = stack.pop()
        if len(al) > _CHUNK:
            half = len(al) // 2
            stack += [(depth, [x[:half] for x in (al, ah, bl, bh, err)]), (depth, [x[half:] for x in (al, ah, bl, bh, err)])]
            continue
        work = (ah - al) * (bh - bl)
        direct = (work <= DIRECT) | (depth >= 64)
        if direct.any():
            n, wide = work[direct], (bh - bl)[direct]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide_at = np.repeat(wide, n)
            i = np.repeat(al[direct], n) + at // wide_at
            j = np.repeat(bl[direct], n) + at % wide_at
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= (np.repeat(al[direct] != bl[direct], n)) | (i < j)
            yield i[near], j[near]
        al, ah, bl, bh, err = (x[~direct] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        below = np.uint64(2 * int(bit) - 1)
        am = np.searchsorted(a, (a[al] & ~below) | bit)
        bm = np.searchsorted(b, (b[bl] & ~below) | bit)
        twin = (al == bl) & (ah == bh) if same else np.zeros(len(al), bool)
        parts = [
            (al, am, bl, bm, err, None),
            (am, ah, bm, bh, err, None),
            (al, am, bm, bh, err + 1, None),
            (am, ah, bl, bm, err + 1, ~twin),
        ]
        new = []
        for p in parts:
            on = (p[0] < p[1]) & (p[2] < p[3]) & (p[4] <= budget)
            if p[5] is not None:
                on &= p[5]
            new.append([x[on] for x in p[:5]])
        children = [np.concatenate(x) for x in zip(*new, strict=True)]
        if len(children[0]):
            stack.append((depth + 1, children))


def cut_trie(counts: dict[int, int], depth: int, limit: int, top: int = 0, prefix: int = 0) -> list[tuple[int, int]]:
    """The subtrees ``(prefix, depth)`` below a node that hold ``limit`` fingerprints at most, or end at ``depth``.

    ``counts``: fingerprints by their first ``depth`` bits.
    """
    keys = sorted(counts)
    sums = np.concatenate([[0], np.cumsum([counts[k] for k in keys])])
    keys = np.array(keys, np.uint64)
    out, stack = [], [(prefix, top)]
    while stack:
        p, d = stack.pop()
        low = np.searchsorted(keys, np.uint64(p << (depth - d)))
        high = np.searchsorted(keys, np.uint64(((p + 1) << (depth - d)) - 1), side="right")
        n = int(sums[high] - sums[low])
        if n and (n <= limit or d == depth):
            out.append((p, d))
        elif n:
            stack += [(2 * p, d + 1), (2 * p + 1, d + 1)]
    return out


def subtree_pairs(cut: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs of places in ``cut`` whose prefixes differ in ``budget`` bits at most, each with itself included."""
    starts = np.array([p << (64 - d) for p, d in cut], np.uint64)
    depths = np.array([d for _, d in cut], np.uint64)
    pairs = []
    for k in range(len(cut)):
        common = np.minimum(depths[k], depths[k:])
        differing = starts[k] ^ starts[k:]
        shared = np.where(common == 0, np.uint64(0), differing >> (np.uint64(64) - np.maximum(common, np.uint64(1))))
        pairs += [(k, k + int(m)) for m in np.flatnonzero(np.bitwise_count(shared) <= budget)]
    return pairs


def _prefix(bits: int):
    return F.shiftrightunsigned("fingerprint", 64 - bits)


def _subtrees(nodes: DataFrame, limit: int) -> list[tuple[int, int]]:
    """The cut of the trie; prefixes that are too full at 16 bits are counted again, 8 bits deeper each time."""
    spark, depth = nodes.sparkSession, 16
    counted = nodes.groupBy(_prefix(depth).alias("p")).count().collect()
    cut = cut_trie({r["p"]: r["count"] for r in counted}, depth, limit)
    size = {r["p"]: r["count"] for r in counted}
    done, full = [], [p for p, d in cut if d == depth and size[p] > limit]
    done = [x for x in cut if not (x[1] == depth and size[x[0]] > limit)]
    while full and depth < 64:
        keys = spark.createDataFrame([(p,) for p in full], "q long")
        inner = nodes.withColumn("q", _prefix(depth)).join(F.broadcast(keys), "q")  # one row per subtree
        counted = inner.groupBy("q", _prefix(min(64, depth + 8)).alias("p")).count().collect()
        size = {(r["p"] % 2**64): r["count"] for r in counted}
        cut = []
        for p in full:
            own = {(r["p"] % 2**64): r["count"] for r in counted if r["q"] == p}
            cut += cut_trie(own, min(64, depth + 8), limit, depth, p)
        depth = min(64, depth + 8)
        full = [p for p, d in cut if d == depth and size[p] > limit]
        done += [x for x in cut if not (x[1] == depth and size[x[0]] > limit)]
    return sorted(done + [(p, depth) for p in full], key=lambda x: x[0] << (64 - x[1]))


def links(nodes: DataFrame, budget: int = BUDGET, limit: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fingerprint`` values within ``budget`` bits: a forest per task."""
    total = nodes.count()
    cut = _subtrees(nodes, limit or min(SUBTREE, max(1024, total // SUBTREES)))
    pairs = subtree_pairs(cut, budget)
    starts = np.array([p << (64 - d) for p, d in cut], np.uint64)
    sides: list[list[tuple[int, bool]]] = [[] for _ in cut]
    for k, (x, y) in enumerate(pairs):
        sides[x].append((k, False))
        if x != y:
            sides[y].append((k, True))
    lone = np.array([x == y for x, y in pairs], bool)

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            at = np.searchsorted(starts, values, side="right") - 1
            order = np.argsort(at, kind="stable")
            edges = np.searchsorted(at[order], np.arange(len(starts) + 1))
            for s in np.unique(at).tolist():
                own = values[order[edges[s] : edges[s + 1]]].view(np.int64)
                for k, second in sides[s]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), k)), pa.array(np.full(len(own), second)), pa.array(own)],
                        ["pair", "second", "fingerprint"],
                    )

    def walk(rows: pa.Table) -> pa.Table:
        values = rows.column("fingerprint").to_numpy().view(np.uint64)
        second = rows.column("second").to_numpy()
        same = bool(lone[rows.column("pair")[0].as_py()])
        a = np.sort(values[~second])
        b = a if same else np.sort(values[second])
        both = a if same else np.concatenate([a, b])
        shift = 0 if same else len(a)
        parent = np.arange(len(both))
        for i, j in close_pairs(a, b, budget, same):
            if len(i):
                parent = merge_links(parent, i, j + shift)
        child = np.flatnonzero(parent != np.arange(len(both)))
        ends = [both[child].view(np.int64), both[parent[child]].view(np.int64)]
        return pa.table({"a": pa.array(ends[0]), "b": pa.array(ends[1])})

    dealt = nodes.select("fingerprint").mapInArrow(deal, "pair long, second boolean, fingerprint long")
    return dealt.groupBy("pair").applyInArrow(walk, "a long, b long")


def classes(fingerprints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``(fingerprint, root, component_id)`` for each distinct value of ``fingerprints(doc_id, fingerprint)``, stored.

    ``root``, the smallest fingerprint of the class, names it even where ids are null or repeated.
    """
    nodes = store(fingerprints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    joined = components(links(nodes, budget)).withColumnRenamed("node", "fingerprint")
    rooted = store(
        nodes.join(joined, "fingerprint", "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    ids = store(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    return store(rooted.join(ids, "root").select("fingerprint", "root", "component_id"), "classes")


def document_classes(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    prints = store(with_fingerprint(documents, keep=["doc_id"]), "fingerprints")
    found = prints.join(classes(prints), "fingerprint")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_class(documents: DataFrame) -> DataFrame:
    """The documents that stay: of each class one row, with the smallest id (of several such rows one; null ids last)."""
    numbered = documents.withColumn("__row", F.monotonically_increasing_id())
    marked = store(with_fingerprint(numbered, "__print"), "marked")
    of = classes(marked.select("doc_id", F.col("__print").alias("fingerprint")))
    placed = marked.select("doc_id", "__row", "__print").join(of.withColumnRenamed("fingerprint", "__print"), "__print")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    first = placed.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first")["__row"].alias("__row"))
    return marked.join(first, "__row", "left_semi").select(*[f"`{c}`" for c in documents.columns])
