"""Near-duplicate documents by SimHash, searched in vantage-point trees.

A fingerprint has 64 bits or a multiple. Two fingerprints are linked when they differ in at most
``radius`` bits; a group is a connected component of links.

**Partitioning.** A forest of vantage-point trees splits the distinct fingerprints into shards.
Each tree measures Hamming distance on its own subset of bits, where the triangle inequality
holds as well, and its shards are the combinations of distances to a set of vantage points. With
``radius + 1`` disjoint subsets, two linked fingerprints agree on one subset at least: their
distance in that tree is 0, the bounds leave one shard only, and the search is exact
(``exact_forest``). For wide radii ``sampled_forest`` draws overlapping subsets of about
log2(rows) bits, as many as the wanted recall asks for.

**Search.** Inside a shard a tree on the full distance is searched: a vantage point halves the
points, and the triangle bounds prune the half that cannot hold partners. A shard above ``cell``
fingerprints is cut into rings of one radius' width around a fixed vantage point, rings into
cells, and each pair of cells in equal or neighbouring rings is searched by a task of its own, so
that no task ever holds more than two cells. Tasks send a spanning forest of the links they find,
never all pairs.

**Check.** ``drop_near_copies`` links documents by the exact similarity of their shingle sets. The trees
only propose pairs, for each document its nearest ones; they find most links, and groups of near copies are whole
after them. What they miss is found exactly, by lists of rare shingles: two sets of similarity s have their
first common shingle among the first n - ceil(s n) + 1 of each, in any order of all shingles. The order
puts those that a sample finds common last, so the lists stay short. Lists with documents of one group only
are left out, and lists of the same documents are one. ``near_links`` checks the others in rounds. A round proposes for each document its next nearest
partners of other groups, leaves out those that sizes or parities of the sets or the number of their common first
shingles rule out, checks the rest on the texts, and merges groups. Tasks that still hold unchecked partners across groups go on to the
next round with eight times as many, so every pair is ruled out, checked or lies inside one group, and
groups of near copies are never expanded into all their pairs.

**Groups.** Components come from alternating large and small stars, one written table a round.

Defined cases: null and empty texts have no words and fingerprint 0, which links like any other.
Fewer words than a shingle are one shingle. Rows that repeat ``doc_id`` and text are in one group
and, in ``drop_near_copies``, one of them stays. A null ``doc_id`` is never the smallest. Other
columns are carried along. Texts are hashed in blocks, so their length does not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import mix, written
from tidelog.llm.exact import flag_repeated, repeated_filter

BLOCK = 1 << 18
CELL = 4096
LEAF = 64
FP, TEXT_HASH = "__fingerprint", "__text_hash"
SAMPLED, COMMON, MOST_COMMON = 10_000, 5, 100_000
LEAST_PARITY, MOST_PARITY = 256, 1 << 15
# Rows whose texts are wanted that are sent to all tasks; above, a filter of bounded size is.
MOST_SENT = 100_000


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of lower-cased words; fewer words are one shingle, none has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), BLOCK):
        block = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes[at : at + BLOCK] = np.fromiter((digest(joined[s:e], 42) for s, e in block), np.uint64)
    return hashes


def fingerprint(text: bytes, shingle: int, width: int, distinct: bool = False) -> bytes:
    """Majority of each bit over the hashes of all shingles, as big-endian bytes.

    Above 64 bits, further words of hash bits are mixed from the first. With ``distinct`` a repeated
    shingle counts once, and 8 bytes that name the set of shingles follow the fingerprint.
    """
    hashes = shingle_hashes(text, shingle)
    return _majority(np.unique(hashes) if distinct else hashes, width, distinct)


def _majority(hashes: np.ndarray, width: int, distinct: bool) -> bytes:
    counts = np.zeros(64 * width, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        first = hashes[at : at + BLOCK]
        for w in range(width):
            h = first if w == 0 else mix(first + np.uint64(w * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            counts[64 * w : 64 * w + 64] += _bit_counts(h)
    bits = counts * 2 > len(hashes)
    prints = np.packbits(bits.reshape(width, 64)[:, ::-1]).tobytes()
    return prints + xxhash.xxh64_digest(hashes.tobytes(), 42) if distinct else prints


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the numbers have each bit, from bit 0 on."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    total = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:  # byte sums of 255 rows cannot overflow
        total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def with_fingerprints(
    docs: DataFrame, shingle: int, width: int, carry: list[str] | None = None, distinct: bool = False
) -> DataFrame:
    """``doc_id``, the carried columns and the fingerprint (binary) of every document."""
    chosen = docs.select("text", "doc_id", *(carry or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            prints = [fingerprint(t or b"", shingle, width, distinct) for t in texts]
            yield pa.record_batch(
                [*batch.columns[1:], pa.array(prints, pa.binary())], names=[*batch.schema.names[1:], FP]
            )

    schema = T.StructType([*chosen.schema.fields[1:], T.StructField(FP, T.BinaryType())])
    return chosen.mapInArrow(run, schema)


# ---------------------------------------------------------------- shards


def _bits_to_masks(subsets: list[np.ndarray], width: int) -> np.ndarray:
    masks = np.zeros((len(subsets), 64 * width), dtype=np.uint8)
    for row, bits in zip(masks, subsets):
        row[bits] = 1
    return np.packbits(masks, axis=1).view(">u8").astype(np.uint64)


def exact_forest(width: int, radius: int) -> np.ndarray:
    """Masks of ``radius + 1`` disjoint subsets of bits: no link within the radius is lost."""
    return _bits_to_masks(np.array_split(np.arange(64 * width), radius + 1), width)


def sampled_forest(width: int, radius: int, rows: int, recall: float = 0.98, seed: int = 11) -> np.ndarray:
    """Masks of random subsets of about log2(rows / 64) bits, as many as reach the recall.

    A pair ``radius`` bits apart shares a shard of one tree with probability (1 - radius/bits)**size;
    closer pairs are found more often.
    """
    size = max(10, math.ceil(math.log2(max(rows, 1) / 64 + 1)))
    same = (1 - radius / (64 * width)) ** size
    trees = math.ceil(math.log(1 - recall) / math.log(1 - same))
    draw = np.random.Generator(np.random.PCG64(seed))
    return _bits_to_masks([draw.choice(64 * width, size, replace=False) for _ in range(trees)], width)


def _as_words(prints: list[bytes], width: int) -> np.ndarray:
    """The fingerprints as rows of 64-bit words, without what follows them."""
    if not prints:
        return np.zeros((0, width), np.uint64)
    return np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(len(prints), -1)[:, :width]


def _distance(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).sum(axis=1, dtype=np.int64)


def _shard_keys(points: np.ndarray, mask: np.ndarray, vantages: np.ndarray) -> np.ndarray:
    """The combination of distances to all vantage points, measured on the bits of the mask."""
    key = np.zeros(len(points), dtype=np.uint64)
    for v in vantages:
        key = key * np.uint64(257) + _distance(points & mask, v & mask).astype(np.uint64)
        key = mix(key)
    return key


def _sharder(masks: np.ndarray, width: int, radius: int, points_per_tree: int = 10, seed: int = 5):
    draw = np.random.Generator(np.random.PCG64(seed))
    vantages = draw.integers(0, 1 << 64, (points_per_tree + 1, width), dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _as_words(batch.column(0).to_pylist(), width)
            ring = pa.array(_distance(points, vantages[-1]) // (radius + 1), pa.int32())
            for tree, mask in enumerate(masks):
                key = _shard_keys(points, mask, vantages[:-1]) ^ mix(np.full(len(points), tree + 1, np.uint64))
                yield pa.record_batch(
                    [pa.array(key.view(np.int64)), ring, batch.column(0)], names=["shard", "ring", "fp"]
                )

    return run


def _tasks(fingerprints: DataFrame, masks: np.ndarray, width: int, radius: int, cell: int) -> DataFrame:
    """(task, fp): the shards of all trees."""
    shards = fingerprints.select("fp").mapInArrow(
        _sharder(masks, width, radius), "shard bigint, ring int, fp binary"
    )
    return _cut(shards, cell)


def _cut(shards: DataFrame, cell: int) -> DataFrame:
    """(task, fp and further columns): every shard, or pair of cells of a large shard, under a number of its own.

    Partners lie in equal or neighbouring rings.
    """
    rings = shards.groupBy("shard", "ring").count()
    large = written(
        rings.groupBy("shard").agg(
            F.sum("count").alias("total"),
            F.map_from_entries(
                F.collect_list(F.struct("ring", F.ceil(F.col("count") / cell).cast("int")))
            ).alias("cells"),
        ).where(F.col("total") > cell).drop("total"),
        "large-shards",
    )
    placed = shards.join(large, "shard", "left")
    # Within a large shard: own cell, and the cells of the same and the two neighbouring rings.
    mine = "named_struct('r', ring, 'c', CAST(pmod(xxhash64(fp), try_element_at(cells, ring)) AS INT))"
    others = (
        "flatten(transform(filter(array(ring - 1, ring, ring + 1), r -> try_element_at(cells, r) IS NOT NULL), "
        "r -> transform(sequence(0, try_element_at(cells, r) - 1), c -> named_struct('r', r, 'c', c))))"
    )
    task = f"transform({others}, o -> xxhash64(shard, least(o, {mine}), greatest(o, {mine})))"
    return placed.select(
        F.explode(F.expr(f"CASE WHEN cells IS NULL THEN array(shard) ELSE {task} END")).alias("task"),
        *[c for c in shards.columns if c not in ("shard", "ring")],
    )


# ---------------------------------------------------------------- search


def _search(a: np.ndarray, points: np.ndarray, b: np.ndarray, radius: int, found) -> None:
    """Report each point of ``a`` with its partners in ``b`` (indices into ``points``), itself included.

    A vantage point halves ``a``; by the triangle inequality partners of a point at distance d from
    it lie between d - radius and d + radius.
    """
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if not len(a) or not len(b):
            continue
        if len(a) > LEAF:
            vantage = points[a[0]]
            da, db = _distance(points[a], vantage), _distance(points[b], vantage)
            middle = int(np.median(da))
            inner = da <= middle
            if inner.all():
                middle = int(da.max()) - 1
                inner = da <= middle
            if inner.any() and not inner.all():
                stack.append((a[inner], b[db <= middle + radius]))
                stack.append((a[~inner], b[db > middle - radius]))
                continue
        for part in np.array_split(a, -(-len(a) // LEAF)):
            distance = np.zeros((len(part), len(b)), dtype=np.int64)
            for w in range(points.shape[1]):
                distance += np.bitwise_count(points[part, w][:, None] ^ points[b, w][None, :])
            near = distance <= radius
            for row in np.flatnonzero(near.sum(axis=1) > 1):
                found(part[row], b[near[row]])


def spanning(points: np.ndarray, radius: int) -> np.ndarray:
    """For each point the smallest index that it reaches by links."""
    label = np.arange(len(points))

    def unite(_: int, members: np.ndarray) -> None:
        roots = label[members]
        if (roots != roots[0]).any():
            roots = np.unique(roots)
            label[np.isin(label, roots[1:])] = roots[0]

    everything = np.arange(len(points))
    _search(everything, points, everything, radius, unite)
    return label


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Each task's rows without the task's number; rows arrive sorted by task."""
    task, waiting = None, []
    for batch in batches:
        tasks = batch.column(0).to_numpy(zero_copy_only=False)
        rows = list(zip(*(c.to_pylist() for c in batch.columns[1:])))
        cuts = [0, *(np.flatnonzero(np.diff(tasks)) + 1).tolist(), len(tasks)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if tasks[lo] != task:
                if waiting:
                    yield task, waiting
                task, waiting = int(tasks[lo]), []
            waiting += rows[lo:hi]
    if waiting:
        yield task, waiting


def _linker(width: int, radius: int):
    """Links of each task as a star to the smallest fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_task(batches):
            prints = sorted({r[0] for r in rows})
            if len(prints) < 2:
                continue
            label = spanning(_as_words(prints, width), radius)
            members = np.flatnonzero(label != np.arange(len(prints)))
            a, b = [prints[i] for i in members], [prints[label[i]] for i in members]
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def find_links(fingerprints: DataFrame, masks: np.ndarray, width: int, radius: int, cell: int = CELL) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect all groups; a > b."""
    tasks = _tasks(fingerprints, masks, width, radius, cell)
    found = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(
        _linker(width, radius), "a binary, b binary"
    )
    return found.groupBy("a", "b").agg(F.count("*").alias("n")).select("a", "b")


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked node with the smallest node of its component.

    Alternating stars: each node's larger neighbours, then its smaller ones, are moved to the
    smallest node next to it, until nothing changes. Neighbours are only aggregated (a minimum);
    the joins are plain ones on written tables, so Spark splits a node with very many links.
    """
    edges, before = written(links.where("a != b"), "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a != b").distinct(), "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if after == before or after[0] == 0:
            return edges
        before = after


def group_fingerprints(prints: DataFrame, masks: np.ndarray, width: int, radius: int, cell: int = CELL) -> DataFrame:
    """(fp, component_id): for every distinct fingerprint its group's smallest document.

    ``prints`` has ``doc_id`` and ``__fingerprint``.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    nodes = written(prints.groupBy(F.col(FP).alias("fp")).agg(F.min(order).alias("first")), "nodes")
    roots = components(find_links(nodes, masks, width, radius, cell)).select(
        F.col("a").alias("fp"), F.col("b").alias("root")
    )
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = written(placed.groupBy("root").agg(F.min("first").alias("best")), "best")
    return written(placed.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id")), "components")


def near_groups(docs: DataFrame, *, shingle: int = 4, radius: int = 4, cell: int = CELL) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex), ``component_id``. Exact."""
    prints = written(with_fingerprints(docs, shingle, 1), "fingerprints")
    groups = group_fingerprints(prints, exact_forest(1, radius), 1, radius, cell)
    return prints.join(groups, prints[FP] == groups["fp"]).select(
        "doc_id", F.lower(F.hex(FP)).alias("fingerprint"), "component_id"
    )


# ---------------------------------------------------------------- exact similarity


def similarity_radius(similarity: float, width: int) -> int:
    """Bits in which the fingerprints of two shingle sets of that Jaccard similarity differ on average."""
    cosine = 2 * similarity / (1 + similarity)
    return round(64 * width * math.acos(cosine) / math.pi)


def _proposed(tasks: DataFrame, pairs, parts: int) -> DataFrame:
    """(a, b, more): pairs of each task to check (a > b), and the tasks that have more.

    Rows of ``tasks`` are (task, fp, root) and further columns, which ``pairs`` gets with the fingerprints in order.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("more", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, rows in _by_task(batches):
            known = {r[0]: r[1:] for r in rows}
            prints = sorted(known)
            if len(prints) < 2:
                continue
            roots, *others = zip(*(known[p] for p in prints))
            _, group = np.unique(np.array(roots, dtype=object), return_inverse=True)
            if group.max() == 0:
                continue
            chosen, more = pairs(prints, group, *others)
            a, b = [prints[i] for i, _ in chosen], [prints[j] for _, j in chosen]
            flags = [None] * len(chosen)
            if more:
                a, b, flags = [*a, None], [*b, None], [*flags, task]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip((a, b, flags), schema)], schema=schema)

    found = tasks.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(run, "a binary, b binary, more bigint")
    return written(found, "proposed")


def _nearest(width: int, radius: int, count: int):
    """Of a point's partners within the radius the nearest of other groups, and the smallest."""

    def pairs(prints: list[bytes], group: np.ndarray) -> tuple[set[tuple[int, int]], bool]:
        points, out = _as_words(prints, width), set()

        def found(row: int, partners: np.ndarray) -> None:
            partners = partners[partners != row]
            order = np.lexsort((partners, _distance(points[partners], points[row])))
            ranked = partners[order]
            chosen = ranked[:count][group[ranked[:count]] != group[row]].tolist()
            chosen.append(int(ranked.min()))
            out.update((max(row, c), min(row, c)) for c in chosen)

        everything = np.arange(len(prints))
        _search(everything, points, everything, radius, lambda row, near: found(int(row), near))
        return out, False

    return pairs


def _possible(width: int, similarity: float, low: int, high: int):
    """Of a point's partners that sizes and parities allow, nearest first, the ``low``-th to ``high``-th of other groups.

    Sets of n and m shingles have at most (n + m) (1 - s) / (1 + s) that only one of them has, and their parities
    differ in no more bits than that. Parities of twice as many classes are halved before they are compared; sets that differ
    more in size than that are not similar, or left in.
    """
    apart = (1 - similarity) / (1 + similarity)

    def halved(parities: list[bytes], words: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By number of words: the sets with as many, or twice as many, and their parities in as many."""
        tables = {}
        for w in np.unique(words).tolist():
            for to in (w, w // 2):
                rows = np.flatnonzero(words == w)
                bits = _as_words([parities[i] for i in rows.tolist()], w)
                bits = bits if to == w else bits[:, :to] ^ bits[:, to:]
                old = tables.get(to, (rows[:0], bits[:0]))
                tables[to] = np.concatenate([old[0], rows]), np.concatenate([old[1], bits])
        return tables

    def pairs(prints, group, sizes, parities) -> tuple[set[tuple[int, int]], bool]:
        points, out, more = _as_words(prints, width), set(), False
        size, words = np.array(sizes, dtype=np.int64), np.array([len(p) // 8 for p in parities])
        tables = halved(parities, words)
        for lo in range(0, len(prints), 256):
            part = np.arange(lo, min(lo + 256, len(prints)))
            mine = size[part][:, None]
            near = np.minimum(mine, size) >= similarity * np.maximum(mine, size) - 1e-6
            for w in np.unique(words[part]).tolist():
                own = np.flatnonzero(words[part] == w)
                for to in (w, w // 2):
                    rows, bits = tables[to]
                    others = np.flatnonzero((words[rows] == to) | (to == w))
                    ours = bits[np.argsort(rows)[np.searchsorted(np.sort(rows), part[own])]]
                    differ = np.zeros((len(own), len(others)), dtype=np.int32)
                    for i in range(to):
                        differ += np.bitwise_count(ours[:, i][:, None] ^ bits[others, i])
                    at = np.ix_(own, rows[others])
                    near[at] &= differ <= apart * (mine[own] + size[rows[others]]) + 1e-6
            near[part - lo, part] = False
            open_rows = (near & (group[part][:, None] != group)).any(axis=1)
            for row in part[open_rows].tolist():
                partners = np.flatnonzero(near[row - lo])
                ranked = partners[np.lexsort((partners, _distance(points[partners], points[row])))]
                other = group[ranked] != group[row]
                more = more or bool(other[high:].any())
                out.update((max(row, c), min(row, c)) for c in ranked[low:high][other[low:high]].tolist())
        return out, more

    return pairs


# ---------------------------------------------------------------- lists of rare shingles


def prefix_length(count: int, similarity: float) -> int:
    """How many first shingles of a set hold the first one that it has in common with any similar set."""
    return count - math.ceil(similarity * count - 1e-6) + 1 if count else 0


def _first(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray, count: int) -> np.ndarray:
    """The first shingles in the order that puts common ones last, the most common at the end."""
    late = np.zeros(len(hashes), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        late = np.where(common[at] == hashes, rank[at], 0)
    return hashes[np.lexsort((hashes, late))[:count]]


def _parity_bits(count: int) -> int:
    """Classes for the parities of a set: as many as shingles at least, or the sums of unlike sets could not differ in enough of them."""
    return min(max(LEAST_PARITY, 1 << max(count - 1, 0).bit_length()), MOST_PARITY)


def _parity(hashes: np.ndarray, bits: int = LEAST_PARITY) -> bytes:
    """For each class of shingles whether their number is odd. The halves of it, combined by XOR, are those for half as many classes."""
    odd = np.bincount((mix(hashes) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def common_shingles(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found often in a sample of the documents, sorted, and their order by number.

    Only the lengths of lists depend on the sample; what is linked does not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                hashes = np.unique(shingle_hashes(text or b"", shingle))
                yield pa.record_batch([pa.array(hashes.view(np.int64))], names=["shingle"])

    every = max(1, docs.count() // SAMPLED)
    sample = docs.where(F.pmod(F.xxhash64(TEXT_HASH), F.lit(every)) == 0).select("text")
    counted = sample.mapInArrow(run, "shingle bigint").groupBy("shingle").count().where(F.col("count") >= COMMON)
    rows = counted.orderBy(F.desc("count"), "shingle").limit(MOST_COMMON).collect()
    hashes = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(rows) - np.arange(len(rows)))[order]


def with_shingles(
    docs: DataFrame, shingle: int, width: int, similarity: float, common: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """Per document: id, hash of the text, fingerprint, hash of the shingle set, its size, parities and first shingles."""
    chosen = docs.select("text", "doc_id", TEXT_HASH)
    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    names = (FP, "__set", "__n", "__parity", "__first")

    def described(text: bytes) -> tuple:
        hashes = np.unique(shingle_hashes(text, shingle))
        first = _first(hashes, *common, prefix_length(len(hashes), similarity))
        prints = _majority(hashes, width, True)
        name = int.from_bytes(prints[-8:], "big", signed=True)
        return prints, name, len(hashes), _parity(hashes, _parity_bits(len(hashes))), first.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [described(t or b"") for t in batch.column(0).cast(pa.binary()).to_pylist()]
            columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch([*batch.columns[1:], *columns], names=["doc_id", TEXT_HASH, *names])

    added = zip(names, (T.BinaryType(), T.LongType(), T.IntegerType(), T.BinaryType(), T.ArrayType(T.LongType())))
    schema = T.StructType([*chosen.schema.fields[1:], *(T.StructField(n, t) for n, t in added)])
    return chosen.mapInArrow(run, schema)


def _listed(prints: DataFrame) -> DataFrame:
    """(shard, weight, set): the sets that have first shingles in common with another one.

    Shingles of the same sets, such as those of one passage, are one list; ``weight`` says how many they are.
    """
    postings = prints.select(F.explode("__first").alias("shard"), F.col("__set").alias("set"))
    ends = postings.groupBy("shard").agg(F.min("set").alias("lo"), F.max("set").alias("hi"))
    shared = written(ends.where("lo != hi").select("shard"), "shared")
    each = written(postings.join(shared, "shard").distinct(), "postings")
    members = [F.count("*"), F.min("set"), F.max("set")]
    members += [F.sum(F.xxhash64("set", F.lit(i)).cast("decimal(20,0)")) for i in range(2)]
    alike = each.groupBy("shard").agg(*(m.alias(f"m{i}") for i, m in enumerate(members)))
    lists = alike.groupBy(*(f"m{i}" for i in range(len(members)))).agg(
        F.min("shard").alias("shard"), F.count("*").alias("weight")
    )
    return written(each.join(written(lists.select("shard", "weight"), "lists"), "shard").select("shard", "weight", "set"), "listed")


def _briefs(listed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, n, lists): each node's lists, as strings of number and weight, that no array is longer than the set's first part."""
    entry = F.concat_ws(":", "shard", "weight")
    lists = listed.groupBy("set").agg(F.collect_list(entry).alias("lists"))
    return written(nodes.select("fp", "n", "set").join(lists, "set").select("fp", "n", "lists"), "briefs")


def _alike(pairs: DataFrame, briefs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that sizes and common first shingles allow; no similar pair is left out.

    Similar sets of n and m shingles share s (n + m) / (1 + s) of them. Take the set whose first part ends earlier
    in the order: what it shares outside of that part is at most the rest of it, and what it shares inside lies in the
    first part of the other set as well.
    """

    def side(name: str) -> DataFrame:
        return briefs.select(*(F.col(c).alias(name if c == "fp" else f"{name}_{c}") for c in ("fp", "n", "lists")))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    rest = [F.ceil(F.col(f"{x}_n") * similarity - 1e-6) - 1 for x in "ab"]
    needed = (F.col("a_n") + F.col("b_n")) * (similarity / (1 + similarity)) - F.greatest(*rest) - 1e-6
    weight = F.aggregate(
        F.array_intersect("a_lists", "b_lists"), F.lit(0).cast("bigint"),
        lambda total, x: total + F.substring_index(x, ":", -1).cast("bigint"),
    )
    sizes = F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * similarity - 1e-6
    return both.where(sizes).where(weight >= F.greatest(needed, F.lit(1.0))).select("a", "b")


def _list_tasks(listed: DataFrame, nodes: DataFrame, roots: DataFrame, similarity: float, cell: int) -> DataFrame:
    """(task, fp, n, parity): the lists that hold nodes of several groups. Rings are sizes within the similarity."""
    rooted = written(
        nodes.join(roots, nodes["fp"] == roots["a"], "left").select("set", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    ends = listed.join(rooted, "set").groupBy("shard").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    several = written(ends.where("lo != hi").select("shard"), "several")
    ring = F.floor(F.log("n") / (-math.log(similarity) * 1.0001)).cast("int").alias("ring")
    members = listed.join(several, "shard").join(nodes, "set").select("shard", ring, "fp", "n", "parity")
    return written(_cut(written(members, "members"), cell), "tasks")


def _parts(rows: int, per_task: int = 16_384) -> int:
    """Partitions for so many rows of tasks: their work grows with rows, not with bytes."""
    return max(1, math.ceil(rows / per_task))


def _checker(shingle: int, similarity: float):
    """The pairs whose shingle sets are similar; rows are (b, part, a, text), b's own text first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            good_a: list[bytes] = []
            good_b: list[bytes] = []
            a_of, texts = batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist()
            for b, a, text in zip(batch.column(0).to_pylist(), a_of, texts):
                shingles = np.unique(shingle_hashes(text or b"", shingle))
                if a is None:
                    mine = shingles
                    continue
                both = len(np.intersect1d(mine, shingles, assume_unique=True))
                either = len(mine) + len(shingles) - both
                if both >= similarity * either - 1e-9:
                    good_a.append(a)
                    good_b.append(b)
            yield pa.record_batch([pa.array(good_a, pa.binary()), pa.array(good_b, pa.binary())], names=["a", "b"])

    return run


def _wanted_texts(keyed: DataFrame, wanted: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """``__node`` and ``text`` of the wanted documents. Texts of others are not shuffled, or few of them."""
    keyed = keyed.select("doc_id", TEXT_HASH, "text")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col(TEXT_HASH) == F.col("__hash"))
    count = wanted.count()
    if count <= most_sent:
        return keyed.join(F.broadcast(wanted), same)
    # Each wanted key is there twice, so the filter of repeated keys holds all of them.
    keys = wanted.select(F.xxhash64("__doc", "__hash").alias("__row"))
    bloom, pages = repeated_filter(keys.unionByName(keys), "__row", count)
    flagged = flag_repeated(keyed.withColumn("__row", F.xxhash64("doc_id", TEXT_HASH)), "__row", bloom, pages, "__asked")
    return flagged.where("__asked").join(wanted, same)


def check_pairs(
    pairs: DataFrame, nodes: DataFrame, keyed: DataFrame, shingle: int, similarity: float, per_task: int = 256
) -> DataFrame:
    """Of the proposed pairs (a, b) those that are similar, by one text of each node.

    The texts of a's meet b's text in parts of about ``per_task`` pairs, so a much paired b is spread.
    """
    ends = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    wanted = written(
        ends.join(nodes, "fp").select(
            F.col("fp").alias("__node"), F.col("first.doc_id").alias("__doc"), F.col(f"first.{TEXT_HASH}").alias("__hash")
        ),
        "wanted",
    )
    texts = written(_wanted_texts(keyed, wanted).groupBy("__node").agg(F.first("text").alias("text")), "texts")
    parts = written(pairs.groupBy("b").agg(F.ceil(F.count("*") / per_task).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    others = pairs.join(parts, "b").select("b", part, "a").join(texts, F.col("a") == F.col("__node"))
    own = parts.join(texts, F.col("b") == F.col("__node")).select(
        "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("a"), "text"
    )
    rows = own.unionByName(others.select("b", "part", "a", "text")).repartition("b", "part")
    rows = rows.sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
    return rows.mapInArrow(_checker(shingle, similarity), "a binary, b binary")


def near_links(
    prints: DataFrame, nodes: DataFrame, keyed: DataFrame, masks: np.ndarray, width: int, radius: int,
    shingle: int, similarity: float, cell: int = CELL, first: int = 2,
) -> DataFrame:
    """(a, root): every linked node with its group's smallest, by checked links. No similar pair is left out.

    ``nodes`` has ``fp``, ``first`` (the document whose text stands for the node), ``set``, ``n`` and ``parity``,
    ``prints`` the first shingles of the documents, ``keyed`` their texts.
    """
    listed = _listed(prints)
    briefs = _briefs(listed, nodes)
    tasks = _tasks(nodes, masks, width, radius, cell).select("task", "fp", F.col("fp").alias("root"))
    proposed = _proposed(tasks, _nearest(width, radius, first), _parts(nodes.count() * len(masks)))
    pairs = written(_alike(proposed.select("a", "b").distinct(), briefs, similarity), "pairs")
    good = check_pairs(pairs, nodes, keyed, shingle, similarity)
    roots = written(components(good).select("a", F.col("b").alias("root")), "roots")
    tasks, low, high = _list_tasks(listed, nodes, roots, similarity, cell), 0, first
    while not tasks.isEmpty():
        placed = tasks.join(roots, tasks["fp"] == roots["a"], "left").select(
            "task", "fp", F.coalesce("root", "fp").alias("root"), "n", "parity"
        )
        proposed = _proposed(placed, _possible(width, similarity, low, high), _parts(tasks.count()))
        pairs = proposed.where("a IS NOT NULL").select("a", "b").distinct()
        pairs = written(_alike(pairs, briefs, similarity), "pairs")
        good = None if pairs.isEmpty() else written(check_pairs(pairs, nodes, keyed, shingle, similarity), "near")
        if good is not None and not good.isEmpty():
            links = good.unionByName(roots.select("a", F.col("root").alias("b")))
            roots = written(components(links).select("a", F.col("b").alias("root")), "roots")
        more = proposed.where("more IS NOT NULL").select(F.col("more").alias("task"))
        tasks = written(tasks.join(more, "task", "left_semi"), "tasks")
        low, high = high, 8 * high
    return roots


def drop_near_copies(
    docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, width: int = 4, recall: float = 0.99
) -> DataFrame:
    """The documents without near copies, in all their columns: of each group the smallest ``doc_id`` stays.

    Two documents are linked when they share ``similarity`` of their distinct shingles (Jaccard), checked exactly;
    all of these are found. ``width`` and ``recall`` decide only how many the trees of fingerprints of 64 x ``width``
    bits find before the lists of rare shingles.
    """
    mean, bits = similarity_radius(similarity, width), 64 * width
    slack = NormalDist().inv_cdf(recall) * math.sqrt(mean * (1 - mean / bits))
    radius = mean + math.ceil(slack)
    keyed = docs.withColumn(TEXT_HASH, F.xxhash64("text"))
    common = common_shingles(keyed, shingle)
    prints = written(with_shingles(keyed, shingle, width, similarity, common), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", TEXT_HASH)
    described = [F.min(f"__{c}").alias(c) for c in ("set", "n", "parity")]
    nodes = written(prints.groupBy(F.col(FP).alias("fp")).agg(F.min(order).alias("first"), *described), "nodes")
    masks = sampled_forest(width, mean, nodes.count(), recall)
    roots = near_links(prints, nodes, keyed, masks, width, radius, shingle, similarity)
    prints = prints.select("doc_id", TEXT_HASH, FP)
    placed = nodes.join(roots, nodes["fp"] == roots["a"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = written(placed.groupBy("root").agg(F.min("first").alias("best")), "best")
    groups = written(placed.join(best, "root").select("fp", "best"), "components")
    judged = prints.join(groups, prints[FP] == groups["fp"])
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col(TEXT_HASH) == F.col(f"best.{TEXT_HASH}"))
    dropped = written(judged.where(~stays).select("doc_id", TEXT_HASH).distinct(), "dropped")
    repeated = written(
        judged.where(stays).groupBy("doc_id", TEXT_HASH).count().where("count > 1").drop("count"), "repeated"
    )
    kept = keyed.join(dropped, _same_row(keyed, dropped), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, _same_row(kept, repeated), "left_semi").dropDuplicates(["doc_id", TEXT_HASH])
        kept = kept.join(repeated, _same_row(kept, repeated), "left_anti").unionByName(once)
    return kept.drop(TEXT_HASH)


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left[TEXT_HASH] == right[TEXT_HASH])
