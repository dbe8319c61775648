"""SimHash near-duplicate classes.

Fingerprints: 64 bits, majority vote over XXH64 (seed 42) of word shingles. Search: every fingerprint is
embedded by the bit counts of its 32 two-bit segments; the Manhattan distance of two embeddings never exceeds
the Hamming distance of the fingerprints. The range join lays a grid over the embedding: the 32 axes form
g groups, so two points within Manhattan distance r agree in at least g - r whole groups and meet in a cell named
by some choice of g - r groups; the more fingerprints there are, the more groups make a cell, so that chance meetings stay few. Within a
cell, Manhattan distance filters and Hamming distance decides. A cell emits a spanning forest of its links, never all pairs, so dense groups cost
rows in proportion to their members and no class is split. Cells above ``cell_limit`` members are dealt again by groups of bits instead of counts, first half
of all bits, then three quarters: what is left in a cell then are fingerprints that differ in 16 bits only, 65,536 at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, attach, byte_column, word_blocks
from tidemark.llm.dealing import in_blocks, links_in_large_groups
from tidemark.llm.graph import components
from tidemark.storage import materialize

SEED = 42
CELL_LIMIT = 20_000
LOW = np.uint64(0x5555555555555555)


def bit_totals(rows: np.ndarray) -> np.ndarray:
    """How many rows (of bytes) have each bit; summed as bytes, 255 rows at a time."""
    total = np.zeros(8 * rows.shape[1], np.int64)
    for at in range(0, len(rows), 255 * 16):
        bits = np.unpackbits(np.ascontiguousarray(rows[at : at + 255 * 16]).ravel()).reshape(-1, len(total))
        for k in range(0, len(bits), 255):
            total += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return total


def simhash(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint of a text's word shingles, repeats included; no words (or null): 0; fewer than ``width`` words: one shingle of all."""
    digest, ones, total = xxhash.xxh64_digest, np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    short = True
    for block in word_blocks((text or b"").translate(LOWER)):
        words = tail + block
        if len(words) < width:
            tail = words
            continue
        short = False
        for at in range(0, len(words) - width + 1, 1 << 16):
            part = words[at : at + (1 << 16) + width - 1]
            h = np.frombuffer(b"".join([digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(width)), strict=False)]), np.uint8).reshape(-1, 8)
            ones += bit_totals(h)
            total += len(h)
        tail = words[len(words) - width + 1 :] if width > 1 else []
    if short:
        if not tail:
            return 0
        return int.from_bytes(digest(b" ".join(tail), SEED), "big", signed=True)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fp long) for every row; no row is dropped, null keys and texts included."""
    kind = docs.schema[key].dataType
    named = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    at = named.schema["k"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [simhash(t, width) for t in byte_column(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["k", "fp"])

    return named.mapInArrow(run, f"k {at.simpleString()}, fp long").select(F.col("k").cast(kind).alias(key), "fp")


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts (0, 1, 2) of two-bit segments in unary, so that Manhattan distance is the bit count of an exclusive or."""
    both, either = fp & (fp >> np.uint64(1)) & LOW, (fp | (fp >> np.uint64(1))) & LOW
    return either | (both << np.uint64(1))


def cell_masks(radius: int, groups: int | None = None, axes: int = 32) -> list[np.uint64]:
    """One mask for each choice of all but ``radius`` of the groups (2 ``radius`` if not given) of the axes: 32 segments or 64 bits."""
    groups, width = groups or 2 * radius, 64 // axes
    bits = [sum(((1 << width) - 1) << (width * s) for s in range(axes) if s % groups == g) for g in range(groups)]
    return [np.uint64(sum(bits[g] for g in chosen)) for chosen in combinations(range(groups), groups - radius)]


def groups_for(n: int, radius: int) -> int:
    """How many groups make the cells for ``n`` fingerprints cheapest: a fingerprint has comb(groups, radius) cells and compares itself to what meets it there by chance, a segment's counts being equal in 3 of 8 cases."""
    return min((2 * radius, 3 * radius, 4 * radius), key=lambda g: comb(g, radius) * (1 + 0.01 * n * (3 / 8) ** (32 * (g - radius) / g)))


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def forest(prints: np.ndarray, nodes: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among rows of ``prints`` (members, words), found breadth first: each search looks only at what is not reached yet."""
    out, todo, unary = [], np.arange(len(nodes)), embed(prints)
    while len(todo) > 1:
        queue, todo = [todo[0]], todo[1:]
        while queue and len(todo):
            at = queue.pop()
            near = _distance(unary[todo], unary[at]) <= radius
            near[near] = _distance(prints[todo[near]], prints[at]) <= radius
            if near.any():
                found = todo[near]
                out.append((np.full(len(found), nodes[at]), nodes[found]))
                queue.extend(found)
                todo = todo[~near]
    return out


def _within(prints: np.ndarray, nodes: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the members of a cell as all of its links do; a few times as many as members at most."""
    m = len(nodes)
    if m > 256:
        return forest(prints, nodes, radius)
    i, j = _PAIRS[m] if m in _PAIRS else _PAIRS.setdefault(m, np.triu_indices(m, 1))
    unary = embed(prints)
    near = np.flatnonzero(_distance(unary[i], unary[j]) <= radius)
    near = near[_distance(prints[i[near]], prints[j[near]]) <= radius]
    return forest(prints, nodes, radius) if len(near) > 4 * m else [(nodes[i[near]], nodes[j[near]])]


_PAIRS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _hash(x: np.ndarray, salt: int) -> np.ndarray:
    cell = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
    return (cell ^ (cell >> np.uint64(32))).view(np.int64)


def _grid(masks: list[np.uint64]):
    """Cells of 64-bit fingerprints by the counts of the chosen groups of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 4096):
                part = fp[at : at + 4096]
                x = embed(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_hash(x & m, k) for k, m in enumerate(masks)])), pa.array(np.tile(part, len(masks)).view(np.int64))], ["cell", "node"])

    return run


def _refined(masks: list[np.uint64]):
    """Cells of 64-bit fingerprints within a cell, by the chosen groups of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, fp = (batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (0, 1))
            for at in range(0, len(fp), 4096):
                c, part = cell[at : at + 4096], fp[at : at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_hash(_hash(part & m, k + 1).view(np.uint64) ^ c, 0) for k, m in enumerate(masks)])), pa.array(np.tile(part, len(masks)).view(np.int64))], ["cell", "node"])

    return run


def _matrix(column: pa.Array, words: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint64).reshape(-1, words)


def _links(radius: int, limit: int, words: int):
    """Over rows (cell, node, print if words > 1) sorted by cell: links (a, b); members of a cell above ``limit`` come back as (cell, a = node, print)."""

    def rows(cell: np.ndarray | None, a: np.ndarray, b: np.ndarray | None, prints: np.ndarray | None) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if cell is None else pa.array(cell), pa.array(a), pa.nulls(n, pa.int64()) if b is None else pa.array(b), pa.nulls(n, pa.binary()) if prints is None else pa.array([x.tobytes() for x in prints], pa.binary())], ["cell", "a", "b", "print"])

    def parts(cell: np.ndarray, node: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[starts, len(cell)])
        keep = np.repeat(size <= limit, size)
        if not keep.all():
            yield rows(cell[~keep], node[~keep], None, prints[~keep])
        two = starts[size == 2]
        near = _distance(embed(prints[two]), embed(prints[two + 1])) <= radius
        near[near] = _distance(prints[two[near]], prints[two[near] + 1]) <= radius
        found = [(node[two[near]], node[two[near] + 1])]
        many = (size > 2) & (size <= limit)
        for s, n in zip(starts[many].tolist(), size[many].tolist(), strict=True):
            found += _within(prints[s : s + n], node[s : s + n], radius)
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(a):
            yield rows(None, a, b, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, node, prints, over = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, words), np.uint64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            c, d = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            p = d.view(np.uint64)[:, None] if words == 1 else _matrix(batch.column(2), words)
            cell, node, prints = np.concatenate([cell, c]), np.concatenate([node, d]), np.concatenate([prints, p])
            if over is not None:
                n = int(np.searchsorted(cell != over, True))
                if n:
                    yield rows(cell[:n], node[:n], None, prints[:n])
                cell, node, prints = cell[n:], node[n:], prints[n:]
                if not len(cell):
                    continue
                over = None
            last = int(np.searchsorted(cell, cell[-1]))
            if last:
                yield from parts(cell[:last], node[:last], prints[:last])
                cell, node, prints = cell[last:], node[last:], prints[last:]
            if len(cell) > limit:
                over = cell[-1]
                yield rows(cell, node, None, prints)
                cell, node, prints = cell[:0], node[:0], prints[:0]
        if len(cell):
            yield from parts(cell, node, prints)

    return run


_LINKS = "cell long, a long, b long, print binary"


def _joined(cells: DataFrame, radius: int, limit: int, words: int) -> DataFrame:
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(n, "cell").sortWithinPartitions("cell").mapInArrow(_links(radius, limit, words), _LINKS)


def links(distinct: DataFrame, radius: int = 3, cell_limit: int = CELL_LIMIT, groups: int | None = None) -> DataFrame:
    """(a, b) links whose connected classes are those of all pairs within ``radius`` bits. distinct: one column ``fp`` of different longs. groups: chosen by their number if not given."""
    masks = cell_masks(radius, groups or groups_for(distinct.count(), radius))
    cells, out = distinct.select("fp").mapInArrow(_grid(masks), "cell long, node long"), None
    for finer in (2 * radius, 4 * radius, None):
        found = materialize(_joined(cells, radius, cell_limit if finer else 2**62, 1), "links")
        near, dense = found.where("b is not null").select("a", "b"), found.where("b is null").select("cell", F.col("a").alias("node"))
        out = near if out is None else out.union(near)
        if not finer or dense.isEmpty():
            return out
        cells = dense.mapInArrow(_refined(cell_masks(radius, finer, 64)), "cell long, node long")
    raise AssertionError("unreachable")


def _named(stars: DataFrame, least: DataFrame) -> DataFrame:
    """(node, class_least): the smallest key of each node's class. stars: (node, root); least: (node, least). A class may hold a third of all nodes."""
    classes = materialize(stars.join(least, "node"), "classes")
    roots = materialize(classes.groupBy("root").agg(F.min("least").alias("class_least"), F.count("*").alias("n")), "roots")
    return attach(classes, roots, "root").select("node", "class_least")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """One row per input row: (key, fp long, component_id).

    component_id is the smallest key reachable over links of at most ``radius`` differing bits, itself included.
    Null or wordless text: fingerprint 0, linked like any other. Rows with a null key count as members, but a null
    never names a class unless all of its keys are null. Repeated rows come back repeated. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    marked = materialize(fingerprints(docs, key, text, width).withColumnRenamed(key, "k"), "simhash")
    return print_classes(marked, radius, cell_limit).withColumnRenamed("k", key)


def print_classes(marked: DataFrame, radius: int = 3, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(k, fp, component_id) of marked rows (k, fp): the smallest k whose fingerprint is reachable over links of at most ``radius`` bits."""
    least = materialize(marked.groupBy("fp").agg(F.min("k").alias("least"), F.count("*").alias("n")), "prints")
    stars = components(links(least.select("fp"), radius, cell_limit))
    named = _named(stars, least.select(F.col("fp").alias("node"), "least"))
    per_fp = least.join(named.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("class_least", "least").alias("component_id"), "n")
    return attach(marked, materialize(per_fp, "components"), "fp").select("k", "fp", "component_id")


#: Shingle width in words, and the least Jaccard similarity of two shingle sets that is a link: NUM / DEN.
WIDTH, NUM, DEN = 5, 4, 5
#: Minhashes of a shingle set; BANDS cells of BAND minhashes each; a sketch of WIDE 64-bit words has four bits of each minhash.
MINHASHES, BANDS, BAND, WIDE = 128, 16, 3, 8
#: At the least similarity, four bits of a minhash differ in 0.4 bits (variance 0.84); six deviations more.
WIDE_RADIUS = int(MINHASHES * 0.4 + 6 * np.sqrt(MINHASHES * 0.84))
#: Bytes of shingle sets that one part of a group holds.
SET_BYTES = 16 << 20
_SALTS = np.random.default_rng(8).integers(1, 2**63, MINHASHES + WIDTH + BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted hashes of a text's different shingles of WIDTH words; fewer words: one shingle of all; no words: none."""
    one, tail, seen, parts = xxhash.xxh64_intdigest, np.zeros(0, np.uint64), 0, []

    def shingles(words: np.ndarray, w: int) -> np.ndarray:
        out = np.zeros(len(words) - w + 1, np.uint64)
        for k in range(w):
            out = out * np.uint64(0x100000001B3) + words[k : k + len(out)] * _SALTS[MINHASHES + k]
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    for block in word_blocks((text or b"").translate(LOWER), 1 << 19):
        words = np.concatenate([tail, np.fromiter((one(w, SEED) for w in block), np.uint64, len(block))])
        if len(words) >= WIDTH:
            parts.append(np.unique(shingles(words, WIDTH)))
        seen += len(block)
        tail = words[-(WIDTH - 1) :]
    if seen and not parts:
        parts.append(shingles(tail, len(tail)))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _sketch(found: np.ndarray) -> tuple[bytes, bytes]:
    if not len(found):
        return bytes(8 * WIDE), bytes(4 * BANDS)
    least = np.full(MINHASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(found), 1 << 12):
        np.minimum(least, (_SALTS[:MINHASHES, None] * found[at : at + (1 << 12)]).min(axis=1), out=least)
    four = ((least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(60)).astype(np.uint8)
    bands = (least[: BANDS * BAND].reshape(BANDS, BAND) * _SALTS[MINHASHES + WIDTH :]).sum(axis=1, dtype=np.uint64)
    return (four[::2] << np.uint8(4) | four[1::2]).tobytes(), (bands >> np.uint64(32)).astype(np.uint32).tobytes()


def wide_prints(text: bytes | None) -> tuple[bytes, bytes]:
    """The compared sketch and the searched bands of a text's shingle set. No words: zeros."""
    return _sketch(shingle_set(text))


def _name(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def _wide_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            bands = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(-1, BANDS).astype(np.uint64)
            cells = [_hash(bands[:, k], k + 1) for k in range(BANDS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.concat_arrays([part.column(0)] * BANDS), pa.concat_arrays([part.column(1)] * BANDS)], ["cell", "node", "print"])


def _wide_forest(radius: int):
    """Links among sketches given as bytes, whose classes are those of all pairs within ``radius`` bits."""

    def run(sketches: list[bytes]) -> list[tuple[int, int]]:
        prints = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
        return [(int(i), int(j)) for x, y in _within(prints, np.arange(len(sketches)), radius) for i, j in zip(x, y, strict=True)]

    return run


def wide_links(cells: DataFrame, radius: int, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b) whose connected classes are those of all pairs of sketches within ``radius`` bits in a cell. cells: (cell, node, print). Cells above ``cell_limit`` are dealt in blocks (see ``dealing``)."""
    found = materialize(_joined(cells, radius, cell_limit, WIDE), "links")
    out = found.where("b is not null").select("a", "b")
    dense = found.where("b is null").select("cell", F.col("a").alias("node"), F.col("print").alias("payload"))
    return out if dense.isEmpty() else out.union(links_in_large_groups(dense, _wide_forest(radius), cell_limit * (8 * WIDE + 16)))


def exact_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of the pairs whose sets have a Jaccard similarity of NUM / DEN at least, by counting: no estimate.

    Candidates by prefix: with the rarest shingles first, two such sets have one in common among the first of each (all but NUM / DEN of them, and one more), and at the first one that they
    have in common enough must still follow in both. What is left out so cannot be that similar; so sets that share a template, but not enough, cost no more than their own size. What is linked is taken off
    the lists of shingles, so near copies are not compared again.
    """
    size = np.array([len(x) for x in sets], np.int64)
    found, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(found), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(found))
    owner, code = np.repeat(np.arange(len(sets)), size), rank[code]
    code = code[np.lexsort((code, owner))]
    upto = np.r_[0, np.cumsum(size)]
    place = np.arange(len(code)) - upto[owner]
    first = size - -(-size * NUM // DEN) + 1
    often = np.sort(often, kind="stable")
    listed = np.flatnonzero((place < first[owner]) & (often[code] > 1))
    listed = listed[np.argsort(code[listed], kind="stable")]
    starts = np.flatnonzero(np.r_[True, code[listed][1:] != code[listed][:-1]]) if len(listed) else np.zeros(0, np.int64)
    lists = {c: (owner[x], place[x]) for c, x in zip(code[listed[starts]].tolist(), np.split(listed, starts[1:]), strict=True)} if len(listed) else {}
    marked, todo, met = np.zeros(len(found), bool), np.ones(len(sets), bool), np.full(len(sets), -1)
    out = []

    def candidates(at: int) -> np.ndarray:
        some = [np.zeros(0, np.int64)]
        for i, c in enumerate(code[upto[at] : upto[at] + first[at]].tolist()):
            held = lists.get(c)
            if held is None:
                continue
            own, where = held
            left = todo[own]
            if not left.all():
                own, where = own[left], where[left]
                if not len(own):
                    del lists[c]
                    continue
                lists[c] = own, where
            new = met[own] != at
            own, where = own[new], where[new]
            met[own] = at
            most = np.minimum(size[at] - i, size[own] - where)
            some.append(own[most * (NUM + DEN) >= NUM * (size[at] + size[own])])
        return np.concatenate(some)

    for seed in range(len(sets)):
        queue = [seed] if todo[seed] else []
        todo[seed] = False
        while queue:
            at = queue.pop()
            fits = candidates(at)
            if not len(fits):
                continue
            mine = code[upto[at] : upto[at + 1]]
            marked[mine] = True
            both = np.array([np.count_nonzero(marked[code[upto[i] : upto[i + 1]]]) for i in fits.tolist()], np.int64)
            marked[mine] = False
            # both / (a + b - both) >= NUM / DEN
            linked = fits[both * (NUM + DEN) >= NUM * (size[fits] + size[at])].tolist()
            out += [(at, i) for i in linked]
            queue += linked
            todo[linked] = False
    return out


def _exact(sets: list[bytes]) -> list[tuple[int, int]]:
    return exact_forest([np.frombuffer(x, np.uint64) for x in sets])


def confirm(groups: DataFrame, texts: DataFrame, set_bytes: int = SET_BYTES) -> DataFrame:
    """(a, b) links whose connected classes are those of all pairs within a group that are NUM / DEN alike, exactly.

    groups: (node, root, least, size), a node being the name of a shingle set, ``least`` the key of a text that has it. texts: (k, t). Groups
    of more than ``set_bytes`` are dealt in blocks (see ``dealing``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in byte_column(batch.column(2))]
            # a key that is repeated may have other texts
            mine = [x.tobytes() if _name(x) == y else None for x, y in zip(sets, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mine, pa.binary())], ["cell", "node", "payload"])

    def sets(some: DataFrame) -> DataFrame:
        rows = texts.join(some.select("node", "root", "least"), F.col("k") == F.col("least")).select("root", "node", "t")
        return rows.mapInArrow(run, "cell long, node long, payload binary").where("payload is not null")

    # broadcast by Spark if it is small, else joined by key, hot keys split by AQE
    large = materialize(groups.groupBy(F.col("root").alias("large")).agg(F.sum((F.col("size") * 8 + 16).cast("long")).alias("bytes")).where(F.col("bytes") > set_bytes).select("large"), "large")
    marked = groups.join(large, F.col("root") == F.col("large"), "left")
    out = in_blocks(sets(marked.where("large is null")).withColumn("block", F.col("cell")), _exact).select("a", "b")
    return out if large.isEmpty() else out.union(links_in_large_groups(sets(marked.where("large is not null")), _exact, set_bytes))


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = WIDE_RADIUS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(key, component_id) per row with a key: classes of documents linked by a Jaccard similarity of 0.8 or more of their sets of five-word shingles.

    Search: 128 minhashes of the set; a document has 16 cells of three each, so a pair at 0.8 meets in none with probability 1e-5, wherever its
    edits are, and one above more rarely. Within cells, sketches as near as ``radius`` bits (six deviations above the mean at 0.8) make groups;
    within a group the sets themselves decide, all pairs that a class may need. Equal sets always meet. key: an integer. Rows without a key are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, prints, fps = [], [], [], []
            for t in byte_column(batch.column(1)):
                found = shingle_set(t)
                fps.append(simhash(t))
                names.append(_name(found))
                sizes.append(len(found))
                prints.append(_sketch(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int32()), pa.array([p for p, _ in prints], pa.binary()), pa.array([s for _, s in prints], pa.binary()), pa.array(fps, pa.int64())], ["k", "node", "size", "print", "search", "fp"])

    named = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    marked = materialize(named.mapInArrow(run, "k long, node long, size int, print binary, search binary, fp long"), "wide")
    nodes = materialize(marked.groupBy("node", "size", "print", "search").agg(F.min("k").alias("least"), F.count("*").alias("n")), "sets")
    wide = wide_links(nodes.select("node", "print", "search").mapInArrow(_wide_cells, "cell long, node long, print binary"), radius, cell_limit)
    # texts of one set may have several fingerprints, as these count repeats
    prints = materialize(marked.select("node", "fp").distinct(), "simhash")
    shared = materialize(prints.groupBy("fp").agg(F.count("*").alias("n")), "prints")
    hashed = links(shared.select("fp"), cell_limit=cell_limit)
    # fingerprints are nodes of the same graph, once: one that is also the name of a set only joins two groups, and the sets decide within
    met = hashed.select(F.explode(F.array("a", "b")).alias("fp")).union(shared.where("n > 1").select("fp")).distinct()
    near = materialize(components(wide.union(hashed).union(prints.join(met, "fp", "left_semi").select("node", "fp"))), "near")
    groups = near.join(nodes.select("node", "least", "size"), "node")
    stars = components(materialize(confirm(groups, named), "confirmed"))
    classes = _named(stars, nodes.select("node", "least"))
    per_node = nodes.join(classes, "node", "left").select("node", F.coalesce("class_least", "least").alias("component_id"), "n")
    return attach(marked.select("k", "node"), materialize(per_node, "components"), "node").select(F.col("k").cast(docs.schema[key].dataType).alias(key), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows, columns untouched, with one row of each class of ``similar_classes``: that of the smallest key.

    Of rows that repeat a key one stays. Rows with a null key can't be named and stay.
    """
    found = materialize(similar_classes(docs, key, text).select(F.col(key).alias("__k"), "component_id"), "members")
    gone = found.where("component_id <> __k").select("__k").distinct()
    kept = docs.join(gone, F.col(key) == F.col("__k"), "left_anti")
    again = found.where("component_id = __k").groupBy("__k").count().where("count > 1").select("__k")
    if again.isEmpty():
        return kept
    one = kept.join(again, F.col(key) == F.col("__k"), "left_semi").dropDuplicates([key])
    return kept.join(again, F.col(key) == F.col("__k"), "left_anti").unionByName(one)
