"""Near-duplicate documents by DartMinHash.

A document is the weighted set of its runs of five words (a shorter one: the run of all its words), the weight being how
often a run occurs. Hash-driven darts fall on the plane of weight and rank, for each element a Poisson number per region
of unit area; the darts below an element's weight hit one of ``K`` coordinates each, and the earliest dart of each
coordinate is the signature. Two documents agree in a coordinate with the probability of their weighted Jaccard
similarity, sum(min) / sum(max).

Signatures are joined in bands. In every bucket all members are compared exactly with the member that shares most
buckets with others; the components of the links so found need no further comparison inside. What then still differs in
component within a bucket is compared block by block inside tasks: signatures first, then the texts of the pairs whose
signatures agree; only links become rows. No bucket is cut and no pair of different texts dropped; copies (equal word sequences) are one node throughout.

Texts without words are in a class of their own each. Null ids and repeated rows are allowed; every row is a document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import components, folders, texts

BANDS, ROWS = 30, 5
K = BANDS * ROWS
THRESHOLD = 0.8
#: Pairs whose signatures agree in a smaller share are not compared by text. Of the pairs at 0.8 that leaves out one in
#: 4 x 10^11, far fewer than share no band (one in 149,000).
AGREE = 0.55
_BLOCK = 512  # nodes of a bucket that are compared with as many others at a time
_BLOCK_BYTES = 8 << 20  # and bytes of their texts, but for one longer text
#: The hash below which a region has at most d darts, for the Poisson distribution of mean 1.
_AT_MOST = [np.uint64(min(int(sum(math.exp(-1) / math.factorial(i) for i in range(d + 1)) * 2.0**64), (1 << 64) - 1)) for d in range(16)]


def weighted_shingles(t: texts.Texts, w: texts.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and weight of the distinct shingles of each text."""
    hashes, of = texts.shingles(w, 5)
    order = np.argsort((of.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))) if len(t) < 1 << 20 else np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], hashes[at], np.diff(np.append(at, len(of)))


def unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def throw(of: np.ndarray, element: np.ndarray, weight: np.ndarray, theta: np.ndarray, k: int):
    """All darts below each element's weight with rank below its text's theta: text, coordinate, rank, dart."""
    found = []
    for level in range(int(weight.max()).bit_length() + 1 if len(weight) else 0):
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        height = 1 / (high - low)  # regions have unit area
        own = np.flatnonzero(weight > low)
        if not len(own):
            continue
        strips = np.ceil(theta[of[own]] / height).astype(np.int64)
        at = np.repeat(own, strips)
        strip = np.arange(len(at)) - np.repeat(np.cumsum(strips) - strips, strips)
        marks = texts.mix((np.arange(int(strips.max())) + (level << 40)).astype(np.uint64))
        region = texts.mix(element[at] ^ marks[strip])
        some = np.arange(len(at))
        for d in range(len(_AT_MOST)):
            some = some[region[some] >= _AT_MOST[d]]
            if not len(some):
                break
            dart = texts.mix(region[some] + np.uint64(0x9E3779B97F4A7C15 * (d + 1) % (1 << 64)))
            rank = (strip[some] + unit(texts.mix(dart ^ np.uint64(0xA5A5A5A5A5A5A5A5)))) * height
            owner = at[some]
            hit = np.flatnonzero(rank < theta[of[owner]])
            dart, rank, owner = dart[hit], rank[hit], owner[hit]
            if level:
                place = low + (high - low) * unit(texts.mix(dart ^ np.uint64(0x3C3C3C3C3C3C3C3C)))
                under = place < weight[owner]
                dart, rank, owner = dart[under], rank[under], owner[under]
            found.append((of[owner], (dart % np.uint64(k)).astype(np.int64), rank, dart))
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)]


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """(n, k) darts; texts without elements get zeros. Ranks beyond a first bound are searched only where a coordinate is still empty."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(of, weights=weight, minlength=n)
    left = np.flatnonzero(total > 0)
    expected = k * math.log(k) + 2 * k
    while len(left):
        slot = np.full(n, -1)
        slot[left] = np.arange(len(left))
        some = slot[of] >= 0
        theta = expected / total[left]
        text, coordinate, rank, dart = throw(slot[of[some]], element[some], weight[some], theta, k)
        cell = text * k + coordinate
        order = np.lexsort((rank, cell)) if len(left) * k >= 1 << 25 else np.argsort((cell.astype(np.uint64) << np.uint64(38)) | np.minimum(rank * ((1 << 38) / theta.max()), (1 << 38) - 1).astype(np.uint64))
        cell = cell[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        full = np.zeros(len(left) * k, bool)
        full[cell[first]] = True
        sign = np.zeros(len(left) * k, np.uint64)
        sign[cell[first]] = dart[order[first]]
        full = full.reshape(-1, k).all(axis=1)
        out[left[full]] = sign.reshape(-1, k)[full]
        left = left[~full]
        expected *= 2
    return out


def band_keys(sign: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = sign.reshape(len(sign), bands, -1)
    key = np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    key = np.repeat(key, len(sign), axis=0)
    for j in range(parts.shape[2]):
        key = texts.mix(key ^ parts[:, :, j]) + np.uint64(j)
    return key


def nodes_of(w: texts.Words) -> np.ndarray:
    """16 bytes for the word sequence of each text; texts without words have zeros."""
    start, end = w.bounds[:-1], w.bounds[1:]
    both = np.stack([texts.sequence_hashes(w.hash, start, end), texts.sequence_hashes(texts.mix(w.hash + np.uint64(1)), start, end)], axis=1)
    both[start == end] = 0
    return both


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, h, text) to (id, h, node, bands, sign); null node without words."""
    for batch in batches:
        for t in texts.slices(batch.column(2), rows=512):
            w = texts.words(t)
            sign = signatures(*weighted_shingles(t, w), len(t))
            none = np.diff(w.bounds) == 0
            rows = batch.slice(t.first, len(t))
            ids = nodes_of(w).astype("<u8").tobytes()
            node = pa.array([None if none[i] else ids[16 * i : 16 * i + 16] for i in range(len(t))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(1),
                    node,
                    pa.array(list(texts.longs(band_keys(sign))), pa.list_(pa.int64())),
                    pa.array([r.tobytes() for r in (sign & np.uint64(0xFFFFFFFF)).astype("<u4")], pa.binary()),
                ],
                names=["id", "h", "node", "bands", "sign"],
            )


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each row."""
    n = len(left)
    out = np.zeros(n)
    size = pc.add(pc.binary_length(left), pc.binary_length(right)).to_numpy(zero_copy_only=False)
    first = 0
    while first < n:
        last = first + max(1, int(np.searchsorted(np.cumsum(size[first:]), texts.SLICE_BYTES, "right")))
        m = last - first if last <= n else n - first
        data, bounds = texts.encoded(pa.concat_arrays([left.slice(first, m), right.slice(first, m)]))
        t = texts.Texts(0, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        of, hashes, weight = weighted_shingles(t, texts.words(t))
        pair, side = of % m, of // m
        order = np.lexsort((side, hashes, pair))
        pair, hashes, weight = pair[order], hashes[order], weight[order]
        both = np.zeros(len(pair), bool)
        both[1:] = (pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])
        at = np.flatnonzero(both)
        common = np.bincount(pair[at], weights=np.minimum(weight[at], weight[at - 1]), minlength=m)
        total = np.bincount(pair, weights=weight, minlength=m)
        out[first : first + m] = common / np.maximum(1, total - common)
        first += m
    return out


def links_of(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are at least as similar as the threshold."""
    with_a = pairs.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(bodies.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = pa.array(similarities(batch.column(2), batch.column(3)) >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(linked), batch.column(1).filter(linked)], names=["a", "b"])

    return with_b.mapInArrow(run, "a binary, b binary")


def element_sets(column: pa.Array) -> list[np.ndarray]:
    """Per text its shingles as sorted hashes, the n-th occurrence of one as an element of its own: common ones are sum(min)."""
    out = []
    for t in texts.slices(column):
        of, hashes, weight = weighted_shingles(t, texts.words(t))
        nth = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
        flat = texts.mix(np.repeat(hashes, weight) + nth.astype(np.uint64))
        bounds = np.searchsorted(np.repeat(of, weight), np.arange(len(t) + 1))
        out += [np.sort(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def compare_blocks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (band, left, right): two blocks of a bucket; the links (a, b) that join components, found by exact comparison.

    A pair is compared in the first band that it shares, closest signatures first, and not once its components are joined.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            band = batch.column(0)[i].as_py()
            sides = []
            for c in batch.columns[1:]:
                block = c.slice(i, 1).flatten()
                sign = np.frombuffer(b"".join(block.field("sign").to_pylist()), "<u4").reshape(len(block), -1)
                bands = block.field("bands").flatten().to_numpy(zero_copy_only=False).reshape(len(block), -1)[:, :band]
                sides.append((block.field("node").to_pylist(), block.field("comp").to_pylist(), sign, bands, element_sets(block.field("text"))))
            (nodes, comps, sign, bands, sets), (nodes2, comps2, sign2, bands2, sets2) = sides
            parent: dict[bytes, bytes] = {}

            def root(x: bytes, parent=parent) -> bytes:
                while x in parent:
                    x = parent[x]
                return x

            size2 = np.fromiter(map(len, sets2), np.int64, len(sets2))
            a, b = [], []
            for j, node in enumerate(nodes):
                share = (sign2 == sign[j]).mean(axis=1)
                fits = (share >= AGREE) & (np.minimum(size2, len(sets[j])) >= (threshold - 1e-9) * np.maximum(size2, len(sets[j])))
                if band:
                    fits &= ~(bands2 == bands[j]).any(axis=1)
                at = np.flatnonzero(fits)
                for m in at[np.argsort(-share[at], kind="stable")].tolist():
                    left, right = root(comps[j]), root(comps2[m])
                    if left == right:
                        continue
                    both = len(sets[j]) + len(sets2[m])
                    common = both - len(np.union1d(sets[j], sets2[m]))
                    if common >= (threshold - 1e-12) * (both - common):
                        parent[max(left, right)] = min(left, right)
                        a.append(min(node, nodes2[m]))
                        b.append(max(node, nodes2[m]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(11))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, h (a hash of its text), class_id and kept.

    ``class_id`` is the smallest id of the class, kept is true for the rows of that id (and, among those, text hash).
    """
    if threshold < THRESHOLD:
        raise ValueError(f"the bands are laid out for similarities of {THRESHOLD} and more")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text)).alias("h"), F.col(text).alias("text"))
    sketched = folders.save(rows.mapInArrow(sketch, f"id {id_type}, h long, node binary, bands array<long>, sign binary"), "sketches")
    key = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    nodes = sketched.filter("node is not null").groupBy("node").agg(F.min(key).alias("first"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
    nodes = folders.save(nodes, "nodes")

    # a band's number is part of its key's row: a pair is compared in the first band that it shares
    entries = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = folders.save(entries.join(sizes, "key"), "buckets")
    popular = shared.groupBy("node").agg(F.sum("n").alias("met"))
    centres = shared.join(popular, "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("centre"))
    stars = shared.join(centres, "key").filter("node <> centre")
    stars = folders.save(stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "pairs")

    # texts of the nodes that met another one
    met = popular.select("node").join(nodes.select("node", "first"), "node").select("node", F.col("first.id").alias("id1"), F.col("first.h").alias("h1"))
    same = F.col("h").eqNullSafe(F.col("h1")) & F.col("id").eqNullSafe(F.col("id1"))
    bodies = folders.save(rows.join(met, same).groupBy("node").agg(F.min("text").alias("text")), "bodies")
    links = folders.save(links_of(stars, bodies, threshold), "links")
    roots = components.components(links)

    # buckets that still hold several components: block against block
    comp = shared.join(roots, "node", "left").select("key", "band", "node", "n", F.coalesce("root", "node").alias("comp"))
    split = comp.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    rest = comp.join(split, "key").join(nodes.select("node", "sign", "bands"), "node").join(bodies, "node")
    bytes_in = rest.groupBy("key").agg(F.sum(F.octet_length("text")).alias("size"))
    blocks = F.ceil(F.greatest(F.col("n") / _BLOCK, F.col("size") / _BLOCK_BYTES)).cast("long")
    rest = rest.join(bytes_in, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    sheets = rest.groupBy("key", "band", "blocks", "block").agg(F.collect_list(F.struct("node", "comp", "sign", "bands", "text")).alias("sheet"))
    sheets = folders.save(sheets, "sheets")
    left = sheets.select("key", "band", F.col("sheet").alias("left"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"))
    right = sheets.select("key", F.col("block").alias("j"), F.col("sheet").alias("right"))
    pairs = left.join(right, ["key", "j"]).select("band", "left", "right")
    more = folders.save(pairs.mapInArrow(lambda it: compare_blocks(it, threshold), "a binary, b binary").distinct(), "links")
    if not more.isEmpty():
        roots = components.components(links.unionByName(more))

    member = nodes.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    classes = member.join(least, "root").select("node", "least")
    out = sketched.select("id", "h", "node").join(classes, "node", "left")
    out = out.withColumn("least", F.coalesce("least", key))
    kept = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("h") == F.col("least.h"))
    return out.select("id", "h", F.col("least.id").alias("class_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that represent their class, each once: of rows alike in id and text any one stays."""
    found = near_duplicates(docs, id_col, text, threshold)
    gone = found.filter(~F.col("kept")).select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct()
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_hash(F.col(text)).alias("h"))
    left = marked.join(gone, marked["id"].eqNullSafe(gone["_id"]) & (marked["h"] == gone["_h"]), "left_anti")
    return left.dropDuplicates(["id", "h"]).select("row.*")
