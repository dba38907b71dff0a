"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

A document's set holds the distinct ``k``-word shingles of its text with A-Z in lower
case; a text of fewer words is one shingle, an empty or null text has the empty set
and is linked with nothing. Documents link when ``100 * |A & B| >= percent * |A | B|``.

Plan. (1) One pass over the texts gives every row a 128-bit digest of its set and the band hashes
of its sketch. Rows with equal sets form a class, so copies never meet again. (2) Classes
that share a band belong to one candidate family, found as components of bucket-to-leader
edges. (3) A second pass recomputes the sets of one row of each class in a family. (4) A family of at
most ``BLOCK_DOCS`` classes is compared in one place. In a larger one, leaders come first: each member
is compared with the ``LEADERS`` leaders that it shares most with, and a family that is connected by then is done.
Of the others, components that share buckets go on together: their members are cut into blocks of bounded size, those of a large
component into blocks of its own, and pairs of blocks that hold different components are compared. So a family of copies close to
their leaders costs traffic in proportion to its size; ``m`` members outside the largest component add about ``m / 1024`` of it, the price of
losing no link. No family is gathered in one place, and none is cut short. Intersections are
counted exactly. (5) The verified links' components give every row its ``component_id``, the smallest
id reachable.

Classes are told apart by cryptographic digests (of the words themselves where a set has one
shingle, which can link with no other set); intersections are counted over 64-bit shingle hashes. A pair at
the threshold 0.85 is missed by all 40 bands of 6 coordinates with a chance below 1e-8.

Ids may be of any type that has an order. Repeated rows, and rows that repeat an id, are members of the
class of their set. A row with a null id is reported with the component of its class and links others, but
names no component; a component of such rows only has a null ``component_id``. Other columns are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, Words, binaries, chunks, fold, inside, mix, signed, text_buffers, windows
from .common import components, fresh, key_filter, materialize, settings, split_rows

BANDS, ROWS = 40, 6
#: Most documents and shingles in a block of a family.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
LEADERS = 3
#: Most followers that share one copy of their leader.
LED_DOCS = 128


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Sorted distinct shingle hashes of each text, where each text's begin, and the digest of each set (None: empty)."""
    w = Words(data, offsets, lower=True)
    h = w.hashes()
    at = np.flatnonzero(inside(w.first, k))
    grams = windows(h, k)[at]
    cut = np.searchsorted(at, w.first)
    counts = np.diff(w.first)
    parts, sizes, digests = [], np.zeros(w.n_texts, np.int64), []
    for i in range(w.n_texts):
        lo, n = w.first[i], int(counts[i])
        if n == 0:
            digests.append(None)
            continue
        parts.append(np.unique(grams[cut[i] : cut[i + 1]]) if n >= k else windows(h[lo : lo + n], n))
        sizes[i] = len(parts[-1])
        if sizes[i] > 1:
            digests.append(fold(parts[-1], 0, len(parts[-1])))
        else:
            one = b" ".join(w.data[w.start[j] : w.end[j]].tobytes() for j in range(lo, lo + min(n, k)))
            digests.append(blake2b(one, digest_size=16, person=b"one shingle").digest())
    first = np.zeros(w.n_texts + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), first, digests


def sketches(flat: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` coordinates for each non-empty set.

    Round ``i`` throws every element into one of ``t`` bins with a random value; a
    coordinate keeps the smallest (round, value). Rounds from ``t`` on aim all elements at
    bin ``i - t``, so after ``2 t`` rounds each coordinate is filled; sets stop as soon as
    theirs are.
    """
    sizes = np.diff(first)
    sizes = sizes[sizes > 0]
    n = len(sizes)
    empty = U(0xFFFFFFFFFFFFFFFF)
    table = np.full(n * t, empty, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    x, open_ = flat, np.arange(n)
    for i in range(2 * t):
        h = mix(x + U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (h & U((1 << 54) - 1)) | U(i << 54)
        bins = ((h >> U(32)) * U(t) >> U(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(table, owner * t + bins, value)
        done = (table.reshape(n, t)[open_] != empty).all(axis=1)
        if done.all():
            break
        if done.any():
            left = np.zeros(n, bool)
            left[open_[~done]] = True
            stay = left[owner]
            x, owner, open_ = x[stay], owner[stay], open_[~done]
    return table.reshape(n, t)


def bands(table: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket for each band of each sketch."""
    parts = table.reshape(len(table), n_bands, rows)
    h = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64), parts.shape[:2]) * U(0x9E3779B97F4A7C15)
    for r in range(rows):
        h = mix(h ^ parts[:, :, r])
    return h


def _signatures(k: int, n_bands: int, rows: int):
    def run(batches):
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for lo, hi in chunks(offsets, 1 << 20):
                flat, first, digests = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                n = np.diff(first)
                some = n > 0
                hashes = bands(sketches(flat, first, n_bands * rows), n_bands, rows) if some.any() else np.empty((0, n_bands), np.uint64)
                at = np.zeros(hi - lo + 1, np.int32)
                np.cumsum(some * n_bands, out=at[1:])
                lists = pa.ListArray.from_arrays(pa.array(at), signed(hashes.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(n), binaries(digests), lists], ["doc_id", "text_key", "n_shingles", "digest", "bands"])

    return run


def _members(k: int, wanted):
    """Sets of the rows whose key passes the filter (all, if there is none)."""

    def run(batches):
        keep = wanted.value
        for b in batches:
            if keep is not None:
                hit = np.flatnonzero(keep(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
                if not len(hit):
                    continue
                b = b.take(pa.array(hit))
            data, offsets = text_buffers(b.column(1))
            for lo, hi in chunks(offsets, 1 << 20):
                flat, first, digests = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                sets = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([binaries(digests), sets], ["digest", "shingles"])

    return run


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``a`` with the sets ``b`` (positions in ``sets``)."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    cut = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1], True])
    df = np.diff(cut)
    both = np.zeros((m, m), np.float32)
    for d in range(2, 9):  # rare shingles: count their few pairs
        at = cut[:-1][df == d]
        if len(at):
            for i in range(d):
                for j in range(i + 1, d):
                    both += np.bincount(owner[at + i] * m + owner[at + j], minlength=m * m).reshape(m, m) if len(at) * 8 > m * m else _sparse(owner[at + i], owner[at + j], m)
    both = np.maximum(both, both.T)[np.ix_(a, b)]
    common = np.flatnonzero(df > 8)  # the others: products of 0/1 matrices
    for lo in range(0, len(common), 2048):
        part = common[lo : lo + 2048]
        grid = np.zeros((m, len(part)), np.float32)
        lens = df[part]
        grid[owner[np.concatenate([np.arange(s, e) for s, e in zip(cut[part], cut[part + 1], strict=True)])], np.repeat(np.arange(len(part)), lens)] = 1
        both += grid[a] @ grid[b].T
    return both


def _sparse(i: np.ndarray, j: np.ndarray, m: int) -> np.ndarray:
    out = np.zeros((m, m), np.float32)
    np.add.at(out, (i, j), 1)
    return out


def _star(link: np.ndarray) -> np.ndarray:
    """Component number of each node of a symmetric boolean matrix."""
    m = len(link)
    label = np.full(m, -1)
    for i in range(m):
        if label[i] < 0:
            front = np.zeros(m, bool)
            front[i] = True
            while front.any():
                label[front] = i
                front = link[front].any(axis=0) & (label < 0)
    return label


def _verified(percent: int):
    def run(table: pa.Table) -> pa.Table:
        family, i, j, block, node = (table[c].to_numpy() for c in ("family", "i", "j", "block", "node"))
        shingles = table["shingles"].to_pylist()
        order = np.lexsort((block, j, i, family))
        out_a, out_b = [], []
        same = (family[order][1:] == family[order][:-1]) & (i[order][1:] == i[order][:-1]) & (j[order][1:] == j[order][:-1])
        for rows in np.split(order, np.flatnonzero(~same) + 1):
            sets = [np.frombuffer(shingles[r], np.uint64) for r in rows]
            left = np.flatnonzero(block[rows] == i[rows[0]])
            right = np.flatnonzero(block[rows] == j[rows[0]])
            if len(rows) < 2 or not len(left) or not len(right):
                continue
            size = np.array([len(s) for s in sets], np.float64)
            inter = _overlaps(sets, left, right).astype(np.float64)
            union = size[left][:, None] + size[right][None, :] - inter
            found = 100 * inter >= percent * union
            link = np.zeros((len(rows), len(rows)), bool)
            link[np.ix_(left, right)] = found
            link |= link.T
            root = _star(link)
            far = root != np.arange(len(rows))
            out_a.append(node[rows][far])
            out_b.append(node[rows][root[far]])
        both = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b)]
        return pa.table({"a": pa.array(both[0], pa.int64()), "b": pa.array(both[1], pa.int64())})

    return run


def _followers(percent: int):
    """Links of followers to their leader; a group holds one leader and a bounded share of its followers."""

    def run(table: pa.Table) -> pa.Table:
        leads, node = table["leads"].to_numpy(zero_copy_only=False), table["node"].to_numpy()
        shingles = table["shingles"].to_pylist()
        top = int(np.flatnonzero(leads)[0])
        one, found = np.frombuffer(shingles[top], np.uint64), []
        for r in np.flatnonzero(~leads):
            other = np.frombuffer(shingles[r], np.uint64)
            at = np.minimum(np.searchsorted(one, other), len(one) - 1)
            both = int((one[at] == other).sum())
            if 100 * both >= percent * (len(one) + len(other) - both):
                found.append(node[r])
        return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([node[top]] * len(found), pa.int64())})

    return run


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, text_key (hash of the text), n_shingles, component_id, kept (doc_id = component_id)."""
    return _grouped(docs, k, percent, n_bands, rows).drop("group")


def _grouped(docs: DataFrame, k: int, percent: int, n_bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` with the ``group`` of each row, one number per component, null for rows without a set."""
    spark = docs.sparkSession
    settings(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed_rows = materialize(keyed.mapInArrow(_signatures(k, n_bands, rows), f"doc_id {kind}, text_key long, n_shingles long, digest binary, bands array<long>"), "signatures")
    classes = signed_rows.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.min(F.xxhash64("doc_id", "text_key")).alias("pick"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # a set of one shingle is like no other set
    slots = classes.where("n > 1").select("node", F.explode("bands").alias("bucket"))
    leaders = materialize(slots.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("c")).where("c > 1"), "leaders")
    pairs = materialize(slots.join(leaders, "bucket").where("node <> leader").groupBy("node", "leader").agg(F.sum("c").alias("c")), "pairs")
    family = _with_roots(components(pairs, "node", "leader"), "family")
    member = materialize(family.join(classes.select("node", "digest", "pick", "n"), "node"), "members")
    links = _links(texts, member, pairs, k, percent)
    linked = _with_roots(components(links, "a", "b"), "root")
    named = linked.join(classes.select("node", "rep"), "node")
    lowest = materialize(named.groupBy("root").agg(F.min("rep").alias("lowest")), "lowest")
    named = named.join(lowest, "root").select("node", "root", "lowest")
    named = classes.select("node", "digest", "rep").join(named, "node", "left").select("digest", F.coalesce("lowest", "rep").alias("component_id"), F.coalesce("root", "node").alias("group"))
    named = materialize(named, "components")
    out = signed_rows.select("doc_id", "text_key", "n_shingles", "digest").join(named, "digest", "left")
    out = out.select("doc_id", "text_key", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "group")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _with_roots(found: DataFrame, name: str) -> DataFrame:
    """(node, root) with a row for the roots too."""
    return found.select("node", F.col("root").alias(name)).unionByName(found.select(F.col("root").alias("node"), F.col("root").alias(name)).distinct())


def _links(texts: DataFrame, member: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (a, b), enough of them to connect all that are linked."""
    spark = texts.sparkSession
    n_members, n_all = member.agg(F.count("*"), F.sum("n")).first()
    picked = texts.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("h"), "text")
    chosen = key_filter(member, "pick", n_members)
    if chosen is None:
        picked = picked.join(member.select(F.col("pick").alias("h")), "h", "left_semi")
    sets = picked.mapInArrow(_members(k, spark.sparkContext.broadcast(chosen)), "digest binary, shingles binary")
    sets = sets.groupBy("digest").agg(F.first("shingles").alias("shingles"))  # repeated rows bring a set more than once
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    cost = materialize(member.groupBy("family").agg(blocks.alias("blocks")), "families")
    known = materialize(member.join(cost, "family").join(sets, "digest").select("family", "blocks", "node", "n", "shingles"), "sets")
    whole = known.where("blocks = 1").select("family", "node", "n", "shingles", F.lit(None).cast("long").alias("part"), F.lit(0).alias("chunk"))
    if cost.where("blocks > 1").isEmpty():
        return _compared(whole, n_all or 0, percent)
    large = known.where("blocks > 1").select("node", "n", "shingles")
    most = F.slice(F.sort_array(F.collect_list(F.struct("c", "leader")), asc=False), 1, LEADERS)["leader"]  # a node has as many leaders as bands at most
    led = pairs.groupBy("node").agg(most.alias("leaders")).join(large.select("node"), "node")
    links = materialize(_led(materialize(led.select("node", F.explode("leaders").alias("leader")), "led"), large, percent), "leader-links")
    label = components(links, "a", "b").select("node", F.col("root").alias("label"))
    label = materialize(large.select("node").join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "labels")
    # components that meet in a bucket: each has a member there, the bucket's leader belongs to one of them
    ends = pairs.join(label, "node").select("leader", F.col("label").alias("a")).distinct()
    meet = materialize(ends.join(label.select(F.col("node").alias("leader"), F.col("label").alias("b")), "leader").where("a <> b").select("a", "b").distinct(), "meeting")
    family = _with_roots(components(meet, "a", "b"), "family").select(F.col("node").alias("label"), "family")
    left = materialize(label.join(family, "label").join(large.select("node", "n"), "node"), "left")
    return _compared(whole.unionByName(_cut(left).join(large.select("node", "shingles"), "node").select(*whole.columns)), n_all or 0, percent).unionByName(links)


def _led(leader: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Links between members and their leaders; a leader's followers are dealt out in chunks, each with a copy of the leader."""
    sized = leader.join(large.select("node", "n"), "node")
    chunks_ = F.ceil(F.greatest(F.count("*") / LED_DOCS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    parts = materialize(sized.groupBy("leader").agg(chunks_.alias("chunks")), "led-chunks")
    follow = leader.join(parts, "leader").join(large, "node")
    follow = follow.select("leader", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", F.lit(False).alias("leads"), "shingles")
    lead = parts.select(F.col("leader").alias("node"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).join(large, "node")
    lead = lead.select(F.col("node").alias("leader"), "chunk", "node", F.lit(True).alias("leads"), "shingles")
    return follow.unionByName(lead).groupBy("leader", "chunk").applyInArrow(_followers(percent), "a long, b long")


def _cut(left: DataFrame) -> DataFrame:
    """Blocks of the members that are left: chunks of their own (``part``) for large components, mixed ones for the others."""
    size = materialize(left.groupBy("family", "label").agg(F.count("*").alias("m"), F.sum("n").alias("total")), "left-components")
    own = (F.col("m") >= BLOCK_DOCS // 2) | (F.col("total") >= BLOCK_SHINGLES // 2)
    part, load = F.when(own, F.col("label")).alias("part"), F.greatest(F.sum("m") / BLOCK_DOCS, F.sum("total") / BLOCK_SHINGLES)
    chunked = materialize(size.groupBy("family", part).agg(F.ceil(load).cast("int").alias("chunks")), "left-blocks")
    rows = left.join(size.select("family", "label", part), ["family", "label"]).withColumnRenamed("family", "f").withColumnRenamed("part", "p")
    rows = rows.join(chunked, (F.col("f") == F.col("family")) & F.col("p").eqNullSafe(F.col("part")))
    return rows.select("family", "node", "n", "part", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"))


def _compared(rows: DataFrame, n_all: int, percent: int) -> DataFrame:
    """Links of all pairs in rows (family, node, n, shingles, part, chunk) but those of one ``part``."""
    grid = materialize(rows.select("family", "part", "chunk").distinct().groupBy("family").agg(F.sort_array(F.collect_list(F.struct("part", "chunk"))).alias("grid")), "grids")
    rows = rows.join(grid, "family")
    other = F.filter(F.transform("grid", lambda x, i: F.when(~F.coalesce(x["part"] == F.col("part"), F.lit(False)), i)), lambda i: i.isNotNull())
    block = (F.array_position("grid", F.struct("part", "chunk")) - 1).cast("int")
    rows = rows.select("family", "node", "shingles", block.alias("block"), F.size("grid").alias("blocks"), F.explode(other).alias("other"))
    rows = rows.select("family", "node", "shingles", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "blocks")
    packs = max(1, n_all // 400_000)
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(packs))).otherwise(F.xxhash64("family", "i", "j"))
    rows = rows.select(pack.alias("pack"), "family", "i", "j", "block", "node", "shingles")
    return rows.groupBy("pack").applyInArrow(_verified(percent), "a long, b long")


def deduplicate(docs: DataFrame, *, k: int = 5, percent: int = 80, n_bands: int = 48, rows: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the one with the smallest id (null ids last), and of
    rows that share that id the one with the least hash of its text. Rows without a word are in no group; a repeated row stays once.

    Only rows that may go, or may be repeated, are exchanged.
    """
    own = F.xxhash64("doc_id", F.xxhash64("text"))
    found = _grouped(docs, k, percent, n_bands, rows).select("doc_id", "text_key", "kept", "group", F.xxhash64("doc_id", "text_key").alias("key"))
    found = materialize(found, "decisions")
    # rows that have the group's smallest id, or all of them none: where these differ, only one stays
    first = found.where("kept and group is not null")
    several = first.groupBy("group").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("group")
    doubtful = found.groupBy("key").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1 or not kept").select("key")
    doubtful = doubtful.unionByName(first.join(several, "group", "left_semi").select("key")).distinct()
    maybe, sure = split_rows(docs, own, materialize(doubtful, "doubtful"))
    text_key, id_, key_ = fresh(docs.columns, "text_key", "stay_id", "stay_key")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("one")
    stay = first.groupBy("group").agg(one).select("one.doc_id", "one.text_key").unionByName(found.where("group is null").select("doc_id", "text_key").distinct())
    stay = stay.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key_))
    maybe = maybe.withColumn(text_key, F.xxhash64("text"))
    maybe = maybe.join(stay, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(text_key) == F.col(key_)), "left_semi")
    return sure.unionByName(maybe.dropDuplicates(["doc_id", text_key]).select(*docs.columns))
