"""N-gram Jaccard join: MinHash banding with verification on full n-gram sets, and the groups that its links form.

Words are runs of letters and digits, lower-cased; a document's set holds the hashes of its runs of ``size`` words (a
shorter document, if it has words, has one run). Two documents are linked when the Jaccard similarity of their sets
reaches the threshold.

1. ``sketch``: per document the key of its set and ``bands`` hashes of ``rows`` minimum hashes each, both chosen so
   that a pair at the threshold shares a band with the target recall. Documents with equal sets form a class; the rest
   of the work is on one representative per class.
2. ``candidate_members``: representatives are shuffled on their band hashes. A bucket is cut into blocks by total set
   size, and every two blocks of it form a group of bounded size; a group lists the members that have a candidate
   there. A pair counts in the first band that it shares only.
3. ``verified_links``: only listed members get their sets, once per group; texts are not shuffled. A group compares
   its candidates exactly and gives per member the number of linked documents and its root in the group's links, so
   no pair is ever a row and no group is larger than two blocks.
4. ``components``: large-star / small-star over the root links, in written rounds, until nothing changes.

Hot keys: equal sets meet in a map-side combined aggregate; a bucket with a large share of the documents is split
into blocks; hubs of the component graph meet in joins that the adaptive skew join splits. Every intermediate result is a
Parquet table in the shared checkpoint folder, so a lost executor repeats tasks of one step only.

Defined cases: null, empty and wordless texts have no set, so no links, and are their own class; repeated rows are
copies of each other; null ids are allowed and sort first; an empty table has an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.textnp import ALNUM_TABLE, mix64, shingles_of, slices, words_of
from granary.session import scratch_path

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 64
BLOCK_SHINGLES = 200_000
BITMAP_BITS = 1 << 26
_BITMAP_BYTES = 4096  # of Spark's bitmaps

SKETCH = "row_id long, doc_id long, key_a long, key_b long, n_shingles long, bands array<long>"


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band with which a pair at the threshold shares a band with this recall.

    More rows mean fewer false candidates; ``1 - (1 - threshold ** rows) ** bands >= recall`` sets the bands, and
    bands x rows stays within ``max_hashes``.
    """
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall can't be reached with this number of hashes")
    return best


def _salts(n: int) -> np.ndarray:
    return np.random.default_rng(20240301).integers(1, 2**64, n, dtype=np.uint64) | np.uint64(1)


def shingle_sets(col: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of the sorted distinct shingles of each document of a slice."""
    words = words_of(col, ALNUM_TABLE)
    doc, hashes = shingles_of(words, size)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    if len(doc):
        first = np.ones(len(doc), bool)
        first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        doc, hashes = doc[first], hashes[first]
    return np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=words.n_docs))]), hashes


def _fold(offsets: np.ndarray, hashes: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key_a, key_b, band hashes [documents, bands]) of documents that all have shingles."""
    starts = offsets[:-1]
    key_a = np.add.reduceat(hashes, starts)
    key_b = np.add.reduceat(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    out = np.empty((len(starts), bands), np.uint64)
    salts = _salts(bands * rows)
    for band in range(bands):
        acc = np.full(len(starts), np.uint64(band + 1))
        for k in range(band * rows, (band + 1) * rows):
            # an odd multiple orders the hashes anew; the rotation brings the strong high bits in again
            v = hashes * salts[k]
            acc = mix64(acc ^ np.minimum.reduceat(v ^ (v >> np.uint64(32)), starts))
        out[:, band] = acc
    return key_a, key_b, out


def sketch(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Row id (a hash of id and text), set key, set size and band hashes of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(2)):
                offsets, hashes = shingle_sets(batch.column(2).slice(i, j - i), size)
                counts = np.diff(offsets)
                full = np.flatnonzero(counts)
                key_a, key_b = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                lists: list = [[]] * (j - i)
                if len(full):
                    a, b, out = _fold(np.append(offsets[:-1][full], offsets[-1]), hashes, bands, rows)
                    key_a[full], key_b[full] = a.view(np.int64), b.view(np.int64)
                ends = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                values = out.view(np.int64).ravel() if len(full) else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                cols = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)]
                cols += [pa.array(key_a), pa.array(key_b), pa.array(counts.astype(np.int64)), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["row_id", "doc_id", "key_a", "key_b", "n_shingles", "bands"])

    return source(docs).mapInArrow(run, SKETCH)


def source(docs: DataFrame) -> DataFrame:
    """``row_id``, ``doc_id``, ``text``; equal rows have equal row ids."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(F.xxhash64(doc_id, text).alias("row_id"), doc_id.alias("doc_id"), text.alias("text"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def representatives(sketches: DataFrame) -> DataFrame:
    """One row per set: the class (its smallest row id), its documents, set size and bands."""
    return (
        sketches.filter("n_shingles > 0")
        .groupBy("key_a", "key_b")
        .agg(
            F.min("row_id").alias("rep"),
            F.min("doc_id").alias("same_set_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )


def candidate_groups(reps: DataFrame, block_shingles: int) -> DataFrame:
    """Band buckets of two representatives or more, cut into pairs of blocks: the group and the member's fields.

    Only ids meet in the buckets (a band's hash holds its number, so it names the bucket); the band hashes follow for
    the members of buckets that have company.
    """
    members = reps.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight")).filter("n > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("weight") / block_shingles).cast("int").alias("blocks"))
    placed = members.drop("n_shingles").join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    # block x meets every block y once: the group of (x, y) and (y, x) is the same
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = placed.select("rep", "bucket", "block", other)
    rows = rows.select("rep", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    fields = reps.select("rep", "copies", "n_shingles", "bands")
    return rows.join(fields, "rep").withColumn("band", (F.array_position("bands", F.col("bucket")) - 1).cast("int"))


_GROUP = ["bucket", "low", "high"]


def _pairs(band: int, low: int, high: int, blocks: np.ndarray, n: np.ndarray, bands: np.ndarray, threshold: float) -> Iterator[tuple]:
    """(member, its candidates after it) of a group: this is the first shared band, and the set sizes allow a link.

    Members of one block meet in the block's own group, members of two blocks in theirs.
    """
    for i in range(len(n) - 1):
        rest = slice(i + 1, len(n))
        ok = np.minimum(n[i], n[rest]) >= threshold * np.maximum(n[i], n[rest]) - 1e-9
        if low != high:
            ok &= blocks[rest] != blocks[i]
        if band:
            ok &= ~(bands[rest, :band] == bands[i, :band]).any(axis=1)
        at = np.flatnonzero(ok)
        if len(at):
            yield i, at + i + 1


def candidate_members(groups: DataFrame, threshold: float) -> DataFrame:
    """The members of each group that have a candidate there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k in range(batch.num_rows):
                g = batch.slice(k, 1).to_pylist()[0]
                m = sorted(g["members"], key=lambda x: x["rep"])
                n = np.array([x["n_shingles"] for x in m])
                bands = np.array([x["bands"] for x in m])
                blocks = np.array([x["block"] for x in m])
                linked: set[int] = set()
                for i, others in _pairs(g["band"], g["low"], g["high"], blocks, n, bands, threshold):
                    linked.add(i)
                    linked.update(others.tolist())
                rows += [(g["bucket"], g["low"], g["high"], m[i]["rep"]) for i in sorted(linked)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[*_GROUP, "rep"])

    members = F.collect_list(F.struct("rep", "n_shingles", "bands", "block")).alias("members")
    held = groups.groupBy(*_GROUP).agg(F.first("band").alias("band"), members)
    return held.mapInArrow(run, "bucket long, low int, high int, rep long")


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """Bits, set where an id is congruent modulo ``BITMAP_BITS``: a filter of fixed size that no id fails."""
    at = F.pmod(F.col("rep"), F.lit(BITMAP_BITS)) + 1  # Spark's bitmaps count from 1
    rows = ids.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    rows = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # 4 kB a row
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in rows:
        start = (r["bucket"] - 1) * _BITMAP_BYTES
        out[start : start + _BITMAP_BYTES] = np.frombuffer(r["bits"], np.uint8)
    return out


def _in_bitmap(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids % BITMAP_BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def representative_sets(docs: DataFrame, listed: DataFrame, size: int) -> DataFrame:
    """``rep`` and its sorted shingle hashes, for the listed representatives only.

    The texts stay where they are read: a bitmap of the listed ids tells which ones to cut into shingles. What a
    shared bit lets through besides is left out by the join that follows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(id_bitmap(listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.flatnonzero(_in_bitmap(shared.value, np.asarray(batch.column(0))))
            batch = batch.take(pa.array(wanted))
            for i, j in slices(batch.column(1)):
                offsets, hashes = shingle_sets(batch.column(1).slice(i, j - i), size)
                sets = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], names=["rep", "shingles"])

    rows = source(docs).select("row_id", "text").mapInArrow(run, "rep long, shingles array<long>")
    rows = rows.join(listed.select("rep").distinct(), "rep", "left_semi")
    return rows.groupBy("rep").agg(F.first("shingles").alias("shingles"))  # equal rows have equal ids: one is enough


def _similar(sets: list[np.ndarray], threshold: float):
    """A function (member, others) -> mask of the others whose similarity reaches the threshold."""
    flat = np.concatenate(sets)
    _, code = np.unique(flat, return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    mark = np.zeros(int(code.max()) + 1, np.int64)

    def check(i: int, others: np.ndarray) -> np.ndarray:
        own = code[ends[i] - sizes[i] : ends[i]]
        mark[own] = 1
        parts = np.concatenate([code[ends[k] - sizes[k] : ends[k]] for k in others])
        first = np.cumsum(sizes[others]) - sizes[others]
        shared = np.add.reduceat(mark[parts], first)
        mark[own] = 0
        return shared >= threshold * (sizes[i] + sizes[others] - shared) - 1e-9

    return check


def verified_links(groups: DataFrame, members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Per group and linked member: ``links`` (documents linked there) and ``root`` (of its links in the group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k in range(batch.num_rows):
                g = batch.slice(k, 1).to_pylist()[0]
                rows += _verify(g, threshold)
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rep", "root", "links"])

    rows = groups.join(members, [*_GROUP, "rep"]).join(sets, "rep")
    held = F.collect_list(F.struct("rep", "copies", "n_shingles", "bands", "block", "shingles")).alias("members")
    held = rows.groupBy(*_GROUP).agg(F.first("band").alias("band"), held)
    return held.mapInArrow(run, "rep long, root long, links long")


def _verify(g: dict, threshold: float) -> list[tuple[int, int, int]]:
    m = sorted(g["members"], key=lambda x: x["rep"])
    sets = [np.array(x["shingles"], np.int64) for x in m]
    n = np.array([x["n_shingles"] for x in m])
    bands = np.array([x["bands"] for x in m])
    blocks = np.array([x["block"] for x in m])
    copies = np.array([x["copies"] for x in m])
    links = np.zeros(len(m), np.int64)
    root = list(range(len(m)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    check = _similar(sets, threshold)
    for i, others in _pairs(g["band"], g["low"], g["high"], blocks, n, bands, threshold):
        others = others[check(i, others)]
        links[i] += copies[others].sum()
        links[others] += copies[i]
        for k in others.tolist():
            a, b = find(i), find(k)
            if a != b:
                root[max(a, b)] = min(a, b)  # members are in order of their ids
    return [(m[i]["rep"], m[find(i)]["rep"], int(links[i])) for i in range(len(m)) if links[i]]


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``): the smallest node of each connected component, for nodes of ``u``-``v`` edges.

    Large-star and small-star rounds: every round links a node's neighbours to its smallest one, and the edges end as
    stars around the smallest nodes. Rounds are tables; the driver sees their counts and checksums only.
    """

    def checksum(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        return moved.union(low.select("u", F.col("m").alias("v")))

    edges = _stored(edges.select("u", "v").filter("u <> v").distinct(), "star-edges")
    before = checksum(edges)
    while True:
        edges = _stored(small_star(large_star(edges).distinct()).distinct(), "star-edges")
        after = checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def link(
    docs: DataFrame,
    size: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Per document row: ``row_id``, ``doc_id``, ``rep`` (its class of equal sets), ``same_set_id`` and ``class_id``
    (the smallest doc_id of its class of equal sets, and of the group that its links form), and ``n_links`` (other
    documents that it is linked to, copies included)."""
    bands, rows = choose_bands(threshold, recall)
    sketches = _stored(sketch(docs, size, bands, rows), "sketches")
    reps = _stored(representatives(sketches), "representatives")
    groups = _stored(candidate_groups(reps, block_shingles), "candidate-groups")
    members = _stored(candidate_members(groups, threshold), "candidate-members")
    sets = representative_sets(docs, members, size)
    links = _stored(verified_links(groups, members, sets, threshold), "links")
    joined = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    return _rows(sketches, reps, links, joined)


def _rows(sketches: DataFrame, reps: DataFrame, links: DataFrame, joined: DataFrame) -> DataFrame:
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select(
        "key_a",
        "key_b",
        "rep",
        "same_set_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    # representatives only, and a group's members are combined map-side
    groups = classes.groupBy("component").agg(F.min("same_set_id").alias("class_id"))
    classes = classes.join(groups, "component")
    rows = sketches.select("row_id", "doc_id", "key_a", "key_b", "n_shingles").join(classes, ["key_a", "key_b"], "left")
    own = F.col("n_shingles") > 0
    return rows.select(
        "row_id",
        "doc_id",
        F.when(own, F.col("rep")).otherwise(F.col("row_id")).alias("rep"),
        F.when(own, F.col("same_set_id")).otherwise(F.col("doc_id")).alias("same_set_id"),
        F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(own, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(own, F.col("component")).otherwise(F.col("row_id")).alias("component"),
    )


_ROW = "__ngram_join_row"  # never a name of the caller's columns


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, all its columns: the one with the smallest id.

    Of repeated rows one stays; documents without words that differ in their ids are no copies and all stay.
    """
    linked = link(docs, **options)
    chosen = linked.groupBy("component").agg(F.min(F.struct("doc_id", "row_id"))["row_id"].alias(_ROW))
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select("*", F.xxhash64(doc_id, text).alias(_ROW)).join(chosen.select(_ROW), _ROW, "left_semi")
    return rows.dropDuplicates([_ROW]).drop(_ROW)
