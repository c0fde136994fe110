"""MinHash near-duplicates: banded candidates, odd sketches to sift them, full sets to confirm them.

A document is the set of its distinct runs of ``shingle`` words. Two sets are linked if 100 * |A & B| >= percent *
|A | B|; the result is each document's component.

1. *Prepare* (narrow): hash the shingles, take MinHash samples, fold the samples into an odd sketch (a parity bitmap
   of (sample, value) pairs), digest the whole set. Documents of equal sets become one node; only nodes go on.
2. *Stars*: nodes meet in the buckets of their bands. Each is paired with its bucket's centre, so a bucket of n
   nodes gives n - 1 pairs. The population count of two sketches' XOR estimates how many samples differ; a pair far
   above the threshold's count goes.
3. *Confirm* on full sets, the likeliest pair of each node first, then pairs that still join different components.
4. *The rest*: where a bucket holds several components, its nodes outside the largest one are compared with all
   nodes of other components inside blocks of the bucket: sketch against sketch, then set against set. Only links
   become rows, so no link is lost to the choice of centres, near misses cost no row, and a bucket that is one
   component costs nothing.

A pair at the threshold misses all bands with probability (1 - 0.8**4)**25 = 2e-6; sketches are cut at six standard
deviations. Sets are compared by 64-bit hashes of their shingles.

Defined cases: a text without words (also null) has an empty set and is linked with nothing; a null doc_id is linked
with nothing and has a null component; rows of one doc_id are nodes by their texts, so equal rows share a component;
other columns are ignored by ``components`` and kept by ``representatives``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from battlelake import session
from battlelake.llm import bytesets

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 25, 4
SAMPLES = BANDS * ROWS

#: Bits of an odd sketch: 64-bit words times 64.
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS

#: Shingles, in all, of the nodes on one side of a block of a bucket (16 MB of hashes).
BLOCK = 2**21

SPACES = np.zeros(256, bool)
SPACES[0x20] = True
SPACES[0x09:0x0E] = True

_random = np.random.RandomState(20240607)
#: Odd multipliers and offsets of the sample functions.
MULTIPLY = _random.randint(0, 2**63 - 1, SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.randint(0, 2**63 - 1, SAMPLES).astype(np.uint64) * np.uint64(2)


def most_differing(percent: int = PERCENT) -> int:
    """The largest XOR population count of the sketches of a pair at the threshold, six deviations up."""
    j = percent / 100
    differing, spread = 2 * SAMPLES * (1 - j), 2 * math.sqrt(SAMPLES * j * (1 - j))
    bits = lambda d: SKETCH_BITS / 2 * (1 - math.exp(-2 * d / SKETCH_BITS))
    return math.ceil(bits(differing + 6 * spread))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    lower = bytesets.LOWER[data]
    starts, ends, rows = bytesets.words(lower, offsets, ~SPACES)
    hashes = bytesets.span_hashes(lower, starts, ends)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    windows = bytesets.window_hashes(hashes, shingle)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= shingle:
            out.append(np.unique(windows[a:b - shingle + 1]))
        elif b > a:
            out.append(bytesets.window_hashes(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def samples(codes: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that isn't empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(codes), 1024):
        part = codes[at:at + 1024]
        values = part[None, :] * MULTIPLY[:, None]
        values += ADD[:, None]
        values ^= values >> np.uint64(31)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def sketch(least: np.ndarray) -> np.ndarray:
    """The parity of the samples that fall on each bit."""
    places = bytesets.mixed(least + np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    return bytesets.window_hashes(bytesets.mixed(least), ROWS)[::ROWS] + np.arange(BANDS, dtype=np.uint64)


def prepared(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, node, bands, sketch, text_hash); node, bands and sketch are null for an empty set."""
    names = ["doc_id", "n_shingles", "node", "bands", "sketch", "text_hash"]

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                sets = shingle_sets(*bytesets.texts_of(part.column("text")), shingle)
                nodes, bands, sketches = [], [], []
                for codes in sets:
                    if not len(codes):
                        nodes.append(None), bands.append(None), sketches.append(None)
                        continue
                    least = samples(codes)
                    nodes.append(int(node_of(codes)))
                    bands.append(band_keys(least).view(np.int64))
                    sketches.append(sketch(least).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())), part.column("text_hash"),
                ], names=names)

    rows = bytesets.only(docs, doc_id="bigint", text="string").withColumn("text_hash", F.xxhash64("text"))
    return bytesets.map_arrow(
        rows, prepare, "doc_id long, n_shingles long, node long, bands array<bigint>, sketch array<bigint>, text_hash long")


def _differing(a: str, b: str):
    """The population count of the XOR of two sketch columns."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, SKETCH_WORDS)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def star_pairs(buckets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(low, high, differing): each node with the centre of each of its buckets, if their sketches agree.

    The bucket's own key decides which of its nodes is the centre, so nodes that share many buckets meet many centres.
    """
    centres = buckets.groupBy("band").agg(F.min(F.col("node").bitwiseXOR(F.col("band"))).alias("least"), F.count("*").alias("n")).where("n > 1")
    centres = centres.select("band", F.col("least").bitwiseXOR(F.col("band")).alias("centre"))
    pairs = buckets.join(centres, "band").where("node <> centre").select(
        F.least("node", "centre").alias("low"), F.greatest("node", "centre").alias("high")).distinct()
    return _sifted(pairs, nodes, percent)


def _sifted(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    sketches = nodes.select(F.col("node").alias("high"), F.col("sketch").alias("high_sketch"))
    centres = nodes.select(F.col("node").alias("low"), F.col("sketch").alias("low_sketch"))
    return (
        pairs.join(sketches, "high").join(centres, "low").select("low", "high", _differing("low_sketch", "high_sketch").alias("differing"))
        .where(F.col("differing") <= most_differing(percent))
    )


def rest_links(buckets: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(low, high): linked nodes of one bucket but different components, enough of them to join those components.

    ``labels`` has (node, label) of the nodes that are not alone. The nodes outside a bucket's largest component ask
    all nodes of the others, in a grid of blocks bounded by the sets they hold. A pair is looked at in its first
    common bucket only, sketches first, then the full sets; a block gives at most one link per component it joins.
    """
    labelled = buckets.join(labels, "node", "left").join(nodes.select("node", "n_shingles"), "node").select(
        "band", "node", F.coalesce("label", "node").alias("label"), "n_shingles")
    sizes = labelled.groupBy("band", "label").agg(F.sum("n_shingles").alias("n"))
    mixed_buckets = sizes.groupBy("band").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"),
        F.max_by("label", F.struct("n", "label")).alias("largest")).where("parts > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    members = session.cut_lineage(labelled.join(mixed_buckets, "band").select(
        "band", "node", "label", (F.col("label") != F.col("largest")).alias("asks"),
        blocks(F.col("n") - F.col("most")).alias("rows"), blocks(F.col("n")).alias("columns")))
    sets = node_sets(members.select("node").distinct(), nodes, docs, shingle)
    # A fixed number of parts: the rows are few bytes but much work, and would else be gathered into few tasks.
    full = members.join(sets.join(nodes.select("node", "bands", "sketch"), "node"), "node")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = full.withColumn("row", copies("rows")).withColumn("column", place("columns")).withColumn("own", F.lit(False))
    asking = full.where("asks").withColumn("row", place("rows")).withColumn("column", copies("columns")).withColumn("own", F.lit(True))
    columns = ["band", "row", "column", "own", "node", "label", "asks", "bands", "sketch", "codes"]
    limit = most_differing(percent)
    nothing = pd.DataFrame({"low": [], "high": []}, dtype="int64")

    def stacked(rows: pd.Series) -> np.ndarray:
        return np.stack(rows.to_numpy()).astype(np.int64).view(np.uint64)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own = group["own"].to_numpy(bool)
        asks, others = group[own], group[~own]
        if not len(asks) or not len(others):
            return nothing
        band = np.array([group["band"].iat[0]], np.int64).view(np.uint64)[0]
        a_node, a_label = asks["node"].to_numpy().copy(), asks["label"].to_numpy().copy()
        b_node, b_label = others["node"].to_numpy().copy(), others["label"].to_numpy().copy()
        a_sketch, b_sketch = stacked(asks["sketch"]), stacked(others["sketch"])
        a_bands, b_bands = stacked(asks["bands"]), stacked(others["bands"])
        b_asks = others["asks"].to_numpy(bool)
        a_sets, b_sets = ([np.frombuffer(c, np.uint64) for c in g["codes"]] for g in (asks, others))
        b_size = np.array([len(c) for c in b_sets], np.int64)
        found: list[tuple[int, int]] = []
        for i, codes in enumerate(a_sets):
            n = len(codes)
            # Both ends ask: the lesser one's question counts.
            may = (b_label != a_label[i]) & (~b_asks | (b_node > a_node[i]))
            may &= (100 * np.minimum(b_size, n) >= percent * np.maximum(b_size, n))
            at = np.flatnonzero(may)
            at = at[np.bitwise_count(b_sketch[at] ^ a_sketch[i]).sum(axis=1) <= limit]
            at = at[(b_bands[at] == a_bands[i]).argmax(axis=1) == np.flatnonzero(a_bands[i] == band)[0]] if len(at) else at
            if not len(at):
                continue
            every = np.concatenate([b_sets[k] for k in at])
            hits = codes[np.minimum(np.searchsorted(codes, every), n - 1)] == every
            shared = np.add.reduceat(hits.astype(np.int64), np.concatenate([[0], np.cumsum(b_size[at])[:-1]]))
            for k in at[100 * shared >= percent * (n + b_size[at] - shared)]:
                old, new = b_label[k], a_label[i]
                if old != new:
                    found.append((min(a_node[i], b_node[k]), max(a_node[i], b_node[k])))
                    a_label[a_label == old], b_label[b_label == old] = new, new
        return pd.DataFrame(found, columns=["low", "high"]).astype("int64") if found else nothing

    bytesets.ship(buckets.sparkSession)
    dealt = asked.select(*columns).unionByName(asking.select(*columns)).repartition(
        session.shuffle_width(buckets.sparkSession), "band", "row", "column")
    return dealt.groupBy("band", "row", "column").applyInPandas(compare, "low long, high long").distinct()


def node_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, codes): the shingle hashes of the wanted nodes as bytes, stored."""
    rows = bytesets.only(docs, doc_id="bigint", text="string")
    texts = wanted.join(nodes.select("node", "doc_id"), "node").join(rows, "doc_id").select("node", "text")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                sets = shingle_sets(*bytesets.texts_of(part.column("text")), shingle)
                own = np.array([int(node_of(s)) if len(s) else 0 for s in sets], np.int64)
                mask = own == np.asarray(part.column("node"), np.int64)
                codes = [s.tobytes() for s, m in zip(sets, mask, strict=True) if m]
                yield pa.RecordBatch.from_arrays([pa.array(own[mask]), pa.array(codes, pa.binary())], names=["node", "codes"])

    return session.cut_lineage(bytesets.map_arrow(texts, coded, "node long, codes binary").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, docs: DataFrame, of_node: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (low, high) that are linked by their full sets; ``of_node`` has one doc_id for each node."""
    ends = pairs.select(F.explode(F.array("low", "high")).alias("node")).distinct()
    wanted = ends.join(of_node, "node").select("node", "doc_id", "n_shingles")
    rows = bytesets.only(docs, doc_id="bigint", text="string")
    # One doc_id may have several texts; the node's own is the one whose set has the node's digest.
    texts = session.cut_lineage(_with_node(wanted.join(rows, "doc_id").select("node", "text"), shingle))
    both = (
        pairs.select("low", "high").join(texts.select(F.col("node").alias("high"), F.col("text").alias("high_text")), "high")
        .join(texts.select(F.col("node").alias("low"), F.col("text").alias("low_text")), "low")
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            for part in bytesets.slices(batch.select(["low", "high", "low_text", "high_text"]), "high_text"):
                lows, highs = part.column("low").to_pylist(), part.column("high").to_pylist()
                sets = shingle_sets(*bytesets.texts_of(part.column("high_text")), shingle)
                keep = []
                for i, (low, own) in enumerate(zip(lows, sets, strict=True)):
                    if low != last:
                        last, last_set = low, shingle_sets(*bytesets.texts_of(part.column("low_text").slice(i, 1)), shingle)[0]
                    shared = len(np.intersect1d(own, last_set, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(own) + len(last_set) - shared))
                mask = np.array(keep, bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(lows, np.int64)[mask]), pa.array(np.array(highs, np.int64)[mask])], names=["low", "high"])

    return bytesets.map_arrow(both, confirm, "low long, high long")


def _with_node(rows: DataFrame, shingle: int) -> DataFrame:
    """Rows (node, text) whose text's set is the node's, once for each node and text."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bytesets.slices(batch, "text"):
                sets = shingle_sets(*bytesets.texts_of(part.column("text")), shingle)
                own = np.array([int(node_of(s)) if len(s) else 0 for s in sets], np.int64)
                yield part.filter(pa.array(own == np.asarray(part.column("node"), np.int64)))

    return bytesets.map_arrow(rows, checked, "node long, text string").dropDuplicates(["node"])


def node_of(codes: np.ndarray) -> np.int64:
    """A digest of a set of shingles."""
    total = (int(bytesets.mixed(codes).sum()) + len(codes) * 0x9E3779B97F4A7C15) % 2**64
    return bytesets.mixed(np.array([total], np.uint64)).view(np.int64)[0]


def joined_components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the edges (low, high): the least node reachable.

    Each round hooks every label to the least neighbouring one and then halves the paths, so the number of rounds
    grows with the logarithm of the longest path. Each round is stored.
    """
    ends = edges.select(F.col("low").alias("node")).union(edges.select(F.col("high").alias("node"))).distinct()
    labels = session.cut_lineage(ends.select("node", F.col("node").alias("label")))
    while True:
        low = labels.select(F.col("node").alias("low"), F.col("label").alias("a"))
        high = labels.select(F.col("node").alias("high"), F.col("label").alias("b"))
        crossing = edges.join(low, "low").join(high, "high").where("a <> b").select(
            F.greatest("a", "b").alias("label"), F.least("a", "b").alias("parent"))
        hooks = session.cut_lineage(crossing.groupBy("label").agg(F.min("parent").alias("parent")))
        if hooks.isEmpty():
            return labels
        while True:
            above = hooks.select(F.col("label").alias("parent"), F.col("parent").alias("grand"))
            jumped = session.cut_lineage(hooks.join(above, "parent", "left").select(
                "label", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")))
            hooks = jumped.select("label", "parent")
            if jumped.where("moved").isEmpty():
                break
        labels = session.cut_lineage(labels.join(hooks, "label", "left").select("node", F.coalesce("parent", "label").alias("label")))


def _crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    low = labels.select(F.col("node").alias("low"), F.col("label").alias("a"))
    high = labels.select(F.col("node").alias("high"), F.col("label").alias("b"))
    return pairs.join(low, "low", "left").join(high, "high", "left").where(
        F.coalesce("a", "low") != F.coalesce("b", "high")).select(*pairs.columns)


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (whether it is the one that stays)."""
    return _placed(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _placed(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, text_hash, chosen) per row: ``chosen`` is the node that its component keeps."""
    rows = session.cut_lineage(prepared(docs, shingle))
    known = rows.where("doc_id IS NOT NULL AND node IS NOT NULL")
    nodes = session.cut_lineage(known.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    of_node = nodes.select("node", "doc_id", "n_shingles")
    all_buckets = nodes.select("node", F.explode("bands").alias("band"))
    full = all_buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = session.cut_lineage(all_buckets.join(full, "band", "left_semi"))

    stars = session.cut_lineage(star_pairs(buckets, nodes, percent))
    # The likeliest pair of each node, then the pairs that still join two components, then what no centre has seen.
    # A pair that was looked at is decided; one inside a component changes nothing.
    first = stars.groupBy("high").agg(F.min_by("low", F.struct("differing", "low")).alias("low"))
    looked = session.cut_lineage(first.select("low", "high"))
    edges = session.cut_lineage(confirmed(looked, docs, of_node, percent, shingle))
    labels = joined_components(edges)
    left = session.cut_lineage(_crossing(stars.select("low", "high").join(looked, ["low", "high"], "left_anti"), labels))
    if not left.isEmpty():
        edges = session.cut_lineage(edges.unionByName(confirmed(left, docs, of_node, percent, shingle)))
        labels = joined_components(edges)
    links = session.cut_lineage(rest_links(buckets, nodes, labels, docs, percent, shingle))
    if not links.isEmpty():
        labels = joined_components(edges.unionByName(links))

    least = labels.join(of_node, "node").groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    of_label = labels.join(least, "label").select("node", "least")
    alone = of_node.join(of_label, "node", "left").select(
        "node", F.coalesce("least.doc_id", "doc_id").alias("component_id"), F.coalesce("least.node", "node").alias("chosen"))
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", "node", "text_hash").join(alone, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), "node", "text_hash", "chosen")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all columns of ``docs``: of the least doc_id's texts in it, one row of one.

    Rows with a null doc_id stay. A doc_id may keep several rows if its texts are in several groups; texts without
    words are in no group and go only as repeats of one doc_id and text.
    """
    wanted = F.col(f"`{text}`").try_cast("string")
    plain = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), wanted.alias("text"))
    placed = _placed(plain, shingle, percent)
    of_groups = placed.where("node = chosen AND doc_id = component_id").groupBy("doc_id", "node").agg(F.min("text_hash").alias("text_hash"))
    wordless = placed.where("node IS NULL AND doc_id IS NOT NULL").select("doc_id", "text_hash").distinct()
    kept = of_groups.select("doc_id", "text_hash").unionByName(wordless).select(
        F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text"))
    number = bytesets.free_name(docs, "row_in_group")
    once = Window.partitionBy(F.col(f"`{key}`"), F.xxhash64(wanted)).orderBy(F.xxhash64(wanted))
    known = docs.where(F.col(f"`{key}`").isNotNull())
    chosen = known.join(
        kept, (known[key].cast("bigint") == F.col("_kept_id")) & (F.xxhash64(wanted) == F.col("_kept_text")), "left_semi")
    chosen = chosen.withColumn(number, F.row_number().over(once)).where(F.col(number) == 1).drop(number)
    return chosen.unionByName(docs.where(F.col(f"`{key}`").isNull()))
