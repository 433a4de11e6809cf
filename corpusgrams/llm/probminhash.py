"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A document's shingles are its runs of five words (fewer words: all of them as
one shingle), each with weight 1 however often it occurs.  In a ProbMinHash each shingle sends a
Poisson process of arrivals at a rate of its weight, each to a random component;
a component keeps the shingle that arrives first.  Two documents agree in a
component with their probability Jaccard similarity: for equal weights the
Jaccard similarity, which is what is verified.  A document is done as soon as no shingle's next arrival
can come before the last component's first one.

``BANDS`` bands of five components make buckets.  Equal texts are one node, so a
hot text is one row from here on.  Within a bucket not all pairs are listed: the
member that shares most bucket places (the likely original) is the centre, and the
others are compared with it; links are verified on the whole shingle sets (Jaccard
of at least ``SIMILAR``); whoever is then in one class needs no more comparison.
Centres leave their buckets and the rest goes on, the least connected members as
centres now and ``GROWTH`` times as many each round, until each bucket's members
are of one class or all compared.  A pair is not verified only where it cannot be a
link: by the sizes of the shingle sets, or because the parities of the shingles in
``GROUPS`` groups differ in so many groups that too few shingles can be shared (a
group of unequal parities holds a shingle of one text alone).  Both bounds are
exact and no cap loses any.  Classes are connected components, by label
propagation with pointer jumping, in tables throughout.

Near copies that are edited so much that they are no longer similar to most of
their group need comparisons with all of it: these are the pairs that grow.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefilter import asked_bits, may_be_asked
from ..session import cut_lineage
from .common import FILTER_BITS, documents, drop_unused, fresh, saved_table, small_arrow_batches, text_slices, without
from .words import Words

SHINGLE = 5
SIMILAR = 0.8
GROWTH = 8
BANDS, COMPONENTS = 24, 120  # a pair of similarity 0.8 shares a bucket with probability 0.9999
GROUPS = 512  # a power of two
SLICE = 1 << 20  # bytes of text that a task has shingles of at a time


# --- shingles and signatures (numpy, inside tasks) ------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of every distinct shingle of each text, by text."""
    import xxhash

    w = Words(texts)
    n = len(w.start)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    distinct = np.empty(int(w.ids.max()) + 1, np.uint64)
    first = np.unique(w.ids, return_index=True)[1]
    distinct[:] = [xxhash.xxh3_64_intdigest(w.strings[i]) for i in first.tolist()]
    word = distinct[w.ids]
    size = np.minimum(w.per_text, SHINGLE)  # words of a shingle, by text
    left = (w.first + w.per_text)[w.text] - np.arange(n)  # words from here to the text's end
    begin = np.flatnonzero((left >= SHINGLE) | (np.arange(n) == w.first[w.text]))
    of = w.text[begin]
    h = np.full(len(begin), 0x1234567, np.uint64)
    for k in range(SHINGLE):
        there = size[of] > k
        at = np.minimum(begin + k, n - 1)
        h = np.where(there, mix(h) + word[at], h)
    h = mix(h)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], h[at], np.diff(np.append(at, len(h)))


def signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int,
               size: int = COMPONENTS) -> np.ndarray:
    """ProbMinHash: (n_docs, size) elements; rows of documents without elements are 0."""
    arrival = np.full((n_docs, size), np.inf)
    winner = np.zeros((n_docs, size), np.uint64)
    last = np.full(n_docs, np.inf)  # when the latest component had its first arrival
    h = np.zeros(len(of))
    step = 0
    while len(of):
        r = mix(element + np.uint64((0x9E3779B97F4A7C15 * (step + 1)) % 2**64))
        h = h - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        early = h < last[of]  # the others' later arrivals come too late as well
        of, element, weight, h, r = of[early], element[early], weight[early], h[early], r[early]
        k = (mix(r ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64)
        place = of * size + k
        np.minimum.at(arrival.reshape(-1), place, h)
        won = arrival.reshape(-1)[place] == h
        winner.reshape(-1)[place[won]] = element[won]
        docs = np.unique(of) if step else np.arange(n_docs)
        last[docs] = arrival[docs].max(1)
        more = h < last[of]
        of, element, weight, h = of[more], element[more], weight[more], h[more]
        step += 1
    return winner


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(n_docs, bands) bucket keys; equal keys of different bands do not meet."""
    parts = signature.reshape(len(signature), bands, -1)
    h = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    for k in range(parts.shape[2]):
        h = mix(h + parts[:, :, k])
    return h.astype(np.int64)


def sketches(of: np.ndarray, element: np.ndarray, n_docs: int) -> np.ndarray:
    """(n_docs, GROUPS / 64) numbers: whether a text has an odd number of shingles, by group."""
    group = (element >> np.uint64(65 - GROUPS.bit_length())).astype(np.int64)
    odd = (np.bincount(of * GROUPS + group, minlength=n_docs * GROUPS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n_docs, GROUPS), axis=1, bitorder="little").view("<i8")


def _lists(x: np.ndarray, some: np.ndarray) -> pa.ListArray:
    """The rows of ``x`` as lists, empty where not ``some``."""
    ends = np.concatenate([[0], np.cumsum(np.where(some, x.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x[some].ravel()))


def _sign_batches(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for s in text_slices(batch, SLICE):
            of, element, _ = shingles(s.column(at))
            signature = signatures(of, element, np.ones(len(of)), s.num_rows)
            n = np.bincount(of, minlength=s.num_rows)
            # a text without words meets nobody
            lists = [_lists(x, n > 0) for x in (band_keys(signature), sketches(of, element, s.num_rows))]
            rest = [s.column(c) for c in ("uid", "doc_id", "digest")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(n.astype(np.int64)), *lists],
                                             ["uid", "doc_id", "digest", "n", "bands", "sketch"])


def _shingle_batches(batches):
    for batch in batches:
        for s in text_slices(batch, SLICE):
            of, element, _ = shingles(s.column("text"))
            cut = np.searchsorted(of, np.arange(s.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(element.view(np.int64)))
            yield pa.RecordBatch.from_arrays([s.column("node"), lists], ["node", "shingles"])


# --- tables ----------------------------------------------------------------------


SIGNED = ("uid long, doc_id long, digest binary, n long, bands array<long>, sketch array<long>")


def _rows(docs: DataFrame, uid: Column) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(uid.alias("uid"), docs["doc_id"].cast("bigint").alias("doc_id"), text.alias("text"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


MEMBER = ["key", "node", "n", "places", "sketch"]


def _buckets(nodes: DataFrame) -> DataFrame:
    """MEMBER of every bucket place that is shared; ``places``: the sizes of all
    the node's buckets, summed up."""
    places = nodes.select("node", "n", "sketch", F.explode("bands").alias("key"))
    sizes = cut_lineage(places.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    shared = places.join(sizes, "key")
    central = shared.groupBy("node").agg(F.sum("size").alias("places"))
    return cut_lineage(shared.drop("size").join(central, "node").select(*MEMBER))


def most_common(n: Column, sketch: Column, other: Column) -> Column:
    """How many shingles two texts of ``n`` shingles together can share: each
    group of unequal parities has one that is not shared."""
    unequal = F.zip_with(sketch, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return (n - F.aggregate(unequal, F.lit(0), lambda s, x: s + x)) / 2


def _texts_of(nodes: DataFrame, rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """node, shingles of the nodes that share a bucket, from whole texts.

    Texts whose bit is not set in a bitmap of the wanted digests stay where they
    are; of the others each task hands over one text a digest, so that neither a
    hot text nor repeated rows are gathered."""
    wanted = cut_lineage(buckets.select("node").distinct().join(nodes.select("node", "digest"), "node"))
    bits = asked_bits(wanted.select("digest"), FILTER_BITS)
    some = rows.filter(may_be_asked(bits, rows["digest"], bits=FILTER_BITS)).groupBy("digest").agg(
        F.first("text").alias("text"))
    found = some.join(wanted, "digest").select("node", "text")
    return saved_table(found.mapInArrow(_shingle_batches, "node long, shingles array<long>"))


def is_link(n: Column, common: Column) -> Column:
    """Of sets of ``n`` elements together, ``common`` of them in both (more can only help)."""
    return common >= SIMILAR * (n - common)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of SIMILAR or more."""
    of = lambda side: texts.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter(is_link(F.size("a_set") + F.size("b_set"), common)).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label (the component's smallest node) of all nodes in ``links`` (a, b).

    Each round gives a node the smallest label around it, then lets labels
    follow labels, until nothing changes."""
    edges = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node")
    labels = cut_lineage(labels)
    while True:
        around = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = cut_lineage(labels.join(around.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")))
        top = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = cut_lineage(lower.join(top, "label").select("node", "before", F.least("label", "top").alias("label")))
        labels = new.select("node", "label")
        if not new.filter("label <> before").take(1):
            return labels
        del around, lower, top, new
        drop_unused(links.sparkSession)


class Links:
    """What is known so far: verified links, the pairs compared, labels of linked nodes."""

    def __init__(self):
        self.links: list[DataFrame] = []
        self.tested: list[DataFrame] = []
        self.labels: DataFrame | None = None  # node, label
        self.n_links = self.n_labelled = 0  # so many links are known; labels are of so many

    def add(self, new: DataFrame) -> None:
        """Labels are made anew when a twentieth of the links is new: older ones
        join too little, which costs comparisons but no link."""
        n = new.count()
        if n:
            self.links.append(new)
            self.n_links += n
        if (self.n_links - self.n_labelled) * 20 > self.n_links:
            self.label()

    def label(self) -> None:
        if self.n_labelled < self.n_links:
            self.labels = components(functools.reduce(DataFrame.unionByName, self.links))
            self.n_labelled = self.n_links


def _link_buckets(buckets: DataFrame, texts: DataFrame, known: Links) -> None:
    """Compare within the buckets until no member of one class is left
    uncompared with one of another."""
    left = buckets
    for turn in range(64):
        labels = known.labels
        if labels is None:
            now = left.withColumn("class", F.col("node"))
        else:
            now = left.join(labels, "node", "left").select(*MEMBER, F.coalesce("label", "node").alias("class"))
        salt = F.pmod(F.xxhash64("node"), F.lit(min(GROWTH**turn, 2**40)))
        rank = F.col("places") if turn == 0 else -F.col("places")
        best = F.max(F.struct(rank.alias("rank"), "node", "class", "n", "sketch"))
        some = now.groupBy("key", salt.alias("salt")).agg(
            best.alias("centre"), F.min("class").alias("low"), F.max("class").alias("high"))
        centres = cut_lineage(
            some.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                    F.collect_list("centre").alias("centres"))  # GROWTH**turn at most
            .filter("low <> high").select("key", "centres"))
        if not centres.take(1):
            return
        drop_unused(buckets.sparkSession)  # what the round before and the labels wrote
        met = now.join(centres, "key")
        able = F.filter("centres", lambda c: (c["class"] != F.col("class"))
                        & (F.least("n", c["n"]) >= SIMILAR * F.greatest("n", c["n"]))  # else their similarity is lower
                        & is_link(F.col("n") + c["n"], most_common(F.col("n") + c["n"], F.col("sketch"), c["sketch"])))
        pairs = met.select("node", F.explode(F.transform(able, lambda c: c["node"])).alias("c")).select(
            F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
        if known.tested:
            pairs = pairs.join(functools.reduce(DataFrame.unionByName, known.tested), ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        known.tested.append(pairs)
        known.add(cut_lineage(verified(pairs, texts)))
        left = cut_lineage(met.filter(~F.exists("centres", lambda c: c["node"] == F.col("node"))).select(*MEMBER))
    raise RuntimeError("buckets are left after 64 rounds")  # the centres of a round grow without bound


def near_classes(rows: DataFrame) -> DataFrame:
    """uid, doc_id, class_id, class_size, kept of every row (uid, doc_id, text, digest)."""
    small_arrow_batches(rows.sparkSession)
    signed = cut_lineage(rows.mapInArrow(_sign_batches, SIGNED))
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("uid"))
    nodes = signed.groupBy("digest").agg(F.min(best).alias("best"), F.first("n").alias("n"), F.first("bands").alias("bands"),
                                         F.first("sketch").alias("sketch"),
                                         F.count(F.lit(1)).alias("copies"))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    buckets, known = _buckets(nodes), Links()
    if buckets.take(1):
        _link_buckets(buckets, _texts_of(nodes, rows, buckets), known)
        known.label()
    labels = known.labels
    member = nodes.select("node", "digest", "best", "copies")
    if labels is None:
        member = member.withColumn("class", F.col("node"))
    else:
        member = member.join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    member = cut_lineage(member.select("digest", "class", "best", "copies"))
    classes = cut_lineage(member.groupBy("class").agg(F.min("best").alias("top"), F.sum("copies").alias("class_size")))
    of = cut_lineage(member.join(classes, "class").select("digest", "top", "class_size"))
    return signed.select("uid", "doc_id", "digest").join(of, "digest").select(
        "uid", "doc_id", F.col("top.id").alias("class_id"), "class_size", (F.col("uid") == F.col("top.uid")).alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, kept: one row per document.

    ``class_id`` is the smallest doc_id (null last) of the documents linked,
    directly or through others; that one stays.  Null texts count as empty;
    equal texts are always one class, texts without words otherwise alone.
    Repeated rows are members of their class like others, one of them stays.
    Other columns are ignored, an empty table gives no rows.
    """
    return near_classes(_rows(docs, F.monotonically_increasing_id())).drop("uid")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    uid = fresh(docs, "row_uid")
    table = saved_table(docs.withColumn(uid, F.monotonically_increasing_id()))
    gone = cut_lineage(near_classes(_rows(table, F.col(uid))).filter("NOT kept").select(F.col("uid").alias(uid)))
    return without(table, gone, uid).drop(uid)


# --- registered query --------------------------------------------------------


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
