"""Near-duplicate documents: BagMinHash signatures of shingle multisets, banded, verified and joined into classes.

The multiset of a text are its runs of five words. Two texts are linked when the weighted Jaccard similarity of their
multisets (shared count over joint count) is 0.8 or more; classes are the connected components of the links.

Signatures. Every (shingle, unit of its count) is a Poisson process in time whose points fall on random components; the
component's value is the earliest point over the whole multiset, so two signatures agree in a component with probability
equal to the weighted Jaccard similarity. Counts are discretised hierarchically: the units 1, 2, 3-4, 5-8, ... form
blocks with one process each at the summed rate, and the bits of a point's hash halve its block down to a unit, where the
point counts if the unit is within the shingle's count. Points later than a bound that fills all components need not be
made; the bound is raised for the few texts with an empty component left.

Links. Texts with equal multisets are one node. 36 bands of 7 components give buckets; a pair of similarity 0.8 misses
all of them with probability 0.0002. Each bucket has a hub, its node that shares most buckets with others. A node is
compared with the most central of its hubs, and nodes that this leaves without any link with their next one: first by
weight and by a 252-bit digest of the signature, then exactly on the texts. So there is about one comparison for each node,
however large its group, and most of a group of copies is connected then. The nodes that are not in the component of one of
their hubs are compared exactly with all other nodes of that hub, in blocks, and with the hub itself unless that was done
before: every pair of a bucket ends up compared or connected, without a cap, and only links are written out, one for each two
components and block.

Defined results: a text of one to four words is one shingle; texts without a word are linked if they are equal; a null
text is a class of its own. Rows are classed by their own text, whatever doc_id they share; the class of rows without a
doc_id is null. One row of a class is kept, also of rows that are equal in doc_id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import on_workers, table, written
from palaver.llm.words import hashed, mix, plain_array, shingles, sliced, string_buffers, words_of

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 36, 7
COMPONENTS = BANDS * ROWS
# Of 252 digest bits, a pair of similarity 0.8 differs in 25 on average, with a deviation of 4.8.
DIFFERENT_BITS = 52
# Hubs of its own that a node without a link is compared with, one after the other, before blocks.
TURNS = 2
# Pairs that one group of a verification holds, about.
PAIRS_TOGETHER = 256
# Nodes outside a hub's component, and nodes of the hub, that one block compares, about.
OUTSIDE, ALL = 128, 1024
_NEVER = np.float64(np.inf)


def multisets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle (52-bit hash) and count, sorted by text and shingle; at most 4096 texts."""
    values, first = shingles(words_of(texts), SHINGLE)
    text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    both, count = np.unique(text << np.uint64(52) | values >> np.uint64(12), return_counts=True)
    return (both >> np.uint64(52)).astype(np.int64), both & np.uint64((1 << 52) - 1), count


def _arrivals(
    text: np.ndarray, state: np.ndarray, rate: np.ndarray, low: np.ndarray, count: np.ndarray, until: np.ndarray,
    best: np.ndarray,
) -> None:
    """Make the points of all processes up to the time ``until`` of their text, and keep the earliest per component."""
    time, made = np.zeros(len(text)), 0
    while len(text):
        k = int(np.clip(20_000 // len(text), 1, 512))
        draw = hashed(state[:, None] + np.arange(made + 1, made + k + 1, dtype=np.uint64), 11)
        made += k
        gap = ((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
        if made == 1:  # most processes end here: compare before taking logarithms
            keep = np.flatnonzero(gap[:, 0] >= np.exp(-until[text] * rate) * (1 - 1e-12))
            text, state, rate, low, count = text[keep], state[keep], rate[keep], low[keep], count[keep]
            time, draw, gap = time[keep], draw[keep], gap[keep]
        at = -np.log(gap) / rate[:, None]
        at[:, 0] += time
        at = np.cumsum(at, axis=1)
        where = hashed(draw, 12)
        component = ((where >> np.uint64(32)) * np.uint64(COMPONENTS) >> np.uint64(32)).astype(np.int64)
        # Units low + 1 .. 2 * low of the block (unit 1 where low is 0): the bits of the hash halve it down to one.
        unit = low[:, None] + 1 + (where.astype(np.int64) & np.maximum(low - 1, 0)[:, None])
        hit = (at <= until[text][:, None]) & (unit <= count[:, None])
        np.minimum.at(best, (text[:, None] * COMPONENTS + component)[hit], at[hit])
        time = at[:, -1]
        keep = np.flatnonzero(time <= until[text])
        text, state, rate, low, count, time = text[keep], state[keep], rate[keep], low[keep], count[keep], time[keep]


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """(n, COMPONENTS) earliest times; a text without shingles keeps infinity."""
    best = np.full(n * COMPONENTS, _NEVER)
    weight = np.bincount(text, count, minlength=n)
    until = (np.log(COMPONENTS) + 3) / np.maximum(weight, 1)
    open_texts = np.flatnonzero(weight)
    while len(open_texts):
        chosen = np.zeros(n, bool)
        chosen[open_texts] = True
        part = np.flatnonzero(chosen[text])
        low = 0
        while len(part):
            state = hashed(shingle[part] * np.uint64(64) + np.uint64(low.bit_length()), 10)
            fill = np.full(len(part), low, np.int64)
            _arrivals(
                text[part], state, np.full(len(part), float(COMPONENTS * max(low, 1))), fill, count[part], until, best
            )
            low = 1 if low == 0 else low * 2
            part = part[count[part] > low]
        filled = np.isfinite(best.reshape(n, COMPONENTS)[open_texts]).all(1)
        open_texts = open_texts[~filled]
        until[open_texts] *= 2
    return best.reshape(n, COMPONENTS)


def _copy_keys(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: pa.Array) -> list[bytes | None]:
    """128-bit key of each multiset; of the text itself where that has no words."""
    n, sums = len(texts), []
    first = np.searchsorted(text, np.arange(n))
    filled = np.flatnonzero(np.bincount(text, minlength=n))
    for salt in (21, 22):
        total = np.zeros(n, np.uint64)
        if len(filled):
            total[filled] = np.add.reduceat(mix(hashed(shingle, salt) + count.astype(np.uint64)), first[filled])
        sums.append(total)
    raw = np.stack(sums, 1).astype(">u8").tobytes()
    keys: list[bytes | None] = [raw[16 * i : 16 * i + 16] for i in range(n)]
    for i in set(range(n)) - set(filled.tolist()):
        value = texts[i].as_py()
        keys[i] = None if value is None else hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=15).digest()
    return keys


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        texts, n = batch.column("text"), batch.num_rows
        text, shingle, count = multisets(texts)
        times = signatures(text, shingle, count, n).astype(np.float32)
        bits = times.view(np.uint32).astype(np.uint64)
        band = np.zeros((n, BANDS), np.uint64)
        for r in range(ROWS):
            band = mix(band * np.uint64(31) + bits[:, r::ROWS])
        band = hashed(band + np.arange(BANDS, dtype=np.uint64), 13)
        weight = np.bincount(text, count, minlength=n).astype(np.int64)
        digest = np.zeros((n, 256), np.uint8)
        digest[:, :COMPONENTS] = mix(bits + np.uint64(1)) & np.uint64(1)
        digest = np.packbits(digest, axis=1).view(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.where(weight > 0, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("key"), pa.array(_copy_keys(text, shingle, count, texts), pa.binary()), pa.array(weight),
                *[pa.array(np.ascontiguousarray(digest[:, i])) for i in range(4)],
                pa.ListArray.from_arrays(offsets, pa.array(band[weight > 0].reshape(-1).view(np.int64))),
            ],
            names=["doc_id", "key", "copy", "weight", "d0", "d1", "d2", "d3", "bands"],
        )


def _key() -> Column:
    """128-bit key of doc_id and text; null for a null text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), F.col("text"))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, key of doc_id and text, key of equal multisets, size of the multiset, digest and band hashes."""
    return on_workers(docs).select("doc_id", "text", _key().alias("key")).mapInArrow(
        _fingerprint,
        "doc_id long, key binary, copy binary, weight long, d0 long, d1 long, d2 long, d3 long, bands array<long>",
    )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hub and group, the hub's text first; similar pairs go out."""
    hub = None
    for batch in sliced(batches, "text"):
        text, shingle, count = multisets(batch.column("text"))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        nodes, hubs = batch.column("node").to_numpy(), batch.column("hub").to_numpy()
        weight = np.bincount(text, count, minlength=batch.num_rows)
        found = []
        for i in range(batch.num_rows):
            mine = shingle[cut[i] : cut[i + 1]], count[cut[i] : cut[i + 1]], weight[i]
            if nodes[i] == hubs[i]:
                hub = mine
                continue
            at = np.minimum(np.searchsorted(hub[0], mine[0]), len(hub[0]) - 1)
            same = hub[0][at] == mine[0]
            shared = np.minimum(hub[1][at][same], mine[1][same]).sum()
            if shared >= SIMILAR * (hub[2] + mine[2] - shared) - 1e-9:
                found.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[found]), pa.array(hubs[found])], names=["node", "hub"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (node, hub) whose texts (node, text) are similar. A hub with many partners is dealt to several groups."""
    many = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PAIRS_TOGETHER).alias("groups"))
    pairs = pairs.join(many, "hub").withColumn("part", F.pmod(F.xxhash64("node"), F.col("groups"))).drop("groups")
    hubs = pairs.select("hub", "part").distinct().withColumn("node", F.col("hub"))
    both = pairs.select("hub", "part", "node").unionByName(hubs).join(texts, "node")
    dealt = both.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("node") != F.col("hub"), "node")
    return on_workers(dealt).select("hub", "node", "text").mapInArrow(_verify, "node long, hub long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, its outside nodes first; one link for each two components goes out."""
    block, left, seen = None, [], set()
    shingle_all = row_all = count_all = weights = None
    for batch in sliced(batches, "text"):
        text, shingle, count = multisets(batch.column("text"))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        weight = np.bincount(text, count, minlength=batch.num_rows)
        keys = zip(*[batch.column(c).to_pylist() for c in ("hub", "ob", "xb", "right", "node", "label")])
        found = []
        for i, (hub, ob, xb, right, node, label) in enumerate(keys):
            mine = shingle[cut[i] : cut[i + 1]], count[cut[i] : cut[i + 1]]
            if block != (hub, ob, xb):
                block, left, seen, shingle_all = (hub, ob, xb), [], set(), None
            if not right:
                left.append((node, label, *mine, weight[i]))
                continue
            if not left:
                continue
            if shingle_all is None:
                shingle_all = np.concatenate([x[2] for x in left])
                order = np.argsort(shingle_all, kind="stable")
                shingle_all = shingle_all[order]
                row_all = np.repeat(np.arange(len(left)), [len(x[2]) for x in left])[order]
                count_all, weights = np.concatenate([x[3] for x in left])[order], np.array([x[4] for x in left])
            low = np.searchsorted(shingle_all, mine[0], side="left")
            n = np.searchsorted(shingle_all, mine[0], side="right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared = np.bincount(
                row_all[at], np.minimum(count_all[at], np.repeat(mine[1], n)), minlength=len(left)
            )
            for k in np.flatnonzero(shared >= SIMILAR * (weights + weight[i] - shared) - 1e-9):
                pair = (min(left[k][1], label), max(left[k][1], label))
                if left[k][1] != label and pair not in seen:
                    seen.add(pair)
                    found.append((left[k][0], node))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
            names=["node", "hub"],
        )


def compared(family: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the nodes of a hub (node, hub, settled) that are outside its component and all others of its buckets.

    The hub itself is among these where a node outside is not ``settled`` with it, that is, not compared exactly before.
    """
    of_hub = labels.select(F.col("node").alias("hub"), F.col("label").alias("_hub_label"))
    named = family.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = named.join(of_hub, "hub", "left").withColumn("hub_label", F.coalesce("_hub_label", "hub"))
    outside = F.col("label") != F.col("hub_label")
    named = written(named.select("hub", "node", "label", "hub_label", "settled", outside.alias("outside")), "named")
    blocks = named.groupBy("hub").agg(
        F.count_if("outside").alias("apart"), F.count(F.lit(1)).alias("size"), F.first("hub_label").alias("hub_label"),
        F.count_if(F.col("outside") & ~F.col("settled")).alias("open"),
    ).filter("apart > 0 AND (size > 1 OR open > 0)").select(
        "hub", "hub_label", (F.col("open") > 0).alias("open"), F.ceil(F.col("apart") / OUTSIDE).alias("obs"),
        F.ceil((F.col("size") + 1) / ALL).alias("xbs"),
    )
    blocks = written(blocks, "blocks")
    itself = blocks.filter("open").select(
        "hub", F.col("hub").alias("node"), F.col("hub_label").alias("label"), F.lit(False).alias("outside"), "obs", "xbs"
    )
    named = named.drop("hub_label", "settled").join(blocks.drop("hub_label", "open"), "hub").unionByName(itself)
    ob, xb = F.pmod(F.xxhash64("node"), F.col("obs")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("xbs"))
    every_o, every_x = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("obs", "xbs"))
    node = ["hub", "node", "label"]
    left = named.filter("outside").select(*node, ob.alias("ob"), every_x.alias("xb"), F.lit(False).alias("right"))
    right = named.select(*node, every_o.alias("ob"), xb.alias("xb"), F.lit(True).alias("right"))
    both = left.unionByName(right).join(texts, "node")
    dealt = both.repartition("hub", "ob", "xb").sortWithinPartitions("hub", "ob", "xb", "right", "node")
    return on_workers(dealt).select("hub", "ob", "xb", "right", "node", "label", "text").mapInArrow(
        _compare, "node long, hub long"
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (node, hub): the lowest node of each connected component.

    Rounds of taking the lowest label among neighbours and then that label's own label; each round is written.
    """
    both = written(edges.unionByName(edges.selectExpr("hub AS node", "node AS hub")).distinct(), "edges")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("hub")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("hub"), "label"), "hub").groupBy("node").agg(
            F.min("label").alias("_near")
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "_near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("_jump"))
        moved = written(
            lower.join(jump, "label", "left").select("node", "old", F.least("label", "_jump").alias("label")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def _fits(a: str, b: str) -> Column:
    """Whether the weights of two nodes let them be similar; exact."""
    wa, wb = F.col(f"{a}.weight"), F.col(f"{b}.weight")
    return F.least(wa, wb) >= SIMILAR * F.greatest(wa, wb) - 1e-9


def _close(a: str, b: str) -> Column:
    """Whether two nodes look similar, by weights and digests."""
    different = sum((F.bit_count(F.col(f"{a}.d{i}").bitwiseXOR(F.col(f"{b}.d{i}"))) for i in range(4)), F.lit(0))
    return _fits(a, b) & (different <= DIFFERENT_BITS)


def row_classes(docs: DataFrame) -> DataFrame:
    """doc_id, key, class_id and kept of every row: class_id is the lowest doc_id of the class.

    One row of a class is kept, of the lowest doc_id and then the lowest key.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = written(fingerprints(docs).withColumn("row", F.monotonically_increasing_id()), "prints")
    known = prints.filter(F.col("copy").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "row")).alias("first")
    node_of = known.groupBy("copy").agg(first).withColumn("node", F.monotonically_increasing_id())
    node_of = written(node_of, "copies")
    nodes = known.join(node_of.select("node", F.col("first.row").alias("row")), "row")
    nodes = written(nodes.drop("doc_id", "copy", "row"), "nodes")
    info = nodes.drop("bands", "key")
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(rows.join(written(sizes, "buckets"), "bucket"), "members")
    central = members.groupBy("node").agg(F.sum("size").alias("_score"))
    top = F.max(F.struct("_score", (-F.col("node")).alias("_low"), "node"))
    hubs = members.join(written(central, "scores"), "node").groupBy("bucket").agg(top.alias("_top")).select(
        "bucket", F.col("_top.node").alias("hub"), F.col("_top._score").alias("_central")
    )
    family = members.join(written(hubs, "hubs"), "bucket").filter("node <> hub").select("node", "hub", "_central").distinct()
    turn = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("_central"), "hub"))  # 36 rows at most
    family = written(family.select("node", "hub", turn.alias("turn")), "family")
    met = family.alias("p").join(info.alias("a"), F.col("p.node") == F.col("a.node")).join(
        info.alias("b"), F.col("p.hub") == F.col("b.node")
    ).select("p.node", "p.hub", "turn", _fits("a", "b").alias("fits"), _close("a", "b").alias("close"))
    family = written(met, "met")
    involved = nodes.select("node", "key").join(members.select("node").distinct(), "node", "left_semi")
    texts = docs.select(_key().alias("key"), "text").join(involved, "key").select("node", "text")
    texts = written(texts.dropDuplicates(["node"]), "texts")

    edges = seen = None
    for k in range(TURNS):
        star = family.filter((F.col("turn") == k + 1) & F.col("close")).select("node", "hub")
        if edges is not None:
            linked = edges.select("node").union(edges.select("hub")).distinct()
            star = star.join(linked, "node", "left_anti")
        star = written(star, "star")
        found = written(verified(star, texts), "linked")
        edges = found if edges is None else edges.unionByName(found)
        seen = star if seen is None else seen.unionByName(star)
    labels = written(components(edges), "first")

    # Pairs of a node and a hub that no turn took up, or that the digest alone kept apart, are still open.
    done = family.join(seen.withColumn("_seen", F.lit(True)), ["node", "hub"], "left")
    settled = ~F.col("fits") | F.coalesce("_seen", F.lit(False))
    late = written(compared(done.select("node", "hub", settled.alias("settled")), labels, texts), "linked")
    joined = edges.unionByName(late)
    labels = labels if late.isEmpty() else written(components(joined), "second")

    labelled = node_of.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = written(labelled.select("copy", "label", "first"), "labelled")
    best = labelled.groupBy("label").agg(F.min("first").alias("best"))
    of_copy = written(labelled.drop("first").join(best, "label").select("copy", "best"), "classes")
    found = known.select("doc_id", "key", "row", "copy").join(of_copy, "copy").select(
        "doc_id", "key", F.col("best.doc_id").alias("class_id"), (F.col("row") == F.col("best.row")).alias("kept")
    )
    alone = prints.filter(F.col("copy").isNull())
    return found.unionByName(alone.select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every row: class_id is the lowest doc_id of the class."""
    return row_classes(docs).select("doc_id", "class_id")


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Class of every document: doc_id, class_id, kept (the row of the lowest doc_id of a class)."""
    return row_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, that with the lowest doc_id; of rows equal in doc_id and text, any one of them.

    The texts are shuffled once: the rows that go are taken away, and repeated ones dropped where that has placed them.
    """
    rows = row_classes(docs).filter("key IS NOT NULL").groupBy("key").agg(F.max("kept").alias("_stays"))
    taken = {c.lower() for c in docs.columns}
    own = next(n for n in (f"_key{i}" for i in range(len(taken) + 1)) if n not in taken)
    gone = written(rows.filter("NOT _stays").select(F.col("key").alias(own)), "gone")
    # Rows without a text are classes of their own and have no key.
    keyed = docs.filter("text IS NOT NULL").withColumn(own, _key())
    once = keyed.join(gone, own, "left_anti").dropDuplicates([own])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.filter("text IS NULL"))
