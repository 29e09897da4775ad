"""Near-duplicate documents by an LSH forest of MinHash signatures.

Each tree sorts the distinct shingle sets by a signature path of its own. Neighbours that
share the first HEAD hash values are candidates, and the sorted order puts those with the
longest common prefix next to each other: where a region is sparse the prefix of HEAD values
decides, where it is dense the SPAN nearest rows, which agree on more values, so depth follows
density. Candidates are compared on their full sets, which are computed again from the text.
Regions of more than SPAN rows that these links do not make one component are searched in
full: a prefix filter over their rarest shingles finds every link between two components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import columns_of, components
from orebed.llm.words import forget
from orebed.session import durable

#: Hash values of a path that neighbours must share, and further ones that order them.
HEAD, TAIL = 3, 4
#: Sorted rows that are compared all with all, together with as many before them.
SPAN = 1024
#: Shared shingles, and rows of the comparison, that are held as a matrix at once.
STRIPE = 512
#: Share of linked pairs at the threshold that no tree may bring together.
MISSED = 1e-4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def trees_for(similarity: float) -> int:
    """Trees needed so that a pair at the threshold shares a head in one of them."""
    return math.ceil(math.log(MISSED) / math.log(1 - similarity**HEAD))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a whole text's distinct shingles of so many words.

    A-Z count as lower case, words are split at ASCII white space. Fewer words make one
    shingle; no words, none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(words, len(found))
    out = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = _mixed(out * _MIX + hashes[k : k + len(out)])
    return np.unique(out)


@lru_cache(maxsize=4)
def _lenders(bins: int) -> np.ndarray:
    """For each bin the order in which an empty one asks the others for a value, itself first."""
    order = np.random.default_rng(bins).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)
    return np.concatenate([np.arange(bins)[:, None], order], axis=1)


def paths(hashes: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Head and tail of a non-empty set's path in each tree, by one-permutation MinHash."""
    bins = trees * (HEAD + TAIL)
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(bin_of, np.arange(bins))  # hashes are sorted: the first is the smallest
    filled = np.zeros(bins, dtype=bool)
    filled[bin_of] = True
    lenders = _lenders(bins)
    source = lenders[np.arange(bins), filled[lenders].argmax(axis=1)]
    values = hashes[first[source]].reshape(trees, HEAD + TAIL)
    head, tail = np.zeros(trees, dtype=np.uint64), np.zeros(trees, dtype=np.uint64)
    for k in range(HEAD):
        head = _mixed(head * _MIX + values[:, k])
    for k in range(HEAD, HEAD + TAIL):
        tail = (tail << np.uint64(16)) | (_mixed(values[:, k]) & np.uint64(0xFFFF))
    return head.view(np.int64), tail.view(np.int64)


def set_digest(hashes: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(hashes.tobytes())


def _signatures(words: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            sizes, digests, heads, tails = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                digests.append(set_digest(found) if len(found) else None)
                head, tail = paths(found, trees) if len(found) else (None, None)
                heads.append(head)
                tails.append(tail)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("name"),
                    batch.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(heads, lists),
                    pa.array(tails, lists),
                ],
                names=["doc_id", "name", "key", "n_shingles", "digest", "heads", "tails"],
            )

    return run


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what links of the full sets connect: 100 |A and B| >= percent |A or B|."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (sizes.sum() - both) else []
    owner, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(starts, len(values)))
    shared = np.repeat(counts > 1, counts)
    column = np.repeat(np.cumsum(counts > 1) - 1, counts)[shared]
    owner = owner[shared]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, STRIPE):
        a, b = np.searchsorted(column, (at, at + STRIPE))
        part = np.zeros((len(sets), STRIPE), dtype=np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        for k in range(0, len(sets), STRIPE):
            both[k : k + STRIPE] += part[k : k + STRIPE] @ part.T
    linked = np.zeros((len(sets), len(sets)), dtype=bool)
    for k in range(0, len(sets), STRIPE):
        some = both[k : k + STRIPE].astype(np.int64)
        linked[k : k + STRIPE] = 100 * some >= percent * (sizes[k : k + STRIPE, None] + sizes[None, :] - some)
    links, waiting = [], np.ones(len(sets), dtype=bool)
    for root in range(len(sets)):
        if waiting[root]:
            waiting[root], reached = False, [root]
            for node in reached:
                new = np.flatnonzero(linked[node] & waiting)
                waiting[new] = False
                links += [(node, int(x)) for x in new]
                reached += new.tolist()
    return links


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        region, held = None, {}

        def links() -> pa.RecordBatch:
            names = list(held)
            pairs = spanning_links(list(held.values()), percent) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([names[p[k]] for p in pairs], pa.string()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("block", "tree", "head")), strict=True)
            for key, digest, text in zip(keys, batch.column("digest").to_pylist(), batch.column("text"), strict=True):
                if key != region:
                    yield links()
                    region, held = key, {}
                if digest not in held:
                    found = shingles(text.as_py(), words)
                    if set_digest(found) == digest:  # the row's own text, whatever the input gives on its second read
                        held[digest] = found
        yield links()

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for i, (digest, text) in enumerate(zip(batch.column("digest").to_pylist(), batch.column("text"), strict=True)):
                found = shingles(text.as_py(), words)
                if set_digest(found) == digest:  # the row's own text, whatever the input gives on its second read
                    rows.append(i)
                    sets.append(found.view(np.int64))
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("digest", "home")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.list_(pa.int64()))], names=["digest", "home", "tokens"])

    return run


def with_text(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Each wanted row, all of different keys, with the text of one of the rows (key, text) of its key.

    A key is a digest of doc_id and text, so rows without a doc_id, or with the same one, do not
    meet each other; of rows that repeat both, one is taken.
    """
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return wanted.join(rows, "key").withColumn("nth", nth).where("nth = 1").drop("nth")


def dense_links(dense: DataFrame, labels: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame | None:
    """All links (a, b) between different components of regions larger than SPAN; None if there is no such region.

    dense holds these regions' rows (tree, head, digest, key), labels the components so far,
    rows the texts by key.
    Shingles are ordered by their number of sets, rarest first. Of two linked sets of sizes
    m and n at least o = percent (m + n) / (100 + percent) shingles are shared, so the first
    shared one has o - 1 shingles behind it in both sets. Passages that a whole region shares
    come last in the order and make no candidates, unless the region's similarity is so close
    to the threshold that a pair's needed overlap is hardly more than the passage.
    """
    homes = dense.join(labels.select(F.col("node").alias("digest"), "component"), "digest", "left")
    homes = durable(homes.withColumn("home", F.coalesce("component", "digest")).drop("component"))
    mixed = homes.groupBy("tree", "head").agg(F.min("home").alias("low"), F.max("home").alias("high")).where("low != high")
    wanted = homes.join(mixed.select("tree", "head"), ["tree", "head"], "left_semi")
    wanted = durable(wanted.select("digest", "key", F.xxhash64("home").alias("home")).distinct())
    if wanted.isEmpty():
        return None
    sets = with_text(wanted, rows).select("digest", "home", "text")
    sets = sets.mapInArrow(_sets(words), "digest string, home long, tokens array<long>").dropDuplicates(["digest"])
    sets = durable(sets.withColumn("node", F.monotonically_increasing_id()))
    tokens = sets.select("node", "home", F.size("tokens").cast("long").alias("size"), F.explode("tokens").alias("token"))
    counts = durable(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"))
    rarest = Window.partitionBy("node").orderBy("n", "token")
    placed = tokens.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    placed = placed.withColumn("behind", F.col("size") - F.row_number().over(rarest))
    # The first shared shingle of a set lies here, and of the smaller or equal set in its leading part.
    placed = placed.where(f"n > 1 and behind + 1 >= ({percent} * size + 99) div 100")
    leads = F.expr(f"behind + 1 >= (2 * {percent} * size + 99 + {percent}) div (100 + {percent})")
    placed = durable(placed.select("token", "home", "node", "size", "behind", leads.alias("leads")))
    small = placed.where("leads").select("token", *[F.col(c).alias(f"{c}_a") for c in ("home", "node", "size", "behind")])
    large = placed.select("token", *[F.col(c).alias(f"{c}_b") for c in ("home", "node", "size", "behind")])
    # Pairs of components first: rows of one component are never paired.
    apart = small.select("token", "home_a").distinct().join(large.select("token", "home_b").distinct(), "token")
    pairs = durable(apart.where("home_a != home_b")).join(small, ["token", "home_a"]).join(large, ["token", "home_b"])
    overlap = f"({percent} * (size_a + size_b) + 99 + {percent}) div (100 + {percent})"
    pairs = pairs.where(f"size_a <= size_b and behind_a + 1 >= {overlap} and behind_b + 1 >= {overlap}")
    pairs = durable(pairs.select(F.least("node_a", "node_b").alias("x"), F.greatest("node_a", "node_b").alias("y")).distinct())
    left, right = (sets.select(F.col("node").alias(n), F.col("digest").alias(d), F.col("tokens").alias(t)) for n, d, t in (("x", "a", "s"), ("y", "b", "t")))
    both = pairs.join(left, "x").join(right, "y").withColumn("both", F.size(F.array_intersect("s", "t")))
    return durable(both.where(f"100 * both >= {percent} * (size(s) + size(t) - both)").select("a", "b"))


def _grouped(named_rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (doc_id, name, text) without their text, plus n_shingles, digest, component and component_id.

    component is a digest that names the group of a row, component_id its smallest doc_id;
    both and digest are null for texts without words.
    """
    written = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    named_rows = named_rows.withColumn("key", F.md5(written.cast("binary")))
    rows = named_rows.select("key", "text")
    trees = trees_for(percent / 100)
    schema = "doc_id long, name string, key string, n_shingles long, digest string, heads array<long>, tails array<long>"
    signed = durable(named_rows.mapInArrow(_signatures(words, trees), schema))
    classes = durable(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("first"),
            F.min("key").alias("key"),
            F.first("heads").alias("heads"),
            F.first("tails").alias("tails"),
        )
    )
    placed = classes.select("digest", "key", F.posexplode(F.arrays_zip("heads", "tails")).alias("tree", "path"))
    placed = placed.select("digest", "key", "tree", F.col("path.heads").alias("head"), F.col("path.tails").alias("tail"))
    regions = durable(placed.groupBy("tree", "head").agg(F.count("*").alias("n")).where("n > 1"))
    near = placed.join(regions, ["tree", "head"])
    order = ["tree", "head", "tail", "digest"]
    sorted_rows = durable(
        near.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    )
    # Rank in the whole order: one row per partition is added up, a table as small as their number.
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sorted_rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    parts = durable(parts.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows"))
    ranked = sorted_rows.withColumn("part", part).join(F.broadcast(parts), "part").withColumn("rank", F.col("base") + within)
    block = F.floor(F.col("rank") / SPAN).cast("long")
    reaches = F.col("rank") % SPAN + F.col("n") > SPAN  # the region may go on in the next block
    blocks = F.when(reaches, F.array(block, block + 1)).otherwise(F.array(block))
    wanted = ranked.groupBy("digest", "key").agg(
        F.flatten(F.collect_list(F.transform(blocks, lambda b: F.struct(b.alias("block"), "tree", "head")))).alias("places")
    )
    texts = with_text(wanted, rows).select("digest", "text", F.explode("places").alias("p"))
    texts = texts.select(F.col("p.block").alias("block"), F.col("p.tree").alias("tree"), F.col("p.head").alias("head"), "digest", "text")
    dealt = texts.repartition("block").sortWithinPartitions("block", "tree", "head", "digest")
    labels = components(durable(dealt.mapInArrow(_verify(words, percent), "a string, b string")), "string")
    dense = sorted_rows.where(F.col("n") > SPAN).select("tree", "head", "digest", "key")
    further = dense_links(dense, labels, rows, words, percent)
    if further is not None and not further.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(further), "string")
    grouped = classes.select("digest", "first").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    grouped = durable(grouped.select("digest", "first", F.coalesce("component", "digest").alias("component")))
    smallest = durable(grouped.groupBy("component").agg(F.min("first").alias("component_id")))
    named = durable(grouped.join(smallest, "component").select("digest", "component", "component_id"))
    return signed.select("doc_id", "name", "n_shingles", "digest").join(named, "digest", "left")


def near_groups(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link if 100 * intersection >= percent * union of their shingle sets.
    component_id is the smallest doc_id reachable by links, itself included; kept marks the
    documents that carry it. Equal sets are one class and compared once. Texts without words
    link with nothing. A null doc_id is above all others; rows that repeat a doc_id each count.
    Other columns are left out; an empty table gives an empty table.
    """
    rows = columns_of(docs, doc_id="long", text="string").withColumn("name", F.lit(None).cast("string"))
    out = _grouped(rows, words, percent)
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, one row of each group of near_groups.

    Rows are told apart by doc_id and text. A group keeps its smallest doc_id, null last; of
    different texts under that id the one with the smallest SHA-256, of rows that repeat both
    any one. Texts without words are groups of their own and all stay.
    """
    named = F.sha2(F.col("text").cast("string").cast("binary"), 256)
    rows = columns_of(docs, doc_id="long", text="string").withColumn("name", named)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "name")).alias("best")
    best = _grouped(rows, words, percent).where("digest is not null").groupBy("component").agg(first)
    # The id as text, empty for null: join and window then share one shuffle of the documents.
    id_text = lambda c: F.coalesce(c.cast("long").cast("string"), F.lit(""))
    stays = best.select(F.col("best.name").alias("__name"), id_text(F.col("best.doc_id")).alias("__id"))
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.where(worded).withColumn("__name", named).withColumn("__id", id_text(F.col("doc_id")))
    once = Window.partitionBy("__name", "__id").orderBy("__name")
    kept = marked.join(stays, ["__name", "__id"], "left_semi").withColumn("__nth", F.row_number().over(once)).where("__nth = 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(docs.where(~worded).select(*columns))
