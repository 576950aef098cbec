"""N-gram Jaccard join with R-trees of count vectors.

1. Texts become sets of hashed shingles; equal sets are one vertex from here on. On the way the shingles
   are counted in ``SLOTS`` hash slots, whose ranks order all shingles, rare slots first: a passage or line that many documents
   share sorts last.
2. Sets that link share some of their first shingles in that order, so only these prefixes, a third of a set, are
   shuffled. How many they share at least follows from the sizes (``needed_keys``): a set of which fewer prefix
   shingles occur anywhere else links with nothing and leaves, twice. All remaining sets with a prefix shingle in
   common join the block of the smallest of them: the two ends of every possible link meet in at least one block.
3. In a block an R-tree for every two neighbouring bands of sizes indexes the sets as points of group counts. The summed coordinate minima bound the overlap
   with a node or a point; pairs that survive are verified on the full sets. Pairs that are in one class already are
   passed over, so a block of near copies costs about a search per member, and links that span its classes are all
   it gives out.
4. A block over ``PAGE_SHINGLES`` is split into pages, each with the block's first set. What does not link with that
   first set visits the other pages; what does needs no more pairs, since it is in one class.
5. Components of the links, by alternating stars, carry the smallest doc_id.

Rules for odd input: null and wordless texts have no set and link with nothing; a null id takes part and is never
a component id unless nothing else is there; rows that share an id or a text are handled as they are; an empty table gives an
empty result; other columns are ignored or kept as they are.
Hashes are 64 bits wide: a false match of two sets or shingles is possible, at odds of about their number squared over 3.7e19.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, staged
from tidemark.llm.components import roots
from tidemark.llm.count_tree import banded_links
from tidemark.llm.shingles import PERCENT, WordHashes, least_overlap, overlap, set_id, shingle_set

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
LOW_BITS = 64 - SLOT_BITS
LOW_MASK = np.uint64((1 << LOW_BITS) - 1)
#: Shingles in one page of a block, 4 MB of them.
PAGE_SHINGLES = 500_000
#: One of so many shingles of a set is in its prefix, at least.
PREFIX_PART = 3
#: Ids of the documents whose sets are compared are broadcast up to this number, 16 MB of them.
BROADCAST_IDS = 1_000_000


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document, then one with the task's shingles per slot."""
    hashes, slots = WordHashes(), np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        vertices, sizes = [], []
        for text in batch["text"]:
            shingles = shingle_set(text, hashes)
            slots += np.bincount((shingles >> np.uint64(LOW_BITS)).astype(np.int64), minlength=SLOTS)
            vertices.append(set_id(shingles))
            sizes.append(len(shingles))
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"].astype("Int64"), "vertex": vertices, "n": sizes, "slots": None}
        )
    packed = zlib.compress(slots.astype("<i8").tobytes(), 1)
    yield pd.DataFrame({"doc_id": [None], "vertex": [0], "n": [-1], "slots": [packed]})


def _sum_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for slots in batch["slots"]:
            total += np.frombuffer(zlib.decompress(slots), dtype="<i8")
    yield pd.DataFrame({"slot": np.arange(SLOTS), "shingles": total})


def slot_ranks(described: DataFrame) -> np.ndarray:
    """The rank of each slot by its count; a fixed number of them comes to the driver."""
    counted = (
        described.filter("n < 0")
        .select("slots")
        .mapInPandas(_sum_slots, "slot int, shingles long")
        .groupBy("slot")
        .agg(F.sum("shingles").alias("shingles"))
        .orderBy("shingles", "slot")
        .select("slot")
        .collect()
    )
    ranks = np.zeros(SLOTS, dtype=np.uint64)
    ranks[[r[0] for r in counted]] = np.arange(len(counted), dtype=np.uint64)
    return ranks


def prefix_length(n: int) -> int:
    """At least one more than a set can lack of a partner's shingles."""
    return max(n - -(-PERCENT * n // 100) + 1, -(-n // PREFIX_PART))


def needed_keys(n: int) -> int:
    """The fewest prefix shingles that a set of ``n`` shares with any set it links with.

    Of two sets let the one whose prefix ends first have ``r`` shingles after it. All that they share up to there is in both
    prefixes, so they share at most ``r`` more. What a link needs less ``r`` is least for the smallest or the largest
    possible partner; one less makes up for rounding between them.
    """
    fewest = []
    for partner in (-(-PERCENT * n // 100), 100 * n // PERCENT):
        after = max(n - prefix_length(n), partner - prefix_length(partner))
        fewest.append(least_overlap(n, partner) - after)
    return max(1, min(fewest) - 1)


def prefix_of(shingles: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles of the prefix, renamed by the rank of their slot; one to one."""
    named = (ranks[shingles >> np.uint64(LOW_BITS)] << np.uint64(LOW_BITS)) | (shingles & LOW_MASK)
    length = prefix_length(len(named))
    if length < len(named):
        named = np.partition(named, length - 1)[:length]
    return named.view(np.int64)


def prefix_rows(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """vertex, n, needed, key for every prefix shingle of every document."""

    @F.pandas_udf("struct<vertex:bigint,n:int,needed:int,keys:array<bigint>>")
    def prefixes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for texts in parts:
            rows = []
            for text in texts:
                shingles = shingle_set(text, hashes)
                n = len(shingles)
                keys = prefix_of(shingles, ranks) if n else shingles.view(np.int64)
                rows.append((set_id(shingles), n, needed_keys(n) if n else 0, keys))
            yield pd.DataFrame(rows, columns=["vertex", "n", "needed", "keys"])

    return docs.select(prefixes("text").alias("p")).select(
        "p.vertex", "p.n", "p.needed", F.explode("p.keys").alias("key")
    )


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of keys that more than one vertex has, and the smallest vertex of the key."""
    of_key = Window.partitionBy("key")
    return rows.withColumns(
        {"leader": F.min("vertex").over(of_key), "last": F.max("vertex").over(of_key)}
    ).filter("leader <> last").drop("last")


def _shared_again(rows: DataFrame) -> DataFrame:
    """The same of the rows that are left: keys are combined before the shuffle, and the join can be split at a hot one.

    For all prefix rows this would shuffle them twice, and most keys have one row.
    """
    ends = rows.groupBy(F.col("key").alias("of_key")).agg(F.min("vertex").alias("leader"), F.max("vertex").alias("last"))
    crowded = ends.filter("leader <> last").drop("last")
    return rows.join(crowded, F.col("key") == F.col("of_key")).drop("of_key")


def _with_enough(shared: DataFrame) -> DataFrame:
    """Rows of the vertices that share as many keys as a link needs."""
    enough = (
        shared.groupBy(F.col("vertex").alias("enough"))
        .agg(F.count(F.lit(1)).alias("keys"), F.max("needed").alias("least"))
        .filter("keys >= least")
        .select("enough")
    )
    return shared.join(enough, F.col("vertex") == F.col("enough"), "left_semi")


def blocks_of(prefixes: DataFrame) -> DataFrame:
    """leader, vertex, n: every block with all its members, the leader among them."""
    rows = prefixes
    for turn, share in (("shared", _shared), ("shared-again", _shared_again)):
        shared = share(rows).select("key", "leader", "vertex", "n", "needed").distinct()
        rows = _with_enough(staged(shared, turn)).drop("leader")
    return _shared_again(rows).select("leader", "vertex", "n").distinct()


def _paged(blocks: DataFrame, page_shingles: int) -> tuple[DataFrame, int]:
    """leader, vertex, page, pages; the leader is on every page of its block."""
    sizes = staged(
        blocks.groupBy("leader").agg(
            F.ceil(F.sum(F.col("n").cast("long")) / F.lit(page_shingles)).cast("int").alias("pages")
        ),
        "block-sizes",
    )
    most = sizes.agg(F.max("pages")).first()[0] or 0
    sized = blocks.join(sizes, "leader")
    own = F.pmod(F.xxhash64("vertex"), F.col("pages")).cast("int")
    pages = F.when(
        F.col("vertex") == F.col("leader"), F.sequence(F.lit(0), F.col("pages") - 1)
    ).otherwise(F.array(own))
    return sized.select("leader", "vertex", "pages", F.explode(pages).alias("page")), most


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """vertex and its shingles as bytes, for the documents whose id is in ``ids`` (unique)."""

    @F.pandas_udf("struct<vertex:bigint,shingles:binary>")
    def shingled(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for texts in parts:
            sets = [shingle_set(text, hashes) for text in texts]
            yield pd.DataFrame({"vertex": [set_id(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("set_doc_id")), "left_semi")
    return chosen.select(shingled("text").alias("s")).select("s.*")


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one (leader, page) at a time, from rows sorted by them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        changes = (batch["leader"].diff().ne(0) | batch["page"].diff().ne(0)).to_numpy().copy()
        changes[0] = True
        starts = np.flatnonzero(changes)
        for start, end in zip(starts, np.r_[starts[1:], len(batch)], strict=True):
            part = batch.iloc[start:end]
            if held and (held[0]["leader"].iat[0], held[0]["page"].iat[0]) != (part["leader"].iat[0], part["page"].iat[0]):
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _links_in_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) that span the classes of each page; of visitors, those with its residents."""
    rows: list[tuple[int, int]] = []
    for page in _pages(batches):
        page = page.drop_duplicates("vertex")
        if len(page) < 2:
            continue
        vertices = page["vertex"].tolist()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in page["shingles"]]
        leader = page["leader"].iat[0]
        first = vertices.index(leader) if leader in vertices else 0
        # Residents of a page have met before, so only visitors, if there are any, search it.
        visits = page["visits"].to_numpy()
        searching = visits if visits.any() else np.ones(len(sets), dtype=bool)
        rows += [(vertices[a], vertices[b]) for a, b in banded_links(sets, overlap, first, searching)]
        if len(rows) > 50_000:
            yield pd.DataFrame(rows, columns=["a", "b"])
            rows = []
    yield pd.DataFrame(rows, columns=["a", "b"]).astype("int64")


def _links(pages: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within pages of (leader, page, vertex, visits)."""
    return (
        pages.join(sets, "vertex")
        .repartition("leader", "page")
        .sortWithinPartitions("leader", "page")
        .select("leader", "page", "vertex", "visits", "shingles")
        .mapInPandas(_links_in_pages, "a long, b long")
    )


def _visits(pages: DataFrame, root_of: DataFrame) -> DataFrame:
    """Of split blocks: members that are not in their leader's class, on the other pages."""
    split = pages.filter("pages > 1 AND vertex <> leader")
    known = (
        split.join(root_of.select(F.col("node").alias("vertex"), F.col("root").alias("own")), "vertex", "left")
        .join(root_of.select(F.col("node").alias("leader"), F.col("root").alias("leads")), "leader", "left")
        .withColumn("loose", ~F.coalesce(F.col("own") == F.col("leads"), F.lit(False)))
    )
    loose = known.filter("loose")
    elsewhere = loose.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("pages") - 1))).filter("to <> page")
    visited = elsewhere.select("leader", F.col("to").alias("page")).distinct()
    residents = split.join(visited, ["leader", "page"], "left_semi")
    return residents.select("leader", "page", "vertex", F.lit(False).alias("visits")).unionByName(
        elsewhere.select("leader", F.col("to").alias("page"), "vertex", F.lit(True).alias("visits"))
    )


def components(docs: DataFrame, page_shingles: int = PAGE_SHINGLES) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = staged(
        docs.mapInPandas(_described, "doc_id long, vertex long, n int, slots binary"), "described"
    )
    ranks = slot_ranks(described)
    documents = described.filter("n >= 0").select("doc_id", "vertex", "n")
    classes = staged(
        documents.filter("n > 0")
        .groupBy("vertex")
        .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    pages, most = _paged(staged(blocks_of(prefix_rows(docs, ranks)), "blocks"), page_shingles)
    pages = staged(pages, "pages")
    wanted = pages.select("vertex").distinct().join(classes, "vertex").select(F.col("least").alias("set_doc_id"))
    sets = staged(sets_of(docs, staged(wanted.distinct(), "wanted")).dropDuplicates(["vertex"]), "sets")
    links = staged(_links(pages.withColumn("visits", F.lit(False)), sets), "links")
    root_of = roots(links, "a", "b")
    if most > 1:
        more = staged(_links(_visits(pages, root_of), sets), "more-links")
        root_of = roots(links.unionByName(more), "a", "b")
    grouped = (
        classes.join(root_of, F.col("vertex") == F.col("node"), "left")
        .filter("copies > 1 OR root IS NOT NULL")
        .select("vertex", F.coalesce("root", "vertex").alias("root"), "least")
    )
    grouped = staged(grouped, "grouped")
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(grouped.join(names, "root").select(F.col("vertex").alias("of_vertex"), "component_id"), "named")
    return documents.join(named, (F.col("vertex") == F.col("of_vertex")) & (F.col("n") > 0), "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, page_shingles: int = PAGE_SHINGLES) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id.

    Rows that share an id stand or fall together; rows without an id stay.
    """
    dropped = staged(
        components(docs, page_shingles).filter("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct(),
        "dropped",
    )
    rows = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("own_id"))
    return rows.join(dropped, F.col("own_id") == F.col("dropped_id"), "left_anti").select("doc.*")
