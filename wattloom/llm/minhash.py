"""MinHash near-dedup by an inverted join on signature coordinates.

Texts with one set of shingles form a class. A class has a signature of 32 coordinates and is posted under each
coordinate-value pair; two classes can only be linked if at least 14 agree (a pair at the threshold misses that
with a probability of about one in a million). Collisions are counted as in merging posting lists with skips:
- Prefix: with c coordinates that any other class shares, a class that agrees in 14 must stand in one of the
  rarest c - 14 + 1 lists, so only those are merged (none if c < 14). The others are skipped, and looked into, by
  comparing the two signatures, for pairs that the merged lists bring together.
- A pair is counted in the first list only that both are posted in, and is skipped if sizes rule out a link or
  other links join its ends already.
To that end, first every class meets the first class of its lists, and of random parts of them: linear in a list,
whatever its length. Where a list still holds several components, pairs across them are counted in tiles inside
tasks, blocks of bounded numbers of classes and shingles, the likeliest pairs first; those above the match threshold
are verified at once on whole sets, since writing them out would make as many rows as a family that is nearly
similar has pairs. Sets and classes are compared by 64-bit hashes.
Defined results: null, empty and blank texts have no shingles and are linked with nothing; rows without doc_id are
kept and linked with nothing (component_id null); a doc_id with several texts is one document that has the links of
all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.llm.common import as_bytes, discard, document_batches, files_for, partition_index, saved
from wattloom.llm.components import components

WORDS, PERCENT = 5, 80
COORDINATES, AGREE = 32, 14
#: Classes in a tile's block, and candidate ids that may be broadcast (8 bytes each).
BLOCK, BROADCAST_IDS = 2048, 1 << 20
#: Shingles in a tile's block, about.
BLOCK_SHINGLES = 1 << 22
#: Into how many random parts each list falls for its stars.
PARTS = (1, 16)
MEMORY = 500_000

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh64_digest

    def __missing__(self, word: bytes) -> bytes:
        code = self.digest(word)
        if len(word) <= 64:
            if len(self) > MEMORY:
                self.clear()
            self[word] = code
        return code


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingles(data: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of `size` words, A-Z lower-cased; a shorter text is one run."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(b"".join(map(hashes.__getitem__, words)), "<u8")
    size = min(size, n)
    mixed = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ codes[i : n - size + 1 + i]) * _GOLDEN
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """The least value under each coordinate's hash; its lowest bits are the coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 8192):
        part = found[at : at + 8192]
        mixed = part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]
        mixed ^= mixed >> np.uint64(31)
        mixed *= _GOLDEN
        np.minimum(least, mixed.min(axis=1), out=least)
    bits = np.uint64(COORDINATES - 1)
    return (least & ~bits | np.arange(COORDINATES, dtype=np.uint64)).view(np.int64)


def class_of(found: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def text_key(docs: DataFrame) -> Column:
    """What rows alike in doc_id and text share."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key (of doc_id and text), row, n_shingles, cid (the class; null without shingles) and sig of every row."""
    names = ["doc_id", "key", "row", "n_shingles", "cid", "sig"]

    def run(batches):
        hashes, row = word_hashes(), partition_index() << 40
        for b in batches:
            sizes, classes, sigs = [], [], []
            for x in as_bytes(b.column(2)):
                found = shingles(x, size, hashes)
                sizes.append(len(found))
                classes.append(class_of(found) if len(found) else None)
                sigs.append(signature(found) if len(found) else None)
            rows = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rows, pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))], names)

    document_batches(docs.sparkSession)
    held = docs.select(F.col("doc_id").cast("long"), text_key(docs).alias("key"), "text")
    return held.mapInArrow(run, "doc_id long, key long, row long, n_shingles long, cid long, sig array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        hashes = word_hashes()
        for b in batches:
            found = [shingles(x, size, hashes) for x in as_bytes(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(f) if len(f) else None for f in found], pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))], ["cid", "members"])

    return docs.select("text").mapInArrow(run, "cid long, members array<long>")


def prefix_postings(sigs: DataFrame, agree: int) -> DataFrame:
    """(cid, key) of the rarest shared coordinates of each class, keys in order of rarity, `place` from 1."""
    posts = sigs.select("cid", F.explode("sig").alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("cid")
    ranked = posts.join(shared, "key").withColumn("place", F.row_number().over(own.orderBy("n", "key"))).withColumn("c", F.count("*").over(own))
    return ranked.where(F.col("place") <= F.col("c") - agree + 1).select("cid", "key", "place")


def _likely(a: str, b: str, agree: int, percent: int):
    """Sizes and signatures allow a link."""
    least, most = F.least(f"{a}n", f"{b}n"), F.greatest(f"{a}n", f"{b}n")
    return (100 * least >= percent * most) & (F.size(F.array_intersect(f"{a}sig", f"{b}sig")) >= agree)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    of = lambda x: sets.select(F.col("cid").alias(x), F.col("members").alias(f"{x}m"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    common = F.size(F.array_intersect("am", "bm"))
    return both.withColumn("common", common).where(100 * F.col("common") >= percent * (F.size("am") + F.size("bm") - F.col("common"))).select("a", "b")


def star_pairs(postings: DataFrame, sigs: DataFrame, agree: int, percent: int) -> DataFrame:
    """Each class with the least class of each of its lists and of its parts of them, if a link is likely."""
    parts = (F.lit(k << 16) + F.pmod(F.xxhash64("cid", F.lit(k)), F.lit(n)).cast("int") for k, n in enumerate(PARTS))
    parted = postings.select("key", "cid", F.explode(F.array(*parts)).alias("part"))
    lists = parted.groupBy("key", "part").agg(F.min("cid").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = parted.join(lists, ["key", "part"]).where("cid != a").select("a", F.col("cid").alias("b")).distinct()
    of = lambda x: sigs.select(F.col("cid").alias(x), F.col("n_shingles").alias(f"{x}n"), F.col("sig").alias(f"{x}sig"))
    return pairs.join(of("b"), "b").join(of("a"), "a").where(_likely("a", "b", agree, percent)).select("a", "b")


def tile_links(rows: list[tuple], first: int, agree: int, percent: int) -> list[tuple[int, int]]:
    """Links across components among (cid, comp, sig, keys, members) rows; with first < len(rows) only from
    the first so many to the rest, otherwise among all. Enough of them to join what they join."""
    whole = first >= len(rows)
    sig = np.array([r[2] for r in rows], np.int64)
    comp = np.unique([r[1] for r in rows], return_inverse=True)[1]
    sizes = np.array([len(r[4]) for r in rows])
    parent = list(range(int(comp.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    step = max(1, (1 << 22) // len(rows))
    for at in range(0, first, step):
        stop = min(first, at + step)
        lo = at + 1 if whole else first
        agreed = np.zeros((stop - at, len(rows) - lo), np.uint8)
        for k in range(sig.shape[1]):
            agreed += sig[at:stop, k, None] == sig[None, lo:, k]
        s, t = sizes[at:stop, None], sizes[None, lo:]
        able = (agreed >= agree) & (comp[at:stop, None] != comp[None, lo:]) & (100 * np.minimum(s, t) >= percent * np.maximum(s, t))
        if whole:
            able &= np.arange(at, stop)[:, None] < np.arange(lo, len(rows))[None, :]
        i, j = np.nonzero(able)
        order = np.argsort(-agreed[i, j].astype(np.int16), kind="stable")
        for i, j in zip((i[order] + at).tolist(), (j[order] + lo).tolist()):
            a, b = find(comp[i]), find(comp[j])
            if a == b:
                continue
            x, y = rows[i], rows[j]
            if x[3] and not x[3].isdisjoint(y[3]):
                continue
            common = len(x[4]) + len(y[4]) - len(np.union1d(x[4], y[4]))
            if 100 * common >= percent * (len(x[4]) + len(y[4]) - common):
                parent[a] = b
                found.append((x[0], y[0]))
    return found


def crossing_links(postings: DataFrame, sets: DataFrame, sigs: DataFrame, comps: DataFrame, agree: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links between the components that still share a posting list."""
    named = postings.join(comps.select(F.col("u").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = named.join(sigs.select("cid", "n_shingles"), "cid")
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum("n_shingles").alias("size")).where("lo != hi")
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    placed = named.join(mixed.select("key", blocks.alias("blocks")), "key").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # A block meets itself and every other block of its list: tile (i, j) with i <= j.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("cid", "component", "key", "place", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"))
    earlier = postings.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("place", "key"))).alias("keys"))  # at most 19 a class
    known = sets.join(sigs.select("cid", "sig"), "cid").join(earlier, "cid")
    full = placed.join(known, "cid").withColumn("keys", F.transform(F.slice("keys", F.lit(1), F.col("place") - 1), lambda k: k["key"])).drop("place")

    def run(batches):
        from itertools import groupby

        def rows():
            for b in batches:
                cols = {n: b.column(n).to_pylist() for n in ("cid", "component", "key", "i", "j", "second")}
                sig, keys, members = b.column("sig"), b.column("keys"), b.column("members")
                for k in range(b.num_rows):
                    yield (cols["key"][k], cols["i"][k], cols["j"][k]), cols["second"][k], (cols["cid"][k], cols["component"][k], sig[k].values.to_numpy(), frozenset(keys[k].as_py()), members[k].values.to_numpy())

        for (_, i, j), tile in groupby(rows(), lambda r: r[0]):
            tile = list(tile)
            own = [r[2] for r in tile if not r[1]]
            rest = [r[2] for r in tile if r[1]]
            if not own or i != j and not rest:
                continue
            links = tile_links(own + rest, len(own), agree, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    document_batches(postings.sparkSession)
    tiles = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "second", "cid")
    return tiles.mapInArrow(run, "a long, b long")


def linked_classes(docs: DataFrame, size: int, percent: int, agree: int, bridged: bool) -> tuple[DataFrame, DataFrame]:
    """The signatures of docs, and the first document and class of each class's component (first_doc, first_cid); where
    bridged, the classes of one doc_id are one node."""
    base = saved(signatures(docs, size))
    few = files_for(base.count())
    real = base.where("cid is not null and doc_id is not null")
    classes = saved(real.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.min_by("row", "doc_id").alias("row")), few)
    sigs = saved(real.join(classes.select("row"), "row", "left_semi").select("cid", "n_shingles", "sig"), few)
    postings = saved(prefix_postings(sigs, agree), few)
    posted = postings.select("cid").distinct()
    chosen = classes.join(posted, "cid", "left_semi").select(F.col("rep").alias("doc_id"))
    if posted.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    sets = saved(_sets(docs.select(F.col("doc_id").cast("long"), "text").join(chosen, "doc_id", "left_semi"), size).where("cid is not null"))
    stars = saved(confirmed(star_pairs(postings, sigs, agree, percent), sets, percent))
    crossing = saved(crossing_links(postings, sets, sigs, components(stars), agree, percent))
    links = stars.unionByName(crossing)
    if bridged:
        texts = real.select("doc_id", "cid").distinct()
        several = texts.groupBy("doc_id").agg(F.min("cid").alias("a"), F.count("*").alias("n")).where("n > 1").select("doc_id", "a")
        links = links.unionByName(texts.join(several, "doc_id").select("a", F.col("cid").alias("b")))
    joined = saved(components(links).withColumnRenamed("u", "cid"), few)
    rooted = classes.join(joined, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    first = rooted.groupBy("component").agg(F.min(F.struct("rep", "cid")).alias("first"))
    told = saved(rooted.select("cid", "component").join(first, "component").select("cid", F.col("first.rep").alias("first_doc"), F.col("first.cid").alias("first_cid")), few)
    for done in (classes, sigs, postings, sets, stars, crossing, joined):
        discard(done)
    return base, told


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, agree: int = AGREE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: one document of each component is kept."""
    base, told = linked_classes(docs, size, percent, agree, True)
    out = base.select("doc_id", "n_shingles", "cid").join(told, "cid", "left")
    # A text without shingles has no class; its document may have another text.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_doc", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, agree: int = AGREE) -> DataFrame:
    """The rows of docs without those whose text is linked with another that stays: of each component of texts the one of
    the least doc_id. Rows alike in doc_id and text share their fate; those without doc_id or shingles stay."""
    base, told = linked_classes(docs, size, percent, agree, False)
    stays = (F.col("doc_id") == F.col("first_doc")) & (F.col("cid") == F.col("first_cid"))
    dropped = base.where("doc_id is not null").join(told, "cid").where(~stays).select(F.col("key").alias("dropped_key")).distinct()
    return docs.join(dropped, text_key(docs) == dropped["dropped_key"], "left_anti")
