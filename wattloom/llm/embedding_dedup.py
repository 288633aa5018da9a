"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Equal vectors form a class. Classes are dealt into blocks; a task multiplies two blocks after quantising each unit
vector x to s*q with whole q in -127..127. The products of the int8 rows are exact: they are summed by a float32
matrix product over stretches so short that every partial sum is a whole number below 2**24. With e >= |x - s*q|
for each vector, a product differs from the cosine by at most e1*(1+e2) + e2*(1+e1) + e1*e2, so only pairs that
this bound lets reach the threshold are recomputed in double precision. A task writes, for each linked class, its
number of links in the tile and the root of its tile component: as many rows as classes, however many pairs there
are. The work is quadratic in the distinct vectors, as the method named is; the memory of a task isn't.
A vec_id with several different vectors is one node that has the links of all of them; only for the classes of
such ids the tiles write out their pairs, so that no neighbour counts twice.
Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do
vectors of different lengths with each other; rows of one vec_id are one node, and come out alike; rows without
vec_id link with nothing (component_id null, kept); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import discard, document_batches, saved
from wattloom.llm.components import components

COSINE = 0.95
TILE, STRIP, GATHER = 4096, 512, 1 << 16
#: Components whose int8 products sum to less than 2**24, and ids with several vectors that may be broadcast.
EXACT, BROADCAST_IDS = 1024, 1 << 20


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two each, which is exact and keeps their squares in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, and bounds of the quantisation errors."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(units - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, error


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The products of int8 rows of a with those of b, exact: as float32 while sums stay below 2**24, else as float64."""
    parts = [a[:, k : k + EXACT].astype(np.float32) @ b[:, k : k + EXACT].astype(np.float32).T for k in range(0, a.shape[1], EXACT)]
    return parts[0] if len(parts) == 1 else np.sum(parts, axis=0, dtype=np.float64)


def slack(width: int) -> float:
    """Covers the roundings of the scaled product and of its limit, of the unit vectors and of the errors' bounds."""
    return max(1e-5, (width + 4) * 2.0**-23)


def tile(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, first: int, cosine: float, told: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Links of each vector, counting copies, the position of its component's root, and the linked pairs of positions of
    which one is told; if first is smaller than their number only pairs between the first so many vectors and the rest count."""
    n, whole = len(ids), first >= len(ids)
    own = scaled(vectors)
    norms = np.linalg.norm(own, axis=1)
    q, scale, error = quantised(own / norms[:, None])
    links, root, pairs = np.zeros(n, np.int64), np.arange(n), []
    lo = 0 if whole else first
    worst = error[lo:].max()
    columns = scale[lo:].astype(np.float32)
    # The least product of a row's whole numbers with the other's, scaled, that the bound lets pass.
    least = ((cosine - (error * (1 + worst) + worst * (1 + error) + error * worst) - slack(q.shape[1])) / scale).astype(np.float32)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    for at in range(0, first, STRIP):
        stop = min(first, at + STRIP)
        i, j = np.nonzero(products(q[at:stop], q[lo:]) * columns >= least[at:stop, None])
        i, j = i + at, j + lo
        if whole:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), GATHER):
            a, b = i[k : k + GATHER], j[k : k + GATHER]
            near = np.einsum("ij,ij->i", own[a], own[b]) / (norms[a] * norms[b]) >= cosine
            a, b = a[near], b[near]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            if told is not None and len(a):
                shown = told[a] | told[b]
                pairs.append(np.stack([a[shown], b[shown]], 1))
            if len(a):
                for x, y in np.unique(np.stack([root[a], root[b]], 1), axis=0).tolist():
                    x, y = find(x), find(y)
                    root[max(x, y)] = min(x, y)
                while (root != root[root]).any():
                    root = root[root]
    return links, root, pairs


def tile_links(classes: DataFrame, cosine: float, size: int = TILE) -> DataFrame:
    """From classes(cls, copies, told, embedding): (cls, links, root) of the linked classes of every tile, and (cls, null,
    root) for each linked pair of which one class is told."""
    blocks = max(1, -(-classes.count() // size))
    own = F.pmod("cls", F.lit(blocks)).cast("int")
    dealt = classes.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select("cls", "copies", "embedding", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "told")

    def run(batches):
        def work(rows):
            for width in {len(r[2]) for r in rows}:
                same = [r for r in rows if len(r[2]) == width]
                first = sum(1 for r in same if not r[3])
                if first == 0 or same[0][4] != same[0][5] and first == len(same):
                    continue
                ids, told = np.array([r[0] for r in same], np.int64), np.array([r[6] for r in same])
                links, root, pairs = tile(ids, np.array([r[1] for r in same], np.int64), np.array([r[2] for r in same], np.float64), first, cosine, told if told.any() else None)
                at = np.flatnonzero(links)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at]), pa.array(ids[root[at]])], names)
                for p in pairs:
                    if len(p):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[p[:, 0]]), pa.nulls(len(p), pa.int64()), pa.array(ids[p[:, 1]])], names)

        held: list = []
        for b in batches:
            vectors = b.column(2)
            c = [b.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6)]
            for k in range(b.num_rows):
                row = (c[0][k], c[1][k], vectors[k].values.to_numpy(zero_copy_only=False), c[4][k], c[2][k], c[3][k], c[5][k])
                if held and held[0][4:6] != row[4:6]:
                    yield from work(held)
                    held = []
                held.append(row)
        if held:
            yield from work(held)

    names = ["cls", "links", "root"]
    return dealt.repartition("i", "j").sortWithinPartitions("i", "j", "second").mapInArrow(run, "cls long, links long, root long")


def _links_of_many(several: DataFrame, members: DataFrame, classes: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ids with several classes: (vec_id, n_links) of each, and (cls, again), how often such an id is among the
    neighbours of a class more than once. Pairs are those of the classes of such ids, both ways, with themselves."""
    known = members.join(F.broadcast(several) if several.count() <= BROADCAST_IDS else several, "vec_id")
    others = pairs.join(known.withColumnRenamed("cls", "root"), "root")  # (cls, root, vec_id): an id of several in reach of a class
    again = others.groupBy("cls", "vec_id").agg((F.count("*") - 1).alias("more")).groupBy("cls").agg(F.sum("more").alias("again"))
    reach = known.join(pairs, "cls").select("vec_id", "root").distinct()
    single = classes.select(F.col("cls").alias("root"), "copies").join(known.groupBy(F.col("cls").alias("root")).agg(F.count("*").alias("known")), "root", "left")
    single = single.select("root", (F.col("copies") - F.coalesce("known", F.lit(0))).alias("single"))
    plain = reach.join(single, "root").groupBy("vec_id").agg(F.sum("single").alias("plain"))
    met = reach.join(known.select(F.col("cls").alias("root"), F.col("vec_id").alias("other")), "root").where("other != vec_id")
    met = met.groupBy("vec_id").agg(F.count_distinct("other").alias("met"))
    return plain.join(met, "vec_id", "left").select("vec_id", (F.col("plain") + F.coalesce("met", F.lit(0))).alias("n_links")), again


def embedding_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    document_batches(vectors.sparkSession)
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & whole, F.lit(False))
    # Zero has two signs; a class is known by one hash and made by the vector itself.
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))
    keyed = held.withColumn("embedding", F.when(sound, plain)).withColumn("cls", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")))
    members = saved(keyed.where("cls is not null").select("vec_id", "cls").distinct())
    several = saved(members.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"))
    counted = members.groupBy("cls").agg(F.min("vec_id").alias("vec"), F.count("*").alias("copies"))
    told = members.join(several, "vec_id", "left_semi").select("cls").distinct().withColumn("told", F.lit(True))
    bodies = keyed.where("cls is not null").select("cls", "embedding").distinct()
    classes = saved(counted.join(told, "cls", "left").join(bodies, "cls").withColumn("told", F.coalesce("told", F.lit(False))))
    found = saved(tile_links(classes.select("cls", "copies", "told", "embedding"), cosine))
    slim = classes.select("cls", "vec", "copies", "told")
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.join(slim.select("cls", F.col("vec").alias("a")), "cls").join(slim.select(F.col("cls").alias("root"), F.col("vec").alias("b")), "root").select("a", "b")
    # The classes of one id are joined by it: their least ids are linked with it.
    bridges = members.join(several, "vec_id", "left_semi").join(slim, "cls").select(F.col("vec_id").alias("a"), F.col("vec").alias("b"))
    joined = saved(components(edges.union(bridges)))
    ways = found.where("links is null").select("cls", "root")
    ways = ways.union(ways.select("root", "cls")).union(slim.where("told").select("cls", F.col("cls").alias("root")))
    ways = saved(ways)
    of_many, again = _links_of_many(several, members, slim, ways)
    told = slim.join(sums, "cls", "left").join(joined.withColumnRenamed("u", "vec"), "vec", "left").join(again, "cls", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1 - F.coalesce("again", F.lit(0))
    told = saved(told.select("cls", n_links.alias("n_links"), F.coalesce("component", "vec").alias("component_id")))
    many = saved(of_many.withColumnRenamed("n_links", "many"))
    for done in (members, several, classes, found, joined, ways):
        discard(done)
    out = keyed.select("vec_id", "cls").join(told, "cls", "left").join(many, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    n_links = F.coalesce("many", "n_links", F.lit(0)).cast("long")
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
