"""Similarity join of texts on word shingles: size-banded tiles with hashed bitmap signatures.

Two texts link when the Jaccard similarity of their shingle sets reaches ``share / 100``.

*Tiles.*  With sets of a and b shingles the similarity allows at most
``d = (a + b) * (100 - share) / (100 + share)`` shingles that only one of them has.  Sizes are cut into bands so
narrow that partners lie in one band or in neighbouring ones.  For the pairs whose smaller set lies in a band, all sets
are dealt by hash value into ``m = d + 1 + spare`` buckets: at most d buckets can differ, so linked sets agree on at
least one whole bucket that is not empty.  (Sets with more empty buckets than ``spare`` name their empty ones too.)
A tile is the sets that agree on one bucket; its key is a hash of band, bucket and content.  No link can be lost, and a
key stands for five or six shingles at once, so passages that many texts share do not fill tiles.

*Bitmaps.*  Every set carries a bitmap of four bits a shingle or more (a power of two from 1 024 to 131 072): bit h is the parity
of the shingles that hash to h, and a larger bitmap folds to a smaller one.  The bits in which two bitmaps differ bound the shingles that only one set has from below, hence the overlap from above.  Pairs that the bound
excludes never meet; the rest is decided by the intersection of the sorted arrays.

*Groups of copies.*  Equal sets are one class from the start.  Tiles are compared in blocks of about ``BLOCK`` members.  In
each round every class offers the closest class by bitmap that lies in another component; verified links join components.
A class remembers how far it has got in the order of its partners, so a pair that was no link is not offered again.  When
few offers link, classes offer more of them at a time.  The rounds end when no class has an offer left: then every pair that
the bitmaps admit was decided or lies in one component.  So large groups of near copies cost some pairs per class
and round, not all their pairs, and only components are carried from round to round.

Every case has a defined result: a null or empty text has an empty set, links with nothing and is its own component; a
text of fewer than k words is one shingle; repeated rows are rows of their own that link with each other; ties do not
arise; documents without id link like any other, and their component is named by the smallest id in it (null if there is
none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words as W
from .components import components
from .tables import Rounds, parked

BITS, MOST_BITS, PER_SHINGLE = 1 << 10, 1 << 17, 4
BLOCK = 1024
#: Share of all shingle arrays that one exact comparison may move; more offers are decided in several turns.
MOVED = 0.25
#: Classes offer this many times more pairs after a round in which fewer than half of the offers linked.
MORE = 4


@cache
def bands(share: int, up_to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest and largest size of each band and the most shingles by which a pair with its smaller set there differs."""
    low, high, differ = [], [], []
    at = 1
    while at <= up_to or len(low) < 2:
        top = at * 100 // share
        low.append(at)
        high.append(top)
        differ.append((100 - share) * (top + top * 100 // share) // (100 + share))
        at = top + 1
    return np.array(low), np.array(high), np.array(differ)


def _class_of(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number per set, equal for equal sets."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = W.mix(np.add.reduceat(W.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), bounds[full]) + sizes[full].astype(np.uint64))
    return out


def _sketches(sets: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Parity bitmap of each set, as a list of numbers of 64 bits."""
    n = np.diff(bounds)
    bits = np.minimum(1 << np.ceil(np.log2(np.maximum(PER_SHINGLE * n, BITS))).astype(np.int64), MOST_BITS)
    start = np.concatenate([[0], np.cumsum(bits)])
    place = (sets & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(start[:-1], n)
    parity = (np.bincount(place, minlength=start[-1]) & 1).astype(np.uint8)
    words = np.packbits(parity, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array((start // 64).astype(np.int32)), pa.array(words))


def _folded(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bitmaps ``words[at[i]:at[i + 1]]`` as rows, folded to the size of the smallest."""
    sizes = np.diff(at)
    least = int(sizes.min())
    if (sizes == least).all():
        return words[at[0] : at[-1]].reshape(-1, least)
    # bit h of a smaller bitmap is the parity of the bits that are h modulo its size
    return np.stack([np.bitwise_xor.reduce(words[a:b].reshape(-1, least)) for a, b in zip(at[:-1], at[1:], strict=True)])


def _keys(sets: np.ndarray, bounds: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile keys of each set: (index of the set, key)."""
    sizes = np.diff(bounds)
    low, high, differ = bands(share, int(sizes.max(initial=1)))
    band = np.searchsorted(low, sizes, side="right") - 1
    owners, keys = [], []
    for down in (0, 1):
        space = band - down
        use = (sizes > 0) & (space >= 0)
        if down:
            use &= -(-share * sizes // 100) <= high[np.maximum(space, 0)]
        allowed = differ[np.maximum(space, 0)]
        use &= allowed > 0  # else only equal sets link
        spare = 1 + allowed // 50
        m = np.where(use, allowed + 1 + spare, 0)
        own = np.repeat(np.arange(len(sizes)), np.where(use, sizes, 0))
        if not len(own):
            continue
        values = sets[np.repeat(use, sizes)]
        bucket = (((values >> np.uint64(32)) * m[own].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])])
        at = np.flatnonzero(new)
        content = np.add.reduceat(W.mix(values + np.uint64(0x2545F4914F6CDD1D)), at)
        label = (space[own[at]].astype(np.uint64) << np.uint64(32)) + bucket[at].astype(np.uint64)
        owners.append(own[at])
        keys.append(W.mix(content ^ W.mix(label)))
        filled = np.bincount(own[at], minlength=len(sizes))
        for i in np.flatnonzero(use & (m - filled > spare)):
            empty = np.setdiff1d(np.arange(m[i]), bucket[at][own[at] == i])
            owners.append(np.full(len(empty), i))
            keys.append(W.mix(~W.mix((np.uint64(space[i]) << np.uint64(32)) + empty.astype(np.uint64))))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(keys)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, key, n, class, sketch) of rows (id, key, text); class and sketch are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                sets, bounds = W.shingles(piece, k)
                n = np.diff(bounds)
                empty = n == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(piece.first, piece.n),
                        batch.column("key").slice(piece.first, piece.n),
                        pa.array(n),
                        pa.array(W.signed(_class_of(sets, bounds)), mask=empty),
                        _sketches(sets, bounds),
                    ],
                    ["id", "key", "n", "class", "sketch"],
                )

    return docs.select("id", "key", "text").mapInArrow(run, "id long, key long, n long, class long, sketch array<long>")


def tile_keys(docs: DataFrame, k: int, share: int) -> DataFrame:
    """(key, class) rows of all texts; a task names each class once, so copies do not multiply them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                sets, bounds = W.shingles(piece, k)
                named = _class_of(sets, bounds)
                owner, key = _keys(sets, bounds, share)
                fresh = np.zeros(len(named), bool)
                for i, c in enumerate(named.tolist()):
                    if c not in seen:
                        seen.add(c)
                        fresh[i] = True
                use = fresh[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(key[use])), pa.array(W.signed(named[owner[use]]))], ["key", "class"]
                )

    return docs.select("text").mapInArrow(run, "key long, class long")


def shingle_arrays(docs: DataFrame, k: int) -> DataFrame:
    """(class, shingles) with the sorted shingles of each text; a task gives each class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                sets, bounds = W.shingles(piece, k)
                arrays = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(W.signed(sets)))
                out = pa.RecordBatch.from_arrays([pa.array(W.signed(_class_of(sets, bounds))), arrays], ["class", "shingles"])
                fresh = []
                for c in out.column("class").to_pylist():
                    fresh.append(c not in seen)
                    seen.add(c)
                yield out.filter(pa.array(fresh))

    return docs.select("text").mapInArrow(run, "class long, shingles array<long>")


def _decided(offers: DataFrame, arrays: DataFrame, share: int) -> DataFrame:
    """(a, b, linked): components ``a`` and ``b`` of every pair of classes that was offered, and whether it links."""
    swap = F.col("class") > F.col("other")
    first, second = F.struct(F.col("class").alias("c"), F.col("root").alias("r")), F.struct(F.col("other").alias("c"), F.col("other_root").alias("r"))
    pairs = offers.select(F.when(swap, second).otherwise(first).alias("x"), F.when(swap, first).otherwise(second).alias("y")).distinct()
    for c in ("x", "y"):
        own = arrays.select(F.col("class").alias(f"class_{c}"), F.col("shingles").alias(f"shingles_{c}"))
        pairs = pairs.withColumn(f"class_{c}", F.col(f"{c}.c")).join(own, f"class_{c}")
    common = F.size(F.array_intersect("shingles_x", "shingles_y"))
    linked = F.lit(100 + share) * common >= F.lit(share) * (F.size("shingles_x") + F.size("shingles_y"))
    return pairs.select(F.col("x.r").alias("a"), F.col("y.r").alias("b"), linked.alias("linked"))


def _nearest(far: np.ndarray, ids: np.ndarray, past: float, past_id: int, most: int) -> np.ndarray:
    """Places of the ``most`` nearest partners that come after (past, past_id) in the order of distance, then id."""
    at = np.flatnonzero(np.isfinite(far) & ((far > past) | ((far == past) & (ids > past_id))))
    return at[np.lexsort((ids[at], far[at]))][:most]


def _offers(members: DataFrame, share: int, most: int) -> DataFrame:
    """(tile, class, root, other, other_root, far): of every class the ``most`` nearest in a tile that it has yet to be compared with.

    ``members`` has (tile, blocks, class, root, past, past_id, n, sketch).  A tile is compared block against block, each
    pair of blocks being a group of its own, so that no task gets more than two blocks of one tile at a time.
    """
    dealt = (
        members.withColumn("block", F.pmod(F.xxhash64("class"), "blocks"))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("block", "with"), "hi": F.greatest("block", "with")})
        .drop("blocks", "with")
    )
    columns = ["block", "class", "root", "past", "past_id", "n"]

    def compare(tile: int, lo: int, hi: int, block, named, root, past, past_id, n, bits) -> list[tuple]:
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        far = np.full((len(left), len(right)), np.inf)
        for row, i in zip(far, left, strict=True):
            apart = np.bitwise_count(bits[right] ^ bits[i]).sum(axis=1, dtype=np.int64)
            sizes = n[right] + n[i]
            ok = ((100 + share) * (sizes - apart) >= 2 * share * sizes) & (root[right] != root[i])
            row[ok] = apart[ok] / sizes[ok]
        found = []
        sides = [(left, right, far)] if lo == hi else [(left, right, far), (right, left, far.T)]
        for own, others, table in sides:
            for i, row in zip(own, table, strict=True):
                for j in _nearest(row, named[others], past[i], past_id[i], most):
                    found.append((tile, named[i], root[i], named[others[j]], root[others[j]], row[j]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            tile, lo, hi = (table.column(c).to_numpy() for c in ("tile", "lo", "hi"))
            values = [table.column(c).to_numpy() for c in columns]
            sketch = table.column("sketch").combine_chunks()
            words = sketch.flatten().to_numpy().view(np.uint64)
            at = sketch.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            new = np.concatenate([[True], (tile[1:] != tile[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
            starts = np.flatnonzero(new)
            found = []
            for a, b in zip(starts, np.append(starts[1:], len(tile)), strict=True):
                if b - a > 1:
                    found += compare(tile[a], lo[a], hi[a], *[v[a:b] for v in values], _folded(words, at[a : b + 1]))
            lists = list(zip(*found, strict=True)) if found else [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            names = ["tile", "class", "root", "other", "other_root", "far"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(lists, kinds, strict=True)], names)

    key = ["tile", "lo", "hi"]
    schema = "tile long, class long, root long, other long, other_root long, far double"
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _nearest_of_all(offers: DataFrame, most: int) -> DataFrame:
    """(class, root, other, other_root, far): of every class the ``most`` nearest over all its tiles; two classes may share several."""
    order = Window.partitionBy("class").orderBy("far", "other")
    return offers.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= most).drop("place", "tile").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the sorted rows that end where a (tile, lo, hi) ends."""
    key, held = ["tile", "lo", "hi"], None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        columns = [table.column(c).to_numpy() for c in key]
        same = np.all([c == c[-1] for c in columns], axis=0)
        cut = int(np.argmax(same))  # the last group starts here: rows are sorted
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None:
        yield held


def _components(tiles: DataFrame, classes: DataFrame, arrays_of: Callable[[DataFrame], DataFrame], share: int, keep: Rounds) -> DataFrame:
    """(class, root) of all classes in tiles, by rounds of offers until no class has one left.

    ``arrays_of`` gives the shingle arrays of classes.  The first round compares all pairs of every tile, so a class without an
    offer there has no partner and is nobody's: the arrays of all others serve every round.
    """
    members = classes.select("class", F.col("class").alias("root"), F.lit(-1.0).alias("past"), F.lit(0).cast("long").alias("past_id"))
    most, total, arrays = 1, classes.agg(F.sum("n")).first()[0] or 0, None
    while True:
        own = tiles.join(members, "class")
        mixed = own.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        own = keep.write(own.join(mixed.where("lo < hi").select("tile", "blocks"), "tile"), "open")
        found = keep.write(_offers(own.join(classes.select("class", "n", "sketch"), "class"), share, most), "found")
        # what a tile has to offer only shrinks, so one without offers is done with
        tiles = own.select("tile", "class").join(found.select("tile").distinct(), "tile")
        offers = keep.write(_nearest_of_all(found, most), "offers")
        keep.free_shuffles()
        if arrays is None:
            arrays = arrays_of(offers.select("class").distinct())
            keep.free_shuffles()
        moved = offers.join(classes.select("class", "n"), "class").agg(F.sum("n")).first()[0] or 0
        turns, decided = max(1, -(-moved // max(1, int(MOVED * total)))), None
        for turn in range(turns):
            part = offers.where(F.pmod(F.xxhash64(F.least("class", "other")), F.lit(turns)) == turn)
            part = keep.write(_decided(part, arrays, share), f"decided{turn}")
            decided = part if decided is None else decided.unionByName(part)
            keep.free_shuffles()
        done = decided.agg(F.count(F.lit(1)).alias("offers"), F.count_if("linked").alias("links")).first()
        if not done["offers"]:
            return members.select("class", "root")
        roots = components(decided.where("linked"), keep).select(F.col("v").alias("root"), F.col("root").alias("up"))
        got = offers.groupBy("class").agg(F.max(F.struct("far", "other")).alias("got"))
        joined = members.join(roots, "root", "left").join(got, "class", "left")
        members = keep.write(
            joined.select(
                "class",
                F.coalesce("up", "root").alias("root"),
                F.coalesce("got.far", "past").alias("past"),
                F.coalesce("got.other", "past_id").alias("past_id"),
            ),
            "members",
        )
        keep.free_shuffles()
        if 2 * done["links"] < done["offers"]:
            most *= MORE


def grouped(docs: DataFrame, k: int, share: int) -> tuple[DataFrame, DataFrame]:
    """(id, key, n, class) of every row and (class, root) of every class; class is null for an empty set.

    ``docs`` has (id, key, text); ``key`` is a hash that tells rows with one id apart.
    """
    keep = Rounds(docs.sparkSession)
    sets = parked(shingle_sets(docs, k), "sets")
    classes = sets.where("class is not null").groupBy("class").agg(
        F.min("id").alias("id"),
        F.max(F.struct("id", "key")).alias("chosen"),  # a row of the class, with or without an id
        F.min("n").alias("n"),
        F.min("sketch").alias("sketch"),
    )

    key = Window.partitionBy("key")
    shared = (
        tile_keys(docs, k, share)
        .repartition("key")
        .groupBy("key", "class")
        .agg(F.lit(1).alias("one"))
        .select(
            "class",
            F.min("class").over(key).alias("lo"),
            F.max("class").over(key).alias("hi"),
            F.bit_xor(F.xxhash64("class")).over(key).alias("tile"),
        )
        .where("lo < hi")
    )
    # tiles with the same members are one tile
    tiles = keep.write(shared.select("tile", "class").distinct(), "tiles")
    keep.free_shuffles()

    open_classes = keep.write(classes.join(tiles.select("class").distinct(), "class").drop("id"), "classes")
    keep.free_shuffles()

    def arrays_of(wanted: DataFrame) -> DataFrame:
        chosen = open_classes.join(wanted, "class").select(F.col("chosen.id").alias("own"), F.col("chosen.key").alias("key"))
        rows = docs.join(chosen, docs.id.eqNullSafe(chosen.own) & (docs.key == chosen.key), "left_semi")
        return keep.write_bucketed(shingle_arrays(rows, k), "class", "arrays")

    roots = _components(tiles, open_classes, arrays_of, share, keep)

    of_class = parked(classes.select("class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "components")
    keep.clear()
    return sets.select("id", "key", "n", "class"), of_class


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, share: int = 80) -> DataFrame:
    """One row of every component: the one with the smallest id (null last), of several with that id the one with the smallest hash of all
    columns.  Rows with an empty set are all kept, rows equal in all columns are one."""
    keyed = docs.withColumn("__key", F.xxhash64(*docs.columns))
    rows, roots = grouped(keyed.select(F.col(doc_id).cast("long").alias("id"), F.col("__key").alias("key"), F.col(text).alias("text")), k, share)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = rows.where("class is not null").groupBy("class").agg(F.min(order).alias("x")).join(roots, "class")
    chosen = first.groupBy("root").agg(F.min("x").alias("x")).select(F.col("x.key").alias("__key"))
    empty = rows.where("class is null").select(F.col("key").alias("__key"))
    return keyed.join(chosen.unionByName(empty).distinct(), "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, share: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; the id must be an integer."""
    rows, roots = grouped(docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("text")), k, share)
    least = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("id")).join(roots, "class")
    smallest = least.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = roots.join(smallest, "root").select("class", "component_id")
    return rows.join(of_class, "class", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
