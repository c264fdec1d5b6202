"""MinHash near-dedup with bottom-k sketches of one hash function.

(1) A document's shingles are hashed; equal sets are one class. A class retains its SKETCH smallest hashes, and in each
of BANDS residue classes of the hash the DEPTH smallest (a bottom-k sketch of that part of the set).
(2) Inverted lists: the retained values of a part are one key, so documents that share a passage or phrases, but little
else, rarely meet. A pair at the least similarity has a part in common but for a chance of (1 - 0.8**3)**28 = 2e-9.
Sets below SMALL keep their parts whole, in as many parts as their size lets differ and half as many more, by classes of
size (a linked pair is in the same class or the next); the chance is below 3e-6 for the smallest and far less for others.
(3) In each list all members are held against the smallest id: sizes, then the sketch of the union, then the exact
Jaccard of the full sets. Groups of near copies become components there, at a cost linear in their size.
(4) In lists whose members are still in several components, the pairs of different components are held against each
other in blocks, in the same order of tests; a pair that shares several lists is taken in one only.
(5) Components of all links.

Full sets are computed again for the documents that have a candidate, chosen by a bitmap of fixed size.

Cases: null and empty texts have no shingles and no links. Rows of one id are one document: they are linked if any of
their rows is. A null id counts as the smallest and comes back as null. Equal texts are linked through their class. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage, without
from slotwise.llm.components import components
from slotwise.llm.hashing import NO_ID, mixed, windows

#: Words of a shingle, and least percentage of the Jaccard similarity.
SHINGLE, PERCENT = 5, 80
#: Hashes that a sketch retains; how many of them a linked pair has in common (but for a chance of 1e-8).
SKETCH, OVERLAP = 32, 12
#: Parts of a set and values retained of each, for the inverted lists; sizes below which sets are kept whole.
BANDS, DEPTH, SMALL = 28, 3, 80
#: Members of one hub in a task; shingles of a block in step 4.
FAN, BLOCK_SHINGLES = 512, 500_000
#: Bits of the bitmap of wanted ids for each of them, and at most (32 MB); more ids are joined instead.
BITS_EACH, MOST_BITS = 16, 1 << 28
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; of the whole text if it has fewer words."""
    data = [(t or "").encode().translate(LOWER) for t in texts]
    rows = np.arange(len(data), dtype=np.int64)
    found = [windows(rows, data, n)[:2] for n in range(words, 0, -1)]
    cuts = [np.searchsorted(i, np.arange(len(data) + 1)) for _, i in found]
    for k in rows:
        for (h, _), c in zip(found, cuts):
            if c[k] < c[k + 1]:
                yield np.unique(h[c[k] : c[k + 1]])
                break
        else:
            yield np.zeros(0, np.uint64)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def part_keys(values: np.ndarray, parts: int, depth: int, salt: int) -> np.ndarray:
    """A key for each part of a set that isn't empty: a hash of its `depth` smallest values."""
    part = (mixed(values) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, values = part[order], values[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
    mark = np.uint64(2 * (salt * BANDS * 4) + 1) + 2 * part.astype(np.uint64)
    return np.add.reduceat(np.where(place < depth, mixed(values ^ mixed(mark)), 0).astype(np.uint64), first)


def list_keys(values: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set for the inverted lists."""
    n, ratio, keys = len(values), 100 / percent, [np.zeros(0, np.uint64)]
    if n >= SMALL / ratio:
        keys.append(part_keys(values, BANDS, DEPTH, 0))
    if n and n <= SMALL:
        size = next(g for g in range(1000) if n < ratio ** (g + 1))
        for group in (size, size + 1):
            differ = int((100 - percent) * 2 * ratio ** (group + 1) / (100 + percent))  # values that a linked pair does not share
            if differ:
                parts = BANDS if differ == 1 else min(BANDS, max(12, -(-3 * differ // 2)))
                keys.append(part_keys(values, parts, n, group + 1))
    return np.concatenate(keys)


def sketched(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """id, n (size of the set), set (128-bit hash of the set), sketch (its smallest hashes, as unsigned numbers), keys."""
    def run(batches):
        for b in small_batches(batches):
            sets = list(shingle_sets(b.column("text").to_pylist(), words))
            numbers = [pa.array([x.view(np.int64) for x in xs], pa.list_(pa.int64())) for xs in ([s[:SKETCH] for s in sets], [list_keys(s, percent) for s in sets])]
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), *numbers], names=["id", "n", "set", "sketch", "keys"])

    return docs.mapInArrow(run, "id long, n long, set binary, sketch array<long>, keys array<long>")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """value, id, n, and of the list: hub (its smallest id), size, shingles; lists of one are left out before anything else."""
    entries = classes.select("id", F.explode("keys").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("value")
    entries = stage(entries.join(shared, "value", "left_semi"), "entries").join(classes.select("id", "n"), "id")
    lists = entries.groupBy("value").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    return stage(entries.join(lists, "value"), "lists")


def near_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def union_estimate(a: Column, b: Column, percent: int) -> Column:
    """Whether the sketch of the union allows a link; exact if it holds the whole union."""
    union = F.slice(F.transform(F.array_sort(F.transform(F.array_union(a, b), flip)), flip), 1, SKETCH)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    full = (F.size(a) < SKETCH) & (F.size(b) < SKETCH) & (F.size(F.array_union(a, b)) <= SKETCH)
    return F.when(full, common * 100 >= F.size(union) * percent).otherwise(common >= F.least(F.lit(OVERLAP), F.ceil(F.size(union) * percent / F.lit(100))))


def flip(x: Column) -> Column:
    """Order of unsigned numbers (its own inverse)."""
    return x.bitwiseXOR(F.lit(NO_ID))


def bit_of(column: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(bits))


def bitmap(wanted: DataFrame, bits: int) -> bytes:
    """`bits` bits, of which those of the wanted ids are set."""
    placed = wanted.select(bit_of("id", bits).alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("k"))
    flat = np.zeros(bits // 8, np.uint8)
    for r in placed.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("map")).collect():
        flat[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["map"], np.uint8)
    return flat.tobytes()


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """id, set (bytes of the sorted hashes) of the wanted ids.

    A bitmap sized by their number keeps most other texts from being read again; the few it lets through do no harm. Where
    it would not fit, the texts are joined to the ids.
    """
    bits = 1 << max(18, (BITS_EACH * wanted.count()).bit_length())
    small = bits <= MOST_BITS
    flat = bitmap(wanted, bits) if small else b""

    def run(batches):
        have = np.frombuffer(flat, np.uint8)
        for b in small_batches(batches):
            if small:
                at = b.column("bit").to_numpy()
                b = b.filter(pa.array(have[at >> 3] >> (at & 7) & 1 == 1))
            sets = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], names=["id", "set"])

    if not small:
        docs = docs.join(wanted.select(F.col("id").alias("_wanted")).distinct(), F.col("id") == F.col("_wanted"), "left_semi")
    made = docs.withColumn("bit", bit_of("id", bits)).mapInArrow(run, "id long, set binary")
    return stage(made.filter(F.length("set") > 0), "sets")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * 100 >= (len(a) + len(b) - both) * percent


def star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, id) that are links. A hub's set goes to as many tasks as its members fill."""
    tasks = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("tasks"))
    members = pairs.join(tasks, "hub").select("id", "hub", F.pmod(F.xxhash64("id"), F.col("tasks")).cast("int").alias("task"), F.lit(False).alias("first"))
    hubs = tasks.select(F.col("hub").alias("id"), "hub", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(True).alias("first"))
    rows = members.unionByName(hubs).join(sets, "id").repartition("hub", "task").sortWithinPartitions("hub", "task", F.desc("first"))

    def run(batches):
        at, own = None, []
        for b in batches:
            out = []
            for hub, task, i, first, raw in zip(*(b.column(c).to_pylist() for c in ("hub", "task", "id", "first", "set"))):
                s = np.frombuffer(raw, np.uint64)
                if first:
                    own = [*own, s] if at == (hub, task) else [s]
                    at = (hub, task)
                elif any(linked(s, o, percent) for o in own):
                    out.append((hub, i))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


BLOCK = ("value", "first", "second")


def blocks(entries: DataFrame) -> DataFrame:
    """Rows of `entries` for each pair of blocks of their list: value, first, second, side (0, 1, or 2 for both)."""
    count = F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("id", "value"), count).cast("int")
    df = entries.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    df = df.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other"), "side": side})
    return df.drop("block", "other").repartition(*BLOCK).sortWithinPartitions(*BLOCK)


def in_groups(batches: Iterator[pa.RecordBatch], keys: tuple) -> Iterator[list[dict]]:
    """Rows of one key at a time, from sorted rows."""
    rows = (r for b in batches for r in b.to_pylist())
    for _, own in groupby(rows, lambda r: tuple(r[k] for k in keys)):
        yield list(own)


def cross_pairs(rows: list[dict], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block whose components differ, whose sizes allow a link, and whose first common list this is."""
    comp, n, side = (np.array([r[c] for r in rows], np.int64) for c in ("component", "n", "side"))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    low, high, value = np.minimum, np.maximum, rows[0]["value"]
    some = [{x for x in r["keys"] if x < value} for r in rows]
    a_out, b_out = [], []
    for i in left:
        ok = right[(comp[right] != comp[i]) & (low(n[right], n[i]) * 100 >= high(n[right], n[i]) * percent)]
        if side[i] == 2:
            ok = ok[(side[ok] != 2) | (ok > i)]
        if some[i] and len(ok):
            ok = ok[[some[i].isdisjoint(some[j]) for j in ok]]
        a_out.append(np.full(len(ok), i))
        b_out.append(ok)
    none = np.zeros(0, np.int64)
    return np.concatenate(a_out or [none]), np.concatenate(b_out or [none])


def allowed(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """union_estimate for rows of two arrays of sketches, padded with the largest number."""
    both = np.sort(np.concatenate((a, b), 1), 1)
    top = np.iinfo(np.uint64).max
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != top)
    place = np.cumsum(~again & (both != top), 1)
    common = (again & (place <= SKETCH)).sum(1)
    size = np.minimum(place[:, -1], SKETCH)
    full = (n_a < SKETCH) & (n_b < SKETCH) & (place[:, -1] <= SKETCH)
    return np.where(full, common * 100 >= size * percent, common >= np.minimum(OVERLAP, -(-size * percent // 100)))


def block_candidates(entries: DataFrame, percent: int) -> DataFrame:
    """value, id of the members that have a candidate in another component of the list."""
    def run(batches):
        for rows in in_groups(batches, BLOCK):
            i, j = cross_pairs(rows, percent)
            if not len(i):
                continue
            sketch = np.full((len(rows), SKETCH), np.iinfo(np.uint64).max, np.uint64)
            for k, r in enumerate(rows):
                sketch[k, : len(r["sketch"])] = np.array(r["sketch"], np.int64).view(np.uint64)
            n, found = np.array([r["n"] for r in rows], np.int64), set()
            for at in range(0, len(i), 50_000):
                p, q = i[at : at + 50_000], j[at : at + 50_000]
                ok = allowed(sketch[p], sketch[q], n[p], n[q], percent)
                found |= set(p[ok].tolist()) | set(q[ok].tolist())
            if found:
                own = sorted({rows[k]["id"] for k in found})
                yield pa.RecordBatch.from_arrays([pa.array([rows[0]["value"]] * len(own)), pa.array(own)], names=["value", "id"])

    return blocks(entries).mapInArrow(run, "value long, id long")


def block_links(entries: DataFrame, percent: int) -> DataFrame:
    """Links that join different components, at most one a member; pairs that are joined already are not tested."""
    def run(batches):
        for rows in in_groups(batches, BLOCK):
            i, j = cross_pairs(rows, percent)
            sets, top, out = [np.frombuffer(r["set"], np.uint64) for r in rows], {}, []

            def find(c):
                while (up := top.get(c, c)) != c:
                    c = up
                return c

            for x, at in groupby(range(len(i)), i.__getitem__):
                ys = [y for y in j[list(at)].tolist() if find(rows[y]["component"]) != find(rows[x]["component"])]
                if not ys:
                    continue
                cat = np.concatenate([sets[y] for y in ys])
                size = np.array([len(sets[y]) for y in ys])
                place = np.minimum(np.searchsorted(sets[x], cat), len(sets[x]) - 1)
                both = np.add.reduceat((sets[x][place] == cat).astype(np.int64), np.cumsum(size) - size)
                for y in np.array(ys)[both * 100 >= (size + len(sets[x]) - both) * percent].tolist():
                    a, b = find(rows[x]["component"]), find(rows[y]["component"])
                    if a != b:
                        top[a] = b
                        out.append((rows[x]["id"], rows[y]["id"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return blocks(entries).mapInArrow(run, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between classes, enough for their components."""
    lists = inverted_lists(classes)
    sketch = classes.select("id", "n", "sketch")
    of_hub = sketch.select(F.col("id").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    pairs = lists.filter("id <> hub").select("hub", "id", "n").distinct()
    sized = pairs.join(of_hub.drop("hub_sketch"), "hub").filter(near_size(F.col("n"), F.col("hub_n"), percent)).select("hub", "id")
    close = sized.join(of_hub, "hub").join(sketch.drop("n"), "id").filter(union_estimate(F.col("sketch"), F.col("hub_sketch"), percent))
    pairs = stage(close.select("hub", "id"), "pairs")
    sets = full_sets(docs, pairs.select("id").union(pairs.select("hub")), words)
    stars = stage(star_links(pairs, sets, percent), "stars")

    found = components(stars)
    rest = lists.filter("size > 2").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = rest.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("value")
    rest = stage(rest.join(several, "value", "left_semi"), "rest")
    shared = rest.groupBy("id").agg(F.collect_list("value").alias("keys"))  # a class has a few dozen keys at most
    of_class = shared.join(sketch.drop("n"), "id")
    chosen = stage(block_candidates(rest.join(of_class, "id"), percent).distinct(), "chosen")
    sets = full_sets(docs, chosen, words)
    last = rest.join(chosen, ["value", "id"], "left_semi").join(shared, "id").join(sets, "id")
    return stars.unionByName(block_links(last, percent))


def near_duplicates(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    rows = stage(sketched(docs, words, percent), "sketches")
    classes = rows.filter("n > 0").groupBy("set").agg(F.min(F.struct("id", "n", "sketch", "keys")).alias("c"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes.select("set", "copies", "c.*"), "classes")
    again = stage(rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("id"), "again")
    found = components(links(docs, classes, words, percent).unionByName(same_id(rows, classes, again)))
    of_class = classes.join(found, "id", "left").select(F.col("set").alias("_set"), F.coalesce("component", "id").alias("component"), "copies", F.col("component").alias("_linked"))
    of_class = of_class.filter("copies > 1 or _linked is not null")
    out = rows.filter("n > 0").join(of_class.drop("copies", "_linked"), F.col("set") == F.col("_set"), "left").select("id", "n", "component")
    empty = rows.filter("n = 0").join(found.join(again, "id", "left_semi"), "id", "left").select("id", "n", "component")
    component = F.coalesce("component", "id")
    null = lambda c: F.nullif(c, F.lit(NO_ID))
    return out.unionByName(empty).select(null(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), null(component).alias("component_id"), (component == F.col("id")).alias("kept"))


def same_id(rows: DataFrame, classes: DataFrame, again: DataFrame) -> DataFrame:
    """Links (a, b) from an id that several rows have to the class of each of them."""
    own = rows.filter("n > 0").join(again, "id", "left_semi").select(F.col("id").alias("a"), "set").distinct()
    return own.join(classes.select("set", F.col("id").alias("b")), "set").select("a", "b")


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, the one with the smallest id, in all columns."""
    return without(docs, near_duplicates(docs, **options).filter(~F.col("kept")))
