"""Phrase collocation mining: n-gram counts from FM-indexes over word ids, and scores of the frequent phrases.

A shard is a bounded run of words of one language. Its words become ids, its pieces a sequence with separators, and two
indexes are built: of the sequence and of its reverse, each as the symbols before the suffixes in sorted order (the
Burrows-Wheeler transform) with the ranks of those symbols. An n-gram is an interval of suffixes in both. One step
extends all intervals of a length by all symbols that stand before (or, in the reverse index, after) them; both
intervals stay in step. Suffixes are sorted by as many words as the longest n-gram has, which is all that intervals of
that length need. A shard yields each n-gram with its count; Spark sums the shards.

A phrase of three words that occurs `least` times has two parts of two words that occur as often. So there are two
passes: words and pairs are counted first, then only intervals of pairs that may be frequent are extended to the right.
The frequent pairs reach the tasks as a bitmap of their hashes, at most PAIR_BITS long. Pairs that it lets through by
mistake cost rows but change nothing, as all counts are exact.

Cases: a null text is empty, a null language is `und`; languages are taken as they are. Rows of one id, or equal rows, all
count. Texts are read whole; a run of words that ends inside a text is completed by the n-grams across its end. An empty
table gives an empty result. Only text and lang are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm.common import parts, stage, whole
from slotwise.llm.hashing import mixed, word_hashes

#: Words of a shard; bytes of text that are split at once; rows of a batch of n-grams.
SHARD, BLOCK, BATCH = 1 << 20, 1 << 22, 1 << 16
#: Bits of the map of frequent pairs: so many for each pair, and at most (32 MB).
BITS_EACH, PAIR_BITS = 16, 1 << 28
#: Bits of one row of the map's table.
ROW_BITS = 32768
#: Stands between pieces; no byte of UTF-8.
GAP = b"\xff"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
LEAST, KEPT, MOST_INSIDE = 10, 2000, 50
ODD = np.uint64(0x9E3779B97F4A7C15)

TABLE = bytearray(range(256))
TABLE[0x41:0x5B] = range(0x61, 0x7B)
TABLE[0x09] = 0x20
for _byte in PIECE_ENDS:
    TABLE[_byte] = GAP[0]
TABLE = bytes(TABLE)

GRAMS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])
GRAM_COLUMNS = "lang string, phrase string, size int, n long"


def tokens(text: bytes, least: int) -> Iterator[list[bytes]]:
    """Words and gaps of a text, block by block; no word is cut, and all blocks but the last have `least` of them."""
    at, out = 0, []
    while at < len(text):
        end = min(at + BLOCK, len(text))
        while end < len(text) and TABLE[text[end]] not in (0x20, GAP[0]):
            end += 1
        out += text[at:end].translate(TABLE).replace(GAP, b" \xff ").split()
        if len(out) >= least:
            yield out
            out = []
        at = end
    if out:
        yield out


class Index:
    """FM-index of a sequence of ids, 0 for gaps, sorted by `depth` symbols."""

    def __init__(self, seq: np.ndarray, depth: int):
        n, shift = len(seq), int(seq.max(initial=0)).bit_length()
        order = np.arange(n)
        for start in range(depth - 1, -1, -(62 // max(shift, 1) or 1)):  # as many symbols as a 64-bit key holds
            first = max(0, start + 1 - (62 // max(shift, 1) or 1))
            key = np.zeros(n, np.int64)
            for k in range(first, start + 1):
                key = (key << shift) | np.roll(seq, -k)
            order = order[np.argsort(key[order], kind="stable")]
        self.n = n
        self.before = np.roll(seq, 1)[order]
        # Row numbers grouped by the symbol before them: rank of a symbol at a row is a binary search.
        self.ranks = np.sort(self.before.astype(np.int64) * (n + 1) + np.arange(n))

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row of the suffixes that start with the symbol and go on with suffixes from `row` on."""
        return np.searchsorted(self.ranks, symbol.astype(np.int64) * (self.n + 1) + row)


class BothWays:
    """Index of a sequence and of its reverse. Intervals are (low, low in the reverse, count), one for each n-gram."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.n, self.seq, self.depth = len(seq), seq, depth

    @cached_property
    def left(self) -> Index:
        return Index(self.seq, self.depth)

    @cached_property
    def right(self) -> Index:
        return Index(self.seq[::-1], self.depth)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([self.n], np.int64)

    @staticmethod
    def _extend(index: Index, low: np.ndarray, other: np.ndarray, count: np.ndarray):
        """All one-symbol extensions of all intervals: (owner, symbol, low, low in the other index, count)."""
        owner = np.repeat(np.arange(len(low)), count)
        row = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + low[owner]
        width = int(index.before.max(initial=0)) + 1
        key, grown = np.unique(owner * width + index.before[row], return_counts=True)
        owner, symbol = key // width, key % width
        # In the other index the extensions of an interval follow each other by symbol.
        start = np.cumsum(grown) - grown
        first = np.searchsorted(owner, np.arange(len(low)))
        inside = start - start[np.minimum(first, max(len(start) - 1, 0))][owner]
        made = owner, symbol, index.rank(symbol, low[owner]), other[owner] + inside, grown
        return [x[symbol > 0] for x in made]

    def to_left(self, low, reverse, count):
        owner, symbol, low, reverse, count = self._extend(self.left, low, reverse, count)
        return owner, symbol, (low, reverse, count)

    def to_right(self, low, reverse, count):
        owner, symbol, reverse, low, count = self._extend(self.right, reverse, low, count)
        return owner, symbol, (low, reverse, count)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return word_hashes(b" ".join(words))[0]


def pair_places(lang: np.ndarray | np.uint64, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Place in the map of each pair of word hashes in a language, given as a hash; bits is a power of two."""
    return (mixed(first * ODD + second + lang) & np.uint64(bits - 1)).astype(np.int64)


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(zlib.crc32(lang.encode()))


class Shard:
    """Words of one language as ids, until they are counted."""

    def __init__(self, lang: str, depth: int, pairs: np.ndarray | None):
        self.lang, self.depth, self.pairs = lang, depth, pairs
        self.tail: list[bytes] = []  # last words of a text that goes on
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {GAP: 0}
        self.seqs: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        ids = self.ids
        self.seqs.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
        self.size += len(words)

    def rows(self, phrases: pa.Array, size: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(counts), BATCH):
            n = min(BATCH, len(counts) - at)
            columns = [pa.array([self.lang] * n, pa.string()), phrases.slice(at, n), pa.array([size] * n, pa.int32()), pa.array(counts[at : at + n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=GRAMS)

    def across(self, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        """N-grams that begin in the tail and end in `words`, the next words of the same text."""
        near = [*self.tail, *words[: self.depth - 1]]
        cut = len(self.tail)
        sizes = range(2, self.depth + 1) if self.pairs is None else [self.depth]
        for size in sizes:
            found = [near[k : k + size] for k in range(max(0, cut - size + 1), cut) if k + size <= len(near)]
            found = [b" ".join(g).decode(errors="replace") for g in found if GAP not in g]
            yield from self.rows(pa.array(found, pa.string()), size, np.ones(len(found), np.int64))

    def counted(self, goes_on: bool) -> Iterator[pa.RecordBatch]:
        """N-grams of the words so far: up to pairs without a map of pairs, else those of `depth` words."""
        seq = np.concatenate([*self.seqs, np.zeros(1, np.int32)]).astype(np.int64)
        words = list(self.ids)
        names = pa.array([w.decode(errors="replace") if w != GAP else "" for w in words], pa.string())
        total = int((seq > 0).sum())
        if total:
            joined = lambda *ids: pc.binary_join_element_wise(*[names.take(pa.array(i)) for i in ids], " ")
            index = BothWays(seq, self.depth)
            _, second, ones = index.to_left(*index.all())
            owner, first, twos = index.to_left(*ones)
            if self.pairs is None:
                yield from self.rows(pa.nulls(1, pa.string()), 0, np.array([total]))
                yield from self.rows(names.take(pa.array(second)), 1, ones[2])
                yield from self.rows(joined(first, second[owner]), 2, twos[2])
            else:
                hashes = np.concatenate([np.zeros(1, np.uint64), hashes_of(words[1:])])
                def may(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                    place = pair_places(lang_hash(self.lang), hashes[a], hashes[b], len(self.pairs) * 8)
                    return (self.pairs[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)

                gram = np.stack([first, second[owner]])
                keep = may(*gram)
                gram, interval = gram[:, keep], tuple(x[keep] for x in twos)
                while len(gram) < self.depth:
                    owner, last, interval = index.to_right(*interval)
                    keep = may(gram[-1][owner], last)
                    gram, interval = np.vstack([gram[:, owner], last])[:, keep], tuple(x[keep] for x in interval)
                yield from self.rows(joined(*gram), len(gram), interval[2])
        if goes_on:
            self.tail = [words[i] for i in seq[:-1][-(self.depth - 1) :]]
        self.clear()


def gram_rows(depth: int, pairs: np.ndarray | None = None):
    """For mapInArrow over (lang, text as bytes): (lang, phrase, size, n) of each shard; size 0 has the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang = lang.as_py()
                shard = shards.setdefault(lang, Shard(lang, depth, pairs))
                for words in tokens(text.as_py(), depth):
                    if shard.tail:
                        yield from shard.across(words)
                        shard.tail = []
                    shard.add(words)
                    held += len(words)
                    if held >= SHARD:
                        for other in shards.values():
                            yield from other.counted(other is shard)
                        held = 0
                shard.tail = []
                if shard.seqs:
                    shard.seqs.append(np.zeros(1, np.int32))
        for shard in shards.values():
            yield from shard.counted(False)

    return run


def summed(docs: DataFrame, depth: int, least: int, pairs: np.ndarray | None = None) -> DataFrame:
    """lang, phrase, size, n of all phrases with `least` occurrences (size 0: words of the language)."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole(F.col("text")).cast("binary").alias("text"))
    grams = rows.mapInArrow(gram_rows(depth, pairs), GRAM_COLUMNS)
    return grams.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter((F.col("size") == 0) | (F.col("n") >= least))


def pair_map(frequent: DataFrame, most_bits: int = PAIR_BITS) -> np.ndarray:
    """Bitmap of the hashes of the phrases of two words. Only its rows come to the driver, most_bits at most."""
    twos = frequent.filter("size = 2").select("lang", F.col("phrase").cast("binary").alias("phrase"))
    bits = min(most_bits, 1 << max(18, math.ceil(math.log2(BITS_EACH * max(twos.count(), 1)))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([lang_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
            hashes = hashes_of(batch.column("phrase").to_pylist())
            place = np.unique(pair_places(langs, hashes[::2], hashes[1::2], bits))
            yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    rows = twos.mapInArrow(places, "place long").groupBy(F.expr(f"place div {ROW_BITS}").alias("row"))
    rows = rows.agg(F.bitmap_construct_agg(F.expr(f"place % {ROW_BITS}")).alias("bitmap")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r["row"] * ROW_BITS // 8 :][: ROW_BITS // 8] = np.frombuffer(r["bitmap"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, depth: int = 3, least: int = LEAST) -> DataFrame:
    """lang, phrase, size, n of all phrases up to `depth` words with `least` occurrences. Eager: a stage for each length from two on."""
    found = stage(summed(docs, 2, least), "grams")
    pairs, out = None, found
    for size in range(3, depth + 1):
        pairs = pair_map(found) if pairs is None else pairs
        longer = stage(summed(docs, size, least, pairs), "grams")
        out = out.unionByName(longer)
    return out


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in decimals of 38 digits: exact for counts below 10^15."""
    whole_number = lambda c, digits: c.cast(f"decimal({digits},0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * whole_number(a, 15) * whole_number(a, 15)
    return F.call_function("div", top, whole_number(l, 18) * whole_number(r, 18))


def collocations(docs: DataFrame, depth: int = 3, least: int = LEAST, kept: int = KEPT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases. Eager.

    All tables from here on hold frequent phrases only. Each cut of a candidate asks for the counts of both sides, which
    are frequent too. A common word is a hot key on one side of that join, which adaptive execution splits.
    """
    grams = frequent_phrases(docs, depth, least)
    counts = grams.filter("size > 0").select("lang", "phrase", F.col("n").alias("count"))
    candidates = grams.filter("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    side = lambda start, length: F.concat_ws(" ", F.slice(words, start, length))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    asked = cuts.select(
        "lang", "phrase", "size", "a", "k",
        F.inline(F.array(
            F.struct(F.lit("l").alias("side"), side(F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit("r").alias("side"), side(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")),
        )),
    )
    have = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "count")
    answered = asked.join(have, (F.col("lang") == F.col("_lang")) & (F.col("part") == F.col("_part")))
    of = lambda s: F.max(F.when(F.col("side") == s, F.col("count")))
    cut = answered.groupBy("lang", "phrase", "size", "a", "k").agg(of("l").alias("l"), of("r").alias("r"))
    cut = cut.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    scored = cut.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The longest candidates have none that contains them; those of one word less are looked up from their extensions.
    longer = candidates.filter("size > 2").select("lang", "a", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"), words.alias("words"))
    inside = longer.select("lang", "a", "length", "words", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    inside = inside.groupBy(F.col("lang").alias("_lang"), F.concat_ws(" ", F.slice("words", F.col("start"), F.col("length"))).alias("_phrase")).agg(F.max("a").alias("most"))
    left = scored.join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
    left = left.filter(F.coalesce(100 * F.col("most"), F.lit(0)) < MOST_INSIDE * F.col("a"))
    return first_of_each(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), kept).join(
        grams.filter("size = 0").select(F.col("lang").alias("_lang"), "n"), F.col("lang") == F.col("_lang")
    ).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def first_of_each(rows: DataFrame, kept: int) -> DataFrame:
    """The first rows of each language, numbered. First among parts of a language, then among what is left of them."""
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    n_parts = parts(rows.sparkSession, 0, 1)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(n_parts)))
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    few = salted.withColumn("place", part).filter(F.col("place") <= kept).drop("place", "salt")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return few.withColumn("rank", rank).filter(F.col("rank") <= kept)
