"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A window that also starts earlier (smaller id, or same id and earlier place) is repeated. Overlapping repeated windows
merge into maximal intervals, and the words of an interval are removed.

Three steps, each a shuffle of packed columns. (1) Tasks hash all windows and send them to the buckets their top bits
name, 7 to 8 bytes for the rest of a hash and one or two for its place; of equal windows in a task only the first is
sent, so a passage in a third of the documents is one entry per task. (2) Each bucket sorts its hashes and finds the
windows that are not the first. (3) Texts and repeated places meet by id and the texts are cut. Buckets and groups are
numbered by the size of the input, so a task's share is bounded.

Hashes have 64 bits, two different windows of n are taken for equal with a chance of n * n / 2**65.

Cases: a null text has no words. Texts below the window keep all words. Different texts of one id are documents of their
own, in the order of a hash of the text (the mark; 0 for ids with one text, but for those that share a bit of a bitmap,
sized by the ids with several texts, with one of these). Rows equal in id and text are one document. A null id counts as
the smallest. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import WORD, parts, stage, whole
from slotwise.llm.hashing import NO_ID, mixed, windows
from slotwise.llm.minhash import BITS_EACH, MOST_BITS, bit_of, bitmap

#: Words in a window.
WINDOW = 20
#: Words hashed at once in a task.
CHUNK_WORDS = 2_000_000
#: Windows of a bucket, and code points of text in a group, on average at most.
BUCKET_WINDOWS, GROUP_CHARS = 1_000_000, 8_000_000
WORDS = re.compile(WORD)


def planes(values: np.ndarray) -> bytes:
    """Small whole numbers, byte by byte: high bytes are nearly free."""
    import zstandard

    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(1).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def unplanes(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def pack(ids: np.ndarray, marks: np.ndarray, places: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ids, marks and places, sorted in this order: differences."""
    step = np.diff(ids, prepend=ids[:1]).view(np.uint64)
    other = np.diff(marks, prepend=marks[:1]).view(np.uint64)
    within = np.where((step == 0) & (other == 0), np.diff(places, prepend=0), places)
    within[:1] = places[:1]
    steps = (planes(np.concatenate((x[:1].view(np.uint64), d[1:]))) for x, d in ((ids, step), (marks, other)))
    return *steps, planes(within.astype(np.uint32))


def unpack(ids: bytes, marks: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step, other, within = unplanes(ids, np.uint64), unplanes(marks, np.uint64), unplanes(places, np.uint32).astype(np.int64)
    first = np.ones(len(step), bool)
    first[1:] = (step[1:] != 0) | (other[1:] != 0)
    total = np.cumsum(within)
    base = (total - within)[first]
    return np.cumsum(step).view(np.int64), np.cumsum(other).view(np.int64), total - np.repeat(base, np.diff(np.append(np.flatnonzero(first), len(step))))


def by_group(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group and its rows, in their order."""
    order = np.argsort(groups, kind="stable")
    cuts = np.flatnonzero(np.diff(groups[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(groups[rows[0]]), rows


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def chunks(batches: Iterator[pd.DataFrame], several: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, marks and texts, sorted by id and mark, of about CHUNK_WORDS words at a time; a mark is 0 without the id's bit."""
    have = np.frombuffer(several, np.uint8)
    ids, marks, texts, size = [], [], [], 0
    for batch in batches:
        bit = batch["bit"].to_numpy()
        own = np.where(have[bit >> 3] >> (bit & 7) & 1 == 1, batch["mark"].to_numpy(), 0)
        for i, m, t in zip(batch["doc_id"].to_numpy(), own, batch["text"]):
            ids.append(i)
            marks.append(m)
            texts.append((t or "").encode())
            size += len(texts[-1])
            if size >= 6 * CHUNK_WORDS:
                yield ordered(ids, marks, texts)
                ids, marks, texts, size = [], [], [], 0
    if ids:
        yield ordered(ids, marks, texts)


def ordered(ids: list, marks: list, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids, marks = np.array(ids, np.int64), np.array(marks, np.int64)
    order = np.lexsort((marks, ids))
    return ids[order], marks[order], [texts[k] for k in order]


def not_first(hashes: np.ndarray, ids: np.ndarray, marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of equal hashes, those that don't have the smallest id, mark and place."""
    order = np.lexsort((places, marks, ids, hashes))
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(h)))
    out = np.zeros(len(h), bool)
    for x in (ids[order], marks[order], places[order]):
        out[order] |= x != np.repeat(x[at], size)
    return out


def repeated_rows(ids: np.ndarray, marks: np.ndarray, places: np.ndarray, groups: int) -> Iterator[tuple]:
    order = np.lexsort((places, marks, ids))
    ids, marks, places = ids[order], marks[order], places[order]
    for group, rows in by_group(group_of(ids, groups)):
        yield group, *pack(ids[rows], marks[rows], places[rows])


def sent(batches: Iterator[pd.DataFrame], several: bytes, window: int, bits: int, groups: int) -> Iterator[pd.DataFrame]:
    """Step 1: windows by bucket; those repeated in the task go on to step 3 by way of any bucket (no hashes)."""
    width = (64 - bits + 7) // 8
    for ids, marks, texts in chunks(batches, several):
        once = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))  # of rows equal in id and text, one
        ids, marks, texts = ids[once], marks[once], [texts[k] for k in once]
        h, row, p = windows(np.arange(len(ids)), texts, window)
        i, m = ids[row], marks[row]
        again = not_first(h, i, m, p)
        rows = [(g % (1 << bits), g, *packed, b"") for g, *packed in repeated_rows(i[again], m[again], p[again], groups)]
        h, i, m, p = h[~again], i[~again], m[~again], p[~again]
        for bucket, at in by_group((h >> np.uint64(64 - bits)).astype(np.int64)):
            rest = np.ascontiguousarray(h[at]).view(np.uint8).reshape(-1, 8)[:, :width]
            rows.append((bucket, -1, *pack(i[at], m[at], p[at]), rest.tobytes()))
        yield pd.DataFrame(rows, columns=["bucket", "group", "ids", "marks", "places", "hashes"])


def counted(rows: pd.DataFrame, bits: int, groups: int) -> pd.DataFrame:
    """Step 2: the repeated windows of a bucket."""
    done = rows[rows["group"] >= 0]
    found = [(int(r.group), r.ids, r.marks, r.places) for r in done.itertuples()]
    got = [(*unpack(r.ids, r.marks, r.places), r.hashes) for r in rows[rows["group"] < 0].itertuples()]
    if got:
        width = (64 - bits + 7) // 8
        raw = np.frombuffer(b"".join(g[3] for g in got), np.uint8).reshape(-1, width)
        h = np.zeros((len(raw), 8), np.uint8)
        h[:, :width] = raw
        i, m, p = (np.concatenate([g[k] for g in got]) for k in (0, 1, 2))
        again = not_first(h.reshape(-1).view(np.uint64), i, m, p)
        found += repeated_rows(i[again], m[again], p[again], groups)
    return pd.DataFrame(found, columns=["group", "ids", "marks", "places"]).assign(texts=None)


def texts_sent(batches: Iterator[pd.DataFrame], several: bytes, groups: int) -> Iterator[pd.DataFrame]:
    """Texts by group, packed."""
    import zstandard

    for ids, marks, texts in chunks(batches, several):
        rows = []
        for group, at in by_group(group_of(ids, groups)):
            own = [texts[k] for k in at]
            body = zstandard.ZstdCompressor(3).compress(b"".join(own))
            rows.append((group, planes(ids[at]), planes(marks[at]), planes(np.array([len(t) for t in own], np.uint64)), body))
        yield pd.DataFrame(rows, columns=["group", "ids", "marks", "places", "texts"])


def intervals(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal intervals [from, to) that sorted windows cover, one a row."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(np.diff(starts) > window) + 1
    return np.stack((starts[np.append(0, new)], starts[np.append(new - 1, len(starts) - 1)] + window), 1)


def cut(rows: pd.DataFrame, window: int):
    """Step 3: id, number of words, intervals and text of each document of a group."""
    import zstandard

    got = [unpack(r.ids, r.marks, r.places) for r in rows.itertuples() if r.texts is None]
    ids, marks, places = (np.concatenate([g[k] for g in got] or [np.zeros(0, np.int64)]) for k in (0, 1, 2))
    order = np.lexsort((places, marks, ids))
    ids, marks, places = ids[order], marks[order], places[order]
    for r in rows.itertuples():
        if r.texts is None:
            continue
        body, at = zstandard.ZstdDecompressor().decompress(r.texts), 0
        for i, m, n in zip(unplanes(r.ids, np.int64), unplanes(r.marks, np.int64), unplanes(r.places, np.uint64)):
            text = body[at : at + int(n)].decode()
            at += int(n)
            lo, hi = np.searchsorted(ids, i), np.searchsorted(ids, i, "right")
            lo, hi = lo + np.searchsorted(marks[lo:hi], m), lo + np.searchsorted(marks[lo:hi], m, "right")
            yield i, text, intervals(np.unique(places[lo:hi]), window)


def digests(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    out = []
    for i, text, gone in cut(rows, window):
        words = WORDS.findall(text)
        kept, at = [], 0
        for lo, hi in gone.tolist():
            kept += words[at:lo]
            at = hi
        kept += words[at:]
        out.append((None if i == NO_ID else int(i), len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"]).astype({"doc_id": "Int64"})


def removals(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Texts with the intervals taken out from the first to the last character, and the intervals in words."""
    out = []
    for i, text, gone in cut(rows, window):
        spans = [m.span() for m in WORDS.finditer(text)] if len(gone) else []
        kept, at = [], 0
        for lo, hi in gone.tolist():
            kept.append(text[at : spans[lo][0]])
            at = spans[hi - 1][1]
        out.append((None if i == NO_ID else int(i), "".join(kept) + text[at:], [list(map(int, g)) for g in gone]))
    return pd.DataFrame(out, columns=["doc_id", "text", "removed"]).astype({"doc_id": "Int64"})


def _run(docs: DataFrame, window: int, of, schema: str) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = parts(spark, chars, GROUP_CHARS)
    bits = max(8, (parts(spark, chars, 5 * BUCKET_WINDOWS) - 1).bit_length())
    docs = docs.withColumn("mark", F.xxhash64(whole(F.col("text"))))
    texts_of = docs.groupBy(F.col("doc_id").alias("id")).agg(F.min("mark").alias("lo"), F.max("mark").alias("hi"))
    shared = stage(texts_of.filter("lo <> hi").select("id"), "shared")
    size = min(MOST_BITS, 1 << max(18, (BITS_EACH * shared.count()).bit_length()))
    docs = docs.withColumn("bit", bit_of("doc_id", size))
    several = bitmap(shared, size)
    marks = docs.mapInPandas(lambda b: sent(b, several, window, bits, groups), "bucket long, group long, ids binary, marks binary, places binary, hashes binary")
    repeated = marks.groupBy("bucket").applyInPandas(lambda r: counted(r, bits, groups), "group long, ids binary, marks binary, places binary, texts binary")
    texts = docs.mapInPandas(lambda b: texts_sent(b, several, groups), repeated.schema)
    return texts.unionByName(repeated).groupBy("group").applyInPandas(lambda r: of(r, window), schema)


def substring_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return _run(docs, window, digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, the text that is left, and the removed intervals of words."""
    return _run(docs, window, removals, "doc_id long, text string, removed array<array<long>>")
