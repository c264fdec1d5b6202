"""Language ID by Bayesian evidence fusion.

The posterior of a language is the product of four kinds of evidence: the likelihood of the text's letter trigrams, of
the language the markup declares, of the address suffix, and a prior of the host, smoothed towards its domain, that
towards the suffix-less whole. The tables of the last three are sums of the text posteriors, by grouped aggregation over
all rows; a row's own part is taken out of its host's. One more class, "und", stands for what is no language of the
model; its trigrams are all equally likely. Rows of that class, and texts without a letter, are rejected.

The trigram model is fitted on TRAIN_ROWS labelled rows with the smallest hashes, whole texts; all else covers all rows.

Cases: null and empty texts have no letter, so they are rejected. A null declaration, address or host is no evidence.
Ties go to the language that comes first in code point order. Equal rows get equal results, up to their own part in the
host's prior. Without labelled rows nothing can be told: lang is null and all rows with a letter are kept. An empty
table gives an empty result. Extra columns pass through `keep_languages` and are not read elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.llm.common import stage, text_hash, whole, with_made, without

#: Labelled rows that the trigram model is fitted on, at most.
TRAIN_ROWS = 4000
#: Cells of the trigram table of a language; strength of a parent's prior, in rows; prior and name of no language.
CELLS, STRENGTH, NONE_PRIOR, NONE = 1 << 14, 5.0, 0.01, "und"
EVIDENCE = ("declared", "suffix", "domain", "host")
#: A letter is in three trigrams, so each counts a third.
TEMPER = 1 / 3


def cells(text: str) -> np.ndarray:
    """Table cells of the text's trigrams (of UTF-8 bytes, lower case, runs of other characters as one blank)."""
    letters = "".join([c if c.isalpha() else " " for c in text.lower()])
    words = " ".join(letters.split())
    if not words:
        return np.zeros(0, np.int64)
    b = np.frombuffer(f" {words} ".encode(), np.uint8).astype(np.uint32)
    return ((b[:-2] * 65536 + b[1:-1] * 256 + b[2:]) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)


def count_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["label"], batch["text"]):
            total[lang] = total.get(lang, 0) + np.bincount(cells(text or ""), minlength=CELLS)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pd.DataFrame({"label": lang, "cell": at, "n": n[at].astype(np.int64)})


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages, and log chances [language, cell] with "und" as the last row, from columns doc_id, text, label."""
    order = F.xxhash64(F.col("doc_id"))
    known = labelled.filter("label is not null and doc_id is not null")
    chosen = [r[0] for r in known.select("doc_id").orderBy(order, "doc_id").limit(train_rows).collect()]  # at most train_rows ids
    sample = known.filter(F.col("doc_id").isin(chosen)) if chosen else known.limit(0)
    counts = sample.select("label", "text").mapInPandas(count_cells, "label string, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    names = sorted(found["label"].unique())
    table = np.full((len(names) + 1, CELLS), 0.5)
    for k, name in enumerate(names):
        own = found[found["label"] == name]
        table[k, own["cell"].to_numpy()] += own["n"].to_numpy()
    table[-1] = 1
    return names, np.log(table / table.sum(1, keepdims=True))


def primary(tag: Column) -> Column:
    """The primary part of a language tag, in lower case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(tag, "^\\s*([A-Za-z]+)", 1)), F.lit(""))


def host_of(address: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(address, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def tail(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def parent(host: Column) -> Column:
    """The host without its first label, if two or more are left: what it shares with its neighbours, never itself."""
    return F.when(F.size(F.split(host, r"\.")) > 2, F.regexp_replace(host, r"^[^.]*\.", ""))


def from_pages(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, suffix, domain and host of web pages."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#A-Za-z0-9]+;", " ")
    declared = primary(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1))
    host = host_of(F.col("url"))
    return pages.select("page_id", text.alias("text"), declared.alias("declared"), tail(host, 1).alias("suffix"), parent(host).alias("domain"), host.alias("host"))


def from_documents(docs: DataFrame) -> DataFrame:
    """The same evidence for documents: they declare `lang` and have a source for a host, no address."""
    none = F.lit(None).cast("string")
    return docs.select("doc_id", "text", primary(F.col("lang")).alias("declared"), none.alias("suffix"), none.alias("domain"), F.col("source").cast("string").alias("host"))


def shares(logs: np.ndarray) -> np.ndarray:
    """Chances from log chances, along the last axis."""
    e = np.exp(logs - logs.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def scored(rows: DataFrame, table: np.ndarray, prior: np.ndarray) -> DataFrame:
    """rows without text, with has_letter, t0, t1, ... (log likelihoods of the classes), r0, r1, ... (posteriors of the text alone)."""
    n = len(table)
    made = pa.schema([("has_letter", pa.bool_()), *[(f"{c}{k}", pa.float64()) for c in "tr" for k in range(n)]])

    def worker():
        def of(text):
            at = cells(text)
            ll = TEMPER * table[:, at].sum(1)
            own = shares(ll + np.log(prior)) if len(at) else np.zeros(n)
            return len(at) > 0, *map(float, ll - ll.max()), *map(float, own)

        return of

    return with_made(rows.withColumn("text", whole(F.col("text"))), "text", made, worker).drop("text")


def classify(rows: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """rows without text and evidence, with lang, posterior and kept."""
    own = [c for c in rows.columns if c not in ("text", *EVIDENCE)]
    n = len(names) + 1
    prior = np.append(np.full(n - 1, (1 - NONE_PRIOR) / max(1, n - 1)), NONE_PRIOR)
    df = stage(scored(rows, table, prior), "languages")
    if not names:
        return df.select(*own, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"), F.col("has_letter").alias("kept"))
    sums = [F.sum(f"r{k}") for k in range(n)]
    everything = np.array([x or 0.0 for x in df.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()])
    base = (everything + STRENGTH * prior) / (everything.sum() + STRENGTH)
    kinds = {}
    for by in EVIDENCE:
        of = df.filter(F.col(by).isNotNull()).groupBy(F.col(by).alias("value")).agg(*[s.alias(f"{by}_{k}") for k, s in enumerate(sums)])
        if by in ("declared", "suffix"):
            of = stage(of, by)
            kinds[by] = of.count() + 1
        df = df.join(of, F.col(by) == F.col("value"), "left").drop("value", by)
    schema = StructType([f for f in df.schema if f.name in own]).add("lang", "string").add("posterior", "double").add("kept", "boolean")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def matrix(prefix: str) -> np.ndarray:
                columns = [batch.column(f"{prefix}{k}").to_numpy(zero_copy_only=False) for k in range(n)]
                return np.stack(columns, 1).astype(float)

            text, part = matrix("t"), matrix("r")
            letter = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            logs = text
            for by, values in kinds.items():
                seen = matrix(f"{by}_")  # NaN where there is no such evidence
                logs = logs + np.where(np.isnan(seen), 0.0, np.log((np.nan_to_num(seen) + 0.5) / (everything + 0.5 * values)))
            chance = np.broadcast_to(base, text.shape)
            for by in ("domain", "host"):
                rest = np.maximum(0.0, np.nan_to_num(matrix(f"{by}_") - part))
                chance = (rest + STRENGTH * chance) / (rest.sum(1, keepdims=True) + STRENGTH)
            found = shares(logs + np.log(chance))
            best = found.argmax(1)
            lang = [[*names, NONE][k] if ok else NONE for k, ok in zip(best.tolist(), letter.tolist())]
            sure = np.where(letter, found.max(1).round(6), 0.0)
            made = [pa.array(lang, pa.string()), pa.array(sure), pa.array(letter & (best < n - 1))]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in schema if f.name in own], *made], names=schema.names)

    return df.mapInArrow(fuse, schema)


def document_model(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    return fit(docs.select("doc_id", "text", primary(F.col("lang")).alias("label")), train_rows)


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of documents (doc_id) and of web pages (page_id); the other id is null."""
    model = document_model(docs)
    of_docs = from_documents(docs).withColumn("page_id", F.lit(None).cast("long"))
    of_pages = from_pages(pages).withColumn("doc_id", F.lit(None).cast("long"))
    return classify(of_docs.unionByName(of_pages), *model).select("doc_id", "page_id", "lang", "posterior", "kept")


def keep_languages(docs: DataFrame) -> DataFrame:
    """The documents that are in a language, in all their columns."""
    rows = from_documents(docs).withColumn("text_sha256", text_hash(F.col("text")))
    return without(docs, classify(rows, *document_model(docs)).filter(~F.col("kept")))
