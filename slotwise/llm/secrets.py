"""Secret scans: fixed patterns, and a battery of randomness tests on other tokens.

A token's encoding is inferred from its characters. It passes the battery if a chi-squared test of its alphabet, a runs
test and a serial-correlation test together do not speak against equally likely, independent symbols. What it must
beat is ordinary text: a table of neighbouring characters, counted over all texts outside such tokens, gives the likelihood of the token as
text. If the token is text, a likelihood ratio of x or more has a chance of 1/x at most, whatever the length; on
that bound the false-discovery rate is controlled among all tokens of a length class, so that many short tokens need
more evidence than a few long ones.

Cases: a null text is empty and has no spans. Rows of one id are scanned one by one. Texts are scanned whole. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage, whole, with_made

# The patterns of known secrets, in the order of their kinds. A match shorter than the bound is dropped
# after matching (for `assign`, group 1 counts); runs of one class can carry the bound in the pattern.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 6

#: Tokens that the battery tests.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}=*")
#: Lower bounds of the length classes.
CLASSES = (16, 20, 24, 32, 40, 64, 128)
#: False discoveries among the discoveries of a length class; chance at which the battery rejects a random token.
RATE, REJECT = 0.01, 0.001
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Alphabets by name, smallest first: the first that holds a token is its encoding.
ENCODINGS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "lower": "abcdefghijklmnopqrstuvwxyz", "UPPER": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": SYMBOLS[:52], "base62": SYMBOLS[:62], "base64": SYMBOLS[:64], "base64url": SYMBOLS[:62] + "-_", "any": SYMBOLS[:66],
}
OTHER = len(SYMBOLS)
CODE = np.full(256, OTHER, np.uint8)
CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
WIDTH = OTHER + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encoding(token: str) -> str | None:
    """None for digits alone, which are too common in text to be told from random ones."""
    own = set(token)
    return None if token.isdigit() else next((n for n, a in ENCODINGS.items() if own <= set(a)), None)


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, alphabet: str) -> float:
    """Chance of results as uneven as the token's if its symbols are equally likely and independent."""
    n, m = len(token), len(alphabet)
    at = np.array([alphabet.index(c) for c in token])
    counts = np.bincount(at, minlength=m)
    pairs = n * (n - 1) / m  # chi-squared by its number of equal pairs, whose mean and variance are exact for short tokens
    chi = ((counts * (counts - 1)).sum() - pairs) / math.sqrt(2 * pairs * (1 - 1 / m))
    high = at >= m / 2
    runs, a = 1 + np.count_nonzero(high[1:] != high[:-1]), np.count_nonzero(high)
    mean = 1 + 2 * a * (n - a) / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    few = (runs - mean) / math.sqrt(spread) if spread > 0 else -math.sqrt(n)
    centred = at - (m - 1) / 2
    serial = (centred[1:] * centred[:-1]).sum() / ((m * m - 1) / 12) / math.sqrt(n - 1)
    each = [max(1e-300, p) for p in (upper_tail(chi), 2 * upper_tail(abs(few)), 2 * upper_tail(abs(serial)))]
    half = -sum(map(math.log, each))  # Fisher's sum, halved; its tail for six degrees of freedom
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def codes(text: str) -> np.ndarray:
    return CODE[np.frombuffer(text.encode(), np.uint8)].astype(np.int64)


def count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(WIDTH * WIDTH, np.int64)
    for batch in batches:
        for text in batch["text"]:
            if text:
                c = codes(TOKEN.sub(" ", text))
                total += np.bincount(c[:-1] * WIDTH + c[1:], minlength=WIDTH * WIDTH)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"pair": at, "n": total[at]})


def text_model(docs: DataFrame) -> np.ndarray:
    """Log chance of each character after each other one, over all texts without the tokens: WIDTH * WIDTH numbers, whatever the input."""
    counts = np.full(WIDTH * WIDTH, 0.5)
    for pair, n in docs.select("text").mapInPandas(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        counts[pair] += n
    counts = counts.reshape(WIDTH, WIDTH)
    return np.log(counts / counts.sum(1, keepdims=True))


def evidence(token: str, model: np.ndarray) -> float:
    """Log likelihood ratio: random symbols of the inferred encoding against text. 0 if the battery rejects."""
    body = token.rstrip("=")
    name = encoding(body)
    if name is None:
        return 0.0
    alphabet = ENCODINGS[name]
    c = codes(body)
    ratio = -len(body) * math.log(len(alphabet)) - model[OTHER, c[0]] - model[c[:-1], c[1:]].sum()
    return ratio if ratio > 0 and battery(body, alphabet) >= REJECT else 0.0


def scan(text: str, model: np.ndarray) -> tuple:
    """Counts of the base kinds, base spans, tested tokens by length class, and those with evidence."""
    base = base_spans(text)
    tested, found = [0] * len(CLASSES), []
    for m in TOKEN.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        k = sum(len(m[0]) >= b for b in CLASSES) - 1
        tested[k] += 1
        if (ratio := evidence(m[0], model)) > 0:
            found.append({"start": m.start(), "end": m.end(), "length": k, "nats": math.floor(ratio)})
    counts = [sum(k == n for _, k, _ in base) for n in range(3)]
    return *counts, [{"start": s, "kind": k, "end": e} for s, k, e in base], tested, found


def struct(*names: str) -> pa.DataType:
    return pa.list_(pa.struct([(n, pa.int32()) for n in names]))


SCANNED = pa.schema([
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base", struct("start", "kind", "end")),
    ("tested", pa.list_(pa.int64())), ("found", struct("start", "end", "length", "nats")),
])


def bars(scanned: DataFrame) -> list[int]:
    """Least evidence of each length class: the smallest at which tokens * exp(-evidence) is within RATE of the discoveries."""
    tested = scanned.select(F.posexplode("tested").alias("length", "n")).groupBy("length").agg(F.sum("n")).collect()
    found = scanned.select(F.explode("found").alias("f")).groupBy("f.length", F.least("f.nats", F.lit(200)).alias("nats")).count().collect()
    out = []
    for k in range(len(CLASSES)):
        total = dict(map(tuple, tested)).get(k) or 0
        of = {r["nats"]: r["count"] for r in found if r["length"] == k}
        passing = [t for t in of if total * math.exp(-t) <= RATE * sum(n for x, n in of.items() if x >= t)]
        out.append(min(passing, default=1 << 30))
    return out


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base and spans as arrays of (start, kind, end), sorted."""
    model = text_model(docs)
    texts = docs.select("doc_id", whole(F.col("text")).alias("text"))
    scanned = stage(with_made(texts, "text", SCANNED, lambda: lambda text: scan(text, model)).drop("text"), "secrets")
    bar = F.array(*map(F.lit, bars(scanned)))
    random = F.transform(
        F.filter("found", lambda f: f["nats"] >= F.get(bar, f["length"])),
        lambda f: F.struct(f["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), f["end"].alias("end")),
    )
    return scanned.withColumn("random", random).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("random").cast("long").alias("n_random"), "base",
        F.array_sort(F.concat("base", "random")).alias("spans"),
    )


def secret_digests(docs: DataFrame) -> DataFrame:
    return secret_spans(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), "n_random",
    )
