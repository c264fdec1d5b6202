"""Collocations, filter audit and URL filters against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from corpus_cases import collected, documents, rows, sentence

from slotwise.llm import collocations, filter_audit, url_filter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CHATTER = [(900 + k, t, "en", "a") for k, t in enumerate([
    "New York City, new york city; NEW\tYORK  city\nnew york. hall! new york city? the new york city hall", "a a a a a a", "a b a b a b a b\x0bc",
    ",;.", "!a!", " . \t . ", "é É é ſ\x1fx\x00y\x1fx\x00y", "x" * 50 + " " + "y z " * 40])]


def phrase_counts(data):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang][tuple(words[k : k + size])] += 1
    return f, n


def phrases_brute(data, least, kept):
    f, n = phrase_counts(data)
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        best = []
        for g, a in cand.items():
            if any(len(h) > len(g) and 100 * b >= 50 * a and any(h[k : k + len(g)] == g for k in range(len(h) - len(g) + 1)) for h, b in cand.items()):
                continue
            cuts = [(1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(g).encode(), a, counts[g[:k]], counts[g[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(best)[:kept], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], -score))
    return sorted(out, key=repr)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("least, kept", [(2, 2000), (3, 5), (10, 2000)])
def test_collocations(spark, least, kept):
    data = rows() + CHATTER * 4
    got = collocations.collocations(documents(spark, data), least=least, kept=kept)
    assert collected(got, *COLUMNS) == phrases_brute(data, least, kept)


def test_collocations_small_shards(spark, monkeypatch):
    """Shards that end inside texts and pieces, blocks of a few bytes, a map with many false pairs."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a ", "bb ", "c ", "ddd\t", ". ", "é ", "\n", "long" * 9 + " "]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    data = [(k, t, rng.choice(["en", None]), "a") for k, t in enumerate(texts)]
    for shard, block in ((1, 1), (3, 7), (10, 20)):
        batches = [_batch(data[:30]), _batch(data[30:])]
        monkeypatch.setattr(collocations, "SHARD", shard)
        monkeypatch.setattr(collocations, "BLOCK", block)
        everything = np.full(1 << 10, 255, np.uint8)
        got = defaultdict(Counter)
        for depth, pairs in ((2, None), (3, everything)):
            for batch in collocations.gram_rows(depth, pairs)(iter(batches)):
                for r in batch.to_pylist():
                    if r["size"]:
                        got[r["lang"]][tuple(r["phrase"].split(" "))] += r["n"]
        assert got == phrase_counts(data)[0]


def _batch(data):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist([{"lang": "und" if g is None else g, "text": t.encode()} for _, t, g, _ in data])


def test_longer_phrases(spark):
    data = rows() + CHATTER * 4
    got = collocations.frequent_phrases(documents(spark, data), depth=5, least=6).filter("size > 0")
    want = Counter()
    for _, text, lang, *_ in data:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update(("und" if lang is None else lang, " ".join(words[k : k + size])) for size in range(1, 6) for k in range(len(words) - size + 1))
    assert collected(got, "lang", "phrase", "n") == sorted(((*k, n) for k, n in want.items() if n >= 6), key=repr)


def test_intervals_both_ways():
    """Each interval of both indexes holds the suffixes that start with its n-gram (or its reverse), in any order of steps."""
    rng = np.random.default_rng(2)
    seq = np.append(rng.integers(0, 5, 400), 0)
    index = collocations.BothWays(seq, 4)
    grams, interval = np.zeros((0, 1), int), index.all()
    for side in ("left", "right", "right", "left"):
        owner, symbol, interval = getattr(index, f"to_{side}")(*interval)
        grams = np.vstack([symbol, grams[:, owner]] if side == "left" else [grams[:, owner], symbol])
        low, reverse, count = interval
        found = Counter(g for g in zip(*[np.roll(seq, -k).tolist() for k in range(len(grams))]) if 0 not in g)
        assert dict(zip(map(tuple, grams.T.tolist()), count.tolist())) == dict(found)
        for lows in (low, reverse):  # intervals of one length are disjoint
            order = np.argsort(lows)
            assert (lows[order][1:] >= (lows + count)[order][:-1]).all()


def test_scores_pass_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3 * 10**12, 7 * 10**12, 5 * 10**12
    row = spark.range(1).select(collocations.score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def fails_brute(data):
    seen = {}
    for i, t, *_ in data:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    out = []
    for i, t, _, source in data:
        t, w = t or "", WORDS.findall(t or "")
        out.append((i, source or "", {c for c, bad in {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > seen[t]}.items() if bad}))
    return out


def audit_brute(data, labels):
    good, toxic = ({i for i, q, x in labels if (q, x)[k] == 1 and i is not None} for k in (0, 1))
    parts = defaultdict(list)
    for i, part, bad in fails_brute(data):
        parts[part].append((i, bad))
    out = []
    for part, docs in parts.items():
        steps, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, c in enumerate(order, 1):
                gone, left = [d for d in left if c in d[1]], [d for d in left if c not in d[1]]
                shapley[c] += len(gone)
                fails = sum(c in bad for _, bad in docs)
                steps.append((part, "".join(order), step, len(left), len(gone), fails - len(gone), sum(bad == {c} for _, bad in docs),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out, key=repr)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit(spark):
    rng = random.Random(8)
    data = rows() + [(2000 + k, sentence(rng, rng.choice([20, 190, 250])) + rng.choice(["", " #", " ABCDEFGHIJ KLMNOP" * 9]), "en", rng.choice(["a", "", None])) for k in range(40)]
    data += [(3000, "ΑΒΓ ÀÉ \U0001F600 " * 80, None, "greek"), (3001, "AB" + "é" * 98, None, "greek"), (3002, "ABC" + "é" * 97, None, "greek"), *data[-3:]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i, *_ in data if rng.random() < 0.6] + [(None, 1, 1), (2000, 1, 1), (2000, 0, 0), (-99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    got = filter_audit.audit(documents(spark, data), table)
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    assert collected(got, *AUDIT) == audit_brute(data, labels)
    assert collected(filter_audit.audit(documents(spark, data), table.limit(0)), *AUDIT) == audit_brute(data, [])


def test_empty_tables(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    pages = spark.createDataFrame([], "page_id long, url string")
    assert filter_audit.audit(docs, labels).isEmpty()
    assert collocations.collocations(docs).isEmpty()
    assert url_filter.judge(pages, url_filter.listed_hosts(pages)).isEmpty()
    nulls = documents(spark, [(None, None, None, None)] * 3)
    assert collocations.collocations(nulls).isEmpty()
    assert filter_audit.audit(nulls, labels).count() == 600


URLS = [
    None, "", "nothing", "://", "http://", "http://A.net", "http://a.net/", "http://a.net?x=/en/", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net/en", "http://notexample.net/en/",
    "https://example.com/de/", "https://m.example.com/de/a/b#c", "https://example.com/fr/de/", "http://x.org/fr/", "http://org/fr/", "http://borg/fr/", "http://x.org/en/", "a://b://c.org/fr/",
    "http://casino-win.example.com/en/", "http://casino-win.example.com/de/", "http://www.spam-farm.example.org/fr/1", "http://spam.org/x", "http://spamming.org/x", "http://user@ads.x.com:80/p\nq?r",
    "http://ÄÖ.com/É?q", "http://İ.net/de/", "http://a.com#/en/", "//a.net/", "http:///net/", "http://x" + "y" * 5000 + ".net/en/",
]


def judged_brute(urls):
    out = []
    for i, url in urls:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(ASCII), m[2]) if m else ("", "")
        fits = [(len(h) + len(p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "block" if set(re.split(r"[.-]", host)) & set(url_filter.LISTED_WORDS) else "allow"))
        out.append((i, host, path, rule, verdict))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [url_filter.CASCADE_BITS, 0])
def test_url_filters(spark, most):
    urls = [*enumerate(URLS), (None, "http://poker.com/"), (3, "http://poker.com/"), (3, "http://poker.com/")]
    pages = spark.createDataFrame([(i, u, "h", "block", True, "k") for i, u in urls], "page_id long, url string, host string, verdict string, listed boolean, key string")
    got = url_filter.judge(pages, url_filter.listed_hosts(pages), most_bits=most)
    assert collected(got, "page_id", "host", "path", "rule", "verdict") == judged_brute(urls)


@pytest.mark.parametrize("listed, others", [(0, 50), (50, 0), (1, 5000), (3000, 9000), (4000, 100)])
def test_cascade_is_exact(spark, listed, others):
    keys = spark.createDataFrame([(f"k{i}", i < listed) for i in range(listed + others)], "key string, listed boolean")
    made = url_filter.cascade(keys)
    assert keys.filter(made.lists(keys["key"]) != keys["listed"]).isEmpty()
    assert (listed == 0) == (not made.levels)
    if min(listed, others) > 1000:
        assert made.bits < 1.3 * url_filter.expected_bits(listed, others)


def test_listed_keys_outside_the_corpus_are_not_encoded(spark):
    corpus = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "key string")
    listed = spark.createDataFrame([("b",), ("zz",), (None,)], "key string")
    assert collected(url_filter.labelled_keys(corpus, listed), "key", "listed") == [("a", False), ("b", True)]


def test_native_plan(spark, sf_dir):
    """No Python and no join in the judging plan; the hosts of the rows are not shuffled."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = url_filter.judge(pages, url_filter.listed_hosts(pages))
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0]
    assert not re.search(r"Python|Arrow|Join|Repartition", plan) and "Aggregate" not in plan.split("scalar-subquery")[0]
