"""Exact, near, substring and line dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from compare import compare
from corpus_cases import collected, documents, rows
from pyspark.sql import functions as F

import corpus_pipeline
from slotwise.llm import exact_dedup, line_dedup, minhash, substring_dedup
from slotwise.llm.components import components
from slotwise.llm.queries import ORACLES, QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def number(i):
    return -(1 << 63) if i is None else i


@pytest.mark.parametrize("weak", [False, True])
def test_exact_classes(spark, weak):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], sha(t or "")) for i, t, *_ in rows()), key=repr)
    options = {"hashed": lambda c: F.length(c) % 7} if weak else {}  # a hash with many collisions
    got = exact_dedup.exact_classes(documents(spark), **options)
    assert collected(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    if not weak:
        left = exact_dedup.exact_dedup(documents(spark))
        assert left.columns == documents(spark).columns
        want = sorted(((i, t or "") for i, t, *_ in rows() if i == keep[t or ""]), key=repr)
        assert collected(left.withColumn("t", F.coalesce("text", F.lit(""))), "doc_id", "t") == want


def shingles(text, n):
    words = WORDS.findall((text or "").translate(ASCII))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def near_brute(data, n):
    sets = [(number(i), shingles(t, n)) for i, t, *_ in data]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    back = lambda i: None if i == number(None) else i
    return sorted(((back(i), len(s), back(find(i)), find(i) == i) for i, s in sets), key=repr)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, n):
    got = minhash.near_duplicates(documents(spark), words=n)
    assert collected(got, "doc_id", "n_shingles", "component_id", "kept") == near_brute(rows(), n)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Chains of edits: neighbours are linked, the ends are not; with lists cut in several blocks and hubs in several tasks."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 150)
    monkeypatch.setattr(minhash, "FAN", 3)
    base = [f"w{k}" for k in range(60)]
    data = [(100 - k, " ".join([f"x{k}_{m}" if m < 5 * k else w for m, w in enumerate(base)]), None, None) for k in range(12)]
    data += [(200 + k, " ".join(base[: 50 + k % 11] + [f"y{k}"]), None, None) for k in range(40)]
    got = minhash.near_duplicates(documents(spark, data), words=2)
    assert collected(got, "doc_id", "n_shingles", "component_id", "kept") == near_brute(data, 2)
    one = minhash.near_dedup(documents(spark, data), words=2)
    assert collected(one, "doc_id") == sorted(((r[0],) for r in near_brute(data, 2) if r[3]), key=repr)


def test_near_duplicates_of_one_id(spark):
    """Rows of one id join their classes, also a row without words."""
    one, two = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    data = [(i, t, None, None) for i, t in ((3, one), (5, one), (5, two), (7, two), (9, two + " end"), (9, ""), (11, "alone"), (11, None), (12, ""))]
    got = minhash.near_duplicates(documents(spark, data), words=2)
    want = near_brute(data, 2)
    assert collected(got, "doc_id", "n_shingles", "component_id", "kept") == want and {r[2] for r in want} == {3, 11, 12}
    assert collected(minhash.near_dedup(documents(spark, data), words=2), "doc_id") == sorted([(3,), (11,), (11,), (12,)], key=repr)


def test_table_loaded_twice(spark):
    """The pipeline's exact stage keeps one of the rows equal in id and text."""
    twice = documents(spark, rows() + rows())
    once = corpus_pipeline.exact(spark, twice, None)
    assert once.columns == twice.columns
    want = {}
    for i, t, *_ in rows():
        want[t or ""] = max(number(i), want.get(t or "", number(None)))
    assert sorted((number(r.doc_id), r.text or "") for r in once.collect()) == sorted((i, t) for t, i in want.items())
    assert once.drop("text").count() == corpus_pipeline.exact(spark, once, None).count()


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 4), (20, 1)] + [(100 + k, 101 + k) for k in range(40)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 1 for k in (1, 2, 3, 4, 20)}, **{k: 7 for k in (7, 8, 9)}, **{k: 100 for k in range(100, 141)}}


def test_long_paths_take_few_rounds(spark, monkeypatch):
    from slotwise.llm import components as module

    stages = []
    stage = module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: stages.append(name) or stage(df, name))
    path = spark.range(1000).selectExpr("id as a", "id + 1 as b")
    rows = module.components(path).collect()
    assert len(rows) == 1001 and {r.component for r in rows} == {0}
    assert stages.count("parents") <= 12


def substring_brute(data, window):
    first = {}
    for i, t, *_ in sorted(data, key=lambda r: number(r[0])):
        words = WORDS.findall(t or "")
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k : k + window]), (number(i), k))
    gone = defaultdict(set)
    for i, t, *_ in data:
        words = WORDS.findall(t or "")
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] != (number(i), k):
                gone[number(i)] |= set(range(k, k + window))
    out = []
    for i, t, *_ in data:
        words = WORDS.findall(t or "")
        kept = [w for k, w in enumerate(words) if k not in gone[number(i)]]
        out.append((i, len(words), len(words) - len(kept), sha(" ".join(kept))))
    return sorted(out, key=repr)


def distinct_ids(data):
    """Rows whose id is theirs alone, or repeated with the same text."""
    texts = defaultdict(set)
    for i, t, *_ in data:
        texts[i].add(t)
    return [r for r in data if len(texts[r[0]]) == 1]


@pytest.mark.parametrize("window", [3, 20])
def test_substrings(spark, window, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 300)
    data = distinct_ids(rows())
    got = substring_dedup.substring_digests(documents(spark, data), window)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == substring_brute(data, window)
    texts = substring_dedup.substring_dedup(documents(spark, data), window).collect()
    want = {i: removed for i, _, removed, _ in substring_brute(data, window)}
    assert all(sum(b - a for a, b in r.removed) == want[r.doc_id] for r in texts)
    whole = dict((i, t or "") for i, t, *_ in data)
    assert all(r.text == whole[r.doc_id] for r in texts if not r.removed)


def test_substrings_of_versions(spark):
    assert substring_dedup.substring_digests(documents(spark)).count() == len(rows())


@pytest.mark.parametrize("same_bit", [False, True])
def test_substrings_in_one_task(spark, monkeypatch, same_bit):
    """Rows equal in id and text in one task repeat nothing; where ids share the bit of one with two texts, all places carry a mark."""
    if same_bit:
        monkeypatch.setattr(substring_dedup, "bit_of", lambda column, bits: F.lit(5))
        monkeypatch.setattr(minhash, "bit_of", lambda column, bits: F.lit(5))
    extra = [(10**6, t, None, None) for t in ("first text of this id", "second text of this id")]
    want = substring_brute(distinct_ids(rows()), 20) + [(i, 5, 0, sha(t)) for i, t, *_ in extra]
    got = substring_dedup.substring_digests(documents(spark, distinct_ids(rows()) + extra).coalesce(1))
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


@pytest.mark.parametrize("swap", [False, True])
def test_texts_of_one_id(spark, swap):
    """What repeats in one text of an id is not cut from the other, which may be shorter; what both have goes from one."""
    shared, own, short = ([f"{c}{k}" for k in range(30)] for c in "sop")
    ids = (9, 2) if swap else (2, 9)
    texts = [(ids[0], shared), (ids[1], own + shared), (ids[1], short)]
    data = [(i, " ".join(t), None, None) for i, t in texts]
    got = {(r.n_words, r.doc_id): r.n_removed for r in substring_dedup.substring_digests(documents(spark, data)).collect()}
    assert got == {(30, ids[0]): 30 * swap, (60, ids[1]): 30 * (not swap), (30, ids[1]): 0}
    assert (ids[1], " ".join(short)) in collected(substring_dedup.substring_dedup(documents(spark, data)), "doc_id", "text")
    both = substring_dedup.substring_digests(documents(spark, [(1, " ".join(shared), None, None), (1, " ".join(shared + own), None, None)]))
    assert sum(r.n_removed for r in both.collect()) == 30
    data = [(i, "\n".join(t), None, None) for i, t in texts]
    got = {(r.n_lines, r.doc_id): r.n_removed for r in line_dedup.line_digests(documents(spark, data)).collect()}
    assert got == {(30, ids[0]): 30 * swap, (60, ids[1]): 30 * (not swap), (30, ids[1]): 0}


def lines_brute(data, run):
    def solid(t):
        return [(k, line.strip(" \t\x0b\x0c\r")) for k, line in enumerate((t or "").split("\n")) if line.strip(" \t\x0b\x0c\r")]

    first = {}
    for i, t, *_ in sorted(data, key=lambda r: number(r[0])):
        own = solid(t)
        for k in range(len(own) - run + 1):
            first.setdefault(tuple(x for _, x in own[k : k + run]), (number(i), k))
    out = []
    for i, t, *_ in data:
        own, gone = solid(t), set()
        for k in range(len(own) - run + 1):
            if first[tuple(x for _, x in own[k : k + run])] != (number(i), k):
                gone |= {p for p, _ in own[k : k + run]}
        lines = (t or "").split("\n")
        out.append((i, len(lines), len(gone), sha("\n".join(x for k, x in enumerate(lines) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("gram", "window"), [(1, 1), (1, 2), (2, 2), (1, 3)])
def test_lines(spark, gram, window):
    data = distinct_ids(rows())
    got = line_dedup.line_digests(documents(spark, data), gram=gram, window=window)
    assert collected(got, "doc_id", "n_lines", "n_removed", "kept_sha256") == lines_brute(data, gram + window - 1)


def runs_brute(data, run):
    """id, places of the first and last line of the maximal runs, number of lines in them."""
    def solid(t):
        return [(k, line.strip(" \t\x0b\x0c\r")) for k, line in enumerate((t or "").split("\n")) if line.strip(" \t\x0b\x0c\r")]

    seen, out = set(), {}
    for i, t, *_ in sorted(data, key=lambda r: number(r[0])):
        own, gone = solid(t), []
        for k in range(0 if i in out else len(own) - run + 1):
            key = tuple(x for _, x in own[k : k + run])
            if key not in seen:
                seen.add(key)
            elif gone and k <= gone[-1][1]:
                gone[-1][1] = k + run - 1
            else:
                gone.append([k, k + run - 1])
        out.setdefault(i, ([[own[a][0], own[b][0]] for a, b in gone], sum(b - a + 1 for a, b in gone)))
    return sorted(((i, *out[i]) for i, *_ in data), key=repr)


def test_runs_by_fingerprints_then_the_rest(spark):
    """The query winnows for runs of two lines, and deletes the other lines with an earlier copy after them."""
    assert line_dedup.GRAM + line_dedup.WINDOW - 1 == 2
    more = ["a\nb\n\nc\nd", "x\na\n \nb\ny\nc\nd\nz", "d\nq\na\nb\nc\nd", "c\nr\nc\nd\nd\na\nb", "r\ns\nr\ns\nr\ns"]
    data = distinct_ids(rows()) + [(10**6 + k, t, None, None) for k, t in enumerate(more)]
    got = line_dedup.line_dedup(documents(spark, data).coalesce(1))
    assert collected(got, "doc_id", "runs", "n_in_runs") == runs_brute(data, 2)
    assert collected(got.withColumn("sha", F.sha2("text", 256)), "doc_id", "n_lines", "n_removed", "sha") == lines_brute(data, 1)
    in_runs = {i: n for i, _, n, _ in lines_brute(data, 2)}
    assert all(in_runs[i] == n for i, _, n in runs_brute(data, 2))
    assert any(r.n_in_runs not in (0, r.n_removed) for r in got.collect())


def test_lines_against_sql_with_runs(spark, tmp_path):
    """The query and its SQL tell the lines of repeated runs from those that repeat alone, on runs with blanks, overlaps and lines of one text."""
    more = ["a\nb\n\nc\nd", "x\na\n \nb\ny\nc\nd\nz", "d\nq\na\nb\nc\nd", "c\nr\nc\nd\nd\na\nb", "r\ns\nr\ns\nr\ns"]
    data = list({r[0]: r for r in rows() if r[0] is not None}.values()) + [(10**6 + k, t, None, None) for k, t in enumerate(more)]
    documents(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    ok, message = compare(QUERIES["op4_line_dedup"], ORACLES["op4_line_dedup"], spark, str(tmp_path), con)
    assert ok, message
    got = {r.doc_id: (r.n_removed, r.n_in_runs, r.runs) for r in QUERIES["op4_line_dedup"](spark, str(tmp_path)).collect()}
    assert [got[10**6 + k] for k in range(5)] == [(0, 0, ""), (4, 4, "1:3,5:6"), (5, 4, "2:5"), (6, 4, "2:3,5:6"), (5, 4, "2:5")]


def test_fingerprints(spark):
    """Each run has the rightmost smallest gram of its window; windows share them, so there are fewer than lines."""
    hashes = [(k * 7919) % 1009 for k in range(3000)] + [5, 5, 5]
    df = spark.createDataFrame([(hashes,)], "hashes array<long>")
    for gram, window in [(1, 2), (2, 3), (1, 6)]:
        got = df.select(F.inline(line_dedup.winnowed(F.col("hashes"), gram, window))).collect()
        assert [r.start for r in got] == list(range(len(hashes) - gram - window + 2))
        prints = {r["at"]: r["print"] for r in got}
        assert all(r.start <= r["at"] < r.start + window for r in got)
        assert all(r["print"] <= prints[k] if k < r["at"] else r["print"] < prints[k] for r in got for k in range(r.start, r.start + window) if k in prints and k != r["at"])
        assert len(prints) < 0.75 * len(hashes)


def test_sets_by_a_join(spark, monkeypatch):
    """Where the ids would not fit the bitmap, texts are joined to them: the same links."""
    monkeypatch.setattr(minhash, "MOST_BITS", 0)
    assert collected(minhash.near_duplicates(documents(spark), words=2), "doc_id", "n_shingles", "component_id", "kept") == near_brute(rows(), 2)


def test_repeated_rows_with_a_map(spark):
    docs = documents(spark).withColumn("more", F.create_map(F.lit("a"), F.col("source"), F.lit("b"), F.col("text")))
    left = exact_dedup.exact_dedup(docs, single=True)
    assert left.columns == docs.columns
    assert left.select("text").count() == len({t or "" for _, t, *_ in rows()})


def test_no_later_copy_of_a_line_stays(spark):
    many = "\n".join(f"line {k % 150_000}" for k in range(200_000))
    data = [(1, "only line", None, None), (2, "only line", None, None), (3, "a\nonly line\nb", None, None), (4, "b", None, None), (5, many, None, None), (6, "line 7\n\n  line 8\t", None, None)]
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.line_digests(documents(spark, data)).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (3, 1), 4: (1, 1), 5: (200_000, 50_000), 6: (3, 2)}


@pytest.mark.parametrize("of", [exact_dedup.exact_classes, exact_dedup.exact_dedup, minhash.near_duplicates, minhash.near_dedup, substring_dedup.substring_digests, line_dedup.line_digests])
def test_empty_table(spark, of):
    assert of(documents(spark, [])).count() == 0
