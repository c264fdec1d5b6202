"""Mixing, pieces, fingerprints, secrets, languages and pages against brute force, the library and fixed cases."""

import hashlib
import math
import random
import re

import pytest
from corpus_cases import collected, documents, rows, sentence
from pyspark.sql import functions as F

from slotwise.llm import html_text, language_id, merkle, mixing, piece_bpe, secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- mixing

def test_targets_by_resharing(spark):
    sizes = {"a": 1000, "b": 10, "B": 4, "é": 300, None: 7, "zero": 0}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, full = sum(sizes.values()), dict.fromkeys(order, 0.0), set()
    while True:  # share, stop those above, share the excess
        rest = total - sum(3 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    got = mixing.mix_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    for r in got.collect():
        assert math.isclose(r.target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)


def test_mix(spark):
    got = mixing.mix(documents(spark)).collect()
    size = {}
    for r in got:
        size.setdefault(r.source, [r.source_size, r.target, 0, 0])
        size[r.source][2] += r.size
        size[r.source][3] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(own == summed and taken == min(math.floor(target + 1e-9), 3 * own) for own, target, summed, taken in size.values())
    assert collected(mixing.mix(documents(spark)), "doc_id", "size", "taken") == collected(mixing.mix(documents(spark).repartition(7)), "doc_id", "size", "taken")
    assert [r.size for r in got if r.doc_id == 1] == [len(WORDS.findall(rows()[0][1]))]


def test_mixed_texts(spark):
    data = [r for r in rows() if r[0] is not None]
    data = list({r[0]: r for r in data}.values())
    out = mixing.mixed(documents(spark, data))
    assert out.columns == documents(spark, data).columns
    taken = {r.doc_id: r.taken for r in mixing.mix(documents(spark, data)).collect() if r.taken}
    words, texts = {}, {r[0]: r[1] for r in data}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORDS.findall(r.text))
        assert texts[r.doc_id].startswith(r.text)
    assert words == taken


# -- pieces

@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers
    import sentencepiece

    return piece_bpe.default_vocabulary(), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_encoding_equals_the_library(pieces):
    vocabulary, library = pieces
    work, rng = piece_bpe.codec(vocabulary), random.Random(1)
    pool = [*" \n\t\r ▁aeiothsn.,'\"<>0x1Aéñß日本\U0001F600\x00 ​", "the", "ing", "   ", "  ", "hello", "▁▁", "\n\n", "<s>", "<0x41>", "e.g.", ",,", "².", "..."]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(8000)]
    texts += [s for n in range(70) for s in (" " * n, " " * n + "a", "a" + " " * n, " " * n + "\n" + " " * n + "日")]
    texts += ["x" * 5000, "ab" * 3000 + " " * 500 + "é" * 700] + [t for _, t, *_ in rows() if t]
    assert [work.encode(t) for t in texts] == library.encode(texts, num_threads=1)
    assert all(work.decode(i) == library.decode(i) for i in map(work.encode, texts))
    assert work.encode(None) == work.encode("") == []


def test_decoding_of_any_ids_equals_the_library(pieces):
    vocabulary, library = pieces
    work, rng = piece_bpe.codec(vocabulary), random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 600), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 8))]
        assert work.decode(ids) == library.decode(ids)


def test_small_memory(pieces, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MEMORY", 3)
    work = piece_bpe.Codec(pieces[0])
    text = rows()[0][1]
    assert work.encode(text) == pieces[1].encode(text)


def test_pieces_of_a_table(spark, pieces):
    vocabulary, library = pieces
    want = []
    for i, t, *_ in rows():
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")))
    got = piece_bpe.digests(documents(spark), vocabulary)
    assert collected(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    texts = piece_bpe.decode(piece_bpe.encode(documents(spark), vocabulary), vocabulary)
    assert collected(texts, "doc_id", "text") == sorted(((i, t or "") for i, t, *_ in rows()), key=repr)
    checked = piece_bpe.encode_and_check(documents(spark), vocabulary)
    assert collected(checked, "doc_id", "n_tokens", "decoded_sha256") == sorted(((i, n, d) for i, n, _, d in want), key=repr)


# -- fingerprints

def test_fingerprints(spark):
    data = list({r[0]: r for r in rows()}.values())
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = {}
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        want[i] = (len(t), sha(t[: len(t) - cut] + after[:cut]))
    got = merkle.fingerprints(documents(spark, data)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    texts = {i: t or "" for i, t, *_ in data}
    for r in got:
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (sha(texts[r.doc_id]) == r.edited_sha256) == (r.fingerprint == r.edited_fingerprint) == (r.n_changed == 0)
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    long = [r for r in got if r.n_chars > 400]
    assert all(r.near_edited > 0.4 for r in long if r.n_chars < 20_000)


def test_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_CHARS", 20)
    data = [((k * 37) % 1009 - 400, f"text {k} " * (k % 5), None, None) for k in range(300)] + [(None, "none", None, None)]
    data += [(None, f"none {k}", None, None) for k in range(20)] + [(-(1 << 63), "low", None, None), ((1 << 63) - 1, "high", None, None)]
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest() if r[0] is None else ""))
    monkeypatch.setattr(merkle, "RANGES", 3)
    got = merkle.with_next(documents(spark, data).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"])
    got = got.collect()
    assert len(got) == len(data) and sum(r.next_text == "none" for r in got) <= 1
    assert {(r.doc_id, r.text): r.next_text for r in got} == {(r[0], r[1]): order[(k + 1) % len(order)][1] for k, r in enumerate(order)}


def test_one_document_is_its_own_next(spark):
    r = merkle.fingerprints(documents(spark, [(5, "one two three four five six", None, None)])).first()
    assert r.edited_sha256 == sha("one two three four" + "one two t") and r.near_next == 1.0


BRANCHES = [
    ("a\nb\n\nc\nd", "a\nX\n\nc\nd\n\ne", [(0, 1), (2, -1)]),
    ("\n".join(f"line {k}" for k in range(20)), "new\n" + "\n".join(f"line {k}" for k in range(20)), [(0, 0)]),
    ("\n".join(f"line {k}" for k in range(20)), "\n".join(f"line {k}" for k in range(20) if k != 7), [(0, 7)]),
    ("a\n\nb\n\nc", "a\n\nnew\n\nb\n\nc", [(1, -1)]),
    ("a\n\nb\n\nc", "a\n\nc", [(1, -1)]),
    ("x\nx\nx", "x\nx", [(0, 2)]), ("same", "same", []), ("", "x", [(0, 0)]), ("", "", []), ("a b", "a  b", [(0, 0)]),
]


def test_changed_branches(spark):
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(BRANCHES)], "k int, a string, b string")
    found = df.select("k", merkle.changed_branches(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d")).collect()
    assert {r.k: [tuple(x) for x in r.d] for r in found} == {k: want for k, (_, _, want) in enumerate(BRANCHES)}


def test_likeness_of_small_edits(spark):
    """One word, or one line, in front, in the middle or at the end: texts of 50 words or more stay above 0.9."""
    texts = [t for _, t, *_ in rows() if len(WORDS.findall(t or "")) >= 50] + [" ".join(sentence(random.Random(k), 50 + k)[:400] for _ in "x") for k in range(40)]
    edits = []
    for t in (t for t in texts if len(WORDS.findall(t)) >= 50):
        words = t.split(" ")
        half = len(words) // 2
        edits += [(t, "word " + t), (t, "one more line\n" + t), (t, " ".join(words[:half] + ["word"] + words[half:])), (t, t + " word"), (t, t.replace(words[half], "other", 1))]
    df = spark.createDataFrame(edits, "a string, b string")
    near = df.select(merkle.likeness(merkle.leaves(F.col("a")), merkle.leaves(F.col("b"))).alias("n"), "a", "b")
    low = near.filter("n <= 0.9 or n >= 1.0").collect()
    assert not [r for r in low if r.n <= 0.9 or r.a == r.b], low[:2]


def test_leaves(spark):
    """Runs of three words from each word on, blanks included, inside a paragraph; the words before them give the text back."""
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b ", "the ", "\t", "x.", "\n", "\x0b", "é ", "日 ", "zz", " "]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    rows_ = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.transform(F.split("t", "\n", -1), lambda p: merkle.runs(p, lambda run: run)).alias("r")).collect()
    for r in rows_:
        assert len(r.r) == len(r.t.split("\n"))
        for paragraph, own in zip(r.t.split("\n"), r.r):
            words = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+", paragraph)
            assert "".join(words) == paragraph and own == ["".join(words[k : k + 3]) for k in range(len(words))]


# -- secrets

def base_brute(text):
    """The patterns as stated: match, then drop."""
    found = []
    letter = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(map(letter, ("password", "passwd", "secret", "token"))) + "|" + letter("api") + "_?" + letter("key")
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans():
    rng = random.Random(3)
    pool = ["password", "PassWd", "secret", "ſecret", "tok", "token", "toKen", "apiKey", "api_key", "\"", "'", " ", "  ", ":", "=", "abc", "AKIA", "ABCD1234EFGH5678", "deadbeef", "0123456789abcdef", "é", ".", "/+", "\n", "日"]
    for _ in range(20_000):
        text = "".join(rng.choices(pool, k=rng.randint(1, 14)))
        assert secrets.base_spans(text) == base_brute(text), text


def test_secret_scan(spark):
    rng = random.Random(4)
    alphabet = secrets.ENCODINGS["base62"]
    hidden = {k: "".join(rng.choice(alphabet) for _ in range(44)) for k in range(20)}
    data = [(k, f"{rows()[k][1]} see {hidden[k]} for it, é password = 'hunter2x' end", None, None) for k in range(20)] + [(50, None, None, None), (51, "", None, None)]
    data += [(60 + k, "internationalization_of_everything " * 3 + "=" * 40 + " " + "ab" * 20, None, None) for k in range(10)]
    out = {r.doc_id: r for r in secrets.secret_digests(documents(spark, data)).collect()}
    hits = 0
    for i, text, *_ in data:
        base = base_brute(text or "")
        named = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert out[i].base_sha256 == sha(",".join(named))
        assert set(named) <= set(out[i].spans.split(",")) | ({""} if not named else set())
        assert (out[i].n_assign, out[i].n_access, out[i].n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        if i in hidden:
            at = text.index(hidden[i])
            hits += f"random:{at}:{at + 44}" in out[i].spans
        else:
            assert out[i].n_random == 0
    assert hits >= 18


def test_battery_levels():
    """Random tokens fail about as rarely as stated, text and patterns fail."""
    rng = random.Random(5)
    a = secrets.ENCODINGS["base64"]
    low = sum(secrets.battery("".join(rng.choice(a) for _ in range(40)), a) < 0.01 for _ in range(2000))
    assert low < 80
    assert secrets.battery("a" * 40, a) < 1e-6 and secrets.battery("abcabc" * 8, a) < 1e-3


# -- languages

def test_languages(spark):
    rng = random.Random(6)
    make = {"en": "the thing with other shown", "fr": "que nous être çà leur", "de": "nicht über straße können"}
    text = lambda lang, n: " ".join(rng.choice(make[lang].split()) for _ in range(n))
    data = [(k, text(lang, rng.randint(5, 60)), lang, "s" + lang) for k, lang in enumerate(rng.choices(list(make), k=200))]
    held = [(1000 + k, text(lang, 12), None, None) for k, lang in enumerate(rng.choices(list(make), k=60))]
    junk = [(2000, None, "en", "sen"), (2001, "", None, None), (2002, "123 -- 456 %%", "en", None), (2003, "Ω жщ ЖЩЦ юэя дфг лнк " * 5, None, None)]
    df = documents(spark, data + held + junk)
    model = language_id.document_model(df)
    assert model[0] == sorted(make)
    out = {r.doc_id: r for r in language_id.classify(language_id.from_documents(df), *model).collect()}
    assert all(out[i].lang == lang and out[i].kept for i, _, lang, _ in data)
    right = [out[i].lang == next(x for x, w in make.items() if set(t.split()) <= set(w.split())) for i, t, *_ in held]
    assert sum(right) >= 58
    assert not any(out[i].kept for i, *_ in junk)
    left = language_id.keep_languages(df)
    assert left.columns == df.columns and left.count() == 260
    assert language_id.keep_languages(documents(spark, [])).count() == 0
    blank = language_id.classify(language_id.from_documents(documents(spark, [(1, "some text", None, None)])), *language_id.document_model(documents(spark, [])))
    assert blank.first().lang is None and blank.first().kept


def test_evidence_decides_where_the_text_does_not(spark):
    """One text, ambiguous by itself: the declaration and the host's other pages tell."""
    rng = random.Random(7)
    docs = documents(spark, [(k, " ".join(rng.choice((a, "alpha")) for _ in range(40)), lang, None) for k, (lang, a) in enumerate([("en", "wolf"), ("fr", "loup")] * 30)])
    html = lambda lang, body: f"<html lang='{lang}'><style>x</style><body>{body}"
    pages = [(k, f"http://a.example.org/{k}", html("en", "wolf wolf alpha")) for k in range(40)] + [(100 + k, f"http://b.example.com/{k}", html("fr", "loup loup alpha")) for k in range(40)]
    pages += [(500, "http://a.example.org/x", "alpha"), (501, "http://b.example.com/y", "alpha"), (502, None, None), (503, "bad", "<html lang=>")]
    out = {r.page_id: r for r in language_id.identify(docs, spark.createDataFrame(pages, "page_id long, url string, html string")).collect() if r.page_id is not None}
    assert (out[500].lang, out[501].lang) == ("en", "fr")
    assert not out[502].kept and not out[503].kept


def test_domain_is_apart_from_the_host(spark):
    hosts = {"a.example.org": "example.org", "m.a.example.org": "a.example.org", "example.org": None, "org": None, "": None}
    pages = spark.createDataFrame([(h, f"http://{h}/x") for h in hosts], "page_id string, url string").withColumn("html", F.lit("x"))
    assert {r.page_id: r.domain for r in language_id.from_pages(pages).collect()} == hosts


# -- pages

PAGES = {
    "<p>a<p>b<ul><li>x<li>y<ol start=3><li>z<li>w</ol></ul>c": "a\n\nb\n\n- x\n- y\n  3. z\n  4. w\n\nc",
    "<table><tr><th>n<th>val<tr><td>long name<td>1</table>after": "n          val\nlong name  1\n\nafter",
    "<table><caption>T</caption><tbody><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>": "T\nab     c\n1   2  3",
    "x<br>y<br><br>z  <b>bo</b>ld": "x\ny\n\nz bold",
    "<div hidden>no</div><div style='display: none'>n</div><span style='visibility:hidden'>h<i style=\"visibility:visible\">v</i></span>ok": "vok",
    "<pre> a\n  b</pre>t": " a\n  b\n\nt",
    "a < b &amp; c<!-- d --><script>var e='</p>';</script>": "a < b & c",
    "<a title='>x'>q</a><title>no</title>": "q",
    "<h1>T</h1>para<div>one</div><div>two</div>": "T\n\npara\none\ntwo",
    "<head><title>t</title><body><details><summary>s</summary>hidden</details>": "s",
    "<blockquote>q<p>r</blockquote><hr>z": "  q\n\n  r\n\nz",
    "<svg><title>no</title><text>label</text><text>b</text></svg><math><mi>x</mi><mo>=</mo><annotation>no</annotation></math><map>maptext</map>": "label\nb\nx=maptext",
    "<div style='visibility:hidden'>a<b class='not-visible-here'>LEAK</b><b style='visibility: VISIBLE'>v</b></div>w": "v\nw",
    "<a '>q</a> <a b=\"c>d</a> <i>e</i>": "q d e",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d<tr><td>e</table>": "a  b\n   c  d\ne",
    "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>": "a  b\n   c\nd  e",
    "<table><tr><td colspan=3>wide<td>x<tr><td>1<td>y</table>": "wide     x\n1     y",
    "": "", "  \n ": "", "plain": "plain", "</p></div>x</b>": "x", "<": "<", "<b": "<b", "<!-- open": "",
}


@pytest.mark.parametrize("html", PAGES)
def test_page(html):
    assert html_text.page_text(html) == PAGES[html]


def test_deep_and_long_pages():
    assert html_text.page_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert html_text.page_text("<p>word " * 20_000).count("word") == 20_000
    assert html_text.page_text("<table><tr><td>" * 300 + "x").strip() == "x"
    hidden = "<div>" * 160 + "<span style='display:none'>SECRET</span><noscript>NO</noscript><svg><defs>D</defs></svg>x"
    assert html_text.page_text(hidden) == "x"
    assert html_text.page_text("<div><p>" * 50_000 + "<i style='visibility:hidden'>" * 50_000 + "<b style='visibility:visible'>y").strip() == "y"
    assert html_text.page_text("<ul><li>" * 3_000 + "z").split()[-1] == "z"


@pytest.mark.parametrize("piece", ["<a '", "<a \"", "<a b='", "<a b=\"", "<a b='>", "<b>", "<b><div>", "<", "</", "<!--", "<!", "</b>", "<p><b>", "<td>", "<li><blockquote>", "<table>", "a=' ", "<td colspan=1000 rowspan=9>"])
def test_time_in_proportion(piece):
    """A megabyte of one piece of markup takes a few seconds at most, and twice as much about twice the time."""
    import time

    took = []
    for size in (1 << 19, 1 << 20):
        start = time.process_time()
        html_text.page_text(piece * (size // len(piece)) + "end")
        took.append(time.process_time() - start)
    assert took[1] < 3.2 * took[0] + 0.5 and took[1] < 40


def random_element(rng, depth, seen, words):
    """Markup of a random element, closed properly; the words that show are added to `words`."""
    out = ""
    for _ in range(rng.randint(0, 4)):
        if depth and rng.random() < 0.6:
            tag = rng.choice(["div", "section", "span", "b", "math", "blockquote", "ul", "script", "noscript", "template", "textarea", "table", "canvas"])
            style = rng.choice(["", "", "", "", " hidden", " style='display:none'", " style=\"visibility:hidden\"", " style='visibility: visible'", " title='a>b' class=\"visible hidden\"", " data-x=hidden"])
            shows = {"": seen, " style=\"visibility:hidden\"": False, " style='visibility: visible'": True}.get(style, seen)
            gone = style in (" hidden", " style='display:none'") or tag in ("script", "noscript", "template", "canvas")
            inside: list[str] = []
            if tag in ("script", "textarea", "noscript"):
                word = f"w{rng.randrange(10**9)}"
                body, inside = f" <b>{word}</b> if (a<b) ", [word] * shows
            elif tag == "ul":
                body = "".join(f"<li>{random_element(rng, depth - 1, shows, inside)}</li>" for _ in range(rng.randint(0, 3)))
            elif tag == "table":
                body = "".join("<tr>" + "".join(f"<td>{random_element(rng, depth - 1, shows, inside)}</td>" for _ in range(rng.randint(1, 3))) + "</tr>" for _ in range(rng.randint(1, 3)))
            else:
                body = random_element(rng, depth - 1, shows, inside)
            out += f"<{tag}{style}>{body}</{tag}>"
            words += [] if gone else inside
        else:
            word = f"w{rng.randrange(10**9)}"
            out += rng.choice([" ", "", "<br>", "<!-- no -->", "&amp; "]) + f" {word} "
            words += [word] * seen
    return out


def test_visible_words_of_random_trees():
    """What a plain recursion over the generated tree takes for visible, and nothing else, comes out."""
    rng = random.Random(12)
    for _ in range(400):
        words: list[str] = []
        page = random_element(rng, 5, True, words)
        assert sorted(re.findall(r"w\d+", html_text.page_text(page))) == sorted(words), page


def test_all_visible_words_stay():
    """Pages of random markup without hidden elements: every word comes out once, in order within its block."""
    rng = random.Random(8)
    tags = "p div ul li ol table tr td th b i span h2 blockquote pre section dl dt dd".split()
    for _ in range(300):
        page, words = "", []
        for k in range(rng.randint(1, 40)):
            r = rng.random()
            page += f"<{rng.choice(tags)}>" if r < 0.4 else f"</{rng.choice(tags)}>" if r < 0.6 else f" w{k} "
            words += [f"w{k}"] if r >= 0.6 else []
        assert sorted(re.findall(r"w\d+", html_text.page_text(page))) == sorted(words), page


def test_pages_of_a_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>a<p>b"), (2, None, None), (None, "u", "x"), (1, "u", "<p>a<p>b")], "page_id long, text string, html string")
    assert collected(html_text.extract_text(df), "page_id", "text", "n_lines") == sorted([(1, "a\n\nb", 3), (2, None, 0), (None, "x", 1), (1, "a\n\nb", 3)], key=repr)


@pytest.mark.parametrize("of", [mixing.mix, mixing.mixed, merkle.fingerprints, secrets.secret_digests, lambda d: piece_bpe.digests(d, piece_bpe.default_vocabulary())])
def test_empty_table(spark, of):
    assert of(documents(spark, [])).count() == 0
