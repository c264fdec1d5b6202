"""Small tables with the awkward cases, shared by the tests of the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, hash string, size long, keep_id long"
COMMON = "the of and to in is on that for with as was at by it from".split()


def sentence(rng, n):
    return " ".join(rng.choice(COMMON) if rng.random() < 0.4 else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def passage(rng, lines=6):
    return "\n".join(sentence(rng, rng.randint(6, 14)).capitalize() + "." for _ in range(lines))


def rows(seed=5):
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, ties, repeated rows, one long text."""
    rng = random.Random(seed)
    shared, base = passage(rng, 4), [passage(rng, rng.randint(1, 9)) for _ in range(24)]
    near = base[3].split()
    texts = [*base, base[0], base[0], base[1], "", None, " \n\t ", "word", "two words", "two words", "Two WORDS", "ſ K é 日本 \U0001F600"]
    texts += [f"{passage(rng, 2)}\n{shared}\n{passage(rng, 1)}" for _ in range(5)] + [shared + "\n" + shared]
    for k in range(6):
        words = list(near)
        words[rng.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts.append(" ".join(sentence(rng, 40) for _ in range(120)) + "\n" + shared)
    texts.append("x" * 30_000 + " tail " + base[2])
    out = [(k * 3 + 1, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])) for k, t in enumerate(texts)]
    out.append(out[5])
    out.append(out[5])
    out.append((None, base[4], "en", "a"))
    out.append((None, "nothing else like this one", None, None))
    out.append((-7, base[6], "fr", "b"))
    return out


def documents(spark, chosen=None):
    """The rows as `documents`, with columns whose names the operators use themselves."""
    data = [(i, t, lang, source, None, "row", 3, "hash", 8, 9) for i, t, lang, source in (rows() if chosen is None else chosen)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
