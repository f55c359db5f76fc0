import random

import pytest

WORDS = "the of and in to Lorem ipsum dolor sit amet Straße été señor naïve x1 42 ... end".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty and long texts, odd spaces and repeated rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([1, 3, 5, 12, 13, 14, 60, 200])) for _ in range(60)]
    long = prose(rng, 9000)
    passage = prose(rng, 70)
    out = list(enumerate(base))
    out += [(100 + k, base[k % 7].upper() if k % 2 else base[k % 7]) for k in range(30)]
    for k in range(40):
        words = base[k % 20 + 20].split()
        words[rng.randrange(len(words))] = f"new{k}"
        out.append((200 + k, " ".join(words)))
    out += [(300 + k, prose(rng, 30) + "\n" + passage + "\t" + prose(rng, 30)) for k in range(12)]
    out += [(400, None), (401, ""), (402, " \t\n"), (403, None), (404, long), (405, long + " tail"), (406, "one  two\tthree\x0bfour\rfive \x0csix"), (407, "One two Three four five six")]
    out += [(5, base[5]), (5, base[5]), (6, base[9]), (None, base[3]), (None, "without an id " * 9), (None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with other columns, some of which have names that operators use inside."""
    table = [(i, t, "en" if k % 3 else None, None if k % 5 == 0 else "src0", len(t or ""), k, "x", k, b"y") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, id int, node string, chunk int, rest binary").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
