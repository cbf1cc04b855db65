import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# further columns whose names clash with what operators produce
CLASHING = "n_words long, score double, component_id long, row string, kept string, shard long, taken long, node long"


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    from shiplens.llm.queries import share_package
    share_package(spark)


def words(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


def corpus(seed=1, n=120):
    """Documents with exact and near copies, shared lines, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "ka lo mi nu pe ra so tu".split() for b in "ban cel dor fin gul".split()]
    rows = []
    shared = [words(rng, 9, vocab) for _ in range(6)]
    for i in range(n):
        kind = i % 8
        if rows and kind == 1:
            text = rng.choice(rows)[1]
        elif rows and kind in (2, 3):
            base = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randint(1, 4)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
            text = " ".join(base)
        elif kind == 4:
            text = "\n".join([words(rng, 12, vocab), rng.choice(shared), words(rng, 15, vocab), "  " + rng.choice(shared).upper() + "\t"])
        else:
            text = words(rng, rng.choice([1, 2, 3, 4, 5, 40, 90]), vocab)
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", "c", None][i % 4], len(text or "")))
    rows.append((n, None, "en", "a", None))
    rows.append((n + 1, "", "en", None, 0))
    rows.append((n + 2, " \t\n ", None, "b", 4))
    rows.append((n + 3, words(rng, 30_000, vocab), "en", "a", 0))
    rows.append((n + 4, "ÄÖ é\x0bß  naïve — 123  x", "de", "d", 0))
    rows.append(rows[5])                       # a repeated row
    rows.append((None, rows[7][1], "en", "a", 1))  # no doc_id
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def wide_docs(docs):
    """The same rows with columns that have the operators' own names."""
    from pyspark.sql import functions as F
    out = docs
    for part in CLASHING.split(", "):
        name, kind = part.split(" ")
        out = out.withColumn(name, F.lit("7").cast(kind))
    return out


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table(df, *cols):
    """Sorted rows of a small result."""
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=key)
