import itertools
import random

import numpy as np
import pyarrow as pa

from shiplens.llm import langid
from shiplens.llm.langid import ChainField, chains, held_out, predict, train
from tests.llm.conftest import SCHEMA, table, words

VOCAB = {"en": "the of and with thing other which from".split(), "fr": "le la des une avec être où leçon".split(),
         "de": "der die und über schön nicht eine straße".split()}


def texts(seed=3, n=90):
    rng = random.Random(seed)
    langs = sorted(VOCAB)
    return [(i, words(rng, rng.choice([3, 20, 150]), VOCAB[langs[i % 3]]), langs[i % 3], "a", 0) for i in range(n)]


def brute_marginals(field, e, n):
    """Marginals of one chain by enumeration of all labellings."""
    k = len(field.labels)
    p, total = np.zeros((n, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        s = field.begin[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(field.trans[a, b] for a, b in zip(path, path[1:]))
        total += np.exp(s)
        for t, y in enumerate(path):
            p[t, y] += np.exp(s)
    return p / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    field = ChainField(["x", "y", "z"])
    field.trans, field.begin = rng.normal(size=(3, 3)), rng.normal(size=3)
    length = np.array([3, 5, 1])
    e = rng.normal(size=(9, 3))
    got, both, begin = field.marginals(e, np.array([0, 3, 8]), length, pairs=True)
    at = 0
    for n in length:
        assert np.allclose(got[at:at + n], brute_marginals(field, e[at:at + n], n))
        at += n
    assert np.isclose(both.sum(), (length - 1).sum()) and np.isclose(begin.sum(), 3)


def test_chains_cover_every_word():
    start, n = chains(np.array([0, 0, 64, 65, 300]))
    assert n.sum() == 300 and n.max() <= langid.SEGMENT
    assert sorted(x for s, k in zip(start, n) for x in range(s, s + k)) == list(range(300))


def test_accuracy_on_rows_not_learned_from(spark):
    df = spark.createDataFrame(texts(), SCHEMA).repartition(3)
    out = held_out()
    field = train(df.filter(~out))
    got = table(predict(df, field).filter(F_held(out)), "row.lang", "lang_pred", "score")
    assert len(got) > 8 and all(a == b and 0 <= s <= 1 for a, b, s in got)
    again = train(df.repartition(5).filter(~out))
    assert np.array_equal(field.weights, again.weights)


def F_held(c):
    from pyspark.sql import functions as F
    return F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 5 == 0, F.lit(False))


def test_words_of_mixed_text_get_their_own_labels(spark):
    field = train(spark.createDataFrame(texts(), SCHEMA))
    w, p = field.label_words(pa.array(["the other thing with " * 5 + "der straße nicht über " * 5]))
    names = [field.labels[i] for i in p.argmax(axis=1)]
    assert names[:15] == ["en"] * 15 and names[-15:] == ["de"] * 15


def test_edges(spark, docs, wide_docs, no_docs):
    field = train(spark.createDataFrame(texts(), SCHEMA))
    got = table(predict(docs, field), "row.doc_id", "lang_pred", "score")
    assert len(got) == docs.count() and got == table(predict(wide_docs, field), "row.doc_id", "lang_pred", "score")
    odd = [(1, None, None, "a", 0), (2, "", None, "a", 0), (3, "123 — !? ①", None, "a", 0), (4, "é", None, "a", 0)]
    got = table(predict(spark.createDataFrame(odd, SCHEMA), field), "lang_pred", "score")
    assert [r for r in got if r[0] == "und"] == [("und", 0.0)] * 3 and len(got) == 4
    assert table(predict(no_docs, field), "lang_pred") == []
    none = train(no_docs)
    assert {r[0] for r in table(predict(docs, none), "lang_pred")} == {"und"}


def test_a_language_of_long_texts_only_is_learned(spark):
    from shiplens.llm.langid import train
    from tests.llm.conftest import SCHEMA
    rows = [(i, "the cat and the dog", "en", "a", 0) for i in range(20)] + [(50 + i, "der hund und die katze " * 9, "de", "a", 0) for i in range(20)]
    assert train(spark.createDataFrame(rows, SCHEMA), sample_chars=50).labels == ["de", "en"]
