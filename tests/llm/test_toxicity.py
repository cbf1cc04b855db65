import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shiplens.llm import textops as tx
from shiplens.llm import toxicity as tox
from shiplens.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, table, words


def distance(a, b):
    """Edits between two words; swapped neighbours are one."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def brute(word_list, terms, stems):
    out = []
    for i, w in enumerate(word_list):
        for k, t in enumerate(terms):
            e = distance(w, t)
            if e == 0 or (e == 1 and len(t) >= tox.EDIT_FROM and w not in terms):
                out.append((i, k, e))
        out += [(i, len(terms) + k, 0) for k, s in enumerate(stems) if w.startswith(s)]
    return sorted(out)


def found(word_list, terms, stems):
    points = np.array([ord(c) for w in word_list for c in w], np.int64)
    off = np.concatenate([[0], np.cumsum([len(w) for w in word_list])]).astype(np.int64)
    return [tuple(map(int, r)) for r in zip(*tox.Lexicon(terms, stems).match(points, off))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abcé", min_size=1, max_size=8), min_size=1, max_size=6),
       st.lists(st.text("abcé", min_size=3, max_size=7), min_size=1, max_size=8, unique=True),
       st.lists(st.text("abé", min_size=2, max_size=4), max_size=3, unique=True))
def test_automaton_product_equals_edit_distance(word_list, terms, stems):
    assert found(word_list, terms, stems) == brute(word_list, terms, stems)


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(tox.INSULTS), st.data())
def test_one_edit_of_an_insult(term, data):
    i = data.draw(st.integers(0, len(term) - 1))
    c = data.draw(st.sampled_from("aeiou"))
    for w in (term[:i] + c + term[i:], term[:i] + c + term[i + 1:], term[:i] + term[i + 1:], term[:i] + term[i:i + 2][::-1] + term[i + 2:]):
        assert found([w, "x" + w + "x"], tox.INSULTS, []) == brute([w, "x" + w + "x"], tox.INSULTS, [])


def spots(*texts):
    lex = tox.Lexicon(tox.INSULTS, ["réeu"])
    row, term, edits, ctx, start, end = tox.occurrences(pa.array(texts), lex, tox.Cues())
    return [(int(r), lex.terms[k][0], int(e), float(c)) for r, k, e, c in zip(row, term, edits, ctx)]


def test_obfuscated_and_foreign_words():
    got = spots("An 1d!ot? IDI0T.", "mor0n$ and m@ron", None, "", "ESTÚPIDO réeuxpa RÉEUX Réeu", "idi ot, i.d.i.o.t, stupid$$$", "7 8 $ @")
    assert [(r, t, e) for r, t, e, _ in got] == [
        (0, "idiot", 0), (0, "idiot", 0), (1, "moron", 0), (1, "moron", 1), (4, "estúpido", 0), (4, "réeu", 0), (4, "réeu", 0),
        (4, "réeu", 0), (5, "stupid", 0)]


def test_quotation_and_abuse():
    q, r, s = tox.QUOTED, tox.REPORTED, tox.SPOKEN
    got = spots('They wrote "idiot" on the wall', "an idiot fell", "you idiot", 'the word moron is old', '"you idiot"', 'a "b" idiot "c"',
                "« idiot »", '"open\nidiot" there', 'the “scum” of it, loser')
    assert [(i, c) for i, _, _, c in got] == [(0, q * r), (1, 1.0), (2, s), (3, r), (4, q * s), (5, 1.0), (6, q), (7, 1.0), (8, q), (8, 1.0)]


def labelled(n=300, seed=5):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "ka lo mi nu pe".split() for b in "ban cel dor fin gul hem".split()]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        w = words(rng, rng.choice([20, 60, 200]), vocab).split(" ")
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["zorgfel", "zorgman", "zorgtip", "scum", "glarbo"]))
        if i % 7 == 1:
            w.insert(3, rng.choice(["lobanx", "zorba"]))
        rows.append((i, " ".join(w), "en", "a", 0))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learned_terms_and_held_out_accuracy(spark):
    rows, labels = labelled()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tox.train(df, lab.filter("doc_id % 5 <> 0"))
    assert ("zorg", True) in model.lexicon.terms and ("glarbo", False) in model.lexicon.terms
    got = {r[0]: r[1:] for r in table(tox.score(df, model), "row.doc_id", "score", "predicted")}
    held = [(t, got[i][1]) for i, _, t in labels if i % 5 == 0]
    assert np.mean([t == p for t, p in held]) >= 0.97 and sum(t for t, _ in held) >= 8
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in got.values())
    again = tox.train(df.repartition(6), lab.filter("doc_id % 5 <> 0"))
    assert np.allclose(model.w, again.w) and model.lexicon.terms == again.lexicon.terms
    spread = spark.createDataFrame([(1, "glarrbo zorgfel scum kaban glarbo", "en", "a", 0), (2, "kaban lodor", "en", "a", 0)], SCHEMA)
    assert [r[0] for r in table(tox.score(spread, model), "row.doc_id", "predicted") if r[1]] == [1]
    at = table(tox.matches(spread, model).selectExpr("row.doc_id", "explode(matches) as m").selectExpr("doc_id", "m.term", "m.start", "m.end", "m.edits"))
    assert (1, "glarbo", 0, 7, 1) in at and (1, "zorg*", 8, 15, 0) in at and all(r[0] == 1 for r in at)


def test_scores_do_not_depend_on_neighbours():
    m = tox.ToxicityModel(tox.Lexicon(tox.INSULTS, ["ab"]))
    t = ["You idiot, scum! " * 40, "", "abba — “trash” é\nyou", "x " * 4000, None, '"stupid']
    whole = m.score(pa.array(t))
    for i, x in enumerate(t):
        assert np.allclose(whole[i], m.score(pa.array([x], pa.string()))[0])
    assert whole[0] > 0.9 and whole[1] == whole[4] < 0.5


def test_edges(spark, docs, wide_docs, no_docs):
    kind = "doc_id long, quality int, toxic int"
    none = tox.train(docs, spark.createDataFrame([], kind))
    assert {r for r in table(tox.score(docs, none), "predicted")} == {(0,)}
    one = tox.train(docs, spark.createDataFrame([(1, 0, 1), (2, 0, 1), (None, 0, 0), (3, 0, None)], kind))
    assert {r[0] for r in table(tox.score(docs, one), "predicted")} == {1}
    both = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(5, 1, 0), (5, 1, 1)], kind)   # a conflict: toxic
    model = tox.train(docs, both)
    got = table(tox.score(docs, model), "row.doc_id", "score", "predicted")
    assert len(got) == docs.count() and got == table(tox.score(wide_docs, model), "row.doc_id", "score", "predicted")
    assert table(tox.score(no_docs, model), "score") == []
    assert tox.train(no_docs, both).lexicon.terms


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op13_toxicity"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got]
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([t == p for t, p in held]) >= 0.95
