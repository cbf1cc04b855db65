import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shiplens.llm import align as al
from shiplens.llm.queries import QUERIES, TOKENIZERS
from tests.llm.conftest import SCHEMA, corpus, table

A_PATH, B_PATH = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """(doc_id, text) rows, token by token."""
    a, b = al.ByteLevel(A_PATH, plain=False), al.Pieces(B_PATH)     # the tokenizer file itself
    docs = []
    for doc_id, text in rows:
        groups, ids = [], ([], [])
        if text:
            want = (" " + text).encode()
            ids = (a.tool.encode(" " + text, add_special_tokens=False).ids, b.tool.encode(text))
            if b"".join(a.pieces[i] for i in ids[0]) != want or b"".join(b.pieces[i] for i in ids[1]) != want:
                ids = ([], [])
            ends = [np.cumsum([len(p.pieces[i]) for i in x]).tolist() for p, x in zip((a, b), ids)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            at = [0, 0]
            for c in cuts:
                to = [y.index(c, k) + 1 for y, k in zip(ends, at)]
                groups.append(tuple(list(x[k:m]) for x, k, m in zip(ids, at, to)))
                at = to
        docs.append((doc_id, ids, groups))
    held = Counter()
    for _, _, groups in docs:
        held.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, ids, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc_id, len(ids[0]), len(ids[1]), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


ODD = ["<|endoftext|> is text", "</s><s><unk> too", "naïve Straße 東京 🙂🙂 ​ x", "a▁b", "  two  spaces\t\ttabs\r\n\n", "\x00 nul", " ",
       "0" * 70 + " " * 37 + "!" * 55, "ﬁ ½ Å é", "İstanbul", "a" * 3000, "ab" * 1500, "\n\n\n\n" * 40, "\xa0nbsp　wide"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    some = [(r[0], r[1], "en", "a", 0) for r in corpus(n=60)]
    texts = [" ".join(rng.choice(["Licensed under the Apache License,", "qzx", "overwhelmingly", "Übergrößenträger", "1234567", "don't", "--", "réêou"])
                      for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return some + [(1000 + i, t, "en", "a", 0) for i, t in enumerate(ODD + texts)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("heavy", [1 << 18, 40, 0])
def test_against_token_by_token(frame, rows, heavy):
    assert table(al.link_counts(frame, A_PATH, B_PATH, heavy=heavy), *COLS) == brute([r[:2] for r in rows])


def test_groups_are_whole_texts(frame):
    a, b, _ = al.tokenizers_at(A_PATH, B_PATH)
    seen = 0
    for r in al.align(frame, A_PATH, B_PATH).collect():
        text = r["row"]["text"]
        if r["groups"]:
            sides = [g.split("|") for g in r["groups"].split(";")]
            for k, v in ((0, a), (1, b)):
                assert b"".join(v.pieces[int(i)] for s in sides for i in s[k].split(",")) == (" " + text).encode()
            assert all(b"".join(a.pieces[int(i)] for i in x.split(",")) == b"".join(b.pieces[int(i)] for i in y.split(",")) for x, y in sides)
            seen += 1
        else:
            assert r["n_a"] == r["n_b"] == r["n_links"] == 0 and not r["same"] and not r["other"]
    assert seen > 80


def test_large_irregular_group_is_whole(monkeypatch):
    a, b, same = al.tokenizers_at(A_PATH, B_PATH)
    texts = pa.array([" ".join(ODD), None, "Übergrößenträger " * 50, ""])
    want = al.Alignment(texts, a, b).links(same)
    monkeypatch.setattr(al, "EXPAND", 3)
    assert all(np.array_equal(x, y) for x, y in zip(want, al.Alignment(texts, a, b).links(same)))


def test_identity_map():
    a, b, same = al.tokenizers_at(A_PATH, B_PATH)
    some = np.flatnonzero(same >= 0)
    assert len(some) > 10_000 and all(a.pieces[i] == b.pieces[same[i]] for i in some)
    missing = set(range(len(same))) - set(some.tolist())
    plain = {p for i, p in enumerate(b.pieces) if not b.special[i]}
    assert not any(a.pieces[i] in plain for i in missing)


def test_edges(spark, docs, wide_docs, no_docs):
    got = table(al.link_counts(docs, A_PATH, B_PATH), *COLS)
    assert len(got) == docs.count() and got == table(al.link_counts(wide_docs, A_PATH, B_PATH), *COLS)
    assert table(al.link_counts(no_docs, A_PATH, B_PATH), *COLS) == []


def test_registered_query(spark):
    got = QUERIES["op12_align_tokenizers"](spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert table(got, *COLS) == brute(rows)


def test_rank_table_gives_the_ids_of_the_file(rows):
    """Every code point beside letters, digits and spaces, and the fixture's texts."""
    fast, slow = al.ByteLevel(A_PATH), al.ByteLevel(A_PATH, plain=False)
    assert fast.fast is not None and slow.fast is None and fast.pieces == slow.pieces
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1{c} {c}  {c}{c}'s{c}" for c in chars] + [r[1] for r in rows if r[1]]
    for x, y in zip(fast.encode(texts), slow.encode(texts)):
        assert np.array_equal(x, y)


def test_other_files_are_run_as_they_are(tmp_path):
    """A file with another cut, or merges out of order, is no rank table."""
    import json
    spec = json.loads(open(A_PATH, encoding="utf-8").read())
    for name, change in (("cut", {"pre_tokenizer": dict(spec["pre_tokenizer"], add_prefix_space=True)}),
                         ("order", {"model": dict(spec["model"], merges=spec["model"]["merges"][1:] + spec["model"]["merges"][:1])})):
        p = tmp_path / name
        p.write_text(json.dumps({**spec, **change}), encoding="utf-8")
        assert al.ByteLevel(str(p)).fast is None
