"""Operator 12 - alignment of two tokenizers, with an identity-map fast path.

A text's tokens under both tokenizers are laid on its bytes; the places where tokens of both end
cut them into groups.  Nearly all groups are one token on either side.  For these a map from each
A id to the B id of the same bytes is made once, so a text's exact one-to-one links are
plain A ids; how many documents hold each is counted in one vector a task, as long as the vocabulary.
Only what irregular groups link (and the rare one-to-one pair that the map does not name, such as
a byte token) is shuffled as pairs.

The links of each document are written once, so that texts are encoded once.  Corpus counts then
come back in two ways: the vector, the highest count of every A id and the pairs held by the most
documents are broadcast (``HEAVY`` pairs at most, whatever the corpus); pairs below that count meet
theirs in a shuffle, where no pair has more rows than that count.
"""

from __future__ import annotations

import functools
import json
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize

HEAVY = 1 << 18          # pairs broadcast: 16 bytes each
EXPAND = 1 << 21         # links of irregular groups held at once: bounds memory, cuts nothing off

LINK = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("n", T.LongType())]))
PAIR = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                                 T.StructField("n", T.LongType())]))


class Vocabulary:
    """Bytes and decimal names of a tokenizer's ids."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        names = [str(i).encode() for i in range(len(pieces))]
        self.name_size = np.array([len(x) for x in names], np.int64)
        width = max(map(len, names), default=1)
        self.names = np.frombuffer(b"".join(x.ljust(width) for x in names), np.uint8).reshape(-1, width)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.data[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.start[ids] - (stop - size), size)]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


#: how byte-level vocabularies of this kind cut a text before merging; fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """A byte-level tokenizer file; texts are encoded behind one space, special tokens as plain text.

    Where the file is a plain byte-pair vocabulary with the usual cut (ids in order of its merges), its own
    ranks are given to ``tiktoken``, which gives the same ids in a fifth of the time; any other file is
    run by ``tokenizers``.
    """

    def __init__(self, path: str, plain: bool | None = None):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab, letters = spec["model"]["vocab"], byte_letters()
        pieces = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in {**vocab, **added}.items():
            pieces[i] = bytes(letters[c] for c in token) if token not in added and all(c in letters for c in token) else token.encode()
        self.pieces, self.vocabulary = pieces, Vocabulary(pieces)
        self.fast = self._ranks(spec, vocab, added, letters) if plain is not False else None
        if self.fast is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self.tool = Tokenizer.from_file(path)
            self.tool.encode_special_tokens = True

    @staticmethod
    def _ranks(spec, vocab, added, letters):
        """The vocabulary as a rank table, if merging by rank is merging by the file's list."""
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        usual = cut == {**cut, "type": "ByteLevel", "add_prefix_space": False} and cut.get("use_regex", True) and not spec.get("normalizer") \
            and model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        ids = [vocab.get(a + b) for a, b in merges]
        if not usual or None in ids or any(x >= y for x, y in zip(ids, ids[1:])) or len(vocab) - len([t for t in added if t in vocab]) != len(merges) + 256:
            return None
        import tiktoken
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.fast is not None:
            found = [np.array(self.fast.encode_ordinary(" " + t), np.int64) for t in texts]
        else:
            found = [np.array(x.ids, np.int64) for x in self.tool.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(x) for x in found], np.int64)


class Pieces:
    """A sentence-piece model with byte fallback, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.tool.get_piece_size()
        self.pieces = [bytes([int(self.tool.id_to_piece(i)[3:5], 16)]) if self.tool.is_byte(i)
                       else self.tool.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.special = np.array([self.tool.is_byte(i) or self.tool.is_control(i) or self.tool.is_unknown(i) for i in range(n)])
        self.vocabulary = Vocabulary(self.pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self.tool.encode(t), np.int64) for t in texts]
        return np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(x) for x in found], np.int64)


@functools.lru_cache(maxsize=2)
def tokenizers_at(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces, np.ndarray]:
    """Both tokenizers and the identity map: the B id of the same bytes for each A id, or -1 (once a worker)."""
    a, b = ByteLevel(a_path), Pieces(b_path)
    of = {}
    for i, p in enumerate(b.pieces):
        if not b.special[i]:
            of.setdefault(p, i)
    return a, b, np.array([of.get(p, -1) for p in a.pieces], np.int64)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, n
    found, inverse = np.unique(keys, return_inverse=True)
    return found, np.bincount(inverse, n, len(found)).astype(np.int64)


class Alignment:
    """Groups of the texts of one batch: texts without tokens have none.

    a, b : ids;  a_of, b_of : their groups;  a_many, b_many : tokens of each group;  doc : text of each group
    """

    def __init__(self, texts: pa.Array, a: ByteLevel, b: Pieces):
        n = len(texts)
        strings = [t or "" for t in texts.to_pylist()]
        ids_a, na = a.encode(strings)
        ids_b, nb = b.encode(strings)
        raw, off = tx.text_bytes(texts)
        size = np.diff(off)
        spaced = np.full(len(raw) + n, 32, np.uint8)
        spaced[np.arange(len(raw)) + np.repeat(np.arange(n) + 1, size)] = raw
        begin = off + np.arange(n + 1)
        right = size > 0
        for ids, many, v in ((ids_a, na, a.vocabulary), (ids_b, nb, b.vocabulary)):
            row = np.repeat(np.arange(n), many)
            length = np.bincount(row, v.size[ids], n).astype(np.int64)
            fits = length == size + 1
            got = v.joined(ids[fits[row]])
            wrong = np.zeros(len(spaced), bool)
            wrong[np.repeat(fits, size + 1)] = got != spaced[np.repeat(fits, size + 1)]
            wrong = np.concatenate([[0], np.cumsum(wrong)])
            right &= fits & (wrong[begin[1:]] == wrong[begin[:-1]])
        keep_a, keep_b = np.repeat(right, na), np.repeat(right, nb)
        self.a, self.b, self.n = ids_a[keep_a], ids_b[keep_b], n
        self.n_a, self.n_b = np.where(right, na, 0), np.where(right, nb, 0)
        end_a, end_b = np.cumsum(a.vocabulary.size[self.a]), np.cumsum(b.vocabulary.size[self.b])
        at = np.searchsorted(end_b, end_a)
        both = end_a[end_b[at] == end_a] if len(end_a) else end_a
        self.a_of, self.b_of = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        self.a_many, self.b_many = np.bincount(self.a_of, minlength=len(both)), np.bincount(self.b_of, minlength=len(both))
        row_a = np.repeat(np.arange(n), self.n_a)
        self.doc = row_a[np.cumsum(self.a_many) - 1] if len(both) else np.zeros(0, np.int64)
        self.names = a.vocabulary, b.vocabulary

    def links(self, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Links by the identity map (doc, a, times), and other linked pairs (doc, a, b, times); each once a document."""
        first_a, first_b = np.cumsum(self.a_many) - self.a_many, np.cumsum(self.b_many) - self.b_many
        one = np.flatnonzero((self.a_many == 1) & (self.b_many == 1))
        exact = one[same[self.a[first_a[one]]] == self.b[first_b[one]]]
        wide = np.int64(len(same))
        fast = [_summed(self.doc[exact] * wide + self.a[first_a[exact]], np.ones(len(exact), np.int64))]
        odd = np.ones(len(self.a_many), bool)
        odd[exact] = False
        odd = np.flatnonzero(odd)
        total = np.cumsum(self.a_many[odd] * self.b_many[odd])
        other, at = [], 0
        while at < len(odd):
            end = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + EXPAND, side="right")), at + 1)
            g = odd[at:end]
            if len(g) == 1:        # one group of any size: its distinct ids with their counts
                xa, ca = np.unique(self.a[first_a[g[0]]:first_a[g[0]] + self.a_many[g[0]]], return_counts=True)
                xb, cb = np.unique(self.b[first_b[g[0]]:first_b[g[0]] + self.b_many[g[0]]], return_counts=True)
                pa_, pb_, times = np.repeat(xa, len(xb)), np.tile(xb, len(xa)), np.outer(ca, cb).ravel()
                d = np.full(len(pa_), self.doc[g[0]])
            else:
                many = self.a_many[g] * self.b_many[g]
                t = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                gg = np.repeat(g, many)
                pa_, pb_ = self.a[first_a[gg] + t // self.b_many[gg]], self.b[first_b[gg] + t % self.b_many[gg]]
                times, d = np.ones(len(gg), np.int64), self.doc[gg]
            named = same[pa_] == pb_
            fast.append(_summed(d[named] * wide + pa_[named], times[named]))
            # ids are below 2^20: document, a and b share one number
            other.append(_summed((d[~named] << 40) | (pa_[~named] << 20) | pb_[~named], times[~named]))
            at = end
        f, nf = _summed(np.concatenate([x[0] for x in fast]), np.concatenate([x[1] for x in fast]))
        none = np.zeros(0, np.int64)
        o, no = _summed(np.concatenate([none, *(x[0] for x in other)]), np.concatenate([none, *(x[1] for x in other)]))
        return f // wide, f % wide, nf, o >> 40, (o >> 20) & 0xFFFFF, o & 0xFFFFF, no

    def text(self) -> list[bytes]:
        """Per text ``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        va, vb = self.names
        cum_a, cum_b = np.concatenate([[0], np.cumsum(self.a_many)]), np.concatenate([[0], np.cumsum(self.b_many)])
        total = len(self.a) + len(self.b)
        at_a, at_b = np.arange(len(self.a)) + cum_b[self.a_of], np.arange(len(self.b)) + cum_a[self.b_of + 1]
        cells = np.zeros((total, max(va.names.shape[1], vb.names.shape[1]) + 1), np.uint8)
        size = np.zeros(total, np.int64)
        for at, ids, v, cum, mark in ((at_a, self.a, va, cum_a, b"|"), (at_b, self.b, vb, cum_b, b";")):
            cells[at, :v.names.shape[1]] = v.names[ids]
            size[at] = v.name_size[ids]
            cells[at, size[at]] = ord(",")
            last = at[cum[1:] - 1]
            cells[last, size[last]] = ord(mark)
        data = cells[np.arange(cells.shape[1]) <= size[:, None]].tobytes()
        stop = np.concatenate([[0], np.cumsum(size + 1)])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        return [data[x:max(x, y - 1)] for x, y in zip(stop[:-1].tolist(), stop[1:].tolist())]


def _structs(doc: np.ndarray, rows: int, **cols) -> pa.ListArray:
    off = np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)
    kinds = {"n": pa.int64()}
    return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(
        [pa.array(v, kinds.get(k, pa.int32())) for k, v in cols.items()], names=list(cols)))


def _aligner(a_path: str, b_path: str):
    def run(batches):
        a, b, same = tokenizers_at(a_path, b_path)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                got = Alignment(tx.column(part, "text"), a, b)
                fd, fa, fn, od, oa, ob, on = got.links(same)
                n_links = np.bincount(got.doc, got.a_many * got.b_many, got.n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "row"), pa.array(got.n_a, pa.int64()), pa.array(got.n_b, pa.int64()),
                     pa.array(np.bincount(got.doc, minlength=got.n), pa.int64()), pa.array(n_links, pa.int64()),
                     pa.array(got.text(), pa.binary()).cast(pa.string()), _structs(fd, got.n, a=fa, n=fn), _structs(od, got.n, a=oa, b=ob, n=on)],
                    names=["row", "n_a", "n_b", "n_groups", "n_links", "groups", "same", "other"])
    return run


def align(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows (row, n_a, n_b, n_groups, n_links, groups, same, other) for every whole text of ``documents``.

    ``groups`` holds the ids of every group, ``same`` the links by the identity map (A id, times)
    and ``other`` all other linked pairs (A id, B id, times), each once a document.  One scan, no shuffle.
    The paths must name files that every executor has.

    Defined cases: null and empty texts, and those that either tokenizer does not give back byte
    by byte, have no tokens (zeros, '' and empty lists); an empty table gives no rows; further columns
    may have any name.
    """
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                           T.StructField("groups", T.StringType()), T.StructField("same", LINK), T.StructField("other", PAIR)])
    return rows.mapInArrow(_aligner(a_path, b_path), schema)


def _vector(size: int):
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = tx.column(batch, "same").flatten().field("a").to_numpy(zero_copy_only=False)
            total += np.bincount(ids, minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["a", "n"])
    return run


def _counter(model):
    """Sums over the links of each document whose counts were broadcast; the other links are handed on."""
    def run(batches):
        vector, best, keys, counts = model.value
        for batch in batches:
            n = batch.num_rows
            score, top = np.zeros(n, np.int64), np.zeros(n, np.int64)

            def add(doc, a, times, count):
                np.add.at(score, doc, times * count)
                np.add.at(top, doc, np.where(count == best[a], times, 0))

            def read(name, *fields):
                col = tx.column(batch, name)
                flat = col.flatten()
                return (np.repeat(np.arange(n), np.diff(col.offsets.to_numpy())), *(flat.field(f).to_numpy(zero_copy_only=False) for f in fields))

            doc, a, times = read("same", "a", "n")
            add(doc, a, times, vector[a])
            doc, a, b, times = read("other", "a", "b", "n")
            key = (a.astype(np.int64) << 32) | b
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            known = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            add(doc[known], a[known], times[known], counts[at[known]] if len(keys) else times[known])
            rest = ~known
            yield pa.RecordBatch.from_arrays(
                [tx.column(batch, "id"), pa.array(top, pa.int64()), pa.array(score, pa.int64()),
                 _structs(doc[rest], n, a=a[rest], b=b[rest], n=times[rest])], names=["id", "n_best", "count_sum", "rest"])
    return run


def link_counts(documents: DataFrame, a_path: str, b_path: str, heavy: int = HEAVY) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The count of an id pair is the number of documents that hold it linked.  ``n_best``: links whose
    count is the highest of their A id; ``count_sum``: sum of the counts of all links.
    Defined cases as in ``align``; a null or repeated doc_id is a document like any other.
    """
    spark = documents.sparkSession
    sha = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    done = materialize(align(documents, a_path, b_path).select(
        F.monotonically_increasing_id().alias("id"), F.col("row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        sha.alias("groups_sha256"), "same", "other"))
    size = len(tokenizers_at(a_path, b_path)[2])
    vector, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    held = done.select("same").mapInArrow(_vector(size), "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()  # a row an A id
    vector[held["a"].to_numpy()] = held["n"].to_numpy()
    pairs = materialize(done.select(F.explode("other").alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n")))
    top = pairs.groupBy("a").agg(F.max("n").alias("n")).toArrow()
    best[top["a"].to_numpy()] = top["n"].to_numpy()
    best = np.maximum(best, vector)
    # the least power of two that at most ``heavy`` pairs reach
    at_most, least = 0, 1 << 62
    for r in pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("m")).orderBy(F.desc("k")).collect():
        at_most += r["m"]
        if at_most > heavy:
            break
        least = 1 << r["k"]
    known = pairs.filter(F.col("n") >= least).toArrow()
    keys = (known["a"].to_numpy().astype(np.int64) << 32) | known["b"].to_numpy()
    order = np.argsort(keys)
    model = spark.sparkContext.broadcast((vector, best, keys[order], known["n"].to_numpy()[order]))
    sums = done.select("id", "same", "other").mapInArrow(_counter(model), T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("rest", PAIR)]))
    highest = spark.createDataFrame(pa.table({"a": pa.array(np.arange(size), pa.int32()), "best": pa.array(best, pa.int64())}).to_pandas(), "a int, best long")
    tail = pairs.filter(F.col("n") < least).join(F.broadcast(highest), "a")       # a row an A id
    late = sums.select("id", F.explode("rest").alias("p")).select("id", "p.a", "p.b", F.col("p.n").alias("times")).join(tail, ["a", "b"]) \
        .select("id", (F.col("times") * F.col("n")).alias("score"), F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0).alias("top"))
    out = sums.select("id", "n_best", "count_sum").unionByName(late.select("id", F.col("top").alias("n_best"), F.col("score").alias("count_sum"))) \
        .groupBy("id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return done.select("id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(out, "id").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
