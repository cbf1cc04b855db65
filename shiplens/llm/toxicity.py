"""Operator 13 - toxicity by Levenshtein automata intersected with a lexicon trie.

The lexicon holds whole terms and stems (a stem matches every word that begins with it).  It is
learned from labelled documents, beside a short list of known insults: the words and word
beginnings that toxic documents hold far more often than others.  Its terms form one trie.

Every distinct word of a batch runs through the product of that trie and its Levenshtein
automaton: a state is (trie node, place in the word, edits so far), and all words' states move
together as arrays.  One edit (a letter changed, added, left out, or two neighbours swapped) is
allowed for terms of ``EDIT_FROM`` letters or more; branches that cannot end in such a term of a fitting
length are cut.  Digits and signs written for letters inside a word (``1d!ot``) are read as letters.

Each occurrence of a term has a context score: a window of ``WINDOW`` words to both sides and the
quotation marks of its line separate a quoted or reported term from abuse that speaks to
somebody.  A document's features are, by term and by group of terms, the logarithm of one plus the summed
context scores (a misspelled one counts ``MISSPELLED``); a logistic regression weighs them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.llm import textops as tx
from shiplens.session import materialize, release

SAMPLE = 3000              # labelled documents of each kind that are learned from
TERMS = 600                # learned terms
STEM = (4, 10)             # letters of a stem
MIN_DOCS, MIN_RATIO = 5, 3.0
EDIT_FROM = 5
WINDOW = 8
QUOTED, REPORTED, SPOKEN, MISSPELLED = 0.25, 0.5, 1.5, 0.6   # context scores of an occurrence
STEPS, RATE, L2 = 300, 0.1, 2e-3
PRIOR = 0.5                # weight of a known insult without any label

# fixed values: insults, words of report and of address in four languages
INSULTS = ("idiot moron stupid scum trash loser pathetic worthless disgusting clown imbecile bastard vermin filthy "
           "dumb idiota estúpido basura imbécil escoria idiote stupide ordure crétin abruti dumm blöd abschaum dummkopf trottel").split()
REPORT = ("word words term terms said says called quote quoted quotes wrote wort begriff sagte mot terme dit écrit palabra "
          "término dijo").split()
ADDRESS = "you your youre yours du dich dir ihr euch dein tu te toi vous ton votre tú usted ustedes vosotros".split()

_LEET = {b"0": b"o", b"1": b"i", b"3": b"e", b"4": b"a", b"5": b"s", b"7": b"t", b"@": b"a", b"$": b"s", b"!": b"i"}
_LETTER = tx.IS_LETTER
_MEANT = np.arange(256, dtype=np.uint8)
for _k, _v in _LEET.items():
    _MEANT[_k[0]] = _v[0]
_SIGN = np.zeros(256, bool)
_SIGN[[k[0] for k in _LEET]] = True


def plain_letters(arr: pa.Array) -> pa.Array:
    """The texts with letters of Latin script in lower case, and signs inside words read as letters; bytes stay in place."""
    raw, off = tx.text_bytes(arr)
    out = tx.LOWER[raw]
    if len(raw):
        lead = np.zeros(len(raw), bool)
        lead[1:] = raw[:-1] == 0xC3
        out[lead & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 0x20
        for first, second in ((0xE2, 0x80), (0xC2, None)):     # general punctuation and Latin signs are no letters
            mark = np.flatnonzero(raw == first)
            mark = mark[mark + 2 < len(raw)] if second else mark
            mark = mark[raw[mark + 1] == second] if second else mark
            for k in range(3 if second else 2):
                out[mark + k] = 32
        letter, sign = _LETTER[out], _SIGN[raw]
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        inner = sign & before & after            # one sign between two letters, or a digit beside one
        inner |= sign & (raw >= 48) & (raw <= 57) & (before | after)
        out = np.where(inner, _MEANT[raw], out)
    return pa.Array.from_buffers(pa.large_string(), len(arr), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])


def letters_of(w: tx.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words ``at``, and their n + 1 offsets."""
    size = w.end[at] - w.start[at]
    stop = np.cumsum(size)
    data = w.data[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(w.start[at] - (stop - size), size)]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    count = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, count[np.concatenate([[0], stop])]


class Lexicon:
    """A trie of terms and stems, with what its automaton product needs at every node."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms = [(t, False) for t in terms] + [(t, True) for t in stems]
        self.long = np.array([len(t) >= EDIT_FROM for t, _ in self.terms], bool)
        self.is_stem = np.array([stem for _, stem in self.terms], bool)
        self.group = np.array([2 if stem else 0 if t in INSULTS else 1 for t, stem in self.terms], np.int64)
        self.alphabet = np.array(sorted({ord(c) for t, _ in self.terms for c in t}), np.int64)
        code = {int(c): i + 1 for i, c in enumerate(self.alphabet)}
        nodes, self.term_at, self.stem_at, self.stem_above = [{}], [-1], [-1], [-1]
        for k, (t, stem) in enumerate(self.terms):
            at = 0
            for c in t:
                child = nodes[at].get(code[ord(c)])
                if child is None:
                    child = nodes[at][code[ord(c)]] = len(nodes)
                    nodes.append({})
                    self.term_at.append(-1)
                    self.stem_at.append(-1)
                at = child
            (self.stem_at if stem else self.term_at)[at] = k
        n = len(nodes)
        self.next = np.zeros((n, len(code) + 1), np.int32)       # 0: no child (the root is nobody's child)
        # by node: letters still to come, at least and at most, in terms that allow an edit
        self.least, self.most = np.full(n, 99, np.int32), np.full(n, -1, np.int32)
        for i in range(n - 1, -1, -1):                            # children have higher numbers
            for c, j in nodes[i].items():
                self.next[i, c] = j
                if self.most[j] >= 0:
                    self.least[i], self.most[i] = min(self.least[i], self.least[j] + 1), max(self.most[i], self.most[j] + 1)
            k = self.term_at[i]
            if k >= 0 and len(self.terms[k][0]) >= EDIT_FROM:
                self.least[i], self.most[i] = 0, max(self.most[i], 0)
        self.term_at, self.stem_at = np.array(self.term_at), np.array(self.stem_at)
        parent, child = np.nonzero(self.next)
        self.kids = self.next[parent, child].astype(np.int64)     # children of all nodes, by node
        self.first_kid = np.searchsorted(parent, np.arange(n + 1))

    def match(self, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, term, edits) of all matches; a word that is a term itself is no misspelling of others."""
        at = np.searchsorted(self.alphabet, points)
        at = np.minimum(at, max(len(self.alphabet) - 1, 0))
        code = np.where(self.alphabet[at] == points, at + 1, 0) if len(self.alphabet) else np.zeros(len(points), np.int64)
        code = np.append(code, [0, 0])
        size = np.diff(off)
        out, edited = [], []

        def branch(word, node, place):
            """Keep states with one edit from which a term of fitting length can be reached."""
            left = size[word] - place
            fit = (left >= self.least[node]) & (left <= self.most[node])
            edited.append((word[fit], node[fit], place[fit]))

        word, node, place = np.arange(len(size)), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        while len(word):
            stem = self.stem_at[node]
            out.append((word[stem >= 0], stem[stem >= 0], 0))
            left = size[word] - place
            term = self.term_at[node]
            whole = (left == 0) & (term >= 0)
            out.append((word[whole], term[whole], 0))
            # one edit here: only where a term of that length is below
            near = (self.most[node] >= 0) & (left + 1 >= self.least[node]) & (left - 1 <= self.most[node])
            w, v, p, m = word[near], node[near], place[near], left[near]
            many = self.first_kid[v + 1] - self.first_kid[v]
            kid = self.kids[np.arange(many.sum()) + np.repeat(self.first_kid[v] - (np.cumsum(many) - many), many)]
            kw, kp, km = np.repeat(w, many), np.repeat(p, many), np.repeat(m, many)
            branch(kw[km > 0], kid[km > 0], kp[km > 0] + 1)             # another letter
            branch(kw, kid, kp)                                        # a letter left out of the word
            branch(w[m > 0], v[m > 0], p[m > 0] + 1)                   # a letter too many
            two = m > 1
            a, b = code[off[w[two]] + p[two]], code[off[w[two]] + p[two] + 1]
            swapped = self.next[self.next[v[two], b], a]
            swapped = np.where((self.next[v[two], b] > 0) & (a > 0) & (a != b), swapped, 0)
            branch(w[two][swapped > 0], swapped[swapped > 0].astype(np.int64), p[two][swapped > 0] + 2)
            more = left > 0
            word, node, place = word[more], node[more], place[more]
            c = code[off[word] + place]
            node = np.where(c > 0, self.next[node, c], 0).astype(np.int64)
            word, node, place = word[node > 0], node[node > 0], place[node > 0] + 1
        word, node, place = (np.concatenate([x[i] for x in edited]) if edited else np.zeros(0, np.int64) for i in range(3))
        while len(word):
            left = size[word] - place
            term = self.term_at[node]
            whole = (left == 0) & (term >= 0)
            w, k = word[whole], term[whole]
            out.append((w[self.long[k]], k[self.long[k]], 1))
            word, node, place = word[left > 0], node[left > 0], place[left > 0]
            c = code[off[word] + place]
            node = np.where(c > 0, self.next[node, c], 0).astype(np.int64)
            ok = node > 0
            word, node, place = word[ok], node[ok], place[ok] + 1
            left = size[word] - place
            fit = (left >= self.least[node]) & (left <= self.most[node])
            word, node, place = word[fit], node[fit], place[fit]
        w, k = (np.concatenate([np.asarray(x[i], np.int64) for x in out]) if out else np.zeros(0, np.int64) for i in range(2))
        e = np.concatenate([np.full(len(x[0]), x[2], np.int64) for x in out]) if out else np.zeros(0, np.int64)
        order = np.lexsort((e, k, w))
        w, k, e = w[order], k[order], e[order]
        head = np.ones(len(w), bool)
        head[1:] = (w[1:] != w[:-1]) | (k[1:] != k[:-1])
        w, k, e = w[head], k[head], e[head]
        own = np.zeros(len(size), bool)
        own[w[(e == 0) & ~self.is_stem[k]]] = True
        keep = (e == 0) | ~own[w]
        return w[keep], k[keep], e[keep]


def _marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of straight quotation marks, of opening ones and of closing ones."""
    straight = np.flatnonzero(raw == 34)
    if len(raw) < 3:
        none = np.zeros(0, np.int64)
        return straight, none, none
    three = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x80)
    opens = np.flatnonzero(three & ((raw[2:] == 0x9C) | (raw[2:] == 0x9E)))
    closes = np.flatnonzero(three & (raw[2:] == 0x9D))
    two = raw[:-1] == 0xC2
    return straight, np.union1d(opens, np.flatnonzero(two & (raw[1:] == 0xAB))), np.union1d(closes, np.flatnonzero(two & (raw[1:] == 0xBB)))


class Cues:
    """Hashes of the words that report a term or speak to somebody."""

    def __init__(self):
        self.report, self.address = (np.sort(tx.Words(plain_letters(pa.array(x)), _LETTER).hashes()) for x in (REPORT, ADDRESS))


def contexts(w: tx.Words, raw: np.ndarray, hashes: np.ndarray, at: np.ndarray, cues: Cues) -> np.ndarray:
    """Context score of the words ``at``: quoted and reported terms count less, spoken ones more."""
    if not len(at):
        return np.zeros(0)
    lo, hi = np.maximum(at - WINDOW, w.first[w.row[at]]), np.minimum(at + WINDOW + 1, w.first[w.row[at] + 1])

    def near(known):
        total = np.concatenate([[0], np.cumsum(np.isin(hashes, known))])
        return total[hi] > total[lo]

    breaks = np.flatnonzero(raw == 10)
    row_lo, row_hi = w.offsets[w.row[at]], w.offsets[w.row[at] + 1]
    nl = np.searchsorted(breaks, w.start[at])
    line_lo = np.maximum(row_lo, np.where(nl > 0, np.append(breaks, 0)[np.maximum(nl, 1) - 1] + 1, 0))
    line_hi = np.minimum(row_hi, np.append(breaks, len(raw))[nl])
    line_lo, line_hi = np.maximum(line_lo, w.start[lo] - 4), np.minimum(line_hi, w.end[hi - 1] + 4)  # within the window
    count = lambda marks, a, b: np.searchsorted(marks, b) - np.searchsorted(marks, a)
    straight, opens, closes = _marks(raw)
    s, e = w.start[at], w.end[at]
    line_start = np.maximum(row_lo, np.where(nl > 0, np.append(breaks, 0)[np.maximum(nl, 1) - 1] + 1, 0))
    quoted = (count(straight, line_start, s) % 2 == 1) & (count(straight, line_lo, s) > 0) & (count(straight, e, line_hi) > 0)
    quoted |= (count(opens, line_lo, s) > count(closes, line_lo, s)) & (count(closes, e, line_hi) > 0)
    spoken = near(cues.address)
    score = np.where(quoted, QUOTED, 1.0) * np.where(near(cues.report) & ~spoken, REPORTED, 1.0)
    return score * np.where(spoken, SPOKEN, 1.0)


def occurrences(texts: pa.Array, lexicon: Lexicon, cues: Cues):
    """(row, term, edits, context score, first byte, one past the last) of every match in the texts."""
    flat = plain_letters(texts)
    w = tx.Words(flat, _LETTER)
    hashes = w.hashes()
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    k_word, k_term, k_edit = lexicon.match(*letters_of(w, first))
    hit = np.zeros(len(first), bool)
    hit[k_word] = True
    at = np.flatnonzero(hit[which]) if len(which) else np.zeros(0, np.int64)
    lo, hi = np.searchsorted(k_word, which[at]), np.searchsorted(k_word, which[at], side="right")
    many = hi - lo
    m = np.arange(many.sum()) + np.repeat(lo - (np.cumsum(many) - many), many)
    score = contexts(w, tx.text_bytes(texts)[0], hashes, at, cues)
    at_ = np.repeat(at, many)
    return w.row[at_], k_term[m], k_edit[m], np.repeat(score, many), w.start[at_], w.end[at_]


GROUPS = 4                 # listed insults, other terms, stems, misspellings


def term_scores(row, term, edits, score, lexicon: "Lexicon"):
    """Features of each document, sparse: logarithms of one plus summed context scores.

    A column a term, one for its misspellings by themselves, and one for each of ``GROUPS``.
    """
    n = len(lexicon.terms)
    share = score * np.where(edits > 0, MISSPELLED, 1.0)
    wide, wrong = 2 * n + GROUPS, edits > 0
    group = 2 * n + np.where(wrong, 3, lexicon.group[term])
    key = np.concatenate([row * wide + term, (row * wide + term + n)[wrong], row * wide + group])
    found, inverse = np.unique(key, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([share, share[wrong], share]), len(found))
    return found // wide, found % wide, np.log1p(total)


class ToxicityModel:
    """A lexicon and the weights of its terms."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.cues = lexicon, Cues()
        n = len(lexicon.terms)
        known = set(INSULTS)
        self.w = np.concatenate([[PRIOR * (t in known and not stem) for t, stem in lexicon.terms], np.zeros(n + GROUPS)])
        self.bias = -0.2

    def fit(self, doc: np.ndarray, col: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "ToxicityModel":
        """Logistic regression on sparse rows; weights are drawn to those of the known insults."""
        if not len(y):
            return self
        if (y == y[0]).all():
            self.w, self.bias = np.zeros_like(self.w), 10.0 if y[0] else -10.0
            return self
        prior, w, b, n = self.w, self.w.copy(), float(np.log(weight[y == 1].sum() / weight[y == 0].sum())), len(y)
        pull = np.where(np.arange(len(w)) < len(w) - GROUPS, L2, L2 / 10)      # groups are few: they may weigh more
        m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        total = weight.sum()
        for step in range(1, STEPS + 1):
            z = b + np.bincount(doc, w[col] * x, n)
            r = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / total
            g = np.append(np.bincount(col, r[doc] * x, len(w)) + pull * (w - prior), r.sum())
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            move = RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        self.w, self.bias = w, b
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        row, term, edits, score, _, _ = occurrences(texts, self.lexicon, self.cues)
        doc, col, x = term_scores(row, term, edits, score, self.lexicon)
        z = self.bias + np.bincount(doc, self.w[col] * x, len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _candidates(batches):
    """(term, stem, documents toxic, documents clean): words and word beginnings of labelled texts, summed by slice."""
    for batch in batches:
        for part in tx.slices(batch, "text"):
            w = tx.Words(plain_letters(tx.column(part, "text")), _LETTER)
            toxic = tx.column(part, "toxic").to_numpy(zero_copy_only=False) == 1
            _, at = np.unique(np.stack([w.row.astype(np.uint64), w.hashes()]), axis=1, return_index=True)
            row = w.row[at]
            points, off = letters_of(w, at)
            lead = np.flatnonzero((w.data & 0xC0) != 0x80)
            begin = np.searchsorted(lead, w.start[at])
            size = np.diff(off)
            starts, ends, rows, stem = [w.start[at]], [w.end[at]], [row], [np.zeros(len(at), bool)]
            for k in range(STEM[0], STEM[1] + 1):
                some = size > k
                starts.append(w.start[at[some]])
                ends.append(lead[begin[some] + k])
                rows.append(row[some])
                stem.append(np.ones(int(some.sum()), bool))
            s, e, r, is_stem = map(np.concatenate, (starts, ends, rows, stem))
            long = np.concatenate([size, *(size[size > k] for k in range(STEM[0], STEM[1] + 1))]) >= 3
            s, e, r, is_stem = s[long], e[long], r[long], is_stem[long]
            h = w.hash_ranges(s, e) + is_stem.astype(np.uint64)
            key, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            pair, where = np.unique(inverse * part.num_rows + r, return_index=True)   # a document counts once
            bad = np.bincount(inverse[where], toxic[r[where]], len(key)).astype(np.int64)
            good = np.bincount(inverse[where], ~toxic[r[where]], len(key)).astype(np.int64)
            keep = bad > 0
            names = [w.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(s[first[keep]].tolist(), e[first[keep]].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(is_stem[first[keep]]), pa.array(bad[keep]), pa.array(good[keep])],
                                             names=["term", "stem", "bad", "good"])


def _rows(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                row, term, edits, score, _, _ = occurrences(tx.column(part, "text"), m.lexicon, m.cues)
                doc, col, x = term_scores(row, term, edits, score, m.lexicon)
                many = np.bincount(doc, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [tx.column(part, "doc_id"), tx.column(part, "toxic"), tx.list_array(col, many, pa.int32()), tx.list_array(x, many, pa.float64())],
                    names=["doc_id", "toxic", "col", "x"])
    return run


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS, seed: int = 13) -> ToxicityModel:
    """Learn lexicon and weights from ``documents`` (doc_id, text) joined to ``labels`` (doc_id, toxic 0 or 1).

    About ``sample`` documents of each label are drawn by a hash of doc_id; texts that occur several times
    are learned once (toxic, if any of them is).  The ``terms`` terms that tell the labels apart best
    (by the likelihood ratio of their document counts) join the known insults.
    """
    rows = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return ToxicityModel(Lexicon(INSULTS, []))
    keep = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(sample / n)) for k, n in sorted(counts.items())])
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < keep * (1 << 30))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = materialize(texts.join(F.broadcast(drawn), "doc_id").filter("text IS NOT NULL")      # about 2 * sample rows
                      .groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")))
    size = {r["toxic"]: r["n"] for r in got.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = []
    if size.get(0) and size.get(1):
        n1, n0 = float(size[1]), float(size[0])
        a, b = F.col("bad").cast("double"), F.col("good").cast("double")
        both, ratio = (a + b) / (n1 + n0), ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
        part = lambda k, n: k * F.log((k + 1e-9) / (n * both)) + (n - k) * F.log((n - k + 1e-9) / (n * (1 - both) + 1e-9))
        chosen = got.select("text", "toxic").mapInArrow(_candidates, "term string, stem boolean, bad long, good long") \
            .groupBy("term", "stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")) \
            .filter((F.col("bad") >= MIN_DOCS) & (ratio >= MIN_RATIO)) \
            .select("term", "stem", (part(a, n1) + part(b, n0)).alias("gain")).orderBy(F.desc("gain"), "term", "stem").limit(terms).collect()
    lexicon = Lexicon(sorted({r["term"] for r in chosen if not r["stem"]} | set(INSULTS)), sorted({r["term"] for r in chosen if r["stem"]}))
    model = ToxicityModel(lexicon)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    data = got.mapInArrow(_rows(shared), "doc_id long, toxic int, col array<int>, x array<double>").toPandas().sort_values("doc_id")
    release(got)
    many = data["col"].map(len).to_numpy() if len(data) else np.zeros(0, np.int64)
    flat = lambda c, t: np.concatenate([np.zeros(0, t), *data[c].tolist()]).astype(t)
    y = data["toxic"].to_numpy().astype(float)
    # labels were drawn evenly: weigh them back to their shares
    weight = np.where(y == 1, counts.get(1, 0) / max((y == 1).sum(), 1), counts.get(0, 0) / max((y == 0).sum(), 1))
    return model.fit(np.repeat(np.arange(len(data)), many), flat("col", np.int64), flat("x", float), y, weight)


def _scorer(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                s = m.score(tx.column(part, "text"))
                yield pa.RecordBatch.from_arrays([tx.column(part, "row"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                                                 names=["row", "score", "predicted"])
    return run


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows (row, score, predicted) for every row of ``documents``; only ``text`` is looked at.

    Defined cases: a null text scores like an empty one (the weight of no term at all).  With labels of one kind
    only every row gets that label; without any label the known insults alone count.  Repeated
    rows score alike; an empty table gives no rows; further columns may have any name.
    """
    return _mapped(documents, _scorer(documents.sparkSession.sparkContext.broadcast(model)),
                   [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _spotter(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in tx.slices(batch, "text"):
                texts = tx.column(part, "text")
                off = tx.text_bytes(texts)[1]
                row, term, edits, ctx, start, end = occurrences(texts, m.lexicon, m.cues)
                order = np.lexsort((term, start))
                row, term, edits, ctx, start, end = (x[order] for x in (row, term, edits, ctx, start, end))
                many = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays(
                    [pa.array([m.lexicon.terms[k][0] + "*" * m.lexicon.terms[k][1] for k in term.tolist()], pa.string()), pa.array(start - off[row], pa.int64()),
                     pa.array(end - off[row], pa.int64()), pa.array(edits, pa.int32()), pa.array(ctx, pa.float64())],
                    names=["term", "start", "end", "edits", "context"])
                yield pa.RecordBatch.from_arrays([tx.column(part, "row"), pa.ListArray.from_arrays(pa.array(many), found)], names=["row", "matches"])
    return run


def matches(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows (row, matches): every occurrence of a term, its bytes in the text, its edits and its context score."""
    found = T.StructType([T.StructField("term", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                          T.StructField("edits", T.IntegerType()), T.StructField("context", T.DoubleType())])
    return _mapped(documents, _spotter(documents.sparkSession.sparkContext.broadcast(model)), [T.StructField("matches", T.ArrayType(found))])


def _mapped(documents: DataFrame, work, fields: list[T.StructField]) -> DataFrame:
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, T.StructType([T.StructField("row", rows.schema["row"].dataType), *fields]))
