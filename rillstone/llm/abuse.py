"""Scores of abusive, hateful and sexually explicit language.

Method: bags of subwords. A word's vector is the sum of hashed character n-gram vectors (and its own), a sentence's the
mean over its words and neighbouring word pairs; a linear softmax over none, abuse, hate, sexual reads it. Vectors and
softmax are trained jointly in numpy. A misspelling not seen before shares most n-grams with the word it stands for.

Labels are on documents, the language in single sentences: sentences of positive documents start as candidates unless
documents labelled none have them as well (but for slips). Two nets, each trained on one half of the labelled documents,
judge the sentences of the other half: the best sentence of a positive document and others that clearly score stay, the
rest becomes none. The documents' scores by the net that hasn't seen them give each kind its cut, where precision and
recall are best together; a last net is trained on all. Training takes a bounded sample of labelled documents
(MAX_LABELLED; see labelled_texts), with the same shares of kinds and none at any size. Every document is scored in
whole, sentence by sentence; a document's score for a kind is that of its highest sentence.

Defined results: null and empty texts score below the cut for every kind (0). Repeated documents score alike. Where no
labelled document is positive or none is clean there is no classifier: a warning, null scores, no rows of kinds.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import Workspace

KINDS = ("none", "abuse", "hate", "sexual")
#: Labelled documents that the classifier is fitted on, at most: half of them none, a sixth of each kind.
MAX_LABELLED = 5000
DIM, BUCKETS, MIN_N, MAX_N = 24, 1 << 17, 3, 5
EPOCHS, BATCH, RATE = (4, 4, 5), 1024, 0.3
#: Updates that a round of training has at least, on few sentences with more epochs. A sentence may be what makes a
#: document positive if clean documents have it at most SLIP times as often as positive ones.
MIN_UPDATES, SLIP = 150, 0.2
#: Scores from which the best sentence of a positive document, and any sentence, is taken for the language.
GOOD, CLEAR = 0.3, 0.7
#: How much the odds of a sentence may rise by its being in several documents of a kind.
LIFT = 9.0
THRESHOLD = 0.5

#: Look-alike signs and the letters they stand for inside a word.
_LOOKALIKE = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "а": "a", "е": "e", "о": "o", "с": "c", "р": "p", "х": "x", "у": "y", "і": "i", "ѕ": "s"}
_ZERO_WIDTH = "\u00ad\u200b-\u200f\u2060\ufeff"
#: A word (also spelled out with signs or spaces between its letters), or a sign that ends a sentence.
_TOKEN = re.compile(
    rf"[^\W_](?:[-._*~ ][^\W_]){{2,}}(?![^\W_])|[^\W_](?:[^\W_]|[@$*'’!{_ZERO_WIDTH}]+(?=[^\W_]))*|[.!?;:()\[\]\"\n«»“”„\x00]|--"
)
_HIDDEN = re.compile(f"[{_ZERO_WIDTH}]")
_SIGNS = str.maketrans(_LOOKALIKE)
_RUN = re.compile(r"([^\W\d])\1{2,}")
_END, _DOC = 0, 1


def plain(word: str) -> str:
    """One spelling of a word: lower case, no hidden signs, spelled-out letters joined, look-alikes as letters, runs of
    a letter shortened; # for a number."""
    w = _HIDDEN.sub("", unicodedata.normalize("NFKC", word)).lower()
    w = re.sub(r"[-._*~ ]", "", w) if re.fullmatch(r"\w(?:[-._*~ ]\w)+", w) else w
    if w.isdigit():
        return "#"
    return _RUN.sub(r"\1", w.translate(_SIGNS))


def _grams(word: str) -> list[int]:
    if " " in word:
        return [zlib.crc32(word.encode()) % BUCKETS]
    w = f"<{word}>"
    found = {w} | {w[i : i + n] for n in range(MIN_N, MAX_N + 1) for i in range(len(w) - n + 1)}
    return sorted(zlib.crc32(g.encode()) % BUCKETS for g in found)


class Words:
    """Numbers for raw tokens; 0 ends a sentence, 1 a document. Spellings that read alike share a number."""

    def __init__(self):
        self.raw = {c: _END for c in ".!?;:()[]\"\n«»“”„"} | {"--": _END, "\x00": _DOC}
        self.number: dict[str, int] = {}
        self.words = ["", ""]

    def ids(self, texts: list[str | None]) -> np.ndarray:
        if len(self.raw) > 3_000_000:  # the cache starts anew; numbers stay
            self.raw = {t: n for t, n in self.raw.items() if n <= _DOC}
        joined = "\x00".join([(t or "").replace("\x00", " ") for t in texts]) + "\x00"
        tokens = _TOKEN.findall(joined)
        raw = self.raw
        for t in sorted(set(tokens).difference(raw)):
            w = plain(t)
            if w not in self.number:
                self.number[w] = len(self.words)
                self.words.append(w)
            raw[t] = self.number[w]
        return np.fromiter(map(raw.__getitem__, tokens), np.int64, len(tokens))


def bags(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence number of each word, whether a word has a next one in its sentence, document of each sentence)."""
    word = ids > _DOC
    sentence = np.cumsum(~word)
    doc_of = np.concatenate([[0], np.cumsum(ids[~word] == _DOC)])
    paired = word[:-1] & word[1:]
    return sentence, paired, doc_of


class Model:
    """Embeddings and softmax. Each word and pair is a fixed row of class scores, made when first seen."""

    def __init__(self, embed: np.ndarray, weight: np.ndarray, bias: np.ndarray, cuts: np.ndarray):
        self.table, self.bias, self.cuts = (embed @ weight).astype(np.float32), bias, cuts
        self.words = Words()
        self.scores_of = np.zeros((2, len(KINDS)), np.float32)
        self.pairs: dict[int, int] = {}
        self.pair_scores = np.zeros((1024, len(KINDS)), np.float32)

    def __getstate__(self):
        return self.table, self.bias, self.cuts

    def __setstate__(self, state):
        Model.__init__(self, state[0], np.eye(len(KINDS), dtype=np.float32), *state[1:])

    def _word_scores(self) -> np.ndarray:
        n = len(self.scores_of)
        if n < len(self.words.words):
            new = np.array([self.table[_grams(w)].mean(axis=0) for w in self.words.words[n:]])
            self.scores_of = np.concatenate([self.scores_of, new])
        return self.scores_of

    def _pair_rows(self, keys: np.ndarray) -> np.ndarray:
        """Scores of pairs, given by key; the cache starts anew when it is full."""
        uniq, inverse = np.unique(keys, return_inverse=True)
        if len(self.pairs) > 1_000_000:
            self.pairs = {}
        rows = np.empty(len(uniq), np.int64)
        words = self.words.words
        for i, k in enumerate(uniq.tolist()):
            r = self.pairs.get(k)
            if r is None:
                r = self.pairs[k] = len(self.pairs)
                if r >= len(self.pair_scores):
                    self.pair_scores = np.concatenate([self.pair_scores, np.zeros_like(self.pair_scores)])
                self.pair_scores[r] = self.table[_grams(f"{words[k >> 32]} {words[k & 0xFFFFFFFF]}")[0]]
            rows[i] = r
        return self.pair_scores[rows][inverse]

    def sentence_scores(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(class shares of each sentence, its document)."""
        ids = self.words.ids(texts)
        sentence, paired, doc_of = bags(ids)
        word = ids > _DOC
        n = len(doc_of)
        count = np.bincount(sentence[word], minlength=n) + np.bincount(sentence[:-1][paired], minlength=n)
        at, pat = sentence[word], sentence[:-1][paired]
        singles = self._word_scores()[ids[word]]
        doubles = self._pair_rows((ids[:-1][paired] << 32) | ids[1:][paired])
        z = np.stack([np.bincount(at, singles[:, c], n) + np.bincount(pat, doubles[:, c], n) for c in range(len(KINDS))], axis=1)
        has = count > 0
        p = softmax(z[has] / count[has, None] + self.bias)
        return p, doc_of[has]

    def scores(self, texts: list) -> np.ndarray:
        """A row of abuse, hate, sexual for each text: each the highest of its sentences, moved so that THRESHOLD is where
        the kind's cut was."""
        p, doc = self.sentence_scores(texts)
        out = np.zeros((len(texts), len(KINDS) - 1))
        np.maximum.at(out, doc, p[:, 1:])
        a, b = out * (1 - self.cuts), (1 - out) * self.cuts
        return a / (a + b)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... n[0] of them, then from start[1] on, and so forth."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


class _Bags:
    """Distinct sentences as units (words and pairs), units as n-grams, in flat arrays."""

    def __init__(self, texts: list):
        words = Words()
        ids = words.ids(texts)
        sentence, _, doc_of = bags(ids)
        starts = np.flatnonzero(np.diff(sentence, prepend=-1))
        index: dict = {}
        unit_of: dict = {}
        rows, docs, flat, times, m, n = [], [], [], [], [], []
        for a, b in zip(starts, [*starts[1:], len(ids)]):
            s = tuple(x for x in ids[a:b].tolist() if x > _DOC)
            if not s:
                continue
            k = index.get(s)
            if k is None:
                k = index[s] = len(index)
                us: dict = {}
                for u in (*s, *zip(s, s[1:])):
                    u = unit_of.setdefault(u, len(unit_of))
                    us[u] = us.get(u, 0) + 1
                flat += us
                times += us.values()
                m.append(len(us))
                n.append(2 * len(s) - 1)
            rows.append(k)
            docs.append(doc_of[sentence[a]])
        self.rows, self.docs = np.array(rows, np.int64), np.array(docs, np.int64)
        self.m, self.flat = np.array(m, np.int64), np.array(flat, np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.m)[:-1]])
        self.part = np.array(times, np.float32) / np.repeat(np.array(n, np.float32), self.m)
        name = words.words
        grams = [_grams(f"{name[u[0]]} {name[u[1]]}" if isinstance(u, tuple) else name[u]) for u in unit_of]
        self.gn = np.array([len(g) for g in grams], np.int64)
        self.gflat = np.array([x for g in grams for x in g], np.int64)
        self.gstart = np.concatenate([[0], np.cumsum(self.gn)[:-1]])

    def __len__(self):
        return len(self.m)

    def batch(self, at: np.ndarray):
        """(share of each unit in each sentence, as a matrix over the units that occur; grams of these units)."""
        m = self.m[at]
        span = _spans(self.start[at], m)
        flat = self.flat[span]
        there = np.zeros(len(self.gn), bool)
        there[flat] = True
        units = np.flatnonzero(there)
        place = np.empty(len(self.gn), np.int64)
        place[units] = np.arange(len(units))
        shares = np.zeros((len(at), len(units)), np.float32)
        shares[np.repeat(np.arange(len(at)), m), place[flat]] = self.part[span]
        gn = self.gn[units]
        return shares, gn, self.gflat[_spans(self.gstart[units], gn)]


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0)


def _by(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    order = np.argsort(key)
    k = key[order]
    first = np.flatnonzero(np.diff(k, prepend=k[0] - 1))
    return k[first], np.add.reduceat(values[order], first, axis=0)


class _Net:
    """Embeddings and softmax under training (Adagrad)."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.weight, self.bias = rng.normal(0, 0.3, (DIM, len(KINDS))).astype(np.float32), np.zeros(len(KINDS), np.float32)
        self.seen = [np.full((BUCKETS, 1), 1e-6, np.float32), np.full(self.weight.shape, 1e-3, np.float32), np.full(self.bias.shape, 1e-3, np.float32)]

    def forward(self, b):
        shares, gn, g = b
        x = shares @ (_sums(self.embed[g], gn) / gn[:, None].astype(np.float32))
        return x, softmax(x @ self.weight + self.bias)

    def step(self, b, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        shares, gn, g = b
        x, p = self.forward(b)
        d = ((p - target) * (weight / max(weight.sum(), 1e-6))[:, None]).astype(np.float32)
        dunit = shares.T @ (d @ self.weight.T)
        ids, dg = _by(g, np.repeat(dunit / gn[:, None].astype(np.float32), gn, axis=0))
        self.seen[0][ids] += (dg**2).mean(axis=1, keepdims=True)
        self.embed[ids] -= rate * dg / np.sqrt(self.seen[0][ids])
        for k, (param, grad) in enumerate(((self.weight, x.T @ d), (self.bias, d.sum(axis=0))), 1):
            self.seen[k] += grad**2
            param -= rate * grad / np.sqrt(self.seen[k])

    def train(self, data: _Bags, target: np.ndarray, weight: np.ndarray, epochs: int) -> None:
        use = np.flatnonzero(weight > 0)
        epochs = max(epochs, -(-MIN_UPDATES * BATCH // max(len(use), 1))) if len(use) >= BATCH else max(epochs, MIN_UPDATES)
        for e in range(epochs):
            order = self.rng.permutation(use)
            for lo in range(0, len(order), BATCH):
                at = order[lo : lo + BATCH]
                self.step(data.batch(at), target[at], weight[at], RATE * (1 - e / (epochs + 1)))

    def predict(self, data: _Bags) -> np.ndarray:
        return np.concatenate([self.forward(data.batch(np.arange(lo, min(lo + BATCH, len(data)))))[1] for lo in range(0, len(data), BATCH)])


def _weak(data: _Bags, kind_of: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(target, weight) of each sentence from the labels of the documents marked in use alone: a sentence that clean
    documents have is none, but for slips; the candidates of a positive document share its label."""
    n = len(data)
    on = use[data.docs]
    rows, cols = data.rows[on], data.docs[on]
    seen = np.array([np.bincount(rows, kind_of[cols, c], n) for c in range(len(KINDS))]).T
    candidate = (seen[:, 0] <= SLIP * seen[:, 1:].sum(axis=1)) & (seen.sum(axis=1) > 0)
    fresh = np.maximum(np.bincount(cols, candidate[rows], len(kind_of)), 1)  # candidates in each document
    share = np.array([np.bincount(rows, kind_of[cols, c] / fresh[cols], n) for c in range(len(KINDS))]).T
    target, weight = np.zeros((n, len(KINDS))), np.minimum(seen[:, 0], 10.0)
    target[:, 0] = 1
    total = np.maximum(share[candidate].sum(axis=1), 1e-9)
    target[candidate] = share[candidate] / total[:, None]
    weight[candidate] = np.minimum(total, 3)
    return target, weight


def _relabel(data: _Bags, kind_of: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(target, weight) of each sentence, by the scores of its occurrences, which come from a net that has not seen the
    document. Of a positive document the best sentence for its kind is that kind, if it is good enough, and others that
    clearly are; a document without one is a reviewer's slip. The rest is none, but for what clearly is a kind in a
    document labelled none."""
    n, rows, docs = len(data), data.rows, data.docs
    positive = kind_of[docs, 1:].any(axis=1)
    has = np.bincount(rows[positive], minlength=n)
    of_clean = np.bincount(rows[~positive], minlength=n)
    wins = np.zeros((n, len(KINDS)))
    for c in range(1, len(KINDS)):
        mine = np.flatnonzero(kind_of[docs, c] > 0)
        # a sentence that other documents of the kind have too, and clean ones don't, counts for more
        often = np.bincount(rows[mine], minlength=n)
        lift = np.minimum((2 * often[rows[mine]] - 1) / (2 * of_clean[rows[mine]] + 1), LIFT)
        odds = score[mine, c] / np.maximum(1 - score[mine, c], 1e-9) * lift
        sure = odds / (1 + odds)
        order = np.lexsort((rows[mine], -sure, docs[mine]))
        best = order[np.flatnonzero(np.diff(docs[mine[order]], prepend=-1))]
        best = mine[best[sure[best] > GOOD]]
        wins[:, c] += np.bincount(rows[best], minlength=n)
    clear = score[:, 1:].max(axis=1) > CLEAR
    clean = np.bincount(rows[~positive & ~clear], minlength=n)
    also = np.zeros((n, len(KINDS)))
    at = positive & clear
    np.add.at(also, (rows[at], score[at, 1:].argmax(axis=1) + 1), 1)
    won = wins.sum(axis=1)
    # a phrase that many positive documents have but that seldom is the best of one comes with the language, it is not it
    frame = (has >= 5) & (won < 0.3 * has)
    votes = np.where((won > 0)[:, None], wins, also)
    named = (votes.sum(axis=1) > 0) & ~frame & (clean <= SLIP * has)
    target = np.zeros((n, len(KINDS)))
    target[~named, 0] = 1
    target[named] = votes[named] / votes[named].sum(axis=1, keepdims=True)
    weight = np.where(named, 2.0, np.minimum(clean + 0.5 * np.minimum(has, 2), 10.0))
    return target, weight


def _balanced(target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights with which the kinds weigh more nearly alike."""
    mass = (target * weight[:, None]).sum(axis=0)
    balance = np.where(mass > 0, np.sqrt(mass.max() / np.maximum(mass, 1e-9)), 0)
    return weight * (target @ np.minimum(balance, 10))


def _cut(score: np.ndarray, truth: np.ndarray) -> float:
    """The score above which a kind holds: that of the best F1 over documents the scores' net has not seen, in the
    middle of the scores that share it."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(truth[order])
    if not len(s) or not hit[-1]:
        return 0.5
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + hit[-1])
    f1[:-1][s[:-1] == s[1:]] = 0  # equal scores stand or fall together
    k = int(f1.argmax())
    low = s[k + 1] if k + 1 < len(s) else 0.0
    return float(np.clip((s[k] + low) / 2, 0.05, 0.98))


def fit(labelled: list[tuple[str, set]]) -> Model | None:
    """labelled: (text, kinds by its reviewers; empty for none). None where no document is positive or none is clean.

    Two folds: a net trained on one judges the sentences and documents of the other, so that what a net has learnt by
    heart, a reviewer's slip too, doesn't confirm itself. The last net is trained on both.
    """
    if not any(k for _, k in labelled) or all(k for _, k in labelled):
        warnings.warn(f"no classifier: of {len(labelled)} labelled documents {sum(not k for _, k in labelled)} are labelled none; scores will be null", stacklevel=2)
        return None
    data = _Bags([t for t, _ in labelled])
    if not len(data):
        return None
    rows, docs = data.rows, data.docs
    kind_of = np.zeros((len(labelled), len(KINDS)))
    for d, (_, k) in enumerate(labelled):
        for x in k or {"none"}:
            kind_of[d, KINDS.index(x)] = 1
    # both folds have their part of each kind
    fold = np.zeros(len(labelled), int)
    for c in range(len(KINDS)):
        mine = np.flatnonzero(kind_of[:, c])
        fold[mine] = np.arange(len(mine)) % 2
    nets = [_Net(7 + f) for f in (0, 1)]
    labels = [_weak(data, kind_of, fold == f) for f in (0, 1)]
    inside = [np.bincount(rows[fold[docs] == f], minlength=len(data)) > 0 for f in (0, 1)]
    for epochs in EPOCHS[:-1]:
        judged = np.zeros((len(rows), len(KINDS)))
        for f in (0, 1):
            target, weight = labels[f]
            nets[f].train(data, target, _balanced(target, weight * inside[f]), epochs)
            other = fold[docs] != f
            judged[other] = nets[f].predict(data)[rows[other]]
        labels = [_relabel(data, kind_of, judged)] * 2
    of_doc = np.zeros((len(labelled), len(KINDS)))
    np.maximum.at(of_doc, docs, judged)
    cuts = [_cut(of_doc[:, c], kind_of[:, c]) for c in range(1, len(KINDS))]
    net = _Net()
    net.train(data, labels[0][0], _balanced(*labels[0]), EPOCHS[-1])
    return Model(net.embed, net.weight, net.bias, np.array(cuts))


# ---- on tables ------------------------------------------------------------------------------------------------------


def labelled_texts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", verdict: str = "verdict", most: int = MAX_LABELLED) -> list[tuple[str, set]]:
    """A bounded sample for fit, of documents chosen by hash from the labels: half of it none, a sixth each abuse, hate and
    sexual, at any size of the table; what one leaves unused the others share. A kind holds where more reviewers named
    it than none; documents whose reviewers disagree otherwise are left out, as are unknown verdicts. Chosen documents
    that are missing or have no text are not replaced. The texts are read once."""
    v = F.lower(F.trim(F.col(verdict)))
    votes = labels.select(F.col(key), v.alias("v")).where(F.col("v").isin(*KINDS)).groupBy(key).agg(*[F.count_if(F.col("v") == k).alias(f"n_{k}") for k in KINDS])
    kinds = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > F.col("n_none"), k) for k in KINDS[1:]]))
    voted = votes.select(key, kinds.alias("kinds"), (F.col("n_none") == sum((F.col(f"n_{k}") for k in KINDS[1:]), F.col("n_none"))).alias("clean")).where("clean or size(kinds) > 0")
    usable = Workspace(docs.sparkSession, "labelled").cut(voted.select(key, "kinds", F.xxhash64(key).alias("h")))
    # by turns: three documents of none and one of each kind, again and again; one of several kinds counts where it comes first
    firsts = None
    for k in KINDS:
        mine = usable.where("size(kinds) = 0" if k == "none" else F.array_contains("kinds", k)).orderBy("h", key).limit(most)
        place = F.row_number().over(Window.partitionBy(F.lit(k)).orderBy("h", key))  # of at most `most` rows
        mine = mine.withColumn("turn", F.ceil(place / len(KINDS[1:])) if k == "none" else place.cast("long"))
        firsts = mine if firsts is None else firsts.unionByName(mine)
    turns = firsts.groupBy(key).agg(F.first("kinds").alias("kinds"), F.min("turn").alias("turn"), F.first("h").alias("h"))
    chosen = turns.orderBy("turn", F.size("kinds") == 0, "h", key).limit(most).select(key, "kinds")
    found = docs.select(key, text).join(F.broadcast(chosen), key).where(F.length(text) > 0).orderBy(F.xxhash64(key), key, text)  # at most MAX_LABELLED rows
    return [(r[1], set(r[2])) for r in found.select(key, text, "kinds").collect()]


def score(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text", chunk: int = 256) -> DataFrame:
    """keep, abuse, hate, sexual: scores from 0 to 1 of every document, whole texts; nulls without a model."""
    names = [*keep, *KINDS[1:]]
    if model is None:
        return docs.select(*keep, *[F.lit(None).cast("double").alias(k) for k in KINDS[1:]])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, BUCKETS rows of four numbers

    def run(batches):
        m = shared.value
        for b in batches:
            texts = b[text].to_pylist()
            parts = [m.scores(texts[i : i + chunk]) for i in range(0, len(texts), chunk)]
            s = np.concatenate(parts) if parts else np.zeros((0, 3))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), *(pa.array(s[:, k]) for k in range(3))], names)

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*docs.select(*keep).schema.fields])
    for k in KINDS[1:]:
        schema = schema.add(k, DoubleType())
    return docs.select(*keep, text).mapInArrow(run, schema)


def kinds(scored: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, kind: one row per kind that a document scores for."""
    named = F.array_compact(F.array(*[F.when(F.col(k) > threshold, k) for k in KINDS[1:]]))
    return scored.select(key, F.explode(named).alias("kind")).distinct()


def rates(scored: DataFrame, by: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """by, n_docs, and for each kind the number and share of documents that score for it; nulls where nothing was scored."""
    hits = [F.sum((F.col(k) > threshold).cast("long")).alias(f"n_{k}") for k in KINDS[1:]]
    r = scored.groupBy(by).agg(F.count(F.lit(1)).alias("n_docs"), *hits)
    return r.select("*", *[(F.col(f"n_{k}") / F.col("n_docs")).alias(f"share_{k}") for k in KINDS[1:]])
