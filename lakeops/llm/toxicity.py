"""Toxicity: a support vector machine over a gapped-subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import fresh_name, map_batches, text_of
from lakeops.session import materialize

#: Weight of each letter that a subsequence spans, so gaps cost a little.
DECAY = 0.7
#: Longest string that the kernel sees; longer terms are read in overlapping windows of this length.
SPAN = 16
STEP = 4
#: At most so many labelled rows of each class are learned from, chosen by a hash of their id.
LABELLED = 6000
#: Chance that any harmless term of the sample is taken for toxic, over all terms tested.
LEVEL = 0.01
#: Labelled sentences of each class that the sentence machine is fitted on, and those of them that are landmarks.
SENTENCES = 3000
SENTENCE_LANDMARKS = 40
#: Least kernel of two spellings of one term.
NEAR = 0.5
CLEAN_TERMS = 4000
MINED = 500
ROUNDS = 3
LANDMARKS = 160
REMEMBERED = 400_000
_CODES = 32 ** 3
_LEET = dict(zip(b"013457", b"oieast"))
#: Letters are lower-cased, digits that stand for letters replaced, bytes of longer characters folded to four signs.
_FOLD = bytes(_LEET[c] if c in _LEET else c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 123 + c % 4
              if c >= 128 else 32 for c in range(256))
_DROPPED = bytes(c for c in range(128) if not chr(c).isalnum() and c not in b" \t\n\r\x0b\x0c" or c in b"2689")
_SPELLED = re.compile(rb"(?<![^ ])[a-z](?: +[a-z]){2,}(?![^ ])")
_SENTENCE = re.compile(r"[.!?\n]+")


def terms_of(text: str) -> set[bytes]:
    """Distinct folded words of a text; signs inside a word are dropped and spelled-out words (i d i o t) joined."""
    folded = text.encode().translate(_FOLD, _DROPPED)
    return set(_SPELLED.sub(lambda m: m.group().replace(b" ", b""), folded).split())


@lru_cache(None)
def _places(size: int) -> tuple[np.ndarray, np.ndarray]:
    """All ordered triples of places in a string of ``size``, and the weight of each."""
    triples = np.array(list(combinations(range(size), 3))).reshape(-1, 3)
    return triples, DECAY ** (triples[:, 2] - triples[:, 0] + 1).astype(float)


def _letters(words: list[bytes]) -> np.ndarray:
    return (np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1) - 96).astype(np.int64)


def _subsequences(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    triples, weights = _places(letters.shape[1])
    return (letters[:, triples[:, 0]] << 10) + (letters[:, triples[:, 1]] << 5) + letters[:, triples[:, 2]], weights


def _self_kernel(letters: np.ndarray) -> np.ndarray:
    """The kernel of each string with itself, by the usual recursion over prefixes, all strings at once."""
    n, size = letters.shape
    same = letters[:, :, None] == letters[:, None, :]
    inner = np.ones((n, size + 1, size + 1))
    for _ in range(2):
        outer = np.zeros_like(inner)
        for i in range(1, size + 1):
            run = np.zeros(n)
            for j in range(1, size + 1):
                run = DECAY * run + DECAY ** 2 * same[:, i - 1, j - 1] * inner[:, i - 1, j - 1]
                outer[:, i, j] = DECAY * outer[:, i - 1, j] + run
        inner = outer
    return DECAY ** 2 * (same * inner[:, :-1, :-1]).sum(axis=(1, 2))


def _windows(word: bytes) -> list[bytes]:
    if len(word) <= SPAN:
        return [word] if len(word) >= 3 else []
    return [word[i:i + SPAN] for i in [*range(0, len(word) - SPAN, STEP), len(word) - SPAN]]


def _apply(tables: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Normalised kernel sums of each word (3 to ``SPAN`` letters) with each column of subsequence weights."""
    out = np.zeros((len(words), tables.shape[1]))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for start in range(0, len(rows), 2000):
            part = rows[start:start + 2000]
            letters = _letters([words[i] for i in part])
            codes, weights = _subsequences(letters)
            for column in range(tables.shape[1]):
                out[part, column] = tables[codes, column] @ weights
            out[part] /= np.sqrt(_self_kernel(letters))[:, None]
    return out


def _table(words: list[bytes]) -> np.ndarray:
    """Unit subsequence weights of each word as one column."""
    out = np.zeros((_CODES, len(words)))
    for column, word in enumerate(words):
        letters = _letters([word])
        codes, weights = _subsequences(letters)
        np.add.at(out[:, column], codes[0], weights)
        out[:, column] /= np.sqrt(_self_kernel(letters)[0])
    return out


@dataclass
class Model:
    """Two machines as one weight per subsequence each (the landmarks' expansions, summed), the terms known as toxic,
    and the score's logistic map of a text's largest term margin and largest and mean sentence margin."""

    weights: np.ndarray | None
    bias: float = -1.0
    sentence_weights: np.ndarray | None = None
    sentence_bias: float = -1.0
    terms: frozenset[bytes] = frozenset()
    slopes: tuple[float, ...] = (0.0, 0.0, 0.0)
    offset: float = -20.0

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margins @ np.array(self.slopes) + self.offset, -50, 50)))


class TermScorer:
    """Margins of terms, sentences and texts, with a bounded memory of terms."""

    def __init__(self, model: Model):
        self.model = model
        columns = [w for w in (model.weights, model.sentence_weights) if w is not None]
        self.tables = np.stack(columns, axis=1) if columns else None
        self.known: dict[bytes, tuple[float, float]] = {}

    def _values(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's margin, and its share in the sentence machine (the sum over its windows)."""
        margins, shares = np.full(len(words), self.model.bias), np.zeros(len(words))
        if self.tables is not None and words:
            owner, windows = [], []
            for i, word in enumerate(words):
                for window in _windows(word):
                    owner.append(i)
                    windows.append(window)
            if windows:
                values = _apply(self.tables, windows)
                if self.model.weights is not None:
                    np.maximum.at(margins, owner, values[:, 0] + self.model.bias)
                if self.model.sentence_weights is not None:
                    np.add.at(shares, owner, values[:, -1])
        sure = np.fromiter((w in self.model.terms for w in words), bool, len(words))
        return np.clip(np.where(sure, np.maximum(margins, 1.0), margins), -2, 2), shares

    def margins(self, words: list[bytes]) -> np.ndarray:
        """The largest margin of each word's windows, between -2 and 2 and at least 1 for known terms; words under three
        letters have the bias."""
        return self._values(words)[0]

    def details(self, texts: list[str]) -> np.ndarray:
        """Per text its largest term margin (-2 without terms), and its largest and mean sentence margin."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        whole = [terms_of(t) for t in texts]
        parts = [[terms_of(s) for s in _SENTENCE.split(t)] for t in texts]
        new = list({w for words in [*whole, *(p for some in parts for p in some)] for w in words if w not in self.known})
        margins, shares = self._values(new)
        self.known.update(zip(new, zip(margins.tolist(), shares.tolist())))
        get, bias = self.known.__getitem__, self.model.sentence_bias
        out = np.full((len(texts), 3), -2.0)
        for i, (words, some) in enumerate(zip(whole, parts)):
            out[i, 0] = max((get(w)[0] for w in words), default=-2.0)
            found = [sum([get(w)[1] for w in p]) / len(p) ** 0.5 + bias for p in some if p]
            if found:
                out[i, 1:] = max(found), sum(found) / len(found)
        return np.clip(out, -2, 2)

    def texts(self, texts: list[str]) -> np.ndarray:
        """The largest margin among each text's terms; -2 without terms."""
        return self.details(texts)[:, 0]


def _fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine by Newton steps on the rows inside the margin."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(rows.shape[1], ridge * weight.sum())
    penalty[-1] = 1e-6
    w = np.zeros(rows.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(50):
        part, c = rows[active], weight[active]
        w = np.linalg.solve(part.T @ (part * c[:, None]) + np.diag(penalty), part.T @ (c * y[active]))
        now = y * (rows @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def fit_terms(toxic: list[bytes], clean: list[bytes], landmarks: list[bytes]) -> Model:
    """The machine over Nystroem features of terms; classes weigh the same."""
    basis = _table(landmarks)
    values, vectors = np.linalg.eigh(basis.T @ basis)
    sound = values > 1e-8 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])
    words = toxic + clean
    features = _apply(basis, words) @ root
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    weight = np.where(y > 0, len(clean) / max(1, len(toxic)), 1.0)
    w, bias = _fit_linear(features, y, weight)
    return Model(basis @ (root @ w), bias)


def fit_sentences(toxic: list[str], clean: list[str], terms: list[bytes]) -> tuple[np.ndarray, float]:
    """The machine over Nystroem features of labelled sentences; classes weigh the same.

    A sentence is the sum of its distinct terms' windows in the space of the term kernel, over the root of the number
    of terms. Landmarks are sentences of both classes and the given terms.
    """
    sets = [terms_of(t) for t in toxic + clean]
    kept = [i for i, words in enumerate(sets) if words]
    sets, y = [sorted(sets[i]) for i in kept], np.array([1.0 if i < len(toxic) else -1.0 for i in kept])
    picked = [sets[i] for sign in (1, -1) for i in np.flatnonzero(y == sign)[:SENTENCE_LANDMARKS]]
    basis = np.zeros((_CODES, len(picked) + len(terms)))
    for column, words in enumerate([*picked, *([w] for w in terms)]):
        windows = [x for w in words for x in _windows(w)]
        for start in range(0, len(windows), 64):
            basis[:, column] += _table(windows[start:start + 64]).sum(axis=1)
        basis[:, column] /= len(words) ** 0.5
    values, vectors = np.linalg.eigh(basis.T @ basis)
    sound = values > 1e-8 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])
    known = {w: i for i, w in enumerate(sorted({x for words in sets for w in words for x in _windows(w)}))}
    reduced = _apply(basis, list(known)) @ root
    features = np.array([reduced[[known[x] for w in words for x in _windows(w)]].sum(axis=0) / len(words) ** 0.5
                         for words in sets])
    weight = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0)
    w, bias = _fit_linear(features, y, weight)
    return basis @ (root @ w), bias


def _fit_score(margins: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Slopes and offset of the logistic map from a document's margins to its label, with Platt's smoothed targets."""
    positive = labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    rows = np.hstack([margins, np.ones((len(margins), 1))])
    size = rows.shape[1]
    w = np.zeros(size)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -50, 50)))
        grad = rows.T @ (p - target) + 1e-3 * w
        hess = rows.T @ (rows * (p * (1 - p) + 1e-9)[:, None]) + 1e-3 * np.eye(size)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w[:-1].tolist()), float(w[-1])


def toxic_terms(counts: list[tuple[bytes, int, int]], rate: float, tested: int) -> list[bytes]:
    """The terms of (term, toxic documents, clean documents) that are toxic beyond chance, strongest first.

    A term's likelihood ratio must be significant at ``LEVEL`` over all terms tested. As labels may be wrong and
    harmless words stand near toxic ones, its share of toxic documents must also be nearer to that which the purest
    term surely has (its confidence bound at the same level) than to the base rate.
    """
    z2 = NormalDist().inv_cdf(1 - min(0.5, LEVEL / max(1, tested))) ** 2
    strong, purest = [], rate
    for term, bad, good in counts:
        n = bad + good
        share = bad / n
        if share <= rate:
            continue
        evidence = 2 * (bad * np.log(share / rate) + (good * np.log((1 - share) / (1 - rate)) if good else 0.0))
        if evidence >= z2:
            centre, spread = share + z2 / (2 * n), np.sqrt(z2 * share * (1 - share) / n + z2 * z2 / (4 * n * n))
            purest = max(purest, (centre - spread) / (1 + z2 / n))
            strong.append((evidence, share, term))
    return [t for _, s, t in sorted(strong, key=lambda x: (-x[0], x[2])) if s > (rate + purest) / 2]


def _variants(word: bytes) -> list[bytes]:
    """The word with one letter doubled, and with one letter put in at each inner place."""
    doubled = [word[:i] + word[i - 1:i] + word[i:] for i in range(1, len(word) + 1)]
    gapped = [word[:i] + bytes([97 + (7 * i + 3 * j) % 26]) + word[i:] for i in range(1, len(word)) for j in (0, 4)]
    return doubled + gapped


def held_out(key):
    """Every fifth id by the checksum of its text form; never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          labelled: int = LABELLED) -> Model:
    """Learn from the documents of labelled rows that are not held out, at most ``labelled`` of each class.

    A sentence carries its document's label; equal sentences count once, for one document. One machine is fitted on
    labelled sentences. Another is fitted on terms: those in toxic documents far beyond chance (see ``toxic_terms``)
    and their spelled variants against clean terms; in further rounds the clean terms of the sample that come
    nearest join them. Without labels of both classes the model scores every text 0.
    """
    usable = (labels.select(labels[key].alias("key"), labels[label].cast("int").alias("toxic"))
              .filter(F.col("key").isNotNull() & F.col("toxic").isin(0, 1)).filter(~held_out(F.col("key")))
              .groupBy("key").agg(F.max("toxic").alias("toxic")))
    chosen = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("key"), "key").limit(labelled) for c in (0, 1)]
    sample = materialize(docs.select(docs[key].alias("key"), text_of(text).alias("text"))
                         .join(F.broadcast(materialize(chosen[0].union(chosen[1]))), "key")
                         .select(F.xxhash64("key").alias("owner"), "text", "toxic"))
    classes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Model(None)

    def sentences(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = {(k, s, y) for k, t, y in zip(*(batch.column(i).to_pylist() for i in range(3)))
                for s in _SENTENCE.split(t) if s}
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()),
                                           pa.array([x[1] for x in rows], pa.string()),
                                           pa.array([x[2] for x in rows], pa.int32())], ["owner", "sentence", "toxic"])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {(w, k, y) for k, s, y in zip(*(batch.column(i).to_pylist() for i in range(3)))
                    for w in terms_of(s) if len(w) >= 3}
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.binary()),
                                              pa.array([x[1] for x in rows], pa.int64()),
                                              pa.array([x[2] for x in rows], pa.int32())], ["term", "owner", "toxic"])

    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _table(toxic)
        for batch in batches:
            words = batch.column(0).to_pylist()
            owner, windows = [], []
            for i, word in enumerate(words):
                for window in _windows(word):
                    owner.append(i)
                    windows.append(window)
            rows, columns = np.nonzero(_apply(tables, windows) >= NEAR) if windows else ([], [])
            pairs = sorted({(owner[r], int(c)) for r, c in zip(rows, columns)})
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i, _ in pairs], pa.binary()),
                                              pa.array([toxic[c] for _, c in pairs], pa.binary())], ["term", "of"])

    distinct = materialize(map_batches(sample, sentences, "owner long, sentence string, toxic int")
                           .groupBy("sentence", "toxic").agg(F.min("owner").alias("owner"))
                           .select("owner", "sentence", "toxic"))
    found = materialize(distinct.mapInArrow(terms, "term binary, owner long, toxic int").distinct())
    counts = [F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")]
    totals = materialize(found.groupBy("term").agg(*counts))
    sums = totals.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("terms")).first()
    rate = (sums.bad or 0) / max(1, (sums.bad or 0) + (sums.good or 0))
    part = F.col("bad") / (F.col("bad") + F.col("good"))
    strong = totals.filter(F.col("bad") > 1).filter(part > rate).collect()
    every = toxic_terms([(bytes(r.term), r.bad, r.good) for r in strong], rate, sums.terms)
    toxic = [t for t in every if len(t) <= SPAN]
    if toxic:
        # Spellings count as the term only if it stays toxic with them, by documents that have any; else it is known
        # to the letter alone.
        near = totals.select("term").mapInArrow(families, "term binary, of binary")
        whole = found.join(near, "term").select("of", "owner", "toxic").distinct().groupBy("of").agg(*counts).collect()
        kept = set(toxic_terms([(bytes(r.of), r.bad, r.good) for r in whole if r.bad > 1], rate, sums.terms))
        toxic = [t for t in toxic if t in kept]
    spark = docs.sparkSession
    model = _term_machine(spark, totals, part, toxic)
    model.terms = frozenset(every)
    ordered = [F.xxhash64("sentence"), F.col("sentence")]
    taught = [[r.sentence for r in distinct.filter(F.col("toxic") == c).orderBy(*ordered).limit(SENTENCES).collect()]
              for c in (1, 0)]
    model.sentence_weights, model.sentence_bias = fit_sentences(*taught, toxic[:2 * SENTENCE_LANDMARKS])
    rows = score_rows(sample, model, ["toxic"], "text", spark).collect()
    model.slopes, model.offset = _fit_score(np.array([r.margins for r in rows]), np.array([r.toxic for r in rows]))
    return model


def _term_machine(spark, totals: DataFrame, part, toxic: list[bytes]) -> Model:
    """The machine over terms; without toxic ones it gives every term the bias."""
    if not toxic:
        return Model(None)
    spelled = toxic + [v for word in toxic for v in _variants(word) if len(v) <= SPAN]
    clean_rows = totals.filter((F.col("good") > 0) & (F.length("term") <= SPAN) & (part < 0.5))
    common = clean_rows.orderBy(F.desc("good"), "term").limit(CLEAN_TERMS // 2).collect()
    random = clean_rows.orderBy(F.xxhash64("term"), "term").limit(CLEAN_TERMS // 2).collect()
    clean = list(dict.fromkeys(bytes(r.term) for r in common + random))
    hard: list[bytes] = []
    for round_ in range(ROUNDS):
        near = hard[:LANDMARKS // 4] + clean
        landmarks = list(dict.fromkeys(toxic[:LANDMARKS // 2] + near))[:LANDMARKS]
        model = fit_terms(spelled, list(dict.fromkeys(clean + hard)), landmarks)
        if round_ == ROUNDS - 1:
            break
        sent = spark.sparkContext.broadcast(model)

        def margins(batch: pa.RecordBatch, scorer: TermScorer) -> pa.RecordBatch:
            words = batch.column(0).to_pylist()
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.margins(words))], ["term", "margin"])

        scored = map_batches(clean_rows.select("term"), margins, "term binary, margin double",
                             lambda sent=sent: TermScorer(sent.value), rows=10_000)
        mined = scored.orderBy(F.desc("margin"), "term").limit(MINED).collect()
        hard = list(dict.fromkeys([bytes(r.term) for r in mined] + hard))
    return model


def score_rows(docs: DataFrame, model: Model, keep: list[str], text: str, spark) -> DataFrame:
    """The kept columns, each text's margins and its score, one pass."""
    sent = spark.sparkContext.broadcast(model)
    frame = docs.select(*[docs[f"`{c}`"] for c in keep], text_of(text).alias(fresh_name(docs, "whole_text")))
    names = [fresh_name(frame.select(*keep), n) for n in ("margins", "score")]
    schema = frame.select(*keep, F.array(F.lit(0.0)).alias(names[0]), F.lit(0.0).alias(names[1])).schema

    def score(batch: pa.RecordBatch, scorer: TermScorer) -> pa.RecordBatch:
        margins = scorer.details(batch.column(len(keep)).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margins.tolist(), pa.list_(pa.float64())),
                                           pa.array(scorer.model.score(margins))], schema.names)

    return map_batches(frame, score, schema, lambda: TermScorer(sent.value))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: key, held_out, score (0 to 1), predicted (1 from 0.5 on).

    The score rests on the most toxic term and the sentences of the whole text, however long; NULL and empty texts
    have none and get the lowest margins. Repeated rows score alike; NULL keys are scored and never held out.
    """
    model = train(docs, labels, key, text, **options)
    scored = score_rows(docs.select(docs[key].alias("key"), docs[text].alias("text")), model, ["key"], "text",
                        docs.sparkSession)
    return scored.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more; the columns stay."""
    model = train(docs, labels, key, text, **options)
    scored = score_rows(docs, model, docs.columns, text, docs.sparkSession)
    return scored.filter(scored[scored.columns[-1]] < 0.5).select(*[f"`{c}`" for c in docs.columns])
