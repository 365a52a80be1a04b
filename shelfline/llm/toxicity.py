"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its labels."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty

#: A short lexicon of insults in English, German, French and Spanish
LEXICON = (
    "idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "pathetic", "disgusting", "worthless", "clown", "jerk", "fool", "ugly",
    "dumm", "blöd", "trottel", "abschaum", "imbécile", "connard", "crétin", "idiota", "imbécil", "estúpido", "basura",
)
LETTERS = regex.compile(r"\p{L}+")
ADDRESS = regex.compile(r"\b(?:you|you're|your|du|tu|vous|usted)\b[^.!?]{0,40}\b(?:" + "|".join(LEXICON) + r")", regex.IGNORECASE)
BANGS = regex.compile(r"[!?]{2,}")
#: word beginnings of these lengths are terms beside the whole word
STEMS = (3, 4, 5, 6, 7, 8)
#: words whose terms a worker remembers
REMEMBERED = 150_000
PATTERNS = ("shouts", "bangs", "address", "several", "none")
#: votes are kept in as many words of so many bits as the voters need
WORD_BITS = 63


def word_terms(word: str) -> list[str]:
    """The terms of a lower-case word: the word itself, marked by its end, and its beginnings."""
    return [word + "$", *[word[:n] for n in STEMS if len(word) >= n]]


def text_terms(text: str) -> set[str]:
    return {t for w in set(LETTERS.findall(text.lower())) for t in word_terms(w)}


@dataclass
class Terms:
    """Finds known terms in texts; remembers the result by word."""

    numbers: dict[str, int]
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def find(self, text: str) -> set[int]:
        out: set[int] = set()
        for word in set(LETTERS.findall(text.lower())):
            own = self.seen.get(word)
            if own is None:
                own = tuple(self.numbers[t] for t in word_terms(word) if t in self.numbers)
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[word] = own
            if own:
                out.update(own)
        return out


@cache
def cases() -> np.ndarray:
    """By code point: 1 for letters, 2 for capitals, 3 for both."""
    return np.fromiter((c.isalpha() + 2 * c.isupper() for c in map(chr, range(0x110000))), np.uint8, 0x110000)


def shouts(text: str) -> bool:
    """Whether over 0.6 of the letters of the whole text, and of at least 20, are capitals."""
    n = np.bincount(cases()[np.frombuffer(text.encode("utf-32-le"), "<u4")], minlength=4)
    letters = int(n[1] + n[3])
    return letters >= 20 and int(n[2] + n[3]) > 0.6 * letters


def votes(text: str, found: set[int], voters: int) -> int:
    """Bits of the voters that fire: a lexicon voter for each of the first ``voters`` terms, then the patterns."""
    lexicon = [t for t in found if t < voters]
    fired = (shouts(text), len(BANGS.findall(text)) >= 2,
             ADDRESS.search(text) is not None, len(lexicon) >= 3, not lexicon)
    return sum(1 << t for t in lexicon) | sum(1 << (voters + i) for i, x in enumerate(fired) if x)


def mask_names(voters: int) -> list[str]:
    """Columns that hold the bits of the voters and the patterns."""
    return [f"mask{i}" for i in range(-(-(voters + len(PATTERNS)) // WORD_BITS))]


def mask_columns(masks: list[int], names: list[str]) -> list[pa.Array]:
    return [pa.array([m >> WORD_BITS * i & (1 << WORD_BITS) - 1 for m in masks], pa.int64()) for i in range(len(names))]


def distinct_terms(ranked: list[tuple[str, float]], most: int) -> list[str]:
    """The first terms of a ranking without those that find nearly the same texts as a beginning or continuation before them."""
    chosen: list[tuple[str, float]] = []
    for term, n in ranked:
        bare = term.rstrip("$")
        if not any((bare.startswith(t) or t.startswith(bare)) and 0.5 * m <= n <= 2 * m for t, m in chosen):
            chosen.append((bare, n))
            if len(chosen) == most:
                break
    marked = {t for t, _ in ranked}
    return [t if t in marked else t + "$" for t, _ in chosen]


@dataclass
class LabelModel:
    """Class-conditional firing rates of the voters, the share of toxic documents, and how far correlated voters count."""

    share: float
    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        fired = self.fired(masks)
        yes = np.log(self.toxic / self.clean) * self.weight
        no = np.log((1 - self.toxic) / (1 - self.clean)) * self.weight
        odds = math.log(self.share / (1 - self.share)) + fired @ yes + (1 - fired) @ no
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def fired(self, masks: np.ndarray) -> np.ndarray:
        """A row for each of ``masks``, which are words of WORD_BITS bits, or rows of such words."""
        words, at = (masks if masks.ndim == 2 else masks[:, None]).astype(np.int64), np.arange(len(self.toxic))
        return ((words[:, at // WORD_BITS] >> at % WORD_BITS) & 1).astype(np.float64)

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Expected numbers of toxic and clean documents in which voters i and j both fire; i = -1: all documents."""
        for batch in batches:
            masks = np.stack([batch.column(c).to_numpy() for c in batch.schema.names if c != "n"], axis=1)
            n = batch.column("n").to_numpy().astype(np.float64)
            p, fired = self.posterior(masks), self.fired(masks)
            i, j = np.triu_indices(fired.shape[1])
            pos, neg = ((fired * (n * q)[:, None]).T @ fired for q in (p, 1 - p))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([[-1], i]), pa.int32()), pa.array(np.concatenate([[-1], j]), pa.int32()),
                 pa.array(np.concatenate([[n @ p], pos[i, j]])), pa.array(np.concatenate([[n @ (1 - p)], neg[i, j]]))], ["i", "j", "pos", "neg"])

    def refit(self, masks: DataFrame) -> LabelModel:
        """One round of expectation and maximisation over the vote patterns of all documents."""
        got = masks.mapInArrow(self.sums, "i int, j int, pos double, neg double").groupBy("i", "j").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
        v = len(self.toxic)
        both = np.zeros((2, v, v))
        pos = neg = 0.0
        for r in got:  # a row for each pair of voters
            if r["i"] < 0:
                pos, neg = r["pos"], r["neg"]
            else:
                both[:, r["i"], r["j"]] = both[:, r["j"], r["i"]] = r["pos"], r["neg"]
        if not pos + neg:
            return self
        toxic, clean = ((np.diag(b) + 0.5) / (n + 1 + 1e-9) for b, n in zip(both, (pos, neg)))
        # correlation of two voters beyond the class, in the larger of both classes' terms
        excess = np.zeros((v, v))
        for b, rate, n in zip(both, (toxic, clean), (pos, neg)):
            spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) + 1e-9
            excess = np.maximum(excess, (b / max(n, 1.0) - np.outer(rate, rate)) / spread)
        np.fill_diagonal(excess, 0)
        weight = 1 / (1 + np.where(excess > 0.3, np.minimum(excess, 1), 0).sum(axis=1))
        clip = lambda x: np.clip(x, 1e-4, 1 - 1e-4)
        return LabelModel(float(np.clip(pos / (pos + neg), 1e-3, 0.5)), clip(toxic), clip(clean), weight)


def logistic_fit(rows: list[list[int]], target: np.ndarray, size: int, penalty: float = 0.1, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression on soft labels, by accelerated gradient steps over term sets."""
    at = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)] or [np.zeros(0)]).astype(np.int64)
    col = np.concatenate([np.asarray(r, np.int64) for r in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
    w, b, vw, vb = np.zeros(size), 0.0, np.zeros(size), 0.0
    # the curvature of a column is at most a quarter of the sum of its rows' lengths
    length = np.bincount(at, minlength=len(rows)).astype(np.float64) + 1
    step_w = 1 / (penalty + 0.25 * np.bincount(col, weights=length[at], minlength=size))
    step_b = 1 / (0.25 * length.sum())
    for k in range(rounds):
        m = k / (k + 3)
        yw, yb = w + m * vw, b + m * vb
        p = 1 / (1 + np.exp(-np.clip(yb + np.bincount(at, weights=yw[col], minlength=len(rows)), -30, 30)))
        e = p - target
        new_w, new_b = yw - step_w * (np.bincount(col, weights=e[at], minlength=size) + penalty * yw), yb - step_b * e.sum()
        w, b, vw, vb = new_w, new_b, new_w - w, new_b - b
    return b, w


def calibration(odds: np.ndarray, label: np.ndarray, rounds: int = 40) -> tuple[float, float]:
    """Slope and shift that turn log odds into those of the label (Platt scaling); no change where the odds do not rise with the label."""
    x, pos = np.clip(odds, -10, 10), label > 0.5
    target = np.where(pos, (pos.sum() + 1) / (pos.sum() + 2), 1 / ((~pos).sum() + 2))
    design, at = np.stack([x, np.ones_like(x)], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (p - target))
        at = at - step * min(1.0, 1 / (np.abs(step).max() + 1e-12))
    return (float(at[0]), float(at[1])) if at[0] > 0.05 else (1.0, 0.0)


@dataclass
class ToxicityModel:
    terms: dict[str, int]
    bias: float
    weights: np.ndarray
    labels: LabelModel | None = None

    def score(self, docs: DataFrame, *keep: str) -> DataFrame:
        """``docs`` columns named in ``keep`` with the score of the text."""
        model = self
        kept = docs.select(*keep, text_or_empty().alias("text"))
        fields = ", ".join(f"`{n}` {t}" for n, t in docs.select(*keep).dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms = Terms(model.terms)
            for batch in batches:
                odds = [model.bias + sum(model.weights[t] for t in terms.find(x.as_py())) for x in batch.column("text")]
                score = 1 / (1 + np.exp(-np.clip(np.array(odds, np.float64), -30, 30)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], [*keep, "score"])

        return kept.mapInArrow(run, f"{fields}, score double")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, voters: int = 48, terms: int = 2000, rounds: int = 2, folds: int = 4) -> ToxicityModel:
    """Learn from the labelled rows that are not held out.

    1. Terms (words and word beginnings) of at most ``sample`` labelled rows, in the order of a hash of doc_id, are counted by class;
       the most telling ones become features, the first ``voters`` of those for toxic become lexicon voters. Patterns vote too.
    2. All documents vote. The label model starts at the rates of the sample and goes through ``rounds`` rounds of
       expectation and maximisation over the counted vote patterns of the corpus; it estimates how often each
       voter fires in either class and which voters are correlated, whose votes then count for less.
    3. A linear classifier over the features learns the posterior labels of the sample, where the given
       label is one more voter.
    4. Its log odds are scaled to the given labels. Each of ``folds`` parts of the sample gets the odds of a classifier learned from
       the other parts, so that the scale is not that of rows learned by heart.

    ``terms`` and ``voters`` bound the model: less telling terms beyond them have no weight, and further terms found do not vote.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # a bounded sample may be broadcast
    )
    # rows that share a doc_id count once, so the sample stays bounded
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = store(texts, "toxic-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
                own = sorted(text_terms(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int32())], ["term", "label"])

    totals = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos_n, neg_n = totals.get(1, 0), totals.get(0, 0)
    counts = (
        texts.select("label", "text").mapInArrow(counted, "term string, label int").groupBy("term")
        .agg(F.sum(F.col("label").cast("double")).alias("pos"), F.sum((1 - F.col("label")).cast("double")).alias("neg")).filter("pos + neg >= 3"))
    lift = F.log((F.col("pos") + 0.5) / (pos_n + 1)) - F.log((F.col("neg") + 0.5) / (neg_n + 1))
    ranked = counts.withColumn("gain", (F.col("pos") + F.lit(0.0)) * F.greatest(lift, F.lit(0.0)) + F.col("neg") * 0.1 * F.greatest(-lift, F.lit(0.0)) * F.lit(float(pos_n > 0)))
    # a term of toxic texts alone is telling when chance would put it there with a probability of e**-12
    chance = -math.log((pos_n + 1) / (pos_n + neg_n + 2)) if pos_n + neg_n else 1.0
    sure = (lift < 0) | (F.col("pos") * F.lit(chance) - F.col("neg") >= 12)
    telling = ranked.filter(F.abs(lift) > 1.5).filter(sure).withColumn("lift", lift).orderBy(F.col("gain").desc(), "term").limit(terms).collect()  # at most `terms` rows
    first = distinct_terms([(r["term"], r["pos"]) for r in telling if r["lift"] > 0], voters)
    named = [f"{w}$" for w in LEXICON]
    order = list(dict.fromkeys(first + [r["term"] for r in telling]))
    # lexicon words that the sample does not show vote as well
    lexicon = list(dict.fromkeys(first + named))
    numbers = {t: i for i, t in enumerate(dict.fromkeys([*lexicon, *order]))}
    v = len(lexicon)
    names = mask_names(v)
    words = ", ".join(f"{c} long" for c in names)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(numbers)
        for batch in batches:
            masks = [votes(text, known.find(text), v) for text in map(pa.StringScalar.as_py, batch.column("text"))]
            yield pa.RecordBatch.from_arrays(mask_columns(masks, names), names)

    masks = store(docs.select(text_or_empty().alias("text")).mapInArrow(voted, words).groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "votes")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(numbers)
        for batch in batches:
            terms_, masks_ = [], []
            for text in map(pa.StringScalar.as_py, batch.column("text")):
                found = known.find(text)
                terms_.append(sorted(found))
                masks_.append(votes(text, found, v))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("fold"), pa.array(terms_, pa.list_(pa.int32())), *mask_columns(masks_, names)], ["label", "fold", "terms", *names])

    described_rows = texts.select(F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int").alias("fold"), "text")
    rows = described_rows.mapInArrow(described, f"label int, fold int, terms array<int>, {words}").collect()  # the bounded sample
    own = np.array([r["label"] for r in rows], np.float64)
    sampled = np.array([[r[c] for c in names] for r in rows], np.int64).reshape(-1, len(names))
    n = v + len(PATTERNS)
    model = LabelModel(0.1, np.full(n, 0.5), np.full(n, 0.5), np.ones(n))
    if len(rows) and 0 < own.sum() < len(own):
        fired = model.fired(sampled)
        rate = lambda y: np.clip((fired[own == y].sum(axis=0) + 0.5) / ((own == y).sum() + 1), 1e-4, 1 - 1e-4)
        model = LabelModel(float(np.clip(own.mean(), 1e-3, 0.5)), rate(1), rate(0), np.ones(n))
        for _ in range(rounds):
            model = model.refit(masks)
        soft = model.posterior(sampled)
        # the given label is one more voter, with the rates at which it agrees with the others
        agrees = np.clip((own @ soft + 1) / (soft.sum() + 2), 0.6, 0.99), np.clip((own @ (1 - soft) + 1) / ((1 - soft).sum() + 2), 0.01, 0.4)
        ratio = np.where(own > 0.5, np.log(agrees[0] / agrees[1]), np.log((1 - agrees[0]) / (1 - agrees[1])))
        target = 1 / (1 + np.exp(-(np.log(soft / (1 - soft)) + ratio)))
        found = [r["terms"] for r in rows]
        bias, weights = logistic_fit(found, target, len(numbers))
        fold, odds = np.array([r["fold"] for r in rows]), np.zeros(len(rows))
        for f in range(folds):
            part = np.flatnonzero(fold == f)
            rest = np.flatnonzero(fold != f)
            if len(part) and len(rest):
                b, w = logistic_fit([found[i] for i in rest], target[rest], len(numbers))
                odds[part] = [b + w[found[i]].sum() for i in part]
        slope, shift = calibration(odds, own)
        bias, weights = slope * bias + shift, slope * weights
    else:  # nothing to learn from: the lexicon alone
        bias, weights = -3.0, np.where(np.arange(len(numbers)) < v, 2.5, 0.0)
    return ToxicityModel(numbers, bias, weights, model)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    held_out rows (CRC-32 of doc_id as text leaves 1 modulo 3) are never learned from. Null and empty
    texts get the score of a text without any term. Null doc_ids are scored and never learned from.
    Without labels of both classes the fixed lexicon alone decides. Repeated rows get equal scores;
    an empty table gives no rows.
    """
    scored = fit(docs, labels, **settings).score(docs, "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    model = fit(docs, labels, **settings)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(model.terms)
        for batch in batches:
            found = [terms.find(x.as_py() or "") for x in batch.column("text")]
            odds = np.array([model.bias + sum(model.weights[t] for t in f) for f in found], np.float64)
            stay = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) < threshold
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(stay)) for c in batch.columns], columns)

    return docs.mapInArrow(run, docs.schema)
