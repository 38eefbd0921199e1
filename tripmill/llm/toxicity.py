"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Training counts tokens in the labelled documents of a bounded sample. A token's score is its log-odds of
standing in a toxic document against a clean one, under a Dirichlet prior that follows the counts of both
classes together; words seen rarely borrow from the prior of their first letters, so that unseen forms of
a known stem count too. Scores that are not significant are 0, and every token pays ``COST``, so that ordinary
text drifts down and only passages dense in toxic tokens rise.

Scoring finds all maximal segments of a document's token scores in linear time, each with a score s. For
random text of n tokens the best s follows an extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s));
lambda is the positive root of the sum over clean tokens of p exp(lambda s) = 1, and K is fitted to the clean
training documents. A segment with an expected count below ``SIGNIFICANT`` is a toxic passage. A document's
evidence is the sum of -log of the expected counts of its passages, and a logistic curve fitted on the
training documents makes it a probability.

Inputs of a score are the text alone. The model has at most ``MODEL_TOKENS`` tokens and is fitted on about
``TRAIN_DOCUMENTS`` labelled documents; everything else covers all rows and whole texts.

Cases: a null or empty text has no tokens and the probability of no evidence. With no labels, or labels of
one class, all scores are the share of toxic labels (0 without any). Repeated rows get equal scores; a
document labelled more than once is toxic if a label says so. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

TRAIN_DOCUMENTS = 20_000
MODEL_TOKENS = 20_000
# A token must reach this G statistic (log-likelihood ratio) to have a score.
_LEAST_G = 20.0
# Weight of the prior, in documents.
_PRIOR = 10.0
# Letters of a word that its stem has, by which unseen words are scored.
_STEMS = (5, 4)
COST = 3.0
# Expected number of such segments in a clean document, below which a segment counts as a passage.
SIGNIFICANT = 0.5
# A long passage is not proof of more than this.
_MOST_EVIDENCE = 60.0
REJECT_AT = 0.3
_TOKEN = re.compile(r"[^\W\d_]+")
_SEGMENT = "array<struct<start:int,end:int,score:double>>"


@dataclass
class ToxicityModel:
    """Scores of words and stems, the extreme-value parameters, and the logistic curve."""

    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    intercept: float = -math.inf

    def token_score(self, token: str) -> float:
        found = self.scores.get(token)
        if found is None:
            for letters in _STEMS:
                found = self.scores.get("^" + token[:letters]) if len(token) > letters else None
                if found is not None:
                    break
        return (found or 0.0) - COST

    def log_expected(self, score: float, n_tokens: int) -> float:
        """Logarithm of the number of segments of at least this score to be expected in so many clean tokens."""
        return math.log(self.k * max(1, n_tokens)) - self.lam * score

    def passages(self, n_tokens: int, segments: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        return [s for s in segments if self.log_expected(s[2], n_tokens) < math.log(SIGNIFICANT)]

    def evidence(self, n_tokens: int, segments: list[tuple[int, int, float]]) -> float:
        found = sum(-self.log_expected(s[2], n_tokens) for s in self.passages(n_tokens, segments))
        return min(_MOST_EVIDENCE, found)

    def probability(self, evidence: float) -> float:
        if self.intercept == -math.inf:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * evidence))))


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def features(token: str) -> list[str]:
    """The word itself and its longer stems."""
    return [token, *("^" + token[:n] for n in _STEMS if len(token) > n)]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(start, end, sum) of all maximal scoring segments, in one pass over the scores.

    A segment's list keeps, of each, the cumulative sum before and after it; a new one is joined to earlier
    ones from the nearest whose left sum is smaller and whose right sum is not larger.
    """
    held: list[list] = []  # start, end, sum before, sum after, nearest earlier with a smaller sum before
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        new = [at, at + 1, before, total, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            new[4] = j
            if j < 0 or held[j][3] >= new[3]:
                held.append(new)
                break
            new[0], new[2] = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, after - before) for a, b, before, after, _ in held]


def document_segments(model_score, known: dict[str, float], words: list[str]) -> list[tuple[int, int, float]]:
    """Maximal segments of a text; token scores are looked up once per distinct token."""
    scores = []
    for word in words:
        value = known.get(word)
        if value is None:
            value = known[word] = model_score(word)
        scores.append(value)
    if max(scores, default=0.0) <= 0:
        return []
    return maximal_segments(scores)


def log_odds(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Scores of the tokens that differ clearly, from the numbers of documents that contain them."""
    found = []
    for token, a in toxic.items():
        b = clean.get(token, 0)
        share, expected = (a + b) / (n_toxic + n_clean), (a + b) * n_toxic / (n_toxic + n_clean)
        if a <= expected:
            continue
        # The G statistic stays sound where one of the counts is 0.
        g = 2 * (a * math.log(a / expected) + (b * math.log(b / (a + b - expected)) if b else 0.0))
        if g >= _LEAST_G:
            alpha, beta = _PRIOR * share, _PRIOR * (1 - share)
            delta = math.log((a + alpha) / (n_toxic - a + beta)) - math.log((b + alpha) / (n_clean - b + beta))
            found.append((g, token, delta))
    return {token: delta for _, token, delta in sorted(found, reverse=True)[:MODEL_TOKENS]}


def extreme_value_rate(shares: dict[float, float]) -> float:
    """Lambda of a score distribution (score to probability) by bisection."""
    if not any(s > 0 for s in shares) or sum(s * p for s, p in shares.items()) >= 0:
        return 1.0
    low, high = 1e-6, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        if sum(p * math.exp(min(700.0, mid * s)) for s, p in shares.items()) > 1:
            high = mid
        else:
            low = mid
    return low


def fit_logistic(x: list[float], y: list[int], ridge: float = 0.1) -> tuple[float, float]:
    """Slope and intercept by Newton's method with halved steps, slightly regularised."""
    import numpy as np

    design = np.column_stack([np.asarray(x, "float64") / _MOST_EVIDENCE, np.ones(len(x))])
    target, weights = np.asarray(y, "float64"), np.zeros(2)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.logaddexp(0, z).sum() - target @ z + ridge / 2 * w @ w)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        gradient = design.T @ (p - target) + ridge * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if abs(size * step).max() < 1e-9:
            break
    return float(weights[0] / _MOST_EVIDENCE), float(weights[1])


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> DataFrame:
    """(text, toxic) of a sample by hash of the labelled documents that are not held out."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, most / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select("doc_id", common.text_or_empty().alias("text")).join(sample, "doc_id").select("text", "toxic")


def held_out(doc_id):
    """Documents whose labels are kept for measuring."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> ToxicityModel:
    rows = common.stage(training_rows(docs, labels, most), "toxicity-training")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy(F.col("toxic").cast("boolean").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(intercept=math.inf if n_toxic else -math.inf)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = {f for token in set(tokens(text)) for f in features(token)}
                counts.update((f, bool(toxic)) for f in found)
        yield pd.DataFrame([(t, y, n) for (t, y), n in counts.items()], columns=["token", "toxic", "n"])

    counted = rows.mapInPandas(count, "token string, toxic boolean, n long").groupBy("token").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("b"),
    )
    # Only tokens over-represented in toxic documents can score; the sample bounds their number.
    likely = counted.filter(f"a * {n_clean} > 2 * b * {n_toxic}").collect()
    toxic = {r["token"]: r["a"] for r in likely}
    clean = {r["token"]: r["b"] for r in likely}
    model = ToxicityModel(log_odds(toxic, clean, n_toxic, n_clean))

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, float] = {}
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = tokens(text)
                segments = document_segments(model.token_score, known, words)
                positive = Counter(round(known[w], 2) for w in words if known[w] > 0)
                out.append((len(words), [s for _, _, s in segments], list(positive), list(positive.values()), int(toxic)))
            yield pd.DataFrame(out, columns=["n", "segments", "values", "times", "toxic"])

    # A row of a few numbers per training document, of which there is a bounded number.
    fitted = rows.mapInPandas(
        summarise, "n long, segments array<double>, values array<double>, times array<long>, toxic int"
    ).collect()
    shares, total = Counter(), 0
    for r in fitted:
        if not r["toxic"]:
            total += r["n"]
            shares.update(dict(zip(r["values"], r["times"])))
    shares[-COST] = total - sum(shares.values())
    model.lam = extreme_value_rate({s: n / max(1, total) for s, n in shares.items()})
    # The mean of K n exp(-lambda S) over the best segments of clean documents is 1.
    best = [(r["n"], max(r["segments"])) for r in fitted if not r["toxic"] and r["segments"]]
    clean_tokens = sum(r["n"] for r in fitted if not r["toxic"])
    count_high = sum(1 for _, s in best if s >= 1.0)
    model.k = min(1.0, max(1e-6, count_high / max(1, clean_tokens) * math.exp(model.lam)))
    evidence = [model.evidence(r["n"], [(0, 0, s) for s in r["segments"]]) for r in fitted]
    model.slope, model.intercept = fit_logistic(evidence, [r["toxic"] for r in fitted])
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents with ``toxic_score`` (0 to 1) and ``passages``: token start, token end and score of each."""

    @F.pandas_udf(f"struct<toxic_score:double,passages:{_SEGMENT}>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        known: dict[str, float] = {}
        scores, passages = [], []
        for text in texts:
            words = tokens(text)
            segments = document_segments(model.token_score, known, words)
            scores.append(model.probability(model.evidence(len(words), segments)))
            passages.append([{"start": a, "end": b, "score": s} for a, b, s in model.passages(len(words), segments)])
        return pd.DataFrame({"toxic_score": scores, "passages": pd.Series(passages, dtype=object)})

    judged = docs.drop("toxic_score", "passages").withColumn("_judged", judge(common.text_or_empty()))
    return judged.select("*", "_judged.*").drop("_judged")
