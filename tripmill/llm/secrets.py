"""Secret scans: rules by pattern, and character Markov models of random strings and ordinary identifiers.

Rules find assignments of secrets, access keys and long hexadecimal strings. What they miss is judged by
two Markov models of order 2 over characters: a string of letters, digits and
the signs of base 64 is reported as ``random`` if the log-likelihood ratio per character of the model of
random strings against that of ordinary identifiers is above a threshold and it has 20 characters or more.
Such strings are looked for inside longer runs, too: of a run that does not pass as a whole, the part with the
largest sum of ratios above the threshold is taken, widened to the next joints if it still passes, then
the same is done left and right of it. What a rule covers is cut out of a run; the rest is judged.

The models are trained on labelled strings: strings that the rules flag, cut out of their context, are
random; words outside such spans, alone and put together as identifiers, also in capitals, are ordinary, and so are
lines of one letter or sign. As the rules know few alphabets, seeded
random strings over the usual alphabets of keys complete the random side. The training rows are a sample
of documents by hash, of about ``TRAIN_DOCUMENTS`` documents; scanning covers all rows and whole texts.

Cases: a null text is an empty one without spans. Spans are counted in code points, end exclusive; they
are sorted by start, then by kind. Equal rows give equal results. An empty table gives no rows and models
of random strings alone. ``scan`` and ``redact`` keep the input's columns.
"""

from __future__ import annotations

import math
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

# The rules, by kind and in the order in which kinds are listed; the least length is that of the group.
RULES = {
    "assign": (
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        2,
        8,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}
KINDS = [*RULES, "random"]
_ALPHABET = string.ascii_letters + string.digits + "+/_=-"
# A secret has so many characters at least.
LEAST = 20
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
_JOINT = re.compile("[/=_-]")
_JOINTS = ["_", "-", "/"]
_IDENTIFIER = re.compile(r"[A-Za-z]{4,}")
# Hexadecimal runs shorter than the rule's least length are no matches, so they need not be visited.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")

TRAIN_DOCUMENTS = 20_000
# Different strings held at a time, some 20 MB.
MOST_STRINGS = 200_000
# Random strings made per alphabet, and their length.
_MADE, _MADE_LENGTH = 2_000, 40
# A string needs this log-likelihood ratio per character, in nats.
THRESHOLD = 2.0
# Inside a run no character counts for more, so that a date among words is no secret.
MOST = 6.0
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def rule_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules' matches: leftmost and without overlap within a kind."""
    found = []
    for kind, (pattern, group, least) in RULES.items():
        pattern = _LONG_HEX if kind == "hex" else pattern
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), m.end(), kind))
    return found


class MarkovModel:
    """Probability of a character after the two before it; rare contexts lean on shorter ones."""

    def __init__(self, counts: dict[str, int], weight: float = 5.0) -> None:
        self.counts, self.weight = counts, weight
        self.seen: Counter = Counter()  # n-grams of one and two characters, and contexts
        self.contexts: Counter = Counter()
        for gram, n in counts.items():
            self.seen[gram[1:]] += n
            self.seen[gram[2:]] += n
            self.contexts[gram[:2]] += n
            self.contexts[gram[1:2]] += n
            self.contexts[""] += n

    def log_probability(self, gram: str) -> float:
        p = (self.seen[gram[2:]] + 0.5) / (self.contexts[""] + 0.5 * len(_ALPHABET))
        p = (self.seen[gram[1:]] + self.weight * p) / (self.contexts[gram[1:2]] + self.weight)
        return math.log((self.counts.get(gram, 0) + self.weight * p) / (self.contexts[gram[:2]] + self.weight))


def grams(text: str) -> Iterator[str]:
    """The characters with the two before them; the string's start counts as two blanks."""
    padded = "  " + text
    return (padded[i : i + 3] for i in range(len(text)))


class Detector:
    """Compares the two models; their difference per three characters is kept as a table."""

    def __init__(self, random_counts: dict[str, int], ordinary_counts: dict[str, int], threshold: float = THRESHOLD) -> None:
        self.models = MarkovModel(random_counts), MarkovModel(ordinary_counts)
        self.threshold = threshold
        self.known: dict[str, float] = {}

    def ratios(self, text: str) -> list[float]:
        """Log-likelihood ratio of each character."""
        out = []
        for gram in grams(text):
            value = self.known.get(gram)
            if value is None:
                a, b = self.models
                value = self.known[gram] = a.log_probability(gram) - b.log_probability(gram)
            out.append(value)
        return out

    def ratio(self, text: str) -> float:
        """Log-likelihood ratio per character."""
        return sum(self.ratios(text)) / max(1, len(text))

    def random_parts(self, text: str) -> list[tuple[int, int]]:
        """Parts of ``LEAST`` characters or more whose mean ratio is above the threshold, without overlap."""
        import numpy as np

        ratios = np.array(self.ratios(text))
        if len(text) >= LEAST and ratios.mean() > self.threshold:
            return [(0, len(text))]
        sums = np.concatenate([[0.0], np.cumsum(np.minimum(ratios, MOST) - self.threshold)])
        joints = [m.start() for m in _JOINT.finditer(text)]
        found, left = [], [(0, len(text))]
        while left:
            low, high = left.pop()
            if high - low < LEAST:
                continue
            own = sums[low : high + 1]
            gains = np.maximum.accumulate(own[::-1])[::-1][LEAST:] - own[:-LEAST]
            start = int(gains.argmax())
            if gains[start] <= 0:
                continue
            end = low + start + LEAST + int(own[start + LEAST :].argmax())
            start += low
            before, after = bisect_left(joints, start), bisect_left(joints, end)
            first = max(low, joints[before - 1] + 1 if before else 0)
            last = min(high, joints[after] if after < len(joints) else high)
            wider = [(first, last), (first, end), (start, last), (start, end)]
            start, end = next((a, b) for a, b in wider if sums[b] > sums[a])
            found.append((start, end))
            left += [(low, start), (end, high)]
        return sorted(found)

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """All spans, sorted by start, then by kind as listed."""
        found = rule_spans(text)
        taken, turn = merged((a, b) for a, b, _ in found), 0
        for m in _CANDIDATE.finditer(text):
            while turn < len(taken) and taken[turn][1] <= m.start():
                turn += 1
            at, upto = m.start(), turn
            while at < m.end():
                cut = taken[upto] if upto < len(taken) and taken[upto][0] < m.end() else (m.end(), m.end())
                if cut[0] - at >= LEAST:
                    found += [(at + a, at + b, "random") for a, b in self.random_parts(text[at : cut[0]])]
                at, upto = cut[1], upto + 1
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def labelled_strings(text: str) -> Iterator[tuple[int, str]]:
    """(1, string) for what the rules flag, (0, string) for identifiers elsewhere.

    Runs long enough to be judged are nobody's identifiers: an unlabelled secret would be learnt by heart.
    """
    spans = rule_spans(text)
    for start, end, kind in spans:
        yield 1, RULES["assign"][0].fullmatch(text[start:end])[2] if kind == "assign" else text[start:end]
    apart = merged([*((a, b) for a, b, _ in spans), *(m.span() for m in _CANDIDATE.finditer(text))])
    before, turn, upto = "name", 0, 0
    for m in _IDENTIFIER.finditer(text):
        while upto < len(apart) and apart[upto][1] <= m.start():
            upto += 1
        if upto == len(apart) or m.end() <= apart[upto][0]:
            yield 0, m[0]
            # Identifiers of code are words put together, sometimes with a number.
            for joint in _JOINTS:
                yield 0, before + joint + m[0]
            yield 0, before + m[0].capitalize() + str(turn % 10)
            before, turn = m[0], turn + 1


def made_strings(seed: int = 0) -> Iterator[str]:
    """Random strings over the usual alphabets of keys."""
    dice = random.Random(seed)
    alphabets = [
        string.hexdigits[:16],
        string.digits + string.ascii_uppercase,
        string.digits + string.ascii_lowercase,
        string.digits + string.ascii_letters,
        string.digits + string.ascii_letters + "+/",
        string.digits + string.ascii_letters + "-_",
    ]
    for alphabet in alphabets:
        for _ in range(_MADE):
            yield "".join(dice.choices(alphabet, k=_MADE_LENGTH))


def train(docs: DataFrame, threshold: float = THRESHOLD, train_documents: int = TRAIN_DOCUMENTS) -> Detector:
    """Count the models' characters over a sample of documents; the counts are bounded by the alphabet."""
    total = docs.count()
    share = min(1.0, train_documents / max(1, total))
    cut = int(share * (1 << 20))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < cut).select(common.text_or_empty().alias("text"))

    def count(batches: Iterator) -> Iterator:
        counts: Counter = Counter()
        strings: Counter = Counter()

        def fold() -> None:
            for (label, found), n in strings.items():
                for gram in grams(found):
                    counts[label, gram] += n
            strings.clear()

        for batch in batches:
            for text in batch["text"]:
                strings.update(labelled_strings(text))
                # Equal strings are counted together, as many as fit.
                if len(strings) >= MOST_STRINGS:
                    fold()
        fold()
        yield pd.DataFrame([(a, g, n) for (a, g), n in counts.items()], columns=["label", "gram", "n"])

    summed = sample.mapInPandas(count, "label int, gram string, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    tables: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for row in summed.collect():  # at most 2 * 69 ** 3 rows, whatever the input
        tables[row["label"]][row["gram"]] = row["n"]
    ordinary, flagged = tables
    for gram, n in list(ordinary.items()):
        for other in {gram.upper(), gram.replace("_", "+"), gram.replace("_", "=")} - {gram}:
            ordinary[other] = ordinary.get(other, 0) + n
    for sign in string.ascii_letters + "+/_=-":
        for g in grams(sign * _MADE_LENGTH):
            ordinary[g] = ordinary.get(g, 0) + 1
    for text in made_strings():
        for g in grams(text):
            flagged[g] = flagged.get(g, 0) + 1
    return Detector(flagged, ordinary, threshold)


def scan(docs: DataFrame, detector: Detector) -> DataFrame:
    """The documents with ``found_spans``, an array of (kind, start, end)."""
    random_counts, ordinary_counts = (m.counts for m in detector.models)
    threshold = detector.threshold

    @F.pandas_udf(_SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Detector(random_counts, ordinary_counts, threshold)
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for a, b, k in own.spans(t)] for t in texts], dtype=object)

    return docs.drop("found_spans").withColumn("found_spans", find(common.text_or_empty()))


def joined(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def redact(docs: DataFrame, detector: Detector, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by a mark; a null text stays null."""
    found = scan(docs, detector)

    @F.pandas_udf("string")
    def cover(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans):
            parts, at = [], 0
            for start, end in merged((s["start"], s["end"]) for s in own):
                parts += [text[at:start], mark]
                at = end
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out, dtype=object)

    covered = F.when(F.size("found_spans") > 0, cover(common.text_or_empty(), F.col("found_spans"))).otherwise(F.col("text"))
    return found.withColumn("text", covered).drop("found_spans")
