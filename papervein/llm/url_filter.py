"""URL filter: rules for hosts and paths, and boosted trees where no rule fits.

The trees are trained on the URLs that a rule judges, with the rule's verdict as label, from
a bounded sample of distinct URLs (``SAMPLE_URLS``, in hash order).  Features are lexical:
lengths, depth, digit ratio, entropy, parameters, and for the last one and two labels of the
host the share of blocked URLs among the sample, smoothed, without the URL itself.

A null URL, or one without ``://``, has an empty host and path, fits no rule, and is judged by
the trees like any other.  Without labelled URLs, or with one verdict only, the trees give
that verdict, or allow.  Of rules of equal length that fit, the one with the longer host wins.
Repeated rows each get a row.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm import boosting
from papervein.llm.shared import Tables, first_by_hash

SAMPLE_URLS = 20_000
SMOOTHING = 5.0
FEATURES = (
    "length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "parameters",
    "hyphens", "longest_segment", "fragment", "one_blocked", "two_blocked",
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Rules:
    """Rules by host.  The list is bounded: it travels with every task."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[Rule]] = defaultdict(list)
        for rule in sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text, r.verdict)):
            self.by_host[rule.host].append(rule)

    def find(self, host: str, path: str) -> Rule | None:
        found, own = None, host
        while own:
            for rule in self.by_host.get(own, ()):
                if path.startswith(rule.path):
                    if found is None or len(rule.text) > len(found.text):
                        found = rule
                    break
            own = own.partition(".")[2]
        return found


def _until(text: str, ends: str) -> int:
    return min((k for k in map(text.find, ends) if k >= 0), default=len(text))


def split(url: str | None) -> tuple[str, str, str]:
    """Host in lower case, path, and what follows it."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    end = _until(rest, "/?#")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    stop = end + _until(rest[end:], "?#")
    return host, rest[end:stop], rest[stop:]


def _suffixes(host: str) -> tuple[str, str]:
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:])


def lexical(url: str | None) -> list[float]:
    """The features that need nothing but the URL."""
    url = url or ""
    host, path, rest = split(url)
    times = Counter(url).values()
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in times)
    query = rest.partition("#")[0].removeprefix("?")
    return [
        len(url), len(host), len(path), host.count(".") + bool(host), sum(map(bool, path.split("/"))),
        sum(c.isdigit() for c in url) / max(1, len(url)), entropy, len([p for p in query.split("&") if p]),
        url.count("-"), max(map(len, path.split("/"))), float("#" in rest),
    ]


@dataclass(frozen=True)
class Model:
    forest: boosting.Forest
    suffix: dict[str, tuple[int, int]]  # blocked and all sampled URLs of a host's suffix
    prior: float

    def features(self, urls: Sequence[str | None], labels: np.ndarray | None = None) -> np.ndarray:
        """``labels``: those of the sample itself, whose own label is left out."""
        out = np.zeros((len(urls), len(FEATURES)))
        for k, url in enumerate(urls):
            shares = []
            for suffix in _suffixes(split(url)[0]):
                blocked, all_ = self.suffix.get(suffix, (0, 0))
                if labels is not None:
                    blocked, all_ = blocked - labels[k], all_ - 1
                shares.append((blocked + SMOOTHING * self.prior) / (all_ + SMOOTHING))
            out[k] = lexical(url) + shares
        return out

    def block_probability(self, urls: Sequence[str | None]) -> np.ndarray:
        return self.forest.probability(self.features(urls))


def fit(urls: Sequence[str], labels: Sequence[int]) -> Model:
    """Train on labelled URLs; 1 is block."""
    y = np.array(labels, float)
    suffix: dict[str, tuple[int, int]] = {}
    for url, label in zip(urls, labels):
        for s in set(_suffixes(split(url)[0])):
            blocked, all_ = suffix.get(s, (0, 0))
            suffix[s] = (blocked + label, all_ + 1)
    prior = float(y.mean()) if len(y) else 0.0
    empty = boosting.fit(np.empty((0, len(FEATURES))), y[:0])
    model = Model(empty, suffix, prior)
    if not len(y):
        return model
    x = model.features(urls, y)
    shares = {FEATURES.index("one_blocked"): 1, FEATURES.index("two_blocked"): 1}
    return Model(boosting.fit(x, y, monotone=shares), suffix, prior)


def labelled_sample(pages: DataFrame, rules: Rules, most: int = SAMPLE_URLS) -> tuple[list[str], list[int]]:
    """Distinct URLs that a rule judges, at most ``most``, and whether they are blocked."""

    def labelled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            urls, labels = [], []
            for url in batch.column(0).to_pylist():
                rule = rules.find(*split(url)[:2])
                if rule:
                    urls.append(url)
                    labels.append(int(rule.verdict == "block"))
            yield pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(labels, pa.int32())], names=["url", "label"])

    urls = pages.select("url").where("url IS NOT NULL").distinct()
    found = Tables(pages.sparkSession, "url-filter").write(urls.mapInArrow(labelled, "url string, label int"), "labelled")
    rows = first_by_hash(found, "url", most).collect()
    return [r.url for r in rows], [r.label for r in rows]


def judge(pages: DataFrame, rules: Sequence[Rule], most: int = SAMPLE_URLS) -> DataFrame:
    """page_id, host, path, the rule that fits (or null), the verdict and the trees' score."""
    compiled = Rules(rules)
    model = fit(*labelled_sample(pages, compiled, most))

    def judged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            urls = batch.column(1).to_pylist()
            split_urls = [split(url)[:2] for url in urls]
            found = [compiled.find(*s) for s in split_urls]
            score = model.block_probability(urls)
            verdicts = [r.verdict if r else "block" if s > 0.5 else "allow" for r, s in zip(found, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s[0] for s in split_urls], pa.string()),
                 pa.array([s[1] for s in split_urls], pa.string()),
                 pa.array([r and r.text for r in found], pa.string()), pa.array(verdicts, pa.string()), pa.array(score)],
                names=["page_id", "host", "path", "rule", "verdict", "block_score"],
            )

    return pages.select("page_id", "url").mapInArrow(
        judged, "page_id long, host string, path string, rule string, verdict string, block_score double"
    )
