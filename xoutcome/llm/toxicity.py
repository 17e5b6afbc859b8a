"""Toxic passages: maximum-scoring segments over token log-odds.

Learning, from a bounded sample of labelled texts (``TRAIN_ROWS`` of least hash):

1. Per feature (a word, or its first 3 to 6 letters) its numbers of occurrences and of texts, in toxic and in clean
   texts. A feature is kept if toxic texts hold it more often than clean ones by a signed root of the likelihood ratio
   of ``ROOT_LEAST`` or more, and if the log-odds of its texts under a symmetric Dirichlet prior are ``ODDS_LEAST`` or
   more even at the lower end of their 95 % interval. The first is not fooled by many features, the second not by many
   texts. What a first-letters feature has beyond the longer kept features below it must have those odds too, so that
   one toxic word does not speak for all that begin alike. A word met in ``OWN_TEXTS`` texts goes by its own counts.
2. A token scores the log-odds of its most specific feature by occurrences. Any other token costs ``drift``, the
   log-odds of a token without a feature (``DRIFT`` at least), so that a clean text drifts down. The scale of the
   extreme-value law is the positive root of sum(p * exp(scale * score)) = 1 over clean texts.
3. A logistic curve over the texts' evidence, fitted on the same sample.

Scoring, over all texts: one linear scan finds all maximal segments; a segment with sum S in a text of n tokens has
an expected number of chance segments of E = n * exp(-scale * S). Those with E <= ``E_MOST`` are passages, and the
text's evidence is the sum of -ln E over them.

Null and empty texts have no evidence. A text of any length is read whole, in linear time. Repeated rows are scored
alike. Rows without an id are scored, but are in no fold and teach nothing. Without labels of both kinds there are no
features and the score is the share of toxic labels (0.5 of no label counts on either side). An empty table gives no
rows. Other columns are left behind, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import texts
from xoutcome.session import stored

TRAIN_ROWS = 50_000
PRIOR = 0.5
ROOT_LEAST = 5.0
ODDS_LEAST = 1.5
OWN_TEXTS = 5
DRIFT = 0.02
E_MOST = 0.5
PREFIXES = (6, 5, 4, 3)
ALL = " all"  # counts all texts and tokens; no token has a space
TOKEN = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Scores of features (prefixes end in ``*``), drift, scale, and the logistic curve's parameters."""

    scores: dict[str, float] = field(default_factory=dict)
    drift: float = DRIFT
    scale: float = 1.0
    base: float = 0.0
    slope: float = 0.0

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.base + self.slope * evidence))))


def features_of(token: str) -> list[str]:
    return [token, *[token[:k] + "*" for k in PREFIXES if len(token) > k]]


def maximal_segments(items: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, last token, sum) of tokens with scores above zero (place, score);
    every token between costs ``drift``.

    Each segment knows the nearest earlier one that begins at a lower sum, so that the search for it follows links and
    visits a segment at most once before it is merged or passed over for good: linear in the number of items.
    """
    first, last, left, right, lower = [], [], [], [], []  # of open segments; lower: place of the nearest with a lower left sum
    total, at = 0.0, -1
    for place, score in items:
        total -= drift * (place - at - 1)
        at = place
        begin, l, r = place, total, total + score
        total = r
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= l:
                j = lower[j]
            if j < 0 or right[j] >= r:
                break
            begin, l = first[j], left[j]
            del first[j:], last[j:], left[j:], right[j:], lower[j:]
        first.append(begin)
        last.append(place)
        left.append(l)
        right.append(r)
        lower.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(first, last, left, right)]


class TokenScores(dict):
    """Scores of tokens, 0 without a feature; the first ``limit`` different ones are remembered."""

    def __init__(self, scores: dict[str, float], limit: int = 50_000):
        super().__init__()
        self.scores, self.limit = scores, limit

    def __missing__(self, token: str) -> float:
        found = self.scores.get(token)
        if found is None:
            found = next((s for k in PREFIXES if len(token) > k and (s := self.scores.get(token[:k] + "*")) is not None), 0.0)
        if len(self) < self.limit and len(token) < 100:
            self[token] = found
        return found


def passages_of(text: str, model: Model, known: TokenScores | None = None) -> tuple[float, list[dict]]:
    """The evidence of a text and its passages as character spans."""
    low = text.lower()
    if not model.scores or not low:
        return 0.0, []
    known = TokenScores(model.scores) if known is None else known
    tokens = TOKEN.findall(low)
    hits = [(i, s) for i, t in enumerate(tokens) if (s := known[t]) > 0]
    if not hits:
        return 0.0, []
    evidence, found = 0.0, []
    spans = [m.span() for m in TOKEN.finditer(low)]
    for first, last, total in maximal_segments(hits, model.drift):
        log_e = math.log(len(tokens)) - model.scale * total
        if log_e <= math.log(E_MOST):
            evidence -= log_e
            found.append({"begin": spans[first][0], "end": spans[last][1], "sum": total, "log_e": log_e})
    return evidence, found


def _training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled texts; the bound makes the labels' side one to broadcast."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _solved(chances: list[tuple[float, float]]) -> float:
    """The positive root of sum(p * exp(x * s)) = 1 for scores with a negative mean."""
    def over(x: float) -> bool:
        return sum(p * math.exp(min(700.0, x * s)) for p, s in chances) > 1
    low, high = 0.0, 1.0
    while not over(high) and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return max(low, 1e-3)


def _odds(d0: float, d1: float, n0: int, n1: int) -> tuple[float, float]:
    """Log-odds, and their standard error, of a feature in ``d0`` of ``n0`` clean and ``d1`` of ``n1`` toxic texts."""
    cells = [d1 + PRIOR, max(n1 - d1, 0) + PRIOR, d0 + PRIOR, max(n0 - d0, 0) + PRIOR]
    return math.log(cells[0] / cells[1]) - math.log(cells[2] / cells[3]), math.sqrt(sum(1 / c for c in cells))


def _leans(d0: float, d1: float, n0: int, n1: int) -> bool:
    odds, error = _odds(d0, d1, n0, n1)
    return odds - 1.96 * error >= ODDS_LEAST


def _chosen(counted: DataFrame, all_) -> tuple[dict[str, tuple[int, int]], dict[str, tuple[int, int]]]:
    """Occurrences in clean and toxic texts: of the kept features without the longer kept ones, and in full of the kept
    features and of the words that begin like one but have counts of their own.

    Only features with the ratio alone come to the driver, far fewer than the sample's distinct words.
    """
    share = all_["d1"] / (all_["d0"] + all_["d1"])
    n = F.col("d0") + F.col("d1")
    part = lambda x, p: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (n * p))).otherwise(0.0)
    ratio = 2 * (part("d1", share) + part("d0", 1 - share))
    rows = counted.where((F.col("d1") > n * share) & (ratio >= ROOT_LEAST ** 2)).collect()
    left = {r["feature"]: np.array([r["d0"], r["d1"], r["c0"], r["c1"]], float) for r in rows}
    whole = dict(left)
    kept: dict[str, tuple[int, int]] = {}

    def above(feature: str) -> list[str]:
        word = feature.rstrip("*")
        return [word[:k] + "*" for k in PREFIXES if len(word) > k]
    size = lambda f: (len(f), f) if f.endswith("*") else (math.inf, f)
    for length in sorted({size(f)[0] for f in left}, reverse=True):  # whole words first, then from long starts to short ones
        for f in sorted(f for f in left if size(f)[0] == length):
            d0, d1, c0, c1 = np.maximum(left[f], 0)
            if _leans(*whole[f][:2], all_["d0"], all_["d1"]) and _odds(d0, d1, all_["d0"], all_["d1"])[0] >= ODDS_LEAST:
                kept[f] = (int(c0), int(c1))
                for up in above(f):
                    if up in left:
                        left[up] = left[up] - left[f]
    starts = {f[:-1] for f in kept if f.endswith("*")}
    longer = F.lit(False)
    for k in PREFIXES:
        longer |= F.substring("feature", 1, k).isin(sorted(p for p in starts if len(p) == k))
    words = counted.where(~F.col("feature").endswith("*") & longer).collect() if starts else []
    further = {r["feature"]: (r["c0"], r["c1"]) for r in words if r["feature"] not in kept}
    return kept, {**{f: (int(whole[f][2]), int(whole[f][3])) for f in kept}, **further}


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``labels`` (doc_id, toxic) over ``docs`` (doc_id, text)."""
    sample = _training(docs, labels, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = [Counter() for _ in range(4)]  # texts and occurrences, clean and toxic
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = TOKEN.findall(text.lower())
                own = Counter()
                for t, n in Counter(tokens).items():
                    for f in features_of(t):
                        own[f] += n
                own[ALL] = len(tokens)
                side = 2 * (toxic > 0)
                by[side].update(own.keys())
                by[side + 1].update(own)
            keys = list({k for c in by for k in c})
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array([c[k] for k in keys], pa.int64()) for c in by)],
                                             names=["feature", "d0", "c0", "d1", "c1"])

    counts = ["d0", "c0", "d1", "c1"]
    counted = stored(sample.mapInArrow(count, "feature string, d0 long, c0 long, d1 long, c1 long").groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in counts]).where(F.col("d0") + F.col("d1") >= OWN_TEXTS), "features")
    all_ = counted.where(F.col("feature") == ALL).first()
    if all_ is None or not all_["d0"] or not all_["d1"]:
        n0, n1 = (all_["d0"], all_["d1"]) if all_ else (0, 0)
        return Model(base=math.log((n1 + PRIOR) / (n0 + PRIOR)))
    own, full = _chosen(counted.where(F.col("feature") != ALL), all_)
    scores = {f: math.log((c1 + PRIOR) / (all_["c1"] + PRIOR)) - math.log((c0 + PRIOR) / (all_["c0"] + PRIOR)) for f, (c0, c1) in full.items()}
    # A kept feature's counts are those of its own tokens: longer kept features are taken out of it.
    share = [[x[k] / max(1, all_[c]) for x in own.values()] for k, c in enumerate(("c0", "c1"))]
    drift = max(DRIFT, math.log(max(1e-6, 1 - min(0.5, sum(share[0])))) - math.log(max(1e-6, 1 - min(0.5, sum(share[1])))))
    chances = [((c0 + PRIOR) / max(1, all_["c0"]), scores[f]) for f, (c0, _) in own.items() if scores[f] > 0]
    model = Model(scores, drift, _solved([*chances, (max(0.0, 1 - sum(p for p, _ in chances)), -drift)]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.scores)
        for batch in batches:
            values = [round(min(passages_of(t, model, known)[0], 100.0)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), batch.column(1).cast(pa.int64())], names=["evidence", "toxic"])

    bins = sample.mapInArrow(gather, "evidence long, toxic long").groupBy("evidence").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("k")).collect()  # 101 rows at most
    base, slope = _logistic(*(np.array([b[c] for b in bins], float) for c in ("evidence", "n", "k")))
    return Model(scores, drift, model.scale, base, slope)


def _logistic(x: np.ndarray, n: np.ndarray, k: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Base and slope of a logistic curve for counts k of n, by Newton steps with a light ridge on the slope.

    The loss is convex, but where evidence tells the kinds apart a whole step may throw the curve to its flat ends and
    never come back. So a step is halved until the loss falls.
    """
    w = np.array([math.log((k.sum() + PRIOR) / (n.sum() - k.sum() + PRIOR)), 0.0])
    design = np.column_stack([np.ones_like(x), x])

    def loss(w: np.ndarray) -> float:
        at = design @ w
        return float((n * np.logaddexp(0, at) - k * at).sum() + ridge / 2 * w[1] ** 2)
    least = loss(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (k - n * p) - np.array([0, ridge]) * w
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-6, ridge])
        step = np.linalg.solve(curve, gradient)
        while (now := loss(w + step)) >= least and np.abs(step).max() > 1e-9:
            step = step / 2
        if now >= least:
            break
        w, least = w + step, now
    return float(w[0]), float(max(0.0, w[1]))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, passages) of every row; a passage has its character span, sum and ln E."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.scores)
        span = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("sum", pa.float64()), ("log_e", pa.float64())])
        for batch in batches:
            found = [passages_of(t, model, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.probability(e) for e, _ in found], pa.float64()),
                                              pa.array([p for _, p in found], pa.list_(span))], names=["doc_id", "score", "passages"])
    return texts(df, id_col, text_col).mapInArrow(
        run, "doc_id long, score double, passages array<struct<begin: long, end: long, sum: double, log_e: double>>")


def fold(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, mod 5; a null id is in no fold."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages); learns from labels of folds 1 to 4 only."""
    model = fit(texts(documents), labels.where(fold() != 0).select(F.col("doc_id").cast("long"), "toxic"))
    return score(documents, model).select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                                          (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def without_toxic(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, in all their columns, with a score below 0.5 under a model learned as in ``toxicity``."""
    model = fit(texts(documents, id_col, text_col), labels.where(fold() != 0).select(F.col("doc_id").cast("long"), "toxic"))
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.scores)
        for batch in batches:
            yield batch.filter(pa.array([model.probability(passages_of(t or "", model, known)[0]) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))
    return documents.mapInArrow(run, documents.schema)
