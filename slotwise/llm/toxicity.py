"""Toxic spans by a linear-chain conditional random field, and a score per document from its marginals.

Tokens are runs of letters, digits and characters beyond ASCII; characters of three or four bytes (scripts without
spaces among them) are a token each. Features of a token are its first 4, 5, 6 and 8 bytes and all of it; a wide
character's go on into the two characters after it, so they are its n-grams and every byte of a text is in one.

Labels exist for documents, so tokens are labelled from them: a token of a toxic document is toxic
if one of its features is far more frequent in toxic than in clean training documents; all other
tokens are not. The field has two tags, weights for the features,
a bias, four transitions and two starts, fitted by gradient steps on windows around tokens that have
features. Forward-backward marginals of these tokens add up to a document's evidence, which
a logistic curve, fitted on training documents the field has not seen, turns into the score.

Tokens without a known feature all have the same potentials, so a run of them is one power of
one 2 x 2 matrix: marginals are those of the whole text, at the cost of its few telling tokens.

Fitting is bounded by parameters: ``sample`` labelled documents of each class of at most ``sample_bytes`` bytes, those
with the smallest hash of doc_id; ``most_features`` features, the most telling; windows around ``most_telling`` telling
tokens and ``most_other`` others, evenly over the sample. Scoring reads every whole text, without a shuffle.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.text import LOWER, U64, mixed, pair_hash, slices, span_hashes, text_bytes, word_spans
from slotwise.session import materialise

SAMPLE = 2_000
SAMPLE_BYTES = 20_000
FEATURES = 5_000
TELLING, OTHER = 5_000, 2_000
LENGTHS = (4, 5, 6, 8)
WINDOW = 5  # tokens on each side of a telling token
THRESHOLD = 0.7
STEPS = 100
PART_BYTES = 1 << 18  # of the sample's texts read at a time: the fit runs on the driver

# Tokens are runs of letters, digits and bytes beyond ASCII.
TOKEN = np.zeros(256, bool)
TOKEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], U64)


def tokens(buffer: np.ndarray, offsets: np.ndarray):
    """Begin, end, tokens before each text, the first eight bytes of each token and where its features end, A-Z lowered;
    and the lowered bytes."""
    n = int(offsets[-1])
    lowered = buffer.copy()
    lowered[:n] = LOWER[buffer[:n]]
    begin, end, first = word_spans(lowered, offsets, TOKEN)
    reach = end
    if n and int(lowered[:n].max()) >= 0xE0:
        points = np.flatnonzero(((lowered[:n] & 0xC0) != 0x80) & TOKEN[lowered[:n]])
        run = np.searchsorted(begin, points, "right") - 1
        wide = lowered[points] >= 0xE0
        starts = np.flatnonzero((points == begin[run]) | wide | np.concatenate([[False], wide[:-1]]))
        stop, third = end[run[starts]], np.append(points, [n, n, n])[starts + 3]
        begin = points[starts]
        end = np.minimum(np.append(begin[1:], n), stop)
        reach = np.where(wide[starts], np.minimum(third, stop), end)
        first = np.searchsorted(begin, offsets)
    lanes = np.ndarray((n + 1,), "<u8", lowered, strides=(1,))
    return begin, end, first, lanes[begin] & _MASK[np.minimum(reach - begin, 8)], reach, lowered


def feature_lists(head: np.ndarray, whole: np.ndarray):
    """One hash per token: of each prefix length in turn, then of the whole token."""
    for k in LENGTHS:
        yield mixed((head & _MASK[k]) ^ U64(0x9E3779B97F4A7C15 * k % (1 << 64)))
    yield mixed(whole ^ U64(0x632BE59BD9B4E019))


def features(head: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """All of them: shape (lengths + 1, tokens)."""
    return np.stack(list(feature_lists(head, whole)))


def _filter(values: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 16, bool)
    table[values & U64(0xFFFF)] = True
    return table


def _find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(values.shape, -1)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return np.where(known[at] == values, at, -1)


# --- the field ------------------------------------------------------------------------------------


class _Field:
    """Potentials of the two-tag chain; tag 1 is toxic. ``theta[0]`` belongs to no feature and stays 0."""

    def __init__(self, n: int):
        self.theta, self.bias = np.zeros(n + 1), -2.0
        self.move, self.start = np.zeros((2, 2)), np.zeros(2)

    def fit(self, ids: np.ndarray, tags: np.ndarray, here: np.ndarray, steps: int = STEPS, rate: float = 0.1, ridge: float = 1e-3):
        """``ids`` (sequence, token, lengths) of features + 1, ``tags`` and presence (sequence, token)."""
        values = [self.theta, np.array([self.bias]), self.move, self.start]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        for step in range(1, steps + 1):
            self.theta, self.bias, self.move, self.start = values[0], values[1][0], values[2], values[3]
            for v, g, m, s in zip(values, self._gradient(ids, tags, here, ridge), first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            values[0][0] = 0.0
        self.theta, self.bias, self.move, self.start = values[0], float(values[1][0]), values[2], values[3]

    def _gradient(self, ids, tags, here, ridge):
        """Of the mean negative log-likelihood: expected minus observed counts, from forward-backward."""
        n, length = tags.shape
        e = np.zeros((n, length, 2))
        e[:, :, 1] = np.where(here, self.theta[ids].sum(axis=2) + self.bias, 0)
        alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        alpha[:, 0] = self.start + e[:, 0]
        for t in range(1, length):
            through = np.logaddexp(alpha[:, t - 1, :1] + self.move[0], alpha[:, t - 1, 1:] + self.move[1]) + e[:, t]
            alpha[:, t] = np.where(here[:, t, None], through, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            on = beta[:, t + 1] + e[:, t + 1]
            through = np.logaddexp(self.move[:, 0] + on[:, :1], self.move[:, 1] + on[:, 1:])
            beta[:, t] = np.where(here[:, t + 1, None], through, beta[:, t + 1])
        log_z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p = np.exp(alpha + beta - log_z[:, None, None])[:, :, 1]
        gap = np.where(here, p - tags, 0)
        theta = np.bincount(ids.ravel(), np.repeat(gap.ravel(), ids.shape[2]), len(self.theta)) / n + ridge * self.theta
        move = ridge * self.move
        for t in range(1, length):
            both = alpha[:, t - 1, :, None] + self.move + (e[:, t] + beta[:, t])[:, None, :]
            pairs = np.exp(both - log_z[:, None, None]) * here[:, t, None, None]
            move = move + pairs.sum(axis=0) / n
            seen = np.bincount((2 * tags[:, t - 1] + tags[:, t])[here[:, t]], minlength=4).reshape(2, 2)
            move = move - seen / n
        start = np.array([np.mean(1 - p[:, 0]) - np.mean(tags[:, 0] == 0), np.mean(p[:, 0]) - np.mean(tags[:, 0] == 1)]) + ridge * self.start
        return theta, np.array([gap.sum() / n]), move, start

    def plain(self) -> dict:
        """Numbers for the workers; the matrix of a token without features is scaled to have a bounded power."""
        step = np.exp(self.move + np.array([0.0, self.bias]))
        step /= np.abs(np.linalg.eigvals(step)).max()
        powers = [np.eye(2)]
        for _ in range(512):  # by then a power no longer changes
            powers.append(powers[-1] @ step)
        return {
            "theta": self.theta[1:], "bias": self.bias, "powers": [p.ravel().tolist() for p in powers],
            "move": np.exp(self.move).ravel().tolist(), "start": np.exp(self.start).tolist(),
        }


def marginals(places: list[int], energy: list[float], length: int, field: dict) -> list[float]:
    """P(toxic) of the telling tokens at ``places`` of a text of ``length`` tokens, given their feature sums."""
    powers, (m00, m01, m10, m11), (s0, s1) = field["powers"], field["move"], field["start"]
    plain_toxic = np.exp(field["bias"])
    toxic = [float(np.exp(min(x + field["bias"], 500.0))) for x in energy]
    last = len(powers) - 1

    def over(a, b, gap):
        p = powers[min(gap, last)]
        return a * p[0] + b * p[2], a * p[1] + b * p[3]

    forward, at, a, b = [], -1, s0, s1
    for place, f in zip(places, toxic):
        if at < 0:
            if place:  # the first token carries the start instead of a move
                a, b = over(a, b * plain_toxic, place - 1)
                a, b = a * m00 + b * m10, a * m01 + b * m11
        else:
            a, b = over(a, b, place - at - 1)
            a, b = a * m00 + b * m10, a * m01 + b * m11
        b *= f
        total = a + b
        a, b = a / total, b / total
        forward.append((a, b))
        at = place
    out, at, x, y = [0.0] * len(places), length, 1.0, 1.0
    for k in range(len(places) - 1, -1, -1):
        p = powers[min(at - places[k] - 1, last)]
        x, y = p[0] * x + p[1] * y, p[2] * x + p[3] * y
        a, b = forward[k]
        out[k] = b * y / (a * x + b * y)
        y *= toxic[k]
        x, y = m00 * x + m01 * y, m10 * x + m11 * y
        total = x + y
        x, y = x / total, y / total
        at = places[k]
    return out


# --- fitting --------------------------------------------------------------------------------------


def _parts(texts: list[str]):
    """First eight bytes and hash of every token, and tokens before each text: a part of the texts at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    for piece in slices(batch, "text", PART_BYTES):
        buffer, offsets = text_bytes(piece.column("text"))
        begin, _, first, head, reach, lowered = tokens(buffer, offsets)
        yield head, span_hashes(lowered, begin, reach), first


def _frequencies(texts: list[str], toxic: np.ndarray, least: int = 3):
    """Features that ``least`` toxic texts have, with the numbers of toxic and of clean texts that have them."""
    known, bad = np.empty(0, U64), np.empty(0)
    for some in _features_of([t for t, x in zip(texts, toxic) if x]):
        values, inverse = np.unique(np.concatenate([known, some]), return_inverse=True)
        bad = np.bincount(inverse, np.concatenate([bad, np.ones(len(some))]), len(values))
        known = values
    known, bad = known[bad >= least], bad[bad >= least]
    good = np.zeros(len(known))
    for some in _features_of([t for t, x in zip(texts, toxic) if not x]):
        at = _find(known, some)
        good += np.bincount(at[at >= 0], minlength=len(known))
    return known, bad, good


def _features_of(texts: list[str]):
    """The features of the texts, each once a text; a kind of feature of a part at a time."""
    for head, whole, first in _parts(texts):
        doc = np.repeat(np.arange(len(first) - 1).astype(U64), np.diff(first))
        for values in feature_lists(head, whole):
            yield values[np.unique(pair_hash(values, doc), return_index=True)[1]]


def _fit_field(texts: list[str], toxic: np.ndarray, most_features: int, most_telling: int, most_other: int) -> dict:
    """Known features, the first hashes of the tokens that have one, and the fitted field.

    Only tokens that have a known feature keep their numbers; of the others it is known where they are.
    """
    known, bad, good = _frequencies(texts, toxic)
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 1) / ((~toxic).sum() + 1))
    least = odds - np.sqrt(1 / (bad + 0.5) + 1 / (good + 1))  # lower bound, so that rare chances stay out
    pick = np.flatnonzero(least > 1)
    pick = np.sort(pick[np.lexsort((known[pick], -odds[pick] * np.sqrt(bad[pick])))][:most_features])
    strong, known = odds[pick] > 2.5, known[pick]
    field = _Field(len(known))
    ids, heads, row, first = [np.zeros((1, len(LENGTHS) + 1), np.int32)], [np.empty(0, U64)], [], [np.zeros(1, np.int64)]
    for head, whole, before in _parts(texts):
        here = np.stack([(_find(known, h) + 1).astype(np.int32) for h in feature_lists(head, whole)], axis=1)
        has = (here > 0).any(axis=1)
        ids.append(here[has])
        heads.append(np.unique(next(feature_lists(head[has], whole[has]))))
        row.append(has)
        first.append(first[-1][-1] + before[1:])
    ids, has, first = np.concatenate(ids), np.concatenate(row), np.concatenate(first)
    telling, rest = np.flatnonzero(has).astype(np.int32), np.flatnonzero(~has).astype(np.int32)
    if len(telling):
        row = np.zeros(len(has), np.int32)  # of ``ids``; the first belongs to all tokens without a feature
        row[telling] = np.arange(1, len(telling) + 1)
        tag = np.append(False, strong)[ids].any(axis=1)
        tag[1:] &= toxic[np.searchsorted(first, telling, "right") - 1]
        centre = np.concatenate([telling[:: -(-len(telling) // most_telling)], rest[:: max(1, -(-len(rest) // most_other))]])
        doc = np.searchsorted(first, centre, "right") - 1
        span = centre[:, None] + np.arange(-WINDOW, WINDOW + 1)
        here = (span >= first[doc][:, None]) & (span < first[doc + 1][:, None])
        order = np.argsort(~here, axis=1, kind="stable")  # tokens that exist come first
        inside = row[np.take_along_axis(np.clip(span, 0, len(has) - 1), order, 1)]
        here = np.take_along_axis(here, order, 1)
        field.fit(np.where(here[:, :, None], ids[inside], 0), np.where(here, tag[inside], 0).astype(np.int64), here)
    return {"known": known, "heads": np.unique(np.concatenate(heads)), "field": field.plain()}


def fit(
    texts: list[str], toxic: list[int], shares: tuple[float, float], most_features: int = FEATURES, most_telling: int = TELLING, most_other: int = OTHER
) -> dict:
    """A model from labelled texts; ``shares``: weight of a clean and of a toxic text in the calibration.

    The curve is fitted on evidence from fields that have not seen the text: one half scores the other.
    """
    bounds = (most_features, most_telling, most_other)
    toxic = np.array(toxic, bool)
    weight = np.where(toxic, shares[1], shares[0])
    prior = (weight[toxic].sum() + 0.5) / (weight.sum() + 10)
    model = {"known": np.empty(0, U64), "heads": np.empty(0, U64), "field": _Field(0).plain(), "curve": (float(np.log(prior / (1 - prior))), 0.0, 0.0)}
    half = np.zeros(len(texts), bool)
    for label in (False, True):
        half[np.flatnonzero(toxic == label)[::2]] = True
    if min(np.count_nonzero(toxic), np.count_nonzero(~toxic)) < 2:
        return model
    evidence = np.zeros((len(texts), 2))
    for learn in (half, ~half):
        part = _fit_field([t for t, x in zip(texts, learn) if x], toxic[learn], *bounds)
        rest = pa.RecordBatch.from_arrays([pa.array([t for t, x in zip(texts, learn) if not x], pa.large_string())], ["text"])
        pieces = slices(rest, "text", PART_BYTES)
        evidence[~learn] = [e for piece in pieces for e, _, _ in _evidence(*text_bytes(piece.column("text")), part)]
    return model | _fit_field(texts, toxic, *bounds) | {"curve": _logistic(evidence, toxic, weight)}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Intercept and slopes by Newton steps, with a small ridge and slopes kept from falling below 0."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(curve, x.T @ (weight * (p - y)) + 0.1 * w)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(float(v) for v in w)


# --- scoring --------------------------------------------------------------------------------------


def _evidence(buffer: np.ndarray, offsets: np.ndarray, model: dict):
    """For each text: (log of 1 + summed squares of distinct tokens' marginals, largest marginal), spans in bytes, their marginals."""
    begin, end, first, head, reach, lowered = tokens(buffer, offsets)
    known = model["known"]
    short = mixed((head & _MASK[LENGTHS[0]]) ^ U64(0x9E3779B97F4A7C15 * LENGTHS[0] % (1 << 64)))
    maybe = np.flatnonzero(_filter(model["heads"])[short & U64(0xFFFF)])
    whole = span_hashes(lowered, begin[maybe], reach[maybe])
    at = np.stack([_find(known, h) for h in features(head[maybe], whole)])
    has = (at >= 0).any(axis=0)
    telling, at, whole = maybe[has], at[:, has], whole[has]
    theta = model["field"]["theta"]
    energy = np.where(at >= 0, theta[at] if len(theta) else 0.0, 0.0).sum(axis=0)
    cut = np.searchsorted(telling, first)
    for d in range(len(offsets) - 1):
        lo, hi = int(cut[d]), int(cut[d + 1])
        if lo == hi:
            yield (0.0, 0.0), [], []
            continue
        mine = telling[lo:hi]
        p = marginals((mine - first[d]).tolist(), energy[lo:hi].tolist(), int(first[d + 1] - first[d]), model["field"])
        best = {}  # a token that comes again and again is evidence once
        for word, q in zip(whole[lo:hi].tolist(), p):
            best[word] = max(q, best.get(word, 0.0))
        yield (float(np.log1p(sum(q * q for q in best.values()))), max(p)), list(zip(begin[mine].tolist(), end[mine].tolist())), p


def chance(evidence: tuple[float, float], curve: tuple[float, ...]) -> float:
    z = curve[0] + sum(a * b for a, b in zip(curve[1:], evidence))
    return 1 / (1 + float(np.exp(-min(max(z, -30), 30))))


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))),
    ]
)


def _score(batches, model: dict):
    for batch in batches:
        for piece in slices(batch, "text"):
            buffer, offsets = text_bytes(piece.column("text"))
            scores, spans = [], []
            for d, (x, where, p) in enumerate(_evidence(buffer, offsets, model)):
                scores.append(chance(x, model["curve"]))
                found = []
                for (a, b), q in zip(where, p):
                    if q >= 0.5:  # offsets count code points: bytes that do not continue a character
                        low = int(np.count_nonzero(buffer[offsets[d] : a] & 0xC0 != 0x80))
                        found.append({"begin": low, "end": low + int(np.count_nonzero(buffer[a:b] & 0xC0 != 0x80)), "probability": q})
                spans.append(found)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, _OUT.field("spans").type)], schema=_OUT)


def fold_of(doc_id, folds: int = 3):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def fit_on_labels(
    docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, **bounds: int
) -> dict:
    """A model from the labels of documents whose crc32(doc_id as text) mod ``folds`` is not ``fold``.

    Null labels and null doc_ids are left out; a document with several labels is toxic if one is. The sample is
    taken from documents within ``sample_bytes``, so a longer one gives its place to another.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != fold))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes))
    open_ = materialise(usable.join(texts.select("id"), "id", "left_semi"), "labelled")
    picked = None
    for label in (0, 1):
        part = open_.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    rows = texts.join(F.broadcast(picked), "id")  # at most 2 * sample rows of two numbers
    rows = rows.groupBy("id").agg(F.max("label").alias("label"), F.max("text").alias("text")).orderBy(F.xxhash64("id", F.lit(1)), "id")
    found = rows.collect()
    seen = {k: max(1, sum(r["label"] == k for r in found)) for k in (0, 1)}
    shares = tuple(counts.get(k, 0) / seen[k] for k in (0, 1))
    model = fit([r["text"] for r in found], [r["label"] for r in found], shares, **bounds)
    pa.default_memory_pool().release_unused()  # the driver goes on to other work
    return model


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """``doc_id, score, predicted, spans``: one row per input row; spans are code point offsets, end exclusive.

    ``docs`` needs doc_id and text; only the text enters a score. Null and empty texts get the
    score of a text without telling tokens. Without labels of both classes every document gets
    the (smoothed) share of toxic labels. Repeated rows each get a row. Other columns are ignored.
    """
    return apply_model(docs, fit_on_labels(docs, labels, **settings), threshold)


def apply_model(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(partial(_score, model=model), "doc_id long, score double, spans array<struct<begin: long, end: long, probability: double>>")
    return out.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def _clean(batches, model: dict, threshold: float):
    for batch in batches:
        for piece in slices(batch, "text"):
            keep = [chance(x, model["curve"]) < threshold for x, _, _ in _evidence(*text_bytes(piece.column("text")), model)]
            yield piece.filter(pa.array(keep, pa.bool_()))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are; nothing is shuffled."""
    model = fit_on_labels(docs, labels, **settings)
    return docs.mapInArrow(partial(_clean, model=model, threshold=threshold), docs.schema)
