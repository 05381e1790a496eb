"""Text quality by a generalised additive model with pairwise interactions.

``fit`` learns one lookup table per feature by cyclic boosting: in every round
each feature in turn gets a shallow tree on its bins, fitted to the current
gradient and added to its table with a small rate.  The pairs of features that
explain most of what is left then get two-way tables the same way.  ``score``
is a sum of table entries, vectorised over a batch of documents.

Only the text is an input of a score.  Training reads a bounded sample of the
labelled rows (``max_rows``, those with the smallest hash of doc_id); scoring
reads every whole text.

Defined results: null text is an empty text (its features are zero); rows without a
label, with a null label or a null doc_id are not learnt from; several labels
of one doc_id count as the one most of them give (1 where even); with no labels at all, or labels of one
kind, every score is the share of label 1 (0.5 without labels); repeated rows are scored once per
row; an empty table gives no rows; extra columns are ignored by ``score``
and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.llm.common import SUB_ROWS, arrow_map, ship

THRESHOLD = 0.3
MAX_ROWS = 40_000     # labelled rows learnt from, at most
BINS = 48             # bins of a feature, at most
PAIR_BINS = 8         # bins of a feature inside a pair
PAIRS = 8             # pairs kept
ROUNDS = 120          # passes over all features
PAIR_ROUNDS = 60      # passes over all pairs
LEAVES = 4            # leaves of a feature's tree
RATE = 0.15
SMOOTH = 5.0          # added to the hessian of a leaf
SHOW = 30             # rows of a tree's leaf, at least

FEATURES = [
    "log_chars", "log_words", "mean_word", "longest_word", "letters", "upper", "digits", "spaces", "stops",
    "loud", "symbols", "bars", "other_marks", "high_bytes", "word_end_symbols", "title_words",
    "distinct_words", "log_lines", "mean_line", "distinct_lines", "repeated_line_chars", "no_stop_lines",
    "top_word", "short_words",
]


def features(texts: list[str | None]):
    """Feature matrix, one row per text, computed from the whole text."""
    import numpy as np

    classes = np.zeros(256, np.int64)
    for k, chars in enumerate([b"", range(97, 123), range(65, 91), b"0123456789", b" \t\r\n\x0b\x0c",
                               b".,;:'\"()?-", b"!", b"*$%#&@^~_=+<>{}[]\\/", b"|", range(128, 256)]):
        classes[list(chars)] = k
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if not raw:
            continue
        n = len(raw)
        count = np.bincount(classes, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 10) / n
        words = raw.split()
        w = max(1, len(words))
        lines = [x for x in raw.split(b"\n") if x]
        m = max(1, len(lines))
        kinds, distinct = Counter(words), set(lines)
        lengths = [len(x) for x in words]
        out[i] = [
            np.log1p(n), np.log1p(len(words)), sum(lengths) / w, min(200, max(lengths, default=0)),
            count[1], count[2], count[3], count[4], count[5], count[6], count[7], count[8], count[0],
            count[9], sum(x[-1] in _SYMBOLS for x in words) / w, sum(x.istitle() for x in words) / w,
            len(kinds) / w, np.log1p(len(lines)), n / m, len(distinct) / m,
            1 - sum(map(len, distinct)) / max(1, sum(map(len, lines))),
            sum(x.rstrip()[-1:] not in _ENDS for x in lines) / m,
            max(kinds.values(), default=0) / w, sum(x < 4 for x in lengths) / w,
        ]
    return out


_SYMBOLS = frozenset(b"*$%#&@!|~^=")
_ENDS = (b".", b"!", b"?", b":", b'"')


@dataclass
class Model:
    base: float
    cuts: list            # per feature: ascending bin borders
    tables: list          # per feature: one value per bin
    pair_cuts: list       # per pair: (feature, borders, feature, borders)
    pair_tables: list     # per pair: matrix of values

    def score(self, x):
        """Probability of label 1 for rows of features."""
        import numpy as np

        z = np.full(len(x), self.base)
        for f, (cuts, values) in enumerate(zip(self.cuts, self.tables)):
            z += values[np.searchsorted(cuts, x[:, f], side="right")]
        for (f, a, g, b), values in zip(self.pair_cuts, self.pair_tables):
            z += values[np.searchsorted(a, x[:, f], side="right"), np.searchsorted(b, x[:, g], side="right")]
        return 1 / (1 + np.exp(-z))


def _borders(v, bins: int):
    import numpy as np

    q = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
    return q[q > v.min()]


def _tree(grad, hess, rows, leaves: int):
    """A shallow tree over ordered bins: the best ``leaves`` runs, split
    greedily by gain; returns the step of every bin."""
    import numpy as np

    g, h, r = (np.r_[0.0, np.cumsum(x)] for x in (grad, hess, rows))
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + SMOOTH)

    def best(a, b):
        if b - a < 2:
            return None
        at = np.arange(a + 1, b)
        gain = value(a, at) + value(at, b) - value(a, b)
        gain[(r[at] - r[a] < SHOW) | (r[b] - r[at] < SHOW)] = -1
        k = int(gain.argmax())
        return (gain[k], int(at[k])) if gain[k] > 0 else None

    runs = [(0, len(grad))]
    while len(runs) < leaves:
        found = [(s[0], s[1], run) for run in runs if (s := best(*run))]
        if not found:
            break
        _, at, (a, b) = max(found)
        runs.remove((a, b))
        runs += [(a, at), (at, b)]
    step = np.zeros(len(grad))
    for a, b in runs:
        step[a:b] = -(g[b] - g[a]) / (h[b] - h[a] + SMOOTH)
    return step


def _quadrants(grad, hess, rows):
    """A shallow tree on a grid: the best cut of each axis, four cells; returns
    the step of every cell and its gain."""
    import numpy as np

    corner = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    g, h, r = corner(grad), corner(hess), corner(rows)
    p, q = g.shape[0] - 1, g.shape[1] - 1
    if p < 2 or q < 2:
        return np.zeros_like(grad), 0.0
    i, j = np.arange(1, p)[:, None], np.arange(1, q)[None, :]

    def four(x):
        tl, top, lft, all_ = x[i, j], x[i, q], x[p, j], x[p, q]
        return [tl, top - tl, lft - tl, all_ - top - lft + tl]

    gs, hs, rs = four(g), four(h), four(r)
    gain = sum(a * a / (b + SMOOTH) for a, b in zip(gs, hs))
    gain = np.where(np.minimum.reduce(rs) >= SHOW, gain, 0)
    a, b = np.unravel_index(gain.argmax(), gain.shape)
    if gain[a, b] <= 0:
        return np.zeros_like(grad), 0.0
    step = np.zeros_like(grad)
    v = [-x[a, b] / (y[a, b] + SMOOTH) for x, y in zip(gs, hs)]
    step[:a + 1, :b + 1], step[:a + 1, b + 1:], step[a + 1:, :b + 1], step[a + 1:, b + 1:] = v
    return step, float(gain[a, b])


def train(x, y) -> Model:
    """Cyclic boosting on a feature matrix and 0/1 labels."""
    import numpy as np

    p = y.mean() if len(y) else 0.5
    k = x.shape[1]
    if not len(y) or p in (0.0, 1.0):
        p = min(max(p, 1e-3), 1 - 1e-3)
        return Model(float(np.log(p / (1 - p))), [np.zeros(0)] * k, [np.zeros(1)] * k, [], [])
    cuts = [_borders(x[:, f], BINS) for f in range(k)]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    base = float(np.log(p / (1 - p)))
    z = np.full(len(y), base)

    def slopes():
        s = 1 / (1 + np.exp(-z))
        return s - y, s * (1 - s)

    for _ in range(ROUNDS):
        for f in range(k):
            grad, hess = slopes()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], grad, size), np.bincount(bins[f], hess, size),
                                rows[f], LEAVES)
            tables[f] += step
            z += step[bins[f]]

    coarse = [_borders(x[:, f], PAIR_BINS) for f in range(k)]
    small = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]

    def grids(f, g, *values):
        shape = len(coarse[f]) + 1, len(coarse[g]) + 1
        at = small[f] * shape[1] + small[g]
        return [np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in values]

    one = np.ones(len(y))
    grad, hess = slopes()
    ranked = sorted(((_quadrants(*grids(f, g, grad, hess, one))[1], f, g)
                     for f in range(k) for g in range(f + 1, k)), key=lambda t: (-t[0], t[1:]))
    pairs = [(f, g) for gain, f, g in ranked[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)) for f, g in pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (f, g) in zip(pair_tables, pairs):
            grad, hess = slopes()
            step = RATE * _quadrants(*grids(f, g, grad, hess, one))[0]
            t += step
            z += step[small[f], small[g]]
    return Model(base, cuts, tables, [(f, coarse[f], g, coarse[g]) for f, g in pairs], pair_tables)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows kept out of training: crc32 of the doc_id's digits divides evenly."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Learn from labelled documents that are not held out, at most ``max_rows``
    (the smallest hashes of doc_id, whatever the corpus size)."""
    import numpy as np

    ship(docs.sparkSession)
    # labels per document first, so repeated rows on both sides cannot multiply
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out()) \
        .groupBy("doc_id").agg(F.sum("y").alias("ones"), F.count("y").alias("n"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(picked), "doc_id").select("doc_id", "ones", "n", "text")  # max_rows rows at most

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, SUB_ROWS):
                part = b.slice(s, SUB_ROWS)
                x = features(part.column(3).to_pylist()).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([r.tobytes() for r in x])],
                                                 names=["doc_id", "ones", "n", "x"])
    found = rows.mapInArrow(run, "doc_id long, ones long, n long, x binary") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(max_rows).collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in found]).reshape(-1, len(FEATURES)).astype(float)
    y = np.array([int(2 * r.ones >= r.n) for r in found], float)
    return train(x, y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""
    def run(batch):
        import numpy as np
        import pyarrow as pa

        x = features(batch.column(1).to_pylist()).astype(np.float32).astype(float)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("text").cast("string").alias("text")), run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, whole, that score at least ``threshold``."""
    at = docs.columns.index("text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, SUB_ROWS):
                part = b.slice(s, SUB_ROWS)
                x = features(part.column(at).to_pylist()).astype(np.float32).astype(float)
                yield part.filter(pa.array(model.score(x) >= threshold))
    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
