"""Operator 6, quality classifier by a sparse rule ensemble.

Statistics of a text (character classes, words, repetition) are computed whole,
in numpy blocks. Labelled rows, at most ``SAMPLE_ROWS`` of them in the order of a
hash of the id, are the training sample. Small boosted trees are grown on it;
every path from a root to a node is a conjunctive rule over the statistics; a
lasso logistic regression picks and weighs rules, its penalty chosen on a fifth
of the sample. The rules that keep a weight are compiled into one column
expression, so scoring is a projection with no join and no model object.

The score is between 0 and 1, higher where label 1 is likelier. Only statistics
of the text are inputs. Null and empty texts have statistics of 0 and get a
score too. Label rows with a null id, a null label or no document are not used; repeated
ones count each. Without labels of both kinds the score is one constant, the
smoothed share of label 1 (0.5 without any label). Empty tables give empty
results; extra columns of the documents are carried through or not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import keep_ids, stage

#: Most labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, SEED = 30, 3, 32, 11
#: A rule holds for at least this share of the sample, and for as much less than all of it.
LEAST_SUPPORT = 0.002
HOLD_OUT = 3  # rows whose crc32(id) modulo this is 1 are held out

STATISTICS = (
    "bytes", "words", "word_bytes", "longest_word", "upper", "digits", "symbols", "marks", "exclamations", "pipes", "other_bytes",
    "spaces", "lines", "line_words", "distinct_words", "twin_words", "top_word", "distinct_triples", "repeated_lines", "byte_entropy",
)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _LOWER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("abcdefghijklmnopqrstuvwxyz"), _class("0123456789")
_SYMBOL, _MARK, _SPACE = _class("#$%&*@^~<>{}[]\\=+_`/"), _class(".,;:?'\"()-"), _class(" \t\n\v\f\r")
_OTHER = np.arange(256) >= 128


def _distinct(value: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in each run [bound[i], bound[i + 1]), and how often its most frequent one occurs."""
    value, n = value.copy(), len(bound) - 1
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[bound[:-1][bound[:-1] < len(value)]] = True
    first = np.flatnonzero(new)
    owner = np.searchsorted(bound, first, side="right") - 1
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner, np.diff(np.append(first, len(value))))
    return np.bincount(owner, minlength=n), most


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a block."""
    n = len(bounds) - 1
    size = np.diff(bounds).astype(float)
    seen = np.zeros((n, 256))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        seen[i] = np.bincount(data[a:b], minlength=256)
    per = lambda table: seen @ table
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    w, h = K.word_hashes(data, bounds)
    count = w.per_text.astype(float)
    owner = np.repeat(np.arange(n), w.per_text)
    length = (w.end - w.start).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    distinct, most = _distinct(h, w.first)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    runs = np.maximum(w.per_text - 2, 0)
    at = K.ragged(w.first[:-1], runs)
    h = K.mix(h)
    triple = K.mix(h[at] + h[at + 1] * np.uint64(3) + h[at + 2] * np.uint64(5)) if len(at) else h[:0]
    triples, _ = _distinct(triple, np.concatenate([[0], np.cumsum(runs)]))
    upper, lower, spaces = per(_UPPER), per(_LOWER), per(_SPACE)
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([bounds[:-1][size > 0], breaks + 1, bounds[1:]]))
    line_start = line_start[line_start <= len(data)]
    ends = np.append(line_start[1:], len(data))[: len(line_start)]
    real = ends > line_start
    line_start, ends = line_start[real], ends[real]
    line_owner = np.searchsorted(bounds, line_start, side="right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    prefix = K.prefix_hash(data)
    bare = ends - (data[ends - 1] == 10) if len(ends) else ends
    kinds, _ = _distinct(K.span_hash(prefix, line_start, bare), np.concatenate([[0], np.cumsum(np.bincount(line_owner, minlength=n))]))
    p = np.divide(seen, size[:, None], out=np.zeros((n, 256)), where=size[:, None] > 0)
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    columns = (
        size, count, share(np.bincount(owner, length, n), count), longest, share(upper, upper + lower), share(per(_DIGIT), size), share(per(_SYMBOL), size),
        share(per(_MARK), size), share(per(_class("!")), size), share(per(_class("|")), size), share(per(_OTHER), size), share(spaces, size), lines,
        share(count, lines), share(distinct, count), share(np.bincount(owner[same], minlength=n), count), share(most, count),
        share(triples, np.maximum(count - 2, 0)), share(lines - kinds, lines), entropy,
    )
    return np.stack(columns, axis=1).astype(float) if n else np.zeros((0, len(STATISTICS)))


# Rules ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold): above means > threshold, else <=."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, above, threshold in self.terms:
            out &= (x[:, i] > threshold) if above else (x[:, i] <= threshold)
        return out

    def column(self, names: list[str]) -> Column:
        out = None
        for i, above, threshold in self.terms:
            term = F.col(names[i]) > F.lit(threshold) if above else F.col(names[i]) <= F.lit(threshold)
            out = term if out is None else out & term
        return out


@dataclass
class RuleModel:
    bias: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total += weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))

    def column(self, names: list[str]) -> Column:
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(names), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _tree_rules(binned: np.ndarray, edges: list[np.ndarray], target: np.ndarray, rng: np.random.Generator, depth: int):
    """Grow one least-squares tree; its paths, and the value of each row's leaf."""
    value = np.zeros(len(target))
    paths = []
    features = rng.permutation(len(edges))[: max(len(edges) * 2 // 3, 1)]
    open_ = [(np.arange(len(target)), ())]
    least = max(int(LEAST_SUPPORT * len(target)), 5)
    for level in range(depth + 1):
        below = []
        for rows, path in open_:
            value[rows] = target[rows].mean() if len(rows) else 0
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-9, None)
            total, n = target[rows].sum(), len(rows)
            for f in features:
                if not len(edges[f]):
                    continue
                b = binned[rows, f]
                left_n = np.cumsum(np.bincount(b, minlength=len(edges[f]) + 1))[:-1]
                left = np.cumsum(np.bincount(b, target[rows], minlength=len(edges[f]) + 1))[:-1]
                ok = (left_n >= least) & (n - left_n >= least)
                if not ok.any():
                    continue
                gain = np.where(ok, left**2 / np.maximum(left_n, 1) + (total - left) ** 2 / np.maximum(n - left_n, 1) - total**2 / n, -1)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (int(f), at))
            if best[1] is None:
                continue
            f, at = best[1]
            goes = binned[rows, f] <= at
            for above, part in ((False, rows[goes]), (True, rows[~goes])):
                longer = (*path, (f, above, float(edges[f][at])))
                paths.append(longer)
                below.append((part, longer))
        open_ = below
    return paths, value


def _simplify(path) -> Rule:
    terms: dict[tuple[int, bool], float] = {}
    for f, above, threshold in path:
        have = terms.get((f, above))
        terms[f, above] = threshold if have is None else (max if above else min)(have, threshold)
    return Rule(tuple(sorted((f, above, t) for (f, above), t in terms.items())))


def _lasso(x: np.ndarray, n: np.ndarray, positive: np.ndarray, penalty: float, start: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Logistic regression with an L1 penalty on all but the last column, by accelerated proximal steps.

    Row i of ``x`` stands for n[i] rows, positive[i] of them with label 1.
    """
    total = n.sum()
    largest = float(np.linalg.eigvalsh((x * n[:, None]).T @ x)[-1])
    step = 4 * total / max(largest, 1e-9)
    w, z, t = start.copy(), start.copy(), 1.0
    for _ in range(rounds):
        gradient = x.T @ (n / (1 + np.exp(-np.clip(x @ z, -40, 40))) - positive) / total
        new = z - step * gradient
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        moved, w, t = np.abs(new - w).max(), new, t_new
        if moved < 1e-4:
            break
    return w


def _loss(x, n, positive, w) -> float:
    m = np.clip(x @ w, -40, 40)
    return float((positive * np.log1p(np.exp(-m)) + (n - positive) * np.log1p(np.exp(m))).sum() / n.sum())


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, seed: int = SEED) -> RuleModel:
    """Rule ensemble for rows of statistics ``x`` and labels ``y`` (0 or 1)."""
    y = y.astype(float)
    prior = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return RuleModel(bias if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin, paths = np.full(len(y), bias), []
    for _ in range(trees):
        part = rng.permutation(len(y))[: max(len(y) // 2, min(len(y), 200))]
        residual = y - 1 / (1 + np.exp(-margin))
        found, value = _tree_rules(binned[part], edges, residual[part], rng, depth)
        paths += found
        margin[part] += 2.0 * value
    seen, rules, columns = set(), [], []
    for rule in dict.fromkeys(map(_simplify, paths)):
        holds = rule.holds(x)
        if LEAST_SUPPORT <= holds.mean() <= 1 - LEAST_SUPPORT and holds.tobytes() not in seen:
            seen |= {holds.tobytes(), (~holds).tobytes()}
            rules.append(rule)
            columns.append(holds)
    if not rules:
        return RuleModel(bias)
    a = np.stack(columns, axis=1)
    scale = a.std(axis=0)
    check = rng.permutation(len(y)) < max(len(y) // 5, 1)

    def fold(rows):
        """Design, row counts and positives of the distinct rule patterns of some rows."""
        packed, first, inverse = np.unique(np.packbits(a[rows], axis=1), axis=0, return_index=True, return_inverse=True)
        design = np.concatenate([a[rows][first] / scale, np.ones((len(first), 1))], axis=1)
        return design, np.bincount(inverse.ravel(), minlength=len(first)).astype(float), np.bincount(inverse.ravel(), y[rows], minlength=len(first))

    whole, part, rest = fold(np.ones(len(y), bool)), fold(~check), fold(check)
    start = np.zeros(len(rules) + 1)
    start[-1] = bias
    highest = float(np.abs(whole[0][:, :-1].T @ (whole[2] - whole[1] * y.mean())).max()) / len(y)
    tried = []
    w = start
    if 0 < part[2].sum() < part[1].sum():
        for penalty in highest * np.logspace(-0.3, -3, 8):
            w = _lasso(*part, penalty, w)
            tried.append((_loss(*rest, w), penalty))
    best = min(tried)[0] if tried else 0
    penalty = max(p for loss, p in tried if loss <= best * 1.02 + 1e-4) if tried else highest / 100
    w = _lasso(*whole, penalty, start, 600)
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-9)
    return RuleModel(float(w[-1]), [rules[i] for i in kept], [float(w[i] / scale[i]) for i in kept])


# The job -------------------------------------------------------------------------------------


def with_statistics(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with a column for each statistic; their names clash with none that is there."""
    stem = "__stat"
    while any(c.startswith(stem) for c in docs.columns):
        stem += "_"
    names = [f"{stem}{i}" for i in range(len(STATISTICS))]
    docs_columns = docs.columns
    place = docs_columns.index(text_col)

    def rows(batches):
        for batch in batches:
            parts = [statistics(data, bounds) for _, data, bounds in K.blocks(batch.column(place).cast(pa.string()), K.SMALL_BLOCK)]
            values = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(values[:, i]) for i in range(len(names)))], [*docs_columns, *names])

    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    plain = docs.toDF(*(f"c{i}" for i in range(len(fields))))  # mapInArrow looks its columns up by name, and a dot would be a field
    return plain.mapInArrow(rows, ", ".join([*fields, *(f"{n} double" for n in names)])), names


def held_out(id_col: Column, modulus: int = HOLD_OUT) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on labelled rows that are not held out."""
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("id")))
    sample = stage(usable.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows), "quality-sample")
    texts = keep_ids(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "id", sample.select("id"))
    measured, names = with_statistics(texts, "text")
    rows = measured.join(sample, "id").select("id", "label", *names).orderBy("id", "label", *names).limit(sample_rows).toArrow()
    x = np.stack([rows.column(n).to_numpy() for n in names], axis=1) if rows.num_rows else np.zeros((0, len(names)))
    return fit_rules(x, rows.column("label").to_numpy() if rows.num_rows else np.zeros(0))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, held_out, score, predicted), one row for every row of ``docs``."""
    model = train(docs, labels, id_col, text_col, label_col, sample_rows)
    measured, names = with_statistics(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")), "__text")
    scored = measured.select(id_col, held_out(F.col(id_col)).alias("held_out"), model.column(names).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows whose score is below 0.5."""
    model = train(docs, labels, id_col, text_col, label_col, sample_rows)
    measured, names = with_statistics(docs, text_col)
    return measured.filter(model.column(names) >= 0.5).drop(*names)
