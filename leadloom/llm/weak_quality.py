"""Quality classifier: a weak-label model trains a hashed linear scorer.

1. Heuristic labellers look at each text and vote good, bad or nothing: on its symbols, capitals, repetition, words and
   lines, and on insults, which no rule on form sees. A text's votes are one number (its pattern).
2. Expectation-maximisation over the *counts of patterns of all documents* (at most 3 ** labellers rows) estimates how
   often each labeller votes what on good and bad texts, and so the posterior of each pattern. Priors say that labellers
   are better than chance and weigh a fixed share of the rows, so a corpus without bad texts does not turn the classes.
3. The posteriors are soft labels for a logistic regression over hashed words, word shapes and statistics. It is fitted
   on a bounded sample: the ``train_rows`` different texts with the smallest hashes, or all if there are no more. Copies
   count once: the share of hashes to look at follows the number of *different* texts (estimated in the pass of step 2), so
   neither equal ids nor equal texts can fill the sample or leave it empty, at any size of the table.
4. Every document gets the scorer's probability; those below ``threshold`` are rejected.

Scale: two passes over the texts, no shuffle of texts; the driver sees the pattern counts and the bounded sample.

Edge cases: null and empty texts are rejected by rule (nothing to learn from); a model that was fitted without any text has no
scorer, and the posterior of a text's votes takes the score's place; repeated rows are scored alike; an empty
table gives an empty result; extra columns stay, one struct column ``out_col`` is added (replacing one of that name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from leadloom.llm.hashing import shingles_of, span_hashes, word_bounds

ABSTAIN, GOOD, BAD = 0, 1, 2
LABELLERS = ("symbols", "capitals", "exclamations", "repetition", "variety", "word_length", "function_words", "line_ends",
             "insults", "insult_kinds", "insult_share")
#: Dimensions of the hashed features, rows of the training sample, probability from which a text is kept.
DIMENSIONS = 1 << 15
TRAIN_ROWS = 8_000
THRESHOLD = 0.3
#: Rows of the sample that the fit looks at together.
RUN_ROWS = 250
#: Share of insults among the words from which a labeller votes bad; those that count them ask for a fifth of it.
INSULT_SHARE = 0.005
#: Weight of the priors as a share of the rows; votes (nothing, good, bad) on good and on bad texts; share of good texts.
PRIOR_WEIGHT = 0.2
PRIOR_GOOD, PRIOR_BAD, PRIOR_SHARE = (0.28, 0.715, 0.005), (0.28, 0.52, 0.20), 0.85
#: The same of labellers that never vote good: a text without insults may be bad in any other way.
ONE_SIDED, PRIOR_GOOD_ONE, PRIOR_BAD_ONE = ("insults", "insult_kinds", "insult_share"), (0.99, 0.005, 0.005), (0.9, 0.005, 0.095)
# Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that it for on with as are this be by from was "
    "le la les de des du un une et est que qui en dans pour sur par au avec "
    "der die das und ist nicht ein eine zu mit von auf sich den dem des "
    "el los las que y en un una por con para se del al es su no"
).split()

# Common insults in English, French, German and Spanish.
INSULTS = (
    "idiot idiots moron morons imbecile stupid dumb dumbass fool fools loser losers scum trash garbage filth vermin pathetic worthless disgusting "
    "clown clowns jerk coward liar bastard bitch asshole "
    "imbécile crétin débile abruti ordure connard salaud minable pourriture "
    "trottel dummkopf abschaum widerlich erbärmlich arschloch schwachkopf versager "
    "idiota imbécil estúpido basura asqueroso patético payaso escoria cabrón"
).split()

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[ord("a"): ord("z") + 1] = _SHAPES[0x80:] = ord("x")
_SHAPES[ord("A"): ord("Z") + 1] = ord("X")
_SHAPES[ord("0"): ord("9") + 1] = ord("9")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_U = np.uint64


def _of_string(text: str) -> np.uint64:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(np.array([_of_string(w) for w in set(words)], dtype=_U))


_FUNCTION_HASHES, _INSULT_HASHES = _hashes(FUNCTION_WORDS), _hashes(INSULTS)
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?\"'()"]] = True


def _among(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words


def statistics(text: str) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """Numbers about a text, and the hashes of its lower-cased words (without one sign at their end) and of their shapes."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, ends = word_bounds(raw)
    n = len(starts)
    if not n:
        return {"words": 0}, np.empty(0, dtype=_U), np.empty(0, dtype=_U)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    words = span_hashes(lower, starts, ends - _MARK[raw[ends - 1]])
    shape = _SHAPES[raw]
    first = np.concatenate(([True], shape[1:] != shape[:-1]))
    first[starts] = True
    place = np.concatenate(([0], np.cumsum(first)))
    shapes = span_hashes(shape[first], place[starts], place[ends])
    letters = (shape == ord("x")) | (shape == ord("X"))
    insults = words[_among(words, _INSULT_HASHES)]
    windows = shingles_of(words, 3)
    line_ends = np.flatnonzero(raw == 10)
    last = raw[np.concatenate((line_ends[line_ends > 0] - 1, [len(raw) - 1]))]
    bytes_in_words = int((ends - starts).sum())
    return {
        "words": n,
        "symbols": _SYMBOL[raw].sum() / n,
        "capitals": np.count_nonzero(shape == ord("X")) / max(1, letters.sum()),
        "exclamations": (raw == ord("!")).sum() / n,
        "repetition": 1 - len(np.unique(windows)) / len(windows),
        "variety": len(np.unique(words)) / n,
        "word_length": bytes_in_words / n,
        "function_words": _among(words, _FUNCTION_HASHES).sum() / n,
        "line_ends": np.isin(last, [ord(c) for c in ".!?\"'"]).mean(),
        "insults": len(insults),
        "insult_kinds": len(np.unique(insults)),
    }, words, shapes


def votes(s: dict[str, float]) -> tuple[int, ...]:
    """A vote of each labeller."""
    def cut(_: float, good: bool, bad: bool) -> int:
        return BAD if bad else GOOD if good else ABSTAIN

    if not s["words"]:
        return (BAD,) * len(LABELLERS)
    n = s["words"]
    abused = s["insults"] > INSULT_SHARE / 5 * n
    return (
        cut(s["symbols"], s["symbols"] < 0.02, s["symbols"] > 0.15),
        cut(s["capitals"], s["capitals"] < 0.12, s["capitals"] > 0.35),
        cut(s["exclamations"], s["exclamations"] < 0.02, s["exclamations"] > 0.15),
        cut(s["repetition"], s["repetition"] < 0.08, s["repetition"] > 0.25),
        cut(s["variety"], n > 30 and s["variety"] > 0.4, n > 30 and s["variety"] < 0.12),
        cut(s["word_length"], 3 < s["word_length"] < 9, s["word_length"] < 2 or s["word_length"] > 14),
        cut(s["function_words"], s["function_words"] > 0.12, n > 30 and s["function_words"] < 0.02),
        cut(s["line_ends"], s["line_ends"] > 0.8, s["line_ends"] < 0.1),
        cut(s["insults"], False, abused and s["insults"] > 1),
        cut(s["insult_kinds"], False, abused and s["insult_kinds"] > 1),
        cut(s["insults"], False, s["insults"] > INSULT_SHARE * n),
    )


def pattern_of(cast: tuple[int, ...]) -> int:
    out = 0
    for v in cast:
        out = 3 * out + v
    return out


def fit_labellers(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray, float]:
    """Posteriors of being good by pattern, P(vote | class) as (2, labellers, 3) with bad first, and the share of good."""
    k = len(LABELLERS)
    patterns = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(p)] for p in patterns], dtype=np.float64)
    cast = np.stack([patterns // 3 ** (k - 1 - j) % 3 for j in range(k)], axis=1)
    hot = np.eye(3)[cast]  # pattern, labeller, vote
    prior = np.array([[one if name in ONE_SIDED else both for name in LABELLERS] for both, one in ((PRIOR_BAD, PRIOR_BAD_ONE), (PRIOR_GOOD, PRIOR_GOOD_ONE))])
    table = prior.copy()
    share = PRIOR_SHARE
    weight = PRIOR_WEIGHT * max(1.0, n.sum())
    post = np.empty(0)
    for _ in range(rounds):
        logs = np.einsum("pjv,cjv->pc", hot, np.log(table)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))
        if len(post) and np.abs(new - post).max() < 1e-7:
            break
        post = new
        for c, p in enumerate((1 - post, post)):
            table[c] = (np.einsum("p,pjv->jv", n * p, hot) + weight * prior[c]) / ((n * p).sum() + weight)
        share = ((n * post).sum() + weight * PRIOR_SHARE) / (n.sum() + weight)
    return dict(zip(patterns.tolist(), post.tolist())), table, share


def features(s: dict[str, float], words: np.ndarray, shapes: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers and values: words and shapes by frequency, statistics by range."""
    n = s["words"]
    ranges = [f"{name}:{int(s[name] * 10)}" for name in ("symbols", "exclamations", "repetition", "variety", "function_words", "capitals")] if n else []
    ranges.append("words:%d" % min(4, int(np.log10(n + 1) * 2)))
    if n and s["insults"]:
        ranges += ["insult_kinds:%d" % min(3, s["insult_kinds"]), "insult_share:%d" % min(3, int(s["insults"] / n / INSULT_SHARE * 2))]
    marks = np.array([_of_string(r) for r in ranges], dtype=_U)
    numbers = np.concatenate((words, shapes ^ _U(0x5851F42D4C957F2D), marks)) % _U(dimensions)
    values = np.concatenate((np.full(2 * n, 1 / max(1, n)), np.full(len(marks), 0.5)))
    found, at = np.unique(numbers.astype(np.int32), return_inverse=True)
    return found, np.bincount(at, weights=values)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], dimensions: int = DIMENSIONS, rounds: int = 200, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on soft labels, by accelerated gradient descent.

    The rows are looked at in runs of ``RUN_ROWS``, in order, so sums are those of one pass and no array but the features' own
    has their length.
    """
    w = np.zeros(dimensions + 1)
    if not rows:
        w[-1] = 1.0
        return w
    runs = []
    for k in range(0, len(rows), RUN_ROWS):
        some = rows[k: k + RUN_ROWS]
        runs.append((k, np.concatenate([r[0] for r in some]), np.concatenate([r[1] for r in some]), [len(r[0]) for r in some]))
    label = np.array([r[2] for r in rows])
    del rows

    def sums(of) -> np.ndarray:
        """The sum of ``of`` (index, value) over each row's features."""
        return np.concatenate([np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=of(i, v.astype(np.float64)), minlength=len(sizes)) for _, i, v, sizes in runs])

    seen = w.copy()
    step = 8.0 / (1 + sums(lambda _, v: v * v).max())
    for t in range(rounds):
        z = sums(lambda i, v: v * seen[i]) + seen[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
        total = np.zeros(dimensions)
        for k, i, v, sizes in runs:
            np.add.at(total, i, v * np.repeat(error[k: k + len(sizes)], sizes))
        gradient = ridge * seen
        gradient[:-1] += total
        gradient[-1] = error.sum()
        after = seen - step * gradient
        seen = after + t / (t + 3) * (after - w)
        w = after
    return w


def score(weights: np.ndarray, index: np.ndarray, value: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(value.dot(weights[index]) + weights[-1], -30, 30))))


def fit(docs: DataFrame, *, text_col: str = "text", train_rows: int = TRAIN_ROWS) -> tuple[dict[int, float], np.ndarray | None]:
    """The posterior of each vote pattern over all documents, and the scorer's weights (None if there was no text)."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pattern_of(votes(statistics(x.as_py() or "")[0])) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), batch.column("hash")], names=["pattern", "hash"])

    source = docs.select(F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    by_pattern = source.mapInArrow(patterns, "pattern long, hash long").groupBy("pattern")
    rows = by_pattern.agg(F.count("*").alias("n"), F.approx_count_distinct("hash", 0.02).alias("different")).collect()
    counts = {r["pattern"]: r["n"] for r in rows}  # 3 ** labellers rows at most
    posterior, _, _ = fit_labellers(counts)
    different = sum(r["different"] for r in rows)  # equal texts have one pattern

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value, label = [], [], []
            for x in batch.column("text"):
                s, words, shapes = statistics(x.as_py() or "")
                i, v = features(s, words, shapes)
                index.append(i.astype(np.int32).tobytes())
                value.append(v.astype(np.float32).tobytes())
                label.append(posterior.get(pattern_of(votes(s)), 0.5))
            yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(index, pa.binary()), pa.array(value, pa.binary()), pa.array(label, pa.float64())], names=["h", "i", "v", "y"])

    # a fifth more than asked for, and 50, for the estimate's error and chance; the least hashes of them are the sample
    share = (1.2 * train_rows + 50) / max(1, different)
    sample = source if share >= 1 else source.where(F.col("hash") < int(share * 2**64) - 2**63)
    got = sample.where("text is not null").distinct().mapInArrow(train, "h long, i binary, v binary, y double").orderBy("h").limit(train_rows).toArrow()
    ordered = sorted(zip(*(got.column(c).to_pylist() for c in "ivy")))
    del got
    return posterior, fit_scorer([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y) for i, v, y in ordered]) if ordered else None


def classify(docs: DataFrame, model: tuple[dict[int, float], np.ndarray | None], *, text_col: str = "text", out_col: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct ``out_col``: votes, weak (posterior of the votes), score and kept."""
    posterior, weights = model
    names = [c for c in docs.columns if c.lower() != out_col.lower()]
    result = pa.struct([("votes", pa.list_(pa.int8())), ("weak", pa.float64()), ("score", pa.float64()), ("kept", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(text_col):
                s, words, shapes = statistics(x.as_py() or "")
                cast = votes(s)
                weak = posterior.get(pattern_of(cast), 0.5)
                p = 0.0 if not s["words"] else weak if weights is None else score(weights, *features(s, words, shapes))
                out.append({"votes": cast, "weak": weak, "score": p, "kept": p >= threshold})
            columns = [batch.column(c) for c in names] + [pa.array(out, result)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, out_col])

    struct = T.StructType([T.StructField("votes", T.ArrayType(T.ByteType())), T.StructField("weak", T.DoubleType()),
                           T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField(out_col, struct)])
    return docs.select(*names).mapInArrow(judge, schema)
