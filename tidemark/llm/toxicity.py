"""Toxic spans by a linear-chain conditional random field.

Tokens are words; a token is toxic or not. Documents are labelled, tokens are
not, so the words that set toxic documents apart label the tokens of toxic
documents, and every token of a clean document is clean. Weights of hashed
features and transitions are fitted in numpy on a bounded sample of windows out
of whole texts, which stay on the executors. Scoring runs on all executors: forward-backward gives each token its exact marginal, and the
marginals of a whole text give its score and the offending offsets.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, discard, id_remainder, shares, steps, table, unused, written

#: Labelled rows of each class that the model is fitted to, about; at most MOST_ROWS in all.
ROWS_PER_CLASS = 1000
MOST_ROWS = 3000
#: Windows with a toxic token that come to the driver, at most, and as many others. They are drawn from anywhere in whole texts.
MOST_WINDOWS = 15_000
#: Files of the sampled texts.
PARTS = 32
FEATURE_BITS = 18
WINDOW = 48
_AFFIXES = (3, 4, 5, 7)
_TELLING = (4, 5, 6)
_EDGES = " \t\n\x0b\x0c\r.,;:!?\"'()[]{}<>*&%$#|/\\+=-_~`@^…“”‘’«»¡¿"
_SPACE = re.compile(r"[^ \t-\r]+")


@dataclass
class Tokens:
    """Words of several texts: codes into ``words``, and where each text's begin (with a last end)."""

    codes: np.ndarray
    words: list[str]
    starts: np.ndarray


def tokenise(texts: list) -> Tokens:
    """Lower-cased words between ASCII white space, without punctuation at their edges."""
    column = pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string()))
    lists = pc.split_pattern_regex(pc.replace_substring_regex(column, r"^[ \t-\r]+|[ \t-\r]+$", ""), r"[ \t-\r]+")
    sizes = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    flat = pc.utf8_trim(pc.list_flatten(lists), characters=_EDGES).dictionary_encode()
    # An empty text splits into one empty word.
    codes = np.asarray(flat.indices, dtype=np.int64)
    empty = np.array([not t or not t.strip(" \t\n\x0b\x0c\r") for t in texts], dtype=bool)
    if empty.any():
        codes = codes[~np.repeat(empty, sizes)]
        sizes[empty] = 0
    return Tokens(codes, flat.dictionary.to_pylist(), np.concatenate([[0], np.cumsum(sizes)]))


def word_features(word: str) -> tuple[list[int], int, int]:
    """Hashed features of a word for its own token (itself, its length, its beginnings and ends), and of it as the word before and after."""
    mask = (1 << FEATURE_BITS) - 1
    b = word.encode()
    crc = zlib.crc32
    h = crc(b)
    own = [h & mask, (len(word) * 2654435761 >> 7) & mask]
    for n in _AFFIXES:
        own.append(crc(b[:n], n) & mask)
        own.append(crc(b[-n:], 16 + n) & mask)
    return own, (h * 3 + 1) & mask, (h * 5 + 3) & mask


def word_scores(words: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each word adds to its own token, to the next one and to the one before."""
    if not words:
        return np.zeros(0), np.zeros(0), np.zeros(0)
    found = [word_features(w) for w in words]
    own = weights[np.array([f[0] for f in found])].sum(axis=1)
    return own, weights[np.array([f[1] for f in found])], weights[np.array([f[2] for f in found])]


def emissions(tokens: Tokens, scores: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    own, after, before = scores
    c = tokens.codes
    e = own[c]
    if len(c) > 1:
        inner = np.ones(len(c) - 1, dtype=bool)
        ends = tokens.starts[1:-1]
        ends = ends[(ends > 0) & (ends < len(c))]
        inner[ends - 1] = False
        e[1:] += np.where(inner, after[c[:-1]], 0)
        e[:-1] += np.where(inner, before[c[1:]], 0)
    return e


def marginal_logits(e: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: float) -> np.ndarray:
    """log P(toxic) / P(clean) of each token, exactly, all texts stepping together.

    ``e`` is the score of toxic over clean, ``trans`` the log weights [from, to],
    ``first`` the score of a toxic first token. With two labels the forward and
    the backward message are one number each: the log ratio of the two labels.
    """
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    at, lengths = starts[:-1][order], lengths[order]
    ahead, back = np.zeros(len(e)), np.zeros(len(e))
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    t00, t01, t10, t11 = trans.ravel()
    r = np.empty(0)
    for t in range(longest):
        n = int(active[t])
        where = at[:n] + t
        if t == 0:
            r = first + e[where]
        else:
            r = r[:n]
            r = e[where] + np.logaddexp(t01, t11 + r) - np.logaddexp(t00, t10 + r)
        ahead[where] = r
    b = np.empty(0)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        where = at[:n] + t
        # Texts that end here start with an even message.
        grown = np.zeros(n)
        if len(b):
            m = len(b)
            ratio = b + e[at[:m] + t + 1]
            grown[:m] = np.logaddexp(t10, t11 + ratio) - np.logaddexp(t00, t01 + ratio)
        b = grown
        back[where] = b
    return ahead + back


@dataclass
class Field:
    """Weights of the chain, and of the document score over its marginals."""

    weights: np.ndarray
    trans: np.ndarray
    first: float
    document: tuple[float, float, float]

    def marginals(self, tokens: Tokens) -> np.ndarray:
        return marginal_logits(emissions(tokens, word_scores(tokens.words, self.weights)), tokens.starts, self.trans, self.first)


def document_features(logits: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The highest marginal of each text (as a clipped logit) and the log of its expected number of toxic tokens."""
    top, expected = np.full(len(starts) - 1, -12.0), np.zeros(len(starts) - 1)
    full = np.diff(starts) > 0
    if full.any():
        begins = starts[:-1][full]
        top[full] = np.clip(np.maximum.reduceat(logits, begins), -12, 12)
        expected[full] = np.add.reduceat(1 / (1 + np.exp(-np.clip(logits, -30, 30))), begins)
    return top, np.log1p(expected)


def units_of(word: str) -> list[str]:
    """What a word is told apart by: itself, its first and its last letters."""
    own = [f"0{word}"] if len(word) > 2 else []
    return own + [f"{side}{word[:n] if side == 1 else word[-n:]}" for n in _TELLING for side in (1, 2) if len(word) >= n]


def over_texts(sample: DataFrame, schema: str, make: Callable[[], Callable[[np.ndarray, np.ndarray, Tokens], Iterator[list]]], finish: bool = False) -> DataFrame:
    """What ``make``'s function yields, as columns, for the keys, classes and tokens of whole sampled texts; with ``finish``, once more at the end, for None."""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for a, b in steps(batch.column(2)):
                part = batch.slice(a, b - a)
                for columns in apply(part.column(0).to_numpy(), part.column(1).to_numpy(), tokenise(part.column(2).to_pylist())):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        if finish:
            for columns in apply(None, None, None):
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return sample.select("_key", "_toxic", "_text").mapInArrow(run, schema)


def unit_counts(sample: DataFrame) -> DataFrame:
    """unit, bad and good: in how many toxic and how many clean texts each unit is."""

    def make() -> Callable:
        held = (Counter(), Counter())

        def apply(keys: np.ndarray | None, toxic: np.ndarray | None, tokens: Tokens | None) -> Iterator[list]:
            if tokens is None:
                units = list(held[0].keys() | held[1].keys())
                yield [pa.array(units, pa.string()), pa.array([held[1][u] for u in units], pa.int64()), pa.array([held[0][u] for u in units], pa.int64())]
                return
            units = [units_of(w) for w in tokens.words]
            for i, y in enumerate(toxic.tolist()):
                found = np.unique(tokens.codes[tokens.starts[i] : tokens.starts[i + 1]]).tolist()
                held[y].update({u for c in found for u in units[c]})

        return apply

    return over_texts(sample, "unit string, bad long, good long", make, finish=True).groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def unit_uses(sample: DataFrame, live: dict[str, int]) -> DataFrame:
    """unit, free and value: the toxic texts each live unit is in (free 0), and hashes of the words around it (free 1)."""

    def make() -> Callable:
        def apply(keys: np.ndarray, toxic: np.ndarray, tokens: Tokens) -> Iterator[list]:
            units = [[live[u] for u in units_of(w) if u in live] for w in tokens.words]
            can = np.array([bool(u) for u in units], dtype=bool)
            inside, uses = set(), set()
            for i in np.flatnonzero(toxic).tolist():
                c = tokens.codes[tokens.starts[i] : tokens.starts[i + 1]]
                for at in np.flatnonzero(can[c]).tolist() if len(c) else []:
                    before = tokens.words[c[at - 1]] if at else "\n"
                    after = tokens.words[c[at + 1]] if at + 1 < len(c) else "\n"
                    around = xxhash.xxh3_64_intdigest(f"{before} {after}".encode()) >> 1
                    for u in units[c[at]]:
                        inside.add((u, int(keys[i])))
                        uses.add((u, around))
            rows = [(u, 0, v) for u, v in inside] + [(u, 1, v) for u, v in uses]
            yield [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))]

        return apply

    return over_texts(sample, "unit int, free int, value long", make).distinct()


def telling_units(sample: DataFrame, bad_total: float, good_total: float, likelier: float = 6.0, least_g: float = 20.0) -> frozenset[str]:
    """Which words, or first or last letters of words, set toxic texts apart.

    A unit must be in 3 toxic texts or more, be ``likelier`` times as likely there
    as in clean ones, and pass a log likelihood ratio test. Copies of a toxic text
    share all its words, so what merely accompanies a toxic word must not pass.
    Hence texts are not simply counted: either the unit is needed, being in enough
    texts that no stronger unit is in (taken greedily), or it is used freely,
    between enough different pairs of neighbours. Whole texts are counted on the
    executors; only units that may pass come here.
    """
    enough = ((F.col("bad") + 0.5) / bad_total >= likelier * (F.col("good") + 0.5) / good_total) & (F.col("bad") >= 3)
    found = unit_counts(sample).filter(enough).orderBy("unit").toArrow()
    names = found.column("unit").to_pylist()
    if not names:
        return frozenset()
    good = found.column("good").to_numpy().astype(float)
    uses = written(unit_uses(sample, {u: i for i, u in enumerate(names)}))
    counts = uses.filter("free = 1").groupBy("unit").agg(F.count(F.lit(1)).alias("n")).toArrow()
    pairs = uses.filter("free = 0").select("unit", "value").toArrow()
    discard(uses)
    free = np.zeros(len(names))
    free[counts.column("unit").to_numpy()] = counts.column("n").to_numpy()
    unit = pairs.column("unit").to_numpy()
    keys, text = np.unique(pairs.column("value").to_numpy(), return_inverse=True)
    share = bad_total / (bad_total + good_total)

    def ratio_test(bad: np.ndarray) -> np.ndarray:
        n = np.maximum(bad + good, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return 2 * (np.where(bad > 0, bad * np.log(bad / (n * share)), 0) + np.where(good > 0, good * np.log(good / (n * (1 - share))), 0))

    telling = ratio_test(free) >= 2 * least_g
    open_texts = np.ones(len(keys), dtype=bool)
    while len(unit):
        bad = np.bincount(unit, minlength=len(names)).astype(float)
        g = ratio_test(bad)
        g[(bad < 3) | (bad / bad_total <= likelier * good / good_total)] = 0
        best = int(np.argmax(g))
        if g[best] < least_g:
            break
        telling[best] = True
        open_texts[text[unit == best]] = False
        stay = open_texts[text]
        unit, text = unit[stay], text[stay]
    return frozenset(u for u, t in zip(names, telling.tolist(), strict=True) if t)


def windows(sample: DataFrame, telling: frozenset[str]) -> DataFrame:
    """All windows of the texts that may be learned from: draw, hit (with a toxic token), words, and labels as digits.

    A telling word in a clean text is no reason to unlearn it: such texts count for the document score only.
    """

    def make() -> Callable:
        def apply(keys: np.ndarray, toxic: np.ndarray, tokens: Tokens) -> Iterator[list]:
            tells = np.array([any(u in telling for u in units_of(w)) for w in tokens.words], dtype=bool)
            rows: list[tuple] = []

            def columns() -> list:
                return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.bool_(), pa.string(), pa.string()))]

            for i, y in enumerate(toxic.tolist()):
                c = tokens.codes[tokens.starts[i] : tokens.starts[i + 1]]
                labels = tells[c] if len(c) else np.zeros(0, dtype=bool)
                if not y and labels.any():
                    continue
                for a in range(0, len(c), WINDOW):
                    own = labels[a : a + WINDOW]
                    draw = xxhash.xxh3_64_intdigest(f"{keys[i]} {a}".encode()) >> 1
                    rows.append((draw, bool(own.any()), " ".join(tokens.words[x] for x in c[a : a + WINDOW].tolist()), "".join("01"[int(x)] for x in own)))
                    if len(rows) >= 4096:
                        yield columns()
                        rows.clear()
            yield columns()

        return apply

    return over_texts(sample, "draw long, hit boolean, words string, labels string", make)


def train(sample: DataFrame, epochs: int = 6, rate: float = 0.3, decay: float = 1e-6, seed: int = 1) -> Field | None:
    """Gradient ascent on the likelihood of the token labels, then a logistic score of documents.

    ``sample`` has _key, _toxic (0 or 1) and _text. Whole texts stay on the
    executors; the units that set toxic ones apart and a bounded number of windows
    from anywhere in them come here, and two numbers a text for the document score.
    """
    sizes = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    drawn = written(windows(sample, telling_units(sample, float(sizes[1]), float(sizes[0]))))
    hits = drawn.filter("hit").orderBy("draw", "words").limit(MOST_WINDOWS).select("words", "labels").toArrow()
    rest = drawn.filter("not hit").orderBy("draw", "words").limit(max(2000, len(hits))).select("words", "labels").toArrow()
    discard(drawn)
    found = pa.concat_tables([hits, rest])
    if not len(found):
        return None
    lists = pc.split_pattern(found.column("words").combine_chunks().cast(pa.large_string()), " ")
    bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    flat = pc.list_flatten(lists).dictionary_encode()
    tokens = Tokens(np.asarray(flat.indices, dtype=np.int64), flat.dictionary.to_pylist(), bounds)
    labels = (np.frombuffer("".join(found.column("labels").to_pylist()).encode(), dtype=np.uint8) - ord("0")).astype(np.float64)
    spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    feats = [word_features(w) for w in tokens.words]
    own = np.array([f[0] for f in feats])
    after, before = np.array([f[1] for f in feats]), np.array([f[2] for f in feats])
    weights, trans, first = np.zeros(1 << FEATURE_BITS), np.array([[0.0, -3.0], [0.0, -2.0]]), -3.0
    rng = np.random.default_rng(seed)
    squares, square_t, square_f = np.full(len(weights), 1e-6), np.full((2, 2), 1e-6), 1e-6
    for _ in range(epochs):
        rng.shuffle(spans)
        for a in range(0, len(spans), 128):
            group = spans[a : a + 128]
            at = np.concatenate([np.arange(x, y) for x, y in group])
            starts = np.concatenate([[0], np.cumsum([y - x for x, y in group])])
            c, y = tokens.codes[at], labels[at]
            part = Tokens(c, tokens.words, starts)
            e = emissions(part, (weights[own].sum(axis=1), weights[after], weights[before]))
            logits = marginal_logits(e, starts, trans, first)
            p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            g = y - p
            inner = np.ones(len(c), dtype=bool)
            inner[starts[:-1]] = False
            grad = np.bincount(own[c].ravel(), weights=np.repeat(g, own.shape[1]), minlength=len(weights))
            right = np.flatnonzero(inner)
            grad += np.bincount(after[c[right - 1]], weights=g[right], minlength=len(weights))
            grad += np.bincount(before[c[right]], weights=g[right - 1], minlength=len(weights))
            grad -= decay * len(c) * weights
            squares += grad * grad
            weights += rate * grad / np.sqrt(squares)
            # Transitions by observed minus expected pairs.
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[right - 1].astype(int), y[right].astype(int)), 1)
            q = pair_marginals(e, starts, trans, first, right)
            gt = seen - q.sum(axis=0)
            square_t += gt * gt
            trans = trans + rate * gt / np.sqrt(square_t)
            gf = float((y - p)[starts[:-1]].sum())
            square_f += gf * gf
            first += rate * gf / math.sqrt(square_f)
    field = Field(weights, trans, first, (0.0, 0.0, 0.0))

    def make() -> Callable:
        def apply(keys: np.ndarray, toxic: np.ndarray, tokens: Tokens) -> Iterator[list]:
            top, expected = document_features(field.marginals(tokens), tokens.starts)
            yield [pa.array(keys, pa.int64()), pa.array(toxic, pa.int32()), pa.array(top), pa.array(expected)]

        return apply

    scored = over_texts(sample, "key long, toxic int, top double, expected double", make).orderBy("key").toArrow()
    top, expected, toxic = (scored.column(n).to_numpy().astype(float) for n in ("top", "expected", "toxic"))
    field.document = logistic(np.stack([top, expected], axis=1), toxic)
    return field


def pair_marginals(e: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: float, right: np.ndarray) -> np.ndarray:
    """P(label before, label here) for the tokens ``right``, from the two log ratios of messages."""
    both = marginal_logits(e, starts, trans, first)
    ahead = forward_only(e, starts, trans, first)
    back = both - ahead
    out = np.empty((len(right), 2, 2))
    for i in (0, 1):
        for j in (0, 1):
            out[:, i, j] = i * ahead[right - 1] + trans[i, j] + j * (e[right] + back[right])
    out -= out.max(axis=(1, 2), keepdims=True)
    np.exp(out, out=out)
    return out / out.sum(axis=(1, 2), keepdims=True)


def forward_only(e: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: float) -> np.ndarray:
    longest = int(np.diff(starts).max())
    ahead = np.zeros(len(e))
    r = first + e[starts[:-1]]
    ahead[starts[:-1]] = r
    lengths = np.diff(starts)
    for t in range(1, longest):
        live = np.flatnonzero(lengths > t)
        where = starts[:-1][live] + t
        r = ahead[where - 1]
        ahead[where] = e[where] + np.logaddexp(trans[0, 1], trans[1, 1] + r) - np.logaddexp(trans[0, 0], trans[1, 0] + r)
    return ahead


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Weights and intercept by Newton steps; classes weigh by their size."""
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Field | None:
    """A field of a bounded sample of labelled rows; None without rows of both classes.

    Rows without an id or a label of 0 or 1 are left out; a document labelled twice counts as toxic if any label says so.
    """
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn_from is not None:
        usable = usable.filter(learn_from)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).filter("_text is not null")
    marked = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_toxic"))
    # Only rows that have a text are drawn.
    marked = written(marked.join(texts.select("_id"), "_id", "left_semi"))
    chosen = shares(marked, F.col("_toxic"), ROWS_PER_CLASS, F.col("_id")).orderBy(F.xxhash64("_id"), "_id").limit(MOST_ROWS)
    # At most MOST_ROWS ids are broadcast.
    found = written(texts.join(F.broadcast(chosen), "_id").withColumn("_key", F.xxhash64("_text")))
    # Of copies, one counts; a text labelled both ways is toxic.
    once = found.groupBy("_key").agg(F.max("_toxic").alias("_toxic"), F.min("_id").alias("_id"))
    once = once.orderBy(F.xxhash64("_id"), "_id", "_key").limit(MOST_ROWS).select("_key", "_toxic")
    whole = found.groupBy("_key").agg(F.max("_text").alias("_text")).join(F.broadcast(once), "_key")
    sample = written(whole.select("_key", "_toxic", "_text").repartition(PARTS, "_key"))
    field = train(sample)
    for done in (marked, found, sample):
        discard(done)
    return field


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())]))
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", SPANS)]


def score_texts(docs: DataFrame, field: Field | None, text_col: str = "text", drop: tuple[str, ...] = ("text",), names: tuple[str, str, str] = ("score", "predicted", "spans")) -> DataFrame:
    """``docs`` with score, predicted (1 from a score of 0.5) and spans.

    Spans are the tokens whose marginal is 0.5 or more, in code points, end
    exclusive. A null or empty text has no tokens and the score of that. Without
    a model every score is 0. Same-named input columns are replaced.
    """

    def make() -> Callable[[list], dict[str, list]]:
        def apply(texts: list) -> dict[str, list]:
            if field is None:
                return {names[0]: [0.0] * len(texts), names[1]: [0] * len(texts), names[2]: [[] for _ in texts]}
            tokens = tokenise(texts)
            logits = field.marginals(tokens)
            top, expected = document_features(logits, tokens.starts)
            a, b, c = field.document
            scores = 1 / (1 + np.exp(-np.clip(a * top + b * expected + c, -30, 30)))
            spans: list[list[dict]] = [[] for _ in texts]
            for i in np.flatnonzero(top >= 0):
                own = logits[tokens.starts[i] : tokens.starts[i + 1]]
                for k, word in enumerate(_SPACE.finditer(texts[i])):
                    if own[k] >= 0:
                        spans[i].append({"start": word.start(), "end": word.end(), "p": 1 / (1 + math.exp(-min(30.0, own[k])))})
            return {names[0]: scores.tolist(), names[1]: (scores >= 0.5).astype(int).tolist(), names[2]: spans}

        return apply

    fields = [T.StructField(n, f.dataType) for n, f in zip(names, FIELDS, strict=True)]
    return annotate(docs, make, fields, text_col, drop)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those whose score is 0.5 or more, by a field fitted to the labelled ones among them."""
    columns = docs.columns
    names = tuple(unused(columns, n) for n in ("score", "predicted", "spans"))
    scored = score_texts(docs, fit(docs, labels, id_col=id_col, text_col=text_col), text_col, drop=(), names=names)
    return scored.filter(F.col(names[1]) == 0).select(*[F.col(f"`{c}`") for c in columns])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 5) != 0)
    rows = docs.withColumn("held_out", id_remainder("doc_id", 5) == 0)
    return score_texts(rows, field).select("doc_id", "held_out", "score", "predicted", "spans")
