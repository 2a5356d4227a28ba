"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The labelled sample (bounded, ``labelled.SAMPLE_ROWS``) is split three ways by a hash of the
text.  One part gives the lexicon: words and word beginnings (4 to 6 bytes) with the log odds of
being in a toxic text, LEXICON_ROWS at most.  The next trains the trees, the last fits the
isotonic step that turns their sums into rates.  Features: densities and largest odds of
lexicon words and beginnings, the same after undoing letter substitutes, lexicon words near a
second-person pronoun, capitals, signs, digits, letters broken by signs, and length.

Nulls and texts without words have all features at 0 and get the rate of such a row.
Repeated rows are scored each; an empty table gives no rows; without labels every
score is 0.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A
from tidemark.llm import labelled

LEXICON_ROWS = 4096
NEAR = 5
PREFIXES = (4, 5, 6)
#: Letters that digits and signs stand for.
PLAIN = A.LOWER.copy()
for _sign, _letter in zip("0134578@$!", "oieastbasi", strict=True):
    PLAIN[ord(_sign)] = ord(_letter)
PLAIN_VALUES = A.BYTE_VALUES[PLAIN]
#: Second-person words (English, German, French, Spanish).
YOU = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre vos tú ti usted ustedes vosotros".split()
SOLID = np.zeros(256, bool)
SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LETTER = SOLID.copy()
LETTER[48:58] = False


def _hash_of(word: str, values=A.LOWER_VALUES) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return A.Rolling(values[raw])(np.array([0]), np.array([len(raw)]))[0]


def _words(data, borders):
    """Words without the signs around them: starts, ends, documents; and counts of all words."""
    starts, ends, docs = A.word_spans(data, borders)
    solid = np.flatnonzero(SOLID[data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    has = high > low
    return solid[low[has]], solid[high[has] - 1] + 1, docs[has], starts, ends, docs


def _keys(data, starts, ends):
    """Hash keys of words: as they are, plain, and their beginnings (0 where too short)."""
    roll, plain = A.Rolling(A.LOWER_VALUES[data]), A.Rolling(PLAIN_VALUES[data])
    keys = [roll(starts, ends), plain(starts, ends)]
    for k in PREFIXES:
        long = ends - starts > k
        keys.append(np.where(long, A.mix(plain(starts, np.where(long, starts + k, ends)) + A.U(k)), A.U(0)))
    return keys


def lexicon(sample: DataFrame, rows: int = LEXICON_ROWS) -> dict:
    """{key: log odds} of the keys that mark toxic texts, from counts of texts that hold them."""
    schema = pa.schema([("key", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def task(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            for first, end, data, borders in A.text_slices(batch.column("text")):
                starts, ends, docs, *_ = _words(data, borders)
                if not len(starts):
                    continue
                keys = _keys(data, starts, ends)
                key = np.concatenate(keys[1:])
                doc = np.tile(docs, len(keys) - 1)
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                once = ~A.same_as_before(key, doc) & (key != 0)
                key, toxic = key[once], label[first:end][doc[once]]
                found, inverse = np.unique(key, return_inverse=True)
                hits = np.bincount(inverse, weights=toxic, minlength=len(found)).astype(np.int64)
                total = np.bincount(inverse, minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(hits), pa.array(total - hits)], schema=schema)

    sizes = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("label")).first()
    toxic, clean = int(sizes[0]), int(sizes[1] - sizes[0])
    if not toxic or not clean:
        return {"keys": np.zeros(0, np.uint64), "odds": np.zeros(0)}
    counts = sample.select("text", "label").mapInArrow(task, "key long, toxic long, clean long")
    counts = counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = (counts.where(F.col("toxic") >= 3).select("key", odds.alias("odds"), "toxic").where("odds > 2")
            .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "key").limit(rows).collect())
    keys = np.array([r[0] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return {"keys": keys[order], "odds": np.array([r[1] for r in best])[order] if len(best) else np.zeros(0)}


def _odds(lexicon: dict, key: np.ndarray) -> np.ndarray:
    known = lexicon["keys"]
    out = np.zeros(len(key))
    if not len(known):
        return out
    maybe = np.zeros(1 << 16, bool)
    maybe[(known & A.U(65535)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(key & A.U(65535)).astype(np.int64)])
    where = np.minimum(np.searchsorted(known, key[at]), len(known) - 1)
    hit = known[where] == key[at]
    out[at[hit]] = lexicon["odds"][where[hit]]
    return out


def features(lexicon: dict, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of dense features per document."""
    n = len(borders) - 1
    starts, ends, docs, all_starts, all_ends, all_docs = _words(data, borders)
    keys = _keys(data, starts, ends)
    raw, plain = _odds(lexicon, keys[0]), _odds(lexicon, keys[1])
    begin = np.max([_odds(lexicon, k) for k in keys[2:]], axis=0) if len(starts) else np.zeros(0)
    words = np.maximum(1, np.bincount(all_docs, minlength=n))
    per = lambda x: np.bincount(docs, weights=x, minlength=n)

    def largest(x):
        out = np.zeros(n)
        np.maximum.at(out, docs[x > 0], x[x > 0])
        return out

    you = np.isin(keys[0], np.array([_hash_of(w) for w in YOU], np.uint64))
    at = np.flatnonzero(you)
    mask = A.covered(len(starts), np.maximum(at - NEAR, 0), np.minimum(at + NEAR + 1, len(starts))) if len(at) else you
    any_hit = np.maximum(np.maximum(raw, plain), begin)
    letters, size = np.append(0, np.cumsum(LETTER[data])), np.maximum(1, np.diff(borders))
    part = lambda flag: np.diff(np.append(0, np.cumsum(flag))[borders]) / size
    upper = (data >= 65) & (data <= 90)
    caps = np.append(0, np.cumsum(upper))
    inside = (ends - starts) - (letters[ends] - letters[starts])
    broken = (inside > 0) & (letters[ends] - letters[starts] >= 2)
    shout = (caps[ends] - caps[starts] == ends - starts) & (ends - starts > 1)
    rows = [per(raw > 0) / words, np.log1p(per(raw > 0)), largest(raw), per(begin > 0) / words, np.log1p(per(begin > 0)),
            largest(begin), per((begin > 0) & (begin > 3)) / words, np.log1p(per(begin > 3)), per((plain > 0) & (raw == 0)) / words,
            per((any_hit > 0) & mask) / words, per(you) / words, part(upper), per(shout) / words, part(data == 33), part(data == 63),
            part(~SOLID[data] & ~A.SPACES[data]), part((data >= 48) & (data <= 57)), per(broken) / words, np.log1p(words),
            np.diff(borders) / words, per(any_hit) / words, np.log1p(per(any_hit))]
    return np.column_stack(rows) if n else np.zeros((0, len(rows)))


class Trees:
    """Boosted regression trees on the logistic loss, over features cut into bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 32, least: float = 5.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
        self.trees, self.depth, self.start = [], depth, float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        cut, total = self._cut(x), np.full(len(y), self.start)
        for _ in range(trees):
            p = labelled.sigmoid(total)
            tree = self._grow(cut, y - p, p * (1 - p), bins, least, rate)
            self.trees.append(tree)
            total += self._value(tree, cut)

    def _cut(self, x):
        return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)])

    def _grow(self, cut, slope, curve, bins, least, rate):
        nodes = (1 << (self.depth + 1)) - 1
        feature, edge, value = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)
        at = np.zeros(len(cut), np.int64)
        for level in range(self.depth + 1):
            for node in range((1 << level) - 1, (1 << (level + 1)) - 1):
                own = np.flatnonzero(at == node)
                if not len(own):
                    continue
                g, h = slope[own], curve[own]
                value[node] = rate * g.sum() / (h.sum() + 1)
                if level == self.depth or h.sum() < 2 * least / 10:
                    continue
                best = (1e-6, -1, 0)
                for f in range(cut.shape[1]):
                    gs, hs = (np.cumsum(np.bincount(cut[own, f], weights=w, minlength=bins)) for w in (g, h))
                    gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                    gain[(hs < least / 10) | (hs[-1] - hs < least / 10)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
                if best[1] >= 0:
                    feature[node], edge[node] = best[1:]
                    at[own] = 2 * node + 1 + (cut[own, best[1]] > best[2])
        return feature, edge, value

    def _value(self, tree, cut):
        feature, edge, value = tree
        at, rows = np.zeros(len(cut), np.int64), np.arange(len(cut))
        for _ in range(self.depth):
            f = feature[at]
            at = np.where(f < 0, at, 2 * at + 1 + (cut[rows, np.maximum(f, 0)] > edge[at]))
        return value[at]

    def __call__(self, x):
        cut, total = self._cut(x), np.full(len(x), self.start)
        for tree in self.trees:
            total += self._value(tree, cut)
        return total


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares rising steps (pool adjacent violators), as points to interpolate between."""
    blocks: list[list[float]] = []
    for v, t in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        blocks.append([t, 1.0, v, v])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    return np.array([p for b in blocks for p in (b[2], b[3])]), np.array([(b[0] * b[1] + 0.02) / (b[1] + 0.1) if 0 < b[0] < 1 else b[0]
                                                                      for b in blocks for _ in (0, 1)])


def train(lexicon: dict):
    def fit(slices):
        xs, ys, part = [], [], []
        for data, borders, label in slices:
            xs.append(features(lexicon, data, borders))
            ys.append(label)
            roll = A.Rolling(A.BYTE_VALUES[data])
            part.append(roll(borders[:-1], borders[1:]) % A.U(3))
        if not xs:
            return None
        x, y, part = np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(part)
        if not 0 < y.mean() < 1:
            return None
        learn, hold = part > 0, part == 0
        if not 0 < y[learn].mean() < 1 or hold.sum() < 30 or not 0 < y[hold].mean() < 1:
            learn = hold = np.ones(len(y), bool)
        trees = Trees(x[learn], y[learn])
        return trees, isotonic(trees(x[hold]), y[hold])

    return fit


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: float = 0.3,
             sample_rows: int = labelled.SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for documents (doc_id, text, ...)."""
    sample = labelled.labelled_sample(docs, labels, label, sample_rows)
    part = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    words = lexicon(sample.where(part))
    model = labelled.fit(sample.where(~part), train(words))

    def score(data, borders):
        if model is None:
            return np.zeros(len(borders) - 1)
        trees, (at, rate) = model
        return np.interp(trees(features(words, data, borders)), at, rate)

    return labelled.score_rows(docs, score, limit)


def query(spark, sf_dir) -> DataFrame:
    """op6: score of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
