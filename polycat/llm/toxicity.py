"""Toxic texts: a convolutional classifier over hashed word embeddings, trained in numpy, with thresholds for each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polycat.llm.common import TEXT_ROWS, bounded, fresh, stored, text_key
from polycat.llm.text import ALNUM, U, buffers, hash_spans, mix, prefix_sums, slices, spans

#: Rows of the embedding table, size of an embedding, widths of the filters, filters of each width.
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 8
#: A word's embedding is the sum of those of the whole word and of its first bytes.
PREFIXES = (4, 5, 6)
PARTS = 1 + len(PREFIXES)
#: Scores of at least this are toxic.
THRESHOLD = 0.3
PAD = max(WIDTHS)


def features(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its beginnings, and words for each row."""
    starts, ends, counts = spans(off, data, ALNUM)
    sums = prefix_sums(data)
    parts = [hash_spans(sums, starts, ends)] + [mix(hash_spans(sums, starts, np.minimum(starts + k, ends)) + U(k)) for k in PREFIXES]
    return np.stack([(p >> U(40)).astype(np.int64) % BUCKETS for p in parts], axis=1).astype(np.int32), counts


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    out: np.ndarray
    bias: float
    languages: list[str] = field(default_factory=list)
    profiles: np.ndarray | None = None  # log probabilities of words by language
    shifts: np.ndarray | None = None  # what each language adds to the score's log odds

    def padded(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embedded words with PAD rows of zeros after each text, where each text starts, and the place of each word."""
        first = np.concatenate([[0], np.cumsum(counts + PAD)])
        at = np.arange(len(words)) + np.repeat(np.arange(len(counts)) * PAD, counts)
        x = np.zeros((int(first[-1]), DIM), np.float32)
        rows = self.embedding[words[:, 0]]
        for k in range(1, PARTS):
            rows += self.embedding[words[:, k]]
        x[at] = rows
        return x, first[:-1], at

    def maps(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Responses of all filters at all places. Those that would reach into the next text are 0, as at a place without words."""
        out = []
        for w in self.filters:
            y = x @ w[0]
            for j in range(1, len(w)):
                y[:-j] += x[j:] @ w[j]
            for j in range(1, len(w)):
                y[np.append(first[1:], len(x)) - j] = 0
            out.append(y)
        return np.concatenate(out, axis=1)

    def logits(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x, first, _ = self.padded(words, counts)
        return np.maximum(np.maximum.reduceat(self.maps(x, first), first, axis=0), 0) @ self.out + self.bias

    def language(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Likeliest language of each text by its words alone."""
        sums = np.zeros((len(words) + 1, self.profiles.shape[1]))
        np.cumsum(self.profiles[words[:, 0]], axis=0, out=sums[1:])
        ends = np.cumsum(counts)
        return np.argmax(sums[ends] - sums[ends - counts], axis=1)

    def scores(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.logits(words, counts)
        if self.shifts is not None:
            z = z + self.shifts[self.language(words, counts)]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 8, batch: int = 32, seed: int = 5) -> Model:
    """A model of the texts' words (arrays of buckets). The first dimension of the embedding starts as each bucket's log odds, the others at random, so that words can be told apart and the wider filters can learn which stand together; both are shrunk where few texts have the word."""
    rng = np.random.default_rng(seed)
    seen = np.zeros((2, BUCKETS))
    for t, y in zip(texts, labels, strict=True):
        seen[int(y), np.unique(t)] += 1
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    e = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32) * np.minimum(1, seen.sum(axis=0) / 100)[:, None].astype(np.float32)
    e[:, 0] = np.clip(odds, -2, 6) * np.minimum(1, seen.sum(axis=0) / 8) / 4
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[0, 0, : FILTERS // 2] = 1
    out = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
    out.reshape(len(WIDTHS), FILTERS)[:, : FILTERS // 2] = 0.5
    m = Model(e, filters, out, -2.0)
    speed = [np.full(a.shape, 1e-3, np.float32) for a in (m.embedding, *m.filters, m.out)]
    places = np.arange(FILTERS * len(WIDTHS))
    for epoch in range(epochs):
        rate = 0.2 / (1 + epoch)
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            counts = np.array([*(len(texts[i]) for i in some), 0])  # and a clean text without words, like which a text of unknown words scores
            y = np.append(labels[some], 0)
            words = np.concatenate([texts[i] for i in some])
            x, first, at = m.padded(words, counts)
            maps = m.maps(x, first)
            top = np.maximum.reduceat(maps, first, axis=0)
            ends = np.append(first[1:], len(x))
            where = np.stack([first[b] + np.argmax(maps[first[b] : ends[b]], axis=0) for b in range(len(counts))])
            act = np.maximum(top, 0)
            z = act @ m.out + m.bias
            dz = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y).astype(np.float32) / len(some)
            dtop = dz[:, None] * m.out * (top > 0)
            at_places, at_grads = [], []  # what reaches the embedded words, by place
            grads = [np.zeros_like(w) for w in m.filters]
            for k, w in enumerate(WIDTHS):
                cols = places[k * FILTERS : (k + 1) * FILTERS]
                for j in range(w):
                    pos = np.minimum(where[:, cols] + j, len(x) - 1)
                    grads[k][j] = np.einsum("bfd,bf->df", x[pos], dtop[:, cols])
                    some_b, some_c = np.nonzero(dtop[:, cols])
                    at_places.append(pos[some_b, some_c])
                    at_grads.append(dtop[some_b, cols[some_c], None] * m.filters[k][j, :, some_c])
            steps = [(m.out, act.T @ dz, speed[-1])] + [(w, g + 1e-4 * w, s) for w, g, s in zip(m.filters, grads, speed[1:-1], strict=True)]
            for value, grad, s in steps:
                s += grad * grad
                value -= rate * grad / np.sqrt(s)
            m.bias -= rate * float(dz.sum())
            pos, grad = np.concatenate(at_places), np.concatenate(at_grads)
            i = np.minimum(np.searchsorted(at, pos), len(at) - 1)
            real = at[i] == pos  # not the zeros between texts
            rows, back = np.unique(words[i[real]], return_inverse=True)
            total = np.zeros((len(rows), DIM), np.float32)
            np.add.at(total, back.ravel(), np.repeat(grad[real], PARTS, axis=0))
            speed[0][rows] += total * total
            m.embedding[rows] -= rate * total / np.sqrt(speed[0][rows])
    return m


def _profiles(texts: list[np.ndarray], langs: list[str | None], most: int) -> tuple[list[str], np.ndarray]:
    """The most frequent languages and the log probability of each whole-word bucket in them."""
    names, counts = np.unique([x for x in langs if x is not None] or [""], return_counts=True)
    names = [str(x) for x in names[np.argsort(-counts, kind="stable")][:most]]
    table = np.full((BUCKETS, len(names)), 0.1)
    for t, x in zip(texts, langs, strict=True):
        if x in names:
            np.add.at(table[:, names.index(x)], t[:, 0], 1)
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The log odds from which on texts count as toxic: the largest F1 with at most one in a hundred clean texts above it; the middle of the widest gap of equally good ones."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    true = np.append(y[::-1].cumsum()[::-1], 0)
    above = np.arange(len(y), -1, -1)
    f1 = 2 * true / (above + y.sum())
    f1[above - true > 0.01 * (len(y) - y.sum())] = -1
    cuts = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    gaps = np.concatenate([[0], np.diff(z), [0]])
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[best[np.argmax(gaps[best])]])


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, off, data in slices(batch.column(1)):
            words, counts = features(off, data)
            ends = np.cumsum(counts)
            cells = [words[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(cells, pa.binary())], ["_id", "_words"])


def _distinct(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Indexes of texts that share none of four MinHashes with an earlier one of the same label: near copies would teach their words."""
    seen: set = set()
    keep = []
    for i, t in enumerate(texts):
        w = t[:, 0].astype(U)
        grams = mix(w[:-2] + (w[1:-1] << U(20)) + (w[2:] << U(40))) if len(w) > 2 else mix(w + U(1))
        keys = {(int(labels[i]), k, int(mix(grams + U(k)).min())) for k in range(4)} if len(grams) else set()
        if keys and not keys & seen:
            keep.append(i)
        seen |= keys
    return np.array(keep, int)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 2000, max_negative: int = 4000, max_tokens: int = 4_000_000, least: int = 20, least_language: int = 10, max_languages: int = 16) -> Model:
    """A model from the labelled documents whose crc32(doc_id) mod 4 is not 2.

    The sample is bounded: of each label the rows with the smallest hash of their id, max_positive and max_negative of
    them, further ones left out once max_tokens words are reached; of texts that share one of four MinHashes with an
    earlier one of their label only the first teaches weights. Languages are guessed among the max_languages most frequent
    ones of the sample; texts in others get the nearest one's threshold. Rows with mod 4 = 1 set the thresholds, the others
    the weights. A language whose threshold rows hold fewer than least_language of either label has the common
    threshold; with fewer than least toxic threshold rows in all, the common one is set by the rows of the weights too.
    Without labelled rows of both kinds (an empty table, labels all null) all texts get the same low score. Null ids,
    null texts and texts without words teach nothing. Where rows of labels repeat an id, the largest label counts; rows
    of docs that repeat it are learnt from one by one.
    """
    named = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_y"))
    named = named.withColumn("_fold", F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4))).where("_fold <> 2")
    pick = lambda y, n: named.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = stored(pick(1, max_positive).union(pick(0, max_negative)))
    langs = docs.select(F.col("doc_id").alias("_id"), F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"))
    docs = docs.select("doc_id", "text")
    texts = docs.where(F.col("text").isNotNull()).join(bounded(chosen.select("_id")), F.col("doc_id") == F.col("_id"), "left_semi")
    rows = texts.select(F.col("doc_id").alias("_id"), "text").mapInArrow(_featurize, "_id long, _words binary").join(chosen, "_id")
    rows = stored(rows.join(langs.join(bounded(chosen.select("_id")), "_id", "left_semi").groupBy("_id").agg(F.min("lang").alias("lang")), "_id").withColumn("_n", F.length("_words") / (4 * PARTS)))
    share = min(1.0, max_tokens / max(1.0, rows.agg(F.sum("_n")).first()[0] or 0.0))
    some = rows.where(F.pmod(F.xxhash64("_id", F.lit(9)), F.lit(1000)) < int(1000 * share)) if share < 1 else rows
    got = some.orderBy("_id").toArrow()
    off, data = buffers(got["_words"])
    words = [data[a:b].view(np.int32).reshape(-1, PARTS) for a, b in zip(off[:-1], off[1:], strict=True)]  # no copies
    y, part, lang = np.array(got["_y"].to_pylist(), int), np.array(got["_fold"].to_pylist()), got["lang"].to_pylist()
    full = np.array([len(w) > 0 for w in words], bool)
    fit_on = np.flatnonzero(full & (part != 1)) if len(words) else np.zeros(0, int)
    if len(set(y[fit_on])) < 2:
        return Model(np.zeros((BUCKETS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32), -4.0)
    fit_on = fit_on[_distinct([words[i] for i in fit_on], y[fit_on])]
    m = fit([words[i] for i in fit_on], y[fit_on])
    m.languages, profiles = _profiles([words[i] for i in fit_on], [lang[i] for i in fit_on], max_languages)
    m.profiles = profiles
    check = np.flatnonzero(full & (part == 1))
    goal = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    m.shifts = np.zeros(len(m.languages))
    if len(set(y[check])) == 2:
        pairs = [(m.logits(words[i], np.array([len(words[i])]))[0], m.language(words[i], np.array([len(words[i])]))[0]) for i in check]
        z, where = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        own = check if y[check].sum() >= least else np.concatenate([check, fit_on])  # too few to set a threshold by
        every = z if own is check else np.concatenate([z, [m.logits(words[i], np.array([len(words[i])]))[0] for i in fit_on]])
        m.shifts[:] = goal - _best_cut(every, y[own])
        for k in range(len(m.languages)):
            own = where == k
            if min(y[check][own].sum(), (1 - y[check][own]).sum()) >= least_language:
                m.shifts[k] = goal - _best_cut(z[own], y[check][own])
    return m


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score, predicted (1 if score >= THRESHOLD) for each row of docs, from its whole text alone; null and empty texts get the score of no words. Ids of any kind, nulls and repeated rows pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size: tables of BUCKETS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, off, data in slices(batch.column(1), 1 << 19):
                s = sent.value.scores(*features(off, data))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], [id_col, "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the classifier, trained on labels, calls toxic, with all their columns.

    A score depends on the whole text only, however long, so decisions are kept by its digest: rows that share an id or
    have none are decided one by one, and null texts as empty ones. An empty table stays empty; without labels of both
    kinds nothing is called toxic.
    """
    name = fresh(docs, "_bad")
    texts = docs.select(text_key(F.col("text")).alias(name), "text")
    bad = stored(score(texts, train(docs, labels), id_col=name).where("predicted = 1").select(name).distinct(), TEXT_ROWS)
    return docs.join(bounded(bad), text_key(F.col("text")) == F.col(name), "left_anti")
