"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed letter trigrams, learned from a bounded sample of labelled documents.  A
document is a mixture of languages: expectation-maximisation finds the proportions that make its trigrams likeliest,
and the set of languages is the one with the best likelihood less a penalty for every language in it, grown one
language at a time from the best single one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, checkpointed, lowest_by_hash, train_row, trimmed

BITS = 16
SAMPLE_DOCS = 400  # labelled documents a language, the lowest by a hash of their id
SMOOTHING = 0.05
STEPS = 12
PENALTY = 0.5  # times log(trigrams), for each language beyond the first
SCHEMA = "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    points = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            points[c] = ord(low[0])
    return points


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of a whole text: letters in lower case, each run of anything else one separator."""
    x = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = x > 0
    keep[1:] |= keep[:-1] & ~keep[1:]  # the first separator of a run stays
    x = np.concatenate([[0], x[keep], [0]]).astype(np.uint32)
    if len(x) < 4 and not x.any():
        return np.empty(0, np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1]) * np.uint32(0x85EBCA6B) + x[2:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))) >> np.uint32(32 - BITS)


def _mixture(p: np.ndarray, w: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of the mixture of p's columns for trigrams of counts w."""
    share, n = np.full(p.shape[1], 1 / p.shape[1]), w.sum()
    for _ in range(steps):
        joint = p * share
        share = w @ (joint / joint.sum(1, keepdims=True)) / n
    return share, float(w @ np.log(p @ share))


@dataclass
class Model:
    """Trigram probabilities of the learned languages: ``floor`` for each but those listed, trigram after trigram."""

    langs: list[str]
    floor: np.ndarray  # a language's probability of a trigram that its sample lacks
    first: np.ndarray  # where a trigram's entries start; one more than there are trigrams
    lang: np.ndarray  # entries: the language
    p: np.ndarray  # and its probability

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Probabilities of distinct trigrams, trigram x language."""
        start, n = self.first[grams], self.first[grams + 1] - self.first[grams]
        entry = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out = np.tile(self.floor, (len(grams), 1))
        out[np.repeat(np.arange(len(grams)), n), self.lang[entry]] = self.p[entry]
        return out


def model_of(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of languages given by (distinct trigrams, their counts), smoothed."""
    langs = sorted(counts)
    size = 1 << BITS
    total = np.array([counts[k][1].sum() + SMOOTHING * size for k in langs])
    gram = np.concatenate([np.empty(0, np.int64), *[counts[k][0].astype(np.int64) for k in langs]])
    lang = np.repeat(np.arange(len(langs), dtype=np.int32), [len(counts[k][0]) for k in langs])
    p = np.concatenate([np.empty(0), *[(counts[k][1] + SMOOTHING) / t for k, t in zip(langs, total, strict=True)]])
    order = np.argsort(gram, kind="stable")
    return Model(langs, SMOOTHING / total, np.searchsorted(gram[order], np.arange(size + 1)), lang[order], p[order])


def infer(model: Model, grams: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Languages and their proportions, largest first, for a document's trigrams."""
    grams, w = np.unique(grams, return_counts=True)
    w, own = w.astype(float), model.rows(grams)
    chosen = [int(np.argmax(w @ np.log(own)))]
    share, best = np.ones(1), float(w @ np.log(own[:, chosen[0]]))
    everyone, _ = _mixture(own, w)
    cost = PENALTY * np.log(w.sum() + 1)
    for k in np.argsort(-everyone, kind="stable"):
        if int(k) in chosen:
            continue
        more, fit = _mixture(own[:, [*chosen, int(k)]], w)
        if fit - best <= cost:
            break
        chosen, share, best = [*chosen, int(k)], more, fit
    order = np.argsort(-share, kind="stable")
    return [chosen[i] for i in order], share[order]


def learn(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of every language, from at most SAMPLE_DOCS rows a language with a text and a language.

    The sample is the lowest rows by a hash of the id: first the ids alone are ranked, then only the chosen texts are
    read on.  What reaches the driver is the distinct trigrams of a language's sample with their counts, 2^BITS at most.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull())
    chosen = checkpointed(lowest_by_hash(rows.select("id", "lang"), "lang", "id", SAMPLE_DOCS, 6).distinct())
    few = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
    sample = rows.join(few, ["id", "lang"], "left_semi")
    sample = lowest_by_hash(sample, "lang", "id", SAMPLE_DOCS, 6)  # again, as rows may repeat an id

    def count(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << BITS, np.int64)
        for text in t["text"]:
            total += np.bincount(trigrams(text.as_py()), minlength=1 << BITS)
        seen = np.flatnonzero(total)
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (seen.astype("<i4"), total[seen].astype("<i8"))]
        return pa.table([t["lang"].slice(0, 1), *blobs], ["lang", "grams", "counts"])

    parts = sample.groupBy("lang").applyInArrow(count, "lang string, grams binary, counts binary").collect()
    return model_of({r.lang: (np.frombuffer(r.grams, "<i4"), np.frombuffer(r.counts, "<i8")) for r in parts})


def judge(model: Model, text: str | None) -> tuple[str, float, list[str], list[float]]:
    """(lang_pred, score, langs, shares) of a text; ``und``, 0, and empty lists if no language can be told."""
    grams = trigrams(text or "") if model.langs else ()
    if not len(grams):
        return "und", 0.0, [], []
    which, share = infer(model, grams)
    return model.langs[which[0]], min(1.0, float(share[0])), [model.langs[k] for k in which], share.tolist()


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, langs, shares) of every row from its whole text alone.

    ``score`` is the share of the predicted language.  Null texts, texts without a letter, and all texts if nothing was
    learned get ``und``, 0, and empty lists.  Ties go to the language first in order; repeated rows are judged each; an
    empty table gives an empty result; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 12 bytes a distinct trigram of a language's sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                out.append((doc_id, *judge(model, text.as_py())))
            if out:
                types = [pa.int64(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "langs", "shares"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(trimmed(run), SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the training rows of ``docs`` and predict all of its rows."""
    return predict(docs, learn(docs.where(train_row(F.col("doc_id")))))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` for which ``identify`` tells a language, mixtures whatever their shares, all columns kept.

    The decision is made where the row is: whole texts don't go through a shuffle for it.  Without a language learned
    no row stays; an empty table gives an empty result; extra columns pass as they are, whatever their names.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(learn(docs.where(train_row(F.col("doc_id")))))

    @F.pandas_udf("boolean")
    def known(texts):
        model = shipped.value
        return texts.map(lambda text: judge(model, text)[0] != "und").astype(bool)

    return docs.where(known(F.col("text")))
