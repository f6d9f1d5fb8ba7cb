"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

A text is read as letters and single gaps: letters are lower-cased, everything else is a gap.
For each language, counts of character sequences up to `ORDER` long give an interpolated
Kneser-Ney model: sequences of full length by their counts, shorter ones by the number of
different characters seen before them. The models of all languages lie in one array of hashes
per length, sorted, with a row of log-probabilities (one per language) for each hash. A text is
scored by the mean of its characters' log-probabilities; the lowest cross-entropy wins. A text
is rejected if even that is worse than what its language showed in texts kept for calibration.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolyard.llm.common import free_name

#: Characters of the longest sequences.
ORDER = 4
DISCOUNT = 0.75
#: Labelled documents per language from which models are learned; bounds them and their memory.
LEARN_DOCS = 600
#: Labelled documents per language, others than those, that tell what to reject.
CALIBRATE_DOCS = 200
#: Texts shorter than this are not rejected on their letters alone.
SURE_LETTERS = 40
#: A text is rejected from here on between what is usual in its language and what a text of
#: another language usually looks like (1 would be as strange as that).
STRANGE = 0.9
#: Characters scored at once.
BLOCK = 1 << 19
UNKNOWN = "und"
GAP = 32


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or the gap."""
    table = np.full(0x110000, GAP, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (char := chr(code)).isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def letters(text: str | None) -> np.ndarray:
    """Code points of a text: a gap, then letters with single gaps between words, then a gap.

    Empty for a text without a letter.
    """
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    folded = np.concatenate([[GAP], _folded()[raw], [GAP]])
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != GAP) | (folded[:-1] != GAP)
    folded = folded[keep].astype(np.uint64)
    return folded if len(folded) > 1 else folded[:0]


def longer(hashes: np.ndarray | None, codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the sequences of `length` characters, by place of the first; from those of one
    character less (None for single characters)."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = np.zeros(n, np.uint64) if hashes is None else hashes[:n] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= codes[length - 1 : length - 1 + n] + np.uint64(1)
    mixed ^= mixed >> np.uint64(29)
    return mixed


def sequences(codes: np.ndarray) -> list[np.ndarray]:
    """For each length from 1 to ORDER, a hash of the sequence that starts at each character."""
    found: list[np.ndarray] = []
    for length in range(1, ORDER + 1):
        found.append(longer(found[-1] if found else None, codes, length))
    return found


@dataclass
class Models:
    """Models of all languages: hashes[k] of the sequences of k + 1 characters, sorted; beside
    each hash, a column per language, the log-probability of its last character (logs) and the
    log-weight of shorter histories when the sequence is itself a history (back)."""

    languages: list[str]
    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    back: list[np.ndarray]
    unseen: np.ndarray
    limits: np.ndarray | None = None

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each character but the first, per language, given those before it.

        Characters whose longest sequence is known are done with one lookup. The others take the
        weight that their history gives to shorter ones, if it is known, and go on with those.
        """
        n = len(codes) - 1
        result = np.zeros((n, len(self.languages)), np.float32)
        seqs = sequences(codes)
        ends = np.arange(ORDER - 1, n + 1)  # characters whose value is open
        for k in range(ORDER, 0, -1):
            if 1 <= k - 1 <= n and k < ORDER:  # has no longer history
                ends = np.concatenate([[k - 1], ends])
            if not len(ends):
                continue
            starts = ends - (k - 1)
            at, found = self._find(k, seqs[k - 1][starts])
            if found.all():
                result[ends - 1] += self.logs[k - 1][at]
                ends = ends[:0]
                continue
            result[ends[found] - 1] += self.logs[k - 1][at[found]]
            ends, starts = ends[~found], starts[~found]
            if k > 1:
                at, known = self._find(k - 1, seqs[k - 2][starts])
                result[ends[known] - 1] += self.back[k - 2][at[known]]
            else:
                result[ends - 1] += self.unseen
        return result

    def _find(self, length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes in the array of a length, and whether they are there."""
        table = self.hashes[length - 1]
        if not len(table):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        return at, table[at] == wanted

    def cross_entropies(self, text: str | None) -> tuple[np.ndarray, int]:
        """Mean negative log-probability per language, and the number of characters behind it."""
        codes = letters(text)
        n = len(codes) - 1
        if n < 1 or not self.languages:
            return np.zeros(len(self.languages)), 0
        total = np.zeros(len(self.languages))
        for start in range(0, n, BLOCK):
            history = min(start, ORDER - 1)
            scored = self.log_probabilities(codes[start - history : start + BLOCK + 1])
            total += scored[history:].sum(axis=0, dtype=np.float64)
        return -total / n, n

    def predict(self, text: str | None) -> tuple[str, float, bool, float | None]:
        """Language, score between 0 and 1, whether accepted, and cross-entropy."""
        entropy, n = self.cross_entropies(text)
        if not n or not self.languages:
            return UNKNOWN, 0.0, False, None
        best = int(np.argmin(entropy))
        weight = np.exp(-(entropy - entropy[best]) * min(n, 200))
        accepted = n < SURE_LETTERS or self.limits is None or entropy[best] <= self.limits[best]
        return self.languages[best], float(1 / weight.sum()), bool(accepted), float(entropy[best])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, len, seq, history, ending, n): how often each batch has a sequence; history lacks
    its last character, ending its first."""
    for batch in batches:
        by_lang: dict[str, list[list[np.ndarray]]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by_lang.setdefault(lang, []).append(sequences(letters(text.as_py())))
        for lang, texts in by_lang.items():
            for k in range(ORDER):
                skip = 1 if k == 0 else 0  # the opening gap is given, not predicted
                seq = np.concatenate([t[k][skip:] for t in texts])
                unique, first, n = np.unique(seq, return_index=True, return_counts=True)
                history = ending = np.zeros(len(unique), np.uint64)
                if k:
                    history = np.concatenate([t[k - 1][: len(t[k])] for t in texts])[first]
                    ending = np.concatenate([t[k - 1][1 : len(t[k]) + 1] for t in texts])[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(unique), pa.string()),
                        pa.array(np.full(len(unique), k + 1, np.int32)),
                        *[pa.array(x.view(np.int64)) for x in (unique, history, ending)],
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "len", "seq", "history", "ending", "n"],
                )


def estimate(counts: pd.DataFrame) -> Models:
    """Interpolated Kneser-Ney models from (lang, len, seq, history, ending, n)."""
    languages = sorted(counts["lang"].unique().tolist())
    by_length = [counts.loc[counts["len"] == k, "seq"] for k in range(1, ORDER + 1)]
    hashes = [np.unique(seqs.to_numpy(np.int64).view(np.uint64)) for seqs in by_length]
    probs = [np.zeros((len(h), len(languages))) for h in hashes]
    weight = [np.ones((len(h), len(languages))) for h in hashes]  # of the lower order, per history
    known = [np.zeros((len(h), len(languages)), bool) for h in hashes]
    alphabet = len(hashes[0]) + 1
    for j, lang in enumerate(languages):
        mine = {k: g for k, g in counts[counts["lang"] == lang].groupby("len")}
        lower = np.full(len(hashes[0]), 1.0 / alphabet)
        for k in range(1, len(hashes) + 1):
            if k not in mine:
                break
            g = mine[k]
            seq = g["seq"].to_numpy().view(np.uint64)
            if k < len(hashes) and k + 1 in mine:  # by the number of characters seen before it
                before = mine[k + 1]["ending"].to_numpy().view(np.uint64)
                endings, n = np.unique(before, return_counts=True)
                at = np.minimum(np.searchsorted(endings, seq), len(endings) - 1)
                n = np.where(endings[at] == seq, n[at], 1).astype(float)
            else:
                n = g["n"].to_numpy().astype(float)
            place = np.searchsorted(hashes[k - 1], seq)
            if k == 1:
                total, kinds = n.sum(), len(n)
                probs[0][:, j] = DISCOUNT * kinds / total * lower
                probs[0][place, j] += np.maximum(n - DISCOUNT, 0) / total
            else:
                history = g["history"].to_numpy().view(np.uint64)
                groups, of = np.unique(history, return_inverse=True)
                total = np.bincount(of, weights=n)
                left = DISCOUNT * np.bincount(of) / total
                spot = np.searchsorted(hashes[k - 2], groups)
                weight[k - 2][spot, j] = left
                ending = g["ending"].to_numpy().view(np.uint64)
                below = probs[k - 2][np.searchsorted(hashes[k - 2], ending), j]
                probs[k - 1][place, j] = np.maximum(n - DISCOUNT, 0) / total[of] + left[of] * below
            known[k - 1][place, j] = True
    # a sequence that only other languages have: this one's shorter history, weighted down
    ends = counts.drop_duplicates(["len", "seq"])
    for k in range(2, len(hashes) + 1):
        g = ends[ends["len"] == k]
        place = np.searchsorted(hashes[k - 1], g["seq"].to_numpy().view(np.uint64))
        below = probs[k - 2][np.searchsorted(hashes[k - 2], g["ending"].to_numpy().view(np.uint64))]
        left = weight[k - 2][np.searchsorted(hashes[k - 2], g["history"].to_numpy().view(np.uint64))]
        probs[k - 1][place] = np.where(known[k - 1][place], probs[k - 1][place], left * below)
    return Models(
        languages,
        hashes,
        [np.log(p).astype(np.float32) for p in probs],
        [np.log(w).astype(np.float32) for w in weight],
        np.full(len(languages), np.log(1e-4), np.float32),
    )


def in_training(id_col: Column) -> Column:
    """Whether a document may be learned from: crc32 of its id as text is not 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 != 2, F.lit(False))


def learn(
    docs: DataFrame,
    learn_docs: int = LEARN_DOCS,
    calibrate_docs: int = CALIBRATE_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Models:
    """Models from a bounded sample of labelled documents.

    Of each language about `learn_docs` documents, drawn by a hash of their ids, are counted
    whole, and about `calibrate_docs` others tell the cross-entropy beyond which a text is
    rejected: `STRANGE` of the way from their median under the own model to their median under
    the best of the other models. With a single language nothing but the lack of letters rejects.
    """
    labelled = docs.filter(in_training(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 40)).alias("draw"),
    )
    # a row per language; one that is rarer than the sample is taken whole
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Models([], [], [], [], np.zeros(0, np.float32))
    share = {s: (learn_docs + calibrate_docs) / n for s, n in sizes.items()}
    bound = F.lit(0)
    for lang, s in share.items():
        bound = F.when(F.col("lang") == lang, F.lit(min(1 << 40, int(s * (1 << 40))))).otherwise(bound)
    # a repeated id counts once; with different texts the least of them, so that reruns agree
    drawn = labelled.withColumn("bound", bound).filter("draw < bound")
    drawn = drawn.groupBy("lang", "draw", "bound").agg(F.min("text").alias("text"))
    to_learn = F.col("draw") < F.col("bound") * (learn_docs / (learn_docs + calibrate_docs))
    counts = (
        drawn.filter(to_learn)
        .select("lang", "text")
        .mapInArrow(_counts, "lang string, len int, seq long, history long, ending long, n long")
        .groupBy("lang", "len", "seq", "history", "ending")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # bounded by the sample
    )
    if counts.empty:
        return Models([], [], [], [], np.zeros(0, np.float32))
    models = estimate(counts.sort_values(["lang", "len", "seq"]))
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                entropy, n = known.cross_entropies(text.as_py())
                if n >= SURE_LETTERS and lang in known.languages:
                    own = known.languages.index(lang)
                    others = np.delete(entropy, own)
                    rows.append((lang, float(entropy[own]), float(others.min()) if len(others) else None))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *[pa.array(c, pa.float64()) for c in columns[1:]]],
                names=["lang", "own", "other"],
            )

    half = F.lit(0.5)
    seen = (
        drawn.filter(~to_learn)
        .select("lang", "text")
        .mapInArrow(entropies, "lang string, own double, other double")
        .groupBy("lang")
        .agg(F.percentile("own", half).alias("own"), F.percentile("other", half).alias("other"))
        .collect()
    )
    # what texts look like to the model of a language they are not in
    strange = [r["other"] for r in seen if r["other"] is not None]
    if strange:
        middle = float(np.median(strange))
        limits = {r["lang"]: r["own"] + STRANGE * (middle - r["own"]) for r in seen}
        models.limits = np.array([limits.get(x, np.inf) for x in models.languages])
    return models


PREDICTION = "lang_pred string, score double, accepted boolean, cross_entropy double"


def predictor(spark: SparkSession, models: Models) -> Callable[[Column], Column]:
    """A function of a text column that gives PREDICTION as a struct. Models are bounded by the
    sample they were learned from and are sent to each executor once."""
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf(PREDICTION)
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        rows = [known.predict(t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "accepted", "cross_entropy"])

    return predict


def identify(
    docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score, accepted, cross_entropy.

    lang_pred is a learned language, or `und` for a text that is null or has no letter (score
    0, not accepted). score is the weight of the winner among all languages. accepted is false
    also where the cross-entropy is beyond the calibrated limit of the predicted language.
    Ties go to the language that comes first by code point. Nothing but the text is looked at,
    all of it, in blocks; rows are not moved. Repeated rows and null ids give a row each.
    """
    predict = predictor(docs.sparkSession, models)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), predict(F.col(text_col)).alias("found"))
    return found.select("doc_id", "found.*")


def accepted(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is accepted."""
    predict = predictor(docs.sparkSession, models)
    found = free_name(docs, "found")
    return docs.withColumn(found, predict(F.col(text_col))).filter(F.col(found)["accepted"]).select(*docs.columns)
