"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, whatever is no letter becomes a space, and all windows of one, two and three characters are hashed
into BINS bins an order. The model is a matrix of log probabilities (bins by languages), broadcast to the workers; a batch
of texts is scored in numpy: rows of the matrix are gathered for the windows and summed within each text.

The model is fitted on a bounded sample of labelled rows: about PER_LANGUAGE rows of each language, drawn row by row (all
rows where there are fewer), so ids that repeat or are null do not make it larger. All languages count as equally frequent
(a uniform prior), as labels need not be dealt as texts are. Every whole text is scored.

A null text or one without a letter is `und`, score 0; so is every text where nothing was learned. The score is the
posterior, tempered to at most EVIDENCE windows, so that it stays below 1. Ties go to the language that sorts first.
Repeated rows are scored alike; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import drawn, per_worker, sized, tidied

ORDERS, BINS, PER_LANGUAGE, EVIDENCE, SMOOTHING, SLICE = 3, 1 << 14, 2000, 200, 0.5, 1 << 18
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def windows(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order the bins of all windows, with the bounds of each text; and whether a text has a letter."""
    letters = per_worker(("letters",), _letters)
    low = [f" {t.lower()} " for t in texts]
    chars = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))
    starts = np.concatenate(([0], ends[:-1]))
    is_letter = letters[chars]
    has = np.add.reduceat(is_letter, starts, dtype=np.int64) > 0
    chars = np.where(is_letter, chars, np.uint32(32))
    found, mixed = [], np.zeros(len(chars), np.uint32)
    for order in range(1, ORDERS + 1):
        size = len(chars) - order + 1
        mixed = (mixed[:size] * np.uint32(0x9E3779B1)) ^ (chars[order - 1 :] * np.uint32(0x85EBCA6B))
        bins = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(18)) % np.uint32(BINS)
        bounds = np.stack((starts, np.maximum(starts, ends - order + 1)), axis=1)
        found.append((bins + np.uint32((order - 1) * BINS), bounds))
    return found, has


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text in; the counts of the bins that occur, for each language, out."""
    for part in sized(batches, 1, SLICE):
        langs = part.column(0).to_pylist()
        sums: dict[str, np.ndarray] = {}
        for bins, bounds in windows(part.column(1).to_pylist())[0]:
            for lang, (a, b) in zip(langs, bounds.tolist()):
                own = sums.setdefault(lang, np.zeros(ORDERS * BINS, np.int64))
                own += np.bincount(bins[a:b], minlength=ORDERS * BINS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bin", "n"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """labelled: text, lang. The languages, sorted, and their log probabilities (one row a bin)."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((ORDERS * BINS, 0), np.float32)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    taken = rows.select("lang", "text").where(drawn(share[F.col("lang")]))
    counts: dict[str, np.ndarray] = {lang: np.zeros(ORDERS * BINS) for lang in sorted(sizes)}
    summed = taken.mapInArrow(tidied(_counter), "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    for r in summed.collect():  # at most a row for each bin and language
        counts[r["lang"]][r["bin"]] = r["n"]
    matrix = np.stack(list(counts.values()), axis=1) + SMOOTHING
    each = matrix.reshape(ORDERS, BINS, -1)
    return list(counts), np.log(each / each.sum(axis=1, keepdims=True)).reshape(ORDERS * BINS, -1).astype(np.float32)


def _scored(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the number of its language (that after the last: none), the score, and whether it has a letter."""
    found, has = windows([t or "" for t in texts])
    total, n = np.zeros((len(texts), logs.shape[1])), np.zeros(len(texts), np.int64)
    if logs.shape[1]:
        for bins, bounds in found:
            gathered = np.concatenate((logs[bins], np.zeros((ORDERS, logs.shape[1]), np.float32)))
            some = bounds[:, 1] > bounds[:, 0]
            summed = np.add.reduceat(gathered, bounds.ravel(), axis=0, dtype=np.float64)[::2]
            total += np.where(some[:, None], summed, 0)
            n += bounds[:, 1] - bounds[:, 0]
        even = total * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
        odds = np.exp(even - even.max(axis=1, keepdims=True))
        best, score = odds.argmax(axis=1), odds.max(axis=1) / odds.sum(axis=1)
    else:
        best, score = np.zeros(len(texts), int), np.zeros(len(texts))
    unknown = ~has | (logs.shape[1] == 0)
    return np.where(unknown, logs.shape[1], best), np.where(unknown, 0.0, score), has


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score for each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = model.value
        names = [*names, UNKNOWN]
        for part in sized(batches, 1, SLICE):
            best, score, _ = _scored(part.column(1).to_pylist(), logs)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([names[k] for k in best]), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score; the model is learned from those rows of docs that have a lang and are not held out."""
    return predict(docs, *fit(docs.where(~held_out(F.col("doc_id")))))


def recognised(docs: DataFrame, wanted: Collection[str] | None = None, least: float = 0.0, named: str | None = None) -> DataFrame:
    """docs without those whose language is `und`, is not wanted (by default every learned one is) or scores under `least`.

    A null lang is filled with the prediction; all other values stay as they were. Each row goes by its own prediction,
    whatever other rows share its doc_id. Where nothing was learned, rows go by their letters alone and no lang is filled.
    With `named` each row also gets its prediction under that name, in place of a column of that name if there is one.
    """
    if named:
        docs = docs.withColumn(named, F.lit(UNKNOWN))
    names, matrix = fit(docs.where(~held_out(F.col("doc_id"))))
    model = docs.sparkSession.sparkContext.broadcast((names, matrix, None if wanted is None else sorted(wanted)))
    at, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs, only = model.value
        accepted = np.array([only is None or name in only for name in names] + [False])
        for part in sized(batches, at, SLICE):
            best, score, has = _scored(part.column(at).to_pylist(), logs)
            if named:
                place = part.schema.get_field_index(named)
                part = part.set_column(place, part.schema.field(place), pa.array([*names, UNKNOWN], part.column(place).type).take(pa.array(best)))
            if not names:
                yield part.filter(pa.array(has))
                continue
            column = part.column(lang)
            if column.null_count:
                column = pc.coalesce(column, pa.array([*names, None], column.type).take(pa.array(best)))
                part = part.set_column(lang, part.schema.field(lang), column)
            yield part.filter(pa.array(accepted[best] & (score >= least)))

    return docs.mapInArrow(tidied(run), docs.schema)
