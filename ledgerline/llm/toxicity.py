"""Toxicity by weak supervision.

1. Lexicons: over all labelled rows that are not held out, words, their beginnings of four, five and six bytes and their
   endings are counted by label. What toxic rows hold beyond chance becomes an entry. Each kind of evidence is a lexicon of
   its own, words two: strong ones and the rest. A lexicon holds what stands out most, ENTRIES in all, of LONGEST bytes at most (of
   longer words the beginnings and endings), so that what is shipped to the executors is bounded whatever the corpus.
2. Voters: each lexicon votes when a text holds one of its entries; further voters look for a public list of insults, for
   several hits, for words disguised by digits, shouting, repeated marks, and the absence of any hit.
3. Label model: the votes of all documents are counted by pattern (at most 2^VOTERS patterns, whatever the corpus). A
   two-class generative model is fitted to the counts by expectation-maximisation; patterns of labelled rows count with their
   labels. Correlations are factors of the model: after a start with independent voters, each voter but one depends, within
   either class, on the class and on the voter it goes along with most (the tree of largest mutual information given the
   class, built anew until it stands), and accuracies and ties are fitted together. A voter that repeats another adds nothing.
4. Classifier: a logistic regression over lexicon entries and votes, trained on the posterior labels of a bounded sample
   (about `rows` documents, and about `sample` rows of either label, whose posterior is their label), scores every whole text.
   What is drawn follows from votes and entries alone: of rows that hold the same ones their number times the share is taken,
   rounded up or down by a hash of them. Ids, repeats, the layout of the files and tasks that run again change nothing of it.

labels, lang, source and doc_id are no inputs of a score. A null or empty text holds nothing and is scored as such. Rows
without a label, or with a null one, teach nothing; a doc_id labelled twice counts as toxic if one label is; documents that
share a labelled doc_id all teach. Without any label the insults alone vote. Repeated rows are scored alike; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import raw, shipped, slices, small, stored, tidied

SAMPLE, CLASSIFIER_ROWS, LEAST_Z, LEAST_ODDS, LEAST_ROWS, STRONG_Z, KEPT = 4000, 20000, 5.0, 2.0, 4, 10.0, 200_000
ENTRIES, LONGEST = 100_000, 64
STARTS, ENDING = (4, 5, 6), 4
LEXICONS = ("strong words", "words", *(f"beginnings of {n}" for n in STARTS), "endings")
RULES = ("insult", "several hits", "disguised", "shouting", "exclamation", "masked", "no hit")
VOTERS = len(LEXICONS) + len(RULES)

# A short public list of English insults.
INSULTS = ["clown", "disgusting", "dumb", "fool", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless"]

TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: The same, with digits and signs read as the letters they stand for in disguised words.
DISGUISE = dict(zip(b"0134579@$", b"oieastgas"))
TO_DISGUISED = bytes(DISGUISE.get(b, TO_WORDS[b]) for b in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def entries(text: bytes) -> set[bytes]:
    """Words; with a star after them their beginnings, with one before them their endings."""
    found = set(text.translate(TO_WORDS).split())
    return found | {w[:n] + b"*" for w in found for n in STARTS if len(w) >= n} | {b"*" + w[-ENDING:] for w in found if len(w) >= ENDING}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """toxic, text in; entry and rows of either label that hold it out. What is held is passed on at KEPT entries."""

    def out(sums: dict[bytes, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array([x[0] for x in sums.values()], pa.int64()), pa.array([x[1] for x in sums.values()], pa.int64())], ["entry", "clean", "toxic"])

    sums: dict[bytes, list[int]] = {}
    for part in slices(batches):
        for toxic, text in zip(part.column(0).to_pylist(), raw(part.column(1))):
            for e in entries(text):
                if e in sums:
                    sums[e][toxic] += 1
                else:
                    sums[e] = [1 - toxic, toxic]
            if len(sums) >= KEPT:
                yield out(sums)
                sums = {}
    if sums:
        yield out(sums)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, text of all documents with a label that are not held out."""
    known = known_labels(labels)
    right = small(known)
    joined = docs.select("doc_id", "text").join(right, F.col("doc_id") == F.col("__id")).select("toxic", "text")
    return stored(joined, "labelled") if right is known else joined  # joined by shuffling: once for all uses


def mine(rows: DataFrame, n: tuple[int, int], most: int = ENTRIES) -> list[tuple[bytes, float]]:
    """The entries that toxic rows hold beyond chance, and how far beyond (z), the strongest first, `most` of them."""
    counts = rows.mapInArrow(tidied(_count), "entry binary, clean bigint, toxic bigint").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    clean, toxic = F.col("clean"), F.col("toxic")
    expected = (clean + toxic) * (n[1] / (n[0] + n[1]))
    odds = F.log((toxic + 0.5) / (n[1] + 1)) - F.log((clean + 0.5) / (n[0] + 1))
    z = (toxic - expected) / F.sqrt(expected + 0.25)
    found = counts.where((toxic >= LEAST_ROWS) & (z >= LEAST_Z) & (odds >= LEAST_ODDS) & (F.octet_length("entry") <= LONGEST + 1))
    return [(bytes(r["entry"]), r["z"]) for r in found.select("entry", z.alias("z")).orderBy(F.desc("z"), "entry").limit(most).collect()]


class Voters:
    def __init__(self, mined: list[tuple[bytes, float]]):
        own = [e for e, _ in mined]
        insults = [w for w in map(str.encode, INSULTS) if w not in set(own)]
        self.insults = frozenset(map(str.encode, INSULTS))
        self.words = {e: k for k, e in enumerate([*own, *insults]) if b"*" not in e}
        self.starts = [{e[:-1]: k for k, e in enumerate(own) if e[-1:] == b"*" and len(e) == n + 1} for n in STARTS]
        self.ends = {e[1:]: k for k, e in enumerate(own) if e[:1] == b"*"}
        self.strong = frozenset(e for e, z in mined if b"*" not in e and z >= STRONG_Z)
        self.weak = frozenset(e for e, z in mined if b"*" not in e and z < STRONG_Z)
        self.entries = len(own) + len(insults)

    def look(self, text: bytes) -> tuple[int, list[int]]:
        """Votes as bits, and the numbers of the entries it holds."""
        found = set(text.translate(TO_WORDS).split())
        words = self.words.keys() & found
        starts = [own.keys() & {w[:n] for w in found} for n, own in zip(STARTS, self.starts)]
        ends = self.ends.keys() & {w[-ENDING:] for w in found}
        hits = [self.words[w] for w in words]
        for own, got in zip(self.starts, starts):
            hits += [own[w] for w in got]
        hits += [self.ends[w] for w in ends]
        upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        lower = len(text) - len(text.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
        disguised = set(text.translate(TO_DISGUISED).split()) - found
        says = (
            not self.strong.isdisjoint(words), not self.weak.isdisjoint(words), *map(bool, starts), bool(ends),
            not self.insults.isdisjoint(found), len(hits) >= 3, not disguised.isdisjoint(self.insults) or not disguised.isdisjoint(self.strong),
            upper > 2 * lower and upper > 20, b"!!" in text, b"***" in text or b"%%%" in text, not hits,
        )
        return sum(1 << k for k, holds in enumerate(says) if holds), sorted(hits)


class LabelModel:
    """Class share, for each voter and class how often it votes if voters are independent (rate, the start), and the fitted
    model: the voter that each depends on (parents, -1: none) and, by class and by that one's vote, how often it votes (given)."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray, rounds: int = 100, tied_rounds: int = 50):
        """Counts of each pattern over all documents, and over the labelled rows of either kind."""
        votes = self.unpack(patterns)
        name = np.array([*LEXICONS, *RULES])
        last, quiet = name == "no hit", np.isin(name, ("disguised", "shouting", "exclamation", "masked"))
        known = toxic.sum() + clean.sum()
        self.share = float(np.clip(toxic.sum() / known if known else 0.1, 0.01, 0.5))
        self.rate = np.stack((np.where(last, 0.9, np.where(quiet, 0.1, 0.02)), np.where(last, 0.05, np.where(quiet, 0.1, 0.4))))
        self.parents = np.full(VOTERS, -1)
        self.given = np.repeat(self.rate[:, :, None], 2, axis=2)
        settled = False
        for t in range(rounds + tied_rounds):
            q = self.posterior(patterns)
            mass = np.stack(((1 - q) * counts + clean, q * counts + toxic))
            total = mass.sum(axis=1)
            rate = np.clip((mass @ votes + 1) / (total[:, None] + 2), 1e-6, 1 - 1e-6)
            if not known:
                self.share = float(np.clip(total[1] / max(total.sum(), 1), 0.001, 0.5))
            both = np.stack([votes.T @ (m[:, None] * votes) for m in mass])  # votes of two voters together
            if t < rounds:
                self.rate = rate
            elif not settled:
                before, self.parents = self.parents, self.tree(both, total)
                settled = bool((before == self.parents).all())
            self.given = self.conditionals(both, total, rate)

    @staticmethod
    def tree(both: np.ndarray, total: np.ndarray) -> np.ndarray:
        """For each voter the one it depends on: a spanning tree, from voter 0, of the largest mutual information given the class."""
        one = np.einsum("yii->yi", both)
        cells = {(1, 1): both, (1, 0): one[:, :, None] - both, (0, 1): one[:, None, :] - both, (0, 0): total[:, None, None] - one[:, :, None] - one[:, None, :] + both}
        gain = np.zeros((VOTERS, VOTERS))
        for (a, b), n in cells.items():
            left, right = (one if a else total[:, None] - one), (one if b else total[:, None] - one)
            chance = left[:, :, None] * right[:, None, :]
            here = (n > 1e-9) & (chance > 0)
            gain += np.where(here, n * np.log(np.where(here, n * total[:, None, None] / np.where(here, chance, 1), 1)), 0).sum(axis=0)
        parents, best, free = np.full(VOTERS, -1), np.zeros(VOTERS, int), list(range(1, VOTERS))
        while free:
            k = max(free, key=lambda v: (gain[best[v], v], -v))
            parents[k] = best[k]
            free.remove(k)
            best = np.array([k if gain[k, v] > gain[best[v], v] else best[v] for v in range(VOTERS)])
        return parents

    def conditionals(self, both: np.ndarray, total: np.ndarray, rate: np.ndarray) -> np.ndarray:
        """How often each votes by class and by the vote of what it depends on; two votes at its own rate are added to each."""
        child = np.arange(VOTERS)
        one = np.einsum("yii->yi", both)
        voted, together = one[:, self.parents], both[:, self.parents, child]
        n = np.stack((total[:, None] - voted, voted), axis=2)
        hits = np.stack((one - together, together), axis=2)
        tied = (hits + 2 * rate[:, :, None]) / (n + 2)
        return np.clip(np.where((self.parents >= 0)[None, :, None], tied, rate[:, :, None]), 1e-6, 1 - 1e-6)

    @staticmethod
    def unpack(patterns: np.ndarray) -> np.ndarray:
        return (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        votes = self.unpack(patterns)
        above = np.where(self.parents >= 0, votes[:, self.parents], 0).astype(int)
        rate = self.given[:, np.arange(VOTERS), above]
        says = np.where(votes == 1, np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0])))
        logit = math.log(self.share / (1 - self.share)) + says.sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def logistic(hits: list[list[int]], dense: np.ndarray, y: np.ndarray, times: np.ndarray, entries_: int, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights (entries, then votes) and intercept on soft labels, by Adam. hits: for each row the entries it holds; times: how
    often it counts."""
    n, width = len(y), entries_ + dense.shape[1]
    at = np.repeat(np.arange(n), [len(h) for h in hits])
    entry = np.array([k for h in hits for k in h], np.int64)
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = np.bincount(at, w[entry], n) + dense @ w[entries_:] + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * times / times.sum()
        g = np.append(np.concatenate((np.bincount(entry, error[at], entries_), dense.T @ error)) + decay * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


class Model:
    def __init__(self, voters: Voters, weights: np.ndarray, intercept: float):
        self.voters, self.weights, self.intercept = voters, weights, intercept

    def scores(self, votes: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """votes of each text, the entries of all texts one after another, and how many each text has."""
        rows = np.repeat(np.arange(len(votes)), counts)
        z = self.intercept + np.bincount(rows, self.weights[hits], len(votes)) + LabelModel.unpack(votes) @ self.weights[-VOTERS:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def looked(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id, votes, hits of each row of docs, written: what the later steps need of the texts, which are read once for it."""
    get = shipped(docs.sparkSession.sparkContext, voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = get().look
        for part in slices(batches):
            seen = [look(t) for t in raw(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v for v, _ in seen], pa.int32()), pa.array([h for _, h in seen], pa.list_(pa.int32()))], ["doc_id", "votes", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, votes int, hits array<int>"), "looked")


def known_labels(labels: DataFrame) -> DataFrame:
    """__id, toxic of each labelled id that is not held out."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return known.select(F.col("doc_id").alias("__id"), "toxic")


def copies_drawn(rows: DataFrame, share: Column) -> DataFrame:
    """Distinct rows and how many of their copies (times) are drawn at this share: exact to the next whole number, which a hash of
    the row chooses, so that any layout draws the same."""
    grouped = rows.groupBy(*rows.columns).count()
    chance = F.xxhash64(*rows.columns).cast("double") / float(1 << 64) + 0.5
    return grouped.select(*rows.columns, F.floor(F.col("count") * F.least(share, F.lit(1.0)) + chance).alias("times")).where("times > 0")


def train(seen: DataFrame, labels: DataFrame, voters: Voters, sample: int = SAMPLE, rows: int = CLASSIFIER_ROWS) -> Model:
    """seen: looked."""
    told = seen.join(small(known_labels(labels)), F.col("doc_id") == F.col("__id")).select(F.col("toxic").alias("label"), "votes", "hits")
    every = seen.select(F.lit(-1).alias("label"), "votes", "hits")
    counted = every.select("label", "votes").unionByName(told.select("label", "votes"))
    table = counted.groupBy("votes").pivot("label", [-1, 0, 1]).count().fillna(0).orderBy("votes").collect()  # at most 2^VOTERS rows
    patterns, all_, clean, toxic = (np.array([r[k] for r in table], np.int64) for k in ("votes", "-1", "0", "1"))
    total = int(all_.sum())
    if not total:
        return Model(voters, np.zeros(voters.entries + VOTERS), 0.0)
    model = LabelModel(patterns, all_, toxic, clean)
    n = int(clean.sum()), int(toxic.sum())
    share = F.when(F.col("label") < 0, rows / total).when(F.col("label") == 1, sample / max(n[1], 1)).otherwise(sample / max(n[0], 1))
    taken = sorted(copies_drawn(every.unionByName(told), share).collect())  # about rows + 2 * sample at most
    if not taken:
        return Model(voters, np.zeros(voters.entries + VOTERS), 0.0)
    votes, label, times = (np.array([r[k] for r in taken], np.int64) for k in ("votes", "label", "times"))
    y = np.where(label < 0, model.posterior(votes), label)
    return Model(voters, *logistic([r["hits"] for r in taken], LabelModel.unpack(votes), y, times, voters.entries))


def scores(seen: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of seen."""
    get = shipped(seen.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = get().scores
        for part in batches:
            counts = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score(part.column(1).to_numpy(zero_copy_only=False), part.column(2).flatten().to_numpy(zero_copy_only=False), counts))], ["doc_id", "score"])

    kind = seen.schema["doc_id"].dataType.simpleString()
    out = seen.mapInArrow(tidied(run), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rows: int = CLASSIFIER_ROWS) -> DataFrame:
    labelled = labelled_rows(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n = sizes.get(0, 0), sizes.get(1, 0)
    voters = Voters(mine(labelled, n) if min(n) else [])
    seen = looked(docs, voters)
    return scores(seen, train(seen, labels, voters, sample, rows))
