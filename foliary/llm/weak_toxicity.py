"""Toxicity by weak supervision.

Voters are words of a fixed lexicon, words and word beginnings that training labels single out, and patterns of writing.
A generative model with a hidden class estimates by expectation-maximisation each voter's rate of firing in either class and,
from what remains together given the class, pairwise correlations, by which the weight of voters that say the same is
lowered. A linear classifier over the voters' counts is then trained on the model's posteriors and scores whole texts.

At most ``most_words`` words and ``most_beginnings`` beginnings are made voters, those that gain most; this bounds the model, not
the rows that are counted or scored. The fit is over a bounded sample, at most ``fit_rows`` labelled texts of least hashed doc_id outside the held-out fold, in
which known labels take part as one more voter of fixed accuracy. Without labels the lexicon alone votes. Scoring reads each
whole text once, without a shuffle. Null texts are empty texts and get a score too. A doc_id counts as toxic if any of its
labels is 1; null labels are left out. Repeated rows get equal scores; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import held_out, quiet_threads, slices, stage, texts
from foliary.llm.words import Words, style

# Insults of four languages.
LEXICON = {
    "en": "idiot stupid moron loser scum trash pathetic worthless disgusting clown imbecile dumb fool jerk bastard bitch asshole fuck shit crap retard whore slut filth vermin garbage",
    "de": "idiot dumm dummkopf blödmann arschloch scheiße scheisse trottel depp abschaum drecksau schlampe hure wichser widerlich wertlos erbärmlich versager",
    "fr": "idiot idiote stupide imbécile connard connasse salaud salope merde putain abruti crétin débile ordure minable dégoûtant pathétique",
    "es": "idiota estúpido estúpida imbécil cabrón gilipollas mierda puta basura escoria patético asqueroso inútil tonto payaso perdedor",
}
_BEGINNINGS = (3, 4, 5, 6, 7, 8)
_STYLE_VOTERS = {"shouts": (4, 0.5), "bangs": (9, 0.3)}  # place in the style features, least value


class Voters:
    """Whole words (with equality) and beginnings of words. ``kinds``: a name per voter."""

    def __init__(self, lexicon: list[str], words: list[str], beginnings: list[str]) -> None:
        self.exact, self.begin, self.kinds = {}, {}, []
        for group, found in (("lexicon", lexicon), ("word", words), ("beginning", beginnings)):
            for w in found:
                place = self.begin if group == "beginning" else self.exact
                if w not in place:
                    place[w] = len(self.kinds)
                    self.kinds.append(f"{group} {w}")
        self.kinds += list(_STYLE_VOTERS)

    def trusted(self) -> np.ndarray:
        """Voters that need no labels: the lexicon's words."""
        return np.array([k.startswith("lexicon") for k in self.kinds])

    def of_word(self, word: str) -> list[int]:
        out = [self.exact[word]] if word in self.exact else []
        if self.begin:
            out += [self.begin[b] for n in _BEGINNINGS if n <= len(word) and (b := word[:n]) in self.begin]
        return out

    def counts(self, array: pa.Array) -> np.ndarray:
        """Texts x voters: how often each fires; the last column is the number of words."""
        w = Words(array)
        fired = w.hits([self.of_word(x) for x in w.dictionary.to_pylist()], len(self.kinds))
        how = style(array)
        for i, (place, least) in enumerate(_STYLE_VOTERS.values()):
            fired[:, len(self.kinds) - len(_STYLE_VOTERS) + i] = how[:, place] >= least
        return np.column_stack([fired, w.counts])


def label_model(votes: np.ndarray, known: np.ndarray, known_accuracy: float = 0.98, rounds: int = 40, trusted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 per row, and each voter's weight after the discount for correlation.

    votes: rows x voters, 1 where a voter fires (else it abstains); known: 1, 0 or -1 (no label). trusted: voters whose votes
    rows without a label begin with (None: all). Correlations are first taken when the classes have settled: before, what the
    class itself explains would count as correlation."""
    n, m = votes.shape
    own = np.log(known_accuracy / (1 - known_accuracy))
    anchor = np.where(known == 1, own, np.where(known == 0, -own, 0.0))
    first = votes if trusted is None else votes[:, trusted]
    posterior = 1 / (1 + np.exp(-np.where(known >= 0, anchor, np.minimum(2.0 * first.sum(1), 4) - 2)))
    discount = np.ones(m)
    for i in range(rounds):
        in_one = (posterior @ votes + 0.5) / (posterior.sum() + 2)
        in_zero = ((1 - posterior) @ votes + 0.5) / ((1 - posterior).sum() + 20)
        weight = discount * np.log(in_one / in_zero)
        absent = np.log1p(-in_one) - np.log1p(-in_zero)
        prior = np.clip(posterior.mean(), 0.01, 0.99)
        margin = np.log(prior / (1 - prior)) + anchor + votes @ weight + (1 - votes) @ (absent * discount)
        posterior = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        if i % 10 == 9 and i > 10:
            rest = votes - np.outer(posterior, in_one) - np.outer(1 - posterior, in_zero)
            scale = rest.std(0) + 1e-6
            correlation = np.abs(rest.T @ rest / n / np.outer(scale, scale))
            np.fill_diagonal(correlation, 0)
            discount = 1 / (1 + np.where(correlation > 0.2, correlation, 0).sum(1))
    return posterior, weight


class Classifier:
    """Linear over the voters' counts (as logarithms), how many words fire and their share."""

    def __init__(self, voters: Voters, weight: np.ndarray, coefficients: np.ndarray) -> None:
        self.voters, self.weight, self.coefficients = voters, weight, coefficients

    @staticmethod
    def features(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
        fired, words = counts[:, :-1], np.maximum(counts[:, -1], 1)
        strong = fired[:, weight > 1.0]
        total = strong.sum(1)
        return np.column_stack([np.ones(len(counts)), np.log1p(fired), np.log1p(total), np.log1p((strong > 0).sum(1)), np.log1p(100 * total / words), np.log1p(words) / 5])

    def scores(self, array: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(self.voters.counts(array), self.weight) @ self.coefficients, -30, 30)))


def _regress(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft targets by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - target) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _mine(sample: DataFrame, n_toxic: int, n_clean: int, least: int, most_words: int, most_beginnings: int) -> tuple[list[str], list[str]]:
    """Words and beginnings that stand in toxic training texts far more often than in clean ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4_000_000):
                part = batch.slice(start, stop - start)
                w = Words(part.column("text"))
                toxic = part.column("label").to_numpy() == 1
                names = w.dictionary.to_pylist()
                seen: dict[str, list] = {}
                for pair in np.unique(w.doc * max(1, len(names)) + w.codes).tolist():
                    doc, code = divmod(pair, len(names))
                    word = names[code]
                    for key in ("w" + word, *("b" + word[:n] for n in _BEGINNINGS if n <= len(word))):
                        x = seen.get(key)
                        if x is None:
                            seen[key] = x = [-1, 0, 0]
                        if x[0] != doc:
                            x[0] = doc
                            x[1 + bool(toxic[doc])] += 1
                yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array([x[2] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64())], names=["key", "toxic", "clean"])

    counted = sample.mapInArrow(run, "key string, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lift = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    ranked = counted.where(F.col("toxic") >= least).withColumn("lift", lift).where("lift > 3").withColumn("gain", F.col("toxic") * F.col("lift"))
    out = []
    for kind, most in (("w", most_words), ("b", most_beginnings)):
        out.append([r.key[1:] for r in ranked.where(F.col("key").startswith(kind)).orderBy(F.desc("gain"), "key").limit(most).collect() if len(r.key) > 1])
    return out[0], out[1]


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, fit_rows: int = 8000, most_words: int = 80, most_beginnings: int = 60) -> Classifier:
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder)).groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = stage(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "fit-ids")
    sample = stage(texts(docs).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "fit-texts")
    by_label = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = by_label.get(1, 0), by_label.get(0, 0)
    lexicon = sorted({w for words in LEXICON.values() for w in words.split()})
    words, beginnings = _mine(sample, n_toxic, n_clean, max(3, n_toxic // 150), most_words, most_beginnings) if n_toxic and n_clean else ([], [])
    voters = Voters(lexicon, words, beginnings)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4_000_000):
                part = batch.slice(start, stop - start)
                yield pa.record_batch([part.column("label"), pa.array(list(voters.counts(part.column("text"))), pa.list_(pa.float64()))], names=["label", "counts"])

    found = sample.select("label", "text").mapInArrow(count, "label int, counts array<double>").toPandas()
    counts = np.array(found["counts"].tolist(), np.float64).reshape(len(found), len(voters.kinds) + 1)
    if not n_toxic or not n_clean:  # no labels of both kinds: each word of the lexicon weighs the same
        weight = np.array([2.0 if k.startswith("lexicon") else 0.0 for k in voters.kinds])
        coefficients = np.zeros(len(voters.kinds) + 5)
        coefficients[0], coefficients[len(voters.kinds) + 1] = -4.0, 4.0
        return Classifier(voters, weight, coefficients)
    posterior, weight = label_model((counts[:, :-1] > 0).astype(np.float64), found["label"].to_numpy(), trusted=voters.trusted())
    return Classifier(voters, weight, _regress(Classifier.features(counts, weight), posterior))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4_000_000):
                part = batch.slice(start, stop - start)
                yield pa.record_batch([part.column("doc_id"), pa.array(model.scores(part.column("text")))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 4, remainder: int = 2, fit_rows: int = 8000) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model = train(docs, labels, modulus, remainder, fit_rows)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def with_scores(docs: DataFrame, model: Classifier, name: str) -> DataFrame:
    """All columns of ``docs`` and the score of column text under ``name``: rows stay where they are."""
    from pyspark.sql.types import DoubleType, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for start, stop in slices(batch.column(at), 4_000_000):
                part = batch.slice(start, stop - start)
                found = model.scores(part.column(at))
                yield pa.record_batch([*part.columns, pa.array(found)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))
