"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all ways to cut it into pieces, which a
forward pass over its letters gives without listing them; a text's is the
product over its words.  The piece probabilities are learned by expectation
and maximisation over the same lattice.

A word is a run of letters and the marks on them, in lower case, with the
vocabulary's mark of a word start before it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import dice, named, share, table
from pressloom.session import cut_lineage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Words are learned from in parts of so many letters; they are scored whole.
LEARN_LETTERS = 24
UNKNOWN_LANGUAGE = "und"
#: Documents that a language is learned from, about; the model needs no more,
#: and prediction covers all.
LEARN_DOCS = 4_000
ROUNDS = 3
#: Added to each expected count.
SMOOTHING = 0.1
#: Of a letter that no piece has.
UNKNOWN_LETTER = 1e-10
#: Forward sums are brought back to about one after so many letters.
RESCALE = 12
SEED = 4
#: Numbers of the lattices that are held at once.
BATCH = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces of letters and word starts; the others never meet a word."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    fits = regex.compile(rf"{START}?[\p{{L}}\p{{M}}]*")
    return sorted({p for p in every if p and fits.fullmatch(p) and p == p.lower()})


class Lattice:
    """Which pieces stand where in words."""

    def __init__(self, vocabulary: list[str]):
        hashes = np.array([self._hash(np.array([list(map(ord, p))], np.uint64))[0] for p in vocabulary], np.uint64)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have one hash")
        self.leading = np.zeros(1 << 20, bool)
        self.leading[hashes >> np.uint64(44)] = True
        self.longest = max(map(len, vocabulary), default=1)

    @staticmethod
    def _hash(letters: np.ndarray) -> np.ndarray:
        total = np.zeros(len(letters), np.uint64)
        for column in letters.T:
            total = total * _BASE + column
        return (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)

    def edges(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """From, to, which words have a piece there, and the piece; words have equal lengths.

        Each letter alone is an edge of every word, with piece -1 if there is none.
        """
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)
        for end in range(1, letters.shape[1] + 1):
            for start in range(max(0, end - self.longest), end):
                hashes = self._hash(letters[:, start:end])
                maybe = np.flatnonzero(self.leading[hashes >> np.uint64(44)])
                at = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
                hit = self.sorted[at] == hashes[maybe]
                rows, piece = maybe[hit], self.order[at[hit]]
                if end - start == 1:
                    whole = np.full(len(words), -1)
                    whole[rows] = piece
                    rows, piece = np.arange(len(words)), whole
                if len(rows):
                    yield start, end, rows, piece

    def batches(self, words: list[str], numbers: int) -> Iterator[np.ndarray]:
        """Places of words of equal length, some at a time, that need so many numbers a letter."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield from np.array_split(at, -(-len(at) * int(length + 1) * numbers // BATCH))

    def likelihoods(self, words: list[str], model: np.ndarray) -> np.ndarray:
        """Logarithm of each word's probability in each language: the forward sums at its end.

        ``model`` has a row a piece and one more for an unknown letter.  Only
        the sums that the longest piece reaches back to are held, and they are
        rescaled as the word goes on, so words may have any length.
        """
        out = np.empty((len(words), model.shape[1]))
        width = self.longest + 1
        for at in self.batches(words, model.shape[1]):
            some = [words[i] for i in at]
            sums = np.zeros((width, len(some), model.shape[1]))
            sums[0] = 1
            scale, last = np.zeros((len(some), 1)), 0
            for start, end, rows, piece in self.edges(some):
                if end != last:
                    if last and last % RESCALE == 0:
                        top = sums[last % width].max(1, keepdims=True)
                        sums /= top
                        scale += np.log(top)
                    sums[end % width], last = 0, end
                sums[end % width, rows] += sums[start % width, rows] * model[piece]
            out[at] = np.log(np.maximum(sums[last % width], np.finfo(float).tiny)) + scale
        return out

    def expected(self, words: list[str], counts: np.ndarray, model: np.ndarray) -> np.ndarray:
        """How often each piece is used in so many of each word, over all ways to cut it, by one language's model."""
        total = np.zeros(len(model))
        for at in self.batches(words, 2 * self.longest):
            some = [words[i] for i in at]
            edges = list(self.edges(some))
            n = len(some[0])
            ahead, behind = np.zeros((n + 1, len(some))), np.zeros((n + 1, len(some)))
            ahead[0] = behind[n] = 1
            for start, end, rows, piece in edges:
                ahead[end, rows] += ahead[start, rows] * model[piece]
            for start, end, rows, piece in sorted(edges, key=lambda e: -e[0]):
                behind[start, rows] += behind[end, rows] * model[piece]
            weight = counts[at] / ahead[n]
            for start, end, rows, piece in edges:
                np.add.at(total, piece, ahead[start, rows] * model[piece] * behind[end, rows] * weight[rows])
        return total


def _frame(lang: str, **columns) -> pd.DataFrame:
    """Rows of one language, its name held as an object: Arrow takes an empty column of the string type for no array."""
    frame = pd.DataFrame(columns)
    frame.insert(0, "lang", pd.Series([lang] * len(frame), dtype=object))
    return frame


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: dict[str, Counter] = {}
        for lang, text in zip(frame["lang"], frame["text"]):
            counts.setdefault(lang, Counter()).update(
                word[at : at + LEARN_LETTERS] for word in WORD.findall(text.lower()) for at in range(0, len(word), LEARN_LETTERS))
        for lang, words in counts.items():
            if words:
                yield _frame(lang, word=pd.Series(list(words), dtype=object), n=list(words.values()))


def fit(labelled: DataFrame, path: str = VOCABULARY, learn_docs: int = LEARN_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages, and probabilities: a row a piece and one for unknown letters, a column a language.

    ``labelled`` has ``id text lang`` without nulls.  About ``learn_docs``
    documents a language are drawn by their id.  What comes to the driver is
    one number a piece and language; the vocabulary is fixed.  Jobs run here.
    """
    spark = labelled.sparkSession
    # Saved, so that Catalyst knows it for small and no text moves to meet it.
    sizes = cut_lineage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")))
    languages = sorted(r.lang for r in sizes.select("lang").collect())
    vocabulary = pieces(path)
    unknown = np.full((1, max(1, len(languages))), UNKNOWN_LETTER)
    model = np.vstack([np.full((len(vocabulary), len(languages)), 1 / len(vocabulary)), unknown[:, : len(languages)]])
    drawn = labelled.join(sizes.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).where(
        share(dice(SEED, F.col("id"))) * F.col("docs") < learn_docs)
    counts = cut_lineage(
        drawn.select("lang", "text").mapInPandas(_counted, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    lattice = Lattice(vocabulary)
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((lattice, languages, model))

        def use(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own, names, now = sent.value
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    words = [START + w for w in part["word"]]
                    used = own.expected(words, part["n"].to_numpy(float), now[:, names.index(lang)])
                    at = np.flatnonzero(used[:-1])
                    if len(at):
                        yield _frame(lang, piece=at, used=used[at])

        used = counts.mapInPandas(use, "lang string, piece bigint, used double").groupBy("lang", "piece").agg(
            F.sum("used").alias("used")).toPandas()
        table_ = np.full((len(vocabulary), len(languages)), SMOOTHING)
        np.add.at(table_, (used["piece"].to_numpy(int), used["lang"].map(languages.index).to_numpy(int)), used["used"].to_numpy())
        model = np.vstack([table_ / table_.sum(0), unknown])
        sent.unpersist()
    return languages, model


def predictor(spark: SparkSession, languages: list[str], model: np.ndarray, path: str = VOCABULARY):
    """A function of a text column: struct of the language and its posterior probability, languages being equal before."""
    sent = spark.sparkContext.broadcast((Lattice(pieces(path)), languages, model))

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lattice, names, probabilities = sent.value
        places: dict[str, int] = {}
        owner, tokens = [], []
        for i, text in enumerate(texts):
            found = [places.setdefault(w, len(places)) for w in WORD.findall(text.lower())] if text else []
            owner.append(len(found))
            tokens.append(np.array(found, np.int32))
        sizes = np.array(owner)
        lang, score = np.full(len(sizes), UNKNOWN_LANGUAGE, object), np.zeros(len(sizes))
        known = np.flatnonzero(sizes)
        if len(known) and names:
            each = lattice.likelihoods([START + w for w in places], probabilities)
            for i in known:
                total = each[tokens[i]].sum(0)
                best = int(total.argmax())
                lang[i], score[i] = names[best], 1 / np.exp(total - total[best]).sum()
        return pd.DataFrame({"lang": pd.Series(lang, dtype=object), "score": score})

    return predict


def held_out(key: str) -> Column:
    """Documents that nothing is learned from: crc32 of the key's text leaves 2 by four."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predicted(
    docs: DataFrame, keep: list[str] | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang",
    path: str = VOCABULARY, learn_docs: int = LEARN_DOCS,
) -> DataFrame:
    """``row_`` (columns to keep), ``held_out``, ``lang_pred`` and ``score``.

    A text that is null or without a letter is ``und`` with score 0, and so is
    every text where nothing can be learned.  Repeated rows are learned from as
    often as they stand there and get equal predictions.
    """
    kept = docs.columns if keep is None else keep
    known = docs.where(~held_out(key)).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    predict = predictor(docs.sparkSession, *fit(known, path, learn_docs), path)
    rows = docs.select(F.struct(*named(kept)).alias("row_"), held_out(key).alias("held_out"), predict(text).alias("guess"))
    return rows.select("row_", "held_out", F.col("guess.lang").alias("lang_pred"), "guess.score")


def op4_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return predicted(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "row_.doc_id", "held_out", "lang_pred", "score")
