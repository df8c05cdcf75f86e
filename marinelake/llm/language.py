"""Language of a text, word by word, with backoff to character n-grams.

A known word is scored by its log frequency in each language. An unseen word falls
back to its longest known character n-grams, from four characters down to one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import crc32_of, lean, slices, small_batches, text_rows, texts_of
from marinelake.llm.registry import query, table

#: Labelled documents of a language that are learned from, about: a bound on the
#: sample. Documents are taken by a hash of their id, evenly over the table.
LEARNED_PER_LANGUAGE = 4000
#: Words and character n-grams that the model keeps. Every language has an equal share
#: of them for its own most frequent ones, and at least ``LEAST_SHARE``.
MAX_WORDS = 60_000
MAX_GRAMS = 60_000
LEAST_SHARE = 5000
LONGEST_GRAM = 4
#: Words whose evidence makes the score; more words would only push it to 1.
SCORE_WORDS = 20
UNDETERMINED = "und"
_LETTERS = r"[\p{L}\p{M}]+"
_REMEMBERED = 300_000
#: Text scored at once: every word of it has a row of scores.
_SLICE = 2 << 20


class LanguageModel:
    """Log frequencies of words and n-grams, one column per language."""

    def __init__(self, languages: list[str], words: dict, grams: dict, documents: dict):
        self.languages = languages
        self.words, self.word_scores = self._table(words)
        self.grams, self.gram_scores = self._table(grams)
        n = np.array([documents.get(x, 0) for x in languages], float)
        self.prior = np.log(n / n.sum()) if len(languages) else np.zeros(0)

    def _table(self, counts: dict) -> tuple[dict, np.ndarray]:
        """Add-one estimates, centred: 0 where all languages are equally likely."""
        index = {x: i for i, x in enumerate(sorted({x for x, _ in counts}))}
        n = np.zeros((len(index), len(self.languages)))
        place = {x: i for i, x in enumerate(self.languages)}
        for (x, language), count in counts.items():
            n[index[x], place[language]] = count
        scores = np.log(n + 1) - np.log(n.sum(axis=0) + len(index))
        return index, scores - scores.mean(axis=1, keepdims=True) if len(index) else scores

    def word(self, word: str) -> np.ndarray:
        at = self.words.get(word)
        if at is not None:
            return self.word_scores[at]
        marked = f" {word} "
        for n in range(min(LONGEST_GRAM, len(marked)), 0, -1):
            known = [self.grams[g] for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if g in self.grams]
            if known:
                return self.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.languages))


def learn_languages(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text") -> LanguageModel:
    """Learn from rows with text and a language. Rows without one teach nothing; no
    such row gives a model without languages, which leaves every text undetermined.

    The driver gets at most the shares of all languages in ``MAX_WORDS`` words and
    ``MAX_GRAMS`` n-grams, so a rare language keeps its words beside frequent ones."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    documents = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(documents)
    if not languages:
        return LanguageModel([], {}, {}, {})
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, LEARNED_PER_LANGUAGE / documents[k]))))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)
    taken = known.where(place < share[F.col("lang")])
    words = taken.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({_LETTERS})"), F.lit(1))).alias("item"))
    counted = words.groupBy("lang", "item").agg(F.count(F.lit(1)).alias("n")).cache()
    marked = F.concat(F.lit(" "), "item", F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(marked))
    parts = F.flatten(
        F.transform(F.sequence(F.lit(1), F.lit(LONGEST_GRAM)), lambda n: F.transform(F.filter(starts, lambda i: i + n - 1 <= F.length(marked)), lambda i: F.substring(marked, i, n)))
    )
    grams = counted.select("lang", "n", F.explode(parts).alias("item")).groupBy("lang", "item").agg(F.sum("n").alias("n"))

    def most(table: DataFrame, limit: int) -> dict:
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
        ranked = table.where("n > 1").withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(limit // len(languages), LEAST_SHARE))
        kept = table.join(ranked.select("item").distinct(), "item").select("item", "lang", "n").toArrow()
        return dict(zip(zip(kept.column("item").to_pylist(), kept.column("lang").to_pylist()), kept.column("n").to_pylist()))

    model = LanguageModel(languages, most(counted, MAX_WORDS), most(grams, MAX_GRAMS), documents)
    counted.unpersist()
    return model


def _scored(model: LanguageModel):
    """A function from texts to predicted languages and scores."""
    remembered: dict[str, int] = {}
    scores = np.zeros((0, len(model.languages)))

    def places(words: list[str]) -> np.ndarray:
        nonlocal remembered, scores
        new = [w for w in words if w not in remembered]
        if len(remembered) + len(new) > _REMEMBERED and remembered:
            remembered, scores, new = {}, scores[:0], words
        if new:
            remembered.update(zip(new, range(len(remembered), len(remembered) + len(new))))
            scores = np.concatenate([scores, np.array([model.word(w) for w in new]).reshape(len(new), -1)])
        return np.fromiter(map(remembered.__getitem__, words), np.int64, len(words))

    def score(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cleaned = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " "))
        cut = pc.split_pattern(cleaned, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        by_word = scores_of(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        n = np.diff(offsets)
        # A text has at least one word, be it empty; its sum is its own, whatever the batch.
        found = np.add.reduceat(by_word, offsets[:-1] - offsets[0], axis=0)
        total = found + model.prior
        evidence = found * (np.minimum(n, SCORE_WORDS) / np.maximum(n, 1))[:, None]
        odds = np.exp(evidence - evidence.max(axis=1, keepdims=True))
        best = total.argmax(axis=1)
        letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        return best, (odds / odds.sum(axis=1, keepdims=True))[np.arange(len(best)), best], letters

    def scores_of(words: list[str]) -> np.ndarray:
        at = places(words)
        return scores[at]

    return score


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score`` (0 to 1) of each whole text.

    Ties go to the language that is first by name. A text that is null or has no
    letter gets ``und`` and 0. Only the text is looked at. ``docs`` must not have the
    two new columns; their names may be chosen."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_WORDS and MAX_GRAMS
    schema = docs.withColumns({lang_pred: F.lit("").cast("string"), score: F.lit(0.0)}).schema

    def predict(batches):
        model = shared.value
        scored = _scored(model) if model.languages else None
        for batch in slices(batches, text, most=_SLICE):
            names, values = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            if scored:
                best, found, letters = scored(texts_of(batch, text))
                names = [model.languages[i] if some else UNDETERMINED for i, some in zip(best, letters)]
                values = np.where(letters, found, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(values)], [*batch.schema.names, lang_pred, score])

    return docs.mapInArrow(lean(predict), schema)


def identify_languages(docs: DataFrame, held_out: int = 2, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row: learn from the rows whose
    crc32 of the id, modulo 4, is not ``held_out``, and predict all. A row without an
    id is not learned from and not counted as held out."""
    fold = F.pmod(crc32_of(doc_id), F.lit(4))
    model = learn_languages(docs.where(fold != held_out), lang, doc_id, text)
    rows = text_rows(docs, doc_id, text)
    found = predict_languages(rows, model)
    return found.select("doc_id", F.coalesce(F.pmod(crc32_of("doc_id"), F.lit(4)) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
