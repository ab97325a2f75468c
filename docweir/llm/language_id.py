"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docweir.llm.common import checkpointed, id_crc, read, tidy

#: How many of the most frequent n-grams make a profile.
PROFILE = 300
#: Labelled documents per language that profiles are learned from, in expectation: whole texts, chosen by hash.
SAMPLE = 3000
#: Most languages whose profiles go to every task, at PROFILE numbers each.
MOST_LANGUAGES = 1000
UNKNOWN = "und"
Profiles = dict[str, tuple[np.ndarray, np.ndarray]]
#: An n-gram as a number: 21 bits a character, 0 for the edge of a word, and a bit that tells the length.
_SHIFT, _ONE, _TWO = 21, 1 << 61, 1 << 62


@cache
def _letters() -> np.ndarray:
    """Each code point, or 0 where it isn't a letter."""
    points = np.arange(0x110000, dtype=np.int64)
    points[[not chr(i).isalpha() for i in range(0x110000)]] = 0
    return points


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to three characters of a whole text, lower-cased, in the order of their numbers, and their counts."""
    points = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.zeros(len(points) + 2, np.int64)
    x[1:-1] = points
    x = x[np.append(True, (x[1:] != 0) | (x[:-1] != 0))]  # one edge between words
    if len(x) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = x[:-1] << _SHIFT | x[1:]
    triples = (pairs[:-1] << _SHIFT | x[2:])[x[1:-1] != 0]
    return np.unique(np.concatenate([x[x != 0] | _ONE, pairs | _TWO, triples]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by number."""
    if len(counts) > size:
        most = counts >= np.partition(counts, -size)[-size]
        grams, counts = grams[most], counts[most]
    return grams[np.lexsort((grams, -counts))[:size]]


def distance(grams: np.ndarray, profile: tuple[np.ndarray, np.ndarray], size: int = PROFILE) -> int:
    """Out-of-place distance to a profile, given as sorted n-grams and their ranks; an n-gram that it lacks is size places out."""
    known, ranks = profile
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    return int(np.where(known[at] == grams, np.abs(ranks[at] - np.arange(len(grams))), size).sum())


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, size: int = PROFILE) -> Profiles:
    """The most frequent n-grams and their ranks, by language.

    Learns from about `sample` documents a language (all, where there are fewer), chosen by a hash of
    id and text, and from rows that repeat once; rows without text or language are passed over. The
    driver gets size rows a language, so more than MOST_LANGUAGES are refused with an error.
    """
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = checkpointed(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    if sizes.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    known = labelled.where(F.col("text").isNotNull()).join(F.broadcast(sizes), "lang")  # a row for each language
    chance = F.pmod(F.xxhash64(F.lit(5), "id", "text"), F.lit(1 << 20))
    chosen = known.where(chance < F.ceil(F.lit(float((1 << 20) * sample)) / F.col("rows")))
    chosen = chosen.groupBy("lang", "id", F.xxhash64("text").alias("digest")).agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                found = [gram_counts(t) for i, t in zip(langs, texts) if i == lang]
                grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in found]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    counted = chosen.select("lang", "text").mapInArrow(tidy(count), "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = totals.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1).where(F.col("rank") < size)
    rows: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():
        rows.setdefault(row["lang"], []).append((row["gram"], row["rank"]))
    return {lang: tuple(np.array(sorted(found), np.int64).T) for lang, found in rows.items()}


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """docs with lang_pred and lang_score.

    The whole text is compared; ties go to the language first by code point. lang_pred is `und`, with
    score 0, where the text is null or has no letters, or where nothing was learned. The score is how
    far the nearest profile is from being wholly out of place, from 0 to 1. All columns of docs stay,
    but for ones named lang_pred or lang_score.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    known = {k: profiles[k] for k in sorted(profiles)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                langs, scores = [], []
                for text in batch.column(whole.num_columns - 1).to_pylist():
                    grams = ranked(*gram_counts(text or ""), size)
                    found = {lang: distance(grams, profile, size) for lang, profile in known.items()} if len(grams) else {}
                    best = min(found, key=found.get, default=UNKNOWN)
                    langs.append(best)
                    scores.append(1 - found[best] / (size * len(grams)) if found else 0.0)
                arrays = [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "lang_score"])

    given = docs.select(*kept, F.col(text_col).alias("_text")).toDF(*(f"_c{i}" for i in range(len(kept) + 1)))
    fields = ", ".join(f"`{name}` {f.dataType.simpleString()}" for name, f in zip(kept, given.schema.fields))
    return given.mapInArrow(tidy(run), f"{fields}, lang_pred string, lang_score double")


def held_out(id_col: str = "doc_id"):
    """Rows whose language is never learned from."""
    return F.coalesce(id_crc(F.col(id_col)) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame) -> Profiles:
    """Profiles from the rows that aren't held out."""
    return learn_profiles(docs.where(~held_out()))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = read(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", "text", held_out().alias("held_out")).select("doc_id", "held_out", "text"), fitted(docs))
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
