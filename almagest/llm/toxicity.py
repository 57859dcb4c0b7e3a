"""Toxicity by gradient-boosted trees over dense features of a text.

The word lists behind the density features are learned too: words and word
beginnings that training rows marked toxic hold far more often than others.
Features: densities and counts of both lists, how many of those words stand
near a second-person pronoun, capitals, punctuation and obfuscation rates.
Scores are calibrated by isotonic regression on rows the trees did not see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import crc_mod, give_back, held, materialize, tidy

#: Most labelled rows that training reads, chosen by a hash of their id.
TRAIN_ROWS = 20_000
#: Most entries of the learned word lists, of which those that tell most are taken; part of the model, like the number of trees.
LEXICON_WORDS = 4_000
STEM, NEAR = 5, 4
#: Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = "you your yours yourself du dich dir dein deine deiner euch euer ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros"
#: Characters that stand for letters in obfuscated words.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FEATURES = ["words", "word_density", "stem_density", "word_hits", "stem_hits", "near_second", "second_rate", "caps_words", "caps_letters", "exclaim", "punct", "leet_hits", "mixed", "stretched", "max_window"]

_WORD = re.compile(r"[^\W_]+").findall
_TOKEN = re.compile(r"\S+").findall
_STRETCH = re.compile(r"(\w)\1\1").search
_LEET = str.maketrans(LEET)
_MIXED = re.compile(r"[0134570@$!*]").search


def words(text: str) -> list[str]:
    return _WORD(text.lower())


def features(text: str, lex: dict[str, set[str]]) -> list[float]:
    """The row of ``FEATURES`` of a text; an empty text has zeros."""
    import numpy as np

    w = words(text)
    n = len(w)
    if not n:
        return [0.0] * len(FEATURES)
    whole, stems, second = lex["words"], lex["stems"], lex["second"]
    hits = [i for i, x in enumerate(w) if x in whole]
    stem_hits = [i for i, x in enumerate(w) if x[:STEM] in stems]
    you = [i for i, x in enumerate(w) if x in second]
    near = 0
    both = sorted({*hits, *stem_hits})
    if both and you:
        at, to = np.array(both), np.array(you)
        i = np.searchsorted(to, at)
        left, right = np.abs(at - to[np.maximum(i - 1, 0)]), np.abs(to[np.minimum(i, len(to) - 1)] - at)
        near = int((np.minimum(left, right) <= NEAR).sum())
    most = 0
    for i, a in enumerate(both):  # most hits in 50 words
        j = i + most
        while j < len(both) and both[j] - a < 50:
            most += 1
            j += 1
    tokens = _TOKEN(text)
    k = len(tokens)
    odd = [t for t in tokens if _MIXED(t)]
    plain = [t.lower().strip(".,;:!?") for t in odd]
    mixed = sum(1 for t in plain if re.search(r"[^\W\d_]", t) and re.search(r"[\d@$*]", t))
    leet = sum(1 for t in plain if t not in whole and (t.translate(_LEET) in whole or (v := t.translate(_LEET))[:STEM] in stems and v != t))
    letters = sum(map(str.isalpha, text)) or 1
    upper = sum(map(str.isupper, text))
    punct = len(text) - letters - sum(map(str.isspace, text))
    return [float(n), len(hits) / n, len(stem_hits) / n, float(len(hits)), float(len(stem_hits)), near / n, len(you) / n, sum(1 for t in tokens if len(t) > 1 and t.isupper()) / k, upper / letters, text.count("!") / k, punct / len(text), leet / k, mixed / k, sum(1 for t in tokens if _STRETCH(t)) / k, float(most)]


def _training(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``bound`` labelled ids that are not held out; of a repeated id the least text.

    Labels may be of any numeric type, boolean, or the text of a number; others count as none.
    """
    mark = F.col("toxic").try_cast("double") if labels.schema["toxic"].dataType.simpleString() != "boolean" else F.col("toxic").cast("double")
    y = labels.select("doc_id", (mark > 0).cast("int").alias("y")).where(F.col("y").isNotNull() & (crc_mod(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.max("y").alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # bounded


def _lexicon(train: DataFrame) -> dict[str, set[str]]:
    """Words and beginnings over eight times likelier in marked rows, in three rows at least."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[tuple, list[int]] = {}
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = set(words(t or ""))
                for key in [("w", x) for x in own if 2 < len(x) <= 40] + [("s", x) for x in {x[:STEM] for x in own if len(x) >= STEM}]:
                    counts.setdefault(key, [0, 0])[y > 0] += 1
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in counts], pa.string()), "term": pa.array([x for _, x in counts], pa.string()), "no": pa.array([c[0] for c in counts.values()], pa.int64()), "yes": pa.array([c[1] for c in counts.values()], pa.int64())})

    total = train.agg(F.sum((F.col("y") > 0).cast("int")), F.count("*")).first()
    yes, no = total[0] or 0, total[1] - (total[0] or 0)
    out = {"words": set(), "stems": set(), "second": set(SECOND_PERSON.split())}
    if not yes or not no:
        return out
    by = train.select("text", "y").mapInArrow(tidy(spread), "kind string, term string, no bigint, yes bigint").groupBy("kind", "term").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    lift = ((F.col("yes") + 0.2) / yes) / ((F.col("no") + 0.2) / no)
    for r in by.where((F.col("yes") >= 3) & (lift > 8)).orderBy(F.desc(F.col("yes") * F.log(lift)), "kind", "term").limit(LEXICON_WORDS).collect():
        out["words" if r.kind == "w" else "stems"].add(r.term)
    return out


def _featured(rows: DataFrame, lex: dict, first: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity")
        for b in batches:
            x = [features(t.as_py() or "", lex) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["k", "x"])

    return rows.mapInArrow(tidy(run), f"k {first}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> dict:
    """Lexicon, trees and calibration from labelled rows whose crc32 remainder is not 0.

    The lists come from two thirds of them and the trees from the same rows;
    the other third, which neither saw, is for calibration.
    """
    import numpy as np

    rows = materialize(_training(docs, labels, bound), "toxicity-train")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3))
    lex = _lexicon(rows.where(fold > 0))
    got = _featured(rows.select(F.struct("y", (fold > 0).alias("fit")).alias("k"), "text"), lex, "struct<y:int,fit:boolean>").collect()
    got.sort(key=lambda r: (r.x, r.k))  # the same model, whatever order the parts came in
    x = np.array([r.x for r in got], dtype=float).reshape(len(got), len(FEATURES))
    y = np.array([float(r.k.y > 0) for r in got])
    fit = np.array([r.k.fit for r in got], dtype=bool)
    trees = boosting.fit_trees(x[fit], y[fit])
    rest = ~fit if (~fit).sum() >= 20 else np.ones(len(y), dtype=bool)
    knots = boosting.fit_isotonic(boosting.raw_scores(trees, x[rest]), y[rest])
    return {"lex": lex, "trees": trees, "knots": knots}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; null text counts as empty and is scored too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held("toxicity")
        m = shared.value
        for b in batches:
            x = np.array([features(t.as_py() or "", m["lex"]) for t in b.column(1)], dtype=float).reshape(len(b.column(1)), len(FEATURES))
            s = boosting.calibrated(m["knots"], boosting.raw_scores(m["trees"], x))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Without labels of both kinds every text gets the prior. Repeated ids are
    scored row by row; a null id is not held out. Extra columns are ignored.
    """
    s = score(docs, train(docs, labels, bound))
    return s.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")  # without pandas, which a worker would keep for all later stages
    def toxic(text: pa.Array) -> pa.Array:
        import numpy as np

        held("toxicity")
        m = shared.value
        x = np.array([features(t.as_py() or "", m["lex"]) for t in text], dtype=float).reshape(len(text), len(FEATURES))
        give_back()
        return pa.array(boosting.calibrated(m["knots"], boosting.raw_scores(m["trees"], x)), pa.float64())

    return docs.where(toxic(F.col("text").cast("string")) < threshold)
