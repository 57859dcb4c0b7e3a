"""Language identification by nearest centroid.

A text is a unit vector of TF-IDF weights of hashed letter n-grams (1 to 3, in
words, case folded). Each language has several centroids, by spherical k-means
over its training vectors. The language of the most similar centroid wins; a
text further from it than almost all training texts of that language were is
flagged ``rejected``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, held, materialize, tidy

#: Most training rows, chosen by a hash of their id within each language.
TRAIN_ROWS_PER_LANG = 600
#: Training rows of all languages up to which each may have its most; but each has one at least.
TRAIN_ROWS = 12_000
#: Languages up to which their counts and training ids are broadcast.
BROADCAST_LANGS = 100_000
BITS, CENTROIDS, ROUNDS = 13, 4, 12
DIMS = 1 << BITS
#: Share of training texts of a language that may be further away.
REJECT = 0.005
UNKNOWN = "und"

def _marks() -> str:
    """Combining marks, which stand inside words but are no word characters to ``re``, as ranges."""
    points = [i for i in range(0x300, 0xE01F0) if unicodedata.category(chr(i))[0] == "M"]
    have = set(points)
    starts = [i for i in points if i - 1 not in have]
    ends = [i for i in points if i + 1 not in have]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends, strict=True))


_MARK = re.compile(f"[{_marks()}]")
_GAP = re.compile(rf"(?:[^\w{_marks()}]|[\d_])+")
_PLAIN_GAP = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case words with one space between them; the quicker pattern serves texts without marks."""
    low = text.lower()
    try:
        low.encode("latin-1")  # has no marks
        marked = None
    except UnicodeEncodeError:
        marked = _MARK.search(low)
    return (_GAP if marked else _PLAIN_GAP).sub(" ", low).strip()


def counts(text: str):
    """Hashed n-gram counts of a text, or None if it has no letter."""
    import numpy as np

    folded = letters(text)
    if not folded or not any(map(str.isalpha, folded)):
        return None
    c = np.frombuffer(f" {folded} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mul, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    pair = c[:-1] * np.uint64(0x110003) + c[1:]
    three = pair[:-1] * np.uint64(0x110003) + c[2:]
    grams = np.concatenate([c[c != 32] * mul, (pair + np.uint64(1 << 62)) * mul, (three[c[1:-1] != 32] + np.uint64(1 << 61)) * mul])
    return np.bincount((grams >> shift).astype(np.int64), minlength=DIMS)


def vector(text: str | None, idf):
    import numpy as np

    n = counts(text) if text else None
    if n is None:
        return None
    v = np.log1p(n) * idf
    size = np.sqrt(v @ v)
    return v / size if size else v


def _training(docs: DataFrame, per_lang: int) -> DataFrame:
    """``lang, text`` of at most ``per_lang`` ids of every language, fewer if they are many; of a repeated id the least text.

    A hash of the id first thins a language with many rows to about one and a
    half times the bound (never under 45 rows, so that none is thinned away),
    so the row numbers are over few ids at any size.
    """
    from pyspark.sql import Window

    ok = docs.where(F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2)).select("doc_id", F.col("lang").cast("string").alias("lang"))
    langs = materialize(ok.groupBy("lang").agg(F.count("*").alias("n")), "langid-langs")
    n = langs.count()
    per_lang = max(1, min(per_lang, TRAIN_ROWS // max(n, 1)))
    small = F.broadcast if n <= BROADCAST_LANGS else lambda df: df  # a checked size
    thin = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1_000_000)) < F.lit(1_500_000.0 * max(per_lang, 30)) / F.col("n")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = ok.join(small(langs), "lang").where(thin).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_lang).select("doc_id", "lang").distinct()
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).join(small(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def _unit(c):
    import numpy as np

    return c / np.maximum(np.sqrt((c**2).sum(axis=-1, keepdims=True)), 1e-12)


def _clusters(v, k: int, rounds: int):
    """Unit centroids by spherical k-means, started by rows spread evenly over the similarity to the mean."""
    import numpy as np

    order = np.argsort(v @ _unit(v.mean(axis=0)), kind="stable")
    c = v[order[np.linspace(0, len(v) - 1, min(k, len(v)) + 2).astype(int)[1:-1]]] if len(v) > k + 2 else v[:k]
    for _ in range(rounds):
        to = (v @ c.T).argmax(axis=1)
        new = _unit(np.array([v[to == j].mean(axis=0) if (to == j).any() else c[j] for j in range(len(c))]))
        if np.allclose(new, c):
            break
        c = new
    return c


def train(docs: DataFrame, per_lang: int = TRAIN_ROWS_PER_LANG, k: int = CENTROIDS) -> dict:
    """Centroids from text and language of rows whose crc32 remainder is not 2.

    The driver holds the training rows' sparse counts and one language's
    matrix at a time. Rows that do not look like their own language, by the
    nearest mean, twice over, take no part in the clusters.
    """
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(a.as_py(), n) for a, t in zip(b.column(0), b.column(1), strict=True) if (n := counts(t.as_py() or "")) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in got], pa.string()), pa.array([np.flatnonzero(n).astype(np.int16) for _, n in got], pa.list_(pa.int16())), pa.array([n[n > 0].astype(np.int32) for _, n in got], pa.list_(pa.int32()))], names=["lang", "at", "n"])

    got = _training(docs, per_lang).select("lang", "text").mapInArrow(tidy(run), "lang string, at array<short>, n array<int>").toArrow()
    rows: dict[str, list] = {}
    held_by = np.zeros(DIMS, dtype=np.int64)
    for lang, at, n in zip(got.column("lang").to_pylist(), got.column("at"), got.column("n"), strict=True):
        at, n = np.array(at.as_py(), dtype=np.int64), np.array(n.as_py(), dtype=np.float32)
        held_by[at] += 1
        rows.setdefault(lang, []).append((at, np.log1p(n)))
    langs = sorted(rows)
    idf = (np.log((1 + got.num_rows) / (1 + held_by)) + 1).astype(np.float32)

    def matrix(lang: str):
        v = np.zeros((len(rows[lang]), DIMS), dtype=np.float32)
        for i, (at, w) in enumerate(rows[lang]):
            v[i, at] = w * idf[at]
        return v / np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-12)[:, None]

    means = _unit(np.array([matrix(x).mean(axis=0) for x in langs])) if langs else None
    own = {}
    for last in (False, True):
        near = []
        for i, lang in enumerate(langs):
            v = matrix(lang)
            ok = (v @ means.T).argmax(axis=1) == i
            own[lang] = ok if ok.any() else np.ones(len(v), dtype=bool)
            near.append(v[own[lang]].mean(axis=0) if not last else None)
        means = _unit(np.array(near)) if langs and not last else means
    model = {"idf": idf, "langs": langs, "centroids": np.zeros((0, DIMS), dtype=np.float32), "of": np.zeros(0, dtype=np.int64), "floor": {}}
    parts = []
    for i, lang in enumerate(langs):
        v = matrix(lang)
        c = _clusters(v[own[lang]], k, ROUNDS)
        model["floor"][lang] = float(np.quantile((v @ c.T).max(axis=1), REJECT))
        model["of"] = np.concatenate([model["of"], np.full(len(c), i)])
        parts.append(c.astype(np.float32))
    if parts:
        model["centroids"] = np.concatenate(parts)
    return model


def classify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, similarity, rejected`` of every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held("langid")
        m = shared.value
        langs, n = m["langs"], len(m["langs"])
        for b in batches:
            out = []
            for t in b.column(1):
                v = vector(t.as_py(), m["idf"]) if n else None
                if v is None:
                    out.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                sim = m["centroids"] @ v.astype(np.float32)
                best = np.full(n, -1.0)
                np.maximum.at(best, m["of"], sim)
                i = int(best.argmax())
                e = np.exp(20 * (best - best[i]))
                out.append((langs[i], float(1 / e.sum()), float(best[i]), bool(best[i] < m["floor"][langs[i]])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.bool_())], names=["doc_id", "lang_pred", "score", "similarity", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, lang_pred string, score double, similarity double, rejected boolean")


def identify(docs: DataFrame, per_lang: int = TRAIN_ROWS_PER_LANG) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` and ``similarity, rejected`` of every row.

    Null texts and texts without a letter are ``und`` with score 0, as is
    every text when there is nothing to learn from. Of languages that are
    equally near the first by name is taken. Repeated ids are predicted
    row by row; extra columns are ignored.
    """
    out = classify(docs, train(docs, per_lang))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "similarity", "rejected")
