"""Language identification in two levels: family first, then pairs of languages inside it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from screenwell.llm.hashing import parts
from screenwell.llm.store import Scratch

BUCKETS = 1 << 14
UNKNOWN = "und"
#: Families of language codes (fixed values); a code that is not here is a family of its own.
FAMILIES = {
    "germanic": ["de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "ur", "mr", "gu", "pa", "ne"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
SCALE = 30.0


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the lower-cased letters of ``texts``, how many each text has
    and whether it has a letter. Other ASCII characters count as a space."""
    table = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
    raw = [t.lower() for t in texts]
    letter = np.array([any(map(str.isalpha, t)) for t in raw], bool)
    data = [b"  " + t.encode("utf-8", "replace").translate(table) + b"  " for t in raw]
    b = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), letter
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    keep = (b[1:-1] != 32) | ((b[:-2] != 32) & (b[2:] != 32))
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
    owner = np.repeat(np.arange(len(texts)), [len(d) for d in data])[:-2]
    return bucket[keep].astype(np.int64), np.bincount(owner[keep], minlength=len(texts)), letter


def vector(text: str) -> SparseVector:
    bucket, _, _ = grams([text])
    at, count = np.unique(bucket, return_counts=True)
    return SparseVector(BUCKETS, at, SCALE * count / max(1, len(bucket)))


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` labelled rows of each language, chosen by a hash: a bounded sample."""
    known = docs.where("lang is not null and text is not null")
    share = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) / 1_000_000
    return (known.join(F.broadcast(share), "lang").where(spread * F.col("n") < per_language)
            .select("lang", "text"))


def fit(docs: DataFrame, per_language: int = 800, iterations: int = 15) -> dict:
    """Weights of the family model and of one linear support vector machine for each two languages
    of a family, from columns lang and text. Each sampled text counts twice: whole, and as a short
    piece of its middle, so that short texts are met in training."""
    scratch = Scratch(docs.sparkSession)

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            half = batch["text"].map(lambda t: t[len(t) // 2: len(t) // 2 + 60])
            yield pd.DataFrame({"lang": pd.concat([batch["lang"], batch["lang"]]),
                                "text": pd.concat([batch["text"], half])})

    rows = training_rows(docs, per_language).mapInPandas(examples, "lang string, text string")
    family = F.udf(lambda code: FAMILY_OF.get(code, code), StringType())
    encode = F.udf(vector, VectorUDT())
    rows = scratch.cut(rows.select("lang", family("lang").alias("family"), encode("text").alias("features")))
    rows = rows.coalesce(6)
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    names = sorted({FAMILY_OF.get(x, x) for x in languages})
    model = {"languages": languages, "families": names, "pairs": [], "weights": np.zeros((BUCKETS, 0)),
             "intercepts": np.zeros(0)}
    columns, intercepts = [], []
    if len(names) > 1:
        index = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, float(i))])
        found = LogisticRegression(maxIter=iterations, regParam=1e-5, standardization=False,
                                   family="multinomial").fit(rows.withColumn("label", index[F.col("family")]))
        columns += list(found.coefficientMatrix.toArray())
        intercepts += list(found.interceptVector.toArray())
    for name in names:
        for a, b in combinations([x for x in languages if FAMILY_OF.get(x, x) == name], 2):
            own = rows.where(F.col("lang").isin(a, b)).withColumn(
                "label", F.when(F.col("lang") == b, 1.0).otherwise(0.0))
            found = LinearSVC(maxIter=iterations, regParam=1e-4, standardization=False).fit(own)
            model["pairs"].append((a, b))
            columns.append(found.coefficients.toArray())
            intercepts.append(found.intercept)
    if columns:
        model["weights"] = np.array(columns).T.astype(np.float32) * SCALE
        model["intercepts"] = np.array(intercepts)
    scratch.delete()
    return model


def decide(model: dict, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of margins: the likeliest family, then most won pairs in it."""
    languages, families = model["languages"], model["families"]
    count = len(families) if len(families) > 1 else 0
    if count:
        raw = np.exp(margins[:, :count] - margins[:, :count].max(axis=1, keepdims=True))
        share = raw / raw.sum(axis=1, keepdims=True)
    else:
        share = np.ones((len(margins), 1))
    best = share.argmax(axis=1)
    votes = np.zeros((len(margins), len(languages)))
    trust = np.zeros((len(margins), len(languages)))
    for k, (a, b) in enumerate(model["pairs"]):
        p = 1 / (1 + np.exp(-2 * np.clip(margins[:, count + k], -30, 30)))
        for code, q in ((a, 1 - p), (b, p)):
            votes[:, languages.index(code)] += (q >= 0.5) + q * 1e-3
            trust[:, languages.index(code)] += q
    out, score = [], np.zeros(len(margins))
    for i, f in enumerate(best):
        own = [k for k, x in enumerate(languages) if FAMILY_OF.get(x, x) == families[f]]
        k = max(own, key=lambda j: (votes[i, j], -j))
        out.append(languages[k])
        score[i] = share[i, f] * (trust[i, k] / (len(own) - 1) if len(own) > 1 else 1.0)
    return out, score


def identify(docs: DataFrame, model: dict, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` plus two ``names``, language and score, from the whole text alone.

    ``und`` with score 0 for a null text, one without a letter, or a model that has seen nothing.
    Columns of ``docs`` that have these names are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = StructType([*kept, StructField(names[0], StringType()), StructField(names[1], DoubleType())])

    def score(batches):
        import pyarrow as pa

        weights, intercepts = model["weights"], model["intercepts"]
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            found, scores = [], []
            for part in parts(texts):
                bucket, n, letter = grams(part)
                if not model["languages"]:
                    letter[:] = False
                at = np.concatenate([[0], np.cumsum(n)])
                sums = np.zeros((len(part), weights.shape[1]))
                for k in range(weights.shape[1]):
                    run = np.concatenate([[0.0], np.cumsum(weights[bucket, k], dtype=np.float64)])
                    sums[:, k] = run[at[1:]] - run[at[:-1]]
                code, s = decide(model, sums / np.maximum(n, 1)[:, None] + intercepts) if letter.any() else (
                    [UNKNOWN] * len(part), np.zeros(len(part)))
                found += [c if ok else UNKNOWN for c, ok in zip(code, letter, strict=True)]
                scores += [float(x) if ok else 0.0 for x, ok in zip(s, letter, strict=True)]
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                             [*(f.name for f in kept), *names])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(score, schema)



def held_out(key: str = "doc_id", modulus: int = 4, rest: int = 2):
    """True for the fold that nothing is learnt from; false for a null key."""
    code = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(modulus)) == rest, F.lit(False))


def learn_and_identify(docs: DataFrame, per_language: int = 800, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Fit on the rows outside the held-out fold, then identify every row.

    Rows with a null doc_id are identified but not learnt from. See ``identify`` for odd texts.
    """
    learning = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    return identify(docs, fit(learning, per_language), names=names)
