"""Language of a text by error-correcting output codes.

Each language has a codeword. For every bit a binary classifier over hashed character n-grams
(1 to 3 letters) tells the languages with a one from those with a zero: its weight for an n-gram
is the log ratio of the two groups' smoothed frequencies, and its output is the mean weight over
the text. Decoding is loss-weighted: the logistic loss of each output against each codeword bit,
weighted by how often that classifier was right about that language in training, summed per
language; the least sum wins. Close calls are flagged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, store, values

DIM = 1 << 14
ORDERS = (1, 2, 3)
CHUNK = 1 << 19
UNKNOWN = "und"
SMOOTH = 0.5
MARGIN = 0.2


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of the lower-cased text; None if it has no letter.

    Whatever is not a letter parts words and counts as one space. Long texts go in slices.
    """
    total, grams = None, len(ORDERS)
    text = text or ""
    for at in range(0, len(text), CHUNK):
        part = text[max(0, at - grams + 1) : at + CHUNK]
        codes = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[codes]
        if not letter.any():
            continue
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        codes = np.where(letter, codes, 32)[keep].astype(np.uint32)
        codes = np.concatenate((np.array([32], np.uint32), codes, np.array([32], np.uint32)))
        found, key = [], np.zeros(len(codes), np.uint32)
        for n in ORDERS:
            # the n-gram that starts here, by Horner's rule over 32 bits
            key = key[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
            found.append((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIM.bit_length() + 1))
        counts = np.bincount(np.concatenate(found), minlength=DIM)
        total = counts if total is None else total + counts
    return total


def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """Codewords (languages x bits, 0 or 1). Up to 6 languages: every split there is; then random
    splits, the best of many draws by the least distance between two codewords."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 6:
        splits = np.arange(1, 1 << (languages - 1), dtype=np.int64)
        return (splits[None, :] >> np.arange(languages)[:, None] & 1).astype(np.int8)
    bits = 10 * int(np.ceil(np.log2(languages)))
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (languages, bits), dtype=np.int8)
        code[0, code.all(0)] = 0
        code[0, ~code.any(0)] = 1
        signed = 2 * code.astype(np.int32) - 1
        distance = (bits - signed @ signed.T) // 2
        least = int(distance[~np.eye(languages, dtype=bool)].min())
        if least > far:
            best, far = code, least
    return best


def count_table(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): n-gram counts of each language over all rows (lang, text).

    A task adds up its own rows per language and emits at most ``DIM`` sums for each.
    """

    def work(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(values(batch.column("lang")), values(batch.column("text"))):
                counts = gram_counts(text)
                if counts is not None:
                    sums[lang] = sums[lang] + counts if lang in sums else counts
        for lang, counts in sums.items():
            gram = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int32)), pa.array(counts[gram])],
                ["lang", "gram", "n"],
            )

    table = map_rows(rows.select("lang", "text"), "lang string, gram int, n long", work)
    return table.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Languages, their codewords, and the weights of the bit classifiers (DIM x bits)."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages, self.code = languages, codebook(len(languages))
        share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
        ones = self.code.T.astype(float)
        groups = [g / np.maximum(g.sum(axis=1, keepdims=True), 1) @ share for g in (ones, 1 - ones)]
        groups = [np.where(g > 0, g, 1 / DIM) for g in groups]
        self.weights = np.ascontiguousarray((np.log(groups[0]) - np.log(groups[1])).T, np.float32)

    def outputs(self, text: str | None) -> np.ndarray | None:
        """One number per bit, positive for a one; None for a text without a letter."""
        counts = gram_counts(text)
        if counts is None:
            return None
        gram = np.flatnonzero(counts)
        n = counts[gram].astype(np.float32)
        return (n / n.sum()) @ self.weights[gram]


def fit(labelled: DataFrame) -> Model:
    """Learn from all rows (lang, text) with both given. The table that reaches the driver has at
    most ``DIM`` rows per language, whatever the number of documents."""
    rows = labelled.filter("lang is not null and text is not null")
    table = store(count_table(rows), "gram-counts")
    found = [r[0] for r in table.select("lang").distinct().orderBy("lang").collect()]
    counts = np.zeros((len(found), DIM))
    place = {lang: i for i, lang in enumerate(found)}
    pulled = table.toArrow()
    at = [place[x] for x in values(pulled.column("lang"))]
    counts[at, pulled.column("gram").to_numpy()] = pulled.column("n").to_numpy()
    return Model(found, counts)


def bit_outputs(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """(carry..., bits): the classifiers' outputs per row; null where the text has no letter."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*carry, F.col("text").cast("string").alias("_text"))
    schema = docs.select(*carry).schema.add("bits", T.ArrayType(T.FloatType()))

    def work(batches):
        for batch in batches:
            bits = [held.value.outputs(t) for t in values(batch.column("_text"))]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            found = pa.array([None if b is None else b.tolist() for b in bits], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*kept, found], [*batch.schema.names[:-1], "bits"])

    return map_rows(rows, schema, work)


def trust(outputs: DataFrame, model: Model) -> np.ndarray:
    """Per language and bit: how often training texts of the language got the bit right."""
    n = model.code.shape[1]
    right = [F.avg((F.col("bits")[j] > 0).cast("double")).alias(f"b{j}") for j in range(n)]
    rows = outputs.filter("bits is not null").groupBy("lang").agg(*right).collect()  # a row per language
    ones = {r[0]: np.array(r[1:], float) for r in rows}
    out = np.array([np.where(c == 1, ones[x], 1 - ones[x]) for x, c in zip(model.languages, model.code)])
    return np.maximum(out, 1e-6)


def decode(outputs: DataFrame, model: Model, weights: np.ndarray, margin: float = MARGIN) -> DataFrame:
    """Add lang_pred, score, runner_up and ambiguous to rows with ``bits``, and drop ``bits``.

    score: the winner's share when each language counts exp(-loss). ambiguous: the second is
    within ``margin`` of it.
    """
    names = [c for c in outputs.columns if c != "bits"]
    signs = 2.0 * model.code - 1
    shares = weights / weights.sum(axis=1, keepdims=True) * model.code.shape[1]
    languages = model.languages

    def work(batches):
        for batch in batches:
            bits = values(batch.column("bits"))
            out: list[list] = [[], [], [], []]
            known = [i for i, b in enumerate(bits) if b is not None and languages]
            z = np.array([bits[i] for i in known], float)
            loss = np.stack([(np.logaddexp(0, -s * z) * w).sum(axis=1) for s, w in zip(signs, shares)], 1) if known else None
            ranks = dict(zip(known, range(len(known))))
            for i in range(len(bits)):
                row = (UNKNOWN, 0.0, None, True)
                if i in ranks:
                    own = loss[ranks[i]]
                    odds = np.exp(own.min() - own)
                    odds /= odds.sum()
                    first, *others = np.argsort(-odds, kind="stable")[:2]
                    gap = odds[first] - (odds[others[0]] if others else 0)
                    row = (languages[first], float(odds[first]), languages[others[0]] if others else None, bool(gap < margin))
                for col, value in zip(out, row):
                    col.append(value)
            kinds = (pa.string(), pa.float64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(c, k) for c, k in zip(out, kinds))],
                [*names, "lang_pred", "score", "runner_up", "ambiguous"],
            )

    schema = outputs.drop("bits").schema
    for name, kind in (("lang_pred", T.StringType()), ("score", T.DoubleType()),
                       ("runner_up", T.StringType()), ("ambiguous", T.BooleanType())):
        schema = schema.add(name, kind)
    return map_rows(outputs, schema, work)


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, runner_up, ambiguous) per row of (doc_id, text, lang).

    Rows for which ``held_out`` is true or null, or whose lang or text is null, teach nothing.
    Predictions see the text alone. A text that is null or has no letter is ``und`` with score 0,
    as is every text if there is nothing to learn from. Repeated rows are answered row by row.
    """
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(~held_out, F.lit(False)).alias("teaches"))
    model = fit(rows.filter("teaches").select("lang", "text"))
    outputs = store(bit_outputs(rows, model, "doc_id", "held_out", "teaches", "lang"), "bit-outputs")
    taught = outputs.filter("teaches and lang is not null")
    weights = trust(taught, model) if model.languages else np.ones((0, 1))
    return decode(outputs.select("doc_id", "held_out", "bits"), model, weights)
