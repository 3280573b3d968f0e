"""Quality rules: counts per text, then a conditional random field over its lines.

A linear-chain CRF with two states labels each line content or boilerplate from its shape
(letters, symbols, case, endings, length, repetition); Viterbi decoding finds the best labelling
of the whole sequence. A text is kept if enough of its words stand in content lines.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, map_rows, slices, store, values

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
STOPS = (b".", b"!", b"?", b":", b'"', b"\xe2\x80\x9d", b"\xe3\x80\x82")
FEATURES = ("bias", "symbols", "upper", "digits", "bare", "marks", "short", "length", "stop", "word", "same", "seen")
# used where there is no labelled document: boilerplate minus content, in the order of FEATURES
PRIOR = (-1.5, 8.0, 4.0, 3.0, 4.0, 3.0, 0.5, -0.3, -0.5, 0.0, 3.0, 1.0)
PRIOR_STICK = 1.0
_MARKS = re.compile(rb"[!?]{2,}")


def text_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    points = len(text) - int(np.count_nonzero((raw & 0xC0) == 0x80))
    spaces = len(text) - len(text.translate(None, SPACE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines, seen = 0, set()
    for line in text.split(b"\n"):
        if line in seen:
            lines += 1
        elif line and not line.isspace():
            seen.add(line)
    return len(words), points - spaces, symbols, lines, repeated_words(words)


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.uint64)
    if len(codes) ** size < 1 << 64:  # the five ids make one exact number
        key = np.zeros(n, np.uint64)
        for k in range(size):
            key = key * np.uint64(len(codes)) + ids[k : k + n]
    else:
        key = ids[:n]
        for k in range(1, size):
            key = np.unique(key * np.uint64(len(codes)) + ids[k : k + n], return_inverse=True)[1].astype(np.uint64)
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    hits = np.flatnonzero(count[where] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + size, -1)
    return int(np.count_nonzero(np.cumsum(cover)))


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features per line with a word, words per line)."""
    rows, sizes, seen = [], [], set()
    for line in text.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = sum(map(len, words))
        symbols = chars - len(line.translate(None, SPACE + SYMBOLS))
        upper = chars - len(line.translate(None, SPACE + UPPER))
        digits = chars - len(line.translate(None, SPACE + DIGITS))
        bare = sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words)
        known = line in seen
        seen.add(line)
        rows.append((
            1.0, min(1.0, 4 * symbols / chars), upper / chars, digits / chars, bare / n,
            min(1.0, len(_MARKS.findall(line)) / n), float(n < 4), math.log1p(n), float(words[-1].endswith(STOPS)),
            min(chars / n, 40) / 10, 1 - len(set(words)) / n, float(known),
        ))
        sizes.append(n)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


class LineField:
    """Scores: ``weights`` of a line for boilerplate (content is 0), ``steps`` between two states."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray) -> None:
        self.weights, self.steps = np.asarray(weights, float), np.asarray(steps, float)

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest states, 1 boilerplate; of equal ones content."""
        scores = (features @ self.weights).tolist()
        (cc, cb), (bc, bb) = self.steps.tolist()
        content, junk, back = 0.0, scores[0] if scores else 0.0, []
        for s in scores[1:]:
            from_c, from_j = content + cc >= junk + bc, content + cb >= junk + bb
            back.append((from_c, from_j))
            content, junk = (
                content + cc if from_c else junk + bc,
                (content + cb if from_j else junk + bb) + s,
            )
        state, out = int(junk > content), []
        for from_c, from_j in reversed(back):
            out.append(state)
            state = int(not (from_j if state else from_c))
        return np.array([state, *reversed(out)][: len(scores)], np.int8)

    def content_share(self, text: bytes) -> float:
        features, sizes = line_features(text)
        if not len(sizes):
            return 0.0
        return float(sizes[self.viterbi(features) == 0].sum() / sizes.sum())


def default_field() -> LineField:
    return LineField(np.array(PRIOR), PRIOR_STICK * np.eye(2))


def train(sequences: list[np.ndarray], labels: list[np.ndarray], rounds: int = 150, decay: float = 1e-2) -> LineField:
    """Maximum conditional likelihood by gradient steps (Adam) on all sequences side by side."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    longest, width = len(sequences[order[0]]), len(FEATURES)
    x = np.zeros((longest, len(order), width))
    y = np.zeros((longest, len(order)), int)
    live = np.zeros((longest, len(order)), bool)
    for k, i in enumerate(order):
        n = len(sequences[i])
        x[:n, k], y[:n, k], live[:n, k] = sequences[i], labels[i], True
    pairs = live[1:] & live[:-1]
    seen_steps = np.array([[np.sum(pairs & (y[:-1] == a) & (y[1:] == b)) for b in (0, 1)] for a in (0, 1)], float)
    seen_lines = np.einsum("tkf,tk->f", x, (y * live).astype(float))
    theta = np.zeros(width + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    total = live.sum()
    for step in range(1, rounds + 1):
        weights, steps = theta[:width], theta[width:].reshape(2, 2)
        unary = np.stack([np.zeros(live.shape), x @ weights], -1)
        ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
        ahead[0] = unary[0]
        for t in range(1, longest):
            come = np.logaddexp.reduce(ahead[t - 1][:, :, None] + steps, axis=1) + unary[t]
            ahead[t] = np.where(live[t][:, None], come, ahead[t - 1])
        for t in range(longest - 2, -1, -1):
            go = np.logaddexp.reduce(steps + (unary[t + 1] + behind[t + 1])[:, None, :], axis=2)
            behind[t] = np.where(live[t + 1][:, None], go, behind[t])
        norm = np.logaddexp.reduce(ahead[-1], axis=1)
        junk = np.exp(ahead[..., 1] + behind[..., 1] - norm) * live
        both = ahead[:-1, :, :, None] + steps + (unary[1:] + behind[1:])[:, :, None, :] - norm[None, :, None, None]
        expected = (np.exp(np.where(pairs[..., None, None], both, -np.inf))).sum(axis=(0, 1))
        gradient = np.concatenate((seen_lines - np.einsum("tkf,tk->f", x, junk), (seen_steps - expected).ravel()))
        gradient = gradient / total - decay * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineField(theta[:width], theta[width:].reshape(2, 2))


def line_run(text: bytes, lines: int) -> np.ndarray:
    """Features of at most ``lines`` consecutive lines, the first of them chosen by a digest."""
    rows = line_features(text)[0]
    at = zlib.crc32(text) % max(1, len(rows) - lines + 1)
    return rows[at : at + lines]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 500, lines: int = 64) -> LineField:
    """Train on at most ``per_class`` documents of each quality, at most ``lines`` lines of each.

    Weak labels: the lines of a document of quality 1 count as content, of quality 0 as
    boilerplate. Labelled documents that have a text are taken by the order of a digest of their
    id, and of a long one a run of lines from a place that a digest of its text chooses, so reruns
    agree. A document with both labels teaches neither. Unless there are documents with words of
    both qualities, the field of ``default_field`` is returned.
    """
    graded = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
    graded = graded.agg(F.min("quality").alias("low"), F.max("quality").alias("quality")).filter("low = quality")
    worded = docs.filter(F.regexp_like("text", F.lit(WORD)))
    texts = worded.select("doc_id", F.col("text").cast("binary").alias("text"))
    # by id first, as ids are narrow, and only ids of texts with a word
    graded = graded.join(worded.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "quality")
    place = F.xxhash64(F.col("doc_id").cast("long"))
    picked = [graded.filter(F.col("quality") == q).orderBy(place, "doc_id").limit(per_class) for q in (0, 1)]
    ids = store(picked[0].union(picked[1]), "picked")
    # of several texts with one id the one with the least digest
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "quality")).alias("x")
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(one).select("doc_id", "x.text", "x.quality")

    def work(batches):
        for batch in batches:
            rows = [line_run(t, lines) for t in values(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r.ravel().tolist() for r in rows])],
                ["doc_id", "quality", "x"],
            )

    shapes = map_rows(found.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text"),
                      "doc_id long, quality int, x array<double>", work)
    sequences, states = [], []
    for quality in (0, 1):
        some = shapes.filter((F.col("quality") == quality) & (F.size("x") > 0))
        for row in some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect():
            x = np.array(row["x"]).reshape(-1, len(FEATURES))
            sequences.append(x)
            states.append(np.full(len(x), 1 - quality))
    if len({int(s[0]) for s in states}) < 2:
        return default_field()
    return train(sequences, states)


def judge(docs: DataFrame, field: LineField, share: float = 0.5, min_words: int = 10, repeat_percent: int = 20) -> DataFrame:
    """Add the counts and the verdict to each row; rows and other columns stay as they are.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (too few words or too
    many in repeated 5-word windows), content_share (null if base_failed), kept. A null or empty
    text has no word and fails. ``docs`` may hold any columns but these.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept")
    names = docs.columns
    if clash := set(added) & {n.lower() for n in names}:
        raise ValueError(f"columns {sorted(clash)} are taken")
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema += ", n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    schema += ", base_failed boolean, content_share double, kept boolean"
    held = docs.sparkSession.sparkContext.broadcast(field)

    def work(batches):
        for batch in slices(batches):
            cols: list[list] = [[] for _ in added]
            for text in values(batch.column(names.index("text")).cast(pa.binary())):
                counts = text_counts(text)
                failed = counts[0] < min_words or 100 * counts[4] > repeat_percent * counts[0]
                content = None if failed else held.value.content_share(text)
                for col, value in zip(cols, (*counts, failed, content, not failed and content >= share)):
                    col.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                [*names, *added],
            )

    return map_rows(docs, schema, work)
