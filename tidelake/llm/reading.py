"""Reading level of each text: familiar-word shares and sentence length, fitted to human readings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.runtime import drop_cut, write_cut

#: Most labelled documents that are used. What reaches the driver is bounded by it (their words and features) and by
#: FREQUENT (words in so large a share of the documents are at most average distinct words / FREQUENT[-1]).
LABEL_SAMPLE = 20_000
FREQUENT = (0.3, 0.1, 0.03, 0.01, 0.003, 0.001)
CUTS = (1.5, 2.5, 3.5, 4.5)
RATIOS = (0.5, 1.0, 2.0, 4.0)
N_LISTS = len(FREQUENT) + len(CUTS) * len(RATIOS)
KNOWN = 1 << N_LISTS  # a word of a labelled document
ENGLISH = 0.5  # least share of such words in English prose
CHUNK = 4 << 20  # bytes of texts that are split at once

_LINES = re.compile("[\r\n\x0b\x0c\x85\u2028\u2029]+")
_HIDDEN = re.compile("[\u200b-\u200f\u2060\ufeff\xad\x00-\x08\x0e-\x1f]")
_MARK = re.compile(r"^\s*(?:[-*#>•]+|\d+[.)])\s+")
_EDGE = "\"'()[]*#.,;:!?"
_JOINED = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_STOPS = (".", "!", "?")

# The same in the syntax of Arrow's regular expressions.
_A_LINES = r"[\r\n\x0b\x0c\x{85}\x{2028}\x{2029}]+"
_A_HIDDEN = r"[\x{200b}-\x{200f}\x{2060}\x{feff}\x{ad}\x00-\x08\x0e-\x1f]"
_A_MARK = r"^[\s\p{Z}]*(?:[-*#>•]+|\p{Nd}+[.)])[\s\p{Z}]+"
_A_LETTER = r"[\p{L}\p{Nl}\p{No}]"
_A_JOINED = f"^{_A_LETTER}+(?:['’-]{_A_LETTER}+)+$"


def words_and_sentences(text: str | None) -> tuple[list[str], int]:
    """Lower-case words of the prose of a text, and the number of its sentences (a line ends one): the rule that
    count_words applies to many texts at once.

    A line is prose if at least half of its parts, between blanks and without marks at their edges, are plain
    words; list marks at its start don't count. Other lines are machine output."""
    words: list[str] = []
    n = 0
    for line in _LINES.split(_HIDDEN.sub("", text).replace("\u0130", "i").lower()) if text else ():
        raw = _MARK.sub("", line).split()
        parts = [p.strip(_EDGE) for p in raw]
        plain = sum(map(str.isalpha, parts))
        if 2 * plain < len(parts):
            plain += sum(_JOINED.fullmatch(p) is not None for p in parts)
        if not parts or 2 * plain < len(parts):
            continue
        own = [w for p in parts for w in ((p,) if p.isalpha() else _WORD.findall(p))]
        if own:
            words += own
            n += sum(p.endswith(_STOPS) for p in raw) + (not raw[-1].endswith(_STOPS))
    return words, n


def _flat(lists: pa.ListArray, parent: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The elements of all lists, and of each the number (or parent) of its list."""
    n = np.diff(lists.offsets.to_numpy())
    return lists.flatten(), np.repeat(np.arange(len(n)) if parent is None else parent, n)


def count_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.ListArray, pa.ListArray]:
    """(n_words, n_sentences, distinct words, their counts) of each text, all texts at once."""
    n_texts = len(texts)
    t = pc.utf8_lower(pc.replace_substring_regex(pc.fill_null(texts, ""), _A_HIDDEN, ""))
    lines, text_of = _flat(pc.split_pattern_regex(t, _A_LINES))
    parts, line_of = _flat(pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(lines, _A_MARK, "", max_replacements=1))))
    there = pc.not_equal(parts, "")
    raw, line_of = parts.filter(there), line_of[there.to_numpy(zero_copy_only=False)]
    parts = pc.utf8_trim(raw, _EDGE)
    alpha = pc.utf8_is_alpha(parts).to_numpy(zero_copy_only=False)
    n_lines = len(lines)
    n_parts = np.bincount(line_of, minlength=n_lines)
    plain = np.bincount(line_of[alpha], minlength=n_lines)
    unsure = ((2 * plain < n_parts)[line_of] & ~alpha).nonzero()[0]
    if len(unsure):
        joined = pc.match_substring_regex(parts.take(pa.array(unsure)), _A_JOINED).to_numpy(zero_copy_only=False)
        plain += np.bincount(line_of[unsure[joined]], minlength=n_lines)
    prose = (n_parts > 0) & (2 * plain >= n_parts)

    kept = prose[line_of]
    whole = (kept & alpha).nonzero()[0]
    mixed = (kept & ~alpha).nonzero()[0]
    words, word_line = [parts.take(pa.array(whole))], [line_of[whole]]
    if len(mixed):
        coded = parts.take(pa.array(mixed)).dictionary_encode()
        found = pa.array([_WORD.findall(p) for p in coded.dictionary.to_pylist()], pa.list_(parts.type))
        inner, of = _flat(found.take(coded.indices), line_of[mixed])
        words.append(inner)
        word_line.append(of)
    word_line = np.concatenate(word_line)
    has_words = np.bincount(word_line, minlength=n_lines) > 0

    stop = np.zeros(len(raw), bool)
    for s in _STOPS:
        stop |= pc.ends_with(raw, s).to_numpy(zero_copy_only=False)
    ends = np.bincount(line_of[stop], minlength=n_lines)
    last = np.flatnonzero(np.append(line_of[1:] != line_of[:-1], True)) if len(line_of) else line_of
    ends[line_of[last]] += ~stop[last]
    n_sentences = np.bincount(text_of, weights=np.where(has_words, ends, 0), minlength=n_texts).astype(np.int64)

    coded = pa.concat_arrays(words).dictionary_encode()
    size = max(len(coded.dictionary), 1)
    pairs, counts = np.unique(text_of[word_line] * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(pairs // size, minlength=n_texts))]).astype(np.int32)
    distinct = coded.dictionary.take(pa.array(pairs % size)).cast(pa.string())
    n_words = np.bincount(text_of[word_line], minlength=n_texts)
    return n_words, n_sentences, pa.ListArray.from_arrays(offsets, distinct), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK bytes; a longer text is one by itself."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, "right"))
        yield at, max(upto, at + 1)
        at = max(upto, at + 1)


def word_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns, n_words, n_sentences, words (distinct, array<string>) and counts of every row of docs (text).
    The only pass over the texts, in Arrow's and numpy's own loops."""
    d = docs.select(*keep, "text")
    names = [*keep, "n_words", "n_sentences", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in _chunks(b.column(len(keep))):
                part = b.slice(a, z - a)
                n, s, w, c = count_words(part.column(len(keep)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64()), pa.array(s, pa.int64()), w, c], names)

    schema = "".join(f"`{c}` {d.schema[c].dataType.simpleString()}, " for c in keep)
    return d.mapInArrow(run, schema + "n_words bigint, n_sentences bigint, words array<string>, counts array<int>")


@dataclass
class Formula:
    """What the lists and coefficients are; plain data that travels to the executors."""

    words: list[str] = field(default_factory=list)
    masks: list[int] = field(default_factory=list)  # of each word the lists that hold it, bit by bit, and KNOWN
    weights: list[float] = field(default_factory=lambda: [3.0] + [0.0] * (N_LISTS + 1))
    cut: float = 3.5

    def shares(self, words: pa.ListArray, counts: pa.ListArray, n_words: np.ndarray, n_sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features of each text, share of its words that labelled documents have). Features: 1, the share of words
        outside each list, and the logarithm of words a sentence."""
        flat, n = words.flatten(), counts.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = words.offsets.to_numpy()
        at = at - at[0]
        masks = np.array([*self.masks, 0], np.int64)
        bits = masks[pc.fill_null(pc.index_in(flat, pa.array(self.words, pa.string())), len(self.words)).to_numpy(zero_copy_only=False)]
        total = np.maximum(n_words, 1)

        def share(hit: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0.0], np.cumsum(np.where(hit, n, 0.0))])
            return (upto[at[1:]] - upto[at[:-1]]) / total

        outside = [share(bits >> i & 1 == 0) for i in range(N_LISTS)]
        length = np.log1p(n_words / np.maximum(n_sentences, 1))
        return np.stack([np.ones(len(total)), *outside, length], axis=1), share(bits & KNOWN > 0)


def median_levels(labels: DataFrame, sample: int = LABEL_SAMPLE) -> DataFrame:
    """doc_id and the median of its readers' levels, of at most `sample` documents (the least hashes); each
    reader counts once for a document, by the latest of their levels; null levels don't count."""
    one = labels.where("level BETWEEN 1 AND 5").groupBy("doc_id", "rater").agg(F.max_by("level", F.struct("rated_at", "level")).alias("level"))
    return one.groupBy("doc_id").agg(F.median("level").alias("level")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def build_lists(frequent: list[tuple[str, float]], labelled: list[tuple]) -> Formula:
    """The familiar-word lists. frequent: (word, share of all documents with it): a list for each of FREQUENT.
    labelled: (word, documents with it at levels 1 to 5), the empty word carrying the numbers of documents: a list
    for each of CUTS and RATIOS of the words whose document frequency below that level is at least so many times
    that above it."""
    lists: dict[str, int] = {}
    for w, share in frequent:
        lists[w] = sum(1 << i for i, least in enumerate(FREQUENT) if share >= least)
    by = {r[0]: r[1:] for r in labelled}
    total = by.pop("", (0,) * 5)
    for k, cut in enumerate(CUTS):
        below = [i for i in range(5) if i + 1 < cut]
        above = [i for i in range(5) if i + 1 >= cut]
        e, h = sum(total[i] for i in below), sum(total[i] for i in above)
        for w, v in by.items():
            odds = (sum(v[i] for i in below) + 0.5) / (e + 1) * (h + 1) / (sum(v[i] for i in above) + 0.5)
            at = len(FREQUENT) + k * len(RATIOS)
            lists[w] = lists.get(w, 0) | KNOWN | sum(1 << (at + j) for j, r in enumerate(RATIOS) if odds >= r)
    return Formula(list(lists), list(lists.values()))


def fit(f: Formula, x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> Formula:
    """Coefficients by ridge regression on the labelled documents (few labels: near the constant 3), and the cut
    between levels 3 and 4 that agrees best with the readers."""
    prior = np.array([3.0] + [0.0] * (N_LISTS + 1))
    pen = ridge * (len(y) + 1) * np.diag([1e-6] + [1.0] * (N_LISTS + 1))
    f.weights = np.linalg.solve(x.T @ x + pen, x.T @ y + pen @ prior).tolist()
    p = np.clip(x @ np.array(f.weights), 1, 5)
    sure = (y <= 3) | (y >= 4)
    hard = y[sure] >= 4

    def f1(cut: float) -> float:
        said = p[sure] >= cut
        return 2 * (said & hard).sum() / max(1, said.sum() + hard.sum())

    cuts = np.arange(3.0, 4.01, 0.02)
    scores = [f1(c) for c in cuts]
    f.cut = float(np.median([c for c, s in zip(cuts, scores) if s >= max(scores) - 1e-9]))
    return f


def train_counts(counts: DataFrame, labels: DataFrame) -> Formula:
    """The formula of a corpus from its written word_counts (doc_id): lists from document frequencies over all of
    it, coefficients from the readings."""
    n = counts.where("n_words > 0").count()
    words = counts.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    frequent = [(r.w, r.n / n) for r in words.where(F.col("n") >= max(1.0, n * FREQUENT[-1])).collect()]
    levels = median_levels(labels.select("doc_id", "rater", "level", "rated_at"))
    read = write_cut(counts.join(F.broadcast(levels), "doc_id"), "labelled")
    at = F.least(F.lit(5), F.greatest(F.lit(1), F.floor(F.col("level") + 0.5)))
    by_level = read.where("n_words > 0").select(F.explode(F.concat(F.array(F.lit("")), "words")).alias("w"), at.alias("at"))
    by_level = by_level.groupBy("w").agg(*(F.count_if(F.col("at") == i).alias(f"l{i}") for i in range(1, 6)))
    f = build_lists(frequent, [tuple(r) for r in by_level.collect()])
    rows = score(read.where("n_words >= 3"), f, ["level"], features=True).select("features", "level").collect()
    drop_cut(read)
    return fit(f, np.array([r[0] for r in rows]).reshape(-1, N_LISTS + 2), np.array([r[1] for r in rows], float))


def train(docs: DataFrame, labels: DataFrame) -> Formula:
    """The formula of a corpus (doc_id, text)."""
    counts = write_cut(word_counts(docs, ["doc_id"]), "word-counts")
    try:
        return train_counts(counts, labels)
    finally:
        drop_cut(counts)


def score(counts: DataFrame, f: Formula, keep: list[str], features: bool = False) -> DataFrame:
    """keep columns, n_words, n_sentences, english_share, level_estimate (1 to 5, null without words) of each row of
    word_counts."""
    d = counts.select(*keep, "n_words", "n_sentences", "words", "counts")
    names = [*keep, "n_words", "n_sentences", "english_share", "level_estimate"] + ["features"] * features
    shared = counts.sparkSession.sparkContext.broadcast(vars(f))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Formula(**shared.value)
        for b in batches:
            n, s = (b.column(len(keep) + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x, known = f.shares(b.column(len(keep) + 2), b.column(len(keep) + 3), n, s)
            level = pa.array(np.clip(x @ np.array(f.weights), 1.0, 5.0), mask=n == 0)
            more = [pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))] * features
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep) + 2], pa.array(known), level, *more], names)

    schema = "".join(f"`{c}` {d.schema[c].dataType.simpleString()}, " for c in keep)
    schema += "n_words bigint, n_sentences bigint, english_share double, level_estimate double" + ", features array<double>" * features
    return d.mapInArrow(run, schema)


def reading_levels(docs: DataFrame, labels: DataFrame, formula: Formula | None = None) -> DataFrame:
    """doc_id, n_words, n_sentences, english_share, level_estimate, is_english_prose, level (1 to 5) of each row.

    level and level_estimate are null where is_english_prose is false: null, empty and blank texts, pure
    machine output, other languages, fewer than three words of prose. English is told without any word list of a
    language: at least half of the words are words of labelled documents, which are English.

    Method: shares of words outside high-frequency lists, from the corpus's document frequencies (and those of its
    labelled documents below and above each level), plus average sentence length, as a linear formula fitted to the
    labels. Each text is split once; its word counts are written, and frequencies, lists and levels come from them.
    Defined cases: repeated texts get equal levels, repeated rows stay; without labels nothing is known to be
    English; whole texts and all words are read; other columns are ignored; an empty table gives no rows.
    """
    counts = word_counts(docs, ["doc_id"])
    if formula is None:
        counts = write_cut(counts, "word-counts")
        formula = train_counts(counts, labels)
    out = score(counts, formula, ["doc_id"])
    prose = (F.col("n_words") >= 3) & (F.col("english_share") >= ENGLISH)
    hard = F.col("level_estimate") >= formula.cut
    near = F.round(F.col("level_estimate")).cast("int")
    level = F.when(hard, F.greatest(F.lit(4), near)).otherwise(F.least(F.lit(3), near))
    return out.withColumn("is_english_prose", prose).withColumn("level", F.when(prose, level)).withColumn("level_estimate", F.when(prose, F.col("level_estimate")))
