"""Language identification with spans of mixed-language text (operator 6).

Script ranges narrow the candidates of a word to the languages that were seen in
that script. A word's score for a language is the sum of the log-probabilities of
its character trigrams and of the word itself. Viterbi over the words of a text,
with a penalty for each switch of language, labels spans; the text's language is
the one whose spans hold the most letters, its score their share of all letters.

The model is fitted on a bounded sample of labelled rows (``sample_per_lang`` rows
of each language, in expectation, chosen by a hash of the id; only of the ``most_langs``
languages with the most rows, of equally many those that sort first) and has a bounded
size (``2 ** bits`` hashed features per language), so it can be broadcast. A column
of dirty labels thus can't make it grow. Every text is then labelled whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and
so is every text where no language was learned; ties go to the language that sorts
first; rows with a null id are predicted and never learned from; repeated rows get
the same answer; only the id, text and (in training) language columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.llm.spans import LETTER, TextBatch, chunks

UNKNOWN = "und"
SAMPLE_PER_LANG = 4000
MOST_LANGS = 128
FEATURE_BITS = 16
SWITCH_PENALTY = 12.0
CHUNK = 1 << 19
CELLS = 1 << 22  # letters times languages that are scored at once

# Unicode blocks of scripts (fixed values); letters outside them form one script of their own.
SCRIPT_RANGES = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPT_RANGES) + 1


@lru_cache(maxsize=1)
def scripts() -> np.ndarray:
    """The number of the script of every code point; 0 outside the ranges."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for first, last in ranges:
            table[first : last + 1] = k
    return table


class Words:
    """The words (runs of letters, lower-cased) of a batch of texts, with hashed features."""

    def __init__(self, texts: Sequence[str | None], bits: int):
        self.batch = batch = TextBatch(texts, lower=True)
        letter = batch.classes == LETTER
        self.starts, self.ends = batch.word_spans((LETTER,))
        self.script = scripts()[batch.cp[self.starts]]
        self.per_text = np.diff(np.searchsorted(self.starts, batch.begins))
        flat = np.zeros(len(batch.cp) + 2, dtype=np.uint64)
        flat[1:-1] = np.where(letter, batch.cp, 0)
        at = np.flatnonzero(letter)
        a, b, c = flat[at], flat[at + 1], flat[at + 2]
        mixed = (a * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xC2B2AE3D27D4EB4F) + c
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        #: Of every letter, the trigram around it; of every word, the word. Upper half: words.
        self.trigram = (mixed >> np.uint64(65 - bits)).astype(np.int64)
        self.word = (batch.hashes(self.starts, self.ends) >> np.uint64(65 - bits)).astype(np.int64) + (1 << (bits - 1))
        #: Where each word's letters begin among all letters.
        self.first = np.concatenate(([0], np.cumsum(self.ends - self.starts)))[:-1]


def _count_features(docs: DataFrame, bits: int) -> DataFrame:
    """``lang, script, feature, n`` of the given ``lang, text`` rows, added up per batch first."""

    def run(batches):
        size = 1 << bits
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in chunks(texts):
                words = Words(texts[i:j], bits)
                names = sorted(set(langs[i:j]))
                code = np.array([names.index(x) for x in langs[i:j]], dtype=np.int64)
                of_word = np.repeat(code, words.per_text)
                length = words.ends - words.starts
                of_letter = np.repeat(of_word, length)
                features = np.concatenate((of_letter * size + words.trigram, of_word * size + words.word))
                counts = np.bincount(features, minlength=len(names) * size)
                at = np.flatnonzero(counts)
                by_script = np.bincount(of_word * N_SCRIPTS + words.script, weights=length, minlength=len(names) * N_SCRIPTS)
                where = np.flatnonzero(by_script)
                found = np.concatenate((at // size, where // N_SCRIPTS))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[k] for k in found.tolist()], pa.string()),
                        pa.array(np.concatenate((at % size, -1 - where % N_SCRIPTS)), pa.int64()),
                        pa.array(np.concatenate((counts[at], by_script[where].astype(np.int64))), pa.int64()),
                    ],
                    names=["lang", "feature", "n"],
                )

    counted = docs.mapInArrow(run, "lang string, feature long, n long")
    return counted.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of the features by language, and the languages of each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, script_letters: np.ndarray, bits: int, least_share: float):
        self.langs, self.bits = langs, bits
        half = 1 << (bits - 1)
        table = np.zeros_like(counts, dtype=np.float64)
        for part in (slice(0, half), slice(half, 2 * half)):
            smooth = counts[part] + 0.5
            table[part] = np.log(smooth / smooth.sum(axis=0, keepdims=True))
        # a feature that no language has tells nothing
        table[counts.sum(axis=1) == 0] = 0.0
        self.table = table.astype(np.float32)
        share = script_letters / np.maximum(1, script_letters.sum(axis=0, keepdims=True))
        allowed = share >= least_share
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0.0, -1e6).astype(np.float32)

    def label(self, texts: Sequence[str | None], penalty: float) -> tuple[Words, np.ndarray]:
        """The words of the texts and the number of each word's language."""
        words = Words(texts, self.bits)
        if not len(words.starts):
            return words, np.zeros(0, dtype=np.int64)
        score = self.table[words.word]
        # words that begin within the same stretch of letters are scored together
        at = np.flatnonzero(np.diff(words.first // max(1, CELLS // len(self.langs)), prepend=-1)).tolist()
        edges = np.append(words.first, len(words.trigram))
        for i, j in zip(at, [*at[1:], len(words.first)], strict=True):
            begin, end = edges[i], edges[j]
            score[i:j] += np.add.reduceat(self.table[words.trigram[begin:end]], words.first[i:j] - begin, axis=0)
        score += self.barred[words.script]
        return words, viterbi(score, words.per_text, penalty)


def viterbi(score: np.ndarray, per_text: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every row for texts of ``per_text`` rows each: the sum of the rows' scores
    less ``penalty`` for each change of label between neighbours. All texts advance together."""
    n_labels = score.shape[1]
    labels = np.zeros(len(score), dtype=np.int64)
    if n_labels == 1 or not len(score):
        return labels
    order = np.argsort(-per_text, kind="stable")
    sizes = per_text[order]
    begin = (np.cumsum(per_text) - per_text)[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts longer than t
    came = np.zeros((len(score), n_labels), dtype=np.min_scalar_type(n_labels - 1))
    best = score[begin[: active[0]]].astype(np.float64)
    last = np.zeros(active[0], dtype=np.int64)
    for t in range(1, longest):
        if active[t] < len(best):
            last[active[t] : len(best)] = best[active[t] :].argmax(axis=1)
            best = best[: active[t]]
        at = begin[: active[t]] + t
        top = best.argmax(axis=1)
        moved = best[np.arange(len(best)), top][:, None] - penalty
        switch = moved > best
        came[at] = np.where(switch, top[:, None], np.arange(n_labels))
        best = np.where(switch, moved, best) + score[at]
    last[: len(best)] = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        at = begin[: active[t]] + t
        now = last[: active[t]]
        labels[at] = now
        if t:
            last[: active[t]] = came[at, now]
    return labels


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_lang: int = SAMPLE_PER_LANG,
    bits: int = FEATURE_BITS,
    least_share: float = 0.005,
    most_langs: int = MOST_LANGS,
) -> Model:
    """Fits the model on a sample of ``labelled``: about ``sample_per_lang`` rows of each of the ``most_langs``
    languages that have the most rows."""
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("id is not null and text is not null and lang is not null")
    by_lang = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    totals = {r["lang"]: r["n"] for r in by_lang.limit(most_langs).collect()}
    langs = sorted(totals)
    counts = np.zeros((1 << bits, len(langs)), dtype=np.float64)
    letters = np.zeros((N_SCRIPTS, len(langs)), dtype=np.float64)
    if langs:
        grain = 1 << 20
        most = {lang: -(-grain * sample_per_lang // max(n, sample_per_lang)) for lang, n in totals.items()}
        shares = labelled.sparkSession.createDataFrame(list(most.items()), "lang string, most long")  # up to most_langs rows
        sample = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("id"), F.lit(grain)) < F.col("most"))
        sample = sample.select("lang", "text")
        # at most (features + scripts) rows of each language
        table = _count_features(sample, bits).toPandas()
        lang = np.searchsorted(np.array(langs), table["lang"].to_numpy(dtype=str))
        feature, n = table["feature"].to_numpy(), table["n"].to_numpy()
        real = feature >= 0
        counts[feature[real], lang[real]] = n[real]
        letters[-1 - feature[~real], lang[~real]] = n[~real]
    return Model(langs, counts, letters, bits, least_share)


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id_col, lang_pred, score, spans``: spans are code points, end exclusive, of one language each.

    ``carry`` names more columns that come through (the text, say, so that no join is needed for it).
    """
    docs = docs.select(id_col, F.col(text_col).alias("_text"), *carry)
    through = [id_col, *carry]
    names = [*through, "lang_pred", "score", "spans"]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2 ** bits numbers
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        model = sent.value
        langs = model.langs
        for b in batches:
            texts = b.column("_text").to_pylist()
            for i, j in chunks(texts, CHUNK):
                n = j - i
                if langs:
                    words, label = model.label(texts[i:j], penalty)
                    doc = np.repeat(np.arange(n), words.per_text)
                    letters = np.bincount(
                        doc * len(langs) + label, weights=words.ends - words.starts, minlength=n * len(langs)
                    ).reshape(n, len(langs))
                    total = letters.sum(axis=1)
                    top = letters.argmax(axis=1)
                    score = letters[np.arange(n), top] / np.maximum(total, 1)
                    pred = [langs[t] if all_ else UNKNOWN for t, all_ in zip(top.tolist(), total.tolist(), strict=True)]
                    new = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(label, prepend=-1)) if len(doc) else doc
                    stop = np.concatenate((new[1:], [len(doc)]))[: len(new)]
                    offset = words.batch.begins[doc[new]]
                    spans = pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=n)))), pa.int32()),
                        pa.StructArray.from_arrays(
                            [
                                pa.array(words.starts[new] - offset, pa.int64()),
                                pa.array((words.ends[stop - 1] if len(new) else stop) - offset, pa.int64()),
                                pa.array([langs[k] for k in label[new].tolist()], pa.string()),
                            ],
                            fields=list(span_type.value_type),
                        ),
                    )
                else:
                    pred, score, spans = [UNKNOWN] * n, np.zeros(n), pa.array([[]] * n, span_type)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c)[i:j] for c in through),
                        pa.array(pred, pa.string()),
                        pa.array(score, pa.float64()),
                        spans,
                    ],
                    names=names,
                )

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in through)
    found = "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"
    return docs.mapInArrow(run, kinds + found)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
