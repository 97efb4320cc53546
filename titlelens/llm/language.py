"""Language identification by bit-sliced Bloom filters over character trigrams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.shingles import mix

#: A trigram enters a language's filter if it makes up at least this share of
#: the language's trigrams (so at most 1 / MIN_SHARE enter) ...
MIN_SHARE = 1e-5
#: ... and this part of the largest share that it has in any language.
MIN_RATIO = 0.2
HASHES = 3
BITS_PER_GRAM = 12

_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> list[str]:
    found = _WORD.findall((text or "").lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all words, padded with one mark at either side, packed into
    63 bits; and for each the number of its word."""
    codes = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.cumsum(codes == 0) - 1
    inner = codes[1:-1] != 0
    grams = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[inner]
    return grams, word[1:-1][inner]


class Filters(NamedTuple):
    """One row of the table is a position of all languages' Bloom filters: a
    bit for each language, so that one gram's rows, and-ed, name all of them."""

    languages: list[str]
    usual: int  # the language with most training text, for texts with no known trigram
    table: np.ndarray  # uint64, positions x words of 64 languages
    false_rate: np.ndarray  # chance that a gram outside a language's set is taken for one inside

    def masks(self, grams: np.ndarray) -> np.ndarray:
        out = None
        for at in _positions(grams, len(self.table)):
            got = self.table[at]
            out = got if out is None else out & got
        return out

    def counts(self, words: list[str]) -> np.ndarray:
        """For each word, trigrams found by language, and in the last column all."""
        grams, word = trigrams(words)
        distinct, back = np.unique(grams, return_inverse=True)
        bits = np.unpackbits(self.masks(distinct).view(np.uint8), axis=1, bitorder="little")[:, :len(self.languages)]
        out = np.empty((len(words), len(self.languages) + 1), np.int32)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(word, bits[:, k][back], minlength=len(words))
        out[:, -1] = np.bincount(word, minlength=len(words))
        return out

    def decide(self, hits: np.ndarray) -> tuple[str, float]:
        n = hits[-1]
        likely = np.clip((hits[:-1] - n * self.false_rate) / (1 - self.false_rate), 0, None)
        total = likely.sum()
        if total <= 0:
            return self.languages[self.usual], 0.0
        best = int(np.argmax(likely))
        return self.languages[best], float(min(1.0, likely[best] / total))


def _positions(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h = mix(grams.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = mix(h) | np.uint64(1)
    for k in range(HASHES):
        yield ((h + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filters:
    """Counts the trigrams of every training text by language and builds the
    filters. Only what passes MIN_SHARE reaches the driver: at most
    1 / MIN_SHARE trigrams a language, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, int]] = {}
        for batch in batches:
            seen: dict[str, dict[str, int]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known = seen.setdefault(lang, {})
                for w in _words(text):
                    known[w] = known.get(w, 0) + 1
            for lang, known in seen.items():
                if known:
                    grams, word = trigrams(list(known))
                    distinct, back = np.unique(grams, return_inverse=True)
                    n = np.bincount(back, np.fromiter(known.values(), np.int64, len(known))[word])
                    into = sums.setdefault(lang, {})
                    for g, c in zip(distinct.tolist(), n.astype(np.int64).tolist(), strict=True):
                        into[g] = into.get(g, 0) + c
            if sum(map(len, sums.values())) > 1_000_000:
                yield from _rows(sums)
                sums = {}
        yield from _rows(sums)

    grams = (train.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = (grams.join(totals, "lang").where(F.col("n") >= MIN_SHARE * F.col("total"))
            .select("lang", "gram", (F.col("n") / F.col("total")).alias("share"), "total").toArrow())
    lang = np.array(kept["lang"].to_pylist(), object)
    gram, share, total = (kept[c].to_numpy() for c in ("gram", "share", "total"))
    languages = sorted(set(lang.tolist()))
    amount = [int(total[lang == x].max()) for x in languages]
    distinct, back = np.unique(gram, return_inverse=True)
    top = np.zeros(len(distinct))
    np.maximum.at(top, back, share)
    use = share >= MIN_RATIO * top[back]
    size = 1 << max(10, int(BITS_PER_GRAM * max(1, len(distinct))).bit_length())
    table = np.zeros((size, -(-max(1, len(languages)) // 64)), np.uint64)
    for k, x in enumerate(languages):
        for at in _positions(gram[use & (lang == x)], size):
            table[at, k // 64] |= np.uint64(1) << np.uint64(k % 64)
    fill = np.array([float(((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(len(languages))])
    return Filters(languages, int(np.argmax(amount)) if amount else 0, table, fill ** HASHES)


def _rows(sums: dict[str, dict[int, int]]) -> Iterator[pa.RecordBatch]:
    for lang, into in sums.items():
        yield pa.record_batch([pa.array([lang] * len(into)), pa.array(list(into), pa.int64()), pa.array(list(into.values()), pa.int64())],
                              names=["lang", "gram", "n"])


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        got = self[word] = len(self)
        return got


def identify(filters: Filters, docs: DataFrame, extra: list[Column], text_col: str = "text") -> DataFrame:
    """``extra`` and ``lang_pred, score`` of each whole text.

    Trigram counts of a word are kept while a task meets it again.  A null text, or one
    without letters, is ``und`` with score 0; one without a known trigram gets the most
    frequent language with score 0, the score otherwise being the language's part of all corrected counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(*extra, F.col(text_col).alias("__text"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        numbers, table = _Numbers(), np.zeros((0, len(f.languages) + 1), np.int32)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                if len(numbers) > 300_000:
                    numbers, table = _Numbers(), table[:0]
                texts = [list(map(numbers.__getitem__, _words(t))) for t in batch.column(batch.num_columns - 1).to_pylist()]
                if len(numbers) > len(table):
                    new = list(numbers)[len(table):]
                    table = np.concatenate((table, f.counts(new)))
                got = [f.decide(table[t].sum(axis=0)) if t and f.languages else ("und", 0.0) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=[*kept, "lang_pred", "score"])

    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: ``doc_id, held_out, lang_pred, score``.  Documents
    whose crc32 of the id is 2 modulo 4 are held out of the fit, and so
    are those without id or language (null ids count as not held out)."""
    held_out = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
    filters = fit(docs.where(~held_out), lang_col, text_col)
    return identify(filters, docs, [F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out")], text_col)
