"""Phrase mining by Apriori: level-wise passes over the texts, then scores from the tables of all levels.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
pieces into words at spaces and tabs. A pass counts phrases of one length. From
the second on it emits a phrase only when both phrases that overlap in it, all
but its last and all but its first word, were frequent in the pass before; as a
part is at least as frequent as the whole, no frequent phrase is missed.

What the tasks are told about the pass before is a bitmap of the hashes of its
frequent phrases. Their list grows with the corpus, the bitmap stops at
MOST_BITS. A hash that is set by another phrase lets a phrase through which is
then counted like any other and dropped when it is not frequent, so the counts
are exact whatever the size of the bitmap.

A candidate's cut into its first k words and the rest is scored by
floor(1000000 * a * a / (l * r)), a, l and r the counts of the whole and the
parts, in exact decimals; the lowest-scoring cut counts, the first of equal
ones. Candidates inside a longer one that has half their count or more go.

Cases: a null text is empty, a null language is ``und``; rows that repeat count
again; an empty table gives an empty table; doc_id and other columns are not
read.

How it scales
-------------
Texts stay in their tasks. A task works through a few megabytes at a time:
words become numbers by dictionary encoding, phrases become pairs of numbers,
and each is emitted once with its count. Spark adds the counts up within the
task before they are shuffled, so a phrase that all texts share arrives once a
task. Lookups of parts are joins by phrase; adaptive execution broadcasts small
sides and splits frequent words. Ranks are taken within shares of a language
first, then of the shares' best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidalbook.llm._shared import stored

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
COVERED = 50
SHARES = 64
#: Bytes of text that a task counts at once; a longer text is counted at once by itself.
BLOCK_BYTES = 2 << 20
#: Bits of the bitmap: 16 for each frequent phrase, within these bounds (128 KB to 16 MB).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(languages, texts) of about ``block_bytes``; nulls are replaced."""
    langs: list[pa.Array] = []
    texts: list[pa.Array] = []
    held = 0
    for batch in batches:
        lang, text = (batch.column(k).cast(pa.large_string()).fill_null(v) for k, v in ((0, NO_LANG), (1, "")))
        begin, ends = 0, np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        while begin < len(text):
            last = int(np.searchsorted(ends, ends[begin] + max(block_bytes - held, 1), "right")) - 1
            last = min(max(last, begin + 1), len(text))
            langs.append(lang.slice(begin, last - begin))
            texts.append(text.slice(begin, last - begin))
            held += int(ends[last] - ends[begin])
            begin = last
            if held >= block_bytes:
                yield pa.concat_arrays(langs), pa.concat_arrays(texts)
                langs, texts, held = [], [], 0
    if langs:
        yield pa.concat_arrays(langs), pa.concat_arrays(texts)


def _words(langs: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(word numbers, whether a word goes on the piece of the one before, language of each number, word of each number)."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    doc_at = ends[:-1] - ends[0]
    kind = _KIND[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = doc_at[doc_at < len(data)]
    begins[firsts] |= inside[firsts]
    start = np.flatnonzero(begins)
    # The bytes of words, one after another: a word is as long as the way to the next start among them.
    kept = _LOWER[data[inside]]
    place = np.cumsum(inside, dtype=np.int64)[start] - 1 if len(start) else np.zeros(0, np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(place, len(kept)).astype(np.int64)), pa.py_buffer(kept)]).dictionary_encode()
    doc = np.searchsorted(doc_at, start, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    on = np.zeros(len(start), bool)
    on[1:] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
    coded = langs.dictionary_encode()
    lang = coded.indices.to_numpy()[doc].astype(np.int64) if len(start) else np.zeros(0, np.int64)
    size = len(words.dictionary)
    each, number = np.unique(lang * size + words.indices.to_numpy().astype(np.int64), return_inverse=True)
    return number, on, coded.dictionary.take(pa.array(each // max(size, 1))), words.dictionary.take(pa.array(each % max(size, 1)))


def _hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """Hashes of words of a language: the bytes as a polynomial, then mixed."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    start, length = ends[:-1] - ends[0], np.diff(ends)
    power = np.multiply.accumulate(np.full(int(length.max()), np.uint64(0x100000001B3)))
    sums = np.add.reduceat(data * power[np.arange(len(data)) - np.repeat(start, length)], start)
    coded = langs.dictionary_encode()
    seeds = np.array([xxhash.xxh3_64_intdigest(name.encode()) for name in coded.dictionary.to_pylist()], np.uint64)[coded.indices.to_numpy()]
    return _joined(sums, seeds)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all but their last and all but their first word."""
    mixed = (left * _MIX) ^ ((right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX


def _known(hashed: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = hashed & np.uint64(bitmap.size * 8 - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counter(length: int, told: Callable[[], list[bytes]], block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Emits (lang, phrase, hash, count) of the phrases of ``length`` words; told gives the bitmaps of the shorter ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b, np.uint8) for b in told()]
        space = pa.scalar(b" ", pa.large_binary())
        for langs, texts in _blocks(batches, block_bytes):
            number, on, of_lang, words = _words(langs, texts)
            hashed = _hashes(of_lang, words)
            phrases = words
            for k in range(2, length + 1):
                # number[i] is the phrase of k - 1 words that begins at word i, or -1.
                goes_on = on[k - 1 :] & (number[:-1] >= 0) & (number[1:] >= 0)
                at = np.flatnonzero(goes_on)
                fine = _known(hashed, bitmaps[k - 2])
                at = at[fine[number[at]] & fine[number[at + 1]]]
                each, of_each = np.unique(number[at] * len(hashed) + number[at + 1], return_inverse=True)
                left, right = each // max(len(hashed), 1), each % max(len(hashed), 1)
                tail = right if k == 2 else tail[right]
                phrases = pc.binary_join_element_wise(phrases.take(pa.array(left)), words.take(pa.array(tail)), space)
                of_lang = of_lang.take(pa.array(left))
                hashed = _joined(hashed[left], hashed[right])
                number = np.full(len(goes_on), -1, np.int64)
                number[at] = of_each
            n_each = np.bincount(number[number >= 0], minlength=len(phrases))
            yield pa.record_batch([of_lang.cast(pa.string()), phrases.cast(pa.string()), pa.array(hashed.view(np.int64)), pa.array(n_each, pa.int64())], names=["lang", "phrase", "hash", "f"])

    return count


def _bitmap(spark: SparkSession, frequent: DataFrame) -> bytes:
    """Bits of the hashes of frequent phrases. What comes to the driver is rows of 4 KB, MOST_BITS in all at most."""
    bits = LEAST_BITS
    wanted = 16 * frequent.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    place = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    rows = frequent.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = bytearray(bits // 8)
    for row in rows.toLocalIterator():
        begin = (row["bucket"] - 1) * 4096
        out[begin : begin + 4096] = row["bits"]
    return bytes(out)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """(the frequent phrases of each length as (lang, phrase, f), words of each language as (lang, n)), written."""
    spark = docs.sparkSession
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    levels, told, n_words = [], [], None
    for length in range(1, max_words + 1):
        bitmaps = spark.sparkContext.broadcast(list(told))
        found = rows.mapInArrow(_counter(length, lambda bitmaps=bitmaps: bitmaps.value, block_bytes), "lang string, phrase string, hash bigint, f bigint")
        counted = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min("hash").alias("hash"))
        if length == 1:
            counted = stored(counted, "phrases-words")
            n_words = stored(counted.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
        frequent = stored(counted.where(F.col("f") >= min_count), f"phrases{length}")
        levels.append(frequent.select("lang", "phrase", "f"))
        if length < max_words:
            told.append(_bitmap(spark, frequent))
    return levels, n_words


def _first_words(k: int) -> Column:
    return F.substring_index("phrase", " ", k)


def _last_words(k: int) -> Column:
    return F.substring_index("phrase", " ", -k)


def scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of all candidates: frequent phrases of two words or more, by their lowest-scoring cut."""
    tables = [t.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f")) for t in levels]

    def with_count(rows: DataFrame, part: Column, length: int, name: str) -> DataFrame:
        return rows.join(tables[length - 1].withColumnRenamed("part_f", name), (F.col("lang") == F.col("part_lang")) & (part == F.col("part"))).drop("part_lang", "part")

    out = []
    for size in range(2, len(levels) + 1):
        rows = levels[size - 1].withColumnRenamed("f", "a").withColumn("words", F.lit(size))
        for k in range(1, size):
            rows = with_count(with_count(rows, _first_words(k), k, f"l{k}"), _last_words(size - k), size - k, f"r{k}")
        wide = lambda c: F.col(c).cast("decimal(19,0)")
        cuts = [
            F.struct(
                F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(31,0)"), wide(f"l{k}") * wide(f"r{k}")).alias("score"),
                F.lit(k).alias("k"),
                F.col(f"l{k}").alias("l"),
                F.col(f"r{k}").alias("r"),
            )
            for k in range(1, size)
        ]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        out.append(rows.select("lang", "phrase", "words", "a", "cut.l", "cut.r", F.col("cut.score").cast("bigint").alias("score")))
    return reduce(DataFrame.unionByName, out)


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates that no longer candidate holds with ``covered`` per cent of their count or more.

    One word more is enough to look at: a phrase inside a longer one is inside
    a part of it that has one word more than the phrase and is no rarer.
    """
    longer = candidates.where("words > 2").select(F.col("lang").alias("in_lang"), F.col("a").alias("in_a"), F.explode(F.array(_first_but_last(), _last_but_first())).alias("inner"))
    best = longer.groupBy("in_lang", "inner").agg(F.max("in_a").alias("in_a"))
    joined = candidates.join(best, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left")
    return joined.where(F.col("in_a").isNull() | (100 * F.col("in_a") < covered * F.col("a"))).select(*candidates.columns)


def _first_but_last() -> Column:
    return F.expr("substring_index(phrase, ' ', words - 1)")


def _last_but_first() -> Column:
    return F.expr("substring_index(phrase, ' ', 1 - words)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, covered: int = COVERED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, then count, then bytes."""
    levels, n_words = phrase_counts(docs, min_count, max_words, block_bytes)
    found = uncovered(stored(scored(levels), "phrases-scored"), covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)  # SHARES * top rows a language
    named = n_words.withColumnRenamed("lang", "its_lang")
    return ranked.join(named, F.col("lang") == F.col("its_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
