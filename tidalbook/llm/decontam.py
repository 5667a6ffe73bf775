"""Benchmark decontamination: a prefix-filtered set join with exact checks.

A benchmark item is cut into windows of ``window`` consecutive words; an item
with fewer words, but not none, is one window. A document word is hit if it
lies in an occurrence of any window.

An occurrence holds every word of its window, so for containment a prefix of
one word is enough: the window's rarest, by a count over the whole corpus. The
join goes over that prefix word and, where all windows of an entry hold it, the
word beside it; windows that several items share are one entry. What it proposes is bounded by length
(the document must be as long as the window) and position (the window must fit
around the prefix word), and is then compared word for word.

How it scales
-------------
* Two map-only passes over the documents, without a shuffle of texts: one
  counts benchmark words (partial counts per task, then one small aggregate),
  one joins. Both are linear in the words of the corpus.
* The items are split into blocks of at most ``block_words`` words; only one
  block, with its words' counts, is broadcast at a time, whatever the size of
  the benchmark. What several blocks find in a document is merged afterwards.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import fresh, row_slices, stored

WINDOW = 13
BLOCK_WORDS = 1_000_000

#: Lower-cases A-Z, keeps 0-9, a-z and all bytes beyond ASCII, and blanks the rest.
_FOLD = bytes.maketrans(
    bytes(range(128)),
    bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(128)),
)

Item = tuple[str, list[bytes]]
#: (item number, place of the prefix word in the item, first window start, last window start)
Run = tuple[int, int, int, int]


class Prefixes(NamedTuple):
    """Different windows by prefix word and a neighbour of it, and the other items that have a window."""

    runs: dict[bytes, dict[bytes, list[Run]]]
    also: dict[tuple[int, int], list[int]]


def words(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def prefixes(items: list[Item], counts: dict[bytes, int], window: int) -> Prefixes:
    """Windows by their rarest word; ties go to the word's bytes, then the first place.

    Of equal windows only the first is looked for; ``also`` names the items of
    the others. Consecutive windows with the same prefix place are one entry.
    """
    runs: dict[bytes, dict[bytes, list[Run]]] = defaultdict(lambda: defaultdict(list))
    also: dict[tuple[int, int], list[int]] = defaultdict(list)
    seen: dict[bytes, tuple[int, int]] = {}

    def add(number: int, item: list[bytes], place: int, first: int, last: int) -> None:
        """Under the word after the prefix word, or before it, that all windows of the run hold; else under none."""
        size = min(window, len(item))
        near = b"+" + item[place + 1] if place + 1 < first + size else b"-" + item[place - 1] if place - 1 >= last else b""
        runs[item[place]][near].append((number, place, first, last))

    for number, (_, item) in enumerate(items):
        last = max(len(item) - window, 0)
        run: tuple[int, int] | None = None
        for start in range(last + 1):
            content = b" ".join(item[start : start + window])
            owner = seen.setdefault(hashlib.blake2b(content, digest_size=16).digest(), (number, start))
            if owner != (number, start):
                if owner[0] != number:
                    also[owner].append(number)
                if run:
                    add(number, item, run[0], run[1], start - 1)
                run = None
                continue
            place = min(range(start, min(start + window, len(item))), key=lambda p: (counts.get(item[p], 0), item[p], p))
            if run and run[0] == place:
                continue
            if run:
                add(number, item, run[0], run[1], start - 1)
            run = (place, start)
        if run:
            add(number, item, run[0], run[1], last)
    return Prefixes({word: dict(near) for word, near in runs.items()}, dict(also))


def occurrences(text_words: list[bytes], items: list[Item], table: Prefixes, window: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans (start, end) of the words hit, merged and in order, and the items found."""
    spans: list[tuple[int, int]] = []
    found: set[int] = set()
    noted: set[tuple[int, int]] = set()
    if table.runs.keys().isdisjoint(text_words):
        return spans, found
    n = len(text_words)

    def proposed(at: int, near: dict[bytes, list[Run]]) -> Iterator[Run]:
        yield from near.get(b"", ())
        if at + 1 < n:
            yield from near.get(b"+" + text_words[at + 1], ())
        if at:
            yield from near.get(b"-" + text_words[at - 1], ())

    for at, word in enumerate(text_words):
        near = table.runs.get(word)
        if near is None:
            continue
        for number, place, first, last in proposed(at, near):
            item = items[number][1]
            size = min(window, len(item))
            if n < size:
                continue
            first, last = max(first, place - at), min(last, n - size - at + place)  # the window fits into the text
            if first > last:
                continue
            left = place
            while left > first and item[left - 1] == text_words[at - place + left - 1]:
                left -= 1
            right = place + 1
            while right < last + size and item[right] == text_words[at - place + right]:
                right += 1
            first, last = max(first, left), min(last, right - size)
            if first <= last:
                spans.append((at - place + first, at - place + last + size))
                found.add(number)
                for key in ((number, start) for start in range(first, last + 1)) if table.also else ():
                    if key not in noted:
                        noted.add(key)
                        found.update(table.also.get(key, ()))
    spans.sort()
    merged: list[tuple[int, int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged, found


def word_counts(docs: DataFrame, items: list[Item]) -> DataFrame:
    """(word, n): how often each word of a block of items occurs in all documents."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(frozenset(w for _, item in items for w in item))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = vocabulary.value, Counter()
        for part in row_slices(batches):
            for text in part.column(0).to_pylist():
                counts.update(filter(known.__contains__, words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[Item]]:
    """Items with words, in blocks of at most ``block_words`` words (one item at least)."""
    block: list[Item] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item"), "text").toLocalIterator():
        item = words(row.text)
        if item:
            if block and size + len(item) > block_words:
                yield block
                block, size = [], 0
            block.append(("" if row.item is None else row.item, item))
            size += len(item)
    if block:
        yield block


def _hits_of_block(docs: DataFrame, items: list[Item], window: int) -> DataFrame:
    """docs (row, text) -> (row, n_words, spans, items) for each document."""
    counts = {bytes(r.word): r.n for r in word_counts(docs, items).toLocalIterator()} if items else {}
    shared = docs.sparkSession.sparkContext.broadcast((items, prefixes(items, counts, window)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, table = shared.value
        for part in row_slices(batches):
            counted, spans, found = [], [], []
            for text in part.column(1).to_pylist():
                own = words(text)
                hit, numbers = occurrences(own, items, table, window)
                counted.append(len(own))
                spans.append([{"start": a, "end": b} for a, b in hit])
                found.append(sorted({items[k][0] for k in numbers}))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counted, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(found, pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(run, "row bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>")


def _merged(spans: Column) -> Column:
    """Sum of the lengths of the union of spans, which may overlap."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0))).alias("n"),
        F.greatest(acc["at"], s["end"]).alias("at"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("at"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["n"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for each row of ``docs``.

    items are the ids, as strings and in string order, of the items of which a
    window occurs; rows of ``benchmark`` with one id count once. contaminated:
    some word is hit and 20 * n_hit >= n_words. A null text has no words; an
    item without words has no window; a null item_id is the empty string.
    Repeated rows each keep a row; clashing column names do not matter, as
    only doc_id, text and item_id, text are read.
    """
    spark = docs.sparkSession
    inputs = docs.select("doc_id", "text")
    blocks = _blocks(benchmark, block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        out = _hits_of_block(inputs.select(F.col("doc_id").cast("bigint").alias("row"), "text"), first, window).withColumnRenamed("row", "doc_id")
    else:
        numbered = stored(inputs.withColumn("row", F.monotonically_increasing_id()), "numbered")
        kept = None
        for block in (b for group in ([first, second], blocks) for b in group):
            part = stored(_hits_of_block(numbered.select("row", "text"), block, window).where((F.size("spans") > 0) | F.lit(kept is None)), "block-hits")
            kept = part if kept is None else kept.unionByName(part)
        gathered = kept.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        out = numbered.select("row", "doc_id").join(gathered, "row").drop("row")
    n_hit = _merged(F.col("spans"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id no contaminated text carries; columns stay.

    Rows without a doc_id stay.
    """
    found = find_contamination(docs, benchmark, window, block_words)
    (name,) = fresh(docs, "gone")
    gone = stored(found.where("contaminated").select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
