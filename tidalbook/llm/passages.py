"""Passages that repeat inside longer, otherwise different lines.

Line dedup compares whole lines. This cuts what it cannot see: a run of more
than ``min_words`` words (cut at single spaces, compared word for word) in a
line of one document that also stands in a line of a document with a smaller
doc_id. The whole run goes from the later document, and the first keeps it.

A line is cut into pieces after punctuation and after words of one or two
characters, so that a run is cut alike wherever it stands. Pieces of ANCHOR_BYTES
bytes or more that two documents share are anchors. Each line that holds one is
laid against the line of the anchor's first document (the smallest doc_id, then
the first line and piece), and the run around the anchor is extended to both
sides, word by word. So a hash only proposes; words decide. Not found is a run
without a whole piece of that size inside, one that goes on over a line end with
no more than ``min_words`` words in each line, and one of which all anchors lie
inside another run of the same two lines.

Null and empty texts have no words. Rows without a doc_id neither lose nor lend
words. Rows with the same doc_id count as one document: what they share with
each other stays. Equal rows lose equal words. Other columns are left alone.

How it scales
-------------
Anchors come from one partial aggregate of numbers (piece hash, smallest and
largest doc_id), so a piece that a third of all documents share arrives as one
row per task. Only lines with an anchor are shuffled, each once for every line
it is laid against, in joins whose hot keys adaptive execution splits; texts
that lose nothing stay where they were read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import fresh, marked, row_slices, stored, with_mark

MIN_WORDS = 50
ANCHOR_BYTES = 32
ENDS = (".", "!", "?", ",", ";", ":")
CUT = r" (?<=[.!?,;:] |(?<![^ ])[^ ]{1,2} )"  # the space after a word that ends so, or of one or two characters
PLACE = ("doc_id", "text_key", "line_no")


def _text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _long_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, line_no, line) for each line of more than min_words words."""
    lines = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    spaces = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    return lines.where((F.octet_length("line") > 2 * min_words) & (spaces >= min_words) & F.col("doc_id").isNotNull())


def _pieces(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, line_no, piece_no, piece) for each piece of a long line that may be an anchor; piece is a hash."""
    pieces = _long_lines(docs, min_words).select(*PLACE, F.posexplode(F.split("line", CUT)).alias("piece_no", "words"))
    return pieces.where(F.octet_length("words") >= ANCHOR_BYTES).select(*PLACE, "piece_no", F.xxhash64("words").alias("piece"))


def _starts(words: list[str]) -> list[int]:
    """The place of each piece's first word."""
    return [0, *(i for i in range(1, len(words)) if words[i - 1].endswith(ENDS) or 0 < len(words[i - 1]) <= 2)]


def shared_runs(line: str, other: str, anchors: list[tuple[int, int]], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Runs [start, end) of more than min_words words of ``line`` that stand in ``other``, around pieces they share."""
    a, b = line.split(" "), other.split(" ")
    starts_a, starts_b = _starts(a), _starts(b)
    runs, done, covered = [], {}, 0  # done: by the distance between both places, how far the last run there went
    for piece, other_piece in sorted(anchors):
        i, j = starts_a[piece], starts_b[other_piece]
        if i < covered or i < done.get(j - i, 0) or a[i] != b[j]:
            continue
        start = i
        while start and start + j - i and a[start - 1] == b[start - 1 + j - i]:
            start -= 1
        end = i
        while end < len(a) and end + j - i < len(b) and a[end] == b[end + j - i]:
            end += 1
        done[j - i] = end
        if end - start > min_words:
            runs.append((start, end))
            covered = end
    return runs


def _run_batches(min_words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("line_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = [
                (row["doc_id"], row["text_key"], row["line_no"], start, end)
                for row in batch.to_pylist()
                for start, end in shared_runs(row["line"], row["first_line"], [(p["piece_no"], p["first_piece"]) for p in row["anchors"]], min_words)
            ]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    return run


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, line_no, start, end): runs of words that an earlier document has; they may overlap."""
    pieces = _pieces(docs, min_words)
    shared = stored(
        pieces.groupBy("piece").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select(F.col("piece").alias("anchor"), F.col("low").alias("first_doc")),
        "anchors",
    )
    found = stored(marked(pieces, F.col("piece"), shared.select("anchor")).join(shared, F.col("piece") == F.col("anchor")).drop("anchor"), "anchor-places")
    firsts = found.where("doc_id = first_doc").groupBy("piece").agg(F.min(F.struct("text_key", "line_no", "piece_no")).alias("at")).withColumnRenamed("piece", "anchor")
    later = found.where("doc_id <> first_doc").join(firsts, F.col("piece") == F.col("anchor"))
    other = ("first_doc", "first_key", "first_no")
    later = later.select(*PLACE, "first_doc", F.col("at.text_key").alias("first_key"), F.col("at.line_no").alias("first_no"), "piece_no", F.col("at.piece_no").alias("first_piece"))
    pairs = stored(later.groupBy(*PLACE, *other).agg(F.collect_set(F.struct("piece_no", "first_piece")).alias("anchors")), "anchor-lines")  # as many as the line has pieces
    places = pairs.select(F.xxhash64(*PLACE)).union(pairs.select(F.xxhash64(*other)))
    lines = stored(marked(_long_lines(docs, min_words), F.xxhash64(*PLACE), places).dropDuplicates(PLACE), "passage-lines")
    first_lines = lines.select(*[F.col(c).alias(o) for c, o in zip(PLACE, other)], F.col("line").alias("first_line"))
    laid = pairs.join(lines, list(PLACE)).join(first_lines, list(other)).select(*PLACE, "line", "first_line", "anchors")
    return laid.mapInArrow(_run_batches(min_words), "doc_id bigint, text_key bigint, line_no int, start int, end int")


def without_runs(text: str, runs: list[tuple[int, int, int]]) -> str:
    """``text`` without the words of runs (line_no, start, end); a line of which every word went is left empty."""
    lines = text.split("\n")
    by_line: dict[int, list[tuple[int, int]]] = {}
    for line_no, start, end in runs:
        by_line.setdefault(line_no, []).append((start, end))
    for line_no, of_line in by_line.items():
        words, kept, at = lines[line_no].split(" "), [], 0
        for start, end in sorted(of_line):
            kept += words[at:start]
            at = max(at, end)
        lines[line_no] = " ".join(kept + words[at:])
    return "\n".join(lines)


def _cut_batches(runs: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            k = batch.schema.get_field_index("text")
            of_rows = batch.column(batch.schema.get_field_index(runs)).to_pylist()
            texts = [t if r is None else without_runs(t, [(x["line_no"], x["start"], x["end"]) for x in r]) for t, r in zip(batch.column(k).to_pylist(), of_rows)]
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return run


def drop_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with passages of over min_words words only in their first document; n_chars, if there, follows."""
    key, own, runs, loses = fresh(docs, "run_id", "run_key", "runs", "loses_runs")
    gone = repeated_runs(docs, min_words).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("line_no", "start", "end")).alias(runs))
    gone = stored(gone.withColumnsRenamed({"doc_id": key, "text_key": own}), "repeated-runs")
    doc_id = F.col("doc_id").cast("bigint")
    split = with_mark(docs, F.xxhash64(doc_id, _text_key("text")), gone.select(F.xxhash64(key, own)), loses)
    joined = split.where(loses).join(gone, (doc_id == F.col(key)) & (_text_key("text") == F.col(own)), "left").drop(key, own, loses)
    cut = joined.mapInArrow(_cut_batches(runs), joined.schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(runs).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return cut.select(*docs.columns).unionByName(split.where(~F.col(loses)).select(*docs.columns))
