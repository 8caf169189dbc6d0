"""Line dedup: lines that many documents share are dropped from all of them.

Lines are exploded, their normalised keys hashed to 128 bits, and distinct documents counted per hash; the hashes
over the threshold come back to the line positions they stand at, and each document is put together again from the
lines at its other positions. Only hashes and positions are shuffled for the counts; a text moves once at most, to
meet its dropped positions. Counts combine before they travel, and a line that a third of all documents share is a
hot key only on the streamed side of a join, which AQE splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import BREAKS, digest, sliced, texts


def _exploded(min_chars: int):
    """One row per line: its document's digest, position, key hash, and whether it is the key's first line there."""
    def run(batches):
        for batch in sliced(batches):
            rows, positions, firsts, hashes = [], [], [], []
            for row, text in enumerate(texts(batch)):
                seen = set()
                for position, line in enumerate(text.split(b"\n")):
                    key = line.strip(BREAKS).lower()
                    # Code points, not bytes: continuation bytes do not count.
                    if len(key) < min_chars or len(key.decode("utf-8", "replace")) < min_chars:
                        continue
                    hashed = xxhash.xxh3_128_digest(key)
                    rows.append(row)
                    positions.append(position)
                    hashes.append(hashed)
                    firsts.append(hashed not in seen)
                    seen.add(hashed)
            if rows:
                halves = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64)
                owner = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("d1").take(owner), batch.column("d2").take(owner), pa.array(positions, pa.int32()),
                    pa.array(halves[0::2]), pa.array(halves[1::2]), pa.array(firsts, pa.bool_()),
                ], ["d1", "d2", "position", "h1", "h2", "first"])
    return run


def _reassembled(batches):
    for batch in sliced(batches):
        kept, counts = [], []
        for text, dropped in zip(texts(batch), batch.column("dropped").to_pylist()):
            lines = text.split(b"\n")
            counts.append(len(lines))
            if dropped:
                gone = set(dropped)
                lines = [line for position, line in enumerate(lines) if position not in gone]
            kept.append(b"\n".join(lines))
        gone = pa.compute.fill_null(pa.compute.list_value_length(batch.column("dropped")), 0)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(counts, pa.int64()), gone.cast(pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ], ["doc_id", "n_lines", "n_dropped", "kept_text"])


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop each line whose key stands in ``min_docs`` documents or more, from every document.

    A key is the line without ASCII white space at its ends, A-Z lower-cased; keys under ``min_chars`` code points
    never count. Returns doc_id, n_lines (before dropping), n_dropped and kept_text, one row per input row.

    Null or empty text is one empty line. Rows that repeat both doc_id and text are one document and count once; each
    still gets its row. A null doc_id is an ordinary value. Columns besides doc_id and text are ignored, whatever
    their names. An empty table gives an empty result.
    """
    d1, d2 = digest(F.col("doc_id"), F.col("text"))
    keyed = docs.select("doc_id", "text").select("doc_id", "text", d1.alias("d1"), d2.alias("d2"))
    lines = keyed.select("d1", "d2", "text").mapInArrow(
        _exploded(min_chars), "d1 long, d2 long, position int, h1 long, h2 long, first boolean")
    # A document repeated as a whole must count once, so its digest is part of what is counted.
    counted = (
        lines.filter("first").select("h1", "h2", "d1", "d2").distinct()
        .groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("h1", "h2")
    )
    dropped = (
        lines.select("d1", "d2", "position", "h1", "h2").join(counted, ["h1", "h2"])
        .groupBy("d1", "d2").agg(F.collect_set("position").alias("dropped"))
    )
    found = keyed.join(dropped, ["d1", "d2"], "left").select("doc_id", "text", "dropped")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_reassembled, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string")
