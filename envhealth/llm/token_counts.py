"""Token counts of documents in flat token files that have no index.

A file is little-endian token ids end to end; an end-of-document id closes each document. Files
are read in blocks. Each block finds its separators with one vectorised search, and a prefix
scan over the blocks gives every block the number of documents before it and the place of the
last separator before it, so that documents may begin and end in any block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import saved, shuffle_tasks, small_batches
from .words import NOT_SPACE, find_words, pieces

TOKEN, EOD = "<u2", 0
BLOCK_BYTES = 4 << 20
#: Blocks that are scanned together before the sums of such runs are scanned.
SCAN_RUN = 4096
FILE_BYTES = 64 << 20


def word_tokens(column: pa.Array) -> list[bytes]:
    """Each text's white-space words as 16-bit ids from 1 on; 0 is left to the separator."""
    out = []
    for texts in pieces(column):
        words = find_words(texts, NOT_SPACE)
        ids = (words.hashes % np.uint64(0xFFFF) + np.uint64(1)).astype(TOKEN)
        out += [ids[a:b].tobytes() for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    return out


def vocabulary_tokens(path: str) -> Callable[[pa.Array], list[bytes]]:
    """An encoder from a `tokenizers` JSON file whose ids fit 16 bits; ids are moved up by one."""

    def encode(column: pa.Array) -> list[bytes]:
        from tokenizers import Tokenizer

        loaded = encode.__dict__.setdefault("loaded", None) or Tokenizer.from_file(path)
        encode.__dict__["loaded"] = loaded
        loaded.encode_special_tokens = True
        texts = [t or "" for t in column.to_pylist()]
        return [(np.array(e.ids, np.int64) + 1).astype(TOKEN).tobytes() for e in loaded.encode_batch(texts, add_special_tokens=False)]

    return encode


def write_token_files(docs: DataFrame, path: str, encode: Callable[[pa.Array], list[bytes]] = word_tokens) -> DataFrame:
    """Writes `docs(doc_id, text)` as flat token files; returns `(file, place, doc_id)`.

    Documents are dealt over files by a hash of their id and ordered by it within a file; `file`
    is the folder of one flat file and `place` counts its documents from 0. A null text is empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array(encode(batch.column(1)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), tokens], names=["doc_id", "tokens"])

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, size // FILE_BYTES, min(shuffle_tasks(spark), size // BLOCK_BYTES))
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("file")
    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, tokens binary")
    rows = made.select("doc_id", dealt, F.col("tokens").cast("string").alias("value"))
    flat = rows.repartition(files, "file").sortWithinPartitions("file", "doc_id").select("file", "value")
    # The writer puts the separator's two zero bytes after each document's bytes.
    flat.write.partitionBy("file").option("lineSep", "\0\0").text(path)
    order = Window.partitionBy("file").orderBy("doc_id")
    return docs.select("doc_id", dealt).select("file", (F.row_number().over(order) - 1).alias("place"), "doc_id")


def _separators(batches: Iterator[pa.RecordBatch], token: str, eod: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """`(path, block, first, tokens, ends)`: token positions of the separators in each block."""
    width = np.dtype(token).itemsize
    for batch in batches:
        for path, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            store, at = pafs.FileSystem.from_uri(path)
            with store.open_input_file(at) as f:
                tokens = np.frombuffer(f.read_at(size, start), token)
            first = start // width
            ends = np.flatnonzero(tokens == eod) + first
            rows = [[path], [start // block_bytes], [first], [len(tokens)], [ends]]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["path", "block", "first", "tokens", "ends"])


def count_tokens(
    spark: SparkSession, path: str, token: str = TOKEN, eod: int = EOD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """`(path, place, start, n_tokens)`: every document of the flat files below `path`.

    `place` counts a file's documents from 0, `start` is the position of the first token. Tokens
    after the last separator are a document too, an empty rest is not. Two separators in a row
    are an empty document. A file of an odd number of bytes loses the incomplete last id.
    """
    width = np.dtype(token).itemsize
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    whole = (F.col("length") / width).cast("long") * width
    sized = files.select("path", whole.alias("whole")).where("whole > 0")
    step, zero = F.lit(block_bytes // width * width).cast("long"), F.lit(0).cast("long")
    blocks = sized.withColumn("start", F.explode(F.sequence(zero, F.col("whole") - 1, step)))
    blocks = blocks.select("path", "start", F.least(step, F.col("whole") - F.col("start")).alias("size"))
    blocks = blocks.repartition(shuffle_tasks(spark), "path", "start")
    schema = "path string, block long, first long, tokens long, ends array<long>"
    found = saved(blocks.mapInArrow(partial(_separators, token=token, eod=eod, block_bytes=block_bytes // width * width), schema), "separators")
    # Prefix scan: within runs of blocks, then over the runs.
    last = F.try_element_at("ends", F.lit(-1))
    sums = found.select(
        "path", "block", F.floor(F.col("block") / SCAN_RUN).alias("run"), F.size("ends").cast("long").alias("n"),
        last.alias("last"), (F.col("first") + F.col("tokens")).alias("stop"),
    )
    runs = sums.groupBy("path", "run").agg(F.sum("n").alias("run_n"), F.max("last").alias("run_last"), F.max("stop").alias("run_stop"))
    over_runs = Window.partitionBy("path").orderBy("run")
    runs = runs.select(
        "path", "run",
        F.coalesce(F.sum("run_n").over(over_runs.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("run_places"),
        F.max("run_last").over(over_runs.rowsBetween(Window.unboundedPreceding, -1)).alias("run_before"),
        F.max("run_stop").over(Window.partitionBy("path")).alias("file_stop"),
    )
    inside = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = sums.select(
        "path", "block", "run", "stop", "last",
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("places"), F.max("last").over(inside).alias("before"),
    ).join(runs, ["path", "run"])
    known = scanned.select(
        "path", "block", "last", (F.col("stop") == F.col("file_stop")).alias("is_last"), "stop",
        (F.col("run_places") + F.col("places")).alias("places"), F.coalesce("before", "run_before", F.lit(-1)).alias("before"),
    )
    joined = found.select("path", "block", "ends").join(known, ["path", "block"])
    # The end of the file closes what the last separator left open.
    tail = F.col("is_last") & (F.col("stop") - 1 > F.coalesce("last", "before"))
    ends = F.when(tail, F.concat("ends", F.array("stop"))).otherwise(F.col("ends"))
    joined = joined.withColumn("ends", ends)
    each = joined.select("path", "places", "before", "ends", F.posexplode("ends").alias("i", "end"))
    begin = F.when(F.col("i") == 0, F.col("before")).otherwise(F.element_at("ends", F.greatest("i", F.lit(1)))) + 1
    return each.select("path", (F.col("places") + F.col("i")).alias("place"), begin.alias("start"), (F.col("end") - begin).alias("n_tokens"))


def document_tokens(docs: DataFrame, path: str, encode: Callable[[pa.Array], list[bytes]] = word_tokens) -> DataFrame:
    """`(doc_id, n_tokens)` of `docs(doc_id, text)` by way of flat token files below `path`.

    One row per document; repeated rows, and a null doc_id, keep theirs (of rows that share an id
    it is not said which count goes first). Null and empty texts have 0 tokens. Other columns
    are ignored; no rows, no result rows.
    """
    spark = docs.sparkSession
    places = write_token_files(docs, path, encode)
    counted = count_tokens(spark, path)
    file = F.regexp_extract("path", r"/file=(\d+)/", 1).cast("long")
    # Spark splits what a task writes for one folder only on request, so a folder is one file.
    return places.join(counted.select(file.alias("file"), "place", "n_tokens"), ["file", "place"]).select("doc_id", "n_tokens")
