"""Token counts of flat token files that have no index.

A token file is a run of little-endian token ids in which an end-of-document
id closes each document. Files come as rows ``(file, block, data)``: blocks of
any size cut anywhere, numbered in order. Each block is searched on its own for
the separator (one vectorised comparison); documents that cross blocks are
stitched by a prefix scan over the block summaries, in two levels so that one
very long file is no single window.

Cases: an empty block changes nothing; a document without tokens counts 0;
tokens after the last separator of a file are a document with ``closed`` false;
an empty table gives an empty result. Null data counts as empty.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from cumulus.llm.common import row_slices, scratch_table
from cumulus.llm.pieces import MODEL_PATH, encoder_for

EOD = 2  # </s> of the piece model
BLOCK_TOKENS = 1 << 16
TASK_BYTES = 128 << 20  # of token files that one task reads, block by block
SUPER = 1024  # blocks of the lower scan level


def _opened(path: str):
    """The file behind a path as Spark lists it, open for reads at any offset."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def read_token_files(spark: SparkSession, path: str, block_bytes: int = 1 << 20) -> DataFrame:
    """``file, block, data`` of raw token files of any length under ``path``, one row a block of ``block_bytes``.

    Spark lists the files and deals the blocks out; a task reads only the byte
    ranges of its blocks, one at a time, through the store's file system as
    Arrow reaches it. ``block_bytes`` must be a multiple of a token's size. A
    file without bytes has no block; one cut short since it was listed fails.
    """

    def read(batches):
        for batch in batches:
            rows = sorted(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            for name, of_file in groupby(rows, key=lambda r: r[0]):
                with _opened(name) as file:
                    for _, block, size in of_file:
                        file.seek(block * block_bytes)
                        data = file.read(size)
                        if len(data) != size:
                            raise OSError(f"{name} ends before byte {block * block_bytes + size}")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name], pa.string()), pa.array([block], pa.int64()), pa.array([data], pa.binary())], ["file", "block", "data"]
                        )

    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(-(-total // TASK_BYTES), spark.sparkContext.defaultParallelism)
    blocks = files.select(
        F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))).alias("block")
    )
    size = F.least(F.lit(block_bytes).cast("long"), F.col("length") - F.col("block") * block_bytes)
    dealt = blocks.select("file", "block", size.alias("size")).repartition(tasks, "file", "block")
    return dealt.mapInArrow(read, "file string, block long, data binary")


def write_token_blocks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, dtype: str = "uint16"
) -> DataFrame:
    """Tokenise documents into flat files, one for each task: ``file, block, data, doc_ids``.

    ``doc_ids`` names the documents that end in the block, in order; the
    scan does not read it. A model with ids beyond ``dtype`` fails.
    """
    most, block_bytes = int(np.iinfo(dtype).max), BLOCK_TOKENS * np.dtype(dtype).itemsize

    def run(batches):
        encoder = encoder_for(model_path, "bpe")
        file, block = TaskContext.get().partitionId(), 0
        held, size, ids = [], 0, []
        end = np.array([EOD], dtype).tobytes()

        def row(data: bytes, closed: list):
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary()), pa.array([closed], pa.list_(pa.int64()))],
                ["file", "block", "data", "doc_ids"],
            )

        for batch in batches:
            for part in row_slices(batch, 1):
                encoded = encoder.encode_all([t or "" for t in part.column(1).to_pylist()])
                for doc, found in zip(part.column(0).to_pylist(), encoded, strict=True):
                    tokens = np.frombuffer(found, np.int32)
                    if tokens.max(initial=0) > most:
                        raise ValueError(f"id {tokens.max()} does not fit {dtype}")
                    tokens = tokens.astype(dtype).tobytes() + end
                    while size + len(tokens) > block_bytes:
                        take = block_bytes - size
                        held.append(tokens[:take])
                        yield row(b"".join(held), ids)
                        tokens, held, size, ids, block = tokens[take:], [], 0, [], block + 1
                    held.append(tokens)
                    size += len(tokens)
                    ids.append(doc)
        if held:
            yield row(b"".join(held), ids)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "file long, block long, data binary, doc_ids array<long>")


def scan_blocks(blocks: DataFrame, eod: int = EOD, dtype: str = "uint16") -> DataFrame:
    """One summary row a block: tokens, separators, tokens before the first and after the last, lengths between."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                rows = []
                for data in part.column(2).to_pylist():
                    tokens = np.frombuffer(data or b"", dtype)
                    at = np.flatnonzero(tokens == eod)
                    if len(at):
                        rows.append((len(at), int(at[0]), len(tokens) - 1 - int(at[-1]), np.diff(at) - 1))
                    else:
                        rows.append((0, len(tokens), len(tokens), at))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array([r[j] for r in rows], pa.int64()) for j in range(3)), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                    ["file", "block", "n_eod", "head", "tail", "inner"],
                )

    kind = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInArrow(
        run, f"file {kind}, block long, n_eod long, head long, tail long, inner array<long>"
    )


def _carry(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``carry_in`` (tokens since the last separator) and ``before`` (documents closed) of the earlier rows of ``keys``."""
    w = Window.partitionBy(*keys).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_run", F.sum(F.when(F.col("n_eod") > 0, 1).otherwise(0)).over(upto))
    out = Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_out", F.sum("tail").over(out))
    return rows.withColumns(
        {
            "carry_in": F.coalesce(F.lag("_out").over(w), F.lit(0)),
            "before": F.coalesce(F.sum("n_eod").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    ).drop("_run", "_out")


def stitch(summaries: DataFrame) -> DataFrame:
    """``file, block, first_doc, lengths, open``: token counts of the documents that end in each block.

    ``open`` holds the tokens of a last document without separator (null elsewhere).
    """
    rows = _carry(summaries.withColumn("sup", F.floor(F.col("block") / SUPER)), ["file", "sup"], "block")
    # What a run of blocks hands on: its closed documents and the tokens after the last.
    since = F.struct("block", F.when(F.col("n_eod") > 0, F.col("tail")).otherwise(F.col("carry_in") + F.col("tail")).alias("rest"))
    sups = rows.groupBy("file", "sup").agg(F.sum("n_eod").alias("n_eod"), F.max(since)["rest"].alias("tail"), F.max("block").alias("last"))
    ends = sups.groupBy("file").agg(F.max("last").alias("final"))
    high = _carry(sups, ["file"], "sup").select("file", "sup", F.col("carry_in").alias("high_in"), F.col("before").alias("high_before"))
    rows = rows.join(high, ["file", "sup"]).join(ends, "file")
    carry = F.when(F.col("before") == 0, F.col("high_in") + F.col("carry_in")).otherwise(F.col("carry_in"))
    lengths = F.when(F.col("n_eod") > 0, F.concat(F.array(carry + F.col("head")), "inner")).otherwise(F.array().cast("array<long>"))
    rest = F.when(F.col("n_eod") > 0, F.col("tail")).otherwise(carry + F.col("tail"))
    return rows.select(
        "file",
        "block",
        (F.col("high_before") + F.col("before")).alias("first_doc"),
        lengths.alias("lengths"),
        F.when((F.col("block") == F.col("final")) & (rest > 0), rest).alias("open"),
    )


def token_counts(blocks: DataFrame, eod: int = EOD, dtype: str = "uint16") -> DataFrame:
    """``file, doc, n_tokens, closed`` of every document of flat token files."""
    rows = stitch(scan_blocks(blocks, eod, dtype))
    closed = rows.select("file", "first_doc", F.posexplode("lengths").alias("i", "n_tokens")).select(
        "file", (F.col("first_doc") + F.col("i")).alias("doc"), "n_tokens", F.lit(True).alias("closed")
    )
    opened = rows.filter("open is not null").select(
        "file", (F.col("first_doc") + F.size("lengths")).alias("doc"), F.col("open").alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.union(opened)


def document_token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, dtype: str = "uint16"
) -> DataFrame:
    """``doc_id, n_tokens``: documents written to flat files, then counted by scanning those files."""
    blocks = scratch_table(write_token_blocks(docs, id_col, text_col, model_path, dtype), "tokens")
    counted = stitch(scan_blocks(blocks, dtype=dtype))
    names = blocks.select("file", "block", "doc_ids")
    return counted.join(names, ["file", "block"]).select(F.explode(F.arrays_zip("doc_ids", "lengths")).alias("d")).select(
        F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("n_tokens")
    )
