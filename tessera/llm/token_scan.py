"""Token counts of documents in flat token files that have no index, by a separator scan.

A token file is a run of unsigned little-endian ids, 2 or 4 bytes each; an end-of-document id ends each document. It is
read in blocks. Each block is searched for the id at once (vectorised) and reduced to how many tokens and
separators it has, the tokens before the first and after the last separator, and the documents within. A prefix scan over
these figures gives each block the separators before it and the tokens since the last of them, which stitches
documents that cross blocks. The scan has two levels (``GROUP`` blocks, then groups), so no
task orders more than a GROUP-th of the blocks of a file. Only figures are shuffled, never tokens.

Defined results: a file without separators, or with tokens after the last one, has a last document that is not
``complete``; two separators in a row make a document of 0 tokens; an empty file has no documents. Null and empty texts are
documents of 0 tokens; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb
from tessera.llm.storage import place

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges of these ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
BLOCK_TOKENS = 1 << 17
GROUP = 1024

_FIGURES = "file string, block long, n long, m long, head long, tail long, inner array<struct<at: long, n: long>>"


def _ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoder(path: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


def shipped(spark: SparkSession, path: str) -> str:
    """Ships a vocabulary from the driver with the job; its name on the workers."""
    import os

    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped_encoder(name: str):
    from pyspark import SparkFiles

    return _encoder(SparkFiles.get(name))


def id_width(path: str, end: int) -> int:
    """Bytes of an id of this vocabulary; the end-of-document id must be none of its tokens."""
    ids = _ranks(path).values()
    if end < 0 or end in ids:
        raise ValueError(f"{end} is a token of the vocabulary and cannot end a document")
    most = max(end, *ids)
    if most >= 1 << 32:
        raise ValueError("ids of more than 4 bytes")
    return 2 if most < 1 << 16 else 4


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Tokenizes (doc_id, text) into one flat stream for each task, kept as a table of blocks under ``path``.

    Returns (file, block, data) and the list of documents written, (file, ordinal, doc_id). Ids take ``id_width`` bytes. The vocabulary is read
    on the driver and shipped with the job; workers need no file of their own.
    """
    kind = f"<u{id_width(tokenizer, end)}"
    name = shipped(docs.sparkSession, tokenizer)

    def each(batches):
        from pyspark import TaskContext

        file = f"{TaskContext.get().partitionId():08d}"
        code = None
        block = ordinal = 0
        held: list[np.ndarray] = []
        size = 0

        def row(kind, at, data):
            return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([file]), pa.array([at], pa.int64()), pa.array([data], pa.binary())], names=["kind", "file", "at", "data"])

        for b in batches:
            if b.num_rows and code is None:
                code = shipped_encoder(name)
            doc = b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            if b.num_rows:
                yield row("doc", ordinal, doc.astype("<i8").tobytes())
                ordinal += b.num_rows
            for text in b.column(1):
                t = text.as_py()
                ids = np.append(code.encode_to_numpy(t, disallowed_special=()), end).astype(kind) if t else np.array([end], dtype=kind)
                held.append(ids)
                size += len(ids)
                if size >= block_tokens:
                    flat = np.concatenate(held)
                    for x in range(0, size - block_tokens + 1, block_tokens):
                        yield row("tokens", block, flat[x : x + block_tokens].tobytes())
                        block += 1
                    held = [flat[size - size % block_tokens :]]
                    size %= block_tokens
        if size:
            yield row("tokens", block, np.concatenate(held).tobytes())

    rows = tb.small_batches(docs).select("doc_id", "text").mapInArrow(each, "kind string, file string, at long, data binary")
    rows.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    spark = docs.sparkSession
    back = spark.read.schema("file string, at long, data binary, kind string").parquet(path)

    def documents(batches):
        for b in batches:
            for f, at, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = np.frombuffer(data, dtype="<i8")
                lost = ids == np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(ids)), pa.array(at + np.arange(len(ids))), pa.array(ids, mask=lost)], names=["file", "ordinal", "doc_id"])

    tokens = back.where("kind = 'tokens'").select("file", F.col("at").alias("block"), "data")
    listed = back.where("kind = 'doc'").select("file", "at", "data").mapInArrow(documents, "file string, ordinal long, doc_id long")
    return tokens, listed


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data) of the raw flat files under ``path``; each block is read by its range, files of any length."""
    size = width * block_tokens
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size)))).select(F.col("path").alias("file"), "block")

    def each(batches):
        from pyarrow import fs

        for b in batches:
            for file, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                system, name = fs.FileSystem.from_uri(file)
                with system.open_input_file(name) as f:
                    f.seek(block * size)
                    data = f.read(size)
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["file", "block", "data"])

    return ranges.mapInArrow(each, "file string, block long, data binary")


def _figures(end: int, width: int):
    kind = {2: "<u2", 4: "<u4"}[width]
    inner = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def each(batches):
        for b in batches:
            data = b.column(b.schema.get_field_index("data"))
            figures, starts, sizes = [], [], []
            for k in range(b.num_rows):
                ids = np.frombuffer(data[k].as_buffer() if data[k].is_valid else b"", dtype=kind)
                at = np.flatnonzero(ids == end)
                n, m = len(ids), len(at)
                figures.append((n, m, int(at[0]) if m else n, n - 1 - int(at[-1]) if m else n))
                starts.append(at[:-1] + 1)
                sizes.append(np.diff(at) - 1)
            edge = np.concatenate([[0], np.cumsum([len(x) for x in starts])]).astype(np.int32)
            docs = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64()) for x in (starts, sizes)], fields=list(inner.value_type))
            cols = [pa.array(np.array(figures, dtype=np.int64).reshape(-1, 4)[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, pa.ListArray.from_arrays(pa.array(edge), docs)], names=["file", "block", "n", "m", "head", "tail", "inner"])

    return each


def count_tokens(blocks: DataFrame, end: int = END, width: int = 2, group: int = GROUP) -> DataFrame:
    """(file, ordinal, start, n_tokens, complete) of every document of the token files (file, block, data)."""
    rows = blocks.select(F.col("file").cast("string").alias("file"), F.col("block").cast("long").alias("block"), "data").mapInArrow(_figures(end, width), _FIGURES)
    rows = rows.withColumn("part", F.floor(F.col("block") / group))
    inside = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("n0", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("m0", F.coalesce(F.sum("m").over(inside), F.lit(0)))
        .withColumn("sep", F.when(F.col("m") > 0, F.col("n0") + F.col("n") - F.col("tail") - 1))
        .withColumn("sep0", F.max("sep").over(inside))
    )
    along = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("file", "part").agg(F.sum("n").alias("pn"), F.sum("m").alias("pm"), F.max("sep").alias("psep"))
    parts = (
        parts.withColumn("pn0", F.coalesce(F.sum("pn").over(along), F.lit(0)))
        .withColumn("pm0", F.coalesce(F.sum("pm").over(along), F.lit(0)))
        .withColumn("psep0", F.max(F.col("pn0") + F.col("psep")).over(along))
        .select("file", "part", "pn0", "pm0", "psep0", "pn", "pm", "psep")
    )
    rows = rows.join(parts.select("file", "part", "pn0", "pm0", "psep0"), ["file", "part"])
    before = rows.withColumn("origin", F.col("pn0") + F.col("n0")).withColumn("since", F.coalesce(F.col("pn0") + F.col("sep0"), F.col("psep0"), F.lit(-1)) + 1)
    first = F.struct((F.col("since") - F.col("origin")).alias("at"), (F.col("origin") + F.col("head") - F.col("since")).alias("n"))
    docs = before.where("m > 0").select("file", "origin", (F.col("pm0") + F.col("m0")).alias("seen"), F.posexplode(F.concat(F.array(first), "inner")).alias("k", "doc"))
    docs = docs.select("file", (F.col("seen") + F.col("k")).alias("ordinal"), (F.col("origin") + F.col("doc.at")).alias("start"), F.col("doc.n").alias("n_tokens"), F.lit(True).alias("complete"))
    ends = parts.groupBy("file").agg(F.sum("pn").alias("n"), F.sum("pm").alias("ordinal"), F.coalesce(F.max(F.col("pn0") + F.col("psep")), F.lit(-1)).alias("last"))
    ends = ends.select("file", "ordinal", (F.col("last") + 1).alias("start"), (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("complete")).where("n_tokens > 0")
    return docs.unionByName(ends)


def document_token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, file, ordinal, n_tokens): documents are written to flat token files in the shared folder and counted from these."""
    tokens, listed = write_token_files(docs, place(docs.sparkSession, "tokens"), tokenizer, end, block_tokens)
    counts = count_tokens(tokens, end, id_width(tokenizer, end))
    return listed.join(counts.select("file", "ordinal", "n_tokens"), ["file", "ordinal"], "left").select("doc_id", "file", "ordinal", "n_tokens")
