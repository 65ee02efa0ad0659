"""Token files: flat unsigned integers beside 64-bit document offsets, read by memory map.

A folder holds for each part ``part-N.bin`` (ids of its documents, one after the other, in the
narrowest of two or four bytes that holds the vocabulary), ``part-N.idx`` (64-bit starts of
the documents in that file, and its end) and ``part-N.ids`` (64-bit document ids, and
whether they are null), and one ``manifest.json`` with each part's document and token
counts and their prefix sums.  Parts are ranges of doc_id, ascending within and across parts.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import storage
from seqloom.llm.common import sliced
from seqloom.llm.tokens import encoder

NULL_ID = -(1 << 63)
#: Pieces of text that a worker remembers with their ids, at about 200 bytes each.
REMEMBER = 1_000_000


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> dict:
    """Encode every text (null: empty), append ``end_id`` to each and write the files; gives the manifest.

    Null ids come first and stay null; rows with equal ids stand in the order of their
    texts' hashes.  An empty table makes a manifest without parts.
    """
    storage.make_dir(path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(parts or max(1, docs.rdd.getNumPartitions()), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, REMEMBER), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        name = f"{path}/part-{part:06d}"
        ids, starts, out, at = [], [0], None, 0
        for batch in sliced(batches, 1, 4 << 20):
            out = out or storage.Writer(f"{name}.bin")
            for data in enc.encode(batch.column(1)):
                out.write(data + end)
                at += len(data) // enc.dtype.itemsize + 1
                starts.append(at)
            ids.append(batch.column(0).fill_null(NULL_ID).to_numpy())
        if out is not None:
            out.commit()
            storage.put(f"{name}.idx", np.array(starts, dtype="<i8").tobytes())
            storage.put(f"{name}.ids", np.concatenate(ids).astype("<i8").tobytes())
            row = [[part], [len(starts) - 1], [at], [enc.dtype.itemsize]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in row], ["part", "docs", "tokens", "width"])

    done = sorted(rows.mapInArrow(kernel, "part long, docs long, tokens long, width long").collect())
    first_doc = first_token = 0
    manifest: dict = {"tokenizer": tokenizer.rsplit("/", 1)[-1], "end_id": end_id, "parts": []}
    for r in done:
        manifest["parts"].append(r.asDict() | {"first_doc": first_doc, "first_token": first_token})
        first_doc, first_token = first_doc + r.docs, first_token + r.tokens
    storage.put(f"{path}/manifest.json", json.dumps(manifest).encode())
    return manifest


def documents_of(path: str, part: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, global start, ids) of each document of one part, in order."""
    name = f"{path}/part-{part['part']:06d}"
    data = storage.mapped(f"{name}.bin", f"<u{part['width']}")
    starts, ids = storage.mapped(f"{name}.idx", "<i8"), storage.mapped(f"{name}.ids", "<i8")
    for doc, lo, hi in zip(ids.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        yield None if doc == NULL_ID else doc, part["first_token"] + lo, data[lo:hi]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a folder, from its files.

    A null or empty text has its end id alone.  Rows with a null or a repeated id come back as often as they were
    written; a folder of no documents gives no rows.
    """
    parts = json.loads(storage.get(f"{path}/manifest.json"))["parts"]
    rows = [(p["part"], p["width"], p["first_token"]) for p in parts]
    table = spark.createDataFrame(rows, "part long, width long, first_token long")
    if rows:
        table = table.repartition(len(rows))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                held: list[tuple] = []
                for doc, start, ids in documents_of(path, part):
                    held.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(held) == 8192:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    return table.mapInArrow(kernel, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def query(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    write(docs, path, tokenizer, 0)
    return read(docs.sparkSession, path)
