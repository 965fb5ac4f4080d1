"""SentencePiece ids and decoded texts through a table of distinct chunks.

A sentencepiece model writes a space as the marker U+2581.  If no piece has
a marker behind another character, no piece reaches from one *chunk* (a run
of markers and the characters up to the next marker) into the next one, so
the ids of a text are the ids of its chunks, one after the other, and each
distinct chunk has to be segmented only once:

1. the most frequent chunks (``head_size`` at most) are segmented in tasks and
   broadcast.  Which ones they are is read off every eighth row of each
   partition; that decides only which chunks need no shuffle;
2. documents are packed in batches of about ``batch_bytes``: a *body*, for each
   chunk in order its number in the head or its place in the list of the
   batch's other distinct chunks, and that list, dealt to buckets by hash;
3. a chunk's bucket is the same in every batch and lies in one task, so each
   distinct chunk is segmented once there, and the ids go back to the
   batches that asked, in the order of the question;
4. body and answers of a batch meet in one task, the ids are put together by
   position and decoded by the library.

What is shuffled are packed blocks, some two bytes a chunk; neither texts nor
rows of single chunks are.  Tasks hold a batch at a time, and of a bucket's
table at most ``KEEP`` chunks (beyond that it begins anew).

The first chunk of a text begins with the marker that the model puts before
every text, so a chunk is encoded by giving the library the chunk without
its first marker.

Cases: a null or empty text has no ids and decodes to the empty text; a
text of spaces has the ids of its markers; U+2581 itself counts as a space,
as it does in the library; repeated rows (same id, same text) give repeated
rows, equal or null ids with different texts stay apart; an empty table
gives an empty result; other columns are ignored.  A model whose pieces
cross markers, or that changes texts before cutting them, is refused.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col, frequent, stored

MARK = "▁"
#: Distinct chunks that a task holds: counted before it hands them on, segmented before it forgets them.
KEEP = 300_000
#: Ids of a result batch, about.
BATCH_IDS = 1_000_000
_CHUNK = re.compile(" ( *[^ ]*)")
_PROBE = " a  béﬁ①\t\x00\U0001f600 "


def chunks_of(text: str | None) -> list[str]:
    """The chunks of a text, each without its first marker and with spaces for the others."""
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


class Segmenter:
    """The library's ids of whole texts and of chunks."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        ids = self.library.encode(_PROBE)
        if self.library.decode(ids) != _PROBE or not self.library.id_to_piece(ids[0]).startswith(MARK):
            raise ValueError("this model changes texts before it cuts them, or puts no marker before them")
        self.lone = self.library.encode("a ")[len(self.library.encode("a")):]

    def ids(self, chunks: list[str]) -> list[list[int]]:
        return [i if c else self.lone for c, i in zip(chunks, self.library.encode(chunks, num_threads=1))]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def emptied() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["chunk", "n"])
        seen.clear()
        return out

    for b in batches:
        for text in b.column(0):
            seen.update(chunks_of(text.as_py()))
            if len(seen) > KEEP:
                yield emptied()
    yield emptied()


def _segmented(model):
    """(chunk, n, ids) of distinct chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(model.value)
        for b in batches:
            ids = [np.array(i, "<i4").tobytes() for i in segmenter.ids(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], names=["chunk", "n", "data"])

    return run


def _zip(values: np.ndarray) -> bytes:
    """Small non-negative numbers, compressed byte plane by byte plane behind their count."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unzip(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _batches(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[list[str]], pa.DataType]]:
    """(ids, chunks of each text, type of the ids) of about ``limit`` bytes of text at a time, or of one text."""
    ids, texts, size, kind = [], [], 0, pa.null()
    for b in batches:
        kind = b.column(0).type
        for i, text in zip(b.column(0), b.column(1)):
            text = text.as_py()
            ids.append(i.as_py())
            texts.append(chunks_of(text))
            size += len(text or "") + 16
            if size >= limit:
                yield ids, texts, kind
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, kind


_BODY, _ASK, _ANSWER = 0, 1, 2


def _pack(head, buckets: int, limit: int):
    """Blocks (kind, place, batch, bucket, ids, data): a body and its questions, one a bucket, of every batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        task = TaskContext.get().partitionId()
        for number, (ids, texts, kind) in enumerate(_batches(batches, limit)):
            batch = (task << 32) + number
            others: dict[str, int] = {}
            codes, open_ = [], []
            for chunks in texts:
                for c in chunks:
                    at = known.get(c)
                    if at is None:
                        codes.append(0)
                        open_.append(others.setdefault(c, len(others)))
                    else:
                        codes.append(at + 1)
            asked: list[list[str]] = [[] for _ in range(buckets)]
            places = np.zeros(len(others), np.int64)  # in the answers, bucket after bucket
            where = [crc32(c.encode()) % buckets for c in others]
            for c, k in zip(others, where):
                asked[k].append(c)
            starts = np.concatenate([[0], np.cumsum([len(q) for q in asked])])
            seen = starts[:-1].copy()
            for j, k in enumerate(where):
                places[j] = seen[k]
                seen[k] += 1
            parts = [_zip(np.array([len(c) for c in texts], np.int64)), _zip(np.array(codes, np.int64)), _zip(places[np.array(open_, np.int64)])]
            body = b"".join(len(p).to_bytes(8, "little") + p for p in parts)
            rows = [(_BODY, batch % buckets, batch, -1, ids, body)]
            rows += [(_ASK, k, batch, k, None, _question(q)) for k, q in enumerate(asked) if q]
            yield _blocks(rows, kind)

    return run


def _question(chunks: list[str]) -> bytes:
    raw = json.dumps(chunks, ensure_ascii=False).encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _blocks(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(id_type), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["kind", "place", "batch", "bucket", "ids", "data"])


def _answered(model, buckets: int):
    """Questions turned into answers, each distinct chunk of a bucket segmented once; bodies pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(model.value)
        table: dict[str, list[int]] = {}
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1)
                if row.column(0)[0].as_py() == _BODY:
                    yield row
                    continue
                data = row.column(5)[0].as_py()
                asked = json.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))
                if len(table) > KEEP:
                    table.clear()
                new = [c for c in asked if c not in table]
                table.update(zip(new, segmenter.ids(new)))
                ids = [table[c] for c in asked]
                sizes = _zip(np.array([len(i) for i in ids], np.int64))
                flat = _zip(np.array([x for i in ids for x in i], np.int64))
                batch, bucket = row.column(2)[0].as_py(), row.column(3)[0].as_py()
                yield _blocks([(_ANSWER, batch % buckets, batch, bucket, None, len(sizes).to_bytes(8, "little") + sizes + flat)],
                              b.column(4).type.value_type)

    return run


def _flat_ids(numbers: np.ndarray, places: np.ndarray, head: tuple, tail: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(ids, their number for each chunk); ``numbers`` has 0 for an open chunk, whose place in ``tail`` is the next of ``places``.

    ``head`` and ``tail`` are (bounds, flat ids) of chunks by number.
    """
    open_ = numbers == 0
    size = np.zeros(len(numbers), np.int64)
    start = np.zeros(len(numbers), np.int64)
    for mask, at, (bounds, _) in ((~open_, numbers[~open_] - 1, head), (open_, places, tail)):
        start[mask] = bounds[at]
        size[mask] = bounds[at + 1] - bounds[at]
    ends = np.cumsum(size)
    source = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    gap = np.repeat(open_, size)
    out = np.empty(len(source), np.int32)
    out[~gap] = head[1][source[~gap]]
    out[gap] = tail[1][source[gap]]
    return out, size


def _assembled(model, head_ids):
    """(id, ids, decoded) of documents; input sorted by batch and bucket, the body (bucket -1) first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Segmenter(model.value).library

        def results(body: tuple, answers: list[bytes], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            ids, data = body
            parts, at = [], 0
            for _ in range(3):
                n = int.from_bytes(data[at : at + 8], "little")
                parts.append(_unzip(data[at + 8 : at + 8 + n]))
                at += 8 + n
            lengths, numbers, places = parts
            sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a in answers:
                n = int.from_bytes(a[:8], "little")
                sizes.append(_unzip(a[8 : 8 + n]))
                flat.append(_unzip(a[8 + n :]))
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            if len(places) and int(places.max()) >= len(bounds) - 1:
                raise RuntimeError("answers to a batch of documents are missing")
            every, per_chunk = _flat_ids(numbers, places, head_ids.value, (bounds, np.concatenate(flat)))
            ends = np.concatenate([[0], np.cumsum(per_chunk)])[np.concatenate([[0], np.cumsum(lengths)])]
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_IDS, "right")) - 1)
                last = min(last, len(ids))
                mine = every[ends[first] : ends[last]]
                cuts = ends[first : last + 1] - ends[first]
                decoded = [library.decode(mine[x:y].tolist()) for x, y in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], kind), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(mine)),
                                                  pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])
                first = last

        batch, body, answers, kind = None, None, [], pa.null()
        for b in batches:
            kind = b.column(4).type.value_type
            for at in range(b.num_rows):
                now, data = b.column(2)[at].as_py(), b.column(5)[at].as_py()
                if now != batch:
                    if body is not None:
                        yield from results(body, answers, kind)
                    batch, body, answers = now, None, []
                if b.column(0)[at].as_py() == _BODY:
                    body = (b.column(4)[at].as_py(), data)
                else:
                    answers.append(data)
        if body is not None:
            yield from results(body, answers, kind)

    return run


def pieces_and_texts(docs: DataFrame, model: bytes, *, id_column: str = "doc_id", text_column: str = "text", head_size: int = 750_000,
                     batch_bytes: int = 8 << 20) -> DataFrame:
    """Return per row of ``docs``: id, ids (array of int), decoded (text), for the serialized sentencepiece model ``model``."""
    spark = docs.sparkSession
    docs = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(model)
    sampled = docs.filter(F.monotonically_increasing_id() % 8 == 0).select("text")
    counts = stored(sampled.mapInArrow(_counted, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n")), "chunks")
    top = (frequent(counts, "n", head_size).select("chunk", "n").mapInArrow(_segmented(shared), "chunk string, n long, data binary")
           .toArrow().sort_by([("n", "descending"), ("chunk", "ascending")]))  # frequent chunks have small numbers
    data = top["data"].to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int64)
    head = spark.sparkContext.broadcast(dict(zip(top["chunk"].to_pylist(), range(len(data)))))
    head_ids = spark.sparkContext.broadcast((bounds, np.frombuffer(b"".join(data), "<i4") if data else np.zeros(0, np.int32)))

    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("place", T.IntegerType()), T.StructField("batch", T.LongType()),
                           T.StructField("bucket", T.IntegerType()), T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)), T.StructField("data", T.BinaryType())])
    blocks = docs.mapInArrow(_pack(head, buckets, batch_bytes), schema).repartition("place")
    answers = blocks.mapInArrow(_answered(shared, buckets), schema)
    out = answers.repartition("batch").sortWithinPartitions("batch", "bucket").mapInArrow(
        _assembled(shared, head_ids), T.StructType([docs.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))
    return out.select(F.col("id").alias(id_column), "ids", "decoded")


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Id, n_tokens, and SHA-256 (lowercase hex) of the ids as decimal text joined by commas and of the decoded text."""
    return encoded.select(col(id_column), F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
