"""Benchmark decontamination with an FM-index per training shard.

The test phrases are all windows of ``window`` consecutive words of the
benchmark items (an item of fewer words, but not none, is one window).
Every task cuts its documents into shards of a bounded number of bytes and
builds an FM-index over the words of each shard; backward search through
wavelet-tree ranks finds the windows that occur, sampled suffix positions
say where, and overlapping occurrences merge to removal spans.

A shard is indexed in the benchmark's vocabulary: a word that no phrase
contains separates runs, and a run shorter than the shortest phrase cannot
hold one, so neither takes part in the suffix order.  This loses nothing
and keeps the index small where documents and benchmark differ.

The benchmark is a query set: it goes to the tasks in blocks of at most
``block_bytes`` of text (one block unless it is larger).  Only one block is
held at a time, on the driver and in the tasks: each makes a pass of its
own, whose result is written before the next block is read, and the passes'
hits are merged per document.  No shuffle of texts takes place with one
block.

Cases: null or wordless texts have no words and no hits; null or wordless
items have no window.  Items with equal texts all count.  A null item_id
takes part in hits but not in the item list.  Repeated rows give repeated
rows; extra columns are kept by ``remove_spans`` and ignored by ``contamination``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.fm_index import FMIndex
from trustfold.llm.tables import col, fresh, stored
from trustfold.llm.textarrays import ALNUM, Chunk, Words, chunk_of, slices, words_of

#: Text indexed at once; words, index and hits take some 30 bytes a byte of it in every Python worker.
SHARD_BYTES = 1 << 20


@dataclass
class Phrases:
    """Distinct windows as rows of symbols (0 behind the end), and the items that hold each."""

    words: np.ndarray  # sorted distinct word hashes; symbol = position + 1
    rows: np.ndarray
    lengths: np.ndarray
    item_bounds: np.ndarray
    items: list[str]  # item ids as strings, by item number
    item_of: np.ndarray

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases_of(items: list[tuple[str | None, str | None]], window: int) -> Phrases:
    """The windows of a block of (item id, text)."""
    w = words_of(chunk_of(pa.array([t for _, t in items], pa.string())), ALNUM)
    words = np.unique(w.hash)
    symbols = np.searchsorted(words, w.hash) + 1
    index: dict[tuple, int] = {}
    holders: list[dict[int, None]] = []
    for i in range(len(items)):
        s = symbols[w.bounds[i] : w.bounds[i + 1]].tolist()
        for j in range(max(1, len(s) - window + 1) if s else 0):
            at = index.setdefault(tuple(s[j : j + window]), len(index))
            if at == len(holders):
                holders.append({})
            holders[at][i] = None
    rows = np.zeros((len(index), window), np.int32)
    for key, at in index.items():
        rows[at, : len(key)] = key
    return Phrases(words, rows, (rows > 0).sum(1), np.concatenate([[0], np.cumsum([len(h) for h in holders])]).astype(np.int64),
                   [i for i, _ in items], np.array([i for h in holders for i in h], np.int64))


def occurrences(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of the phrases in a shard: phrase numbers and the words they begin at."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.words) or not len(words.hash):
        return none
    at = np.searchsorted(phrases.words, words.hash)
    known = phrases.words[np.minimum(at, len(phrases.words) - 1)] == words.hash
    # runs of known words of one text, without those too short for any phrase
    begin = known & ~np.concatenate([[False], known[:-1] & (words.text[1:] == words.text[:-1])])
    run = np.cumsum(begin) - 1
    place = np.flatnonzero(known)
    long_enough = np.bincount(run[place], minlength=int(begin.sum())) >= phrases.shortest if len(place) else np.zeros(0, bool)
    place = place[long_enough[run[place]]] if len(place) else place
    if not len(place):
        return none
    heads = np.flatnonzero(begin[place])  # a separator behind each run
    text = np.insert(at[place] + 1, np.append(heads[1:], len(place)), 0)
    back = np.insert(place, np.append(heads[1:], len(place)), -1)
    index = FMIndex(text, len(phrases.words) + 1)
    low, high = index.search(phrases.rows, phrases.lengths)
    found = np.flatnonzero(high > low)
    count = high[found] - low[found]
    which = np.repeat(found, count)
    rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[found], count)
    return which, back[index.locate(rows)]


@dataclass
class Hits:
    """Per text of a shard: words, hit words, the numbers of the items found; and the hit words themselves."""

    words: Words
    hit: np.ndarray
    items: list[list[int]]

    def spans(self, i: int) -> list[tuple[int, int]]:
        """Merged removal spans of text i, as words [from, to) counted within the text."""
        mask = self.hit[self.words.bounds[i] : self.words.bounds[i + 1]].astype(np.int8)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
        return [(int(a), int(b)) for a, b in edge.reshape(-1, 2)]


def hits_of(chunk: Chunk, phrases: Phrases) -> Hits:
    words = words_of(chunk, ALNUM)
    which, start = occurrences(words, phrases)
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + phrases.lengths[which], -1)
    items: list[list[int]] = [[] for _ in range(len(chunk))]
    if len(which):
        pairs = np.unique(np.stack([words.text[start], which]), axis=1)
        n = phrases.item_bounds[pairs[1] + 1] - phrases.item_bounds[pairs[1]]
        item = phrases.item_of[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(phrases.item_bounds[pairs[1]], n)]
        for text, i in np.unique(np.stack([np.repeat(pairs[0], n), item]), axis=1).T.tolist():
            items[text].append(i)
    return Hits(words, np.cumsum(cover[:-1]) > 0, items)


#: Text of the items that are held as phrases at a time (a distinct window costs some 300 bytes while they are made).
BLOCK_BYTES = 4 << 20


@dataclass
class Blocks:
    """The items of a benchmark in parts of about ``block_bytes`` of text (or one item)."""

    items: DataFrame
    parts: int
    window: int

    @classmethod
    def of(cls, items: DataFrame, id_column: str, text_column: str, window: int, block_bytes: int) -> Blocks:
        named = items.select(col(id_column).cast("string").alias("item"), col(text_column).cast("string").alias("text"))
        total = named.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
        return cls(named, 1 + int(total) // block_bytes, window)

    def phrases(self, part: int):
        """The broadcast phrases of one part."""
        mine = self.items if self.parts == 1 else self.items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(self.parts)) == part)
        rows = [(r["item"], r["text"]) for r in mine.toLocalIterator()]
        return self.items.sparkSession.sparkContext.broadcast(phrases_of(rows, self.window))


def _digest(ids: Iterable[str]) -> tuple[int, str]:
    ids = sorted(ids)
    return len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()


def _hit_rows(phrases):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = phrases.value
        for b in slices(batches, "text", SHARD_BYTES):
            h = hits_of(chunk_of(b.column(1)), p)
            spans = [h.spans(i) if h.items[i] else [] for i in range(b.num_rows)]
            ids = [sorted({p.items[x] for x in own if p.items[x] is not None}) for own in h.items]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(h.words.counts, pa.int64()),
                 pa.array([[{"from": x, "to": y} for x, y in s] for s in spans], pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                 pa.array(ids, pa.list_(pa.string()))], names=["id", "n_words", "spans", "items"])

    return run


_SPANS = T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))


def _merged(spans: str) -> str:
    """SQL that merges spans: sorted, then folded into disjoint ones."""
    return (f"aggregate(array_sort({spans}), cast(array() as array<struct<from:bigint,to:bigint>>), (done, s) -> "
            "if(size(done) > 0 and element_at(done, -1).to >= s.from, "
            "concat(slice(done, 1, size(done) - 1), array(named_struct('from', element_at(done, -1).from, 'to', greatest(element_at(done, -1).to, s.to)))), "
            "concat(done, array(s))))")


def contamination(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", window: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Return per row of ``docs``: id, n_words, spans (merged, in words), items (sorted distinct item ids)."""
    docs = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    schema = T.StructType([docs.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    blocks = Blocks.of(items, item_column, item_text, window, block_bytes)
    if blocks.parts == 1:
        return docs.mapInArrow(_hit_rows(blocks.phrases(0)), schema)
    keyed = docs.withColumn("id", F.struct("id", F.sha2(F.coalesce("text", F.lit("\0")), 256).alias("sha")))
    wide = T.StructType([keyed.schema["id"], *schema.fields[1:]])
    every = None
    for i in range(blocks.parts):
        phrases = blocks.phrases(i)
        part = stored(keyed.mapInArrow(_hit_rows(phrases), wide).withColumn("block", F.lit(i)), "hits")
        phrases.destroy()
        every = part if every is None else every.union(part)
    rows = (every.groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                    F.sum((F.col("block") == 0).cast("int")).alias("copies")))
    return (rows.withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
            .select("id.id", "n_words", F.expr(_merged("spans")).alias("spans"), "items"))


def contamination_digest(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``contamination`` as n_words, n_hit, n_items, items_sha256, contaminated per row."""
    id_column = options.get("id_column", "doc_id")
    return (contamination(docs, items, **options)
            .select(F.col("id").alias(id_column), "n_words",
                    F.expr("aggregate(spans, 0L, (a, s) -> a + s.to - s.from)").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def _cut(texts: list[str], phrases: Phrases) -> list[str]:
    """The texts without any occurrence: cut, and cut again where joining the rest makes a new one."""
    todo = list(range(len(texts)))
    texts = list(texts)
    while todo:
        raw = [texts[i].encode() for i in todo]
        h = hits_of(chunk_of(pa.array(raw, pa.binary())), phrases)
        again = []
        for k, i in enumerate(todo):
            spans = h.spans(k)
            if not spans:
                continue
            first, base, kept, at = int(h.words.bounds[k]), sum(map(len, raw[:k])), [], 0
            for a, b in spans:
                kept.append(raw[k][at : int(h.words.start[first + a]) - base])
                at = int(h.words.end[first + b - 1]) - base
            kept.append(raw[k][at:])
            texts[i] = b"".join(kept).decode()
            again.append(i)
        todo = again
    return texts


def remove_spans(docs: DataFrame, items: DataFrame, *, text_column: str = "text", item_column: str = "item_id",
                 item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with every occurrence of a window cut out of the text; all columns and all rows stay.

    Texts without an occurrence, null and empty ones included, are unchanged.
    With several blocks of items one block cuts after the other, each in a
    pass of its own over what the one before it wrote, and all of them again
    until a whole round cuts nothing: a cut can join a window of another block.
    """
    blocks = Blocks.of(items, item_column, item_text, window, block_bytes)
    at = docs.columns.index(text_column)
    names = docs.columns
    rows = docs.toDF(*(f"_{i}" for i in range(len(names))))  # names of any kind: Arrow functions resolve them as text
    if blocks.parts == 1:
        return rows.mapInArrow(_cut_rows(blocks.phrases(0), at, False), rows.schema).toDF(*names)
    flagged = T.StructType([*rows.schema.fields, T.StructField("cut", T.BooleanType())])
    changed = True
    while changed:
        changed = False
        for i in range(blocks.parts):
            phrases = blocks.phrases(i)
            out = stored(rows.mapInArrow(_cut_rows(phrases, at, True), flagged), "cut_texts")
            phrases.destroy()
            changed = changed or not out.filter("cut").isEmpty()
            rows = out.drop("cut")
    return rows.toDF(*names)


def _cut_rows(phrases, at: int, flag: bool):
    """Rows with the texts of column ``at`` cut (``flag``: and whether they were)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = phrases.value
        for b in slices(batches, f"_{at}", SHARD_BYTES):
            column = b.column(at)
            hit = [i for i, own in enumerate(hits_of(chunk_of(column), p).items) if own]
            if hit:
                texts = column.to_pylist()
                for i, text in zip(hit, _cut([texts[i] for i in hit], p)):
                    texts[i] = text
                column = pa.array(texts, column.type)
            out = b.set_column(at, b.schema.field(at), column)
            yield out.append_column("cut", pa.array(np.isin(np.arange(b.num_rows), hit))) if flag else out

    return run


def decontaminated(docs: DataFrame, items: DataFrame, *, text_column: str = "text", length_column: str | None = "n_chars", **options) -> DataFrame:
    """``remove_spans``, with the length column brought up to date and documents that nothing remains of dropped."""
    before = fresh(docs, "chars_before")
    out = remove_spans(docs.withColumn(before, F.char_length(col(text_column))), items, text_column=text_column, **options)
    cut = F.col(before).isNotNull() & (F.char_length(col(text_column)) < F.col(before))
    if length_column:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.when(cut, F.char_length(col(text_column)).cast(kind)).otherwise(col(length_column)))
    return out.filter(~cut | (F.trim(col(text_column)) != "")).select(*(col(c) for c in docs.columns))
