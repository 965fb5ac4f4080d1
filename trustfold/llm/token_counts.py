"""Token counts per document: pieces once per distinct pre-token, joined to pre-token frequencies.

A byte-level BPE tokenizer cuts a text at its special strings, then into
pre-tokens, and each pre-token into pieces that depend on nothing else.  So

1. the most frequent pre-tokens (``head_size`` at most) are counted in pieces
   and broadcast.  Which ones they are is read off every eighth row of each
   partition; that decides only which pre-tokens need no shuffle;
2. one pass makes the pre-token frequencies of every document.  Those in the
   head are looked up on the spot, which leaves one partial sum a
   document; the others, the long tail, become rows of their own;
3. the tail rows are shuffled and sorted by pre-token, so each distinct one
   is one run of rows: the tokenizer's own model says once how many pieces
   it has, and all rows of the run take that;
4. sums of frequency times pieces per document.  No token ids are made.

Cutting: a boundary always lies before a space that follows a character
other than white space, so a text is first split there, and the tokenizer's
own pre-tokenizer cuts each distinct such unit once per task.

Special strings inside texts count as the library's default counts them:
one token each, and the text around them is cut on its own.  Cases: a null
or empty text has 0 bytes and 0 tokens; repeated rows give repeated rows;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col, frequent

#: Distinct units (and pre-tokens) that a task keeps at most.
KEEP = 300_000
_INNER = re.compile(r"\s ")
_UNIT = re.compile(r"(?<=\S)(?= )")


def _plain_words(unit: str) -> tuple[str, ...] | None:
    """The cut of a unit of Latin words with full stops, commas or exclamation marks and single line ends; None for others."""
    lead = unit[:1] == " "
    out = []
    for i, part in enumerate(unit[lead:].split("\n")):
        core = part.rstrip(".,!")
        if not core.isalpha() or not (core.isascii() or max(core) < "\u0250"):
            return None
        if i:
            out.append("\n")
        out.append(" " + core if lead and not i else core)
        if len(core) < len(part):
            out.append(part[len(core):])
    return tuple(out)


class PreTokenizer:
    """Pre-token frequencies of texts, by the rules of a tokenizers JSON file."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        spec = json.loads(definition)
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers without normalizer and prefix space cut texts this way")
        special = [t for t in spec.get("added_tokens", [])]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("added tokens that match by their surroundings are not supported")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.names = names
        self.cuts: dict[str, tuple[str, ...]] = {}

    def cut(self, unit: str) -> tuple[str, ...]:
        """The pre-tokens of a unit (none of an empty one)."""
        known = self.cuts.get(unit)
        if known is None:
            known = _plain_words(unit) or tuple(unit[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(unit))
            if len(self.cuts) < KEEP:  # frequent units come early; later rare ones are cut again
                self.cuts[unit] = known
        return known

    def units(self, text: str) -> tuple[list[str], list[str], int]:
        """A text as (whole units, units without their leading space, special strings)."""
        parts, special = [text], 0
        if self.special is not None and any(n in text for n in self.names):
            parts = self.special.split(text)
            special = len(parts) - 1
        whole, spaced = [], []
        for part in parts:
            if _INNER.search(part):
                whole += _UNIT.split(part)
            elif part:
                first, *rest = part.split(" ")
                whole.append(first)
                spaced += rest
        return whole, spaced, special

    def __call__(self, text: str | None) -> tuple[Counter, int]:
        """(frequencies of pre-tokens, special strings) of a text."""
        out: Counter = Counter()
        whole, spaced, special = self.units(text or "")
        for units, lead in ((Counter(whole), ""), (Counter(spaced), " ")):
            for unit, c in units.items():
                for p in self.cut(lead + unit):
                    out[p] += c
        return out, special

    def pieces(self, pretoken: str) -> int:
        """Pieces of one pre-token: cut on its own it stays whole."""
        return sum(len(self.tokenizer.model.tokenize(p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(pretoken))


def _vocabulary(definition):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = PreTokenizer(definition.value)
        whole, spaced = Counter(), Counter()

        def emptied() -> pa.RecordBatch:
            total: Counter = Counter()
            for units, lead in ((whole, ""), (spaced, " ")):
                for unit, c in units.items():
                    for p in read.cut(lead + unit):
                        total[p] += c
                units.clear()
            return _frequencies(total)

        for b in batches:
            for text in b.column(0):
                first, rest, _ = read.units(text.as_py() or "")
                whole.update(first)
                spaced.update(rest)
                if len(whole) + len(spaced) > KEEP:
                    yield emptied()
        yield emptied()

    return run


def _frequencies(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["pretoken", "n"])


def _pieces(definition):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = PreTokenizer(definition.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([read.pieces(p) for p in b.column(0).to_pylist()], pa.int32())],
                                             names=["pretoken", "pieces"])

    return run


def _tokens(definition):
    """Tokens of every row; input sorted by pre-token, each distinct one is cut into pieces once.  Rows with n_bytes are sums already."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = PreTokenizer(definition.value)
        last, pieces = None, 0
        for b in batches:
            out = []
            for word, n, summed in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).is_valid().to_pylist()):
                if summed:
                    out.append(n)
                    continue
                if word != last:
                    last, pieces = word, read.pieces(word)
                out.append(n * pieces)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64()), b.column(4)], names=["id", "text_key", "n_tokens", "n_bytes"])

    return run


def _per_document(definition, head):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, known = PreTokenizer(definition.value), head.value
        told: dict[str, tuple[int, tuple[str, ...]]] = {}

        def unit_of(unit: str) -> tuple[int, tuple[str, ...]]:
            """(pieces of the pre-tokens in the head, the other pre-tokens) of a unit."""
            cut = read.cut(unit)
            out = sum(known.get(p, 0) for p in cut), tuple(p for p in cut if p not in known)
            if len(told) < KEEP:
                told[unit] = out
            return out

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                size, sums, keys, words, counts, bounds = [], [], [], [], [], [0]
                for text in part.column(1).to_pylist():
                    text = text or ""
                    whole, spaced, total = read.units(text)
                    tail: dict[str, int] = {}
                    for units, lead in ((Counter(whole), ""), (Counter(spaced), " ")):
                        for unit, c in units.items():
                            unit = lead + unit
                            pieces, rest = told.get(unit) or unit_of(unit)
                            total += c * pieces
                            for p in rest:
                                tail[p] = tail.get(p, 0) + c
                    words += tail
                    counts += tail.values()
                    bounds.append(len(words))
                    raw = text.encode()
                    size.append(len(raw))
                    keys.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
                    sums.append(total)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["pretoken", "n"]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.int64()), pa.array(size, pa.int64()), pa.array(sums, pa.int64()), lists],
                                                 names=["id", "text_key", "n_bytes", "n_tokens", "tail"])

    return run


def token_counts(docs: DataFrame, definition: str, *, id_column: str = "doc_id", text_column: str = "text",
                 limit: int = 512, head_size: int = 300_000) -> DataFrame:
    """Return per row: id, n_bytes, n_tokens, over_limit, for the tokenizer of the JSON text ``definition``."""
    spark = docs.sparkSession
    docs = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(definition)
    sampled = docs.filter(F.monotonically_increasing_id() % 8 == 0).select("text")
    vocabulary = sampled.mapInArrow(_vocabulary(shared), "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
    top = frequent(vocabulary, "n", head_size).select("pretoken").mapInArrow(_pieces(shared), "pretoken string, pieces int").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(top["pretoken"].to_pylist(), top["pieces"].to_pylist())))
    tail_type = T.ArrayType(T.StructType([T.StructField("pretoken", T.StringType()), T.StructField("n", T.LongType())]))
    long = T.LongType()
    rows = docs.mapInArrow(_per_document(shared, head), T.StructType(
        [docs.schema["id"], T.StructField("text_key", long), T.StructField("n_bytes", long), T.StructField("n_tokens", long), T.StructField("tail", tail_type)]))
    # one row per document with what the head gave, one per pre-token of its tail; a row's pre-token is never null in the tail
    exploded = rows.select("id", "text_key", F.explode(F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("pretoken"), F.col("n_tokens").alias("n"), F.col("n_bytes").alias("n_bytes"))),
        F.transform("tail", lambda t: F.struct(t["pretoken"].alias("pretoken"), t["n"].alias("n"), F.lit(None).cast("long").alias("n_bytes"))))).alias("x"))
    # sums meet no pre-token and are spread by a key of their own
    keyed = exploded.select("id", "text_key", F.coalesce("x.pretoken", F.concat(F.lit("\n"), F.col("text_key").cast("string"))).alias("pretoken"),
                            F.col("x.n").alias("n"), F.col("x.n_bytes").alias("n_bytes"))
    each = keyed.repartition("pretoken").sortWithinPartitions("pretoken").mapInArrow(_tokens(shared), T.StructType(
        [docs.schema["id"], T.StructField("text_key", long), T.StructField("n_tokens", long), T.StructField("n_bytes", long)]))
    sums = each.groupBy("id", "text_key").agg(F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"), F.count("n_bytes").alias("rows"))
    # equal rows (same id, same text) were summed together
    alone = sums.withColumn("n_tokens", F.expr("n_tokens div rows")).withColumn("copy", F.explode(F.expr("sequence(1, rows)")))
    return alone.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
