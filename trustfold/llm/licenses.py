"""License scans by diagonal voting.

Templates (license notices and texts) and documents are runs of words.  All
rolling k-word hashes of the documents are joined by Spark to the k-word
hashes of the templates.  Templates are a table of any size: up to
``SENT_GRAMS`` hashes they are sent to every task, beyond it the join
shuffles.  A match of document word
i with template word j is a vote for the diagonal ``i - j``:

* votes are grouped by document, template and diagonal; all words of a short
  template on one diagonal are an exact occurrence, which starts there;
* diagonals at most ``shift`` apart are merged (a word more or less moves
  the rest of a notice to a neighbouring diagonal);
* a merged span is verified by the share of the template's words that its
  votes cover, each counted once; a span from ``cover`` on gives the
  template's label.

*Phrases* are templates of which every exact occurrence is counted.  Words
are compared by 64-bit hashes.  Votes are sets of positions, so copies of a
document in different tasks change nothing, and one shuffle (by document)
serves every grouping; documents without a vote send one row.

Cases: a null or wordless text has no words and no hits (score 0); a phrase
shorter than k words is refused; rows with equal id and text are grouped
and come back as often as they were; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col, stored
from trustfold.llm.textarrays import ALNUM, Chunk, chunk_of, gram_hashes, list_array, signed, slices, words_of

#: Grams of all templates together that are sent to every task (some 100 bytes each); more are joined by a shuffle.
SENT_GRAMS = 100_000

#: Phrases of which all places count (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: License notices and the labels they give (fixed values).
NOTICES = {
    "the mit license": "mit",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "either version 3 of the license or at your option any later version": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


#: Whole license texts and the labels they give, as words (fixed values).
TEXTS = {
    """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
    to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or
    sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions
    the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
    the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
    fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
    liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in
    the software""": "mit",
    """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above
    copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard
    to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct
    indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence
    or other tortious action arising out of or in connection with the use or performance of this software""": "isc",
    """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from
    the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and
    redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you
    wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not
    required altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not
    be removed or altered from any source distribution""": "zlib",
    """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
    redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary
    form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials
    provided with the distribution""": "bsd",
}


def template_table(spark: SparkSession, phrases: Mapping[str, str], notices: Mapping[str, str]) -> DataFrame:
    """Templates as rows (text, label, phrase): of phrases every place counts."""
    texts = [*phrases, *notices]
    return spark.createDataFrame(pa.table({"text": pa.array(texts, pa.string()), "label": pa.array([*phrases.values(), *notices.values()], pa.string()),
                                           "phrase": pa.array([t in phrases for t in texts], pa.bool_())}))


def template_grams(templates: DataFrame, k: int) -> DataFrame:
    """Stored (gram, word, template, label, phrase, length) of templates (text, label, phrase); length counts words."""
    numbered = stored(templates.select("text", "label", "phrase").withColumn("template", F.monotonically_increasing_id()), "templates")
    schema = T.StructType([T.StructField("template", T.LongType()), T.StructField("key", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("grams", T.ArrayType(T.LongType()))])
    words = numbered.select("template", "text").mapInArrow(_grams(k), schema)
    least = words.agg(F.min("length")).first()[0]
    if least is not None and least < k:
        raise ValueError(f"a template has fewer than {k} words")
    grams = words.select("template", "length", F.posexplode("grams").alias("word", "gram")).filter("word > 0")
    return stored(grams.join(numbered.drop("text"), "template").select("gram", (F.col("word") - 1).alias("word"), "template", "label", "phrase", "length"), "template_grams")


def _grams(k: int):
    """Per text: its key, word count and all rolling k-word hashes, with a first entry that no gram has (its row is always kept)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            chunk: Chunk = chunk_of(b.column(1))
            words = words_of(chunk, ALNUM)
            grams, at = gram_hashes(words, k)
            cut = np.searchsorted(at, words.bounds)
            values = np.insert(signed(grams), cut[:-1], 0)
            raw, o = chunk.data.tobytes(), chunk.offsets.tolist()
            keys = [int.from_bytes(hashlib.blake2b(raw[x:y], digest_size=8).digest(), "little", signed=True) for x, y in zip(o, o[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array(words.counts, pa.int64()),
                                              list_array(values, cut + np.arange(len(cut)))], names=["id", "key", "n_words", "grams"])

    return run


def scan(docs: DataFrame, templates: DataFrame | None = None, *, id_column: str = "doc_id",
         text_column: str = "text", k: int = 3, shift: int = 2, cover: float = 0.9) -> DataFrame:
    """Return per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``templates`` has rows (text, label, phrase); without it the phrases,
    notices and texts of this module are looked for.  Spans are the verified
    ones: (label, from, to, cover), in words.
    """
    docs = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    wanted = template_grams(template_table(docs.sparkSession, PHRASES, {**NOTICES, **TEXTS}) if templates is None else templates, k)
    if wanted.count() <= SENT_GRAMS:
        wanted = F.broadcast(wanted)
    schema = T.StructType([docs.schema["id"], T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("grams", T.ArrayType(T.LongType()))])
    grams = docs.mapInArrow(_grams(k), schema).select("id", "key", "n_words", F.posexplode("grams").alias("at", "gram"))
    votes = (grams.join(wanted, "gram", "left").filter("template is not null or at = 0")
             .withColumn("diagonal", F.col("at") - 1 - F.col("word")).repartition("id", "key"))
    kind = ("template", "label", "phrase", "length")  # the last three follow from the template
    diagonals = (votes.groupBy("id", "key", *kind, "diagonal")
                 .agg(F.max("n_words").alias("n_words"), F.collect_set("word").alias("words"), F.sum((F.col("at") == 0).cast("int")).alias("rows")))
    order = "partition by id, key, template order by diagonal"
    merged = (diagonals.withColumn("new", F.expr(f"if(diagonal - lag(diagonal) over ({order}) <= {shift}, 0, 1)"))
              .withColumn("span", F.expr(f"sum(new) over ({order})"))
              .withColumn("full", F.col("phrase") & (F.size("words") == F.col("length") - k + 1))
              .groupBy("id", "key", *kind, "span")
              .agg(F.max("n_words").alias("n_words"), F.sum("rows").alias("rows"), F.sum(F.col("full").cast("long")).alias("n_base"),
                   F.min(F.when(F.col("full"), F.col("diagonal"))).alias("first_word"), F.max(F.when(F.col("full"), F.col("diagonal"))).alias("last_word"),
                   F.min(F.col("diagonal") + F.array_min("words")).alias("from"), F.max(F.col("diagonal") + F.array_max("words") + k).alias("to"),
                   F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
              .withColumn("covered", F.size(F.array_distinct(F.flatten(F.transform("words", lambda w: F.sequence(w, w + k - 1))))) / F.col("length")))
    verified = F.when(F.col("covered") >= cover, F.struct("label", F.col("from").cast("long").alias("from"), F.col("to").cast("long").alias("to"), F.col("covered").alias("cover")))
    out = (merged.groupBy("id", "key")
           .agg(F.max("n_words").alias("n_words"), F.sum("rows").alias("rows"), F.coalesce(F.sum("n_base"), F.lit(0)).cast("long").alias("n_base"),
                F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"),
                F.collect_set(F.when(F.col("n_base") > 0, F.col("label"))).alias("base"), F.array_sort(F.collect_list(verified)).alias("spans"),
                F.coalesce(F.max("covered"), F.lit(0.0)).alias("score")))
    return (out.withColumn("copy", F.explode(F.expr("sequence(1, rows)")))
            .select(F.col("id").alias(id_column), "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union("base", F.transform("spans", lambda s: s["label"]))), ",").alias("labels"), "score", "spans"))
