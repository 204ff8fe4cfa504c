"""License scans by diagonal voting.

All rolling word k-gram hashes of a text are joined to the positions of the same k-grams in the
license templates. Matches vote for their diagonal (text position less template position), votes
of neighbouring diagonals are merged, so that a word put in or left out does not split a span,
and the spans left are verified word by word.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlake.llm.common import words_of

K = 3
#: Diagonals this near belong to one span.
DRIFT = 2
#: Share of a template's words that must verify. One vote is enough to be verified: a word that differs or is
#: put in takes up to K k-grams away, so asking for more would be stricter than this.
LEAST_SIMILARITY = 0.7

#: Phrases that are found exactly, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Passages of well-known licenses, found approximately.
PASSAGES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "you may not use this file except in compliance with the license": "apache-2",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under the gnu general public license version 3": "gpl-3",
    "under the terms of the gnu general public license version 2": "gpl-2",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "creative commons attribution 4 0 international license": "cc-by-4",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: (words, label, exact)
TEMPLATES = [(tuple(t.encode().split()), label, True) for t, label in PHRASES.items()]
TEMPLATES += [(tuple(t.encode().split()), label, False) for t, label in PASSAGES.items()]


class _WordHash(dict):
    """64-bit hash of each word, kept while there are not too many."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def gram_hashes(words: list[bytes], hashes: dict[bytes, int]) -> np.ndarray:
    """Hash of each run of K words, as signed 64-bit numbers."""
    if len(words) < K:
        return np.empty(0, np.int64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - K + 1, np.uint64)
    for i in range(K):
        mixed = (mixed ^ each[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def template_positions(spark: SparkSession) -> DataFrame:
    """``gram, template, at``: one row per k-gram of the fixed templates, about a hundred."""
    hashes = _WordHash()
    rows = [
        (int(gram), number, at)
        for number, (words, _, _) in enumerate(TEMPLATES)
        for at, gram in enumerate(gram_hashes(list(words), hashes))
    ]
    return spark.createDataFrame(rows, "gram bigint, template int, at int")


def _grams(batches):
    hashes = _WordHash()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        # Few texts at a time: the hashes of a batch of long ones would fill the memory.
        for start in range(0, len(texts), 256):
            arrays = [gram_hashes(words_of(t), hashes) for t in texts[start : start + 256]]
            offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
            part = batch.slice(start, 256)
            yield pa.record_batch([*(part.column(c) for c in ("doc_id", "text_hash", "row")), grams], ["doc_id", "text_hash", "row", "grams"])


def candidate_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, spans``: ranges of words that templates vote for."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("binary").alias("text"),
    )
    grams = texts.mapInArrow(_grams, "doc_id bigint, text_hash bigint, row bigint, grams array<bigint>")
    places = grams.select("doc_id", "text_hash", "row", F.posexplode("grams").alias("pos", "gram"))
    # The templates are fixed text, so their table has a fixed size.
    votes = places.join(F.broadcast(template_positions(spark)), "gram")
    diagonals = votes.groupBy("doc_id", "text_hash", "row", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True))
    merged = (
        diagonals.withColumn("far", far.cast("int"))
        .withColumn("span", F.sum("far").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "text_hash", "row", "template", "span")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    )
    # Rows that repeat a text under one doc_id have the same spans: once is enough.
    return merged.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("template", "first", "last", "low", "high")).alias("spans"))


def verify(words: list[bytes], spans) -> tuple[list[dict], list[dict]]:
    """Exact places of phrases, and verified approximate passages."""
    places, passages = set(), {}
    for span in spans:
        template, label, exact = TEMPLATES[span["template"]]
        first, end = span["first"], span["last"] + K
        if exact:
            for at in range(max(0, first - len(template)), min(end, len(words) - len(template) + 1)):
                if tuple(words[at : at + len(template)]) == template:
                    places.add((at, at + len(template), label))
        else:
            # The whole template along its diagonals: words beyond the outermost votes may match too.
            low = max(0, span["low"])
            best = SequenceMatcher(None, template, words[low : max(end, span["high"] + len(template))], autojunk=False).get_matching_blocks()
            share = sum(block.size for block in best) / len(template)
            if share >= LEAST_SIMILARITY:
                matched = [block for block in best if block.size]
                key = (low + matched[0].b, low + matched[-1].b + matched[-1].size, label)
                passages[key] = max(passages.get(key, 0.0), min(1.0, share))
    keyed = [dict(start=s, end=e, label=n, similarity=1.0) for s, e, n in sorted(places)]
    return keyed, [dict(start=s, end=e, label=n, similarity=w) for (s, e, n), w in sorted(passages.items())]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("similarity", pa.float64())])
_SPANS = "array<struct<start:bigint,end:bigint,label:string,similarity:double>>"


def _verified(batches):
    for batch in batches:
        counts, exact, near = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = words_of(text)
            counts.append(len(words))
            places, passages = verify(words, spans) if spans else ([], [])
            exact.append(places)
            near.append(passages)
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(exact, pa.list_(_SPAN)), pa.array(near, pa.list_(_SPAN))],
            ["doc_id", "n_words", "places", "passages"],
        )


def license_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, places, passages``.

    ``places`` are the verified occurrences of the phrases, ``passages`` verified ranges that
    resemble a longer license text; both in words from 0 with an exclusive end. Null and empty
    texts have no words. Repeated rows are kept, a null doc_id is a value like any other.
    """
    found = candidate_spans(spark, docs)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )
    same = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["text_hash"] == found["text_hash"])
    joined = texts.join(found, same, "left").select(texts["doc_id"], texts["text"], "spans")
    return joined.mapInArrow(_verified, f"doc_id bigint, n_words bigint, places {_SPANS}, passages {_SPANS}")
