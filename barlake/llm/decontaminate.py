"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of ten consecutive item words. Words are the symbols: a shift table over
blocks of two words says how far the search may jump, the windows that end in a block whose shift
is zero form a bucket by suffix hash, and a direct comparison confirms an occurrence.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import drop_rows, map_rows, stored, text_hash, words_of

WINDOW = 10
#: Windows of one search table; more windows make more tables, each searched over all documents.
TABLE_WINDOWS = 200_000


class WuManber:
    """Search for word sequences of different lengths; ``find`` yields (start, pattern number)."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.symbols: dict[bytes, int] = {}
        for pattern in patterns:
            for word in pattern:
                self.symbols.setdefault(word, len(self.symbols) + 1)
        coded = [tuple(self.symbols[w] for w in p) for p in patterns]
        # One table for each shortest length: short items would spoil the jumps of long ones.
        lengths = {len(p) for p in coded}
        self.tables = [
            self._table([(n, p) for n, p in enumerate(coded) if len(p) == length], length)
            for length in sorted(lengths)
        ]

    @staticmethod
    def _table(patterns, length: int):
        block = min(2, length)
        shifts: dict = {}
        buckets: dict = {}
        for number, pattern in patterns:
            for end in range(block, length + 1):
                key = pattern[end - 1] if block == 1 else (pattern[end - 2], pattern[end - 1])
                shifts[key] = min(shifts.get(key, length), length - end)
            buckets.setdefault(pattern[-block:], []).append((number, pattern))
        return length, block, shifts, buckets

    def find(self, words: list[bytes]):
        get = self.symbols.get
        codes = [get(w, 0) for w in words]
        if not any(codes):
            return
        count = len(codes)
        for length, block, shifts, buckets in self.tables:
            jump, end = length - block + 1, length
            while end <= count:
                last = codes[end - 1]
                key = last if block == 1 else (codes[end - 2], last)
                shift = shifts.get(key, jump)
                # A word that no pattern has rules out every window over it.
                if not last:
                    shift = length
                if shift:
                    end += shift
                    continue
                found = tuple(codes[end - length : end])
                for number, pattern in buckets[found[-block:]]:
                    if pattern == found:
                        yield end - length, number
                end += 1


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``window`` (words), ``items`` (the identifiers that have it), one row per window."""

    def of_batch(batch):
        ids, windows = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            if words:
                for i in range(max(1, len(words) - WINDOW + 1)):
                    ids.append(item)
                    windows.append(b" ".join(words[i : i + WINDOW]))
        yield pa.record_batch([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], ["item", "window"])

    texts = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")
    )
    windows = map_rows(texts, of_batch, "item string, window binary")
    return windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _search(docs: DataFrame, patterns: list[tuple[bytes, ...]], items: list[list[str]]) -> DataFrame:
    """Per document: its words, the runs of hit words and the items found."""

    def over_all(batches):
        search = WuManber(patterns)
        for batch in batches:
            counts, runs, found = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                counts.append(len(words))
                spans: list[list[int]] = []
                names: set[str] = set()
                for start, number in sorted(search.find(words)) if words else ():
                    end = start + len(patterns[number])
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                    names.update(items[number])
                runs.append([{"start": s, "end": e} for s, e in spans])
                found.append(sorted(names))
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            yield pa.record_batch(
                [
                    batch.column("row"), batch.column("doc_id"), batch.column("text_hash"), pa.array(counts, pa.int64()),
                    pa.array(runs, pa.list_(span)), pa.array(found, pa.list_(pa.string())),
                ],
                ["row", "doc_id", "text_hash", "n_words", "runs", "items"],
            )

    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash(),
        F.col("text").cast("binary").alias("text"),
    )
    schema = "row bigint, doc_id bigint, text_hash bigint, n_words bigint, runs array<struct<start:int,end:int>>, items array<string>"
    return texts.mapInArrow(over_all, schema)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, table_windows: int = TABLE_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, runs, items, n_hit``.

    ``runs`` are the maximal runs of words inside an occurrence of a window, ``items`` the items
    whose windows occur, sorted as text. An item of fewer than ten words is one window; an item
    without words has none; a null item_id counts as empty text. Null and empty texts have no
    words. Repeated rows are separate documents. The windows are searched in tables of
    at most ``table_windows``, which is all that is sent to a task; documents are read once a table.
    """
    windows = stored(spark, item_windows(benchmark), "windows")
    tables = max(1, -(-windows.count() // table_windows))
    results = []
    for number in range(tables):
        block = windows.where(F.pmod(F.xxhash64("window"), F.lit(tables)) == number).orderBy("window").collect()
        patterns = [tuple(bytes(r.window).split(b" ")) for r in block]
        results.append(_search(docs, patterns, [list(r["items"]) for r in block]))
    hits = results[0]
    if tables > 1:
        # The same row has the same number in every search, as all read the same table.
        for more in results[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_hash").alias("text_hash"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        merged = """aggregate(runs, cast(array() as array<struct<start:int,end:int>>), (done, r) ->
            if(size(done) > 0 and r.start <= element_at(done, -1).end,
               concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).start as start,
                      greatest(element_at(done, -1).end, r.end) as end))),
               concat(done, array(r))))"""
        hits = hits.withColumn("runs", F.expr(merged))
    covered = F.expr("aggregate(runs, 0L, (n, r) -> n + r.end - r.start)")
    return hits.select("doc_id", "text_hash", "n_words", "runs", "items", covered.alias("n_hit"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    return drop_rows(docs, contamination(spark, docs, benchmark).where("n_hit > 0"))
