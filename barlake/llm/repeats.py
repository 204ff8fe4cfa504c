"""Repeated passages by longest-previous-factor arrays over sampled suffixes.

A byte goes if a passage of ``LENGTH`` bytes that covers it also starts earlier: at a smaller
doc_id, or earlier in the same document. No suffix array spans a corpus, so the suffixes that
could match are brought together first:

1. Every window of LENGTH bytes has an anchor, the smallest hashed 16-gram in it. Consecutive
   windows with the same anchor form a segment, and equal windows have equal anchors. Segments
   are sorted by anchor and content hash: a segment that is there already is a repeat as a whole.
2. Where an anchor has different segments, only parts of them may match. The bytes of the first
   occurrence of each are fetched, their suffixes sorted, and longest previous factors follow
   from previous and next smaller positions in suffix order.

A task first drops what repeats within itself, so that a passage in a third of all documents
leaves one row per task. Groups too large for one task are compared by window digests instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import slices, stored

LENGTH, GRAM = 100, 16
#: Bytes hashed at once, and segments gathered before a task drops its own repeats.
BLOCK_BYTES, GATHERED = 1 << 20, 400_000
#: Suffixes sorted at once, and segments of an anchor beyond which its windows are compared by digest.
SORTED, GROUP_SEGMENTS = 200_000, 20_000
_C1, _C2, _C3, _R = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0x5851F42D4C957F2D))
_NO_ID = -(2**63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _C3
    return x ^ (x >> np.uint64(29))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Segmenter:
    """Cuts texts into segments of windows with the same anchor."""

    def __init__(self):
        room = BLOCK_BYTES + 2 * LENGTH
        self.up, self.down = _powers(int(_R), room), _powers(pow(int(_R), -1, 2**64), room)

    def segments(self, pieces: list[bytes]):
        """(piece, first window, windows, anchor hash, segment hash) of all pieces, as arrays."""
        data = np.frombuffer(b"".join(pieces) + bytes(8), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        count = len(data) - 7
        eights = np.ndarray(count, "<u8", data.data, strides=(1,)).copy()
        grams = _mix(eights[:-8] * _C1 ^ np.roll(eights, -8)[:-8] * _C2) if count > 8 else np.empty(0, np.uint64)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        bits = np.uint64((1 << 22) - 1)
        least = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
        width = LENGTH - GRAM + 1
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: span - width], least[width - span :])
        inside = np.ones(int(ends[-1]), bool)
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
            inside[max(end - size, end - LENGTH + 1) : end] = False
        windows = np.flatnonzero(inside)
        if not len(windows):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.int64),) * 2
        anchors = (least[windows] & bits).astype(np.int64)
        new = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.concatenate([[0], np.flatnonzero(new) + 1])
        start = windows[first]
        many = np.diff(np.concatenate([first, [len(windows)]]))
        anchor = anchors[first]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(eights * _C2) * self.up[:count], dtype=np.uint64)])
        content = (sums[start + many + LENGTH - 8] - sums[start]) * self.down[start]
        content = _mix(content ^ many.astype(np.uint64) * _C1 ^ (anchor - start).astype(np.uint64) * _C2)
        piece = np.searchsorted(ends, start, "right")
        return piece, start - (ends - sizes)[piece], many, grams[anchor].view(np.int64), content.view(np.int64)


def _merged(keys: list[np.ndarray], start: np.ndarray, end: np.ndarray):
    """Runs of overlapping or touching ranges of the same key; ends rise with starts."""
    order = np.lexsort([start, *reversed(keys)])
    keys, start, end = [k[order] for k in keys], start[order], end[order]
    apart = start[1:] > end[:-1]
    for key in keys:
        apart |= key[1:] != key[:-1]
    first = np.concatenate([[0], np.flatnonzero(apart) + 1])
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return [k[first] for k in keys], start[first], end[last]


_ROWS = "kind int, anchor bigint, content bigint, id bigint, hash bigint, start bigint, many bigint"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
SEGMENT, REPEAT, PART = 0, 1, 2


def _rows(kind, anchor, content, ident, digest, start, many):
    kinds = np.full(len(anchor), kind, np.int32)
    return pa.record_batch([pa.array(c) for c in (kinds, anchor, content, ident, digest, start, many)], _NAMES)


def _drop_own(gathered):
    """Segments less those that repeat another of the task, and the ranges of these."""
    anchor, content, ident, digest, start, many = (np.concatenate(c) for c in zip(*gathered, strict=True))
    order = np.lexsort([start, digest, ident, content, anchor])
    anchor, content, ident, digest, start, many = (c[order] for c in (anchor, content, ident, digest, start, many))
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    # A row that repeats both doc_id and text is the same document, not a later one.
    again = (ident != ident[first]) | (digest != digest[first]) | (start != start[first])
    yield _rows(SEGMENT, *(c[new] for c in (anchor, content, ident, digest, start, many)))
    if again.any():
        (ident, digest), start, end = _merged([ident[again], digest[again]], start[again], start[again] + many[again] + LENGTH - 1)
        spread = _mix(ident.view(np.uint64) * _C1).view(np.int64)
        yield _rows(REPEAT, spread, np.zeros_like(spread), ident, digest, start, end)


def _pieces(texts: list[bytes]):
    """(text number, offset, bytes): long texts in parts that overlap by less than a window."""
    for number, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), BLOCK_BYTES // 2):
            yield number, at, text[at : at + BLOCK_BYTES // 2 + LENGTH - 1]


def _segment_rows(batches):
    segmenter = Segmenter()
    gathered, held = [], 0
    for batch in batches:
        ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "hash"))
        pieces = list(_pieces(batch.column("text").to_pylist()))
        for a, b in slices([len(p[2]) for p in pieces], BLOCK_BYTES // 2):
            part = pieces[a:b]
            piece, start, many, anchor, content = segmenter.segments([p[2] for p in part])
            owner = np.array([p[0] for p in part])[piece]
            start = start + np.array([p[1] for p in part])[piece]
            gathered.append((anchor, content, ids[owner], hashes[owner], start, many))
            held += len(anchor)
            if held > GATHERED:
                yield from _drop_own(gathered)
                gathered, held = [], 0
    if held:
        yield from _drop_own(gathered)


def _repeated_segments(batches):
    """Of sorted segments: later copies as ranges, and first ones whose anchor has other segments."""
    last = None  # the row that later copies are copies of
    waiting = None  # the newest first occurrence: whether it has a neighbour is not known yet
    for batch in batches:
        kind, *columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in _NAMES)
        done = kind == REPEAT
        if done.any():
            yield _rows(REPEAT, *(c[done] for c in columns))
            columns = [c[~done] for c in columns]
        if not len(columns[0]):
            continue
        if last is not None:
            columns = [np.concatenate([[v], c]) for v, c in zip(last, columns, strict=True)]
        anchor, content, ident, digest, start, many = columns
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = (ident != ident[first]) | (digest != digest[first]) | (start != start[first])
        if again.any():
            yield _rows(REPEAT, anchor[again], content[again], ident[again], digest[again], start[again], start[again] + many[again] + LENGTH - 1)
        firsts = [c[new] for c in columns]
        near = np.zeros(len(firsts[0]), bool)
        same = firsts[0][1:] == firsts[0][:-1]
        near[1:] |= same
        near[:-1] |= same
        # The first of these is the one that has been waiting, if there is one.
        near[0] |= waiting is not None and waiting
        taken = near.copy()
        taken[-1] = False
        if taken.any():
            yield _rows(PART, *(c[taken] for c in firsts))
        last, waiting = [c[-1] for c in firsts], bool(near[-1])
    if waiting:
        yield _rows(PART, *(np.array([v]) for v in last))


def longest_previous(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factor of each position, up to the depth that ``common`` knows.

    ``order`` lists positions by suffix, ``common[i]`` is the length that suffixes i-1 and i share.
    A position's earlier match lies at the nearest smaller position before or behind it in suffix
    order; both are found in one pass over a stack of rising positions.
    """
    factor = [0] * len(order)
    stack: list[tuple[int, int]] = []  # (position, length shared with the entry below)
    positions = order.tolist()
    shared = common.tolist()
    for i, position in enumerate(positions):
        length = shared[i] if i else 0
        while stack and stack[-1][0] > position:
            # The position met now is the next smaller one of the entry on top.
            above, below = stack.pop()
            factor[above] = max(factor[above], below, length)
            length = min(length, below)
        stack.append((position, length))
    while stack:
        above, below = stack.pop()
        factor[above] = max(factor[above], below)
    return np.array(factor, np.int64)


def previous_factors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, window) of the windows that occur earlier, in the order of the texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    many = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(texts)), many)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    place = (np.cumsum(sizes) - sizes)[owner] + window
    words = [np.ndarray(len(data) - 7, ">u8", data.data, strides=(1,))[place + at].astype(np.uint64) for at in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    order = np.lexsort(words[::-1])
    equal = np.ones(len(order) - 1, bool)
    for word in words:
        sorted_word = word[order]
        equal &= sorted_word[1:] == sorted_word[:-1]
    # Factors shorter than a window make no difference: runs of equal windows stand by themselves.
    common = np.concatenate([[0], np.where(equal, LENGTH, 0)])
    run = np.zeros(len(order), bool)
    run[1:] |= equal
    run[:-1] |= equal
    ranks = np.flatnonzero(run)
    if not len(ranks):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    positions = order[ranks]
    dense = np.argsort(np.argsort(positions))
    factor = longest_previous(dense, common[ranks])
    found = np.sort(positions)[factor >= LENGTH]
    return owner[found], window[found]


_PARTS = "anchor bigint, id bigint, hash bigint, start bigint, bytes binary"


def _fetched(batches):
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("id", "hash", "text", "parts")]
        for ident, digest, text, parts in zip(*columns, strict=True):
            rows += [(p["anchor"], ident, digest, p["start"], text[p["start"] : p["start"] + p["many"] + LENGTH - 1]) for p in parts]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)],
            ["anchor", "id", "hash", "start", "bytes"],
        )


def _factors(limit: int):
    """Ranges of repeated windows among the segments of each anchor; too large groups are handed on."""
    columns = ("anchor", "id", "hash", "start")
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("start", pa.int64()), ("many", pa.int64()), ("anchor", pa.int64()), ("bytes", pa.binary())])

    def found(ident, digest, start, many):
        return pa.record_batch([pa.array(ident), pa.array(digest), pa.array(start), pa.array(many), pa.nulls(len(ident), pa.int64()), pa.nulls(len(ident), pa.binary())], schema=schema)

    def compare(keys, texts):
        sizes = [len(t) - LENGTH + 1 for t in texts]
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys[0])) + 1, [len(texts)]])
        totals = np.add.reduceat(np.array(sizes), bounds[:-1]).tolist()
        for a, b in slices(totals, SORTED):
            low, high = bounds[a], bounds[b]
            owner, window = previous_factors(texts[low:high])
            if len(owner):
                ident, digest, start = (k[low:high][owner] for k in keys[1:])
                (ident, digest), start, end = _merged([ident, digest], start + window, start + window + LENGTH)
                yield found(ident, digest, start, end)

    def over_all(batches):
        keys, texts = [np.empty(0, np.int64)] * 4, []
        handed_on = None
        for batch in batches:
            fresh = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            new_texts = batch.column("bytes").to_pylist()
            # The same row twice is one document.
            before = [np.concatenate([k[-1:], f[:-1]]) if len(k) else np.concatenate([f[:1] - 1, f[:-1]]) for k, f in zip(keys, fresh, strict=True)]
            new = np.any([f != b for f, b in zip(fresh, before, strict=True)], axis=0)
            keys = [np.concatenate([k, f[new]]) for k, f in zip(keys, fresh, strict=True)]
            texts += [t for t, n in zip(new_texts, new, strict=True) if n]
            if not texts:
                continue
            if handed_on is not None:
                same = int(np.searchsorted(keys[0], handed_on, "right"))
                yield handed(keys, texts, same)
                keys, texts = [k[same:] for k in keys], texts[same:]
                if not texts:
                    continue
            last = int(np.searchsorted(keys[0], keys[0][-1]))
            if last:
                yield from compare([k[:last] for k in keys], texts[:last])
            keys, texts = [k[last:] for k in keys], texts[last:]
            if len(texts) > limit:
                handed_on = keys[0][-1]
                yield handed(keys, texts, len(texts))
                keys, texts = [k[:0] for k in keys], []
        if texts:
            yield from compare(keys, texts)

    def handed(keys, texts, count):
        anchor, ident, digest, start = (k[:count] for k in keys)
        return pa.record_batch([pa.array(ident), pa.array(digest), pa.array(start), pa.array(start), pa.array(anchor), pa.array(texts[:count], pa.binary())], schema=schema)

    return over_all


def _by_digest(rows: DataFrame) -> DataFrame:
    """Repeated windows of segments, by the digest of each window."""
    windows = rows.distinct().select("id", "hash", "start", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)).alias("at"))
    places = windows.select(
        F.expr(f"md5(substring(bytes, at + 1, {LENGTH}))").alias("digest"), F.struct("id", "hash", (F.col("start") + F.col("at")).alias("start")).alias("place")
    )
    firsts = places.groupBy("digest").agg(F.min("place").alias("first"))
    later = places.join(firsts, "digest").where("place <> first").select("place.*")
    return later.withColumn("end", F.col("start") + LENGTH)


def repeated_ranges(spark: SparkSession, docs: DataFrame, *, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """``id, hash, start, end``: ranges of bytes that an earlier passage repeats; they may overlap.

    ``docs`` has ``id, hash, text`` without nulls, as ``_documents`` makes them.
    """
    segments = docs.mapInArrow(_segment_rows, _ROWS)
    ordered = segments.repartition("anchor").sortWithinPartitions("kind", "anchor", "content", "id", "hash", "start")
    judged = stored(spark, ordered.mapInArrow(_repeated_segments, _ROWS), "segments")
    whole = judged.where(F.col("kind") == REPEAT).select("id", "hash", "start", F.col("many").alias("end"))
    parts = judged.where(F.col("kind") == PART).groupBy("id", "hash").agg(F.collect_list(F.struct("anchor", "start", "many")).alias("parts"))
    fetched = docs.join(parts, ["id", "hash"]).select("id", "hash", "text", "parts").mapInArrow(_fetched, _PARTS)
    grouped = fetched.repartition("anchor").sortWithinPartitions("anchor", "id", "hash", "start")
    compared = stored(spark, grouped.mapInArrow(_factors(group_segments), "id bigint, hash bigint, start bigint, many bigint, anchor bigint, bytes binary"), "factors")
    partial = compared.where("anchor IS NULL").select("id", "hash", "start", F.col("many").alias("end"))
    over = compared.where("anchor IS NOT NULL").select("id", "hash", "start", "bytes")
    ranges = whole.unionByName(partial)
    return ranges if over.isEmpty() else ranges.unionByName(_by_digest(over))


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("hash"), text.cast("binary").alias("text")
    )


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _cut(batches):
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            bounds = [0, *(x for run in merged for x in run), len(text)]
            sizes.append(len(text))
            spans.append([dict(start=s, end=e) for s, e in merged])
            kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
        yield pa.record_batch(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "spans", "kept"],
        )


def drop_repeats(spark: SparkSession, docs: DataFrame, *, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal removed runs of bytes, ``kept`` the bytes left. Null counts as empty.
    A null doc_id comes before all numbers; of one doc_id the text with the smaller hash comes
    first, and rows that repeat both doc_id and text are one document with one result each.
    An empty table gives no rows.
    """
    own = _documents(docs)
    ranges = repeated_ranges(spark, own, group_segments=group_segments)
    gathered = ranges.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = own.join(gathered, ["id", "hash"], "left").select("id", "text", "ranges")
    cut = joined.mapInArrow(_cut, "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return cut.select(F.nullif("id", F.lit(_NO_ID)).alias("doc_id"), "n_bytes", "spans", "kept")
