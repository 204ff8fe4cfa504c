"""Language of words and documents by a linear-chain conditional random field.

Words have affix, character n-gram and lexicon features, hashed to a fixed number of weights per
language; transitions between the languages of neighbouring words are learned with them, from
chains in which fragments of different languages follow each other. Forward-backward gives
each word of a text its marginal probabilities; a document's are their mean, and neighbouring words
with one label are a span.

Marginals sum to 1 whatever the language, so they cannot tell that a text is of none of those learned.
That is seen from its letters: ``familiar`` is the share of a text's letter trigrams that occurred in
training in the language its words are labelled with.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from barlake.llm.common import slices

#: Bounds of the training sample: rows a language, fragments a row, words a fragment.
ROWS_PER_LANGUAGE, FRAGMENTS, FRAGMENT_WORDS = 800, 6, 12
FEATURES = 1 << 16
#: Places of the table of letter trigrams seen in training, a multiple of FEATURES.
TRIGRAMS = 1 << 18
#: Words worked on in one sweep; messages are carried from one such stretch of a text to the next.
STRETCH = 64
#: Words whose scores a task keeps, and words worked on at once.
KNOWN_WORDS, BLOCK_WORDS = 200_000, 100_000
UNKNOWN = "und"
#: A longer run of letters, as in scripts without spaces, is several words of the chain.
_WORD = re.compile(r"[^\W\d_]{1,40}")


def _hashes(word: str) -> list[int]:
    """The word itself, prefixes, suffixes, character bigrams and, last, a trigram for each letter."""
    marked = f"^{word}$"
    names = ["w" + word]
    names += ["p" + word[:n] for n in (1, 2, 3) if len(word) >= n]
    names += ["s" + word[-n:] for n in (1, 2, 3) if len(word) >= n]
    names += [marked[i : i + 2] for i in range(len(marked) - 1)]
    names += [marked[i : i + 3] for i in range(len(marked) - 2)]
    return [xxhash.xxh32_intdigest(n) % TRIGRAMS for n in names]


def word_features(word: str) -> list[int]:
    return [h % FEATURES for h in _hashes(word)]


def emissions(words: list[str], weights: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: the score of each language, its trigrams, and those seen in each language."""
    if not words:
        return np.empty((0, weights.shape[1]), np.float32), np.empty(0, np.int64), np.empty((0, weights.shape[1]), np.int64)
    lists = [_hashes(w) for w in words]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    letters = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    flat = np.fromiter((f for features in lists for f in features), np.int64, ends[-1])
    scores = np.add.reduceat(weights[flat % FEATURES], ends - sizes, axis=0)
    trigram = np.arange(len(flat)) >= np.repeat(ends - letters, sizes)
    known = np.add.reduceat(seen[flat] & trigram[:, None], ends - sizes, axis=0, dtype=np.int64)
    return scores, letters, known


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, *, before: np.ndarray | None = None,
    after: np.ndarray | None = None, pairs: bool = False,
) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of (chain, word, language) scores and, for training, expected transitions.

    ``before`` and ``after`` are the messages into the first and the last word of each chain where
    it is a stretch of a longer one. Places at or beyond a chain's length have marginal zero.
    """
    _, width, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions)
    ahead = np.empty_like(local)
    behind = np.ones_like(local)
    first = local[:, 0] if before is None else local[:, 0] * before
    ahead[:, 0] = first / first.sum(axis=1, keepdims=True)
    if after is None:
        after = np.ones_like(first)
    behind[:, -1] = after
    for t in range(1, width):
        now = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    inside = np.arange(width)[None, :] < lengths[:, None]
    for t in range(width - 2, -1, -1):
        now = (local[:, t + 1] * behind[:, t + 1]) @ step.T
        now /= now.sum(axis=1, keepdims=True)
        behind[:, t] = np.where(inside[:, t + 1, None], now, after)
    marginal = ahead * behind
    marginal *= inside[:, :, None] / marginal.sum(axis=2, keepdims=True)
    if not pairs:
        return marginal, None
    expected = np.zeros((labels, labels))
    for t in range(1, width):
        pair = ahead[:, t - 1, :, None] * step[None] * (local[:, t] * behind[:, t])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected += pair[inside[:, t]].sum(axis=0)
    return marginal, expected


def passages(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """What each stretch does to a message into its first word, as a matrix up to a factor."""
    many, width, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions)
    state = np.eye(labels, dtype=local.dtype)[None] * local[:, 0, None, :]
    for t in range(1, width):
        now = (state.reshape(-1, labels) @ step).reshape(many, labels, labels) * local[:, t, None, :]
        now /= now.sum(axis=(1, 2), keepdims=True)
        state = np.where((t < lengths)[:, None, None], now, state)
    return state


def carried(passage: np.ndarray, order: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages into the first and the last word of each stretch; ``order`` counts those of a text from 0."""
    before, after = np.ones(passage.shape[:2], passage.dtype), np.ones(passage.shape[:2], passage.dtype)
    # Stretches with one number belong to different texts; those of a text lie side by side.
    numbered = np.argsort(order, kind="stable")
    bounds = np.searchsorted(order[numbered], np.arange(1, int(order.max()) + 2))
    levels = [numbered[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for at in levels:
        message = np.einsum("ni,nij->nj", before[at - 1], passage[at - 1]) @ step
        before[at] = message / message.sum(axis=1, keepdims=True)
    for at in reversed(levels):
        message = np.einsum("nij,nj->ni", passage[at], after[at]) @ step.T
        after[at - 1] = message / message.sum(axis=1, keepdims=True)
    return before, after


def train(fragments: list[tuple[str, list[str]]], *, epochs: int = 3, seed: int = 7):
    """``languages, weights, transitions, seen`` from (language, words) fragments, by AdaGrad.

    A training chain joins three fragments; half of the time all are of one language.
    """
    languages = sorted({lang for lang, _ in fragments})
    weights = np.zeros((FEATURES, len(languages)), np.float32)
    transitions = np.zeros((len(languages), len(languages)))
    seen = np.zeros((TRIGRAMS, len(languages)), bool)
    if not languages:
        return languages, weights, transitions, seen
    for lang, words in fragments:
        for word in words:
            seen[_hashes(word)[-len(word) :], languages.index(lang)] = True
    random = np.random.default_rng(seed)
    by_label = [[words for lang, words in fragments if lang == name] for name in languages]
    squares, pair_squares = np.full_like(weights, 1e-6), np.full_like(transitions, 1e-6)
    features: dict[str, list[int]] = {}
    chains = max(1, len(fragments) // 3)
    for _ in range(epochs):
        for _ in range(-(-chains // 128)):
            words, labels = [], []
            for _ in range(128):
                chosen = random.integers(len(languages), size=3)
                if random.random() < 0.5:
                    chosen[:] = chosen[0]
                words.append([])
                labels.append([])
                for label in chosen:
                    part = by_label[label][random.integers(len(by_label[label]))]
                    words[-1] += part
                    labels[-1] += [label] * len(part)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            width = int(lengths.max())
            lists = []
            for word in (w for chain in words for w in chain):
                if word not in features:
                    features[word] = word_features(word)
                lists.append(features[word])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.concatenate([np.asarray(f) for f in lists])
            inside = np.arange(width)[None, :] < lengths[:, None]
            scores = np.zeros((len(words), width, len(languages)))
            scores[inside] = np.add.reduceat(weights[flat], np.concatenate([[0], np.cumsum(sizes[:-1])]), axis=0)
            marginal, expected = forward_backward(scores, lengths, transitions, pairs=True)
            truth = np.concatenate([np.asarray(c) for c in labels])
            error = marginal[inside]
            error[np.arange(len(truth)), truth] -= 1
            spread = np.repeat(error, sizes, axis=0)
            slope = np.stack([np.bincount(flat, spread[:, k], FEATURES) for k in range(len(languages))], axis=1) / len(words)
            squares += slope**2
            weights -= (0.3 * slope / np.sqrt(squares)).astype(np.float32)
            true = np.zeros_like(transitions)
            for chain in labels:
                np.add.at(true, (chain[:-1], chain[1:]), 1)
            slope = (expected - true) / len(words)
            pair_squares += slope**2
            transitions -= 0.1 * slope / np.sqrt(pair_squares)
    return languages, weights, transitions, seen


def _fragments(batches):
    for batch in batches:
        langs, fragments = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = _WORD.findall(text.lower())
            # Spread over the whole text, so that no part of it is preferred.
            last = max(0, len(words) - FRAGMENT_WORDS)
            for start in sorted({last * i // max(1, FRAGMENTS - 1) for i in range(FRAGMENTS)}):
                if words:
                    langs.append(lang)
                    fragments.append(words[start : start + FRAGMENT_WORDS])
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(fragments, pa.list_(pa.string()))], ["lang", "words"])


def fit(docs: DataFrame):
    """Train on a bounded sample of documents that are not held out and have a language.

    Of several texts with one doc_id and language the smallest is taken; null texts teach nothing.
    """
    usable = docs.where(held_out() == F.lit(False)).where("lang IS NOT NULL")
    # Of a common language only some four times the rows needed are ranked, by their hash. There is
    # a row per language, for each of which the model holds FEATURES weights anyway.
    counts = usable.groupBy("lang").agg((4.0 * ROWS_PER_LANGUAGE / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.select("doc_id", "lang").join(F.broadcast(counts), "lang").where(draw < F.col("share")).distinct()
    rank = Window.partitionBy("lang").orderBy(draw, "doc_id")
    chosen = drawn.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    # As many rows as languages times ROWS_PER_LANGUAGE at most, also where doc_ids repeat.
    texts = usable.select("doc_id", "lang", "text").where("text IS NOT NULL")
    texts = texts.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"])
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = texts.select("lang", "text").mapInArrow(_fragments, "lang string, words array<string>").collect()
    return train(sorted((r.lang, list(r.words)) for r in rows))


def held_out():
    """Whether crc32 of the doc_id as text is a multiple of five; false for a null doc_id."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


class Tagger:
    """Marginals of whole texts; scores of words are kept while there are not too many."""

    def __init__(self, languages, weights, transitions, seen):
        self.languages, self.weights, self.transitions, self.seen = languages, weights, transitions, seen
        self._forget()

    def _forget(self):
        self.numbers: dict[str, int] = {}
        self.scores, self.letters, self.known = emissions([], self.weights, self.seen)

    def codes(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.numbers) > KNOWN_WORDS:
            self._forget()
        numbers, known = self.numbers, len(self.numbers)
        coded = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in texts]
        new = list(numbers)[known:] if len(numbers) > known else []
        fresh = emissions(new, self.weights, self.seen)
        self.scores, self.letters, self.known = (np.concatenate(c) for c in zip((self.scores, self.letters, self.known), fresh, strict=True))
        return coded

    def marginals(self, coded: list[np.ndarray]):
        """``(text, word, marginals)`` arrays of the words of all texts, in order, some at a time."""
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        stretches = -(-counts // STRETCH)
        if not stretches.sum() or not self.languages:
            return
        owner = np.repeat(np.arange(len(coded)), stretches)
        order = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        lengths = np.minimum(STRETCH, counts[owner] - order * STRETCH)
        every, transitions = np.concatenate(coded), self.transitions.astype(np.float32)
        ends = np.cumsum(lengths)
        # Few stretches at a time, as one text may have millions of words.
        parts = [slice(start, start + 4096) for start in range(0, len(owner), 4096)]

        def scored(part):
            inside = np.arange(STRETCH)[None, :] < lengths[part, None]
            words = every[ends[part.start] - lengths[part.start] : ends[part][-1]]
            scores = np.zeros((len(inside), STRETCH, len(self.languages)), np.float32)
            scores[inside] = self.scores[words]
            return scores, inside, words

        passage = np.concatenate([passages(scored(part)[0], lengths[part], transitions) for part in parts])
        before, after = carried(passage, order, np.exp(transitions))
        for part in parts:
            scores, inside, words = scored(part)
            marginal, _ = forward_backward(scores, lengths[part], transitions, before=before[part], after=after[part])
            yield np.repeat(owner[part], lengths[part]), words, marginal[inside]

    def judge(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Mean marginals over the words of each text, and the share of its trigrams that are familiar; zeros without words."""
        means, letters, known = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts))
        coded = self.codes(texts)
        for text, words, marginal in self.marginals(coded):
            for label in range(len(self.languages)):
                means[:, label] += np.bincount(text, marginal[:, label], len(texts))
            letters += np.bincount(text, self.letters[words], len(texts))
            known += np.bincount(text, self.known[words, marginal.argmax(axis=1)], len(texts))
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        return means / np.maximum(counts, 1)[:, None], known / np.maximum(letters, 1)

    def mean_marginals(self, texts: list[list[str]]) -> np.ndarray:
        return self.judge(texts)[0]


def _words(text: str | None) -> list[str]:
    words = _WORD.findall(text.lower()) if text else []
    # Numerals such as superscripts match as words but are no letters.
    if words and not any(w.isalpha() for w in words) and not any(c.isalpha() for c in text):
        return []
    return words


def languages_of(docs: DataFrame, model) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, n_words, switches, familiar``.

    ``score`` is the mean marginal of the predicted language (of equal ones the first in order of
    name), ``switches`` counts other languages with a tenth of the words or more. A run of over 40
    letters counts as several words. A null text, or one without letters, is ``und`` with score 0, as
    is every text if there was nothing to train on. Repeated rows and null doc_ids are kept.
    """

    def over_all(batches):
        tagger = Tagger(*model)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, score, counts, switches, familiar = [], [], [], [], []
            pending: list[list[str]] = []
            held = 0

            def flush(pending, pred=pred, score=score, switches=switches, familiar=familiar):
                for words, means, share in zip(pending, *tagger.judge(pending), strict=True):
                    best = int(means.argmax()) if len(means) else 0
                    known = bool(words) and len(means) > 0
                    pred.append(tagger.languages[best] if known else UNKNOWN)
                    score.append(min(1.0, float(means[best])) if known else 0.0)
                    switches.append(int((means >= 0.1).sum()) - 1 if known else 0)
                    familiar.append(float(share))

            for text in texts:
                words = _words(text)
                counts.append(len(words))
                pending.append(words)
                held += len(words)
                if held >= BLOCK_WORDS:
                    flush(pending)
                    pending, held = [], 0
            flush(pending)
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                    pa.array(counts, pa.int64()), pa.array(switches, pa.int32()), pa.array(familiar, pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "n_words", "switches", "familiar"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(over_all, "doc_id bigint, held_out boolean, lang_pred string, score double, n_words bigint, switches int, familiar double")


def language_spans(docs: DataFrame, model) -> DataFrame:
    """Runs of neighbouring words with one label: ``doc_id, start, end, lang, n_words, score``.

    ``start`` and ``end`` are code points of the text, end exclusive, ``score`` is the mean marginal of the
    label over the words. Between words nothing is labelled; a span reaches from its first word to its
    last. Texts that are null or without letters have no spans, nor has any text if nothing was
    learned; rows that repeat have theirs once each.
    """

    def over_all(batches):
        tagger = Tagger(*model)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in slices([len(t or "") for t in texts], 8 * BLOCK_WORDS):
                found = [[m for m in _WORD.finditer(t or "") if any(c.isalpha() for c in m.group())] for t in texts[a:b]]
                places = [m.span() for matches in found for m in matches]
                judged = list(tagger.marginals(tagger.codes([[m.group().lower() for m in matches] for matches in found])))
                if not judged:
                    continue
                text, _, marginal = (np.concatenate(c) for c in zip(*judged, strict=True))
                label = marginal.argmax(axis=1)
                new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (text[1:] != text[:-1])]))
                many = np.diff(np.concatenate([new, [len(label)]]))
                means = np.add.reduceat(marginal[np.arange(len(label)), label], new, dtype=np.float64) / many
                yield pa.record_batch(
                    [
                        pa.array([ids[a + i] for i in text[new]], pa.int64()),
                        pa.array([places[i][0] for i in new], pa.int64()),
                        pa.array([places[i][1] for i in new + many - 1], pa.int64()),
                        pa.array([tagger.languages[i] for i in label[new]], pa.string()),
                        pa.array(many, pa.int64()), pa.array(np.minimum(means, 1.0), pa.float64()),
                    ],
                    ["doc_id", "start", "end", "lang", "n_words", "score"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(over_all, "doc_id bigint, start bigint, end bigint, lang string, n_words bigint, score double")


def drop_unknown(docs: DataFrame, model, *, least_familiar: float = 0.0, least_score: float = 0.0) -> DataFrame:
    """The documents, with all their columns, that are written in the languages learned, one or several.

    At least ``least_familiar`` of a text's letter trigrams must be known in the language its words are
    labelled with, and its language must have ``least_score`` at least; a value equal to the bound is
    enough. Null texts and texts without letters go, as does every text if nothing was learned. Rows
    that repeat stay or go alike; an empty table stays empty.
    """

    def over_all(batches):
        tagger = Tagger(*model)
        for batch in batches:
            kept = []
            pending: list[list[str]] = []
            held = 0
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                pending.append(_words(text))
                held += len(pending[-1])
                if held >= BLOCK_WORDS or i == len(texts) - 1:
                    means, shares = tagger.judge(pending)
                    best = means.max(axis=1, initial=0.0)
                    kept += [bool(w) and bool(m >= least_score and s >= least_familiar) and bool(tagger.languages) for w, m, s in zip(pending, best, shares, strict=True)]
                    pending, held = [], 0
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(over_all, docs.schema)
