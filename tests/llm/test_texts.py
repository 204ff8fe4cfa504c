"""Chat formatting and repeated passages, byte for byte."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from barlake.llm import chat, repeats
from barlake.llm.chat_queries import HOSTILE, op2_chat
from barlake.llm.repeats import drop_repeats
from barlake.llm.repeat_queries import op3_repeats
from tests.llm.conftest import LONG, SMALL, by_id, rows


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("<\\|>im_startendsep \n"), max_size=40) | st.sampled_from(chat.CONTROLS).flatmap(lambda c: st.text(max_size=9).map(lambda t: t + c + "\\" + c)))
def test_escaping_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)


@pytest.mark.parametrize("text", ["", "a", HOSTILE, "\U0001f600é\n\t ", "a" * 20_000, "<|endoftext|>", LONG])
def test_tokens_decode_to_the_text(text):
    tokens = chat.encode(text, chat.VOCABULARY)
    assert chat.decode(tokens, chat.VOCABULARY) == text and all(t < chat.reserved(chat.VOCABULARY)[0] for t in tokens)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(turns):
    """What must be read back of (role, text) turns in order."""
    turns = [(r or "", t or "") for r, t in turns]
    learned = "".join(t for r, t in turns if r == "assistant")
    chars = sum(32 + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns)
    return len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), digest(learned), chars


COLUMNS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def test_conversations_are_read_back(spark):
    turns = {-1: [(0, "user", HOSTILE), (1, "assistant", HOSTILE)]}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {r["conv_id"]: r for r in rows(op2_chat(spark, SMALL))}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        assert tuple(got[conv][c] for c in COLUMNS) == plain([t[1:] for t in sorted(own)])


def test_odd_conversations(spark):
    given_turns = [
        (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "assistant", "b"), (1, 4, "assistant", "c<|im_end|>"), (None, 1, None, "x"),
        (None, None, "assistant", "first"), (2, 1, "user", "same"), (2, 1, "user", "same"), (3, 1, "assistant", LONG), (4, 1, "ro<|im_sep|>\nle", "y"),
    ]
    frame = spark.createDataFrame([(*t, 7, "k") for t in given_turns], "conv_id bigint, turn bigint, role string, text string, ids int, loss string")
    formatted = chat.format_conversations(frame)
    got = {r["conv_id"]: r for r in rows(chat.read_back(formatted))}
    for conv in {t[0] for t in given_turns}:
        own = sorted((t[1:] for t in given_turns if t[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0))
        assert tuple(got[conv][c] for c in COLUMNS) == plain([t[1:] for t in own]), conv
    parts = [r for r in formatted.orderBy("turn").collect() if r.conv_id == 1]
    assert [p.offset for p in parts] == np.cumsum([0, *(len(p.ids) for p in parts)])[:-1].tolist()
    assert sum(parts[1].loss) == 0 and sum(parts[2].loss) == 1 and all(len(p.ids) == len(p.loss) for p in parts)
    assert chat.format_conversations(frame.limit(0)).count() == 0
    many = spark.createDataFrame([(5, i, "assistant", f"t{i}") for i in range(3000)], "conv_id bigint, turn bigint, role string, text string")
    assert rows(chat.read_back(chat.format_conversations(many)))[0]["loss_sha256"] == digest("".join(f"t{i}" for i in range(3000)))


def plain_repeats(texts):
    """Removed flags of each text (bytes, in order), by a set of all windows so far."""
    seen, result = set(), []
    for text in texts:
        flags = bytearray(len(text))
        for at in range(len(text) - repeats.LENGTH + 1):
            window = text[at : at + repeats.LENGTH]
            if window in seen:
                flags[at : at + repeats.LENGTH] = b"\1" * repeats.LENGTH
            seen.add(window)
        result.append(flags)
    return result


def expected_row(text, flags):
    runs = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
    kept = bytes(b for b, f in zip(text, flags, strict=True) if not f)
    return len(text), sum(flags), runs, hashlib.sha256(kept).hexdigest()


def test_repeats_match_a_set_of_windows(spark, documents):
    texts = sorted((r.doc_id, (r.text or "").encode()) for r in documents.collect())
    got = by_id(op3_repeats(spark, SMALL))
    for (i, text), flags in zip(texts, plain_repeats([t for _, t in texts]), strict=True):
        own = got[i]
        assert (own["n_bytes"], own["n_removed"], own["n_spans"], own["kept_sha256"]) == expected_row(text, flags)


@pytest.mark.parametrize("group_segments", [20_000, 2])
def test_repeats_of_made_texts(spark, make_docs, monkeypatch, group_segments):
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("abcd é") for _ in range(n))

    passage, line = noise(400), noise(130)
    texts = ["a" * 500, "ab" * 300, passage, *(noise(rng.randrange(150)) + passage[rng.randrange(200) : rng.randrange(230, 400)] + noise(50) for _ in range(40))]
    texts += [noise(60) + line + noise(30) + line for _ in range(10)] + ["", noise(99), passage[:100], passage[:99], noise(5000) * 2, None]
    rows_given = list(enumerate(texts)) + [(None, passage)]
    order = sorted(rows_given, key=lambda r: (r[0] is not None, r[0] or 0))
    flags = plain_repeats([(t or "").encode() for _, t in order])
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 4096)
    got = {r["doc_id"]: r for r in rows(drop_repeats(spark, make_docs(rows_given), group_segments=group_segments))}
    for (i, text), own in zip(order, flags, strict=True):
        row = got[i]
        removed = sum(s["end"] - s["start"] for s in row["spans"])
        found = (row["n_bytes"], removed, len(row["spans"]), hashlib.sha256(bytes(row["kept"])).hexdigest())
        assert found == expected_row((text or "").encode(), own), i


def test_longest_previous_factors():
    text = b"abaababaab"
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))

    def common(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    shared = np.array([0, *(common(a, b) for a, b in zip(order[:-1], order[1:], strict=True))])
    expected = [max((common(j, i) for j in range(i)), default=0) for i in range(len(text))]
    assert repeats.longest_previous(order, shared).tolist() == expected


def test_repeats_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = rows(drop_repeats(spark, odd_docs))
    assert len(got) == len(odd_rows) and {r["n_bytes"] for r in got if r["doc_id"] in (3, 4)} == {0}
    assert [len(r["kept"]) for r in got if r["doc_id"] == 5][0] < 200
    assert drop_repeats(spark, no_docs).count() == 0
    # Rows that repeat doc_id and text are one document.
    twice = "".join(chr(97 + i * i % 23) + str(i) for i in range(80))
    frame = spark.createDataFrame([(1, twice), (1, twice), (2, twice)], "doc_id bigint, text string")
    assert sorted((r["doc_id"], len(r["spans"])) for r in rows(drop_repeats(spark, frame))) == [(1, 0), (1, 0), (2, 1)]
