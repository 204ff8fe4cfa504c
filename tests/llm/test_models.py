"""Language, mixture and the pipeline."""

import itertools
import math

import numpy as np
import pytest

import corpus_pipeline
from barlake.llm import language, mixing
from barlake.llm.common import table
from barlake.llm.language import drop_unknown, fit, language_spans, languages_of
from tests.llm.conftest import SMALL, by_id, rows


def test_forward_backward_matches_all_labelings():
    random = np.random.default_rng(3)
    scores, transitions = random.normal(size=(1, 4, 3)), random.normal(size=(3, 3))
    for length in (1, 3, 4):
        marginal, expected = np.zeros((4, 3)), np.zeros((3, 3))
        total = 0.0
        for labels in itertools.product(range(3), repeat=length):
            weight = math.exp(sum(scores[0, t, k] for t, k in enumerate(labels)) + sum(transitions[a, b] for a, b in itertools.pairwise(labels)))
            total += weight
            for t, k in enumerate(labels):
                marginal[t, k] += weight
            for a, b in itertools.pairwise(labels):
                expected[a, b] += weight
        got, pairs = language.forward_backward(scores, np.array([length]), transitions, pairs=True)
        assert np.allclose(got[0], marginal / total) and np.allclose(pairs, expected / total)


def test_mean_marginals_do_not_depend_on_company():
    model = language.train([("a", ["foo", "bar"]), ("b", ["quux", "zap"])] * 6, epochs=2)
    tagger = language.Tagger(*model)
    texts = [["foo"], [], ["bar", "zap"] * 100, ["quux"] * 64, ["foo"] * 65]
    together = tagger.mean_marginals(texts)
    alone = np.concatenate([tagger.mean_marginals([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5) and not together[1].any() and np.allclose(together[[0, 2, 3, 4]].sum(axis=1), 1, atol=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    return fit(table(spark, "/root/testdata/sf0.01", "documents"))


def test_held_out_documents_get_their_language(spark, model):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in rows(languages_of(docs, model)) if r["held_out"]]
    assert len(got) > 100 and all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in got) >= 0.98 * len(got)


def test_code_switched_text_shows_both_languages(spark, model, documents):
    langs = {r.lang: r.text for r in documents.where("n_chars > 400").collect()}
    mixed = " ".join(langs["en"].split()[:40] + langs["de"].split()[:40])
    tagger = language.Tagger(*model)
    means = dict(zip(model[0], tagger.mean_marginals([language._words(mixed)])[0], strict=True))
    assert means["en"] > 0.25 and means["de"] > 0.25


def test_messages_are_carried_through_whole_texts():
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    seen = np.zeros((language.TRIGRAMS, 3), bool)
    weights = random.normal(size=(language.FEATURES, 3)).astype(np.float32) * 0.1
    # Neighbours agree nearly always, so that a text cut into pieces would show it.
    tagger = language.Tagger(["a", "b", "c"], weights, np.eye(3) * 4.0, seen)
    texts = [[words[i] for i in random.integers(40, size=n)] for n in (1, 63, 64, 65, 128, 300, 1000)]
    got = list(tagger.marginals(tagger.codes(texts)))
    text, _, marginal = (np.concatenate(c) for c in zip(*got, strict=True))
    for i, own in enumerate(texts):
        scores = language.emissions(own, weights, seen)[0][None].astype(np.float64)
        want, _ = language.forward_backward(scores, np.array([len(own)]), np.eye(3) * 4.0)
        assert np.allclose(marginal[text == i], want[0], atol=1e-4)


def test_spans_of_a_mixed_text_are_labelled_word_by_word(spark, model):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("lang IN ('en', 'de') AND length(text) > 600")
    parts = {lang: [r.text for r in docs.where(f"lang = '{lang}'").orderBy("doc_id").limit(12).collect()] for lang in ("en", "de")}
    texts, truth = [], []
    for one, other in zip(parts["en"], parts["de"], strict=True):
        pieces = [(lang, " ".join(w for w in t.split() if w.isalpha())[:400].rsplit(" ", 1)[0]) for lang, t in (("en", one), ("de", other), ("en", other and one))]
        texts.append("½ " + " ".join(t for _, t in pieces))
        truth.append([lang for lang, t in pieces for _ in t.split()])
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(98, None, "x"), (99, "12 -", "x")], "doc_id bigint, text string, lang string")
    got = rows(language_spans(frame, model))
    right = total = 0
    for i, text in enumerate(texts):
        spans = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert all(a["end"] <= b["start"] and a["lang"] != b["lang"] for a, b in itertools.pairwise(spans))
        labels = [r["lang"] for r in spans for _ in text[r["start"] : r["end"]].split()]
        assert len(labels) == len(truth[i]) and sum(r["n_words"] for r in spans) == len(labels)
        right += sum(a == b for a, b in zip(labels, truth[i], strict=True))
        total += len(labels)
    assert right >= 0.95 * total and not [r for r in got if r["doc_id"] >= 98]


def test_texts_in_languages_not_learned_are_rejected(spark, model, documents):
    strange = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "qwrt zxcv plmk wqxz jkhg vbnm", "我" * 500, "x" * 100_000,
    ]
    langs = {r.lang: r.text for r in documents.where("n_chars > 400").orderBy("doc_id").collect()}
    mixed = [" ".join(langs[a].split()[:60] + langs[b].split()[:60]) for a, b in itertools.combinations(sorted(langs), 2)]
    whole = ["All human beings are born free and equal in dignity and rights.", *langs.values()]
    texts = [*strange, *mixed, *whole]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {r.doc_id for r in drop_unknown(frame, model, least_familiar=corpus_pipeline.LEAST_FAMILIAR).collect()}
    assert kept == set(range(len(strange), len(texts)))
    # Fewer labels make it no easier to pass.
    two = language.train([("a", ["walking", "talking"]), ("b", ["gehen", "sehen"])] * 9)
    kept = {r.doc_id for r in drop_unknown(frame.limit(len(strange)), two, least_familiar=corpus_pipeline.LEAST_FAMILIAR).collect()}
    assert not kept


def test_no_part_of_a_long_run_is_passed_over():
    one, other = ("a" * 60 + middle + "b" * 60 for middle in ("qqqqqqqqqq", "zzzzzzzzzz"))
    assert language._words(one) != language._words(other) and "".join(language._words(one)) == one
    assert all(len(w) <= 40 for w in language._words(one))


def test_language_of_odd_rows(spark, model, odd_docs, odd_rows, no_docs):
    got = rows(languages_of(odd_docs, model))
    assert len(got) == len(odd_rows)
    unknown = [r for r in got if r["lang_pred"] == "und"]
    assert len(unknown) == 4 and all(r["score"] == 0 for r in unknown)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert language._words("½ ² 12") == [] and language._words("a²") != []
    assert languages_of(no_docs, model).count() == 0
    nothing = fit(no_docs)
    assert {r["lang_pred"] for r in rows(languages_of(odd_docs, nothing))} == {"und"}
    kept = drop_unknown(odd_docs, model, least_score=0.0)
    assert kept.schema == odd_docs.schema and kept.count() == len(odd_rows) - 4


def test_held_out_needs_no_language(spark, documents, model):
    # Neither language, source nor number of a document is read when it is judged.
    assert {c for c in languages_of(documents.drop("lang", "source", "n_chars"), model).columns} >= {"lang_pred"}


def plain_rates(tokens, members, targets, steps):
    """The same projected gradients with numpy."""
    size = tokens.sum()
    metric = np.linalg.inv((members * tokens[:, None]).T @ members / size + 1e-9 * np.eye(members.shape[1]))
    rate = np.ones(len(tokens))
    for _ in range(steps):
        off = (tokens * rate) @ members / size - targets
        rate = np.maximum(0, rate - members @ (metric @ off))
    return rate


def test_rates_meet_targets_and_match_numpy(spark):
    random = np.random.default_rng(5)
    members = random.dirichlet([0.4, 0.3, 0.3], 400)
    tokens = random.integers(0, 2000, 400).astype(float)
    targets = {"high": 0.7, "low": 0.27, "toxic": 0.03}
    names = [f"p_{d}" for d in targets]
    frame = spark.createDataFrame([(i, int(t), *map(float, p)) for i, (t, p) in enumerate(zip(tokens, members, strict=True))], f"doc_id bigint, n_tokens bigint, {', '.join(f'{n} double' for n in names)}")
    steps, shares = mixing.fit_rates(frame, targets)
    got = np.array([r[0] for r in frame.orderBy("doc_id").select(mixing.rate(steps, list(targets))).collect()])
    assert np.allclose(got, plain_rates(tokens, members, np.array(list(targets.values())), len(steps)), atol=1e-6)
    assert (got >= 0).all() and np.allclose(shares, list(targets.values()), atol=2e-2)
    assert mixing.fit_rates(frame.limit(0), targets)[0] == []


def mixed_members(spark, alpha, targets=mixing.TARGETS):
    random = np.random.default_rng(11)
    members, tokens = random.dirichlet(alpha, 3000), random.integers(1, 2000, 3000)
    frame = spark.createDataFrame([(i, int(t), *map(float, p)) for i, (t, p) in enumerate(zip(tokens, members, strict=True))], f"doc_id bigint, n_tokens bigint, {', '.join(f'p_{d} double' for d in targets)}")
    mixed, shares, final = mixing.mixture(spark, frame, targets)
    rates = np.array([r.rate for r in mixed.orderBy("doc_id").collect()])
    assert (rates >= 0).all() and np.allclose(shares, (tokens * rates) @ members / tokens.sum(), atol=1e-9)
    return members, rates, np.array(shares), final


@pytest.mark.parametrize("alpha", [(0.1, 0.1, 0.1), (0.3, 0.2, 0.5), (1, 1, 1)])
def test_mixture_goes_on_until_targets_are_met(spark, alpha):
    _, _, shares, final = mixed_members(spark, alpha)
    assert final and np.abs(shares - list(mixing.TARGETS.values())).max() <= mixing.TOLERANCE


def test_mixture_out_of_reach_ends_at_the_nearest_shares(spark):
    members, rates, shares, final = mixed_members(spark, (10, 10, 10))
    off = shares - list(mixing.TARGETS.values())
    assert final and np.abs(off).max() > 0.05
    # Least squares over rates of 0 or more: no document's rate can lower the distance.
    assert (members @ off).min() > -1e-4 and abs(shares @ off) < 1e-4


def test_mixture_warns_of_targets_out_of_reach(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    with pytest.warns(UserWarning, match="high 0.3333 for 0.8000"):
        mixing.mix(spark, odd_docs, labels)


def test_mixture_of_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    got = by_id(mixing.mix(spark, docs, labels))
    size = sum(r["n_tokens"] for r in got.values())
    for domain, share in mixing.TARGETS.items():
        assert abs(sum(r["n_tokens"] * r["rate"] * r[f"p_{domain}"] for r in got.values()) / size - share) < 0.01
    truth = {r.doc_id: "toxic" if r.toxic else "high" if r.quality else "low" for r in labels.collect()}
    best = {i: max(mixing.TARGETS, key=lambda d: got[i][f"p_{d}"]) for i in truth}
    assert sum(best[i] == t for i, t in truth.items()) >= 0.95 * len(truth)


def test_mixture_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = rows(mixing.mix(spark, odd_docs, labels))
    assert len(got) == len(odd_rows) and all(r["rate"] >= 0 for r in got)
    assert all(abs(sum(r[f"p_{d}"] for d in mixing.TARGETS) - 1) < 1e-9 for r in got)
    equal = rows(mixing.mix(spark, odd_docs, labels.limit(0)))
    assert all(abs(r["p_low"] - 1 / 3) < 1e-9 for r in equal)
    assert mixing.mix(spark, no_docs, labels).count() == 0


def test_native_operators_run_no_python(spark, documents):
    from barlake.llm.exact_dedup import exact_groups

    labels = table(spark, SMALL, "labels")
    for frame in (exact_groups(spark, documents), mixing.mix(spark, documents, labels)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages_keep_columns_and_take_effect(spark, documents):
    from tests.llm.test_dedup import lower, plain_components, plain_fingerprint
    from tests.llm.test_scans import plain_contamination, plain_windows

    kept = {r.doc_id: r.text for r in documents.collect()}
    docs, after = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toPandas(), documents.schema)
        assert docs.columns == documents.columns
        after[name] = {r.doc_id: r.text for r in docs.collect()}
        assert all(kept[i] == t for i, t in after[name].items())
    assert set(after["language"]) == set(kept)
    last = {lower(t): i for i, t in sorted(kept.items())}
    assert set(after["exact_dedup"]) == set(last.values())
    near = plain_components({i: plain_fingerprint(t) for i, t in after["exact_dedup"].items()})
    assert set(after["near_dedup"]) == set(near.values())
    windows = plain_windows([(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()])
    assert set(after["decontaminate"]) == {i for i, t in after["near_dedup"].items() if not plain_contamination(t, windows)[1]}
    final = by_id(corpus_pipeline.run(spark, SMALL))
    assert set(final) == set(after["decontaminate"])


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns and out.count() <= docs.count()
    assert corpus_pipeline.known_language(spark, no_docs, SMALL).count() == 0
