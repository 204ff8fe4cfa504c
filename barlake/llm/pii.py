"""Personal data by weak supervision, in SQL functions only.

Patterns give candidate spans; regex, gazetteer and context labelers vote on each (-1, 0, 1).
Expectation-maximisation estimates from all votes how reliable each labeler is and how likely
each pattern of votes is personal data; those posteriors train the final classifier, a logistic
regression on votes, kind and shape. Spans of the fixed patterns always stay; the classifier
decides on the loose ones. Votes are counted by pattern, of which there is a fixed number, so
what the estimates need does not grow with the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "refusal", "extent")
#: The patterns in a form that takes linear time and constant stack: an attempt begins at the start of
#: a run (or behind the last match), and groups are not tried again once they have matched.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "loose": r"(?<![0-9+])\(?[0-9]++(?:[().\x20/-]{1,2}[0-9]++)++",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DIGITS = "translate(x, '+().- /', '')"
_LUHN = f"""(aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + if((length({_DIGITS}) - i) % 2 = 1,
    if(cast(substr({_DIGITS}, i, 1) AS int) > 4, 2 * cast(substr({_DIGITS}, i, 1) AS int) - 9, 2 * cast(substr({_DIGITS}, i, 1) AS int)),
    cast(substr({_DIGITS}, i, 1) AS int))) % 10 = 0)"""
VALID = {
    "email": "true",
    "ip": rf"x RLIKE r'^{_OCTET}(?:\.{_OCTET}){{3}}$'",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "loose": f"length({_DIGITS}) BETWEEN 7 AND 15",
}
#: Gazetteers: top-level domains, first digits of cards, calling codes, words before a number.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|mx|ar|at|ch|be"
CALLING = "1|7|20|27|30|31|32|33|34|36|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CONTACT = "phone|tel|call|fax|mobile|cell|contact|mail|card|visa|telefon|handy|anruf|appel|portable|llam|correo|tarjeta|karte|carte"
REFUSED = r"version|isbn|issn|page|seite|doi|art|vol|\$|€|#|="

_VOTES = {
    "regex": {"loose": "0", "": "1"},
    "gazetteer": {
        "email": rf"if(lower(x) RLIKE r'\.(?:{DOMAINS})$', 1, -1)",
        "ip": r"if(x RLIKE r'^(?:0|10|127|255)\.', -1, 1)",
        "card": "if(x RLIKE '^[3-6]', 1, -1)",
        "phone": rf"if(x RLIKE r'^\+(?:{CALLING})', 1, -1)",
        "loose": r"if(x RLIKE r'^\(?[0-9]{2,5}\)?[ .-]{1,2}[0-9]{3,4}[ .-][0-9]{3,6}$', 1, -1)",
    },
    "context": {"": f"if(lower(before) RLIKE r'(?:{CONTACT})', 1, 0)"},
    "refusal": {
        "loose": rf"if(lower(before) RLIKE r'(?:{REFUSED})[a-z.:]*\x20*$' OR x RLIKE r'^[0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}', -1, 0)",
        "": rf"if(lower(before) RLIKE r'(?:{REFUSED})[a-z.:]*\x20*$', -1, 0)",
    },
    "extent": {"email": "if(length(x) <= 64, 1, -1)", "ip": "if(length(x) >= 9, 1, 0)", "": f"if(length({_DIGITS}) BETWEEN 10 AND 16, 1, -1)"},
}
SHAPES = {"bracket": "instr(x, '(') > 0", "spaced": "instr(x, ' ') > 0", "dashed": "instr(x, '-') > 0"}
_TYPE = "array<struct<start:bigint,end:bigint,kind:string," + ",".join(
    [*(f"{n}:int" for n in LABELERS), *(f"{n}:boolean" for n in SHAPES)]
) + ">>"


#: Elements of a block of a pass over an array.
_BLOCK = 64


def _folded(rows: str, kind: str, zero: str, state: str, piece: str) -> str:
    """SQL for one pass over an array with a state: ``piece`` is the array of ``kind`` that the element ``e`` adds,
    ``state`` what follows ``acc.state``.

    What an aggregate holds is copied at each element, so elements are taken in blocks: the states at their
    starts are found first, and no more than a block's results are held at a time.
    """
    blocks = f"transform(sequence(0, greatest(ceil(size(a) / {_BLOCK}) - 1, 0L)), i -> slice(a, cast(i * {_BLOCK} + 1 AS int), {_BLOCK}))"
    after = f"aggregate(b, struct(every.state AS state), (acc, e) -> struct({state} AS state), acc -> acc.state)"
    starts = f"""aggregate(bs, struct({zero} AS state, cast(array() AS array<bigint>) AS starts),
        (every, b) -> struct({after} AS state, concat(every.starts, array(every.state)) AS starts), every -> every.starts)"""
    block = f"""aggregate(b, struct(s AS state, cast(array() AS {kind}) AS out),
        (acc, e) -> struct({state} AS state, concat(acc.out, {piece}) AS out), acc -> acc.out)"""
    return f"""flatten(transform(array({rows}), a -> flatten(transform(array({blocks}),
        bs -> flatten(zip_with(bs, {starts}, (b, s) -> {block}))))))"""


def _found(kind: str) -> str:
    """SQL for the valid matches of a kind as an array of spans with votes.

    A match starts where the lengths of all gaps and matches before it end; its context is the
    end of the gap before it.
    """
    votes = [f"{_VOTES[n].get(kind, _VOTES[n].get(''))} AS {n}" for n in LABELERS]
    shapes = [f"{sql} AS {n}" for n, sql in SHAPES.items()]
    pattern = f"r'{PATTERNS[kind]}'"
    span = f"struct(start, start + length(x) AS end, '{kind}' AS kind, {', '.join(votes + shapes)})"
    # Names inside the lambda are bound by one-element transforms, so that SQL above can use x and before.
    made = f"transform(array(1), one -> {span})"
    for name, value in (("x", "e.x"), ("before", "e.before"), ("start", "acc.state + e.gap")):
        made = f"flatten(transform(array({value}), {name} -> {made}))"
    valid = VALID[kind].replace("x RLIKE", "e.x RLIKE").replace("(x,", "(e.x,")
    guard = {"email": "instr(text, '@') > 0", "phone": "instr(text, '+') > 0"}.get(kind, "text RLIKE '[0-9]'")
    matches = f"""zip_with(split(text, {pattern}, -1), regexp_extract_all(text, {pattern}, 0),
        (g, x) -> struct(cast(length(g) AS bigint) AS gap, right(g, 24) AS before, x AS x))"""
    piece = f"CASE WHEN e.x IS NOT NULL AND {valid} THEN cast({made} AS {_TYPE}) ELSE cast(array() AS {_TYPE}) END"
    spans = _folded(matches, _TYPE, "0L", "acc.state + e.gap + coalesce(length(e.x), 0)", piece)
    return f"CASE WHEN {guard} THEN {spans} ELSE cast(array() AS {_TYPE}) END"


def _apart() -> str:
    """SQL for the loose spans neither inside nor across one of the others, by two passes over all in order of start."""
    none = f"cast(array() AS {_TYPE})"
    # Forwards: how far the others before it reach. Backwards: where the next other one starts.
    every = "array_sort(concat(email, ip, card, phone, loose))"
    clear = f"CASE WHEN e.kind = 'loose' AND acc.state > e.start THEN {none} ELSE array(e) END"
    ahead = _folded(every, _TYPE, "-1L", "CASE WHEN e.kind = 'loose' THEN acc.state ELSE greatest(acc.state, e.end) END", clear)
    kept = f"CASE WHEN e.kind = 'loose' AND acc.state >= e.end THEN array(e) ELSE {none} END"
    left = _folded(f"reverse({ahead})", _TYPE, f"{2**63 - 1}L", "CASE WHEN e.kind = 'loose' THEN acc.state ELSE e.start END", kept)
    return f"CASE WHEN size(loose) = 0 THEN loose ELSE reverse({left}) END"


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and an array of spans with votes for each kind, of every row."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = texts.select("doc_id", *[F.expr(_found(kind)).alias(kind) for kind in (*KINDS, "loose")])
    return spans.withColumn("loose", F.expr(_apart()))


def vote_patterns(found: DataFrame) -> DataFrame:
    """How many spans have each combination of kind, votes and shape."""
    every = found.select(F.explode(F.concat(*KINDS, "loose")).alias("s")).select("s.*")
    return every.groupBy("kind", *LABELERS, *SHAPES).agg(F.count("*").alias("n"))


def estimate(patterns: list, rounds: int = 25) -> tuple[list[float], dict]:
    """Posterior of each pattern, and P(vote | class) of each labeler, by expectation-maximisation.

    ``patterns`` are rows of ``vote_patterns``. Starts from the mean vote.
    """
    posts = [min(0.95, max(0.05, 0.5 + 0.2 * sum(r[name] for name in LABELERS))) for r in patterns]
    reliability: dict = {}
    for _ in range(rounds):
        total = sum(r["n"] for r in patterns)
        true = sum(r["n"] * p for r, p in zip(patterns, posts, strict=True))
        for name in LABELERS:
            for vote in (-1, 0, 1):
                own = [(r["n"] * p, r["n"] * (1 - p)) for r, p in zip(patterns, posts, strict=True) if r[name] == vote]
                yes, no = (sum(c) for c in zip(*own, strict=True)) if own else (0.0, 0.0)
                reliability[name, vote] = ((yes + 1) / (true + 3), (no + 1) / (total - true + 3))
        prior = (true + 1) / (total + 2)
        posts = []
        for r in patterns:
            logit = math.log(prior / (1 - prior))
            logit += sum(math.log(reliability[n, r[n]][0] / reliability[n, r[n]][1]) for n in LABELERS)
            posts.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))))
    return posts, reliability


def _features(r) -> list[float]:
    return [1.0, *(float(r[n]) for n in LABELERS), *(float(r[n]) for n in SHAPES), *(float(r["kind"] == k) for k in KINDS)]


def train(patterns: list, posts: list[float], steps: int = 300, rate: float = 0.5) -> list[float]:
    """Weights of a logistic regression on the posteriors, one for each of ``_features``."""
    rows = [(_features(r), r["n"], p) for r, p in zip(patterns, posts, strict=True)]
    total = sum(n for _, n, _ in rows) or 1
    weights = [0.0] * (1 + len(LABELERS) + len(SHAPES) + len(KINDS))
    for _ in range(steps):
        slope = [0.001 * w for w in weights]
        for features, n, p in rows:
            logit = sum(w * f for w, f in zip(weights, features, strict=True))
            error = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) - p)
            slope = [g + error * f for g, f in zip(slope, features, strict=True)]
        weights = [w - rate * g for w, g in zip(weights, slope, strict=True)]
    return weights


def pii_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, email, ip, card, phone, contact``, arrays of spans.

    Spans have ``start``, ``end`` (code points, end exclusive), their votes and ``score``. The
    first four hold the valid matches of the fixed patterns; ``contact`` holds loose numbers that
    the classifier takes for personal data. Null and empty texts have none; a corpus without any
    candidate trains on nothing and adds nothing. Repeated rows and null doc_ids are kept.
    """
    found = stored(spark, candidates(docs), "candidates")
    # At most kinds x 3^labelers x 2^shapes rows.
    patterns = vote_patterns(found).orderBy("kind", *LABELERS, *SHAPES).collect()
    posts, _ = estimate(patterns)
    weights = train(patterns, posts)
    terms = [repr(weights[0])]
    terms += [f"{w!r} * s.{n}" for w, n in zip(weights[1:], LABELERS, strict=False)]
    terms += [f"{w!r} * cast(s.{n} AS int)" for w, n in zip(weights[1 + len(LABELERS) :], SHAPES, strict=False)]
    kinds = " ".join(f"WHEN '{k}' THEN {w!r}" for k, w in zip(KINDS, weights[-len(KINDS) :], strict=True))
    terms.append(f"CASE s.kind {kinds} ELSE 0.0 END")
    logit = " + ".join(f"cast({t} AS double)" for t in terms)
    score = f"1 / (1 + exp(-({logit})))"

    def scored(column: str) -> str:
        return f"transform({column}, s -> struct(s.start, s.end, s.kind, {', '.join(f's.{n}' for n in LABELERS)}, {score} AS score))"

    taken = f"filter({scored('loose')}, s -> s.score >= 0.5)"
    return found.select("doc_id", *[F.expr(scored(k)).alias(k) for k in KINDS], F.expr(taken).alias("contact"))
