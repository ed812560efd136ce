"""Personal data by weak supervision, with DataFrame functions only.

Regular expressions propose candidate spans: four strict base kinds and further kinds (national phone numbers,
social security and bank account numbers, secrets). Three labelers vote on every candidate, each for,
against or abstaining: a *regex* labeler on its form, a *gazetteer* labeler on lists of codes and endings, and a
*context* labeler on cue words before it. Expectation-maximisation over the counts of the vote patterns estimates
every labeler's reliability, and the posteriors are the soft labels of a naive Bayes span classifier on surface
features. Base spans are always kept; other candidates are kept if the classifier says so and no base span
overlaps them.

Defined results: a null or empty text has no spans (the digest of an empty list); repeated rows are annotated alike;
an empty table gives an empty result and a classifier that follows its prior; other columns pass through
``annotated`` and are ignored by ``found``.

Scale: one pass over the texts, without a shuffle; patterns are possessive or bounded, so no text takes more than
linear time per pattern. The statistics are at most 27 vote patterns and a bounded set of features,
pre-aggregated where the rows are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from campaignlens.llm.common import Workspace

# The four base kinds, in the order that breaks ties. The patterns match exactly what the plain forms
# match leftmost and non-overlapping (a look-behind or ``\\G`` names the only places where a match can start).
BASE_KINDS = ("email", "ip", "card", "phone")
BASE_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OTHER_PATTERNS = {
    "phone_local": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![0-9A-Za-z])",
    "secret": r'(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|(?:password|passwd|secret|token|api_key) ?[=:] ?"?[A-Za-z0-9_-]{8,64}+"?)(?![0-9A-Za-z])',
}
KINDS = (*BASE_KINDS, *OTHER_PATTERNS)
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# A text without these characters or words can't hold the kind; a cheap test before the pattern.
GATES = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9 -]{10}", "phone": r"\+[0-9]", "phone_local": r"[0-9]{3}[.-][0-9]{4}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]", "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}", "secret": r"AKIA|password|passwd|secret|token|api_key",
}

GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|info|biz|io|de|fr|es|it|nl|uk|at|ch|be|eu|us|ca|mx|ar|br|jp|cn|in)$",
    "ip": r"^0*(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:3[47]|4|5[1-5]|2[2-7]|6(?:011|4|5))",
    "phone": r"^\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "phone_local": r"^\(?[2-9][0-9]{2}",
    "ssn": r"^(?!000|666|9)",
    "iban": r"^(?:DE|FR|ES|IT|NL|BE|AT|CH|GB|IE|PT|PL|SE|NO|DK|FI|LU)",
    "secret": r"^AKIA|[=:]",
}
CUES = {
    "email": r"e-?mail|contact|mailto|write|address|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|client|login|from",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": r"phone|call|tel|mobile|fax|cell|contact|anruf|llam|appel",
    "phone_local": r"phone|call|tel|mobile|fax|cell|contact|anruf|llam|appel",
    "ssn": r"ssn|social|security",
    "iban": r"iban|account|konto|cuenta|compte",
    "secret": r"key|password|passwd|secret|token|credential",
}
COUNTER_CUES = r"version|release|isbn|issn|order|invoice|page|section|figure|build"
CONTEXT_CHARS = 32
ROUNDS = 15


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """All matches of one pattern as ``(start, end, match)`` in code points, left to right."""
    gate = text.rlike(GATES[kind]) if kind != "email" else F.contains(text, F.lit("@"))
    found = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    between = F.when(gate, F.split(text, pattern, -1))
    none = "cast(array() as array<struct<start:int,end:int,match:string>>)"
    state = F.expr(f"struct(0 as pos, {none} as out)")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["pos"] + F.char_length(pair["between"])
        end = start + F.char_length(pair["found"])
        made = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("match"))
        further = F.struct(end.alias("pos"), F.concat(acc["out"], F.array(made)).alias("out"))
        return F.when(pair["found"].isNull(), acc).otherwise(further)

    pairs = F.arrays_zip(between.alias("between"), found.alias("found"))
    return F.coalesce(F.aggregate(pairs, state, step, lambda acc: acc["out"]), F.expr(none))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """Whether a match of a base kind counts; failing ones are dropped."""
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        return F.char_length(_digits(match)).between(12, 19) & _luhn(match)
    if kind == "phone":
        return F.char_length(_digits(match)).between(9, 15)
    return F.lit(True)


def _form(kind: str, match: Column) -> Column:
    """The regex labeler: base forms are strict; looser forms need a telling shape."""
    if kind in BASE_KINDS:
        return F.lit(1)
    strict = {
        "phone_local": r"^\([0-9]{3}\) |^[0-9]{3}([.-])[0-9]{3}\1",
        "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
        "iban": r"^[A-Z]{2}[0-9]{2}(?:[A-Z]{4})?[0-9]{7,}$",
        "secret": r"^AKIA|[0-9][A-Za-z_-]*[0-9]",
    }[kind]
    return F.when(match.rlike(strict), 1).otherwise(-1)


def _candidate(text: Column, kind: str, span: Column) -> Column:
    """One candidate with its votes and surface features."""
    match, start = span["match"], span["start"]
    from_char = F.greatest(start - CONTEXT_CHARS, F.lit(0))
    before = F.lower(F.substring(text, from_char + 1, start - from_char))
    form = _form(kind, match)
    listed = F.when(match.rlike(GAZETTEER[kind]), 1).otherwise(-1)
    context = F.when(before.rlike(CUES[kind]), 1).when(before.rlike(COUNTER_CUES), -1).otherwise(0)
    digits = F.least(F.char_length(_digits(match)), F.lit(20))
    features = F.array(
        F.lit(f"kind={kind}"),
        F.concat(F.lit(f"{kind} digits="), digits.cast("string")),
        F.concat(F.lit("separators="), match.rlike("[ ().-]").cast("string")),
        F.concat(F.lit("letters="), match.rlike("[A-Za-z]").cast("string")),
        F.concat(F.lit("open="), before.rlike(r"[\s(\"'<:=]$").cast("string")),
        F.concat(F.lit("cue="), context.cast("string")),
    )
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), span["end"].alias("end"), F.lit(kind).alias("kind"),
        F.lit(kind in BASE_KINDS).alias("base"), form.alias("form"), listed.alias("listed"), context.alias("context"),
        features.alias("features"),
    )


def annotated(docs: DataFrame) -> DataFrame:
    """The documents with ``candidates``: all candidate spans by start, kind and end."""
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = BASE_PATTERNS | OTHER_PATTERNS
    spans = docs.select("*", *[_spans(text, k, p).alias(f"__{k}") for k, p in patterns.items()])

    def of(kind: str) -> Column:
        kept = F.filter(F.col(f"__{kind}"), lambda s: _valid(kind, s["match"]))
        return F.transform(kept, lambda s: _candidate(text, kind, s))

    parts = [of(kind) for kind in patterns]
    return spans.select(*docs.columns, F.array_sort(F.concat(*parts)).alias("candidates"))


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities of the labelers and the span classifier's weights."""

    prior: float
    reliability: dict[tuple[str, int, int], float]
    bias: float
    weights: dict[str, float]


LABELERS = ("form", "listed", "context")


def _posterior(prior: float, reliability: dict) -> Column:
    odds = F.lit(math.log(prior / (1 - prior)))
    for name in LABELERS:
        table = F.create_map(*[x for v in (-1, 0, 1) for x in (F.lit(v), F.lit(math.log(reliability[name, v, 1] / reliability[name, v, 0])))])
        odds = odds + table[F.col(name)]
    return 1 / (1 + F.exp(-odds))


def train(candidates: DataFrame, workspace: Workspace, rounds: int = ROUNDS) -> SpanModel:
    """Fits the label model and then the classifier to a stored table with ``candidates``.

    Each round is one aggregation over the at most 27 counted vote patterns; the driver holds only parameters.
    """
    exploded = candidates.select(F.explode("candidates").alias("c")).select("c.*")
    patterns = workspace.table(exploded.groupBy(*LABELERS).agg(F.count(F.lit(1)).alias("n")), "votes")
    prior = 0.7
    reliability = {(name, v, y): p for name in LABELERS for y, row in ((1, (0.1, 0.2, 0.7)), (0, (0.7, 0.2, 0.1))) for v, p in zip((-1, 0, 1), row)}
    for _ in range(rounds):
        for_it = F.col("n") * _posterior(prior, reliability)
        against = F.col("n") - for_it
        sums = [F.sum(for_it).alias("1"), F.sum(against).alias("0")]
        for name in LABELERS:
            for v in (-1, 0, 1):
                sums += [F.sum(F.when(F.col(name) == v, m)).alias(f"{name} {v} {y}") for y, m in ((1, for_it), (0, against))]
        row = {k: x or 0.0 for k, x in patterns.agg(*sums).first().asDict().items()}
        prior = (row["1"] + 7) / (row["1"] + row["0"] + 10)
        # smoothing: 10 pseudo-votes per labeler and class, in the starting proportions
        for name in LABELERS:
            for y, start in ((1, (1.0, 2.0, 7.0)), (0, (7.0, 2.0, 1.0))):
                for v, s in zip((-1, 0, 1), start):
                    reliability[name, v, y] = (row[f"{name} {v} {y}"] + s) / (row[str(y)] + 10)
    soft = exploded.withColumn("p", _posterior(prior, reliability)).select("p", F.explode("features").alias("feature"))
    counted = soft.groupBy("feature").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("q")).collect()
    whole = {r["feature"]: (r["p"], r["q"]) for r in counted}
    kinds = [v for f, v in whole.items() if f.startswith("kind=")]
    positive, negative = sum(p for p, _ in kinds) + 2, sum(q for _, q in kinds) + 2
    weights = {f: math.log((p + 1) / positive) - math.log((q + 1) / negative) for f, (p, q) in whole.items()}
    return SpanModel(prior, reliability, math.log(positive / negative), weights)


def accepted(model: SpanModel) -> Column:
    """Kept spans of ``candidates``: all base spans, and others by the classifier where no base span overlaps."""
    weights = F.create_map(*[x for f, w in sorted(model.weights.items()) for x in (F.lit(f), F.lit(w))]) if model.weights else None

    def judged(c: Column) -> Column:
        if weights is None:
            return F.lit(model.bias >= 0)
        total = F.aggregate(c["features"], F.lit(model.bias), lambda a, f: a + F.coalesce(weights[f], F.lit(0.0)))
        return total >= 0

    base = F.filter("candidates", lambda c: c["base"])

    def free(c: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    return F.filter("candidates", lambda c: c["base"] | (judged(c) & free(c)))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Per document: ``doc_id``, all kept ``spans``, and the ``candidates`` with their votes."""
    workspace = workspace or Workspace(docs.sparkSession)
    candidates = workspace.table(annotated(docs.select("doc_id", "text")).drop("text"), "candidates")
    model = train(candidates, workspace)
    return candidates.select("doc_id", accepted(model).alias("spans"), "candidates")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    state = F.expr("struct(0 as pos, cast(array() as array<string>) as out)")

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        parts = F.concat(acc["out"], F.array(kept, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
        fresh = F.struct(s["end"].alias("pos"), parts.alias("out"))
        longer = F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["pos"], fresh).otherwise(longer)

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["pos"] + 1, F.char_length(text) - acc["pos"])
        return F.array_join(F.concat(acc["out"], F.array(rest)), "")

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, finish)).otherwise(text)


def redacted_documents(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text`` and ``n_chars`` recounted; all columns, all rows."""
    workspace = workspace or Workspace(docs.sparkSession)
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")  # other columns' names can't clash in it
    candidates = workspace.table(annotated(docs.select("text", record)), "candidates")
    model = train(candidates.select("candidates"), workspace)
    spans = candidates.withColumn("candidates", accepted(model))
    clean = spans.select("record", redacted(F.col("record.text"), F.col("candidates")).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("bigint")}
    return clean.select(*[new.get(c, F.col("record").getField(c)).alias(c) for c in docs.columns])
