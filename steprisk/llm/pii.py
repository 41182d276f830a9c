"""Personal data: fixed patterns, and boosted trees over the candidates of high-recall generators. No Python on executors.

* Base spans: e-mail addresses, IP addresses, card and phone numbers by fixed patterns and checks.
* Candidates: looser generators propose spans of six kinds (those four, credentials and personal numbers), which may
  overlap each other and the base spans. Format and context give their features.
* Labels: gradient-boosted trees are fitted on the labelled candidates of all documents but a fifth by hash, which is held out for
  the thresholds. Positive: overlaps a base span of its kind, or is named as a credential or personal number
  right before. Negative: cannot be of its kind (failed checks, dates, plain long numbers, unnamed and unassigned strings, data of another kind).
  All others carry no label: they are what the trees decide. What makes the positives sure, their anchor (the plus, the at
  sign, the naming word), is hidden from the features, so the trees judge the rest of the format and the context.
* Counterexamples: each positive credential counts twice more as a negative, once as a bare string of a sentence and once
  as a digest or commit number, so that its characters alone never decide.
* Threshold of each kind: below its lowest score on held-out candidates from which all of the kind upwards reach
  ``PRECISION``, halfway to the next lower score seen; where none does, the kind adds nothing (an infinite threshold).
* The fitted trees become one SQL expression, so finding, scoring and redacting happen in a single projection over whole
  texts: nothing is exploded, joined or shuffled, and a text with thousands of spans is still one row.

A span's places come from the texts between the matches: ``split`` and ``regexp_extract_all`` walk the same matches.

Defined results: a null text is an empty one and has no span. Base spans always stay; a learned span is added only if it
overlaps none of them, nor a learned one before it. If the documents lack candidates of either class, nothing is learned or added.
Rows with null or equal ids are treated one by one. Columns other than those named play no role. An empty table gives none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steprisk.llm.common import free_name, written

# Kinds in their fixed order. The patterns find what these plain ones find, with starts and repeats that cannot
# backtrack: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) ;
# [0-9]([\x20-]?[0-9])+ ; \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
# What a text must hold for its pattern to be worth a walk.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Kinds that only the method finds, after the base ones.
ALL_KINDS = (*KINDS, "secret", "id")
GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]++(?:[ ._/-]{1,2}[0-9]++)*+",
    "phone": r"(?<![0-9])\(?[0-9]++(?:[ ().-]{1,3}[0-9]++)++",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+={0,2}+",
    "id": r"(?<![0-9A-Za-z-])[0-9]{2,6}+(?:-[0-9]{2,6}+){1,3}+(?![0-9A-Za-z-])",
}
# Fewest characters of a candidate, where the pattern alone does not say.
LEAST_LENGTH = {"card": 12, "phone": 8}
AT, DOT = r" ?[\(\[]at[\)\]] ?| ?@ ?", r" ?[\(\[]dot[\)\]] ?"
CONTEXT = 24
CONTEXT_WORDS = r"(?i)\b(tel|phone|call|fax|mobile|mail|contact|card|visa|account|ip|host|server)\b"
DIGEST_WORDS = r"(?i)(sha-?[0-9]|md5|crc|commit|digest|checksum|hash|uuid|guid|revision|build)"
_NAMED = {
    "secret": r"""(?i)\b(token|secret|passw(or)?d|pwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|bearer)["']?(\s?[:=]\s?|\s)["']?$""",
    "id": r"(?i)\b(ssn|social security|passport|national|tax|insurance)( (number|no|id))?[.:=#]?\s?$",
}
_ASSIGNED = r"""[:=]\s?["']?$"""
FEATURES = (
    "length", "digits", "separators", "groups", "longest_group", "parentheses", "dots", "letters", "luhn", "open_before",
    "open_after", "context_words", "context_letters", "context_digits", "generator", "switches", "capitals", "assigned",
    "quoted", "digest_words",
)
PRECISION = 0.99
ROUNDS, DEPTH = 16, 4
# The labels are weak: a few odd candidates must not get a leaf of their own.
_CAUTION = {"minInstancesPerNode": 5, "minInfoGain": 1e-3}


# --- spans ------------------------------------------------------------------------------------------------------------

_SPANS = "array<struct<start:int,kind:int,end:int,match:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches as (start, kind, end, match), in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(state: Column, place: Column) -> Column:
        match = F.element_at(found, place)
        begin = state["at"] + F.length(F.element_at(between, place))
        end = begin + F.length(match)
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), match.alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    walk = F.aggregate(F.sequence(F.lit(1), F.size(found)), start, add, lambda state: state["spans"])
    return F.when(F.size(found) > 0, walk).otherwise(F.array().cast(_SPANS))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.coalesce(part.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _of_kind(kind: str):
    return lambda span: _valid(kind, span["match"])


def base_spans(text: Column) -> Column:
    """The spans of all four kinds, by start, then kind."""
    some_digit = text.rlike("[0-9]")
    parts = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        needed = some_digit if NEEDS[kind] is None else text.contains(NEEDS[kind])
        if kind == "ip":
            needed = needed & some_digit
        spans = F.filter(_matches(text, pattern, number), _of_kind(kind))
        parts.append(F.when(needed, spans).otherwise(F.array().cast(_SPANS)))
    return F.array_sort(F.concat(*parts))


def _overlaps(one: Column, other: Column) -> Column:
    return (one["start"] < other["end"]) & (other["start"] < one["end"])


def candidates(text: Column) -> Column:
    """What the generators propose; spans of different generators may overlap."""
    some_digit = text.rlike("[0-9]")
    parts = []
    for kind, pattern in GENERATORS.items():
        needed = text.rlike(r"@|[\(\[]at[\)\]]") if kind == "email" else some_digit
        spans = _matches(text, pattern, ALL_KINDS.index(kind))
        if kind in LEAST_LENGTH:
            spans = F.filter(spans, _at_least(LEAST_LENGTH[kind]))
        if kind == "secret":
            spans = F.filter(spans, lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"))
        parts.append(F.when(needed, spans).otherwise(F.array().cast(_SPANS)))
    return F.concat(*parts)


def _at_least(length: int):
    return lambda span: F.length(span["match"]) >= length


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in ALL_KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


# --- features and trees -----------------------------------------------------------------------------------------------


def _before(span: Column, text: Column, size: int = CONTEXT) -> Column:
    return text.substr(F.greatest(span["start"] - size + 1, F.lit(1)), F.least(span["start"], F.lit(size)))


def _after(span: Column, text: Column) -> Column:
    return text.substr(span["end"] + 1, F.lit(CONTEXT))


def _longest_group(match: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.split(match, "[^0-9]+"), lambda g: F.length(g))), F.lit(0))


def _features(span: Column, text: Column) -> list[Column]:
    # An address written out looks like a plain one.
    match = F.regexp_replace(F.regexp_replace(span["match"], AT, "@"), DOT, ".")
    digits = _digits(match)
    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: F.length(g) > 0)
    before, after = _before(span, text), _after(span, text)
    # A plus right before a number is what the base pattern anchors on.
    near = F.regexp_replace(F.concat(before, F.lit(" "), after), r"\+", "")
    # The sign after a personal number's name is part of its anchor.
    assigned = before.rlike(_ASSIGNED) & (span["kind"] != F.lit(ALL_KINDS.index("id")))
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern))
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    columns = (
        F.length(match), F.length(digits), count(match, "[ ()._/-]"), F.size(groups), _longest_group(match),
        count(match, "[()]"), count(match, r"\."), count(match, "[A-Za-z]"),
        flag(F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)),
        flag(before.rlike(r"(^|[\s+:;,=(])$")), flag(after.rlike(r"^($|[\s:;,.)])")),
        count(near, CONTEXT_WORDS), count(near, r"\p{L}"), count(near, "[0-9]"), span["kind"],
        count(match, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), count(match, "[A-Z]"), flag(assigned),
        flag(before.rlike("""["']$""") & after.rlike("""^["']""")), count(before, DIGEST_WORDS),
    )
    return [column.cast("double") for column in columns]


def _label(span: Column, base: Column, text: Column) -> Column:
    """1 for sure data of the span's kind, 0 for what cannot be of it, else NULL."""
    kind, match = span["kind"], span["match"]
    of = lambda name: kind == F.lit(ALL_KINDS.index(name))
    digits = F.length(_digits(match))
    before = _before(span, text, 2 * CONTEXT)
    sure = F.exists(base, lambda b: _overlaps(b, span) & (b["kind"] == kind))
    other = F.exists(base, lambda b: _overlaps(b, span) & (b["kind"] != kind))
    for name, pattern in _NAMED.items():
        named = before.rlike(pattern)
        sure, other = sure | (of(name) & named), other | (~of(name) & named)
    never = (
        (of("email") & ~match.rlike("[A-Za-z]{2,}$"))
        | (of("ip") & (match.contains(",") | ~_valid("ip", F.regexp_replace(match, ",", "."))))
        | (of("card") & ~_valid("card", match))
        | (of("phone") & (~_valid("phone", match) | (_longest_group(match) > 7) | match.rlike(r"^(19|20)[0-9]{2}[.-]")))
        | (of("secret") & ~before.rlike(_ASSIGNED))
        | (of("id") & (~digits.between(8, 14) | match.rlike("^(19|20)[0-9]{2}-|-(19|20)[0-9]{2}$")))
    )
    return F.when(sure, 1.0).when(never | other, 0.0)


@dataclass(frozen=True)
class Judge:
    """Fitted trees as nested (feature, threshold, left, right) tuples or leaf values, weights, and the least margin per kind."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def margin(self, features: Column) -> Column:
        def expression(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, threshold, left, right = node
            return F.when(features[feature] <= threshold, expression(left)).otherwise(expression(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            total = total + expression(tree) * weight
        return total

    def accepts(self, features: Column, kind: Column) -> Column:
        least = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), kind + 1)
        return self.margin(features) >= least


def _nodes(model: GBTClassificationModel) -> tuple:
    def walk(node):
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return tuple(walk(tree._call_java("rootNode")) for tree in model.trees)


NOTHING = Judge((), (), (math.inf,) * len(ALL_KINDS))


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """Labelled candidates of all ``docs`` with their features; ``held_out`` goes by document."""
    key = F.xxhash64(F.lit(5), "doc_id", "text")
    texts = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    spans = texts.select("key", "text", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("found"))
    found = written(
        spans.where(F.size("found") > 0)
        .select("key", "text", "base", F.explode("found").alias("span"))
        .select(
            (F.pmod(F.shiftrightunsigned("key", 20), F.lit(5)) == 0).alias("held_out"),
            _label(F.col("span"), F.col("base"), F.col("text")).alias("label"),
            *[column.alias(name) for name, column in zip(FEATURES, _features(F.col("span"), F.col("text")))],
        )
        .where("label IS NOT NULL"),
        "pii-candidates",
    )
    credentials = found.where((F.col("generator") == ALL_KINDS.index("secret")) & (F.col("label") == 1.0)).withColumn("label", F.lit(0.0))
    bare = credentials.withColumns({"assigned": F.lit(0.0), "quoted": F.lit(0.0)})
    return found.unionByName(bare).unionByName(credentials.withColumn("digest_words", F.lit(1.0)))


def _threshold(bins: list[tuple[int, int, float]], precision: float) -> float:
    """Least margin for a kind from its (hundredth of the score, rows, positives): halfway between the lowest hundredth that
    reaches ``precision`` and the next lower one seen, or that lowest itself where none is lower."""
    least, rows, yes = None, 0, 0.0
    ordered = sorted(bins, reverse=True)
    for place, (score, n, positives) in enumerate(ordered):
        rows, yes = rows + n, yes + positives
        if positives and yes / rows >= precision:
            least = (score + 1 + ordered[place + 1][0]) / 200 if place + 1 < len(ordered) else score / 100
    if least is None:
        return math.inf
    probability = min(max(least, 1e-9), 1 - 1e-9)
    return math.log(probability / (1 - probability)) / 2


def fit(docs: DataFrame, precision: float = PRECISION) -> Judge:
    """Trees and thresholds from the candidates of ``docs`` (``doc_id``, ``text``); ``NOTHING`` if there is nothing to learn."""
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled_candidates(docs))
    learned_from, held_out = ready.where("not held_out"), ready.where("held_out")
    if learned_from.select("label").distinct().count() < 2:
        return NOTHING
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=3, checkpointInterval=-1, **_CAUTION).fit(learned_from)
    # Rows and positives per kind and hundredth of the score; at most 101 rows of a kind.
    scored = model.transform(held_out).select(
        F.col("generator").cast("int").alias("kind"),
        F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("score"), "label",
    )
    bins = scored.groupBy("kind", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("yes")).collect()
    thresholds = [
        _threshold([(found["score"], found["n"], found["yes"]) for found in bins if found["kind"] == kind], precision)
        for kind in range(len(ALL_KINDS))
    ]
    return Judge(_nodes(model), tuple(model.treeWeights), tuple(thresholds))


# --- finding and redacting -------------------------------------------------------------------------------------------


def with_spans(docs: DataFrame, judge: Judge | None, base: str = "_base_spans", spans: str = "_all_spans") -> DataFrame:
    """``docs`` with its base spans and all spans, by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumn(base, base_spans(text))
    if judge is None:
        return found.withColumn(spans, F.col(base))
    unknown = F.filter(candidates(text), lambda c: ~F.exists(F.col(base), lambda b: _overlaps(b, c)))
    seen = F.transform(unknown, lambda c: F.struct(c.alias("span"), F.array(*_features(c, text)).alias("features")))
    sure = F.filter(seen, lambda s: judge.accepts(s["features"], s["span"]["kind"]))
    accepted = F.array_sort(F.transform(sure, lambda s: s["span"]))

    def apart(kept: Column, span: Column) -> Column:
        clear = F.coalesce(F.try_element_at(kept, F.lit(-1))["end"] <= span["start"], F.lit(True))
        return F.when(clear, F.concat(kept, F.array(span))).otherwise(kept)

    added = F.aggregate(accepted, F.array().cast(_SPANS), apart)
    return found.withColumn(spans, F.array_sort(F.concat(F.col(base), added)))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in ALL_KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cover(state: Column, span: Column) -> Column:
        gap = text.substr(state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        part = F.when(span["start"] >= state["at"], F.concat(gap, F.element_at(names, span["kind"] + 1))).otherwise("")
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["parts"], F.array(part)).alias("parts")
        )

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), text.substr(state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, cover, finish)).otherwise(text)


def redact(docs: DataFrame, judge: Judge | None) -> DataFrame:
    """All rows and columns of ``docs``, with the personal data in ``text`` masked and ``n_chars``, if there, following it."""
    base, spans, masked = (free_name(name, docs.columns) for name in ("_base_spans", "_all_spans", "_masked_text"))
    found = with_spans(docs, judge, base, spans).withColumn(masked, redacted(F.col("text"), F.col(spans)))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col(masked).alias("text"))
        elif name == "n_chars":
            size = F.length(masked).cast(docs.schema[name].dataType)
            columns.append(F.when(F.size(spans) > 0, size).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return found.select(*columns)


def op10_pii(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` of every row."""
    found = with_spans(docs.select("doc_id", "text"), fit(docs))
    counts = [
        F.size(F.array_remove(F.transform("_base_spans", lambda s: s["kind"] == F.lit(number)), False)).cast("long").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("_base_spans")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_all_spans")).alias("spans"),
    )
